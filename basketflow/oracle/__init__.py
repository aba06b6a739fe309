"""DuckDB SQL that states every query independently of the Spark code.

The driver runs each statement against the star-schema Parquet views and
compares the result with the Spark query of the same name.
"""

from basketflow.oracle.statements import oracle_sql  # noqa: F401
