"""Named queries: every feature operator, table and check as a callable
``(spark, sf_dir) -> DataFrame`` over the star-schema test data.

Doubles that depend on the order of summation (``ORDER_DEPENDENT_COLUMNS``) are
rounded to 12 significant digits in this presentation layer, as the oracle SQL
does; all others, and the operators themselves, keep full precision.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketflow.functions import significant
from basketflow.operators import product, quality, user, user_product
from basketflow.plans import mldataset, tables
from basketflow.plans.facts import shared_facts
from basketflow.sources import store
from basketflow.sources.fixtures import star_schema_on_demand
from basketflow.sources.readers import Sources
from basketflow.sources.schema import ORDER_DEPENDENT_COLUMNS


def presented(df: DataFrame) -> DataFrame:
    return df.select(*[significant(F.col(c)).alias(c) if c in ORDER_DEPENDENT_COLUMNS else F.col(c)
                       for c in df.columns])


def _over_sources(name: str, op: Callable[[Sources], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        src = star_schema_on_demand(spark, sf_dir)
        # The query is planned once per input state, like a prepared statement;
        # every call is a query of its own over that plan.
        found = store.once(spark, f"query-{name}", src.home, lambda: op(src))
        return found if op is _t6 else presented(found)
    run.__name__ = getattr(op, "__name__", "query")
    run.__doc__ = op.__doc__
    return run


def _t1(src: Sources) -> DataFrame:
    return tables.user_feature(src)


def _t2(src: Sources) -> DataFrame:
    return tables.product_feature(src)


def _t3(src: Sources) -> DataFrame:
    return tables.user_product_feature(src)


def _t4(src: Sources) -> DataFrame:
    return mldataset.ml_dataset(src)


def _t5(src: Sources) -> DataFrame:
    return mldataset.ml_dataset(src, with_target=True)


def _t6(src: Sources) -> DataFrame:
    """The line dataset joined with the stored feature tables.  They are rounded
    before they meet the lines: a value of a user or product once, not by line,
    and what writes the 95 columns stays a method that the JVM compiles (8,000
    bytecodes at most)."""
    uf, pf, upf = map(presented, tables.shared_tables(src))
    return mldataset.final_of_sources(src, uf, pf, upf, shared_facts(src))


TABLE_BUILDERS = {
    "t1_user_feature": _t1,
    "t2_product_feature": _t2,
    "t3_user_product_feature": _t3,
    "t4_ml_dataset": _t4,
    "t5_target_variable": _t5,
    "t6_ml_dataset_final": _t6,
}


def all_operators() -> dict[str, Callable[[Sources], DataFrame]]:
    ops: dict[str, Callable[[Sources], DataFrame]] = {}
    ops.update(product.OPERATORS)
    ops.update(user_product.OPERATORS)
    ops.update(user.OPERATORS)
    ops.update(TABLE_BUILDERS)
    ops.update(quality.CHECK_QUERIES)
    return ops


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _over_sources(name, op) for name, op in all_operators().items()}
