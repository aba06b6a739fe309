"""Operators of a training-data pipeline (nothing else in the package imports
this subpackage).  Each module holds one operator; ``queries`` registers the
``opN_<name>`` queries and the DuckDB statements that check them."""
