"""The six input tables as one ``Sources`` bundle, read from CSV or Parquet."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketflow.sources import store
from basketflow.sources.csvsplit import read_split_csv
from basketflow.sources.schema import CSV_READ_SCHEMAS, SCHEMAS

# File names of the original CSV export (fixed values).
CSV_FILE_NAMES = {
    "aisles": "aisles.csv",
    "departments": "departments.csv",
    "orders": "orders.csv",
    "products": "products.csv",
    "order_products_prior": "order_products__prior.csv",
    "order_products_train": "order_products__train.csv",
}


@dataclass(frozen=True)
class Sources:
    """Input tables of the model, each a lazily evaluated DataFrame."""

    aisles: DataFrame
    departments: DataFrame
    orders: DataFrame
    products: DataFrame
    order_products_prior: DataFrame
    order_products_train: DataFrame
    # Shared folder for what is derived from these tables, keyed by the state
    # of their files; None for sources that are only a plan.
    home: str | None = None

    def as_dict(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in SCHEMAS}


class SourcesOnDemand:
    """``Sources`` whose tables are stored when they are first read, so a query
    waits for the tables it reads alone.  To be read while the input files are
    as they were when ``home`` was found."""

    def __init__(self, home: str, build: Callable[[str], DataFrame]):
        self.home, self._build = home, build

    def __getattr__(self, name: str) -> DataFrame:
        if name not in SCHEMAS:
            raise AttributeError(name)
        table = self._build(name)
        setattr(self, name, table)
        return table

    def as_dict(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in SCHEMAS}


def _conform(df: DataFrame, name: str) -> DataFrame:
    """Select the model columns in model order with model types."""
    schema = SCHEMAS[name]
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def read_csv_sources(spark: SparkSession, folder: str, file_names: dict[str, str] | None = None,
                     multi_line: bool = False) -> Sources:
    """Read the six CSV files (comma separated, header row) and keep them as
    typed Parquet in the shared checkpoint folder, keyed by the files' state.

    Fields may be quoted; a quote inside a quoted field is doubled.  An empty
    unquoted field is NULL, a quoted empty one an empty string.  Rows that do
    not fit the schema fail the read (FAILFAST) instead of turning into silent
    NULLs.  ``reordered`` is read as 0/1 and cast.  Line ends inside quoted
    fields need ``multi_line``, with which records are put together from lines
    by quote parity (``csvsplit``; a file is still read by many tasks); without
    it such a row fails the read.
    """
    names = file_names or CSV_FILE_NAMES
    paths = {name: f"{folder.rstrip('/')}/{names[name]}" for name in CSV_READ_SCHEMAS}
    root = store.folder_of(spark, "csv", list(paths.values()), str(multi_line))

    def read(name: str) -> DataFrame:
        if multi_line:
            return _conform(read_split_csv(spark, paths[name], CSV_READ_SCHEMAS[name]), name)
        raw = (spark.read.schema(CSV_READ_SCHEMAS[name]).option("header", True).option("mode", "FAILFAST")
               .option("quote", '"').option("escape", '"').csv(paths[name]))
        return _conform(raw, name)

    return store.once(spark, "sources", root, lambda: _laid_out(spark, root, read))


# Orders and lines are stored by order: what meets or groups them by order
# needs no exchange of lines.
BY_ORDER = {"orders": "order_id", "order_products_prior": "order_id", "order_products_train": "order_id"}


def _laid_out(spark: SparkSession, root: str, read: Callable[[str], DataFrame]) -> Sources:
    """The six tables, stored under ``root``."""
    frames = {name: _conform(store.materialise(spark, f"{root}/{name}", lambda n=name: read(n),
                                               bucket_by=BY_ORDER.get(name)), name) for name in SCHEMAS}
    return Sources(**frames, home=root)


def read_parquet_sources(spark: SparkSession, folder: str) -> Sources:
    """Read the six tables from ``<folder>/<table>`` Parquet datasets.  Orders
    and lines are stored once more in the shared checkpoint folder, laid out by
    order (one exchange, which every later use of them is spared), and so is
    what is derived; all keyed by the files' state.  The input folder is only
    read."""
    paths = {name: f"{folder.rstrip('/')}/{name}" for name in SCHEMAS}
    root = store.folder_of(spark, "parquet", list(paths.values()))
    return store.once(spark, "sources", root,
                      lambda: _laid_out(spark, root, lambda n: _conform(spark.read.parquet(paths[n]), n)))


def write_parquet_sources(sources: Sources, folder: str) -> None:
    """Store the six tables once as Parquet (columnar, typed) for later jobs."""
    for name, df in sources.as_dict().items():
        df.write.mode("overwrite").parquet(f"{folder.rstrip('/')}/{name}")
