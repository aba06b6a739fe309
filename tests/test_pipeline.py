"""End-to-end build writes all tables and reads them back."""

import tempfile

import pytest

from basketflow.operators.quality import DataQualityError
from basketflow.plans.pipeline import build_all
from basketflow.sources.schema import (
    ML_DATASET_COLUMNS, PRODUCT_FEATURE_COLUMNS, USER_FEATURE_COLUMNS, USER_PRODUCT_FEATURE_COLUMNS,
)


def test_build_all(spark, small_sources):
    out = tempfile.mkdtemp(prefix="basketflow-test-")
    steps = build_all(spark, small_sources, out, check=False)
    assert "checks" not in steps
    final = spark.read.parquet(f"{out}/ml_dataset_final")
    assert len(final.columns) == 95
    assert final.columns[:3] == ["user_id", "product_id", "order_id"]
    assert final.count() == 4466
    assert spark.read.parquet(f"{out}/user_feature").columns == USER_FEATURE_COLUMNS
    assert spark.read.parquet(f"{out}/product_feature").columns == PRODUCT_FEATURE_COLUMNS
    assert spark.read.parquet(f"{out}/user_product_feature").columns == USER_PRODUCT_FEATURE_COLUMNS
    assert spark.read.parquet(f"{out}/ml_dataset").columns == ML_DATASET_COLUMNS


def test_csv_source_round_trip(spark, small_sources):
    from pyspark.sql import functions as F

    from basketflow.sources.readers import CSV_FILE_NAMES, read_csv_sources
    folder = tempfile.mkdtemp(prefix="basketflow-csv-")
    for name, df in small_sources.as_dict().items():
        out = df
        if "reordered" in df.columns:
            out = df.withColumn("reordered", F.col("reordered").cast("int"))
        out.coalesce(1).write.option("header", True).csv(f"{folder}/{name}")
    names = {k: f"{k}/*.csv" for k in CSV_FILE_NAMES}
    back = read_csv_sources(spark, folder, names)
    assert back.order_products_prior.schema == small_sources.order_products_prior.schema
    assert back.order_products_prior.filter("reordered").count() == 3043
    assert back.orders.exceptAll(small_sources.orders).count() == 0


def test_build_all_from_csv(spark, small_sources):
    from pyspark.sql import functions as F

    from basketflow.sources.readers import CSV_FILE_NAMES, read_csv_sources
    folder = tempfile.mkdtemp(prefix="basketflow-csv-")
    for name, df in small_sources.as_dict().items():
        if "reordered" in df.columns:
            df = df.withColumn("reordered", F.col("reordered").cast("int"))
        df.coalesce(1).write.option("header", True).csv(f"{folder}/{name}")
    src = read_csv_sources(spark, folder, {k: f"{k}/*.csv" for k in CSV_FILE_NAMES})
    out = tempfile.mkdtemp(prefix="basketflow-csv-out-")
    steps = build_all(spark, src, out, check=False)
    assert set(steps) >= {"sources", "facts", "ml_dataset_final"}
    assert spark.read.parquet(f"{out}/ml_dataset_final").count() == 4466
    assert spark.read.parquet(f"{out}/user_product_feature").count() == 1423


def test_build_all_reports_bad_rows(spark, small_sources):
    """The fixture's gaps exceed 30 days, which one check does not allow."""
    out = tempfile.mkdtemp(prefix="basketflow-test-")
    with pytest.raises(DataQualityError, match="user_domain_bounds: 149$"):
        build_all(spark, small_sources, out)
    assert spark.read.parquet(f"{out}/user_feature").count() == 150
