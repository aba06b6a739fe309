"""End-to-end build: sources -> shared facts -> feature tables (checked)
-> ML dataset.

The five tables in the output folder are always rebuilt.  What they are
derived from (typed sources, shared facts) is kept in the shared checkpoint
folder, keyed by the state of the input files and the code, so changed input
is never mixed with what was derived before.

Every table is written as Parquet and read back before it is used again,
so each job starts from stored data: the feature tables are checked on
what was written, and ``ml_dataset_final`` joins the stored tables instead
of re-planning 3 x 20 aggregations under one root.

Usage::

    python -m basketflow.plans.pipeline --star /root/testdata/sf0.01 --out /data/features
    python -m basketflow.plans.pipeline --csv /data/basket_csv --out /data/features
"""

from __future__ import annotations

import argparse
import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

from basketflow.operators import quality
from basketflow.plans import mldataset, tables
from basketflow.plans.facts import shared_facts
from basketflow.session import build_session, ensure_checkpoint_dir
from basketflow.sources.readers import Sources, read_csv_sources, read_parquet_sources, write_parquet_sources
from basketflow.sources.sinks import read_table, write_and_read, write_table


def stored_sources(spark: SparkSession, src: Sources) -> Sources:
    """Sources that derived tables can be stored for: those that are only a
    plan are written to a fresh shared folder first."""
    if src.home is not None:
        return src
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/basketflow-plan/{uuid.uuid4().hex}"
    write_parquet_sources(src, folder)
    return read_parquet_sources(spark, folder)


def build_all(spark: SparkSession, src: Sources, out_dir: str, check: bool = True) -> dict[str, float]:
    """Build and write all five tables under ``out_dir``; returns seconds
    per step.  With ``check`` the row checks are counted while the feature
    tables are written, the others run on the written tables, and any violation
    raises ``DataQualityError``.  A table is replaced when its new version is
    complete; until then the old one can be read."""
    out = out_dir.rstrip("/")
    steps: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.perf_counter()
        result = fn()
        steps[name] = round(time.perf_counter() - t0, 3)
        return result

    src = timed("sources", lambda: stored_sources(spark, src))
    fx = timed("facts", lambda: shared_facts(src))
    seen: dict[str, dict] = {}

    def built(name: str, build) -> DataFrame:
        """Write a feature table and count its row checks on the way."""
        seen[name] = write_table(build(src, fx), f"{out}/{name}", quality.observed_counts(name) if check else None)
        return read_table(spark, f"{out}/{name}")

    uf = timed("user_feature", lambda: built("user_feature", tables.user_feature))
    pf = timed("product_feature", lambda: built("product_feature", tables.product_feature))
    upf = timed("user_product_feature", lambda: built("user_product_feature", tables.user_product_feature))
    if check:
        def run_checks():
            report = (quality.key_checks(src).unionByName(quality.reference_checks(src))
                      .unionByName(quality.user_feature_checks(uf, src, seen["user_feature"]))
                      .unionByName(quality.product_feature_checks(pf, src, seen["product_feature"]))
                      .unionByName(quality.user_product_feature_checks(upf, uf, pf, src, seen["user_product_feature"])))
            return quality.enforce(report)
        timed("checks", run_checks)
    ml = timed("ml_dataset", lambda: write_and_read(mldataset.ml_dataset(src), f"{out}/ml_dataset"))
    timed("ml_dataset_final",
          lambda: write_and_read(mldataset.ml_dataset_final(ml, uf, pf, upf, fx), f"{out}/ml_dataset_final"))
    return steps


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    group = parser.add_mutually_exclusive_group(required=True)
    group.add_argument("--csv", help="folder with the six CSV files")
    group.add_argument("--parquet", help="folder with the six tables as Parquet datasets")
    group.add_argument("--star", help="folder with the star-schema test Parquet files")
    parser.add_argument("--out", required=True, help="output folder (shared storage on a cluster)")
    parser.add_argument("--master", default=None)
    parser.add_argument("--shuffle-partitions", type=int, default=None,
                        help="initial shuffle partitions (about shuffle bytes / 128 MB); AQE coalesces")
    parser.add_argument("--no-check", action="store_true")
    args = parser.parse_args(argv)
    spark = build_session(args.master, shuffle_partitions=args.shuffle_partitions)
    if args.csv:
        src = read_csv_sources(spark, args.csv)
    elif args.parquet:
        src = read_parquet_sources(spark, args.parquet)
    else:
        from basketflow.sources.fixtures import load_star_schema
        src = load_star_schema(spark, args.star)
    print(json.dumps(build_all(spark, src, args.out, check=not args.no_check)))


if __name__ == "__main__":
    main()
