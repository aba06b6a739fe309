"""Changed input is never mixed with what was derived from earlier input, and
input folders are only read."""

import json
import os
import subprocess
import sys

import pytest
from conftest import ROOT
from pyspark.sql import functions as F

from basketflow.plans.pipeline import build_all
from basketflow.sources.readers import CSV_FILE_NAMES, read_csv_sources, read_parquet_sources
from basketflow.sources.schema import SCHEMAS

OUTPUTS = ("user_feature", "product_feature", "user_product_feature", "ml_dataset", "ml_dataset_final")
CSV = {
    "aisles": "aisle_id,aisle\n1,fresh\n2,\n",
    "departments": "department_id,department\n1,produce\n",
    "products": 'product_id,product_name,aisle_id,department_id\n1,"Bread, sliced",1,1\n2,"5"" Tart, ""Deep"" Dish",1,1\n3,,2,1\n',
    "orders": "order_id,user_id,eval_set,order_number,order_dow,order_hour_of_day,days_since_prior_order\n"
              "1,1,prior,1,0,8,\n2,1,prior,2,3,9,4\n3,2,prior,1,1,1,\n",
    "order_products_train": "order_id,product_id,add_to_cart_order,reordered\n",
}
LINES = "order_id,product_id,add_to_cart_order,reordered\n"
A = LINES + "1,1,1,0\n2,1,1,1\n3,1,1,0\n"
B = LINES + "1,2,1,0\n1,1,2,0\n2,1,1,1\n3,2,1,0\n3,3,2,0\n"


def write_csv(folder, lines):
    for name, text in {**CSV, "order_products_prior": lines}.items():
        with open(os.path.join(folder, CSV_FILE_NAMES[name]), "w") as f:
            f.write(text)


def tables(spark, out):
    return {n: sorted(map(str, spark.read.parquet(f"{out}/{n}").collect())) for n in OUTPUTS}


def test_second_csv_build_in_one_process(spark, tmp_path):
    folder, out, clean = (str(tmp_path / d) for d in ("in", "out", "clean"))
    os.mkdir(folder)
    write_csv(folder, A)
    build_all(spark, read_csv_sources(spark, folder), out)
    first = tables(spark, out)
    write_csv(folder, B)
    build_all(spark, read_csv_sources(spark, f"file://{folder}"), out)
    again = str(tmp_path / "copy")
    os.mkdir(again)
    write_csv(again, B)
    build_all(spark, read_csv_sources(spark, again), clean)
    assert tables(spark, out) == tables(spark, clean) != first
    assert sorted(os.listdir(folder)) == sorted(CSV_FILE_NAMES.values())


def test_second_parquet_build_of_several_files(spark, tmp_path):
    folder, out, clean = (str(tmp_path / d) for d in ("in", "out", "clean"))
    csv = str(tmp_path / "csv")
    os.mkdir(csv)

    def write(lines, where):
        write_csv(csv, lines)
        for name, df in read_csv_sources(spark, csv).as_dict().items():
            df.repartition(3).write.mode("overwrite").parquet(f"{where}/{name}")

    write(A, folder)
    build_all(spark, read_parquet_sources(spark, folder), out)
    write(B, folder)
    build_all(spark, read_parquet_sources(spark, folder), out)
    write(B, str(tmp_path / "other"))
    build_all(spark, read_parquet_sources(spark, f"file://{tmp_path}/other"), clean)
    assert tables(spark, out) == tables(spark, clean)
    assert sorted(os.listdir(folder)) == sorted(SCHEMAS)


def test_second_build_in_another_process(spark, tmp_path):
    """Two applications that share a checkpoint folder."""
    folder, out, shared, clean = (str(tmp_path / d) for d in ("in", "out", "shared", "clean"))
    os.mkdir(folder)
    code = ("import json, sys\nfrom basketflow.plans.pipeline import build_all\n"
            "from basketflow.session import build_session\nfrom basketflow.sources.readers import read_csv_sources\n"
            "s = build_session('local[2]', shuffle_partitions=2, extra={'spark.checkpoint.dir': sys.argv[3]})\n"
            "build_all(s, read_csv_sources(s, sys.argv[1]), sys.argv[2])\n"
            "print(json.dumps(sorted(map(str, s.read.parquet(sys.argv[2] + '/user_product_feature').collect()))))")
    got = []
    for lines in (A, B):
        write_csv(folder, lines)
        run = subprocess.run([sys.executable, "-c", code, folder, out, shared], cwd=ROOT, capture_output=True, text=True,
                             timeout=300)
        assert run.returncode == 0, run.stderr[-2000:]
        got.append(json.loads(run.stdout.splitlines()[-1]))
    build_all(spark, read_csv_sources(spark, folder), clean)
    assert got[0] != got[1] == tables(spark, clean)["user_product_feature"]


def test_quotes_and_empty_fields(spark, tmp_path):
    write_csv(str(tmp_path), A)
    src = read_csv_sources(spark, str(tmp_path))
    names = {r.product_id: r.product_name for r in src.products.collect()}
    assert names == {1: "Bread, sliced", 2: '5" Tart, "Deep" Dish', 3: None}
    assert src.aisles.filter("aisle_id = 2").first()["aisle"] is None
    assert src.orders.filter(F.col("days_since_prior_order").isNull()).count() == 2


def test_line_ends_in_quotes_need_multi_line(spark, tmp_path):
    write_csv(str(tmp_path), A)
    path = tmp_path / CSV_FILE_NAMES["products"]
    path.write_text('product_id,product_name,aisle_id,department_id\n1,"two\nlines",1,1\n')
    assert read_csv_sources(spark, str(tmp_path), multi_line=True).products.first()["product_name"] == "two\nlines"
    with pytest.raises(Exception):
        read_csv_sources(spark, str(tmp_path)).products.collect()
