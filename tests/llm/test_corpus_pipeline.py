"""Every stage against a brute-force version on the smallest tables."""

import numpy as np
import pyarrow as pa
from conftest import SF_SMALL
from test_decontam import brute as hits_of
from test_near_dup import brute as groups_of
from test_tokens import BYTE, library, little

import corpus_pipeline as cp


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns = docs.columns
    frames = {"documents": docs}
    for name, stage in cp.STAGES:
        out = f"{tmp_path}/{name}"
        stage(spark, docs, SF_SMALL).write.parquet(out)
        docs = frames[name] = spark.read.parquet(out)
        if name != "tokens":
            assert docs.columns == columns
    rows = {k: {r.doc_id: r for r in f.collect()} for k, f in frames.items()}

    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_SMALL}/labels.parquet").collect()}
    left = [d in rows["quality"] for d in rows["documents"] if labels.get(d) == 1]
    # A handful of bad labels: little can be rejected (rates are tested on the
    # larger tables), good documents stay all the same.
    assert np.mean(left) >= 0.97 and len(rows["quality"]) < len(rows["documents"])

    want = {i for i, _, _, kept in groups_of([(d, r.text) for d, r in rows["quality"].items()], 5, 80) if kept}
    assert set(rows["near_duplicates"]) == want

    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    for d, r in rows["near_duplicates"].items():
        n, hit, _ = hits_of(r.text, items)
        assert (d in rows["decontamination"]) == (not (hit > 0 and 20 * hit >= n))
        if not hit:
            assert rows["decontamination"][d].text == r.text

    assert set(rows["secrets"]) == set(rows["decontamination"]) == set(rows["tokens"])
    masked = [d for d, r in rows["secrets"].items() if r.text != rows["decontamination"][d].text]
    # These few findings may not suffice for a forest (planted secrets: test_scans).
    assert all("[SECRET]" in rows["secrets"][d].text for d in masked)
    texts = [rows["secrets"][d].text for d in rows["tokens"]]
    for r, ids in zip(rows["tokens"].values(), library(BYTE, texts)):
        assert r.n_tokens == len(ids) and bytes(r.ids) == little(ids)


def test_run(spark):
    assert cp.run(spark, SF_SMALL).columns == ["doc_id", "source", "lang", "n_tokens", "ids"]


def test_batches_are_small_while_the_stages_run_and_the_setting_is_given_back(spark, monkeypatch):
    name, seen = "spark.sql.execution.arrow.maxRecordsPerBatch", []

    def stage(spark, docs, sf_dir):
        def sizes(batches):
            for batch in batches:
                yield pa.RecordBatch.from_pydict({"n": [batch.num_rows]})
        seen.append(max(r.n for r in docs.coalesce(1).mapInArrow(sizes, "n long").collect()))
        return docs

    before = spark.conf.get(name)
    monkeypatch.setattr(cp, "STAGES", [("one", stage)])
    for setting, most in ((before, cp.BATCH_ROWS), ("0", cp.BATCH_ROWS), ("50", 50)):
        spark.conf.set(name, setting)
        try:
            cp.run(spark, "/root/testdata/sf0.01")
            assert spark.conf.get(name) == setting and 0 < seen.pop() <= most
        finally:
            spark.conf.set(name, before)
