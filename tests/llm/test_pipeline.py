"""The pipeline's stages against what each must keep."""

import os

import pytest

import corpus_pipeline
from tests.llm.test_simhash import fingerprint, groups

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF_DIR).write.parquet(str(tmp_path / name))
        new = spark.read.parquet(str(tmp_path / name))
        if name != "packing":
            assert new.columns == docs.columns
        kept[name], docs = new.collect(), new
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    good = {r.doc_id for r in kept["quality"]}
    judged = [(i in good) == bool(q) for i, q in labels.items()]
    assert sum(judged) / len(judged) > 0.9
    of = groups(sorted({fingerprint(r.text) for r in kept["quality"]}), lambda a, b: (a ^ b).bit_count() <= 2)
    least = {}
    for r in kept["quality"]:
        root = of[fingerprint(r.text)]
        least[root] = min(least.get(root, r.doc_id), r.doc_id)
    assert {r.doc_id for r in kept["simhash"]} == set(least.values()) and len(kept["simhash"]) == len(least)
    items = [r.text.lower() for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    bad = {r.doc_id for r in kept["simhash"] if any(" ".join(i.split()) in " ".join(r.text.lower().split()) for i in items)}
    assert {r.doc_id for r in kept["simhash"]} - bad == {r.doc_id for r in kept["decontamination"]}
    assert {r.doc_id for r in kept["secrets"]} == {r.doc_id for r in kept["decontamination"]}
    assert {r.doc_id for r in kept["packing"]} == {r.doc_id for r in kept["secrets"]}
    whole = corpus_pipeline.run(spark, SF_DIR).collect()
    assert {(r.doc_id, r.doc_tokens) for r in whole} == {(r.doc_id, r.doc_tokens) for r in kept["packing"]}
    assert sum(r.length for r in whole) == sum(r.length for r in kept["packing"])
