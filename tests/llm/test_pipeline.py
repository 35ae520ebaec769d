"""The pipeline's stages against plain versions over the small tables, and the registered names."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

import corpus_pipeline
import __spark_entry__ as contract
from gatewarden.llm import registered
from tests.llm.test_minhash_and_embeddings import classes_by_force
from tests.llm.test_texts_and_archives import base_by_force, check_packing

SF = "/root/testdata/sf0.001"


def test_names():
    names = set(registered.queries())
    assert {n.split("_")[0] for n in names} == {*(f"op{k}" for k in range(1, 11)), "pipeline"}
    assert names <= set(contract.queries())
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "quality_classifier", "near_duplicates", "secrets", "packing"
    ]


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        seen[name] = before, docs.collect()
        if name != "packing":
            assert docs.columns == columns
    before, after = seen["quality_rules"]
    kept = {r.doc_id for r in after}
    for r in before:
        words = len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
        if r.doc_id in kept:
            assert words >= 50
        elif words >= 50 and quality.get(r.doc_id) is not None:
            assert quality[r.doc_id] == 0
    before, after = seen["quality_classifier"]
    kept = {r.doc_id for r in after}
    assert all(quality.get(i, 1) == 1 for i in kept) and len(kept) >= 0.9 * len(before)
    before, after = seen["near_duplicates"]
    classes = classes_by_force([r.doc_id for r in before], [r.text for r in before])
    assert sorted(r.doc_id for r in after) == sorted(set(classes.values()))
    before, after = seen["secrets"]
    texts = {r.doc_id: r.text for r in after}
    assert len(texts) == len(before) and any(base_by_force(r.text) for r in before)
    for r in before:
        assert not base_by_force(texts[r.doc_id])
        if not base_by_force(r.text):
            assert texts[r.doc_id] == r.text
    found, fewest = check_packing(seen["packing"][1], texts)
    assert found <= fewest * 1.03 + 1


def test_the_classifier_learns_what_the_rules_dropped(spark):
    """Its stage rejects junk of its own input, though that has no bad label left."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    known = spark.read.parquet(f"{SF}/labels.parquet")
    bad = docs.join(known.where("quality = 0").select("doc_id"), "doc_id", "left_semi")
    good = docs.join(known.where("quality = 1").select("doc_id"), "doc_id", "left_semi")
    junk = bad.withColumn("doc_id", F.col("doc_id") + 1_000_000)  # the same texts, unlabelled
    kept = {r.doc_id for r in corpus_pipeline.quality_classifier(spark, good.union(junk), SF).collect()}
    assert kept == {r.doc_id for r in good.collect()}


def test_run_equals_its_stages(spark):
    rows = contract.queries()["pipeline"](spark, SF).collect()
    total = sum(r.length for r in rows)
    assert len({r.sequence_id for r in rows}) <= -(-total // 2048) * 1.03 + 1
    assert len({(r.doc_id, r.piece) for r in rows}) == len(rows)
