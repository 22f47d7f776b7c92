"""The pipeline's stages decide as brute force does, each on its predecessor's rows."""

from brute import jaccard, pii_base, quality_base, words
from pyspark.sql import functions as F

import corpus_pipeline
from claimlens.llm import mixing
from claimlens.session import write_table

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("_shard", F.lit("extra")).withColumn("_key", F.lit("extra"))
    seen = {"raw": docs}
    for name, stage in corpus_pipeline.STAGES:
        docs = seen[name] = write_table(stage(spark, docs, SF), name)
        assert name == "pack" or docs.columns == seen["raw"].columns
    rows = {k: v.collect() for k, v in seen.items()}
    raw = {r.doc_id: r.text for r in rows["raw"]}
    clean = {r.doc_id: r.text for r in rows["quality"]}
    assert all(not quality_base(raw[d])[5] for d in clean) and all(set(t.split("\n")) <= set(raw[d].split("\n")) for d, t in clean.items())
    assert sorted(r.doc_id for r in rows["near_duplicates"]) == sorted(d for d, _, c in jaccard(list(clean.items())) if d == c)
    assert {r.doc_id for r in rows["pii"]} == {r.doc_id for r in rows["near_duplicates"]}
    assert all(sum(pii_base(r.text)[:4]) == 0 and r.n_chars == len(r.text) for r in rows["pii"])
    want = {r.doc_id: r.taken for r in mixing.taken_words(seen["pii"]).collect()}
    took = dict.fromkeys(want, 0)
    for r in rows["mix"]:
        took[r.doc_id] += len(words(r.text))
    assert took == want
    assert sum(1 for r in rows["pack"] if r.piece == 0) == len(rows["mix"])


def test_run_and_empty_table(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("false")
    for name, stage in corpus_pipeline.STAGES:
        docs = write_table(stage(spark, docs, SF), name)
    assert docs.count() == 0
