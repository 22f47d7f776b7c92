"""Derived views over the driver tables.

* ``labeled``  -- documents joined to their quality / toxicity labels, 3 classes.
* ``claims``   -- the held-out (test) side of the stratified split; the whole
                  text is the claim.  ``evidence`` is the training side.
* ``preds``    -- SYNTHETIC base and evidence predictions derived from md5
                  hashes of the document id.  They stand in for model outputs
                  so that merge and metric operators can be checked exactly
                  against an SQL oracle.  They are not model predictions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlens.constants import BINARY_TO_LABEL, FINE_LABELS, FINE_TO_LABEL, LABELS
from claimlens.functions.labels import collapse_label, decode_label
from claimlens.functions.numeric import hash_int
from claimlens.operators.splits import stratified_split
from claimlens.sources.claims import union_corpus
from claimlens.sources.tables import read_table

def label_expr() -> F.Column:
    return (F.when(F.col("toxic") == 1, F.lit("mixed"))
            .when(F.col("quality") == 1, F.lit("true"))
            .otherwise(F.lit("false")))


def labeled(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    labs = read_table(spark, sf_dir, "labels", ["doc_id", "quality", "toxic"])
    return docs.join(labs, "doc_id").select("doc_id", "text", label_expr().alias("label"))


def labeled_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, label)`` of labelled documents, without reading any text."""
    labs = read_table(spark, sf_dir, "labels", ["doc_id", "quality", "toxic"])
    ids = read_table(spark, sf_dir, "documents", ["doc_id"])
    return labs.join(ids, "doc_id", "left_semi").select("doc_id", label_expr().alias("label"))


def split_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, label, split)``: the split is decided on keys only; text never enters its shuffle."""
    return stratified_split(labeled_keys(spark, sf_dir))


def with_text(spark: SparkSession, sf_dir: str, keys: DataFrame) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"], spread_by="doc_id")
    return docs.join(keys, "doc_id")


def split_labeled(spark: SparkSession, sf_dir: str, keys: DataFrame | None = None) -> DataFrame:
    """``(doc_id, text, label, split)``."""
    k = keys if keys is not None else split_keys(spark, sf_dir)
    return with_text(spark, sf_dir, k).select("doc_id", "text", "label", "split")


def claims(spark: SparkSession, sf_dir: str, split: DataFrame | None = None) -> DataFrame:
    s = split if split is not None else split_labeled(spark, sf_dir)
    return (s.filter(F.col("split") == "test")
            .select("doc_id", "text", "label", F.col("text").alias("headline")))


def evidence(spark: SparkSession, sf_dir: str, split: DataFrame | None = None) -> DataFrame:
    s = split if split is not None else split_labeled(spark, sf_dir)
    return s.filter(F.col("split") == "train").select("doc_id", "text", "label")


def _h(tag: str, pos: int) -> F.Column:
    return hash_int(F.lit(tag), F.col("doc_id"), pos=pos)


def with_preds(df: DataFrame, gold: str = "label") -> DataFrame:
    """Attach the synthetic prediction columns to rows keyed by ``doc_id``."""
    missing = (_h("e", 1) % 13) == 0
    return df.select(
        "*",
        F.col(gold).alias("gold"),
        decode_label(_h("p", 1) % 3).alias("base_label"),
        F.when((_h("p", 9) % 10) == 0, F.lit(None).cast("double"))
         .otherwise((_h("p", 17) % 10000) / F.lit(10000.0)).alias("base_confidence"),
        F.when(missing, F.lit(None).cast("string")).otherwise(decode_label(_h("e", 9) % 3)).alias("evidence_label"),
        F.when(missing, F.lit(None).cast("double"))
         .otherwise((F.lit(9000) + _h("e", 17) % 1001) / F.lit(10000.0)).alias("evidence_confidence"),
    )


def preds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_preds(labeled(spark, sf_dir).select("doc_id", "label")).drop("label")


def model_preds(df: DataFrame, model: str) -> F.Column:
    """SYNTHETIC prediction of a named model for the leaderboard checks."""
    return decode_label(hash_int(F.lit(model), F.col("doc_id")) % 3)


# -- two corpus sources (loader semantics on driver data) ---------------------

def fine_grained_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First source: labelled documents with a six-way fine label index.

    The fine index is drawn (by hash) among the two fine labels that collapse
    to the document's class, then decoded and collapsed again, exercising the
    index -> name -> 3-class chain.  ``split`` is provenance (80/10/10).
    """
    lab = labeled(spark, sf_dir)
    pick = hash_int(F.lit("f"), F.col("doc_id")) % 2
    fine_idx = (F.when(F.col("label") == "true", F.when(pick == 0, 3).otherwise(2))
                .when(F.col("label") == "mixed", F.when(pick == 0, 1).otherwise(4))
                .otherwise(F.when(pick == 0, 0).otherwise(5)))
    prov = hash_int(F.lit("s"), F.col("doc_id")) % 10
    fine = decode_label(fine_idx, FINE_LABELS)
    return lab.select(
        "doc_id", "text",
        fine_idx.cast("int").alias("fine_label_id"),
        collapse_label(fine, FINE_TO_LABEL).alias("label"),
        F.lit("documents").alias("source"),
        F.when(prov < 8, "train").when(prov == 8, "validation").otherwise("test").alias("split"))


def binary_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second source: benchmark items with a real / fake label, no ``split`` column."""
    b = read_table(spark, sf_dir, "benchmark", ["item_id", "text"])
    fine = F.when(hash_int(F.lit("b"), F.col("item_id")) % 2 == 0, F.lit("real")).otherwise(F.lit("fake"))
    return b.select(F.col("item_id").alias("doc_id"), "text",
                    collapse_label(fine, BINARY_TO_LABEL).alias("label"), F.lit("benchmark").alias("source"))


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return union_corpus([fine_grained_source(spark, sf_dir).drop("fine_label_id"), binary_source(spark, sf_dir)])


__all__ = ["LABELS", "labeled", "claims", "evidence", "preds", "with_preds", "corpus"]
