"""Registered file queries: what is written to the shared folder in a format comes back row for row."""

from __future__ import annotations

from pyspark.sql import functions as F

from claimlens.plans import sqlparts as Q
from claimlens.plans import views as V
from claimlens.plans.catalog import register
from claimlens.session import scratch_path
from claimlens.sources import claims as SC
from claimlens.sources import sinks as SK
from claimlens.constants import FINE_LABELS
from claimlens.functions.labels import decode_label

_FLAT = "translate(text, chr(9) || chr(10) || chr(13), '   ')"


@register("read_claims_tsv", Q.with_(Q.LABELED, Q.fine_source()) + f"""
SELECT CAST(doc_id AS VARCHAR) AS id, fine_label_id AS label, nullif({_FLAT}, '') AS statement,
  CASE WHEN doc_id % 13 = 4 THEN NULL ELSE CAST(doc_id % 50 AS FLOAT) END AS false_counts, doc_id % 13 = 4 AS corrupt, true AS has_file,
  source, split FROM fine_src""")
def read_claims_tsv(spark, sf):
    """Labelled documents as a claims file (every 13th with a broken number), read with provenance; whole texts."""
    docs = V.fine_grained_source(spark, sf)
    path = scratch_path(spark, "claims-tsv")
    count = F.when(F.col("doc_id") % 13 == 4, F.lit("n/a")).otherwise((F.col("doc_id") % 50).cast("string"))
    blank = [F.lit("").alias(f"c{i}") for i in range(5)]
    SK.write_tsv(docs.select("doc_id", decode_label(F.col("fine_label_id"), FINE_LABELS).alias("label"), "text", *blank, F.lit("0").alias("n0"),
                             count.alias("n1"), *[F.lit("0").alias(f"n{i}") for i in range(2, 5)], F.concat_ws("/", "source", "split").alias("context")), path)
    got = SC.read_claims_tsv(spark, path, provenance=True)
    return got.select("id", "label", "statement", "false_counts", F.col("corrupt_line").isNotNull().alias("corrupt"),
                      F.col("source_file").startswith("part-").alias("has_file"), F.split_part("context", F.lit("/"), F.lit(1)).alias("source"),
                      F.split_part("context", F.lit("/"), F.lit(2)).alias("split"))


@register("corpus_by_file_label", Q.with_(Q.LABELED) + f"""
SELECT nullif({_FLAT}, '') AS text, CASE WHEN doc_id % 2 = 0 THEN 'true' ELSE 'false' END AS label, 'titles' AS source FROM labeled""")
def corpus_by_file_label(spark, sf):
    """One CSV folder per class; the class comes from the folder, quotes and commas survive."""
    docs = V.labeled(spark, sf).select("doc_id", F.translate("text", "\t\n\r", "   ").alias("title"), F.lit("u").alias("url"))
    paths = {"real": scratch_path(spark, "titles-real"), "fake": scratch_path(spark, "titles-fake")}
    for k, name in enumerate(paths):
        SK.write_csv(docs.filter(F.col("doc_id") % 2 == k).select("url", "title"), paths[name])
    return SC.corpus_by_file_label(spark, paths)


@register("eval_cases_read", Q.with_(Q.LABELED, Q.SPLIT, Q.CLAIMS) + """
SELECT nullif(text, '') AS text, label FROM claims""")
def eval_cases_read(spark, sf):
    """Held-out claims written as an evaluation CSV (line breaks inside quotes) and read back, columns checked."""
    path = scratch_path(spark, "eval-cases")
    SK.write_csv(V.claims(spark, sf).select("text", "label"), path)
    return SC.read_eval_cases(spark, path, multi_line=True)
