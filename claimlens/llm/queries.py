"""The registered queries ``opN_<name>``: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlens.llm import (chat_format, embedding_dedup, fingerprints, lexical_search, mixing, ngram_join, packing, periodic_runs, pii,
                           quality_rules, substring_dedup, suffix_dedup, toxicity)
from claimlens.sources.tables import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


@register("op1_best_fit_packing")
def op1(spark, sf):
    return packing.pack_documents(read_table(spark, sf, "documents"))


@register("op2_chat_formatting", chat_format.ORACLE_SQL)
def op2(spark, sf):
    rows = read_table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").cast(rows.schema["turn"].dataType).alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("\\### Assistant: </turn> ok").alias("text"))
    return chat_format.read_back(chat_format.format_conversations(rows.unionByName(extra)))


@register("op3_ngram_jaccard_join")
def op3(spark, sf):
    return ngram_join.jaccard_components(read_table(spark, sf, "documents"))


@register("op4_quality_rules")
def op4(spark, sf):
    return quality_rules.quality_report(read_table(spark, sf, "documents"))


@register("op5_suffix_array_dedup")
def op5(spark, sf):
    return suffix_dedup.remove_repeats(read_table(spark, sf, "documents"), keep_bytes=False)


@register("op6_toxicity")
def op6(spark, sf):
    return toxicity.toxicity_report(read_table(spark, sf, "documents"), read_table(spark, sf, "labels"))


@register("op7_document_fingerprints")
def op7(spark, sf):
    return fingerprints.fingerprint_report(read_table(spark, sf, "documents"))


@register("op8_substring_dedup")
def op8(spark, sf):
    return substring_dedup.remove_repeats(read_table(spark, sf, "documents"), keep_text=False)


@register("op9_source_mixing", mixing.ORACLE_SQL)
def op9(spark, sf):
    return mixing.taken_words(read_table(spark, sf, "documents"))


@register("op10_pii_sanitisation")
def op10(spark, sf):
    return pii.report(read_table(spark, sf, "documents"))


@register("op11_embedding_near_dedup")
def op11(spark, sf):
    return embedding_dedup.near_duplicates(read_table(spark, sf, "embeddings"))


@register("op12_lexical_search", lexical_search.ORACLE_SQL)
def op12(spark, sf):
    return lexical_search.rank(read_table(spark, sf, "documents"), read_table(spark, sf, "benchmark"))


@register("op13_periodic_runs")
def op13(spark, sf):
    return periodic_runs.report(periodic_runs.find_runs(periodic_runs.with_planted_periods(read_table(spark, sf, "documents"))))
