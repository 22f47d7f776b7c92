"""A training corpus from raw documents: clean, deduplicate, sanitise, mix, pack.

``STAGES`` holds (name, function) pairs; each function takes (spark, docs, sf_dir), works on every row that its predecessor kept
and returns a DataFrame.  All but the last return the columns of ``documents``; the last returns one row per packed piece.

* ``quality`` removes failed lines and drops documents that the rules reject.
* ``near_duplicates`` keeps the document with the smallest id (then text hash) of every component.
* ``pii`` replaces personal data and terms that disclose it.
* ``mix`` draws sources to their target weights; a document stands there once per copy.
* ``pack`` puts token pieces into sequences of 2048.

Defined results for nulls, empty texts, ties, repeated rows, empty tables and extra columns are those of the operators' modules;
extra columns are carried up to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from claimlens.llm import mixing, ngram_join, packing, pii, quality_rules
from claimlens.session import write_table
from claimlens.sources.tables import read_table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_clean(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.keep_one_of_each(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.sanitise(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("pii", personal_data), ("mix", mix), ("pack", pack)]

ORACLE_SQL = None  # token ids and packing cannot be stated in SQL; tests/llm compares with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = write_table(docs, name)
    return docs
