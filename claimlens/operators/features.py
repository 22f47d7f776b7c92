"""Text features: terms, vocabulary, TF-IDF and fixed-length id sequences.

TF-IDF follows the smooth formula ``tf * (ln((1+n)/(1+df)) + 1)`` with an L2
norm per document; the vocabulary is the ``max_features`` most frequent terms
of the fitting rows (ties by term).  Everything is long-form
``(doc, term, value)`` and aggregates partially before each shuffle; the
vocabulary is bounded by ``max_features`` so it may be broadcast.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimlens.constants import CLS_ID, MAX_FEATURES, MAX_LENGTH, PAD_ID, SEP_ID, UNK_ID
from claimlens.functions.text import exploded, stopwords, word_bigrams, word_tokens

DOCS_PER_TASK = 2000


def tokens(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", remove_stop: bool = False,
           out: str = "tokens") -> DataFrame:
    """``(id, tokens)``; stop words are dropped by Spark's StopWordsRemover (a JVM hash lookup)."""
    keep = [c for c in df.columns if c not in (id_col, text_col)]
    t = df.select(id_col, *keep, word_tokens(F.col(text_col)).alias("_tok"))
    if not remove_stop:
        return t.withColumnRenamed("_tok", out)
    remover = StopWordsRemover(inputCol="_tok", outputCol=out, stopWords=list(stopwords()), caseSensitive=True)
    return remover.transform(t).drop("_tok")


def doc_terms(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", remove_stop: bool = True,
              bigrams: bool = True) -> DataFrame:
    """Exploded ``(id, term)``: unigrams plus bigrams formed after stop-word removal."""
    t = tokens(df, id_col, text_col, remove_stop, "_t")
    terms = F.concat(F.col("_t"), word_bigrams("_t")) if bigrams else F.col("_t")
    return exploded(t, [id_col], terms, "term")


def term_frequencies(terms: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return terms.groupBy(id_col, "term").agg(F.count(F.lit(1)).alias("tf"))


def dealt_by_id(tokens_: DataFrame, id_col: str, n_docs: int) -> DataFrame:
    """Token lists dealt by id, ``DOCS_PER_TASK`` documents each: counting a document's terms then moves no term, and a task's counts stay small."""
    parts = max(tokens_.sparkSession.sparkContext.defaultParallelism, math.ceil(n_docs / DOCS_PER_TASK))
    return tokens_.repartition(parts, F.col(id_col))


def counted_terms(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", bigrams: bool = True) -> DataFrame:
    """``(id, term, tf)`` of :func:`doc_terms` without stop words, moving token lists in place of terms."""
    t = dealt_by_id(tokens(df.select(id_col, text_col), id_col, text_col, remove_stop=True, out="_t"), id_col, df.count())
    return term_frequencies(exploded(t, [id_col], F.concat(F.col("_t"), word_bigrams("_t")) if bigrams else F.col("_t"), "term"), id_col)


def top_vocabulary(tf: DataFrame, max_features: int = MAX_FEATURES) -> DataFrame:
    """``(term, term_count, doc_freq, rank)`` of the most frequent terms; ``rank`` is 0-based.

    ``orderBy().limit()`` keeps only ``max_features`` rows per partition before
    merging (TakeOrderedAndProject), so no task sees every term.
    """
    stats = tf.groupBy("term").agg(F.sum("tf").alias("term_count"), F.count(F.lit(1)).alias("doc_freq"))
    top = stats.orderBy(F.desc("term_count"), F.asc("term")).limit(max_features)
    w = Window.orderBy(F.desc("term_count"), F.asc("term"))
    return top.withColumn("rank", (F.row_number().over(w) - 1).cast("int"))


def idf_table(vocab: DataFrame, n_docs) -> DataFrame:
    """Smooth idf ``ln((1+n)/(1+df)) + 1`` for every vocabulary term."""
    n = n_docs if not isinstance(n_docs, int) else F.lit(n_docs)
    return vocab.select("term", "rank", (F.log((F.lit(1.0) + n) / (F.lit(1.0) + F.col("doc_freq"))) + F.lit(1.0))
                        .alias("idf"))


def tfidf_weights(tf: DataFrame, idf: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``(id, term, rank, weight)`` L2-normalised per document."""
    w = tf.join(F.broadcast(idf), "term").withColumn("_w", F.col("tf") * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(Window.partitionBy(id_col)))
    return w.select(id_col, "term", "rank", (F.col("_w") / norm).alias("weight"))


def fit_tfidf(fit_docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              max_features: int = MAX_FEATURES) -> DataFrame:
    """Vocabulary and idf fitted on ``fit_docs`` only: ``(term, rank, idf)``."""
    vocab = top_vocabulary(counted_terms(fit_docs, id_col, text_col), max_features)
    n = fit_docs.select(F.count(F.lit(1)).cast("double")).scalar()
    return idf_table(vocab, n)


def transform_tfidf(docs: DataFrame, idf: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return tfidf_weights(term_frequencies(doc_terms(docs, id_col, text_col), id_col), idf, id_col)


def fit_transform_tfidf(docs: DataFrame, fit_col: str, id_col: str = "doc_id", text_col: str = "text",
                        max_features: int = MAX_FEATURES, materialize: bool = False) -> DataFrame:
    """Fit the vectoriser on rows where ``fit_col`` is true and weight every row, tokenising once.

    Token lists are dealt by id (:func:`dealt_by_id`): neither a document's term counts nor its norm move anything more.
    Vocabulary and idf come from the flagged rows (the flag is tested inside the explode, so that both counts read one exchange).
    """
    t = dealt_by_id(tokens(docs.select(id_col, text_col, fit_col), id_col, text_col, remove_stop=True, out="_t"), id_col, docs.count())
    terms = F.concat(F.col("_t"), word_bigrams("_t"))

    def counted(some) -> DataFrame:
        return exploded(t, [id_col, fit_col], some, "term").groupBy(id_col, fit_col, "term").agg(F.count(F.lit(1)).alias("tf"))

    tf, fitted = counted(terms), counted(F.when(F.col(fit_col), terms))
    if materialize:
        from claimlens.session import write_table
        tf = write_table(tf, "tfidf-tf")
        fitted = tf.filter(F.col(fit_col))
    vocab = top_vocabulary(fitted.drop(fit_col), max_features)
    n = docs.filter(F.col(fit_col)).select(F.count(F.lit(1)).cast("double")).scalar()
    return tfidf_weights(tf.drop(fit_col), idf_table(vocab, n), id_col)


def word_vocabulary(fit_docs: DataFrame, size: int, id_col: str = "doc_id", text_col: str = "text",
                    first_id: int = 1000) -> DataFrame:
    """``(term, token_id)`` for the ``size`` most frequent word tokens; ids start at ``first_id``."""
    terms = doc_terms(fit_docs, id_col, text_col, remove_stop=False, bigrams=False)
    vocab = top_vocabulary(term_frequencies(terms, id_col), size)
    return vocab.select("term", (F.col("rank") + first_id).cast("int").alias("token_id"))


def sequence_encode(docs: DataFrame, vocab: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    max_length: int = MAX_LENGTH) -> DataFrame:
    """``[CLS] ids... [SEP]`` padded with 0 to ``max_length``, plus the attention mask.

    Truncation to ``max_length - 2`` word ids is the encoding itself.  Unknown
    words map to the unknown id.
    """
    body = max_length - 2
    toks = exploded(docs, [id_col], F.slice(word_tokens(F.col(text_col)), 1, body), "term", "pos")
    ids = toks.join(vocab, "term", "left").select(
        id_col, "pos", F.coalesce("token_id", F.lit(UNK_ID)).alias("token_id"))
    seqs = ids.groupBy(id_col).agg(F.array_sort(F.collect_list(F.struct("pos", "token_id"))).alias("_s"))
    allids = docs.select(id_col).join(seqs, id_col, "left").select(
        id_col, F.coalesce(F.transform("_s", lambda s: s["token_id"]), F.array().cast("array<int>")).alias("_ids"))
    core = F.concat(F.array(F.lit(CLS_ID)), F.col("_ids"), F.array(F.lit(SEP_ID)))
    n = F.size(core)
    return allids.select(
        id_col,
        F.concat(core, F.array_repeat(F.lit(PAD_ID), F.lit(max_length) - n)).alias("input_ids"),
        F.concat(F.array_repeat(F.lit(1), n), F.array_repeat(F.lit(0), F.lit(max_length) - n))
        .alias("attention_mask"))
