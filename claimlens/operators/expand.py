"""Synonym tables and query expansion.

``synonym_table`` = curated list (origin 0) + thesaurus (origin 1).  The
thesaurus is an input table ``(word, rank, synonym)``; :func:`corpus_thesaurus`
derives one from a corpus for data that has no dictionary words.

``expand_queries`` reproduces the variant rule: start with the raw query;
for each expandable token in order, for each of its (at most two) synonyms,
replace the whole token, join the words with single spaces and append the
variant if it is new; stop at ``max_queries`` and stop after any token once
three queries exist.  Relationally: candidates are ordered by
``(position, synonym rank)``; a candidate is *new* unless it reproduces the
raw words (its synonym equals the token); it is kept when it is new, fewer
than two new candidates come from earlier tokens, and its ordinal among new
candidates is at most ``max_queries - 1``.  Variant texts are only built for
the kept candidates, so long texts never produce one text per token.

A candidate is kept only while fewer than two new ones come from earlier
tokens, so a text is read as far as it has to be: with synonyms that are made
on demand its first ``HEAD_WORDS`` words are looked up first, and all of them
only if those leave a variant open.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimlens.constants import CURATED_SYNONYMS, MAX_QUERIES, MAX_REPLACEMENTS, MAX_SYNONYMS, THESAURUS_SENSES
from claimlens.functions.text import exploded, is_expandable, normalise_token, whitespace_split
from claimlens.session import write_table

HEAD_WORDS = 32


def curated_table(spark: SparkSession) -> DataFrame:
    rows = [(w, 0, i + 1, s) for w, syns in CURATED_SYNONYMS.items() for i, s in enumerate(syns)]
    return spark.createDataFrame(rows, "word string, origin int, rank int, synonym string")


def dictionary_thesaurus(entries: DataFrame, words: DataFrame | None = None, senses: int = THESAURUS_SENSES) -> DataFrame:
    """``(word, rank, synonym)`` from dictionary entries ``(word, sense, lemma, synonym)``.

    Senses go in order (``sense`` counts from 1), a sense's lemmas in theirs; only the first ``senses`` distinct sense numbers of a word
    count.  ``words`` restricts the dictionary to the words asked for before anything is ranked (a left semi join).
    """
    e = entries.select(F.lower("word").alias("word"), "sense", "lemma", "synonym")
    if words is not None:
        e = e.join(words.select("word").distinct(), "word", "left_semi")
    e = e.withColumn("_s", F.dense_rank().over(Window.partitionBy("word").orderBy("sense"))).filter(F.col("_s") <= senses)
    order = Window.partitionBy("word").orderBy("_s", "lemma", "synonym")
    return e.select("word", F.row_number().over(order).cast("int").alias("rank"), "synonym")


def corpus_words(docs: DataFrame, text_col: str = "text", min_length: int = 4) -> DataFrame:
    """``(word, freq, k_len)``: the normalised tokens of a corpus that are long enough, counted and written down."""
    # tokens are counted as they stand and only the distinct ones normalised; written once, since a filter on the words would otherwise be
    # pushed below the count and normalise every token, and both uses in the thesaurus would count the corpus again
    tokens = exploded(docs, [], F.split(F.col(text_col), r"\s+"), "token").groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    return write_table(tokens.select(normalise_token("token").alias("word"), "n").groupBy("word").agg(
        F.sum("n").alias("freq"), F.max(F.length("word")).alias("k_len")).filter(F.col("k_len") >= min_length), "thesaurus-words")


def corpus_thesaurus(docs: DataFrame, text_col: str = "text", senses: int = THESAURUS_SENSES,
                     min_length: int = 4, wanted: DataFrame | None = None, words: DataFrame | None = None) -> DataFrame:
    """A thesaurus derived from a corpus (ours, for invented prose).

    Words are normalised tokens (ASCII letters and hyphens) of at least
    ``min_length`` characters.  The entries of a word are the ``senses`` most
    frequent *other* words with the same initial letter and length, ranked by
    frequency then spelling.  Only the top ``senses + 1`` words of each group
    are needed, so each word gets a bounded number of partners (never all
    pairs of a group), and Spark limits each group before the shuffle.
    ``wanted`` (``word``) restricts the ranking to words that some query asks for; ``words``: the :func:`corpus_words`, if they are there already.
    """
    words = corpus_words(docs, text_col, min_length) if words is None else words
    words = words.select("word", "freq", F.substring("word", 1, 1).alias("k_init"), "k_len")
    grp = Window.partitionBy("k_init", "k_len").orderBy(F.desc("freq"), F.asc("word"))
    top = (words.withColumn("_r", F.row_number().over(grp)).filter(F.col("_r") <= senses + 1)
           .select("k_init", "k_len", F.col("word").alias("synonym"), F.col("freq").alias("s_freq")))
    # ``top`` holds at most senses+1 rows per (initial, length) group; its size is checked at run time (AQE)
    if wanted is not None:
        words = words.join(wanted.select("word").distinct(), "word", "left_semi").drop("freq")
    pairs = words.join(top, ["k_init", "k_len"]).filter(F.col("synonym") != F.col("word"))
    per_word = Window.partitionBy("word").orderBy(F.desc("s_freq"), F.asc("synonym"))
    return (pairs.withColumn("rank", F.row_number().over(per_word)).filter(F.col("rank") <= senses)
            .select("word", F.col("rank").cast("int").alias("rank"), "synonym"))


def synonym_table(curated: DataFrame, thesaurus: DataFrame, max_synonyms: int = MAX_SYNONYMS) -> DataFrame:
    """``(word, origin, rank, synonym)``: curated first, then thesaurus entries.

    Thesaurus entries are lower-cased, ``_`` becomes a space, non-ASCII and
    self entries are dropped, and at most ``max_synonyms`` are taken per word.
    """
    th = (thesaurus.select("word", "rank", F.lower(F.regexp_replace("synonym", "_", " ")).alias("synonym"))
          .filter((F.col("synonym") != F.col("word")) & ~F.col("synonym").rlike(r"[^\x00-\x7F]")))
    th = th.groupBy("word", "synonym").agg(F.min("rank").alias("rank"))  # an entry counts once, at its first place
    th = (th.withColumn("_r", F.row_number().over(Window.partitionBy("word").orderBy("rank", "synonym")))
          .filter(F.col("_r") <= max_synonyms)
          .select("word", F.lit(1).alias("origin"), F.col("_r").cast("int").alias("rank"), "synonym"))
    return curated.select("word", "origin", "rank", "synonym").unionByName(th)


def query_synonyms(table: DataFrame, max_synonyms: int = MAX_SYNONYMS) -> DataFrame:
    """``(word, srank, synonym)``: the first ``max_synonyms`` distinct synonyms of each word."""
    first = Window.partitionBy("word", "synonym").orderBy("origin", "rank")
    order = Window.partitionBy("word").orderBy("origin", "rank")
    return (table.withColumn("_d", F.row_number().over(first)).filter(F.col("_d") == 1)
            .withColumn("srank", F.row_number().over(order)).filter(F.col("srank") <= max_synonyms)
            .select("word", F.col("srank").cast("int").alias("srank"), "synonym"))


def _split(queries: DataFrame, id_col: str, text_col: str) -> DataFrame:
    q = queries.select(id_col, F.col(text_col).alias("_q")).withColumn("_words", whitespace_split("_q"))
    return q.select(id_col, "_words", (F.col("_q") == F.array_join("_words", " ")).alias("regular"))


def _tokens(split: DataFrame, id_col: str) -> DataFrame:
    both = F.transform("_words", lambda t: F.struct(t.alias("token"), normalise_token(t).alias("word")))
    return exploded(split, [id_col, "regular"], both, "_t", "pos").select(
        id_col, "pos", "_t.token", "_t.word", is_expandable("_t.token", "_t.word").alias("expandable"), "regular")


def candidate_tokens(queries: DataFrame, id_col: str = "doc_id", text_col: str = "headline") -> DataFrame:
    """``(id, pos, token, word, expandable, regular)`` for every whitespace token.

    Each token is normalised once, before the rows are made: a filter on ``expandable`` would otherwise compute it for every test.
    """
    return _tokens(_split(queries, id_col, text_col), id_col)


def _kept(toks: DataFrame, synonyms: DataFrame, id_col: str, max_queries: int) -> DataFrame:
    """``(id, ord, pos, synonym)`` of the candidates that become variants."""
    cand = toks.join(synonyms, "word")
    by_id = Window.partitionBy(id_col)
    w = by_id.orderBy("pos", "srank").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier_tokens = by_id.orderBy("pos").rangeBetween(Window.unboundedPreceding, -1)
    noop = F.col("synonym") == F.col("token")
    cand = cand.withColumn("_noop", noop).withColumn(
        "_noops", F.sum(F.col("_noop").cast("int")).over(w))
    cand = cand.withColumn("_new", ~F.col("_noop") | ((F.col("_noops") == 1) & ~F.col("regular")))
    cand = (cand.withColumn("_k", F.sum(F.col("_new").cast("int")).over(w))
            .withColumn("_earlier", F.coalesce(F.sum(F.col("_new").cast("int")).over(earlier_tokens), F.lit(0))))
    kept = cand.filter(F.col("_new") & (F.col("_earlier") < MAX_REPLACEMENTS) & (F.col("_k") <= max_queries - 1))
    return kept.select(id_col, F.col("_k").cast("int").alias("ord"), "pos", "synonym")


def _kept_by_heads(queries: DataFrame, synonyms_of: Callable[[DataFrame], DataFrame], id_col: str, text_col: str, max_queries: int) -> DataFrame:
    """:func:`_kept`, from the first words of each query where these settle it.

    Once as many new candidates as count stand in the first words, none after them is kept.
    """
    split = _split(queries, id_col, text_col)
    heads = write_table(split.select(id_col, F.slice("_words", 1, HEAD_WORDS).alias("_words"), "regular", F.size("_words").alias("_n")), "claim-heads")
    toks = _tokens(heads, id_col).filter("expandable")
    kept = write_table(_kept(toks, synonyms_of(toks.select("word")), id_col, max_queries), "head-variants")
    settled = kept.groupBy(id_col).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= min(MAX_REPLACEMENTS, max_queries - 1))
    left = write_table(heads.filter(F.col("_n") > HEAD_WORDS).select(id_col).distinct().join(settled, id_col, "left_anti"), "open-claims")
    if left.isEmpty():
        return kept
    toks = write_table(_tokens(split.join(left, id_col, "left_semi"), id_col).filter("expandable"), "claim-tokens")
    rest = _kept(toks, synonyms_of(toks.select("word")), id_col, max_queries)
    return kept.join(left, id_col, "left_anti").unionByName(rest)


def expand_queries(queries: DataFrame, synonyms: DataFrame | Callable[[DataFrame], DataFrame], id_col: str = "doc_id",
                   text_col: str = "headline", max_queries: int = MAX_QUERIES, tokens: DataFrame | None = None) -> DataFrame:
    """Long form ``(id, ord, query)``; ``ord`` 0 is the raw query.

    ``synonyms``: :func:`query_synonyms`, or a function that makes those of the words ``(word)`` that it is given, so that a query is read no
    further than its variants need.  ``tokens``: the expandable :func:`candidate_tokens` of the queries, if they are there already.
    """
    if max_queries <= 0:
        return queries.select(id_col, F.lit(0).cast("int").alias("ord"), F.col(text_col).alias("query")).limit(0)
    if callable(synonyms):
        kept = _kept_by_heads(queries, synonyms, id_col, text_col, max_queries)
    else:
        toks = tokens if tokens is not None else candidate_tokens(queries, id_col, text_col).filter("expandable")
        kept = _kept(toks, synonyms, id_col, max_queries)
    words = queries.select(id_col, whitespace_split(text_col).alias("_words"))
    variants = kept.join(words, id_col).select(
        id_col, "ord",
        F.array_join(F.transform("_words", lambda x, i: F.when(i == F.col("pos"), F.col("synonym")).otherwise(x)),
                     " ").alias("query"))
    raw = queries.select(id_col, F.lit(0).cast("int").alias("ord"), F.col(text_col).alias("query"))
    return raw.unionByName(variants)


def joined_variants(long: DataFrame, id_col: str = "doc_id", sep: str = " || ") -> DataFrame:
    """``(id, n_variants, variants)`` with the variants in order, joined by ``sep``."""
    return long.groupBy(id_col).agg(
        F.count(F.lit(1)).alias("n_variants"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "query"))), lambda s: s["query"]),
                     sep).alias("variants"))
