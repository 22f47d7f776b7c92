"""Registered text queries: tokens, stop words, n-grams, vocabulary, TF-IDF,
fixed-length encoding, token normalisation and query expansion."""

from __future__ import annotations

from pyspark.sql import functions as F

from claimlens.constants import CURATED_SYNONYMS, MAX_FEATURES, MAX_LENGTH
from claimlens.functions.numeric import round6
from claimlens.functions.text import DIGIT_PATTERN, word_bigrams, word_tokens
from claimlens.operators import expand as X
from claimlens.operators import features as FE
from claimlens.plans import sqlparts as Q
from claimlens.plans import views as V
from claimlens.plans.catalog import register
from claimlens.session import write_table
from claimlens.sources.tables import read_table

RE = Q.TOKEN_RE
STOP = Q.STOPWORDS_SQL
SEQ_VOCAB = 30000


def _docs(spark, sf):
    return read_table(spark, sf, "documents", ["doc_id", "text"], spread_by="doc_id")


def _join_str(arr, sep=" "):
    return F.array_join(F.transform(arr, lambda x: x.cast("string")), sep)


@register("tokenize_words", f"""
SELECT doc_id, CAST(len(t) AS INTEGER) AS n_tokens, array_to_string(t, ' ') AS tokens
FROM (SELECT doc_id, regexp_extract_all(lower(text), '{RE}') AS t FROM documents)""")
def tokenize_words(spark, sf):
    t = _docs(spark, sf).select("doc_id", word_tokens("text").alias("t"))
    return t.select("doc_id", F.size("t").alias("n_tokens"), F.array_join("t", " ").alias("tokens"))


@register("remove_stopwords", f"""
SELECT doc_id, CAST(len(t) AS INTEGER) AS n_kept, array_to_string(t, ' ') AS kept
FROM (SELECT doc_id, list_filter(regexp_extract_all(lower(text), '{RE}'), lambda x: NOT list_contains({STOP}, x)) AS t
      FROM documents)""")
def remove_stopwords(spark, sf):
    t = FE.tokens(_docs(spark, sf), remove_stop=True, out="t")
    return t.select("doc_id", F.size("t").alias("n_kept"), F.array_join("t", " ").alias("kept"))


@register("word_bigrams", f"""
SELECT doc_id, CAST(len(b) AS INTEGER) AS n_bigrams, array_to_string(b, '|') AS bigrams
FROM (SELECT doc_id, list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1]) AS b
      FROM (SELECT doc_id, list_filter(regexp_extract_all(lower(text), '{RE}'),
                                       lambda x: NOT list_contains({STOP}, x)) AS t FROM documents))""")
def word_bigrams_q(spark, sf):
    t = FE.tokens(_docs(spark, sf), remove_stop=True, out="t")
    b = t.select("doc_id", word_bigrams("t").alias("b"))
    return b.select("doc_id", F.size("b").alias("n_bigrams"), F.array_join("b", "|").alias("bigrams"))


_TRAIN_TERMS = f"""tr AS (SELECT doc_id, text FROM split WHERE split = 'train'),
tk AS (SELECT doc_id, list_filter(regexp_extract_all(lower(text), '{RE}'), lambda x: NOT list_contains({STOP}, x)) AS t
       FROM tr),
terms AS (SELECT doc_id, unnest(t || list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])) AS term
          FROM tk),
tf AS (SELECT doc_id, term, count(*) AS tf FROM terms GROUP BY ALL),
vocab AS (SELECT term, CAST(sum(tf) AS BIGINT) AS term_count, count(*) AS doc_freq FROM tf GROUP BY term
          ORDER BY term_count DESC, term LIMIT {MAX_FEATURES})"""


@register("top_vocabulary", Q.with_(Q.LABELED, Q.SPLIT, _TRAIN_TERMS) + """
SELECT term, term_count, doc_freq, CAST(row_number() OVER (ORDER BY term_count DESC, term) - 1 AS INTEGER) AS rank
FROM vocab""")
def top_vocabulary(spark, sf):
    """The most frequent uni- and bigrams of the training rows (ties by term)."""
    train = V.split_labeled(spark, sf).filter(F.col("split") == "train")
    return FE.top_vocabulary(FE.term_frequencies(FE.doc_terms(train)), MAX_FEATURES)


@register("tfidf_weights", Q.with_(Q.LABELED, Q.SPLIT, _TRAIN_TERMS, f"""idf AS (
  SELECT term, ln((1.0E0 + (SELECT count(*) FROM tr)) / (1.0E0 + doc_freq)) + 1.0E0 AS idf FROM vocab),
tka AS (SELECT doc_id, list_filter(regexp_extract_all(lower(text), '{RE}'), lambda x: NOT list_contains({STOP}, x)) AS t
        FROM labeled),
termsa AS (SELECT doc_id, unnest(t || list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])) AS term
           FROM tka),
wa AS (SELECT doc_id, term, count(*) * idf AS w FROM termsa JOIN idf USING (term) GROUP BY doc_id, term, idf)""") + f"""
SELECT doc_id, term, {Q.r6('w / sqrt(sum(w * w) OVER (PARTITION BY doc_id))')} AS weight FROM wa""")
def tfidf_weights(spark, sf):
    """Vectoriser fitted on the training rows, applied to every labelled document (one tokenisation)."""
    split = V.split_labeled(spark, sf).select("doc_id", "text", (F.col("split") == "train").alias("_fit"))
    # one plan: the term-frequency exchange is reused for the vocabulary and for the weights
    w = FE.fit_transform_tfidf(split, "_fit")
    return w.select("doc_id", "term", round6("weight").alias("weight"))


@register("sequence_encode", Q.with_(Q.LABELED, Q.SPLIT, f"""tr AS (SELECT doc_id, text FROM split WHERE split = 'train'),
wv AS (SELECT term, CAST(row_number() OVER (ORDER BY cnt DESC, term) - 1 + 1000 AS INTEGER) AS token_id
       FROM (SELECT term, count(*) AS cnt FROM (SELECT unnest(regexp_extract_all(lower(text), '{RE}')) AS term FROM tr)
             GROUP BY term ORDER BY cnt DESC, term LIMIT {SEQ_VOCAB})),
lt AS (SELECT doc_id, regexp_extract_all(lower(text), '{RE}')[1:{MAX_LENGTH - 2}] AS t FROM labeled),
ps AS (SELECT doc_id, unnest(t) AS term, unnest(range(1, len(t) + 1)) AS pos FROM lt),
ids AS (SELECT doc_id, list(coalesce(v.token_id, 100) ORDER BY pos) AS l FROM ps LEFT JOIN wv v USING (term)
        GROUP BY doc_id),
enc AS (SELECT d.doc_id, [101] || coalesce(i.l, []) || [102] AS core FROM labeled d LEFT JOIN ids i USING (doc_id))""") + f"""
SELECT doc_id, array_to_string(list_resize(core, {MAX_LENGTH}, 0), ' ') AS input_ids,
       array_to_string(list_resize(list_transform(core, lambda x: 1), {MAX_LENGTH}, 0), '') AS attention_mask
FROM enc""")
def sequence_encode(spark, sf):
    """[CLS] + word ids + [SEP], padded to 128, with a corpus-built word vocabulary."""
    split = V.split_labeled(spark, sf)
    vocab = FE.word_vocabulary(split.filter(F.col("split") == "train"), SEQ_VOCAB)
    enc = FE.sequence_encode(split.select("doc_id", "text"), vocab)
    return enc.select("doc_id", _join_str("input_ids").alias("input_ids"),
                      _join_str("attention_mask", "").alias("attention_mask"))


# ---------------------------------------------------------------- expansion

_CLAIM_TOKENS = f"""cw AS (SELECT doc_id, headline, list_filter(string_split_regex(headline, '[\\s\\x0B\\x1C-\\x1F\\x{{85}}\\p{{Z}}]+'), lambda x: x <> '') AS w
       FROM claims),
tok AS (SELECT doc_id, headline = array_to_string(w, ' ') AS regular, unnest(w) AS token,
               unnest(range(0, len(w))) AS pos FROM cw),
tokx AS (SELECT *, lower(regexp_replace(token, '[^A-Za-z-]', '', 'g')) AS normalised FROM tok),
tokx2 AS (SELECT *, length(normalised) >= 4 AND NOT list_contains({Q.EXPANSION_STOPWORDS_SQL}, normalised)
                    AND NOT regexp_matches(token, '{DIGIT_PATTERN}')
                    AND NOT (token = upper(token) AND token <> lower(token)) AS expandable FROM tokx)"""

_CURATED_VALUES = ", ".join(f"('{w}', 0, {i + 1}, '{s}')" for w, syns in CURATED_SYNONYMS.items()
                            for i, s in enumerate(syns))

_SYNONYMS = f"""ww AS (SELECT lower(regexp_replace(t, '[^A-Za-z-]', '', 'g')) AS word
       FROM (SELECT unnest(string_split_regex(text, '\\s+')) AS t FROM documents)),
wf AS (SELECT word, count(*) AS freq, substr(word, 1, 1) AS k_init, length(word) AS k_len FROM ww
       WHERE length(word) >= 4 GROUP BY word),
top AS (SELECT k_init, k_len, word AS synonym, freq AS s_freq
        FROM (SELECT *, row_number() OVER (PARTITION BY k_init, k_len ORDER BY freq DESC, word) AS r FROM wf)
        WHERE r <= 4),
th AS (SELECT word, rank, synonym FROM (
         SELECT w.word, t.synonym, row_number() OVER (PARTITION BY w.word ORDER BY t.s_freq DESC, t.synonym) AS rank
         FROM wf w JOIN top t USING (k_init, k_len) WHERE t.synonym <> w.word) WHERE rank <= 3),
th1 AS (SELECT word, rank, lower(replace(synonym, '_', ' ')) AS synonym FROM th),
th2 AS (SELECT word, 1 AS origin, CAST(r AS INTEGER) AS rank, synonym FROM (
          SELECT *, row_number() OVER (PARTITION BY word ORDER BY rank, synonym) AS r FROM th1
          WHERE synonym <> word AND NOT regexp_matches(synonym, '[^\\x00-\\x7F]')) WHERE r <= 2),
cur AS (SELECT * FROM (VALUES {_CURATED_VALUES}) c(word, origin, rank, synonym)),
syn AS (SELECT word, origin, rank, synonym FROM cur UNION ALL SELECT word, origin, rank, synonym FROM th2),
qs AS (SELECT word, CAST(srank AS INTEGER) AS srank, synonym FROM (
         SELECT word, synonym, row_number() OVER (PARTITION BY word ORDER BY origin, rank) AS srank
         FROM (SELECT *, row_number() OVER (PARTITION BY word, synonym ORDER BY origin, rank) AS d FROM syn)
         WHERE d = 1) WHERE srank <= 2)"""


def _claim_tokens(spark, sf):
    return X.candidate_tokens(V.claims(spark, sf))


def _synonyms(spark, sf, wanted=None, words=None):
    return X.query_synonyms(X.synonym_table(X.curated_table(spark), X.corpus_thesaurus(_docs(spark, sf), wanted=wanted, words=words)))


def _expandable(spark, sf):
    """Claims from a split that is decided once, and their expandable tokens, written down for the thesaurus and the variants."""
    claims = V.claims(spark, sf, V.split_labeled(spark, sf, write_table(V.split_keys(spark, sf), "split-keys")))
    return claims, write_table(X.candidate_tokens(claims).filter("expandable"), "claim-tokens")


@register("normalise_token", Q.with_(Q.LABELED, Q.SPLIT, Q.CLAIMS, _CLAIM_TOKENS) + """
SELECT doc_id, CAST(pos AS INTEGER) AS pos, normalised FROM tokx""")
def normalise_token(spark, sf):
    return _claim_tokens(spark, sf).select("doc_id", "pos", F.col("word").alias("normalised"))


@register("expandable_tokens", Q.with_(Q.LABELED, Q.SPLIT, Q.CLAIMS, _CLAIM_TOKENS) + """
SELECT doc_id, CAST(pos AS INTEGER) AS pos, expandable FROM tokx2""")
def expandable_tokens(spark, sf):
    return _claim_tokens(spark, sf).select("doc_id", "pos", "expandable")


@register("token_synonyms", Q.with_(Q.LABELED, Q.SPLIT, Q.CLAIMS, _CLAIM_TOKENS, _SYNONYMS) + """
SELECT DISTINCT q.word, q.srank, q.synonym FROM tokx2 t JOIN qs q ON q.word = t.normalised WHERE t.expandable""")
def token_synonyms(spark, sf):
    """Up to two synonyms (curated first, then thesaurus) of every expandable claim word."""
    words = _expandable(spark, sf)[1].select("word").distinct()
    return words.join(_synonyms(spark, sf, words), "word").select("word", "srank", "synonym")


_EXPAND = """cand AS (SELECT t.doc_id, t.pos, t.token, t.regular, q.srank, q.synonym, q.synonym = t.token AS noop
         FROM tokx2 t JOIN qs q ON q.word = t.normalised WHERE t.expandable),
c2 AS (SELECT *, sum(CASE WHEN noop THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY pos, srank
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS noops FROM cand),
c3 AS (SELECT *, (NOT noop) OR (noops = 1 AND NOT regular) AS is_new FROM c2),
c4 AS (SELECT *, sum(CASE WHEN is_new THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY pos, srank
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS k,
              coalesce(sum(CASE WHEN is_new THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY pos
                 RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS earlier FROM c3),
kept AS (SELECT doc_id, k AS ord, pos, synonym FROM c4 WHERE is_new AND earlier < 2 AND k <= 2),
var AS (SELECT k.doc_id, k.ord,
               array_to_string(list_transform(range(0, len(c.w)),
                   lambda i: CASE WHEN i = k.pos THEN k.synonym ELSE c.w[i + 1] END), ' ') AS query
        FROM kept k JOIN cw c USING (doc_id)),
allq AS (SELECT doc_id, 0 AS ord, headline AS query FROM claims UNION ALL SELECT doc_id, ord, query FROM var)"""


@register("expand_queries", Q.with_(Q.LABELED, Q.SPLIT, Q.CLAIMS, _CLAIM_TOKENS, _SYNONYMS, _EXPAND) + """
SELECT doc_id, count(*) AS n_variants, string_agg(query, ' || ' ORDER BY ord) AS variants FROM allq GROUP BY doc_id""")
def expand_queries(spark, sf):
    """Query variants of every held-out claim (raw first), joined in order."""
    claims, toks = _expandable(spark, sf)
    long = X.expand_queries(claims, _synonyms(spark, sf, toks.select("word")), tokens=toks)
    return X.joined_variants(long)
