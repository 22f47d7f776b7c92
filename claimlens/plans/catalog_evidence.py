"""Registered evidence queries: retrieval, verdicts, merged pipelines, reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens.constants import LABELS
from claimlens.functions.numeric import fixed, hash_int, percent_text, round6
from claimlens.functions.text import exploded, word_tokens
from claimlens.operators import combine as C
from claimlens.operators import expand as X
from claimlens.operators import metrics as M
from claimlens.operators import retrieve as R
from claimlens.operators import splits as S
from claimlens.operators import verdict as VD
from claimlens.plans import sqlparts as Q
from claimlens.plans import views as V
from claimlens.plans.catalog import register
from claimlens.plans.catalog_text import _CLAIM_TOKENS, _EXPAND, _SYNONYMS, _docs, _synonyms
from claimlens.session import scratch_path, write_table
from claimlens.sources import sinks as SK
from claimlens.sources.tables import read_table

RE = Q.TOKEN_RE
VARIANT_SLOTS = 8  # in the SQL oracles only: a variant's number = claim id * 8 + ordinal


# ---------------------------------------------------------------- SQL builders

def bm25_sql(q_src: str, q_id: str, q_text: str, d_src: str, out: str, k: int = 5) -> str:
    """Naive BM25 top-k of every query in ``q_src`` over documents ``d_src``."""
    return f"""{out}_dt AS (SELECT doc_id AS doc, regexp_extract_all(lower(text), '{RE}') AS t FROM {d_src}),
{out}_st AS (SELECT CAST(count(*) AS DOUBLE) AS n, CAST(avg(len(t)) AS DOUBLE) AS avgdl FROM {out}_dt),
{out}_tf AS (SELECT doc, term, count(*) AS tf FROM (SELECT doc, unnest(t) AS term FROM {out}_dt) GROUP BY ALL),
{out}_po AS (SELECT doc, term, (tf * 2.2E0) / (tf + 1.2E0 * (0.25E0 + 0.75E0
               * sum(tf) OVER (PARTITION BY doc) / (SELECT avgdl FROM {out}_st))) AS ntf FROM {out}_tf),
{out}_idf AS (SELECT term, ln(1.0E0 + ((SELECT n FROM {out}_st) - count(*) + 0.5E0) / (count(*) + 0.5E0)) AS idf
              FROM {out}_po GROUP BY term),
{out}_qt AS (SELECT DISTINCT qid, term FROM (
               SELECT {q_id} AS qid, unnest(regexp_extract_all(lower({q_text}), '{RE}')) AS term FROM {q_src})),
{out}_sc AS (SELECT q.qid, p.doc, CAST(sum(CAST(floor(i.idf * p.ntf * 1000000.0E0 + 0.5E0) AS BIGINT)) AS BIGINT) AS score_units
             FROM {out}_qt q JOIN {out}_idf i USING (term) JOIN {out}_po p USING (term) GROUP BY q.qid, p.doc),
{out} AS (SELECT * FROM (SELECT qid, doc, score_units,
                 row_number() OVER (PARTITION BY qid ORDER BY score_units DESC, doc) AS rank
                 FROM {out}_sc WHERE score_units > 0) WHERE rank <= {k})"""


def shares_sql(hits: str, out: str) -> str:
    cols = ", ".join(
        f"sum(CASE WHEN label = '{c}' THEN score_units ELSE 0 END) AS u_{c}, "
        f"sum(CASE WHEN label = '{c}' THEN 1 ELSE 0 END) AS n_{c}" for c in LABELS)
    return f"""{out} AS (SELECT qid, count(*) AS n_hits, sum(score_units) AS u_total, {cols},
          list('doc:' || CAST(doc AS VARCHAR) ORDER BY score_units DESC, doc) AS sources
        FROM (SELECT h.qid, h.doc, h.score_units, e.label FROM {hits} h JOIN evidence e ON e.doc_id = h.doc)
        GROUP BY qid)"""


def verdict_sql(shares: str, out: str) -> str:
    sf, sm, st = (f"(CAST(s.u_{c} AS DOUBLE) / CAST(s.u_total AS DOUBLE))" for c in LABELS)
    best = f"greatest({sf}, {sm}, {st})"
    reason = "'hits=' || s.n_hits || " + " || ".join(f"' {c}=' || s.n_{c}" for c in LABELS)
    return f"""{out} AS (SELECT c.doc_id,
    CASE WHEN s.n_hits IS NULL OR {best} < 0.5E0 THEN 'mixed'
         WHEN {sf} >= {sm} AND {sf} >= {st} THEN 'false' WHEN {sm} >= {st} THEN 'mixed' ELSE 'true' END AS verdict,
    CASE WHEN s.n_hits IS NULL THEN 0.0E0 ELSE {best} END AS confidence_score,
    CASE WHEN s.n_hits IS NULL THEN 'no evidence found' ELSE {reason} END AS reasoning,
    coalesce(s.sources, []) AS sources, CAST(coalesce(s.n_hits, 0) AS BIGINT) AS n_hits,
    CASE WHEN s.n_hits IS NULL THEN false ELSE {st} > 0.5E0 END AS is_real,
    CASE WHEN s.n_hits IS NULL THEN 1.0E0 ELSE greatest({st}, 1.0E0 - {st}) END AS binary_confidence
  FROM claims c LEFT JOIN {shares} s ON s.qid = c.doc_id)"""


_PLAIN = Q.with_(Q.LABELED, Q.SPLIT, Q.CLAIMS, bm25_sql("claims", "doc_id", "headline", "evidence", "hp"),
                 shares_sql("hp", "sp"), verdict_sql("sp", "vp"))

_EXPANDED_CTES = [_CLAIM_TOKENS, _SYNONYMS, _EXPAND,
                  f"vq AS (SELECT doc_id * {VARIANT_SLOTS} + ord AS vqid, query FROM allq)",
                  bm25_sql("vq", "vqid", "query", "evidence", "hx"),
                  f"hxd AS (SELECT qid // {VARIANT_SLOTS} AS qid, doc, max(score_units) AS score_units FROM hx "
                  "GROUP BY ALL)",
                  shares_sql("hxd", "sx"), verdict_sql("sx", "vx")]

_BOTH = Q.with_(Q.LABELED, Q.SPLIT, Q.CLAIMS, Q.PREDS, bm25_sql("claims", "doc_id", "headline", "evidence", "hp"),
                shares_sql("hp", "sp"), verdict_sql("sp", "vp"), *_EXPANDED_CTES)


# ---------------------------------------------------------------- Spark pieces

class EvidencePlan:
    """Shared pieces of the evidence pipeline for one data directory."""

    def __init__(self, spark, sf, materialize: bool = True, evidence_fn=None):
        """``evidence_fn(queries, evidence) -> (qid, ord, doc, rank, score_units)`` replaces BM25 when given; queries are ``(qid, ord, query)``."""
        self.spark, self.sf = spark, sf
        self.evidence_fn = evidence_fn
        # split membership (keys only) and the evidence postings are written once to the shared
        # checkpoint folder; every later branch reads them instead of re-running the split and
        # the tokenisation, and a lost executor does not replay the lineage
        keys = V.split_keys(spark, sf)
        if materialize:
            keys = write_table(keys, "split-keys")
        self.split = V.split_labeled(spark, sf, keys)
        self.claims = V.claims(spark, sf, self.split)
        self.evidence = V.evidence(spark, sf, self.split)
        # labels alone: joins that need no text read none
        self.claim_labels = keys.filter(F.col("split") == "test").select("doc_id", "label")
        self.evidence_labels = keys.filter(F.col("split") == "train").select("doc_id", "label")
        self.materialize = materialize
        self._index = None
        self._variant_hits = None
        self._variants = None

    @property
    def index(self) -> R.Bm25Index:
        """The evidence, tokenised once per plan."""
        if self._index is None:
            self._index = R.build_index(self.evidence, materialize=self.materialize)
        return self._index

    def variants(self) -> DataFrame:
        """Query variants of every claim, computed once per plan (``doc_id, ord, query``)."""
        if self._variants is None:
            words = X.corpus_words(_docs(self.spark, self.sf))
            v = X.expand_queries(self.claims, lambda wanted: _synonyms(self.spark, self.sf, wanted, words))
            self._variants = write_table(v, "variants") if self.materialize else v
        return self._variants

    def plain_hits(self) -> DataFrame:
        """Top-k evidence of every claim: ``(qid, rank, doc, score_units)``; a search for the variants serves them too."""
        if self._variant_hits is not None:
            return self._variant_hits.filter(F.col("ord") == 0).drop("ord")
        if self.evidence_fn is not None:
            return self.evidence_fn(self.claims.select(F.col("doc_id").alias("qid"), F.lit(0).alias("ord"),
                                                       F.col("headline").alias("query")), self.evidence).drop("ord")
        return R.bm25_topk(self.claims, self.index, "doc_id", "headline")

    def variant_hits(self) -> DataFrame:
        """Top-k evidence of every query variant, the claim itself (``ord`` 0) included: ``(qid, ord, rank, doc, score_units)``."""
        if self._variant_hits is None:
            v = self.variants().select(F.col("doc_id").alias("qid"), "ord", "query")
            hits = R.search(v, self.index) if self.evidence_fn is None else self.evidence_fn(v, self.evidence)
            self._variant_hits = write_table(hits, "evidence-hits") if self.materialize else hits
        return self._variant_hits

    def expanded_hits(self) -> DataFrame:
        return self.variant_hits().select("qid", "doc", "score_units")

    def plain_verdict(self) -> DataFrame:
        shares = VD.label_shares(self.plain_hits(), self.evidence_labels)
        return VD.three_class_verdict(self.claim_labels.withColumnRenamed("doc_id", "qid"), shares)

    def expanded_verdict(self) -> DataFrame:
        shares = VD.label_shares(VD.dedupe_hits(self.expanded_hits()), self.evidence_labels)
        return VD.three_class_verdict(self.claim_labels.withColumnRenamed("doc_id", "qid"), shares)

    def with_evidence(self, base: DataFrame | None = None) -> DataFrame:
        """Base and base + evidence per claim.  ``base`` has ``doc_id, base_label, base_confidence``; default: synthetic preds."""
        if base is None:
            base = V.with_preds(self.claim_labels).select("doc_id", "base_label", "base_confidence")
        pv = self.plain_verdict().select(F.col("qid").alias("doc_id"), F.col("verdict").alias("evidence_verdict"),
                                         F.col("confidence_score").alias("evidence_confidence"),
                                         F.col("reasoning").alias("evidence_reasoning"),
                                         F.col("sources").alias("evidence_sources"))
        wide = self.claim_labels.select("doc_id", F.col("label").alias("gold")).join(base, "doc_id").join(pv, "doc_id")
        return wide.withColumn("evidence_label", C.combine_predictions(
            "base_label", "base_confidence", "evidence_verdict", "evidence_confidence"))

    def three_pipelines(self, base: DataFrame | None = None) -> DataFrame:
        """:meth:`with_evidence` and base + expanded evidence, side by side."""
        self.variant_hits()  # one search serves the raw claims and all their variants
        xv = self.expanded_verdict().select(F.col("qid").alias("doc_id"), F.col("verdict").alias("expanded_verdict"),
                                            F.col("confidence_score").alias("expanded_confidence"))
        return self.with_evidence(base).join(xv, "doc_id").withColumn("expanded_label", C.combine_predictions(
            "base_label", "base_confidence", "expanded_verdict", "expanded_confidence"))


# ---------------------------------------------------------------- queries

@register("evidence_topk", Q.with_(bm25_sql("benchmark", "item_id", "text", "documents", "hb")) + """
SELECT qid AS item_id, CAST(rank AS INTEGER) AS rank, doc AS doc_id, score_units / 1000000.0E0 AS score FROM hb""")
def evidence_topk(spark, sf):
    """BM25 top-5 documents for every benchmark item over the whole document table."""
    items = read_table(spark, sf, "benchmark", ["item_id", "text"])
    index = R.build_index(_docs(spark, sf), materialize=True)
    hits = R.bm25_topk(items, index, "item_id", "text")
    return hits.select(F.col("qid").alias("item_id"), F.col("rank").cast("int").alias("rank"),
                       F.col("doc").alias("doc_id"), (F.col("score_units") / F.lit(1000000.0)).alias("score"))


_PASSAGE_SQL = f"""xt AS (SELECT DISTINCT qid, term FROM (SELECT vqid AS qid, unnest(regexp_extract_all(lower(query), '{RE}')) AS term FROM vq)),
dw AS (SELECT doc_id AS doc, unnest(t) AS term, unnest(range(len(t))) AS pos FROM (SELECT doc_id, regexp_extract_all(lower(text), '{RE}') AS t FROM evidence)),
mt AS (SELECT h.qid, h.doc, d.pos FROM hx h JOIN xt q USING (qid) JOIN dw d ON d.doc = h.doc AND d.term = q.term),
mc AS (SELECT qid, doc, pos, count(*) OVER (PARTITION BY qid, doc ORDER BY pos RANGE BETWEEN CURRENT ROW AND 11 FOLLOWING) AS n FROM mt),
mb AS (SELECT qid, doc, pos FROM (SELECT *, row_number() OVER (PARTITION BY qid, doc ORDER BY n DESC, pos) AS r FROM mc) WHERE r = 1),
ps AS (SELECT mb.qid, mb.doc, string_agg(dw.term, ' ' ORDER BY dw.pos) AS passage
  FROM mb JOIN dw ON dw.doc = mb.doc AND dw.pos BETWEEN mb.pos AND mb.pos + 11 GROUP BY mb.qid, mb.doc)"""


@register("evidence_topk_expanded", Q.with_(Q.LABELED, Q.SPLIT, Q.CLAIMS, *_EXPANDED_CTES, _PASSAGE_SQL) + f"""
SELECT doc_id, count(*) AS n_variants,
       string_agg('Query: ' || query || coalesce(hits, chr(10) || 'no results'), chr(10) ORDER BY ord) AS results
FROM (SELECT a.doc_id, a.ord, a.query,
             (SELECT string_agg(chr(10) || 'doc:' || CAST(h.doc AS VARCHAR) || ' ' || ps.passage, '' ORDER BY h.rank) FROM hx h JOIN ps USING (qid, doc)
              WHERE h.qid = a.doc_id * {VARIANT_SLOTS} + a.ord) AS hits
      FROM allq a) GROUP BY doc_id""")
def evidence_topk_expanded(spark, sf):
    """Evidence for every query variant of every claim: blocks in variant order, each with its query and the best passage of every hit."""
    plan = EvidencePlan(spark, sf)
    v = plan.variants().select(F.col("doc_id").alias("qid"), F.col("ord").cast("long").alias("ord"), "query")
    hits = R.best_passages(plan.variant_hits(), v, plan.evidence)
    line = F.concat(F.lit("\ndoc:"), F.col("doc").cast("string"), F.lit(" "), F.coalesce("passage", F.lit("")))
    per_v = hits.groupBy("qid", "ord").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", line.alias("line")))), lambda s: s["line"]), "").alias("hits"))
    blocks = v.join(per_v, ["qid", "ord"], "left").select(
        F.col("qid").alias("doc_id"), "ord", F.concat(F.lit("Query: "), "query", F.coalesce("hits", F.lit("\nno results"))).alias("block"))
    return blocks.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_variants"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "block"))), lambda s: s["block"]),
                     "\n").alias("results"))


@register("three_class_verdict", _PLAIN + f"""
SELECT doc_id, verdict, {Q.r6('confidence_score')} AS confidence_score, reasoning,
       array_to_string(sources, ',') AS sources, n_hits FROM vp""")
def three_class_verdict(spark, sf):
    v = EvidencePlan(spark, sf).plain_verdict()
    return v.select(F.col("qid").alias("doc_id"), "verdict", round6("confidence_score").alias("confidence_score"),
                    "reasoning", F.array_join("sources", ",").alias("sources"), "n_hits")


@register("binary_verdict", _PLAIN + f"""
SELECT doc_id, is_real, {Q.r6('binary_confidence')} AS confidence_score, reasoning FROM vp""")
def binary_verdict(spark, sf):
    plan = EvidencePlan(spark, sf)
    shares = VD.label_shares(plan.plain_hits(), plan.evidence_labels)
    v = VD.binary_verdict(plan.claim_labels.withColumnRenamed("doc_id", "qid"), shares)
    return v.select(F.col("qid").alias("doc_id"), "is_real", round6("confidence_score").alias("confidence_score"),
                    "reasoning")


_WIDE_SQL = f"""wide AS (SELECT c.doc_id, c.label AS gold, p.base_label, p.base_confidence,
       vp.verdict AS evidence_verdict, vp.confidence_score AS evidence_confidence, vp.reasoning AS evidence_reasoning,
       vp.sources AS evidence_sources, vx.verdict AS expanded_verdict, vx.confidence_score AS expanded_confidence
  FROM claims c JOIN preds p USING (doc_id) JOIN vp USING (doc_id) JOIN vx USING (doc_id)),
wide2 AS (SELECT *, {Q.final_label('base_label', 'base_confidence', 'evidence_verdict', 'evidence_confidence')}
                      AS evidence_label,
                    {Q.final_label('base_label', 'base_confidence', 'expanded_verdict', 'expanded_confidence')}
                      AS expanded_label FROM wide)"""


@register("three_pipeline_eval", _BOTH + "," + _WIDE_SQL + f"""
SELECT doc_id, gold, base_label, base_confidence, evidence_label, evidence_verdict,
       {Q.r6('evidence_confidence')} AS evidence_confidence, expanded_label, expanded_verdict,
       {Q.r6('expanded_confidence')} AS expanded_confidence FROM wide2""")
def three_pipeline_eval(spark, sf):
    """Base prediction, base + evidence, base + expanded evidence, per held-out claim."""
    w = EvidencePlan(spark, sf).three_pipelines()
    return w.select("doc_id", "gold", "base_label", "base_confidence", "evidence_label", "evidence_verdict",
                    round6("evidence_confidence").alias("evidence_confidence"), "expanded_label",
                    "expanded_verdict", round6("expanded_confidence").alias("expanded_confidence"))


_PLAIN_WIDE = Q.with_(Q.LABELED, Q.SPLIT, Q.CLAIMS, Q.PREDS, bm25_sql("claims", "doc_id", "headline", "evidence", "hp"),
                      shares_sql("hp", "sp"), verdict_sql("sp", "vp"), f"""wide AS (
  SELECT c.doc_id, p.base_label, p.base_confidence, vp.verdict AS evidence_verdict, vp.confidence_score AS evidence_confidence,
         vp.reasoning AS evidence_reasoning, vp.sources AS evidence_sources
  FROM claims c JOIN preds p USING (doc_id) JOIN vp USING (doc_id)),
wide2 AS (SELECT *, {Q.final_label('base_label', 'base_confidence', 'evidence_verdict', 'evidence_confidence')}
                      AS evidence_label FROM wide)""")


@register("evidence_report", _PLAIN_WIDE + f"""
SELECT doc_id, base_label AS prediction,
       CASE WHEN base_confidence IS NULL THEN 'N/A' ELSE {Q.fixed('base_confidence * 100.0E0', 1)} || '%' END
         AS confidence_text,
       evidence_verdict AS verdict, {Q.fixed('evidence_confidence * 100.0E0', 1)} || '%' AS evidence_confidence_text,
       evidence_label AS final_label, evidence_reasoning AS reason,
       CASE WHEN len(evidence_sources) = 0 THEN 'None'
            ELSE array_to_string(list_transform(evidence_sources, lambda s: '- ' || s), chr(10)) END AS sources_text
FROM wide2""")
def evidence_report(spark, sf):
    """The full result record per claim: prediction, verdict, final label, reason, sources (no variants are searched)."""
    w = EvidencePlan(spark, sf).with_evidence()
    return w.select("doc_id", F.col("base_label").alias("prediction"),
                    percent_text(F.col("base_confidence"), 1, "N/A").alias("confidence_text"),
                    F.col("evidence_verdict").alias("verdict"),
                    percent_text(F.col("evidence_confidence"), 1).alias("evidence_confidence_text"),
                    F.col("evidence_label").alias("final_label"), F.col("evidence_reasoning").alias("reason"),
                    C.sources_text("evidence_sources").alias("sources_text"))


REPORT_MODEL = "synthetic"


def _report_block(ord_col, model: str):
    """A claim as a small tab-separated table: one line per pipeline (label, verdict, confidence), the claim's text last."""
    def line(name: str, *cells):
        return F.concat_ws("\t", F.lit(name), *cells)

    none = F.lit("-")
    return F.concat_ws(
        "\n",
        line("case", ord_col.cast("string"), F.concat(F.lit("gold="), F.col("gold"))),
        line(model, F.col("base_label"), none, F.coalesce(fixed(F.col("base_confidence"), 4), none)),
        *(line(f"+{p}", F.col(f"{p}_label"), F.col(f"{p}_verdict"), fixed(F.col(f"{p}_confidence"), 4)) for p in ("evidence", "expanded")),
        line("text", F.coalesce("headline", none)))


@register("prediction_report", _BOTH + "," + _WIDE_SQL + f""",
rep AS (SELECT w.*, c.headline, row_number() OVER (ORDER BY {Q.h('42:shuffle')}, w.doc_id) AS ord
        FROM wide2 w JOIN claims c USING (doc_id))
SELECT CAST(0 AS BIGINT) AS ord, 'report' || chr(9) || 'synthetic' || chr(9) || 'cases=' || count(*) AS block FROM rep
UNION ALL
SELECT ord, 'case' || chr(9) || ord || chr(9) || 'gold=' || gold || chr(10)
       || 'synthetic' || chr(9) || base_label || chr(9) || '-' || chr(9) || coalesce({Q.fixed('base_confidence', 4)}, '-') || chr(10)
       || '+evidence' || chr(9) || evidence_label || chr(9) || evidence_verdict || chr(9) || {Q.fixed('evidence_confidence', 4)} || chr(10)
       || '+expanded' || chr(9) || expanded_label || chr(9) || expanded_verdict || chr(9) || {Q.fixed('expanded_confidence', 4)} || chr(10)
       || 'text' || chr(9) || coalesce(headline, '-')
FROM rep""")
def prediction_report(spark, sf):
    """Per-example report rows ``(ord, block)``: a header (ord 0), then one block per claim.

    Claims are numbered in the seeded-shuffle order; write with
    :func:`claimlens.sources.sinks.write_lines`.
    """
    plan = EvidencePlan(spark, sf)
    w = write_table(plan.three_pipelines(), "report-rows")  # numbered, counted and printed from one result
    numbered = S.seeded_shuffle(w, "doc_id", name="ord").join(plan.claims.select("doc_id", "headline"), "doc_id")
    blocks = numbered.select(F.col("ord").cast("bigint").alias("ord"), _report_block(F.col("ord"), REPORT_MODEL).alias("block"))
    header = w.agg(F.concat_ws("\t", F.lit("report"), F.lit(REPORT_MODEL), F.concat(F.lit("cases="), F.count(F.lit(1)).cast("string")))
                   .alias("block")).select(F.lit(0).cast("bigint").alias("ord"), "block")
    return header.unionByName(blocks)


# ---------------------------------------------------------------- evaluation of the three pipelines

_CELLS_SQL = """cells AS (SELECT pipeline, gold, base, predicted, count(*) AS n FROM (
    SELECT 'base' AS pipeline, gold, base_label AS base, base_label AS predicted FROM wide2
    UNION ALL SELECT 'evidence', gold, base_label, evidence_label FROM wide2
    UNION ALL SELECT 'expanded', gold, base_label, expanded_label FROM wide2) GROUP BY ALL),
classes AS (SELECT unnest(['false', 'mixed', 'true']) AS label)"""


@register("pipeline_metrics", _BOTH + "," + _WIDE_SQL + "," + _CELLS_SQL + f""",
per AS (SELECT pipeline, label, sum(n) AS total, sum(CASE WHEN gold = predicted THEN n ELSE 0 END) AS correct,
    sum(CASE WHEN gold = label AND predicted = label THEN n ELSE 0 END) AS tp,
    sum(CASE WHEN gold = label THEN n ELSE 0 END) AS gp, sum(CASE WHEN predicted = label THEN n ELSE 0 END) AS pp,
    sum(CASE WHEN gold = label AND predicted = 'false' THEN n ELSE 0 END) AS p0,
    sum(CASE WHEN gold = label AND predicted = 'mixed' THEN n ELSE 0 END) AS p1,
    sum(CASE WHEN gold = label AND predicted = 'true' THEN n ELSE 0 END) AS p2
  FROM cells, classes GROUP BY pipeline, label),
sc AS (SELECT *, CASE WHEN pp > 0 THEN tp / CAST(pp AS DOUBLE) ELSE 0.0E0 END AS p, CASE WHEN gp > 0 THEN tp / CAST(gp AS DOUBLE) ELSE 0.0E0 END AS r,
    CASE WHEN gp + pp > 0 THEN 2 * tp / CAST(gp + pp AS DOUBLE) ELSE 0.0E0 END AS f FROM per),
lines AS (SELECT pipeline, label, p, r, f, gp, total, correct, p0, p1, p2 FROM sc
  UNION ALL SELECT pipeline, 'macro avg', (sum(p)) / 3.0E0, sum(r) / 3.0E0, sum(f) / 3.0E0, sum(gp), any_value(total), any_value(correct),
    sum(p0), sum(p1), sum(p2) FROM sc GROUP BY pipeline
  UNION ALL SELECT pipeline, 'weighted avg', sum(p * gp) / sum(gp), sum(r * gp) / sum(gp), sum(f * gp) / sum(gp), sum(gp), any_value(total),
    any_value(correct), sum(p0), sum(p1), sum(p2) FROM sc GROUP BY pipeline)
SELECT pipeline, label, {Q.r6('p')} AS precision, {Q.r6('r')} AS recall, {Q.r6('f')} AS f1, CAST(gp AS BIGINT) AS support,
  CAST(p0 AS BIGINT) AS pred_false, CAST(p1 AS BIGINT) AS pred_mixed, CAST(p2 AS BIGINT) AS pred_true,
  {Q.r6('correct / CAST(total AS DOUBLE)')} AS accuracy FROM lines""")
def pipeline_metrics(spark, sf):
    """Per pipeline: precision, recall, F1, support and the confusion row of every class, the averages, and the accuracy."""
    return M.pipeline_report(M.pipeline_cells(EvidencePlan(spark, sf).three_pipelines()))


@register("pipeline_overrides", _BOTH + "," + _WIDE_SQL + "," + _CELLS_SQL + """,
kinds AS (SELECT *, CASE WHEN base = predicted AND gold = predicted THEN 'unchanged_correct' WHEN base = predicted THEN 'unchanged_wrong'
    WHEN predicted = gold THEN 'corrected' WHEN base = gold THEN 'worsened' ELSE 'changed_still_wrong' END AS effect
  FROM cells WHERE pipeline <> 'base')
SELECT pipeline, 'transition' AS kind, base || ' -> ' || predicted AS name, CAST(sum(n) AS BIGINT) AS n FROM kinds
  WHERE base <> predicted GROUP BY pipeline, base, predicted
UNION ALL SELECT pipeline, 'effect', effect, CAST(sum(n) AS BIGINT) FROM kinds GROUP BY pipeline, effect
UNION ALL SELECT pipeline, 'total', 'claims', CAST(sum(n) AS BIGINT) FROM kinds GROUP BY pipeline""")
def pipeline_overrides(spark, sf):
    """What evidence changed, per pipeline: transitions, their effect on correctness, and the number of claims."""
    return M.pipeline_changes(M.pipeline_cells(EvidencePlan(spark, sf).three_pipelines()))


# ---------------------------------------------------------------- golden cases

_VERDICTS = Q.with_(Q.LABELED, Q.SPLIT, Q.CLAIMS, bm25_sql("claims", "doc_id", "headline", "evidence", "hp"),
                    shares_sql("hp", "sp"), verdict_sql("sp", "vp"), *_EXPANDED_CTES)
_GRID_SQL = """,
grid AS (SELECT c.doc_id, m.model, c.label AS expected, CASE m.model WHEN 'evidence' THEN vp.verdict ELSE vx.verdict END AS predicted
  FROM claims c JOIN vp USING (doc_id) JOIN vx USING (doc_id), (VALUES ('evidence'), ('expanded')) m(model))"""


def _case_grid(spark, sf) -> DataFrame:
    """Every held-out claim against every evidence pipeline: the label expected and the verdict that the pipeline gives."""
    plan = EvidencePlan(spark, sf)
    plan.variant_hits()  # one search serves both pipelines
    verdicts = [v.select(F.col("qid").alias("doc_id"), F.lit(m).alias("model"), F.col("verdict").alias("predicted"))
                for m, v in (("evidence", plan.plain_verdict()), ("expanded", plan.expanded_verdict()))]
    cases = plan.claim_labels.select("doc_id", F.col("label").alias("expected"), F.explode(F.array(F.lit("evidence"), F.lit("expanded"))).alias("model"))
    return cases.join(verdicts[0].unionByName(verdicts[1]), ["doc_id", "model"], "left").withColumn(
        "passed", F.col("predicted").eqNullSafe(F.col("expected")))


@register("case_model_grid", _VERDICTS + _GRID_SQL + """
SELECT doc_id, model, expected, predicted, predicted = expected AS passed FROM grid""")
def case_model_grid(spark, sf):
    """Golden cases x models: every held-out claim with the verdict of every evidence pipeline, and pass / fail."""
    return _case_grid(spark, sf).select("doc_id", "model", "expected", "predicted", "passed")


@register("case_pass_rate", _VERDICTS + _GRID_SQL + f"""
SELECT coalesce(model, 'ALL') AS model, coalesce(expected, 'ALL') AS expected,
       CAST(sum(CASE WHEN predicted = expected THEN 1 ELSE 0 END) AS BIGINT) AS passed, count(*) AS total,
       {Q.r6('CAST(sum(CASE WHEN predicted = expected THEN 1 ELSE 0 END) AS DOUBLE) / count(*)')} AS pass_rate
FROM grid GROUP BY ROLLUP (model, expected)""")
def case_pass_rate(spark, sf):
    return M.pass_rate(_case_grid(spark, sf), "passed", ("model", "expected"))


@register("case_result_lines", _VERDICTS + _GRID_SQL + """,
num AS (SELECT *, row_number() OVER (ORDER BY model, doc_id) AS ord FROM grid)
SELECT CASE WHEN predicted = expected THEN 'PASSED' ELSE 'FAILED' END || ' - ' || model || '[' || doc_id || ']' AS line, 1 AS n FROM num
UNION ALL SELECT '', 1
UNION ALL SELECT sum(CASE WHEN predicted = expected THEN 1 ELSE 0 END) || '/' || count(*) || ' passed', 1 FROM num""")
def case_result_lines(spark, sf):
    """The result file of the golden cases, written in order to the shared folder and read back."""
    cases = S.seeded_shuffle(_case_grid(spark, sf).withColumn("case_name", F.concat("model", F.lit("["), F.col("doc_id").cast("string"), F.lit("]"))),
                             "case_name", name="ord")
    path = scratch_path(spark, "case-results")
    SK.write_lines(SK.pass_rate_lines(write_table(cases.select("ord", "case_name", "passed"), "cases")), path)
    return spark.read.text(path).select(F.col("value").alias("line"), F.lit(1).alias("n"))


# ---------------------------------------------------------------- hooks

def long_word_evidence(queries: DataFrame, evidence: DataFrame, k: int = 5, least: int = 9) -> DataFrame:
    """An evidence function of its own: documents that share most distinct words of ``least`` and more characters with the query."""
    long_words = lambda c: F.array_distinct(F.filter(word_tokens(c), lambda w: F.length(w) >= least))
    key = lambda c: F.col(c).cast("long").alias(c)
    q = exploded(queries.where("qid is not null"), [key("qid"), key("ord")], long_words("query"), "term")
    d = evidence.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc"), long_words("text").alias("_w"))
    d = exploded(d.withColumn("dl", F.size("_w")), ["doc", "dl"], "_w", "term")
    # every shared word counts the same: a search whose postings all weigh a million, never all pairs that share a word
    return R.search_terms(q, write_table(d, "long-words"), F.lit(1000000), k).select("qid", "ord", "doc", "score_units", "rank")


@register("evidence_hook", Q.with_(Q.LABELED, Q.SPLIT, Q.CLAIMS, f"""
lq AS (SELECT DISTINCT doc_id AS qid, w FROM (SELECT doc_id, unnest(regexp_extract_all(lower(headline), '{RE}')) AS w FROM claims) WHERE length(w) >= 9),
ld AS (SELECT DISTINCT doc_id AS doc, w FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '{RE}')) AS w FROM evidence) WHERE length(w) >= 9),
lh AS (SELECT qid, doc, count(*) * 1000000 AS score_units FROM lq JOIN ld USING (w) GROUP BY qid, doc),
hh AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score_units DESC, doc) AS rank FROM lh) WHERE rank <= 5)""",
                                   shares_sql("hh", "sh"), verdict_sql("sh", "vh")) + f"""
SELECT doc_id, verdict, {Q.r6('confidence_score')} AS confidence_score, reasoning, array_to_string(sources, ',') AS sources, n_hits FROM vh""")
def evidence_hook(spark, sf):
    """The verdicts with a user's evidence function in place of BM25."""
    v = EvidencePlan(spark, sf, evidence_fn=long_word_evidence).plain_verdict()
    return v.select(F.col("qid").alias("doc_id"), "verdict", round6("confidence_score").alias("confidence_score"),
                    "reasoning", F.array_join("sources", ",").alias("sources"), "n_hits")


def _sample_verdicts(requests):
    """The example verdict function of ``verdict_hook``: reads ``id:text``, fails on some ids, answers broken JSON on others."""
    out = []
    for request in requests:
        key, _, text = request.partition(":")
        if int(key) % 7 == 3:
            raise ValueError(f"no answer for {key}")
        body = f'{{"verdict": "{LABELS[int(key) % 3]}", "confidence_score": 0.{90 + len(text) % 10}, "reasoning": "sample", "sources": []'
        out.append(body if int(key) % 11 == 5 else body + "}")
    return out


@register("verdict_hook", Q.with_(Q.LABELED, Q.PREDS, f"""
hook AS (SELECT p.doc_id, base_label, base_confidence, p.doc_id % 7 = 3 AS failed, p.doc_id % 7 = 3 OR p.doc_id % 11 = 5 AS bad,
    {Q.LABEL_LIST}[p.doc_id % 3 + 1] AS evidence_label, (90 + length(l.text) % 10) / 100.0E0 AS evidence_confidence
  FROM preds p JOIN labeled l USING (doc_id))""") + f"""
SELECT doc_id, CASE WHEN bad THEN 'evidence_error' ELSE 'ok' END AS status, CASE WHEN NOT bad THEN evidence_label END AS verdict,
  failed, CAST(CASE WHEN failed THEN 3 ELSE 0 END AS INTEGER) AS failed_attempts, CASE WHEN bad THEN base_label ELSE {Q.final_label()} END AS final_label
FROM hook""")
def verdict_hook(spark, sf):
    """A user's verdict function over all labelled texts: failing rows fail alone and fall back to the base prediction."""
    rows = V.with_preds(V.labeled(spark, sf)).select("doc_id", "base_label", "base_confidence", F.concat_ws(":", "doc_id", "text").alias("prompt"))
    got = VD.apply_verdict_fn(rows, _sample_verdicts).select(
        "doc_id", "base_label", "base_confidence", "verdict_error", "attempts", F.col("report.verdict").alias("evidence_label"),
        F.col("report.confidence_score").alias("evidence_confidence"), F.lit(True).alias("use_evidence"), F.lit(True).alias("evidence_available"))
    failed = F.col("verdict_error").isNotNull()
    return C.score_with_status(got).select("doc_id", "status", F.col("evidence_label").alias("verdict"), failed.alias("failed"),
                                           F.when(failed, F.col("attempts")).otherwise(0).alias("failed_attempts"), "final_label")


@register("render_prompt", f"""
SELECT conv_id, turn,
  'Assess the claim below with one of three labels: true (reliable evidence supports it), '
  || 'mixed (partly true, unclear, or sources disagree) or false (evidence refutes it).' || chr(10)
  || 'Classifier label: ' || {Q.decode(Q.h('p', 'conv_id') + ' % 3')} || chr(10) || 'Classifier confidence: '
  || CASE WHEN {Q.h('p', 'conv_id', 9)} % 10 = 0 THEN 'not available'
          ELSE {Q.fixed(f"({Q.h('p', 'conv_id', 17)} % 10000) / 10000.0E0", 4)} END || chr(10)
  || 'When the evidence is incomplete or conflicting, answer mixed.' || chr(10) || 'Claim: ' || text AS prompt
FROM conversations WHERE role = 'user'""")
def render_prompt(spark, sf):
    """A verdict request per user turn, with a (synthetic) base label and confidence."""
    c = read_table(spark, sf, "conversations", ["conv_id", "turn", "role", "text"]).filter(F.col("role") == "user")
    lab = V.decode_label(hash_int(F.lit("p"), F.col("conv_id")) % 3)
    conf = F.when(hash_int(F.lit("p"), F.col("conv_id"), pos=9) % 10 == 0, F.lit(None).cast("double")) \
        .otherwise((hash_int(F.lit("p"), F.col("conv_id"), pos=17) % 10000) / F.lit(10000.0))
    return c.select("conv_id", "turn", VD.render_prompt(F.col("text"), lab, conf).alias("prompt"))


def _verdict_json_sql() -> str:
    conf = (f"CASE WHEN {Q.h('j', pos=17)} % 9 = 0 THEN evidence_confidence * 1.2E0 "
            "ELSE evidence_confidence END")
    body = (f"'{{\"verdict\": \"' || CASE WHEN {Q.h('j', pos=9)} % 7 = 0 THEN 'unsure' ELSE evidence_label END "
            f"|| '\", \"confidence_score\": ' || {Q.fixed(conf, 4)} "
            "|| ', \"reasoning\": \"rule\", \"sources\": [\"doc:' || CAST(doc_id AS VARCHAR) || '\"]'")
    return f"CASE WHEN {Q.h('j')} % 11 = 0 THEN {body} ELSE {body} || '}}' END"


@register("parse_verdict", Q.with_(Q.LABELED, Q.PREDS, f"""vj AS (SELECT doc_id, {_verdict_json_sql()} AS j
  FROM preds WHERE evidence_label IS NOT NULL)""") + """
SELECT doc_id,
       CASE WHEN json_valid(j) AND json_extract_string(j, '$.verdict') IN ('false', 'mixed', 'true')
            THEN json_extract_string(j, '$.verdict') END AS verdict,
       CASE WHEN json_valid(j) THEN CAST(json_extract_string(j, '$.confidence_score') AS DOUBLE) END
         AS confidence_score,
       CASE WHEN json_valid(j) THEN CAST(json_extract_string(j, '$.confidence_score') AS DOUBLE) BETWEEN 0 AND 1 END
         AS in_range,
       CASE WHEN json_valid(j) THEN CAST(json_array_length(j, '$.sources') AS INTEGER) END AS n_sources
FROM vj""")
def parse_verdict(spark, sf):
    """Validate structured verdicts; some are malformed, out of the label set or above 1 on purpose."""
    p = V.preds(spark, sf).filter(F.col("evidence_label").isNotNull())
    conf = F.when(hash_int(F.lit("j"), F.col("doc_id"), pos=17) % 9 == 0, F.col("evidence_confidence") * F.lit(1.2)) \
        .otherwise(F.col("evidence_confidence"))
    label = F.when(hash_int(F.lit("j"), F.col("doc_id"), pos=9) % 7 == 0, F.lit("unsure")) \
        .otherwise(F.col("evidence_label"))
    body = F.concat(F.lit('{"verdict": "'), label, F.lit('", "confidence_score": '), fixed(conf, 4),
                    F.lit(', "reasoning": "rule", "sources": ["doc:'), F.col("doc_id").cast("string"), F.lit('"]'))
    j = F.when(hash_int(F.lit("j"), F.col("doc_id")) % 11 == 0, body).otherwise(F.concat(body, F.lit("}")))
    parsed = p.select("doc_id", VD.parse_verdict(j).alias("v"))
    return parsed.select("doc_id", "v.verdict", "v.confidence_score", "v.in_range",
                         F.size("v.sources").alias("n_sources"))
