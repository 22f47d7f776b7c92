"""Registered queries: one Spark plan per operator, plus its SQL oracle.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLE[name] -> str``.
A key without an oracle entry is checked on row counts only (model training,
streaming) and is covered by in-repo tests instead.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimlens.constants import LABELS, PER_LABEL, SEED
from claimlens.functions.labels import collapse_label, decode_label, display_label, encode_label
from claimlens.functions.numeric import argmax_index, hash_int, round6, softmax
from claimlens.operators import combine as C
from claimlens.operators import metrics as M
from claimlens.operators import splits as S
from claimlens.operators import training as TR
from claimlens.operators.guard import guard_texts
from claimlens.plans import sqlparts as Q
from claimlens.plans import views as V
from claimlens.session import write_table
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


# ---------------------------------------------------------------- corpus / sources

@register("corpus_with_provenance", Q.with_(Q.LABELED, Q.fine_source()) + """
SELECT doc_id, fine_label_id, label, source, split, CAST(length(text) AS INTEGER) AS n_chars FROM fine_src""")
def corpus_with_provenance(spark, sf):
    return V.fine_grained_source(spark, sf).select(
        "doc_id", "fine_label_id", "label", "source", "split", F.length("text").alias("n_chars"))


@register("corpus_union", Q.with_(Q.LABELED, Q.fine_source()) + """
SELECT doc_id, label, source, split, CAST(length(text) AS INTEGER) AS n_chars FROM corpus""")
def corpus_union(spark, sf):
    return V.corpus(spark, sf).select("doc_id", "label", "source", "split", F.length("text").alias("n_chars"))


@register("drop_null_text", Q.with_(Q.LABELED, Q.fine_source()) + """
SELECT doc_id, label, source FROM corpus WHERE text IS NOT NULL""")
def drop_null_text(spark, sf):
    return V.corpus(spark, sf).na.drop(subset=["text"]).select("doc_id", "label", "source")


@register("source_counts", Q.with_(Q.LABELED, Q.fine_source()) + """
SELECT coalesce(source, 'ALL') AS source, count(*) AS n_rows, count(text) AS n_kept
FROM corpus GROUP BY ROLLUP (source)""")
def source_counts(spark, sf):
    """Rows per source before the null-text drop, and kept rows; ``ALL`` is the total."""
    return (V.corpus(spark, sf).rollup("source")
            .agg(F.count(F.lit(1)).alias("n_rows"), F.count("text").alias("n_kept"))
            .withColumn("source", F.coalesce("source", F.lit("ALL"))))


@register("label_distribution", Q.with_(Q.LABELED, Q.fine_source()) + """
SELECT label, count(*) AS n FROM corpus WHERE text IS NOT NULL GROUP BY label""")
def label_distribution(spark, sf):
    return (V.corpus(spark, sf).na.drop(subset=["text"]).groupBy("label")
            .agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "label"))


# ---------------------------------------------------------------- labels

# Demonstration mapping (ours): five order priorities to three classes;
# '4-NOT SPECIFIED' is deliberately unmapped and must come out null.
PRIORITY_TO_LABEL = {"1-URGENT": "false", "2-HIGH": "false", "3-MEDIUM": "mixed", "5-LOW": "true"}


@register("label_collapse", """
SELECT o_orderpriority,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'false' WHEN '2-HIGH' THEN 'false'
            WHEN '3-MEDIUM' THEN 'mixed' WHEN '5-LOW' THEN 'true' END AS label,
       count(*) AS n
FROM orders GROUP BY ALL""")
def label_collapse(spark, sf):
    o = read_table(spark, sf, "orders", ["o_orderpriority"])
    return (o.select("o_orderpriority", collapse_label("o_orderpriority", PRIORITY_TO_LABEL).alias("label"))
            .groupBy("o_orderpriority", "label").agg(F.count(F.lit(1)).alias("n")))


@register("label_encode", Q.with_(Q.LABELED) + f"""
SELECT doc_id, label, CAST(list_position({Q.LABEL_LIST}, label) - 1 AS INTEGER) AS label_id FROM labeled""")
def label_encode(spark, sf):
    return V.labeled(spark, sf).select("doc_id", "label", encode_label("label").alias("label_id"))


_DECODE_ID = f"CAST({Q.h('d')} % 4 AS INTEGER)"


@register("label_decode", Q.with_(Q.LABELED) + f"""
SELECT doc_id, {_DECODE_ID} AS label_id,
       CASE WHEN {_DECODE_ID} < 3 THEN {Q.LABEL_LIST}[{_DECODE_ID} + 1]
            ELSE CAST({_DECODE_ID} AS VARCHAR) END AS label_name
FROM labeled""")
def label_decode(spark, sf):
    lid = (hash_int(F.lit("d"), F.col("doc_id")) % 4).cast("int")
    return V.labeled(spark, sf).select("doc_id", lid.alias("label_id"), decode_label(lid).alias("label_name"))


@register("display_label", Q.with_(Q.LABELED) + f"""
SELECT doc_id, label_name,
       CASE label_name WHEN 'true' THEN 'TRUE' WHEN 'mixed' THEN 'MIXED' WHEN 'false' THEN 'FALSE'
            ELSE label_name END AS display
FROM (SELECT doc_id, CASE WHEN {_DECODE_ID} < 3 THEN {Q.LABEL_LIST}[{_DECODE_ID} + 1]
                          ELSE CAST({_DECODE_ID} AS VARCHAR) END AS label_name FROM labeled)""")
def display_label_q(spark, sf):
    d = label_decode(spark, sf)
    return d.select("doc_id", "label_name", display_label("label_name", C.DISPLAY).alias("display"))


# ---------------------------------------------------------------- guards / limits

@register("headline_guard", r"""
SELECT conv_id, turn,
       CASE WHEN text IS NULL OR regexp_replace(text, '^[\s\x0B\x1C-\x1F\x{85}\p{Z}]+|[\s\x0B\x1C-\x1F\x{85}\p{Z}]+$', '', 'g') = '' THEN 'empty' ELSE 'ok' END AS status,
       CAST(length(regexp_replace(text, '^[\s\x0B\x1C-\x1F\x{85}\p{Z}]+|[\s\x0B\x1C-\x1F\x{85}\p{Z}]+$', '', 'g')) AS INTEGER) AS headline_len
FROM conversations""")
def headline_guard(spark, sf):
    """Strip the text; empty (or missing) texts get status ``empty`` instead of a prediction."""
    c = guard_texts(read_table(spark, sf, "conversations", ["conv_id", "turn", "text"]))
    return c.select("conv_id", "turn", "status", F.length("text").alias("headline_len"))


LIMIT_ROWS = 25


@register("limit_rows", Q.with_(Q.LABELED, Q.SPLIT, Q.CLAIMS) + f"""
SELECT doc_id, label FROM claims ORDER BY doc_id LIMIT {LIMIT_ROWS}""")
def limit_rows(spark, sf):
    """The first n claims; Spark has no row order, so the key orders them."""
    return V.claims(spark, sf).select("doc_id", "label").orderBy("doc_id").limit(LIMIT_ROWS)


# ---------------------------------------------------------------- splits and samples

@register("stratified_split", Q.with_(Q.LABELED, Q.SPLIT) + "SELECT doc_id, label, split FROM split")
def stratified_split(spark, sf):
    return V.split_keys(spark, sf).select("doc_id", "label", "split")


@register("three_way_split", Q.with_(
    Q.LABELED, Q.SPLIT,
    "rest AS (SELECT doc_id, text, label FROM split WHERE split = 'train')",
    Q.split_ctes("rest", "split2", 0.25, SEED, "validation", ("train", "validation"))) + """
SELECT doc_id, label, split FROM split2
UNION ALL SELECT doc_id, label, split FROM split WHERE split = 'test'""")
def three_way_split(spark, sf):
    return S.three_way_split(V.labeled_keys(spark, sf)).select("doc_id", "label", "split")


@register("balanced_sample", Q.with_(Q.LABELED, Q.SPLIT, Q.CLAIMS) + f"""
SELECT doc_id, label, row_number() OVER (ORDER BY {Q.h(f'{SEED}:shuffle')}, doc_id) AS ord
FROM (SELECT doc_id, label,
             row_number() OVER (PARTITION BY label ORDER BY {Q.h(f'{SEED}:sample')}, doc_id) AS rn
      FROM claims) WHERE rn <= {PER_LABEL}""")
def balanced_sample(spark, sf):
    """n held-out claims per label, then shuffled and numbered with the same seed."""
    sample = S.balanced_sample(V.claims(spark, sf).select("doc_id", "label"), PER_LABEL)
    return S.seeded_shuffle(sample).select("doc_id", "label", "ord")


@register("seeded_shuffle", Q.with_(Q.LABELED) + f"""
SELECT doc_id, row_number() OVER (ORDER BY {Q.h(f'{SEED}:shuffle')}, doc_id) AS ord FROM labeled""")
def seeded_shuffle(spark, sf):
    return S.seeded_shuffle(V.labeled(spark, sf).select("doc_id")).select("doc_id", "ord")


@register("heldout_only", Q.with_(Q.LABELED, Q.SPLIT, Q.CLAIMS) + """
SELECT c.doc_id, c.label FROM claims c WHERE NOT EXISTS (SELECT 1 FROM evidence e WHERE e.text = c.text)""")
def heldout_only(spark, sf):
    """Held-out claims whose exact text never occurs among the training rows (the split is decided and written once)."""
    split = V.split_labeled(spark, sf, write_table(V.split_keys(spark, sf), "split-keys"))
    return S.heldout_by_text(V.claims(spark, sf, split), V.evidence(spark, sf, split)).select("doc_id", "label")


@register("class_weights", Q.with_(Q.LABELED, Q.SPLIT) + f"""
SELECT label, n_label, {Q.r6('CAST(sum(n_label) OVER () AS DOUBLE) / CAST(count(*) OVER () * n_label AS DOUBLE)')}
       AS weight
FROM (SELECT label, count(*) AS n_label FROM split WHERE split = 'train' GROUP BY label)""")
def class_weights(spark, sf):
    train = V.split_labeled(spark, sf).filter(F.col("split") == "train")
    return S.class_weights(train).withColumn("weight", round6("weight"))


# ---------------------------------------------------------------- metrics

def _preds(spark, sf):
    return V.preds(spark, sf)


@register("gold_pred_join", Q.with_(Q.LABELED) + f"""
SELECT g.doc_id, g.label AS gold, p.pred FROM labeled g
JOIN (SELECT doc_id, {Q.decode(Q.h('p') + ' % 3')} AS pred FROM labeled) p USING (doc_id)""")
def gold_pred_join(spark, sf):
    """Gold and prediction tables aligned by key (never by position)."""
    gold = V.labeled(spark, sf).select("doc_id", F.col("label").alias("gold"))
    pred = read_table(spark, sf, "labels", ["doc_id"]).select(
        "doc_id", V.model_preds(None, "p").alias("pred"))
    return gold.join(pred, "doc_id")


@register("accuracy", Q.with_(Q.LABELED, Q.PREDS) + f"""
SELECT {Q.r6('avg(CASE WHEN gold = base_label THEN 1.0E0 ELSE 0.0E0 END)')} AS accuracy, count(*) AS n FROM preds""")
def accuracy(spark, sf):
    return M.accuracy(_preds(spark, sf), "gold", "base_label")


def _class_sql(src: str, gold: str = "gold", pred: str = "pred", by: str = "") -> str:
    """Per-class tp / gold / pred counts in long form."""
    sel_by = f"{by}, " if by else ""
    return f"""cls AS (SELECT * FROM (VALUES ('false', 0), ('mixed', 1), ('true', 2)) t(label, idx)),
cnt AS (SELECT {sel_by}c.label, c.idx,
          CAST(sum(CASE WHEN s.{gold} = c.label AND s.{pred} = c.label THEN 1 ELSE 0 END) AS BIGINT) AS tp,
          CAST(sum(CASE WHEN s.{gold} = c.label THEN 1 ELSE 0 END) AS BIGINT) AS gp,
          CAST(sum(CASE WHEN s.{pred} = c.label THEN 1 ELSE 0 END) AS BIGINT) AS pp,
          count(*) AS n, CAST(sum(CASE WHEN s.{gold} = s.{pred} THEN 1 ELSE 0 END) AS BIGINT) AS correct
        FROM {src} s, cls c GROUP BY {sel_by}c.label, c.idx),
stat AS (SELECT *, CASE WHEN pp > 0 THEN CAST(tp AS DOUBLE) / pp ELSE 0.0E0 END AS p,
                   CASE WHEN gp > 0 THEN CAST(tp AS DOUBLE) / gp ELSE 0.0E0 END AS r,
                   CASE WHEN gp + pp > 0 THEN CAST(2 * tp AS DOUBLE) / (gp + pp) ELSE 0.0E0 END AS f
         FROM cnt)"""


def _wide3(col: str, by: str = "") -> str:
    """``v0 + v1 + v2`` summed left to right in class order, grouped by ``by``."""
    return (f"(((0.0E0 + max(CASE WHEN idx = 0 THEN {col} END)) + max(CASE WHEN idx = 1 THEN {col} END)) "
            f"+ max(CASE WHEN idx = 2 THEN {col} END))")


@register("classification_report", Q.with_(
    Q.LABELED, Q.PREDS, "pp0 AS (SELECT gold, base_label AS pred FROM preds)", _class_sql("pp0")) + f"""
SELECT label, {Q.r6('p')} AS precision, {Q.r6('r')} AS recall, {Q.r6('f')} AS f1, gp AS support FROM stat
UNION ALL
SELECT 'macro avg', {Q.r6(_wide3('p') + ' / 3.0E0')}, {Q.r6(_wide3('r') + ' / 3.0E0')},
       {Q.r6(_wide3('f') + ' / 3.0E0')}, CAST(sum(gp) AS BIGINT) FROM stat
UNION ALL
SELECT 'weighted avg', {Q.r6(_wide3('p * gp') + ' / sum(gp)')}, {Q.r6(_wide3('r * gp') + ' / sum(gp)')},
       {Q.r6(_wide3('f * gp') + ' / sum(gp)')}, CAST(sum(gp) AS BIGINT) FROM stat""")
def classification_report(spark, sf):
    return M.classification_report(_preds(spark, sf), "gold", "base_label")


def _macro_sql(by: str = "") -> str:
    grp = f"GROUP BY {by}" if by else ""
    sel = f"{by}, " if by else ""
    present = "(gp + pp > 0)"
    npres = f"(0 + max(CASE WHEN idx = 0 AND {present} THEN 1 ELSE 0 END) + max(CASE WHEN idx = 1 AND {present} THEN 1 ELSE 0 END) + max(CASE WHEN idx = 2 AND {present} THEN 1 ELSE 0 END))"
    def mean(c):
        return Q.r6(f"({_wide3(f'CASE WHEN {present} THEN {c} ELSE 0.0E0 END')}) / {npres}")
    return f"""SELECT {sel}{Q.r6('CAST(max(correct) AS DOUBLE) / max(n)')} AS accuracy,
       {mean('p')} AS precision, {mean('r')} AS recall, {mean('f')} AS f1, max(n) AS n
FROM stat {grp}"""


@register("macro_scores", Q.with_(
    Q.LABELED, Q.PREDS, "pp0 AS (SELECT gold, base_label AS pred FROM preds)", _class_sql("pp0")) + _macro_sql())
def macro_scores(spark, sf):
    return M.macro_scores(_preds(spark, sf), "gold", "base_label")


@register("micro_weighted_scores", Q.with_(
    Q.LABELED, Q.PREDS, "pp0 AS (SELECT gold, base_label AS pred FROM preds)", _class_sql("pp0")) + f"""
SELECT 'micro' AS average, {Q.r6('CAST(sum(tp) AS DOUBLE) / sum(pp)')} AS precision,
       {Q.r6('CAST(sum(tp) AS DOUBLE) / sum(gp)')} AS recall,
       {Q.r6('CAST(2 * sum(tp) AS DOUBLE) / (sum(gp) + sum(pp))')} AS f1 FROM stat
UNION ALL
SELECT 'weighted', {Q.r6(_wide3('p * gp') + ' / sum(gp)')}, {Q.r6(_wide3('r * gp') + ' / sum(gp)')},
       {Q.r6(_wide3('f * gp') + ' / sum(gp)')} FROM stat""")
def micro_weighted_scores(spark, sf):
    return M.micro_weighted_scores(_preds(spark, sf), "gold", "base_label")


@register("confusion_matrix", Q.with_(Q.LABELED, Q.PREDS) + """
SELECT c.label AS gold, c.idx AS gold_idx,
       CAST(sum(CASE WHEN p.base_label = 'false' THEN 1 ELSE 0 END) AS BIGINT) AS pred_false,
       CAST(sum(CASE WHEN p.base_label = 'mixed' THEN 1 ELSE 0 END) AS BIGINT) AS pred_mixed,
       CAST(sum(CASE WHEN p.base_label = 'true' THEN 1 ELSE 0 END) AS BIGINT) AS pred_true
FROM (VALUES ('false', 0), ('mixed', 1), ('true', 2)) c(label, idx) LEFT JOIN preds p ON p.gold = c.label
GROUP BY c.label, c.idx""")
def confusion_matrix(spark, sf):
    return M.confusion_matrix(_preds(spark, sf), "gold", "base_label")


LEADERBOARD_MODELS = ["p", "q"]


@register("model_leaderboard", Q.with_(
    Q.LABELED,
    "long AS (" + " UNION ALL ".join(
        f"SELECT '{m}' AS model, doc_id, label AS gold, {Q.decode(Q.h(m) + ' % 3')} AS pred FROM labeled"
        for m in LEADERBOARD_MODELS) + ")",
    _class_sql("long", by="model")) + _macro_sql("model"))
def model_leaderboard(spark, sf):
    lab = V.labeled(spark, sf).select("doc_id", F.col("label").alias("gold"))
    long = lab.select("doc_id", "gold", F.explode(F.array(*[F.lit(m) for m in LEADERBOARD_MODELS])).alias("model"))
    long = long.withColumn("pred", decode_label(hash_int(F.col("model"), F.col("doc_id")) % 3))
    return M.leaderboard(long)


@register("chance_control", Q.with_(
    Q.LABELED,
    f"""maj AS (SELECT label FROM labeled GROUP BY label
               ORDER BY count(*) DESC, {Q.LABEL_ORDER.format(c='label')}, label LIMIT 1),
long AS (SELECT 'random' AS model, doc_id, label AS gold, {Q.decode(Q.h(f'{SEED}:random') + ' % 3')} AS pred
         FROM labeled
         UNION ALL SELECT 'majority', doc_id, label, (SELECT label FROM maj) FROM labeled)""",
    _class_sql("long", by="model")) + _macro_sql("model"))
def chance_control(spark, sf):
    """Seeded random class and majority class, scored like any model."""
    lab = V.labeled(spark, sf).select("doc_id", F.col("label").alias("gold"))
    majority = (lab.groupBy("gold").agg(F.count(F.lit(1)).alias("n"))
                .orderBy(F.desc("n"), S._label_rank(F.col("gold")), "gold").limit(1).select("gold").scalar())
    rnd = lab.select(F.lit("random").alias("model"), "doc_id", "gold",
                     decode_label(hash_int(F.lit(f"{SEED}:random"), F.col("doc_id")) % 3).alias("pred"))
    maj = lab.select(F.lit("majority").alias("model"), "doc_id", "gold", majority.alias("pred"))
    return M.leaderboard(rnd.unionByName(maj))


# ---------------------------------------------------------------- merge and overrides

def _final(df):
    return df.withColumn("final_label", C.combine_predictions(
        "base_label", "base_confidence", "evidence_label", "evidence_confidence"))


@register("combine_predictions", Q.with_(Q.LABELED, Q.PREDS) + f"""
SELECT doc_id, {Q.merge_rule()} AS rule, {Q.final_label()} AS final_label FROM preds""")
def combine_predictions(spark, sf):
    p = _preds(spark, sf)
    return _final(p).select("doc_id", C.merge_rule("base_label", "base_confidence", "evidence_label",
                                                   "evidence_confidence").alias("rule"), "final_label")


@register("override_transitions", Q.with_(Q.LABELED, Q.PREDS) + f"""
SELECT base_label, final_label, count(*) AS n
FROM (SELECT base_label, {Q.final_label()} AS final_label FROM preds)
WHERE base_label <> final_label GROUP BY ALL""")
def override_transitions(spark, sf):
    return M.override_transitions(_final(_preds(spark, sf)))


@register("override_impact", Q.with_(Q.LABELED, Q.PREDS) + f"""
SELECT CAST(sum(CASE WHEN f <> b AND b <> gold AND f = gold THEN 1 ELSE 0 END) AS BIGINT) AS corrected,
       CAST(sum(CASE WHEN f <> b AND b = gold AND f <> gold THEN 1 ELSE 0 END) AS BIGINT) AS worsened,
       CAST(sum(CASE WHEN f = b AND f = gold THEN 1 ELSE 0 END) AS BIGINT) AS unchanged_correct,
       CAST(sum(CASE WHEN f = b AND f <> gold THEN 1 ELSE 0 END) AS BIGINT) AS unchanged_wrong,
       CAST(sum(CASE WHEN f <> b AND b <> gold AND f <> gold THEN 1 ELSE 0 END) AS BIGINT) AS changed_still_wrong,
       count(*) AS n
FROM (SELECT gold, base_label AS b, {Q.final_label()} AS f FROM preds)""")
def override_impact(spark, sf):
    return M.override_impact(_final(_preds(spark, sf)))


def _status_input(spark, sf):
    """Preds plus a request flag and a raw verdict whose confidence is sometimes out of range."""
    p = _preds(spark, sf)
    scaled = F.when(hash_int(F.lit("z"), F.col("doc_id")) % 17 == 0, F.col("evidence_confidence") * F.lit(1.25)) \
        .otherwise(F.col("evidence_confidence"))
    return p.select("doc_id", "base_label", "base_confidence", "evidence_label",
                    scaled.alias("evidence_confidence"),
                    (hash_int(F.lit("r"), F.col("doc_id")) % 5 != 0).alias("use_evidence"),
                    F.col("evidence_label").isNotNull().alias("evidence_available"))


@register("score_with_status", Q.with_(Q.LABELED, Q.PREDS, f"""si AS (
  SELECT doc_id, base_label, base_confidence, evidence_label,
         CASE WHEN {Q.h('z')} % 17 = 0 THEN evidence_confidence * 1.25E0 ELSE evidence_confidence END
           AS evidence_confidence,
         {Q.h('r')} % 5 <> 0 AS use_evidence, evidence_label IS NOT NULL AS evidence_available FROM preds),
st AS (SELECT *, CASE WHEN NOT use_evidence THEN 'base_only'
                      WHEN NOT evidence_available THEN 'evidence_unavailable'
                      WHEN evidence_label NOT IN ('false', 'mixed', 'true') OR evidence_confidence IS NULL
                           OR evidence_confidence < 0 OR evidence_confidence > 1 THEN 'evidence_error'
                      ELSE 'ok' END AS status FROM si)""") + f"""
SELECT doc_id, status,
       CASE base_label WHEN 'true' THEN 'TRUE' WHEN 'mixed' THEN 'MIXED' WHEN 'false' THEN 'FALSE'
            ELSE base_label END AS display_label,
       CASE WHEN base_confidence IS NULL THEN 'N/A' ELSE {Q.fixed('base_confidence * 100.0E0', 1)} || '%' END
         AS confidence_text,
       CASE WHEN status = 'ok' THEN {Q.final_label()} ELSE base_label END AS final_label
FROM st""")
def score_with_status(spark, sf):
    return C.score_with_status(_status_input(spark, sf)).select(
        "doc_id", "status", "display_label", "confidence_text", "final_label")


# ---------------------------------------------------------------- training log (events)

_LOG_SQL = f"""ev AS (SELECT user_id AS run, value,
              row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS ord FROM events),
blog AS (SELECT run, CAST((ord - 1) // 4 + 1 AS BIGINT) AS epoch,
                CAST((ord - 1) % 4 + 1 AS BIGINT) AS batch, value / 100.0E0 AS loss,
                value FROM ev)"""


@register("epoch_loss", Q.with_(_LOG_SQL) + f"""
SELECT run, epoch, {Q.r6('avg(loss)')} AS mean_loss, count(*) AS n_batches FROM blog GROUP BY run, epoch""")
def epoch_loss(spark, sf):
    return TR.epoch_loss(TR.batch_log_from_events(read_table(spark, sf, "events",
                                                             ["event_id", "ts", "user_id", "value"])))


@register("early_stop", Q.with_(_LOG_SQL, """elog AS (
  SELECT run, epoch, floor(max(value) / 125.0E0) / 4.0E0 AS val_acc FROM blog
  GROUP BY run, epoch),
w AS (SELECT *, val_acc > coalesce(max(val_acc) OVER (PARTITION BY run ORDER BY epoch
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0E0) AS improved FROM elog),
w2 AS (SELECT *, epoch - coalesce(max(CASE WHEN improved THEN epoch END) OVER (PARTITION BY run ORDER BY epoch
                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS streak FROM w),
stop AS (SELECT run, coalesce(min(CASE WHEN streak >= 2 THEN epoch END), max(epoch)) AS stop_epoch,
                min(CASE WHEN streak >= 2 THEN epoch END) IS NOT NULL AS stopped_early
         FROM w2 GROUP BY run)""") + """
SELECT s.run, CAST(max(CASE WHEN w2.improved AND w2.epoch <= s.stop_epoch THEN w2.epoch END) AS BIGINT) AS best_epoch,
       max(CASE WHEN w2.epoch <= s.stop_epoch THEN w2.val_acc END) AS best_val_acc,
       CAST(s.stop_epoch AS BIGINT) AS stop_epoch, s.stopped_early
FROM stop s JOIN w2 USING (run) GROUP BY s.run, s.stop_epoch, s.stopped_early""")
def early_stop(spark, sf):
    ev = read_table(spark, sf, "events", ["event_id", "ts", "user_id", "value"])
    return TR.early_stop(TR.epoch_log_from_events(ev))


# ---------------------------------------------------------------- scores (arg-max, softmax)

def _logits(spark, sf):
    e = read_table(spark, sf, "embeddings", ["vec_id", "embedding"])
    return e.select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("logits"))


_SOFTMAX_SQL = """el AS (SELECT vec_id, CAST(unnest(embedding) AS DOUBLE) AS x, unnest(range(len(embedding))) AS k FROM embeddings),
ex AS (SELECT *, exp(x - max(x) OVER (PARTITION BY vec_id)) AS e FROM el),
sm AS (SELECT vec_id, k, x, e / sum(e) OVER (PARTITION BY vec_id) AS p FROM ex)"""


@register("softmax_scores", Q.with_(_SOFTMAX_SQL) + f"""
SELECT vec_id, k AS class, {Q.r6('p')} AS p FROM sm""")
def softmax_scores(spark, sf):
    """The probability of every class, over the whole vector."""
    p = _logits(spark, sf).select("vec_id", F.posexplode(softmax("logits")).alias("class", "p"))
    return p.select("vec_id", F.col("class").cast("bigint").alias("class"), round6(F.col("p")).alias("p"))


@register("argmax_label", Q.with_(_SOFTMAX_SQL) + f"""
SELECT vec_id, CASE k % 3 WHEN 0 THEN 'false' WHEN 1 THEN 'mixed' ELSE 'true' END AS label, k AS class,
       {Q.r6('p')} AS confidence
FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY x DESC, k) AS place FROM sm) WHERE place = 1""")
def argmax_label(spark, sf):
    """Class of the largest of all logits (first index wins ties), folded to a label, and its softmax probability."""
    lg = _logits(spark, sf).select("vec_id", "logits", softmax("logits").alias("p"))
    idx = argmax_index("logits")
    return lg.select("vec_id", decode_label(idx % 3).alias("label"), idx.cast("bigint").alias("class"),
                     round6(F.element_at("p", idx + 1)).alias("confidence"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load_more()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    _load_more()
    return dict(ORACLE)


def _load_more():
    # Importing these modules registers their queries.
    from claimlens.plans import catalog_text  # noqa: F401
    from claimlens.plans import catalog_evidence  # noqa: F401
    from claimlens.plans import catalog_models  # noqa: F401
    from claimlens.plans import catalog_files  # noqa: F401

