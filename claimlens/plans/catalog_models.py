"""Registered model queries (checked on row counts; see tests for invariants).

Trained models are kept per (Spark application, data directory), so that several keys share one fit, until
:func:`forget_models` (the benchmark calls it before every timed query).
"""

from __future__ import annotations

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from claimlens.constants import LABELS
from claimlens.functions.labels import decode_label
from claimlens.functions.numeric import argmax_index, round6
from claimlens.operators import linear as LN
from claimlens.operators import metrics as M
from claimlens.operators import models as ML
from claimlens.operators import splits as S
from claimlens.plans import sqlparts as Q
from claimlens.plans import views as V
from claimlens.plans.catalog import register
from claimlens.session import scratch_path, write_table
from claimlens.sources.tables import read_table
from claimlens.streaming.score import read_scored, scored_stream, start_scoring

MLP_SHAPES = {"mlp_64_32_3": [64, 32, 3], "mlp_64_16_3": [64, 16, 3]}
_MEMO: dict = {}


def _memo(spark, *key, fit):
    key = (spark.sparkContext.applicationId, *key)
    for old in [k for k in _MEMO if k[0] != key[0]]:
        del _MEMO[old]  # of an application that has ended
    if key not in _MEMO:
        _MEMO[key] = fit()
    return _MEMO[key]


def forget_models() -> None:
    _MEMO.clear()


def logreg_model(spark, sf, bigrams: bool = True) -> PipelineModel:
    def fit():
        train = V.split_labeled(spark, sf).filter(F.col("split") == "train").select("doc_id", "text", "label")
        return ML.train_logreg(train, bigrams=bigrams)
    return _memo(spark, sf, "logreg", bigrams, fit=fit)


def _test_rows(spark, sf):
    return V.split_labeled(spark, sf).filter(F.col("split") == "test").select("doc_id", "text", "label")


@register("train_logreg")
def train_logreg(spark, sf):
    """Fit on the training rows; report test metrics next to the chance controls."""
    model = logreg_model(spark, sf)
    pred = ML.predict(model, _test_rows(spark, sf), ["doc_id", "label"]).select(
        F.lit("tfidf_logreg").alias("model"), F.col("label").alias("gold"), "pred")
    return M.leaderboard(pred).withColumn("iterations", F.lit(ML.iterations(model)).cast("int"))


@register("predict_labels")
def predict_labels(spark, sf):
    return ML.predict(logreg_model(spark, sf), _test_rows(spark, sf), ["doc_id", "label"]).select(
        "doc_id", F.col("label").alias("gold"), "pred")


@register("predict_scores")
def predict_scores(spark, sf):
    p = ML.predict(logreg_model(spark, sf), _test_rows(spark, sf), ["doc_id"])
    return p.select("doc_id", "pred", round6("confidence").alias("confidence"),
                    *[round6(f"p_{c}").alias(f"p_{c}") for c in LABELS])


def _embedding_splits(spark, sf):
    emb = ML.embedding_frame(read_table(spark, sf, "embeddings", ["vec_id", "embedding", "label"]))
    return S.three_way_split(emb, key="vec_id", label="label")


def mlp_models(spark, sf):
    """Both shapes, trained from one written split."""
    def fit():
        parts = write_table(_embedding_splits(spark, sf).select("split", "features", "y"), "embedding-split")
        return ML.train_mlps(parts.filter(F.col("split") == "train"), parts.filter(F.col("split") == "validation"), MLP_SHAPES)
    return _memo(spark, sf, "mlp", fit=fit)


@register("train_mlp")
def train_mlp(spark, sf):
    """Two network shapes, epoch log with early stopping; the better validation accuracy wins."""
    results = mlp_models(spark, sf)
    rows = [(name, r.best_epoch, float(r.best_val_acc), epoch, float(acc))
            for name, r in results.items() for epoch, acc in r.log]
    log = spark.createDataFrame(rows, "model string, best_epoch int, best_val_acc double, epoch int, val_acc double")
    best = max(results, key=lambda n: (results[n].best_val_acc, n))
    return log.withColumn("selected", F.col("model") == F.lit(best))


@register("batch_score")
def batch_score(spark, sf):
    """Test embeddings scored by the selected network."""
    results = mlp_models(spark, sf)
    best = max(results, key=lambda n: (results[n].best_val_acc, n))
    test = _embedding_splits(spark, sf).filter(F.col("split") == "test").withColumn("gold", F.col("label"))
    return ML.score_network(results[best].model, test, ["vec_id", "gold"]).withColumn("confidence", round6("confidence"))


def _third_sums():
    """The example user function of ``callable_score``: the score of class c is the sum of every third number from c on."""
    return lambda x: np.stack([x[:, c::3].astype(np.float64).sum(1) for c in range(3)], axis=1)


@register("callable_score", """
WITH s AS (SELECT vec_id, list_transform([0, 1, 2], lambda c: list_sum(list_transform(list_filter(range(0, 64), lambda i: i % 3 = c),
    lambda i: CAST(embedding[i + 1] AS DOUBLE)))) AS p FROM embeddings)
SELECT vec_id, ['false', 'mixed', 'true'][list_position(p, list_max(p))] AS pred, floor(list_max(p) * 1000000.0E0 + 0.5E0) / 1000000.0E0 AS score
FROM s""")
def callable_score(spark, sf):
    """Every embedding scored by a user's function in Arrow batches (the model-callable hook)."""
    scorer = ML.callable_scorer(_third_sums, 64)
    p = read_table(spark, sf, "embeddings", ["vec_id", "embedding"]).select("vec_id", scorer(F.col("embedding")).alias("p"))
    return p.select("vec_id", decode_label(argmax_index("p")).alias("pred"), round6(F.array_max("p")).alias("score"))


@register("model_dispatch")
def model_dispatch(spark, sf):
    """Score held-out claims with models chosen by name; output is long with a ``model`` column."""
    reg = ML.ModelRegistry()
    reg.register("tfidf_logreg", logreg_model(spark, sf, True))
    reg.register("tfidf_logreg_unigram", logreg_model(spark, sf, False))
    return reg.score(_test_rows(spark, sf), ["tfidf_logreg", "tfidf_logreg_unigram"], ["doc_id", "label"]) \
        .select("model", "doc_id", F.col("label").alias("gold"), "pred")


@register("model_roundtrip")
def model_roundtrip(spark, sf):
    """Save the fitted pipeline to the shared folder, load it back and score with the copy."""
    path = scratch_path(spark, "model")
    logreg_model(spark, sf).write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    return ML.predict(loaded, _test_rows(spark, sf), ["doc_id"]).select("doc_id", "pred")


@register("stream_score")
def stream_score(spark, sf):
    """Held-out claims arrive as files; a streaming query scores them with the saved model."""
    model_path = scratch_path(spark, "stream-model")
    logreg_model(spark, sf).write().overwrite().save(model_path)
    source = scratch_path(spark, "stream-in")
    _test_rows(spark, sf).select("doc_id", "text").repartition(4).write.parquet(source)
    sink, ckpt = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-ckpt")
    q = start_scoring(spark, model_path, source, sink, ckpt, available_now=True)
    q.awaitTermination()
    return read_scored(spark, sink)


# ---------------------------------------------------------------- the same answers by other ways

def _same(a: str, b: str):
    return F.abs(F.col(a) - F.col(b)) < 1e-6


@register("score_by_weights", Q.with_(Q.LABELED, Q.SPLIT, Q.CLAIMS) + """
SELECT m.model, doc_id, label AS gold, true AS same_label, true AS same_scores
FROM claims, (VALUES ('tfidf_logreg'), ('tfidf_logreg_unigram')) m(model)""")
def score_by_weights(spark, sf):
    """Held-out claims scored by a term join with each model's weight table, compared row by row with the fitted pipelines' scores."""
    out = None
    for name, bigrams in (("tfidf_logreg", True), ("tfidf_logreg_unigram", False)):
        model = logreg_model(spark, sf, bigrams)
        test = _test_rows(spark, sf)
        fitted = ML.predict(model, test, ["doc_id", "label"])
        weights = write_table(LN.weight_table(spark, model), "weights")
        joined = LN.score_by_weights(test, weights, bigrams=bigrams).select(
            "doc_id", F.col("pred").alias("pred2"), *(F.col(f"p_{c}").alias(f"q_{c}") for c in LABELS))
        both = fitted.join(joined, "doc_id").select(
            F.lit(name).alias("model"), "doc_id", F.col("label").alias("gold"), (F.col("pred") == F.col("pred2")).alias("same_label"),
            (_same("p_false", "q_false") & _same("p_mixed", "q_mixed") & _same("p_true", "q_true")).alias("same_scores"))
        out = both if out is None else out.unionByName(both)
    return out


@register("roundtrip_check", Q.with_(Q.LABELED, Q.SPLIT, Q.CLAIMS) + """
SELECT doc_id, true AS same_label, true AS same_scores FROM claims""")
def roundtrip_check(spark, sf):
    """A pipeline saved to the shared folder and loaded again gives every held-out claim the scores it gave before."""
    path = scratch_path(spark, "model")
    model = logreg_model(spark, sf)
    model.write().overwrite().save(path)
    test = _test_rows(spark, sf)
    before = ML.predict(model, test, ["doc_id"])
    after = ML.predict(PipelineModel.load(path), test, ["doc_id"]).select("doc_id", F.col("pred").alias("pred2"), F.col("confidence").alias("conf2"))
    return before.join(after, "doc_id").select("doc_id", (F.col("pred") == F.col("pred2")).alias("same_label"),
                                               (F.col("confidence") == F.col("conf2")).alias("same_scores"))


@register("stream_check", Q.with_(Q.LABELED, Q.SPLIT, Q.CLAIMS) + r"""
SELECT doc_id, CASE WHEN regexp_matches(coalesce(text, ''), '[^\s\x0B\x1C-\x1F\x{85}\p{Z}]') THEN 'ok' ELSE 'empty' END AS status,
  CAST(1 AS BIGINT) AS times, true AS like_batch FROM claims""")
def stream_check(spark, sf):
    """Every held-out claim comes out of the stream once, with the scores of the batch path."""
    streamed = write_table(stream_score(spark, sf), "streamed")
    batch = scored_stream(_test_rows(spark, sf).select("doc_id", "text"), logreg_model(spark, sf)).select(
        "doc_id", F.col("status").alias("status2"), F.col("pred").alias("pred2"), F.col("confidence").alias("conf2"))
    like = F.col("pred").eqNullSafe(F.col("pred2")) & F.col("confidence").eqNullSafe(F.col("conf2")) & (F.col("status") == F.col("status2"))
    return streamed.join(batch, "doc_id", "full_outer").groupBy("doc_id").agg(
        F.max("status").alias("status"), F.count("status").alias("times"), F.min(F.coalesce(like, F.lit(False))).alias("like_batch"))
