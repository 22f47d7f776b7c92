"""Classifiers on Spark ML.

* ``train_logreg``: TF-IDF (uni+bigrams, stop words removed, top
  ``max_features`` terms of the training rows, smooth idf, L2 norm) feeding a
  multinomial logistic regression with balanced class weights.  The fitted
  vocabulary and idf (bounded by ``max_features``) are frozen into JVM
  stages (``CountVectorizerModel`` and ``ElementwiseProduct``) so the whole
  model is one ``PipelineModel`` that works on batch and streaming frames.
  The objective ``C*sum(w_i*loss_i) + |w|^2/2`` maps to Spark's
  ``sum(w_i*loss_i)/sum(w_i) + regParam*|w|^2/2`` with ``regParam = 1/(C*n)``
  because balanced weights sum to ``n``.
* ``train_mlps``: multilayer perceptrons over dense embeddings.  Every shape goes on from its last weights epoch after epoch,
  the shapes side by side in threads; one aggregate scores all epochs of all shapes into a metric log, and the early-stop operator
  (:func:`claimlens.operators.training.early_stop`) reads from that log where each run ends and which epoch is kept.
* ``callable_scorer``: any user function from a batch of feature vectors to class scores (``predict_batch_udf``, Arrow batches).
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.feature import (CountVectorizerModel, ElementwiseProduct, NGram, Normalizer, RegexTokenizer,
                                SQLTransformer, StopWordsRemover)
from pyspark.ml.functions import array_to_vector, predict_batch_udf, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlens.constants import BATCH_SIZE, EPOCHS, LABELS, MAX_FEATURES, MAX_ITER, PATIENCE, REG_C, SEED, TOKEN_PATTERN
from claimlens.functions.labels import decode_label, encode_label
from claimlens.functions.numeric import argmax_index
from claimlens.functions.text import stopwords
from claimlens.operators import features as FE
from claimlens.operators.splits import class_weights
from claimlens.operators.training import early_stop

TOLERANCE = 1e-6  # relative change of the loss at which the solver stops
MAX_DRIVER_VOCAB = 1_000_000  # the model's vocabulary lives on the driver: a larger one is refused


def text_feature_stages(vocab: list[str], idf: list[float], text_col: str = "text", bigrams: bool = True):
    tok = RegexTokenizer(inputCol=text_col, outputCol="_words", pattern=TOKEN_PATTERN, gaps=False,
                         toLowercase=True, minTokenLength=1)
    rem = StopWordsRemover(inputCol="_words", outputCol="_kept", stopWords=list(stopwords()), caseSensitive=True)
    stages = [tok, rem]
    if bigrams:
        stages.append(NGram(n=2, inputCol="_kept", outputCol="_bigrams"))
        stages.append(SQLTransformer(statement="SELECT *, concat(_kept, _bigrams) AS _terms FROM __THIS__"))
        terms = "_terms"
    else:
        terms = "_kept"
    cv = CountVectorizerModel.from_vocabulary(vocab, inputCol=terms, outputCol="_tf")
    scale = ElementwiseProduct(scalingVec=Vectors.dense(idf), inputCol="_tf", outputCol="_tfidf")
    norm = Normalizer(p=2.0, inputCol="_tfidf", outputCol="features")
    return stages + [cv, scale, norm]


def fit_text_features(train: DataFrame, text_col: str = "text", max_features: int = MAX_FEATURES,
                      bigrams: bool = True, id_col: str = "doc_id"):
    """Vocabulary and idf fitted on the training rows (aggregates; only the top terms reach the driver)."""
    if max_features > MAX_DRIVER_VOCAB:
        raise ValueError(f"max_features is {max_features}; a driver-side vocabulary holds at most {MAX_DRIVER_VOCAB}")
    if bigrams:
        idf_df = FE.fit_tfidf(train, id_col, text_col, max_features)
    else:
        idf_df = FE.idf_table(FE.top_vocabulary(FE.counted_terms(train, id_col, text_col, bigrams=False), max_features), float(train.count()))
    rows = idf_df.orderBy("rank").collect()  # max_features rows
    return [r["term"] for r in rows], [float(r["idf"]) for r in rows]


def train_logreg(train: DataFrame, text_col: str = "text", label_col: str = "label",
                 max_features: int = MAX_FEATURES, c: float = REG_C, max_iter: int = MAX_ITER,
                 bigrams: bool = True) -> PipelineModel:
    vocab, idf = fit_text_features(train, text_col, max_features, bigrams)
    feats = PipelineModel(text_feature_stages(vocab, idf, text_col, bigrams))
    # one small aggregate gives the weights and the row count; the text is never shuffled on the label
    counts = [(r[0], r[1], r[2]) for r in class_weights(train, label_col).filter(F.col(label_col).isin(list(LABELS))).select(
        label_col, "weight", "n_label").collect()]
    weight = F.coalesce(*[F.when(F.col(label_col) == c, F.lit(float(w))) for c, w, _ in counts], F.lit(1.0))
    data = (feats.transform(train.withColumn("weight", weight))
            .withColumn("_y", encode_label(F.col(label_col)).cast("double"))
            .filter(F.col("_y").isNotNull()))
    n = max(1, sum(x for _, _, x in counts))
    # every step of the solver sends one gradient (classes x features doubles) per partition: no more partitions than cores
    data = data.select("features", "_y", "weight").coalesce(train.sparkSession.sparkContext.defaultParallelism)
    lr = LogisticRegression(featuresCol="features", labelCol="_y", weightCol="weight", family="multinomial",
                            regParam=1.0 / (c * n), elasticNetParam=0.0, standardization=False,
                            maxIter=max_iter, tol=TOLERANCE, predictionCol="_pred", probabilityCol="_prob",
                            rawPredictionCol="_raw")
    model = lr.fit(data)
    return PipelineModel(feats.stages + [model])


def iterations(model: PipelineModel) -> int | None:
    """Solver iterations of a model fitted in this session (a loaded one no longer knows)."""
    lr = model.stages[-1]
    return int(lr.summary.totalIterations) if lr.hasSummary else None


def predict(model: PipelineModel, df: DataFrame, keep: list[str], hide_confidence: bool = False) -> DataFrame:
    """``keep`` columns + ``pred``, ``confidence`` and one probability per class."""
    out = model.transform(df).withColumn("_p", vector_to_array("_prob"))
    idx = argmax_index("_p")
    conf = F.element_at("_p", idx + 1)
    cols = [F.col(k) for k in keep] + [decode_label(idx).alias("pred"),
                                       (F.lit(None).cast("double") if hide_confidence else conf).alias("confidence")]
    cols += [F.col("_p")[i].alias(f"p_{c}") for i, c in enumerate(LABELS)]
    return out.select(*cols)


# ---------------------------------------------------------------- neural classifier

@dataclass
class MlpResult:
    model: object
    layers: list[int]
    log: list[tuple] = field(default_factory=list)   # (epoch, val_acc) up to the stop
    best_epoch: int | None = None
    best_val_acc: float = 0.0


def _epoch_models(train: DataFrame, layers: list[int], features: str, label: str, epochs: int, iters: int, seed: int) -> list:
    """One model per epoch, each fitted on from the weights before it."""
    models: list = []
    while len(models) < epochs:
        net = MultilayerPerceptronClassifier(layers=layers, featuresCol=features, labelCol=label, seed=seed, maxIter=iters, blockSize=BATCH_SIZE)
        if models:
            net.setInitialWeights(models[-1].weights)
        models.append(net.fit(train))
    return models


def train_mlps(train: DataFrame, valid: DataFrame, shapes: dict[str, list[int]], features: str = "features", label: str = "y",
               epochs: int = EPOCHS, patience: int = PATIENCE, iters_per_epoch: int = 10, seed: int = SEED) -> dict[str, MlpResult]:
    """Networks of several shapes, each at its best epoch by validation accuracy (the early-stop operator on the metric log)."""
    with ThreadPoolExecutor(len(shapes)) as pool:
        jobs = {name: pool.submit(_epoch_models, train, layers, features, label, epochs, iters_per_epoch, seed) for name, layers in shapes.items()}
        models = {name: job.result() for name, job in jobs.items()}
    scored = [m.transform(valid).select(F.lit(name).alias("run"), F.lit(e).cast("bigint").alias("epoch"), (F.col("prediction") == F.col(label)).alias("hit"))
              for name, runs in models.items() for e, m in enumerate(runs, 1)]
    log = reduce(DataFrame.union, scored).groupBy("run", "epoch").agg(F.avg(F.coalesce("hit", F.lit(False)).cast("double")).alias("val_acc"))
    log = valid.sparkSession.createDataFrame(log.collect(), log.schema)  # shapes x epochs rows
    ends = {r["run"]: r for r in early_stop(log, patience).collect()}
    out = {}
    for name, layers in shapes.items():
        # without validation rows there is no log: the last epoch stays
        end = ends.get(name)
        rows = sorted((r["epoch"], r["val_acc"]) for r in log.where(F.col("run") == name).collect()) if end else []
        best = end["best_epoch"] if end else None
        out[name] = MlpResult(models[name][(best or epochs) - 1], layers, [r for r in rows if r[0] <= end["stop_epoch"]] if end else [], best,
                              float(end["best_val_acc"] or 0.0) if best else 0.0)
    return out


def train_mlp(train: DataFrame, valid: DataFrame, layers: list[int], **options) -> MlpResult:
    """One shape of :func:`train_mlps`."""
    return train_mlps(train, valid, {"mlp": layers}, **options)["mlp"]


def embedding_frame(emb: DataFrame) -> DataFrame:
    """``(vec_id, features, y, label)`` with the ten embedding labels folded to three classes."""
    y = (F.col("label") % 3)
    return emb.select("vec_id", array_to_vector(F.col("embedding")).alias("features"),
                      y.cast("double").alias("y"), decode_label(y).alias("label"), "embedding")


def score_network(model, df: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns + ``pred`` and ``confidence`` of a fitted network, in the JVM's batches."""
    out = model.transform(df).withColumn("_p", vector_to_array("probability"))
    idx = argmax_index("_p")
    return out.select(*keep, decode_label(idx).alias("pred"), F.element_at("_p", idx + 1).alias("confidence"))


def callable_scorer(make_fn: Callable[[], Callable[[np.ndarray], np.ndarray]], n_features: int, batch_size: int = BATCH_SIZE):
    """A column function from ``ARRAY`` features to class scores computed by a user's function.

    ``make_fn`` is called once per Python worker (load a model there); its result maps an array (rows, ``n_features``)
    to an array (rows, classes) and is called once per Arrow batch of at most ``batch_size`` rows.
    """
    def make():
        fn = make_fn()

        def run(x: np.ndarray) -> np.ndarray:
            out = np.asarray(fn(x.reshape(-1, n_features)), dtype=np.float64)
            if out.ndim != 2 or len(out) != x.size // n_features:
                raise ValueError(f"the scorer returned shape {out.shape} for {x.size // n_features} rows")
            return out

        return run

    return predict_batch_udf(make, return_type=T.ArrayType(T.DoubleType()), batch_size=batch_size, input_tensor_shapes=[[n_features]])


class ModelRegistry:
    """Named fitted models; scoring an unknown name is an error."""

    def __init__(self):
        self._models: dict[str, PipelineModel] = {}

    def register(self, name: str, model: PipelineModel) -> None:
        self._models[name] = model

    def names(self) -> list[str]:
        return sorted(self._models)

    def score(self, df: DataFrame, names: list[str], keep: list[str]) -> DataFrame:
        out = None
        for name in names:
            if name not in self._models:
                raise ValueError(f"unknown model {name!r}; known: {', '.join(self.names())}")
            part = predict(self._models[name], df, keep).withColumn("model", F.lit(name))
            out = part if out is None else out.unionByName(part)
        return out
