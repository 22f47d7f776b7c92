import numpy as np
import pytest
from pyspark.sql import functions as F

from claimlens.operators import metrics as M
from claimlens.operators import models as ML
from claimlens.operators.training import early_stop
from claimlens.plans import views as V
from claimlens.sources.tables import read_table
from claimlens.streaming.score import scored_stream
from tests.conftest import SF001, SF01


def test_logreg_beats_chance_on_training_rows(spark):
    train = V.split_labeled(spark, SF01).filter(F.col("split") == "train").select("doc_id", "text", "label")
    model = ML.train_logreg(train, max_iter=50)
    pred = ML.predict(model, train, ["doc_id", "label"])
    acc = M.accuracy(pred, "label", "pred").collect()[0].accuracy
    majority = max(r["count"] for r in train.groupBy("label").count().collect()) / train.count()
    assert acc > majority
    probs = pred.select((F.col("p_false") + F.col("p_mixed") + F.col("p_true")).alias("s")).collect()
    assert all(abs(r.s - 1.0) < 1e-9 for r in probs)
    # the same PipelineModel scores a frame through the streaming path (batch here)
    out = scored_stream(train.select("doc_id", "text").union(
        spark.createDataFrame([(999999, "   ")], "doc_id long, text string")), model)
    empty = out.filter(F.col("doc_id") == 999999).collect()[0]
    assert empty.status == "empty" and empty.pred is None


def test_networks_follow_the_early_stop_of_their_log(spark):
    emb = ML.embedding_frame(read_table(spark, SF001, "embeddings", ["vec_id", "embedding", "label"]))
    train, valid = emb.filter("vec_id % 4 <> 0").cache(), emb.filter("vec_id % 4 = 0").cache()
    got = ML.train_mlps(train, valid, {"a": [64, 8, 3], "b": [64, 4, 3]}, epochs=4, patience=1, iters_per_epoch=3)
    for name, res in got.items():
        log = spark.createDataFrame([(name, e, a) for e, a in res.log], "run string, epoch long, val_acc double")
        end = early_stop(log, 1).first()
        assert (end.best_epoch, end.stop_epoch) == (res.best_epoch, len(res.log))
        best = M.accuracy(ML.score_network(res.model, valid, ["label"]), "label", "pred").first().accuracy
        assert abs(best - dict(res.log)[res.best_epoch]) < 1e-6 and best == round(res.best_val_acc, 6)
    again = ML.train_mlp(train, valid, [64, 8, 3], epochs=4, patience=1, iters_per_epoch=3)
    assert again.log == got["a"].log
    none = ML.train_mlp(train, valid.filter("false"), [64, 4, 3], epochs=1, iters_per_epoch=2)
    assert none.log == [] and none.best_epoch is None and none.model is not None


def test_callable_scorer(spark):
    rows = [(i, [float(i), 1.0, 0.0, 2.0]) for i in range(70)]
    df = spark.createDataFrame(rows, "vec_id long, v array<float>").repartition(3)

    def make():
        def fn(x):
            assert x.shape[1] == 4 and len(x) <= 32
            return np.stack([x.sum(1), x[:, 0]], axis=1)
        return fn

    got = {r.vec_id: list(r.p) for r in df.select("vec_id", ML.callable_scorer(make, 4)(F.col("v")).alias("p")).collect()}
    assert got == {i: [i + 3.0, float(i)] for i in range(70)}
    with pytest.raises(Exception, match="returned shape"):
        df.select(ML.callable_scorer(lambda: lambda x: x.sum(1), 4)(F.col("v"))).collect()


def test_registry_unknown_name(spark):
    reg = ML.ModelRegistry()
    try:
        reg.score(spark.createDataFrame([(1, "x")], "doc_id long, text string"), ["nope"], ["doc_id"])
    except ValueError as exc:
        assert "nope" in str(exc)
    else:
        raise AssertionError("expected ValueError")


def test_driver_contract(spark):
    import __spark_entry__ as e
    q, o = e.queries(), e.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 60
    df = e.entry(spark)
    assert df.columns[:3] == ["doc_id", "gold", "base_label"]
    assert df.count() > 0
