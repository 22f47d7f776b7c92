import pytest
from pyspark.sql import functions as F

from claimlens.operators import models as ML
from claimlens.plans import views as V
from claimlens.session import scratch_path
from claimlens.streaming.score import read_ledger, read_scored, scored_stream, start_scoring
from tests.conftest import SF001


def test_stream_scores_each_file_once(spark):
    split = V.split_labeled(spark, SF001)
    model = ML.train_logreg(split.filter(F.col("split") == "train").select("doc_id", "text", "label"), max_iter=20)
    model_path, source = scratch_path(spark, "t-model"), scratch_path(spark, "t-in")
    sink, ckpt = scratch_path(spark, "t-out"), scratch_path(spark, "t-ckpt")
    model.write().overwrite().save(model_path)
    test = split.filter(F.col("split") == "test").select("doc_id", "text", "label")
    first = test.filter(F.col("label") == "true").drop("label")
    second = test.filter(F.col("label") != "true").drop("label").union(spark.createDataFrame([(-1, "   ")], "doc_id long, text string"))
    first.write.mode("append").parquet(source)
    start_scoring(spark, model_path, source, sink, ckpt).awaitTermination()
    n1 = read_scored(spark, sink).count()
    second.write.mode("append").parquet(source)
    start_scoring(spark, model_path, source, sink, ckpt).awaitTermination()  # restart from the checkpoint
    out = read_scored(spark, sink)
    assert n1 == first.count()
    assert out.count() == first.count() + second.count()
    assert out.select("doc_id").distinct().count() == out.count()
    empty = out.filter(F.col("doc_id") == -1).collect()[0]
    assert empty.status == "empty" and empty.pred is None


def test_a_stream_killed_between_write_and_entry_neither_loses_nor_doubles(spark):
    split = V.split_labeled(spark, SF001)
    model = ML.train_logreg(split.filter(F.col("split") == "train").select("doc_id", "text", "label"), max_iter=5)
    model_path, source = scratch_path(spark, "t-model"), scratch_path(spark, "t-in")
    sink, ckpt = scratch_path(spark, "t-out"), scratch_path(spark, "t-ckpt")
    model.write().overwrite().save(model_path)
    rows = split.select("doc_id", "text")
    rows.repartition(3).write.parquet(source)

    def die(batch_id):
        if batch_id == 1:
            raise RuntimeError("killed after the rows of batch 1 were written")

    with pytest.raises(Exception, match="killed"):
        start_scoring(spark, model_path, source, sink, ckpt, files_per_batch=1, between=die).awaitTermination()
    assert [r.batch for r in read_ledger(spark, sink).collect()] == [0]
    left = spark.read.parquet(sink).count()
    first = read_scored(spark, sink).count()
    assert 0 < first < left  # batch 1 is there, but not entered
    start_scoring(spark, model_path, source, sink, ckpt, files_per_batch=1).awaitTermination()
    out = read_scored(spark, sink)
    assert sorted(r.batch for r in read_ledger(spark, sink).collect()) == [0, 1, 2]
    assert sorted(tuple(r) for r in out.select("doc_id", "pred", "confidence").collect()) == sorted(
        tuple(r) for r in scored_stream(rows, model).select("doc_id", "pred", "confidence").collect())
    assert read_ledger(spark, sink).agg(F.sum("n_rows")).first()[0] == rows.count()
