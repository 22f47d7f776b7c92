"""Score arriving claims with a saved model (Structured Streaming).

File source -> strip / guard -> saved ``PipelineModel`` -> one folder per micro-batch, with a checkpoint in the shared folder.  The flow is
stateless; ``availableNow`` processes whatever has arrived and stops, ``processingTime`` keeps running.

A batch is first written to ``<sink>/batch=<id>`` (replacing what an earlier attempt left there) and then entered in the ledger
``<sink>-ledger`` with its number of rows.  Spark gives a batch that was not committed the same id and the same files again, so a
query that dies between any two steps neither loses nor doubles a claim; :func:`read_scored` reads the batches of the ledger alone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlens.functions.labels import decode_label
from claimlens.functions.numeric import argmax_index
from claimlens.operators.guard import guard_texts

CLAIM_SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])
LEDGER_SCHEMA = "batch long, n_rows long"


def scored_stream(source: DataFrame, model: PipelineModel) -> DataFrame:
    """Stateless scoring of a (streaming or batch) frame of ``doc_id, text``."""
    out = model.transform(guard_texts(source.withColumn("text", F.coalesce("text", F.lit("")))))
    p = vector_to_array("_prob")
    idx = argmax_index(p)
    ok = F.col("status") == "ok"
    return out.select("doc_id", "status",
                      F.when(ok, decode_label(idx)).alias("pred"),
                      F.when(ok, F.element_at(p, idx + 1)).alias("confidence"))


def ledger_dir(sink_dir: str) -> str:
    return sink_dir.rstrip("/") + "-ledger"


def batch_writer(sink_dir: str, between: Callable[[int], None] | None = None) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` function; ``between`` runs after a batch's rows are written and before the ledger knows them (tests)."""
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        target = f"{sink_dir}/batch={batch_id}"
        batch.write.mode("overwrite").parquet(target)
        if between is not None:
            between(batch_id)
        rows = spark.read.schema(batch.schema).parquet(target).count()
        spark.createDataFrame([(batch_id, rows)], LEDGER_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{ledger_dir(sink_dir)}/{batch_id}")

    return write


def read_ledger(spark: SparkSession, sink_dir: str) -> DataFrame:
    return spark.read.schema(LEDGER_SCHEMA).option("recursiveFileLookup", "true").parquet(ledger_dir(sink_dir))


def read_scored(spark: SparkSession, sink_dir: str) -> DataFrame:
    """The rows of all entered batches; a batch folder without an entry is a write that was cut off, and is left out."""
    return spark.read.parquet(sink_dir).join(read_ledger(spark, sink_dir).select("batch").distinct(), "batch", "left_semi").drop("batch")


def start_scoring(spark: SparkSession, model_path: str, source_dir: str, sink_dir: str, checkpoint_dir: str,
                  available_now: bool = True, interval: str = "10 seconds", files_per_batch: int = 64,
                  between: Callable[[int], None] | None = None):
    model = PipelineModel.load(model_path)
    src = spark.readStream.schema(CLAIM_SCHEMA).option("maxFilesPerTrigger", files_per_batch).parquet(source_dir)
    writer = scored_stream(src, model).writeStream.foreachBatch(batch_writer(sink_dir, between)).option("checkpointLocation", checkpoint_dir)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start()
