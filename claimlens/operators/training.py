"""Training-log operators: mean loss per epoch and early stopping as windows.

The training loop's bookkeeping (best validation accuracy, patience counter)
is re-expressed over a metric-log table ``(run, epoch, val_acc)``:

* ``improved``  = val_acc > best of all earlier epochs (the best starts at 0.0);
* ``streak``    = epoch - last improving epoch so far (0 before any);
* ``stop``      = first epoch whose streak reaches ``patience`` (else the last);
* ``best``      = last improving epoch not after ``stop`` (null if none).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimlens.constants import PATIENCE
from claimlens.operators.ordinal import group_ordinal

BATCHES_PER_EPOCH = 4


def batch_log_from_events(events: DataFrame) -> DataFrame:
    """``(run, epoch, batch, loss, value)`` from an event stream.

    ``run`` is the user, batches are the user's events in time order (ties by
    id), four per epoch, and ``loss`` is ``value / 100``.  The per-run
    ordinal is bucketed by hour, so one very active user does not end up in a
    single task.
    """
    ordered = group_ordinal(events, ["ts", "event_id"], ["user_id"],
                            F.date_trunc("hour", F.col("ts")), "ord")
    return ordered.select(
        F.col("user_id").alias("run"),
        (F.floor((F.col("ord") - 1) / BATCHES_PER_EPOCH) + 1).cast("bigint").alias("epoch"),
        ((F.col("ord") - 1) % BATCHES_PER_EPOCH + 1).cast("bigint").alias("batch"),
        (F.col("value") / F.lit(100.0)).alias("loss"),
        "value")


def epoch_loss(batch_log: DataFrame) -> DataFrame:
    return batch_log.groupBy("run", "epoch").agg(
        (F.floor(F.avg("loss") * F.lit(1000000.0) + F.lit(0.5)) / F.lit(1000000.0)).alias("mean_loss"),
        F.count(F.lit(1)).alias("n_batches"))


def epoch_log_from_events(events: DataFrame) -> DataFrame:
    """``(run, epoch, val_acc)``: a coarse accuracy (quarters) so that ties occur."""
    return batch_log_from_events(events).groupBy("run", "epoch").agg(
        (F.floor(F.max("value") / F.lit(125.0)) / F.lit(4.0)).alias("val_acc"))


def early_stop(epoch_log: DataFrame, patience: int = PATIENCE, epochs: int | None = None,
               run: str = "run", epoch: str = "epoch", acc: str = "val_acc") -> DataFrame:
    """Per run: ``best_epoch``, ``best_val_acc``, ``stop_epoch``, ``stopped_early``.

    Only patience ends a run; ``epochs`` is the length of a training that was planned shorter than its log.
    """
    log = epoch_log if epochs is None else epoch_log.filter(F.col(epoch) <= epochs)
    w = Window.partitionBy(run).orderBy(epoch)
    earlier = w.rowsBetween(Window.unboundedPreceding, -1)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    log = log.withColumn("_improved", F.col(acc) > F.coalesce(F.max(acc).over(earlier), F.lit(0.0)))
    log = log.withColumn("_streak", F.col(epoch) - F.coalesce(
        F.max(F.when(F.col("_improved"), F.col(epoch))).over(upto), F.lit(0)))
    first_stop = F.min(F.when(F.col("_streak") >= patience, F.col(epoch))).over(Window.partitionBy(run))
    log = log.withColumn("_stop", F.coalesce(first_stop, F.max(epoch).over(Window.partitionBy(run)))) \
             .withColumn("_early", first_stop.isNotNull())
    kept = F.col(epoch) <= F.col("_stop")
    return log.groupBy(run).agg(
        F.max(F.when(F.col("_improved") & kept, F.col(epoch))).cast("bigint").alias("best_epoch"),
        F.max(F.when(kept, F.col(acc))).alias("best_val_acc"),
        F.first("_stop").cast("bigint").alias("stop_epoch"),
        F.first("_early").alias("stopped_early"))
