"""Exact row ordinals that do not funnel a hot group into one task.

``row_number() over (partition by label order by h)`` sends every row of a
label to one task; with three labels, three tasks would hold the whole table.
Instead rows are numbered inside ``(group, bucket)`` windows, where ``bucket``
is monotone in the ordering (the high bits of a uniform hash, or the hour of a
timestamp), and shifted by the number of rows in earlier buckets.  The offset
table has one row per (group, bucket), so it stays small; AQE decides at run
time whether to broadcast it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HASH_BITS = 32


def hash_bucket(h: Column, bits: int = 10) -> Column:
    """High ``bits`` of an unsigned 32-bit hash: monotone in the hash order."""
    return F.shiftright(h, HASH_BITS - bits).cast("int")


def ordinal_parts(df: DataFrame, order_cols: list, partition_cols: list | tuple = (),
                  bucket: Column | None = None):
    """``(ranked, offsets)``: rows numbered inside ``(group, bucket)`` and the per-bucket offsets.

    ``offsets`` has ``(group..., _bkt, _n, _off)`` with one row per bucket; it is
    derived from ``ranked`` itself (same partitioning), so the input is read once.
    """
    pcols = list(partition_cols)
    if bucket is None:
        bucket = F.lit(0)
    b = df.withColumn("_bkt", bucket)
    ranked = b.withColumn(
        "_rn", F.row_number().over(Window.partitionBy(*pcols, "_bkt").orderBy(*order_cols)))
    sizes = ranked.groupBy(*pcols, "_bkt").agg(F.max("_rn").alias("_n"))
    before = Window.partitionBy(*pcols).orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    return ranked, offsets


def group_ordinal(df: DataFrame, order_cols: list, partition_cols: list | tuple = (),
                  bucket: Column | None = None, name: str = "ord") -> DataFrame:
    """Add ``name`` = 1-based position within ``partition_cols`` ordered by ``order_cols``.

    ``bucket`` must be non-decreasing along ``order_cols``; ties inside
    ``order_cols`` must be broken by a unique key for a stable result.
    """
    pcols = list(partition_cols)
    ranked, offsets = ordinal_parts(df, order_cols, pcols, bucket)
    return (ranked.join(offsets.drop("_n"), [*pcols, "_bkt"])
            .withColumn(name, (F.col("_off") + F.col("_rn")).cast("bigint"))
            .drop("_bkt", "_rn", "_off"))
