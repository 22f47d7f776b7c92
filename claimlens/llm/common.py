"""Shared parts of the operators: the key column, input columns, sizes and components."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlens.session import shared_dir, write_table

NULL_ID = -(1 << 63)


def doc_key(name: str = "doc_id") -> Column:
    """The id as a long that is never null (null: the smallest long)."""
    return F.coalesce(F.col(name).cast("long"), F.lit(NULL_ID))


def text_key(name: str = "text") -> Column:
    """A 64-bit hash of the text (null: empty), which tells rows of one id apart."""
    return F.xxhash64(F.coalesce(F.col(name), F.lit("")))


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """A 64-bit key of id and text (null: empty): rows of one id with different texts have different keys, repeated rows one."""
    return F.xxhash64(doc_key(doc_id), F.coalesce(F.col(text), F.lit("")))


def only(df: DataFrame, *names: str) -> DataFrame:
    """The named columns alone: extra columns, whatever their names, cannot clash later."""
    return df.select(*names)


def boxed(docs: DataFrame, *more: Column) -> DataFrame:
    """``(row, *more)``: all columns of ``docs`` in one struct, so that no name of theirs can clash with an operator's."""
    return docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), *more)


def unboxed(df: DataFrame, columns: list[str], **changed: Column) -> DataFrame:
    """The boxed columns again, some of them replaced."""
    return df.select(*(changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in columns))


def groups_for(rows: int, per_group: int) -> int:
    return max(1, math.ceil(rows / per_group))


def shuffle_slices(df: DataFrame) -> int:
    """Number of hash slices: a few per shuffle partition, so that slices spread evenly."""
    return 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of one task as stars: every node with the smallest node it reaches inside the task."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent.setdefault(up, up)
        return x

    for rb in batches:
        for a, b in zip(rb.column(0).to_pylist(), rb.column(1).to_pylist()):
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    pairs = [(x, r) for x in parent if (r := root(x)) != x]
    yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.int64()) for k in range(2)], ["u", "v"])


def _stamp(links: DataFrame):
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, per_task: int = 500_000, max_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges(a, b)`` (longs): ``(node, root)``, root the smallest node.

    Tasks first shrink about ``per_task`` links each to stars.  Then large-star and small-star steps alternate (each a minimum per node
    and a join) until nothing changes: the number of rounds grows with the logarithm of the diameter, and a hub with very many
    neighbours is aggregated before the shuffle.  Each round's links are written to the shared folder: a lost executor rereads
    them.  Empty input gives an empty result.
    """
    links = write_table(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v"), "links")
    tasks = groups_for(links.count(), per_task)
    links = write_table(links.repartition(tasks).mapInArrow(_forest, "u long, v long").distinct(), "links")
    stamp = _stamp(links)
    for _ in range(max_rounds):
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        low2 = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low2, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(low2.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        links, before = write_table(small, "links"), stamp
        stamp = _stamp(links)
        if stamp == before:
            break
    else:
        raise RuntimeError("components did not settle")
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


__all__ = ["NULL_ID", "components", "doc_key", "groups_for", "only", "row_key", "shared_dir", "shuffle_slices", "text_key", "write_table"]
