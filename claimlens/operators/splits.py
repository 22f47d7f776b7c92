"""Reproducible stratified splits, balanced samples and seeded shuffles.

Membership depends only on ``(seed, key)`` through md5, never on partitioning
or on ``rand()``, so two jobs (or a retried task) re-create the same split.
Per-class sizes follow the largest-remainder quota: ``n_test = ceil(size*n)``,
training counts per class are floors of ``c*n_train/n`` and the remaining
units go to the largest fractions (ties to the lower label in LABELS order);
the test side gets what is left in each class.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimlens.constants import LABELS, PER_LABEL, SEED, TEST_SIZE, VALIDATION_SIZE
from claimlens.functions.numeric import hash_int
from claimlens.operators.ordinal import group_ordinal, hash_bucket, ordinal_parts
from claimlens.session import write_table


def seeded_hash(key: str | Column, seed: int, salt: str) -> Column:
    k = F.col(key) if isinstance(key, str) else key
    return hash_int(F.lit(str(seed)), F.lit(salt), k)


def _label_rank(label: Column, labels=LABELS) -> Column:
    pos = F.array_position(F.array(*[F.lit(x) for x in labels]), label)
    return F.when(pos > 0, pos).otherwise(F.lit(len(labels) + 1))


def quotas_from_counts(counts: DataFrame, label: str, test_size: float, labels=LABELS) -> DataFrame:
    """From ``(label, n_class)``: ``n_train`` and ``n_test`` per class (one row per class)."""
    whole = Window.partitionBy()
    n = F.sum("n_class").over(whole)
    n_test_total = F.ceil(F.lit(float(test_size)) * n)
    q = (counts
         .withColumn("_n", n)
         .withColumn("_n_train", (F.col("_n") - n_test_total).cast("bigint"))
         .withColumn("_cont", (F.col("n_class").cast("decimal(19,0)") * F.col("_n_train").cast("decimal(19,0)")).cast("double") / F.col("_n"))
         .withColumn("_floor", F.floor("_cont"))
         .withColumn("_rem", F.col("_cont") - F.col("_floor"))
         .withColumn("_need", F.col("_n_train") - F.sum("_floor").over(whole))
         .withColumn("_rank", F.row_number().over(
             Window.orderBy(F.desc("_rem"), _label_rank(F.col(label), labels), F.col(label))))
         .withColumn("n_train", (F.col("_floor") + F.when(F.col("_rank") <= F.col("_need"), 1).otherwise(0))
                     .cast("bigint"))
         .withColumn("n_test", (F.col("n_class") - F.col("n_train")).cast("bigint")))
    return q.select(label, "n_class", "n_train", "n_test")


def class_quotas(df: DataFrame, label: str, test_size: float, labels=LABELS) -> DataFrame:
    """Per class: ``n_class``, ``n_train``, ``n_test`` (one row per class)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_class"))
    return quotas_from_counts(counts, label, test_size, labels)


def stratified_split(df: DataFrame, key: str = "doc_id", label: str = "label",
                     test_size: float = TEST_SIZE, seed: int = SEED, salt: str = "split",
                     names: tuple[str, str] = ("train", "test"), bits: int = 16,
                     split_col: str = "split") -> DataFrame:
    """Add ``split_col`` in ``names``; exact per-class test sizes.

    Rows are ranked inside their class by ``md5(seed:salt:key)`` (ties by
    key); the first ``n_test`` of each class are the test side.  Class sizes
    (and so the quotas) come from the per-bucket counts of the ranking itself:
    the input is read once, and only a table of ``classes x buckets`` rows is
    joined back.
    """
    h = seeded_hash(key, seed, salt)
    ranked, offsets = ordinal_parts(df.withColumn("_h", h), ["_h", key], [label], hash_bucket(F.col("_h"), bits))
    counts = offsets.groupBy(label).agg(F.sum("_n").alias("n_class"))
    meta = offsets.join(quotas_from_counts(counts, label, test_size).select(label, "n_test"), label)
    out = ranked.join(meta.select(label, "_bkt", "_off", "n_test"), [label, "_bkt"])
    return (out.withColumn(split_col, F.when(F.col("_off") + F.col("_rn") <= F.col("n_test"), F.lit(names[1]))
                           .otherwise(F.lit(names[0])))
            .drop("_h", "_bkt", "_rn", "_off", "n_test"))


def three_way_split(df: DataFrame, key: str = "doc_id", label: str = "label",
                    test_size: float = TEST_SIZE, validation_size: float = VALIDATION_SIZE,
                    seed: int = SEED, split_col: str = "split") -> DataFrame:
    """60/20/20: test first, then a stratified validation share of the rest.

    The first split is written down, because both sides of the second step read it.
    """
    first = write_table(stratified_split(df, key, label, test_size, seed, "split", split_col=split_col), "first-split")
    rest = first.filter(F.col(split_col) == "train").drop(split_col)
    second = stratified_split(rest, key, label, validation_size, seed, "validation",
                              names=("train", "validation"), split_col=split_col)
    return second.unionByName(first.filter(F.col(split_col) == "test"))


def balanced_sample(df: DataFrame, per_label: int = PER_LABEL, key: str = "doc_id", label: str = "label",
                    seed: int = SEED, labels=LABELS, check: bool = True) -> DataFrame:
    """``per_label`` rows of every label in ``labels``; raises if a label is short.

    ``row_number() <= n`` over the label lets Spark keep only ``n`` rows per
    label in every map task before the shuffle (WindowGroupLimit).
    """
    if check:
        wanted = df.sparkSession.createDataFrame([(x,) for x in labels], f"{label} string")
        counts = df.filter(F.col(label).isin(labels)).groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
        short = (wanted.join(counts, label, "left").withColumn("_n", F.coalesce("_n", F.lit(0)))
                 .filter(F.col("_n") < per_label).orderBy(label).first())
        if short is not None:
            raise ValueError(f"balanced_sample: need {per_label} rows labelled {short[0]!r}, the input has {short[1]}")
    h = seeded_hash(key, seed, "sample")
    w = Window.partitionBy(label).orderBy(h, F.col(key))
    return (df.filter(F.col(label).isin(labels)).withColumn("_rn", F.row_number().over(w))
            .filter(F.col("_rn") <= per_label).drop("_rn"))


def seeded_shuffle(df: DataFrame, key: str = "doc_id", seed: int = SEED, name: str = "ord",
                   bits: int = 16) -> DataFrame:
    """Renumber rows 1..n in the order of ``md5(seed:shuffle:key)``."""
    h = seeded_hash(key, seed, "shuffle")
    return group_ordinal(df.withColumn("_h", h), ["_h", key], [], hash_bucket(F.col("_h"), bits), name).drop("_h")


def heldout_only(candidates: DataFrame, training: DataFrame, on: str | list = "doc_id") -> DataFrame:
    """Keep candidate rows whose key never occurs in the training rows."""
    keys = [on] if isinstance(on, str) else list(on)
    return candidates.join(training.select(*keys).distinct(), keys, "left_anti")


def heldout_by_text(candidates: DataFrame, training: DataFrame, key: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """Keep candidates whose exact text never occurs among the training rows.

    The bulk anti-join shuffles only a 64-bit hash of each text; texts are
    compared in full only for candidates whose hash matches a training hash,
    so the result is exact while long texts are not shuffled twice.
    """
    h = F.xxhash64(F.col(text_col))
    cand_h = candidates.select(key, h.alias("_h"))
    train_h = training.select(h.alias("_h")).distinct()
    suspects = cand_h.join(train_h, "_h", "left_semi")
    train_texts = training.select(h.alias("_h"), F.col(text_col).alias("_t")).join(
        suspects.select("_h").distinct(), "_h", "left_semi").distinct()  # one row per text, however many copies it has
    confirmed = (suspects.join(candidates.select(key, F.col(text_col).alias("_c")), key)
                 .join(train_texts, "_h").filter(F.col("_c") == F.col("_t")).select(key).distinct())
    return candidates.join(confirmed, key, "left_anti")


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """Balanced weights ``n / (k * n_class)`` per class."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_label"))
    whole = Window.partitionBy()
    return counts.withColumn(
        "weight", F.sum("n_label").over(whole).cast("double")
        / (F.count(F.lit(1)).over(whole) * F.col("n_label")).cast("double"))
