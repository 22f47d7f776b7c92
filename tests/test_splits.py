import math

import pytest
from pyspark.sql import functions as F

from claimlens.operators import splits as S
from claimlens.plans import views as V
from tests.conftest import SF01


def _quota(counts, test_size):
    """Largest remainder on the training side, ties to the lower label."""
    n = sum(counts.values())
    n_train = n - math.ceil(test_size * n)
    cont = {k: c * n_train / n for k, c in counts.items()}
    fl = {k: math.floor(v) for k, v in cont.items()}
    need = n_train - sum(fl.values())
    order = sorted(counts, key=lambda k: (-(cont[k] - fl[k]), ["false", "mixed", "true"].index(k)))
    for k in order[:need]:
        fl[k] += 1
    return {k: counts[k] - fl[k] for k in counts}


def test_split_sizes_disjoint_complete_stable(spark):
    lab = V.labeled(spark, SF01)
    s = S.stratified_split(lab).select("doc_id", "label", "split")
    rows = s.collect()
    assert len(rows) == lab.count() == len({r.doc_id for r in rows})
    counts = {}
    for r in rows:
        counts[r.label] = counts.get(r.label, 0) + 1
    want = _quota(counts, 0.2)
    got = {k: sum(1 for r in rows if r.label == k and r.split == "test") for k in counts}
    assert got == want == {"false": 10, "mixed": 10, "true": 60}
    again = S.stratified_split(lab.repartition(7)).select("doc_id", "split").collect()
    assert {(r.doc_id, r.split) for r in again} == {(r.doc_id, r.split) for r in rows}


def test_three_way_sizes(spark):
    s = S.three_way_split(V.labeled(spark, SF01)).groupBy("split", "label").count().collect()
    got = {(r.split, r.label): r["count"] for r in s}
    assert [got[("validation", c)] for c in ("false", "mixed", "true")] == [10, 10, 60]
    assert [got[("train", c)] for c in ("false", "mixed", "true")] == [29, 31, 179]


def test_single_row_class_and_identical_texts(spark):
    rows = [(i, "same text", "true") for i in range(9)] + [(100, "lonely", "mixed")]
    df = spark.createDataFrame(rows, "doc_id long, text string, label string")
    out = {r.doc_id: r.split for r in S.stratified_split(df).collect()}
    assert len(out) == 10
    assert sum(1 for v in out.values() if v == "test") == math.ceil(0.2 * 10)


def test_balanced_sample_and_shortage(spark):
    rows = [(i, ["false", "mixed", "true"][i % 3]) for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, label string")
    sample = S.seeded_shuffle(S.balanced_sample(df, 4)).collect()
    assert len(sample) == 12 and sorted(r.ord for r in sample) == list(range(1, 13))
    with pytest.raises(ValueError, match="mixed"):
        S.balanced_sample(df.filter(F.col("doc_id") != 1), 10)


def test_seeded_shuffle_is_a_permutation(spark):
    df = spark.range(1000).withColumnRenamed("id", "doc_id")
    ords = [r.ord for r in S.seeded_shuffle(df, bits=4).collect()]
    assert sorted(ords) == list(range(1, 1001))


def test_class_weights_sum_to_n(spark):
    rows = [(i, "true") for i in range(6)] + [(10, "false"), (11, "mixed"), (12, "mixed")]
    df = spark.createDataFrame(rows, "doc_id long, label string")
    w = {r.label: r.weight for r in S.class_weights(df).collect()}
    assert abs(w["true"] * 6 + w["false"] + 2 * w["mixed"] - 9) < 1e-9


def test_heldout_by_text_exact(spark):
    cand = spark.createDataFrame([(1, "same words"), (2, "only here"), (3, "same words "), (4, None)],
                                 "doc_id long, text string")
    train = spark.createDataFrame([(10, "same words"), (11, "other")], "doc_id long, text string")
    got = sorted(r.doc_id for r in S.heldout_by_text(cand, train).collect())
    assert got == [2, 3, 4]
    assert got == sorted(r.doc_id for r in S.heldout_only(cand, train, "text").collect())


def test_quotas_of_very_large_classes(spark):
    from claimlens.operators.splits import quotas_from_counts
    counts = spark.createDataFrame([("false", 4_000_000_000), ("mixed", 3_000_000_000), ("true", 5_000_000_000)], "label string, n_class long")
    got = {r.label: (r.n_train, r.n_test) for r in quotas_from_counts(counts, "label", 0.2).collect()}
    assert got == {"false": (3_200_000_000, 800_000_000), "mixed": (2_400_000_000, 600_000_000), "true": (4_000_000_000, 1_000_000_000)}
