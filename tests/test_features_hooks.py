import json
import os

import pytest
from pyspark.sql import functions as F

from claimlens.constants import CLS_ID, MAX_LENGTH, PAD_ID, SEP_ID, UNK_ID
from claimlens.operators import features as FE
from claimlens.operators.guard import guard_texts
from claimlens.operators import verdict as VD


def test_sequence_encode_lengths(spark):
    words = [f"w{i}" for i in range(600)]
    rows = [(0, ""), (1, " ".join(words[:126])), (2, " ".join(words[:127])), (3, " ".join(words[:500]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    vocab = spark.createDataFrame([("w0", 1000), ("w125", 1125)], "term string, token_id int")
    out = {r.doc_id: r for r in FE.sequence_encode(docs, vocab).collect()}
    for r in out.values():
        assert len(r.input_ids) == MAX_LENGTH and len(r.attention_mask) == MAX_LENGTH
        assert r.input_ids[0] == CLS_ID
    assert out[0].input_ids[:3] == [CLS_ID, SEP_ID, PAD_ID] and sum(out[0].attention_mask) == 2
    assert out[1].input_ids[1] == 1000 and out[1].input_ids[126] == 1125 and out[1].input_ids[127] == SEP_ID
    assert out[2].input_ids[127] == SEP_ID and sum(out[2].attention_mask) == MAX_LENGTH  # truncated at 126 words
    assert out[3].input_ids[2] == UNK_ID and sum(out[3].attention_mask) == MAX_LENGTH


def test_pluggable_verdict_function(spark):
    def verdicts(prompts):
        out = []
        for p in prompts:
            if "broken" in p:
                out.append('{"verdict": "true"')
            elif "odd" in p:
                out.append(json.dumps({"verdict": "perhaps", "confidence_score": 0.5, "reasoning": "", "sources": []}))
            else:
                out.append(json.dumps({"verdict": "false", "confidence_score": 1.5, "reasoning": "r",
                                       "sources": ["s1"]}))
        import pandas as pd
        return pd.Series(out)

    df = spark.createDataFrame([(1, "fine claim"), (2, "broken claim"), (3, "odd claim")], "id long, prompt string")
    out = {r.id: r.report for r in VD.apply_verdict_fn(df, verdicts).collect()}
    assert out[1].verdict == "false" and out[1].in_range is False and out[1].sources == ["s1"]
    assert out[2].verdict is None and out[2].confidence_score is None
    assert out[3].verdict is None and out[3].confidence_score == 0.5


def test_prompt_marks_missing_confidence(spark):
    df = spark.createDataFrame([("c", "true", None), ("c", "false", 0.61234)], "c string, l string, p double")
    texts = [r[0] for r in df.select(VD.render_prompt(F.col("c"), F.col("l"), F.col("p"))).collect()]
    assert "not available" in texts[0] and "0.6123" in texts[1]


def test_failing_rows_fail_alone_and_are_retried(spark, tmp_path):
    good = '{"verdict": "true", "confidence_score": 0.9, "reasoning": "", "sources": []}'
    seen = str(tmp_path)

    def verdicts(prompts):
        out = []
        for p in prompts:
            if p.startswith("bad"):
                raise ValueError(f"no {p}")
            if p.startswith("flaky"):
                mark = os.path.join(seen, p)
                calls = os.path.exists(mark) and open(mark).read() or ""
                with open(mark, "w") as f:
                    f.write(calls + "x")
                if not calls:  # fails once alone (the batch ended before it)
                    raise RuntimeError("later")
            out.append(None if p == "none" else good)
        return out

    rows = [(i, p) for i, p in enumerate(["a", "bad1", "b", "flaky1", "none", "bad2", "c"])]
    df = spark.createDataFrame(rows, "id long, prompt string").coalesce(1)
    got = {r.prompt: r for r in VD.apply_verdict_fn(df, verdicts).collect()}
    assert {p for p, r in got.items() if r.report.verdict == "true"} == {"a", "b", "c", "flaky1"}
    assert got["bad1"].verdict_error == "ValueError: no bad1" and got["bad1"].verdict_json is None and got["bad1"].attempts == 3
    assert got["flaky1"].attempts == 3 and got["flaky1"].verdict_error is None
    assert got["none"].verdict_error is None and got["none"].report.verdict is None
    short = VD.apply_verdict_fn(df, lambda p: [good] if len(p) == 1 else [good]).collect()
    assert all(r.report.verdict == "true" and r.attempts == 2 for r in short)  # a wrong number of answers is a failure of the batch
    assert VD.apply_verdict_fn(df.filter("false"), verdicts).collect() == []


def test_strict_guard(spark):
    df = spark.createDataFrame([(1, " a\u00a0"), (2, None), (3, "\u2003 ")], "id long, text string")
    got = {r.id: (r.status, r.text) for r in guard_texts(df).collect()}
    assert got == {1: ("ok", "a"), 2: ("empty", None), 3: ("empty", "")}
    assert guard_texts(df.filter("id = 1"), strict=True).count() == 1
    with pytest.raises(ValueError, match="2 of the claims"):
        guard_texts(df, strict=True)


def test_term_counts_move_token_lists_and_not_terms(spark):
    rows = [(i % 7, f"Red apple {'pie ' * (i % 3)}green{i}", i % 2 == 0) for i in range(12)]  # ids come twice
    docs = spark.createDataFrame(rows, "doc_id long, text string, fit boolean")
    plans = [FE.fit_transform_tfidf(docs, "fit"), FE.counted_terms(docs)]
    for df in plans:
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not [x for x in plan.splitlines() if "hashpartitioning(doc_id" in x and "term" in x]
    got = {(r.doc_id, r.term): r.tf for r in plans[1].collect()}
    want = {(r.doc_id, r.term): r.tf for r in FE.term_frequencies(FE.doc_terms(docs.select("doc_id", "text"))).collect()}
    assert got == want


def test_solver_has_no_more_partitions_than_cores(spark, monkeypatch):
    from claimlens.operators import models as ML
    seen, fit = [], ML.LogisticRegression.fit
    monkeypatch.setattr(ML.LogisticRegression, "fit", lambda self, data, *a: seen.append(data.rdd.getNumPartitions()) or fit(self, data, *a))
    cores = spark.sparkContext.defaultParallelism
    train = spark.createDataFrame([(i, f"word{i % 5} other", ("false", "mixed", "true")[i % 3]) for i in range(30)], "doc_id long, text string, label string")
    ML.train_logreg(train.repartition(5 * cores), max_features=10, max_iter=2)
    assert seen and seen[0] <= cores
