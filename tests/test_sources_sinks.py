import os
import tempfile

import pytest
from pyspark.sql import functions as F

from claimlens.sources import claims as SC
from claimlens.sources import sinks as SK


def _tmp():
    return tempfile.mkdtemp(prefix="claimlens-test-")


def test_read_claims_tsv_keeps_quotes(spark):
    d = _tmp()
    path = os.path.join(d, "train.tsv")
    lines = [
        "1\ttrue\t\"Quoted start of a statement\tsubj\tsp\tjob\tst\tparty\t1\t2\t3\t4\t5\tctx",
        "2\tpants-fire\tPlain statement\tsubj\tsp\tjob\tst\tparty\t0\t0\t0\t0\t1\tctx",
        "3\tnot-a-label\tOdd label\tsubj\tsp\tjob\tst\tparty\t0\t0\t0\t0\t0\tctx",
    ]
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")
    df = SC.read_claims_tsv(spark, path).collect()
    assert df[0].statement.startswith('"Quoted') and df[0].label == 3 and df[1].label == 5
    assert df[0].barely_true_counts == 1.0
    corpus = SC.read_claim_splits(spark, {"train": path}).collect()
    assert [r.label for r in corpus] == ["true", "false", None]
    assert {r.split for r in corpus} == {"train"}


def test_file_label_corpus_union_and_null_drop(spark):
    d = _tmp()
    real, fake = os.path.join(d, "real.csv"), os.path.join(d, "fake.csv")
    with open(real, "w") as f:
        f.write('id,title,url\n1,"A title, with comma",u\n2,,u\n3,null,u\n')
    with open(fake, "w") as f:
        f.write('id,title\n4,"He said ""hi"""\n')
    df = SC.corpus_by_file_label(spark, {"real": real, "fake": fake})
    rows = df.collect()
    assert {r.text for r in rows} >= {"A title, with comma", 'He said "hi"'}
    assert sum(1 for r in rows if r.text is None) == 1          # empty field only
    pandas_like = SC.corpus_by_file_label(spark, {"real": real, "fake": fake}, na_values=True)
    assert pandas_like.na.drop(subset=["text"]).count() == 2    # 'null' dropped too
    first = spark.createDataFrame([("x", "true", "claims", "train")], "text string, label string, source string, split string")
    u = SC.union_corpus([first, df])
    assert u.filter(F.col("source") == "titles").filter(F.col("split").isNull()).count() == 4


def test_eval_cases_checks(spark):
    d = _tmp()
    p = os.path.join(d, "cases.csv")
    with open(p, "w") as f:
        f.write('text,label\n"A ""quoted"", text",true\nplain,false\nthird,false\n')
    df = SC.read_eval_cases(spark, p)
    assert df.schema["label"].dataType.simpleString() == "string"
    assert df.collect()[0].text == 'A "quoted", text'
    assert SC.read_eval_cases(spark, p, limit=2).count() == 2
    with pytest.raises(FileNotFoundError):
        SC.read_eval_cases(spark, os.path.join(d, "missing.csv"))
    q = os.path.join(d, "bad.csv")
    with open(q, "w") as f:
        f.write("headline,label\nx,true\n")
    with pytest.raises(ValueError):
        SC.read_eval_cases(spark, q)


def test_csv_and_lines_sinks(spark):
    d = _tmp()
    df = spark.createDataFrame([("a, \"b\"", "true"), ("c", "mixed")], "text string, label string")
    SK.write_csv(df, os.path.join(d, "out"))
    back = SC.read_eval_cases(spark, os.path.join(d, "out"))
    assert sorted(r.text for r in back.collect()) == ['a, "b"', "c"]
    cases = spark.createDataFrame([(i, f"case{i}", i % 3 != 0) for i in range(1, 11)],
                                  "ord long, case_name string, passed boolean")
    lines = SK.pass_rate_lines(cases)
    SK.write_lines(lines, os.path.join(d, "lines"))
    text = spark.read.text(os.path.join(d, "lines")).collect()
    got = [r.value for r in text]
    assert got[0] == "PASSED - case1" and got[2] == "FAILED - case3" and got[-1] == "7/10 passed" and got[-2] == ""


def test_claims_tsv_provenance_and_broken_lines(spark):
    d = _tmp()
    with open(os.path.join(d, "a.tsv"), "w") as f:
        f.write("1\ttrue\tfine\ts\tp\tj\tst\tpa\t1\t2\t3\t4\t5\tctx\n2\ttrue\tbroken\ts\tp\tj\tst\tpa\t1\tx\t3\t4\t5\tctx\n3\ttrue\tshort\n")
    got = {r.id: r for r in SC.read_claims_tsv(spark, d, provenance=True).collect()}
    assert {r.source_file for r in got.values()} == {"a.tsv"}
    assert got["1"].corrupt_line is None and got["2"].corrupt_line.startswith("2\ttrue") and got["3"].corrupt_line.startswith("3\t")
    assert got["2"].false_counts is None and got["2"].half_true_counts == 3.0 and got["2"].label == 3
    assert "corrupt_line" not in SC.read_claims_tsv(spark, d).columns


def test_tsv_sink_flattens_cells(spark):
    d = os.path.join(_tmp(), "out")
    SK.write_tsv(spark.createDataFrame([(1, 'a\tb\n"c', None), (2, "", "z")], "i int, t string, u string"), d)
    assert sorted(r.value for r in spark.read.text(d).collect()) == ['1\ta b "c\t', "2\t\tz"]


def test_scope_removes_what_was_written(spark):
    from claimlens.session import scratch_path, table_scope, write_table
    outside = write_table(spark.range(3), "kept")
    with table_scope(spark) as made:
        inner = write_table(spark.range(5), "gone")
        spark.range(2).write.parquet(scratch_path(spark, "also-gone"))
        assert inner.count() == 5 and all(os.path.exists(p.removeprefix("file:")) for p in made) and len(made) == 2
    assert not any(os.path.exists(p.removeprefix("file:")) for p in made)
    with pytest.raises(ZeroDivisionError):
        with table_scope(spark) as made:
            write_table(spark.range(1), "gone")
            raise ZeroDivisionError
    assert not os.path.exists(made[0].removeprefix("file:")) and outside.count() == 3


def test_no_table_is_left_behind_after_a_scoped_query(spark):
    import __spark_entry__ as e
    from claimlens.session import shared_dir, table_scope
    from tests.conftest import SF001
    root = shared_dir(spark).removeprefix("file:")
    before = set(os.listdir(root))
    with table_scope(spark) as made:
        assert e.queries()["prediction_report"](spark, SF001).count() > 1
    assert made and set(os.listdir(root)) == before
