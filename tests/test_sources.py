"""Readers, writers, resumable annotation, streaming."""

import json

import pytest
from pyspark.sql import functions as F

from judgex.operators import annotate, resume, sft
from judgex.sources import readers, sinks

SCHEMA = "case_no string, v int"


@pytest.fixture
def tree(tmp_path):
    (tmp_path / "2014").mkdir()
    (tmp_path / "out").mkdir()
    w = lambda name, text: (tmp_path / name).write_text(text, encoding="utf-8")
    w("2014/a.json", "\ufeff" + json.dumps([{"case_no": "1", "v": 1}, 5, {"case_no": "2", "v": 2}]))
    w("b.json", '[\n{"case_no": "3", "v": 3},\n{"case_')
    w("c.json", '{"case_no": "4", "v": 4}')
    w("out/d.json", json.dumps([{"case_no": "9", "v": 9}]))
    w("e.jsonl", '{"case_no": "5", "v": 5}\n\nbroken\n{"case_no": "6", "v": 6}\n')
    w("f.jsonl", '{"case_no": "7", "v": 7}\n')
    w("g.csv", '\ufeff案号,全文\n1,"一\n""二"""\n,\n3,三\n')
    return str(tmp_path)


def test_json_arrays(spark, tree):
    strict = readers.json_arrays(spark, tree, SCHEMA, exclude="out")
    assert sorted((r.case_no, r._pos) for r in strict.collect()) == [("1", 0), ("2", 2)]
    mended = readers.json_arrays(spark, tree, SCHEMA, recover=True, exclude="out")
    assert sorted(r.case_no for r in mended.collect() if r.case_no in "123") == ["1", "2", "3"]


def test_json_lines(spark, tree):
    got = readers.json_lines(spark, tree, SCHEMA).collect()
    assert sorted((r.case_no, r._pos) for r in got) == [("5", 0), ("6", 3), ("7", 0)]
    assert readers.json_lines_splittable(spark, tree, SCHEMA).count() == 3


def test_json_mixed_drops_files_with_broken_lines(spark, tree):
    assert sorted(r.case_no for r in readers.json_mixed(spark, tree, SCHEMA, exclude="out").collect()) == ["1", "2", "4", "7"]


def test_csv(spark, tree):
    df = readers.csv_tree(spark, tree)
    got = df.select("案号", readers.judgment_text(df).alias("t"), "_pos").orderBy("_pos").collect()
    assert [tuple(r) for r in got] == [("1", '一\n"二"', 0), (None, "", 1), ("3", "三", 2)]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("2013", "2013-05", "1", None), ("2013", "2013-06", "2", "x")], "year string, year_month string, case_no string, z string")
    path = str(tmp_path / "m")
    sinks.json_by_month(df, path)
    sinks.json_by_month(df.withColumn("z", F.lit("new")), path)
    assert spark.read.json(path).filter("z = 'new'").count() == 0
    sinks.json_by_month(df.filter("year_month = '2013-05'").withColumn("z", F.lit("new")), path, overwrite=True)
    assert sorted(r.z for r in spark.read.json(path).collect()) == ["new", "x"]
    sinks.json_arrays_by_month(df, str(tmp_path / "a"))
    (f,) = (tmp_path / "a/year=2013/year_month=2013-05").glob("*.txt")
    assert json.loads(f.read_text()) == [{"case_no": "1", "z": None}]


def test_sample_text_and_audits(spark, tmp_path):
    labels = spark.createDataFrame([("l", i, c, "20", "交付金额", "Z4") for i, c in enumerate(["a", "a", None, "b", "c", "d"])], "_file string, _pos int, case_no string, target_amount string, amount_type string, source_zone string")
    texts = spark.createDataFrame([("t", i, c, "理由", "事实") for i, c in enumerate(["a", "c", "c", "d"])], "_file string, _pos int, case_no string, z4 string, z3 string")
    g = sft.gated(labels, texts)
    assert [r.outcome for r in g.orderBy("_pos").collect()] == ["valid", "duplicate", "empty_case_no", "missing", "ambiguous", "valid"]
    sinks.sample_text(g.filter("outcome = 'valid'"), str(tmp_path / "t"))
    text = "".join(p.read_text() for p in (tmp_path / "t").glob("*.txt"))
    assert text.count("指令：") == 2 and text.endswith("}\n\n")
    sinks.audits(g, str(tmp_path / "x"))
    assert spark.read.json(str(tmp_path / "x")).count() == 4


@pytest.mark.parametrize("n, want", [(12000, "valid"), (12001, "overlength")])
def test_length_gate(spark, n, want):
    labels = spark.createDataFrame([("l", 0, "a", "20", "交付金额", "Z4")], "_file string, _pos int, case_no string, target_amount string, amount_type string, source_zone string")
    make = lambda size: spark.createDataFrame([("t", 0, "a", "字" * size, "事")], "_file string, _pos int, case_no string, z4 string, z3 string")
    base = sft.gated(labels, make(1)).first().sample.length - 1
    assert sft.gated(labels, make(n - base)).first().outcome == want


def test_unknown_type_and_status_do_not_matter(spark):
    labels = spark.createDataFrame([("l", 0, "a", "", "unknown", "none")], "_file string, _pos int, case_no string, target_amount string, amount_type string, source_zone string")
    texts = spark.createDataFrame([("t", 0, "a", "x", "y")], "_file string, _pos int, case_no string, z4 string, z3 string")
    assert sft.gated(labels, texts).first().outcome == "invalid_or_filtered_amount"
    assert sft.gated(labels, texts, include_unknown=True).first().outcome == "valid"


def test_resume_is_idempotent(spark):
    df = spark.createDataFrame([("f", i, c) for i, c in enumerate(["a", "b", None, "a", " "])], "_file string, _pos int, case_no string")
    once = resume.first_wins(df)
    assert sorted(r._pos for r in once.collect()) == [0, 1, 2, 4]
    assert sorted(r._pos for r in resume.remaining(once, once).collect()) == [2, 4]


def test_model_calls_retry_and_fall_back(spark):
    df = spark.createDataFrame([(1, "被告应当偿还借款二十万元。", ""), (2, "无", ""), (3, "", "")], "k int, z4 string, z3 string")

    def model(prompt, key):
        assert key in ("k1", "k2")
        raise RuntimeError("HTTP 500")

    out = annotate.answered_amounts(annotate.called(df, F.col("z4"), model, keys=("k1", "k2"), concurrency=2)).orderBy("k").collect()
    assert [(r.status, r.amount.target_amount) for r in out] == [("success", "200000"), ("failed", ""), ("skipped", "")]
    assert all(r.attempts == 1 for r in out)


def test_run_summary_and_vocabulary(spark, tmp_path):
    df = spark.createDataFrame([("success",), ("failed",)], "status string")
    r = sinks.run_summary(df, limit=5).first()
    assert (r.rows, r.success, r.failed, r.skipped, r.limit) == (2, 1, 1, 0, 5)
    p = tmp_path / "v.json"
    p.write_text('{"<pad>": 0}')
    with pytest.raises(ValueError):
        readers.vocabulary(str(p))
    (tmp_path / "latest_run.txt").write_text("r1\n")
    assert readers.run_folder(str(tmp_path)) == f"{tmp_path}/r1"


def test_streaming_annotates_each_file_once(spark, tmp_path):
    from judgex.streaming.incremental import annotate_new_files

    src = tmp_path / "in"
    src.mkdir()
    for i in range(2):
        (src / f"{i}.json").write_text(json.dumps({"case_no": str(i), "z4": "被告应当偿还借款二十万元。", "z3": ""}))
        q = annotate_new_files(spark, str(src), str(tmp_path / "out"), str(tmp_path / "cp"))
        q.awaitTermination()
        assert spark.read.parquet(str(tmp_path / "out")).count() == i + 1


def test_merge_twice_adds_nothing(spark, tmp_path):
    schema = "source_file string, case_no string, note string"
    path = str(tmp_path / "merged")
    spark.createDataFrame([("f", "1", None), ("f", "2", "x")], schema).write.json(path)
    new = spark.createDataFrame([("f", "1", "later"), ("f", "3", None), ("f", "3", "y")], schema)
    for _ in range(2):
        sinks.merge(spark.read.schema(schema).json(path), new, path)
        got = spark.read.schema(schema).json(path)
        assert sorted((r.case_no, r.note) for r in got.select("case_no", "note").fillna("-").collect()) == [("1", "-"), ("2", "x"), ("3", "-")]
