"""Month stores that survive interruptions, listings, the resume index' plan, limits by group, the boundary scorer, records."""

import json
import math

import pytest
from pyspark.sql import functions as F

from judgex.functions import zones
from judgex.operators import resume, scorer
from judgex.operators.resume_index import ResumeIndex
from judgex.sources import files, months

ROWS = "k int, year string, year_month string, _file string"


def _rows(spark, *rows):
    return spark.createDataFrame([(k, m[:4], m, f) for k, m, f in rows], ROWS)


def _stored(spark, path):
    return sorted((r.year_month, r.k, r.run) for r in months.read(spark, path, "k int").collect())


def test_months_skip(spark, tmp_path):
    path = str(tmp_path / "m")
    df = _rows(spark, (1, "2020-01", "a/2020-01.csv"), (2, "2020-01", "b/2020-01.csv"), (3, "2020-02", "a/2020-02.csv"))
    months.write(df, path, run="r1")
    months.write(df.withColumn("k", F.col("k") + 10), path, run="r2")
    assert _stored(spark, path) == [("2020-01", 1, "r1"), ("2020-02", 3, "r1")] and months.months(spark, path) == [("2020", "2020-01"), ("2020", "2020-02")]
    months.write(_rows(spark, (4, "2020-03", "x"), (5, "2020-01", "x")), path, run="r3")
    months.write(_rows(spark, (6, "2020-03", "x")), path, months.APPEND, run="r4")
    months.write(_rows(spark, (7, "2020-02", "x")), path, months.OVERWRITE, run="r5")
    assert _stored(spark, path) == [("2020-01", 1, "r1"), ("2020-02", 7, "r5"), ("2020-03", 4, "r3"), ("2020-03", 6, "r4")]
    months.write(df.limit(0), path, run="r6")
    assert len(_stored(spark, path)) == 4
    with pytest.raises(ValueError):
        months.write(df, path, "replace")


@pytest.mark.parametrize(("mode", "moves"), [(m, n) for m in (months.SKIP, months.APPEND, months.OVERWRITE) for n in range(2 if m == months.SKIP else 3)])
def test_interrupted_moves_are_finished(spark, tmp_path, monkeypatch, mode, moves):
    path = str(tmp_path / "m")
    months.write(_rows(spark, (0, "2020-02", "x")), path, run="r0")
    df = _rows(spark, (1, "2020-01", "a"), (2, "2020-02", "a"), (3, "2020-03", "a"))
    left, rename = moves, files.Files.rename

    def breaks(self, old, new):
        nonlocal left
        if not left:
            raise KeyboardInterrupt
        left -= 1
        rename(self, old, new)

    monkeypatch.setattr(files.Files, "rename", breaks)
    with pytest.raises(KeyboardInterrupt):
        months.write(df, path, mode, run="r1")
    monkeypatch.undo()
    assert not any(r[1] == 3 for r in _stored(spark, path))
    assert months.repair(spark, path) == {"r1": "finished"} and months.repair(spark, path) == {}
    own = {months.SKIP: [("2020-02", 0, "r0")], months.APPEND: [("2020-02", 0, "r0"), ("2020-02", 2, "r1")], months.OVERWRITE: [("2020-02", 2, "r1")]}[mode]
    assert _stored(spark, path) == [("2020-01", 1, "r1"), *own, ("2020-03", 3, "r1")]
    months.write(df, path, months.SKIP, run="r2")  # a rerun adds nothing
    assert len(_stored(spark, path)) == 2 + len(own)


def test_interrupted_writes_are_taken_back(spark, tmp_path):
    path = str(tmp_path / "m")
    months.write(_rows(spark, (0, "2020-02", "x")), path, run="r0")
    bad = _rows(spark, (1, "2020-01", "a"), (2, "2020-02", "a")).withColumn("k", F.when(F.col("k") == 1, F.col("k")).otherwise(F.raise_error(F.lit("killed"))))
    with pytest.raises(Exception, match="killed"):
        months.write(bad, path, months.APPEND, run="r1")
    assert _stored(spark, path) == [("2020-02", 0, "r0")]
    assert months.repair(spark, path) == {"r1": "taken back"} and _stored(spark, path) == [("2020-02", 0, "r0")]


def test_listing(spark, tmp_path):
    for f in ("b/2.json", "b/10.json", "a-b/1.json", "a/1.json", "a/out/1.json", "a/out/deep/2.json", "a/x.txt", "0.json"):
        (tmp_path / f).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / f).write_text("{}")
    below = lambda df: [r._file.split(f"{tmp_path}/")[1] for r in files.ordered(df).collect()]
    base = f"file://{tmp_path}"
    assert below(files.listed(spark, base, "*.json", exclude=f"{base}/a/out")) == ["0.json", "a/1.json", "a-b/1.json", "b/10.json", "b/2.json"]
    assert len(below(files.listed(spark, base))) == 8 and below(files.listed(spark, base, "1*.json", exclude=base)) == []
    assert sorted(r.rsplit("/", 1)[-1] for r in files.roots(spark, base, f"{base}/a/out")) == ["0.json", "1.json", "a-b", "b", "x.txt"]
    assert files.roots(spark, base, f"{base}/elsewhere/../../other") == [files.Files(spark).qualified(base)]
    with pytest.raises(FileExistsError):
        files.Files(spark).rename(f"{base}/0.json", f"{base}/a/1.json")


def test_input_folders_and_vocabularies(spark, tmp_path):
    base = f"file://{tmp_path}"
    with pytest.raises(FileNotFoundError):
        files.input_folder(spark, base)
    (tmp_path / "latest_run.txt").write_text("﻿run7\n", encoding="utf-8")
    assert files.input_folder(spark, base) == f"{base}/run7" and files.input_folder(spark, base, run="r") == f"{base}/r" and files.input_folder(spark, base, "/x", "r") == "/x"
    (tmp_path / "v.json").write_text(json.dumps({"<pad>": 0, "<unk>": 1, "借": 2}), encoding="utf-8-sig")
    assert files.vocabulary(spark, f"{base}/v.json")["借"] == 2
    (tmp_path / "w.json").write_text('{"<pad>": 0}')
    with pytest.raises(ValueError):
        files.vocabulary(spark, f"{base}/w.json")


def test_index_side_has_no_exchange(spark, tmp_path):
    path = f"file://{tmp_path}/index"
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        index = ResumeIndex(spark, "test_resume_index", path, 8)
        df = spark.range(200).selectExpr("concat('c', id) AS case_no", "CASE WHEN id % 10 = 0 THEN 'failed' ELSE 'success' END AS status", "id")
        index.add(df.filter("id < 50"), "case", only_success=True)
        index.add(df.filter("id >= 40 AND id < 100"), "case")
        rest = index.remaining(df.unionByName(df.limit(1).withColumn("case_no", F.lit(" "))), "case")
        assert sorted(r.id for r in rest.collect()) == [0, *(i for i in range(40) if i % 10 == 0), *range(100, 200)]
        plan = rest._jdf.queryExecution().executedPlan().toString()
        head, tail = plan.split("SortMergeJoin")[-1].split("test_resume_index")[0], plan
        assert tail.count("Exchange hashpartitioning") in (1, 2) and "Bucketed: true" in tail  # AQE shows the plan as it was and as it ended
        index_side = plan[plan.index("FileScan parquet spark_catalog.default.test_resume_index") - 400 : plan.index("FileScan parquet spark_catalog.default.test_resume_index")]
        assert index_side.rsplit("Sort [", 1)[-1].count("Exchange") == 0 and head is not None
        index.drop()
        again = ResumeIndex(spark, "test_resume_index_2", path, 8)
        assert again.remaining(df, "case").count() == 104
        again.drop()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_limits_stop_early(spark):
    df = spark.range(5000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('g', id % 50) END AS g")
    top = resume.first_of_each(df, 2, ["g"], F.col("id").desc())
    assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()
    got = {}
    for r in top.collect():
        got.setdefault(r.g, []).append(r.id)
    assert all(sorted(v, reverse=True) == sorted((i for i in range(5000) if ("hot" if i % 3 == 0 else f"g{i % 50}") == g), reverse=True)[:2] for g, v in got.items()) and len(got) == 51
    assert [r.id for r in resume.first_rows(df, 3, F.col("id").desc()).collect()] == [4999, 4998, 4997]


# the scorer


def test_pooling_by_hand(spark):
    sentences = spark.createDataFrame([(1, 0, [2, 3, 2, 0, 0]), (1, 1, [0, 0]), (1, 2, [9]), (2, 0, [3]), (2, 1, [])], "k int, i int, ids array<int>")
    vectors = spark.createDataFrame([(0, [9.0, 9.0]), (2, [1.0, 4.0]), (3, [4.0, -2.0])], "id int, v array<double>")
    got = {(r.k, r.i): (r.n, r.v) for r in scorer.pooled(sentences, vectors, 2, ["k", "i"]).collect()}
    assert got == {(1, 0): (3, [2.0, 2.0]), (1, 1): (0, [0.0, 0.0]), (1, 2): (1, [0.0, 0.0]), (2, 0): (1, [4.0, -2.0]), (2, 1): (0, [0.0, 0.0])}
    scored = scorer.pooled(sentences, vectors, 2, ["k", "i"])
    heads = [scorer.score("v", scorer.Head([1, 1])), scorer.score("v", scorer.Head([0, -1], 5.0)), F.lit(0.0)]
    assert {r.k: r.picks for r in scorer.picked(scored, ["k"], "i", heads).collect()} == {1: [0, 1, 0], 2: [0, 0, 0]}
    masked = scorer.picked(scored, ["k"], "i", heads, (F.col("k") == 1) & (F.col("i") > 0))
    assert {r.k: r.picks for r in masked.collect()} == {1: [1, 1, 1], 2: [0, 0, 0]}


def test_scored_boundaries(spark):
    texts = {1: "甲号。乙乙。丙判决如下：丁。", 2: "", 3: None, 4: "丙。\n \n甲。"}
    vocabulary = {"甲": 2, "乙": 3, "丙": 4, "。": 5}
    vectors = {2: [1.0, 0.0, 0.0], 3: [0.0, 1.0, 0.0], 4: [0.0, 0.0, 1.0], 5: [0.1, 0.1, 0.1], 1: [-1.0, -1.0, -1.0]}
    heads = [scorer.Head([1, 0, 0]), scorer.Head([0, 1, 0]), scorer.Head([0, 0, 1]), scorer.Head([0, 0, 1]), scorer.Head([-1, -1, -1]), scorer.Head([-1, -1, -1])]
    df = spark.createDataFrame(list(texts.items()), "k int, text string")
    cuts = {r.k: [tuple(s) for s in r.s] for r in df.select("k", zones.slices(zones.boundaries("text")).alias("s")).collect()}
    want = {}
    for k, t in texts.items():
        means = []
        for a, b in cuts[k]:
            ids = [vocabulary.get(c, 1) for c in t[a:b] if c.strip()] or [1]
            means.append([math.fsum(vectors[i][d] for i in ids) / len(ids) for d in range(3)])
        ends, top = [], 0
        for h in heads if means else []:
            scores = [round(sum(w * x for w, x in zip(h.weights, m)), 9) for m in means]
            top = max(top, cuts[k][scores.index(max(scores))][1])
            ends.append(top)
        want[k] = ends
    v = spark.createDataFrame(list(vocabulary.items()), "char string, id int")
    got = scorer.boundaries(df, v, spark.createDataFrame(list(vectors.items()), "id int, v array<double>"), 3, heads).collect()
    assert {r.k: r.boundaries for r in got} == want and {r.k for r in got} == set(texts)


# records


def test_partition_of_one_text(spark):
    text = "某法院（2020）民初1号原告张三，被告李四。经审理查明，借款十万元。本院认为，应当归还。判决如下：归还。"
    got = zones.partition_text(spark, text)
    assert got["text_length"] == len(text) and got["boundaries"] == sorted(got["boundaries"]) and "".join(z["text"] for z in got["zones"].values()) == text
    assert zones.partition_text(spark, None)["anchor_status"] == zones.partition_text(spark, "")["anchor_status"] == "empty_or_unsplittable"
    df = spark.createDataFrame([("", text, "c1"), ("号。", "x", None)], "text string, full_text string, case_no string")
    rows = zones.partition_records(df).collect()
    assert [r.text_length for r in rows] == [len(text), 2] and rows[0].case_no == "c1" and "sample_id" not in zones.partition_records(df).columns
