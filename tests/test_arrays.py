"""JSON arrays read in byte ranges, against json.loads over odd files in tiny splits."""

import json
import random
import re

import pytest

from judgex.sources import arrays


def _value(rng, depth=0):
    k = rng.randrange(7 if depth < 3 else 4)
    if k < 4:
        return [rng.randrange(1000), "".join(rng.choices(["a", "}", "{", '"', "\\", "[", "]", ",", "é", "\n", " ", "汉"], k=rng.randrange(12))), None, rng.random() < 0.5][k]
    if k == 4:
        return [_value(rng, depth + 1) for _ in range(rng.randrange(4))]
    return {"k" + rng.choice(['"', "}", "", "\\", "x"]): _value(rng, depth + 1) for _ in range(rng.randrange(4))}


FIXED = ['{"a": [1, {"b": 2}]}', "", "[]", "[1, 2]\n", '[{"a": 1} {"b": 2}]', '[{"a": 1}, {"b": nope}, {"c": 3}]', '[{"a": 1}]]', '[{"a": 1}', '[{"a": 1}] x', '{"a": 1}, {"b": 2}', '﻿[{"a": 1}]', '[{"a": "}', '[{"a": {}}, {"b": {"c": 1}, "d', "  ", "nope", '"{}"']


def _texts(seed):
    rng = random.Random(seed)
    for i in range(40):
        a = [{"id": j, "v": _value(rng)} for j in range(rng.randrange(30))]
        if i % 5 == 0:
            a = [x for y in a for x in ([y] if rng.random() < 0.7 else [y, rng.choice([1, "s}{", None, [1, [2]], [{"z": 1}]])])]
        t = json.dumps(a, ensure_ascii=bool(i % 2), indent=rng.choice([None, None, 2]))
        yield t[: rng.randrange(len(t) + 1)] if i % 4 == 1 else t.lstrip("[") if i % 6 == 2 else t
    yield from FIXED


def _objects(text):
    try:
        found = json.loads(text)
    except ValueError:
        return None
    return [x for x in found if isinstance(x, dict)] if isinstance(found, list) else []


def _strict(text):
    return _objects(text.lstrip("﻿")) or []


def _recovered(text):
    text = text.lstrip("﻿").strip()
    if (whole := _objects(text)) is not None:
        return whole
    body = text[: text.rfind("}") + 1]
    return _objects(("" if body.startswith("[") else "[") + body + "]") or [] if body else []


@pytest.fixture
def tiny_splits(spark):
    conf = {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "1"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize(("seed", "mode", "want"), [(1, arrays.STRICT, _strict), (1, arrays.RECOVER, _recovered), (2, arrays.RECOVER, _recovered)])
def test_modes(spark, tmp_path, tiny_splits, seed, mode, want):
    texts = dict(enumerate(_texts(seed)))
    for i, t in texts.items():
        (tmp_path / f"{i}.json").write_text(t, encoding="utf-8")
    assert max(len(t.encode()) for t in texts.values()) > 900 and arrays._pieces(spark, str(tmp_path), "*.json", None).rdd.getNumPartitions() > 40
    got = {}
    for r in arrays.json_array_elements(spark, str(tmp_path), mode).collect():
        got.setdefault(int(re.search(r"(\d+)\.json$", r._file)[1]), {})[r._pos] = json.loads(r._json)
    for i, t in texts.items():
        own = got.get(i, {})
        assert sorted(own) == [*range(len(own))] and [own[k] for k in sorted(own)] == want(t), t


def test_salvage_keeps_whole_elements(spark, tmp_path, tiny_splits):
    (tmp_path / "a.json").write_text('[{"a": 1}, {"b": {"c": 2}, "d": [{"e": 1}], "f')
    (tmp_path / "b.json").write_text('[{"a": 1}, {"b": nope}, {"c": 3}')
    got = {(r._file[-6:], r._pos): json.loads(r._json) for r in arrays.json_array_elements(spark, str(tmp_path), arrays.SALVAGE).collect()}
    assert got == {("a.json", 0): {"a": 1}, ("b.json", 0): {"a": 1}, ("b.json", 2): {"c": 3}}


def test_one_large_file_takes_several_tasks(spark, tmp_path, tiny_splits):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    rows = [{"id": i, "t": "x}{\\\"" * (i % 50)} for i in range(3000)]
    (tmp_path / "one.json").write_text(json.dumps(rows))
    df = arrays.json_arrays(spark, str(tmp_path), "id long, t string")
    assert {(r._pos, r.id, r.t) for r in df.collect()} == {(r["id"], r["id"], r["t"]) for r in rows}
    assert arrays._pieces(spark, str(tmp_path), "*.json", None).rdd.getNumPartitions() > 4


def test_excluded_folders(spark, tmp_path):
    for d in ("in", "in/out"):
        (tmp_path / d).mkdir()
        (tmp_path / d / "x.json").write_text(f'[{{"d": "{d}"}}]')
    assert [r.d for r in arrays.json_arrays(spark, str(tmp_path / "in"), "d string", exclude=str(tmp_path / "in/out")).collect()] == ["in"]
