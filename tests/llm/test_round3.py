"""Token shards, importance resampling and dual-tree clustering against brute force, round trips and edge cases."""

import hashlib
import math
import random
import re
import string
import struct
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from judgex.llm import clustering, covertree, kernels, resampling, simple8b, tokens

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
DOCS = "doc_id long, text string, Text2 string, start long"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, repeated and null ids, empty, long and repeated texts, columns that clash with the operators' own."""
    rng = random.Random(2)
    texts = [" ".join(rng.choices(["ab", "Cd", "é1", "don't", "'s", "x" * 70, "\n", "  ", "汉字", "42"], k=rng.randint(0, 60))) for _ in range(60)]
    rows = [(i, t, "z", i) for i, t in enumerate(texts)] + [(7, texts[7], "z", 0), (7, "other words here", "z", 0), (None, "no id", "z", 0), (None, None, "z", 0), (90, "", "z", 0), (91, None, "z", 0)]
    rows += [(92, "word " * 60_000, None, 0), (93, "a<|endoftext|>b", None, None)] + [(5, f"hot {i % 3}", None, i) for i in range(40)]
    return spark.createDataFrame(rows, DOCS).repartition(3)


# Simple-8b


@pytest.mark.parametrize("n", [0, 1, 59, 61, 1024, 3000])
@pytest.mark.parametrize("most", [1, 9, 50_000, (1 << 31) - 1, 1 << 60, (1 << 64) - 1])
def test_words_round_trip(n, most):
    ids = np.random.default_rng(n).integers(0, most, n, np.uint64, endpoint=True)
    ids[n // 3 : n // 2] = ids[:1] if n else 0
    for block in (5, 64, simple8b.BLOCK):
        b = simple8b.encode(ids, block)
        assert (simple8b.decode(b) == ids).all() and int(b.ids.sum()) == n
        shard = simple8b.Shard(simple8b.pack(ids, [(None, n)], block=block) + b"\0")
        assert (shard.ids() == ids).all() and (shard.ids(7, n - 3) == ids[7 : max(7, n - 3)]).all()


def test_words_are_full():
    """Words hold what their selector says, and a greedy choice can't hold more."""
    ids = np.arange(60, dtype=np.uint64) % 2
    assert len(simple8b.encode(ids).words) == 1 and len(simple8b.encode(np.full(1000, 7, np.uint64)).words) == 1
    assert len(simple8b.encode(np.array([40_000] * 2 + [50_000] * 1, np.uint64)).words) == 1
    b = simple8b.encode(np.array([1 << 63, 3, (1 << 60)], np.uint64))
    assert (b.words >> np.uint64(60)).tolist()[0] == simple8b.ESCAPE and b.escapes.tolist() == [1 << 63, 1 << 60]


def test_damaged_shards_raise():
    content = simple8b.pack(np.arange(50, dtype=np.uint64), [(1, 50)]) + b"\0"
    for bad in (content[:-3], content[: len(content) // 2], b"", content[:50] + b"!" + content[51:]):
        with pytest.raises(ValueError):
            simple8b.Shard(bad)


def test_pieces_agree_with_the_library():
    p, rng = tokens.Pieces(tokens.vocabulary_path()), random.Random(1)
    odd = ["'", "s", "t", "re", "ve", "l", "d", "m", " ", "  ", "\n", "\t", "1", "²", "½", "é", "汉", " ", "́", "🙂", "A", "!", "\r\n", "​", "Ⅷ", "\x00", "_", "　", "\x85", "\x1c", "<|endoftext|>"]
    for k in (len(odd), len(odd) - 1):
        texts = ["".join(rng.choices(odd[:k], k=rng.randint(0, 30))) for _ in range(3000)]
        for s in kernels.slabs(pa.array(texts), 5000):
            ids, sizes = p.encode(s)
            assert np.split(ids, np.cumsum(sizes)[:-1])[0].tolist() == p.tokenizer.encode(texts[s.lo], add_special_tokens=False).ids
            assert ids.tolist() == [x for t in texts[s.lo : s.hi] for x in p.tokenizer.encode(t, add_special_tokens=False).ids]


def _want_tokens(rows):
    t = tokens.Pieces(tokens.vocabulary_path()).tokenizer
    return [(d, t.encode(x or "", add_special_tokens=False).ids + [2]) for d, x in rows]


@pytest.mark.parametrize("parts", [1, 7])
def test_shards_brute_force(spark, odd, tmp_path, parts):
    tokens.write(odd, f"file://{tmp_path}/s", tokens.vocabulary_path(), parts=parts, shard_ids=500)
    got = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in tokens.read(spark, f"file://{tmp_path}/s").collect())
    assert [r[1] for r in got] == sorted((r[1] for r in got), key=lambda d: (d is not None, d or 0))  # ascending, nulls first
    assert [r[0] for r in got] == [0, *np.cumsum([r[2] for r in got]).tolist()][:-1]
    crc = lambda ids: (len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids)))
    want = Counter((d, *crc(ids)) for d, ids in _want_tokens([(r.doc_id, r.text) for r in odd.collect()]))
    assert Counter((r[1], r[2], r[3]) for r in got) == want


def test_hot_ids_are_spread(spark, odd):
    parts = {r.part for r in tokens.encoded(odd, 9, tokens.vocabulary_path()).filter("doc_id = 5").select("part").collect()}
    assert len(parts) > 1


def test_tokens_query(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    at, want = 0, {}
    for d, ids in _want_tokens([(r.doc_id, r.text) for r in rows]):
        want[d] = (at, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids)))
        at += len(ids)
    assert {r.doc_id: tuple(r)[1:] for r in tokens.op11_token_ids(spark, SF).collect()} == want


# Importance resampling


def test_crc_of_many():
    rng = random.Random(3)
    words = [bytes(rng.randrange(256) for _ in range(rng.choice([0, 1, 3, 9, 64, 65, 200]))) for _ in range(400)]
    data, ends = np.frombuffer(b"".join(words), np.uint8), np.cumsum([len(w) for w in words])
    before = np.array([rng.randrange(1 << 32) for _ in words], np.uint32)
    got = resampling.crc32(data, ends - [len(w) for w in words], ends, before)
    assert got.tolist() == [zlib.crc32(w, int(b)) for w, b in zip(words, before)]


def _features(text, n, buckets):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    return len(w), Counter(zlib.crc32(" ".join(w[i : i + k]).encode()) % buckets for k in range(1, n + 1) for i in range(len(w) - k + 1))


def _drawn(docs, target, percent, least, seed, n, buckets):
    """Rows (doc_id, n_features, weight, score) and, in order, the scores and ids that are drawn."""
    each, s, t = [(d, *_features(x, n, buckets)) for d, x in docs], Counter(), Counter()
    for _, _, c in each:
        s.update(c)
    for x in target:
        t.update(_features(x, n, buckets)[1])
    S, T = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets)))) for b in range(buckets)]
    rows, able = [], []
    for d, words, c in each:
        size = sum(c.values())
        weight = sum(gain[b] * k for b, k in c.items()) // size if size else 0
        h = int(hashlib.sha256(f"{seed}:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        rows.append((d, size, weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
        if words >= least:
            able.append((-rows[-1][3], d is None, d or 0))
    return rows, [(-a, None if late else d) for a, late, d in sorted(able)[: percent * len(able) // 100]]


@pytest.mark.parametrize(("n", "buckets", "least", "percent"), [(2, 10_000, 20, 25), (3, 50, 1, 60), (1, 7, 5, 100)])
def test_resampling_brute_force(spark, odd, monkeypatch, n, buckets, least, percent):
    monkeypatch.setattr(resampling, "STRIP_BYTES", 600)
    monkeypatch.setattr(resampling, "SALT_STRIPS", 4)
    target = ["ab ab Cd cd", None, "", "é1 words here 42 42"]
    got = resampling.draw(odd, spark.createDataFrame([(1, x, "b") for x in target], "item_id long, text string, bucket string"), percent, least, 7, n, buckets).collect()
    rows, order = _drawn([(r.doc_id, r.text) for r in odd.collect()], target, percent, least, 7, n, buckets)
    assert Counter(tuple(r)[:4] for r in got) == Counter(rows)
    ranked = sorted((r.rank, r.score, r.doc_id) for r in got if r["rank"] is not None)
    assert [r[0] for r in ranked] == [*range(1, len(order) + 1)] and [r[1:] for r in ranked] == order


def test_resampling_query(spark):
    docs, bench = (spark.read.parquet(f"{SF}/{t}.parquet").collect() for t in ("documents", "benchmark"))
    rows, order = _drawn([(r.doc_id, r.text) for r in docs], [r.text for r in bench], 25, 20, 7, 2, 10_000)
    rank = {d: i + 1 for i, (_, d) in enumerate(order)}
    assert {tuple(r) for r in resampling.op12_importance_resampling(spark, SF).collect()} == {(*r, rank.get(r[0])) for r in rows}


def test_resampling_prefers_the_target(spark):
    rng = random.Random(6)
    near, far = [f"law{i}" for i in range(40)], [f"fun{i}" for i in range(40)]
    docs = [(i, " ".join(rng.choices(near if i % 4 == 0 else far, k=50))) for i in range(200)]
    got = resampling.draw(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(1, " ".join(near * 4))], "item_id long, text string")).collect()
    drawn = [r for r in got if r["rank"] is not None]
    assert len(drawn) == 50 and sum(r.doc_id % 4 == 0 for r in drawn) > 1.5 * 50 / 4  # noise leaves others a chance
    assert min(r.weight for r in got if r.doc_id % 4 == 0) > max(r.weight for r in got if r.doc_id % 4)


# Clustering


@pytest.mark.parametrize(("n", "k", "dim", "spread"), [(1, 1, 3, 5), (40, 5, 2, 3), (700, 16, 64, 100), (900, 120, 8, 30), (500, 16, 4, 0), (300, 20, 64, 1 << 27)])
def test_dual_trees_find_the_nearest(n, k, dim, spread):
    rng = np.random.default_rng(n)
    centroids = rng.integers(-spread, spread + 1, (k, dim))
    points = centroids[rng.integers(0, k, n)] + rng.integers(-3, 4, (n, dim))
    points[: n // 3] = points[0]
    centroids[k // 2 + k % 2 :] = centroids[: k // 2]
    tree, ctree = covertree.build(points), covertree.build(centroids, leaf=1)
    ordered = points[tree.order]
    assert sorted(tree.order.tolist()) == [*range(n)] and tree.hi[0] == n
    for i in range(len(tree.centre)):
        own = ordered[tree.lo[i] : tree.hi[i]]
        assert tree.lo[i] <= tree.centre[i] < tree.hi[i] and (np.sqrt(covertree.squared(own, ordered[tree.centre[i]])) <= tree.radius[i]).all()
        heads = [int(tree.centre[c]) for c in covertree._children(tree, i)]
        for a in range(len(heads)):  # siblings' centres are further apart than the scale
            for b in range(a):
                assert covertree.squared(ordered[heads[a]][None], ordered[heads[b]])[0] > 0
    best, settled, counts = covertree.nearest(tree, ordered, ctree, centroids[ctree.order])
    want = [int(covertree.squared(centroids, x).argmin()) for x in ordered]
    assert best.tolist() == want and all((best[lo:hi] == c).all() for lo, hi, c in settled) and counts.exact <= n * k


def test_pruning_saves_comparisons(spark):
    points = clustering.quantised(spark.read.parquet(f"{SF}/embeddings.parquet"))
    trees, n = clustering.blocks(points, 64), points.count()
    _, did = clustering.lloyd(trees, np.array(clustering.seeds(points, 16, 1)), 2)
    assert all(c.exact < 16 * n / 4 and c.settled > n / 2 for c in did)


def test_clusters_match_sql(same):
    same(clustering.op13_centroid_clusters, clustering.ORACLE)


def test_odd_vectors(spark, monkeypatch):
    monkeypatch.setattr(clustering, "BLOCK", 16)
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(0, 2, 4)], "c", -1) for i in range(60)] + [(3, [0.0] * 4, "c", 0)] * 40 + [(None, [1.0] * 4, "c", 0)]
    rows += [(100, None, "c", 0), (101, [1.0] * 3, "c", 0), (102, [1.0, None, 1.0, 1.0], "c", 0), (103, [float("nan")] * 4, "c", 0), (104, [float("inf")] * 4, "c", 0), (105, [1e300, -1e300, 0.0, 0.0], "c", 0), (106, [], "c", 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, cluster string, distance int").repartition(3)
    kept = [(v, [max(-(1 << 27), min(1 << 27, math.floor(64 * x))) if abs(x) < 1e200 else (1 << 27) * (1 if x > 0 else -1) for x in e]) for v, e, *_ in rows if e and len(e) == 4 and None not in e and all(map(math.isfinite, e))]
    for k in (3, 200):
        first = sorted((hashlib.sha256(f"1:{'' if v is None else v}".encode()).hexdigest(), p) for v, p in kept)[:k]
        cs = [p for _, p in first]
        near = lambda p: min((sum((a - b) ** 2 for a, b in zip(p, c)), i) for i, c in enumerate(cs))  # noqa: B023, E731
        for _ in range(3):
            at = [near(p)[1] for _, p in kept]
            cs = [[sum(x) // len(own) for x in zip(*own)] if (own := [p for (_, p), a in zip(kept, at) if a == i]) else c for i, c in enumerate(cs)]
        want = Counter((v, near(p)[1], near(p)[0], hashlib.sha256(",".join(map(str, cs[near(p)[1]])).encode()).hexdigest()) for v, p in kept)
        got = clustering.cluster(df, k=k, dim=4).collect()
        assert Counter((r.vec_id, r.cluster, r.distance, r.centroid_sha256) for r in got) == want
        assert {r.inertia for r in got} == {sum(r.distance for r in got)}
        assert all(r.cluster_inertia == sum(x.distance for x in got if x.cluster == r.cluster) for r in got)


def test_empty_tables(spark, tmp_path):
    docs = spark.createDataFrame([], DOCS)
    assert clustering.cluster(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
    assert resampling.draw(docs, spark.createDataFrame([], "item_id long, text string")).count() == 0
    tokens.write(docs, f"file://{tmp_path}/none", tokens.vocabulary_path())
    assert tokens.read(spark, f"file://{tmp_path}/none").count() == 0
    some = spark.createDataFrame([(1, "a b", "", 0)], DOCS)
    assert resampling.draw(some, spark.createDataFrame([], "item_id long, text string"), least_words=1, percent=100).first()["rank"] == 1
