"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Patterns are the windows of benchmark items: 13 consecutive words, or all words of a shorter item. Patterns of
one length are searched together. A block of two words (one, for one-word patterns) ending at a text
position gives, by table, the number of words that can be skipped; where that is zero, a bucket by the hash of the
patterns' last block names the patterns to compare, word by word.

The benchmark is a stated query set. Its patterns go to every task in blocks of at most ``BLOCK_BYTES`` of
item text, measured before anything is collected; a larger benchmark takes several passes over the documents, one block at a time,
whose written results are merged by row, so neither the driver nor a task ever holds more of it than a block.

Defined results: null and wordless texts have no words and are never contaminated; items that are null or wordless
have no windows; items with equal windows are all found; an item without item_id hits like any other and
counts as one item, but is left out of the digest; rows with null or repeated doc_id are judged one by one; an
empty benchmark hits nothing. Further columns are ignored by ``scan`` and returned unchanged by ``drop``.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from judgex.llm import kernels as K
from judgex.llm.arrow import batched, over, table
from judgex.session import cut

WINDOW = 13
BLOCK_BYTES = 8 << 20


class Class(NamedTuple):
    """Search tables of the patterns of one length (in words)."""

    length: int
    bits: int
    shift: np.ndarray
    buckets: dict[int, list[int]]
    patterns: list[tuple[bytes, ...]]
    items: list[frozenset]


def _tokens(text: bytes) -> tuple[list[bytes], np.ndarray]:
    data = K.LOWER[np.frombuffer(text, np.uint8)]
    w = K.words(data, np.array([0, len(data)]), K.NON_ALNUM)
    raw = data.tobytes()
    return [raw[a:b] for a, b in zip(w.starts.tolist(), w.ends.tolist())], K.RangeHash(data)(w.starts, w.ends)


def _blocks(h: np.ndarray, length: int) -> np.ndarray:
    """Hash of the block that ends at each word; the first of two-word blocks has no meaning."""
    return K.mix(h) if length < 2 else np.concatenate((h[:1], K.runs(h, 2)))


def build(items: list[tuple[object, str | None]], window: int = WINDOW) -> list[Class]:
    """Search tables for the items' windows."""
    found: dict[int, dict[tuple, tuple[set, np.ndarray]]] = defaultdict(dict)
    for item, text in items:
        toks, h = _tokens((text or "").encode())
        m = min(window, len(toks))
        for i in range(len(toks) - m + 1 if m else 0):
            found[m].setdefault(tuple(toks[i : i + m]), (set(), h[i : i + m]))[0].add(item)
    out = []
    for m, pats in sorted(found.items()):
        b = min(2, m)
        bits = max(12, (len(pats) * m * 16).bit_length())
        bits = min(bits, 24)
        shift = np.full(1 << bits, m - b + 1, np.uint8)
        buckets: dict[int, list[int]] = defaultdict(list)
        for i, (_, h) in enumerate(pats.values()):
            bh = _blocks(h, m)
            for j in range(b - 1, m):
                at = int(bh[j] >> np.uint64(64 - bits))
                shift[at] = min(shift[at], m - 1 - j)
            buckets[int(bh[-1])].append(i)
        out.append(Class(m, bits, shift, dict(buckets), list(pats), [frozenset(x[0]) for x in pats.values()]))
    return out


def search(s: K.Slab, classes: list[Class]) -> tuple[np.ndarray, np.ndarray, list[set]]:
    """Words, hit words and the items found, of each row."""
    data = K.LOWER[s.data]
    w = K.words(data, s.offs, K.NON_ALNUM)
    n_words = np.diff(w.first)
    items: list[set] = [set() for _ in range(s.n)]
    h = K.RangeHash(data)(w.starts, w.ends)
    raw, lo, hi = data.tobytes(), [], []
    for c in classes:
        m = c.length
        if len(h) < m:
            continue
        bh = _blocks(h, m)
        skip = c.shift[bh >> np.uint64(64 - c.bits)].tobytes()
        for r in np.flatnonzero(n_words >= m).tolist():
            i, end = int(w.first[r]) + m - 1, int(w.first[r + 1])
            while i < end:
                if d := skip[i]:
                    i += d
                    continue
                for p in c.buckets.get(int(bh[i]), ()):
                    a = i - m + 1
                    if all(raw[w.starts[a + j] : w.ends[a + j]] == t for j, t in enumerate(c.patterns[p])):
                        items[r] |= c.items[p]
                        lo.append(a)
                        hi.append(i + 1)
                i += 1
    n_hit = np.zeros(s.n, np.int64)
    if lo:
        n_hit = np.bincount(w.row[K.coverage(len(h), np.array(lo), np.array(hi))], minlength=s.n)
    return n_words, n_hit, items


def digest(items: set) -> str:
    return hashlib.sha256(",".join(sorted(str(x) for x in items if x is not None)).encode()).hexdigest()


def _number_of_blocks(benchmark: DataFrame) -> int:
    size = benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return -(-size // BLOCK_BYTES) or 1


def _item_blocks(benchmark: DataFrame, n: int) -> Iterator[list[tuple[object, str | None]]]:
    """The benchmark's items, a bounded block at a time."""
    items = benchmark.select("item_id", "text").filter(F.col("text").isNotNull())
    for k in range(n):
        part = items if n == 1 else items.filter(F.pmod(F.xxhash64("text"), F.lit(n)) == k)
        yield [(r[0], r[1]) for r in part.collect()]


def _contaminated(n_words: np.ndarray, n_hit: np.ndarray) -> np.ndarray:
    return (n_hit > 0) & (20 * n_hit >= n_words)


_SCHEMA = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"


def scan(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Rows (doc_id, n_words, n_hit, n_items, items_sha256, contaminated)."""
    n = _number_of_blocks(benchmark)
    docs = docs.select(docs["doc_id"].cast("long"), "text")
    if n > 1:
        rows = cut(docs.withColumn("row", F.monotonically_increasing_id()), "decontaminate-rows")
        return _scan_in_passes(rows, benchmark, n, window).drop("row")
    (items,) = _item_blocks(benchmark, 1)
    shared = docs.sparkSession.sparkContext.broadcast(build(items, window))

    def f(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for s in K.slabs(b.column("text")):
            n_words, n_hit, items = search(s, shared.value)
            yield table(doc_id=b.column("doc_id").slice(s.lo, s.n), n_words=n_words, n_hit=n_hit, n_items=[len(x) for x in items], items_sha256=[digest(x) for x in items], contaminated=_contaminated(n_words, n_hit))

    return over(docs, f, _SCHEMA)


def _scan_in_passes(rows: DataFrame, benchmark: DataFrame, n: int, window: int) -> DataFrame:
    """A benchmark of several blocks: each pass over rows (row, doc_id, text) marks hit words, and rows are merged over the passes."""

    def one(block) -> DataFrame:
        def f(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            for s in K.slabs(b.column("text")):
                for i in range(s.n):
                    own = K.Slab(0, 1, s.data[s.offs[i] : s.offs[i + 1]], np.array([0, s.offs[i + 1] - s.offs[i]]), s.valid[i : i + 1])
                    marks, items = marked(own, block.value)
                    yield table(row=b.column("row").slice(s.lo + i, 1), doc_id=b.column("doc_id").slice(s.lo + i, 1), marks=[marks], items=[sorted(map(str, items - {None}))], nameless=[None in items])

        return over(rows, f, "row long, doc_id long, marks binary, items array<string>, nameless boolean")

    every = None
    for items in _item_blocks(benchmark, n):
        shared = rows.sparkSession.sparkContext.broadcast(build(items, window))
        found = cut(one(shared), "decontaminate-pass")
        shared.destroy()
        every = found if every is None else every.unionAll(found)
    merged = every.groupBy("row").agg(F.first("doc_id", True).alias("doc_id"), F.collect_list("marks").alias("marks"), F.flatten(F.collect_list("items")).alias("items"), F.max("nameless").alias("nameless"))

    def g(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        n_words, n_hit, sizes, shas = [], [], [], []
        for marks, items, nameless in zip(b.column("marks").to_pylist(), b.column("items").to_pylist(), b.column("nameless").to_pylist()):
            n_words.append(len(marks[0]))
            n_hit.append(int(np.any([np.frombuffer(m, np.uint8) for m in marks], axis=0).sum()) if marks[0] else 0)
            sizes.append(len(set(items)) + bool(nameless))
            shas.append(digest(set(items)))
        w, h = np.array(n_words, np.int64), np.array(n_hit, np.int64)
        yield table(row=b.column("row"), doc_id=b.column("doc_id"), n_words=w, n_hit=h, n_items=sizes, items_sha256=shas, contaminated=_contaminated(w, h))

    return over(merged, g, "row long, " + _SCHEMA)


def marked(s: K.Slab, classes: list[Class]) -> tuple[bytes, set]:
    """One row: a byte for each word, 1 if it is hit; the items found."""
    data = K.LOWER[s.data]
    w = K.words(data, s.offs, K.NON_ALNUM)
    h, raw, items = K.RangeHash(data)(w.starts, w.ends), data.tobytes(), set()
    marks = np.zeros(len(h), np.uint8)
    for c in classes:
        m = c.length
        if len(h) < m:
            continue
        bh = _blocks(h, m)
        skip, i = c.shift[bh >> np.uint64(64 - c.bits)].tobytes(), m - 1
        while i < len(h):
            if d := skip[i]:
                i += d
                continue
            for p in c.buckets.get(int(bh[i]), ()):
                a = i - m + 1
                if all(raw[w.starts[a + j] : w.ends[a + j]] == t for j, t in enumerate(c.patterns[p])):
                    items |= c.items[p]
                    marks[a : i + 1] = 1
            i += 1
    return marks.tobytes(), items


def drop(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents that aren't contaminated, with all their columns."""
    n = _number_of_blocks(benchmark)
    if n > 1:
        row = "__judgex_row"
        rows = cut(docs.withColumn(row, F.monotonically_increasing_id()), "decontaminate-rows")
        found = _scan_in_passes(rows.select(F.col(row).alias("row"), rows["doc_id"].cast("long").alias("doc_id"), "text"), benchmark, n, window)
        return rows.join(found.filter("contaminated").select(F.col("row").alias(row)), row, "left_anti").select(docs.columns)
    (items,) = _item_blocks(benchmark, 1)
    shared = docs.sparkSession.sparkContext.broadcast(build(items, window))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            clean = []
            for s in K.slabs(b.column("text")):
                n_words, n_hit, _ = search(s, shared.value)
                clean.append(~_contaminated(n_words, n_hit))
            if clean:
                yield b.filter(pa.array(np.concatenate(clean)))

    return batched(docs).mapInArrow(run, docs.schema)


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet")
    return scan(read("documents"), read("benchmark"))


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
ORACLE = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents
), b AS (
  SELECT item_id, {_WORDS} AS w FROM benchmark
), p AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS m, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)
), x AS (
  SELECT r, i, q.m, array_to_string(w[i:i + q.m - 1], ' ') AS win
  FROM (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM d), (SELECT DISTINCT m FROM p) q WHERE i + q.m - 1 <= len(w)
), o AS (
  SELECT x.r, x.i, x.m, p.item_id FROM x JOIN p ON x.win = p.win AND x.m = p.m
), h AS (
  SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT r, unnest(range(i, i + m)) AS k FROM o) GROUP BY r
), t AS (
  SELECT r, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
  FROM (SELECT DISTINCT r, item_id FROM o) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN h USING (r) LEFT JOIN t USING (r)
"""
