"""Exact substring dedup: a depth-limited radix sort of suffixes.

A suffix matters only through its first ``size`` bytes (its window). Suffixes are dealt into groups by digits, most
significant first; a group of one window holds no repeat and is dropped, and the groups left after the last digit are
exactly the repeated windows. Digits are hashes of byte ranges, so a pass is a map-side combined
aggregate on digit values and a join with the values that occur again; no group is ever gathered.

1. Anchor digit. Among the ``size - ANCHOR + 1`` places of a window, the ``ANCHOR``-byte string with the least hash
   (leftmost on ties) is the window's anchor. Equal windows have equal anchors at equal offsets, and about one place in
   (size - ANCHOR) / 2 is an anchor, so the first pass deals all suffixes at that fraction of the rows.
2. Stretch digits. The windows of an anchor are cut into stretches of ``STRETCH`` neighbouring offsets. A stretch
   whose union of bytes occurs again is repeated as a whole; one whose common core doesn't is not repeated
   at all; the others are undecided. Equal stretches of one text are one row with all their places, so a text that repeats itself
   (a long run of one word) gives a digit no more rows than any other text. What becomes of a stretch is decided by distinct unions, and
   the stretches are joined with that once.
3. Window digit. Undecided stretches, and one representative of each decided stretch with the same core, give their
   windows, by all of their bytes.

Texts that are equal as a whole are settled before: all their windows are repeated, and one of them stands for all.
Digits are 64-bit hashes of whole ranges.

Defined results: null is an empty text; texts of fewer than ``size`` bytes lose nothing; rows with repeated
doc_id and text are copies of each other like any rows with equal texts; an empty table gives an empty result;
matches never cross rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from judgex.llm import kernels as K
from judgex.llm.arrow import over, table
from judgex.session import cut

SIZE, ANCHOR, STRETCH = 400, 200, 16
_U = np.uint64


def _anchors(data: np.ndarray, offs: np.ndarray, size: int) -> tuple[np.ndarray, ...]:
    """Runs of windows with one anchor: (row, anchor, first window, last window, anchor hash); places count in the slab."""
    width = size - ANCHOR + 1
    z = np.zeros(0, np.int64)
    if len(data) < size:
        return z, z, z, z, np.zeros(0, np.uint64)
    h = K.RangeHash(data).windows(ANCHOR)
    key = (h & ~_U(0xFFFFFFFF)) | np.arange(len(h), dtype=np.uint64)
    # least key of every `width` neighbours: of the end of one block and the beginning of the next
    n = len(key) - width + 1
    pad = -len(key) % width
    blocks = np.append(key, np.full(pad, ~_U(0))).reshape(-1, width)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    anchor = (np.minimum(right[:n], left[width - 1 : width - 1 + n]) & _U(0xFFFFFFFF)).astype(np.int64)
    row = np.repeat(np.arange(len(offs) - 1), np.diff(offs))[:n]
    valid = np.arange(n) + size <= offs[1:][row]
    at = np.flatnonzero(valid)
    if not len(at):
        return z, z, z, z, np.zeros(0, np.uint64)
    new = np.concatenate(([True], (np.diff(anchor[at]) != 0) | (np.diff(row[at]) != 0)))
    first = at[new]
    last = at[np.append(np.flatnonzero(new)[1:] - 1, len(at) - 1)]
    return row[first], anchor[first], first, last, h[anchor[first]]


def _anchor_rows(b: pa.RecordBatch, size: int) -> Iterator[pa.RecordBatch]:
    """Rows (h, uid, twice): the distinct anchors of each text, and whether one occurs twice in it."""
    for s in K.slabs(b.column("text")):
        row, _, _, _, h = _anchors(s.data, s.offs, size)
        if not len(row):
            continue
        order = np.lexsort((h, row))
        r, g = row[order], h[order]
        new = np.concatenate(([True], (r[1:] != r[:-1]) | (g[1:] != g[:-1])))
        at = np.flatnonzero(new)
        twice = np.diff(np.append(at, len(r))) > 1
        yield table(h=K.signed(g[at]), uid=b.column("uid").take(pa.array(r[at] + s.lo)), twice=twice)


def _stretches(text: bytes, anchors: list[int], size: int) -> tuple[np.ndarray, ...]:
    """The distinct stretches whose anchors occur again: (core, union, first place of each in what follows), and of all places, equal stretches together, (first window, last window)."""
    data = np.frombuffer(text, np.uint8)
    _, a, first, last, h = _anchors(data, np.array([0, len(data)]), size)
    use = np.isin(K.signed(h), np.array(anchors, np.int64))
    a, first, last, h = a[use], first[use], last[use], h[use]
    # offsets of windows before the anchor, dealt into stretches [STRETCH g, STRETCH g + STRETCH)
    lo, hi = (a - last) // STRETCH, (a - first) // STRETCH
    many = hi - lo + 1
    i = np.repeat(np.arange(len(a)), many)
    g = np.arange(len(i)) - np.repeat(np.cumsum(many) - many, many) + lo[i]
    p0 = np.maximum(first[i], a[i] - (g * STRETCH + STRETCH - 1))
    p1 = np.minimum(last[i], a[i] - g * STRETCH)
    rh = K.RangeHash(data)
    tag = K.mix(h[i] + g.astype(np.uint64) * _U(0x9E3779B97F4A7C15))
    core = K.mix(rh(a[i] - g * STRETCH, a[i] - (g * STRETCH + STRETCH - 1) + size) ^ tag)
    # the union's place in the stretch is part of it
    ends = ((a[i] - p0) * (size * 4) + (a[i] - p1)).astype(np.uint64)
    union = K.mix(K.mix(rh(p0, p1 + size) ^ tag) + ends)
    order = np.lexsort((p0, union))
    core, union, p0, p1 = core[order], union[order], p0[order], p1[order]
    at = np.flatnonzero(np.append(True, union[1:] != union[:-1])) if len(union) else np.zeros(0, np.int64)
    return core[at], union[at], at, p0, p1


def _further(at: np.ndarray, p0: np.ndarray, p1: np.ndarray) -> pa.Array:
    """The places of each stretch besides its first; null where there is none."""
    more = np.ones(len(p0), bool)
    more[at] = False
    ends = np.append(np.cumsum(more)[at], more.sum()).astype(np.int32)
    none = np.append(np.diff(np.append(at, len(p0))) == 1, False)
    places = pa.StructArray.from_arrays([pa.array(p0[more].astype(np.int32)), pa.array(p1[more].astype(np.int32))], ["p0", "p1"])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32(), mask=none), places)


def _merge(starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs covered by ranges."""
    out: list[list[int]] = []
    for a, b in sorted(zip(starts.tolist(), ends.tolist())):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def remove(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """Rows (doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept): kept are the remaining bytes."""
    return _resolved(docs, size, True)


def _resolved(docs: DataFrame, size: int, with_kept: bool) -> DataFrame:
    if not ANCHOR < size < 1 << 20:
        raise ValueError(f"size must be over {ANCHOR}")
    docs = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    docs = docs.withColumn("uid", F.xxhash64("text"))
    long = docs.filter(F.octet_length("text") >= size)
    texts = cut(docs.groupBy("uid").agg(F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("one"), F.max(F.octet_length("text")).alias("n")), "suffix-texts")

    # pass 1
    anchors = cut(over(long.select("uid", "text"), lambda b: _anchor_rows(b, size), "h long, uid long, twice boolean"), "suffix-anchors")
    again = anchors.groupBy("h").agg(F.min("uid").alias("u0"), F.max("uid").alias("u1"), F.max("twice").alias("twice")).filter("u0 != u1 or twice").select("h")
    by_text = anchors.join(again, "h").groupBy("uid").agg(F.collect_set("h").alias("anchors"))
    chosen = by_text.join(texts.select("uid", "one"), "uid")
    # one copy of each text that has them goes on
    one = long.join(chosen, "uid").filter("doc_id <=> one").groupBy("uid").agg(F.first("text").alias("text"), F.first("anchors").alias("anchors"))
    work = cut(one, "suffix-work")

    # pass 2
    def stretches(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for uid, text, a in zip(*(b.column(c).to_pylist() for c in ("uid", "text", "anchors"))):
            core, union, at, p0, p1 = _stretches(text, a, size)
            n = np.diff(np.append(at, len(p0))).astype(np.int32)
            yield table(core=K.signed(core), union=K.signed(union), uid=np.full(len(core), uid), n=n, p0=p0[at].astype(np.int32), p1=p1[at].astype(np.int32), more=_further(at, p0, p1))

    parts = cut(over(work, stretches, "core long, union long, uid long, n int, p0 int, p1 int, more array<struct<p0: int, p1: int>>"), "suffix-stretches")
    whole = parts.groupBy("union").agg(F.sum("n").alias("n"), F.min("uid").alias("rep"), F.first("core").alias("core"))
    # a core is undecided where it has several places and one of them isn't settled by its union
    cores = whole.groupBy("core").agg(F.sum("n").alias("places"), F.max((F.col("n") == 1).cast("int")).alias("open")).filter("places > 1").select("core", "open")
    decided = whole.join(cores, "core").filter("n > 1 or open = 1").select("union", F.col("n").alias("times"), "rep", "open")
    marked = cut(parts.join(decided, "union").select("uid", "p0", "p1", "more", "times", "rep", "open"), "suffix-marked")
    settled = marked.filter("times > 1")
    accepted = settled.select("uid", "p0", "p1").unionAll(settled.filter("more is not null").select("uid", F.inline("more")))
    # the first place of a settled stretch stands for all
    finer = marked.filter("open = 1 and (times = 1 or rep = uid)").groupBy("uid").agg(F.collect_list(F.struct("p0", "p1")).alias("runs"))

    # pass 3
    def windows(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for uid, text, runs in zip(*(b.column(c).to_pylist() for c in ("uid", "text", "runs"))):
            p = np.unique(np.concatenate([np.arange(r["p0"], r["p1"] + 1) for r in runs]))
            h = K.RangeHash(np.frombuffer(text, np.uint8))(p, p + size)
            yield table(w=K.signed(h), uid=np.full(len(p), uid), p=p.astype(np.int32))

    ends = over(work.select("uid", "text").join(finer, "uid"), windows, "w long, uid long, p int")
    ends = cut(ends, "suffix-windows")
    twice = ends.groupBy("w").count().filter("count > 1").select("w")
    accepted = accepted.unionAll(ends.join(twice, "w").select("uid", "p", F.col("p").alias("p1")))
    found = cut(accepted.groupBy("uid").agg(F.collect_list(F.struct("p0", "p1")).alias("runs")), "suffix-found")

    # what remains of each text that loses a part; whole copies lose everything
    def remains(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        out = []
        for text, runs in zip(b.column("text").to_pylist(), b.column("runs").to_pylist()):
            r = np.array([(x["p0"], x["p1"] + size) for x in runs], np.int64)
            gone = _merge(r[:, 0], r[:, 1])
            edges = [0, *(x for g in gone for x in g), len(text)]
            kept = b"".join(text[a:z] for a, z in zip(edges[::2], edges[1::2]))
            out.append((len(text) - len(kept), len(gone), hashlib.sha256(kept).hexdigest(), kept if with_kept else None))
        cols = list(zip(*out))
        yield table(uid=b.column("uid"), r=pa.array(cols[0], pa.int64()), s=pa.array(cols[1], pa.int64()), sha=list(cols[2]), left=pa.array(cols[3], pa.binary()))

    alone = texts.filter("copies = 1").select("uid")
    lossy = cut(over(work.select("uid", "text").join(found, "uid").join(alone, "uid", "left_semi"), remains, "uid long, r long, s long, sha string, left binary"), "suffix-lossy")
    out = docs.select("doc_id", "uid", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("full"), *(["text"] if with_kept else []))
    out = out.join(texts.select("uid", "copies"), "uid").join(lossy, "uid", "left")
    copy = (F.col("copies") > 1) & (F.col("n_bytes") >= size)
    cols = [
        "doc_id", "n_bytes",
        F.when(copy, F.col("n_bytes")).otherwise(F.coalesce("r", F.lit(0))).alias("n_removed"),
        F.when(copy, F.lit(1)).otherwise(F.coalesce("s", F.lit(0))).cast("long").alias("n_spans"),
        F.when(copy, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("sha", "full")).alias("kept_sha256"),
    ]
    if with_kept:
        cols.append(F.when(copy, F.lit(b"")).when(F.col("r").isNotNull(), F.col("left")).otherwise(F.col("text")).alias("kept"))
    return out.select(*cols)


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The digests and, as ``text``, what remains; a character that is cut through shows as U+FFFD there, and ``kept_sha256`` is of the bytes."""
    out = _resolved(spark.read.parquet(f"{sf_dir}/documents.parquet"), SIZE, True)
    return out.withColumn("text", F.make_valid_utf8(F.col("kept").cast("string"))).drop("kept")
