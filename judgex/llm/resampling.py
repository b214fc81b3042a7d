"""Importance resampling towards a target distribution, over bucket-partitioned inverted postings.

A text's features are its runs of one to ``n`` words; each falls into a hash bucket. The documents are inverted: per strip of
about ``STRIP_BYTES`` of text, every bucket has one posting segment (places of the documents in the strip, counts). Segments are shuffled by
group of buckets (``GROUPS`` in all) and salt of strips, and meet the gains of the group's buckets, which come from co-grouping what both corpora hold in
a bucket: the log ratio of smoothed shares. There the segments turn into contributions, counts times gains summed by document, at most one a
document and group; these are reduced by document.

The totals of buckets are counted before, in one vector a task, so gains depend on no order and a bucket's segments needn't be together: a bucket is
split into one salt per ``SALT_STRIPS`` strips, however frequent it is, and what meets in one place is bounded. The scan is run twice, once for totals and once for postings, which
moves less than keeping the postings. Scores add Gumbel noise of a seeded hash of doc_id, so the largest are a sample without
replacement in proportion to exp(weight / 1000). Ranks come from a range sort and the sizes of its ranges.

Defined results: null and wordless texts have no features, weight 0 and no rank; a null doc_id is hashed as an empty text and orders last; rows
with one doc_id are documents of their own, of equal score if their texts are equal, in the order of their places;
an empty target has no counts, so gains come from the documents alone; an empty table gives an empty
result; further columns are ignored. Strips are told apart by partition and number, so ``docs`` must come from files or be
written first (``cut``): its partitions must hold the same rows in the same order when a task is run again.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from judgex.llm import kernels as K
from judgex.llm.arrow import batched, table
from judgex.session import cut

BUCKETS, RUN = 10_000, 2
STRIP_BYTES, STRIP_ROWS, SALT_STRIPS, GROUPS = 4 << 20, 1 << 16, 32, 16
_LONG_WORD = 64


def _crc_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, t >> 1 ^ np.uint32(0xEDB88320), t >> 1)
    return t


_CRC = _crc_table()


def crc32(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, before: np.ndarray | None = None) -> np.ndarray:
    """zlib's crc32 of many byte ranges at once, each going on from ``before``."""
    out = np.zeros(len(starts), np.uint32) if before is None else before.copy()
    size = ends - starts
    for i in np.flatnonzero(size > _LONG_WORD).tolist():
        out[i] = zlib.crc32(data[starts[i] : ends[i]].tobytes(), int(out[i]))
    short = np.flatnonzero(size <= _LONG_WORD)
    short = short[np.argsort(-size[short], kind="stable")]  # those that still have bytes come first
    c, at, n = ~out[short], starts[short], size[short]
    left = len(n) - np.cumsum(np.bincount(n, minlength=_LONG_WORD + 1))
    for j in range(int(n.max(initial=0))):
        m = int(left[j])
        c[:m] = _CRC[(c[:m] ^ data[at[:m] + j]) & 0xFF] ^ c[:m] >> np.uint32(8)
    out[short] = ~c
    return out


def features(data: np.ndarray, offs: np.ndarray, n: int = RUN, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of each feature, its bucket, words of each row) of a slab."""
    low = K.LOWER[data]
    w = K.words(low, offs, K.NON_ALNUM)
    crc = crc32(low, w.starts, w.ends)
    rows, found = [w.row], [crc % np.uint32(buckets)]
    blank = np.array([32], np.uint8)
    for k in range(1, n):
        m = len(w.starts) - k
        if m <= 0:
            break
        whole = w.row[:m] == w.row[k:]
        # runs of k + 1 words go on from those of k words, whose first m are in place
        one = np.zeros(m, np.int64)
        crc = crc32(blank, one, one + 1, crc[:m])
        crc = crc32(low, w.starts[k:], w.ends[k:], crc)
        rows.append(w.row[:m][whole])
        found.append((crc % np.uint32(buckets))[whole])
    return np.concatenate(rows), np.concatenate(found).astype(np.int64), np.diff(w.first)


def _strips(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Table]]:
    """(number, rows) of a partition's strips: batches put together, or cut, to bounded texts and rows."""
    base, number, held, size, rows = TaskContext.get().partitionId() << 32, 0, [], 0, 0
    for b in batches:
        if not b.num_rows:
            continue
        for s in K.slabs(b.column("text"), STRIP_BYTES):
            if held and (size + len(s.data) > STRIP_BYTES or rows + s.n > STRIP_ROWS):
                yield base + number, pa.Table.from_batches(held)
                number, held, size, rows = number + 1, [], 0, 0
            held.append(b.slice(s.lo, s.n))
            size, rows = size + len(s.data), rows + s.n
    if held:
        yield base + number, pa.Table.from_batches(held)


def _text(t: pa.Table) -> K.Slab:
    (s,) = K.slabs(t.column("text"), 1 << 62)
    return s


def summary(docs: DataFrame, n: int, buckets: int) -> DataFrame:
    """Rows (strip, doc_ids, n_words, n_features, null) for each strip and (null, null, null, null, counts) for each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        for strip, t in _strips(batches):
            s = _text(t)
            row, bucket, n_words = features(s.data, s.offs, n, buckets)
            counts += np.bincount(bucket, minlength=buckets)
            n_features = np.bincount(row, minlength=s.n)
            yield table(strip=[strip], doc_ids=pa.array([t.column("doc_id").to_pylist()], pa.list_(pa.int64())), n_words=[n_words], n_features=[n_features], counts=pa.array([None], pa.list_(pa.int64())))
        if counts.any():
            none = pa.array([None], pa.list_(pa.int64()))
            yield table(strip=pa.array([None], pa.int64()), doc_ids=none, n_words=none, n_features=none, counts=[counts])

    return batched(docs).mapInArrow(run, "strip long, doc_ids array<long>, n_words array<long>, n_features array<long>, counts array<long>")


def postings(docs: DataFrame, n: int, buckets: int) -> DataFrame:
    """Rows (bucket, strip, docs, counts): which documents of a strip hold a bucket, as 16-bit places, and how often, as 8- or 32-bit counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for strip, t in _strips(batches):
            s = _text(t)
            row, bucket, _ = features(s.data, s.offs, n, buckets)
            key, count = np.unique(bucket * STRIP_ROWS + row, return_counts=True)
            which, first = np.unique(key // STRIP_ROWS, return_index=True)
            last = np.append(first[1:], len(key))
            places = (key % STRIP_ROWS).astype("<u2").tobytes()
            most = np.maximum.reduceat(count, first) if len(first) else first
            small, large = np.minimum(count, 255).astype("u1").tobytes(), count.astype("<u4").tobytes()
            yield table(
                bucket=which.astype(np.int32), strip=np.full(len(which), strip), docs=[places[2 * a : 2 * b] for a, b in zip(first.tolist(), last.tolist())],
                counts=[small[a:b] if m < 256 else large[4 * a : 4 * b] for a, b, m in zip(first.tolist(), last.tolist(), most.tolist())],
            )

    return batched(docs).mapInArrow(run, "bucket int, strip long, docs binary, counts binary")


def gains(mine: DataFrame, target: DataFrame, buckets: int) -> DataFrame:
    """Rows (bucket, gain), at most one a bucket, from the summaries of both corpora."""
    held = lambda s, name: s.filter("counts IS NOT NULL").select(F.posexplode("counts").alias("bucket", "c")).groupBy("bucket").agg(F.sum("c").alias(name))
    both = mine.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket")).join(held(mine, "s"), "bucket", "left").join(held(target, "t"), "bucket", "left").na.fill(0)
    every = Window.partitionBy()  # over the buckets, whose number is a parameter
    share = lambda c: F.sum(c).over(every).cast("double") + buckets
    ratio = ((F.col("t") + 1).cast("double") * share("s")) / ((F.col("s") + 1).cast("double") * share("t"))
    return both.select("bucket", F.floor(1000 * F.log(ratio)).cast("long").alias("gain"))


def _flat(col: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all values one after another, bytes of each)."""
    a = col.combine_chunks()
    a = pa.concat_arrays(a.chunks) if isinstance(a, pa.ChunkedArray) else a
    _, offs, data = a.buffers()
    o = np.frombuffer(offs, np.int32 if a.type == pa.binary() else np.int64)[a.offset : a.offset + len(a) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8)[o[0] : o[-1]] if data is not None else np.zeros(0, np.uint8), np.diff(o)


def _contributions(mine: pa.Table, gain: pa.Table) -> pa.Table:
    """Rows (strip, place, part) of a group's segments: each document's counts times gains, summed."""
    gains_of = np.zeros(int(np.max(gain.column("bucket").to_numpy(), initial=-1)) + 1, np.int64)
    gains_of[gain.column("bucket").to_numpy()] = gain.column("gain").to_numpy()
    strips, at = np.unique(mine.column("strip").to_numpy(), return_inverse=True)
    places, size = _flat(mine.column("docs"))
    n = size // 2  # places have two bytes
    data, width = _flat(mine.column("counts"))
    wide = np.repeat(width > n, n)
    count = np.zeros(len(wide), np.int64)
    by_byte = np.repeat(width > n, width)
    count[~wide], count[wide] = data[~by_byte], data[by_byte].view("<u4")
    key = np.repeat(at, n) * STRIP_ROWS + places.view("<u2")
    found, which = np.unique(key, return_inverse=True)
    part = np.zeros(len(found), np.int64)
    np.add.at(part, which, count * np.repeat(gains_of[mine.column("bucket").to_numpy()], n))
    return pa.table({"strip": strips[found // STRIP_ROWS], "place": (found % STRIP_ROWS).astype(np.int32), "part": part})


_NONE = pa.table({"strip": pa.array([], pa.int64()), "place": pa.array([], pa.int32()), "part": pa.array([], pa.int64())})


def weights(docs: DataFrame, target: DataFrame, n: int = RUN, buckets: int = BUCKETS) -> DataFrame:
    """Rows (strip, place, doc_id, n_words, n_features, weight): the floored mean gain of each document's features."""
    docs = docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text")
    mine = cut(summary(docs, n, buckets), "resample-summary")
    theirs = summary(target.select(F.lit(None).cast("long").alias("doc_id"), "text"), n, buckets)
    salts = 1 + mine.filter("strip IS NOT NULL").count() // SALT_STRIPS
    group = (F.col("bucket") % GROUPS).alias("group")
    gain = gains(mine, theirs, buckets).select(group, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"), "bucket", "gain")
    salted = postings(docs, n, buckets).select(group, F.pmod(F.xxhash64("strip"), F.lit(salts)).cast("int").alias("salt"), "bucket", "strip", "docs", "counts")
    met = salted.groupBy("group", "salt").cogroup(gain.groupBy("group", "salt"))
    parts = met.applyInArrow(lambda mine, gain: _contributions(mine, gain) if mine.num_rows else _NONE, "strip long, place int, part long")
    known = mine.filter("strip IS NOT NULL").select("strip", F.posexplode(F.arrays_zip("doc_ids", "n_words", "n_features")).alias("place", "d"))
    known = known.select("strip", "place", F.lit(0).cast("long").alias("part"), *(F.col(f"d.{c}").alias(c) for c in ("doc_ids", "n_words", "n_features")))
    every = known.unionByName(parts, allowMissingColumns=True)
    each = every.groupBy("strip", "place").agg(F.sum("part").alias("total"), F.max("doc_ids").alias("doc_id"), F.max("n_words").alias("n_words"), F.max("n_features").alias("n_features"))
    mean = F.when(F.col("n_features") > 0, F.expr("(total - pmod(total, n_features)) DIV n_features")).otherwise(F.lit(0)).cast("long")
    return each.select("strip", "place", "doc_id", "n_words", "n_features", mean.alias("weight"))


def noise(seed: int, doc_id: F.Column) -> F.Column:
    """Gumbel noise of a document, in thousandths, floored."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def draw(docs: DataFrame, target: DataFrame, percent: int = 25, least_words: int = 20, seed: int = 7, n: int = RUN, buckets: int = BUCKETS) -> DataFrame:
    """Rows (doc_id, n_features, weight, score, rank): ``percent`` of the documents of ``least_words`` are drawn and have a rank."""
    w = cut(weights(docs, target, n, buckets), "resample-weights")
    w = w.withColumn("score", F.col("weight") + noise(seed, F.col("doc_id"))).withColumn("able", F.col("n_words") >= least_words)
    order = (F.col("able").desc(), F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("strip"), F.col("place"))
    ranked = w.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("seat", F.monotonically_increasing_id())
    ranked = cut(ranked.select("doc_id", "n_features", "weight", "score", "able", F.shiftright("seat", 33).alias("range"), F.col("seat").bitwiseAND((1 << 33) - 1).alias("at")), "resample-order")
    sizes = ranked.groupBy("range").agg(F.count(F.lit(1)).alias("size"), F.count_if("able").alias("able_size"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # one row a range of the sort
    bases = sizes.select("range", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"), F.sum("able_size").over(Window.partitionBy()).alias("n_able"))
    rank = F.col("base") + F.col("at") + 1
    drawn = F.col("able") & (rank <= F.expr(f"(n_able * {percent}) DIV 100"))
    return ranked.join(bases, "range").select("doc_id", "n_features", "weight", "score", F.when(drawn, rank).alias("rank"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return draw(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
