"""Token ids of a corpus as Simple-8b shard files, in ascending doc_id order.

Texts are cut into pieces where the tokenizer's own pre-tokenizer cuts them, many texts at once, and a task gives the tokenizer every
distinct piece once (``Pieces``); pieces are looked up by hash and compared with what was found, byte by byte. Which class a character belongs to is asked of the tokenizer too, so both agree by construction; a text
with the string of a special token goes to the tokenizer whole.

Documents are dealt to ranges of doc_id whose bounds are percentiles of the ids; ids that take up several ranges, a hot id or nulls, are
spread over all of these by the hash of their text. A range is sorted on disk where it must be and written as shards of about
``SHARD_IDS`` ids (a longer document makes a longer shard), by Spark's text sink, a row a file, so a retried task leaves no second copy
and any file system will do. The only rows shuffled are compressed ids. ``manifest`` gives each shard its place in the whole stream.

Defined results: a null text is empty and has the end id only; null doc_ids come first, rows with one doc_id in the order of their text's
hash; the string of a special token becomes its id, as the library does by default (``special=False``: ordinary text);
an empty table writes no shard and gives an empty result; further columns are ignored. Shards that are cut short or damaged raise.
"""

from __future__ import annotations

import itertools
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from judgex.llm import kernels as K
from judgex.llm import simple8b
from judgex.llm.arrow import batched, over, table
from judgex.session import cut, scratch

VOCABULARY, END = "byte_bpe_50k.json", 2
SHARD_IDS = 8 << 20
#: Distinct pieces that a worker remembers before it starts anew.
PIECES = 1_000_000
#: Places of the table that finds most of them at once, a power of two.
NEAR = 1 << 20
_SPACE, _LETTER, _NUMBER, _OTHER, _UNKNOWN = 1, 2, 3, 4, 0
#: Contractions that the byte-level pre-tokenizer cuts off.
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Pieces:
    """A byte-level tokenizer for many texts at once. ``special``: whether strings of special tokens become their ids."""

    def __init__(self, path: str, special: bool = True):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not special
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()] if special else []
        self.classes = np.zeros(0x110000, np.uint8)
        (self.line_end,) = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self._forget()

    def _forget(self) -> None:
        # known pieces: sorted hashes with the piece's number; by number, where its bytes and its ids begin
        self.hashes, self.number = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.bytes, self.start = np.zeros(0, np.uint8), np.zeros(1, np.int64)
        self.ids, self.first = np.zeros(0, np.uint32), np.zeros(1, np.int64)
        # by the low bits of a hash, one of the known pieces that share them, mostly an early and so a frequent one
        self.near, self.near_hash = np.full(NEAR, -1, np.int32), np.zeros(NEAR, np.uint64)

    def _learn(self, points: np.ndarray) -> None:
        """Ask the pre-tokenizer with what each new character stays together."""
        join = lambda c, x: len(self.tokenizer.pre_tokenizer.pre_tokenize_str(x + c)) == 1
        for p in points.tolist():
            c = chr(p)
            self.classes[p] = next((k for k, x in ((_LETTER, "a"), (_NUMBER, "1"), (_OTHER, "!")) if join(c, x)), _SPACE)

    def cuts(self, points: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Where pieces begin in the code points of texts that begin at ``first``."""
        kind = self.classes[points]
        if (kind == _UNKNOWN).any():
            self._learn(np.unique(points[kind == _UNKNOWN]))
            kind = self.classes[points]
        n = len(points)
        top = np.zeros(n + 1, bool)
        top[first] = True
        begin = top[:n].copy()
        begin[1:] |= kind[1:] != kind[:-1]
        last = np.append(begin[1:], True)  # the run of one class ends here
        # white space before something else: its last character stands apart, and a blank goes with what follows
        apart = (kind == _SPACE) & last & ~top[1:]
        begin[apart] = True
        blank = np.flatnonzero(apart & (points == 32))
        begin[blank + 1] = False
        # an apostrophe that begins a piece takes certain letters with it, wherever the word goes on
        mark = np.flatnonzero((points == 39) & begin & last)
        for letters in CONTRACTIONS:
            m = len(letters)
            fits = mark[mark + m < n]
            for j, c in enumerate(letters):
                fits = fits[(points[fits + j + 1] == ord(c)) & ~top[fits + j + 1]]
            begin[fits + 1] = False
            after = fits + m + 1
            begin[after[after < n]] = True
        return np.flatnonzero(begin)

    def _encoded(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pieces, how many each has). Pieces without white space at their end go as lines of one text: a line end is a piece of its own."""
        texts = [p.decode() for p in pieces]
        lines = [not t[-1].isspace() for t in texts]
        apart = {i: self.tokenizer.encode(t, add_special_tokens=False).ids for i, (t, line) in enumerate(zip(texts, lines)) if not line}
        text = "\n".join(t for t, line in zip(texts, lines) if line)
        ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
        ends = np.append(np.flatnonzero(ids == self.line_end), len(ids))
        if len(ends) != max(1, sum(lines)):
            raise ValueError("the tokenizer doesn't keep line ends apart")
        sizes = np.zeros(len(pieces), np.int64)
        sizes[np.flatnonzero(lines)] = np.diff(ends, prepend=-1) - 1 if any(lines) else []
        ids = ids[ids != self.line_end]
        for i, own in sorted(apart.items()):
            sizes[i] = len(own)
        if apart:
            at = np.concatenate(([0], np.cumsum(sizes)))
            out = np.zeros(at[-1], np.uint32)
            out[np.repeat(np.array(lines), sizes)] = ids
            for i, own in apart.items():
                out[at[i] : at[i + 1]] = own
            ids = out
        return ids, sizes

    def _add(self, hashes: np.ndarray, pieces: list[bytes]) -> None:
        ids, sizes = self._encoded(pieces)
        every, number = np.concatenate((self.hashes, hashes)), np.concatenate((self.number, len(self.number) + np.arange(len(hashes))))
        order = np.argsort(every, kind="stable")
        self.hashes, self.number = every[order], number[order]
        slot = (hashes & np.uint64(NEAR - 1)).astype(np.int64)
        free = np.flatnonzero(self.near[slot] < 0)
        self.near[slot[free]] = len(self.start) - 1 + free
        self.near_hash[slot[free]] = hashes[free]
        self.bytes = np.concatenate((self.bytes, np.frombuffer(b"".join(pieces), np.uint8)))
        self.start = np.concatenate((self.start, self.start[-1] + np.cumsum([len(p) for p in pieces])))
        self.ids, self.first = np.concatenate((self.ids, ids)), np.concatenate((self.first, self.first[-1] + np.cumsum(sizes)))

    def _numbers(self, data: np.ndarray, edges: np.ndarray) -> np.ndarray | None:
        """The number of each piece; the pieces are all of ``data``, cut at ``edges``. None if two pieces share a hash."""
        h = K.RangeHash(data)(edges[:-1], edges[1:])

        def known() -> tuple[np.ndarray, np.ndarray]:
            """Numbers by the low bits of the hashes, and the places of the pieces that these don't tell."""
            slot = (h & np.uint64(NEAR - 1)).astype(np.int64)
            no = self.near[slot].astype(np.int64)
            return no, np.flatnonzero((no < 0) | (self.near_hash[slot] != h))

        no, rest = known()
        found, one, which = np.unique(h[rest], return_index=True, return_inverse=True)
        fresh = np.flatnonzero(~np.isin(found, self.hashes, assume_unique=True))
        if len(self.hashes) + len(fresh) > PIECES:
            self._forget()
            no, rest = known()
            found, one, which = np.unique(h[rest], return_index=True, return_inverse=True)
            fresh = np.arange(len(found))
        if len(fresh):
            raw, at = data.tobytes(), rest[one[fresh]]
            self._add(found[fresh], [raw[a:b] for a, b in zip(edges[at].tolist(), edges[at + 1].tolist())])
        no[rest] = self.number[np.searchsorted(self.hashes, found)][which]
        size = np.diff(edges)
        if (np.diff(self.start)[no] != size).any():
            return None
        return no if (self.bytes[np.repeat(self.start[no] - edges[:-1], size) + np.arange(len(data))] == data).all() else None

    def encode(self, s: K.Slab) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts of a slab, how many each text has)."""
        raw = s.data.tobytes()
        if len(raw) == 0:
            return np.zeros(0, np.uint32), np.zeros(s.n, np.int64)
        points = np.frombuffer(raw.decode().encode("utf-32-le"), np.uint32)
        starts = np.flatnonzero((s.data & 0xC0) != 0x80)  # byte of each code point
        first = np.searchsorted(starts, s.offs)
        at = self.cuts(points, first)
        no = self._numbers(s.data, np.append(starts[at], len(raw)))
        if no is None:
            return self._by_text(raw, s.offs)
        sizes = self.first[no + 1] - self.first[no]
        ends = np.concatenate(([0], np.cumsum(sizes)))
        ids = self.ids[np.repeat(self.first[no] - ends[:-1], sizes) + np.arange(ends[-1])]
        of_text = ends[np.searchsorted(at, first)]
        if any(x.encode() in raw for x in self.special):
            return self._by_text(raw, s.offs, ids, of_text)
        return ids, np.diff(of_text)

    def _by_text(self, raw: bytes, offs: np.ndarray, ids: np.ndarray | None = None, of_text: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """As ``encode``, text by text; ids that are known are kept for texts without strings of special tokens."""
        out = []
        for i, (a, b) in enumerate(zip(offs.tolist(), offs[1:].tolist())):
            t = raw[a:b]
            whole = ids is None or any(x.encode() in t for x in self.special)
            out.append(np.array(self.tokenizer.encode(t.decode(), add_special_tokens=False).ids, np.uint32) if whole else ids[of_text[i] : of_text[i + 1]])
        return np.concatenate(out), np.array([len(x) for x in out], np.int64)


_kept: dict[tuple[str, bool], Pieces] = {}


def pieces(path: str, special: bool) -> Pieces:
    """A tokenizer that this worker keeps from task to task."""
    return _kept.get((path, special)) or _kept.setdefault((path, special), Pieces(path, special))


def encoded(docs: DataFrame, parts: int, path: str, end: int = END, special: bool = True) -> DataFrame:
    """Rows (part, doc_id, tie, wide, ids): each document's range and its ids with the end id, as integers of 16 bits, or 32 where wide."""
    docs = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.xxhash64("text").alias("tie"), "text")
    least = -(1 << 63)
    shares = [i / parts for i in range(1, parts)]
    found = docs.agg(F.percentile_approx(F.coalesce("doc_id", F.lit(least)), F.array(*map(F.lit, shares)), F.lit(max(10_000, 50 * parts)))).first()[0] if shares else []
    bounds = np.array(found or [], np.int64)
    def f(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        coder = pieces(path, special)
        doc = np.asarray(b.column("doc_id").fill_null(least))
        lo, hi = np.searchsorted(bounds, doc, "left"), np.searchsorted(bounds, doc, "right")
        spread = np.asarray(b.column("tie").fill_null(0)).view(np.uint64) % (hi - lo + 1).astype(np.uint64)
        part = pa.array((lo + spread.astype(np.int64)).astype(np.int32))
        for s in K.slabs(b.column("text")):
            ids, sizes = coder.encode(s)
            wide = max(int(ids.max(initial=0)), end) >= 1 << 16
            ends = np.cumsum(sizes + 1)
            every = np.full(ends[-1], end, "<u4" if wide else "<u2")
            every[np.arange(len(ids)) + np.repeat(np.arange(s.n), sizes)] = ids
            offsets = np.concatenate(([0], ends * every.itemsize))
            blobs = pa.Array.from_buffers(pa.large_binary(), s.n, [None, pa.py_buffer(offsets), pa.py_buffer(every)]).cast(pa.binary())
            yield table(part=part.slice(s.lo, s.n), doc_id=b.column("doc_id").slice(s.lo, s.n), tie=b.column("tie").slice(s.lo, s.n), wide=np.full(s.n, wide), ids=blobs)

    return over(docs, f, "part int, doc_id long, tie long, wide boolean, ids binary")


def write(docs: DataFrame, folder: str, path: str, parts: int | None = None, end: int = END, shard_ids: int = SHARD_IDS, special: bool = True) -> None:
    """Write documents (doc_id, text) to shard files in ``folder``; ``parts`` ranges are written at a time by as many tasks."""
    parts = parts or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = encoded(docs, parts, path, end, special).repartitionById(parts, F.col("part")).sortWithinPartitions("part", F.col("doc_id").asc_nulls_first(), "tie")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[np.ndarray] = []
        of: list[tuple[int | None, int]] = []
        held, own, seq = 0, -1, 0
        for b in batches:
            for part, doc_id, wide, blob in zip(*(b.column(c).to_pylist() for c in ("part", "doc_id", "wide", "ids"))):
                x = np.frombuffer(blob, "<u4" if wide else "<u2")
                if of and (part != own or held + len(x) > shard_ids):
                    yield table(content=pa.array([simple8b.pack(np.concatenate(ids), of, own, seq)], pa.binary()))
                    seq = seq + 1 if part == own else 0
                    ids, of, held = [], [], 0
                own = part
                ids.append(x)
                of.append((doc_id, len(x)))
                held += len(x)
        if of:
            yield table(content=pa.array([simple8b.pack(np.concatenate(ids), of, own, seq)], pa.binary()))

    files = batched(rows).mapInArrow(run, "content binary").select(F.col("content").cast("string").alias("value"))
    files.write.option("lineSep", "\0").option("maxRecordsPerFile", 1).text(folder)


def manifest(shards: DataFrame) -> DataFrame:
    """Rows (part, seq, n_ids) of shards with ``base``, the ids of all shards before: sums by range first, then within a range."""
    before = lambda w: F.coalesce(F.sum("n_ids").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranges = shards.groupBy("part").agg(F.sum("n_ids").alias("n_ids"))
    ranges = ranges.select("part", before(Window.orderBy("part")).alias("range_base"))
    return shards.withColumn("within", before(Window.partitionBy("part").orderBy("seq"))).join(ranges, "part").select("part", "seq", "n_ids", (F.col("range_base") + F.col("within")).alias("base"))


def read(spark: SparkSession, folder: str) -> DataFrame:
    """Rows (doc_id, start, n_tokens, ids_crc32) of the documents in the shard files of a folder."""

    def f(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for content in b.column("content"):
            s = simple8b.Shard(content.as_py())
            sizes = s.docs["ids"].astype(np.int64)
            ends = np.cumsum(sizes)
            crcs, doc, at = np.zeros(len(sizes), np.int64), 0, 0
            for ids in s.strips():
                data, n = ids.astype("<u4").tobytes(), len(ids)
                lo = 0
                while lo < n:
                    hi = min(n, int(ends[doc]) - at)
                    crcs[doc] = zlib.crc32(memoryview(data)[4 * lo : 4 * hi], int(crcs[doc]))
                    lo = hi
                    if at + hi == ends[doc]:
                        doc += 1
                at += n
            one = np.ones(len(sizes), np.int32)
            yield table(part=one * s.part, seq=one * s.seq, doc_id=pa.array(s.docs["doc_id"], mask=s.docs["null"].astype(bool)), at=ends - sizes, n_tokens=sizes, ids_crc32=crcs)

    files = spark.read.format("binaryFile").load(folder).select("content")
    rows = cut(over(files, f, "part int, seq int, doc_id long, at long, n_tokens long, ids_crc32 long"), "token-rows")
    bases = manifest(rows.groupBy("part", "seq").agg(F.sum("n_tokens").alias("n_ids")))
    return rows.join(bases, ["part", "seq"]).select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def op11_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch(spark, "token-shards")
    write(spark.read.parquet(f"{sf_dir}/documents.parquet"), folder, vocabulary_path())
    return read(spark, folder)
