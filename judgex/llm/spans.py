"""Substring dedup over sliding sentence spans.

A text is cut into sentences: after a word whose trailing punctuation has . ! or ?, at line breaks, and, everywhere,
after the word with the least hash (the last of equal ones) of each window of ``GAP`` words. So no sentence has over
``GAP`` words, and whether a cut is made depends on the ``GAP`` - 1 words before and after it alone: every ``GAP`` words of a
passage hold a cut that all its copies share, whatever stands around them. At every sentence starts one span, and one ends: the shortest
run of at least ``RUN`` sentences and ``WORDS`` words. Together they cover whatever a longer repeated run covers. Spans are hashed (words compared with A-Z lower-cased, white space
ignored) and joined globally; ``least`` = 1 hashes the runs of two sentences of any length, too; a sentence that any but the first occurrence of a repeated span covers is
removed with the white space after it. The first occurrence is that with the least (doc_id, text hash, position).

Span hashes are counted by a map-side combined aggregate, so a span in a third of all documents is one row a task; only
occurrences of those that repeat are written and compared with the first. No group of occurrences is ever collected. What is collected is a document's own removed sentences.

Defined results: null and empty texts have no sentences; rows that agree in doc_id and text are one document, whose
copies all keep what the first occurrence keeps; a null doc_id orders last; within a document, later
repeats go too; an empty table gives an empty result. Texts are read whole. Further columns are ignored by
``report``; ``strip`` returns them unchanged.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from judgex.llm import kernels as K
from judgex.llm.arrow import batched, over, table
from judgex.llm.sieve import marked
from judgex.session import cut

RUN, WORDS, GAP = 2, 16, 8
_STOP = K.byte_set(b".!?")
_SOLID = ~K.NON_ALNUM


def sentences(data: np.ndarray, offs: np.ndarray) -> tuple[K.Words, np.ndarray, np.ndarray]:
    """Words of a slab, their hashes, and the word at which each sentence begins."""
    low = K.LOWER[data]
    w = K.words(low, offs, K.WS)
    n = len(w.starts)
    if n == 0:
        return w, np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h = K.RangeHash(low)(w.starts, w.ends)
    last = np.zeros(n, bool)  # the word ends its sentence
    stops = np.flatnonzero(_STOP[data])
    if len(stops):
        solid = np.flatnonzero(_SOLID[data])
        after = np.append(solid, len(data))[np.searchsorted(solid, stops)]
        word = np.searchsorted(w.starts, stops, "right") - 1
        last[word[after >= w.ends[word]]] = True
    lines = np.concatenate(([0], np.cumsum(data == 10)))
    last[:-1] |= lines[w.starts[1:]] > lines[w.ends[:-1]]
    last[:-1] |= w.row[1:] != w.row[:-1]
    last[-1] = True
    last |= _lows(w.row, h)
    return w, h, np.concatenate(([0], np.flatnonzero(last)[:-1] + 1))


def _lows(row: np.ndarray, h: np.ndarray, gap: int = GAP) -> np.ndarray:
    """Words that have the least hash, the last of equal ones, of a window of ``gap`` words of their row."""
    out = np.zeros(len(h), bool)
    m = len(h) - gap + 1
    if m <= 0:
        return out
    least = h[:m].copy()
    for k in range(1, gap):
        np.minimum(least, h[k : k + m], out=least)
    todo = row[:m] == row[gap - 1 :]
    for k in range(gap - 1, -1, -1):
        hit = todo & (h[k : k + m] == least)
        out[k : k + m] |= hit
        todo &= ~hit
    return out


def spans(w: K.Words, h: np.ndarray, begin: np.ndarray, run: int = RUN, least: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first sentence, sentence after the last, hash) of each span of a slab."""
    m, n = len(begin), len(h)
    if m == 0:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(0, np.uint64)
    start = np.append(begin, n)
    i = np.arange(m)
    # the first sentence boundary that is at least `least` words and `run` sentences away
    j = np.maximum(np.searchsorted(start, start[:-1] + least, "left"), i + run)
    ok = j <= m
    i, j = i[ok], j[ok]
    same = w.row[start[i]] == w.row[start[j] - 1]
    i, j = i[same], j[same]
    # where none of these ends at a sentence's end, the shortest run that does
    ends = np.setdiff1d(np.arange(1, m + 1), j)
    back = np.minimum(np.searchsorted(start, start[ends] - least, "right") - 1, ends - run)
    ok = back >= 0
    ends, back = ends[ok], back[ok]
    same = w.row[start[back]] == w.row[start[ends] - 1]
    i, j = np.concatenate((i, back[same])), np.concatenate((j, ends[same]))
    # hash of the words of the run, from running sums of word hash times a power of an odd base
    return i, j, _run_hash(h, start[i], start[j])


def _run_hash(h: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    up, down = K._powers(len(h) + 1)
    s = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(h * up[: len(h)], out=s[1:])
    return K.mix((s[b] - s[a]) * down[a] + (b - a).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def _sentence_numbers(w: K.Words, begin: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Row of each sentence, and the number of the first sentence of each row."""
    row = w.row[begin] if len(begin) else np.zeros(0, np.int64)
    return row, np.searchsorted(row, np.arange(n + 1))


def _emit(b: pa.RecordBatch, least: int = WORDS) -> Iterator[pa.RecordBatch]:
    for s in K.slabs(b.column("text")):
        w, h, begin = sentences(s.data, s.offs)
        i, j, sh = spans(w, h, begin, least=least)
        row, first = _sentence_numbers(w, begin, s.n)
        r = row[i]
        at = pa.array(r + s.lo)
        yield table(h=K.signed(sh), doc_id=b.column("doc_id").take(at), rid=b.column("rid").take(at), pos=(i - first[r]).astype(np.int32), n=(j - i).astype(np.int32))


def _with_id(docs: DataFrame) -> DataFrame:
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.xxhash64("doc_id", "text").alias("rid"), "text")


def repeats(docs: DataFrame, least: int = WORDS) -> DataFrame:
    """Rows (rid, pos, n): spans to remove, by xxhash64(doc_id, text), first sentence and number of sentences."""
    every = over(_with_id(docs), lambda b: _emit(b, least), "h long, doc_id long, rid long, pos int, n int")
    again = cut(every.groupBy("h").count().filter("count > 1").select("h"), "span-repeats")
    found = cut(every.join(again, "h", "left_semi"), "span-places")
    # null ids last: a struct's nulls sort first, so a flag goes before
    seat = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "rid", "pos")
    first = found.groupBy("h").agg(F.min(seat).alias("first")).select("h", F.col("first.rid").alias("first_rid"), F.col("first.pos").alias("first_pos"))
    return found.join(first, "h").filter("rid != first_rid or pos != first_pos").select("rid", "pos", "n")


def _removed(docs: DataFrame, least: int = WORDS) -> DataFrame:
    """One row (rid, gone) a document that loses sentences; gone is bounded by the document."""
    spans = repeats(docs, least).groupBy("rid").agg(F.collect_set(F.struct("pos", "n")).alias("spans"))
    each = F.flatten(F.transform("spans", lambda s: F.sequence(s["pos"], s["pos"] + s["n"] - 1)))
    return cut(spans.select("rid", F.array_sort(F.array_distinct(each)).alias("gone")), "span-removed")


def remains(text: bytes | None, gone: list[int]) -> tuple[bytes | None, int, int]:
    """(what is left of a text, its number of sentences, words removed)."""
    if not text:
        return text, 0, 0
    data = np.frombuffer(text, np.uint8)
    w, _, begin = sentences(data, np.array([0, len(data)]))
    if not gone:
        return text, len(begin), 0
    start = np.append(begin, len(w.starts))
    edges = [0, *w.starts[begin[1:]].tolist(), len(text)]
    lost = set(gone)
    kept = b"".join(text[edges[i] : edges[i + 1]] for i in range(len(begin)) if i not in lost)
    return kept, len(begin), int(sum(start[i + 1] - start[i] for i in lost))


def report(docs: DataFrame, least: int = WORDS) -> DataFrame:
    """Rows (doc_id, n_sentences, n_removed, n_words_removed, n_bytes_kept, kept_sha256). ``least`` is the fewest words of a span."""
    rows = _with_id(docs).join(_removed(docs, least), "rid", "left")

    def f(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        out = [remains(t.encode() if t is not None else None, g or []) for t, g in zip(b.column("text").to_pylist(), b.column("gone").to_pylist())]
        yield table(
            doc_id=b.column("doc_id"), n_sentences=[x[1] for x in out], n_removed=pa.array([len(g or []) for g in b.column("gone").to_pylist()], pa.int64()),
            n_words_removed=[x[2] for x in out], n_bytes_kept=[len(x[0] or b"") for x in out], kept_sha256=[hashlib.sha256(x[0] or b"").hexdigest() for x in out],
        )

    return over(rows, f, "doc_id long, n_sentences long, n_removed long, n_words_removed long, n_bytes_kept long, kept_sha256 string")


def strip(docs: DataFrame, least: int = WORDS) -> DataFrame:
    """The documents with repeated sentences taken out of ``text``; all else as it was. ``least`` is the fewest words of a span."""
    rid, gone = "__judgex_rid", "__judgex_gone"
    lost = _removed(docs, least).withColumnsRenamed({"rid": rid, "gone": gone})
    maybe = marked(docs.withColumn(rid, F.xxhash64("doc_id", "text")), F.col(rid), lost.select(rid), "__judgex_maybe")
    rows = maybe.filter("__judgex_maybe").join(lost, rid, "left").select(*docs.columns, gone)
    names = docs.columns
    at = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lost = b.column(b.num_columns - 1).to_pylist()
            if b.num_rows == 0:
                continue
            cols = [b.column(i) for i in range(b.num_columns - 1)]
            if any(lost):
                text = [t if not g else remains(t.encode(), g)[0].decode() for t, g in zip(cols[at].to_pylist(), lost)]
                cols[at] = pa.array(text, cols[at].type)
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return batched(rows).mapInArrow(run, docs.schema).unionAll(maybe.filter("not __judgex_maybe").select(docs.columns))


def op9_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(spark.read.parquet(f"{sf_dir}/documents.parquet"))
