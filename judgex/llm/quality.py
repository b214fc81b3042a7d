"""Quality rules: base statistics of a text, and its fertility under public tokenizer vocabularies.

Fertility has three measures: characters per token and Shannon entropy of the tokens (bits) under a byte-level
BPE for many languages, and the share of the text's bytes that a vocabulary with byte fallback has no character piece
for, so must spell as bytes. Each language, or else each script, has a band; a text outside its band is
rejected. Bands are parameters; the defaults are wide, so that odd but clean prose stays.

Defined results: null and wordless texts have zero statistics, fail the base rules, and have null fertility; null or
unknown languages take the band of the text's main script. Rows with null or repeated doc_id are judged one by one.
Texts are read whole. Further columns are ignored by ``judge`` and returned unchanged by ``keep``.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from judgex.llm import kernels as K
from judgex.llm.arrow import batched, over, table

TOKENIZERS = "/opt/tokenizers"
RANKS, PIECES = "byte_bpe_multi_50k.tiktoken", "piece_bpe_32k.model"
#: The splitting pattern published with the vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class Band(NamedTuple):
    least_chars: float
    most_chars: float
    most_fallback: float
    least_entropy: float


BANDS = {
    "en": Band(2.2, 6.5, 0.15, 5.2),
    "de": Band(2.2, 6.5, 0.15, 5.2),
    "es": Band(2.1, 6.5, 0.15, 5.2),
    "fr": Band(2.04, 6.5, 0.15, 5.2),
    "Latin": Band(1.9, 6.5, 0.2, 5.0),
    "Cyrillic": Band(1.2, 6.5, 0.2, 5.0),
    "Greek": Band(0.9, 6.5, 0.3, 4.5),
    "Arabic": Band(0.9, 6.5, 0.3, 4.5),
    "Han": Band(0.4, 3.0, 0.5, 4.5),
    "Other": Band(0.3, 6.5, 1.0, 4.0),
}
#: First and last code point of the letters that tell a script.
SCRIPTS = (("Latin", 0x41, 0x24F), ("Greek", 0x370, 0x3FF), ("Cyrillic", 0x400, 0x52F), ("Arabic", 0x600, 0x6FF), ("Han", 0x3040, 0x9FFF))
_SYMBOLS, _NEWLINE = K.byte_set(b"#*$%&|<>"), K.byte_set(b"\n")
_ROW = np.uint64(0xC2B2AE3D27D4EB4F)


def _distinct(rows: np.ndarray, h: np.ndarray, n: int) -> np.ndarray:
    """Distinct hashes in each row."""
    _, at = np.unique(K.mix(h + rows.astype(np.uint64) * _ROW), return_index=True)
    return np.bincount(rows[at], minlength=n)


def base_stats(s: K.Slab) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of each row."""
    n, data, offs = s.n, s.data, s.offs
    w = K.words(data, offs, K.WS)
    rh = K.RangeHash(data)
    cp = K.code_points(data)
    out = {"n_words": np.diff(w.first)}
    out["word_chars"] = np.bincount(w.row, weights=cp[w.ends] - cp[w.starts], minlength=n).astype(np.int64)
    out["n_symbols"] = np.diff(np.concatenate(([0], np.cumsum(_SYMBOLS[data])))[offs])
    lines = K.words(data, offs, _NEWLINE)
    filled = np.concatenate(([0], np.cumsum(~K.WS[data])))
    real = filled[lines.ends] > filled[lines.starts]
    lrow = lines.row[real]
    lh = rh(lines.starts[real], lines.ends[real])
    out["n_dup_lines"] = np.bincount(lrow, minlength=n) - _distinct(lrow, lh, n)
    rep = np.zeros(n, np.int64)
    if len(w.starts) >= 3:
        h = K.runs(rh(w.starts, w.ends), 3)
        ok = np.flatnonzero(w.row[:-2] == w.row[2:])
        key = K.mix(h[ok] + w.row[ok].astype(np.uint64) * _ROW)
        _, inv, cnt = np.unique(key, return_inverse=True, return_counts=True)
        twice = ok[cnt[inv] > 1]
        if len(twice):
            rep = np.bincount(w.row[K.coverage(len(w.starts), twice, twice + 3)], minlength=n)
    out["n_repeat_words"] = rep
    return {k: v.astype(np.int64) for k, v in out.items()}


class Vocabulary(NamedTuple):
    """What the executors need of the public vocabulary files; a few hundred kB, whatever the corpus."""

    ranks: bytes
    singles: frozenset[str]


def load(tokenizers: str = TOKENIZERS) -> Vocabulary:
    """Read the vocabulary files on the driver."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=f"{tokenizers}/{PIECES}")
    singles = {p for i in range(sp.get_piece_size()) if not sp.is_byte(i) and len(p := sp.id_to_piece(i)) == 1} | {" "}
    with open(f"{tokenizers}/{RANKS}", "rb") as f:
        return Vocabulary(f.read(), frozenset(singles))


_loaded: dict[str, object] = {}


def _encoding(v: Vocabulary):
    import tiktoken

    key = hashlib.sha1(v.ranks).hexdigest()
    if key not in _loaded:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, v.ranks.splitlines())}
        _loaded[key] = tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _loaded[key]


def fertility(text: str, enc, singles: frozenset[str]) -> tuple[float, float, float]:
    """Characters per token, byte-fallback share, token entropy of a text that isn't empty."""
    ids = enc.encode_to_numpy(text) if hasattr(enc, "encode_to_numpy") else np.array(enc.encode_ordinary(text))
    _, c = np.unique(ids, return_counts=True)
    p = c / len(ids)
    odd = set(text) - singles
    spelt = sum(text.count(x) * len(x.encode()) for x in odd)
    return len(text) / len(ids), spelt / len(text.encode()), float(-(p * np.log2(p)).sum())


def script(text: str) -> str:
    """The script of most letters."""
    cp = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    n = [(int(((cp >= a) & (cp <= b)).sum()), name) for name, a, b in SCRIPTS]
    most = max(n, key=lambda x: x[0])
    return most[1] if most[0] else "Other"


def _judged(batch: pa.RecordBatch, vocab: Vocabulary, bands: dict[str, Band]) -> dict[str, np.ndarray | list]:
    enc, texts, langs = _encoding(vocab), batch.column("text"), batch.column("lang").to_pylist()
    parts = [base_stats(s) for s in K.slabs(texts)]
    out: dict = {k: np.concatenate([p[k] for p in parts]) for k in parts[0]}
    failed = (out["n_words"] < 50) | (100 * out["n_repeat_words"] > 50 * out["n_words"])
    measures = np.full((3, len(langs)), np.nan)
    kept = ~failed
    for i in np.flatnonzero(out["n_words"]):
        text = texts[int(i)].as_py()
        c, f, e = measures[:, i] = fertility(text, enc, vocab.singles)
        if kept[i]:
            b = bands.get(langs[i]) or bands[script(text)]
            kept[i] = b.least_chars <= c <= b.most_chars and f <= b.most_fallback and e >= b.least_entropy
    return out | {"base_failed": failed, "kept": kept, "chars_per_token": measures[0], "fallback_share": measures[1], "token_entropy": measures[2]}


def judge(docs: DataFrame, tokenizers: str = TOKENIZERS, bands: dict[str, Band] = BANDS) -> DataFrame:
    """Statistics, fertility and verdict of each document."""
    vocab = docs.sparkSession.sparkContext.broadcast(load(tokenizers))

    def f(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        j = _judged(b, vocab.value, bands)
        nulls = {k: pa.array(j.pop(k), from_pandas=True) for k in ("chars_per_token", "fallback_share", "token_entropy")}
        yield table(doc_id=b.column("doc_id"), **j, **nulls)

    docs = docs.select(docs["doc_id"].cast("long"), "text", docs["lang"].cast("string"))
    return over(docs, f, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, chars_per_token double, fallback_share double, token_entropy double")


def keep(docs: DataFrame, tokenizers: str = TOKENIZERS, bands: dict[str, Band] = BANDS) -> DataFrame:
    """The documents that pass, with all their columns; no shuffle."""
    vocab = docs.sparkSession.sparkContext.broadcast(load(tokenizers))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield b.filter(pa.array(_judged(b, vocab.value, bands)["kept"]))

    return batched(docs).mapInArrow(run, docs.schema)


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(spark.read.parquet(f"{sf_dir}/documents.parquet"))
