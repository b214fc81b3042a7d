"""Quality classifier: ridge regression on random Fourier features of document statistics, calibrated isotonically.

Statistics of a text (lengths, character shares, repetition; never labels, lang, source or ids) are standardised and
mapped to ``FEATURES`` cosines whose inner products approximate a Gaussian kernel. Each partition sums its part of the
normal equations; the sums are added up in a bounded number of tasks and solved on the driver, whatever the number of
rows. Ridge scores of a fold of the training rows that the fit hasn't seen are binned, made monotone by pool-adjacent-
violators, and give the map from score to the chance of label 1.

Training rows are those whose crc32(doc_id as text) mod 4 isn't 2: 0 and 1 fit, 3 calibrates. All labelled rows count;
nothing is sampled.

Defined results: null and empty texts have the statistics of the empty text and get a score; null labels and labels of
unknown doc_ids don't count; repeated labels and documents count each; a null doc_id is never held out
and never labelled; without training rows every score is 0.5; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from judgex.llm import kernels as K
from judgex.llm.arrow import over, table
from judgex.llm.quality import base_stats
from judgex.session import cut

FEATURES, RIDGE, BINS, SUMS = 256, 1e-3, 2000, 16
NAMES = (
    "words chars_a_word spread_of_word_chars capitals digits symbols stops commas exclaims bars other_bytes distinct_words dup_lines repeat_words words_a_line short_words byte_entropy white capital_words longest_word letters"
).split()
_UPPER, _DIGIT = K.byte_set(bytes(range(65, 91))), K.byte_set(b"0123456789")
_LETTER = K.byte_set(bytes([*range(65, 91), *range(97, 123), *range(128, 256)]))


def statistics(s: K.Slab) -> np.ndarray:
    """A row of NAMES for each text of a slab."""
    n, data, offs = s.n, s.data, s.offs
    base = base_stats(s)
    w = K.words(data, offs, K.WS)
    cp = K.code_points(data)
    size = (cp[w.ends] - cp[w.starts]).astype(float)
    words = np.maximum(base["n_words"], 1)
    per = lambda x: np.bincount(w.row, weights=x, minlength=n) / words
    total = np.maximum(np.diff(cp[offs]), 1)
    count = lambda mask: np.diff(np.concatenate(([0], np.cumsum(mask[data])))[offs])
    of = lambda chars: count(K.byte_set(chars))
    hist = np.zeros((n, 256))
    for i in range(n):
        hist[i] = np.bincount(data[offs[i] : offs[i + 1]], minlength=256)
    share = hist / np.maximum(hist.sum(1, keepdims=True), 1)
    entropy = -(share * np.log2(np.where(share > 0, share, 1))).sum(1)
    h = K.RangeHash(data)(w.starts, w.ends)
    _, at = np.unique(K.mix(h + w.row.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)), return_index=True)
    distinct = np.bincount(w.row[at], minlength=n)
    mean = per(size)
    longest = np.zeros(n)
    np.maximum.at(longest, w.row, size)
    letters = np.maximum(count(_LETTER), 1)
    lines = of(b"\n") + 1
    cols = [
        np.log1p(base["n_words"]), mean, np.sqrt(np.maximum(per(size**2) - mean**2, 0)), count(_UPPER) / letters, count(_DIGIT) / total, base["n_symbols"] / words, of(b".?") / words, of(b",;:") / words,
        of(b"!") / words, of(b"|") / words, (hist[:, 128:].sum(1)) / total, distinct / np.sqrt(words), base["n_dup_lines"] / lines, base["n_repeat_words"] / words, np.log1p(base["n_words"] / lines),
        per((size <= 3).astype(float)), entropy, count(K.WS) / total, per(_UPPER[data[w.starts]].astype(float)) if len(w.starts) else np.zeros(n), np.log1p(longest), count(_LETTER) / total,
    ]
    return np.stack([np.asarray(c, float) for c in cols], 1)


def _measured(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, x): the statistics of every text."""

    def f(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for s in K.slabs(b.column("text")):
            x = statistics(s)
            flat = pa.array(x.ravel())
            rows = pa.ListArray.from_arrays(pa.array(np.arange(s.n + 1, dtype=np.int32) * len(NAMES)), flat)
            yield table(doc_id=b.column("doc_id").slice(s.lo, s.n), x=rows)

    return over(docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text"), f, "doc_id long, x array<double>")


def _matrix(col: pa.Array) -> np.ndarray:
    return col.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(NAMES))


class Model:
    """Standardisation, random directions, ridge weights and the calibration curve; of fixed size."""

    def __init__(self, mean: np.ndarray, spread: np.ndarray, features: int = FEATURES, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.mean, self.spread = mean, np.where(spread > 1e-9, spread, 1.0)
        self.directions = rng.normal(0, 1 / np.sqrt(len(mean)), (len(mean), features))
        self.phase = rng.uniform(0, 2 * np.pi, features)
        self.weights: np.ndarray | None = None
        self.curve: tuple[np.ndarray, np.ndarray] = (np.zeros(1), np.full(1, 0.5))

    def lifted(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.spread, -6, 6) @ self.directions + self.phase
        return np.concatenate((np.cos(z) * np.sqrt(2 / len(self.phase)), np.ones((len(x), 1))), 1)

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.zeros(len(x)) if self.weights is None else self.lifted(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(x), *self.curve), 0, 1)


def isotonic(at: np.ndarray, n: np.ndarray, positive: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over bins in order of score: points of a monotone curve."""
    blocks: list[list[float]] = []  # weight, positives, sum of weight times score
    for x, w, p in zip(at.tolist(), n.tolist(), positive.tolist()):
        blocks.append([w, p, w * x])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    b = np.array(blocks)
    return b[:, 2] / b[:, 0], b[:, 1] / b[:, 0]


def _normal_equations(train: DataFrame, model: Model, ridge: float) -> np.ndarray | None:
    """Ridge weights from sums by partition, added up in ``SUMS`` tasks."""
    d = FEATURES + 1

    def by_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        a, c, n = np.zeros((d, d)), np.zeros(d), 0
        for b in batches:
            if b.num_rows:
                z, y = model.lifted(_matrix(b.column("x"))), b.column("y").to_numpy()
                a, c, n = a + z.T @ z, c + z.T @ y, n + len(y)
        if n:
            yield table(slot=pa.array([TaskContext.get().partitionId() % SUMS]), sums=pa.array([np.concatenate((a.ravel(), c, [n])).tobytes()], pa.binary()))

    def add(t: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x.as_py()) for x in t.column("sums"))
        return pa.table({"sums": pa.array([total.tobytes()], pa.binary())})

    from judgex.llm.arrow import batched

    parts = batched(train).mapInArrow(by_partition, "slot long, sums binary").groupBy("slot").applyInArrow(add, "sums binary").collect()
    if not parts:
        return None
    total = sum(np.frombuffer(r[0]) for r in parts)
    a, c, n = total[: d * d].reshape(d, d), total[d * d : -1], total[-1]
    penalty = np.full(d, ridge * n)
    penalty[-1] = 0
    return np.linalg.lstsq(a + np.diag(penalty), c, rcond=None)[0]


def fit(measured: DataFrame, labels: DataFrame) -> Model:
    """``measured`` has (doc_id, x), ``labels`` (doc_id, y); both are the caller's training rows."""
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4))
    rows = cut(measured.join(labels, "doc_id").select("x", "y", (fold == 3).alias("calibrate")), "classifier-rows")
    train, rest = rows.filter("not calibrate"), rows.filter("calibrate")
    cols = [F.col("x")[i] for i in range(len(NAMES))]
    stats = train.agg(*(F.avg(c) for c in cols), *(F.stddev_pop(c) for c in cols)).first()
    values = np.array([0.0 if v is None else v for v in stats])
    model = Model(values[: len(NAMES)], values[len(NAMES) :])
    model.weights = _normal_equations(train.select("x", "y"), model, RIDGE)
    if model.weights is None:
        return model
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def scores(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        yield table(s=shared.value.raw(_matrix(b.column("x"))), y=b.column("y"))

    binned = over(rest.select("x", "y"), scores, "s double, y double")
    at = F.greatest(F.lit(0), F.least(F.lit(BINS - 1), F.floor((F.col("s") + 0.5) * (BINS / 2))))
    points = sorted(binned.groupBy(at.alias("bin")).agg(F.avg("s").alias("s"), F.count(F.lit(1)).alias("n"), F.sum("y").alias("p")).collect())
    if points:
        model.curve = isotonic(*(np.array([float(r[c]) for r in points]) for c in ("s", "n", "p")))
    else:
        model.curve = (np.array([0.0, 1.0]), np.array([0.0, 1.0]))
    return model


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows (doc_id, held_out, score, predicted); ``labels`` has doc_id and quality."""
    held = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))
    measured = cut(_measured(docs), "classifier-statistics")
    own = labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels["quality"].cast("double").alias("y")).filter("doc_id is not null and y is not null").filter(~held)
    model = docs.sparkSession.sparkContext.broadcast(fit(measured, own))

    def f(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        s = model.value.score(_matrix(b.column("x")))
        yield table(doc_id=b.column("doc_id"), held_out=b.column("held_out"), score=s, predicted=(s >= 0.7).astype(np.int32))

    return over(measured.withColumn("held_out", held), f, "doc_id long, held_out boolean, score double, predicted int")


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
