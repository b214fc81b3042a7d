"""Lloyd's clustering of integer vectors with dual trees: cover trees over the vectors, one tree over the centroids a round.

Vectors are put into blocks of ``BLOCK`` as they come, whatever their keys, and each block's cover tree is built once and written. A round
builds a tree over the centroids and searches pairs of nodes (``covertree.nearest``): bounds on distances prune whole pairs, a node whose points
can only have one nearest centroid is settled without looking at them, and leaf pairs are compared exactly. Each task returns a count and a sum per
cluster; only these, bounded by the parameter ``k``, reach the driver, which makes the next centroids of them.

Defined results: vectors are kept if they have exactly ``dim`` components, none null or non-finite; a component x becomes
floor(scale * x), beyond ±2**27 the nearest of these two, so that squared distances fit 64 bits; a null vec_id is hashed as an
empty text; rows with one vec_id are vectors of their own; among equal hashes the smaller vector comes first;
with fewer kept vectors than k each is a centroid; with none the result is empty; ties go to the smaller number; a
centroid without vectors stays; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from judgex.llm import covertree
from judgex.llm.arrow import batched, over, table
from judgex.session import cut

BLOCK, LIMIT = 2048, 1 << 27
_TREE = "vec_ids array<long>, points binary, order binary, centre binary, lo binary, hi binary, radius binary, skip binary"


def quantised(vectors: DataFrame, dim: int = 64, scale: float = 64.0) -> DataFrame:
    """Rows (vec_id, p): the kept vectors as integers."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    kept = vectors.select(vectors["vec_id"].cast("long").alias("vec_id"), "embedding").filter((F.size("embedding") == dim) & finite)
    whole = F.transform("embedding", lambda x: F.floor(F.greatest(F.lit(float(-LIMIT)), F.least(F.lit(float(LIMIT)), scale * x.cast("double")))).cast("int"))
    return kept.select("vec_id", whole.alias("p"))


def blocks(points: DataFrame, dim: int, block: int = BLOCK) -> DataFrame:
    """One row a block of vectors: ids and points in the order of its cover tree, and the tree."""

    def packed(ids: list, p: np.ndarray) -> pa.RecordBatch:
        t = covertree.build(p)
        at = t.order.tolist()
        binary = lambda a, kind: pa.array([np.ascontiguousarray(a, kind).tobytes()], pa.binary())
        return table(
            vec_ids=pa.array([[ids[i] for i in at]], pa.list_(pa.int64())), points=binary(p[t.order], "<i4"), order=binary(t.order, "<i4"),
            centre=binary(t.centre, "<i4"), lo=binary(t.lo, "<i4"), hi=binary(t.hi, "<i4"), radius=binary(t.radius, "<f8"), skip=binary(t.skip, "<i4"),
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, held = [], []
        for b in batches:
            new = np.asarray(b.column("p").flatten()).astype(np.int64).reshape(-1, dim)
            own = b.column("vec_id").to_pylist()
            while len(own):
                room = block - len(ids)
                ids += own[:room]
                held.append(new[:room])
                own, new = own[room:], new[room:]
                if len(ids) == block:
                    yield packed(ids, np.concatenate(held))
                    ids, held = [], []
        if ids:
            yield packed(ids, np.concatenate(held))

    return batched(points).mapInArrow(run, _TREE)


def _opened(b: pa.RecordBatch, dim: int) -> Iterator[tuple[pa.Array, np.ndarray, covertree.Tree]]:
    for i in range(b.num_rows):
        get = lambda c, kind: np.frombuffer(b.column(c)[i].as_py(), kind)  # noqa: B023, E731
        points = get("points", "<i4").astype(np.int64).reshape(-1, dim)
        yield b.column("vec_ids").slice(i, 1).flatten(), points, covertree.Tree(get("order", "<i4"), get("centre", "<i4"), get("lo", "<i4"), get("hi", "<i4"), get("radius", "<f8"), get("skip", "<i4"))


def _centroid_tree(centroids: np.ndarray) -> tuple[covertree.Tree, np.ndarray]:
    t = covertree.build(centroids, leaf=1)
    return t, centroids[t.order]


def sums(trees: DataFrame, centroids: np.ndarray) -> tuple[dict[int, tuple[int, list[int]]], np.ndarray]:
    """(of each cluster with vectors its number and sum of vectors, what the searches did in all)."""
    k, dim = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ctree, sorted_ = _centroid_tree(centroids)
        count, total, did = np.zeros(k, np.int64), np.zeros((k, dim), np.int64), np.zeros(4, np.int64)
        for b in batches:
            for _, points, tree in _opened(b, dim):
                best, settled, counts = covertree.nearest(tree, points, ctree, sorted_)
                did += np.array(counts)
                loose = np.ones(len(points), bool)
                for lo, hi, c in settled:
                    count[c] += hi - lo
                    total[c] += points[lo:hi].sum(0)
                    loose[lo:hi] = False
                for c in np.unique(best[loose]).tolist():
                    own = points[loose & (best == c)]
                    count[c] += len(own)
                    total[c] += own.sum(0)
        if count.any():
            used = np.flatnonzero(count)
            yield table(cluster=used.astype(np.int32), v=pa.array(np.column_stack((count[used], total[used])).tolist(), pa.list_(pa.int64())))
            yield table(cluster=pa.array([-1], pa.int32()), v=pa.array([did.tolist()], pa.list_(pa.int64())))

    each = batched(trees).mapInArrow(run, "cluster int, v array<long>").select("cluster", F.posexplode("v").alias("i", "x"))
    found: dict[int, dict[int, int]] = {}
    for r in each.groupBy("cluster", "i").agg(F.sum(F.col("x").cast("decimal(20,0)")).alias("x")).collect():  # at most (k + 1) * (dim + 1) rows
        found.setdefault(r.cluster, {})[r.i] = int(r.x)
    did = found.pop(-1, {})
    return {c: (v[0], [v[i + 1] for i in range(dim)]) for c, v in found.items()}, np.array([did.get(i, 0) for i in range(4)])


def lloyd(trees: DataFrame, centroids: np.ndarray, rounds: int) -> tuple[np.ndarray, list[covertree.Counts]]:
    """The centroids after so many rounds, and what the searches of each round did."""
    did = []
    for _ in range(rounds):
        found, counts = sums(trees, centroids)
        did.append(covertree.Counts(*counts.tolist()))
        centroids = centroids.copy()
        for c, (n, total) in found.items():
            centroids[c] = [x // n for x in total]
    return centroids, did


def assigned(trees: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Rows (vec_id, cluster, distance)."""
    dim = centroids.shape[1]
    kept: list = []

    def f(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        if not kept:
            kept.append(_centroid_tree(centroids))
        ctree, sorted_ = kept[0]
        for ids, points, tree in _opened(b, dim):
            best, _, _ = covertree.nearest(tree, points, ctree, sorted_)
            gap = points - centroids[best]
            yield table(vec_id=ids, cluster=best.astype(np.int32), distance=np.einsum("ij,ij->i", gap, gap))

    return over(trees, f, "vec_id long, cluster int, distance long")


def seeds(points: DataFrame, k: int, seed: int) -> list[list[int]]:
    """The k vectors with the smallest hashes, in their order."""
    h = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    return [r.p for r in points.select(h.alias("h"), "p").orderBy("h", "p").limit(k).collect()]


def cluster(vectors: DataFrame, k: int = 16, rounds: int = 3, dim: int = 64, seed: int = 1, scale: float = 64.0) -> DataFrame:
    """Rows (vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256, centroid)."""
    spark = vectors.sparkSession
    points = quantised(vectors, dim, scale)
    first = seeds(points, k, seed)
    if not first:
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string, centroid array<long>")
    trees = cut(blocks(points, dim), "cluster-trees")
    centroids, _ = lloyd(trees, np.array(first, np.int64), rounds)
    rows = cut(assigned(trees, centroids), "cluster-assigned")
    spread = rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("own"))
    most = F.lit((1 << 63) - 1).cast("decimal(30,0)")
    long = lambda c: F.least(c.cast("decimal(30,0)"), most).cast("long")
    spread = spread.select("cluster", long(F.col("own")).alias("cluster_inertia"), long(F.sum("own").over(Window.partitionBy())).alias("inertia"))  # k rows
    named = [(i, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest(), c) for i, c in enumerate(centroids.tolist())]
    last = spark.createDataFrame(named, "cluster int, centroid_sha256 string, centroid array<long>").join(spread, "cluster")
    return rows.join(F.broadcast(last), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "centroid")


def op13_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet")).drop("centroid")


def _round_sql(r: int) -> str:
    return f"""
), a{r} AS (
  SELECT id, p, k, distance FROM (
    SELECT v.id, v.p, c.k, list_sum(list_transform(list_zip(v.p, c.p), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS distance,
           row_number() OVER (PARTITION BY v.id ORDER BY list_sum(list_transform(list_zip(v.p, c.p), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), c.k) AS near
    FROM v, c{r} c) WHERE near = 1
), s{r} AS (
  SELECT k, i, sum(x) AS s, count(*) AS n FROM (SELECT k, unnest(range(1, 65)) AS i, unnest(p) AS x FROM a{r}) GROUP BY k, i
), c{r + 1} AS (
  SELECT c.k, coalesce(m.p, c.p) AS p FROM c{r} c LEFT JOIN (
    SELECT k, list(CAST((s - (s % n + n) % n) // n AS BIGINT) ORDER BY i) AS p FROM s{r} GROUP BY k) m ON c.k = m.k"""


ORACLE = f"""
WITH v AS (
  SELECT row_number() OVER () AS id, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS p
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), c0 AS (
  SELECT row_number() OVER (ORDER BY h, p) - 1 AS k, p FROM (SELECT sha256('1:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h, p FROM v) ORDER BY h, p LIMIT 16
{"".join(map(_round_sql, range(3))).strip()}
), z AS (
  SELECT id, k, distance FROM (
    SELECT v.id, c.k, list_sum(list_transform(list_zip(v.p, c.p), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS distance,
           row_number() OVER (PARTITION BY v.id ORDER BY list_sum(list_transform(list_zip(v.p, c.p), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), c.k) AS near
    FROM v, c3 c) WHERE near = 1
)
SELECT vec_id, CAST(z.k AS INT) AS cluster, CAST(distance AS BIGINT) AS distance, CAST(sum(distance) OVER (PARTITION BY z.k) AS BIGINT) AS cluster_inertia,
       CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.p, ',')) AS centroid_sha256
FROM z JOIN v USING (id) JOIN c3 c ON z.k = c.k
"""
