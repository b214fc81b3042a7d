"""Connected components of an undirected graph held as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from judgex.session import cut

MAX_ROUNDS = 60


def components(edges: DataFrame) -> DataFrame:
    """Rows (v, root) for every vertex of ``edges`` (a, b): root is the least vertex it is connected with.

    Each round hooks every vertex to its least neighbour, follows the hooks to their roots by
    doubling, and contracts the graph to the roots. Only minima and joins on vertices are used, so a hub with a
    third of all edges is combined on the map side and never gathered. The graph shrinks by half a round at
    least; every round ends in a written table. Duplicate edges and loops do no harm.
    """
    graph = cut(edges.select("a", "b").filter("a != b").distinct(), "cc-edges")
    known = None
    for _ in range(MAX_ROUNDS):
        if graph.isEmpty():
            break
        both = graph.select("a", "b").unionAll(graph.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = cut(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("p")), "cc-hooks")
        for _ in range(MAX_ROUNDS):
            up = hooks.select(F.col("a").alias("p"), F.col("p").alias("pp"))
            jumped = cut(hooks.join(up, "p", "left").select("a", F.coalesce("pp", "p").alias("p"), (F.coalesce("pp", "p") != F.col("p")).alias("moved")), "cc-jump")
            moved = not jumped.filter("moved").isEmpty()
            hooks = jumped.select("a", "p")
            if not moved:
                break
        roots = hooks.select(F.col("a").alias("v"), F.col("p").alias("root"))
        if known is None:
            known = roots
        else:
            step = hooks.select(F.col("a").alias("root"), F.col("p").alias("up"))
            known = cut(known.join(step, "root", "left").select("v", F.coalesce("up", "root").alias("root")), "cc-known")
        pa, pb = hooks.toDF("a", "pa"), hooks.toDF("b", "pb")
        graph = cut(graph.join(pa, "a").join(pb, "b").filter("pa != pb").select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(), "cc-graph")
    else:
        raise RuntimeError("components did not settle")
    if known is None:
        return graph.select(F.col("a").alias("v"), F.col("b").alias("root"))
    return known
