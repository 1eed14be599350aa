"""Connected components of an edge table, by alternating star contractions.

Every round each node links its larger neighbours to its smallest one
(large star), then its smaller neighbours and itself to the smallest (small
star), until every node has either larger neighbours only or one neighbour, a
smaller one: O(log^2 n) rounds on any shape, also on long chains.  Before the
first round each task replaces its edges by stars of what they connect, once as
the edges are dealt and once for about TASK_EDGES of those stars together,
whatever number of partitions they lie in; if one such task has them all, there
is nothing left for a round.  A node with very many neighbours only needs their
minimum, which is aggregated before the shuffle.  Each round is written to the
shared folder, so a lost executor repeats one round at most.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from funnelspark.llm.common import Workspace

#: Nodes that a task holds at once when it replaces its edges by stars.
HELD_NODES = 500_000
#: Edges that a task is given, about, when small partitions are taken together (at most HELD_NODES / 2).
TASK_EDGES = 100_000


def _local_stars(edges: DataFrame, held: int = HELD_NODES) -> DataFrame:
    """Edges (a, b) with a > b that connect what those of each task connect."""
    def stars(parent):
        pairs = [(node, _root(parent, node)) for node in parent]
        a, b = zip(*[p for p in pairs if p[0] != p[1]]) if pairs else ((), ())
        return pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    def run(batches):
        parent: dict[int, int] = {}
        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if a != b:
                    x, y = _root(parent, a), _root(parent, b)
                    parent[max(x, y)] = parent[min(x, y)] = min(x, y)
            if len(parent) > held:
                yield stars(parent)
                parent = {}
        if parent:
            yield stars(parent)
    return edges.select("a", "b").mapInArrow(run, "a long, b long")


def _root(parent: dict[int, int], node: int) -> int:
    parent.setdefault(node, node)
    while parent[node] != node:
        parent[node] = parent[parent[node]]
        node = parent[node]
    return node


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v")))


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Edges (a, b) with a > b after one contraction; the large star's are dealt by ``a``."""
    if large:
        both = _both_ways(edges)
    else:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    linked = both.join(least, "u")
    if large:
        out = linked.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).repartition("a")
    else:
        out = linked.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(
            least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def connected_components(edges: DataFrame, work: Workspace | None = None) -> DataFrame:
    """(node, label) of every node of ``edges`` (a, b long): the smallest node it reaches."""
    work = work or Workspace(edges.sparkSession)
    edges = work.save(_local_stars(edges), "edges")
    tasks = -(-edges.count() // TASK_EDGES)
    if tasks:
        edges = work.save(_local_stars(edges.coalesce(tasks)), "edges")
    while tasks > 1 and _both_ways(edges).groupBy("u").agg(F.min("v").alias("low"), F.max("v").alias("high")) \
            .where("low < u and low <> high").count():
        edges = work.save(_star(_star(edges, True), False), "edges")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("label"))).distinct()
