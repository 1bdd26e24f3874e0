"""Connected components of a graph by alternating star contractions."""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subscope.llm.shared import Held

EDGES = "u long, v long"
#: Edges that one task contracts by itself.
EDGES_PER_TASK = 250_000


def _contract(batches):
    """The edges of one partition as stars: every node with the smallest one that it reaches within the partition."""
    parent: dict[int, int] = {}

    def root(x):
        top = x
        while parent.get(top, top) != top:
            top = parent[top]
        while parent.get(x, x) != top:
            parent[x], x = top, parent[x]
        return top

    for batch in batches:
        for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = root(u), root(v)
            parent[max(a, b)] = min(a, b)
    nodes = [x for x in parent if root(x) != x]
    pairs = np.array([(x, parent[x]) for x in nodes], dtype=np.int64).reshape(-1, 2)
    yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["u", "v"])


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node's larger neighbours move to the smallest of the node and its neighbours."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    smallest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours move to the smallest of them. Edges go from larger to smaller."""
    smallest = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(smallest, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(smallest.select("u", F.col("m").alias("v"))).distinct()


def _is_done(edges: DataFrame) -> bool:
    """Whether the edges are stars: no node has two edges to smaller ones, or one to a smaller and one to a larger."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("down"), F.lit(0).alias("up"))
    ends = ends.union(edges.select(F.col("v").alias("x"), F.lit(0).alias("down"), F.lit(1).alias("up")))
    each = ends.groupBy("x").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return not each.where("down > 1 OR down + up > 1").head(1)


def components(spark: SparkSession, held: Held, edges: DataFrame) -> DataFrame:
    """(node, root) of every node with an edge, where root is the smallest node reachable.

    `edges` has the columns u and v; loops, repeated and reversed edges do no harm. Nodes without an edge to
    another node are absent. Tasks first contract EDGES_PER_TASK edges each. A round between them is two grouped minima
    and two joins, written to the shared folder; a hub with a third of all edges is combined before its shuffle, and
    its join is one that Spark may split.
    """
    edges = edges.where("u <> v").select(F.col("u").cast("long"), F.col("v").cast("long"))
    current = held.table(edges)
    while True:
        tasks = max(1, -(-current.count() // EDGES_PER_TASK))
        stars = held.table(current.coalesce(tasks).mapInArrow(_contract, EDGES))
        held.drop(current)
        if tasks == 1 or _is_done(stars):
            return stars.select(F.col("u").alias("node"), F.col("v").alias("root"))
        large = held.table(_large_star(stars))
        current = held.table(_small_star(large))
        held.drop(stars, large)
