"""Connected components of an edge table, by contraction within tasks and pointer jumping.

Every task contracts the edges it holds: each node goes to the least one that
it is connected with in that task.  So a node is the upper end of one edge a
task at most, and edges can be dealt by it whatever its degree.  Dealt so, they are contracted
again, and an edge whose lower end has a lower one itself jumps there.  It ends when
no lower end has one and no node has two different ones.

A task holds a bounded block of edges and one row for each of its nodes.  Edges and
jumps are written to the shared folder, so lineage stays short and a lost
executor costs one round at most; the join that jumps has one row per node
on one side, and Spark splits a hub on the other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonekit.llm.common import staged

#: edges that a task holds besides one for each of its nodes
_BLOCK = 1 << 20


def least_connected(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, least node connected with it) of every node that is not the least itself."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    low = np.arange(len(nodes))
    while True:
        ends = low[a], low[b]
        apart = ends[0] != ends[1]
        if not apart.any():
            break
        a, b = a[apart], b[apart]
        # a root goes to the least root that an edge leads to, then every node to its root
        np.minimum.at(low, np.maximum(*ends)[apart], np.minimum(*ends)[apart])
        while (low != (higher := low[low])).any():
            low = higher
    moved = np.flatnonzero(low != np.arange(len(nodes)))
    return nodes[moved], nodes[low[moved]]


def _contracted(edges: DataFrame) -> DataFrame:
    """(u, v): every node of a task's edges with the least one that they connect it with."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        u = v = np.zeros(0, dtype=np.int64)
        waiting, rows = [(u, v)], 0
        for batch in batches:
            waiting.append((batch.column("u").to_numpy(), batch.column("v").to_numpy()))
            rows += batch.num_rows
            if rows >= max(_BLOCK, len(u)):
                u, v = least_connected(*map(np.concatenate, zip(*waiting)))
                waiting, rows = [(u, v)], 0
        u, v = least_connected(*map(np.concatenate, zip(*waiting)))
        yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

    return edges.mapInArrow(run, "u long, v long")


def _jumps(edges: DataFrame) -> DataFrame:
    """(node, low): the least lower end of every node that is a lower end itself or has several."""
    upper = edges.select(F.col("u").alias("node"), F.col("v").alias("low"))
    lower = edges.select(F.col("v").alias("node"), F.lit(None).cast("long").alias("low"))
    seen = upper.unionByName(lower).groupBy("node").agg(
        F.min("low").alias("low"), F.max("low").alias("high"), F.max(F.col("low").isNull()).alias("below")
    )
    return seen.filter(F.col("below") & F.col("low").isNotNull() | (F.col("low") < F.col("high"))).select("node", "low")


def stars(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """``edges`` as (u, v): every node with the least one of its component, where that is another; rows may repeat."""
    parts = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ends = edges.select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v")).filter("u <> v")
    while True:
        dealt = _contracted(ends).repartition(parts, "u")
        found = staged(_contracted(dealt), "edges")
        jumps = staged(_jumps(found), "jumps")
        if jumps.isEmpty():
            return found
        to = jumps.select(F.col("node").alias("v"), "low")
        ends = found.join(to, "v", "left").select("u", F.coalesce("low", "v").alias("v"))


def members(found: DataFrame) -> DataFrame:
    """(node, root) of every node of ``stars``."""
    roots = found.select(F.col("v").alias("node"), F.col("v").alias("root"))
    return found.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots).distinct()


def components(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """(node, root) for every node of ``edges``, whose ends are longs; the root is the component's least node."""
    return members(stars(edges, left, right))
