"""Connected components by contraction: every round merges neighbours and shrinks the graph."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import IntegerType, LongType, StringType

from urbanframe.operators.staging import remove, written

#: A graph of so many edges or fewer (16 MB as numbers, some 100 MB as texts) is finished by a single task.
FEW_EDGES = 1_000_000


def _united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, root) of one partition's edges (u, v) by union and find; the root is the least node."""
    parts = [tuple(b.column(k).to_numpy(zero_copy_only=False) for k in (0, 1)) for b in batches]
    if not parts:
        return
    nodes, ends = np.unique(np.concatenate([p[k] for k in (0, 1) for p in parts]), return_inverse=True)
    parent, half = list(range(len(nodes))), len(ends) // 2

    def top(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for a, b in zip(ends[:half].tolist(), ends[half:].tolist(), strict=True):
        a, b = top(a), top(b)
        parent[max(a, b)] = min(a, b)
    roots = nodes[[top(x) for x in range(len(nodes))]]
    yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(roots)], ["node", "root"])


def _step(edges: DataFrame, turn: int) -> DataFrame:
    """(node, root): every node goes to its neighbour, or itself, of the least hash; which is least changes with the turn."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    drawn = lambda c: F.struct(F.xxhash64(F.lit(turn), c).alias("h"), F.col(c).alias("n"))
    return both.groupBy("u").agg(F.least(F.min(drawn("v")), drawn("u")).alias("to")).select(F.col("u").alias("node"), F.col("to.n").alias("root"))


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", few_edges: int = FEW_EDGES) -> DataFrame:
    """(node, component) for every node of the undirected edges; component is the component's least node.

    In each round a node goes to the neighbour of the least hash, and edges take the places of their ends; half of all
    nodes that have edges are expected to go. When few_edges or fewer are left and nodes are integers or texts, one task
    finishes them, in bounded memory and with the same result. Rounds are written to the shared folder
    and the one before is removed; only counts reach the driver. Loops count as nodes; edges with a null end are left out.
    """
    ends = edges.filter(F.col(src).isNotNull() & F.col(dst).isNotNull()).select(F.col(src).alias("u"), F.col(dst).alias("v"))
    own = written(ends.distinct(), "edges")
    left, turn, maps = own.filter("u <> v"), 0, []
    kind = own.schema["u"].dataType
    plain = isinstance(kind, IntegerType | LongType | StringType) and own.schema["v"].dataType == kind
    while True:
        n = left.count()
        if not n or plain and n <= few_edges:
            break
        maps.append(written(_step(left, turn), "steps"))
        to = lambda c, m=maps[-1]: m.select(F.col("node").alias(c), F.col("root").alias(f"to_{c}"))
        moved = left.join(to("u"), "u").join(to("v"), "v").filter("to_u <> to_v")
        after = written(moved.select(F.least("to_u", "to_v").alias("u"), F.greatest("to_u", "to_v").alias("v")).distinct(), "edges")
        if turn:
            remove(left)
        left, turn = after, turn + 1
    if n:
        maps.append(written(left.coalesce(1).mapInArrow(_united, f"node {kind.simpleString()}, root {kind.simpleString()}"), "steps"))
    # from the last round back, so that every node's root is a root of the end
    labels = None
    for m in reversed(maps):
        if labels is not None:
            further = labels.select(F.col("node").alias("mid"), F.col("root").alias("end"))
            m = written(m.withColumnRenamed("root", "mid").join(further, "mid", "left").select("node", F.coalesce("end", "mid").alias("root")), "labels")
        labels = m
    nodes = own.select(F.col("u").alias("node")).union(own.select("v")).distinct()
    if labels is None:
        return nodes.withColumn("component", F.col("node"))
    rooted = nodes.join(labels, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = rooted.groupBy("root").agg(F.min("node").alias("component"))
    return written(rooted.join(written(least, "component-ids"), "root").select("node", "component"), "components")
