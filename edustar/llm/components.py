"""Connected components of an edge table (a long, b long) by large-star / small-star contraction.

Every round first contracts the edges of each task by a local union-find, then lets each node point its
neighbours to the smallest node around it. Groups are only ever reduced by a minimum, so the neighbours of
a hub are never gathered in one task. Rounds end when the edges are a star per component.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


EDGES_PER_TASK = 250_000


def local_roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes and the smallest node that each reaches, of the given edges; roots themselves are left out."""
    nodes, code = np.unique(np.concatenate((a, b)), return_inverse=True)
    x, y = code[: len(a)], code[len(a):]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, root[x], low)
        np.minimum.at(new, root[y], low)
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, root):
            break
        root = new
    own = root != np.arange(len(nodes))
    return nodes[own], nodes[root[own]]


def _contract(batches, limit: int = 1 << 20):
    """Contracts up to ``limit`` edges of a task at once."""
    held, n = [], 0

    def out():
        a, b = local_roots(*(np.concatenate([h[k] for h in held]) for k in (0, 1)))
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    for x in batches:
        held.append((x.column(0).to_numpy(zero_copy_only=False), x.column(1).to_numpy(zero_copy_only=False)))
        n += x.num_rows
        if n >= limit:
            yield out()
            held, n = [], 0
    if n:
        yield out()


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(a, b): every node that isn't the smallest of its component, and that smallest node."""
    e = written(edges.select("a", "b").mapInArrow(_contract, "a long, b long"), "components")
    parts = max(4, -(-e.count() // EDGES_PER_TASK))  # few edges take few tasks, whatever the shuffles are set to
    mark = None
    for _ in range(rounds):
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # the minima are written: both sides of the join are then plain shuffles, so that Spark can split
        # the many edges of a hub over tasks (or ship the minima while they are few)
        low = written(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")).coalesce(parts), "components-low")
        large = e.join(low.withColumnRenamed("a", "b"), "b").select("a", F.col("m").alias("b"))
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        e = written(small.unionByName(low.select("a", F.col("m").alias("b"))).distinct().coalesce(parts)
                    .mapInArrow(_contract, "a long, b long"), "components")
        now = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == mark:
            return e
        mark = now
    raise RuntimeError(f"components did not settle in {rounds} rounds")
