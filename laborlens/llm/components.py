"""Connected components by alternating large and small stars."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from laborlens.llm.frames import map_arrow, split_join, stage

#: Edges that a task contracts at a time.
CONTRACTED = 1 << 17


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges (u, v), u > v, that join the same nodes as a task's edges: each node with the smallest it reaches by them."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[up]
        return x

    def flush() -> pa.RecordBatch:
        pairs = [(x, r) for x in list(parent) if (r := root(x)) != x]
        parent.clear()
        return pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], ["u", "v"])

    seen = 0
    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
        seen += batch.num_rows
        if seen >= CONTRACTED:
            yield flush()
            seen = 0
    yield flush()


def connected_components(edges: DataFrame) -> DataFrame:
    """node and component (its smallest node) of every node that an edge (a, b) touches.

    Each task first contracts its own edges. Each round then links a node's larger neighbours to its smallest one, then its
    smaller neighbours; components halve their depth or better. Neighbours are never collected, so a hub is an aggregate and
    a join that Spark can split. What a round leaves is written to a table, and counted while it is, so the driver holds one
    round's plan at a time. Edges may repeat; an edge from a node to itself names a node without neighbours.
    """
    edges = stage(edges.select("a", "b"))
    loops = edges.filter("a = b").select(F.col("a").alias("node")).distinct()
    now = stage(map_arrow(edges.filter("a <> b"), _contract, "u long, v long").distinct())
    before = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = split_join(both, least, "u", cut=stage).filter("v > u")
        large = large.select(F.col("v").alias("u"), F.least("m", "u").alias("v"))
        large = stage(large.distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        pairs = F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v"))))
        small = split_join(large, least, "u", cut=stage).select(pairs.alias("e")).select("e.u", "e.v").filter("u <> v").distinct()
        state = Observation()
        now = stage(small.observe(state, F.count("*").alias("n"), F.sum(F.xxhash64("u", "v") % 1_000_000_007).alias("s")))
        if state.get == before:
            break
        before = state.get
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component"))
    alone = loops.select("node", F.col("node").alias("component"))
    return stars.unionByName(roots).unionByName(alone).groupBy("node").agg(F.min("component").alias("component"))
