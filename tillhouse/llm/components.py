"""Connected components of links, without gathering any node's links in one place."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillhouse.llm.common import cut, ship

#: Links contracted at a time.
CHUNK = 500_000


def stars(a: list[int], b: list[int]) -> tuple[list[int], list[int]]:
    """Links that hang every node of some links on the smallest one it can reach by them."""
    root: dict[int, int] = {}

    def find(node: int) -> int:
        top = node
        while root.setdefault(top, top) != top:
            top = root[top]
        while node != top:
            root[node], node = top, root[node]
        return top

    for x, y in zip(a, b):
        x, y = find(x), find(y)
        if x != y:
            root[max(x, y)] = min(x, y)
    nodes = [n for n in root if root[n] != n]
    return nodes, [find(n) for n in nodes]


def contract(edges: DataFrame) -> DataFrame:
    """`u, v` edges with the same components: what a task holds becomes stars, chunk by chunk."""
    ship(edges.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        u, v = [], []

        def out() -> pa.RecordBatch:
            nodes, roots = stars(np.concatenate(u).tolist(), np.concatenate(v).tolist())
            u.clear()
            v.clear()
            return pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(roots, pa.int64())], names=["u", "v"])

        for batch in batches:
            u.append(batch.column(0).to_numpy())
            v.append(batch.column(1).to_numpy())
            if sum(map(len, u)) >= CHUNK:
                yield out()
        if u:
            yield out()

    return edges.select(F.col("u").cast("long"), F.col("v").cast("long")).mapInArrow(run, "u long, v long")


def components(links: DataFrame) -> DataFrame:
    """`node, component` (the smallest node reachable) for every node of `a, b` links.

    Tasks contract what they hold first. Then two steps alternate until nothing changes. Large star:
    every node hangs its larger neighbours on the smallest node it sees. Small star: the same for its
    smaller ones and itself. Both only need a minimum per node and a join, which is
    combined before it is shuffled. The number of rounds grows with the logarithm of the number of nodes.
    """
    links = links.where(F.col("a") != F.col("b"))
    edges = cut(contract(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))).distinct(), "links")
    while not _settled(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where(F.col("u") != F.col("v")).distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        edges = cut(small.select("e.u", "e.v").where(F.col("u") != F.col("v")).distinct(), "links")
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots.select("node", F.col("node").alias("component")))


def _settled(edges: DataFrame) -> bool:
    """Whether every node hangs on one root only and no root hangs itself; one count per node tells."""
    up = edges.select(F.col("u").alias("node"), F.lit(1).alias("ups"), F.lit(0).alias("downs"))
    down = edges.select(F.col("v").alias("node"), F.lit(0).alias("ups"), F.lit(1).alias("downs"))
    seen = up.unionByName(down).groupBy("node").agg(F.sum("ups").alias("ups"), F.max("downs").alias("downs"))
    return seen.where((F.col("ups") > 1) | ((F.col("ups") > 0) & (F.col("downs") > 0))).isEmpty()
