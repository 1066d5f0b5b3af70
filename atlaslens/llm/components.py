"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from atlaslens.llm.common import release, stage


#: Graphs of at most so many links (16 bytes each) are solved by one task; larger ones on the cluster, with the same result.
ONE_TASK = 1_000_000


def _solved(edges: DataFrame) -> DataFrame:
    """Union-find over a bounded number of links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}

        def root(node: int) -> int:
            top = node
            while (up := parent.setdefault(top, top)) != top:
                top = up
            while parent[node] != top:
                parent[node], node = top, parent[node]
            return top

        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                a, b = root(a), root(b)
                parent[max(a, b)] = min(a, b)
        nodes = np.fromiter(parent, dtype=np.int64, count=len(parent))
        yield pa.RecordBatch.from_arrays(
            [pa.array(nodes), pa.array([root(n) for n in nodes.tolist()], pa.int64())], names=["node", "component"]
        )

    return edges.coalesce(1).mapInArrow(run, "node long, component long")


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b longs); the component is its smallest node.

    Alternating star contraction: each node's larger neighbours are tied to its
    smallest one, then its smaller neighbours likewise, until every node is
    tied to the smallest of its component. Rounds grow with the logarithm of
    the size; each ends in a written table. Only minima and equality joins on
    nodes are used, so a node with very many links is pre-aggregated or split.
    """
    edges = stage(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"
    )
    if edges.count() <= ONE_TASK:
        return _solved(edges)
    state = None
    while True:
        before = edges
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        tied = large.join(lowest, "a")
        small = tied.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            lowest.select("a", F.col("m").alias("b"))
        ).where("a <> b").distinct()
        edges = stage(small, "stars")
        release(before)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state or not now[0]:
            break
        state = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
