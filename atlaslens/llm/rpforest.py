"""Near-duplicate vectors by a forest of random-projection trees.

Every tree splits by random directions at medians that a bounded sample gives;
vectors close to a split go both ways (spill). Vectors of one leaf are compared
exactly, in double precision, and what the trees find is united. Equal vectors
are one class from the start.

A pair is counted by the first leaf that holds both (by tree, then by number) and
passed over by all others, so the numbers of links are sums and no list of pairs
exists anywhere: a comparison gives the links of each vector and so many links as
hold its vectors together, one fewer than there are. Leaves are worked out again
where vectors are compared. They come out the same, as directions and vectors are
whole numbers there, whose products are exact in any order.

The deeper a tree, the more of its splits can part two near vectors, most of all
in a large group of loose near copies, which medians cut again and again. So
deeper forests have more trees, such that the share of links that no tree finds
stays about the same; they run in rounds, which bounds disk and memory. It is a
share to be expected, not a guarantee.

Fitted on a sample: the splits only. Every vector is put into leaves. Trees are
no deeper than the sample has medians for, so from some 6.5 million vectors on
leaves grow with the input; leaves that are too large for one task are compared
in chunks, every two chunks by one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from atlaslens.llm.common import stage
from atlaslens.llm.components import connected_components

COSINE = 0.9
TREES = 10  # at least, and of one round
# At a level of a tree about this share of the links of a loose group (mean cosine 0.9) stays together; so many trees
# grow that no more than MISS of the links are expected to be missed by all.
STAYS, MISS = 0.88, 0.01
# A vector of length 1 goes both ways at a split this near, in units of how far projections spread (1 / sqrt(width)).
SPILL = 0.16
SAMPLE = 20_000  # the splits are fitted on about so many vectors, chosen by a hash,
SAMPLE_BYTES = 64 << 20  # and on fewer wide ones, so that they stay within this
LEAF = 400  # vectors of a leaf that a tree aims at
CHUNK = 2_048  # vectors of one side of a comparison in one task
MAX_DEPTH = 24
SEED = 97
# Components of vectors and directions as whole numbers; a product of two stays below 2**53.
VECTOR_STEPS, DIRECTION_STEPS = float(1 << 26), float(1 << 24)


def unit(vectors: np.ndarray) -> np.ndarray:
    """Scaled to length 1 in double precision."""
    scale = np.abs(vectors).max(axis=1, keepdims=True)  # squares of very large or small components stay finite
    vectors = vectors / scale
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def whole(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length 1 in whole steps."""
    return np.rint(vectors * VECTOR_STEPS)


@dataclass
class Tree:
    """One direction per level, one threshold per node; node k has the children 2k + 1 and 2k + 2."""

    directions: np.ndarray  # in whole steps
    thresholds: np.ndarray

    def leaves(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) of every vector and each of its leaves, the same whatever other vectors there are."""
        rows, nodes = np.arange(len(vectors)), np.zeros(len(vectors), np.int64)
        near = SPILL / np.sqrt(vectors.shape[1])
        along = whole(vectors) @ self.directions.T / (VECTOR_STEPS * DIRECTION_STEPS)
        for level in range(len(self.directions)):
            away = along[rows, level] - self.thresholds[nodes]
            left, right = away < near, away >= -near
            rows, nodes = (
                np.concatenate((rows[left], rows[right])), np.concatenate((2 * nodes[left] + 1, 2 * nodes[right] + 2))
            )
        return rows, nodes


def trees_of(depth: int) -> int:
    return max(TREES, int(np.ceil(np.log(MISS) / np.log1p(-(STAYS**depth))))) if depth else TREES


def fit(sample: np.ndarray, total: int, trees: int | None = None, leaf: int = LEAF, seed: int = SEED) -> list[Tree]:
    """Trees deep enough for ``total`` vectors, as far as the sample has medians for their nodes; as many as the depth asks for."""
    random = np.random.default_rng(seed)
    depth = max(0, int(np.ceil(np.log2(max(total, 1) / leaf))))
    depth = min(depth, MAX_DEPTH, int(np.log2(max(len(sample), 1))))
    forest = []
    for _ in range(trees or trees_of(depth)):
        directions = np.rint(unit(random.normal(size=(max(depth, 1), sample.shape[1]))) * DIRECTION_STEPS)[:depth]
        thresholds = np.zeros(2 ** depth - 1)
        nodes = np.zeros(len(sample), np.int64)
        for level, direction in enumerate(directions):
            along = whole(sample) @ direction / (VECTOR_STEPS * DIRECTION_STEPS)
            for node in range(2 ** level - 1, 2 ** (level + 1) - 1):
                inside = along[nodes == node]
                if len(inside):
                    thresholds[node] = np.median(inside)
            nodes = 2 * nodes + 1 + (along >= thresholds[nodes])
        forest.append(Tree(directions, thresholds))
    return forest


def _matrix(values: list[bytes], kind: str) -> np.ndarray:
    """Vectors of length 1 from their components as they were stored."""
    return unit(np.frombuffer(b"".join(values), kind).reshape(len(values), -1).astype(np.float64))


def component_kind(vectors: DataFrame) -> str:
    """Components travel as they are stored: single precision where the table has it, else double."""
    return "<f4" if vectors.schema["embedding"].dataType.elementType.simpleString() == "float" else "<f8"


def classes(vectors: DataFrame) -> DataFrame:
    """(vec_id, key, width, vector): the components as bytes and a hash of them, null where the vector links with nothing.

    That is: null, empty or zero vectors, and those with a null or non-finite
    component. Only vectors with equal components are one class.
    """
    kind = component_kind(vectors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, widths = [], []
            for value in batch.column(1):
                v = np.array(value.as_py() if value.is_valid else [], dtype=np.float64)  # null components become nan
                good = len(v) > 0 and np.isfinite(v).all() and v.any()
                out.append((v + 0.0).astype(kind).tobytes() if good else None)  # -0 becomes 0
                widths.append(len(v))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(widths, pa.int32()), pa.array(out, pa.binary())], names=["vec_id", "width", "vector"]
            )

    return vectors.select("vec_id", "embedding").mapInArrow(run, "vec_id long, width int, vector binary").withColumn("key", F.xxhash64("vector"))


def leaf_rows(points: DataFrame, forest: Broadcast, trees: range, width: int, kind: str) -> DataFrame:
    """(tree, leaf, key, copies, vector) for every leaf that every point has in some trees of the forest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            matrix = _matrix(batch.column("vector").to_pylist(), kind)
            for number in trees:
                rows, leaves = forest.value[number].leaves(matrix)
                take = pa.array(rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(rows), number, np.int32)), pa.array(leaves), *(batch.column(k).take(take) for k in range(3))],
                    names=["tree", "leaf", "key", "copies", "vector"],
                )

    schema = "tree int, leaf long, key long, copies long, vector binary"
    return points.where(F.col("width") == width).select("key", "copies", "vector").mapInArrow(run, schema)


def dealt(rows: DataFrame) -> DataFrame:
    """Gives every two chunks of a large leaf a task: adds chunk (the pair) and slot (the side, -1 for a chunk with itself)."""
    sizes = rows.groupBy("tree", "leaf").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks"))
    own = F.pmod(F.hash("key"), F.col("chunks")).cast("int")
    each = F.transform(F.sequence(F.lit(0), F.col("chunks") - 1), lambda o: F.struct(
        (F.least(o, F.col("own")) * F.col("chunks") + F.greatest(o, F.col("own"))).cast("long").alias("chunk"),
        F.when(o == F.col("own"), F.lit(-1)).otherwise(F.col("own")).cast("int").alias("slot"),
    ))
    return rows.join(sizes, ["tree", "leaf"]).withColumn("own", own).withColumn("at", F.explode(each)).select(*rows.columns, "at.chunk", "at.slot")


def met_before(vectors: np.ndarray, forest: list[Tree], tree: int, leaf: int) -> np.ndarray:
    """Which two of the vectors share a leaf of an earlier tree, or one of this tree with a smaller number."""
    met = np.zeros((len(vectors), len(vectors)), bool)
    for number in range(tree + 1):
        rows, leaves = forest[number].leaves(vectors)
        if number == tree:
            rows, leaves = rows[leaves < leaf], leaves[leaves < leaf]
        order = np.argsort(leaves, kind="stable")
        rows, leaves = rows[order], leaves[order]
        starts = np.flatnonzero(np.r_[True, leaves[1:] != leaves[:-1]]) if len(leaves) else leaves
        ends = np.r_[starts[1:], len(leaves)]
        for low, high in zip(starts[ends - starts > 1].tolist(), ends[ends - starts > 1].tolist()):
            inside = rows[low:high]
            met[inside[:, None], inside] = True
    return met


def spanning(near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (two arrays of rows) that hold together what a symmetric matrix of links does, at most one a row."""
    left = near.any(axis=1)
    froms, tos = [], []
    while left.any():
        first = int(np.argmax(left))
        left[first], waiting = False, [first]
        while waiting:
            row = waiting.pop()
            new = np.flatnonzero(near[row] & left)
            left[new] = False
            froms.append(np.full(len(new), row))
            tos.append(new)
            waiting += new.tolist()
    none = np.empty(0, np.int64)
    return np.concatenate([none, *froms]), np.concatenate([none, *tos])


def compare(rows: DataFrame, forest: Broadcast, least: float, kind: str) -> DataFrame:
    """What each tree, leaf and chunk finds first: (a, b, others).

    Rows with a null b say how many other vectors key a links with, copies
    counted; those with b are links that hold together all pairs found.
    """

    def run(group: pd.DataFrame) -> pd.DataFrame:
        keys, copies, slot = (group[name].to_numpy() for name in ("key", "copies", "slot"))
        sides = [np.flatnonzero(slot == s) for s in np.unique(slot)]
        none = pd.DataFrame({"a": keys[:0], "b": pd.array([], "Int64"), "others": keys[:0]})
        if len(keys) < 2 or len(sides) == 1 and slot[0] >= 0:
            return none
        matrix = _matrix(group["vector"].tolist(), kind)
        near = np.zeros((len(keys), len(keys)), bool)
        left, right = sides[0], sides[-1]
        for low in range(0, len(left), 512):
            some = left[low : low + 512]
            near[some[:, None], right] = matrix[some] @ matrix[right].T >= least
        near |= near.T
        np.fill_diagonal(near, False)
        linked = np.flatnonzero(near.any(axis=1))
        if not len(linked):
            return none
        tree, leaf = int(group["tree"].iat[0]), int(group["leaf"].iat[0])
        near = near[linked[:, None], linked] & ~met_before(matrix[linked], forest.value, tree, leaf)
        keys, copies = keys[linked], copies[linked]
        others = np.zeros(len(keys), np.int64)
        for low in range(0, len(keys), 512):
            others[low : low + 512] = np.where(near[low : low + 512], copies, 0).sum(axis=1)
        one, two = spanning(near)
        counted = np.flatnonzero(others)
        return pd.DataFrame({
            "a": np.concatenate((keys[counted], keys[one])),
            "b": pd.array([None] * len(counted) + keys[two].tolist(), "Int64"),
            "others": np.concatenate((others[counted], np.zeros(len(one), np.int64))),
        })

    return rows.groupBy("tree", "leaf", "chunk").applyInPandas(run, "a long, b long, others long")


def near_duplicates(vectors: DataFrame, least: float = COSINE, trees: int | None = None) -> DataFrame:
    """vec_id, n_links, component_id (smallest vec_id reachable, itself included), kept (it is that one) per row.

    ``vectors`` has vec_id and embedding (array of numbers); other columns are
    not read. Repeated rows are vectors of their own and link with each other.
    Vectors of different widths are never compared. Vectors that link with
    nothing are their own component. An empty table gives no rows.
    """
    known, kind = stage(classes(vectors), "vectors"), component_kind(vectors)
    grouped = known.where("vector IS NOT NULL").groupBy("key").agg(
        F.count("*").alias("copies"), F.min("vec_id").alias("smallest"), F.first("width").alias("width"), F.first("vector").alias("vector")
    )
    points = stage(grouped, "points")
    found = None
    widths = [(r["width"], r["n"]) for r in points.groupBy("width").agg(F.count("*").alias("n")).orderBy("width").collect()]
    for width, n in widths:
        wanted = min(SAMPLE, SAMPLE_BYTES // (8 * width))
        share = F.pmod(F.xxhash64("key", F.lit(SEED)), F.lit(1 << 30)) < int((1 << 30) * min(1.0, wanted / n))
        some = points.where((F.col("width") == width) & share).select("key", "vector").orderBy("key")
        sample = _matrix([bytes(r["vector"]) for r in some.collect()], kind)
        if not len(sample):  # a hash may choose none of a few very wide vectors
            sample = np.zeros((1, width))
        forest = fit(sample, n, trees, LEAF)
        shared = vectors.sparkSession.sparkContext.broadcast(forest)
        for first in range(0, len(forest), TREES):
            some_trees = range(first, min(first + TREES, len(forest)))
            new = compare(dealt(leaf_rows(points, shared, some_trees, width, kind)), shared, least, kind)
            if len(forest) > TREES:  # the rows of a round go before the next begins
                new = stage(new, "vector-round")
            found = new if found is None else found.unionByName(new)
    alone = lambda rows: rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    if found is None:
        return alone(known).withColumn("kept", F.lit(True))
    found = stage(found, "vector-links")
    links = found.where("b IS NOT NULL").select("a", "b")
    degree = found.where("b IS NULL").groupBy("a").agg(F.sum("others").alias("others"))
    reached = connected_components(links)
    named = stage(
        points.select("key", "copies", "smallest").join(reached, F.col("key") == F.col("node"), "left")
        .withColumn("class", F.coalesce("component", "key")).join(degree, F.col("key") == F.col("a"), "left")
        .select("key", "smallest", "class", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links")), "vector-classes",
    )
    smallest = named.groupBy("class").agg(F.min("smallest").alias("component_id"))
    per_key = named.join(smallest, "class").select("key", "n_links", "component_id")
    linked = known.where("vector IS NOT NULL").join(per_key, "key").select("vec_id", "n_links", "component_id")
    return linked.unionByName(alone(known.where("vector IS NULL"))).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
