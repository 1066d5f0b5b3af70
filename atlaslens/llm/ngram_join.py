"""N-gram Jaccard join with a count-vector R-tree.

Every text becomes its set of five-word shingles. Shingles are hashed into
groups and a text's group counts are a point; no two texts can share more
shingles than the sum of the smaller counts of each group, so boxes of points
in an R-tree bound the overlap of all pairs below them. Surviving pairs are
verified on the whole sets.

An R-tree over a whole corpus would have to be in one place, so texts are
first dealt out, without losing a pair: two linked texts must share a shingle
among the first quarter of either set in any fixed order (prefix principle).
The order puts shingles that are common in the corpus last, so passages that
many documents share do not bring these together. Pairs that the tree or a
group's leader brings up are first bounded on a finer point, with a group for
every few shingles, so that few sets have to be sent anywhere. Equal sets are one text from
the start. In a group of near copies all are first compared with one of them;
only texts that this leaves unconnected meet in the tree. There no pair leaves
a task: what may link is told as smaller groups, each of which then gets its
sets once, and only links that join two components come back. That suffices
for components, and no group is expanded into all its pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from atlaslens.llm import texthash as T
from atlaslens.llm.common import WORD, columns_of, pick_rows, release, stage, text_blocks
from atlaslens.llm.components import connected_components

WORDS = 5
NEED, OF = 75, 100  # linked when OF * shared >= NEED * union
GROUPS = 256  # coordinates of points in the tree
PER_GROUP = 4  # shingles to a group of the finer points, up to FINEST groups
FINEST = 1 << 14
LEAF = 16
# A shingle counts as common from this many documents on. The list only sets an
# order, so its bound costs no links: the most common ones go last, others by hash.
COMMON_FROM = 12
COMMON_AT_MOST = 1 << 20
# Members of one tree. Larger groups are dealt into chunks, and every two chunks share a tree.
CHUNK = 2_048
CHUNK_BYTES = 1 << 25  # of the sets of one chunk, where a tree has whole sets
# Documents to look up again are broadcast up to so many (some 100 bytes each), and joined beyond.
BROADCAST_KEYS = 200_000
# How often the components of a group are compared by one member each before all members that are still apart meet.
ROUNDS = 2
# Sets that one task compares with a leader.
STAR = 4_096

_KEY_ODD = np.uint64(0x9E3779B97F4A7C15)


class SetBlock:
    """Shingle sets of some texts, one after another, with a 64-bit key for each whole set."""

    def __init__(self, data: np.ndarray, at: np.ndarray, words: int):
        self.values, self.at = T.shingle_sets(data, at, words)
        self.sizes = np.diff(self.at)
        self.full = np.flatnonzero(self.sizes)
        self.keys = np.zeros(len(self.sizes), dtype=np.int64)
        if len(self.full):
            starts = self.at[:-1][self.full]
            with np.errstate(over="ignore"):
                total = np.add.reduceat(T.mix(self.values), starts)
                other = np.bitwise_xor.reduceat(T.mix(self.values * _KEY_ODD), starts)
                self.keys[self.full] = T.mix(total * _KEY_ODD + other + self.sizes[self.full].astype(np.uint64)).view(np.int64)

    def set(self, k: int) -> np.ndarray:
        return self.values[self.at[k] : self.at[k + 1]]


def prefix_length(n: int) -> int:
    """How many of a set's first shingles must be looked at: any link shares at least NEED/OF of either set."""
    return n - -(-NEED * n // OF) + 1


def _blocks(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[tuple[pa.RecordBatch, SetBlock]]:
    """The second column holds the texts."""
    for batch in batches:
        for first, data, at in text_blocks(batch.column(1), 1 << 20):
            yield batch.slice(first, len(at) - 1), SetBlock(data, at, words)


def set_sizes(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """Two kinds of rows. kind 0: doc_id, mark, n (set size), key (of the set), and at the first of equal sets that a task
    comes upon its points, ``coarse`` and ``fine``. kind 1: a shingle (key) and in how many
    sets of some of a task's documents it occurs (n), where these are more than one."""
    names = ["doc_id", "mark", "n", "key", "kind", "coarse", "fine"]

    def shared(waiting: list[np.ndarray]) -> pa.RecordBatch:
        values = np.concatenate(waiting)
        values.sort()
        starts = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))
        times = np.diff(np.append(starts, len(values)))
        again = times > 1
        out = values[starts[again]].view(np.int64)
        return pa.RecordBatch.from_arrays(
            [*[pa.nulls(len(out), pa.int64())] * 2, pa.array(times[again]), pa.array(out), pa.array(np.ones(len(out), np.int32)),
             *[pa.nulls(len(out), pa.binary())] * 2], names=names
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[np.ndarray] = []
        held, seen = 0, set()
        for rows, block in _blocks(batches, words):
            coarse: list[bytes | None] = [None] * len(block.sizes)
            fine = coarse.copy()
            for k in block.full.tolist():
                if (key := int(block.keys[k])) not in seen:  # equal sets count once
                    seen.add(key)
                    own = block.set(k)
                    waiting.append(own)
                    held += len(own)
                    coarse[k], fine[k] = point(own, GROUPS), point(own, finest(len(own)))
            yield pa.RecordBatch.from_arrays([
                rows.column(0), rows.column(2), pa.array(block.sizes.astype(np.int64)), pa.array(block.keys, mask=block.sizes == 0),
                pa.array(np.zeros(len(block.sizes), np.int32)), pa.array(coarse, pa.binary()), pa.array(fine, pa.binary()),
            ], names=names)
            if held > 4_000_000:
                yield shared(waiting)
                waiting, held, seen = [], 0, set()
        if waiting:
            yield shared(waiting)

    return docs.select("doc_id", "text", text_mark().alias("mark")).mapInArrow(run, "doc_id long, mark long, n long, key long, kind int, coarse binary, fine binary")


def finest(n: int) -> int:
    """Groups of a set's finer point: a power of two, so that points of different sizes fold onto each other."""
    return min(FINEST, max(GROUPS, 1 << max(0, n // PER_GROUP - 1).bit_length()))


def point(shingles: np.ndarray, groups: int) -> bytes:
    """How many shingles fall into each group, in as few bytes as the largest count needs."""
    counts = np.bincount((shingles >> np.uint64(20)).astype(np.int64) & (groups - 1), minlength=groups)
    most = int(counts.max())
    return counts.astype("<u1" if most < 1 << 8 else "<u2" if most < 1 << 16 else "<u4").tobytes()


def counts_of(stored: bytes, groups: int) -> np.ndarray:
    return np.frombuffer(stored, f"<u{len(stored) // groups}").astype(np.int32)


def may_link(n: int, left: bytes, m: int, right: bytes) -> bool:
    """Whether sizes and summed smaller counts leave a link possible."""
    if OF * min(n, m) < NEED * max(n, m):
        return False
    x, y = counts_of(left, finest(n)), counts_of(right, finest(m))
    while len(x) > len(y):
        x = x[: len(x) // 2] + x[len(x) // 2 :]
    while len(y) > len(x):
        y = y[: len(y) // 2] + y[len(y) // 2 :]
    return (OF + NEED) * int(np.minimum(x, y).sum()) >= NEED * (n + m)


def bounded(pairs: DataFrame, points: DataFrame) -> DataFrame:
    """The pairs (a, b: keys) that their points leave possible."""
    one = points.select(F.col("key").alias("a"), F.col("n").alias("n"), F.col("fine").alias("left"))
    other = points.select(F.col("key").alias("b"), F.col("n").alias("m"), F.col("fine").alias("right"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("n", "left", "m", "right")))
            good = pa.array([may_link(*row) for row in rows], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(good)

    joined = pairs.join(one, "a").join(other, "b").select("a", "b", "n", "left", "m", "right")
    return joined.mapInArrow(run, "a long, b long").distinct()


def text_mark() -> Column:
    """Tells rows of one doc_id with different texts apart."""
    return F.xxhash64("text")


class CommonLast:
    """The order of shingles: by value, but the common ones last, the most common at the very end."""

    def __init__(self, common: np.ndarray):  # rarest first
        order = np.argsort(common)
        self.values, self.ranks = common[order], order
        self.hint = np.zeros(1 << 22, dtype=bool)
        self.hint[self.values >> np.uint64(42)] = True

    def places(self, values: np.ndarray) -> np.ndarray:
        """Place among the common shingles, -1 for others."""
        out = np.full(len(values), -1, dtype=np.int64)
        maybe = np.flatnonzero(self.hint[values >> np.uint64(42)])
        if len(maybe):
            some = values[maybe]
            at = np.minimum(np.searchsorted(self.values, some), len(self.values) - 1)
            out[maybe] = np.where(self.values[at] == some, self.ranks[at], -1)
        return out


def prefixes(docs: DataFrame, common: np.ndarray, words: int = WORDS) -> DataFrame:
    """(shingle, key): the first shingles of every set, once per set and task."""
    shared = docs.sparkSession.sparkContext.broadcast(common)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order, seen = CommonLast(shared.value), set()
        for _, block in _blocks(batches, words):
            places = order.places(block.values)
            any_common = np.concatenate(([0], np.cumsum(places >= 0)))[block.at]
            out: list[np.ndarray] = []
            keys: list[int] = []
            for k in block.full.tolist():
                if (key := int(block.keys[k])) in seen:
                    continue
                seen.add(key)
                low, high = block.at[k], block.at[k + 1]
                own, want = block.values[low:high], prefix_length(int(high - low))
                if any_common[k + 1] > any_common[k]:
                    place = places[low:high]
                    first = own[place < 0][:want]
                    if len(first) < want:
                        late = np.flatnonzero(place >= 0)
                        first = np.concatenate((first, own[late[np.argsort(place[late])]][: want - len(first)]))
                else:
                    first = own[:want]
                out.append(first)
                keys.append(key)
            if out:
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate(out).view(np.int64)), pa.array(np.repeat(np.array(keys, np.int64), [len(x) for x in out])),
                ], names=["shingle", "key"])

    return docs.select("doc_id", "text").mapInArrow(run, "shingle long, key long")


def with_leaders(postings: DataFrame) -> DataFrame:
    """(shingle, key, leader) of all shingles that several sets have; the leader is the smallest of these.

    One pass over rows in order; nothing is held but the last row, so a shingle
    may have any number of sets.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # (shingle, key, leader, whether it has company) of the row that waits for its successor
        for batch in batches:
            s, k = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            if not len(s):
                continue
            if last:
                s, k = np.concatenate(([last[0]], s)), np.concatenate(([last[1]], k))
            new = np.concatenate(([True], s[1:] != s[:-1]))
            starts = np.flatnonzero(new)
            leader = k[starts][np.cumsum(new) - 1]
            company = ~new
            company[:-1] |= ~new[1:]
            if last:
                leader[: starts[1] if len(starts) > 1 else len(s)] = last[2]
                company[0] |= last[3]
            last = (s[-1], k[-1], leader[-1], bool(company[-1] and not new[-1]) or (len(s) == 1 and bool(company[-1])))
            keep = company[:-1]
            yield pa.RecordBatch.from_arrays([pa.array(x[:-1][keep]) for x in (s, k, leader)], names=["shingle", "key", "leader"])
        if last and last[3]:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in last[:3]], names=["shingle", "key", "leader"])

    dealt = postings.repartition("shingle").sortWithinPartitions("shingle", "key")
    return dealt.mapInArrow(run, "shingle long, key long, leader long")


def _sets_of(docs: DataFrame, wanted: DataFrame, columns: list[str], kinds: str, words: int) -> DataFrame:
    """Texts of the wanted documents as (key, n, shingles, then the other columns of ``wanted``).

    ``wanted`` has doc_id. A set comes once per task and other columns, even if
    its document is repeated.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for rows, block in _blocks(batches, words):
            others = [rows.column(c).to_pylist() for c in columns]
            fresh = []
            for k in block.full.tolist():
                mark = (int(block.keys[k]), *(str(o[k]) for o in others))
                if mark not in seen:
                    seen.add(mark)
                    fresh.append(k)
            yield pa.RecordBatch.from_arrays([
                pa.array(block.keys[fresh]), pa.array(block.sizes[fresh].astype(np.int32)),
                pa.array([block.set(k).tobytes() for k in fresh], pa.binary()), *(rows.column(c).take(pa.array(fresh, pa.int64())) for c in columns),
            ], names=["key", "n", "shingles", *columns])

    some = F.broadcast(wanted) if wanted.count() <= BROADCAST_KEYS else wanted
    joined = docs.select("doc_id", "text").join(some, "doc_id").select("doc_id", "text", *columns)
    return joined.mapInArrow(run, "key long, n int, shingles binary" + kinds)


def verify_stars(docs: DataFrame, stars: DataFrame, stand: DataFrame, words: int = WORDS) -> DataFrame:
    """Which of (leader, key) link, as (a, b). Large stars are dealt over several tasks, each with a copy of the leader."""
    salts = F.ceil(F.count("*") / STAR).cast("int")
    sizes = stars.groupBy("leader").agg(salts.alias("salts"))
    leaders = sizes.select("leader", F.col("leader").alias("key"), F.sequence(F.lit(0), F.col("salts") - 1).alias("at"))
    others = stars.join(sizes, "leader").select("leader", "key", F.array(F.pmod(F.xxhash64("key"), F.col("salts")).cast("int")).alias("at"))
    roles = leaders.unionByName(others).groupBy("key").agg(F.collect_list(F.struct("leader", "at")).alias("roles"))
    wanted = stage(stand.join(roles, "key").select("doc_id", F.col("key").alias("own"), "roles"), "star-roles")
    sets = _sets_of(docs, wanted, ["own", "roles"], ", own long, roles array<struct<leader:long,at:array<int>>>", words)
    dealt = (
        sets.where("key = own").withColumn("role", F.explode("roles")).withColumn("salt", F.explode("role.at"))
        .select(F.col("role.leader").alias("leader"), "salt", "key", "shingles")
        .repartition("leader", "salt").sortWithinPartitions("leader", "salt", F.col("key") != F.col("leader"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leader, first = None, np.empty(0, np.uint64)
        for batch in batches:
            a, b = [], []
            for of, key, shingles in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3)):
                own = np.frombuffer(shingles.as_buffer(), np.uint64)
                if of == key:
                    leader, first = of, own.copy()
                elif of == leader and linked(first, own):
                    a.append(of)
                    b.append(key)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return dealt.mapInArrow(run, "a long, b long")


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """The exact rule on two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    if OF * len(a) < NEED * len(b):
        return False
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    both = int(np.count_nonzero(b[at] == a))
    return OF * both >= NEED * (len(a) + len(b) - both)


class Tree:
    """R-tree over count vectors, bulk-loaded by halving along the widest coordinate."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        self.points, self.sizes = points, sizes
        self.nodes: list[tuple] = []  # (largest counts, smallest size, largest size, children or None, rows or None)
        self.root = self._load(np.arange(len(points)))

    def _load(self, rows: np.ndarray) -> int:
        points, sizes = self.points[rows], self.sizes[rows]
        box = (points.max(0), int(sizes.min()), int(sizes.max()))
        if len(rows) <= LEAF:
            self.nodes.append((*box, None, rows))
        else:
            with_size = np.column_stack((sizes, points))
            axis = int(np.argmax(np.ptp(with_size, axis=0)))
            order = np.argsort(with_size[:, axis], kind="stable")
            half = len(rows) // 2
            children = (self._load(rows[order[:half]]), self._load(rows[order[half:]]))
            self.nodes.append((*box, children, None))
        return len(self.nodes) - 1

    def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of rows whose bound on the overlap does not rule them out."""
        stack = [(self.root, self.root)]
        while stack:
            i, j = stack.pop()
            high_i, low_n, most_n, children_i, rows_i = self.nodes[i]
            high_j, low_m, most_m, children_j, rows_j = self.nodes[j]
            if OF * most_n < NEED * low_m or OF * most_m < NEED * low_n:
                continue
            if (OF + NEED) * int(np.minimum(high_i, high_j).sum()) < NEED * (low_n + low_m):
                continue
            if children_i is None and children_j is None:
                shared = np.minimum(self.points[rows_i][:, None], self.points[rows_j][None]).sum(2)
                n, m = self.sizes[rows_i][:, None], self.sizes[rows_j][None]
                keep = ((OF + NEED) * shared >= NEED * (n + m)) & (OF * np.minimum(n, m) >= NEED * np.maximum(n, m))
                if i == j:
                    keep = np.triu(keep, 1)
                x, y = np.nonzero(keep)
                yield rows_i[x], rows_j[y]
            elif i == j:
                a, b = children_i
                stack += [(a, a), (a, b), (b, b)]
            elif children_j is None or (children_i is not None and len(self.nodes) and most_n - low_n >= most_m - low_m):
                stack += [(c, j) for c in children_i]
            else:
                stack += [(i, c) for c in children_j]


def _runs(batches: Iterator[pa.RecordBatch], by: tuple[str, ...]) -> Iterator[list[pa.Table]]:
    """The runs of rows that are alike in ``by``, as many as each batch completes. One at a time is held."""
    held = None
    for batch in chain(batches, (None,)):
        whole = held if batch is None else pa.Table.from_batches([*(held.to_batches() if held else []), batch])
        if whole is None or not len(whole):
            continue
        new = np.ones(len(whole), dtype=bool)
        new[1:] = np.any([np.diff(whole.column(c).to_numpy()) != 0 for c in by], axis=0)
        starts = np.append(np.flatnonzero(new), len(whole)).tolist()
        done = len(starts) - (1 if batch is None else 2)
        yield [whole.slice(i, j - i) for i, j in zip(starts[:done], starts[1:])]
        held = whole.slice(starts[-2]).combine_chunks()


class Joined:
    """Which rows of a group have been joined, as a forest."""

    def __init__(self, parent: list[int]):
        self.parent = parent

    def root(self, i: int) -> int:
        parent = self.parent
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    def join_where(self, x: np.ndarray, y: np.ndarray, alike: Callable[[int, int], bool]) -> Iterator[tuple[int, int]]:
        """Joins the pairs that are ``alike`` and gives them; those that are joined by then are not looked at."""
        for i, j in zip(x.tolist(), y.tolist()):
            a, b = self.root(i), self.root(j)
            if a != b and alike(i, j):
                self.parent[max(a, b)] = min(a, b)
                yield i, j


def _across(slot: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Two chunks in one tree: pairs within one of them belong to that chunk's own tree."""
    return (slot[x] != slot[y]) | (slot[x] < 0)


def near_groups(members: DataFrame) -> DataFrame:
    """(x, y, first, key, n, label): members that may link with members of other labels, in groups named by two hashes of their
    keys; first is the group's smallest key.

    ``members`` has shingle, chunk, slot, key, n, label, coarse and fine. What
    a tree brings up is bounded on the finer points in the same task, and
    whatever is left of these pairs, one by one or in a chain, is one group.
    So a tree tells each of its members at most once, not its pairs, and all
    pairs that may link are within some group. Groups of the same members have
    the same name and come once. A task reads its trees in order and holds one
    at a time: at most two chunks.
    """
    names, by = ["x", "y", "first", "key", "n", "label"], ("shingle", "chunk")

    def near(tree: pa.Table) -> Iterator[np.ndarray]:
        labels, slot, n = (tree.column(c).to_numpy() for c in ("label", "slot", "n"))
        if (labels == labels[0]).all():
            return
        points = np.stack([counts_of(p, GROUPS) for p in tree.column("coarse").to_pylist()])
        sizes, fine = n.tolist(), tree.column("fine").to_pylist()
        joined, some = Joined(list(range(len(tree)))), set()
        for x, y in Tree(points, n).pairs():
            keep = (labels[x] != labels[y]) & _across(slot, x, y)
            for pair in joined.join_where(x[keep], y[keep], lambda i, j: may_link(sizes[i], fine[i], sizes[j], fine[j])):
                some.update(pair)
        rows = np.array(sorted(some), dtype=np.int64)
        roots = np.array([joined.root(i) for i in rows.tolist()], dtype=np.int64)
        for root in np.unique(roots).tolist():
            yield rows[roots == root]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for trees in _runs(batches, by):
            out: list[np.ndarray] = []
            for tree in trees:
                keys, n, labels = (tree.column(c).to_numpy() for c in names[3:])
                for rows in near(tree):
                    own = keys[rows].view(np.uint64)
                    with np.errstate(over="ignore"):
                        name = np.array([np.bitwise_xor.reduce(T.mix(own)), T.mix(own * _KEY_ODD).sum(dtype=np.uint64)]).view(np.int64)
                    if (mark := name.tobytes()) not in seen:
                        seen.add(mark)
                        name = np.append(name, keys[rows].min())
                        out.append(np.column_stack((np.tile(name, (len(rows), 1)), keys[rows], n[rows], labels[rows])))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c.copy()) for c in np.concatenate(out).T], names=names)

    dealt = members.select(*by, "slot", "key", "n", "label", "coarse", "fine").repartition(*by).sortWithinPartitions(*by)
    return dealt.mapInArrow(run, "x long, y long, first long, key long, n long, label long").distinct()


def put_together(groups: DataFrame) -> DataFrame:
    """(x, y, key, n, label): groups of ``near_groups`` that overlap are one, so that each set has to be sent once.

    Where that would be more than CHUNK members, they stay the groups they are.
    """
    reached = stage(connected_components(groups.select(F.col("first").alias("a"), F.col("key").alias("b"))), "near-components")
    small = reached.groupBy("component").agg(F.count("*").alias("members")).where(F.col("members") <= CHUNK).select("component")
    both = groups.join(reached.join(small, "component").select(F.col("node").alias("key"), "component"), "key", "left")
    return both.select(
        F.coalesce("component", "x").alias("x"), F.when(F.col("component").isNull(), F.col("y")).otherwise(0).alias("y"), "key", "n", "label"
    ).distinct()


def group_links(groups: DataFrame, sets: DataFrame) -> DataFrame:
    """The links (a, b: keys) that join the components of every group (x, y, key, n, label), by the exact rule.

    A pair whose labels are joined by then is not compared, so a tree gives
    fewer links than it has members. A task holds the sets of one tree at a time.
    """
    by = ("x", "y", "chunk")

    def links(tree: pa.Table) -> Iterator[tuple[int, int]]:
        keys, first = np.unique(tree.column("key").to_numpy(), return_index=True)
        slot = tree.column("slot").to_numpy()[first]
        _, one, of = np.unique(tree.column("label").to_numpy()[first], return_index=True, return_inverse=True)
        if len(one) == 1:
            return
        column = tree.column("shingles")
        own = [np.frombuffer(column[i].as_buffer(), np.uint64) for i in first.tolist()]
        points = np.stack([counts_of(point(s, GROUPS), GROUPS) for s in own])
        sizes = [len(s) for s in own]
        fine = [point(s, finest(len(s))) for s in own]
        joined = Joined(one[of].tolist())

        def alike(i: int, j: int) -> bool:
            return may_link(sizes[i], fine[i], sizes[j], fine[j]) and linked(own[i], own[j])

        for x, y in Tree(points, np.array(sizes)).pairs():
            keep = _across(slot, x, y)
            for pair in joined.join_where(x[keep], y[keep], alike):
                yield tuple(sorted(int(keys[i]) for i in pair))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for trees in _runs(batches, by):
            if found := [pair for tree in trees for pair in links(tree)]:
                a, b = zip(*found)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    trees = chunked(groups, ["x", "y"], F.greatest(F.count("*") / CHUNK, F.sum("n") * 8 / CHUNK_BYTES))
    dealt = trees.join(sets, "key").select(*by, "slot", "key", "label", "shingles").repartition(*by).sortWithinPartitions(*by)
    return dealt.mapInArrow(run, "a long, b long").distinct()


def one_of_each(groups: DataFrame) -> DataFrame:
    """Of groups (shingle, key, label) with the same members only the one with the smallest shingle."""
    alike = [F.bit_xor(F.xxhash64("key")).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), "key")).alias("y"), F.count("*").alias("n")]
    chosen = groups.groupBy("shingle").agg(*alike).groupBy("x", "y", "n").agg(F.min("shingle").alias("shingle")).select("shingle")
    return groups.join(chosen, "shingle", "left_semi")


def verified(docs: DataFrame, pairs: DataFrame, points: DataFrame, stand: DataFrame, words: int) -> DataFrame:
    """The pairs (a, b) that link: first by their points, then by their sets."""
    near = stage(bounded(pairs, points), "near")
    found = verify_stars(docs, near.select(F.col("a").alias("leader"), F.col("b").alias("key")), stand, words)
    return stage(found.distinct(), "verified")


def open_groups(groups: DataFrame, labels: DataFrame) -> DataFrame:
    """(shingle, key, label, members) of the groups whose members are not all in one component."""
    named = labels.select(F.col("node").alias("key"), F.col("component").alias("label"))
    tagged = groups.select("shingle", "key").join(named, "key", "left").withColumn("label", F.coalesce("label", "key"))
    mixed = tagged.groupBy("shingle").agg(F.min("label").alias("x"), F.max("label").alias("y"), F.count("*").alias("members"))
    return stage(tagged.join(mixed.where("x <> y").select("shingle", "members"), "shingle"), "open-groups")


def representatives(groups: DataFrame, number: int) -> DataFrame:
    """Pairs (a, b): one member of the largest component of a group with one of each other component.

    Groups of two are left to the tree, which looks at their only pair anyway.
    """
    drawn = F.min(F.struct(F.xxhash64("key", F.lit(number)).alias("h"), "key"))["key"]
    each = groups.where("members > 2").groupBy("shingle", "label").agg(F.count("*").alias("size"), drawn.alias("b"))
    first = each.groupBy("shingle").agg(F.max(F.struct("size", "label", F.col("b").alias("a"))).alias("f")).select("shingle", F.col("f.label").alias("main"), "f.a")
    return each.join(first, "shingle").where("label <> main").select("a", "b").distinct()


def chunked(members: DataFrame, by: list[str], size: Column) -> DataFrame:
    """Deals groups into as many chunks as ``size`` (an aggregate) says, and gives every two chunks of a group a tree of their own.

    Adds chunk (which tree) and slot (which side; -1 in a chunk's own tree).
    """
    sizes = members.groupBy(*by).agg(F.ceil(size).cast("int").alias("chunks"))
    own = F.pmod(F.xxhash64("key"), F.col("chunks")).cast("int")
    each = F.transform(F.sequence(F.lit(0), F.col("chunks") - 1), lambda o: F.when(
        o == F.col("own"), F.struct((o * F.col("chunks") + o).cast("long").alias("chunk"), F.lit(-1).alias("slot"))
    ).otherwise(F.struct((F.least(o, F.col("own")) * F.col("chunks") + F.greatest(o, F.col("own"))).cast("long").alias("chunk"), F.col("own").alias("slot"))))
    return members.join(sizes, by).withColumn("own", own).withColumn("at", F.explode(each)).select(*members.columns, "at.chunk", "at.slot")


def jaccard_components(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id, n_shingles and component_id (smallest doc_id reachable by links, itself included) per document.

    ``docs`` has doc_id and text; other columns are not read. Null, empty and
    wordless texts have no shingles and no links; a text of fewer words than
    ``words`` is one shingle. Repeated rows give repeated rows. A null doc_id
    joins the component of its text but never names one. A ``mark`` of the text follows.
    """
    found = stage(set_sizes(docs, words), "set-sizes")
    sized = found.where("kind = 0").select("doc_id", "mark", "n", "key")
    usual = found.where("kind = 1").groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") >= COMMON_FROM)
    common = usual.orderBy(F.desc("n"), "key").limit(COMMON_AT_MOST).select("key").toPandas()["key"].to_numpy(np.int64)

    first = stage(prefixes(docs, common[::-1].astype(np.int64).view(np.uint64), words), "prefixes")
    members = stage(with_leaders(first), "members")
    release(first)

    # One document stands for each set. Each set is compared with the smallest leader of its groups; then, group by
    # group, the components that are left are compared with the largest by one member each, a few times over.
    stand = stage(sized.where("key IS NOT NULL AND doc_id IS NOT NULL").groupBy("key").agg(F.min("doc_id").alias("doc_id")), "stand-ins")
    points = found.where("fine IS NOT NULL").select("key", "n", "coarse", "fine")
    stars = members.groupBy("key").agg(F.min("leader").alias("leader")).where("leader <> key")
    links = verified(docs, stars.select(F.col("leader").alias("a"), F.col("key").alias("b")), points, stand, words)
    labels = stage(connected_components(links), "labels")
    groups = open_groups(members, labels)
    for number in range(ROUNDS):
        pairs = stage(representatives(groups, number), "representatives")
        if pairs.isEmpty():
            break
        links = stage(links.unionByName(verified(docs, pairs, points, stand, words)), "links")
        labels = stage(connected_components(links), "labels")
        groups = open_groups(groups, labels)

    some = points.dropDuplicates(["key"])
    trees = chunked(one_of_each(groups).join(some, "key"), ["shingle"], F.count("*") / CHUNK)
    apart = stage(near_groups(trees), "near-groups")
    near = stage(put_together(apart), "near")
    release(apart)
    wanted = stand.join(near.select("key").distinct(), "key", "left_semi").select("doc_id")
    sets = stage(_sets_of(docs, wanted, [], "", words).select("key", "shingles"), "tree-sets")
    more = stage(group_links(near, sets), "tree-links")

    reached = connected_components(links.unionByName(more))
    release(members, groups, sets, near, links, labels, more)
    classes = stage(
        sized.where("key IS NOT NULL").groupBy("key").agg(F.min("doc_id").alias("doc_id"))
        .join(reached, F.col("key") == F.col("node"), "left").withColumn("class", F.coalesce("component", "key")).select("key", "doc_id", "class"), "classes"
    )
    names = classes.groupBy("class").agg(F.min("doc_id").alias("component_id"))
    named = classes.join(names, "class").select("key", "component_id")
    without = sized.where("key IS NULL").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), "mark")
    return sized.join(named, "key").select("doc_id", F.col("n").alias("n_shingles"), "component_id", "mark").unionByName(without)


def keep_one(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """One document of each component, the one with the smallest doc_id; all columns as they are.

    Texts without words are linked with nothing and all stay. Of repeated rows
    one stays; rows of one doc_id with different texts are told apart. Texts
    of which no row has a doc_id stay.
    """
    found = jaccard_components(docs, words).where("n_shingles > 0")
    rows = found.groupBy("component_id", "doc_id", "mark").agg(F.count("*").alias("copies"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark", "copies")).alias("f")
    named = rows.where("component_id IS NOT NULL").groupBy("component_id").agg(first).select("f.*")
    picked = named.unionByName(rows.where("component_id IS NULL").select(F.lit(True).alias("none"), "doc_id", "mark", "copies"))
    picked = stage(picked.select("doc_id", "mark", "copies"), "kept")
    no_words = docs.where(F.coalesce(~F.col("text").rlike(WORD), F.lit(True)))
    found = pick_rows(docs.where(F.col("text").rlike(WORD)), picked, text_mark())
    return found.select(*(column.alias(name) for name, column in columns_of(docs, "row.").items())).unionByName(no_words)
