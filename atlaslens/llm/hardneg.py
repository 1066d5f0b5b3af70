"""Hard negatives by rotated one-bit codes whose intervals are certain.

Every vector is rotated and coded by the signs of its components; the inner
product of vector and code (their alignment) is stored beside the code. What the
code leaves over is rotated and coded again, ``LEVELS`` times, which shrinks it by
some 0.6 a level. An anchor is rotated alike and rounded to ``PLANES`` bit planes,
so popcounts of plane and code give its inner product with every code. Estimate
and truth differ by no more than, after Cauchy and Schwarz, the anchor's rounding
errors times the alignments, and the length of the last remainder times that of
the part of the anchor across the last code. A row whose whole interval lies
outside what can still matter is dropped; all others are scored in integers.
Nothing is chosen by an estimate, so the result is exact.

Anchors meet the rows in blocks: at most ``MOST_ANCHORS`` of them, and at most
``ANCHOR_BYTES`` of components, are broadcast; every task reads its rows once and
sends its best rows per anchor. The codes lie in a written table that all blocks
read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from atlaslens.llm.common import release, stage

SCALE = 256
LEVELS, PLANES = 4, 7
POSITIVES, NEGATIVES = 5, 10
LEAST, MOST = 30, 90  # a negative's score in percent of the positive's
ANCHOR_BYTES, MOST_ANCHORS = 24 << 20, 32_768  # of the anchors of one pass
FIRST_ROWS, ROWS, ANCHORS = 512, 4_096, 64  # a block of estimates; the first rows of a task set its bounds
PENDING = 1 << 20  # scored pairs that wait to be ranked
PAIRS_A_TASK, ROWS_A_TASK = 1 << 21, 1 << 16  # small tables are dealt by work, large ones by rows
PIECE = 256  # components that are rotated together
LONGEST = 2.0**31  # of a vector, so that scores fit 64 bits
NO_ID = (1 << 63) - 1  # stands for a null vec_id, which comes last among ties
SEED = 41


class Rotation:
    """An orthogonal map: components change places, then pieces of them are turned."""

    def __init__(self, width: int, level: int):
        random = np.random.default_rng([SEED, width, level])
        self.places = random.permutation(width)
        self.turns = [
            np.linalg.qr(random.normal(size=(min(PIECE, width - k),) * 2))[0] for k in range(0, width, PIECE)
        ]

    def __call__(self, vectors: np.ndarray) -> np.ndarray:
        moved, low = vectors[:, self.places], 0
        for turn in self.turns:
            moved[:, low : low + len(turn)] = moved[:, low : low + len(turn)] @ turn
            low += len(turn)
        return moved


def rotations(width: int) -> list[Rotation]:
    return [Rotation(width, level) for level in range(LEVELS)]


def pack(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as 64-bit words."""
    padded = np.pad(bits, ((0, 0), (0, -bits.shape[1] % 64)))
    return np.ascontiguousarray(np.packbits(padded, axis=1, bitorder="little")).view(np.uint64)


def length(vectors: np.ndarray) -> np.ndarray:
    return np.sqrt((vectors * vectors).sum(axis=1))


@dataclass
class Codes:
    """Codes of some vectors: packed signs (vector, level, word), alignments (vector, level), length of the last remainder and of the whole."""

    signs: np.ndarray
    align: np.ndarray
    rest: np.ndarray
    length: np.ndarray

    def __getitem__(self, rows) -> "Codes":
        return Codes(self.signs[rows], self.align[rows], self.rest[rows], self.length[rows])


def encode(vectors: np.ndarray, turns: list[Rotation]) -> Codes:
    rest = vectors.astype(np.float64)
    whole, signs, align = length(rest), [], []
    for turn in turns:
        rest = turn(rest)
        code = np.where(rest >= 0, 1.0, -1.0) / np.sqrt(max(rest.shape[1], 1))
        along = (rest * code).sum(axis=1)
        signs.append(pack(rest >= 0))
        align.append(along)
        rest = rest - along[:, None] * code
    return Codes(np.stack(signs, axis=1), np.stack(align, axis=1), length(rest), whole)


@dataclass
class Planes:
    """Anchors, rotated per level and rounded to whole steps: words (level, plane, anchor, word); the rest (level, anchor)."""

    words: np.ndarray
    low: np.ndarray
    step: np.ndarray
    error: np.ndarray
    length: np.ndarray
    width: int

    def __getitem__(self, some) -> "Planes":
        return Planes(self.words[:, :, some], self.low[:, some], self.step[:, some], self.error[:, some], self.length[some], self.width)


def planes(anchors: np.ndarray, turns: list[Rotation]) -> Planes:
    turned = anchors.astype(np.float64)
    whole, words, lows, steps, errors = length(turned), [], [], [], []
    for turn in turns:
        turned = turn(turned)
        low = turned.min(axis=1, initial=0.0)
        step = (turned.max(axis=1, initial=0.0) - low) / ((1 << PLANES) - 1)
        step[step == 0] = 1.0
        number = np.rint((turned - low[:, None]) / step[:, None]).astype(np.int64)
        words.append(np.stack([pack((number >> p & 1).astype(bool)) for p in range(PLANES)]))
        lows.append(low), steps.append(step)
        errors.append(length(turned - (low[:, None] + number * step[:, None])))
    return Planes(np.stack(words), np.stack(lows), np.stack(steps), np.stack(errors), whole, anchors.shape[1])


def intervals(q: Planes, codes: Codes) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the inner product of each anchor (rows of the result) with each coded vector (columns)."""
    root, shape = np.sqrt(max(q.width, 1)), (len(q.length), len(codes.length))
    middle, wide = np.zeros(shape), np.zeros(shape)
    along, error = np.zeros(shape), np.zeros((shape[0], 1))
    for level in range(LEVELS):
        signs = np.ascontiguousarray(codes.signs[:, level].T)
        ones = np.bitwise_count(signs).sum(axis=0, dtype=np.int64)
        met, total = np.zeros(shape, np.float32), np.zeros(shape[0])
        for p, plane in enumerate(q.words[level]):
            for word, sign in enumerate(signs):
                met += np.bitwise_count(plane[:, word, None] & sign) * np.float32(1 << p)
            total += np.bitwise_count(plane).sum(axis=1, dtype=np.int64) * float(1 << p)
        # <steps, code>: what meets a set sign counts once for and, with all, once against
        low, step = q.low[level][:, None], q.step[level][:, None]
        along = (step * (2.0 * met - total[:, None]) + low * (2.0 * ones - q.width)) / root
        align, error = codes.align[:, level], q.error[level][:, None]
        middle += align * along
        wide += align * error
    across = np.sqrt(np.maximum(0.0, q.length[:, None] ** 2 - np.maximum(0.0, np.abs(along) - error) ** 2))
    wide += codes.rest * across
    wide += 1e-6 * (1.0 + q.length[:, None] * codes.length)  # more than rounding adds to all this
    return middle - wide, middle + wide


def scores(anchors: np.ndarray, vectors: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of anchors[a] with vectors[b]."""
    out = np.empty(len(a), np.int64)
    for k in range(0, len(a), 1 << 15):
        part = slice(k, k + (1 << 15))
        out[part] = np.einsum("ij,ij->i", anchors[a[part]], vectors[b[part]])
    return out


class Best:
    """The first ``most`` rows of each group by score (highest first), id and row, of all that come in."""

    def __init__(self, groups: int, most: int):
        self.most, self.kept, self.waiting, self.count = most, np.empty((4, 0), np.int64), [], 0
        self.least = np.full(groups, -np.inf)  # what scores less cannot enter its group

    def add(self, group: np.ndarray, score: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        self.waiting.append(np.stack((group, score, ids, rows)))
        self.count += len(group)
        if self.count > PENDING:
            self.rank()

    def rank(self) -> np.ndarray:
        if self.count:
            every = np.concatenate([self.kept, *self.waiting], axis=1)
            every = every[:, np.lexsort((every[3], every[2], -every[1], every[0]))]
            group = every[0]
            first = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
            place = np.arange(len(group)) - np.repeat(first, np.diff(np.append(first, len(group))))
            last = place == self.most - 1
            self.least[group[last]] = every[1][last]
            self.kept, self.waiting, self.count = every[:, place < self.most], [], 0
        return self.kept


@dataclass
class Block:
    """The anchors of one pass, with their positives from the second scan on."""

    rows: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    planes: Planes
    low: np.ndarray | None = None  # per anchor and positive: the least and greatest score of a negative
    high: np.ndarray | None = None


def _signs(batch: pa.RecordBatch, words: int) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column("signs").to_pylist()), np.uint64).reshape(len(batch), LEVELS, words)


def _vectors(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<i4").reshape(len(column), width).astype(np.int64)


def code_table(vectors: DataFrame, parts: int) -> DataFrame:
    """row, vec_id, label, width, vector (integers), signs, align, rest, length of each row that takes part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns: dict[int, list[Rotation]] = {}
        for batch in batches:
            embeddings = [v.as_py() for v in batch.column("embedding")]
            widths = np.array([len(v) for v in embeddings], np.int64)
            for width in np.unique(widths).tolist():
                some = np.flatnonzero(widths == width)
                matrix = np.array([embeddings[i] for i in some], dtype=np.float64).reshape(len(some), width)  # nulls become nan
                with np.errstate(over="ignore", invalid="ignore"):
                    matrix = np.floor(SCALE * matrix)
                    good = np.isfinite(matrix).all(axis=1) & (length(matrix) < LONGEST)
                some, matrix = some[good], matrix[good]
                if len(some):
                    codes = encode(matrix, turns.setdefault(width, rotations(width)))
                    take = pa.array(some)
                    yield pa.RecordBatch.from_arrays([
                        batch.column("vec_id").take(take), batch.column("label").take(take), pa.array(widths[some], pa.int32()),
                        pa.array([v.tobytes() for v in matrix.astype("<i4")], pa.binary()), pa.array([s.tobytes() for s in codes.signs], pa.binary()),
                        pa.array([a.tobytes() for a in codes.align], pa.binary()), pa.array(codes.rest), pa.array(codes.length),
                    ], names=["vec_id", "label", "width", "vector", "signs", "align", "rest", "length"])

    known = vectors.where("label IS NOT NULL AND embedding IS NOT NULL").select(
        F.coalesce(F.col("vec_id").cast("long"), F.lit(NO_ID)).alias("vec_id"), F.col("label").cast("long").alias("label"), "embedding"
    )
    coded = known.repartition(parts).mapInArrow(
        run, "vec_id long, label long, width int, vector binary, signs binary, align binary, rest double, length double"
    )
    return coded.withColumn("row", F.monotonically_increasing_id())


def scan(codes: DataFrame, block: Block, groups: int, most: int, meet: Callable) -> DataFrame:
    """(slot, score, vec_id, row): the best rows per slot that each task finds; ``meet`` says which pairs to score and where they count."""
    shared = codes.sparkSession.sparkContext.broadcast(block)
    width = block.vectors.shape[1]
    words = block.planes.words.shape[-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, best, first = shared.value, Best(groups, most), True
        for batch in batches:
            low = 0
            while low < len(batch):
                part = batch.slice(low, FIRST_ROWS if first else ROWS)
                low, first = low + len(part), False
                align = np.frombuffer(b"".join(part.column("align").to_pylist())).reshape(len(part), LEVELS)
                coded = Codes(_signs(part, words), align, part.column("rest").to_numpy(), part.column("length").to_numpy())
                ids, rows, labels = (part.column(name).to_numpy() for name in ("vec_id", "row", "label"))
                vectors = _vectors(part.column("vector"), width)
                meet(block, best, coded, vectors, labels, ids, rows)
                best.rank()
        slot, score, ids, rows = best.rank()
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (slot, score, ids, rows)], names=["slot", "score", "vec_id", "row"])

    columns = ["vec_id", "label", "vector", "signs", "align", "rest", "length", "row"]
    return codes.where(F.col("width") == width).select(columns).mapInArrow(run, "slot long, score long, vec_id long, row long")


def meet_positives(block: Block, best: Best, coded: Codes, vectors, labels, ids, rows) -> None:
    """Other rows of the anchor's label whose interval reaches the scores that still count."""
    for label in np.intersect1d(block.labels, labels).tolist():
        mine, anchors = np.flatnonzero(labels == label), np.flatnonzero(block.labels == label)
        some = coded[mine]
        for k in range(0, len(anchors), ANCHORS):
            part = anchors[k : k + ANCHORS]
            _, high = intervals(block.planes[part], some)
            a, b = np.nonzero((high >= best.least[part][:, None]) & (block.rows[part][:, None] != rows[mine]))
            a, b = part[a], mine[b]
            best.add(a, scores(block.vectors, vectors, a, b), ids[b], rows[b])


def meet_negatives(block: Block, best: Best, coded: Codes, vectors, labels, ids, rows) -> None:
    """Rows of other labels whose interval meets the range of some positive and reaches the scores that still count there."""
    for k in range(0, len(block.rows), ANCHORS):
        part = slice(k, k + ANCHORS)
        low, high = intervals(block.planes[part], coded)
        needed = np.maximum(block.low[part], best.least.reshape(-1, POSITIVES)[part])
        needed = np.where(block.low[part] <= block.high[part], needed, np.inf).min(axis=1)
        near = (high >= needed[:, None]) & (low <= block.high[part].max(axis=1)[:, None]) & (block.labels[part][:, None] != labels)
        a, b = np.nonzero(near)
        a += k
        score = scores(block.vectors, vectors, a, b)
        for j in range(POSITIVES):
            inside = np.flatnonzero((score >= block.low[a, j]) & (score <= block.high[a, j]) & (score >= best.least[a * POSITIVES + j]))
            best.add(a[inside] * POSITIVES + j, score[inside], ids[b[inside]], rows[b[inside]])


def _first(found: DataFrame, most: int) -> DataFrame:
    """The best rows of each slot over all tasks, with their rank."""
    order = Window.partitionBy("slot").orderBy(F.desc("score"), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def mine(vectors: DataFrame) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``vectors`` has vec_id, embedding (array of numbers) and label; other
    columns are not read. Each component x counts as floor(256 * x), and a score
    is an integer inner product; higher ones come first, then the smaller
    vec_id. Anchors are the rows whose vec_id is divisible by 100. An anchor's
    positives are its first 5 other rows of the same label; for each of them,
    the first 10 rows of other labels that score 30 to 90 % of it are returned.

    Rows with a null label, a null vector or a null or non-finite component take
    no part, nor do those of a length of 2**31 or more after scaling, whose
    scores may not fit 64 bits. Vectors of different widths never meet. Repeated
    rows are rows of their own, also as anchors. A row without vec_id is no
    anchor, may be found, and comes last among ties. Zero and empty vectors
    score 0. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    known = vectors.where("label IS NOT NULL AND embedding IS NOT NULL")
    n, n_anchors = known.agg(F.count("*"), F.count_if(F.col("vec_id") % 100 == 0)).first()
    parts = max(1, min(-(-n * n_anchors // PAIRS_A_TASK), max(64, -(-n // ROWS_A_TASK))))
    codes = stage(code_table(vectors, parts), "codes")
    is_anchor = (F.col("vec_id") % 100 == 0) & (F.col("vec_id") != NO_ID)
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    results = []
    for width, count in sorted(tuple(r) for r in codes.where(is_anchor).groupBy("width").count().collect()):
        passes = -(-count // max(1, min(MOST_ANCHORS, ANCHOR_BYTES // (8 * max(width, 1)))))
        for number in range(passes):
            chosen = is_anchor & (F.col("width") == width) & (F.pmod(F.xxhash64("row"), F.lit(passes)) == number)
            own = codes.where(chosen).select("row", "vec_id", "label", "vector").toArrow().sort_by("row")
            if len(own):
                results.append(_pass(spark, codes, own, width))
    out = None
    for result in results:
        out = result if out is None else out.unionByName(result)
    release(codes)
    return spark.createDataFrame([], schema) if out is None else out


def _pass(spark, codes: DataFrame, own: pa.Table, width: int) -> DataFrame:
    """The result for one block of anchors."""
    matrix = _vectors(own["vector"], width)
    block = Block(own["row"].to_numpy(), own["label"].to_numpy(), matrix, planes(matrix, rotations(width)))
    found = _first(scan(codes, block, len(own), POSITIVES, meet_positives), POSITIVES)
    positives = found.select("slot", "rank", "vec_id", "score").toArrow()  # POSITIVES rows an anchor
    low, high = np.ones((len(own), POSITIVES)), np.zeros((len(own), POSITIVES))
    low, high = low.astype(np.int64), high.astype(np.int64)  # no range where a positive is missing
    listed = [(r["slot"] * POSITIVES + r["rank"] - 1, own["vec_id"][r["slot"]].as_py(), r["vec_id"], r["score"]) for r in positives.to_pylist()]
    for slot, _, _, score in listed:
        low[divmod(slot, POSITIVES)], high[divmod(slot, POSITIVES)] = -(-LEAST * score // 100), MOST * score // 100
    block.low, block.high = low, high
    ranked = _first(scan(codes, block, len(own) * POSITIVES, NEGATIVES, meet_negatives), NEGATIVES)
    names = spark.createDataFrame(pa.table({
        "slot": pa.array([r[0] for r in listed], pa.int64()), "anchor_id": pa.array([r[1] for r in listed], pa.int64()),
        "positive_id": pa.array([r[2] for r in listed], pa.int64()), "positive_score": pa.array([r[3] for r in listed], pa.int64()),
    }))
    known = lambda name: F.nullif(F.col(name), F.lit(NO_ID)).alias(name)
    return stage(
        ranked.withColumnRenamed("vec_id", "negative_id").withColumnRenamed("score", "negative_score").join(names, "slot").select(
            "anchor_id", known("positive_id"), F.col("rank").cast("int").alias("rank"), known("negative_id"), "positive_score", "negative_score"
        ), "negatives",
    )
