"""Best-fit packing of token sequences by bin completion.

Documents are tokenized where they lie. Only the count of pieces per length
comes to the driver: at most ``capacity`` numbers, whatever the corpus. There a
branch-and-bound search over undominated fillings writes a plan in terms of
lengths, and every piece finds its own place in the plan from its rank among
the pieces of its length.
"""

from __future__ import annotations

import json
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from atlaslens.llm.common import stage

CAPACITY = 1024
END_ID = 2
# Effort of the search. Every piece is packed whatever they are; more effort may save sequences.
NODES = 1_200
BRANCHES = 3
FILLINGS = 400
# Pieces of one length are ranked in buckets of about this many rows.
RANK_ROWS = 200_000

# Fixed value: how byte-level vocabularies of this family split a text before the merges.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, salt int"
PIECES_WITH_IDS = PIECES + ", ids array<int>"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """Ids of a tokenizer file. The merges run in tiktoken, which is faster and gives the same ids."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in set(printable)]
        byte_of = {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(rest)}
        self.special = {t["content"]: t["id"] for t in parts["added_tokens"] if t["special"]}
        ranks = {
            bytes(byte_of[c] for c in token): rank
            for token, rank in parts["model"]["vocab"].items() if token not in self.special
        }
        self.fast = tiktoken.Encoding("corpus", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens=self.special)

    def ids(self, text: str) -> list[int]:
        try:
            return self.fast.encode(text, allowed_special="all")
        except Exception:  # the pattern engine gives up on some very long runs; the tokenizer itself does not
            return self.whole.encode(text, add_special_tokens=False).ids


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def cuts(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids: whole capacities, the first piece takes the rest."""
    first = n % capacity or capacity
    starts = [0, *range(first, n, capacity)]
    return [(s, (first if s == 0 else capacity)) for s in starts]


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """One row per piece: where it lies in its document's ids, and a checksum of its ids.

    A null or empty text is the end id alone. With ``with_ids`` the ids come along.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, row = encoder(tokenizer), 0
        for batch in batches:
            columns: dict[str, list] = {k: [] for k in ("doc_id", "piece", "start", "length", "ids_crc32", "salt", "ids")}
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.array([*enc.ids(text.as_py() or ""), end_id], dtype="<u4")
                for k, (start, length) in enumerate(cuts(len(ids), capacity)):
                    part = ids[start : start + length]
                    columns["doc_id"].append(doc_id)
                    columns["piece"].append(k)
                    columns["start"].append(start)
                    columns["length"].append(length)
                    columns["ids_crc32"].append(zlib.crc32(part.tobytes()))
                    columns["salt"].append(row & 0xFFFF)
                    if with_ids:
                        columns["ids"].append(part.astype(np.int32))
                    row += 1
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int32())]
            kept = list(zip(columns, kinds))[: None if with_ids else -1]
            yield pa.RecordBatch.from_arrays([pa.array(columns[c], type=k) for c, k in kept], names=[c for c, _ in kept])

    return docs.select("doc_id", "text").mapInArrow(run, PIECES_WITH_IDS if with_ids else PIECES)


# The plan. A histogram maps a length to how many pieces have it; a plan is a list of (filling, how many sequences).


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing on the histogram: the first incumbent."""
    gaps: dict[int, Counter] = {}  # space left -> filling -> how many sequences
    for length in sorted(counts, reverse=True):
        todo = counts[length]
        while todo:
            space = min((g for g in gaps if g >= length), default=None)
            if space is None:
                each = capacity // length
                whole, rest = divmod(todo, each)
                for fill, number in (((length,) * each, whole), ((length,) * rest, 1 if rest else 0)):
                    if number:
                        gaps.setdefault(capacity - sum(fill), Counter())[fill] += number
                break
            fill, number = next(iter(gaps[space].items()))
            take = min(number, todo)
            gaps[space][fill] -= take
            if not gaps[space][fill]:
                del gaps[space][fill]
                if not gaps[space]:
                    del gaps[space]
            gaps.setdefault(space - length, Counter())[(*fill, length)] += take
            todo -= take
    return [(fill, number) for fills in gaps.values() for fill, number in fills.items()]


def fillings(counts: dict[int, int], order: list[int], space: int, wanted: int) -> list[tuple[int, ...]]:
    """Undominated ways to fill a space, least waste first.

    A filling is dominated when some of its pieces could give way to one piece
    that is at least as long together and still fits: the single piece is the
    harder one to place later. Larger pieces are tried first.
    """
    found: list[tuple[int, tuple[int, ...]]] = []
    steps = 0
    smallest = order[-1] if order else space + 1

    def dominated(fill: tuple[int, ...], waste: int) -> bool:
        sums = {0}
        for k, length in enumerate(fill):
            sums |= {s + length for s in sums}
        singles = set(fill)
        return any(
            counts.get(s + w, 0) and s + w not in singles
            for s in sums - singles - {0} for w in range(min(waste, 8) + 1)
        )

    def grow(at: int, left: int, fill: tuple[int, ...]) -> bool:
        nonlocal steps
        steps += 1
        if left < smallest or at == len(order):
            if not dominated(fill, left):
                found.append((left, fill))
            return steps < FILLINGS
        fits = False
        for k in range(at, len(order)):
            length = order[k]
            if length > left or counts[length] <= fill.count(length):
                continue
            fits = True
            if not grow(k, left - length, (*fill, length)):
                return False
            if sum(w == 0 for w, _ in found) >= wanted:
                return False
        if not fits and not dominated(fill, left):
            found.append((left, fill))
        return steps < FILLINGS

    grow(0, space, ())
    found.sort(key=lambda x: (x[0], len(x[1]), [-v for v in x[1]]))
    out = [fill for _, fill in found[:wanted]]
    return out or [()]


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Fillings and how often each is used, in as few sequences as the search finds.

    Depth first around the longest piece left; a branch ends when its waste
    shows that it cannot beat the incumbent. It ends at the lower bound or
    after ``NODES`` steps, with the best plan so far.
    """
    counts = {length: number for length, number in counts.items() if number}
    if not counts:
        return []
    total = sum(length * number for length, number in counts.items())
    # Two lower bounds: all tokens together, and the pieces of which no two fit into one sequence.
    bound = max(-(-total // capacity), sum(n for length, n in counts.items() if 2 * length > capacity))
    best = best_fit(counts, capacity)
    sequences = sum(n for _, n in best)
    # A node: (what was left, the filling that it takes next and how often, waste so far, plan so far as a linked list).
    # Siblings share the array of what was left, so the stack stays small.
    start = np.zeros(max(counts) + 1, dtype=np.int64)
    start[list(counts)] = list(counts.values())
    stack: list[tuple[np.ndarray, tuple[int, ...], int, int, tuple | None]] = [(start, (), 0, 0, None)]
    nodes = 0
    while stack and sequences > bound and nodes < NODES:
        before, taken, times, waste, path = stack.pop()
        nodes += 1
        allowed = (sequences - 1) * capacity - total
        if waste > allowed:
            continue
        after = before.copy()
        for length in taken:
            after[length] -= times
        lengths = np.flatnonzero(after)
        if not len(lengths):
            fills = []
            while path:
                fills.append(path[0])
                path = path[1]
            best, sequences = fills[::-1], sum(n for _, n in fills)
            continue
        left = dict(zip(lengths.tolist(), after[lengths].tolist()))
        longest = int(lengths[-1])
        rest = dict(left)
        rest[longest] -= 1
        order = [v for v in sorted(rest, reverse=True) if rest[v] and v <= capacity - longest]
        branches = []
        for filling in fillings(rest, order, capacity - longest, BRANCHES):
            fill = (longest, *filling)
            needs = Counter(fill)
            times = min(left[v] // k for v, k in needs.items())
            branches.append((after, fill, times, waste + times * (capacity - sum(fill)), ((fill, times), path)))
        stack.extend(reversed(branches))
    return best


def slots(chosen: list[tuple[tuple[int, ...], int]], lengths: int) -> dict[str, np.ndarray]:
    """The plan by length: piece number r of a length, first[i] <= r, goes to sequence[i] + r - first[i] at offset[i]."""
    taken: Counter = Counter()
    rows, sequence = [], 0
    for fill, times in chosen:
        at = 0
        for length in fill:
            rows.append((length, taken[length], sequence, at))
            taken[length] += times
            at += length
        sequence += times
    table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 4)
    return {
        "first": table[:, 1], "sequence": table[:, 2], "offset": table[:, 3],
        "range": np.searchsorted(table[:, 0], np.arange(lengths + 2)),
    }


def pack(parts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to pieces (as ``pieces`` returns them, written to a table).

    Repeated rows are pieces of their own. An empty table gives an empty table.
    """
    sizes = {r["length"]: r["n"] for r in parts.groupBy("length").agg(F.count("*").alias("n")).collect()}
    where = slots(plan(sizes, capacity), capacity)
    buckets = max(1, -(-sum(sizes.values()) // RANK_ROWS))
    dealt = parts.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece") + F.col("salt"), F.lit(buckets)))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        dealt.groupBy("length", "bucket").agg(F.count("*").alias("n"))
        .withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    )
    within = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = (
        dealt.withColumn("within", F.row_number().over(within) - 1).join(offsets, ["length", "bucket"])
        .withColumn("rank", F.col("before") + F.col("within")).drop("within", "before", "bucket", "salt")
    )
    schema = ranked.drop("rank").schema.add("sequence_id", "long").add("offset", "long")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            sequence, offset = np.empty(len(rank), np.int64), np.empty(len(rank), np.int64)
            for value in np.unique(length):
                rows = np.flatnonzero(length == value)
                low, high = where["range"][value], where["range"][value + 1]
                slot = low + np.searchsorted(where["first"][low:high], rank[rows], side="right") - 1
                sequence[rows] = where["sequence"][slot] + rank[rows] - where["first"][slot]
                offset[rows] = where["offset"][slot]
            kept = [c for c in batch.schema.names if c != "rank"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(sequence), pa.array(offset)], names=[*kept, "sequence_id", "offset"]
            )

    return ranked.mapInArrow(place, schema)


def pack_documents(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Tokenize and pack documents (doc_id, text; other columns are not read).

    Returns per piece doc_id, piece, start, length, ids_crc32, sequence_id and
    offset, and the ids on request. Longer documents are cut into whole
    capacities with a shorter first piece; all else stays in one piece.
    """
    parts = stage(pieces(docs, tokenizer or default_tokenizer(), capacity, end_id, with_ids), "pieces")
    packed = pack(parts, capacity)
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    return packed.select(*names, *(["ids"] if with_ids else []))
