"""Phrases of two to five words that occur together more often than their parts suggest, by sorted count streams.

Every word opens a window of up to five words of its piece. The windows are
sorted over the whole cluster, so all windows that begin alike are neighbours,
and one pass over the stream counts the phrases of all lengths: a phrase's count
is the sum of the windows it opens. What is common enough becomes the count
stream, which is then read twice, sorted by its words from the front (prefix
order) and from the back (suffix order). In prefix order each phrase follows all
phrases that it begins with, so a stack of at most five open phrases has the
counts of its left parts, and gives each open phrase the count of its commonest
extension; in suffix order it is the right parts. Counts meet by their place in
the order; none is looked up in a hash table.

Where a stream is cut between tasks, windows that go on in the next task are
added up afterwards, and each task of the count stream also gets the phrases its
first key begins with. So no first word, however common, has to fit one task.

Before that, what cannot be common enough is found by bounded sketches: words are
counted in 2**24 buckets, then pairs of neighbours whose words passed, then
triples whose pairs passed, in 2**27 each. A bucket below the least count ends
the windows that would go on there, and only words of some passing pair open one.
Buckets shared by several keys keep windows that are not needed, they never lose
one; the counts themselves come from the streams alone. Where every bucket is
full, at some 10**11 words, nothing is saved, with the same result.

Equal windows are merged within a task, over all it reads, as long as the
different ones are few enough to keep. A common window still leaves every task,
so the windows are cut out in as many tasks as there are cores: with a task for
each part of the input, both the tasks and the common windows would grow with
it, and the rows with their product.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from atlaslens.llm import texthash
from atlaslens.llm.common import release, stage, text_blocks

WORDS = 5  # of the longest phrase
LEAST = 100  # occurrences of a phrase
TOP = 2_000  # phrases of a language
UNKNOWN = "und"
WORD_BUCKETS, RUN_BUCKETS = 1 << 24, 1 << 27  # of words, and of pairs or triples; a bit each is broadcast: 2 and 16 MB
RANGE = 1 << 18  # buckets that are added up together
CHUNK = 1 << 17  # windows that are cut out at a time
FLUSH = 1 << 20  # windows a task merges at a time
MERGED = 1 << 19  # different windows a task keeps before it sends them
A_TASK = 1 << 14  # phrases of the count stream in one task
SAMPLE = 1 << 14  # keys that its cuts are chosen from

# Words are joined by the least byte there is, so a phrase sorts right before all that begin with its words.
# The two least bytes are written as two within words.
JOIN, ESCAPES = "\x00", (("\x01", "\x01\x02"), ("\x00", "\x01\x01"))

_KIND = np.zeros(256, np.uint8)  # fixed values: 1 ends a word, 2 a piece as well
_KIND[[0x20, 0x09]] = 1
_KIND[[ord(c) for c in ".,;:!?"] + [0x0A, 0x0B, 0x0C, 0x0D]] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _ragged(starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of all elements of some runs, one run after another, and where each run begins there."""
    bounds = np.concatenate(([0], np.cumsum(sizes)))
    return np.repeat(starts - bounds[:-1], sizes) + np.arange(bounds[-1]), bounds


class Words:
    """The words of a block of texts in lower case, joined by JOIN, each with the piece it belongs to."""

    def __init__(self, data: np.ndarray, at: np.ndarray):
        kind = _KIND[data]
        inside = kind == 0
        edge = np.zeros(len(data) + 1, dtype=bool)
        edge[at[:-1]] = True
        before = np.concatenate(([False], inside[:-1])) & ~edge[:-1]
        starts = np.flatnonzero(inside & ~before)
        after = np.concatenate((inside[1:], [False])) & ~edge[1:]
        ends = np.flatnonzero(inside & ~after) + 1
        self.hashes = texthash.Runs(data, lower=True).hash(starts, ends)
        pieces = np.cumsum(kind == 2)[starts] if len(starts) else starts
        texts = np.searchsorted(at, starts, side="right")
        sizes = ends - starts
        self.ends = np.cumsum(sizes + 1) - 1
        self.starts = self.ends - sizes
        self.data = np.zeros(self.ends[-1] + 1 if len(starts) else 0, np.uint8)
        places, _ = _ragged(starts, sizes)
        self.data[_ragged(self.starts, sizes)[0]] = _LOWER[data[places]]
        self.inside = np.zeros(len(starts), dtype=bool)  # whether the word before is of the same piece
        self.inside[1:] = (pieces[1:] == pieces[:-1]) & (texts[1:] == texts[:-1])

    def __len__(self) -> int:
        return len(self.starts)

    def windows(self, opens: np.ndarray, second: np.ndarray, third: np.ndarray) -> Iterator[pa.Array]:
        """Up to WORDS words from every word that ``opens`` one: a second one where its mark is set, and more while theirs are in ``third``."""
        stops = np.append(np.flatnonzero(~third), len(self))
        first = np.flatnonzero(opens)
        stop = stops[np.minimum(np.searchsorted(stops, first + 2), len(stops) - 1)]
        pair = np.append(second, False)[first + 1]
        last = np.where(pair, np.minimum(first + WORDS, np.maximum(stop, first + 2)), first + 1) - 1
        for k in range(0, len(first), CHUNK):
            starts = self.starts[first[k : k + CHUNK]]
            places, bounds = _ragged(starts, self.ends[last[k : k + CHUNK]] - starts)
            offsets = bounds.astype(np.int64)
            yield pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(self.data[places])])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, Words]]:
    """The words of every block of texts of one language."""
    for batch in batches:
        langs = batch.column("lang")
        for lang in langs.unique().to_pylist():
            for _, data, at in text_blocks(batch.column("text").filter(pc.equal(langs, lang))):
                if len(data) and data.min() <= 1:
                    texts = [data[low:high].tobytes() for low, high in zip(at[:-1], at[1:])]
                    for plain, written in ESCAPES:
                        texts = [text.replace(plain.encode(), written.encode()) for text in texts]
                    data = np.frombuffer(b"".join(texts), np.uint8)
                    at = np.concatenate(([0], np.cumsum([len(text) for text in texts])))
                yield lang, Words(data, at)


class Filter:
    """What may be common enough: a bit per bucket of words, pairs and triples; ``used`` are the words of passing pairs."""

    def __init__(self):
        self.words = self.pairs = self.triples = self.used = None

    def _marks(self, words: Words, lang: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Buckets of the words; whether each passes with the one before, with the two before; the buckets of those runs.

        A run passes where no sketch that is known already rules it out.
        """
        own = np.uint64(int.from_bytes(hashlib.sha256(lang.encode()).digest()[:8], "little"))
        hashes = texthash.mix(words.hashes ^ own)
        single = (hashes & np.uint64(WORD_BUCKETS - 1)).astype(np.int64)
        if self.words is None:
            return single, None, None, None
        useful, second = _set(self.words, single), words.inside.copy()
        second &= useful
        second[1:] &= useful[:-1]
        runs = (texthash.windows(hashes, 2)[second[1:]] & np.uint64(RUN_BUCKETS - 1)).astype(np.int64)
        if self.pairs is None:
            return single, second, None, runs
        second[second] = _set(self.pairs, runs)
        third = second.copy()
        third[:1] = False
        third[1:] &= second[:-1]
        runs = (texthash.windows(hashes, 3)[third[2:]] & np.uint64(RUN_BUCKETS - 1)).astype(np.int64)
        if self.triples is not None:
            third[third] = _set(self.triples, runs)
        return single, second, third, runs

    def to_count(self, words: Words, lang: str, least: int) -> tuple[np.ndarray, np.ndarray]:
        """The buckets of what comes next (words, pairs, triples) and counts; words of passing pairs come after the triples."""
        single, second, third, runs = self._marks(words, lang)
        found, counts = np.unique(single if second is None else runs, return_counts=True)
        if third is not None:
            both = second.copy()
            both[:-1] |= second[1:]
            used = np.unique(single[both])
            found, counts = np.append(found, used + RUN_BUCKETS), np.append(counts, np.full(len(used), least))
        return found, counts

    def buckets(self) -> int:
        return WORD_BUCKETS if self.words is None else RUN_BUCKETS if self.pairs is None else RUN_BUCKETS + WORD_BUCKETS

    def learn(self, bits: np.ndarray) -> None:
        if self.words is None:
            self.words = bits
        elif self.pairs is None:
            self.pairs = bits
        else:
            self.triples, self.used = bits[: RUN_BUCKETS // 8], bits[RUN_BUCKETS // 8 :]

    def passing(self, words: Words, lang: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        single, second, third, _ = self._marks(words, lang)
        return _set(self.used, single), second, third


def _set(bits: np.ndarray, places: np.ndarray) -> np.ndarray:
    return (bits[places >> 3] >> (places & 7).astype(np.uint8) & 1).astype(bool)


def sketch(docs: DataFrame, known: Filter, least: int) -> tuple[np.ndarray, DataFrame]:
    """A bit per bucket that reaches ``least``, of what ``known`` does not have yet; and (lang, n) word counts."""
    shared = docs.sparkSession.sparkContext.broadcast(known)
    names, schema = ["part", "lang", "n", "places", "counts"], "part int, lang string, n long, places binary, counts binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, totals = shared.value, {}
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def flush() -> Iterator[pa.RecordBatch]:
            if not held:
                return
            places, counts = (np.concatenate(side) for side in zip(*held))
            order = np.argsort(places)
            first = np.flatnonzero(np.concatenate(([True], np.diff(places[order]) != 0)))
            places, counts = places[order][first], np.add.reduceat(counts[order], first)
            parts, first = np.unique(places // RANGE, return_index=True)
            last = np.append(first[1:], len(places))
            low, n = (places % RANGE).astype("<u4"), counts.astype("<i8")
            n = n.astype("<u2") if len(n) and n.max() < 1 << 16 else n
            yield pa.RecordBatch.from_arrays([
                pa.array(parts, pa.int32()), pa.nulls(len(parts), pa.string()), pa.nulls(len(parts), pa.int64()),
                pa.array([low[a:b].tobytes() for a, b in zip(first, last)], pa.binary()), pa.array([n[a:b].tobytes() for a, b in zip(first, last)], pa.binary()),
            ], names=names)
            held.clear()

        size = 0
        for lang, words in _blocks(batches):
            totals[lang] = totals.get(lang, 0) + len(words)
            found = known.to_count(words, lang, least)
            if len(found[0]):
                held.append(found)
                size += len(found[0])
            if size > FLUSH * 2:
                yield from flush()
                size = 0
        yield from flush()
        yield pa.RecordBatch.from_arrays([
            pa.array([-1] * len(totals), pa.int32()), pa.array(list(totals), pa.string()), pa.array(list(totals.values()), pa.int64()),
            pa.nulls(len(totals), pa.binary()), pa.nulls(len(totals), pa.binary()),
        ], names=names)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, sums = -1, np.zeros(RANGE, np.int64)

        def bits() -> pa.RecordBatch:
            rows = [(part, None, None, np.packbits(sums >= least, bitorder="little").tobytes())] if part >= 0 else []
            columns = list(zip(*rows)) or [()] * 4
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.string(), pa.int64(), pa.binary()))], names=["part", "lang", "n", "bits"]
            )

        for batch in batches:
            for own, lang, n, places, counts in zip(*(column.to_pylist() for column in batch.columns)):
                if own < 0:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([own], pa.int32()), pa.array([lang]), pa.array([n]), pa.array([None], pa.binary())], names=["part", "lang", "n", "bits"]
                    )
                    continue
                if own != part:
                    yield bits()
                    part, sums = own, np.zeros(RANGE, np.int64)
                places = np.frombuffer(places, "<u4")
                sums[places] += np.frombuffer(counts, "<u2" if len(counts) == 2 * len(places) else "<i8")
        yield bits()

    partial = docs.mapInArrow(run, schema).repartition("part").sortWithinPartitions("part")
    found = stage(partial.mapInArrow(add, "part int, lang string, n long, bits binary"), "sketch")
    bits = np.zeros(known.buckets() // 8, np.uint8)
    for row in found.where("part >= 0").select("part", "bits").toArrow().to_pylist():  # a bit per bucket in all
        bits[row["part"] * RANGE // 8 : (row["part"] + 1) * RANGE // 8] = np.frombuffer(row["bits"], np.uint8)
    return bits, found.where("part < 0").groupBy("lang").agg(F.sum("n").alias("n"))


def windows(docs: DataFrame, known: Filter) -> DataFrame:
    """(lang, phrase, n): the windows of all texts that pass; equal windows of a task are merged."""
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merged: dict[str, pa.Table] = {}
        held: dict[str, list[pa.Array]] = {}
        size = 0

        def merge() -> int:
            for lang, parts in held.items():
                found = pa.table({"phrase": pa.chunked_array(parts, pa.large_string())}).group_by("phrase", use_threads=False).aggregate([([], "count_all")])
                found = found.select(["phrase", "count_all"]).rename_columns(["phrase", "n"])
                if lang in merged:
                    both = pa.concat_tables([merged[lang], found]).group_by("phrase", use_threads=False).aggregate([("n", "sum")])
                    found = both.select(["phrase", "n_sum"]).rename_columns(["phrase", "n"])
                merged[lang] = found
            held.clear()
            return sum(map(len, merged.values()))

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, found in merged.items():
                for part in found.to_batches(max_chunksize=1 << 16):
                    yield pa.RecordBatch.from_arrays([
                        pa.array([lang] * len(part), pa.string()), part.column("phrase").cast(pa.string()), part.column("n"),
                    ], names=["lang", "phrase", "n"])
            merged.clear()

        for lang, words in _blocks(batches):
            for part in words.windows(*shared.value.passing(words, lang)):
                held.setdefault(lang, []).append(part)
                size += len(part)
                if size >= FLUSH:
                    if merge() >= MERGED:
                        yield from flush()
                    size = 0
        merge()
        yield from flush()

    return docs.mapInArrow(run, "lang string, phrase string, n long")


class Stream:
    """Counts the phrases that sorted windows open; batches may cut a phrase anywhere."""

    def __init__(self, least: int):
        self.least = least
        self.lang, self.last = None, None
        self.open: dict[int, tuple[int, bool]] = {}  # by words: the count so far, and whether the stream began with it

    def feed(self, lang: str, phrases: pa.LargeStringArray, n: np.ndarray) -> list[tuple[str, str, int]]:
        """The phrases that are complete once these windows, all of one language, are read: (lang, phrase, n)."""
        begins_stream = self.lang is None
        done = self.close(False) if lang != self.lang else []
        self.lang = lang
        if self.last is not None:
            phrases, n = pa.concat_arrays([pa.array([self.last], pa.large_string()), phrases]), np.concatenate(([0], n))
        offsets = np.frombuffer(phrases.buffers()[1], np.int64)[phrases.offset : phrases.offset + len(phrases) + 1]
        data = np.frombuffer(phrases.buffers()[2], np.uint8)
        starts, sizes = offsets[:-1], np.diff(offsets)
        # Where each word ends, from the phrase's start on; beyond the last word a number that no other row has.
        ends = -np.arange(len(n) * WORDS).reshape(len(n), WORDS) - 1
        joins = np.flatnonzero(data[offsets[0] : offsets[-1]] == 0) + offsets[0]
        row = np.searchsorted(offsets, joins, side="right") - 1
        words = np.bincount(row, minlength=len(n))
        ends[row, np.arange(len(joins)) - (np.cumsum(words) - words)[row]] = joins - starts[row]
        ends[np.arange(len(n)), words] = sizes
        words = words + 1
        # How many bytes, then how many words each row shares with the one before.
        alike = np.zeros(len(n), np.int64)
        if len(n) > 1:
            both = np.minimum(sizes[1:], sizes[:-1])
            here, bounds = _ragged(starts[1:], both)
            there, _ = _ragged(starts[:-1], both)
            place = here - np.repeat(starts[1:], both)
            shared = np.minimum.reduceat(np.where(data[here] != data[there], place, np.repeat(both, both)), bounds[:-1])
            alike[1:] = ((ends[1:] == ends[:-1]) & (ends[1:] <= shared[:, None])).sum(axis=1)
        still = {}
        for k in range(1, WORDS + 1):
            rows = np.flatnonzero(words >= k)
            if not len(rows):
                continue
            first = np.flatnonzero(alike[rows] < k)
            own, begins = n[rows], rows[first]
            head = np.zeros(len(begins), dtype=bool)
            if rows[0] == 0:
                so_far, head[0] = self.open.get(k, (0, begins_stream))
                own[0] += so_far
            sums = np.add.reduceat(own, first)
            keep = (sums >= self.least) | head
            if words[-1] >= k:
                still[k] = int(sums[-1]), bool(head[-1])
                keep[-1] = False
            done += [
                (lang, bytes(data[starts[i] : starts[i] + ends[i, k - 1]]).decode(), int(total)) for i, total in zip(begins[keep], sums[keep])
            ]
        self.open, self.last = still, phrases[-1].as_py()
        return done

    def close(self, cut: bool = True) -> list[tuple[str, str, int]]:
        """The phrases still open; those of any count where the next task may go on with them."""
        parts = self.last.split(JOIN) if self.last is not None else []
        done = [(self.lang, JOIN.join(parts[:k]), n) for k, (n, head) in self.open.items() if n >= self.least or head or cut]
        self.open, self.last = {}, None
        return done


def count_phrases(found: DataFrame, least: int) -> DataFrame:
    """(lang, phrase, n) of all phrases of up to WORDS words that occur at least so often."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream = Stream(least)

        def rows(done: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*done)) or [(), (), ()]
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.int64())], names=["lang", "phrase", "n"]
            )

        for batch in batches:
            langs = batch.column("lang").to_pylist() if len(batch) else []
            low = 0
            while low < len(langs):
                high = bisect_right(langs, langs[low].encode(), lo=low, key=str.encode)
                part = batch.slice(low, high - low)
                yield rows(stream.feed(langs[low], part.column("phrase").cast(pa.large_string()), part.column("n").to_numpy().copy()))
                low = high
        yield rows(stream.close())

    ordered = found.repartitionByRange("lang", "phrase").sortWithinPartitions("lang", "phrase")
    partial = ordered.mapInArrow(run, "lang string, phrase string, n long")
    return partial.groupBy("lang", "phrase").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def _cuts(keys: DataFrame, tasks: int) -> list[tuple[str, str]]:
    """The first key of every task but the first, as the order of a sample of keys has them."""
    share = min(1.0, SAMPLE / (tasks * A_TASK))
    some = keys.where(F.pmod(F.xxhash64("lang", "key"), F.lit(1 << 30)) < int(share * (1 << 30))).select("lang", "key")
    sample = sorted({(r["lang"].encode(), r["key"].encode()) for r in some.collect()})
    places = np.unique(np.linspace(0, len(sample), tasks + 1).astype(int)[1:-1])
    return [(sample[k][0].decode(), sample[k][1].decode()) for k in places]


def parts_in_order(counts: DataFrame, backwards: bool, tasks: int) -> DataFrame:
    """(lang, phrase, n, parts, longer) in one lockstep pass over the count stream.

    ``parts`` has the counts of the phrase's first 1, 2, ... words (its last
    ones if ``backwards``), ``longer`` the greatest count of the phrase with one
    more word at its other end. A phrase may come several times; n and parts are
    null in all rows but one, and its ``longer`` is the greatest of all.
    """
    key = F.array_join(F.reverse(F.split("phrase", JOIN)), JOIN) if backwards else F.col("phrase")
    keys = counts.select("lang", key.alias("key"), "n")
    cuts = [(lang.encode(), first.encode()) for lang, first in _cuts(keys, tasks)]
    carried: dict[tuple[bytes, bytes], list[int]] = {}  # what a task's first key begins with
    for task, (lang, first) in enumerate(cuts, 1):
        words = first.split(JOIN.encode())
        for k in range(1, len(words)):
            carried.setdefault((lang, JOIN.encode().join(words[:k])), []).append(task)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for lang, key, n in zip(*(column.to_pylist() for column in batch.columns)):
                place = lang.encode(), key.encode()
                own = bisect_right(cuts, place)
                out += [(own, lang, key, n, False)] + [(task, lang, key, n, True) for task in carried.get(place, ()) if task != own]
            columns = list(zip(*out)) or [()] * 5
            kinds = [pa.int32(), pa.string(), pa.string(), pa.int64(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["task", "lang", "key", "n", "carried"])

    def lockstep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: list[list] = []  # phrases that begin with one another: lang, words, n, carried, counts of the parts, longer
        task = None

        def close(down_to: int, out: list[tuple]) -> None:
            while len(open_) > down_to:
                lang, words, n, only_carried, parts, longer = open_.pop()
                phrase = JOIN.join(reversed(words) if backwards else words)
                if not only_carried:
                    out.append((lang, phrase, n, parts, longer))
                elif longer:
                    out.append((lang, phrase, None, None, longer))

        def rows(out: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*out)) or [()] * 5
            kinds = [pa.string(), pa.string(), pa.int64(), pa.list_(pa.int64()), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["lang", "phrase", "n", "parts", "longer"])

        for batch in batches:
            out: list[tuple] = []
            for own, lang, key, n, only_carried in zip(*(column.to_pylist() for column in batch.columns)):
                words = key.split(JOIN)
                depth = 0
                if own == task:
                    while depth < len(open_) and depth < len(words) - 1 and open_[depth][0] == lang and open_[depth][1][-1] == words[depth]:
                        depth += 1
                close(depth, out)
                task = own
                if open_:
                    open_[-1][5] = max(open_[-1][5], n)
                open_.append([lang, words, n, only_carried, [above[2] for above in open_], 0])
            yield rows(out)
        out = []
        close(0, out)
        yield rows(out)

    dealt = keys.mapInArrow(deal, "task int, lang string, key string, n long, carried boolean")
    ordered = dealt.repartition(tasks, "task").sortWithinPartitions("task", "lang", "key")
    return ordered.mapInArrow(lockstep, "lang string, phrase string, n long, parts array<long>, longer long")


def mine(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's ``top`` phrases.

    ``docs`` has text and lang; other columns are not read. A null text is
    empty, a null lang is ``und``, repeated rows count again. Words are in lower
    case (A-Z). Candidates are phrases of 2 to 5 words within a piece that occur
    at least ``least`` times (a), overlaps included. l and r are the counts of
    the two parts of its lowest-scoring cut, n is the number of words of the
    language, and the score is floor(1000 * a * n / (l * r)); ties of cuts go to
    the shorter first part. A candidate goes if a longer one that contains it
    occurs as often; one that is longer by a word is enough to see it, because
    the counts between cannot be less. Equal scores are ordered by a, then by
    the phrase's bytes. Without such phrases the result is empty.
    """
    spark = docs.sparkSession
    texts = docs.select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), "text").where(F.col("text") != "")
    known = Filter()
    for _ in range(3):
        bits, totals = sketch(texts, known, least)
        known.learn(bits)
    # Every task sends its own copy of a window, so there are as many tasks as cores, however many parts the input has.
    found = windows(texts.coalesce(spark.sparkContext.defaultParallelism), known)
    found = stage(found, "windows")  # sorting reads them twice: for a sample, then whole
    counts = stage(count_phrases(found, least), "counts")
    release(found)
    tasks = max(1, -(-counts.count() // A_TASK))
    left, right = (
        parts_in_order(counts, backwards, tasks).select(
            "lang", "phrase", "n", F.col("parts").alias("left" if not backwards else "right"),
            F.lit(None).cast("array<long>").alias("right" if not backwards else "left"), "longer",
        ) for backwards in (False, True)
    )
    both = left.unionByName(right).where(F.contains("phrase", F.lit(JOIN))).groupBy("lang", "phrase").agg(
        F.max("n").alias("a"), F.max("left").alias("left"), F.max("right").alias("right"), F.max("longer").alias("longer")
    ).where(F.col("longer") < F.col("a"))
    # Products pass 64 bits, so they are decimals of 38 digits.
    cut = F.expr("""array_min(transform(sequence(1, size(left)), k -> named_struct(
        'score', (1000BD * cast(a as decimal(19, 0)) * cast(total as decimal(19, 0)))
            div (cast(left[k - 1] as decimal(19, 0)) * cast(right[size(left) - k] as decimal(19, 0))),
        'k', k, 'l', left[k - 1], 'r', right[size(left) - k])))""")
    plain = F.replace(F.col("phrase"), F.lit(JOIN), F.lit(" "))
    for byte, written in reversed(ESCAPES):
        plain = F.replace(plain, F.lit(written), F.lit(byte))
    scored = both.join(totals.withColumnRenamed("n", "total"), "lang").select("lang", plain.alias("phrase"), "a", F.col("total").alias("n"), cut.alias("cut"))
    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "cut.l", "cut.r", "n", F.col("cut.score").alias("score"))
