"""The language of a text by prediction by partial matching.

Every language has a tree of byte contexts of up to four bytes, with how often
each byte followed. A byte is coded in the longest context the tree has; one
that never followed there costs an escape, and the next shorter context codes it
without the bytes that were just ruled out. The chance of an escape is the share
of distinct followers (method C). The language whose frozen counts need the
fewest bits for the whole text is predicted.

All labelled documents are counted. The trees together keep at most ``NODES``
counts: each language drops what occurs less often than a power of two, the
smallest that makes its tree fit its share. As a shorter context counts at least
what a longer one does, a tree stays whole when its rare ends go.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from atlaslens.llm.common import BLOCK_BYTES, release, stage, text_blocks

ORDER = 4  # bytes of the longest context
BEFORE = 10  # a text counts as if line ends preceded it
NODES = 1 << 20  # counts of all trees together (16 bytes each)
UNIT = 1 << 20  # code lengths are summed in this fraction of a bit, exactly and in any order
FLUSH = 1 << 21  # counts a task holds before it merges them
CACHE_BYTES = 64 << 20  # code lengths a task remembers
UNKNOWN = "und"


def _low(bytes_: int) -> np.int64:
    return np.int64((1 << 8 * bytes_) - 1)


def grams(data: np.ndarray, at: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each byte from ``low`` to ``high`` of a block: itself below the ORDER bytes before it, and its text."""
    place = np.arange(low, high)
    doc = np.searchsorted(at, place, side="right") - 1
    inside = place - at[doc]
    key = data[low:high].astype(np.int64)
    for k in range(1, ORDER + 1):
        before = np.where(inside >= k, data[np.maximum(place - k, 0)], BEFORE)
        key |= before.astype(np.int64) << 8 * k
    return key, doc


def _merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    key, count = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(key, kind="stable")
    key, count = key[order], count[order]
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    return key[first], np.add.reduceat(count, first)


def count_grams(docs: DataFrame) -> DataFrame:
    """(lang, gram, n) partial counts of the labelled texts; a task sends what it has merged."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[list, list]] = {}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, parts in held.items():
                if not parts[0]:
                    continue
                key, count = _merged(*parts)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(key), pa.string()), pa.array(key), pa.array(count)], names=["lang", "gram", "n"])

        for batch in batches:
            langs = batch.column("lang")
            for lang in langs.unique().to_pylist():
                texts = batch.column("text").filter(pc.equal(langs, lang))
                keys, counts = held.setdefault(lang, ([], []))
                for _, data, at in text_blocks(texts):
                    for low in range(0, len(data), BLOCK_BYTES):
                        key, count = np.unique(grams(data, at, low, min(low + BLOCK_BYTES, len(data)))[0], return_counts=True)
                        keys.append(key), counts.append(count)
                        size += len(key)
                        if size > FLUSH:
                            for parts in held.values():
                                if parts[0]:
                                    key, count = _merged(*parts)
                                    parts[0][:], parts[1][:] = [key], [count]
                            size = sum(len(k) for parts in held.values() for k in parts[0])
                            if size > FLUSH // 2:
                                yield from flush()
                                for parts in held.values():
                                    parts[0].clear(), parts[1].clear()
                                held = {lang: held[lang]}
                                size = 0
        yield from flush()

    known = docs.where("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text")
    return known.mapInArrow(run, "lang string, gram long, n long")


class Tree:
    """Frozen counts of one language. Per order: the followers of all its contexts, and the contexts with their totals."""

    def __init__(self, tables: list[tuple[np.ndarray, np.ndarray]]):
        self.grams, self.counts, self.contexts, self.n, self.d = [], [], [], [], []
        for gram, count in tables:
            order = np.argsort(gram)
            gram, count = gram[order], count[order].astype(np.float64)
            context, first = np.unique(gram >> 8, return_index=True)
            self.grams.append(gram), self.counts.append(count), self.contexts.append(context)
            self.n.append(np.add.reduceat(count, first) if len(first) else count)
            self.d.append(np.diff(np.append(first, len(gram))).astype(np.float64))
        # What is left of the next shorter context once the followers of this one are ruled out.
        self.rest_n, self.rest_d = [np.zeros(len(self.contexts[0]))], [256.0 - self.d[0]]
        for k in range(1, ORDER + 1):
            shorter = np.searchsorted(self.contexts[k - 1], self.contexts[k] & _low(k - 1))
            same = self.counts[k - 1][np.searchsorted(self.grams[k - 1], self.grams[k] & _low(k))]
            first = np.searchsorted(self.grams[k] >> 8, self.contexts[k])
            self.rest_n.append(self.n[k - 1][shorter] - (np.add.reduceat(same, first) if len(first) else same))
            self.rest_d.append(self.d[k - 1][shorter] - self.d[k])

    def lengths(self, keys: np.ndarray) -> np.ndarray:
        """The code length of each gram's last byte after the bytes before it, in 1 / UNIT bits."""
        bits = np.zeros(len(keys))
        left = np.arange(len(keys))  # those not coded yet
        rest_n, rest_d = np.full(len(keys), np.nan), np.full(len(keys), 256.0)
        for k in range(ORDER, -1, -1):
            if not len(left) or not len(self.contexts[k]):
                continue
            key = keys[left]
            context = (key >> 8) & _low(k)
            i = np.minimum(np.searchsorted(self.contexts[k], context), len(self.contexts[k]) - 1)
            known = self.contexts[k][i] == context
            at, i = left[known], i[known]
            fresh = np.isnan(rest_n[at])
            n, d = np.where(fresh, self.n[k][i], rest_n[at]), np.where(fresh, self.d[k][i], rest_d[at])
            gram = key[known] & _low(k + 1)
            j = np.minimum(np.searchsorted(self.grams[k], gram), len(self.grams[k]) - 1)
            found = self.grams[k][j] == gram
            total = n + d
            share = np.where(found, self.counts[k][j], d)
            sure = ~found & (total == 0)  # nothing else was left here: an escape tells nothing
            bits[at] += np.where(sure, 0.0, np.log2(np.where(sure, 1.0, total)) - np.log2(np.where(sure, 1.0, share)))
            rest_n[at], rest_d[at] = self.rest_n[k][i], self.rest_d[k][i]
            coded = np.zeros(len(keys), dtype=bool)
            coded[at[found]] = True
            left = left[~coded[left]]
        bits[left] += np.log2(rest_d[left])  # a byte this language never showed
        return np.round(bits * UNIT).astype(np.int64)


@dataclass
class Model:
    langs: list[str]
    trees: list[Tree]

    def scorer(self) -> "Scorer":
        return Scorer(self)


class Scorer:
    """Code lengths of whole texts, remembering those of grams already met."""

    def __init__(self, model: Model):
        self.model = model
        self.most = CACHE_BYTES // (8 * (1 + len(model.langs)))
        self._forget()

    def _forget(self) -> None:
        self.keys = np.empty(0, np.int64)
        self.known = [np.empty(0, np.int64) for _ in self.model.langs]

    def _learn(self, keys: np.ndarray) -> np.ndarray:
        """Where the sorted ``keys`` are among those remembered, after the new ones have been worked out."""
        at = np.searchsorted(self.keys, keys)
        new = keys[self.keys[np.minimum(at, len(self.keys) - 1)] != keys] if len(self.keys) else keys
        if len(new):
            if len(self.keys) + len(new) > self.most:
                self._forget()
                new = keys
            places = np.searchsorted(self.keys, new)
            self.known = [np.insert(have, places, tree.lengths(new)) for have, tree in zip(self.known, self.model.trees)]
            self.keys = np.insert(self.keys, places, new)
            at = np.searchsorted(self.keys, keys)
        return at

    def score(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        """A row per text, a column per language: the bits of the whole text, times UNIT."""
        out = np.zeros((len(at) - 1, len(self.model.langs)), np.int64)
        for low in range(0, len(data), BLOCK_BYTES):
            keys, doc = grams(data, at, low, min(low + BLOCK_BYTES, len(data)))
            distinct, which = np.unique(keys, return_inverse=True)
            place = self._learn(distinct)
            first = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1])))
            for column, lengths in enumerate(self.known):
                out[doc[first], column] += np.add.reduceat(lengths[place][which], first)
        return out


def train(docs: DataFrame, nodes: int = NODES) -> Model | None:
    """Counts all documents with a lang and a text; None where there are none.

    Repeated rows count as often as they occur; empty texts count nothing.
    ``nodes`` bounds what all trees hold together, each language having an equal
    share of it, but no less than 256.
    """
    counted = stage(count_grams(docs).groupBy("lang", "gram").agg(F.sum("n").alias("n")), "grams")
    orders = F.explode(F.array(*[
        F.struct(F.lit(k).alias("k"), F.col("gram").bitwiseAND(F.lit(int(_low(k + 1)))).alias("gram")) for k in range(ORDER + 1)
    ])).alias("at")
    tree = stage(counted.select("lang", "n", orders).groupBy("lang", "at.k", "at.gram").agg(F.sum("n").alias("n")), "nodes")
    sizes = tree.groupBy("lang", F.floor(F.log2("n")).cast("int").alias("power")).agg(F.count("*").alias("size")).collect()  # 64 rows a language
    langs = sorted({r["lang"] for r in sizes}, key=lambda lang: lang.encode())
    if not langs:
        release(counted, tree)
        return None
    share, least = max(256, nodes // len(langs)), {}
    for lang in langs:
        total, floor = 0, 64
        for power, size in sorted(((r["power"], r["size"]) for r in sizes if r["lang"] == lang), reverse=True):
            total += size
            if total > share:
                break
            floor = power
        least[lang] = 1 << floor
    limits = docs.sparkSession.createDataFrame([(lang, least[lang]) for lang in langs if least[lang] < 1 << 63], "lang string, least long")
    kept = tree.join(F.broadcast(limits), "lang").where("n >= least").select("lang", "k", "gram", "n").toArrow()
    release(counted, tree)
    trees = []
    for lang in langs:
        own = kept.filter(pc.equal(kept["lang"], lang))
        k, gram, n = (own[name].to_numpy() for name in ("k", "gram", "n"))
        trees.append(Tree([(gram[k == order], n[k == order]) for order in range(ORDER + 1)]))
    return Model(langs, trees)


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, lang_pred, score (0 to 1) and code_bits (of that language) of every whole text of ``docs`` (doc_id, text).

    ``score`` is the chance of the predicted language, all being equally likely
    beforehand. Equal code lengths go to the first language by code point. A
    text that is null or has no letter is ``und`` with score 0 and null bits,
    and so is every text where nothing was learned. Repeated rows are scored
    again; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = shared.value.scorer() if shared.value else None
        for batch in batches:
            letters = batch.column("letters").to_numpy(zero_copy_only=False).astype(bool)
            langs, score, bits = np.full(len(batch), UNKNOWN, dtype=object), np.zeros(len(batch)), np.zeros(len(batch))
            if scorer:
                for first, data, at in text_blocks(batch.column("text")):
                    lengths = scorer.score(data, at)
                    best = lengths.argmin(axis=1)
                    fewest = lengths[np.arange(len(best)), best]
                    more = np.maximum((fewest[:, None] - lengths) / UNIT, -1074.0)
                    part = slice(first, first + len(best))
                    langs[part] = np.array(scorer.model.langs, dtype=object)[best]
                    score[part] = 1.0 / np.exp2(more).sum(axis=1)
                    bits[part] = fewest / UNIT
                langs[~letters], score[~letters] = UNKNOWN, 0.0
            told = letters if scorer else np.zeros(len(batch), dtype=bool)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(langs, pa.string()), pa.array(score), pa.array(bits, mask=~told)],
                names=["doc_id", "lang_pred", "score", "code_bits"],
            )

    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letters")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", letters).mapInArrow(run, f"doc_id {kind}, lang_pred string, score double, code_bits double")


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether nothing may be learned from a document; one without an id is never held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def predict(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, code_bits of all documents, learned from those with a lang that are not held out."""
    model = train(docs.where(~held_out()).select("lang", "text"))
    return identify(docs.select("doc_id", "text"), model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "code_bits")
