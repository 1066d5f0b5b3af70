"""Quality by nearest-neighbour voting in a latent-semantic space.

A bounded sample of labelled documents is turned into term vectors (hashed
words, and hashed triples of character classes, which see shape rather than
content), weighted by rarity and reduced by singular value decomposition. The
reduced labelled vectors are broadcast. Every document is reduced the same way,
its cosine with every labelled vector is computed in blocks, and its nearest
neighbours vote with their similarity as weight.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from atlaslens.llm import texthash as T
from atlaslens.llm.common import text_blocks

# The model is fitted on at most this many labelled documents, chosen by a hash of their ids.
# Half of the places are kept for either label, as far as it has so many.
LABELLED = 2_000
WORD_TERMS, SHAPE_TERMS = 1_024, 512
TERMS = WORD_TERMS + SHAPE_TERMS
LATENT = 48
NEIGHBOURS = 25
SHARPNESS = 8  # similarity to this power is a vote's weight

# Fixed value: character classes. Letters, digits and other scripts are one class each, every other sign its own.
_CLASS = np.arange(256) % 24 + 8
_CLASS[65:91], _CLASS[97:123], _CLASS[48:58], _CLASS[128:], _CLASS[32], _CLASS[10] = 0, 1, 2, 1, 3, 4
_SHAPE = (np.arange(32**3) * 40_503 % 65_521 % SHAPE_TERMS).astype(np.int64)


def term_counts(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How often each term occurs in each text of a block."""
    n_docs = len(at) - 1
    w = T.words(data, at)
    bucket = (T.Runs(data).hash(w.starts, w.ends) >> np.uint64(20)).astype(np.int64) % WORD_TERMS
    words = np.bincount(w.doc * WORD_TERMS + bucket, minlength=n_docs * WORD_TERMS).reshape(n_docs, WORD_TERMS)
    kinds = _CLASS[data]
    doc = np.repeat(np.arange(n_docs), np.diff(at))
    triple = _SHAPE[kinds[:-2] * 1024 + kinds[1:-1] * 32 + kinds[2:]]
    same = doc[:-2] == doc[2:]
    shapes = np.bincount((doc[:-2] * SHAPE_TERMS + triple)[same], minlength=n_docs * SHAPE_TERMS).reshape(n_docs, SHAPE_TERMS)
    return np.hstack((words, shapes)).astype(np.float32)


@dataclass
class Model:
    weight: np.ndarray  # of each term
    axes: np.ndarray  # terms x latent
    vectors: np.ndarray  # labelled x latent, of length 1
    labels: np.ndarray
    base: float  # share of label 1, the score where nothing is similar

    def reduce(self, counts: np.ndarray) -> np.ndarray:
        return unit((unit_blocks(np.log1p(counts)) * self.weight) @ self.axes)

    def score(self, counts: np.ndarray) -> np.ndarray:
        """Cosines with all labelled vectors, block by block, and the vote of the nearest."""
        out = np.empty(len(counts))
        k = min(NEIGHBOURS, len(self.labels))
        for first in range(0, len(counts), 512):
            cosine = self.reduce(counts[first : first + 512]) @ self.vectors.T
            near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
            weight = np.maximum(np.take_along_axis(cosine, near, 1), 0).astype(np.float64) ** SHARPNESS
            # A vote of weight 0.01 for the base share: decides only where nothing is similar.
            out[first : first + 512] = ((weight * self.labels[near]).sum(1) + 0.01 * self.base) / (weight.sum(1) + 0.01)
        return np.clip(out, 0, 1)


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def unit_blocks(x: np.ndarray) -> np.ndarray:
    """Words and shapes count alike, however many there are of either."""
    return np.hstack((unit(x[:, :WORD_TERMS]), 2 * unit(x[:, WORD_TERMS:])))


def fit(counts: np.ndarray, labels: np.ndarray, share: float) -> Model:
    terms = unit_blocks(np.log1p(counts))
    weight = np.log((len(terms) + 1) / ((counts > 0).sum(0) + 1)).astype(np.float32) + 0.3
    weighted = np.multiply(terms, weight, out=terms)
    # Leading right singular vectors by subspace iteration: needs no matrix of terms by terms.
    axes = np.linalg.qr(np.random.default_rng(3).normal(size=(TERMS, LATENT + 16)).astype(np.float32))[0]
    for _ in range(12):
        axes = np.linalg.qr(weighted.T @ (weighted @ axes))[0]
    _, turn = np.linalg.eigh((weighted @ axes).T @ (weighted @ axes))
    axes = np.ascontiguousarray((axes @ turn)[:, ::-1][:, :LATENT])
    return Model(weight, axes, unit(weighted @ axes), labels.astype(np.float64), share)


def count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Rows that have a text, with their term counts."""
    for batch in batches:
        for first, data, at in text_blocks(batch.column("text")):
            for low in range(0, len(at) - 1, 2_048):  # many short texts: bound the matrix too
                part = at[low : low + 2_049]
                yield batch.slice(first + low, len(part) - 1), term_counts(data[part[0] : part[-1]], part - part[0])


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", most: int = LABELLED) -> Model | None:
    """Fits on ``labels`` (doc_id and a 0/1 column) joined to ``docs``; None where there is nothing to learn from.

    Null labels are left out; a document labelled several times has the
    majority label, 1 on a tie.
    """
    clean = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        (F.avg(label) >= 0.5).cast("int").alias("label")
    )
    share = clean.agg(F.avg("label")).first()[0]
    if share is None:
        return None
    order = F.xxhash64(F.lit("labelled"), "doc_id")
    picked = None
    for value in (0, 1):
        some = clean.where(F.col("label") == value).orderBy(order, "doc_id").limit(most // 2)
        picked = some if picked is None else picked.unionByName(some)
    found = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")  # at most ``most`` rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, counts in count_batches(batches):
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), rows.column(2), pa.array([c.tobytes() for c in np.minimum(counts, 65535).astype("<u2")], pa.binary())],
                names=["doc_id", "label", "counts"],
            )

    sample = found.select("doc_id", "text", "label").mapInArrow(run, "doc_id long, label int, counts binary")
    rows = sample.dropDuplicates(["doc_id"]).toArrow().sort_by("doc_id")
    if not len(rows):
        return None
    counts = np.frombuffer(b"".join(rows["counts"].to_pylist()), "<u2").reshape(len(rows), TERMS).astype(np.float32)
    return fit(counts, rows["label"].to_numpy(), float(share))


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id and score (0 to 1; higher: label 1 likelier) of every whole text.

    A null text is empty; an empty text resembles nothing and gets about the
    share of label 1. Without labelled documents every score is 0.5. Repeated
    rows are scored again; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, counts in count_batches(batches):
            values = shared.value.score(counts) if shared.value else np.full(len(counts), 0.5)
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(values)], names=["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")


def keep(docs: DataFrame, model: Model | None, least: float = 0.5) -> DataFrame:
    """The documents that score at least so much, with all their columns as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, counts in count_batches(batches):
            yield rows.filter(pa.array(shared.value.score(counts) >= least)) if shared.value else rows

    # Signs in names would be read as syntax on the way, so only the text keeps its name there.
    plain = docs.toDF(*(name if name == "text" else f"c{k}" for k, name in enumerate(docs.columns)))
    return plain.mapInArrow(run, plain.schema).toDF(*docs.columns)


def held_out(doc_id="doc_id"):
    """Whether a document's label must not be learned from; ids that are null are never held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def predict(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for all documents, learned from labels that are not held out."""
    model = train(docs, labels.where(~held_out()))
    return score(docs, model).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
