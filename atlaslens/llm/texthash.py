"""64-bit hashes of words, shingles and lines of many texts at once, in numpy.

The hash of a run of bytes is a polynomial over a random table, taken from
running sums, so the cost does not depend on how the bytes fall into words.
Two different runs share a hash with a chance of about 2**-64 a pair.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_random = np.random.default_rng(20240229)
_BYTES = _random.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = np.arange(256)
_LOWER[65:91] += 32
_BYTES_LOWER = _BYTES[_LOWER]
_BASE = int(_random.integers(1, 2**62)) * 2 + 1
_INVERSE = pow(_BASE, -1, 2**64)
_STEP = _random.integers(1, 2**63, 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
#: First byte of a code point.
LEADS = (np.arange(256) & 0xC0) != 0x80

_powers: dict[int, np.ndarray] = {}


def _power_table(base: int, count: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < count:
        with np.errstate(over="ignore"):
            steps = np.full(max(count, 1 << 20), base, dtype=np.uint64)
            steps[0] = 1
            have = np.multiply.accumulate(steps)
        if count <= 1 << 22:
            _powers[base] = have
    return have[:count]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of a 64-bit number over all others."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class Runs:
    """Hashes of any byte runs of a block."""

    def __init__(self, data: np.ndarray, lower: bool = False):
        n = len(data)
        with np.errstate(over="ignore"):
            self.sums = np.zeros(n + 1, dtype=np.uint64)
            np.cumsum((_BYTES_LOWER if lower else _BYTES)[data] * _power_table(_BASE, n), out=self.sums[1:])
        self.inverse = _power_table(_INVERSE, n + 1)

    def hash(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix((self.sums[ends] - self.sums[starts]) * self.inverse[starts])


@dataclass
class Words:
    """Words of a block: where they are, the text each belongs to, and each text's first word and word count."""

    starts: np.ndarray
    ends: np.ndarray
    doc: np.ndarray
    first: np.ndarray
    count: np.ndarray


def words(data: np.ndarray, at: np.ndarray) -> Words:
    """The words of every text; ``at`` has the start of each text and the end of the last."""
    n_docs = len(at) - 1
    if not len(data):
        none = np.empty(0, np.int64)
        return Words(none, none, none, np.zeros(n_docs, np.int64), np.zeros(n_docs, np.int64))
    inside = ~SPACE[data]
    before = np.empty_like(inside)
    before[0] = False
    before[1:] = inside[:-1]
    full = at[:-1][at[1:] > at[:-1]]
    before[full] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[-1] = False
    after[:-1] = inside[1:]
    after[full[1:] - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    doc = np.searchsorted(at, starts, side="right") - 1
    count = np.bincount(doc, minlength=n_docs)
    first = np.concatenate(([0], np.cumsum(count)[:-1]))
    return Words(starts, ends, doc, first, count)


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` neighbours, whether or not they are of one text."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        total = np.zeros(n, dtype=np.uint64)
        for k in range(size):
            total += hashes[k : k + n] * _STEP[k]
        return mix(total)


def distinct_runs(values: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorts every run in place and leaves out repeats within a run; ``at`` has each run's start and the last end."""
    for low, high in zip(at[:-1].tolist(), at[1:].tolist()):
        values[low:high].sort()
    keep = np.ones(len(values), dtype=bool)
    keep[1:] = values[1:] != values[:-1]
    keep[at[:-1][at[1:] > at[:-1]]] = True
    return values[keep], np.concatenate(([0], np.cumsum(keep)))[at]


def shingle_sets(data: np.ndarray, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingles of each text of a block, A-Z taken as a-z: all values, and where each text's begin and end.

    A text with fewer words than ``size`` has its whole word sequence as one
    shingle; a text without words has none.
    """
    w = words(data, at)
    hashes = Runs(data, lower=True).hash(w.starts, w.ends)
    spans = windows(hashes, size)
    whole = spans[w.doc[: len(spans)] == w.doc[size - 1 :]] if len(spans) else spans
    short = np.flatnonzero((w.count > 0) & (w.count < size))
    lengths = np.maximum(w.count - size + 1, 0)
    lengths[short] = 1
    bounds = np.concatenate(([0], np.cumsum(lengths)))
    values = np.empty(bounds[-1], dtype=np.uint64)
    is_short = np.zeros(len(values), dtype=bool)
    is_short[bounds[short]] = True
    values[~is_short] = whole
    for k in short.tolist():
        first, count = int(w.first[k]), int(w.count[k])
        with np.errstate(over="ignore"):
            values[bounds[k]] = mix(windows(hashes[first : first + count], count) + np.uint64(count))[0]
    return distinct_runs(values, bounds)
