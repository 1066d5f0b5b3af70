"""Quality rules as weak supervision.

Every rule votes good, bad or abstains. How often each rule is right is
estimated by expectation-maximisation over the counts of all vote patterns of
the corpus, and a document's posterior probability of being good replaces the
demand that it pass every rule.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from atlaslens.llm import texthash as T
from atlaslens.llm.common import stage, text_blocks

# Fixed value: the characters that count as symbols.
SYMBOLS = np.zeros(256, dtype=bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True
UPPER = np.zeros(256, dtype=bool)
UPPER[65:91] = True
LETTER = UPPER.copy()
LETTER[97:123] = True
# How a word of prose ends: a letter or digit of any script, or ordinary punctuation.
PLAIN_END = LETTER.copy()
PLAIN_END[128:] = PLAIN_END[48:58] = True
PLAIN_END[[ord(c) for c in ".,;:?'\")-"]] = True

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct", "n_upper", "n_letters", "n_shouts", "n_plain_ends"]


def _by_doc(marks: np.ndarray, at: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(marks, dtype=np.int64)))
    return total[at[1:]] - total[at[:-1]]


def measure_block(data: np.ndarray, at: np.ndarray) -> dict[str, np.ndarray]:
    """All measures of a block of whole texts, none of them on a part of a text."""
    n_docs = len(at) - 1
    w = T.words(data, at)
    inside = ~T.SPACE[data]
    runs = T.Runs(data)
    hashes = runs.hash(w.starts, w.ends)
    salt = T.mix(np.arange(n_docs, dtype=np.uint64) + np.uint64(1))

    def distinct(values: np.ndarray, doc: np.ndarray) -> np.ndarray:
        own = np.unique(T.mix(values ^ salt[doc]), return_index=True)[1]
        return np.bincount(doc[own], minlength=n_docs)

    # Words inside a three-word window that the text has twice or more.
    spans = T.windows(hashes, 3)
    repeated = np.zeros(len(hashes), dtype=bool)
    if len(spans):
        own = np.flatnonzero(w.doc[2:] == w.doc[:-2])
        _, which, times = np.unique(T.mix(spans[own] ^ salt[w.doc[own]]), return_inverse=True, return_counts=True)
        again = own[times[which] > 1]
        for k in range(3):
            repeated[again + k] = True

    # Lines: a text of k line feeds has k + 1 of them; only those with a word count.
    feeds = np.flatnonzero(data == 10)
    line_start = np.unique(np.concatenate((at[:-1][at[1:] > at[:-1]], feeds + 1)))
    line_start = line_start[line_start < len(data)]
    line_doc = np.searchsorted(at, line_start, side="right") - 1
    line_end = np.minimum(np.append(line_start[1:], len(data)), at[line_doc + 1]) if len(line_start) else line_start
    cut = np.zeros(len(data) + 1, dtype=bool)
    cut[feeds] = True
    line_end = np.where((line_end > line_start) & cut[line_end - 1], line_end - 1, line_end) if len(line_start) else line_start
    words_before = np.searchsorted(w.starts, line_start)
    full = np.searchsorted(w.starts, line_end) > words_before
    line_start, line_end, line_doc = line_start[full], line_end[full], line_doc[full]
    n_lines = np.bincount(line_doc, minlength=n_docs)

    last_byte = data[w.ends - 1] if len(w.ends) else np.empty(0, np.uint8)
    return {
        "n_words": w.count,
        "word_chars": _by_doc(inside & T.LEADS[data], at),
        "n_symbols": _by_doc(SYMBOLS[data], at),
        "n_dup_lines": n_lines - distinct(runs.hash(line_start, line_end), line_doc),
        "n_repeat_words": np.bincount(w.doc[repeated], minlength=n_docs),
        "n_lines": n_lines,
        "n_distinct": distinct(hashes, w.doc),
        "n_upper": _by_doc(UPPER[data], at),
        "n_letters": _by_doc(LETTER[data], at),
        "n_plain_ends": np.bincount(w.doc[PLAIN_END[last_byte]], minlength=n_docs),
        "n_shouts": np.bincount(w.doc[last_byte == ord("!")], minlength=n_docs),
    }


def measures(docs: DataFrame) -> DataFrame:
    """doc_id and the measures of every whole text; a null text has none of anything."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, at in text_blocks(batch.column(1)):
                found = measure_block(data, at)
                ids = batch.column(0).slice(first, len(at) - 1)
                yield pa.RecordBatch.from_arrays(
                    [ids, *(pa.array(found[m].astype(np.int64)) for m in MEASURES)], names=["doc_id", *MEASURES]
                )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, " + ", ".join(f"{m} long" for m in MEASURES))


@dataclass(frozen=True)
class Rule:
    """Votes bad when ``bad`` holds, good when ``good`` holds, else abstains."""

    name: str
    good: Column
    bad: Column

    def vote(self) -> Column:
        return F.when(self.bad, -1).when(self.good, 1).otherwise(0).cast("int").alias(self.name)


def rules() -> list[Rule]:
    words = F.col("n_words")
    share = lambda part, whole: F.col(part) / F.greatest(F.col(whole), F.lit(1))
    length = share("word_chars", "n_words")
    symbols, lines = share("n_symbols", "n_words"), share("n_dup_lines", "n_lines")
    repeats, shouts = share("n_repeat_words", "n_words"), share("n_shouts", "n_words")
    upper, plain = share("n_upper", "n_letters"), share("n_plain_ends", "n_words")
    variety = share("n_distinct", "n_words")
    return [
        Rule("words", words >= 80, words < 30),
        Rule("word_length", length.between(3, 9), (length < 2) | (length > 14)),
        Rule("symbols", symbols < 0.05, symbols > 0.3),
        Rule("lines", lines < 0.1, lines > 0.4),
        Rule("repeats", repeats < 0.2, repeats > 0.5),
        Rule("shouts", shouts < 0.05, shouts > 0.3),
        Rule("word_ends", plain > 0.9, plain < 0.6),
        Rule("upper", upper < 0.2, upper > 0.5),
        # Long texts repeat words by nature, so variety says something about short and middling ones only.
        Rule("variety", variety > 0.3, (variety < 0.1) & (words < 2000)),
    ]


def fit(patterns: np.ndarray, counts: np.ndarray, rounds: int = 50) -> dict[str, np.ndarray | float]:
    """Expectation-maximisation over vote patterns (one row each, -1, 0 or 1) and how many documents have them.

    Classes are named by where they start: good documents mostly get good
    votes. A weak prior, worth 5% of the documents, keeps an accuracy from
    running to 0 or 1 and the classes from changing places.
    """
    n_rules = patterns.shape[1]
    prior_good, good_says_bad, bad_says_bad = 0.85, np.full(n_rules, 0.01), np.full(n_rules, 0.3)
    start = (good_says_bad.copy(), bad_says_bad.copy())
    weight = max(1.0, 0.05 * counts.sum())
    voted, bad = patterns != 0, patterns == -1
    post = np.full(len(patterns), prior_good)
    for _ in range(rounds):
        good_log = np.log(prior_good) + np.where(voted, np.where(bad, np.log(good_says_bad), np.log1p(-good_says_bad)), 0).sum(1)
        bad_log = np.log1p(-prior_good) + np.where(voted, np.where(bad, np.log(bad_says_bad), np.log1p(-bad_says_bad)), 0).sum(1)
        post = 1 / (1 + np.exp(np.clip(bad_log - good_log, -500, 500)))
        for share, rate, first in ((post, good_says_bad, start[0]), (1 - post, bad_says_bad, start[1])):
            mass = (counts * share)[:, None]
            rate[:] = ((mass * bad).sum(0) + weight * first) / ((mass * voted).sum(0) + weight)
        prior_good = float(((counts * post).sum() + 0.85 * weight) / (counts.sum() + weight))
    return {"post": post, "prior": prior_good, "good_says_bad": good_says_bad, "bad_says_bad": bad_says_bad}


def score(docs: DataFrame, keep: float = 0.5) -> DataFrame:
    """Measures, votes, ``posterior`` (probability of good) and ``kept`` per document.

    ``base_failed`` texts (under 50 words, or over half of the words repeated)
    are never kept. Patterns are at most 3 to the number of rules, so the table
    of posteriors has a fixed bound. Empty tables give empty results.
    """
    chosen = rules()
    names = [r.name for r in chosen]
    voted = stage(measures(docs).select("*", *(r.vote() for r in chosen)), "votes")
    seen = voted.groupBy(*names).agg(F.count("*").alias("documents")).collect()
    spark = docs.sparkSession
    posterior = F.lit(0.5)
    if seen:
        patterns = np.array([[row[n] for n in names] for row in seen])
        post = fit(patterns, np.array([row["documents"] for row in seen], dtype=float))["post"]
        key = F.concat_ws(",", *names)
        known = [(",".join(map(str, p)), float(v)) for p, v in zip(patterns, post)]
        lookup = spark.createDataFrame(known, "pattern string, posterior double")
        voted = voted.withColumn("pattern", key).join(F.broadcast(lookup), "pattern", "left").drop("pattern")
        posterior = F.col("posterior")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return voted.withColumn("posterior", posterior).withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & (F.col("posterior") >= keep)
    )
