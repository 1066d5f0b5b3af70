"""Hard negatives, language identification and phrases against brute force, held-out labels and awkward rows."""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from atlaslens.llm import collocations, hardneg, langid
from atlaslens.llm.common import text_blocks

DOCS = "doc_id long, text string, lang string, source string"


# Hard negatives.


def brute_negatives(rows):
    """(vec_id, label, integers) rows; a null id comes last among ties."""
    place = lambda i: (rows[i][0] is None, rows[i][0] or 0, i)
    out = []
    for i, (anchor, label, x) in enumerate(rows):
        if anchor is None or anchor % 100:
            continue
        score = {j: sum(a * b for a, b in zip(x, y)) for j, (_, _, y) in enumerate(rows) if j != i and len(y) == len(x)}
        order = sorted(score, key=lambda j: (-score[j], place(j)))
        for p in [j for j in order if rows[j][1] == label][:5]:
            good = [j for j in order if rows[j][1] != label and 30 * score[p] <= 100 * score[j] <= 90 * score[p]][:10]
            out += [(anchor, rows[p][0], k, rows[j][0], score[p], score[j]) for k, j in enumerate(good, 1)]
    return Counter(out)


def mined(spark, rows, **extra):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").select("*", *[F.lit(v).alias(k) for k, v in extra.items()])
    return Counter(tuple(r) for r in hardneg.mine(df).collect())


def whole(rows):
    return [(i, l, [math.floor(256 * x) for x in v]) for i, v, l in rows if l is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]


def test_hard_negatives_equal_brute_force_in_clusters_and_ties(spark):
    rnd = np.random.default_rng(5)
    centre = rnd.normal(size=(4, 70))
    rows = []
    for k in range(900):
        x = centre[k % 4] + rnd.normal(size=70) * (0.05 if k % 3 else 1.0)
        rows.append((k, (x / np.linalg.norm(x)).round(2).tolist(), int(k % 7 == 1) + 2 * (k % 2)))
    rows += [(1000 + k, rows[3][1], k % 3) for k in range(40)]  # copies, so equal scores
    got = mined(spark, rows, row=1, score="x", slot=3, label_="y")
    assert got == brute_negatives(whole(rows)) and len(got) > 100


def test_hard_negatives_of_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.5], 1), (1, [0.9, 0.5], 1), (2, [0.5, 0.1], 2), (3, [0.4, 0.3], 2), (None, [0.4, 0.3], 2), (None, [0.9, 0.5], 1),
        (0, [1.0, 0.5], 1), (0, [1.0, 0.5], 1), (4, None, 1), (5, [0.2, 0.2], None), (6, [nan, 1.0], 2), (7, [inf, 1.0], 2), (8, [0.2, None], 2),
        (9, [0.3], 2), (100, [0.5], 1), (101, [0.7], 1), (102, [0.2], 2), (103, [0.0], 2), (200, [], 1), (201, [], 1), (202, [], 2),
        (300, [0.0, 0.0], 1), (301, [0.0, 0.0], 2), (302, [-1.0, -0.1], 1), (400, [-1.0, 0.0], 2), (500, [5000.0, -7000.5], 3), (501, [4000.0, 1.0], 3),
    ]
    assert mined(spark, rows) == brute_negatives(whole(rows))
    beyond = rows + [(9000, [1e300, 1.0], 1), (9100, [1e7, 1.0], 2)]
    assert mined(spark, beyond) == brute_negatives(whole(rows))
    assert not mined(spark, []) and not mined(spark, [(0, None, None)])


def test_anchors_in_several_blocks_and_tasks(spark, monkeypatch):
    rnd = np.random.default_rng(6)
    rows = [(10 * k, rnd.normal(size=9).tolist(), k % 4) for k in range(400)]
    monkeypatch.setattr(hardneg, "MOST_ANCHORS", 11)
    monkeypatch.setattr(hardneg, "PAIRS_A_TASK", 4000)
    monkeypatch.setattr(hardneg, "ANCHORS", 3)
    monkeypatch.setattr(hardneg, "PENDING", 50)
    assert mined(spark, rows) == brute_negatives(whole(rows))


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 200), st.integers(0, 2**31), st.sampled_from([1e-3, 1.0, 300.0, 1e6]))
def test_intervals_are_certain(width, seed, size):
    rnd = np.random.default_rng(seed)
    vectors = np.floor(rnd.normal(size=(12, width)) * size)
    vectors[0] = 0
    vectors[1] = vectors[2]
    turns = hardneg.rotations(width)
    low, high = hardneg.intervals(hardneg.planes(vectors, turns), hardneg.encode(vectors, turns))
    exact = vectors @ vectors.T
    assert (low <= exact).all() and (exact <= high).all()


def test_intervals_rule_most_rows_out():
    vectors = np.floor(256 * np.random.default_rng(3).normal(size=(2000, 64)) / 8)
    turns = hardneg.rotations(64)
    low, high = hardneg.intervals(hardneg.planes(vectors[:50], turns), hardneg.encode(vectors, turns))
    exact = vectors[:50] @ vectors.T
    tenth = np.sort(exact, axis=1)[:, -10][:, None]
    assert (high >= tenth).mean() < 0.2


# Languages.


def brute_bits(counted: dict, text: bytes) -> float:
    """Code length from nested dictionaries, byte by byte."""
    padded, bits = b"\n" * 4 + text, 0.0
    for i in range(4, len(padded)):
        out = set()
        for k in range(4, -1, -1):
            followers = counted.get(padded[i - k : i])
            if not followers:
                continue
            left = {s: n for s, n in followers.items() if s not in out}
            total = sum(left.values()) + len(left)
            if padded[i] in left:
                bits -= math.log2(left[padded[i]] / total)
                break
            if total:
                bits -= math.log2(len(left) / total)
            out |= set(followers)
        else:
            bits += math.log2(256 - len(out))
    return bits


def brute_counts(texts, least=1):
    counted = defaultdict(Counter)
    for text in texts:
        padded = b"\n" * 4 + text.encode()
        for i in range(4, len(padded)):
            for k in range(5):
                counted[padded[i - k : i]][padded[i]] += 1
    kept = {context: {s: n for s, n in f.items() if n >= least} for context, f in counted.items()}
    return {context: f for context, f in kept.items() if f}


LEARNED = [("xx", "the cat the hat"), ("xx", "that é ha"), ("yy", "le chat le chapeau"), ("yy", ""), ("yy", "là-bas"), (None, "nobody"), ("zz", None)]


def test_code_lengths_equal_brute_force(spark):
    docs = spark.createDataFrame(LEARNED * 3, "lang string, text string")
    model = langid.train(docs)
    assert model.langs == ["xx", "yy"]
    texts = ["the chat", "", "là", "qqq☃", "le chapeau that", "a" * 50, "\n\n\n\n\nthe"]
    blocks = list(text_blocks(pa.array(texts)))
    found = np.concatenate([model.scorer().score(data, at) for _, data, at in blocks]) / langid.UNIT
    for column, lang in enumerate(model.langs):
        counted = brute_counts([t for l, t in LEARNED * 3 if l == lang and t])
        assert np.allclose(found[:, column], [brute_bits(counted, t.encode()) for t in texts], atol=1e-3)


def test_trees_keep_what_is_common_and_stay_whole(spark):
    rnd = random.Random(4)
    texts = [" ".join(rnd.choice(["ab", "abc", "bca", "c", "xyz"]) for _ in range(60)) for _ in range(30)]
    model = langid.train(spark.createDataFrame([("xx", t) for t in texts], "lang string, text string"), nodes=300)
    kept = sum(len(g) for g in model.trees[0].grams)
    least = int(min(c.min() for c in model.trees[0].counts))
    assert kept <= 300
    floor = 1 << (least.bit_length() - 1) if least & (least - 1) else least
    counted = brute_counts(texts, floor)
    assert kept == sum(len(f) for f in counted.values())
    (_, data, at), = text_blocks(pa.array(["abc xyzzy bca"]))
    assert np.allclose(model.scorer().score(data, at) / langid.UNIT, brute_bits(counted, b"abc xyzzy bca"), atol=1e-3)


def test_scores_do_not_depend_on_blocks_or_memory(spark, monkeypatch):
    model = langid.train(spark.createDataFrame(LEARNED, "lang string, text string"))
    texts = ["the cat le chat " * 40, "", "hat", "chapeau là " * 30]
    whole_ = [model.scorer().score(data, at) for _, data, at in text_blocks(pa.array(texts))]
    monkeypatch.setattr(langid, "BLOCK_BYTES", 7)
    monkeypatch.setattr(langid, "CACHE_BYTES", 24 * 9)
    assert (np.concatenate(whole_) == model.scorer().score(*list(text_blocks(pa.array(texts)))[0][1:])).all()


def test_counts_are_merged_within_bounds(spark, monkeypatch):
    docs = spark.createDataFrame([(l, t) for l, t in LEARNED if t] * 20, "lang string, text string")
    expected = {tuple(r) for r in langid.count_grams(docs).groupBy("lang", "gram").agg(F.sum("n")).collect()}
    many = langid.count_grams(docs)
    monkeypatch.setattr(langid, "FLUSH", 10)  # read where the rows are counted, in this process
    run = {}
    for lang, text in [(l, t) for l, t in LEARNED if t and l] * 20:
        for _, data, at in text_blocks(pa.array([text])):
            for key in langid.grams(data, at, 0, len(data))[0].tolist():
                run[lang, key] = run.get((lang, key), 0) + 1
    assert expected == {(l, k, n) for (l, k), n in run.items()} == {tuple(r) for r in many.groupBy("lang", "gram").agg(F.sum("n")).collect()}


def test_held_out_documents_are_told_apart(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = langid.predict(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(rows) > 100 and sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.98


def test_languages_of_awkward_rows(spark):
    rows = [(1, "the cat the hat", "xx", "a"), (2, None, "xx", None), (3, "", None, "b"), (4, " 12 ☃ !", "yy", "b"), (None, "le chat", "yy", "b"), (None, None, None, None),
            (6, "le chat le chapeau", "yy", "c"), (6, "le chat le chapeau", "yy", "c"), (7, "le chat " * 60_000, None, "c"), (8, "É", None, "c")]
    docs = spark.createDataFrame(rows, DOCS).withColumn("letters", F.lit("x")).withColumn("score", F.lit("x")).withColumn("gram", F.lit(2))
    got = {(r.doc_id, r.lang_pred): r for r in langid.predict(docs).collect()}
    assert len(langid.predict(docs).collect()) == len(rows)
    assert {k for k in got if k[1] == "und"} == {(2, "und"), (3, "und"), (4, "und"), (None, "und")} and (None, "yy") in got and (7, "yy") in got
    assert all(0 <= r.score <= 1 for r in got.values()) and got[4, "und"].score == 0
    unlearned = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in langid.predict(unlearned).collect()} == {"und"}
    assert langid.predict(docs.limit(0)).collect() == []


# Phrases.


def brute_phrases(rows, least, top):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for m in range(1, 6):
                for i in range(len(words) - m + 1):
                    f[lang][tuple(words[i : i + m])] += 1
    out = []
    for lang, c in f.items():
        candidates = [p for p, a in c.items() if len(p) > 1 and a >= least]
        gone = {p[i : i + m] for p in candidates for m in range(2, len(p)) for i in range(len(p) - m + 1) if c[p] >= c[p[i : i + m]]}
        scored = []
        for p in candidates:
            if p not in gone:
                score, k = min((1000 * c[p] * n[lang] // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-score, -c[p], " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        out += [(lang, rank, p.decode(), -a, l, r, n[lang], -score) for rank, (score, a, p, l, r) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out)


def phrases(spark, rows, least, top=2000):
    docs = spark.createDataFrame([(k, t, l, None) for k, (l, t) in enumerate(rows)], DOCS)
    for name in ("n", "phrase", "bucket", "a", "rank"):
        docs = docs.withColumn(name, F.lit("other"))
    return sorted(tuple(r) for r in collocations.mine(docs, least, top).collect())


def made_up(seed, count):
    rnd = random.Random(seed)
    vocabulary = ["a", "b", "a\x01", "\x00", "\x01", "B", "é", "\x02c", "ab", "☃"]
    out = []
    for _ in range(count):
        words = [rnd.choice(vocabulary[: rnd.choice([2, 4, 10])]) for _ in range(rnd.randint(0, 30))]
        out.append((rnd.choice(["en", "fr", None, "und"]), "".join(w + rnd.choice([" ", " ", "  ", "\t", ", ", "\n", "!"]) for w in words)))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_phrases_equal_brute_force(spark, seed, monkeypatch):
    rows = made_up(seed, 300)
    monkeypatch.setattr(collocations, "A_TASK", 60)  # many cuts through the count stream
    assert phrases(spark, rows, 5) == brute_phrases(rows, 5, 2000)
    assert phrases(spark, rows, 8, 7) == brute_phrases(rows, 8, 7)


def test_one_word_or_line_may_be_most_of_all(spark, monkeypatch):
    monkeypatch.setattr(collocations, "A_TASK", 20)
    rows = [("en", "w w w w w w w " * 50), ("en", "this line is everywhere, and this one too\n" * 200)] + made_up(3, 100)
    rows += [("en", f"w x{k % 9} y{k % 5} z{k % 3}") for k in range(400)]
    assert phrases(spark, rows, 20) == brute_phrases(rows, 20, 2000)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["a", "b", "ab", "é"]), min_size=1, max_size=5), min_size=1, max_size=30), st.integers(1, 5), st.integers(1, 6), st.integers(0, 30))
def test_streams_count_alike_wherever_they_are_cut(windows, least, size, cut):
    ordered = sorted((collocations.JOIN.join(w) for w in windows), key=str.encode)
    expected = Counter()
    for window in ordered:
        parts = window.split(collocations.JOIN)
        expected.update(collocations.JOIN.join(parts[:k]) for k in range(1, len(parts) + 1))
    found = Counter()
    for part in (ordered[:cut], ordered[cut:]):  # two tasks
        stream = collocations.Stream(least)
        for low in range(0, len(part), size):
            some = part[low : low + size]
            for _, phrase, n in stream.feed("en", pa.array(some, pa.large_string()), np.ones(len(some), np.int64)):
                found[phrase] += n
        for _, phrase, n in stream.close():
            found[phrase] += n
    assert {p: n for p, n in found.items() if n >= least} == {p: n for p, n in expected.items() if n >= least}


def test_phrases_of_awkward_rows(spark):
    rows = [("en", None), (None, ""), ("en", " \t.,"), (None, "one two"), (None, "One TWO"), ("x", "one"), ("en", "k " * 30_000)]
    assert phrases(spark, rows, 2) == brute_phrases(rows, 2, 2000)
    assert phrases(spark, [], 2) == [] and phrases(spark, [(None, None)], 2) == []
