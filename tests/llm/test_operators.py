"""Operators against brute force, exact round trips and held-out labels, and on awkward rows."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import oracle
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from atlaslens.llm import (
    chat, common, components, html_blocks, mixing, ngram_join, packing, pii, quality, queries, rpforest, rules, sharding, texthash,
)

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty and wordless texts, a very long one, ties, repeated rows, and columns whose names clash."""
    long_text = " ".join(f"w{k % 977}x{k}" for k in range(60_000))
    rows = [
        (1, None, None, None, None), (2, "", "en", "a", 0), (3, " \t\n ", "en", "a", 4), (4, "one two", "en", "a", 7), (5, "one two", "en", None, 7),
        (None, "one two", "en", "b", 7), (None, None, None, None, None), (6, long_text, "de", "b", len(long_text)), (7, long_text + " end", None, "", 1),
        (8, "mail x@y.zz now", "en", "a", None), (8, "mail x@y.zz now", "en", "a", None), (9, "ONE Two", "en", "c", 7), (10, "é # ü | é", "fr", "c", 9),
    ]
    df = spark.createDataFrame(rows, DOCS)
    for name in ("score", "label", "key", "n", "size", "shard", "candidates", "kind", "copies", "rank", "base"):
        df = df.withColumn(name, F.lit("other"))
    return df


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_matches_sql(name, spark, sf_dir):
    df = queries.QUERIES[name](spark, sf_dir)
    assert oracle.differences(oracle.connect(sf_dir), queries.ORACLES[name], df) is None


# Hashes of words and shingles.


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("aAbé \n\t", max_size=40), min_size=1, max_size=6))
def test_shingles_are_those_of_each_text_alone(batch):
    together = [s for _, data, at in common.text_blocks(pa.array(batch), 30) for s in _sets(data, at)]
    for text, found in zip(batch, together):
        words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text))
        expected = {tuple(words[k : k + 5]) for k in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} - {()}
        assert len(found) == len(expected)
        (alone,) = [s for _, data, at in common.text_blocks(pa.array([text])) for s in _sets(data, at)]
        assert (alone == found).all()


def _sets(data, at):
    values, bounds = texthash.shingle_sets(data, at, 5)
    return [values[i:j] for i, j in zip(bounds[:-1], bounds[1:])]


# 1 Quality.


def test_quality_on_labels_it_has_not_seen(spark, sf_dir, docs):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = quality.predict(docs, labels).join(labels, "doc_id").where("held_out").select("quality", "predicted", "doc_id").collect()
    assert len(rows) > 50 and all(zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in rows)
    assert np.mean([r.quality == r.predicted for r in rows]) > 0.95


def test_quality_of_odd_rows(spark, odd, nothing, sf_dir, docs):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.train(docs, labels)
    rows = quality.score(odd, model).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    assert quality.score(nothing, model).count() == 0
    assert {r.score for r in quality.score(odd, quality.train(docs, labels.limit(0))).collect()} == {0.5}
    assert quality.keep(odd, model).columns == odd.columns


def test_votes_are_those_of_all_cosines(docs):
    block = pa.array([r.text for r in docs.limit(300).collect()])
    counts = np.vstack([quality.term_counts(data, at) for _, data, at in common.text_blocks(block)])
    labels = np.arange(200) % 2
    model = quality.fit(counts[:200], labels, 0.5)
    cosine = model.reduce(counts[200:]) @ model.vectors.T
    for row, score in zip(cosine, model.score(counts[200:])):
        near = np.argsort(-row, kind="stable")[: quality.NEIGHBOURS]
        weight = np.maximum(row[near], 0).astype(float) ** quality.SHARPNESS
        assert score == pytest.approx(((weight * labels[near]).sum() + 0.005) / (weight.sum() + 0.01), abs=1e-4)


# 2 Sharding.


def test_shards_fit_and_only_large_buckets_are_split(odd, nothing):
    limit = 400
    rows = sharding.shard(odd, limit).collect()
    assert len(rows) == odd.count()
    sums = Counter()
    for r in rows:
        sums[r.shard] += r.n_bytes
    for r in rows:
        assert sums[r.shard] == r.shard_bytes and len(r.shard) == r.depth and (r.shard_bytes <= limit or r.shard_documents == 1)
        if r.depth:  # the bucket one bit up was too large
            assert sum(x.n_bytes for x in rows if x.shard.startswith(r.shard[:-1])) > limit
    assert sharding.shard(nothing, limit).count() == 0


def test_a_repeated_row_is_split_too(spark):
    rows = sharding.shard(spark.createDataFrame([(1, "x" * 100)] * 60, "doc_id long, text string"), 300).collect()
    assert len(rows) == 60 and all(r.shard_bytes <= 300 for r in rows)


# 3 Mixing.


def test_mix_of_odd_rows(odd, nothing):
    plan = mixing.plan_mix(odd, block_words=8)
    rows = mixing.mixed_counts(plan).collect()
    assert len(rows) == odd.count()
    assert all(0 <= r.taken <= 2 * r["size"] and r.target <= 2 * r.source_size for r in rows)
    assert sum(r.taken for r in rows) == pytest.approx(1.5 * sum(r["size"] for r in rows), abs=60)
    mixed = mixing.mixed_documents(odd, plan)
    assert mixed.columns == odd.columns
    words = Counter()
    for r in mixed.collect():
        words[r.doc_id] += len(WORD.findall(r.text or ""))
    taken = Counter()
    for r in rows:
        taken[r.doc_id] += r.taken
    assert +words == +taken
    assert mixing.mixed_counts(mixing.plan_mix(nothing)).count() == 0


def test_seats_go_one_by_one_to_the_highest_quotients(spark):
    rng = random.Random(5)
    for seats in (1, 7, 100):
        votes = [(f"p{k:02}", float(rng.choice([0, 1, 5, 50, 900]))) for k in range(15)]
        won = Counter()
        for _ in range(seats if any(v for _, v in votes) else 0):
            won[max((v for v in votes if v[1]), key=lambda v: (v[1] / (2 * won[v[0]] + 1), [-ord(c) for c in v[0]]))[0]] += 1
        df = spark.createDataFrame([(p, v, seats) for p, v in votes], "party string, votes double, seats long")
        found = {r.party: r.won for r in mixing.apportion(df, [], "votes", "seats", ["party"], "won").collect()}
        assert found == {p: won[p] for p, _ in votes}


# 4 Packing.


def test_pieces_lie_side_by_side_and_decode_to_the_texts(docs, odd, nothing):
    enc = packing.encoder(packing.default_tokenizer())
    for df in (docs.limit(200), odd):
        rows = packing.pack_documents(df, with_ids=True).collect()
        expected = Counter()
        for r in df.collect():
            ids = enc.whole.encode(r.text or "", add_special_tokens=False).ids + [packing.END_ID]
            for k, (start, length) in enumerate(packing.cuts(len(ids), packing.CAPACITY)):
                expected[r.doc_id, k, start, tuple(ids[start : start + length])] += 1
        assert Counter((r.doc_id, r.piece, r.start, tuple(r.ids)) for r in rows) == expected
        by_sequence = {}
        for r in rows:
            assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) and r.length == len(r.ids)
            by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
        for parts in by_sequence.values():
            at = 0
            for offset, length in sorted(parts):
                assert offset == at
                at += length
            assert at <= packing.CAPACITY
    assert packing.pack_documents(nothing).count() == 0


def test_special_strings_and_long_runs_have_the_tokenizers_ids():
    enc = packing.encoder(packing.default_tokenizer())
    for text in ("a<|endoftext|>b", " " * 5000 + "x", "aaaa" * 3000, "é​\U0001f600 \r\n\t x", "12345 '... don't"):
        assert enc.ids(text) == enc.whole.encode(text, add_special_tokens=False).ids


def _fewest(lengths, capacity):
    """The fewest sequences, by trying everything."""
    best = len(lengths)

    def put(k, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if k == len(lengths):
            best = len(bins)
            return
        for i in range(len(bins)):
            if bins[i] >= lengths[k] and bins[i] not in bins[:i]:
                put(k + 1, [*bins[:i], bins[i] - lengths[k], *bins[i + 1 :]])
        put(k + 1, [*bins, capacity - lengths[k]])

    put(0, [])
    return best


def test_plans_are_whole_and_as_good_as_trying_everything():
    rng = random.Random(3)
    for _ in range(60):
        lengths = sorted((rng.randint(1, 20) for _ in range(rng.randint(1, 9))), reverse=True)
        chosen = packing.plan(dict(Counter(lengths)), 20)
        assert Counter(v for fill, n in chosen for _ in range(n) for v in fill) == Counter(lengths)
        assert all(sum(fill) <= 20 for fill, _ in chosen)
        assert sum(n for _, n in chosen) == _fewest(lengths, 20)


# 5 Near duplicates.


def _jaccard_components(texts):
    sets = {}
    for doc_id, text in texts.items():
        words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[doc_id] = {tuple(words[k : k + 5]) for k in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} - {()}
    parent = {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    where = {}
    for d, own in sets.items():
        shared = Counter(e for s in own for e in where.get(s, ()))
        for e, n in shared.items():
            if 100 * n >= 75 * (len(own) + len(sets[e]) - n):
                a, b = root(d), root(e)
                parent[max(a, b)] = min(a, b)
        for s in own:
            where.setdefault(s, []).append(d)
    return {d: (len(s), root(d)) for d, s in sets.items()}


def _found(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(df).collect()}


def test_components_are_those_of_all_pairs(docs, texts):
    assert _found(docs) == _jaccard_components(texts)


def test_chains_of_near_copies_and_common_passages(spark, monkeypatch):
    rng = random.Random(11)
    passage = " ".join(f"p{k}" for k in range(60))
    base = [f"b{k}" for k in range(80)]
    texts = {}
    for k in range(120):  # neighbours of the chain link, its ends do not
        texts[len(texts)] = " ".join(base)
        base = [*base[3:], *(f"n{k}x{j}" for j in range(3))]
    for k in range(150):  # the same passage in unlike texts
        texts[len(texts)] = " ".join([*(f"q{k}y{j}" for j in range(60)), passage])
    for k in range(100):  # many copies with a word changed
        words = [f"c{j}" for j in range(90)]
        words[rng.randrange(90)] = f"z{k}"
        texts[len(texts)] = " ".join(words)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(7)
    monkeypatch.setattr(ngram_join, "CHUNK", 8)  # trees of many chunks
    monkeypatch.setattr(ngram_join, "STAR", 5)
    monkeypatch.setattr(ngram_join, "BROADCAST_KEYS", 0)
    assert _found(df) == _jaccard_components(texts)


def test_leaders_across_batches(spark):
    rng = random.Random(2)
    rows = [(rng.randrange(40), rng.randrange(500)) for _ in range(900)] + [(99, 1)]
    df = spark.createDataFrame(rows, "shingle long, key long").repartition(3)
    groups = {}
    for s, k in rows:
        groups.setdefault(s, []).append(k)
    expected = Counter((s, k, min(ks)) for s, ks in groups.items() if len(ks) > 1 for k in ks)
    assert Counter(tuple(r) for r in ngram_join.with_leaders(df).collect()) == expected


def test_one_document_of_each_group_stays(odd, nothing):
    kept = ngram_join.keep_one(odd)
    assert kept.columns == odd.columns
    ids = Counter((r.doc_id, r.text) for r in kept.collect())
    long_ones = [d for d, t in ids if t and len(t) > 1000]
    assert long_ones == [6] and ids[8, "mail x@y.zz now"] == 1 and ids[4, "one two"] == 1
    assert (5, "one two") not in ids and (None, "one two") not in ids and (9, "ONE Two") not in ids
    assert ids[1, None] == ids[2, ""] == ids[None, None] == ids[3, " \t\n "] == 1
    assert ngram_join.keep_one(nothing).count() == 0


def test_the_bound_never_rules_out_a_link():
    rng = np.random.default_rng(1)
    for _ in range(300):
        n = int(rng.integers(1, 400))
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        b = np.unique(np.concatenate((a[: int(len(a) * rng.random())], rng.integers(0, 2**63, int(rng.integers(1, 90))).astype(np.uint64))))
        points = [ngram_join.point(s, ngram_join.finest(len(s))) for s in (a, b)]
        if ngram_join.linked(a, b):
            assert ngram_join.may_link(len(a), points[0], len(b), points[1])


@pytest.mark.parametrize("one_task", [0, 10_000])
def test_components_of_random_graphs(spark, monkeypatch, one_task):
    monkeypatch.setattr(components, "ONE_TASK", one_task)
    rng = random.Random(4)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(k, k + 1) for k in range(400, 460)]
    parent = {n: n for link in links for n in link}

    def root(n):
        return n if parent[n] == n else root(parent[n])

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    df = spark.createDataFrame(links, "a long, b long")
    found = {r.node: r.component for r in components.connected_components(df).collect()}
    assert found == {n: root(n) for a, b in links if a != b for n in (a, b)}


# 6 Chat.


@settings(max_examples=80, deadline=None)
@given(st.text(st.sampled_from(list("</s>[]INROLE\\ \na")), max_size=40))
def test_escape_leaves_no_control_string_and_can_be_undone(text):
    template = chat.Template()
    guarded = re.compile(template.guarded)
    escaped = guarded.sub(lambda m: m[1] + m[2] + "\\" + m[3], text)
    assert not any(c in escaped for c in template.control)
    assert re.sub(template.guarded.replace(r"(\\*)", r"\\(\\*)"), lambda m: m[1] + m[2] + m[3], escaped) == text


def test_conversations_read_back_as_they_were(spark):
    rows = [
        (1, 0, "system", "<s>\\[INST]"), (1, 1, "user", "</s>[/ROLE]"), (1, 2, "assistant", "<\\/s> [\\\\ROLE]"), (2, 0, "assistant", "first"), (2, 0, "assistant", "first"),
        (3, None, None, None), (3, 1, "</s>", ""), (None, 0, "user", "lost"), (4, 1, "assistant", "b"), (4, 0, "user", "a"), (5, 0, "user", "x" * 100_000),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit(1)).withColumn("segments", F.lit(1))
    formatted = chat.format_conversations(df)
    found = {r.conv_id: r for r in chat.read_back(formatted).collect()}
    assert [(t.role, t.text) for t in found[1].turns] == [(r, t) for c, _, r, t in rows if c == 1]
    assert found[1].loss_text == rows[2][3] and found[2].loss_text == "firstfirst" and found[3].loss_text == ""
    assert [(t.role, t.text) for t in found[3].turns] == [("", ""), ("</s>", "")] and [t.text for t in found[4].turns] == ["a", "b"]
    assert found[None].turns[0].text == "lost" and len(found[5].turns[0].text) == 100_000
    state = {r.conv_id: (r.in_order, r.complete) for r in formatted.collect()}
    assert state[1] == (True, True) and state[2] == (False, False) and state[5] == (True, False) and state[4] == (True, True)
    assert chat.digests(chat.read_back(chat.format_conversations(df.limit(0)))).count() == 0


# 7 Personal data.

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _base(text):
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            doubled = sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(reversed(digits)))
            good = {
                "email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in m[0].split(".")),
                "card": 13 <= len(digits) <= 19 and doubled % 10 == 0, "phone": 9 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((kind, m.start(), m.end()))
    return out


def _spans(df):
    found = pii.find(df).select("doc_id", pii.listed(F.col("base")).alias("base"), pii.listed(F.col("spans")).alias("spans")).collect()
    return [(r.doc_id, r.base, r.spans) for r in found]


def test_base_spans_are_those_of_the_rules(spark, docs, texts):
    rng = random.Random(8)
    made = {
        -k - 1: "".join(rng.choice(["a", "é", "@", ".", "-", " ", "+", "1", "4", "12", "255", "(", ")", "_", "\U0001f600", "4111 1111 1111 1111", "\n"])
                        for _ in range(rng.randint(0, 40))) for k in range(600)
    }
    both = docs.select("doc_id", "text").unionByName(spark.createDataFrame(list(made.items()), "doc_id long, text string"))
    for doc_id, base, spans in _spans(both):
        expected = ",".join(f"{k}:{i}:{j}" for k, i, j in _base(texts.get(doc_id, made.get(doc_id))))
        assert base == expected
        assert set(base.split(",")) - {""} <= set(spans.split(","))


def test_personal_data_in_long_and_odd_texts(spark, odd, nothing):
    hard = ["1" * 60_000, "1 " * 30_000, "a" * 80_000, "a.b@" * 20_000, "1.2.3." * 10_000, "+1 " * 20_000, "x@y." * 10_000]
    df = spark.createDataFrame(list(enumerate(hard)), "doc_id long, text string")
    for doc_id, base, _ in _spans(df):
        assert base == ",".join(f"{k}:{i}:{j}" for k, i, j in _base(hard[doc_id]))
    assert len(_spans(odd)) == odd.count() and _spans(nothing) == []
    redacted = {r.doc_id: r for r in pii.redact(odd).collect()}
    assert redacted[8].text == "mail [EMAIL] now" and redacted[1].text is None and redacted[4].n_chars == 7
    assert pii.redact(odd).columns == odd.columns


def test_trees_follow_the_check_and_leave_the_unlikely_alone():
    check = 1 << pii.FEATURES.index("check")
    masks = np.array([1 | check, 2, 2 | check, 4, 4 | check | 64, 8 | 512])
    good = np.where(masks & check, 50, 0)
    model = pii.fit(masks, good, 50 - good)
    assert 0.5 <= model.threshold < 1 and len(model.trees) == pii.TREES
    assert pii.fit(masks, good * 0, good) is None


def test_trees_go_by_format_and_context_and_not_by_their_own_label():
    check, keyword = (1 << pii.FEATURES.index(name) for name in ("check", "keyword"))
    rng = np.random.default_rng(9)
    masks = np.unique(rng.integers(0, 1 << len(pii.FEATURES), 3_000)) & ~check
    sure = np.where(masks & keyword, 99, 10)
    both = np.concatenate((masks | check, masks))
    model = pii.fit(both, np.concatenate((sure, 0 * sure)), np.concatenate((0 * sure, 100 - sure)))
    used = {f for top, *sides in model.trees for f in (top, *(side[0] for side in sides))}
    assert pii.FEATURES.index("check") not in used and pii.FEATURES.index("keyword") in used
    p = model.scores(both)
    assert np.allclose(p[: len(masks)], p[len(masks) :]) and p[both & keyword != 0].min() > 0.9 > 0.3 > p[both & keyword == 0].max()


def test_the_threshold_is_that_of_masks_the_trees_have_not_seen():
    # Each mask has a mind of its own: trees can learn the given ones, and that says nothing about others.
    card, spaced, keyword = (1 << pii.FEATURES.index(name) for name in ("card", "spaced", "keyword"))
    masks = np.array([card, card | spaced, card | keyword, card | spaced | keyword])
    good = np.array([100, 0, 0, 100])
    assert pii.fit(masks, good, 100 - good).threshold < 1
    assert pii.calibrate(masks, good, 100 - good) > 1


def test_numbers_that_only_look_alike_need_context(spark):
    # Strict forms in context are good; those without are too short, as part numbers are.
    rng = random.Random(4)
    number = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    rows = []
    for _ in range(60):
        for word in ("call ", "phone: ", "mobile "):
            rows += [f"{word}+49 {number(3)} {number(7)} now", f"{word}+1 ({number(3)}) {number(3)} {number(4)}", f"{word}+4{number(8)}", f"x{word}+1 {number(9)}"]
        for word in ("part ", "lot ", "rev. "):
            rows += [f"{word}+49 {number(3)} now", f"{word}+1 ({number(3)}) {number(2)}", f"{word}+4{number(3)}", f"{word}+1 {number(4)}"]
    asked = [
        ("call (030) 555-1234 now", "phone:5:19"), ("phone: 555 123 4567", "phone:7:19"), ("part (030) 555-1234 in", ""), ("lot 555 123 4567", ""),
        ("host 300[.]1[.]1[.]1", ""),
    ]
    df = spark.createDataFrame([(k, t) for k, t in enumerate([a for a, _ in asked] + rows)], "doc_id long, text string")
    found = {doc_id: spans for doc_id, _, spans in _spans(df)}
    assert [found[k] for k in range(len(asked))] == [spans for _, spans in asked]


# 8 Rules.


def test_measures_are_those_of_the_text_alone(docs, texts, odd):
    rows = {r.doc_id: r for r in rules.measures(docs).collect()}
    for doc_id, text in texts.items():
        words = WORD.findall(text)
        spans = Counter(zip(words, words[1:], words[2:]))
        repeated = {k + j for k in range(len(words) - 2) if spans[tuple(words[k : k + 3])] > 1 for j in range(3)}
        lines = [line for line in text.split("\n") if WORD.search(line)]
        r = rows[doc_id]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.n_lines, r.n_distinct) == (
            len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated), len(lines), len(set(words))
        )


def test_rules_keep_the_good_and_drop_the_bad(spark, sf_dir, docs, odd, nothing):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = rules.score(docs).join(labels, "doc_id").where("NOT base_failed").select("kept", "quality").collect()
    assert np.mean([r.kept for r in rows if r.quality == 1]) > 0.98
    assert np.mean([r.kept for r in rows if r.quality == 0]) < 0.1
    found = rules.score(odd).collect()
    assert len(found) == odd.count() and {r.base_failed for r in found if r.n_words < 50} == {True}
    assert rules.score(nothing).count() == 0


# 9 Vectors.


def test_forest_finds_the_links_of_all_pairs(spark):
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(60, 24))
    vectors = [c + rng.normal(size=24) * s for c in centres for s in (0.05, 0.1, 0.2, 0.3)] + list(rng.normal(size=(2500, 24)))
    vectors = [v.astype(np.float32) for v in vectors]
    vectors += [vectors[0]] * 3 + [vectors[0] * 2]
    rows = [(k, v.tolist()) for k, v in enumerate(vectors)]
    bad = [(9000, None), (9001, [0.0] * 24), (9002, [float("nan")] * 24), (9003, [None] * 24), (9004, []), (9005, [float("inf")] + [1.0] * 23), (9006, [1.0, 2.0]), (9006, [1.0, 2.0])]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>").withColumn("key", F.lit(1)).withColumn("label", F.lit(None).cast("int"))
    unit = np.array(vectors, dtype=float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.9
    found = rpforest.near_duplicates(df).collect()
    assert len(found) == len(rows) + len(bad)
    by_id = {r.vec_id: r for r in found if r.vec_id < 9000}
    links = near.sum(1) - 1
    assert all(by_id[k].n_links <= links[k] for k in by_id)
    assert sum(r.n_links for r in by_id.values()) >= 0.97 * links.sum()
    assert {(r.vec_id, r.n_links, r.component_id, r.kept) for r in found if 9000 <= r.vec_id < 9006} == {(k, 0, k, True) for k in range(9000, 9006)}
    assert [r.n_links for r in found if r.vec_id == 9006] == [1, 1]
    assert rpforest.near_duplicates(df.limit(0)).count() == 0


def test_large_leaves_are_compared_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(rpforest, "CHUNK", 7)
    rng = np.random.default_rng(7)
    vectors = (np.ones(8) + rng.normal(size=(90, 8)) * 0.05).astype(np.float32)
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(vectors)], "vec_id long, embedding array<float>")
    unit = vectors.astype(float) / np.linalg.norm(vectors.astype(float), axis=1, keepdims=True)
    links = (unit @ unit.T >= 0.9).sum(1) - 1
    assert {r.vec_id: r.n_links for r in rpforest.near_duplicates(df).collect()} == dict(enumerate(links))


def test_deep_forests_miss_no_more_links_of_a_loose_group():
    # A third of the vectors are one group of unlike near copies, at the depth of some 6.5 million vectors.
    rng = np.random.default_rng(1)
    n, width = 1 << 14, 64
    centre = rpforest.unit(rng.normal(size=(1, width)))
    hot = centre + rng.normal(size=(n // 3, width)) * np.sqrt((1 / 0.905 - 1) / width)
    vectors = rpforest.unit(np.concatenate((hot, rng.normal(size=(n - len(hot), width)))))
    forest = rpforest.fit(vectors, n, leaf=1)
    assert {len(tree.directions) for tree in forest} == {14}
    some = vectors[:150]
    links = np.triu(some @ some.T >= 0.9, 1)
    found = np.zeros_like(links)
    for tree in forest:
        rows, leaves = tree.leaves(some)
        names, at = np.unique(leaves, return_inverse=True)
        inside = np.zeros((len(some), len(names)), np.float32)
        inside[rows, at] = 1
        found |= inside @ inside.T > 0
    recall = (found & links).sum() / links.sum()
    print("recall", recall, "of", links.sum(), "links with", len(forest), "trees")
    assert recall >= 0.98


def test_rounds_of_a_large_forest_are_united(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(150, 8))
    vectors = np.concatenate([centres + rng.normal(size=centres.shape) * 0.05 for _ in range(8)]).astype(np.float32)
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(vectors)], "vec_id long, embedding array<float>")
    unit = rpforest.unit(vectors.astype(float))
    links = (unit @ unit.T >= 0.9).sum(1) - 1
    found = {r.vec_id: r.n_links for r in rpforest.near_duplicates(df, trees=25).collect()}
    assert sum(found.values()) >= 0.99 * links.sum() and all(found[k] <= n for k, n in enumerate(links))


def test_a_deep_forest_counts_every_pair_once(spark, monkeypatch):
    # The whole operator, leaves aimed at 4 vectors (depth 9): a third is one loose group, besides exact and near copies.
    monkeypatch.setattr(rpforest, "LEAF", 4)
    rng = np.random.default_rng(11)
    width, n = 64, 2_000
    centre = rpforest.unit(rng.normal(size=(1, width)))
    hot = centre + rng.normal(size=(n // 3, width)) * np.sqrt((1 / 0.905 - 1) / width)
    rest = rng.normal(size=(n - len(hot) - 60, width))
    vectors = np.concatenate((hot, rest, rest[:30], rest[30:60] + rng.normal(size=(30, width)) * 0.1)).astype(np.float32)
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(vectors)], "vec_id long, embedding array<float>").repartition(7)
    unit = rpforest.unit(vectors.astype(float))
    links = (unit @ unit.T >= 0.9).sum(1) - 1
    found = {r.vec_id: r.n_links for r in rpforest.near_duplicates(df).collect()}
    recall = sum(found.values()) / links.sum()
    print("recall", recall, "of", links.sum() // 2, "links")
    assert all(found[k] <= count for k, count in enumerate(links)) and recall >= 0.95


def test_spanning_links_hold_the_same_together():
    rng = np.random.default_rng(12)
    near = np.triu(rng.random((200, 200)) < 0.008, 1)
    near |= near.T
    one, two = rpforest.spanning(near.copy())

    def parts(pairs):
        name = list(range(200))
        for _ in range(200):
            for a, b in pairs:
                name[a] = name[b] = min(name[a], name[b])
        return name

    assert near[one, two].all() and len(one) == 200 - len(set(parts(np.argwhere(near).tolist())))
    assert parts(list(zip(one.tolist(), two.tolist()))) == parts(np.argwhere(near).tolist())


def test_leaves_do_not_depend_on_the_batch():
    rng = np.random.default_rng(13)
    vectors = rpforest.unit(rng.normal(size=(700, 64)))
    for tree in rpforest.fit(vectors, 700, trees=3, leaf=2):
        at = lambda rows, leaves: {(int(r), int(k)) for r, k in zip(rows, leaves)}
        whole = at(*tree.leaves(vectors))
        parts = set()
        for low in (*range(0, 600, 13), *range(611, 700)):
            high = min(low + 13, 611) if low < 611 else low + 1
            parts |= {(low + r, k) for r, k in at(*tree.leaves(vectors[low:high]))}
        assert parts == whole


# 10 Pages.


@pytest.fixture(scope="module")
def labeller(spark, sf_dir):
    return html_blocks.train(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def test_made_pages_not_seen_in_training(labeller):
    rng = random.Random(1234)
    right = total = 0
    for _ in range(150):
        source, main = html_blocks.made_page(rng)
        page = html_blocks.blocks(source)
        right += int(((labeller.probabilities(html_blocks.features(page)) >= 0.5) == html_blocks._labels(page, main)).sum())
        total += len(page)
    assert right / total > 0.97


def test_given_pages(spark, sf_dir, labeller):
    import html

    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    rows = html_blocks.extract(pages, labeller).join(pages.select("page_id", "html"), "page_id").collect()
    right = 0
    for r in rows:
        inside = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        right += r.text == " ".join(html.unescape(re.sub(r"<[^>]*>", " ", inside)).split())
        assert r.n_chars == len(r.text)
    assert right / len(rows) > 0.97


def test_odd_pages(spark, labeller):
    rows = [
        (1, None, None), (2, "u", ""), (3, "u", "<article><p>One &amp; two&nbsp; x<p>Three words here."), (3, "u", "<"), (4, "u", "<p" * 50_000),
        (5, "u", "<div>" * 30_000 + "deep"), (6, "u", '<a "' * 50_000 + "'>"), (None, "u", "<article><p>no id</article>"),
    ]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit(1)).withColumn("n_chars", F.lit(1))
    found = html_blocks.extract(df, labeller).collect()
    assert len(found) == len(rows)
    assert [r.text for r in found if r.page_id in (1, 2)] == ["", ""]
    assert [r.text for r in found if r.page_id == 3 and r.text] == ["One & two x Three words here."]
    assert html_blocks.extract(df.limit(0), labeller).count() == 0


def test_windows_of_a_long_page_agree_with_one_run(labeller, monkeypatch):
    page = html_blocks.blocks("<article>" + "".join(f"<p>Some words of text number {k}.</p>" for k in range(300)) + "</article><footer>&copy; x</footer>")
    whole = labeller.probabilities(html_blocks.features(page))
    monkeypatch.setattr(html_blocks, "WINDOW", 80)
    parts = labeller.probabilities(html_blocks.features(page))
    assert len(whole) == len(parts) and ((whole >= 0.5) == (parts >= 0.5)).all()


def test_containers_of_many_unclosed_elements_stay_in_the_path():
    loose = "".join(f"<p><b>Words of text number {k}.<br>" for k in range(100))
    for opening, closing, name in (("<article>", "</article>", "article"), ('<div class="comments">', "</div>", "comments"), ('<div id="footer">', "</div>", "footer")):
        page = html_blocks.blocks(f"<main>{opening}{loose}{closing}<p>After.</main>")
        bucket = html_blocks._bucket(name, html_blocks.PATH_TERMS)
        assert len(page) == 101 and all(html_blocks.features(page)[:100, bucket] == 1)
        assert all({name, "main"} <= b.says for b in page[:100]) and name not in page[100].says


@pytest.mark.parametrize("classes", [
    "flex flex-col items-center px-4 py-2 sidebar", "post-12 post type-post status-publish format-standard related-posts",
    "widget widget_text textwidget-1 clearfix mt-4 comments",
])
def test_the_last_of_many_classes_counts(classes):
    last = classes.split()[-1]
    assert last in html_blocks._marks("div", f' class="{classes}"')
    (block,) = html_blocks.blocks(f'<div class="{classes}">Text.</div>')
    assert html_blocks._bucket(last, html_blocks.PATH_TERMS) in block.path


def test_words_after_the_twelfth_count():
    start = "one two three four five six seven eight nine ten eleven twelve "
    a, b = (html_blocks.features(html_blocks.blocks(f"<div>{start}{rest}</div>"))[0] for rest in ("subscribe newsletter", "mountains afternoon"))
    words = slice(html_blocks.PATH_TERMS, html_blocks.PATH_TERMS + html_blocks.WORD_TERMS)
    assert (a[words] != b[words]).any()
    long = html_blocks.features(html_blocks.blocks("<p>" + "word other " * 100_000))[0]
    assert np.isfinite(long).all() and long[words].max() < 2


def test_windows_carry_their_state(monkeypatch):
    model = html_blocks.Labeller()
    x = np.random.default_rng(2).normal(size=(500, html_blocks.WIDTH)).astype(np.float32)
    whole = model.probabilities(x)
    monkeypatch.setattr(html_blocks, "WINDOW", 48)
    assert np.allclose(model.probabilities(x), whole, atol=1e-5)


def test_all_bytes_of_a_name_and_a_word_count():
    start = "x" * 64
    buckets = {html_blocks._bucket(start + end, html_blocks.PATH_TERMS) for end in ("article", "comments", "nav", "footer", "aside")}
    assert len(buckets) > 1
    a, b = html_blocks.features(html_blocks.blocks(f"<p>{start}one<p>{start}five"))
    assert (a[html_blocks.PATH_TERMS :] != b[html_blocks.PATH_TERMS :]).any()


@pytest.mark.parametrize("source, says", [
    ("<b><article><p>one</b><p>two</article><p>three", [{"article"}, {"article"}, set()]),
    ("<article><b><p>one</b>two</b></article><p>three", [{"article"}, set()]),
    ("<a><div class=comments><span><p>one</a></span><p>two</div><p>three", [{"comments"}, {"comments"}, set()]),
    ("<noscript><div><p>one</noscript><main>two</main>", [{"main"}]),
])
def test_end_tags_of_inline_elements_leave_blocks_open(source, says):
    assert [set(block.says) for block in html_blocks.blocks(source)][: len(says)] == says


def test_features_of_many_pages_are_those_of_each():
    rng = random.Random(3)
    pages = [html_blocks.blocks(html_blocks.made_page(rng)[0]) for _ in range(20)] + [[]]
    for one, page in zip(html_blocks.features_of(pages), pages):
        assert len(one) == len(page) and (one == html_blocks.features(page)).all()
        for x, block in zip(one, page):
            said = block.text.split()
            assert x[-5] == np.float32(np.log1p(len(said)) / 5) and x[-2] == (block.text[-1] in ".!?")
            assert x[-3] == np.float32(sum(w[-1] in ".!?:;," for w in said) / len(said))


def test_long_pages_are_sampled_within_bounds(spark):
    long = "<article>" + "".join(f"<p>Words of text number {k}.</p>" for k in range(2_000)) + "</article><footer>x</footer>"
    df = spark.createDataFrame([(7, long), (8, None), (9, "<p>no label"), (3, "<main>short</main>")], "o long, html string")
    rows = {r.o: r for r in df.mapInArrow(html_blocks._given, "o long, x binary, y binary").collect()}
    assert set(rows) == {7, 3}
    assert len(rows[7].y) == 4 * html_blocks.SAMPLE_BLOCKS and len(rows[7].x) == len(rows[7].y) * html_blocks.WIDTH
    assert np.frombuffer(rows[3].y, np.float32).tolist() == [1]


def test_gradient_of_a_direction():
    rng = np.random.default_rng(8)
    one = html_blocks.Direction(rng)
    one.w = one.w.astype(np.float64)
    x, mask = rng.normal(size=(2, 5, html_blocks.WIDTH)), np.array([[True] * 5, [True] * 3 + [False] * 2])
    pull = rng.normal(size=(2, 5, html_blocks.HIDDEN)) * mask[:, :, None]
    loss = lambda: (one.forward(x, mask, False)[0] * pull).sum()
    d_w, d_b = one.backward(x, mask, one.forward(x, mask, True)[1], pull)
    for k in ((0, 3), (100, 20), (html_blocks.WIDTH + 2, 40), (html_blocks.WIDTH - 1, 60)):
        kept, step = one.w[k], 1e-2
        one.w[k] = kept + step
        up = loss()
        one.w[k] = kept - step
        slope = (up - loss()) / (2 * step)
        one.w[k] = kept
        assert abs(slope - d_w[k]) < 0.02 * max(1, abs(slope))


# Layouts as blogs and news sites write them, laid out here and not by the generator: no article element, telling names among others.
SITES = [
    ('<div id="page" class="site"><div class="site-branding">Daily Herald</div><div class="main-navigation"><a href="/">Home</a> <a href="/w">World</a></div>'
     '<div class="site-content"><div class="entry-content">{}</div><div id="comments" class="comments-area"><div class="comment-body">{}</div></div>'
     '<div class="widget-area sidebar"><div class="widget">{}</div></div></div><div class="site-footer">{}</div></div>'),
    ('<div class="container mx-auto flex"><header class="masthead">{3}</header><div class="col-md-8 post-content">{0}</div>'
     '<div class="col-md-4 sidebar-right related">{2}</div></div><section class="discussion comments-list">{1}</section><footer>{3}</footer>'),
    ('<table><tr><td class="menu"><a href=1>{3}</a></td><td><div id="main-content">{0}</div><div class="advert-box ad">{2}</div></td></tr></table>'
     '<div class="comments">{1}</div>'),
]


def test_sites_without_an_article_element(labeller):
    rng = random.Random(77)
    vocabulary = "river council opened new bridge after years residents said traffic money plan winter school teacher market price story".split()
    sentence = lambda: " ".join(rng.choices(vocabulary, k=rng.randrange(6, 18))).capitalize() + "."
    right = total = 0
    for number in range(90):
        body = [" ".join(sentence() for _ in range(rng.randrange(1, 6))) for _ in range(rng.randrange(2, 9))]
        main = "".join(f"<p>{p}</p>" for p in body)
        notes = "".join(f"<p>{sentence()}</p>" for _ in range(rng.randrange(1, 4)))
        page = html_blocks.blocks("<html><body>" + SITES[number % len(SITES)].format(main, notes, f"<p>{sentence()}</p>", "Copyright Daily Herald"))
        said = labeller.probabilities(html_blocks.features(page)) >= 0.5
        right += sum(bool(s) == (b.text in body) for s, b in zip(said, page))
        total += len(page)
    print("blocks right", right, "of", total)
    assert right / total > 0.9


# The pipeline.


def test_stages_carry_columns_of_any_name(spark, docs, sf_dir):
    names = ("_doc_id", "_mark", "_copies", "_take", "_laps", "_size", "mark", "take", "laps", "row", "new", "own_id", "a.b", "tick`s", "spans", "cut")
    df = docs.unionByName(docs.limit(3))
    for number, name in enumerate(names):
        df = df.withColumn(name, F.lit(number))
    for stage in (corpus_pipeline.judge, corpus_pipeline.deduplicate, corpus_pipeline.redact, corpus_pipeline.mix):
        found = stage(spark, df, sf_dir)
        assert found.columns == df.columns
        rows = found.collect()
        assert rows and all(row[-len(names) :] == tuple(range(len(names))) for row in rows)


def test_pipeline_stages(spark, docs, sf_dir, nothing):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality classifier", "n-gram jaccard join", "pii", "mixing", "best-fit packing"]
    at = docs
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        after = common.stage(stage(spark, at, sf_dir), "test")
        seen[name] = (at, after)
        if name != "best-fit packing":
            assert after.columns == docs.columns and after.schema.simpleString() == docs.schema.simpleString()
        at = after
    judged, single = seen["quality classifier"][1], seen["n-gram jaccard join"][1]
    assert judged.subtract(docs).isEmpty() and 0.8 * docs.count() < judged.count() < docs.count()
    expected = {d for d, (_, c) in _jaccard_components({r.doc_id: r.text for r in judged.collect()}).items() if d == c}
    assert {r.doc_id for r in single.collect()} == expected
    redacted = seen["pii"][1]
    assert redacted.count() == single.count()
    assert not any(_base(r.text) for r in redacted.collect())
    mixed = {}
    for r in seen["mixing"][1].collect():
        mixed[r.doc_id] = mixed.get(r.doc_id, 0) + len(WORD.findall(r.text))
    counts = {r.doc_id: r.taken for r in mixing.mixed_counts(mixing.plan_mix(redacted)).collect() if r.taken}
    assert mixed == counts
    packed = seen["best-fit packing"][1]
    assert packed.select("doc_id").distinct().count() == len(counts)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing, sf_dir).count() == 0
