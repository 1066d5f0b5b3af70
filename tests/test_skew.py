"""Hot keys: a key, spot or text holding most rows, against plain Python."""

from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from atlaslens.functions import geo
from atlaslens.operators import dedupe, paging, resolve, scheduling, spans, stores


@pytest.fixture(scope="module")
def hot_sets():
    """(key, time in us): one key has two thirds of the rows, with runs and gaps."""
    rng = random.Random(7)
    rows = []
    for i in range(6000):
        key = "hot" if i % 3 else f"k{rng.randrange(50)}"
        rows.append((key, rng.randrange(40 * 86_400) * 1_000_000 // 1 + rng.randrange(1_000_000)))
    return rows


@pytest.mark.parametrize("ttl_s", [60, 3600, 86_400])
def test_spans(spark, hot_sets, ttl_s):
    expected, by_key = [], {}
    for key, at in hot_sets:
        by_key.setdefault(key, []).append(at)
    for key, times in by_key.items():
        times.sort()
        run = [times[0]]
        for at in times[1:]:
            if at - run[-1] >= ttl_s * 1_000_000:
                expected.append((key, run[0], run[-1], len(run)))
                run = []
            run.append(at)
        expected.append((key, run[0], run[-1], len(run)))
    df = spark.createDataFrame(hot_sets, "key string, at long")
    assert sorted(map(tuple, spans.alive_spans(df, "key", "at", ttl_s).collect())) == sorted(expected)


def test_first_and_latest_per_key(spark, hot_sets):
    df = spark.createDataFrame([(k, at, i) for i, (k, at) in enumerate(hot_sets)], "key string, at long, i int")
    first, last = {}, {}
    for i, (key, at) in enumerate(hot_sets):
        first[key] = min(first.get(key, (at, i)), (at, i))
        last[key] = max(last.get(key, (at, i)), (at, i))
    firsts = dedupe.first_per_key(df, ["key"], [F.col("at"), F.col("i")])
    assert {r.key: (r.at, r.i) for r in firsts.collect()} == first
    lasts = dedupe.latest_values(df, ["key"], ["at", "i"], ["at", "i"])
    assert {r.key: (r.at, r.i) for r in lasts.collect()} == last


def test_pages_of_a_hot_place_are_folded_before_the_window(spark):
    rng = random.Random(3)
    rows = [("hot", "en", rng.randrange(400), rng.randrange(1000)) for _ in range(20_000)]
    rows += [(f"p{rng.randrange(20)}", "en", rng.randrange(30), rng.randrange(1000)) for _ in range(2_000)]
    df = spark.createDataFrame(rows, "place_id string, language string, page_number int, age int").withColumn(
        "review_date", F.date_sub(F.to_date(F.lit("2024-01-01")), F.col("age")))
    pages = paging.page_age_range(df).withColumn("is_stop", F.col("newest") < F.to_date(F.lit("2023-12-20")))
    newest = {}
    for place, _, page, age in rows:
        newest[place, page] = min(newest.get((place, page), 10**6), age)
    expected = set()
    for place in {p for p, _ in newest}:
        for page in sorted(n for p, n in newest if p == place and n < 200):
            expected.add((place, page))
            if newest[place, page] > 12:
                break
    kept = paging.take_until_stop(pages)
    assert {(r.place_id, r.page_number) for r in kept.collect()} == expected


def mercator(lat, lng, level):
    import math
    side = 2**level
    x = int((lng + 180) / 360 * side)
    r = math.radians(lat)
    return x, int((1 - math.log(math.tan(r) + 1 / math.cos(r)) / math.pi) / 2 * side)


@pytest.mark.parametrize("spread", [0.0, 0.01, 0.3])
def test_one_name_in_one_spot(spark, spread):
    """Two thirds of entries and places share a name; with no spread they share a point too."""
    rng = random.Random(11)

    def point():
        return 40.4 + rng.random() * spread, -3.7 + rng.random() * spread

    names = lambda i: "Chain" if i % 3 else f"Bar {i % 7}"
    places = [(f"p{i:05d}", names(i), *point()) for i in range(900)]
    entries = [(i, names(i), *point()) for i in range(900)] + [(900, "Nowhere", 40.4, -3.7), (901, None, 40.4, -3.7), (902, "Chain", None, -3.7)]
    got = resolve.nearest_by_name(
        spark.createDataFrame(entries, "id int, name string, lat double, lng double"),
        spark.createDataFrame(places, "place_id string, name string, lat double, lng double"))
    found = {r.id: (r.distance_mm, r.place_id) for r in got.collect()}
    for i, name, lat, lng in entries:
        if lat is None or name is None:
            assert found[i] == (None, None)
            continue
        x, y = mercator(lat, lng, geo.COARSE_LEVEL)
        near = [(millimetres(lat, lng, plat, plng), p) for p, n, plat, plng in places
                if n == name and all(abs(a - b) <= 1 for a, b in zip((x, y), mercator(plat, plng, geo.COARSE_LEVEL)))]
        assert found[i] == (min(near) if near else (None, None))
    assert len(found) == len(entries)


def millimetres(lat, lng, plat, plng):
    import math
    a, b = math.radians(lat), math.radians(plat)
    chord = math.sin((b - a) / 2) ** 2 + math.cos(a) * math.cos(b) * math.sin(math.radians(plng - lng) / 2) ** 2
    return math.floor(2 * 6371008.8 * math.asin(math.sqrt(chord)) * 1000 + 0.5)


def test_nearest_beats_smallest_id_and_the_date_line_is_no_border(spark):
    places = [("a", "X", 10.0010, 20.0), ("z", "X", 10.00001, 20.0), ("w", "Y", -17.0, 179.9999), ("v", "Y", -17.0, 179.0)]
    entries = [(1, "X", 10.0, 20.0), (2, "Y", -17.0, -179.9999)]
    got = resolve.nearest_by_name(
        spark.createDataFrame(entries, "id int, name string, lat double, lng double"),
        spark.createDataFrame(places, "place_id string, name string, lat double, lng double"))
    assert {r.id: r.place_id for r in got.collect()} == {1: "z", 2: "w"}


def test_many_copies_of_one_text(spark):
    batch = [("same" if i % 3 else f"t{i % 100}", i) for i in range(3000)]
    df = spark.createDataFrame(batch, "id string, n int")
    store = spark.createDataFrame([("t0",), ("other",), (None,)], "id string")
    new = stores.insert_ignore(df, store, "id", F.col("n"))
    expected = {}
    for key, n in batch:
        expected[key] = min(n, expected.get(key, n))
    expected.pop("t0")
    assert {r.id: r.n for r in new.collect()} == expected
    assert stores.without_key(df.union(spark.createDataFrame([(None, 1)], "id string, n int")), "id").count() == 1
    # Adding the same batch again adds nothing.
    assert stores.insert_ignore(df, store.union(new.select("id")), "id", F.col("n")).count() == 0


def test_set_union_of_a_hot_place(spark):
    incoming = [("hot" if i % 3 else f"p{i % 20}", f"q{i % 11}") for i in range(3000)]
    store = spark.createDataFrame([("hot", ["q3", "old"]), ("gone", ["q1"])], "place_id string, all_queries array<string>")
    df = spark.createDataFrame(incoming, "place_id string, query string")
    merged = stores.upsert_set(store, df, "place_id", "all_queries", "query")
    expected = {"hot": {"q3", "old"}, "gone": {"q1"}}
    for place, query in incoming:
        expected.setdefault(place, set()).add(query)
    rows = {r.place_id: r.all_queries for r in merged.collect()}
    assert rows == {place: sorted(queries) for place, queries in expected.items()}
    again = stores.upsert_set(merged, df, "place_id", "all_queries", "query")
    assert {r.place_id: r.all_queries for r in again.collect()} == rows


@pytest.mark.parametrize("digits", [1, 4])
def test_slots_cover_the_day_evenly(spark, digits):
    keys = spark.range(0, 997).union(spark.range(0, 500))
    rows = scheduling.even_slots(keys, "id", digits=digits).collect()
    order = sorted(range(997), key=lambda i: hashlib.sha256(f"10_{i}".encode()).hexdigest())
    assert {r.id: r.position for r in rows} == {key: i for i, key in enumerate(order)}
    assert all(abs(r.slot - r.position / 997 * 24) <= 0.0500001 for r in rows)
