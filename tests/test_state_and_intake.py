"""Keys that expire or are deleted, in batch and in any number of stream batches; aborts; id requests; ranks; searched cells."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from atlaslens.functions import geo
from atlaslens.operators import keyed_store, places as pl, scheduling, spans, stores
from atlaslens.operators.keyed_store import KeyedStore
from atlaslens.plans import flows
from atlaslens.session import work_dir
from atlaslens.sources.requests import check_id_requests
from atlaslens.streaming import jobs

WRITE = "key string, set_at long, ttl_s long, value string"
SECOND = 1_000_000


@pytest.fixture
def folder(spark):
    return work_dir(spark, "test")


def replay(writes, now):
    """What a key-value server holds after all writes, in order of time."""
    last = {}
    for key, at, ttl, value in writes:
        order = (at, ttl is not None, ttl or 0, value)
        if key not in last or order > last[key][0]:
            last[key] = order, (at, ttl, value)
    return {(k, at, (at + ttl * SECOND - now) // SECOND, v) for k, (_, (at, ttl, v)) in last.items() if ttl is not None and at + ttl * SECOND > now}


def made_up(seed, n):
    rnd = random.Random(seed)
    key = lambda: "hot" if rnd.random() < 0.4 else f"k{rnd.randrange(20)}"
    return [(key(), rnd.randrange(100) * SECOND // 2, rnd.choice([None, 5, 10, 40, 100]), f"v{rnd.randrange(3)}") for _ in range(n)]


@pytest.mark.parametrize("max_files", [None, 1])
def test_sets_resets_deletes_and_expiry(spark, folder, max_files, monkeypatch):
    monkeypatch.setattr(keyed_store, "MOST_FOLDERS", 2)  # buckets are folded on the way
    writes = made_up(1, 300)
    writes += [("gone", SECOND, 10, "v"), ("gone", 2 * SECOND, None, "v"), ("back", SECOND, None, "v"), ("back", 2 * SECOND, 99, "w"),
               ("edge", 0, 50, "v"), ("tie", SECOND, None, "v"), ("tie", SECOND, 90, "v")]
    random.Random(2).shuffle(writes)
    now = 50 * SECOND
    for k in range(6):
        spark.createDataFrame(writes[k::6], WRITE).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    stream = jobs.file_stream(spark, f"{folder}/in", WRITE, max_files)
    got = {tuple(r) for r in jobs.run_live_keys(stream, f"{folder}/out", F.lit(now), "value").select("key", "set_at", "remaining_s", "value").collect()}
    assert got == replay(writes, now)
    names = {k for k, *_ in got}
    assert "gone" not in names and "edge" not in names and {"back", "tie"} <= names
    batch = spans.live_keys(spans.latest_writes(spark.createDataFrame(writes, WRITE), "value"), F.lit(now))
    assert {tuple(r) for r in batch.collect()} == {r[:3] for r in got}
    # Later files: the state goes on from what is kept, and nothing old is read from the source again.
    spark.createDataFrame([("gone", 49 * SECOND, 20, "z")], WRITE).write.mode("append").parquet(f"{folder}/in")
    again = jobs.run_live_keys(jobs.file_stream(spark, f"{folder}/in", WRITE), f"{folder}/out", F.lit(now), "value")
    assert {tuple(r) for r in again.select("key", "set_at", "remaining_s", "value").collect()} == replay(writes + [("gone", 49 * SECOND, 20, "z")], now)
    state = KeyedStore(spark, f"{folder}/out/keys", ["key"], buckets=16)
    assert all(len(writes) <= 2 for writes in state.manifest()["folders"].values())


def test_streams_without_files(spark, folder):
    spark.createDataFrame([], WRITE).write.parquet(f"{folder}/in")
    stream = lambda: jobs.file_stream(spark, f"{folder}/in", WRITE)
    assert jobs.run_live_keys(stream(), f"{folder}/a", F.lit(0)).collect() == []
    assert jobs.run_slices(stream(), f"{folder}/b", ["key"], "set_at", 60).collect() == []


def test_slices_of_many_batches_stay_folded(spark, folder, monkeypatch):
    monkeypatch.setattr(keyed_store, "MOST_FOLDERS", 2)
    writes = made_up(5, 400)
    df = spark.createDataFrame(writes, WRITE)
    for k in range(5):
        spark.createDataFrame(writes[k::5], WRITE).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    found = jobs.run_slices(jobs.file_stream(spark, f"{folder}/in", WRITE, 1), f"{folder}/out", ["key"], "set_at", 3)
    assert {tuple(r) for r in found.collect()} == {tuple(r) for r in spans.alive_spans(df, "key", "set_at", 3).collect()}
    kept = KeyedStore(spark, f"{folder}/out/slices", ["key", "_slice"], buckets=16).read().count()
    slices = spans.span_slices(df, ["key"], "set_at", 3).count()
    assert slices <= kept < 3 * slices


def test_abort_comes_after_the_write_and_once(spark, folder):
    rows = [[("a", "x" * 200, 3)], [("b", "x" * 101 + "refused", 0), ("c", "short", 0)], [("d", "x" * 200, 1)]]
    for part in rows:
        spark.createDataFrame(part, "id string, content string, n int").coalesce(1).write.mode("append").parquet(f"{folder}/in")
    stream = lambda: jobs.routed_pages(
        jobs.file_stream(spark, f"{folder}/in", "id string, content string, n int", max_files=1), F.col("content"), F.col("n"), marker="refused")
    with pytest.raises(StreamingQueryException, match="PageRefused"):
        jobs.route_pages(stream(), f"{folder}/out")
    early = jobs.written_pages(spark, f"{folder}/out", stream().schema)
    assert {r.id: r.route for r in early.collect()}["b"] == "abort" and early.where("id = 'c'").count() == 1
    done = jobs.route_pages(stream(), f"{folder}/out")
    assert sorted((r.id, r.route) for r in done.collect()) == [("a", "ok"), ("b", "abort"), ("c", "retry"), ("d", "ok")]
    assert jobs.route_pages(stream(), f"{folder}/out").count() == 4


def test_id_requests_there_and_back(spark, folder):
    places = spark.createDataFrame(
        [("p1", 2, "A \"q\" é", (1.5, -2.0), None, None), ("p2", None, None, None, None, False), ("p3", 1, "C", None, "known", None), ("p4", 1, "D", None, None, True)],
        "place_id string, priority int, name string, coords struct<lat:double,lng:double>, data_id string, unserpable boolean")
    stores.append_messages(scheduling.id_requests(places), f"{folder}/q", F.col("value"))
    odd = ['{"place_id": "x"', '{"place_id": "x"}', json.dumps({"place_id": "", "priority": 1, "name": "n", "coords": None, "data_id": None}), "[]"]
    stores.append_messages(spark.createDataFrame([(o,) for o in odd], "value string"), f"{folder}/q", F.col("value"))
    received = check_id_requests(jobs.file_stream(spark, f"{folder}/q", "value string", file_format="text"), "value").select("request.*", "outcome")
    got = sorted(((r.outcome, r.place_id or "", r.priority, r.name, r.coords) for r in jobs.run(received, f"{folder}/out").collect()), key=str)
    assert [g for g in got if g[0] == "ok"] == [("ok", "p1", 2, "A \"q\" é", [1.5, -2.0]), ("ok", "p2", None, None, None)]
    assert sorted(g[0] for g in got if g[0] != "ok") == ["keys", "malformed", "malformed", "place_id"]


def test_ranks_over_many_ranges(spark, folder):
    rnd = random.Random(3)
    rows = [(rnd.choice([1.0, 2.0, None, rnd.random()]), f"n{k}") for k in range(500)]
    got = scheduling.ranked(spark.createDataFrame(rows, "v double, name string"), folder, F.desc_nulls_last("v"), F.col("name")).collect()
    expected = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    assert [(r.v, r.name) for r in sorted(got, key=lambda r: r["rank"])] == expected and {r["rank"] for r in got} == set(range(1, 501))
    assert scheduling.ranked(spark.createDataFrame([], "v double, name string"), folder + "/none", F.col("v")).collect() == []


def test_searched_cells_are_those_asked_for(spark):
    cell = geo.cell_id(F.lit(8190), F.lit(6200), geo.COARSE_LEVEL)
    cells = spark.range(1).select(cell.alias("cell"))
    cover = geo.cover(cells).orderBy("child_cell").limit(2).collect()
    body = json.dumps({"results": [{"place_id": "a", "name": "A", "geometry": {"location": {"lat": 1.0, "lng": 2.0}}}]})
    answers = spark.createDataFrame([(cover[0].child_cell, body), (7, body)], "child_cell long, body string")
    asked = flows.responses_of_cells(cells, answers)
    from atlaslens.sources.responses import found_places, place_results
    row, = pl.normalise_places(found_places(place_results(asked)), F.lit("q"), F.current_timestamp()).collect()
    assert row.search_cell_fine == cover[0].child_cell and row.search_cell_coarse == cover[0].cell and row.loc_cell_fine != row.search_cell_fine
