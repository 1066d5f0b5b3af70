"""Whole search entries as variants, and tables that grow by the day."""

from __future__ import annotations

import datetime as dt
import glob
import io
import json
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from atlaslens.operators import search
from atlaslens.operators.day_store import DayStore
from atlaslens.sources import responses

BODIES = {
    1: {"place_results": {"place_id": "a", "title": "A", "rating": 4.5, "gps_coordinates": {"latitude": 1, "longitude": 2.5},
                          "people_also_search_for": [{"local_results": [{"position": 1, "place_id": "b", "odd": {"x": [1, None]}}, {"title": "no position"}]},
                                                     {"local_results": [{"position": 9}]}]},
        "search_metadata": {"id": "m"}, "search_information": "plain"},
    2: {"local_results": [{"position": 3, "types": ["t", "u"], "address": "s"}, {"position": 4, "place_id": 77}]},
    3: {"error": "none left"},
    4: {"local_results": []},
    5: {"place_results": None, "local_results": {"not": "a list"}},
    6: {"place_results": "text", "local_results": [{"position": 1}]},
    7: [1, 2],
}


def plan_of(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.fixture
def entries(spark):
    rows = [(k, json.dumps(v)) for k, v in BODIES.items()] + [(8, "{broken"), (9, None)]
    return responses.search_entries(spark.createDataFrame(rows, "k int, body string"))


def test_entries_of_every_shape(entries):
    got = sorted(((r.k, r.tag or "", r.search_error or "", r.place_id or "", r.n_entries) for r in entries.collect()))
    assert got == [
        (1, "", "", "", 3), (1, "pasf_1", "", "b", 3), (1, "pr", "", "a", 3), (2, "ll_3", "", "", 2), (2, "ll_4", "", "77", 2), (3, "", "none left", "", 0),
        (4, "", "", "", 0), (5, "", "unexpected response", "", 0), (6, "ll_1", "", "", 1), (7, "", "unexpected response", "", 0),
        (8, "", "unexpected response", "", 0), (9, "", "unexpected response", "", 0),
    ]
    first = entries.where("tag = 'pr'").first()
    assert (first.search_metadata, first.search_information, first.gps_coordinates.latitude, first.title) == ('{"id":"m"}', "plain", 1.0, "A")
    assert entries.where("tag = 'll_3'").first().types == ["t", "u"]


def test_unknown_fields_survive_the_cache(spark, entries, tmp_path):
    at = F.to_timestamp(F.lit("2024-05-06 07:08:09"))
    rows = search.cache_rows(entries, F.lit("food"), F.lit("@1,2"), at)
    store = DayStore(spark, str(tmp_path / "c"), "query_ds", StructType.fromDDL(search.CACHE_ROW))
    assert store.read().collect() == [] and store.days() == []
    store.append(rows, "run-1")
    back = {r.local_results: json.loads(r.e) for r in store.read().withColumn("e", F.to_json("place_results")).collect()}
    assert back["pasf_1"]["odd"] == {"x": [1, None]} and back["pr"]["rating"] == 4.5 and len(back) == 6
    one = store.read().where("local_results = 'pr'").first()
    assert (one.query_params, str(one.query_ds), str(one.query_dt), one.n_entries, one.run) == ("food_@1,2", "2024-05-06", "2024-05-06 07:08:09", 3, "run-1")


def test_a_response_is_parsed_once(entries):
    plan = plan_of(entries)
    assert plan.lower().count("try_parse_json(") + plan.count("tryParseJson(") <= 2  # named in the Project's input and output
    assert "lambda" not in plan.lower() and "from_json" not in plan


def days(spark, *rows):
    return spark.createDataFrame([(dt.date.fromisoformat(d) if d else None, v) for d, v in rows], "day date, v int")


def test_runs_replace_themselves_and_days_are_pruned(spark, tmp_path):
    store = DayStore(spark, str(tmp_path / "d"), "day", StructType.fromDDL("v int, day date"))
    store.append(days(spark, ("2024-01-01", 1), ("2024-01-02", 2), (None, 9)), "a")
    store.append(days(spark, ("2024-01-02", 3)), "b")
    kept = set(glob.glob(f"{store.root}/*/run=a/*.parquet"))
    store.append(days(spark, ("2024-01-02", 4)), "b")  # again, after a failure
    assert kept == set(glob.glob(f"{store.root}/*/run=a/*.parquet"))
    assert sorted(r.v for r in store.read().collect()) == [1, 2, 4, 9]
    late = store.read(since=dt.date(2024, 1, 2))
    assert sorted(r.v for r in late.collect()) == [2, 4]
    plan = plan_of(late)
    assert "PartitionFilters: [isnotnull(day" in plan and len(late.inputFiles()) >= 2
    assert [r.v for r in store.read(until=dt.date(2024, 1, 1)).collect()] == [1]


def test_expired_days_go_without_being_read(spark, tmp_path):
    store = DayStore(spark, str(tmp_path / "d"), "day", StructType.fromDDL("v int, day date"))
    store.append(days(spark, ("2024-01-01", 1), ("2024-01-02", 2), ("2024-01-03", 3), (None, 9)), "a")
    for path in glob.glob(f"{store.root}/day=2024-01-01/*/*.parquet"):
        open(path, "wb").write(b"not parquet")  # reading it would fail
    day = 86_400
    assert store.drop_expired(dt.datetime(2024, 1, 3), 2 * day) == []
    assert store.drop_expired(dt.datetime(2024, 1, 4), 2 * day) == ["2024-01-01"]
    assert sorted(r.v for r in store.read().collect()) == [2, 3, 9] and store.days() == ["2024-01-02", "2024-01-03"]
