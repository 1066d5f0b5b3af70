"""The jobs as a whole on small tables."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from atlaslens import config
from atlaslens.plans import flows
from atlaslens.session import work_dir
from atlaslens.sources.pages import page_records, read_pages

NOW = dt.datetime(2024, 3, 10, 12)


def page(age, *names, token="t="):
    blocks = "".join(
        f'<div class="TSUbDb">{n}</div><div class="PuaHbe">{age}</div><div class="Jtu6Td"><span class="review-full-text">text {n}</span></div>'
        for n in names)
    more = f'<i data-next-page-token="{token}"></i>' if token else ""
    return "<body>" + "<!-- -->" * 20 + blocks + more + "</body>"


@pytest.fixture(scope="module")
def run(spark):
    rows = [
        ("stops", 0, page("a day ago", "a", "b")), ("stops", 1, page("2 months ago", "c")), ("stops", 2, page("3 months ago", "d")),
        ("ends", 0, page("a day ago", "a", token=None)),
        ("breaks", 0, page("a day ago", "a")), ("breaks", 1, page("x")), ("breaks", 2, page("a day ago", "b")),
        ("refused", 0, page("x") + config.BLOCKED_MARKER), ("empty", 0, "tiny"), ("goes on", 0, page("a day ago", "a")),
        ("nobody asked", 0, page("a day ago", "z")),
    ]
    captured = spark.createDataFrame(
        [(p, "d", p, "en", n, c) for p, n, c in rows],
        "place_id string, data_id string, name string, language string, page_number int, content string")
    asked = ["stops", "ends", "breaks", "refused", "empty", "goes on", "not captured"]
    requests = spark.createDataFrame([(p, "en", dt.date(2024, 2, 1)) for p in asked], "place_id string, language string, last_scraped date")
    records = page_records(captured, F.lit(NOW))
    folder = work_dir(spark, "pages")
    records.write.parquet(folder)
    stored = read_pages(spark, folder)
    return flows.refresh_reviews(stored, requests, config.parser_table(spark), F.lit(NOW), work_dir(spark, "lists"))


def test_status_of_each_request(run):
    assert {r.place_id: (r.status, r.last_page, r.n_pages) for r in run.requests.collect()} == {
        "stops": ("done", 1, 2), "ends": ("done", 0, 1), "breaks": ("retry", 1, 1), "refused": ("abort", 0, 0),
        "empty": ("retry", 0, 0), "goes on": ("waiting", 0, 1), "not captured": ("waiting", None, 0)}


def test_only_reviews_of_kept_pages(run):
    found = sorted((r.place_id, r.page_number, r.reviewer_name, r.review_original) for r in run.reviews.collect())
    assert found == [("breaks", 0, "a", "text a"), ("ends", 0, "a", "text a"), ("goes on", 0, "a", "text a"),
                     ("stops", 0, "a", "text a"), ("stops", 0, "b", "text b"), ("stops", 1, "c", "text c")]


def test_pages_and_quarantine(run):
    assert sorted((r.place_id, r.page_number, r.is_stop) for r in run.pages.collect()) == [
        ("breaks", 0, False), ("ends", 0, True), ("goes on", 0, False), ("stops", 0, False), ("stops", 1, True)]
    assert sorted((r.place_id, r.page_number, r.outcome) for r in run.quarantine.collect()) == [
        ("breaks", 1, "NO_ROWS"), ("empty", 0, "EMPTY"), ("refused", 0, "BLOCKED")]


def test_freshness_is_set_for_finished_runs_only(spark, run):
    places = spark.createDataFrame([(p, {"es": dt.date(2024, 1, 1)}) for p in ("stops", "ends", "breaks", "other")],
                                   "place_id string, last_scraped map<string, date>")
    marked = flows.mark_refreshed(places, run, "en", F.lit(NOW).cast("date"))
    assert {r.place_id: r.last_scraped.get("en") for r in marked.collect()} == {
        "stops": NOW.date(), "ends": NOW.date(), "breaks": None, "other": None}


def test_a_scan_twice_changes_nothing(spark):
    body = '{"results":[{"place_id":"a","name":"A","types":["bar"],"geometry":{"location":{"lat":40.4,"lng":-3.7}}},' \
           '{"place_id":"b","name":"B","geometry":{"location":{"lat":40.4,"lng":-3.7}}},' \
           '{"place_id":"a","name":"A again","geometry":{"location":{"lat":1.0,"lng":1.0}}}]}'
    responses = spark.createDataFrame([(1, body)], "page int, body string")
    order = [F.col("name")]
    from atlaslens.operators import places as pl
    from atlaslens.sources.responses import broken_responses, found_places, place_results
    empty = pl.normalise_places(found_places(place_results(responses.where("false"))), F.lit("x"), F.lit(NOW))
    odd = place_results(spark.createDataFrame([(1, body), (2, "{broken"), (3, '{"results": []}'), (4, None)], "page int, body string"))
    assert sorted(r.page for r in broken_responses(odd).collect()) == [2, 4] and {r.page for r in found_places(odd).collect()} == {1}
    once = flows.scan_area(empty, responses, "coffee", F.lit(NOW), order)
    twice = flows.scan_area(flows.scan_area(once, responses, "coffee", F.lit(NOW), order), responses, "bars", F.lit(NOW), order)
    shape = lambda df: sorted((r.place_id, r.name, r.priority, tuple(r.all_queries)) for r in df.collect())
    assert shape(once) == [("a", "A", 2, ("coffee",)), ("b", "B", 1, ("coffee",))]
    assert shape(twice) == [("a", "A", 2, ("bars", "coffee")), ("b", "B", 1, ("bars", "coffee"))]
