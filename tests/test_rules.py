"""The rules on small inputs, one case per branch."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from atlaslens import config
from atlaslens.functions import text as tx
from atlaslens.functions.affinity import affinity
from atlaslens.functions.age import precision, with_days_before, with_review_age
from atlaslens.functions.bilingual import with_bilingual_texts
from atlaslens.functions.facets import facet_columns
from atlaslens.functions import geo
from atlaslens.operators import paging, places, reviews, scheduling, search, spans, stores
from atlaslens.sources import state
from atlaslens.sources.requests import check_requests

DAY = dt.date(2024, 3, 1)


def values(df, *columns):
    return [tuple(row[c] for c in columns) if len(columns) > 1 else row[columns[0]] for row in df.collect()]


def days(spark, language, texts, compat=False):
    df = spark.createDataFrame([(i, t, language) for i, t in enumerate(texts)], "i int, time string, language string")
    return values(with_days_before(df, compat=compat).orderBy("i"), "days_before_scrape")


def test_age_english(spark):
    texts = ["an hour ago", "a day ago", "3 days ago", "2 weeks ago", "a month ago", "2 years ago", "a week ago",
             "Edited 2 weeks ago", "5 fortnights ago", "", "5 Minutes ago", "a second ago", None, "un day ago"]
    assert days(spark, "en", texts) == [0, 1, 3, 14, 30, 730, 7, None, None, None, 0, 0, None, None]


def test_age_spanish(spark):
    texts = ["Hace 5 horas", "Hace un día", "Hace 3 meses", "Hace un año", "Hace una semana", "2 semanas", "hace 2 semanas",
             "Hace un minuto", "Hace 3 segundos"]
    assert days(spark, "es", texts) == [0, 1, 90, 365, 7, None, 14, 0, 0]


def test_age_as_older_runs_had_it(spark):
    assert days(spark, "en", ["a week ago", "2 weeks ago", "a day ago"], compat=True) == [1, 14, 1]
    assert days(spark, "es", ["Hace una semana"], compat=True) == [1]


def test_age_columns_and_errors(spark):
    df = spark.createDataFrame(
        [("a week ago", "en", DAY), ("il y a un jour", "fr", DAY), ("soon", "en", DAY)], "time string, language string, scrape_ds date"
    )
    rows = with_review_age(df, F.lit(dt.date(2024, 3, 11))).collect()
    assert (rows[0].review_date, rows[0].age_in_days, rows[0].age_precision, rows[0].age_error) == (dt.date(2024, 2, 23), 17, 7, None)
    assert [(r.review_date, r.age_precision, r.age_error) for r in rows[1:]] == [(None, None, "language"), (None, None, "text")]


def test_precision(spark):
    df = spark.createDataFrame([(n,) for n in (0, 1, 6, 7, 29, 30, 364, 365, None)], "n int")
    assert values(df.select(precision(F.col("n")).alias("p")), "p") == [0, 1, 1, 7, 7, 30, 30, 365, None]


T, O = "(Translated by Google)", "(Original)"


@pytest.mark.parametrize("parts, expected", [
    ([T, "t", O, "o"], ("o", "t")),
    (["o", T, "t"], ("o", "t")),
    ([f"{T} t", f"{O} o"], ("o", "t")),
    ([f"{T} t", O, "o"], ("o", "t")),
    ([f"{T} t", O], ("", "t")),
    ([f"{T} t"], ("", "t")),
    (["o"], ("o", "o")),
    ([" ", "\n", " o \n", "p"], ("o", "o")),
    (["o", T], ("o", None)),
    ([T], ("", None)),
    ([], ("", "")),
    ([f"{T} {T}", "x"], (f"{T} {T}", f"{T} {T}")),
    (None, ("single", "single")),
])
def test_bilingual(spark, parts, expected):
    df = spark.createDataFrame([(parts,)], "parts array<string>")
    split = with_bilingual_texts(df, F.col("parts"), F.lit(" single\n"), F.lit(T), F.lit(O))
    assert values(split, "original", "translated") == [expected]


def test_no_single_text_is_empty(spark):
    df = spark.createDataFrame([(None, None)], "parts array<string>, single string")
    split = with_bilingual_texts(df, F.col("parts"), F.col("single"), F.lit(T), F.lit(O))
    assert values(split, "original", "translated") == [("", "")]


def test_zip_of_unequal_lists(spark):
    df = spark.createDataFrame([("p", ["r1", "r2"], ["n1", "n2", "n3"], ["t1", "t2"], [1.0]), ("q", None, ["n"], [], None)],
                               "id string, r array<string>, n array<string>, t array<string>, s array<double>")
    rows = reviews.zip_lists(df, {"r": "review", "n": "name", "t": "time", "s": "star"}).orderBy("id", "position").collect()
    assert [tuple(r) for r in rows] == [
        ("p", 0, "r1", "n1", "t1", 1.0, True), ("p", 1, "r2", "n2", "t2", None, True), ("p", 2, None, "n3", None, None, False),
        ("q", 0, None, "n", None, None, False),
    ]


def test_page_outcome(spark):
    marker = config.BLOCKED_MARKER
    rows = [("x" * 100, 5), ("x" * 101, 0), ("x" * 101 + marker, 0), ("x" * 101 + marker, 3), (None, 0)]
    df = spark.createDataFrame(rows, "content string, n int")
    outcome = paging.page_outcome(F.col("content"), F.col("n"))
    assert values(df.select(outcome.alias("o"), paging.route(outcome).alias("r")), "o", "r") == [
        ("EMPTY", "retry"), ("NO_ROWS", "retry"), ("BLOCKED", "abort"), ("OK", "ok"), ("EMPTY", "retry")]


def test_stop(spark):
    as_of = dt.datetime(2024, 3, 1, 0, 0, 0)
    oldest = dt.date(2024, 3, 1) - dt.timedelta(days=1440)
    last = dt.date(2024, 2, 10)
    rows = [
        ("t", dt.date(2024, 2, 10), DAY, as_of, False),
        ("t", dt.date(2024, 2, 9), DAY, as_of, True),
        ("t", DAY, oldest, as_of, False),
        ("t", DAY, oldest, as_of + dt.timedelta(seconds=1), True),
        (None, DAY, DAY, as_of, True),
        ("t", None, None, as_of, False),
    ]
    df = spark.createDataFrame(rows, "token string, newest date, oldest date, as_of timestamp, expected boolean")
    stop = paging.is_stop(F.col("token"), F.col("newest"), F.col("oldest"), F.lit(last), F.col("as_of"))
    assert all(a == b for a, b in values(df.select("expected", stop.alias("s")), "expected", "s"))


def test_last_scraped_day(spark):
    df = spark.createDataFrame([("2024-02-03 10:11:12",), (None,)], "d string")
    day = paging.last_scraped_day(F.col("d").cast("timestamp"))
    assert values(df.select(day.alias("d")), "d") == [dt.date(2024, 2, 3), dt.date(2015, 1, 1)]


def test_take_until_stop_keeps_the_stopping_page(spark):
    rows = [("a", "en", n, n in (2, 4)) for n in range(6)] + [("b", "en", n, False) for n in range(3)] + [("c", "en", 0, True)]
    kept = paging.take_until_stop(spark.createDataFrame(rows, "place_id string, language string, page_number int, is_stop boolean"))
    assert sorted(values(kept, "place_id", "page_number")) == [("a", 0), ("a", 1), ("a", 2), ("b", 0), ("b", 1), ("b", 2), ("c", 0)]


def test_page_budget(spark):
    df = spark.createDataFrame([("a", "en", n) for n in range(0, 210)], "place_id string, language string, page_number int")
    runs = dict(values(paging.page_budget(df), "page_number", "run_id"))
    assert len(runs) == 200 and runs[11] == 0 and runs[12] == 1 and runs[199] == 16


def test_resume(spark):
    keys = "place_id string, language string"
    requests = spark.createDataFrame([(p, "en") for p in "abcdef"], keys)
    checkpoints = spark.createDataFrame(
        [("b", "en", 0, 5), ("c", "en", 4, 9), ("c", "en", 7, 3), ("d", "en", 4, 1), ("e", "en", 4, 1), ("f", "es", 4, 1)],
        keys + ", page_number int, set_at int")
    pages = spark.createDataFrame([("c", "en", 4, "tok"), ("e", "en", 4, None), ("d", "es", 4, "other")],
                                  keys + ", page_number int, next_page_token string")
    rows = values(paging.resume_points(requests, checkpoints, pages), "place_id", "start_page", "start_token")
    # e stored its last page (no token), so it is finished; d's page is missing in its language.
    assert sorted(rows) == [("a", 0, ""), ("b", 0, ""), ("c", 5, "tok"), ("d", 5, ""), ("f", 0, "")]


def test_token_chain(spark):
    df = spark.createDataFrame([("a", "en", 0, "t0"), ("a", "en", 1, None), ("a", "en", 2, "t2"), ("a", "en", 4, "t4")],
                               "place_id string, language string, page_number int, next_page_token string")
    rows = values(paging.token_chain(df), "page_number", "request_token", "chain_broken")
    assert sorted(rows) == [(0, "", False), (1, "t0", False), (2, None, False), (4, None, True)]


@pytest.mark.parametrize("html, token", [
    ('<a data-next-page-token="AbC_1==">', "AbC_1=="), ('<a data-next-page-token="AbC">', None),
    ('<a data-next-page-token="A-b=">', None), ('data-next-page-token="ñ=" data-next-page-token="x="', "ñ="),
])
def test_token(spark, html, token):
    df = spark.createDataFrame([(html,)], "h string")
    assert values(df.select(tx.next_page_token(F.col("h")).alias("t")), "t") == [token]


def test_page_link(spark):
    link = tx.page_link(F.lit("www.example"), F.lit("es"), F.lit("en"), F.lit("0x1:0x2"), F.lit("tok="))
    assert spark.range(1).select(link.alias("l")).first().l == (
        "https://www.example.es/async/reviewDialog?hl=en&async=feature_id:0x1:0x2,"
        "sort_by:newestFirst,next_page_token:tok=,associated_topic:,_fmt:pc")


def test_text_cleaning(spark):
    df = spark.createDataFrame([("\n Ann,\nLee|  ", '<span class="r3">x</span>')], "n string, o string")
    row = df.select(
        tx.clean_name(F.col("n")).alias("name"), tx.collapse_whitespace(F.lit(" 2\n  weeks  ago ")).alias("time"),
        tx.star_rating(F.lit("Rated 4.0 out of 5"), F.col("o")).alias("by_label"),
        tx.star_rating(F.lit(None).cast("string"), F.col("o")).alias("by_outer"),
        tx.star_rating(F.lit("none"), F.lit("none")).alias("none"),
        tx.review_id(F.lit("p"), F.lit(None).cast("string"), F.lit("en")).alias("no_id"),
    ).first()
    assert tuple(row) == ("Ann Lee", "2 weeks ago", 4.0, 3.0, None, None)


def test_due(spark):
    as_of = dt.date(2024, 3, 1)
    rows = [("no id", None, None, None), ("excluded", "d", True, None), ("unknown flag", "d", None, None), ("never", "d", False, None),
            ("28 days", "d", False, dt.date(2024, 2, 2)), ("29 days", "d", False, dt.date(2024, 2, 1)), ("busy", "d", False, None)]
    df = spark.createDataFrame(rows, "place_id string, data_id string, unscrapable boolean, last_scraped date")
    busy = spark.createDataFrame([("busy",), (None,)], "place_id string")
    assert sorted(values(scheduling.due_places(df, busy, F.lit(as_of)), "place_id")) == ["29 days", "never", "unknown flag"]


def test_last_scraped_of_a_language(spark):
    df = spark.createDataFrame([({"en": DAY},), ({},), (None,)], "last_scraped map<string, date>")
    assert values(df.select(scheduling.last_scraped_by_language(df, F.lit("en")).alias("d")), "d") == [DAY, None, None]


def test_highest_priority_puts_none_last(spark):
    df = spark.createDataFrame([("a", None), ("b", 1), ("c", 2), ("d", 2)], "place_id string, priority int")
    assert values(scheduling.highest_priority(df, 3, "place_id"), "place_id") == ["c", "d", "b"]


def test_priority_default(spark):
    df = spark.createDataFrame([(["bar"], None), (["museum"], None), ([], None), (None, None), (["bar"], 5)], "types array<string>, priority int")
    rows = places.with_defaults(places.with_place_types(df))
    assert values(rows, "priority", "unserpable") == [(2, False), (1, False), (1, False), (1, False), (5, False)]


def test_link_outcome(spark):
    known = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", None)], "place_id string, data_id string")
    entries = spark.createDataFrame([("a", "9"), ("b", "2"), ("c", None), ("z", "4"), (None, "5")], "place_id string, data_id string")
    links = search.one_link_per_place(entries, F.col("data_id"))
    outcomes = dict(values(search.classify_links(links, known), "place_id", "link_outcome"))
    assert outcomes == {"a": "updated", "b": "unchanged", "c": "unchanged", "z": "inserted"}
    linked = dict(values(search.apply_links(known, links), "place_id", "data_id"))
    assert linked == {"a": "9", "b": "2", "c": None, "z": "4"}


def test_contract(spark):
    full = '{"place_id":"p","data_id":"d","name":"n","language":"en","country_domain":"es","priority":1,"last_scraped":"2024-01-01"}'
    bodies = [full, full.replace('"priority":1,', ""), full.replace('"priority"', '"extra":2,"priority"'),
              full.replace('"d"', '""'), full.replace('"d"', "null"), "not json", None]
    df = spark.createDataFrame([(b,) for b in bodies], "body string")
    checked = check_requests(df)
    assert values(checked, "outcome") == ["ok", "keys", "keys", "data_id", "data_id", "malformed", "malformed"]
    assert stores.quarantined(checked).count() == 6


def test_affinity_wraps_both_ways(spark):
    row = spark.range(1).select(
        affinity(F.lit(23.5), F.lit(0.5)).alias("a"), affinity(F.lit(0.5), F.lit(23.5)).alias("b"),
        affinity(F.lit(0.5), F.lit(23.5), compat=True).alias("c")).first()
    assert row.a == pytest.approx(row.b) and row.c < 1e-6 < row.a


def test_live_keys(spark):
    second = 1_000_000
    rows = [("a", 10, 5), ("a", 12, 1), ("b", 10, 5), ("c", 10, 3), ("d", 1, 5), ("e", 9, 4), ("f", 10, 50), ("f", 11, None), ("g", 11, None), ("g", 12, 9)]
    df = spark.createDataFrame([(k, s * second, t) for k, s, t in rows], "key string, set_at long, ttl_s long")
    live = spans.live_keys(df, F.lit(13 * second))
    # a was set again with a shorter life and is gone; c ends exactly now.
    # f was deleted, g set again after it was.
    assert sorted(values(live, "key", "remaining_s")) == [("b", 2), ("g", 8)]


def test_spans_end_at_exactly_the_ttl(spark):
    second = 1_000_000
    times = [0, 59.999999, 119.999998, 179.999998]
    df = spark.createDataFrame([("k", int(t * second)) for t in times], "k string, at long")
    assert sorted(values(spans.alive_spans(df, "k", "at", 60), "span_start_us", "last_set_us", "n_sets")) == [
        (0, 119_999_998, 3), (179_999_998, 179_999_998, 1)]


def test_keys_by_prefix_and_suffix(spark):
    df = spark.createDataFrame([("working_on_a_b",), ("x_working_on_c",), ("w1_current_slot",), ("_current_slot",)], "key string")
    assert values(spans.keys_with_prefix(df, config.LEASE_PREFIX), "name") == ["a_b"]
    assert values(spans.keys_with_suffix(df, config.CURRENT_SLOT_SUFFIX), "name") == ["w1", ""]


def test_slots_are_decoded(spark):
    df = spark.createDataFrame([({"es_12_b.conf_23.6": "1700000000.5", "plain": "7", "a_x": "1"},)], "pairs map<string, string>")
    rows = values(state.decode_slots(state.hash_pairs(df)), "name", "slot", "last_used")
    assert sorted(rows, key=str) == sorted([("es_12_b.conf", 23.6, 1700000000.5), ("", None, 7.0), ("a", None, 1.0)], key=str)


def test_best_slot_is_rested_and_nearest(spark):
    day = 86_400.0
    rows = [("g", "a", 12.0, 0.0), ("g", "b", 1.0, 0.0), ("g", "c", 23.5, 10 * day), ("h", "z", 5.0, 10 * day), ("i", "q", 23.0, 9 * day)]
    df = spark.createDataFrame(rows, "g string, name string, slot double, last_used double")
    best = scheduling.best_slots(df, ["g"], F.lit(23.75), F.lit(10 * day))
    # c fits best but was just used, i has rested for exactly a day, which is not more than a day.
    assert values(best, "g", "name") == [("g", "b")]


def test_facets(spark):
    df = spark.createDataFrame([({"Review": ["fine"], "Food": ["4", "5"], "FOOD": ["1"], "Service": []},)], "m map<string, array<string>>")
    labels = {name: F.lit(name.title()) for name in ("food", "service", "atmosphere")}
    row = df.select(*(c.alias(n) for n, c in facet_columns(F.col("m"), labels).items())).first()
    assert (row.review, row.service, row.atmosphere) == ("fine", None, None) and row.food in ("4", "1")


def test_cells_of_missing_and_extreme_points(spark):
    df = spark.createDataFrame([(None, 1.0), (1.0, None), (90.0, 180.0), (-90.0, -180.0), (0.0, 0.0)], "lat double, lng double")
    cells = df.select(geo.tile_x(F.col("lng"), 3).alias("x"), geo.tile_y(F.col("lat"), 3).alias("y"))
    assert values(cells, "x", "y") == [(4, None), (None, 3), (7, 0), (0, 7), (4, 4)]


def test_update_map_entry(spark):
    df = spark.createDataFrame([("a", {"en": DAY}), ("b", None), ("c", {"es": DAY})], "k string, m map<string, date>")
    new = spark.createDataFrame([("a", dt.date(2024, 4, 1)), ("b", dt.date(2024, 4, 2))], "k string, d date")
    rows = dict(values(stores.update_map_entry(df, new, "k", "m", F.lit("en"), "d"), "k", "m"))
    assert rows == {"a": {"en": dt.date(2024, 4, 1)}, "b": {"en": dt.date(2024, 4, 2)}, "c": {"es": DAY}}
