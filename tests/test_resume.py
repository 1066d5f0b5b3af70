"""The refresh job in several runs: budget, resume, expiry, failures."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from atlaslens import config
from atlaslens.plans import flows
from atlaslens.session import work_dir
from atlaslens.sources.pages import page_records, read_pages
from test_flows import NOW, page


@pytest.fixture(scope="module")
def captured(spark):
    long = [("long", n, page("a day ago", f"r{n}", f"s{n}", token="t=" if n < 29 else None)) for n in range(30)]
    short = [("short", 0, page("a day ago", "a")), ("short", 1, page("3 months ago", "b")), ("short", 2, page("4 months ago", "c"))]
    breaks = [("breaks", n, page("a day ago", f"r{n}") if n != 14 else page("x")) for n in range(20)]
    start = [("start", 0, page("a day ago", "a")), ("start", 1, "tiny")]
    rows = spark.createDataFrame([(p, "d", p, "en", n, c) for p, n, c in long + short + breaks + start],
                                 "place_id string, data_id string, name string, language string, page_number int, content string")
    folder = work_dir(spark, "captured")
    page_records(rows, F.lit(NOW)).write.parquet(folder)
    asked = spark.createDataFrame([(p, "en", dt.date(2024, 2, 1)) for p in ("long", "short", "breaks", "start", "not captured")],
                                  "place_id string, language string, last_scraped date")
    return read_pages(spark, folder), asked


def go(spark, captured, ledger, run, hours=0):
    pages, asked = captured
    flows.resume_reviews(pages, asked, config.parser_table(spark), F.lit(NOW + dt.timedelta(hours=hours)), work_dir(spark, "round"), ledger, run)


def states(ledger):
    return {r.place_id: (r.status, r.last_page, r.page_number) for r in ledger.state().collect()}


def stored(ledger):
    return sorted((r.place_id, r.page_number, r.reviewer_name) for r in ledger.reviews.read().collect())


def test_three_runs_are_one(spark, captured):
    ledger = flows.RunLedger(spark, work_dir(spark, "ledger"), 4)
    assert ledger.state() is None
    go(spark, captured, ledger, 0)
    assert states(ledger) == {"long": ("waiting", 11, 11), "short": ("done", 1, 1), "breaks": ("waiting", 11, 11), "start": ("retry", 1, 0)}
    go(spark, captured, ledger, 0)  # a run that was done already
    assert ledger.requests.version() == 1
    go(spark, captured, ledger, 1)
    assert states(ledger) == {"long": ("waiting", 23, 23), "short": ("done", 1, 1), "breaks": ("retry", 14, 13), "start": ("retry", 1, 0)}
    # The third run fails after its reviews were stored, and is repeated.
    add, ledger.requests.add = ledger.requests.add, lambda *_: 1 / 0
    with pytest.raises(ZeroDivisionError):
        go(spark, captured, ledger, 2)
    ledger.requests.add = add
    go(spark, captured, ledger, 2)
    assert states(ledger) == {"long": ("done", 29, 29), "short": ("done", 1, 1), "breaks": ("retry", 14, 13), "start": ("retry", 1, 0)}
    once = flows.refresh_reviews(*captured, config.parser_table(spark), F.lit(NOW), work_dir(spark, "lists"))
    assert stored(ledger) == sorted((r.place_id, r.page_number, r.reviewer_name) for r in once.reviews.collect())
    assert {(r.place_id, r.page_number) for r in ledger.pages.read().collect()} == {(r.place_id, r.page_number) for r in once.pages.collect()}


def test_checkpoints_run_out(spark, captured):
    ledger = flows.RunLedger(spark, work_dir(spark, "ledger"), 4)
    go(spark, captured, ledger, 0)
    go(spark, captured, ledger, 1, hours=25)  # from page 0 again, which adds nothing
    assert states(ledger)["long"] == ("waiting", 11, 11) and len([r for r in stored(ledger) if r[0] == "long"]) == 24
    go(spark, captured, ledger, 2, hours=48)
    assert states(ledger)["long"] == ("waiting", 23, 23)
