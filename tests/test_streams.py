"""Streams: same rows as in batch, files arriving later, restarts, and open spans."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from atlaslens.operators import paging, spans, stores
from atlaslens.session import work_dir
from atlaslens.sources.requests import check_requests
from atlaslens.streaming import jobs


@pytest.fixture
def folder(spark):
    return work_dir(spark, "test")


def test_intake_of_files_that_arrive_later(spark, folder):
    def arrive(*bodies):
        spark.createDataFrame([(bytearray(b.encode()),) for b in bodies], "body binary").coalesce(1).write.mode("append").parquet(f"{folder}/in")

    full = '{"place_id":"p%d","data_id":"d","name":"ñ","language":"en","country_domain":"es","priority":1,"last_scraped":"2024-01-01"}'
    stream = lambda: jobs.checked_requests(jobs.file_stream(spark, f"{folder}/in", "body binary", max_files=1)).select(
        "request.place_id", "request.name", "outcome")
    arrive(full % 1, "{}")
    arrive(full % 2)
    assert jobs.run(stream(), f"{folder}/out", ("outcome",)).count() == 3
    # Nothing new: a restart repeats nothing.
    assert jobs.run(stream(), f"{folder}/out", ("outcome",)).count() == 3
    arrive(full % 3, "broken")
    rows = sorted(map(tuple, jobs.run(stream(), f"{folder}/out", ("outcome",)).collect()), key=str)
    assert rows == sorted([("p1", "ñ", "ok"), ("p2", "ñ", "ok"), ("p3", "ñ", "ok"), (None, None, "keys"), (None, None, "malformed")], key=str)


def test_same_outcomes_as_batch(spark, sf_dir):
    from atlaslens.plans import refresh, tables

    bodies = tables.request_bodies(tables.table(spark, sf_dir, "events")).withColumn("bytes", F.encode("body", "UTF-8"))
    batch = refresh.checked_columns(check_requests(bodies.withColumn("body", F.decode("bytes", "UTF-8"))))
    from atlaslens.plans.catalog import QUERIES
    streamed = QUERIES["s_request_ingest"](spark, sf_dir)
    assert batch.exceptAll(streamed.select(batch.columns)).isEmpty() and batch.count() == streamed.count()


def test_closed_spans_are_those_of_the_batch(spark, folder):
    """A hot place with most sets, over two batches of files; open spans are held back."""
    start = dt.datetime(2024, 1, 1)
    rows = [("hot" if i % 3 else f"p{i % 7}", start + dt.timedelta(seconds=(i * 977) % 40_000)) for i in range(2000)]
    rows += [("edge", start), ("edge", start + dt.timedelta(seconds=60)), ("edge", start + dt.timedelta(seconds=119, microseconds=999_999))]
    df = spark.createDataFrame(rows, "place_id string, at timestamp")
    df.repartition(2).write.parquet(f"{folder}/in")
    stream = jobs.file_stream(spark, f"{folder}/in", "place_id string, at timestamp")
    closed = jobs.run(jobs.alive_sessions(stream, ["place_id"], "at", 60, delay="10 seconds"), f"{folder}/out")
    us = lambda c: F.unix_micros(c)
    got = {(r[0], r[1], r[2], r[3]) for r in closed.select("place_id", us("span_start"), us("last_set"), "n_sets").collect()}
    every = {tuple(r) for r in spans.alive_spans(df.withColumn("us", us("at")), "place_id", "us", 60).collect()}
    assert got < every
    latest = max(at for _, at in rows).replace(tzinfo=dt.timezone.utc).timestamp() * 1e6
    assert all(last + 59_999_999 > latest - 10_000_000 for _, _, last, _ in every - got)
    # Exactly a ttl apart ends a span, a microsecond less does not.
    assert sorted(n for place, _, _, n in every if place == "edge") == [1, 2]


def test_routes_and_abort(spark, folder):
    rows = [("a", "x" * 200, 3), ("b", "x" * 200, 0), ("c", "x" * 101 + "refused", 0), ("d", "short", 0)]
    spark.createDataFrame(rows, "id string, content string, n int").write.parquet(f"{folder}/in")
    stream = jobs.file_stream(spark, f"{folder}/in", "id string, content string, n int")
    written = jobs.run(jobs.routed_pages(stream, F.col("content"), F.col("n"), marker="refused"), f"{folder}/out", ("route",))
    assert {r.id: (r.outcome, r.route) for r in written.collect()} == {
        "a": ("OK", "ok"), "b": ("NO_ROWS", "retry"), "c": ("BLOCKED", "abort"), "d": ("EMPTY", "retry")}
    # The pages are on disk before the run is stopped.
    with pytest.raises(RuntimeError):
        jobs.raise_on_abort(written)
    jobs.raise_on_abort(written.where("route <> 'abort'"))


def test_staged_reviews_are_added_once(spark, folder):
    new = [("r1", 1), ("r1", 2), ("r2", 3)]
    spark.createDataFrame(new, "id string, n int").write.parquet(f"{folder}/in")
    spark.createDataFrame([("r2", 0)], "id string, n int").write.parquet(f"{folder}/store")

    def add():
        staged = jobs.run(jobs.file_stream(spark, f"{folder}/in", "id string, n int"), f"{folder}/staged")
        fresh = stores.insert_ignore(staged, spark.read.parquet(f"{folder}/store"), "id", F.col("n"))
        stores.append(fresh, f"{folder}/store")
        return sorted(map(tuple, spark.read.parquet(f"{folder}/store").collect()))

    assert add() == [("r1", 1), ("r2", 0)]
    assert add() == [("r1", 1), ("r2", 0)]


def test_messages_sent_are_messages_received(spark, folder):
    from atlaslens.operators.scheduling import as_message, shape_requests
    from atlaslens import config

    due = spark.createDataFrame([("p1", "d1", "A", 2, None, "es"), ("p2", "d2", "B", None, dt.date(2024, 1, 1), "es")],
                                "place_id string, data_id string, name string, priority int, last_scraped date, country string")
    stores.append_messages(shape_requests(due, config.localization_table(spark)), f"{folder}/queue", as_message())
    stream = jobs.file_stream(spark, f"{folder}/queue", "value string", file_format="text")
    got = jobs.run(check_requests(stream, "value").select("request.*", "outcome"), f"{folder}/got")
    assert sorted((r.place_id, r.priority, r.language, r.country_domain, r.last_scraped, r.outcome) for r in got.collect()) == [
        ("p1", 2, "en", "es", "2017-01-01", "ok"), ("p2", None, "en", "es", "2024-01-01", "ok")]


def test_retention(spark):
    rows = spark.createDataFrame([(0, 10), (5, 10), (0, 5)], "at_s long, ttl long")
    kept = rows.where(stores.unexpired(F.col("at_s") * 1_000_000, F.col("ttl"), F.lit(10_000_000)))
    assert [tuple(r) for r in kept.collect()] == [(5, 10)]
    days = spark.createDataFrame([(dt.date(2024, 1, d),) for d in (1, 2, 3)], "day date")
    gone = days.where(stores.expired_days(F.col("day"), F.lit(dt.date(2024, 1, 16)), 14 * 86400))
    assert [r.day.day for r in gone.collect()] == [1]


def test_versions_are_never_overwritten(spark, folder):
    first = spark.createDataFrame([("a", 1)], "k string, v int")
    stores.write_version(first, f"{folder}/t", "run=1")
    stores.write_version(stores.read_version(spark, f"{folder}/t", "run=1").withColumn("v", F.col("v") + 1), f"{folder}/t", "run=2")
    assert stores.read_version(spark, f"{folder}/t", "run=2").first().v == 2
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        stores.write_version(first, f"{folder}/t", "run=1")


def test_work_dir_follows_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        assert work_dir(spark, "x").startswith(f"{base.rstrip('/')}/x-")
    assert work_dir(spark, "x") != work_dir(spark, "x")


class OnCluster:
    """The parts of a cluster session that choosing a folder looks at."""

    class conf:
        get = staticmethod(lambda key, default=None: default)

    class sparkContext:
        master = "yarn"


def test_no_machine_local_folder_on_a_cluster():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        work_dir(OnCluster, "x")


@pytest.mark.parametrize("name", ["s_lease_spans", "s_page_checkpoint"])
@pytest.mark.parametrize("max_files", [None, 1])
def test_no_set_is_lost_however_the_files_come(name, max_files, spark, sf_dir, tmp_path):
    from atlaslens.plans import streams, tables

    events = tables.table(spark, sf_dir, "events")
    events.repartition(6).write.parquet(f"{tmp_path}/events.parquet")
    build = getattr(streams, name)
    scattered, whole = build(spark, str(tmp_path), max_files), build(spark, sf_dir)
    assert scattered.agg(F.sum("n_sets")).first()[0] == events.count()
    assert scattered.exceptAll(whole).isEmpty() and scattered.count() == whole.count()
    assert {r.closed for r in whole.select("closed").distinct().collect()} == {True, False}
