"""Streaming queries: each processes all files there are and returns what it wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from atlaslens import config
from atlaslens.operators import stores
from atlaslens.plans import paging as paging_plans, refresh, tables, upkeep
from atlaslens.plans.registry import ORACLES, query
from atlaslens.session import work_dir
from atlaslens.streaming import jobs

# Files in a batch of the request intake; how many there are changes no row.
INTAKE_FILES = 1000


def event_stream(spark: SparkSession, sf_dir: str, max_files: int | None = None) -> DataFrame:
    return jobs.file_stream(spark, tables.stream_glob(sf_dir, "events"), tables.EVENTS, max_files)


def document_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.file_stream(spark, tables.stream_glob(sf_dir, "documents"), tables.DOCUMENTS)


@query("s_request_ingest", ORACLES["request_contract"])
def s_request_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request messages in bytes, decoded, checked and written by outcome."""
    messages = tables.request_bodies(event_stream(spark, sf_dir, INTAKE_FILES)).withColumn("body", F.encode("body", "UTF-8"))
    checked = refresh.checked_columns(jobs.checked_requests(messages))
    return jobs.run(checked, work_dir(spark, "requests"), ("outcome",))


# A span is closed when its last set has run out as of the latest event.
NOW = "(SELECT max(epoch_us(ts)) FROM events)"


def closed(spark: SparkSession, sf_dir: str, ttl_s: int):
    return F.col("last_set_us") + ttl_s * 1_000_000 <= tables.latest(tables.events(spark, sf_dir), "at_us")


@query("s_lease_spans", f"""
    SELECT user_id, span_start_us, last_set_us, n_sets, last_set_us + 3600000000 <= {NOW} AS closed FROM ({refresh.LEASE_SPANS_SQL})""")
def s_lease_spans(spark: SparkSession, sf_dir: str, max_files: int | None = None) -> DataFrame:
    """Spans in which a place stayed in progress, closed or still open."""
    stream = event_stream(spark, sf_dir, max_files).withColumn("at_us", tables.micros("ts"))
    found = jobs.run_slices(stream, work_dir(spark, "leases"), ["user_id"], "at_us", config.LEASE_TTL_S)
    return found.withColumn("closed", closed(spark, sf_dir, config.LEASE_TTL_S))


@query("s_page_checkpoint", f"""
    WITH sets AS (
        SELECT user_id, CASE WHEN event_type IN ('click', 'view') THEN 'en' ELSE 'es' END AS language,
               epoch_us(ts) AS us, event_id, CAST(floor(value) AS INTEGER) AS page_number FROM events
    ), marked AS (
        SELECT *, CASE WHEN us - lag(us) OVER (PARTITION BY user_id, language ORDER BY us) < 86400000000 THEN 0 ELSE 1 END AS starts FROM sets
    ), numbered AS (
        SELECT *, sum(starts) OVER (PARTITION BY user_id, language ORDER BY us ROWS UNBOUNDED PRECEDING) AS span FROM marked
    ), spans AS (
        SELECT user_id, language, min(us) AS span_start_us, max(us) AS last_set_us,
               count(*) AS n_sets, arg_max(page_number, row(us, event_id)) AS page_number
        FROM numbered GROUP BY user_id, language, span
    )
    SELECT user_id, language, span_start_us, last_set_us, n_sets, page_number, last_set_us + 86400000000 <= {NOW} AS closed FROM spans""")
def s_page_checkpoint(spark: SparkSession, sf_dir: str, max_files: int | None = None) -> DataFrame:
    """Last stored page of each place and language while its checkpoint stayed alive."""
    keys, ttl_s = ["user_id", "language"], config.PAGE_CHECKPOINT_TTL_S
    stream = event_stream(spark, sf_dir, max_files).select(
        "user_id", F.when(F.col("event_type").isin("click", "view"), "en").otherwise("es").alias("language"),
        tables.micros("ts").alias("at_us"), "event_id", F.floor("value").cast("int").alias("page_number"),
    )
    found = jobs.run_slices(stream, work_dir(spark, "checkpoints"), keys, "at_us", ttl_s, "event_id", "page_number")
    return found.drop("event_id").withColumn("closed", closed(spark, sf_dir, ttl_s))


@query("s_outcome_route", ORACLES["page_quality"])
def s_outcome_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captured pages written to the ok, retry and abort folders."""
    pages = document_stream(spark, sf_dir).withColumn("n_rows", paging_plans.long_lines())
    routed = jobs.routed_pages(pages, F.col("text"), F.col("n_rows"), marker=paging_plans.MARKER)
    return jobs.run(routed.select("doc_id", "n_rows", "outcome", "route"), work_dir(spark, "routes"), ("route",))


@query("s_review_upsert", upkeep.INSERT_IGNORE_SQL)
def s_review_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews staged by a stream, then added to the store once each."""
    staged = jobs.run(upkeep.keyed_documents(document_stream(spark, sf_dir)), work_dir(spark, "staged"))
    return stores.insert_ignore(staged, upkeep.stored_reviews(spark, sf_dir), "unique_review_id", F.col("doc_id"))
