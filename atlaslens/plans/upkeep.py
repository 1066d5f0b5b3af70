"""Keeping the tables: inserting, merging, updating and dropping rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from atlaslens import config
from atlaslens.operators import stores
from atlaslens.plans import tables
from atlaslens.plans.registry import query


INSERT_IGNORE_SQL = """
    SELECT min(doc_id) AS doc_id, sha256(text) AS unique_review_id FROM documents
    WHERE sha256(text) NOT IN (SELECT sha256(d.text) FROM documents d JOIN labels l ON l.doc_id = d.doc_id)
    GROUP BY sha256(text)"""


def keyed_documents(documents: DataFrame) -> DataFrame:
    return documents.select("doc_id", F.sha2("text", 256).alias("unique_review_id"))


def stored_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a label count as stored already."""
    labels = tables.table(spark, sf_dir, "labels").select("doc_id")
    return keyed_documents(tables.table(spark, sf_dir, "documents").join(labels, "doc_id", "left_semi"))


@query("insert_ignore", INSERT_IGNORE_SQL)
def insert_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents to add: one of each text, none that is stored."""
    batch = keyed_documents(tables.table(spark, sf_dir, "documents"))
    return stores.insert_ignore(batch, stored_reviews(spark, sf_dir), "unique_review_id", F.col("doc_id"))


@query("upsert_set_union", """
    SELECT user_id, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS all_queries,
           CAST(count(DISTINCT event_type) AS INTEGER) AS n_queries
    FROM events GROUP BY user_id""")
def upsert_set_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queries that found each place: those stored from the first half of the month and the new ones."""
    source = tables.table(spark, sf_dir, "events").select("user_id", "event_type", "ts")
    early = F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")
    store = source.where(early).groupBy("user_id").agg(F.collect_set("event_type").alias("all_queries"))
    merged = stores.upsert_set(store, source.where(~early), "user_id", "all_queries", "event_type")
    return merged.select("user_id", F.array_join("all_queries", ",").alias("all_queries"), F.size("all_queries").alias("n_queries"))


@query("freshness_update", """
    SELECT c_custkey, coalesce(strftime(CASE WHEN d IS NOT NULL THEN d WHEN c_acctbal > 0 THEN DATE '1994-05-01' END, '%Y-%m-%d'), '') AS last_scraped,
           coalesce(strftime(d, '%Y-%m-%d'), '') AS english
    FROM customer LEFT JOIN (SELECT o_custkey, CAST(max(o_orderdate) FILTER (o_orderstatus = 'F') AS DATE) AS d FROM orders GROUP BY 1) ON o_custkey = c_custkey""")
def freshness_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Date of the last scrape set where there was one, as a column and as a map entry."""
    places = tables.table(spark, sf_dir, "customer").select(
        "c_custkey", F.when(F.col("c_acctbal") > 0, F.to_date(F.lit("1994-05-01"))).alias("last_scraped"),
        F.expr("cast(map() as map<string, date>)").alias("by_language"),
    )
    done = tables.table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        # Places with open orders only have no date; an update without a value leaves a place as it is.
        F.to_date(F.max(F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate")))).alias("last_scraped")
    )
    updated = stores.update_column(places, done, "c_custkey", "last_scraped")
    mapped = stores.update_map_entry(updated, done, "c_custkey", "by_language", F.lit("en"), "last_scraped")
    return mapped.select(
        "c_custkey", F.coalesce(tables.day_text("last_scraped"), F.lit("")).alias("last_scraped"),
        F.coalesce(tables.day_text(F.try_element_at("by_language", F.lit("en"))), F.lit("")).alias("english"),
    )


@query("retention", """
    SELECT event_id, (epoch_us(ts) + 1209600000000 - (SELECT max(epoch_us(ts)) FROM events)) AS left_us
    FROM events WHERE epoch_us(ts) + 1209600000000 > (SELECT max(epoch_us(ts)) FROM events)""")
def retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored rows still within 14 days, with the time they have left."""
    source = tables.events(spark, sf_dir)
    now = tables.latest(source, "at_us")
    ttl = F.lit(config.PAGE_RETENTION_S).cast("long")
    kept = source.where(stores.unexpired(F.col("at_us"), ttl, now))
    return kept.select("event_id", (F.col("at_us") + ttl * 1_000_000 - now).alias("left_us"))
