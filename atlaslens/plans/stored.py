"""Tables that are kept: stores that grow by batches, written and read within the query."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from pyspark.sql.types import StructType

from atlaslens.operators import keyed_store, search
from atlaslens.operators.day_store import DayStore
from atlaslens.operators.keyed_store import KeyedStore
from atlaslens.plans import discovery, tables
from atlaslens.plans.registry import ORACLES, query
from atlaslens.session import work_dir
from atlaslens.sources import responses
from atlaslens.streaming import jobs


@query("store_insert", """
    WITH r AS (SELECT doc_id, lang, sha256(text) AS unique_review_id, text FROM documents)
    SELECT unique_review_id, coalesce(min(doc_id) FILTER (lang = 'en'), min(doc_id)) AS doc_id, text FROM r GROUP BY unique_review_id, text""")
def store_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A review store after two batches, English ones first; a review that is stored is not added again."""
    reviews = tables.table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("unique_review_id"), "text", "lang")
    store = KeyedStore(spark, work_dir(spark, "reviews"), ["unique_review_id"])
    english = F.col("lang").eqNullSafe("en")
    store.insert(reviews.where(english).drop("lang"), F.col("doc_id"))
    store.insert(reviews.where(~english).drop("lang"), F.col("doc_id"))
    return store.read().select("unique_review_id", "doc_id", "text")


@query("store_set_union", ORACLES["upsert_set_union"])
def store_set_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queries that found each place, kept as rows in a store and gathered when read."""
    pairs = tables.table(spark, sf_dir, "events").select("user_id", F.col("event_type").alias("query"), "ts")
    store = KeyedStore(spark, work_dir(spark, "queries"), ["user_id", "query"])
    early = F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")
    for part in (early, ~early):
        store.insert(pairs.where(part).select("user_id", "query"))
    found = keyed_store.sets(store.read(), "user_id", "query", "all_queries")
    return found.select("user_id", F.array_join("all_queries", ",").alias("all_queries"), F.size("all_queries").alias("n_queries"))


@query("store_freshness", ORACLES["freshness_update"])
def store_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Date of the last scrape set in a stored table, as a column and as a map entry; only buckets with a change are written."""
    store = KeyedStore(spark, work_dir(spark, "places"), ["c_custkey"])
    store.insert(tables.table(spark, sf_dir, "customer").select(
        "c_custkey", F.when(F.col("c_acctbal") > 0, F.to_date(F.lit("1994-05-01"))).alias("last_scraped"),
        F.expr("cast(map() as map<string, date>)").alias("by_language"),
    ))
    done = tables.table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.to_date(F.max("o_orderdate")).alias("last_scraped")
    )
    store.update(done, keyed_store.set_column("last_scraped", "c_custkey"))
    store.update(done, keyed_store.set_map_entry("by_language", "c_custkey", "en", "last_scraped"))
    return store.read().select(
        "c_custkey", F.coalesce(tables.day_text("last_scraped"), F.lit("")).alias("last_scraped"),
        F.coalesce(tables.day_text(F.try_element_at("by_language", F.lit("en"))), F.lit("")).alias("english"),
    )


@query("s_store_reviews", """
    SELECT sha256(text) AS unique_review_id, min(doc_id) AS doc_id, text FROM documents GROUP BY text""")
def s_store_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole reviews that a stream adds to a store, each batch once however often it is delivered."""
    stream = jobs.file_stream(spark, tables.stream_glob(sf_dir, "documents"), tables.DOCUMENTS)
    reviews = stream.select(F.sha2("text", 256).alias("unique_review_id"), "doc_id", "text")
    store = KeyedStore(spark, work_dir(spark, "stream-store"), ["unique_review_id"])
    out = work_dir(spark, "stream-reviews")
    for _ in range(2):  # the second run finds nothing new to read
        jobs.insert_into(reviews, store, out, "reviews", F.col("doc_id"))
    return store.read().select("unique_review_id", "doc_id", "text")


@query("cache_days", """
    WITH entries AS (
        SELECT *, unnest(range(CASE o_orderstatus WHEN 'F' THEN 1 ELSE 0 END, n + 1)) AS i FROM (
            SELECT *, CAST(o_orderpriority[1] AS INTEGER) AS n FROM orders) WHERE o_orderstatus IN ('O', 'F') AND o_orderkey % 2 = 1
    ), hits AS (
        SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey, i) AS rn FROM entries WHERE i % 2 = 1
    )
    SELECT 'p' || c_custkey AS place_id, rn IS NOT NULL AS cache_hit, 'd' || o_orderkey || '_' || i AS data_id,
           CASE WHEN o_orderstatus = 'F' THEN 'll_' WHEN i = 0 THEN 'pr' ELSE 'pasf_' END || CASE WHEN i = 0 AND o_orderstatus = 'O' THEN '' ELSE CAST(i AS VARCHAR) END AS tag,
           CAST(CASE o_orderstatus WHEN 'F' THEN n ELSE n + 1 END AS INTEGER) AS n_entries, CAST(i % 5 + 1 AS INTEGER) AS rating,
           'Place ' || o_orderkey || '_@' || (o_custkey % 80) AS query_params, CASE WHEN rn IS NOT NULL THEN '2024-03-02' END AS query_day
    FROM customer LEFT JOIN hits ON o_custkey = c_custkey AND rn = 1""")
def cache_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places looked up in the search results of the last day cached, with a field that only the cached entry has."""
    orders = tables.table(spark, sf_dir, "orders")
    found = responses.search_entries(discovery.search_responses(orders))
    point = F.concat(F.lit("@"), F.col("gps_coordinates.latitude").cast("int"))
    key = F.col("o_orderkey")
    days = [dt.date(2024, 3, 1), dt.date(2024, 3, 2)]
    store = DayStore(spark, work_dir(spark, "cache"), "query_ds", StructType.fromDDL(search.CACHE_ROW + ", o_orderkey long, position int"))
    for number, day in enumerate([*days, days[1]]):  # the last run is repeated, and replaces itself
        own = found.where(key % 2 == min(number, 1))
        at = F.to_timestamp(F.lit(f"{day} 10:00:00"))
        rows = search.cache_rows(own, F.concat(F.lit("Place "), key), point, at, "o_orderkey", "position")
        store.append(rows, f"run-{min(number, 1)}")
    cached = store.read(since=days[1])
    looked = search.look_up_cache(tables.places(spark, sf_dir).select("place_id"), cached, F.col("query_dt"), key, F.col("position"))
    return looked.select(
        "place_id", "cache_hit", F.col("cached_data_id").alias("data_id"), F.col("cached_local_results").alias("tag"),
        F.col("cached_n_entries").alias("n_entries"), F.try_variant_get("cached_place_results", "$.rating", "int").alias("rating"),
        F.col("cached_query_params").alias("query_params"), F.date_format("cached_query_ds", "yyyy-MM-dd").alias("query_day"),
    )
