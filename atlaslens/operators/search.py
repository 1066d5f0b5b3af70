"""Linking search entries back to the places table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from atlaslens.operators.dedupe import first_per_key


def missing_id(data_id: Column) -> Column:
    """Null and empty count as unresolved."""
    return F.coalesce(data_id, F.lit("")) == ""


def one_link_per_place(entries: DataFrame, *order: Column) -> DataFrame:
    """The entry that decides a place's identifier; entries without a place are dropped."""
    return first_per_key(entries.where(F.col("place_id").isNotNull()), ["place_id"], order)


def classify_links(entries: DataFrame, places: DataFrame) -> DataFrame:
    """Add the outcome of linking: inserted, unchanged or updated.

    ``entries`` and ``places`` hold one row per place_id.
    """
    known = places.select("place_id", F.col("data_id").alias("_known_id"), F.lit(True).alias("_known"))
    outcome = (
        F.when(F.col("_known").isNull(), "inserted")
        .when(F.col("_known_id").eqNullSafe(F.col("data_id")), "unchanged")
        .otherwise("updated")
    )
    return entries.join(known, "place_id", "left").withColumn("link_outcome", outcome).drop("_known_id", "_known")


def apply_links(places: DataFrame, links: DataFrame) -> DataFrame:
    """Places with the identifiers of the links, and new places added.

    Columns a link does not have are null on the added rows.
    """
    ids = links.select("place_id", F.col("data_id").alias("_link_id"), F.lit(True).alias("_linked"))
    updated = (
        places.join(ids, "place_id", "left")
        .withColumn("data_id", F.when(F.col("_linked"), F.col("_link_id")).otherwise(F.col("data_id")))
        .drop("_link_id", "_linked")
    )
    added = links.join(places.select("place_id"), "place_id", "left_anti")
    shared = [column for column in places.columns if column in added.columns]
    return updated.unionByName(added.select(*shared), allowMissingColumns=True)


def mark_unresolved(places: DataFrame, searched: DataFrame) -> DataFrame:
    """Set ``unserpable`` on places that were searched and still have no identifier."""
    keys = searched.select("place_id", F.lit(True).alias("_searched")).distinct()
    failed = F.col("_searched").isNotNull() & missing_id(F.col("data_id"))
    return (
        places.join(keys, "place_id", "left")
        .withColumn("unserpable", F.when(failed, F.lit(True)).otherwise(F.col("unserpable")))
        .drop("_searched")
    )


CACHE_ROW = (
    "place_id string, data_id string, place_results variant, local_results string, n_entries int, search_metadata string, "
    "search_parameters string, search_information string, query_params string, query_dt timestamp, query_ds date"
)


def cache_rows(entries: DataFrame, words: Column, around: Column, at: Column, *more: str) -> DataFrame:
    """Entries of search responses (``responses.search_entries``) as rows of the cache.

    ``place_results`` holds the whole entry and ``local_results`` its tag. The query is
    kept as its words and the point it looked around, joined by an underscore; ``at`` is
    when it was made. ``more`` names further columns to keep. Failed responses are not
    cached.
    """
    return entries.where(F.col("search_error").isNull() & F.col("entry").isNotNull()).select(
        "place_id", "data_id", F.col("entry").alias("place_results"), F.col("tag").alias("local_results"), "n_entries",
        "search_metadata", "search_parameters", "search_information", F.concat(words, F.lit("_"), around).alias("query_params"),
        at.alias("query_dt"), F.to_date(at).alias("query_ds"), *more,
    )


def look_up_cache(requests: DataFrame, cache: DataFrame, *order: Column) -> DataFrame:
    """Requests with the first cached entry of their place and whether there was one.

    A place can be cached many times; it is reduced to one entry before the join, so
    neither side of it repeats a key of the cache.
    """
    hit = first_per_key(cache.where(F.col("place_id").isNotNull()), ["place_id"], order)
    kept = [F.col(column).alias(f"cached_{column}") for column in hit.columns if column != "place_id"]
    return (
        requests.join(hit.select("place_id", *kept, F.lit(True).alias("_hit")), "place_id", "left")
        .withColumn("cache_hit", F.coalesce("_hit", F.lit(False)))
        .drop("_hit")
    )
