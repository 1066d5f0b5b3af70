"""Place and search responses as rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from atlaslens import schemas

# Fields of a search entry that have a column of their own. All others stay in the entry.
ENTRY = (
    "struct<place_id: string, data_id: string, title: string, address: string, formatted_address: string, "
    "types: array<string>, position: int, gps_coordinates: struct<latitude: double, longitude: double>>"
)
ENTRY_FIELDS = ("place_id", "data_id", "title", "address", "formatted_address", "types", "position", "gps_coordinates")


def place_results(responses: DataFrame, body: str = "body") -> DataFrame:
    """One row per place of a place-search response; other columns are repeated.

    Pages of results may differ in their fields: missing ones are null. A response
    without a next-page token keeps its rows. A body that cannot be read, or has no
    list of results, gives one row with ``response_error``; an empty list gives one
    row without a place. ``found_places`` leaves both out, ``broken_responses`` returns
    the former.
    """
    carried = [column for column in responses.columns if column != body]
    parsed = responses.select(*carried, F.from_json(body, schemas.PLACE_RESPONSE).alias("_response"))
    # The results leave the parsed response before they are exploded, so no row carries all of it.
    fields = parsed.select(*carried, "_response.next_page_token", F.col("_response.results").alias("_results"))
    error = F.when(F.col("_results").isNull(), F.lit("no results")).alias("response_error")
    # An outer explode: a plain one makes Spark test the body in a filter of its own and so parse it twice.
    exploded = fields.select(*carried, "next_page_token", error, F.explode_outer("_results").alias("_place"))
    return exploded.select(*carried, "next_page_token", "response_error", F.col("_place").isNotNull().alias("is_place"), "_place.*")


def found_places(results: DataFrame) -> DataFrame:
    return results.where("is_place").drop("is_place", "response_error")


def broken_responses(results: DataFrame) -> DataFrame:
    return results.where(F.col("response_error").isNotNull())


def search_entries(responses: DataFrame, body: str = "body") -> DataFrame:
    """One row per entry of a search response, with a tag telling where it stood.

    The primary place is ``pr``, the first group of places also searched for is
    ``pasf_<position>``; a plain result list is ``ll_<position>``. The metadata is
    repeated on each row, as is ``n_entries``, how many the response has. ``entry``
    is the entry as it came, with all its fields, whatever they are. A response with
    an error, or of an unknown shape, gives one row with ``search_error`` set, so
    that nothing is lost on the way.

    The body is parsed once, to a variant; fields are taken from that.
    """
    metadata = ["search_metadata", "search_parameters", "search_information"]
    carried = [column for column in responses.columns if column != body]
    parsed = responses.select(*carried, F.try_parse_json(body).alias("_response"))
    part = lambda path, kind: F.try_variant_get("_response", path, kind)
    parts = parsed.select(
        *carried, *(part(f"$.{name}", "string").alias(name) for name in metadata), part("$.error", "string").alias("_error"),
        # Null where the field is something else than an object or a list.
        part("$.place_results", "struct<place_id: variant>").isNotNull().alias("_is_place"),
        part("$.place_results", "variant").alias("_primary"),
        part("$.place_results.people_also_search_for[0].local_results", "array<variant>").alias("_related"),
        part("$.local_results", "array<variant>").alias("_list"),
    )
    none = F.expr("cast(array() as array<variant>)")
    entries = F.when(F.col("_is_place"), F.concat(F.array("_primary"), F.coalesce("_related", none))).otherwise(F.col("_list"))
    # Entries and metadata are columns of their own before the explode, so no row carries the response.
    listed = parts.select(*carried, *metadata, "_error", "_is_place", entries.alias("_entries"))
    failed = F.when(F.col("_entries").isNull(), F.coalesce("_error", F.lit("unexpected response"))).alias("search_error")
    exploded = listed.select(
        *carried, *metadata, failed, "_is_place", F.coalesce(F.size("_entries"), F.lit(0)).alias("n_entries"), F.posexplode_outer("_entries").alias("_at", "entry")
    )
    fields = F.try_variant_get("entry", "$", ENTRY)
    tag = F.when(F.col("_is_place") & (F.col("_at") == 0), "pr").otherwise(
        F.concat(F.when(F.col("_is_place"), "pasf_").otherwise("ll_"), F.col("position").cast("string"))
    )
    named = exploded.select(*carried, *metadata, "search_error", "n_entries", "entry", "_is_place", "_at", fields.alias("_fields")).select("*", "_fields.*")
    return named.select(
        *carried, *metadata, "search_error", "n_entries", F.when(F.col("search_error").isNull(), tag).alias("tag"), *ENTRY_FIELDS, "entry"
    )


def normalise_entries(entries: DataFrame) -> DataFrame:
    """Search entries in the shape of place results: name, geometry, formatted address."""
    return entries.withColumns({
        "name": F.col("title"),
        "formatted_address": F.coalesce("formatted_address", "address"),
        "geometry": F.struct(
            F.struct(
                F.col("gps_coordinates.latitude").alias("lat"), F.col("gps_coordinates.longitude").alias("lng")
            ).alias("location")
        ),
    }).drop("title", "address", "gps_coordinates")
