"""Place rows: normalising, defaults, one row per place."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from atlaslens import config, schemas
from atlaslens.functions import geo
from atlaslens.operators.dedupe import first_per_key


def default_priority(priority: Column, types: Column) -> Column:
    """A given priority stays; otherwise 2 for places to eat or drink and 1 for others."""
    eats = F.arrays_overlap(types, F.array(*(F.lit(kind) for kind in config.PLACE_TYPES_FIRST)))
    return F.coalesce(priority, F.when(eats, F.lit(2)).otherwise(F.lit(1)))


def with_place_types(df: DataFrame) -> DataFrame:
    """``types`` as ``types_en``, an empty list where missing."""
    if "types" not in df.columns:
        return df.withColumn("types_en", F.expr("cast(array() as array<string>)"))
    return df.withColumn(
        "types_en", F.coalesce("types", F.expr("cast(array() as array<string>)"))
    ).drop("types")


def with_coordinates(df: DataFrame) -> DataFrame:
    """``geometry.location`` as ``coords`` and the two cells of the point."""
    flat = df.withColumn(
        "coords", F.struct(F.col("geometry.location.lat").alias("lat"), F.col("geometry.location.lng").alias("lng"))
    ).drop("geometry")
    return geo.with_location_cells(flat, F.col("coords.lat"), F.col("coords.lng"))


def with_searched_cells(df: DataFrame) -> DataFrame:
    """The fine cell a response was asked for (``searched_cell``, if there) and its coarse one."""
    if "searched_cell" not in df.columns:
        return df
    cell = F.col("searched_cell")
    return df.withColumns({
        "search_cell_fine": cell, "search_cell_coarse": geo.parent_cell(cell, geo.FINE_LEVEL, geo.COARSE_LEVEL),
    }).drop("searched_cell")


def with_defaults(df: DataFrame) -> DataFrame:
    """Priority and flag defaults; given values stay."""
    given = {name: F.col(name) if name in df.columns else F.lit(None) for name in ("priority", "unserpable")}
    return df.withColumns({
        "priority": default_priority(given["priority"].cast("int"), F.col("types_en")),
        "unserpable": F.coalesce(given["unserpable"].cast("boolean"), F.lit(False)),
    })


def with_provenance(df: DataFrame, query: Column, as_of: Column) -> DataFrame:
    """Where and when a place was found. No language has been scraped yet."""
    data_id = F.col("data_id") if "data_id" in df.columns else F.lit(None).cast("string")
    return df.withColumns({
        "search_query": query,
        "query_ds": F.to_date(as_of),
        "added_at": as_of,
        "last_scraped": F.expr("cast(map() as map<string, date>)"),
        "data_id": data_id,
        "all_queries": F.when(query.isNotNull(), F.array(query)).otherwise(F.expr("cast(array() as array<string>)")),
    })


def allowed_columns(df: DataFrame) -> DataFrame:
    """Only the columns that may be stored for a place."""
    return df.select(*(column for column in df.columns if column in schemas.PLACE_COLUMNS))


def normalise_places(results: DataFrame, query: Column, as_of: Column) -> DataFrame:
    """Place results as storable place rows, in one projection."""
    located = with_searched_cells(with_coordinates(with_place_types(results)))
    rows = with_provenance(with_defaults(located), query, as_of)
    return allowed_columns(rows)


def union_result_pages(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Result pages with differing columns, one below the other."""
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first


def one_per_place(places: DataFrame, *order: Column) -> DataFrame:
    """First row of each place in the given total order."""
    return first_per_key(places, ["place_id"], order)
