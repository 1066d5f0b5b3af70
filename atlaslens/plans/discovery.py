"""Places from responses, map cells, search entries and identifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from atlaslens.functions import geo
from atlaslens.operators import places as pl, resolve, search
from atlaslens.plans import tables
from atlaslens.plans.registry import query
from atlaslens.sources import responses


def x_sql(lng: str, level: int) -> str:
    return f"greatest(0, least({2**level - 1}, CAST(floor(({lng} + 180) / 360 * {2**level}) AS BIGINT)))"


def y_sql(lat: str, level: int) -> str:
    bounded = f"radians(greatest(-85.05112878e0, least(85.05112878e0, {lat})))"
    return (
        f"greatest(0, least({2**level - 1}, CAST(floor((1 - ln(tan({bounded}) + 1 / cos({bounded})) / pi()) / 2 * {2**level}) AS BIGINT)))"
    )


def cell_sql(x: str, y: str, level: int) -> str:
    return f"({level * 2**56} + {x} * {2**28} + {y})"


POINTS_SQL = """
    points AS (
        SELECT *, (c_custkey * 37 % 12000) / 100e0 - 60e0 AS lat, (c_custkey * 91 % 36000) / 100e0 - 180e0 AS lng FROM customer
    )"""


def place_responses(customers: DataFrame) -> DataFrame:
    """Each customer as a place-search response in JSON."""
    point = tables.customer_points()
    types = F.when(F.col("c_acctbal") > 5000, F.array(F.lower("c_mktsegment"), F.lit("restaurant"))).when(
        F.col("c_acctbal") > 0, F.array(F.lower("c_mktsegment"))
    )
    place = F.struct(
        F.concat(F.lit("p"), F.col("c_custkey")).alias("place_id"),
        F.col("c_name").alias("name"),
        types.alias("types"),
        F.when(F.col("c_nationkey") > 20, F.col("c_nationkey")).alias("priority"),
        F.struct(F.struct(point["lat"].alias("lat"), point["lng"].alias("lng")).alias("location")).alias("geometry"),
    )
    body = F.to_json(F.struct(F.array(place).alias("results"), F.col("c_mktsegment").alias("next_page_token")))
    return customers.select(body.alias("body"))


@query("places_normalise", f"""
    WITH {POINTS_SQL},
    cells AS (SELECT *, {x_sql("lng", 17)} AS x, {y_sql("lat", 17)} AS y FROM points)
    SELECT 'p' || c_custkey AS place_id, c_name AS name,
           CASE WHEN c_acctbal > 5000 THEN lower(c_mktsegment) || ',restaurant' WHEN c_acctbal > 0 THEN lower(c_mktsegment) ELSE '' END AS types,
           CASE WHEN c_nationkey > 20 THEN c_nationkey WHEN c_acctbal > 5000 THEN 2 ELSE 1 END AS priority,
           false AS unserpable, round(lat, 6) AS lat, round(lng, 6) AS lng,
           {cell_sql("x", "y", 17)} AS loc_cell_fine, {cell_sql("(x // 8)", "(y // 8)", 14)} AS loc_cell_coarse,
           'coffee' AS queries, '2024-01-31' AS query_ds
    FROM cells""")
def places_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places from search responses: coordinates, cells, defaults and provenance."""
    results = responses.found_places(responses.place_results(place_responses(tables.table(spark, sf_dir, "customer"))))
    rows = pl.normalise_places(results, F.lit("coffee"), F.timestamp_seconds(F.lit(1706700000)))
    return rows.select(
        "place_id", "name", F.array_join("types_en", ",").alias("types"), "priority", "unserpable",
        F.round("coords.lat", 6).alias("lat"), F.round("coords.lng", 6).alias("lng"),
        "loc_cell_fine", "loc_cell_coarse", F.array_join("all_queries", ",").alias("queries"),
        tables.day_text("query_ds").alias("query_ds"),
    )


@query("priority", """
    SELECT p_partkey, CASE WHEN p_size > 40 THEN p_size WHEN p_type IN ('PROMO', 'SMALL') THEN 2 ELSE 1 END AS priority,
           p_size > 45 AS unserpable FROM part""")
def priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Default priority and flag of places; given values stay."""
    kinds = (
        F.when(F.col("p_type") == "PROMO", F.array(F.lit("bar")))
        .when(F.col("p_type") == "SMALL", F.array(F.lit("store"), F.lit("cafe")))
        .when(F.col("p_type") == "LARGE", F.array(F.lit("museum")))
    )
    given = tables.table(spark, sf_dir, "part").select(
        "p_partkey", kinds.alias("types"),
        F.when(F.col("p_size") > 40, F.col("p_size")).alias("priority"),
        F.when(F.col("p_size") > 45, True).alias("unserpable"),
    )
    return pl.with_defaults(pl.with_place_types(given)).select("p_partkey", "priority", "unserpable")


@query("geocell", f"""
    WITH points AS (SELECT vec_id, CAST(embedding[1] AS DOUBLE) * 180 AS lat, CAST(embedding[2] AS DOUBLE) * 360 AS lng FROM embeddings),
    cells AS (SELECT vec_id, {x_sql("lng", 17)} AS x, {y_sql("lat", 17)} AS y, {x_sql("lng", 14)} AS coarse_x, {y_sql("lat", 14)} AS coarse_y FROM points)
    SELECT vec_id, x, y, coarse_x, coarse_y, {cell_sql("x", "y", 17)} AS cell_fine,
           {cell_sql("coarse_x", "coarse_y", 14)} AS cell_coarse, true AS nested FROM cells""")
def geocell(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Map cells of points at both levels; the coarse cell is the parent of the fine one."""
    points = tables.table(spark, sf_dir, "embeddings").select(
        "vec_id", (F.get("embedding", 0).cast("double") * 180).alias("lat"), (F.get("embedding", 1).cast("double") * 360).alias("lng")
    )
    fine, coarse = F.col("loc_cell_fine"), F.col("loc_cell_coarse")
    return geo.with_location_cells(points, F.col("lat"), F.col("lng")).select(
        "vec_id", geo.cell_x(fine).alias("x"), geo.cell_y(fine).alias("y"),
        geo.cell_x(coarse).alias("coarse_x"), geo.cell_y(coarse).alias("coarse_y"),
        fine.alias("cell_fine"), coarse.alias("cell_coarse"),
        (geo.parent_cell(fine, geo.FINE_LEVEL, geo.COARSE_LEVEL) == coarse).alias("nested"),
    )


@query("geocell_cover", f"""
    WITH {POINTS_SQL},
    cells AS (SELECT DISTINCT {x_sql("lng", 14)} AS cx, {y_sql("lat", 14)} AS cy FROM points),
    children AS (SELECT *, cx * 8 + dx AS x, cy * 8 + dy AS y FROM cells, range(8) a(dx), range(8) b(dy)),
    centres AS (SELECT *, degrees(atan(sinh(pi() * (1 - 2 * (y + 0.5e0) / {2**17})))) AS lat FROM children)
    SELECT {cell_sql("cx", "cy", 14)} AS cell, {cell_sql("x", "y", 17)} AS child_cell, round(lat, 6) AS centre_lat,
           round((x + 0.5e0) / {2**17} * 360 - 180, 6) AS centre_lng,
           CAST(floor({geo.EARTH_CIRCUMFERENCE_M}e0 / {2**17} * cos(radians(lat))) AS BIGINT) AS radius_m
    FROM centres""")
def geocell_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The finer cells to search in each coarse cell that has a customer."""
    point = tables.customer_points()
    cells = tables.table(spark, sf_dir, "customer").select(
        geo.point_cell(point["lat"], point["lng"], geo.COARSE_LEVEL).alias("cell")
    ).distinct()
    return geo.cover(cells).select(
        "cell", "child_cell", F.round("centre_lat", 6).alias("centre_lat"), F.round("centre_lng", 6).alias("centre_lng"), "radius_m"
    )


@query("scan_dedupe", """
    WITH pages AS (
        SELECT c_nationkey || '_' || CAST(floor(c_acctbal / 100) AS BIGINT) AS place_id, c_name AS name, c_mktsegment AS cell, NULL AS balance, 1 AS page, c_custkey AS k FROM customer
        UNION ALL
        SELECT s_nationkey || '_' || CAST(floor(s_acctbal / 100) AS BIGINT), s_name, NULL, s_acctbal, 2, s_suppkey FROM supplier
    ), ranked AS (SELECT *, row_number() OVER (PARTITION BY place_id ORDER BY page, k) AS rn FROM pages)
    SELECT place_id, name, coalesce(cell, '') AS cell, coalesce(balance, 0) AS balance, page FROM ranked WHERE rn = 1""")
def scan_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Result pages with differing columns put together, one row per place."""

    def spot(nation: str, balance: str) -> Column:
        return F.concat_ws("_", F.col(nation), F.floor(F.col(balance) / 100)).alias("place_id")

    first = tables.table(spark, sf_dir, "customer").select(
        spot("c_nationkey", "c_acctbal"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("cell"),
        F.lit(1).alias("page"), F.col("c_custkey").alias("k"),
    )
    second = tables.table(spark, sf_dir, "supplier").select(
        spot("s_nationkey", "s_acctbal"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"),
        F.lit(2).alias("page"), F.col("s_suppkey").alias("k"),
    )
    found = pl.one_per_place(pl.union_result_pages(first, second), F.col("page"), F.col("k"))
    return found.select(
        "place_id", "name", F.coalesce("cell", F.lit("")).alias("cell"), F.coalesce("balance", F.lit(0.0)).alias("balance"), "page"
    )


def search_responses(orders: DataFrame) -> DataFrame:
    """Each order as a search response; its status decides the shape, its priority the number of entries."""
    key = F.col("o_orderkey")
    count = F.substring("o_orderpriority", 1, 1).cast("int")

    def entry(position: Column) -> Column:
        return F.struct(
            F.when(position % 2 == 1, F.concat(F.lit("p"), F.col("o_custkey"))).alias("place_id"),
            F.concat(F.lit("d"), key, F.lit("_"), position).alias("data_id"),
            F.concat(F.lit("Place "), key, F.lit("/"), position).alias("title"),
            F.concat(F.lit("Street "), position).alias("address"),
            position.cast("int").alias("position"),
            (position % 5 + 1).cast("int").alias("rating"),  # of no use to the library, but part of the entry
            F.struct(
                (F.col("o_custkey") % 80).cast("double").alias("latitude"), position.cast("double").alias("longitude")
            ).alias("gps_coordinates"),
        )

    entries = F.transform(F.sequence(F.lit(1), count), entry)
    primary = entry(F.lit(0))
    main = F.struct(
        *(primary[name].alias(name) for name in ("place_id", "data_id", "title", "address", "position", "rating", "gps_coordinates")),
        F.array(F.struct(entries.alias("local_results"))).alias("people_also_search_for"),
    )
    metadata = F.struct(F.col("o_orderpriority").alias("id")).alias("search_metadata")
    body = (
        F.when(F.col("o_orderstatus") == "O", F.to_json(F.struct(metadata, main.alias("place_results"))))
        .when(F.col("o_orderstatus") == "F", F.to_json(F.struct(metadata, entries.alias("local_results"))))
        .otherwise(F.to_json(F.struct(F.lit("no searches left").alias("error"))))
    )
    return orders.select("o_orderkey", body.alias("body"))


@query("serp_flatten", """
    WITH counted AS (SELECT *, CAST(o_orderpriority[1] AS INTEGER) AS n FROM orders),
    entries AS (
        SELECT *, unnest(range(CASE o_orderstatus WHEN 'F' THEN 1 ELSE 0 END, n + 1)) AS i FROM counted WHERE o_orderstatus IN ('O', 'F')
    )
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'll_' || i WHEN i = 0 THEN 'pr' ELSE 'pasf_' || i END AS tag,
           CASE WHEN i % 2 = 1 THEN 'p' || o_custkey END AS place_id, 'd' || o_orderkey || '_' || i AS data_id,
           'Place ' || o_orderkey || '/' || i AS name, 'Street ' || i AS formatted_address,
           CAST(o_custkey % 80 AS DOUBLE) AS lat, '{"id":"' || o_orderpriority || '"}' AS search_metadata, NULL AS search_error
    FROM entries
    UNION ALL
    SELECT o_orderkey, NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'no searches left' FROM counted WHERE o_orderstatus NOT IN ('O', 'F')""")
def serp_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search responses of every shape as one row per entry."""
    found = responses.search_entries(search_responses(tables.table(spark, sf_dir, "orders")))
    return responses.normalise_entries(found).select(
        "o_orderkey", "tag", "place_id", "data_id", "name", "formatted_address",
        F.col("geometry.location.lat").alias("lat"), "search_metadata", "search_error",
    )


@query("serp_cache_lookup", """
    WITH ranked AS (
        SELECT o_custkey, CASE WHEN o_orderstatus <> 'P' THEN 'd' || o_orderkey END AS data_id,
               row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn
        FROM orders
    )
    SELECT 'p' || c_custkey AS place_id, coalesce(data_id, '') AS cached_data_id, rn IS NOT NULL AS cache_hit
    FROM customer LEFT JOIN ranked ON o_custkey = c_custkey AND rn = 1""")
def serp_cache_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places with their first cached search result; those without one go on to a search."""
    requests = tables.places(spark, sf_dir).select("place_id")
    cache = tables.table(spark, sf_dir, "orders").select(
        F.concat(F.lit("p"), F.col("o_custkey")).alias("place_id"),
        F.when(F.col("o_orderstatus") != "P", F.concat(F.lit("d"), F.col("o_orderkey"))).alias("data_id"), "o_orderdate", "o_orderkey",
    )
    looked = search.look_up_cache(requests, cache, F.col("o_orderdate"), F.col("o_orderkey"))
    return looked.select("place_id", F.coalesce("cached_data_id", F.lit("")).alias("cached_data_id"), "cache_hit")


LINKS_SQL = """
    entries AS (
        SELECT CASE WHEN o_orderpriority = '1-URGENT' THEN 'x' || o_orderkey ELSE 'p' || o_custkey END AS place_id,
               CASE WHEN o_orderstatus = 'F' THEN 'd' || o_custkey WHEN o_totalprice > 350000 THEN 'n' || o_orderkey END AS data_id,
               o_orderdate, o_orderkey
        FROM orders
    ), links AS (
        SELECT place_id, data_id FROM (
            SELECT *, row_number() OVER (PARTITION BY place_id ORDER BY o_orderdate DESC, o_orderkey) AS rn FROM entries) WHERE rn = 1
    ), places AS (
        SELECT 'p' || c_custkey AS place_id, CASE WHEN c_acctbal >= 0 THEN 'd' || c_custkey END AS data_id,
               CASE c_mktsegment WHEN 'BUILDING' THEN true WHEN 'FURNITURE' THEN NULL ELSE false END AS unserpable
        FROM customer
    )"""


def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as search entries with an identifier for a known or new place, one per place."""
    place = F.when(F.col("o_orderpriority") == "1-URGENT", F.concat(F.lit("x"), F.col("o_orderkey"))).otherwise(
        F.concat(F.lit("p"), F.col("o_custkey"))
    )
    found = F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("d"), F.col("o_custkey"))).when(
        F.col("o_totalprice") > 350000, F.concat(F.lit("n"), F.col("o_orderkey"))
    )
    entries = tables.table(spark, sf_dir, "orders").select(
        place.alias("place_id"), found.alias("data_id"), "o_orderdate", "o_orderkey"
    )
    return search.one_link_per_place(entries, F.desc("o_orderdate"), F.col("o_orderkey")).select("place_id", "data_id")


@query("link_classify", f"""
    WITH {LINKS_SQL}
    SELECT l.place_id, l.data_id, CASE WHEN p.place_id IS NULL THEN 'inserted'
           WHEN p.data_id IS NOT DISTINCT FROM l.data_id THEN 'unchanged' ELSE 'updated' END AS link_outcome
    FROM links l LEFT JOIN places p ON p.place_id = l.place_id""")
def link_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether linking an entry inserts a place, changes it or leaves it."""
    return search.classify_links(links(spark, sf_dir), tables.places(spark, sf_dir))


@query("mark_unresolved", f"""
    WITH {LINKS_SQL},
    linked AS (
        SELECT p.place_id, CASE WHEN l.place_id IS NOT NULL THEN l.data_id ELSE p.data_id END AS data_id, unserpable
        FROM places p LEFT JOIN links l ON l.place_id = p.place_id
        UNION ALL
        SELECT place_id, data_id, NULL FROM links WHERE place_id NOT IN (SELECT place_id FROM places)
    )
    SELECT place_id, coalesce(data_id, '') AS data_id,
           CASE WHEN coalesce(data_id, '') = '' AND place_id IN (SELECT 'p' || o_custkey FROM orders) THEN 'true'
                ELSE coalesce(CAST(unserpable AS VARCHAR), '') END AS unserpable
    FROM linked""")
def mark_unresolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places after linking; those searched in vain are marked."""
    places = tables.places(spark, sf_dir).select("place_id", "data_id", "unserpable")
    searched = tables.table(spark, sf_dir, "orders").select(F.concat(F.lit("p"), F.col("o_custkey")).alias("place_id"))
    marked = search.mark_unresolved(search.apply_links(places, links(spark, sf_dir)), searched)
    return marked.select(
        "place_id", F.coalesce("data_id", F.lit("")).alias("data_id"),
        F.coalesce(F.col("unserpable").cast("string"), F.lit("")).alias("unserpable"),
    )


def town_sql(key: str) -> str:
    return f"({key} * 7919 % 2000) / 10000e0 + 40e0 AS lat, ({key} * 104729 % 4000) / 10000e0 - 3.8e0 AS lng"


@query("entity_resolve", f"""
    WITH places AS (SELECT 'p' || c_custkey AS place_id, c_mktsegment AS name, {town_sql("c_custkey")} FROM customer),
    entries AS (SELECT o_orderkey, CASE WHEN o_totalprice > 400000 THEN 'Unknown' ELSE c_mktsegment END AS name, {town_sql("o_orderkey")}
                FROM orders JOIN customer ON c_custkey = o_custkey),
    p AS (SELECT *, {x_sql("lng", 14)} AS x, {y_sql("lat", 14)} AS y, radians(lat) AS r FROM places),
    e AS (SELECT *, {x_sql("lng", 14)} AS x, {y_sql("lat", 14)} AS y, radians(lat) AS r FROM entries),
    pairs AS (
        SELECT e.o_orderkey, e.name, p.place_id, CASE WHEN p.place_id IS NOT NULL THEN CAST(floor(2e0 * 6371008.8e0 * asin(sqrt(least(1e0,
            sin((p.r - e.r) / 2e0) ** 2 + cos(e.r) * cos(p.r) * sin(radians(p.lng - e.lng) / 2e0) ** 2))) * 1000e0 + 0.5e0) AS BIGINT) END AS distance_mm
        FROM e LEFT JOIN p ON p.name = e.name AND abs(p.y - e.y) <= 1 AND (p.x - e.x + 16384) % 16384 IN (0, 1, 16383)
    ), ranked AS (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY distance_mm, place_id) AS rn FROM pairs)
    SELECT o_orderkey, name, coalesce(place_id, '') AS place_id, coalesce(distance_mm, -1) AS distance_mm FROM ranked WHERE rn = 1""")
def entity_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of each entry that has only a name and a position."""
    customers = tables.table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    point = tables.town_point(F.col("c_custkey"))
    places = customers.select(
        F.concat(F.lit("p"), F.col("c_custkey")).alias("place_id"), F.col("c_mktsegment").alias("name"),
        point["lat"].alias("lat"), point["lng"].alias("lng"),
    )
    orders = tables.table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "c_custkey")
    spot = tables.town_point(F.col("o_orderkey"))
    entries = orders.join(customers, "c_custkey").select(
        "o_orderkey", F.when(F.col("o_totalprice") > 400000, "Unknown").otherwise(F.col("c_mktsegment")).alias("name"),
        spot["lat"].alias("lat"), spot["lng"].alias("lng"),
    )
    return resolve.nearest_by_name(entries, places).select(
        "o_orderkey", "name", F.coalesce("place_id", F.lit("")).alias("place_id"), F.coalesce("distance_mm", F.lit(-1)).alias("distance_mm")
    )
