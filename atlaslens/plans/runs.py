"""Queries for the jobs as a whole."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from atlaslens import config
from atlaslens.operators import places as pl, scheduling
from atlaslens.plans import discovery, flows, tables
from atlaslens.plans.parsing import escaped
from atlaslens.plans.refresh import PLACES_SQL
from atlaslens.plans.registry import ORACLES, query
from atlaslens.session import work_dir
from atlaslens.sources import responses
from atlaslens.sources.pages import page_records

SHORT = 80


def captured_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns as captured pages: a review per line, older with each turn; short turns have no reviews."""
    pages = tables.conversation_pages(spark, sf_dir)
    age = F.concat(((F.col("page_number") + 1) * 2).cast("string"), F.lit(" weeks ago"))
    lines = F.filter(F.split("text", "\n"), lambda line: F.length(F.trim(line)) > 0)

    def block(line: Column, position: Column) -> Column:
        return F.concat(
            F.lit('<div class="TSUbDb">User '), position.cast("string"), F.lit('</div><div class="PuaHbe">'), age,
            F.lit('</div><div class="Jtu6Td"><span class="review-full-text">'), escaped(line), F.lit("</span></div>"),
        )

    reviews = F.array_join(F.transform(lines, block), "")
    refused = F.when(F.contains("text", F.lit(",")), F.lit(config.BLOCKED_MARKER)).otherwise(F.lit("nothing here"))
    token = F.coalesce(F.concat(F.lit('<i data-next-page-token="'), F.col("next_page_token"), F.lit('"></i>')), F.lit(""))
    content = F.concat(
        F.lit("<!-- " + "x" * 100 + " --><body>"), F.when(F.length("text") < SHORT, refused).otherwise(reviews), token
    )
    captured = pages.select(
        F.col("conv_id").cast("string").alias("place_id"), F.lit("d").alias("data_id"), F.col("role").alias("name"),
        F.lit("en").alias("language"), "page_number", content.alias("content"),
    )
    return page_records(captured, F.timestamp_seconds(F.lit(1706659200)))


@query("refresh_run", f"""
    WITH pages AS (
        SELECT conv_id, CAST(turn AS INTEGER) AS page_number, text, length(text) > 100 AS has_token,
               DATE '2024-01-31' - 14 * (CAST(turn AS INTEGER) + 1) AS newest,
               CASE WHEN length(text) >= {SHORT} THEN 'OK' WHEN contains(text, ',') THEN 'BLOCKED' ELSE 'NO_ROWS' END AS outcome,
               len(list_filter(string_split(text, chr(10)), lambda line: length(trim(line)) > 0)) AS n_lines
        FROM conversations
    ), judged AS (
        SELECT *, NOT has_token OR (outcome = 'OK' AND (newest < DATE '2024-01-31' - 14 * (conv_id % 4 + 1)::INTEGER
               OR newest < DATE '2024-01-31' - 70)) AS stops FROM pages
    ), looked AS (
        SELECT *, bool_or(stops OR outcome <> 'OK') OVER (
            PARTITION BY conv_id ORDER BY page_number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS stopped FROM judged
    ), reached AS (SELECT * FROM looked WHERE NOT coalesce(stopped, false)),
    ends AS (
        SELECT conv_id, arg_max(outcome, page_number) AS outcome, arg_max(stops, page_number) AS stops,
               max(page_number) AS last_page, count(*) FILTER (outcome = 'OK') AS n_pages,
               CAST(coalesce(sum(n_lines) FILTER (outcome = 'OK'), 0) AS BIGINT) AS n_reviews
        FROM reached GROUP BY 1
    )
    SELECT CAST(conv_id AS VARCHAR) AS place_id, CASE WHEN outcome = 'BLOCKED' THEN 'abort' WHEN outcome <> 'OK' THEN 'retry'
           WHEN stops THEN 'done' ELSE 'waiting' END AS status, last_page, n_pages, n_reviews FROM ends""")
def refresh_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status, pages and reviews of each request after its captured pages were parsed."""
    pages = captured_conversations(spark, sf_dir)
    weeks = (F.col("conv_id") % 4 + 1).cast("int") * 14
    requests = tables.table(spark, sf_dir, "conversations").select("conv_id").distinct().select(
        F.col("conv_id").cast("string").alias("place_id"), F.lit("en").alias("language"),
        F.date_sub(F.to_date(F.lit("2024-01-31")), weeks).alias("last_scraped"),
    )
    now = F.timestamp_seconds(F.lit(1706659200))
    run = flows.refresh_reviews(pages, requests, config.parser_table(spark), now, work_dir(spark, "lists"), 70)
    counts = run.reviews.groupBy("place_id").agg(F.count(F.lit(1)).alias("n_reviews"))
    return run.requests.join(counts, "place_id", "left").select(
        "place_id", "status", "last_page", "n_pages", F.coalesce("n_reviews", F.lit(0)).alias("n_reviews")
    )


@query("refresh_rounds", ORACLES["refresh_run"])
def refresh_rounds(spark: SparkSession, sf_dir: str, pages_per_run: int = 4, runs: int = 3) -> DataFrame:
    """The same from several runs of a few pages each, every one going on where the last ended."""
    pages = captured_conversations(spark, sf_dir)
    weeks = (F.col("conv_id") % 4 + 1).cast("int") * 14
    requests = tables.table(spark, sf_dir, "conversations").select("conv_id").distinct().select(
        F.col("conv_id").cast("string").alias("place_id"), F.lit("en").alias("language"),
        F.date_sub(F.to_date(F.lit("2024-01-31")), weeks).alias("last_scraped"),
    )
    ledger = flows.RunLedger(spark, work_dir(spark, "ledger"))
    for run in range(runs):
        now = F.timestamp_seconds(F.lit(1706659200 + 600 * run))
        flows.resume_reviews(pages, requests, config.parser_table(spark), now, work_dir(spark, "round"), ledger, run, 70, pages_per_run=pages_per_run)
    n_pages = ledger.pages.read().groupBy("place_id").agg(F.count(F.lit(1)).alias("n_pages"))
    n_reviews = ledger.reviews.read().groupBy("place_id").agg(F.count(F.lit(1)).alias("n_reviews"))
    zero = lambda name: F.coalesce(name, F.lit(0)).alias(name)
    return ledger.state().join(n_pages, "place_id", "left").join(n_reviews, "place_id", "left").select(
        "place_id", "status", "last_page", zero("n_pages"), zero("n_reviews")
    )


def town_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    point = tables.town_point(F.col("c_custkey"))
    return tables.places(spark, sf_dir).select(
        "place_id", "data_id", "name", "priority", F.struct(point["lat"].alias("lat"), point["lng"].alias("lng")).alias("coords"), "unserpable"
    )


def town_responses(orders: DataFrame) -> DataFrame:
    """Each order as a search response about its customer and the customers after it: good, failed or empty."""
    count = F.substring("o_orderpriority", 1, 1).cast("int")

    def entry(position: Column) -> Column:
        key = F.col("o_custkey") + position
        point = tables.town_point(key)
        return F.struct(
            F.when(position % 2 == 1, F.concat(F.lit("p"), key)).alias("place_id"),
            F.concat(F.lit("n"), F.col("o_orderkey"), F.lit("_"), position).alias("data_id"),
            F.format_string("Customer#%09d", key).alias("title"),
            position.cast("int").alias("position"),
            F.struct(point["lat"].alias("latitude"), point["lng"].alias("longitude")).alias("gps_coordinates"),
        )

    entries = F.transform(F.sequence(F.lit(0), count), entry)
    price = F.col("o_totalprice")
    body = (
        F.when(price < 150000, F.to_json(F.struct(entries.alias("local_results"))))
        .when(price < 200000, F.lit('{"error": "out of searches"}')).otherwise(F.lit('{"local_results": []}'))
    )
    # Dearer orders stand for responses to searches nobody here asked for.
    asked = F.when(price < 220000, F.concat(F.lit("p"), F.col("o_custkey")))
    return orders.select(asked.alias("place_id"), "o_orderkey", body.alias("body"))


@query("id_resolution", f"""
    WITH places AS ({PLACES_SQL}),
    wanted AS (SELECT place_id, c_custkey FROM places WHERE data_id IS NULL AND coalesce(unserpable, false) = false),
    hits AS (SELECT place_id, arg_min('d' || o_orderkey, o_orderkey) AS data_id FROM wanted JOIN orders ON o_custkey = c_custkey
             WHERE o_totalprice > 480000 GROUP BY 1),
    misses AS (SELECT * FROM wanted WHERE place_id NOT IN (SELECT place_id FROM hits)),
    entries AS (
        SELECT o_orderkey, i, o_custkey + i AS k FROM (
            SELECT *, unnest(range(CAST(o_orderpriority[1] AS INTEGER) + 1)) AS i FROM orders JOIN misses ON c_custkey = o_custkey
            WHERE o_totalprice < 150000)
    ), searched AS (
        SELECT DISTINCT place_id FROM misses JOIN orders ON o_custkey = c_custkey
        WHERE o_totalprice < 150000 OR (o_totalprice >= 200000 AND o_totalprice < 220000)
    ), retry AS (
        SELECT place_id, CASE WHEN EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice >= 150000 AND o_totalprice < 200000)
            THEN 'out of searches' ELSE 'no response' END AS search_error
        FROM misses WHERE place_id NOT IN (SELECT place_id FROM searched)
    ), placed AS (
        SELECT 'p' || k AS place_id, 'n' || o_orderkey || '_' || i AS data_id, o_orderkey, i FROM entries
        WHERE i % 2 = 1 OR k IN (SELECT c_custkey FROM customer)
    ), links AS (SELECT place_id, arg_min(data_id, row(o_orderkey, i)) AS data_id FROM placed GROUP BY 1),
    linked AS (
        SELECT p.place_id, coalesce(h.data_id, l.data_id, p.data_id) AS data_id, p.unserpable
        FROM places p LEFT JOIN links l ON l.place_id = p.place_id LEFT JOIN hits h ON h.place_id = p.place_id
        UNION ALL
        SELECT place_id, data_id, false FROM links WHERE place_id NOT IN (SELECT place_id FROM places)
    )
    SELECT place_id, coalesce(data_id, '') AS data_id,
           CASE WHEN data_id IS NULL AND place_id IN (SELECT place_id FROM searched) THEN 'true'
                ELSE coalesce(CAST(unserpable AS VARCHAR), '') END AS unserpable, coalesce(search_error, '') AS retry
    FROM linked LEFT JOIN retry USING (place_id)""")
def id_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places after a round of identifier lookups: cache, responses, names, and marks for failures."""
    places = town_places(spark, sf_dir)
    wanted = places.where(scheduling.needs_identifier(F.col("data_id"), F.col("unserpable")))
    orders = tables.table(spark, sf_dir, "orders")
    cache = orders.select(  # entries without a place are of no use and are passed over
        F.when(F.col("o_totalprice") > 480000, F.concat(F.lit("p"), F.col("o_custkey"))).alias("place_id"), F.concat(F.lit("d"), F.col("o_orderkey")).alias("data_id"), "o_orderkey"
    )
    resolved = flows.resolve_identifiers(
        places, wanted, cache, town_responses(orders),
        [F.col("o_orderkey"), F.col("position")], [F.col("o_orderkey")], F.timestamp_seconds(F.lit(1706659200)),
        work_dir(spark, "links"),
    )
    return resolved.places.join(resolved.retry, "place_id", "left").select(
        "place_id", F.coalesce("data_id", F.lit("")).alias("data_id"),
        F.coalesce(F.col("unserpable").cast("string"), F.lit("")).alias("unserpable"), F.coalesce("search_error", F.lit("")).alias("retry"),
    )


def spot_responses(df: DataFrame, nation: str, balance: str, name: str, key: str) -> DataFrame:
    """Rows as place-search responses; the place is a nation and a band of the balance."""
    place_id = F.concat_ws("_", F.col(nation), F.floor(F.col(balance) / 100))
    point = tables.town_point(F.col(key))
    place = F.struct(
        place_id.alias("place_id"), F.col(name).alias("name"),
        F.struct(F.struct(point["lat"].alias("lat"), point["lng"].alias("lng")).alias("location")).alias("geometry"),
    )
    return df.select(F.col(key).alias("k"), F.to_json(F.struct(F.array(place).alias("results"))).alias("body"))


def _town_cell_sql(key: str) -> str:
    lat, lng = f"(({key} * 7919 % 2000) / 10000e0 + 40e0)", f"(({key} * 104729 % 4000) / 10000e0 - 3.8e0)"
    return discovery.cell_sql(discovery.x_sql(lng, 14), discovery.y_sql(lat, 14), 14)


@query("area_scan", f"""
    WITH coffee AS (
        SELECT *, row_number() OVER (PARTITION BY place_id ORDER BY k) AS rn FROM (
            SELECT c_nationkey || '_' || CAST(floor(c_acctbal / 100) AS BIGINT) AS place_id, c_name AS name, c_custkey AS k FROM customer)
    ), bar AS (
        SELECT *, row_number() OVER (PARTITION BY place_id ORDER BY k) AS rn FROM (
            SELECT s_nationkey || '_' || CAST(floor(s_acctbal / 100) AS BIGINT) AS place_id, s_name AS name, s_suppkey AS k FROM supplier)
    ), c AS (SELECT * FROM coffee WHERE rn = 1), b AS (SELECT * FROM bar WHERE rn = 1)
    SELECT place_id, c.name, {_town_cell_sql("c.k")} AS loc_cell_coarse, CASE WHEN b.place_id IS NULL THEN 'coffee' ELSE 'bar,coffee' END AS queries
    FROM c LEFT JOIN b USING (place_id)
    UNION ALL
    SELECT place_id, name, {_town_cell_sql("k")}, 'bar' FROM b WHERE place_id NOT IN (SELECT place_id FROM c)""")
def area_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of two scans of one area, each with all the queries that found it."""
    now = F.timestamp_seconds(F.lit(1706659200))
    first = spot_responses(tables.table(spark, sf_dir, "customer"), "c_nationkey", "c_acctbal", "c_name", "c_custkey")
    second = spot_responses(tables.table(spark, sf_dir, "supplier"), "s_nationkey", "s_acctbal", "s_name", "s_suppkey")
    nothing = pl.normalise_places(responses.found_places(responses.place_results(first.where("false"))), F.lit("coffee"), now)
    store = flows.scan_area(nothing, first, "coffee", now, [F.col("k")])
    scanned = flows.scan_area(store, second, "bar", now, [F.col("k")])
    return scanned.select("place_id", "name", "loc_cell_coarse", F.array_join("all_queries", ",").alias("queries"))
