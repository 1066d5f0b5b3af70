"""Keys that expire, routes with an abort, requests for identifiers, reports and scans by cell."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession, functions as F

from atlaslens import config
from atlaslens.functions import geo
from atlaslens.operators import places as pl, scheduling, spans, stores
from atlaslens.plans import discovery, flows, paging as paging_plans, refresh, streams, tables
from atlaslens.plans.registry import ORACLES, query
from atlaslens.plans.runs import town_places
from atlaslens.session import work_dir
from atlaslens.sources import responses
from atlaslens.sources.requests import check_id_requests
from atlaslens.streaming import jobs

# Fixed values of the queries below: how long an event keeps its user's place, and which deletes it.
TTL_S = {"click": 3600, "view": 86400, "purchase": 7200, "signup": 600}

LIVE_SQL = """
    WITH writes AS (
        SELECT user_id, epoch_us(ts) AS us, CASE event_type WHEN 'click' THEN 3600::BIGINT WHEN 'view' THEN 86400 WHEN 'purchase' THEN 7200 WHEN 'signup' THEN 600 END AS ttl,
               event_id FROM events
    ), last AS (
        SELECT user_id, arg_max(row(us, ttl, event_id), row(us, ttl IS NOT NULL, coalesce(ttl, 0), event_id)) AS w FROM writes GROUP BY 1
    ), remaining AS (
        SELECT user_id, w[1] AS set_at, w[3] AS event_id, w[1] + w[2] * 1000000 - (SELECT max(us) FROM writes) AS left_us FROM last
    )
    SELECT 'working_on_p' || user_id AS key, set_at, left_us // 1000000 AS remaining_s, event_id FROM remaining WHERE left_us > 0"""


def key_writes(events: DataFrame) -> DataFrame:
    """Events as sets of their user's key, each type with its own ttl; an error deletes the key."""
    ttl = None
    for name, seconds in TTL_S.items():
        ttl = (F if ttl is None else ttl).when(F.col("event_type") == name, F.lit(seconds))
    return events.select(
        F.concat(F.lit(config.LEASE_PREFIX + "p"), F.col("user_id")).alias("key"), tables.micros("ts").alias("set_at"),
        ttl.cast("long").alias("ttl_s"), "event_id",
    )


@query("live_keys", LIVE_SQL)
def live_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys still set as of the last event, after sets with different ttls and deletes."""
    writes = key_writes(tables.table(spark, sf_dir, "events"))
    now = tables.latest(tables.events(spark, sf_dir), "at_us")
    state = spans.latest_writes(writes, "event_id")
    return spans.live_keys(state, now).join(state.select("key", "event_id"), "key")


@query("s_live_keys", LIVE_SQL)
def s_live_keys(spark: SparkSession, sf_dir: str, max_files: int | None = None) -> DataFrame:
    """The same from a stream whose state has one row per key."""
    now = tables.latest(tables.events(spark, sf_dir), "at_us")
    stream = key_writes(streams.event_stream(spark, sf_dir, max_files))
    return jobs.run_live_keys(stream, work_dir(spark, "live"), now, "event_id")


@query("s_route_abort", ORACLES["page_quality"])
def s_route_abort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captured pages routed by a job that fails after it wrote them where a site refused one, and is started again."""
    pages = streams.document_stream(spark, sf_dir).withColumn("n_rows", paging_plans.long_lines())
    routed = jobs.routed_pages(pages, F.col("text"), F.col("n_rows"), marker=paging_plans.MARKER).select("doc_id", "n_rows", "outcome", "route")
    out = work_dir(spark, "abort")
    try:
        return jobs.route_pages(routed, out)
    except StreamingQueryException as failure:
        if jobs.PageRefused.__name__ not in str(failure):
            raise
    return jobs.route_pages(routed, out)


@query("s_id_requests", f"""
    WITH places AS ({refresh.PLACES_SQL}), wanted AS (
        SELECT *, c_custkey % 10 = 3 AS broken, c_custkey % 10 = 4 AS bare FROM places WHERE data_id IS NULL AND coalesce(unserpable, false) = false
    )
    SELECT CASE WHEN NOT broken THEN place_id END AS place_id, CASE WHEN NOT broken AND NOT bare THEN priority END AS priority,
           CASE WHEN NOT broken AND NOT bare THEN name END AS name, CASE WHEN NOT broken AND NOT bare THEN (c_custkey * 7919 % 2000) / 10000e0 + 40e0 END AS lat,
           CASE WHEN NOT broken AND NOT bare THEN (c_custkey * 104729 % 4000) / 10000e0 - 3.8e0 END AS lng,
           CASE WHEN broken THEN 'malformed' WHEN bare THEN 'keys' ELSE 'ok' END AS outcome, count(*) AS n
    FROM wanted GROUP BY ALL""")
def s_id_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests for identifiers sent as lines of a folder and received as a stream; what breaks on the way is routed."""
    queue = work_dir(spark, "id-queue")
    key = F.substring("place_id", 2, 20).cast("long") % 10
    places = town_places(spark, sf_dir)
    stores.append_messages(scheduling.id_requests(places.where(~key.isin(3, 4))), queue, F.col("value"))
    damaged = scheduling.id_requests(places.where(key == 3)).select(F.substring("value", 1, 15).alias("value"))
    bare = places.where(key == 4).where(scheduling.needs_identifier(F.col("data_id"), F.col("unserpable"))).select(F.to_json(F.struct("place_id")).alias("value"))
    stores.append_messages(damaged.unionByName(bare), queue, F.col("value"))
    stream = jobs.file_stream(spark, queue, "value string", file_format="text")
    received = check_id_requests(stream, "value").select(
        "request.place_id", "request.priority", "request.name", F.try_element_at("request.coords", F.lit(1)).alias("lat"),
        F.try_element_at("request.coords", F.lit(2)).alias("lng"), "outcome",
    )
    routed = jobs.run(received, work_dir(spark, "id-requests"), ("outcome",))
    return routed.groupBy(*routed.columns).agg(F.count(F.lit(1)).alias("n"))


@query("ranked_report", """
    WITH slots AS (
        SELECT event_type || '_' || user_id AS name, CAST(hour(ts) AS DOUBLE) AS slot, CAST(max(epoch_us(ts) // 1000000) AS DOUBLE) AS last_used FROM events GROUP BY 1, 2
    ), current AS (
        SELECT 'u' || user_id AS name, max(epoch_us(ts)) + 1800000000 - (SELECT max(epoch_us(ts)) FROM events) AS left_us FROM events GROUP BY 1
    )
    SELECT 'used' AS frame, name, slot, last_used, NULL AS remaining_s, row_number() OVER (ORDER BY last_used DESC, name, slot) AS rank FROM slots
    UNION ALL
    SELECT 'current', name, NULL, NULL, left_us // 1000000, row_number() OVER (ORDER BY left_us // 1000000 DESC, name) FROM current WHERE left_us > 0""")
def ranked_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All slots in order of their last use, and the current ones in order of the time they have left."""
    used = refresh.used_slots(spark, sf_dir).select("name", "slot", "last_used")
    events = tables.events(spark, sf_dir)
    current = events.select(
        F.concat(F.lit("u"), F.col("user_id"), F.lit(config.CURRENT_SLOT_SUFFIX)).alias("key"), F.col("at_us").alias("set_at"),
        F.lit(config.CURRENT_SLOT_TTL_S).cast("long").alias("ttl_s"),
    ).unionByName(tables.leases(spark, sf_dir))
    live = scheduling.expiry_report(spans.live_keys(current, tables.latest(events, "at_us")), config.CURRENT_SLOT_SUFFIX)
    first = scheduling.ranked(used, work_dir(spark, "used"), F.desc("last_used"), F.col("name"), F.col("slot"))
    second = scheduling.ranked(live, work_dir(spark, "current"), F.desc("remaining_s"), F.col("name"))
    return (
        first.withColumn("frame", F.lit("used")).unionByName(second.withColumn("frame", F.lit("current")), allowMissingColumns=True)
        .select("frame", "name", "slot", "last_used", "remaining_s", "rank")
    )


@query("area_cells", f"""
    WITH {discovery.POINTS_SQL}, found AS (
        SELECT 'p' || c_custkey AS place_id, c_name AS name, {discovery.x_sql("lng", 17)} AS x, {discovery.y_sql("lat", 17)} AS y,
               (c_custkey * 7919 % 2000) / 10000e0 + 40e0 AS plat, (c_custkey * 104729 % 4000) / 10000e0 - 3.8e0 AS plng, c_acctbal FROM points
    ), asked AS (SELECT DISTINCT x // 8 AS cx, y // 8 AS cy FROM found WHERE c_acctbal > 0)
    SELECT place_id, name, {discovery.cell_sql("x", "y", 17)} AS search_cell_fine, {discovery.cell_sql("cx", "cy", 14)} AS search_cell_coarse,
           {discovery.cell_sql(discovery.x_sql("plng", 17), discovery.y_sql("plat", 17), 17)} AS loc_cell_fine
    FROM found JOIN asked ON x // 8 = cx AND y // 8 = cy""")
def area_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places found by searching all fine cells of some coarse ones, with the cells searched and their own."""
    point, spot = tables.customer_points(), tables.town_point(F.col("c_custkey"))
    place = F.struct(
        F.concat(F.lit("p"), F.col("c_custkey")).alias("place_id"), F.col("c_name").alias("name"),
        F.struct(F.struct(spot["lat"].alias("lat"), spot["lng"].alias("lng")).alias("location")).alias("geometry"),
    )
    customers = tables.table(spark, sf_dir, "customer")
    answers = customers.select(
        geo.point_cell(point["lat"], point["lng"], geo.FINE_LEVEL).alias("child_cell"), F.to_json(F.struct(F.array(place).alias("results"))).alias("body")
    )
    cells = customers.where("c_acctbal > 0").select(geo.point_cell(point["lat"], point["lng"], geo.COARSE_LEVEL).alias("cell")).distinct()
    found = responses.found_places(responses.place_results(flows.responses_of_cells(cells, answers)))
    rows = pl.normalise_places(pl.one_per_place(found, F.col("searched_cell")), F.lit("coffee"), F.timestamp_seconds(F.lit(1706659200)))
    return rows.select("place_id", "name", "search_cell_fine", "search_cell_coarse", "loc_cell_fine")
