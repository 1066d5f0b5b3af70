"""What to refresh next, requests for it, leases and slots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from atlaslens import config, schemas
from atlaslens.functions.affinity import decimal_hour
from atlaslens.operators import scheduling, spans
from atlaslens.operators.dedupe import latest_values
from atlaslens.plans import tables
from atlaslens.plans.registry import query
from atlaslens.sources import state
from atlaslens.sources.requests import check_requests, decode_requests

PLACES_SQL = """
    SELECT 'p' || c_custkey AS place_id,
           CASE WHEN c_acctbal >= 0 THEN 'd' || c_custkey END AS data_id,
           c_name AS name, c_nationkey AS priority,
           CASE c_mktsegment WHEN 'BUILDING' THEN true WHEN 'FURNITURE' THEN NULL ELSE false END AS unserpable,
           CASE c_mktsegment WHEN 'MACHINERY' THEN true WHEN 'FURNITURE' THEN NULL ELSE false END AS unscrapable,
           c_custkey, c_nationkey
    FROM customer"""

DUE_SQL = f"""
    WITH places AS ({PLACES_SQL}),
    last_orders AS (SELECT o_custkey AS c_custkey, CAST(max(o_orderdate) AS DATE) AS last_scraped FROM orders GROUP BY 1),
    as_of AS (SELECT CAST(max(o_orderdate) AS DATE) AS d FROM orders),
    busy AS (
        SELECT 'p' || user_id AS place_id FROM events GROUP BY 1
        HAVING max(ts) + INTERVAL 1 HOUR > (SELECT max(ts) FROM events)
    ),
    due AS (
        SELECT p.*, l.last_scraped
        FROM places p LEFT JOIN last_orders l USING (c_custkey)
        WHERE data_id IS NOT NULL AND coalesce(unscrapable, false) = false
          AND (l.last_scraped IS NULL OR l.last_scraped < (SELECT d FROM as_of) - 28)
          AND NOT EXISTS (SELECT 1 FROM busy b WHERE b.place_id = p.place_id)
    )"""


def live_leases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places someone works on, as of the last event."""
    now = tables.latest(tables.events(spark, sf_dir), "at_us")
    live = spans.live_keys(tables.leases(spark, sf_dir), now)
    return spans.keys_with_prefix(live, config.LEASE_PREFIX, name="place_id")


def due(spark: SparkSession, sf_dir: str, places: DataFrame) -> DataFrame:
    """The given places that are due on the day of the last order."""
    today = F.to_date(tables.latest(tables.table(spark, sf_dir, "orders"), "o_orderdate"))
    places = places.join(tables.last_orders(spark, sf_dir), "c_custkey", "left")
    return scheduling.due_places(places, live_leases(spark, sf_dir).select("place_id"), today)


@query("due_selection", DUE_SQL + """
    SELECT place_id, data_id, name, priority, coalesce(strftime(last_scraped, '%Y-%m-%d'), '') AS last_scraped
    FROM due ORDER BY priority DESC NULLS LAST, place_id LIMIT 50""")
def due_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The places to refresh next: due, not in progress, highest priority first."""
    first = scheduling.highest_priority(due(spark, sf_dir, tables.places(spark, sf_dir)), 50, "place_id")
    return first.select(
        "place_id", "data_id", "name", "priority",
        F.coalesce(tables.day_text("last_scraped"), F.lit("")).alias("last_scraped"),
    )


@query("need_id_batch", f"""
    WITH places AS ({PLACES_SQL})
    SELECT place_id, name, priority FROM places
    WHERE data_id IS NULL AND coalesce(unserpable, false) = false
    ORDER BY priority DESC NULLS LAST, place_id LIMIT 20""")
def need_id_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The next places that need an identifier."""
    wanted = state.find(
        tables.places(spark, sf_dir),
        scheduling.needs_identifier(F.col("data_id"), F.col("unserpable")),
        ["place_id", "name", "priority"],
    )
    return scheduling.highest_priority(wanted, 20, "place_id")


@query("dispatch_batch", DUE_SQL + """
    SELECT place_id, data_id, name, CASE r_name WHEN 'EUROPE' THEN 'es' ELSE 'en' END AS language,
           CASE r_name WHEN 'AFRICA' THEN 'co.za' WHEN 'AMERICA' THEN 'com' WHEN 'ASIA' THEN 'co.jp'
                       WHEN 'EUROPE' THEN 'es' ELSE 'ae' END AS country_domain,
           priority, coalesce(strftime(last_scraped, '%Y-%m-%d'), '2017-01-01') AS last_scraped
    FROM due JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey""")
def dispatch_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every due place as a request message, decoded again to compare the fields."""
    places = due(spark, sf_dir, tables.places_with_country(spark, sf_dir))
    shaped = scheduling.shape_requests(places, tables.region_localization(spark))
    sent = shaped.select(scheduling.as_message().alias("body"))
    return decode_requests(sent).select("request.*").select(*schemas.SCRAPE_REQUEST_KEYS)


@query("localize", """
    SELECT c_custkey, r_name AS country, CASE r_name WHEN 'EUROPE' THEN 'es' ELSE 'en' END AS language,
           CASE r_name WHEN 'AFRICA' THEN 'co.za' WHEN 'AMERICA' THEN 'com' WHEN 'ASIA' THEN 'co.jp'
                       WHEN 'EUROPE' THEN 'es' ELSE 'ae' END AS domain,
           CASE r_name WHEN 'EUROPE' THEN 'Comida' ELSE 'Food' END AS food
    FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey""")
def localize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language, domain and labels of each place's country."""
    loc = F.broadcast(tables.region_localization(spark))
    return tables.places_with_country(spark, sf_dir).join(loc, "country").select(
        "c_custkey", "country", "language", "domain", "food"
    )


@query("request_contract", """
    SELECT event_id,
           CASE WHEN value > 300 THEN 'malformed' WHEN event_type IN ('click', 'signup') THEN 'keys'
                WHEN event_type = 'error' OR (event_type = 'purchase' AND value < 50) THEN 'data_id'
                ELSE 'ok' END AS outcome,
           CASE WHEN value > 300 THEN '' ELSE 'p' || user_id END AS place_id
    FROM events""")
def request_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request messages checked against the contract."""
    messages = tables.request_bodies(tables.table(spark, sf_dir, "events"))
    return checked_columns(check_requests(messages))


def checked_columns(checked: DataFrame) -> DataFrame:
    place_id = F.when(F.col("outcome") != "malformed", F.col("request.place_id"))
    return checked.select("event_id", "outcome", F.coalesce(place_id, F.lit("")).alias("place_id"))


@query("active_leases", """
    SELECT 'p' || user_id AS place_id, max(epoch_us(ts)) AS set_at,
           CAST(floor((max(epoch_us(ts)) + 3600000000 - (SELECT max(epoch_us(ts)) FROM events)) / 1000000.0) AS BIGINT) AS remaining_s
    FROM events GROUP BY 1
    HAVING max(epoch_us(ts)) + 3600000000 > (SELECT max(epoch_us(ts)) FROM events)""")
def active_leases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leases that have not run out, with the seconds they have left."""
    return live_leases(spark, sf_dir).select("place_id", "set_at", "remaining_s")


LEASE_SPANS_SQL = """
    WITH marked AS (
        SELECT user_id, epoch_us(ts) AS us,
               CASE WHEN epoch_us(ts) - lag(epoch_us(ts)) OVER w < 3600000000 THEN 0 ELSE 1 END AS starts
        FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)
    ), numbered AS (
        SELECT user_id, us, sum(starts) OVER (PARTITION BY user_id ORDER BY us ROWS UNBOUNDED PRECEDING) AS span FROM marked
    ), spans AS (
        SELECT user_id, min(us) AS span_start_us, max(us) AS last_set_us, count(*) AS n_sets
        FROM numbered GROUP BY user_id, span
    )
    SELECT user_id, span_start_us, last_set_us, n_sets FROM spans"""


@query("lease_spans", LEASE_SPANS_SQL)
def lease_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans in which a place stayed in progress."""
    return spans.alive_spans(tables.events(spark, sf_dir), "user_id", "at_us", config.LEASE_TTL_S)


@query("last_state", """
    SELECT user_id || '_' || event_type AS slot_key, arg_max(value, row(ts, event_id)) AS value, max(epoch_us(ts)) AS set_at_us
    FROM events GROUP BY 1""")
def last_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last value written to each key."""
    written = tables.events(spark, sf_dir).select(
        state.encode_slot(F.col("user_id"), F.col("event_type")).alias("slot_key"),
        "value", F.col("at_us").alias("set_at_us"), "event_id",
    )
    return latest_values(written, ["slot_key"], ["value", "set_at_us"], ["set_at_us", "event_id"])


def used_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as ``<type>_<user>_<hour>`` -> epoch seconds, decoded, last use per slot."""
    pairs = tables.events(spark, sf_dir).select(
        F.create_map(
            state.encode_slot(F.concat_ws("_", "event_type", "user_id"), F.hour("ts")),
            F.floor(F.col("at_us") / 1_000_000).cast("string"),
        ).alias("pairs")
    )
    last = state.hash_pairs(pairs).groupBy("key").agg(F.max(F.col("value").cast("long")).alias("value"))
    return state.decode_slots(last)


@query("state_report", """
    SELECT event_type || '_' || user_id AS name, CAST(hour(ts) AS DOUBLE) AS slot,
           CAST(max(epoch_us(ts) // 1000000) AS DOUBLE) AS last_used,
           greatest(0, max(epoch_us(ts) // 1000000) + 1800 - (SELECT max(epoch_us(ts) // 1000000) FROM events)) AS ttl_s
    FROM events GROUP BY 1, 2""")
def state_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All slots by last use, with what is left of their current use."""
    used = used_slots(spark, sf_dir)
    now = tables.latest(tables.events(spark, sf_dir), F.floor(F.col("at_us") / 1_000_000))
    left = F.greatest(F.lit(0), F.col("last_used").cast("long") + config.CURRENT_SLOT_TTL_S - now).alias("ttl_s")
    return scheduling.slot_report(used.select("name", "slot", "last_used", left))


@query("slot_assign", """
    WITH users AS (SELECT DISTINCT user_id FROM events),
    placed AS (SELECT user_id, row_number() OVER (ORDER BY sha256('10_' || user_id)) - 1 AS position,
                      count(*) OVER () AS total FROM users)
    SELECT user_id, position, round(CAST(position AS DOUBLE) / total * 24, 1) AS slot FROM placed""")
def slot_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users spread evenly over the day in a seeded order."""
    return scheduling.even_slots(tables.table(spark, sf_dir, "events"), "user_id")


@query("slot_affinity", """
    WITH now AS (SELECT max(ts) AS t FROM events),
    slots AS (SELECT user_id, event_type AS name, CAST(hour(ts) AS DOUBLE) AS slot, max(epoch_us(ts)) / 1e6 AS last_used
              FROM events GROUP BY 1, 2, 3),
    clock AS (SELECT hour(t) + minute(t) / 60e0 AS h, epoch_us(t) / 1e6 AS s FROM now),
    scored AS (
        SELECT user_id, name, slot,
               (exp(-power((h - slot) / 1.5e0, 2) / 2) + exp(-power((h - slot - 24) / 1.5e0, 2) / 2)
                + exp(-power((h - slot + 24) / 1.5e0, 2) / 2)) / (1.5e0 * sqrt(2 * pi())) AS score
        FROM slots, clock WHERE s - last_used > 86400
    ), ranked AS (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY round(score, 12) DESC, name, slot) AS rn FROM scored
    )
    SELECT user_id, name, slot, round(score, 6) AS score FROM ranked WHERE rn = 1""")
def slot_affinity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's rested slot that fits the present hour best."""
    source = tables.events(spark, sf_dir)
    slots = source.groupBy("user_id", F.col("event_type").alias("name"), F.hour("ts").cast("double").alias("slot")).agg(
        (F.max("at_us") / 1e6).alias("last_used")
    )
    now = tables.latest(source, "ts")
    best = scheduling.best_slots(slots, ["user_id"], decimal_hour(now), tables.micros(now) / 1e6)
    return best.withColumn("score", F.round("score", 6))
