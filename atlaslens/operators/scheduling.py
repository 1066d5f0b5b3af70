"""What to refresh or look up next, and which slot to use."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from atlaslens import config, schemas
from atlaslens.functions.affinity import affinity
from atlaslens.operators import spans
from atlaslens.operators.dedupe import absent_from


def is_due(data_id: Column, unscrapable: Column, last_scraped: Column, as_of_day: Column,
           every_days: int = config.REFRESH_EVERY_DAYS) -> Column:
    """Has an identifier, is not excluded, and was last scraped long enough ago or never."""
    old = F.coalesce(last_scraped < F.date_sub(as_of_day, every_days), F.lit(True))
    return data_id.isNotNull() & ~unscrapable.eqNullSafe(True) & old


def needs_identifier(data_id: Column, unserpable: Column) -> Column:
    return data_id.isNull() & ~unserpable.eqNullSafe(True)


def highest_priority(df: DataFrame, n: int, *tie_break: str) -> DataFrame:
    """The first n rows by priority; without a priority last. Ties go by the given columns."""
    return df.orderBy(F.desc_nulls_last("priority"), *tie_break).limit(n)


def due_places(places: DataFrame, in_progress: DataFrame, as_of_day: Column, last_scraped: str = "last_scraped") -> DataFrame:
    """Places due for a refresh that nobody works on."""
    due = places.where(is_due(F.col("data_id"), F.col("unscrapable"), F.col(last_scraped), as_of_day))
    return absent_from(due, in_progress, ["place_id"])


def last_scraped_by_language(places: DataFrame, language: Column) -> Column:
    """Date of the last scrape in a language from ``map<language, date>``; null if never."""
    return F.try_element_at(F.col("last_scraped"), language)


def shape_requests(due: DataFrame, localization: DataFrame, country: str = "country") -> DataFrame:
    """Due places as scrape requests: language and domain of the country are added.

    Spark broadcasts the localization table if its size allows.
    """
    loc = localization.select(F.col("country").alias(country), "language", F.col("domain").alias("country_domain"))
    return due.join(loc, country).withColumn(
        "last_scraped",
        F.coalesce(F.date_format("last_scraped", "yyyy-MM-dd"), F.lit(config.NO_DATE_IN_REQUEST)),
    )


def as_message(keys: Sequence[str] = schemas.SCRAPE_REQUEST_KEYS) -> Column:
    """The given columns as one JSON message; null fields are kept as keys."""
    return F.to_json(F.struct(*keys), {"ignoreNullFields": "false"})


def id_requests(places: DataFrame) -> DataFrame:
    """Places that need an identifier as request messages (column ``value``); coordinates go as [latitude, longitude]."""
    wanted = places.where(needs_identifier(F.col("data_id"), F.col("unserpable")))
    shaped = wanted.withColumn("coords", F.when(F.col("coords").isNotNull(), F.array("coords.lat", "coords.lng")))
    return shaped.select(as_message(schemas.ID_REQUEST_KEYS).alias("value"))


def even_slots(keys: DataFrame, key: str, hours: float = 24.0, seed: int = 10, digits: int = 4) -> DataFrame:
    """Spread distinct keys evenly over the day in a seeded, repeatable random order.

    The order is that of a hash, so the first hex digits of it cut the keys into
    buckets of equal expected size. Positions are counted within a bucket, and the
    sizes of the buckets before it are added: only that table of 16**digits counts is
    ever in one window, never the keys.
    """
    hashed = keys.select(key).distinct().withColumn(
        "_hash", F.sha2(F.concat(F.lit(f"{seed}_"), F.col(key).cast("string")), 256)
    ).withColumn("_bucket", F.substring("_hash", 1, digits))
    sizes = hashed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_size"))
    total = F.sum("_size").over(Window.partitionBy(F.lit(1)))
    offsets = sizes.withColumns({
        "_before": F.sum("_size").over(Window.partitionBy(F.lit(1)).orderBy("_bucket")) - F.col("_size"),
        "_total": total,
    }).drop("_size")
    within = F.row_number().over(Window.partitionBy("_bucket").orderBy("_hash")) - 1
    return (
        hashed.withColumn("_within", within)
        .join(offsets, "_bucket", "left")
        .withColumn("position", F.col("_before") + F.col("_within"))
        .withColumn("slot", F.round(F.col("position") / F.col("_total") * hours, 1))
        .select(key, "position", "slot")
    )


def best_slots(slots: DataFrame, group: Sequence[str], hour: Column, as_of_s: Column,
               cool_down_s: int = config.SLOT_COOL_DOWN_S) -> DataFrame:
    """The slot of each group that fits the hour best, among those unused for a while.

    Expects name, slot (hour of day) and last_used (epoch seconds). The best is a
    maximum, combined before the shuffle. Ties go to the smallest name and slot.
    """
    rested = slots.where(as_of_s - F.col("last_used") > cool_down_s)
    scored = rested.withColumn("score", affinity(hour, F.col("slot")))
    best = F.min_by(F.struct("name", "slot", "score"), F.struct(-F.col("score"), "name", "slot"))
    return scored.groupBy(*group).agg(best.alias("_best")).select(*group, "_best.*")


def slot_report(slots: DataFrame) -> DataFrame:
    """All slots, the most recently used first."""
    return slots.orderBy(F.desc("last_used"), "name", "slot")


def ranked(df: DataFrame, folder: str, *order: Column, rank: str = "rank") -> DataFrame:
    """Add each row's place, from 1, in a total order of the whole table.

    Rows are dealt to tasks by ranges of the order and written below ``folder``; a row's
    rank is its place in its range and the sizes of the ranges before. A window holds
    one range, or one number per range, never the table.
    """
    path = f"{folder}/ranges"
    df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()).write.parquet(path)
    rows = df.sparkSession.read.parquet(path)
    sizes = rows.groupBy("_range").agg(F.count(F.lit(1)).alias("_size"))
    before = F.sum("_size").over(Window.partitionBy(F.lit(1)).orderBy("_range")) - F.col("_size")
    offsets = sizes.select("_range", before.alias("_before"))
    within = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return rows.withColumn("_within", within).join(offsets, "_range").withColumn(rank, F.col("_before") + F.col("_within")).drop("_range", "_within", "_before")


def expiry_report(live: DataFrame, suffix: str) -> DataFrame:
    """The keys with a suffix that are still set (``spans.live_keys``): name, without the suffix, and remaining_s."""
    return spans.keys_with_suffix(live, suffix).select("name", "remaining_s")
