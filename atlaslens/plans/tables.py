"""The given tables, and the frames of the domain that Spark derives from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from atlaslens import config, schemas


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def micros(ts: str | Column) -> Column:
    """Whole microseconds since 1970, times without zone taken as UTC."""
    column = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_micros(column.cast("timestamp"))


def day_text(column: str | Column) -> Column:
    return F.date_format(column, "yyyy-MM-dd")


def latest(df: DataFrame, column: str | Column) -> Column:
    """The largest value of a column as a scalar subquery: one row, found on the cluster."""
    return df.agg(F.max(column)).scalar()


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with their time in microseconds."""
    return table(spark, sf_dir, "events").withColumn("at_us", micros("ts"))


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as places; the flags and identifiers follow from balance and segment."""
    segment = F.col("c_mktsegment")
    return table(spark, sf_dir, "customer").select(
        F.concat(F.lit("p"), F.col("c_custkey")).alias("place_id"),
        F.when(F.col("c_acctbal") >= 0, F.concat(F.lit("d"), F.col("c_custkey"))).alias("data_id"),
        F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("priority"),
        F.when(segment == "BUILDING", True).when(segment != "FURNITURE", False).alias("unserpable"),
        F.when(segment == "MACHINERY", True).when(segment != "FURNITURE", False).alias("unscrapable"),
        "c_custkey", "c_nationkey",
    )


def last_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day of each customer's last order, as the day of a place's last scrape."""
    return table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.to_date(F.max("o_orderdate")).alias("last_scraped")
    )


def leases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event takes a lease on its user's place. Leases long past are not read."""
    source = events(spark, sf_dir)
    recent = source.where(F.col("ts") > latest(source, "ts") - F.expr(f"interval {config.LEASE_TTL_S} seconds"))
    return recent.select(
        F.concat(F.lit(config.LEASE_PREFIX + "p"), F.col("user_id")).alias("key"),
        F.col("at_us").alias("set_at"),
        F.lit(config.LEASE_TTL_S).cast("long").alias("ttl_s"),
    )


def customer_points() -> dict[str, Column]:
    """A position for each customer key, spread over the globe by integer arithmetic."""
    key = F.col("c_custkey")
    return {
        "lat": (key * 37 % 12000) / 100.0 - 60.0,
        "lng": (key * 91 % 36000) / 100.0 - 180.0,
    }


def town_point(key: Column) -> dict[str, Column]:
    """A position inside one town, so that many rows share cells."""
    return {
        "lat": (key * 7919 % 2000) / 10000.0 + 40.0,
        "lng": (key * 104729 % 4000) / 10000.0 - 3.8,
    }


# One localization per region name.
REGION_LOCALIZATION = [
    ("AFRICA", "en", "co.za", "Food", "Service", "Atmosphere"),
    ("AMERICA", "en", "com", "Food", "Service", "Atmosphere"),
    ("ASIA", "en", "co.jp", "Food", "Service", "Atmosphere"),
    ("EUROPE", "es", "es", "Comida", "Servicio", "Ambiente"),
    ("MIDDLE EAST", "en", "ae", "Food", "Service", "Atmosphere"),
]


def region_localization(spark: SparkSession) -> DataFrame:
    return config.localization_table(spark, REGION_LOCALIZATION)


def places_with_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey")
    region = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("country"))
    return places(spark, sf_dir).join(nation, "c_nationkey").join(region, "n_regionkey").drop("n_regionkey")


def request_bodies(events: DataFrame) -> DataFrame:
    """Events as request messages; their type decides how they keep the contract."""
    fields = {
        "place_id": F.concat(F.lit("p"), F.col("user_id")),
        "data_id": F.when(F.col("event_type") == "purchase", F.when(F.col("value") < 50, F.lit("")).otherwise(F.lit("d1")))
        .when(F.col("event_type") != "error", F.lit("d2")),
        "name": F.col("event_type"),
        "language": F.lit("en"),
        "country_domain": F.lit("es"),
        "last_scraped": F.lit(config.NO_DATE_IN_REQUEST),
    }
    six = [column.alias(name) for name, column in fields.items()]
    seven = [*six, F.col("user_id").cast("int").alias("priority")]
    keep_nulls = {"ignoreNullFields": "false"}
    body = (
        F.when(F.col("event_type") == "click", F.to_json(F.struct(*six), keep_nulls))
        .when(F.col("event_type") == "signup", F.to_json(F.struct(*seven, F.lit("x").alias("note")), keep_nulls))
        .otherwise(F.to_json(F.struct(*seven), keep_nulls))
    )
    cut = F.when(F.col("value") > 300, F.substring(body, 1, 20)).otherwise(body)
    return events.withColumn("body", cut)


def review_days(spark: SparkSession, sf_dir: str, days_per_page: int = 3) -> DataFrame:
    """Events as reviews on pages, newest first: a page holds three days of one user and language."""
    source = table(spark, sf_dir, "events")
    newest_day = latest(source, F.to_date("ts"))
    return source.select(
        F.col("user_id").alias("place_id"),
        F.when(F.col("event_type").isin("click", "view"), "en").otherwise("es").alias("language"),
        F.floor(F.datediff(newest_day, F.to_date("ts")) / days_per_page).cast("int").alias("page_number"),
        F.to_date("ts").alias("review_date"),
        "value",
    )


def conversation_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns of a conversation as pages of a place; short ones carry no next-page token."""
    return table(spark, sf_dir, "conversations").select(
        "conv_id",
        F.col("turn").cast("int").alias("page_number"),
        F.when(F.length("text") > 100, F.concat(F.substring(F.sha2("text", 256), 1, 12), F.lit("=="))).alias("next_page_token"),
        "role", "text",
    )


def stream_glob(sf_dir: str, name: str) -> str:
    """A glob that matches the table whether it is one file or a folder of files."""
    return f"{sf_dir}/{name}.parquet*"


DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
EVENTS = schemas.EVENTS
