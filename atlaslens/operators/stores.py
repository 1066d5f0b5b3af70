"""Keeping tables up to date: every rule as a new DataFrame, writing is separate.

Plain Parquet has no MERGE. A changed table is therefore written as a new version
next to the old one and the reader told which version to use; no path is overwritten
while it is read, and a job that fails half way leaves the old version intact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from atlaslens.operators.dedupe import absent_from, first_per_key


def insert_ignore(batch: DataFrame, store: DataFrame, key: str, *order: Column) -> DataFrame:
    """Rows of the batch to append: one per key, none whose key is already stored.

    Rows without a key cannot be told apart and are not appended; see ``without_key``.
    """
    return absent_from(first_per_key(batch.where(F.col(key).isNotNull()), [key], order), store, [key])


def without_key(batch: DataFrame, key: str) -> DataFrame:
    """Rows of a batch that have no key, for the quarantine."""
    return batch.where(F.col(key).isNull())


def upsert_set(store: DataFrame, incoming: DataFrame, key: str, array: str, element: str) -> DataFrame:
    """Add elements to the array of their key, creating keys that are new.

    ``store`` has one row per key; ``incoming`` any number of (key, element) rows,
    made distinct before they are gathered so that a hot key carries each element once.
    """
    additions = incoming.select(key, element).distinct().groupBy(key).agg(
        F.collect_set(element).alias("_added")
    )
    empty = F.expr("cast(array() as array<string>)")
    return (
        store.join(additions, key, "full")
        .withColumn(array, F.sort_array(F.array_union(F.coalesce(array, empty), F.coalesce("_added", empty))))
        .drop("_added")
    )


def upsert_rows(store: DataFrame, rows: DataFrame, key: str, array: str) -> DataFrame:
    """Rows with a new key are added; of the others only the array's elements are merged in.

    Both tables have one row per key.
    """
    elements = rows.select(key, F.col(array).alias("_added"))
    empty = F.expr("cast(array() as array<string>)")
    kept = (
        store.join(elements, key, "left")
        .withColumn(array, F.sort_array(F.array_union(F.coalesce(array, empty), F.coalesce("_added", empty))))
        .drop("_added")
    )
    return kept.unionByName(absent_from(rows, store, [key]), allowMissingColumns=True)


def update_column(store: DataFrame, updates: DataFrame, key: str, column: str) -> DataFrame:
    """Set a column where there is an update (one row per key); other rows keep theirs."""
    new = updates.select(key, F.col(column).alias("_new"))
    return store.join(new, key, "left").withColumn(column, F.coalesce("_new", column)).drop("_new")


def update_map_entry(store: DataFrame, updates: DataFrame, key: str, column: str, entry: Column, value: str) -> DataFrame:
    """Set one entry of a map column where there is an update (one row per key)."""
    new = updates.select(key, F.col(value).alias("_value"))
    current = F.coalesce(F.col(column), F.expr("cast(map() as map<string, date>)"))
    others = F.map_filter(current, lambda name, _: name != entry)
    changed = F.map_concat(others, F.create_map(entry, F.col("_value")))
    return (
        store.join(new, key, "left")
        .withColumn(column, F.when(F.col("_value").isNotNull(), changed).otherwise(F.col(column)))
        .drop("_value")
    )


def unexpired(stored_at_us: Column, ttl_s: Column, as_of_us: Column) -> Column:
    """Whether a stored row is still within its retention period."""
    return stored_at_us + ttl_s * 1_000_000 > as_of_us


def expired_days(days: Column, as_of_day: Column, ttl_s: int) -> Column:
    """Whether a whole day partition is past retention and can be dropped unread."""
    return days < F.date_sub(as_of_day, ttl_s // 86400)


def quarantined(rows: DataFrame, outcome: str = "outcome", accepted: Sequence[str] = ("OK", "ok")) -> DataFrame:
    """Rows set aside for inspection: every outcome that is not accepted, also none at all."""
    return rows.where(~F.coalesce(F.col(outcome).isin(*accepted), F.lit(False)))


def append(df: DataFrame, path: str, *partition_by: str) -> None:
    """Append to a Parquet table partitioned by the given columns."""
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def append_messages(df: DataFrame, path: str, message: Column) -> None:
    """Append one JSON message per line, as work items for whoever reads the folder."""
    df.select(message.alias("value")).write.mode("append").text(path)


def write_version(df: DataFrame, root: str, version: str, *partition_by: str) -> None:
    """Write a whole table as a new version; fails when the version exists."""
    df.write.mode("errorifexists").partitionBy(*partition_by).parquet(f"{root}/{version}")


def read_version(spark: SparkSession, root: str, version: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{version}")
