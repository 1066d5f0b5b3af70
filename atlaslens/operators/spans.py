"""State with expiry: live keys, and the spans in which a key stayed alive."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def live_keys(state: DataFrame, as_of: Column, key: str = "key", set_at: str = "set_at", ttl_s: str = "ttl_s") -> DataFrame:
    """Keys whose latest set has not expired, with the seconds they have left.

    ``set_at`` is in whole microseconds. Setting a key again replaces its expiry,
    so only the latest row of a key counts. A key is gone at exactly set_at + ttl.
    A row with a null ttl deletes its key; of a set and a delete at the same time
    the set counts.
    """
    latest = state.groupBy(key).agg(F.max_by(F.struct(set_at, ttl_s), F.struct(set_at, ttl_s)).alias("_last"))
    left_us = F.col(f"_last.{set_at}") + F.col(f"_last.{ttl_s}") * 1_000_000 - as_of
    return (
        latest.withColumn("_left_us", left_us)
        .where("_left_us > 0")
        .select(
            key,
            F.col(f"_last.{set_at}").alias(set_at),
            F.floor(F.col("_left_us") / 1_000_000).cast("long").alias("remaining_s"),
        )
    )


def latest_writes(state: DataFrame, *value: str, key: str = "key", set_at: str = "set_at", ttl_s: str = "ttl_s") -> DataFrame:
    """The latest set or delete of each key, with its value columns: what ``live_keys`` needs, folded before the shuffle.

    The fold may be repeated on its own results in any grouping. Of writes at the
    same time a set counts before a delete, then the longer ttl, then the greater
    value.
    """
    found = F.struct(set_at, ttl_s, *value)
    order = F.struct(F.col(set_at), F.col(ttl_s).isNotNull(), F.col(ttl_s), *value)
    return state.groupBy(key).agg(F.max_by(found, order).alias("_last")).select(key, "_last.*")


def keys_with_prefix(state: DataFrame, prefix: str, key: str = "key", name: str = "name") -> DataFrame:
    """Rows whose key begins with the prefix, with the rest of the key as a column."""
    return state.where(F.startswith(F.col(key), F.lit(prefix))).withColumn(
        name, F.expr(f"right({key}, length({key}) - {len(prefix)})")
    )


def keys_with_suffix(state: DataFrame, suffix: str, key: str = "key", name: str = "name") -> DataFrame:
    """Rows whose key ends with the suffix, with the rest of the key as a column."""
    return state.where(F.endswith(F.col(key), F.lit(suffix))).withColumn(
        name, F.expr(f"left({key}, length({key}) - {len(suffix)})")
    )


def span_slices(df: DataFrame, keys: list[str], at_us: str, ttl_s: int, *latest: str) -> DataFrame:
    """Sets folded to one row per key and ``ttl_s`` slice of time.

    Rows of one key in the same slice are less than a ttl apart, so they always
    share a span: nothing is lost by folding them, in any order and in any number
    of batches. ``latest`` names columns whose values at the last set are kept; they
    break ties of time, in the order given.
    """
    width = ttl_s * 1_000_000
    slice_start = F.col(at_us) - F.pmod(F.col(at_us), F.lit(width))
    return df.groupBy(*keys, slice_start.alias("_slice")).agg(
        F.min(at_us).alias("_first"), F.max(F.struct(at_us, *latest)).alias("_end"), F.count(F.lit(1)).alias("_n")
    )


def spans_of_slices(slices: DataFrame, keys: list[str], at_us: str, ttl_s: int, *latest: str) -> DataFrame:
    """Spans from slices, which may come from several batches: keys, span_start_us, last_set_us, n_sets, latest values.

    The windows see one row per key and slice, a number bounded by the length of the
    time range and not by the rows.
    """
    width = ttl_s * 1_000_000
    merged = merge_slices(slices, keys)
    in_time = Window.partitionBy(*keys).orderBy("_slice")
    starts = F.coalesce(F.col("_first") - F.lag(f"_end.{at_us}").over(in_time) >= width, F.lit(True))
    return (
        merged.withColumn("_starts", starts.cast("int"))
        .withColumn("_span", F.sum("_starts").over(in_time))
        .groupBy(*keys, "_span")
        .agg(F.min("_first").alias("span_start_us"), F.max("_end").alias("_end"), F.sum("_n").alias("n_sets"))
        .select(*keys, "span_start_us", F.col(f"_end.{at_us}").alias("last_set_us"), "n_sets", *(F.col(f"_end.{c}").alias(c) for c in latest))
    )


def merge_slices(slices: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key and slice from those of several batches."""
    return slices.groupBy(*keys, "_slice").agg(F.min("_first").alias("_first"), F.max("_end").alias("_end"), F.sum("_n").alias("_n"))


def alive_spans(df: DataFrame, key: str, at_us: str, ttl_s: int) -> DataFrame:
    """Spans in which a key stayed set, when every row sets it for ``ttl_s`` seconds.

    A span ends where the next set comes ``ttl_s`` or more after the last one.
    Returns key, span_start_us, last_set_us and n_sets.
    """
    return spans_of_slices(span_slices(df, [key], at_us, ttl_s), [key], at_us, ttl_s)
