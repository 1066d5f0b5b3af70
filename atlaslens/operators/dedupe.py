"""One row per key, safe when a key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in a total order.

    The rank-one filter is planned as a limit per group on both sides of the
    shuffle, so each task sends at most one row per key, however hot the key is.
    """
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_position", position).where("_position = 1").drop("_position")


def latest_values(df: DataFrame, keys: Sequence[str], values: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Last write wins: the values of the latest row of each key, combined before the shuffle."""
    newest = F.max_by(F.struct(*values), F.struct(*order)).alias("_newest")
    return df.groupBy(*keys).agg(newest).select(*keys, "_newest.*")


def absent_from(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not in the other table. A null key in the other table hides nothing."""
    return df.join(other.select(*keys).distinct(), list(keys), "left_anti")
