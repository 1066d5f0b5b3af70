"""Key-value state and keyed lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def find(table: DataFrame, condition: Column, columns: Sequence[str]) -> DataFrame:
    """Keyed find with projection: both reach the file scan."""
    return table.where(condition).select(*columns)


def hash_pairs(table: DataFrame, pairs: str = "pairs") -> DataFrame:
    """Rows (key, value) from a column of maps; the other columns are repeated."""
    return table.select(*(column for column in table.columns if column != pairs), F.explode(pairs).alias("key", "value"))


def decode_slots(rows: DataFrame) -> DataFrame:
    """Name, slot and last use from rows with key ``<name>_<slot>`` and value epoch seconds.

    The name may itself hold ``_``: the slot is the part after the last one. Best done
    after the last write of each key was chosen, so that each key is taken apart once.
    """
    return rows.withColumns({
        "name": F.substring_index("key", "_", -1),
    }).withColumns({
        "slot": F.col("name").try_cast("double"),
        "name": F.expr("left(key, length(key) - length(name) - 1)"),
        "last_used": F.col("value").try_cast("double"),
    }).drop("key", "value")


def encode_slot(name: Column, slot: Column) -> Column:
    return F.concat(name.cast("string"), F.lit("_"), slot.cast("string"))
