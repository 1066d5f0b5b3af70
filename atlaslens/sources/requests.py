"""Request messages: JSON text or bytes to columns, checked against the contract."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from atlaslens import schemas


def decode_body(body: Column) -> Column:
    """Message bytes as text."""
    return F.decode(body, "UTF-8")


def decode_requests(messages: DataFrame, body: str = "body", schema: str = schemas.SCRAPE_REQUEST) -> DataFrame:
    """Add ``request`` (the decoded fields) next to the other columns."""
    return messages.withColumn("request", F.from_json(F.col(body), schema))


def request_outcome(keys: Column, required: Column, expected_keys: Sequence[str] = schemas.SCRAPE_REQUEST_KEYS, name: str = "data_id") -> Column:
    """``ok``, ``malformed``, ``keys`` (key set differs) or the name of the required field (null or empty), from the sorted keys."""
    expected = F.array(*(F.lit(key) for key in sorted(expected_keys)))
    return (
        F.when(keys.isNull(), "malformed")
        .when(keys != expected, "keys")
        .when(F.coalesce(required, F.lit("")) == "", name)
        .otherwise("ok")
    )


def check_requests(messages: DataFrame, body: str = "body") -> DataFrame:
    """Decoded messages with their outcome. Rejected ones stay, for a quarantine table."""
    decoded = decode_requests(messages, body)
    keyed = decoded.withColumn("_keys", F.sort_array(F.json_object_keys(body)))
    return keyed.withColumn("outcome", request_outcome(F.col("_keys"), F.col("request.data_id"))).drop("_keys")


def check_id_requests(messages: DataFrame, body: str = "body") -> DataFrame:
    """Requests for an identifier, decoded, with their outcome: they need a place, and have no identifier yet."""
    decoded = decode_requests(messages, body, schemas.ID_REQUEST).withColumn("_keys", F.sort_array(F.json_object_keys(body)))
    outcome = request_outcome(F.col("_keys"), F.col("request.place_id"), schemas.ID_REQUEST_KEYS, "place_id")
    return decoded.withColumn("outcome", outcome).drop("_keys")
