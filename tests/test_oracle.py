"""Every query against its SQL on the same tables."""

from __future__ import annotations

import oracle
import pytest

from atlaslens.plans.catalog import ORACLES, QUERIES


@pytest.fixture(scope="module")
def connection(sf_dir):
    return oracle.connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(name, spark, sf_dir, connection):
    df = QUERIES[name](spark, sf_dir)
    assert oracle.differences(connection, ORACLES[name], df) is None


def test_a_difference_is_noticed(spark, sf_dir, connection):
    df = QUERIES["last_state"](spark, sf_dir)
    changed = df.selectExpr("slot_key", "value + 0.001 AS value", "set_at_us")
    assert oracle.differences(connection, ORACLES["last_state"], changed) is not None


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).columns == ["place_id", "data_id", "name", "priority", "last_scraped"]
