"""What the plans must not contain, and what must reach the scan."""

from __future__ import annotations

import contextlib
import io
import re

import pytest

from atlaslens.plans.catalog import QUERIES

BATCH = sorted(name for name in QUERIES if not name.startswith("s_"))
READS_HTML = {"positional_zip", "extraction_counts", "review_rows", "refresh_run"}


def plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_join_and_no_python(name, spark, sf_dir):
    text = plan(QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    if name not in READS_HTML:
        assert "Python" not in text and "InPandas" not in text


def scans(text: str) -> list[str]:
    return re.findall(r"ReadSchema: struct<(.*)>", text)


@pytest.mark.parametrize("name, columns", [
    ("lease_spans", {"ts:timestamp_ntz,user_id:bigint"}),
    ("token_chain", {"conv_id:bigint,turn:bigint,text:string"}),
    ("insert_ignore", {"doc_id:bigint,text:string", "doc_id:bigint"}),
    ("need_id_batch", {"c_custkey:bigint,c_name:string,c_nationkey:int,c_acctbal:double,c_mktsegment:string"}),
])
def test_only_needed_columns_are_read(name, columns, spark, sf_dir):
    assert set(scans(plan(QUERIES[name](spark, sf_dir)))) == columns


def test_filters_reach_the_scan(spark, sf_dir):
    text = plan(QUERIES["resume_point"](spark, sf_dir))
    assert "EqualTo(role,assistant)" in text


@pytest.mark.parametrize("name", ["scan_dedupe", "serp_cache_lookup", "link_classify", "insert_ignore"])
def test_one_row_per_key_is_limited_before_the_shuffle(name, spark, sf_dir):
    text = plan(QUERIES[name](spark, sf_dir))
    assert re.search(r"WindowGroupLimit.*\n(.*\n)*?.*Partial", text)


def test_limited_lists_are_not_sorted_in_full(spark, sf_dir):
    for name in ("due_selection", "need_id_batch"):
        assert "TakeOrderedAndProject" in plan(QUERIES[name](spark, sf_dir))
