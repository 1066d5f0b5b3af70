"""What leaves a task grows with its members, not with their pairs."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from atlaslens.llm import collocations
from atlaslens.llm import ngram_join as J
from atlaslens.llm.components import connected_components


def _members(spark, copies, groups):
    """Sets that all link and sets that share a passage only, in several groups; every one is a component of its own so far."""
    rng = np.random.default_rng(5)
    draw = lambda n: rng.integers(0, 2**63, n).astype(np.uint64)
    base, passage = draw(300), draw(60)
    sets = [np.unique(np.concatenate((base, draw(9)))) for _ in range(copies)] + [np.unique(np.concatenate((passage, draw(200)))) for _ in range(20)]
    rows = [(key, len(s), key, J.point(s, J.GROUPS), J.point(s, J.finest(len(s))), s.tobytes()) for key, s in enumerate(sets)]
    df = spark.createDataFrame(rows, "key long, n long, label long, coarse binary, fine binary, shingles binary")
    members = df.drop("shingles").withColumn("shingle", F.explode(F.sequence(F.lit(1), F.lit(groups)))).where(F.pmod("key", F.lit(7)) != F.col("shingle"))
    return sets, members, df.select("key", "shingles")


@pytest.mark.parametrize("chunk", [2_048, 16])
def test_trees_tell_members_and_spanning_links(spark, monkeypatch, chunk):
    monkeypatch.setattr(J, "CHUNK", chunk)  # with 16 there are many chunks, and what overlaps is too large to be put together
    sets, members, own = _members(spark, 60, 5)
    trees = J.chunked(members, ["shingle"], F.count("*") / J.CHUNK).persist()
    found = J.near_groups(trees)
    assert 0 < found.count() <= trees.count()
    assert found.groupBy("x", "y").agg(F.count("*").alias("n"), F.countDistinct("key").alias("k")).where("n <> k").isEmpty()
    near = J.put_together(found)
    if chunk > len(sets):
        assert near.count() == near.select("key").distinct().count() == 60  # each set is sent once
    links = [(r.a, r.b) for r in J.group_links(near, own).collect()]
    assert all(a < b and J.linked(sets[a], sets[b]) for a, b in links)
    assert len(links) == 59 if chunk > len(sets) else 59 <= len(links) < 60 * 59 / 2
    parts = connected_components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.node: r.component for r in parts} == dict.fromkeys(range(60), 0)
    trees.unpersist()


def test_large_sets_are_dealt_into_chunks_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(J, "CHUNK_BYTES", 20 * 8 * 309)
    _, members, own = _members(spark, 60, 5)
    near = J.put_together(J.near_groups(J.chunked(members, ["shingle"], F.count("*") / J.CHUNK)))
    links = J.group_links(near, own)
    assert [r.component for r in connected_components(links).collect()] == [0] * 60


def test_a_run_of_rows_may_go_over_many_batches():
    import pyarrow as pa

    rows = [(1, 1), (1, 1), (1, 2), (1, 2), (1, 2), (2, 2), (3, 0)]
    for cut in range(1, len(rows) + 1):
        batches = [pa.RecordBatch.from_pylist([{"s": s, "c": c} for s, c in rows[k : k + cut]]) for k in range(0, len(rows), cut)]
        found = [[tuple(r.values()) for r in run.to_pylist()] for runs in J._runs(iter(batches), ("s", "c")) for run in runs]
        assert found == [rows[:2], rows[2:5], rows[5:6], rows[6:]]


def _windows(spark, monkeypatch, docs, least):
    """The rows of the window stage, and the phrases."""
    made = []

    def stage(df, name):
        staged = plain(df, name)
        if name == "windows":
            made.extend(tuple(r) for r in staged.select("lang", "phrase", "n").collect())
        return staged

    plain = collocations.stage
    with monkeypatch.context() as m:
        m.setattr(collocations, "stage", stage)
        phrases = sorted(tuple(r) for r in collocations.mine(docs, least).collect())
    return made, phrases


def _texts(spark, count, parts):
    rows = [(k, "en" if k % 3 else "fr", f"a b c d{k % 4}, e f{k % 3} g") for k in range(count)]
    return spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(parts, "doc_id")


def test_windows_do_not_grow_with_the_parts_of_the_input(spark, monkeypatch):
    cores = spark.sparkContext.defaultParallelism
    few, expected = _windows(spark, monkeypatch, _texts(spark, 600, 1), 5)
    many, phrases = _windows(spark, monkeypatch, _texts(spark, 600, 5 * cores), 5)
    assert phrases == expected and phrases
    assert len(few) == len({r[:2] for r in few}) and len(many) <= cores * len(few)
    assert sum(r[2] for r in many) == sum(r[2] for r in few)


@pytest.mark.parametrize("kept", [1, 1 << 19])
def test_equal_windows_are_merged_over_all_that_a_task_reads(spark, monkeypatch, kept):
    whole, expected = _windows(spark, monkeypatch, _texts(spark, 600, 1), 5)
    monkeypatch.setattr(collocations, "FLUSH", 16)
    monkeypatch.setattr(collocations, "MERGED", kept)  # with 1 they are sent each time
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(rows)
    spark.conf.set(rows, "20")  # many blocks
    try:
        found, phrases = _windows(spark, monkeypatch, _texts(spark, 600, 1), 5)
    finally:
        spark.conf.set(rows, before)
    assert phrases == expected
    assert sorted(found) == sorted(whole) if kept > 1 else len(found) > len(whole)
