"""Stores in buckets: what a batch touches, what a failure leaves, and batches that come twice."""

from __future__ import annotations

import glob
import io
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from atlaslens.operators import keyed_store
from atlaslens.operators.keyed_store import KeyedStore, VersionConflict
from atlaslens.streaming import jobs

ROW = "k string, v int, m map<string,date>"


def rows(spark, *pairs):
    return spark.createDataFrame([(k, v, None) for k, v in pairs], ROW)


def held(store, version=None):
    return sorted((r.k, r.v) for r in store.read(version).collect())


def files(root):
    return set(glob.glob(f"{root}/data/*/bucket=*/*.parquet"))


@pytest.fixture
def store(spark, tmp_path):
    return KeyedStore(spark, str(tmp_path / "s"), ["k"], buckets=8)


def test_insert_keeps_what_is_stored(spark, store):
    assert store.version() == 0 and store.read().collect() == []
    store.insert(rows(spark, ("a", 2), ("a", 1), ("b", 1), (None, 9)), F.col("v"))
    before = files(store.root)
    store.insert(rows(spark, ("a", 0), ("c", 5), ("c", 4), (None, 1)), F.col("v"))
    assert held(store) == [("a", 1), ("b", 1), ("c", 4)] and held(store, 1) == [("a", 1), ("b", 1)]
    assert before < files(store.root) and len(files(store.root) - before) == 1
    assert store.insert(rows(spark)) == 3 and held(store) == [("a", 1), ("b", 1), ("c", 4)]


def test_update_writes_only_its_buckets(spark, store):
    store.insert(rows(spark, *[(f"k{i}", i) for i in range(200)]))
    before = store.manifest()["folders"]
    store.update(rows(spark, ("k7", 70), ("new", 1), (None, 2)), keyed_store.set_column("v", "k"))
    after = store.manifest()["folders"]
    changed = {bucket for bucket in before if before[bucket] != after[bucket]}
    assert 1 <= len(changed) <= 2 and set(after) == set(before)  # the buckets of k7 and of the unknown key
    assert held(store) == sorted((f"k{i}", 70 if i == 7 else i) for i in range(200))
    day = spark.createDataFrame([("k7", None), ("k8", "2024-05-01")], "k string, d string").select("k", F.to_date("d").alias("d"))
    store.update(day, keyed_store.set_map_entry("m", "k", "en", "d"))
    found = {r.k: r.m for r in store.read().where("k IN ('k7', 'k8')").collect()}
    assert found["k7"] is None and str(found["k8"]["en"]) == "2024-05-01"
    assert store.update(day.limit(0), keyed_store.set_column("v", "k")) == 3


@pytest.mark.parametrize("limit", [keyed_store.BROADCAST_BYTES, 0])
def test_large_and_small_batches_agree(spark, store, monkeypatch, limit):
    monkeypatch.setattr(keyed_store, "BROADCAST_BYTES", limit)
    store.insert(rows(spark, *[(f"k{i}", i) for i in range(0, 300, 2)]))
    store.insert(rows(spark, *[(f"k{i}", -i) for i in range(300)]))
    assert held(store) == sorted((f"k{i}", -i if i % 2 else i) for i in range(300))


def test_small_batches_do_not_shuffle_the_store(spark, store):
    store.insert(rows(spark, *[(f"k{i}", i) for i in range(50)]))
    out = io.StringIO()
    with redirect_stdout(out):
        store._absent(rows(spark, ("k1", 1)), store.read()).explain("formatted")
    plan = out.getvalue()
    assert "BroadcastHashJoin LeftSemi" in plan and "SortMergeJoin" not in plan and "hashpartitioning" not in plan
    assert "ReadSchema: struct<k:string>" in plan


def test_failure_before_the_manifest_leaves_the_old_version(spark, store, monkeypatch):
    store.insert(rows(spark, ("a", 1)))

    def fail(*_, **__):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(store, "_commit", fail)
        with pytest.raises(RuntimeError):
            store.insert(rows(spark, ("b", 1)))
        with pytest.raises(RuntimeError):
            store.update(rows(spark, ("a", 5)), keyed_store.set_column("v", "k"))
    assert held(store) == [("a", 1)] and store.version() == 1
    store.insert(rows(spark, ("b", 2)))
    assert held(store) == [("a", 1), ("b", 2)]
    assert len(store.drop_unused()) == 2 and held(store) == [("a", 1), ("b", 2)]


def test_the_second_of_two_writers_fails(spark, store, monkeypatch):
    store.insert(rows(spark, ("a", 1)))
    late = KeyedStore(spark, store.root, ["k"], buckets=8)
    monkeypatch.setattr(late, "version", lambda: 1)
    store.insert(rows(spark, ("b", 1)))
    with pytest.raises(VersionConflict):
        late.insert(rows(spark, ("c", 1)))
    assert held(store) == [("a", 1), ("b", 1)]


def test_many_small_inserts_are_merged(spark, store, monkeypatch):
    monkeypatch.setattr(keyed_store, "MOST_FOLDERS", 2)
    for i in range(5):
        store.insert(rows(spark, *[(f"k{i}-{j}", j) for j in range(30)]))
    assert len(held(store)) == 150
    assert all(len(writes) <= 2 for writes in store.manifest()["folders"].values())
    store.drop_unused()
    assert len(held(store)) == 150 and store.version() == 5


def test_a_batch_counts_once(spark, store):
    batch = rows(spark, ("a", 1))
    assert store.insert(batch, source="s", number=0) == 1
    assert store.insert(rows(spark, ("b", 1)), source="s", number=0) == 1
    assert store.insert(rows(spark, ("b", 1)), source="other", number=0) == 2
    assert store.update(rows(spark, ("a", 7)), keyed_store.set_column("v", "k"), "s", 1) == 3
    assert store.update(rows(spark, ("a", 8)), keyed_store.set_column("v", "k"), "s", 1) == 3
    assert held(store) == [("a", 7), ("b", 1)]


def test_stream_into_a_store_survives_a_lost_checkpoint(spark, store, tmp_path):
    folder = str(tmp_path / "in")
    for i in range(3):
        rows(spark, (f"k{i}", i), ("same", i)).coalesce(1).write.mode("append").parquet(folder)
    stream = lambda: jobs.file_stream(spark, folder, ROW, max_files=1)
    jobs.insert_into(stream(), store, str(tmp_path / "a"), "reviews", F.col("v"))
    whole, version = held(store), store.version()
    assert [k for k, _ in whole] == ["k0", "k1", "k2", "same"] and version == 3
    jobs.insert_into(stream(), store, str(tmp_path / "a"), "reviews", F.col("v"))  # nothing new
    jobs.insert_into(stream(), store, str(tmp_path / "b"), "reviews", F.col("v"))  # every batch once more
    assert held(store) == whole and store.version() == version


def test_sets_are_gathered_on_output(spark, tmp_path):
    pairs = KeyedStore(spark, str(tmp_path / "p"), ["a", "b"], buckets=4)
    batch = lambda *found: spark.createDataFrame(found, "a string, b string")
    pairs.insert(batch(("x", "q2"), ("x", "q2"), ("y", "q1"), ("z", None)))
    pairs.insert(batch(("x", "q1"), ("x", "q2")))
    assert {r.a: r.all for r in keyed_store.sets(pairs.read(), "a", "b", "all").collect()} == {"x": ["q1", "q2"], "y": ["q1"]}
    with pytest.raises(ValueError):
        KeyedStore(spark, pairs.root, ["a"]).read()
