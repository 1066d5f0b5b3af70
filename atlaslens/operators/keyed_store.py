"""Keyed tables in hash buckets, with a manifest per version.

Plain Parquet has no MERGE and no transactions. A store is a folder:

    data/<write>/bucket=<n>/...parquet   what one write added for some buckets
    manifests/<version>                  the folders that are live, one line each

The bucket of a row is a hash of its key, so a batch only concerns the buckets of
its own keys. An insert adds folders, an update replaces the folders of the
buckets it touches, and all other files stay as they are. A version exists once
its manifest does; that is one rename, so a job that fails before leaves the old
version, and a second job that finished first makes this one fail instead of
undoing its work. Folders of a failed write are in no manifest and are never read.

A manifest also names the last batch each source has delivered. A stream that
starts again and delivers a batch once more therefore adds nothing.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from atlaslens.operators.dedupe import absent_from, first_per_key

BUCKETS = 64
#: An insert that would leave a bucket with more folders than this rewrites the bucket as one.
MOST_FOLDERS = 8
#: Keys of a batch are sent to the stored rows, instead of these being shuffled, up to this many bytes.
BROADCAST_BYTES = 32 << 20


class VersionConflict(RuntimeError):
    """Another job has written the next version first."""


class KeyedStore:
    """A table with at most one row per key. ``keys`` are its key columns, none of them null in a stored row."""

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], buckets: int = BUCKETS):
        self.spark, self.root, self.keys, self.buckets = spark, root.rstrip("/"), list(keys), buckets

    # Versions.

    def version(self) -> int:
        """The number of the newest version; 0 before the first."""
        system, folder = self._path("manifests")
        if not system.exists(folder):
            return 0
        names = [entry.getPath().getName() for entry in system.listStatus(folder)]
        return max((int(name) for name in names if name.isdigit()), default=0)

    def manifest(self, version: int | None = None) -> dict:
        """Live folders per bucket, the schema and the last batch of each source, as of a version."""
        version = self.version() if version is None else version
        if not version:
            return {"schema": None, "buckets": self.buckets, "folders": {}, "batches": {}}
        line = self.spark.read.text(f"{self.root}/manifests/{version:08d}", wholetext=True).first()[0]
        found = json.loads(line)
        if found["keys"] != self.keys:
            raise ValueError(f"the store has the keys {found['keys']}")
        return found | {"folders": {int(bucket): writes for bucket, writes in found["folders"].items()}}

    def read(self, version: int | None = None, buckets: Sequence[int] | None = None) -> DataFrame:
        """The rows of a version, of some buckets or of all."""
        return self._rows(self.manifest(version), buckets)

    def _rows(self, manifest: dict, buckets: Sequence[int] | None = None) -> DataFrame:
        wanted = manifest["folders"] if buckets is None else buckets
        paths = [f"{self.root}/data/{write}/bucket={bucket}" for bucket in sorted(wanted) for write in manifest["folders"].get(bucket, [])]
        if not paths:
            return self.spark.createDataFrame([], StructType.fromJson(manifest["schema"] or StructType().jsonValue()))
        return self.spark.read.schema(StructType.fromJson(manifest["schema"])).parquet(*paths)

    # Writing.

    def insert(self, batch: DataFrame, *order: Column, source: str | None = None, number: int = 0) -> int:
        """Add the rows whose key is not stored yet, the first of each key in ``order``. Returns the version then current.

        Rows with a null in a key cannot be told apart and are not added. Stored
        files are only read for their keys, and none is written again unless a
        bucket is in too many pieces. ``source`` and ``number`` name the batch: one
        that is not newer than the last of its source is left out as a whole.
        """
        before = self.version()
        manifest = self.manifest(before)
        if source is not None and number <= manifest["batches"].get(source, -1):
            return before
        first = first_per_key(batch.where(self._keyed()), self.keys, order or [F.lit(0)])
        if manifest["schema"] is None:
            return self._commit(before, manifest, self._write(first), source, number, batch.schema)
        incoming = f"{self.root}/incoming/{uuid.uuid4().hex}"  # read several times below, worked out once
        first.write.parquet(incoming)
        first = self.spark.read.schema(first.schema).parquet(incoming)
        buckets = self._buckets_of(first)
        added = self._write(self._absent(first, self._rows(manifest, buckets))) if buckets else {}
        kept = {bucket: manifest["folders"].get(bucket, []) + writes for bucket, writes in added.items()}
        crowded = [bucket for bucket, writes in kept.items() if len(writes) > MOST_FOLDERS]
        if crowded:
            kept |= {bucket: [] for bucket in crowded} | self._write(self._rows({**manifest, "folders": kept}, crowded))
        version = self._commit(before, manifest, kept, source, number)
        system, folder = self._path(incoming.removeprefix(f"{self.root}/"))
        system.delete(folder, True)
        return version

    def add(self, rows: DataFrame, fold: Callable[[DataFrame], DataFrame], source: str | None = None, number: int = 0) -> int:
        """Add what a batch knows about its keys, to be folded when read (``folded``).

        ``fold`` takes any number of rows per key to one and does not mind their
        order or grouping, such as a maximum, a sum or the latest write. A batch
        only adds folders; a bucket with more than ``MOST_FOLDERS`` of them is
        folded to one, so what is read stays in proportion to the keys. Keys may
        be null here.
        """
        before = self.version()
        manifest = self.manifest(before)
        if source is not None and number <= manifest["batches"].get(source, -1):
            return before
        own = fold(rows)
        kept = {bucket: manifest["folders"].get(bucket, []) + writes for bucket, writes in self._write(own).items()}
        manifest = manifest | {"schema": manifest["schema"] or own.schema.jsonValue()}
        crowded = [bucket for bucket, writes in kept.items() if len(writes) > MOST_FOLDERS]
        if crowded:
            kept |= self._write(fold(self._rows({**manifest, "folders": kept}, crowded)))
        return self._commit(before, manifest, kept, source, number)

    def folded(self, fold: Callable[[DataFrame], DataFrame], version: int | None = None) -> DataFrame:
        return fold(self.read(version))

    def update(self, updates: DataFrame, change: Callable[[DataFrame, DataFrame], DataFrame], source: str | None = None, number: int = 0) -> int:
        """Rewrite the buckets of the updates' keys as ``change(stored rows, updates)`` has them.

        ``updates`` has the key columns. ``change`` gets the rows of those buckets
        and returns what they hold from now on, one row per key.
        """
        before = self.version()
        manifest = self.manifest(before)
        if source is not None and number <= manifest["batches"].get(source, -1):
            return before
        keyed = updates.where(self._keyed())
        if manifest["schema"] is None:
            raise ValueError("the store is empty; insert rows first")
        buckets = self._buckets_of(keyed)
        if not buckets:
            return self._commit(before, manifest, {}, source, number) if source is not None else before
        changed = change(self._rows(manifest, buckets), keyed)
        written = self._write(changed.select(*self._rows(manifest, buckets).columns))
        return self._commit(before, manifest, {bucket: written.get(bucket, []) for bucket in buckets}, source, number)

    def _keyed(self) -> Column:
        known = F.lit(True)
        for key in self.keys:
            known = known & F.col(key).isNotNull()
        return known

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _buckets_of(self, rows: DataFrame) -> list[int]:
        """Which buckets rows fall into: at most as many numbers as there are buckets."""
        return sorted(row[0] for row in rows.select(self._bucket()).distinct().collect())

    def _absent(self, batch: DataFrame, stored: DataFrame) -> DataFrame:
        """Rows of the batch whose key is not stored.

        Where the batch's keys fit ``BROADCAST_BYTES`` they go to the stored rows,
        which are read for their keys and not shuffled; what they meet is at most
        as many keys again. Larger batches meet the stored keys in a sorted join.
        """
        keys = batch.select(*self.keys)
        width = sum((F.coalesce(F.octet_length(F.col(k).cast("string")), F.lit(0)) + 16 for k in self.keys), F.lit(0))
        size = keys.agg(F.sum(width)).first()[0] or 0
        have = stored.select(*self.keys)
        if size <= BROADCAST_BYTES:
            met = have.join(F.broadcast(keys), self.keys, "left_semi")
            return batch.select(*stored.columns).join(F.broadcast(met), self.keys, "left_anti").select(*stored.columns)
        return absent_from(batch, have, self.keys).select(*stored.columns)

    def _write(self, rows: DataFrame) -> dict[int, list[str]]:
        """Write rows to a folder of their own, one folder per bucket in it; says which buckets it has."""
        name = uuid.uuid4().hex
        path = f"{self.root}/data/{name}"
        # By bucket and by key: a bucket that gets very many rows is written by several tasks.
        spread = rows.withColumn("bucket", self._bucket()).repartition("bucket", F.pmod(F.hash(*self.keys), F.lit(8)))
        spread.write.partitionBy("bucket").parquet(path)
        system, folder = self._path(f"data/{name}")
        names = [entry.getPath().getName() for entry in system.listStatus(folder)]
        return {int(part.removeprefix("bucket=")): [name] for part in names if part.startswith("bucket=")}

    def _commit(self, before: int, manifest: dict, changed: dict[int, list[str]], source: str | None, number: int, schema=None) -> int:
        folders = {bucket: writes for bucket, writes in (manifest["folders"] | changed).items() if writes}
        batches = manifest["batches"] | ({source: number} if source is not None else {})
        kind = manifest["schema"] or schema.jsonValue()
        line = json.dumps({"keys": self.keys, "buckets": self.buckets, "schema": kind, "folders": folders, "batches": batches})
        system, target = self._path(f"manifests/{before + 1:08d}")
        _, draft = self._path(f"manifests/.{uuid.uuid4().hex}")
        stream = system.create(draft)
        stream.write(line.encode())
        stream.close()
        # Not every file system refuses to rename onto a file, so that is asked first.
        if system.exists(target) or not system.rename(draft, target):
            system.delete(draft, False)
            raise VersionConflict(f"version {before + 1} of {self.root} is there already")
        return before + 1

    def drop_unused(self, keep: int = 1) -> list[str]:
        """Remove folders that none of the last ``keep`` versions reads, and older manifests. Only while no job writes."""
        newest = self.version()
        used = set()
        for version in range(max(1, newest - keep + 1), newest + 1):
            used |= {write for writes in self.manifest(version)["folders"].values() for write in writes}
        gone = []
        system, folder = self._path("incoming")
        system.delete(folder, True)
        _, folder = self._path("data")
        if system.exists(folder):
            for entry in system.listStatus(folder):
                if entry.getPath().getName() not in used:
                    gone.append(entry.getPath().getName())
                    system.delete(entry.getPath(), True)
        for version in range(1, newest - keep + 1):
            system.delete(self._path(f"manifests/{version:08d}")[1], False)
        return gone

    def _path(self, name: str):
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), path


def set_column(column: str, key: str) -> Callable[[DataFrame, DataFrame], DataFrame]:
    """A change that sets a column where the update has a value; other rows, and updates of unknown keys, change nothing."""

    def change(stored: DataFrame, updates: DataFrame) -> DataFrame:
        new = updates.select(key, F.col(column).alias("_new"))
        return stored.join(new, key, "left").withColumn(column, F.coalesce("_new", column)).drop("_new")

    return change


def set_map_entry(column: str, key: str, entry: str, value: str) -> Callable[[DataFrame, DataFrame], DataFrame]:
    """A change that sets one entry of a map column where the update has a value."""

    def change(stored: DataFrame, updates: DataFrame) -> DataFrame:
        kind = stored.schema[column].dataType.simpleString()
        new = updates.select(key, F.col(value).alias("_new"))
        others = F.map_filter(F.coalesce(F.col(column), F.expr(f"cast(map() as {kind})")), lambda name, _: name != F.lit(entry))
        changed = F.map_concat(others, F.create_map(F.lit(entry), F.col("_new")))
        return stored.join(new, key, "left").withColumn(column, F.when(F.col("_new").isNotNull(), changed).otherwise(F.col(column))).drop("_new")

    return change


def sets(pairs: DataFrame, key: str, element: str, array: str) -> DataFrame:
    """Pairs of a store whose keys are (key, element), as one row per key with a sorted array.

    The store holds rows, so a key may gain elements without its others being
    read or written; only this output has arrays.
    """
    return pairs.groupBy(key).agg(F.sort_array(F.collect_list(element)).alias(array))
