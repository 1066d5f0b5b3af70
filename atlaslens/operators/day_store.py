"""Tables that grow by the day: appended by runs, read by days, and dropped by days unread."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


class DayStore:
    """A Parquet folder partitioned by a day column and by the run that wrote it.

    A run that is repeated replaces what it wrote before and touches nothing else,
    so a failed one is simply run again.
    """

    def __init__(self, spark: SparkSession, root: str, day: str, schema: StructType):
        self.spark, self.root, self.day = spark, root.rstrip("/"), day
        self.schema = schema if "run" in schema.names else StructType([*schema.fields]).add("run", "string")

    def append(self, rows: DataFrame, run: str) -> None:
        """Add the rows of a run. A row without a day goes to a partition of its own, which no day filter reads."""
        names = [name for name in self.schema.names if name not in (self.day, "run")]
        (
            rows.select(*names, self.day, F.lit(run).alias("run")).write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic").partitionBy(self.day, "run").parquet(self.root)
        )

    def read(self, since: dt.date | None = None, until: dt.date | None = None) -> DataFrame:
        """Rows from a day on and up to a day; folders of other days are not listed for reading."""
        system, folder = self._path(self.root)
        if not system.exists(folder):
            return self.spark.createDataFrame([], self.schema)
        found = self.spark.read.schema(self.schema).parquet(self.root)
        if since is not None:
            found = found.where(F.col(self.day) >= F.lit(since))
        if until is not None:
            found = found.where(F.col(self.day) <= F.lit(until))
        return found

    def days(self) -> list[str]:
        """The days there are, from the names of the folders."""
        system, folder = self._path(self.root)
        if not system.exists(folder):
            return []
        prefix = f"{self.day}="
        names = [entry.getPath().getName() for entry in system.listStatus(folder)]
        return sorted(name.removeprefix(prefix) for name in names if name.startswith(prefix) and name[len(prefix) :][:1].isdigit())

    def drop_expired(self, as_of: dt.datetime, ttl_s: int) -> list[str]:
        """Remove the days whose last moment is past retention at ``as_of``, without reading them."""
        limit = as_of - dt.timedelta(seconds=ttl_s)
        gone = [day for day in self.days() if dt.datetime.fromisoformat(day) + dt.timedelta(days=1) <= limit]
        for day in gone:
            system, folder = self._path(f"{self.root}/{self.day}={day}")
            system.delete(folder, True)
        return gone

    def _path(self, path: str):
        target = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), target
