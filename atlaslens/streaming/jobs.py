"""Streaming jobs: request intake, leases, page checkpoints, routing and staging.

Every job ends in an append-only file sink with its own checkpoint, so a restart
neither loses nor repeats rows. A job takes ``max_files`` as its intake bound.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from atlaslens.operators import paging, spans
from atlaslens.operators.keyed_store import KeyedStore
from atlaslens.sources.requests import check_requests, decode_body


def file_stream(spark: SparkSession, path: str, schema: str, max_files: int | None = None,
                file_format: str = "parquet", **options: str) -> DataFrame:
    """Files that arrive below a path (or glob) as a stream, a bounded number per batch."""
    reader = spark.readStream.format(file_format).schema(schema).options(**options)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def start(stream: DataFrame, out: str, partition_by: tuple[str, ...] = (), available_now: bool = True) -> StreamingQuery:
    """Start writing a stream to ``out/data``, with the checkpoint in ``out/checkpoint``."""
    writer = (
        stream.writeStream.format("parquet").outputMode("append").partitionBy(*partition_by)
        .option("path", f"{out}/data").option("checkpointLocation", f"{out}/checkpoint")
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def run(stream: DataFrame, out: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Process all that has arrived and read back what was written."""
    spark = stream.sparkSession
    start(stream, out, partition_by).awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{out}/data")


def insert_into(stream: DataFrame, store: KeyedStore, out: str, source: str, *order: Column) -> None:
    """Insert all that has arrived into a store, exactly once.

    The store's manifest names the last batch it has of ``source``, in the same
    rename that makes the batch's rows visible. A batch that failed before leaves
    nothing; one whose checkpoint was lost after is delivered again and left out.
    """
    def write(batch: DataFrame, number: int) -> None:
        store.insert(batch, *order, source=source, number=number)

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True)
    writer.start().awaitTermination()


def fold_into(stream: DataFrame, store: KeyedStore, out: str, source: str, fold: Callable[[DataFrame], DataFrame]) -> None:
    """Add all that has arrived to a store whose rows are folded per key, each batch exactly once (see ``insert_into``).

    What is kept, and read later, is in proportion to the keys and not to the batches.
    """
    def write(batch: DataFrame, number: int) -> None:
        store.add(batch, fold, source, number)

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True)
    writer.start().awaitTermination()


def run_slices(stream: DataFrame, out: str, keys: list[str], at_us: str, ttl_s: int, *latest: str) -> DataFrame:
    """Spans in which a key stayed set, from all files that have arrived so far, whatever their order.

    Each batch folds its sets to slices (``spans.span_slices``) and adds them to a
    store of slices below ``out``. Slices merge in any order: no watermark is needed
    and no set is ever late. Without any file there are no spans.
    """
    spark = stream.sparkSession
    store = KeyedStore(spark, f"{out}/slices", [*keys, "_slice"], buckets=16)
    schema = spans.span_slices(spark.createDataFrame([], stream.schema), keys, at_us, ttl_s, *latest).schema

    def fold(rows: DataFrame) -> DataFrame:
        return spans.merge_slices(rows, keys) if "_slice" in rows.columns else spans.span_slices(rows, keys, at_us, ttl_s, *latest)

    fold_into(stream, store, out, "slices", fold)
    slices = store.read() if store.version() else spark.createDataFrame([], schema)
    return spans.spans_of_slices(slices, keys, at_us, ttl_s, *latest)


def run_live_keys(stream: DataFrame, out: str, as_of: Column, *value: str) -> DataFrame:
    """Keys that are still set at ``as_of``, from all sets and deletes that have arrived, in any order and with any ttl.

    ``stream`` has key, set_at (microseconds), ttl_s (null for a delete) and the value
    columns. The state below ``out`` has one row per key.
    """
    spark = stream.sparkSession
    store = KeyedStore(spark, f"{out}/keys", ["key"], buckets=16)
    fold = lambda rows: spans.latest_writes(rows, *value)
    fold_into(stream, store, out, "keys", fold)
    state = store.folded(fold) if store.version() else spark.createDataFrame([], stream.select("key", "set_at", "ttl_s", *value).schema)
    return spans.live_keys(state, as_of).join(state.select("key", *value), "key")


class PageRefused(RuntimeError):
    """A site refused a page; all pages of its batch are in their folders."""


def route_pages(routed: DataFrame, out: str) -> DataFrame:
    """Write pages (see ``routed_pages``) to a folder per route, then fail if one asks for an abort.

    One batch function serves the three folders. It raises only after all rows of its
    batch are written. When the job is started again the batch is delivered once more,
    found complete and passed over, so it neither repeats rows nor fails again.
    """
    spark = routed.sparkSession

    def write(batch: DataFrame, number: int) -> None:
        path = f"{out}/data/batch={number}"
        done = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
        if done.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(done):
            return
        batch.write.mode("overwrite").partitionBy("route").parquet(path)
        raise_on_abort(spark.read.schema(batch.schema).parquet(path))

    writer = routed.writeStream.foreachBatch(write).option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True)
    writer.start().awaitTermination()
    return written_pages(spark, out, routed.schema)


def written_pages(spark: SparkSession, out: str, schema: StructType) -> DataFrame:
    """All pages that ``route_pages`` has written, also those of a run that failed after."""
    return spark.read.schema(schema).option("basePath", f"{out}/data").parquet(f"{out}/data/batch=*").select(*schema.names)


def checked_requests(messages: DataFrame, body: str = "body") -> DataFrame:
    """Request messages in bytes, decoded and checked against the contract."""
    return check_requests(messages.withColumn(body, decode_body(F.col(body))), body)


def alive_sessions(events: DataFrame, keys: list[str], at: str, ttl_s: int, *aggregates: Column, delay: str) -> DataFrame:
    """Spans in which a key stayed set, as session windows.

    A session closes where the next set comes ``ttl_s`` or more after the last one;
    the gap is a microsecond short of the ttl because Spark merges sessions that touch.
    Spans still open at the watermark are not emitted yet, and sets more than ``delay``
    behind the latest one seen are left out: this is for files that arrive in order. To
    catch up on a stored table use ``run_slices``, which loses nothing. Sessions are merged within
    a task before the shuffle (see ``session.RUNTIME_SETTINGS``), so a hot key does not
    send its single rows.
    """
    gap = f"{ttl_s - 1}.999999 seconds"
    return (
        events.withWatermark(at, delay)
        .groupBy(*keys, F.session_window(at, gap).alias("_session"))
        .agg(F.min(at).alias("span_start"), F.max(at).alias("last_set"), F.count(F.lit(1)).alias("n_sets"), *aggregates)
        .drop("_session")
    )


def routed_pages(pages: DataFrame, content: Column, n_rows: Column, **options) -> DataFrame:
    """Pages with their outcome and route; written by route, one sink serves ok, retry and abort."""
    return pages.withColumn("outcome", paging.page_outcome(content, n_rows, **options)).withColumn(
        "route", paging.route(F.col("outcome"))
    )


def raise_on_abort(routed: DataFrame) -> None:
    """Stop the run after its pages were written when one of them asks for it."""
    if not routed.where("route = 'abort'").isEmpty():
        raise PageRefused("a page was refused by its site; see the rows with route = 'abort'")
