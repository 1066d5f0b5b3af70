"""Tables, staged results and Arrow helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from atlaslens.session import work_dir

# Fixed value: what separates words.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = r"[\x20\x09-\x0D]+"

# Texts are worked on in blocks of about this many bytes, so that memory does not depend on the batch.
BLOCK_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Shuffle files go at the end of the query that made them, and not only when the driver collects its garbage.
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a result to the shared work folder and read it back.

    It is worked out once, and a lost executor costs no more than reading a
    file again. The folder goes when the driver's JVM ends, or with ``release``.
    """
    spark = df.sparkSession
    path = work_dir(spark, name)
    before = spark.conf.get(_CLEAN, None)
    spark.conf.set(_CLEAN, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(_CLEAN) if before is None else spark.conf.set(_CLEAN, before)
    system, target = _file_system(spark, path)
    system.deleteOnExit(target)
    staged = spark.read.schema(df.schema).parquet(path)
    staged.staged_at = path
    return staged


def release(*staged: DataFrame) -> None:
    """Remove staged results that nothing returned to a caller is built on."""
    for df in staged:
        system, target = _file_system(df.sparkSession, df.staged_at)
        system.delete(target, True)


def _file_system(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def columns_of(docs: DataFrame, inside: str = "") -> dict[str, Column]:
    """Every column by name, whatever signs the name has; ``inside`` names the struct that holds them."""
    return {name: F.col(inside + "`" + name.replace("`", "``") + "`") for name in docs.columns}


def as_row(docs: DataFrame) -> Column:
    """A row as one column, so that no name of its columns meets a name of the work done around it."""
    return F.struct(*(column.alias(name) for name, column in columns_of(docs).items()))


def pick_rows(docs: DataFrame, picked: DataFrame, mark: Column) -> DataFrame:
    """Rows of ``docs`` whose doc_id and mark (a number worked out from the row) are picked, once each.

    ``picked`` has doc_id, mark, copies (how many such rows there are) and what
    else the result is to carry. Returns the row of ``docs`` as the column
    ``row``, and copies and the rest as they are; names of ``docs`` may be any.
    Null doc_ids are equal. Rows without copies are joined as they are; only
    those with copies are folded, before their texts travel far.
    """
    marked = docs.select(as_row(docs).alias("row"), F.col("doc_id").alias("own_id"), mark.alias("own_mark"))
    same = F.col("own_id").eqNullSafe(F.col("doc_id")) & (F.col("own_mark") == F.col("mark"))
    single, several = picked.where("copies = 1"), picked.where("copies > 1")
    folded = marked.join(several.select("doc_id", "mark"), same, "left_semi").dropDuplicates(["own_id", "own_mark"])
    return marked.join(single, same).unionByName(folded.join(several, same)).drop("own_id", "own_mark", "doc_id", "mark")


def n_words(text: Column) -> Column:
    """How many words a text has; a null text has none."""
    found = F.regexp_count(text, F.lit(WORD))
    return F.coalesce(found, F.lit(0)).cast("long")


def text_blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Blocks of whole texts as bytes: (index of the first text, bytes, where each text starts and the last ends).

    A null text is empty. A text longer than the limit is a block of its own.
    """
    column = column.cast(pa.large_string()).fill_null("")
    count = len(column)
    if not count:
        return
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + count + 1]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    first = 0
    while first < count:
        last = max(first + 1, int(np.searchsorted(at, at[first] + limit, side="right")) - 1)
        yield first, whole[at[first] : at[last]], at[first : last + 1] - at[first]
        first = last
