"""Sharding by extendible hashing.

The directory is indexed by the leading bits of a document's hash. Only a
bucket over the byte limit is split, on the next bit. Instead of splitting one
bucket after another, the bytes of all cells of the next 16 bits are summed in
one aggregation, and every cell takes the shortest prefix that fits; cells that
are still too large go on to the following 16 bits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from atlaslens.llm.common import stage

LIMIT = 1 << 20
STEP = 16  # bits to a round; four hexadecimal digits
ROUNDS = 14


def _bits(hexadecimal: Column) -> Column:
    return F.array_join(F.transform(F.split(hexadecimal, ""), lambda d: F.when(d == "", F.lit("")).otherwise(F.lpad(F.conv(d, 16, 2), 4, "0"))), "")


def shard(docs: DataFrame, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, shard (its bits), depth, shard_bytes and shard_documents per document.

    ``docs`` has doc_id and text. No shard exceeds the limit unless it is one
    document that does by itself. Null texts have no bytes. A document's bits
    come from its doc_id; repeated doc_ids, null ones too, share 60 bits and
    are told apart by 164 more from the row and its number among equal rows,
    so a doc_id that a third of all rows have is split as well. An empty table
    gives no shards.
    """
    rows = docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), F.xxhash64("text").alias("mark"))
    folded = rows.groupBy("doc_id", "n_bytes", "mark").agg(F.count("*").alias("copies"))
    each = folded.withColumn("copy", F.explode(F.expr("sequence(1L, copies)")))
    own = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    more = F.sha2(F.concat_ws(":", own, "mark", "copy"), 256)
    open_rows = stage(each.select("doc_id", "n_bytes", F.concat(F.substring(F.md5(own), 1, 15), F.substring(more, 1, 41)).alias("code")), "shard-rows")
    done = None
    for number in range(ROUNDS):
        prefix, cell = F.substring("code", 1, 4 * number), F.conv(F.substring("code", 4 * number + 1, 4), 16, 10).cast("int")
        keyed = open_rows.withColumn("prefix", prefix).withColumn("cell", cell)
        cells = stage(keyed.groupBy("prefix", "cell").agg(F.sum("n_bytes").alias("b"), F.count("*").alias("n")), "shard-cells")
        # Every cell and all its ancestors, from no bit of this round to all of them.
        depths = cells.withColumn("depth", F.explode(F.sequence(F.lit(0), F.lit(STEP))))
        depths = depths.withColumn("above", F.floor(F.col("cell") / F.pow(F.lit(2.0), STEP - F.col("depth"))).cast("int"))
        sums = depths.groupBy("prefix", "depth", "above").agg(F.sum("b").alias("bytes"), F.sum("n").alias("documents"))
        fits = sums.where((F.col("bytes") <= limit) | (F.col("documents") == 1))
        chosen = depths.join(fits, ["prefix", "depth", "above"]).groupBy("prefix", "cell").agg(
            F.min(F.struct("depth", "above", "bytes", "documents")).alias("c")
        )
        label = F.concat(_bits(F.col("prefix")), F.when(F.col("c.depth") > 0, F.lpad(F.bin(F.col("c.above")), F.col("c.depth"), F.lit("0"))).otherwise(F.lit("")))
        directory = stage(chosen.select(
            "prefix", "cell", label.alias("shard"), (F.col("c.depth") + STEP * number).alias("depth"),
            F.col("c.bytes").alias("shard_bytes"), F.col("c.documents").alias("shard_documents"),
        ), "shard-directory")
        settled = keyed.join(directory, ["prefix", "cell"]).select("doc_id", "n_bytes", "shard", "depth", "shard_bytes", "shard_documents")
        done = settled if done is None else done.unionByName(settled)
        rest = keyed.join(directory, ["prefix", "cell"], "left_anti").select("doc_id", "n_bytes", "code")
        open_rows = stage(rest, "shard-open")
        if open_rows.isEmpty():
            break
    return done
