"""Mixing sources to target weights by Sainte-Laguë apportionment.

Words are laid out in blocks of equal size along the documents of a shard, in
seeded order. Sources get blocks by highest quotients of their targets, shards
get their source's blocks the same way, and a shard takes its first blocks.
Only column expressions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from atlaslens.llm.common import WORD, columns_of, n_words, pick_rows, stage

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST = 2
BLOCK_WORDS = 64
SHARD_WORDS = 65_536
# Larger sources get larger shards, so that neither a source's shards nor a shard's documents are too many for one task.
MAX_SHARDS = 4_096
SEED = "mix-1"


def apportion(parties: DataFrame, group: list[str], votes: str, seats: str, ties: list[str], out: str) -> DataFrame:
    """Sainte-Laguë: the seats of a group go to the highest quotients votes / (2k - 1), k-th seat of a party.

    Rounding the exact shares gives all but at most half as many seats as there
    are parties. The rest are given (or taken back) one by one by quotient; a
    party can be moved by at most n/2 times its share plus one seats, so only so
    many quotients per party are looked at. ``ties`` settles equal quotients.
    """
    over = Window.partitionBy(*group)
    share = F.when(F.col("_sum") > 0, F.col(votes) / F.col("_sum")).otherwise(0.0)
    rounded = (
        parties.withColumn("_sum", F.sum(votes).over(over)).withColumn("_n", F.count(F.lit(1)).over(over))
        .withColumn("_base", F.floor(F.col(seats) * share + 0.5).cast("long"))
        .withColumn("_short", F.when(F.col("_sum") > 0, F.col(seats) - F.sum("_base").over(over)).otherwise(0))
        .withColumn("_reach", (F.ceil(F.col("_n") * share / 2) + 1).cast("int"))
    )
    step = F.when(F.col("_short") > 0, F.sequence(F.lit(1), F.col("_reach"))).when(
        F.col("_short") < 0, F.sequence(F.lit(1), F.least(F.col("_reach").cast("long"), F.col("_base")).cast("int"))
    )
    seat = F.when(F.col("_short") > 0, F.col("_base") + F.col("_step")).otherwise(F.col("_base") - F.col("_step") + 1)
    ranked = rounded.withColumn("_step", F.explode_outer(F.when(F.col("_base") + F.col("_short") >= 0, step)))
    quotient = F.when(F.col("_step").isNotNull(), F.col(votes) / (2 * seat - 1))
    signed = F.when(F.col("_short") > 0, -quotient).otherwise(quotient)
    order = Window.partitionBy(*group).orderBy(
        signed.asc_nulls_last(), *(F.when(F.col("_short") > 0, F.col(t)).asc_nulls_last() for t in ties), *(F.col(t).desc() for t in ties)
    )
    chosen = ranked.withColumn("_chosen", F.when(
        F.col("_step").isNotNull() & (F.row_number().over(order) <= F.abs("_short")), F.signum("_short")
    ).otherwise(0).cast("long"))
    columns = parties.columns
    return chosen.groupBy(*columns, "_base").agg(F.sum("_chosen").alias("_moved")).select(
        *columns, (F.col("_base") + F.col("_moved")).alias(out)
    )


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """Adds target to (key, source, source_size): by weight, at most ``most`` times the size, the excess shared anew.

    Sources reach their limits in the order of limit by weight. Taking the first
    k as full gives a common level for the rest; the true level is the highest
    of these, as any other choice of k counts some source for more than it gives.
    """
    everything = Window.partitionBy()
    position = F.row_number().over(everything.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*(F.lit(w) for w in weights)), (position % len(weights) + 1).cast("int"))
    limit = (F.col("source_size") * most).cast("double")
    order = everything.orderBy(F.col("_limit") / F.col("weight"), "key")
    earlier, later = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    level = (F.sum("source_size").over(everything) * share - F.coalesce(F.sum("_limit").over(earlier), F.lit(0.0))) / F.sum("weight").over(later)
    leveled = sizes.withColumn("weight", weight).withColumn("_limit", limit).withColumn("_level", level)
    target = F.least(F.col("weight") * F.max("_level").over(everything), F.col("_limit"))
    return leveled.withColumn("target", target).select(*sizes.columns, "weight", "target")


def source_key() -> Column:
    return F.when(F.col("source").isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col("source")))


def hash_number(*parts: Column) -> Column:
    """A number below 2**32 from the MD5 of some text, the same in any engine."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 8), 16, 10).cast("long")


def plan_mix(docs: DataFrame, block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS, seed: str = SEED, **targets) -> DataFrame:
    """How many words the mix takes of every document.

    ``docs`` has doc_id, source, text. Returns per group of equal rows doc_id,
    fingerprint, source, size (words), copies, source_size, target, and where
    it starts in its shard (``start``), with the shard's words and what it takes:
    copy number c takes ``taken_words(c)``. Null texts have size 0; null sources
    are a source of their own, the last. Empty tables give no rows.
    """
    rows = docs.select(
        "doc_id", "source", source_key().alias("key"), n_words(F.col("text")).alias("size"),
        F.xxhash64(*columns_of(docs).values()).alias("fingerprint"),
    )
    # Equal rows travel as one row with a count, so a row repeated a million times is no hot spot.
    folded = stage(rows.groupBy("doc_id", "source", "key", "size", "fingerprint").agg(F.count("*").alias("copies")), "mix-sizes")
    words = F.col("size") * F.col("copies")
    sizes = folded.groupBy("key", "source").agg(F.sum(words).alias("source_size"))
    targeted = source_targets(sizes, **targets)
    total = F.sum("target").over(Window.partitionBy())
    sources = apportion(
        targeted.withColumn("seats", F.round(total / block_words).cast("long")), [], "target", "seats", ["key"], "blocks"
    ).withColumn("shards", F.greatest(F.lit(1), F.least(F.lit(MAX_SHARDS), F.ceil(F.col("source_size") / shard_words))).cast("int"))
    sources = stage(sources.select("key", "source_size", "target", "blocks", "shards"), "mix-sources")

    number = hash_number(F.lit(seed), F.col("doc_id"))
    placed = stage(
        folded.join(sources, "key").withColumn("shard", (number % F.col("shards")).cast("int")), "mix-shards"
    )
    shards = placed.groupBy("key", "shard", "blocks").agg(F.sum(words).alias("shard_size"))
    quotas = apportion(shards, ["key"], "shard_size", "blocks", ["shard"], "quota").select(
        "key", "shard", "shard_size", F.least(F.col("quota") * block_words, F.col("shard_size") * 2).alias("shard_takes")
    )
    order = Window.partitionBy("key", "shard").orderBy(F.md5(F.concat_ws(":", F.lit(seed), F.lit("order"), F.col("doc_id"))), "doc_id", "fingerprint")
    start = F.sum(words).over(order.rowsBetween(Window.unboundedPreceding, 0)) - words
    return placed.withColumn("start", start).join(quotas, ["key", "shard"]).select(
        "doc_id", "fingerprint", "source", "size", "copies", "source_size", "target", "start", "shard_size", "shard_takes"
    )


def taken_words(copy: Column, lap: int) -> Column:
    """Words that lap 0 or 1 along the shard takes of a copy: those before the shard's last block ends."""
    left = F.col("shard_takes") - F.col("shard_size") * lap - F.col("start") - copy * F.col("size")
    return F.greatest(F.lit(0), F.least(F.col("size"), left)).cast("long")


def mixed_counts(plan: DataFrame) -> DataFrame:
    """One row per document: size, source_size, target, and taken with repeats counted."""
    each = plan.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
    return each.withColumn("taken", taken_words(F.col("copy"), 0) + taken_words(F.col("copy"), 1)).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


def mixed_documents(docs: DataFrame, plan: DataFrame) -> DataFrame:
    """The mix itself: a row for each time a document is taken, cut after its last taken word; columns as in ``docs``.

    ``n_chars``, if there, is the length of the text that is left.
    """
    per_copy = F.expr("sequence(0L, copies - 1)")
    laps = F.array_sort(F.flatten(F.transform(per_copy, lambda c: F.array(taken_words(c, 0), taken_words(c, 1)))))
    wanted = plan.select(
        "doc_id", F.col("fingerprint").alias("mark"), "copies", "size", F.filter(laps, lambda n: n > 0).alias("laps")
    ).where(F.size("laps") > 0)
    # Equal rows are one row of the plan, which says what all of them together give.
    taken = pick_rows(docs, wanted, F.xxhash64(*columns_of(docs).values())).withColumn("take", F.explode("laps"))
    columns, all_of_it = columns_of(docs, "row."), F.col("take") == F.col("size")
    part = F.array_join(F.slice(F.regexp_extract_all(columns["text"], F.lit(rf"[\x20\x09-\x0D]*{WORD}"), F.lit(0)), 1, F.col("take").cast("int")), "")
    out = taken.withColumn("new", F.when(all_of_it, columns["text"]).otherwise(part))
    columns["text"] = F.col("new")
    if "n_chars" in columns:
        columns["n_chars"] = F.when(all_of_it, columns["n_chars"]).otherwise(F.length("new").cast(docs.schema["n_chars"].dataType))
    return out.select(*(column.alias(name) for name, column in columns.items()))
