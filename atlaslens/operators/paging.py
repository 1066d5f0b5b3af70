"""Which captured pages count, where a run stops and where the next one resumes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from atlaslens import config

PAGE_KEY = ("place_id", "language")


def page_outcome(content: Column, n_rows: Column, marker: str = config.BLOCKED_MARKER) -> Column:
    """EMPTY, OK, BLOCKED or NO_ROWS.

    The length gate goes first; the marker only counts on a page without rows.
    """
    return (
        F.when(F.coalesce(F.length(content) <= config.MIN_PAGE_CHARS, F.lit(True)), "EMPTY")
        .when(n_rows > 0, "OK")
        .when(F.contains(content, F.lit(marker)), "BLOCKED")
        .otherwise("NO_ROWS")
    )


def route(outcome: Column) -> Column:
    """Where a request goes next: done, tried again, or stopped for good."""
    return (
        F.when(outcome == "OK", "ok").when(outcome == "BLOCKED", "abort").otherwise("retry")
    )


def last_scraped_day(last_scraped: Column) -> Column:
    """The day of the last scrape, or a day before any review."""
    return F.coalesce(F.to_date(last_scraped), F.to_date(F.lit(config.NEVER_SCRAPED)))


def page_age_range(reviews: DataFrame, keys: Sequence[str] = PAGE_KEY, extra: Sequence[Column] = ()) -> DataFrame:
    """One row per page: number of reviews, newest and oldest review date, and extra aggregates."""
    return reviews.groupBy(*keys, "page_number").agg(
        F.count(F.lit(1)).alias("n_reviews"),
        F.max("review_date").alias("newest"),
        F.min("review_date").alias("oldest"),
        *extra,
    )


def is_stop(
    next_page_token: Column, newest: Column, oldest: Column, last_scraped: Column, as_of: Column,
    max_age_days: int = config.MAX_REVIEW_AGE_DAYS,
) -> Column:
    """Whether paging ends with this page: last page, nothing new, or reviews too old.

    ``as_of`` is a timestamp; the age limit is strict and counts hours, not days.
    """
    too_old = oldest.cast("timestamp") < as_of - F.expr(f"interval '{max_age_days}' day")
    return (
        next_page_token.isNull()
        | F.coalesce(newest < last_scraped, F.lit(False))
        | F.coalesce(too_old, F.lit(False))
    )


def take_until_stop(pages: DataFrame, keys: Sequence[str] = PAGE_KEY) -> DataFrame:
    """Pages up to and including the first stopping page of their key.

    The first stop is a minimum per key, found before the shuffle in each task; a key
    may have any number of pages.
    """
    stops = pages.where("is_stop").groupBy(*(F.col(k).alias(f"_{k}") for k in keys)).agg(F.min("page_number").alias("_first_stop"))
    same = None
    for k in keys:
        each = F.col(k).eqNullSafe(F.col(f"_{k}"))
        same = each if same is None else same & each
    return (
        pages.join(stops, same, "left")
        .where(F.col("_first_stop").isNull() | (F.col("page_number") <= F.col("_first_stop")))
        .select(*pages.columns)
    )


def page_budget(
    pages: DataFrame, keys: Sequence[str] = PAGE_KEY, max_pages: int = config.MAX_PAGES,
    pages_per_run: int = config.PAGES_PER_RUN,
) -> DataFrame:
    """Drop pages beyond the page limit and number the runs that store the others.

    Expects one row per key and page, so after the limit a window holds at most
    ``max_pages`` rows.
    """
    in_order = Window.partitionBy(*keys).orderBy("page_number")
    return (
        pages.where(F.col("page_number") < max_pages)
        .withColumn("_position", F.row_number().over(in_order))
        .withColumn("run_id", F.floor((F.col("_position") - 1) / F.lit(pages_per_run)).cast("int"))
        .drop("_position")
    )


def token_chain(pages: DataFrame, keys: Sequence[str] = PAGE_KEY, stored: Column | None = None) -> DataFrame:
    """Add the token each page was asked for with, and whether the chain is broken.

    A page that was not ``stored`` keeps its row, but no later page takes a token from it.

    The token is that of the previous page number, '' for page 0. It is found by an
    equality join on the page number, which spreads a key with many pages over all
    tasks; a window per key would not.
    """
    previous = (pages if stored is None else pages.where(stored)).select(
        *keys, (F.col("page_number") + 1).alias("page_number"),
        F.col("next_page_token").alias("_token"), F.lit(True).alias("_found"),
    )
    found = F.coalesce(F.col("_found"), F.lit(False))
    return (
        pages.join(previous, [*keys, "page_number"], "left")
        .withColumn("request_token", F.when(F.col("page_number") == 0, F.lit("")).otherwise(F.col("_token")))
        .withColumn("chain_broken", (F.col("page_number") > 0) & ~found)
        .drop("_token", "_found")
    )


def resume_points(requests: DataFrame, checkpoints: DataFrame, pages: DataFrame,
                  keys: Sequence[str] = PAGE_KEY) -> DataFrame:
    """Where each request starts: page number and token.

    ``checkpoints`` holds one row per stored page (page_number, set_at); the latest
    counts. No checkpoint or page 0 means page 0 is done (again). A stored page with
    a null token was the last one: the key is finished and gets no row. A checkpoint
    without a stored page resumes with an empty token.
    """
    last = checkpoints.groupBy(*keys).agg(
        F.max_by("page_number", F.struct("set_at", "page_number")).alias("page_number")
    )
    tokens = pages.select(*keys, "page_number", "next_page_token", F.lit(True).alias("_stored"))
    restart = F.coalesce(F.col("page_number"), F.lit(0)) == 0
    return (
        requests.join(last, list(keys), "left")
        .join(tokens, [*keys, "page_number"], "left")
        .where(restart | F.col("_stored").isNull() | F.col("next_page_token").isNotNull())
        .withColumn("start_page", F.when(restart, F.lit(0)).otherwise(F.col("page_number") + 1).cast("int"))
        .withColumn(
            "start_token",
            F.when(restart, F.lit("")).otherwise(F.coalesce(F.col("next_page_token"), F.lit(""))),
        )
        .drop("page_number", "next_page_token", "_stored")
    )
