"""Page checks, stopping, budgets and resuming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from atlaslens.operators import paging, stores
from atlaslens.plans import tables
from atlaslens.plans.registry import query

# A line many documents share stands for the text of a refused page.
MARKER = "Licensed under the Apache License, Version 2.0."
LONG_LINE = 400

PAGE_QUALITY_SQL = f"""
    WITH counted AS (
        SELECT doc_id, text, length(text) AS n_chars,
               len(list_filter(string_split(text, chr(10)), lambda line: length(line) > {LONG_LINE})) AS n_rows
        FROM documents
    ), judged AS (
        SELECT doc_id, n_chars, CAST(n_rows AS INTEGER) AS n_rows,
               CASE WHEN n_chars <= 100 THEN 'EMPTY' WHEN n_rows > 0 THEN 'OK'
                    WHEN contains(text, '{MARKER}') THEN 'BLOCKED' ELSE 'NO_ROWS' END AS outcome
        FROM counted
    )"""


def long_lines(text: str = "text"):
    """How many rows a document yields: its long lines."""
    return F.size(F.filter(F.split(text, "\n"), lambda line: F.length(line) > LONG_LINE))


def judged(documents: DataFrame) -> DataFrame:
    counted = documents.withColumn("n_rows", long_lines())
    return counted.withColumn("outcome", paging.page_outcome(F.col("text"), F.col("n_rows"), MARKER))


@query("page_quality", PAGE_QUALITY_SQL + """
    SELECT doc_id, n_rows, outcome,
           CASE outcome WHEN 'OK' THEN 'ok' WHEN 'BLOCKED' THEN 'abort' ELSE 'retry' END AS route FROM judged""")
def page_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcome of each captured page and where its request goes."""
    return judged(tables.table(spark, sf_dir, "documents")).select(
        "doc_id", "n_rows", "outcome", paging.route(F.col("outcome")).alias("route")
    )


@query("quarantine", PAGE_QUALITY_SQL + """
    SELECT doc_id, outcome, n_chars FROM judged WHERE outcome <> 'OK'""")
def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages set aside because no rows came out of them."""
    rejected = stores.quarantined(judged(tables.table(spark, sf_dir, "documents")))
    return rejected.select("doc_id", "outcome", F.length("text").cast("long").alias("n_chars"))


REVIEW_DAYS_SQL = """
    reviews AS (
        SELECT user_id AS place_id, CASE WHEN event_type IN ('click', 'view') THEN 'en' ELSE 'es' END AS language,
               CAST(floor(((SELECT CAST(max(ts) AS DATE) FROM events) - CAST(ts AS DATE)) / 3.0) AS INTEGER) AS page_number,
               CAST(ts AS DATE) AS review_date, value
        FROM events
    )"""


@query("takewhile_stop", f"""
    WITH {REVIEW_DAYS_SQL},
    now AS (SELECT max(ts) AS t FROM events),
    requests AS (SELECT user_id AS place_id, CAST(min(ts) AS DATE) AS last_scraped FROM events
                 WHERE event_type = 'signup' GROUP BY 1),
    pages AS (SELECT place_id, language, page_number, count(*) AS n_reviews, max(review_date) AS newest,
                     min(review_date) AS oldest, max(value) AS top FROM reviews GROUP BY 1, 2, 3),
    judged AS (
        SELECT p.*, (top > 150 OR newest < coalesce(last_scraped, DATE '2015-01-01')
                     OR CAST(oldest AS TIMESTAMP) < (SELECT t FROM now) - INTERVAL 24 DAY) AS is_stop
        FROM pages p LEFT JOIN requests USING (place_id)
    ), looked AS (
        SELECT *, max(CAST(is_stop AS INTEGER)) OVER (
            PARTITION BY place_id, language ORDER BY page_number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS stopped
        FROM judged
    )
    SELECT place_id, language, page_number, n_reviews, strftime(newest, '%Y-%m-%d') AS newest,
           strftime(oldest, '%Y-%m-%d') AS oldest, is_stop
    FROM looked WHERE coalesce(stopped, 0) = 0""")
def takewhile_stop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages up to and including the first that ends the paging of its place and language."""
    source = tables.table(spark, sf_dir, "events")
    now = tables.latest(source, "ts").cast("timestamp")
    requests = source.where("event_type = 'signup'").groupBy(F.col("user_id").alias("place_id")).agg(
        F.to_date(F.min("ts")).alias("last_scraped")
    )
    reviews = tables.review_days(spark, sf_dir)
    pages = paging.page_age_range(reviews, extra=[F.max("value").alias("top")])
    token = F.when(F.col("top") <= 150, F.lit("more"))
    marked = pages.join(requests, "place_id", "left").withColumn(
        "is_stop",
        paging.is_stop(token, F.col("newest"), F.col("oldest"), paging.last_scraped_day(F.col("last_scraped")), now, 24),
    )
    return paging.take_until_stop(marked).select(
        "place_id", "language", "page_number", "n_reviews",
        tables.day_text("newest").alias("newest"), tables.day_text("oldest").alias("oldest"), "is_stop",
    )


@query("page_budget", """
    WITH pages AS (
        SELECT DISTINCT user_id AS place_id,
               CAST(((SELECT max(epoch_us(ts)) FROM events) - epoch_us(ts)) // 3600000000 AS INTEGER) AS page_number
        FROM events
    )
    SELECT place_id, page_number,
           CAST((row_number() OVER (PARTITION BY place_id ORDER BY page_number) - 1) // 12 AS INTEGER) AS run_id
    FROM pages WHERE page_number < 200""")
def page_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages within the limit, with the run that stores each; a page is one hour of a user."""
    source = tables.events(spark, sf_dir)
    hours_back = F.floor((tables.latest(source, "at_us") - F.col("at_us")) / 3_600_000_000).cast("int")
    pages = source.select(F.col("user_id").alias("place_id"), hours_back.alias("page_number")).distinct()
    return paging.page_budget(pages, ["place_id"])


CONVERSATION_PAGES_SQL = """
    pages AS (
        SELECT conv_id, CAST(turn AS INTEGER) AS page_number, role, text,
               CASE WHEN length(text) > 100 THEN substr(sha256(text), 1, 12) || '==' END AS next_page_token
        FROM conversations
    )"""


@query("resume_point", f"""
    WITH {CONVERSATION_PAGES_SQL},
    requests AS (SELECT DISTINCT conv_id FROM pages),
    last AS (SELECT conv_id, max(page_number) AS last_page FROM pages WHERE role = 'assistant' GROUP BY 1)
    SELECT r.conv_id,
           CASE WHEN coalesce(last_page, 0) = 0 THEN 0 ELSE last_page + 1 END AS start_page,
           CASE WHEN coalesce(last_page, 0) = 0 THEN '' ELSE p.next_page_token END AS start_token
    FROM requests r LEFT JOIN last l USING (conv_id)
    LEFT JOIN pages p ON p.conv_id = r.conv_id AND p.page_number = l.last_page
    WHERE coalesce(last_page, 0) = 0 OR p.next_page_token IS NOT NULL""")
def resume_point(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each conversation goes on after its last answered turn."""
    pages = tables.conversation_pages(spark, sf_dir)
    done = pages.where("role = 'assistant'").select("conv_id", "page_number", F.col("page_number").alias("set_at"))
    return paging.resume_points(pages.select("conv_id").distinct(), done, pages, ["conv_id"])


@query("token_chain", f"""
    WITH {CONVERSATION_PAGES_SQL},
    stored AS (SELECT * FROM pages WHERE length(text) >= 80)
    SELECT s.conv_id, s.page_number,
           CASE WHEN s.page_number = 0 THEN '' ELSE coalesce(p.next_page_token, '') END AS request_token,
           s.page_number > 0 AND p.conv_id IS NULL AS chain_broken, length(s.text) >= 80 AS stored
    FROM pages s LEFT JOIN stored p ON p.conv_id = s.conv_id AND p.page_number = s.page_number - 1""")
def token_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The token each page was asked for with; pages too short to be stored break the chain."""
    pages = tables.conversation_pages(spark, sf_dir).withColumn("stored", F.length("text") >= 80)
    chained = paging.token_chain(pages.select("conv_id", "page_number", "next_page_token", "stored"), ["conv_id"], F.col("stored"))
    return chained.select(
        "conv_id", "page_number", F.coalesce("request_token", F.lit("")).alias("request_token"), "chain_broken", "stored"
    )
