"""The three jobs as a whole: refreshing reviews, resolving identifiers, scanning an area."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from atlaslens import config
from atlaslens.functions import geo
from atlaslens.operators import paging, places as pl, resolve, reviews as rv, search, stores
from atlaslens.operators.keyed_store import KeyedStore
from atlaslens.sources import responses as rs

PAGE = [*paging.PAGE_KEY, "page_number"]


class RefreshRun(NamedTuple):
    """What a refresh found out."""

    reviews: DataFrame     # review rows to add to the store
    pages: DataFrame       # pages to keep, with is_stop
    quarantine: DataFrame  # pages that ended a run badly
    requests: DataFrame    # each request's status: done, retry, abort or waiting


def refresh_reviews(pages: DataFrame, requests: DataFrame, parsers: DataFrame, as_of: Column, folder: str,
                    max_age_days: int = config.MAX_REVIEW_AGE_DAYS, max_pages: int = config.MAX_PAGES) -> RefreshRun:
    """Parse the captured pages of all requests and decide which of them count.

    ``pages`` are page records, one per place, language and number; ``requests`` have
    place_id, language and last_scraped. A run takes pages in order up to the first
    stopping page, and breaks off before a page without reviews. Paging ends at
    ``max_pages`` pages; later ones are not looked at.

    The parsed lists are written to ``folder`` once, below the folder the cluster
    shares. Everything else reads them there: the HTML is not parsed again for each
    result, and a lost executor costs a read and no parsing.
    """
    rv.with_review_lists(pages, parsers).write.parquet(folder)
    lists = pages.sparkSession.read.parquet(folder)
    rows = rv.rows_from_lists(lists, F.to_date(as_of))
    found = lists.select("place_id", F.col("scrape_language").alias("language"), "page_number", "next_page_token", "n_rows", "outcome")
    judged = (
        found.join(paging.page_age_range(rows), PAGE, "left")
        .join(requests.select(*paging.PAGE_KEY, "last_scraped"), list(paging.PAGE_KEY))
        .withColumn("stops", paging.is_stop(
            F.col("next_page_token"), F.col("newest"), F.col("oldest"), paging.last_scraped_day(F.col("last_scraped")),
            as_of, max_age_days,
        ))
        .withColumn("is_stop", F.col("stops") | (F.col("outcome") != "OK"))
    )
    reached = paging.take_until_stop(judged.where(F.col("page_number") < max_pages))
    kept = reached.where("outcome = 'OK'")
    end = F.max_by(F.struct("page_number", "outcome", "stops"), "page_number").alias("end")
    last_page = F.col("end.page_number")
    status = (
        F.when(F.col("end").isNull(), "waiting")
        .when(F.col("end.outcome") != "OK", paging.route(F.col("end.outcome")))
        .when(F.col("end.stops") | (last_page == max_pages - 1), "done")
        .otherwise("waiting")
    )
    ends = reached.groupBy(*paging.PAGE_KEY).agg(end, F.count(F.when(F.col("outcome") == "OK", 1)).alias("n_pages"))
    return RefreshRun(
        reviews=rows.join(kept.select(*PAGE), PAGE, "left_semi"),
        pages=kept.select(*PAGE, "next_page_token", "n_reviews", "newest", "oldest", F.col("stops").alias("is_stop")),
        quarantine=stores.quarantined(reached).select(*PAGE, "outcome"),
        requests=requests.join(ends, list(paging.PAGE_KEY), "left").select(
            *paging.PAGE_KEY, status.alias("status"), last_page.alias("last_page"), F.coalesce("n_pages", F.lit(0)).alias("n_pages")
        ),
    )


class RunLedger:
    """What the runs of the refresh job know of each other: a row per request and the pages and reviews stored so far.

    The three tables lie side by side below ``root``. A run first stores its pages and reviews,
    each once however often a page is done again, and then moves its requests on, so a run that
    fails between is repeated without loss.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int = 16):
        self.requests = KeyedStore(spark, f"{root}/requests", paging.PAGE_KEY, buckets)
        self.pages = KeyedStore(spark, f"{root}/pages", PAGE, buckets)
        self.reviews = KeyedStore(spark, f"{root}/reviews", [*PAGE, "position"], buckets)

    def state(self) -> DataFrame | None:
        """The last known row of each request; None before the first run."""
        return self.requests.folded(latest_run) if self.requests.version() else None


def latest_run(rows: DataFrame) -> DataFrame:
    """Of each request, where its last run ended, and the last page that any run stored."""
    point = F.max_by(F.struct("page_number", "next_page_token", "set_at"), F.when(F.col("page_number").isNotNull(), F.struct("run", "page_number")))
    last = F.max_by(F.struct("run", "status", "last_page"), F.struct("run"))
    return rows.groupBy(*paging.PAGE_KEY).agg(last.alias("_last"), point.alias("_point")).select(*paging.PAGE_KEY, "_last.*", "_point.*")


def resume_reviews(pages: DataFrame, requests: DataFrame, parsers: DataFrame, as_of: Column, folder: str, ledger: RunLedger, run: int,
                   max_age_days: int = config.MAX_REVIEW_AGE_DAYS, max_pages: int = config.MAX_PAGES,
                   pages_per_run: int = config.PAGES_PER_RUN, checkpoint_ttl_s: int = config.PAGE_CHECKPOINT_TTL_S) -> None:
    """One run of the refresh job: every request that is not done goes on where its last run ended, for so many pages.

    A request starts at its resume point (``paging.resume_points``), or at page 0 if its
    checkpoint has run out at ``as_of``. Only the pages of this run are parsed. It is done at
    a stopping page or the page limit; otherwise it waits for the next run. A run number that
    the ledger has already is passed over. What the runs found is in the ledger's tables.
    """
    spark, state = pages.sparkSession, ledger.state()
    keys = list(paging.PAGE_KEY)
    if run <= ledger.requests.manifest()["batches"].get("run", -1):
        return
    if state is None:
        open_requests = requests.withColumns({"start_page": F.lit(0), "start_token": F.lit("")})
    else:
        left = F.col("set_at").cast("timestamp") + F.make_dt_interval(secs=F.lit(float(checkpoint_ttl_s))) > as_of
        points = state.where(left & F.col("page_number").isNotNull()).select(*keys, "page_number", "next_page_token", "set_at")
        finished = state.where("status = 'done'")
        open_requests = paging.resume_points(requests.join(finished.select(*keys), keys, "left_anti"), points.drop("next_page_token"), points.drop("set_at"))
    open_requests.write.parquet(f"{folder}/open")
    open_requests = spark.read.parquet(f"{folder}/open")
    first = open_requests.select("place_id", F.col("language").alias("scrape_language"), "start_page")
    turn = F.col("page_number").between(F.col("start_page"), F.col("start_page") + pages_per_run - 1)
    own = pages.where(F.col("page_number") < max_pages).join(first, ["place_id", "scrape_language"]).where(turn).drop("start_page")
    found = refresh_reviews(own, open_requests.drop("start_page", "start_token"), parsers, as_of, f"{folder}/lists", max_age_days, max_pages)
    ledger.pages.insert(found.pages)
    ledger.reviews.insert(found.reviews)
    ended = found.pages.groupBy(*keys).agg(F.max_by(F.struct("page_number", "next_page_token"), "page_number").alias("_end"))
    rows = found.requests.where(F.col("last_page").isNotNull()).join(ended, keys, "left").select(
        *keys, F.lit(run).alias("run"), "status", "last_page", "_end.page_number", "_end.next_page_token", as_of.alias("set_at"),
    )
    ledger.requests.add(rows, latest_run, "run", run)


def mark_refreshed(places: DataFrame, run: RefreshRun, language: str, day: Column) -> DataFrame:
    """Places with the day of the run as last scrape, where the run of their request is done."""
    done = run.requests.where((F.col("status") == "done") & (F.col("language") == language)).select("place_id", day.alias("day"))
    return stores.update_map_entry(places, done, "place_id", "last_scraped", F.lit(language), "day")


class Resolved(NamedTuple):
    """What a round of identifier lookups found out."""

    places: DataFrame  # the places table
    retry: DataFrame   # place_id and search_error of wanted places whose search failed or gave no response


NO_RESPONSE = "no response"


def resolve_identifiers(places: DataFrame, wanted: DataFrame, cache: DataFrame, responses: DataFrame,
                        order: list[Column], cache_order: list[Column], as_of: Column, folder: str) -> Resolved:
    """Places with the identifiers found for those that wanted one, and whom to ask again.

    ``places`` have place_id, data_id, name, coords and unserpable; ``wanted`` place_id;
    ``cache`` place_id and data_id; ``responses`` the place_id they were asked for and a
    body. A cached entry decides; otherwise the entries of the response do. Entries
    without a place are looked up by name and position, or dropped. Entries of unknown
    places are added. A place is marked when a search for it succeeded and it still has
    no identifier; the mark is for good. Where every search failed, or none answered,
    the place is left alone and returned for another try, with the error.

    What the cache had, the entries of the responses, which are also the new rows for
    the cache, and the links are written below ``folder`` once and read from there by the steps after.
    """
    spark = places.sparkSession
    search.look_up_cache(wanted.select("place_id"), cache, *cache_order).write.parquet(f"{folder}/looked")
    looked = spark.read.parquet(f"{folder}/looked")
    hits = looked.where("cache_hit").select("place_id", F.col("cached_data_id").alias("data_id"))
    misses = looked.where(~F.col("cache_hit")).select(F.col("place_id").alias("asked_for"))
    asked = responses.withColumnRenamed("place_id", "asked_for").join(misses, "asked_for", "left_semi")
    # Failed responses are left out after the write: a filter before it would be pushed below
    # the parsing and parse each response once more for the test.
    rs.normalise_entries(rs.search_entries(asked)).write.parquet(f"{folder}/entries")
    answers = spark.read.parquet(f"{folder}/entries")
    entries = answers.where(F.col("search_error").isNull())
    searched = entries.select(F.col("asked_for").alias("place_id")).distinct()
    errors = answers.groupBy("asked_for").agg(F.min("search_error").alias("search_error"))
    retry = (
        misses.join(searched, F.col("asked_for") == F.col("place_id"), "left_anti").join(errors, "asked_for", "left")
        .select(F.col("asked_for").alias("place_id"), F.coalesce("search_error", F.lit(NO_RESPONSE)).alias("search_error"))
    )
    point = {"lat": F.col("geometry.location.lat"), "lng": F.col("geometry.location.lng")}
    unplaced = entries.where(F.col("place_id").isNull()).drop("place_id").withColumns(point)
    known = places.select("place_id", "name", F.col("coords.lat").alias("lat"), F.col("coords.lng").alias("lng"))
    placed = entries.where(F.col("place_id").isNotNull()).unionByName(
        resolve.nearest_by_name(unplaced, known, folder=f"{folder}/resolve").drop("lat", "lng", "distance_mm")
    )
    search.one_link_per_place(placed, *order).write.parquet(f"{folder}/links")
    links = spark.read.parquet(f"{folder}/links")
    new = pl.normalise_places(links, F.lit(None).cast("string"), as_of)
    linked = search.apply_links(places, new)
    return Resolved(search.mark_unresolved(_with_ids(linked, hits), searched), retry)


def _with_ids(places: DataFrame, ids: DataFrame) -> DataFrame:
    return stores.update_column(places, ids, "place_id", "data_id")


def scan_area(store: DataFrame, responses: DataFrame, query: str, as_of: Column, order: list[Column]) -> DataFrame:
    """The places table with the results of a scan: new places added, known ones get the query."""
    results = rs.found_places(rs.place_results(responses))
    found = pl.one_per_place(results, *order)
    return stores.upsert_rows(store, pl.normalise_places(found, F.lit(query), as_of), "place_id", "all_queries")


def responses_of_cells(cells: DataFrame, responses: DataFrame, cell: str = "cell") -> DataFrame:
    """Responses (child_cell, body and more) to the searches that cover the given coarse cells, with the cell each was asked for.

    A search was made in every fine cell of a coarse one; a response may name places
    outside the cell it was asked for. Responses to other searches are left out.
    """
    asked = geo.cover(cells, cell).select("child_cell")
    return responses.join(asked, "child_cell", "left_semi").withColumnRenamed("child_cell", "searched_cell")
