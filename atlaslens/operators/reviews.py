"""Review rows from captured pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from atlaslens import config
from atlaslens.functions import text as tx
from atlaslens.functions.age import with_review_age
from atlaslens.functions.bilingual import with_bilingual_texts
from atlaslens.functions.html import review_lists
from atlaslens.operators.paging import page_outcome


def zip_lists(df: DataFrame, lists: dict[str, str], position: str = "position") -> DataFrame:
    """One row per position of lists that may differ in length; short ones give null.

    ``lists`` maps the list columns to the names of their elements. ``aligned`` tells
    whether the first list, which decides what a row is, reached that far.
    """
    # A null list would make the whole zip null, so it counts as empty.
    filled = df.withColumns({column: F.coalesce(F.col(column), F.array()) for column in lists})
    first = next(iter(lists))
    # The size is taken before the lists are exploded, else each row would carry the whole first list.
    sized = filled.withColumn("_first_size", F.size(first))
    zipped = sized.select(
        *(column for column in sized.columns if column not in lists),
        F.posexplode(F.arrays_zip(*lists)).alias(position, "_zipped"),
    )
    return zipped.select(
        *(column for column in zipped.columns if column not in ("_zipped", "_first_size")),
        *(F.col(f"_zipped.{column}").alias(name) for column, name in lists.items()),
        (F.col(position) < F.col("_first_size")).alias("aligned"),
    )


def with_review_lists(pages: DataFrame, parsers: DataFrame, language: str = "scrape_language") -> DataFrame:
    """Pages with their lists of reviews, names, times and stars in place of the content.

    Adds ``n_rows``, the length of the longest list, and the ``outcome`` of the page.
    Spark broadcasts the parser table if its size allows. A page in a language without
    parser settings has empty lists.
    """
    settings = parsers.withColumnRenamed("language", language)
    lists = review_lists(
        F.col("content"), F.col("stars_class"), F.col("review_class"), F.col("sing_lang_review_class"),
        F.col("full_review_class"), config.NAME_CLASS, config.TIME_CLASS,
    )
    return (
        pages.join(settings, language, "left")
        .withColumn("_lists", lists)
        .select("*", "_lists.*")
        .withColumn("n_rows", F.greatest(*(F.size(name) for name in ("reviews", "names", "times", "stars"))))
        .withColumn("outcome", page_outcome(F.col("content"), F.col("n_rows")))
        .drop("_lists", "content", "stars_class", "review_class", "sing_lang_review_class", "full_review_class")
    )


def parse_pages(pages: DataFrame, parsers: DataFrame, as_of: Column, compat_age: bool = False) -> DataFrame:
    """Typed review rows of captured pages, all pages in one lazy plan."""
    return rows_from_lists(with_review_lists(pages, parsers), as_of, compat_age)


def rows_from_lists(with_lists: DataFrame, as_of: Column, compat_age: bool = False) -> DataFrame:
    """One row per review position with its texts, name, age and id.

    Surplus names, times or stars keep their page's keys, with ``aligned`` false.
    """
    rows = zip_lists(
        with_lists.drop("n_rows", "outcome"),
        {"reviews": "review", "names": "raw_name", "times": "raw_time", "stars": "star"},
    )
    texts = with_bilingual_texts(
        rows, F.col("review.parts"), F.col("review.single"), F.col("translated_tag"), F.col("original_tag")
    )
    aligned = F.col("aligned")
    reviews = (
        texts.withColumns({
            "review_original": F.when(aligned, F.col("original")),
            "review_target_language": F.when(aligned, F.col("translated")),
            "language": F.col("scrape_language"),
            "reviewer_name": tx.clean_name(F.col("raw_name")),
            "time": tx.collapse_whitespace(F.col("raw_time")),
            "stars": tx.star_rating(F.col("star.label"), F.col("star.outer")),
            "restaurant_name": F.col("name"),
        })
        .withColumn("unique_review_id", tx.review_id(F.col("place_id"), F.col("reviewer_name"), F.col("language")))
        .drop("original", "translated", "review", "raw_name", "raw_time", "star", "translated_tag", "original_tag",
              "name", "scrape_language")
    )
    return with_review_age(reviews, as_of, compat=compat_age)
