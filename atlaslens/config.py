"""Localization and parser settings as small fixed tables.

Both tables have a fixed number of rows that does not grow with the data,
which is the size bound behind broadcasting them.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

# One row per country.
LOCALIZATION = [
    # country, language, domain, food, service, atmosphere
    ("es", "en", "es", "Food", "Service", "Atmosphere"),
]

# One row per language of the captured pages.
PARSER = [
    # language, stars_class, review_class, sing_lang_review_class, full_review_class, translated_tag, original_tag
    ("en", "lTi8oc z3HNkc", "Jtu6Td", "f5axBf", "review-full-text", "(Translated by Google)", "(Original)"),
    ("es", "Fam1ne EBe2gf", "Jtu6Td", "f5axBf", "review-full-text", "(Traducido por Google)", "(Original)"),
]

# Classes that do not depend on the language.
NAME_CLASS = "TSUbDb"
TIME_CLASS = "PuaHbe"

# Limits and periods.
PLACE_TYPES_FIRST = ("restaurant", "cafe", "food", "bar")
REFRESH_EVERY_DAYS = 28
LEASE_TTL_S = 3600
CURRENT_SLOT_TTL_S = 1800
PAGE_CHECKPOINT_TTL_S = 86400
PAGE_RETENTION_S = 14 * 86400
SLOT_COOL_DOWN_S = 86400
MIN_PAGE_CHARS = 100
MAX_PAGES = 200
PAGES_PER_RUN = 12
MAX_REVIEW_AGE_DAYS = 48 * 30
BLOCKED_MARKER = "Our systems have detected unusual traffic from your computer network."
NEVER_SCRAPED = "2015-01-01"
NO_DATE_IN_REQUEST = "2017-01-01"
LEASE_PREFIX = "working_on_"
CURRENT_SLOT_SUFFIX = "_current_slot"

LOCALIZATION_COLUMNS = ("country", "language", "domain", "food", "service", "atmosphere")
PARSER_COLUMNS = (
    "language", "stars_class", "review_class", "sing_lang_review_class", "full_review_class", "translated_tag", "original_tag",
)


def _table(spark: SparkSession, rows, columns) -> DataFrame:
    # An Arrow table becomes a local relation; plain Python rows would be read through an RDD.
    return spark.createDataFrame(pa.Table.from_pylist([dict(zip(columns, row)) for row in rows]))


def localization_table(spark: SparkSession, rows=LOCALIZATION) -> DataFrame:
    return _table(spark, rows, LOCALIZATION_COLUMNS)


def parser_table(spark: SparkSession, rows=PARSER) -> DataFrame:
    return _table(spark, rows, PARSER_COLUMNS)
