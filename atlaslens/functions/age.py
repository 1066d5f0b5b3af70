"""Relative age text ("3 weeks ago", "hace 3 semanas") to days, dates and precision."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

# The words of each unit and its length in days (0 = counted as the same day).
UNITS_EN = [
    (("second", "seconds", "minute", "minutes", "hour", "hours"), 0),
    (("day", "days"), 1),
    (("week", "weeks"), 7),
    (("month", "months"), 30),
    (("year", "years"), 365),
]
UNITS_ES = [
    (("segundo", "segundos", "secundos", "minuto", "minutos", "minuta", "hora", "horas"), 0),
    (("día", "días"), 1),
    (("semana", "semanas"), 7),
    (("mes", "meses"), 30),
    (("año", "años"), 365),
]
ARTICLES_EN = ("a", "an")
ARTICLES_ES = ("un", "una")


def _unit_length(word: Column, units) -> Column:
    return reduce(lambda chain, unit: chain.when(word.isin(*unit[0]), F.lit(unit[1])), units, F.when(F.lit(False), 0))


def _total(count: Column, unit_days: Column, is_article: Column, compat: bool) -> Column:
    # In compat mode "a week" counts as one day, as in the published results of older runs.
    one_unit = F.when(unit_days == 7, F.lit(1)).otherwise(unit_days) if compat else unit_days
    return (
        F.when(unit_days == 0, F.lit(0)).when(is_article, one_unit).otherwise(count.try_cast("int") * unit_days)
    )


def with_days_before(df: DataFrame, text: str = "time", language: str = "language", compat: bool = False) -> DataFrame:
    """Add days_before_scrape; null when the language or the text is not understood.

    English reads ``<count> <unit> ago``, Spanish ``hace <count> <unit>``. The steps are
    columns of their own, so that each is worked out once per row.
    """
    spanish = F.col(language) == "es"
    readable = (F.col(language) == "en") | (spanish & (F.get("_words", F.lit(0)) == "hace"))
    is_article = F.when(spanish, F.col("_count").isin(*ARTICLES_ES)).otherwise(F.col("_count").isin(*ARTICLES_EN))
    return (
        df.withColumn("_words", F.split(F.lower(text), " "))
        .withColumn("_at", F.when(readable, F.when(spanish, F.lit(1)).otherwise(F.lit(0))))
        .withColumns({"_count": F.get("_words", F.col("_at")), "_unit": F.get("_words", F.col("_at") + 1)})
        .withColumn(
            "_unit_days",
            F.when(spanish, _unit_length(F.col("_unit"), UNITS_ES)).otherwise(_unit_length(F.col("_unit"), UNITS_EN)),
        )
        .withColumn("days_before_scrape", _total(F.col("_count"), F.col("_unit_days"), is_article, compat))
        .drop("_words", "_at", "_count", "_unit", "_unit_days")
    )


def age_error(days: Column, language: Column) -> Column:
    """Why an age is null (``language`` or ``text``), or null when it is known."""
    return (
        F.when(~F.coalesce(language.isin("en", "es"), F.lit(False)), F.lit("language")).when(days.isNull(), F.lit("text"))
    )


def precision(days: Column) -> Column:
    """How coarse an age is, in days."""
    return (
        F.when(days == 0, 0).when(days < 7, 1).when(days < 30, 7).when(days < 365, 30)
        .when(days.isNotNull(), 365)
    )


def with_review_age(
    df: DataFrame, as_of: Column, text: str = "time", language: str = "language", scrape_ds: str = "scrape_ds",
    compat: bool = False,
) -> DataFrame:
    """Add days_before_scrape, review_date, age_in_days, age_precision and age_error."""
    return (
        with_days_before(df, text, language, compat)
        .withColumn("review_date", F.date_sub(F.col(scrape_ds), F.col("days_before_scrape")))
        .withColumns({
            "age_in_days": F.datediff(as_of, F.col("review_date")),
            "age_precision": precision(F.col("days_before_scrape")),
            "age_error": age_error(F.col("days_before_scrape"), F.col(language)),
        })
    )


def age_text(review_date: Column) -> Column:
    """Text form of an age: its date."""
    return F.date_format(review_date, "yyyy-MM-dd")
