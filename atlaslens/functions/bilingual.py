"""Split the parts of a review into its original and its translated text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from atlaslens.functions.text import strip


def _part(position: Column) -> Column:
    """The part at a 1-based position (negative from the end), null when there is none."""
    return F.try_element_at(F.col("_parts"), F.nullif(position, F.lit(0)).cast("int"))


def _first_with(tag: Column) -> Column:
    """1-based position of the first part containing the tag, 0 when there is none."""
    return F.coalesce(F.array_position(F.transform("_parts", lambda part: F.contains(part, tag)), True), F.lit(0))


def with_bilingual_texts(
    df: DataFrame, full_parts: Column, single_text: Column, translated_tag: Column, original_tag: Column,
) -> DataFrame:
    """Add ``original`` and ``translated`` of each review.

    ``full_parts`` holds the texts of the children of a full review; where it is null
    the single text is both original and translation. With parts:

    * A part equal to the translated tag: the next part is the translation and the
      previous one the original. With the tag first, "previous" is the last part,
      which is right for tag, translation, tag, original. A trailing tag has no
      translation (null) and keeps the original.
    * A part containing the tag: the rest of it is the translation. The original is
      the part after a part equal to the original tag, or the rest of the part
      containing that tag, or empty.
    * No tag (or nothing beside it): both are the first part, or empty.

    The steps are columns of their own, so that each is worked out once per row.
    """
    single = F.array(F.coalesce(strip(single_text), F.lit("")))
    tidy = F.filter(F.transform(full_parts, strip), lambda part: F.length(part) > 0)
    t, o = F.col("_t"), F.col("_o")
    staged = (
        df.withColumns({
            "_parts": F.when(full_parts.isNull(), single).otherwise(tidy), "_ttag": translated_tag, "_otag": original_tag,
        })
        .withColumns({
            "_t": F.when(full_parts.isNull(), F.lit(0)).otherwise(_first_with(F.col("_ttag"))),
            "_o": _first_with(F.col("_otag")),
        })
        .withColumns({
            "_first": F.coalesce(_part(F.lit(1)), F.lit("")),
            "_tagged": _part(t),
            "_after": _part(t + 1),
            "_before": F.when(F.size("_parts") > 1, _part(F.when(t == 1, F.lit(-1)).otherwise(t - 1))).otherwise(F.lit("")),
            "_marked": _part(o),
            "_next": F.when(o > 0, _part(o + 1)),
        })
        .withColumns({
            "_rest": strip(F.replace("_tagged", "_ttag", F.lit(""))),
            "_sought": F.when(o == 0, F.lit(""))
            .when((F.col("_marked") == F.col("_otag")) & F.col("_next").isNotNull(), F.col("_next"))
            .otherwise(strip(F.replace("_marked", "_otag", F.lit("")))),
        })
    )
    untagged = (t == 0) | ((F.col("_tagged") != F.col("_ttag")) & (F.col("_rest") == ""))
    exact = F.col("_tagged") == F.col("_ttag")
    return staged.withColumns({
        "original": F.when(untagged, F.col("_first")).when(exact, F.col("_before")).otherwise(F.col("_sought")),
        "translated": F.when(untagged, F.col("_first")).when(exact, F.col("_after")).otherwise(F.col("_rest")),
    }).drop("_parts", "_ttag", "_otag", "_t", "_o", "_first", "_tagged", "_after", "_before", "_marked", "_next", "_rest", "_sought")
