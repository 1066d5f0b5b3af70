"""Column functions on text: cleaning, links, keys, ids and page tokens."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Word characters and trailing equal signs; (?U) makes \w match letters of every script.
NEXT_PAGE_TOKEN = r'(?U)data-next-page-token="(\w+=+)'

# The characters that count as white space.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(text: Column) -> Column:
    """Trim every kind of white space, not only blanks. Looks at the ends only, not at the whole text."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def collapse_whitespace(text: Column) -> Column:
    """Each run of white space becomes one blank, none at the ends."""
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def clean_name(text: Column) -> Column:
    """Newlines become blanks, commas and bars are dropped, the ends are trimmed."""
    flat = F.replace(text, F.lit("\n"), F.lit(" "))
    return strip(F.replace(F.replace(flat, F.lit(","), F.lit("")), F.lit("|"), F.lit("")))


def first_digit(text: Column) -> Column:
    """First digit as a double, null when there is none."""
    return F.nullif(F.regexp_extract(text, r"(\d)", 1), F.lit("")).cast("double")


def star_rating(label: Column, outer: Column) -> Column:
    """First digit of the label; only when the label has none, of the whole element.

    Class names in the element may hold digits, so the label goes first.
    """
    return F.coalesce(first_digit(label), first_digit(outer))


def next_page_token(html: Column) -> Column:
    """First next-page token in the page text, null when there is none."""
    return F.nullif(F.regexp_extract(html, NEXT_PAGE_TOKEN, 1), F.lit(""))


def page_link(host: Column, domain: Column, language: Column, data_id: Column, token: Column) -> Column:
    """Text of the address of one review page. The address is only written, never opened."""
    return F.concat(
        F.lit("https://"), host, F.lit("."), domain, F.lit("/async/reviewDialog?hl="), language,
        F.lit("&async=feature_id:"), data_id,
        F.lit(",sort_by:newestFirst,next_page_token:"), token,
        F.lit(",associated_topic:,_fmt:pc"),
    )


def composite_key(*parts: Column) -> Column:
    """Parts joined by ``_``; null when a part is null (``concat_ws`` would skip it)."""
    joined = parts[0].cast("string")
    for part in parts[1:]:
        joined = F.concat(joined, F.lit("_"), part.cast("string"))
    return joined


def review_id(place_id: Column, reviewer_name: Column, language: Column) -> Column:
    """Stable id of a review; null when one of its parts is null."""
    return F.sha2(composite_key(place_id, reviewer_name, language), 256)
