"""Facet ratings (food, service, atmosphere) of one review."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

FACETS = ("food", "service", "atmosphere")


def facet_columns(review: Column, labels: dict[str, Column]) -> dict[str, Column]:
    """Review text and one column per facet from ``map<string, array<string>>``.

    Keys compare without case after the facet's localized label is renamed to its
    plain name; a missing facet is null, otherwise the first entry of its list.
    """
    def first(name: Column) -> Column:
        # A filter, not transform_keys: keys differing only in case must not clash.
        lists = F.map_values(F.map_filter(review, lambda key, _: F.lower(key) == name))
        return F.try_element_at(F.try_element_at(lists, F.lit(1)), F.lit(1))

    columns = {"review": first(F.lit("review"))}
    for facet in FACETS:
        columns[facet] = F.coalesce(first(F.lower(labels[facet])), first(F.lit(facet)))
    return columns
