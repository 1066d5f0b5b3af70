"""Schemas of the collections, as DDL strings."""

from __future__ import annotations

PAGE = (
    "place_id string, data_id string, name string, scrape_ds date, scrape_language string, "
    "page_number int, next_page_token string, content string, ttl int, stored_at timestamp"
)

PLACE_RESPONSE = (
    "results array<struct<place_id: string, name: string, formatted_address: string, types: array<string>, "
    "priority: int, unserpable: boolean, permanent_closed: boolean, "
    "geometry: struct<location: struct<lat: double, lng: double>>>>, next_page_token string"
)

SCRAPE_REQUEST = (
    "place_id string, data_id string, name string, language string, country_domain string, "
    "priority int, last_scraped string"
)

# The contract of a scrape request, exactly these keys.
SCRAPE_REQUEST_KEYS = ("place_id", "data_id", "name", "language", "country_domain", "priority", "last_scraped")

# The contract of a request for an identifier: exactly these keys.
ID_REQUEST_KEYS = ("place_id", "priority", "name", "coords", "data_id")

ID_REQUEST = "place_id string, priority int, name string, coords array<double>, data_id string"

# Columns that may be stored for a place.
PLACE_COLUMNS = (
    "formatted_address", "name", "place_id", "types_en", "loc_cell_coarse", "loc_cell_fine", "coords",
    "search_cell_coarse", "search_cell_fine", "search_query", "query_ds", "last_scraped", "permanent_closed",
    "data_id", "all_queries", "priority", "unserpable", "unscrapable", "added_at",
)

EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
