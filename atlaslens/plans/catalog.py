"""All queries. Importing the plan modules registers them."""

from __future__ import annotations

from atlaslens.plans import discovery, paging, parsing, refresh, runs, upkeep  # noqa: F401
from atlaslens.plans import intake, stored, streams  # noqa: F401  (they import the batch twins whose SQL they share)
from atlaslens.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
