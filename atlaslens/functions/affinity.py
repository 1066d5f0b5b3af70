"""How well an hour of the day fits a habitual hour."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F


def _density(x: Column, mu: Column, sigma: float) -> Column:
    return F.exp(-F.pow((x - mu) / sigma, F.lit(2.0)) / 2.0) / (sigma * math.sqrt(2.0 * math.pi))


def affinity(x: Column, mu: Column, sigma: float = 1.5, compat: bool = False) -> Column:
    """Sum of normal densities around ``mu`` on a 24-hour clock.

    The clock wraps both ways, so 23.5 against 0.5 equals 0.5 against 23.5. With
    ``compat`` it wraps only forwards, as older runs did.
    """
    forward = _density(x, mu, sigma) + _density(x, mu + 24.0, sigma)
    return forward if compat else forward + _density(x, mu - 24.0, sigma)


def decimal_hour(ts: Column) -> Column:
    return F.hour(ts) + F.minute(ts) / 60.0
