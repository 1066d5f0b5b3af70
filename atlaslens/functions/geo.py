"""Square map cells on the Web Mercator grid, as plain column maths.

A level has 2**level cells per side. A cell and its parent differ by halving x and
y, so a point's coarse cell is always the parent of its fine cell.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

COARSE_LEVEL = 14
FINE_LEVEL = 17
MAX_LATITUDE = 85.05112878
EARTH_CIRCUMFERENCE_M = 40075016.686

_LEVEL_SHIFT = 56
_X_SHIFT = 28


def _bounded(value: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), value))


def tile_x(lng: Column, level: int) -> Column:
    side = 2**level
    x = F.floor((lng + 180.0) / 360.0 * side)
    # greatest and least skip null, so a missing coordinate is told apart first.
    return F.when(lng.isNotNull(), _bounded(x, 0, side - 1).cast("long"))


def tile_y(lat: Column, level: int) -> Column:
    side = 2**level
    radians = F.radians(_bounded(lat, -MAX_LATITUDE, MAX_LATITUDE))
    # ln(tan + sec) written as atanh(sin): one trigonometric function per point.
    y = F.floor((1.0 - F.atanh(F.sin(radians)) / math.pi) / 2.0 * side)
    return F.when(lat.isNotNull(), _bounded(y, 0, side - 1).cast("long"))


def cell_id(x: Column, y: Column, level: int) -> Column:
    """One long per cell: level, x and y in separate bits."""
    return F.lit(level * 2**_LEVEL_SHIFT) + F.shiftleft(x.cast("long"), _X_SHIFT) + y.cast("long")


def point_cell(lat: Column, lng: Column, level: int) -> Column:
    return cell_id(tile_x(lng, level), tile_y(lat, level), level)


def cell_x(cell: Column) -> Column:
    return F.shiftright(cell, _X_SHIFT).bitwiseAND(F.lit(2**_X_SHIFT - 1))


def cell_y(cell: Column) -> Column:
    return cell.bitwiseAND(F.lit(2**_X_SHIFT - 1))


def parent_cell(cell: Column, level: int, parent_level: int) -> Column:
    steps = level - parent_level
    return cell_id(F.shiftright(cell_x(cell), steps), F.shiftright(cell_y(cell), steps), parent_level)


def centre_lat(y: Column, level: int) -> Column:
    return F.degrees(F.atan(F.sinh(math.pi * (1.0 - 2.0 * (y + 0.5) / float(2**level)))))


def centre_lng(x: Column, level: int) -> Column:
    return (x + 0.5) / float(2**level) * 360.0 - 180.0


def search_radius_m(lat: Column, level: int) -> Column:
    """Ground length of a cell's side at a latitude, in whole metres."""
    return F.floor(EARTH_CIRCUMFERENCE_M / float(2**level) * F.cos(F.radians(lat))).cast("long")


def haversine_m(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    """Distance on the sphere in metres."""
    half_lat = F.sin(F.radians(lat2 - lat1) / 2.0)
    half_lng = F.sin(F.radians(lng2 - lng1) / 2.0)
    chord = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lng * half_lng
    return 2.0 * 6371008.8 * F.asin(F.sqrt(F.least(F.lit(1.0), chord)))


def with_location_cells(df: DataFrame, lat: Column, lng: Column) -> DataFrame:
    """Add the cells of a point at the two levels in use."""
    return df.withColumns({
        "loc_cell_fine": point_cell(lat, lng, FINE_LEVEL),
        "loc_cell_coarse": point_cell(lat, lng, COARSE_LEVEL),
    })


def cover(cells: DataFrame, cell: str = "cell", level: int = COARSE_LEVEL, child_level: int = FINE_LEVEL) -> DataFrame:
    """Each cell's children with centre point and search radius: 4**(child_level - level) rows per cell."""
    steps = child_level - level
    last = 2**steps - 1
    return (
        cells.withColumn("_dx", F.explode(F.sequence(F.lit(0), F.lit(last))))
        .withColumn("_dy", F.explode(F.sequence(F.lit(0), F.lit(last))))
        .withColumns({
            "child_x": F.shiftleft(cell_x(F.col(cell)), steps) + F.col("_dx"),
            "child_y": F.shiftleft(cell_y(F.col(cell)), steps) + F.col("_dy"),
        })
        .withColumns({
            "child_cell": cell_id(F.col("child_x"), F.col("child_y"), child_level),
            "centre_lat": centre_lat(F.col("child_y"), child_level),
            "centre_lng": centre_lng(F.col("child_x"), child_level),
        })
        .withColumn("radius_m", search_radius_m(F.col("centre_lat"), child_level))
        .drop("_dx", "_dy")
    )
