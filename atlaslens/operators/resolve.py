"""Finding the place of a search entry that came without one, by name and position."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from atlaslens.functions import geo
from atlaslens.session import work_dir

# Levels looked at one after another: cells of about 38 m, 306 m and 2.4 km at the equator.
FINEST_LEVEL = 20
LEVEL_STEP = 3


def _wrapped(x: Column, level: int) -> Column:
    """Cells east of the last column are those west of the first."""
    return F.pmod(x, F.lit(1 << level))


def _around(x: Column, y: Column, level: int) -> Column:
    """The cell and its eight neighbours as an array of (x, y)."""
    steps = [(dx, dy) for dx in (-1, 0, 1) for dy in (-1, 0, 1)]
    return F.array(*(F.struct(_wrapped(x + dx, level).alias("x"), (y + dy).alias("y")) for dx, dy in steps))


def nearest_by_name(
    entries: DataFrame, places: DataFrame, lat: str = "lat", lng: str = "lng", coarse: int = geo.COARSE_LEVEL, folder: str | None = None,
) -> DataFrame:
    """Add place_id of the nearest place of exactly the entry's name, and distance_mm; null if there is none.

    Candidates lie in the entry's coarse cell or one of the eight around it, across the
    180th meridian too. They are ranked by distance in whole millimetres, then place_id.

    Entries and places are first folded to one row per name and point. Entries then look
    around in ever coarser cells and stop as soon as nothing outside the nine cells can be
    nearer, so in a crowd they meet only the places next to them. Both folded tables and
    each level's answers are written below ``folder`` (a fresh work folder unless given):
    a level reads what the one before left open, and nothing is worked out twice.
    """
    spark = entries.sparkSession
    folder = folder or work_dir(spark, "resolve")

    def written(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

    located = entries.where(F.col("name").isNotNull() & F.col(lat).isNotNull() & F.col(lng).isNotNull())
    spots = written(located.select("name", F.col(lat).alias("_lat"), F.col(lng).alias("_lng")).distinct(), "spots")
    # Places of a name that no entry has are of no use to any level.
    named = places.join(spots.select("name").distinct(), "name", "left_semi")
    folded = written(named.groupBy("name", F.col(lat).alias("_plat"), F.col(lng).alias("_plng")).agg(F.min("place_id").alias("_place_id")), "places")
    metres = geo.haversine_m(F.col("_lat"), F.col("_lng"), F.col("_plat"), F.col("_plng"))
    distance = F.floor(metres * 1000.0 + 0.5)
    levels = [*range(FINEST_LEVEL, coarse, -LEVEL_STEP), coarse]
    open_spots, found = spots, None
    for level in levels:
        cell = lambda la, ln, level=level: (geo.tile_x(F.col(ln), level), geo.tile_y(F.col(la), level))
        px, py = cell("_plat", "_plng")
        x, y = cell("_lat", "_lng")
        there = folded.withColumns({"_x": _wrapped(px, level), "_y": py})
        # Whatever lies outside is at least one cell away; rows of cells get lower towards the poles.
        side = geo.EARTH_CIRCUMFERENCE_M / float(2**level) * F.cos(F.radians(F.least(F.abs("_lat") + 360.0 / 2**level, F.lit(90.0))))
        sure = F.lit(True) if level == coarse else F.coalesce(F.col("_best.distance_mm") < side * 990.0, F.lit(False))
        best = F.struct(distance.alias("distance_mm"), F.col("_place_id").alias("place_id"))
        near = written(
            open_spots.withColumn("_cell", F.explode(_around(x, y, level)))
            .select("*", F.col("_cell.x").alias("_x"), F.col("_cell.y").alias("_y"))
            .join(there, ["name", "_x", "_y"], "left")
            .groupBy("name", "_lat", "_lng")
            .agg(F.min(F.when(F.col("_plat").isNotNull(), best)).alias("_best"))
            .withColumn("_sure", sure), f"level-{level}",
        )
        settled = near.where("_sure AND _best IS NOT NULL").select("name", "_lat", "_lng", "_best.place_id", "_best.distance_mm")
        found = settled if found is None else found.unionByName(settled)
        open_spots = near.where("NOT _sure").select("name", "_lat", "_lng")
    same = (F.col("name") == F.col("_name")) & (F.col(lat) == F.col("_lat")) & (F.col(lng) == F.col("_lng"))
    return entries.join(found.withColumnRenamed("name", "_name"), same, "left").drop("_name", "_lat", "_lng")
