"""The 1 km tile grid: tiles of a box, selections and cache coverage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from urbanframe.functions.geometry import let
from urbanframe.functions.parsing import TILE_M, tile_id, tile_parts
from urbanframe.functions.projection import PLAIN, from_utm, to_utm
from urbanframe.operators.spatial import smallest_cover

#: Tiles of a viewport and of a selection.
MOST_TILES, MOST_SELECTED = 400, 256


def tiles_of_box(spark: SparkSession, west: float, south: float, east: float, north: float, most: int = MOST_TILES) -> DataFrame:
    """(tile_id, zone, northern, easting, northing) of the tiles that a box touches; none if there are more than most.

    The zone is that of the box's centre. Only the number of tiles is computed on the driver.
    """
    zone = int(((west + east) / 2 + 180) / 6) + 1
    northern = (south + north) / 2 >= 0
    corners = [to_utm(x, y, zone, PLAIN) for x in (west, east) for y in (south, north)]
    (e0, e1), (n0, n1) = ((int(min(v) // TILE_M), int(max(v) // TILE_M)) for v in zip(*corners, strict=True))
    count = (e1 - e0 + 1) * (n1 - n0 + 1)
    grid = spark.range(count if count <= most else 0)
    easting = ((F.lit(e0) + F.col("id") % (e1 - e0 + 1)) * TILE_M).alias("easting")
    northing = ((F.lit(n0) + F.floor(F.col("id") / (e1 - e0 + 1))) * TILE_M).alias("northing")
    out = grid.select(F.lit(zone).alias("zone"), F.lit(northern).alias("northern"), easting, northing)
    return out.select(tile_id(F.col("zone"), F.col("northern"), F.col("easting"), F.col("northing")).alias("tile_id"), "zone", "northern", "easting", "northing")


def tiles_of_boxes(boxes: DataFrame, zone: int, northern: bool = True, most: int = MOST_TILES) -> DataFrame:
    """(id, tile_id, zone, northern, easting, northing) of the tiles that each box (id, west, south, east, north) touches in a zone.

    A box of more tiles than most has none, and neither has one with a null side. Repeated boxes give repeated rows.
    """
    sides = ("west", "south", "east", "north")
    corner = lambda x, y: F.struct(F.col(x).alias("lon"), F.col(y).alias("lat"))
    planar = lambda c: F.struct(*(F.floor(v / TILE_M).alias(n) for n, v in zip("en", to_utm(c["lon"], c["lat"], zone), strict=True)))
    corners = F.transform(F.array(*(corner(x, y) for x in sides[::2] for y in sides[1::2])), planar)

    def grid(c: Column) -> Column:
        ends = {n: (F.array_min(F.transform(c, lambda p: p[n])), F.array_max(F.transform(c, lambda p: p[n]))) for n in "en"}
        few = (ends["e"][1] - ends["e"][0] + 1) * (ends["n"][1] - ends["n"][0] + 1) <= most
        every = F.flatten(F.transform(F.sequence(*ends["e"]), lambda e: F.transform(F.sequence(*ends["n"]), lambda n: F.struct((e * TILE_M).alias("easting"), (n * TILE_M).alias("northing")))))
        return F.when(few, every)

    known = boxes.filter(" AND ".join(f"{c} IS NOT NULL" for c in sides))
    out = known.select("id", F.explode(let(corners, grid)).alias("t")).select("id", F.lit(zone).alias("zone"), F.lit(northern).alias("northern"), "t.*")
    return out.select("id", tile_id(F.col("zone"), F.col("northern"), F.col("easting"), F.col("northing")).alias("tile_id"), "zone", "northern", "easting", "northing")


def with_corners(tiles: DataFrame, zone: int, northern: bool = True) -> DataFrame:
    """Adds west, south, east and north, the envelope of a tile's four corners, and lon and lat of its centre (7 dp)."""
    at = lambda dx, dy: F.struct((F.col("easting") + dx).alias("e"), (F.col("northing") + dy).alias("n"), F.lit(dx not in (0, TILE_M)).alias("mid"))
    points = F.array(*(at(dx, dy) for dx in (0, TILE_M) for dy in (0, TILE_M)), at(TILE_M // 2, TILE_M // 2))
    lon, lat = from_utm(F.col("c.e"), F.col("c.n"), zone, northern)
    degrees = tiles.withColumn("c", F.explode(points)).select(*tiles.columns, lon.alias("lon"), lat.alias("lat"), F.col("c.mid").alias("mid"))
    side = lambda f, c, name, mid=False: F.round(f(F.when(F.col("mid") == mid, F.col(c))), 7).alias(name)
    return degrees.groupBy(*tiles.columns).agg(side(F.min, "lon", "west"), side(F.min, "lat", "south"), side(F.max, "lon", "east"), side(F.max, "lat", "north"), side(F.max, "lon", "lon", True), side(F.max, "lat", "lat", True))


def selection(ids: DataFrame, by: Sequence[str] = (), most: int = MOST_SELECTED) -> DataFrame:
    """For tile ids (tile_id), all or by group: n, cols, rows and reason, null if they are a full rectangle of one zone.

    Reasons, the first that holds: empty, bad_id, too_many, mixed_zones, not_rectangle. Blank ids are left out and
    repeated ones count once.
    """
    trimmed = ids.withColumn("tile_id", F.trim("tile_id")).filter("tile_id <> ''").select(*by, "tile_id").distinct()
    parts = trimmed.withColumn("t", tile_parts(F.col("tile_id")))
    out = parts.groupBy(*by).agg(
        F.count("*").alias("n"),
        F.count_if(F.col("t").isNull()).alias("bad"),
        F.countDistinct("t.zone", "t.northern").alias("zones"),
        F.countDistinct("t.easting").alias("cols"),
        F.countDistinct("t.northing").alias("rows"),
        ((F.max("t.easting") - F.min("t.easting")) / TILE_M + 1).alias("wide"),
        ((F.max("t.northing") - F.min("t.northing")) / TILE_M + 1).alias("high"),
    )
    full = (F.col("wide") * F.col("high") == F.col("n")) & (F.col("cols") * F.col("rows") == F.col("n"))
    reason = F.when(F.col("n") == 0, "empty").when(F.col("bad") > 0, "bad_id").when(F.col("n") > most, "too_many").when(F.col("zones") > 1, "mixed_zones").when(~full, "not_rectangle")
    return out.select(*by, "n", "cols", "rows", reason.alias("reason"))


def coverage(tiles: DataFrame, macro: DataFrame, clips: DataFrame) -> DataFrame:
    """Adds source: macro where a macro tile covers the tile's envelope, else clip, else none."""
    sides = ("west", "south", "east", "north")
    targets = tiles.select(F.col("tile_id").alias("id"), *sides)

    def has(covers: DataFrame, name: str) -> DataFrame:
        found = smallest_cover(targets, covers.select(F.lit(1).alias("id"), *sides)).filter("cover IS NOT NULL")
        return found.select(F.col("target").alias("tile_id"), F.lit(True).alias(name))

    out = tiles.join(has(macro, "m"), "tile_id", "left").join(has(clips, "k"), "tile_id", "left")
    return out.withColumn("source", F.when(F.col("m"), "macro").when(F.col("k"), "clip").otherwise("none")).drop("m", "k")


def selection_totals(tiles: DataFrame, by: Sequence[str]) -> DataFrame:
    """(by, easting, northing, cols, rows, tiles, cached_tiles, cached, sources) of the tiles (easting, northing, source) of selections.

    A tile with a source that isn't empty is cached. Repeated tiles count once, and are cached if one of them is; sources
    are sorted, without repeats. Tiles without a place are left out, a null group is a group.
    """
    some = F.when(F.col("source") != "", F.col("source"))
    once = tiles.filter("easting IS NOT NULL AND northing IS NOT NULL").groupBy(*by, "easting", "northing").agg(F.collect_set(some).alias("own"))
    n, cached = F.count("*"), F.count_if(F.size("own") > 0)
    return once.groupBy(*by).agg(
        F.min("easting").alias("easting"), F.min("northing").alias("northing"), F.count_distinct("easting").alias("cols"), F.count_distinct("northing").alias("rows"),
        n.alias("tiles"), cached.alias("cached_tiles"), (cached == n).alias("cached"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("own")))).alias("sources"),
    )
