"""Parsing of tags, ids and lines as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

FLOOR_M = 3.5
#: The form of a tile's id, and the addresses of maps that have a place, the last that fits wins.
TILE_ID = r"^z(\d{1,2})([ns])_e(-?\d+)_n(-?\d+)_s(\d+)$"
MAP_ADDRESSES = (
    (r"[?&]q=(-?\d+\.\d+),(-?\d+\.\d+)", False),
    (r"[?&]ll=(-?\d+\.\d+),(-?\d+\.\d+)", False),
    (r"/@(-?\d+\.\d+),(-?\d+\.\d+),([\d.]+)z", True),
)
TILE_M = 1000


def number(text: Column) -> Column:
    """A double, or null; NaN counts as null."""
    value = text.try_cast("double")
    return F.when(~F.isnan(value), value)


def level_height(height: Column, levels: Column) -> Column:
    """Metres of a building's tags: the height without any m, else levels of 3.5 m; below 2.5 m it counts as none."""
    own = number(F.trim(F.replace(height, F.lit("m"), F.lit(""))))
    found = F.coalesce(own, number(levels) * FLOOR_M)
    return F.when(found >= 2.5, found)


def import_height(height: Column, levels: Column) -> Column:
    """Metres as the importer reads them: a positive plain number, else positive levels of 3.5 m, else 0."""
    own, floors = number(height), number(levels)
    return F.when(own > 0, own).when(floors > 0, floors * FLOOR_M).otherwise(F.lit(0.0))


def real_height(height: Column, floors: Column) -> Column:
    """The provider's height if positive, else its floors, else 0."""
    return F.when(height > 0, height).when(floors > 0, floors * FLOOR_M).otherwise(F.lit(0.0))


def building_class(subtype: Column, kind: Column) -> Column:
    """The first that isn't empty of subtype and class, else building."""
    return F.coalesce(F.nullif(subtype, F.lit("")), F.nullif(kind, F.lit("")), F.lit("building"))


def lane_count(text: Column) -> Column:
    return F.coalesce(F.trim(text).try_cast("int"), F.lit(0))


def width_m(text: Column) -> Column:
    return F.coalesce(number(F.trim(F.replace(text, F.lit("m"), F.lit("")))), F.lit(0.0))


def map_centre(url: Column) -> Column:
    """struct(lat, lon, zoom) of a map's address: /@lat,lon,zoomz, else ll=, else q= with zoom 14; null if none fits."""
    found = F.lit(None).cast("struct<lat:double,lon:double,zoom:double>")
    for pattern, zoomed in MAP_ADDRESSES:
        part = lambda k: F.regexp_extract(url, pattern, k).try_cast("double")  # noqa: E731, B023
        zoom = part(3) if zoomed else F.lit(14.0)
        found = F.when(F.regexp_like(url, F.lit(pattern)), F.struct(part(1).alias("lat"), part(2).alias("lon"), zoom.alias("zoom"))).otherwise(found)
    return found


def tile_parts(tile_id: Column) -> Column:
    """struct(zone, northern, easting, northing) of a tile's id; null unless it is well formed, aligned and 1 km wide."""
    part = lambda k: F.regexp_extract(tile_id, TILE_ID, k)
    zone, east, north, size = (part(k).try_cast("long") for k in (1, 3, 4, 5))
    good = F.regexp_like(tile_id, F.lit(TILE_ID)) & zone.between(1, 60) & (size == TILE_M) & (east % TILE_M == 0) & (north % TILE_M == 0)
    return F.when(good, F.struct(zone.cast("int").alias("zone"), (part(2) == "n").alias("northern"), east.alias("easting"), north.alias("northing")))


def tile_id(zone: Column, northern: Column, easting: Column, northing: Column) -> Column:
    return F.format_string("z%d%s_e%d_n%d_s%d", zone.cast("int"), F.when(northern, "n").otherwise("s"), easting.cast("long"), northing.cast("long"), F.lit(TILE_M))
