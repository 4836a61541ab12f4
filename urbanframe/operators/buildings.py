"""Cleaning, deduplication and heights of building footprints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from urbanframe.functions.geometry import area, bounds, let, unique_points
from urbanframe.functions.projection import DEGREE_M_ROUND
from urbanframe.operators.spatial import nearest

#: Fixed values of the cleaning rules: square metres, metres.
LEAST_AREA, MOST_HEIGHT, DUPLICATE_M, ENRICH_M, PROVIDER_M = 5.0, 600.0, 3.0, 8.0, 50.0
TYPES = ("Polygon", "MultiPolygon")
#: Floors by footprint area, and metres of a floor by class.
FLOORS_BELOW = ((60, 1), (150, 2), (400, 3), (1000, 4), (3000, 6))
FLOORS_ELSE = 8
FLOOR_BY_CLASS = {
    "residential": 2.9, "apartments": 2.9, "house": 2.9, "terrace": 2.9, "dormitory": 2.9,
    "commercial": 3.5, "retail": 3.5, "office": 3.5, "hotel": 3.4, "hospital": 3.6, "school": 3.5, "education": 3.5,
    "civic": 3.6, "government": 3.6, "public": 3.6,
    "industrial": 4.5, "warehouse": 4.5,
}
ONE_FLOOR, ONE_FLOOR_M = ("carport", "garage", "shed", "roof"), 2.5


def reject_reason(geom_type: Column, outer_rings: Column) -> Column:
    """null for a good footprint, else the first of null_geom, degenerate and tiny; outer_rings are planar metres."""

    def of(opened: Column) -> Column:
        good = F.exists(opened, lambda r: F.size(r) >= 3)
        total = F.aggregate(F.transform(opened, area), F.lit(0.0), lambda a, x: a + x)
        return (
            F.when(geom_type.isNull() | ~geom_type.isin(*TYPES) | opened.isNull(), "null_geom")
            .when(~F.coalesce(good, F.lit(False)), "degenerate")
            .when(total < LEAST_AREA, "tiny")
        )

    return let(F.transform(outer_rings, unique_points), of)


def clean_height(raw: Column) -> tuple[Column, Column]:
    """(height, height_source): null and what isn't positive become 0, to be estimated; the rest ends at 600 m."""
    good = F.coalesce(raw > 0, F.lit(False)) & ~F.isnan(raw)
    return F.when(good, F.least(raw, F.lit(MOST_HEIGHT))).otherwise(F.lit(0.0)), F.when(good, "overture").otherwise("estimated_pending")


def clean_buildings(df: DataFrame) -> DataFrame:
    """Adds reject_reason, height and height_source to buildings (fid, geom_type, outer, raw_height, others)."""
    height, source = clean_height(F.col("raw_height"))
    return df.withColumns({"reject_reason": reject_reason(F.col("geom_type"), F.col("outer")), "height": height, "height_source": source})


def cleaning_report(cleaned: DataFrame) -> DataFrame:
    """One row of counters."""
    n = lambda c: F.count_if(c).alias
    reason, kept = F.col("reject_reason"), F.col("reject_reason").isNull()
    return cleaned.agg(
        F.count("*").alias("n_in"),
        n(reason == "null_geom")("null_geom"),
        n(reason == "degenerate")("degenerate"),
        n(reason == "tiny")("tiny"),
        n(kept)("n_out"),
        n(kept & (F.col("height_source") == "estimated_pending"))("pending"),
        n(kept & (F.col("raw_height") > MOST_HEIGHT))("clamped"),
    )


def footprint_floors(square_m: Column) -> Column:
    out = F.lit(FLOORS_ELSE)
    for limit, floors in reversed(FLOORS_BELOW):
        out = F.when(square_m < limit, floors).otherwise(out)
    return out.cast("double")


def procedural_height(height: Column, square_m: Column, kind: Column, noise: Column) -> Column:
    """Heights near 10 or 8 m and those not above 0 are estimates' triggers: floors by area plus noise, times class metres."""
    floors = F.least(F.lit(15.0), F.greatest(F.lit(1.0), footprint_floors(square_m) + noise))
    metres = F.when(square_m > 2000, 4.5).when(square_m > 500, 3.5).otherwise(2.9)
    for name, m in FLOOR_BY_CLASS.items():
        metres = F.when(kind == name, m).otherwise(metres)
    estimate = F.when(kind.isin(*ONE_FLOOR), F.lit(ONE_FLOOR_M)).otherwise(floors * metres)
    return F.when((F.abs(height - 10) < 0.1) | (F.abs(height - 8) < 0.1) | (height <= 0), estimate).otherwise(height)


def hash_noise(*keys: Column) -> Column:
    """A value from -1.5 to 1.5 that depends on the keys only."""
    return F.pmod(F.xxhash64(*keys), F.lit(3001)) / 1000.0 - 1.5


def second_heights(buildings: DataFrame, survey: DataFrame, reach_m: float = PROVIDER_M) -> DataFrame:
    """(id, height, real, provider) of buildings (id, lon, lat, raw_height): those without a real height take a second provider's.

    Only they are looked for in the survey (id, lon, lat, height): the nearest row within reach, in degrees times a fixed
    value; of ties the least id. Its height counts as real, whatever it is. Others without a height have 0. Rows with a
    null place meet nothing.
    """
    real = F.coalesce(F.col("raw_height") > 0, F.lit(False))
    near = nearest(buildings.filter(~real).select("id", "lon", "lat"), survey.select("id", "lon", "lat"), reach_m / DEGREE_M_ROUND, ("id", "lon", "lat"))
    found = near.join(survey.select(F.col("id").alias("right_id"), "height"), "right_id").select(F.col("left_id").alias("id"), F.coalesce("height", F.lit(0.0)).alias("second"))
    out = buildings.join(found, "id", "left")
    second = ~real & F.col("second").isNotNull()
    return out.select("id", F.when(real, F.col("raw_height")).otherwise(F.coalesce("second", F.lit(0.0))).alias("height"), (real | second).alias("real"), F.when(real, "first").when(second, "second").alias("provider"))


def outline_extent(buildings: DataFrame) -> DataFrame:
    """One row: the extent of the first rings of buildings (outer array of rings), and how many there are with one; null without any."""
    b = buildings.select(bounds(F.try_element_at("outer", F.lit(1))).alias("b"))
    side = lambda f, c: f(f"b.{c}").alias(c)
    return b.agg(F.count("b.min_x").alias("n"), side(F.min, "min_x"), side(F.min, "min_y"), side(F.max, "max_x"), side(F.max, "max_y"))
