"""Queries on the building layer, projections and spatial joins."""

from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from urbanframe.functions import geometry as G, parsing as P, projection as PR
from urbanframe.functions.sql import register
from urbanframe.operators import buildings as B, overlay as OV, quality as Q, spatial as S
from urbanframe.plans.layers import ORIGIN, cte, layer, planar, planar_sql, table
from urbanframe.plans.sqltext import Sql, Text
from urbanframe.sources.geojson import coverage, split_collections

NEAR_M = B.ENRICH_M


def _squares(*dx: float):
    """Closed rings around the planar centre, each moved by its dx; a side of 0 gives equal points. The projection is worked out once."""
    point = lambda r, d, a, b: F.struct((r["x"] + d + a * (r["side"] / 2)).alias("x"), (r["z"] + b * (r["side"] / 2)).alias("y"))
    ring = lambda r, d: F.array(*(point(r, d, a, b) for a, b in ((-1, -1), (1, -1), (1, 1), (-1, 1), (-1, -1))))
    return G.let(F.struct("x", "z", "side"), lambda r: F.array(*(ring(r, d) for d in dx)))


def _square():
    return F.element_at(_squares(0.0), 1)


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    bld = planar(layer(spark, sf_dir, "bld"))
    both = _squares(0.0, 20.0)
    outer = F.slice(both, F.lit(1), F.when(F.col("geom_type") == "MultiPolygon", 2).otherwise(1))
    return B.clean_buildings(bld.withColumn("outer", outer))


_CLEAN = (
    cte("bld")
    + """, c AS (
SELECT *, side * side * CASE WHEN geom_type = 'MultiPolygon' THEN 2 ELSE 1 END AS square_m,
       CASE WHEN raw_height > 0 THEN least(raw_height, 600) ELSE 0 END AS height,
       CASE WHEN raw_height > 0 THEN 'overture' ELSE 'estimated_pending' END AS height_source FROM bld),
cleaned AS (
SELECT *, CASE WHEN geom_type IS NULL OR geom_type = 'Point' THEN 'null_geom' WHEN side = 0 THEN 'degenerate' WHEN square_m < 5 THEN 'tiny' END AS reject_reason FROM c)
"""
)


def bld_clean_report(spark, sf_dir):
    return B.cleaning_report(cleaned(spark, sf_dir))


def bld_clean_rows(spark, sf_dir):
    return cleaned(spark, sf_dir).select("fid", "reject_reason", "height", "height_source")


def bld_height_provenance(spark, sf_dir):
    return cleaned(spark, sf_dir).filter("reject_reason IS NULL").groupBy("height_source").agg(F.count("*").alias("n"), F.round(F.avg("height"), 6).alias("mean_height"))


def contract_checks(spark, sf_dir):
    return Q.building_checks(cleaned(spark, sf_dir).filter("reject_reason IS NULL"))


def retention_check(spark, sf_dir):
    one = B.cleaning_report(cleaned(spark, sf_dir))
    ratio, status = Q.retention(F.col("n_in"), F.col("n_out"))
    return one.select("n_in", "n_out", F.round(ratio, 6).alias("ratio"), status.alias("status"))


def height_anomaly(spark, sf_dir):
    out = Q.height_anomalies(cleaned(spark, sf_dir))
    return out.withColumn("mean_height", F.round("mean_height", 6))


def utm_project(spark, sf_dir):
    e, n = PR.to_utm(F.col("lon"), F.col("lat"), 47)
    return layer(spark, sf_dir, "bld").select("fid", PR.zone_number(F.col("lon")).cast("long").alias("zone"), F.round(e, 3).alias("easting"), F.round(n, 3).alias("northing"))


_E, _N = (str(v) for v in PR.to_utm(Text("lon"), Text("lat"), 47, Sql))
_EZ, _NZ = (str(v) for v in PR.to_utm(Text("lon"), Text("lat"), Text("zone"), Sql))
_LON, _LAT = (str(v) for v in PR.from_utm(Text("e"), Text("n"), 47, True, Sql))


def utm_inverse(spark, sf_dir):
    e, n = PR.to_utm(F.col("lon"), F.col("lat"), 47)
    lon, lat = PR.from_utm(F.col("e"), F.col("n"), 47)
    return layer(spark, sf_dir, "bld").select("fid", F.round(e, 2).alias("e"), F.round(n, 2).alias("n")).select("fid", F.round(lon, 7).alias("lon"), F.round(lat, 7).alias("lat"))


def local_scene(spark, sf_dir):
    return planar(layer(spark, sf_dir, "bld")).select("fid", F.round("x", 3).alias("x"), F.round(-F.col("z"), 3).alias("scene_z"))


def box_sizes(spark, sf_dir):
    w, h = PR.box_size(*(F.col(c) for c in ("west", "south", "east", "north")))
    return layer(spark, sf_dir, "clips").select("id", F.round(w, 3).alias("width_m"), F.round(h, 3).alias("height_m"))


def centre_boxes(spark, sf_dir):
    base = layer(spark, sf_dir, "bld").withColumn("km", PR.zoom_radius_km(F.lit(10) + F.col("fid") % 8))
    sides = PR.box_around(F.col("lon"), F.col("lat"), F.col("km"))
    return base.select("fid", "km", *(F.round(v, 7).alias(c) for v, c in zip(sides, ("west", "south", "east", "north"), strict=True)))


def _ring():
    """An open five-cornered ring that is wound by the row's number."""
    corners = ((0.0, 0.0), (2.0, 0.0), (2.0, 1.0), (1.0, 1.5), (0.0, 1.0))
    at = lambda r, a, b: F.struct((r["x"] + a * (r["side"] + 1)).alias("x"), (r["z"] + b * (r["side"] + 1)).alias("y"))
    ring = G.let(F.struct("x", "z", "side"), lambda r: F.array(*(at(r, a, b) for a, b in corners)))
    return G.let(ring, lambda r: F.when(F.col("fid") % 2 == 0, r).otherwise(F.reverse(r)))


_RING = cte("bld") + f""", p AS (SELECT *, side + 1 AS s, CASE WHEN fid % 2 = 0 THEN 1 ELSE -1 END AS turn FROM {planar_sql('bld')})"""


_SQL_FUNCTIONS = """
SELECT fid, round(abs(ring_signed_area(ring)), 3) AS square_m, round(ring_signed_area(reverse(ring)), 3) AS turned,
       ring_contains(ring, x + 1.5D * s, z + element_at(array(0.5D, 1.3D, 1.2D, -0.1D), CAST(fid % 4 AS INT) + 1) * s) AS inside,
       round(crossing_first(x, z, x + 2 * s, z, x + fid % 5 * 0.4D * s, z - s, x + fid % 5 * 0.4D * s, z + s), 6) AS share,
       round(utm_easting(lon, lat, 47), 3) AS easting, round(utm_northing(lon, lat, 47), 3) AS northing, utm_zone(lon) AS zone,
       round(utm_lon(utm_easting(lon, lat, 47), utm_northing(lon, lat, 47), 47, true), 6) AS lon_back
FROM (SELECT *, array(named_struct('x', x, 'y', z), named_struct('x', x + 2 * s, 'y', z), named_struct('x', x + 2 * s, 'y', z + s),
                      named_struct('x', x + s, 'y', z + 1.5D * s), named_struct('x', x, 'y', z + s)) AS ring
      FROM (SELECT *, side + 1 AS s FROM {rows}))"""


def sql_functions(spark, sf_dir):
    """Areas, containment, crossings and projections by their SQL names."""
    register(spark)
    return spark.sql(_SQL_FUNCTIONS, rows=planar(layer(spark, sf_dir, "bld")).select("fid", "lon", "lat", "side", "x", "z"))


def _packed(batches):
    """Every third file (path, text) becomes an archive, every eleventh is cut short."""
    for batch in batches:
        content = []
        for k, text in zip(batch["k"], batch["text"], strict=True):
            data = text.encode()
            if k % 3 == 0:
                with zipfile.ZipFile(out := io.BytesIO(), "w", zipfile.ZIP_DEFLATED) as z:
                    z.writestr("readme.txt", "x")
                    z.writestr("part.geojson", data)
                data = out.getvalue()
            content.append(data[: len(data) // 2] if k % 11 == 0 else data)
        yield pd.DataFrame({"path": batch["k"].astype(str), "content": content})


def collection_coverage(spark, sf_dir):
    """Coverage of collections of 500 buildings, some of them zipped and some damaged."""
    point = F.concat(F.lit('{"type":"Point","coordinates":['), F.col("lon").cast("string"), F.lit(","), F.col("lat").cast("string"), F.lit("]}"))
    feature = F.concat(F.lit('{"geometry":'), F.when(F.col("geom_type").isNull(), "null").otherwise(point), F.lit(',"properties":{"height":'), F.coalesce(F.col("raw_height").cast("string"), F.lit('""')), F.lit("}}"))
    files = layer(spark, sf_dir, "bld").groupBy(F.floor(F.col("fid") / 500).alias("k")).agg(F.concat_ws(",", F.collect_list(feature)).alias("text"))
    files = files.withColumn("text", F.concat(F.lit('{"features":['), "text", F.lit("]}")))
    return coverage(split_collections(files.mapInPandas(_packed, "path string, content binary")))


def ring_area(spark, sf_dir):
    return planar(layer(spark, sf_dir, "bld")).select("fid", F.round(G.area(_ring()), 3).alias("square_m"))


def ring_square_m(spark, sf_dir):
    """Areas of slanted quads in degrees, some of them in other zones, south, or across the equator."""
    k = F.col("fid") % 5
    rows = layer(spark, sf_dir, "bld").select("fid", (F.col("lon") - k * 40).alias("lon"), F.when(k == 4, 0.0).otherwise(F.col("lat") * (1 - k)).alias("lat"), (F.col("side") * 1e-5).alias("s"))
    at = lambda a, b: F.struct((F.col("lon") + a * F.col("s")).alias("x"), (F.col("lat") + b * F.col("s")).alias("y"))
    ring = F.array(at(0.0, -1.0), at(2.0, 0.0), at(1.0, 2.0), at(-1.0, 1.0))
    return rows.select("fid", F.round(PR.ring_square_m(F.when(F.col("fid") % 13 == 0, F.slice(ring, 1, 2)).otherwise(ring)), 3).alias("square_m"))


def winding(spark, sf_dir):
    rows = planar(layer(spark, sf_dir, "bld")).withColumn("ring", _ring())
    return rows.select("fid", F.round(G.signed_area(F.col("ring")), 3).alias("signed"), F.round(G.signed_area(G.wound(F.col("ring"))), 3).alias("after"))


def ring_centroids(spark, sf_dir):
    rows = planar(layer(spark, sf_dir, "bld")).withColumns({"a": G.area_centroid(_ring()), "v": G.vertex_mean(_ring()), "b": G.bounds(_ring())})
    r = lambda c, n: F.round(F.col(c), 2).alias(n)
    return rows.select("fid", r("a.x", "ax"), r("a.y", "az"), r("v.x", "vx"), r("v.y", "vz"), r("b.max_x", "max_x"), r("b.min_y", "min_z"))


def centroid_in_box(spark, sf_dir):
    return planar(layer(spark, sf_dir, "bld")).filter(G.inside(G.area_centroid(_ring()), -2500, -3200, 1000, -1500)).select("fid")


def centroid_delete_flag(spark, sf_dir):
    v = F.col("v")
    rows = planar(layer(spark, sf_dir, "bld")).withColumn("v", G.vertex_mean(_ring()))
    return rows.select("fid", (~(v["x"].between(-2500, 1000) & v["y"].between(-3200, -1500))).alias("deleted"))


def points_in_box(spark, sf_dir):
    margin = 0.001
    return layer(spark, sf_dir, "bld").filter(F.col("lon").between(100.842 - margin, 100.845 + margin) & F.col("lat").between(12.891 - margin, 12.892 + margin)).select("fid")


def _split(spark, sf_dir):
    bld = planar(layer(spark, sf_dir, "bld")).select(F.col("fid").alias("id"), "x", F.col("z").alias("y"), "raw_height", "lon", "lat")
    return bld.filter("id % 7 <> 0"), bld.filter("id % 7 = 0")


_SPLIT = cte("bld") + f""", p AS (SELECT fid AS id, x, z AS y, raw_height, lon, lat FROM {planar_sql('bld')}),
l AS (SELECT * FROM p WHERE id % 7 <> 0), o AS (SELECT * FROM p WHERE id % 7 = 0)
"""


def nearest_height(spark, sf_dir):
    left, right = _split(spark, sf_dir)
    out = S.nearest(left, right, NEAR_M)
    return out.select("left_id", "right_id", F.round("distance", 3).alias("distance"))


def enriched_heights(spark, sf_dir):
    """Heights with their source: a near survey replaces what is missing or estimated."""
    left, right = _split(spark, sf_dir)
    survey = right.select(F.col("id").alias("right_id"), (F.col("id") % 40 + 3).cast("double").alias("survey_m"))
    joined = left.join(S.nearest(left, right, NEAR_M).withColumnRenamed("left_id", "id"), "id", "left").join(survey, "right_id", "left")
    pending = ~F.coalesce(F.col("raw_height") > 0, F.lit(False))
    return joined.select(
        "id",
        F.when(pending & F.col("survey_m").isNotNull(), F.col("survey_m")).when(pending, 0.0).otherwise(F.least("raw_height", F.lit(600.0))).alias("height"),
        F.when(pending & F.col("survey_m").isNotNull(), "osm").when(pending, "estimated_pending").otherwise("overture").alias("height_source"),
    )


def nearest_degrees(spark, sf_dir):
    """Nearest within 50 m, in degrees times 111319, without the cosine of the latitude."""
    left, right = _split(spark, sf_dir)
    deg = 50 / PR.DEGREE_M_ROUND
    out = S.nearest(left, right, deg, ("id", "lon", "lat"))
    return out.select("left_id", "right_id", F.round(F.col("distance") * PR.DEGREE_M_ROUND, 2).alias("metres"))


def second_heights(spark, sf_dir):
    """Heights of a second provider for the buildings without a real one."""
    left, right = _split(spark, sf_dir)
    out = B.second_heights(left, right.withColumn("height", (F.col("id") % 9).cast("double")))
    return out.select("id", "height", "real", "provider")


def pairs_within(spark, sf_dir):
    left, _ = _split(spark, sf_dir)
    return S.within_distance(left, left, 3.0, strict=True).filter("left_id < right_id").select("left_id", "right_id")


def bld_dedup(spark, sf_dir):
    rows = planar(layer(spark, sf_dir, "bld"))
    return S.dedup_within(rows.select(F.col("fid").alias("id"), "x", F.col("z").alias("y")), B.DUPLICATE_M)


def cover_anti(spark, sf_dir):
    left, right = _split(spark, sf_dir)
    return S.uncovered(left, right, 15.0, whole=False)


def cover_add(spark, sf_dir):
    left, right = _split(spark, sf_dir)
    return S.uncovered(left, right, 15.0)


def _targets(spark, sf_dir):
    t = table(spark, sf_dir, "customer")
    return t.selectExpr("c_custkey AS id", "100.84e0 + c_custkey % 17 * 2e-3 AS west", "12.87e0 + c_custkey % 19 * 1e-3 AS south", "100.85e0 + c_custkey % 17 * 2e-3 AS east", "12.88e0 + c_custkey % 19 * 1e-3 AS north")


_TARGETS = cte("clips") + """, t AS (
SELECT c_custkey AS id, 100.84e0 + c_custkey % 17 * 2e-3 AS west, 12.87e0 + c_custkey % 19 * 1e-3 AS south, 100.85e0 + c_custkey % 17 * 2e-3 AS east, 12.88e0 + c_custkey % 19 * 1e-3 AS north
FROM customer),
j AS (SELECT t.id AS target, c.id AS cover, (c.east - c.west) * (c.north - c.south) AS size FROM t LEFT JOIN clips c
      ON c.west <= t.west AND c.south <= t.south AND c.east >= t.east AND c.north >= t.north)
"""


def smallest_cover(spark, sf_dir):
    return S.smallest_cover(_targets(spark, sf_dir), layer(spark, sf_dir, "clips"))


def first_cover(spark, sf_dir):
    return S.smallest_cover(_targets(spark, sf_dir), layer(spark, sf_dir, "clips"), order=["id"])


def segment_hits(spark, sf_dir):
    return S.segment_crossings(layer(spark, sf_dir, "segments"), limit=None, digits=(4, 3))


def _diamonds(spark, sf_dir, centre_x: str, centre_y: str, size: str, hole: float = 0.0):
    """Squares on their tips around each customer's place, with a hole of a part of their size."""
    c = table(spark, sf_dir, "customer").selectExpr("c_custkey AS zone", f"{centre_x} AS cx", f"{centre_y} AS cy", f"{size} AS s")
    at = lambda a, b, k: F.struct((F.col("cx") + a * k * F.col("s")).alias("x"), (F.col("cy") + b * k * F.col("s")).alias("y"))
    ring = lambda k: F.array(at(0.0, -1.0, k), at(1.0, 0.0, k), at(0.0, 1.0, k), at(-1.0, 0.0, k))
    return c.select("zone", F.array(ring(1.0), *([ring(hole)] if hole else [])).alias("parts"))


def pip_mask(spark, sf_dir):
    rings = _diamonds(spark, sf_dir, "CAST(c_custkey * 7919 % 48 AS DOUBLE)", "CAST(c_custkey * 104729 % 38 AS DOUBLE)", "0.7003e0 + c_custkey % 3")
    return OV.covered_points(layer(spark, sf_dir, "points").select("id", "x", F.col("z").alias("y")), rings)


def zonal_polygons(spark, sf_dir):
    """Mean in time of each half-metre cell, then over the cells in slanted zones with holes that were present more than half of the time."""
    cells = layer(spark, sf_dir, "points").withColumn("present", (F.col("kind") != "error").cast("int"))
    by_cell = cells.groupBy(F.floor(F.col("x") * 2).alias("c"), F.floor(F.col("z") * 2).alias("r")).agg(F.avg("value").alias("value"), F.avg("present").alias("p"))
    centres = by_cell.filter("p > 0.5").select(((F.col("c") + 0.5) / 2).alias("x"), ((F.col("r") + 0.5) / 2).alias("y"), "value")
    zones = _diamonds(spark, sf_dir, "CAST(c_custkey * 31 % 48 AS DOUBLE)", "CAST(c_custkey * 17 % 38 AS DOUBLE)", "2.1003e0 + c_custkey % 7 * 1.5e0", 0.4)
    out = OV.zone_totals(centres, zones)
    return out.select("zone", F.col("n").alias("cells"), F.round(F.col("total") / F.col("n"), 9).alias("mean_value"))


def zonal_mean(spark, sf_dir):
    """Mean in time for each cell, then mean of the cells in a zone with more than half of them present."""
    cells = layer(spark, sf_dir, "points").withColumn("present", (F.col("kind") != "error").cast("int"))
    by_cell = cells.groupBy(F.floor("x").alias("c"), F.floor("z").alias("r")).agg(F.avg("value").alias("v"), F.avg("present").alias("p"))
    zones = by_cell.filter("p > 0.5").groupBy(F.floor(F.col("c") / 10).alias("zone_c"), F.floor(F.col("r") / 10).alias("zone_r"))
    return zones.agg(F.round(F.avg("v"), 6).alias("mean_value"), F.count("*").alias("cells"))


def procedural_heights(spark, sf_dir):
    rows = cleaned(spark, sf_dir).filter("reject_reason IS NULL")
    noise = F.col("fid") % 31 / 10.0 - 1.5
    height = B.procedural_height(F.col("height"), F.col("side") * F.col("side") * 30, F.col("subtype"), noise)
    return rows.select("fid", F.round(height, 4).alias("height"))


def _kinds() -> str:
    return " ".join(f"WHEN subtype = '{k}' THEN {v}" for k, v in B.FLOOR_BY_CLASS.items())


def tag_heights(spark, sf_dir):
    """The two height parsers on the same tags."""
    rows = table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS fid",
        "CASE p_partkey % 6 WHEN 0 THEN concat(p_size, ' m') WHEN 1 THEN 'abc' WHEN 2 THEN CAST(p_size AS STRING) WHEN 3 THEN '2.0' END AS height",
        "CASE p_partkey % 4 WHEN 0 THEN CAST(p_size % 9 AS STRING) WHEN 1 THEN 'x' END AS levels",
    )
    h, v = F.col("height"), F.col("levels")
    return rows.select("fid", P.level_height(h, v).alias("level_height"), P.import_height(h, v).alias("import_height"))


def class_heights(spark, sf_dir):
    rows = layer(spark, sf_dir, "bld").withColumn("floors", (F.col("fid") % 5).cast("double"))
    return rows.select("fid", P.real_height(F.col("raw_height"), F.col("floors")).alias("height"), P.building_class(F.col("subtype"), F.col("kind")).alias("kind"))


def layer_extent(spark, sf_dir):
    return layer(spark, sf_dir, "bld").agg(*(F.round(f(c), 7).alias(f"{n}_{c}") for c in ("lon", "lat") for n, f in (("min", F.min), ("max", F.max), ("mean", F.avg))))


def outline_extent(spark, sf_dir):
    out = B.outline_extent(cleaned(spark, sf_dir).filter("reject_reason IS NULL"))
    return out.select("n", *(F.round(c, 3).alias(c) for c in ("min_x", "min_y", "max_x", "max_y")))


def box_overlap(spark, sf_dir):
    """Boxes that touch a viewport, edges included."""
    return layer(spark, sf_dir, "clips").filter("west <= 100.9e0 AND east >= 100.89e0 AND south <= 12.93e0 AND north >= 12.9e0").select("id")


def largest_ring(spark, sf_dir):
    """The ring of the largest area of each multi-part footprint, by place and area."""
    wider = lambda k: F.transform(_square(), lambda p: F.struct((p["x"] * (1 + k * 0.5)).alias("x"), p["y"].alias("y")))
    rings = F.array(wider(0), wider(2), wider(1))
    ranked = F.transform(rings, lambda r, i: F.struct(F.round(G.area(G.unique_points(r)), 3).alias("square_m"), (-i).alias("order")))
    return planar(layer(spark, sf_dir, "bld")).withColumn("best", F.array_max(ranked)).select("fid", F.col("best.square_m").alias("square_m"), (-F.col("best.order")).cast("long").alias("place"))


QUERIES = {
    f.__name__: f
    for f in (
        bld_clean_report, bld_clean_rows, bld_height_provenance, contract_checks, retention_check, height_anomaly, utm_project,
        utm_inverse, local_scene, box_sizes, centre_boxes, sql_functions, collection_coverage, ring_area, winding, ring_centroids, centroid_in_box,
        centroid_delete_flag, points_in_box, nearest_height, enriched_heights, nearest_degrees, second_heights, ring_square_m, outline_extent, pairs_within, bld_dedup, cover_anti,
        cover_add, smallest_cover, first_cover, segment_hits, pip_mask, zonal_polygons, zonal_mean, procedural_heights, tag_heights,
        class_heights, layer_extent, box_overlap, largest_ring,
    )
}

_NEAR = "ranked AS (SELECT l.id AS left_id, o.id AS right_id, {d} AS d, row_number() OVER (PARTITION BY l.id ORDER BY {d}, o.id) AS r FROM l JOIN o ON {d} <= {limit})"
_XY = "sqrt((l.x - o.x) * (l.x - o.x) + (l.y - o.y) * (l.y - o.y))"
_DEG = "sqrt((l.lon - o.lon) * (l.lon - o.lon) + (l.lat - o.lat) * (l.lat - o.lat))"
_BLOCK = "abs(CAST(trunc({a}.x / 15) AS BIGINT) - CAST(trunc({b}.x / 15) AS BIGINT)) <= 1 AND abs(CAST(trunc({a}.y / 15) AS BIGINT) - CAST(trunc({b}.y / 15) AS BIGINT)) <= 1"

ORACLE_SQL = {
    "bld_clean_report": _CLEAN + """SELECT count(*) AS n_in, count(*) FILTER (reject_reason = 'null_geom') AS null_geom, count(*) FILTER (reject_reason = 'degenerate') AS degenerate,
count(*) FILTER (reject_reason = 'tiny') AS tiny, count(*) FILTER (reject_reason IS NULL) AS n_out,
count(*) FILTER (reject_reason IS NULL AND height_source = 'estimated_pending') AS pending, count(*) FILTER (reject_reason IS NULL AND raw_height > 600) AS clamped FROM cleaned""",
    "bld_clean_rows": _CLEAN + "SELECT fid, reject_reason, CAST(height AS DOUBLE) AS height, height_source FROM cleaned",
    "bld_height_provenance": _CLEAN + "SELECT height_source, count(*) AS n, round(avg(height), 6) AS mean_height FROM cleaned WHERE reject_reason IS NULL GROUP BY 1",
    "contract_checks": _CLEAN + """, n AS (SELECT count(*) AS n, count(*) FILTER (height_source <> 'estimated_pending') AS real, count(*) FILTER (height_source = 'estimated_pending') AS pending FROM cleaned WHERE reject_reason IS NULL)
SELECT 'bld_height_present' AS "check", 'pass' AS status, '0 of ' || n || ' without height' AS message FROM n
UNION ALL SELECT 'bld_height_source', 'pass', real || ' real, ' || pending || ' pending, 0 bad' FROM n""",
    "retention_check": _CLEAN + """, r AS (SELECT count(*) AS n_in, count(*) FILTER (reject_reason IS NULL) AS n_out FROM cleaned)
SELECT n_in, n_out, round(n_out / n_in, 6) AS ratio, CASE WHEN n_out / n_in < 0.5 OR n_out / n_in > 0.995 THEN 'warn' ELSE 'pass' END AS status FROM r""",
    "height_anomaly": _CLEAN + """SELECT count(*) AS n, CAST(min(height) AS DOUBLE) AS min_height, round(avg(height), 6) AS mean_height, CAST(max(height) AS DOUBLE) AS max_height,
CASE WHEN count(*) = 0 THEN 'empty' WHEN bool_and(height = 10) THEN 'all_default' WHEN avg(height) < 0.5 THEN 'near_zero' ELSE 'none' END AS anomaly FROM cleaned""",
    "utm_project": cte("bld") + f" SELECT fid, CAST(trunc((lon + 180) / 6) AS BIGINT) + 1 AS zone, round({_E}, 3) AS easting, round({_N}, 3) AS northing FROM bld",
    "utm_inverse": cte("bld") + f", m AS (SELECT fid, round({_E}, 2) AS e, round({_N}, 2) AS n FROM bld) SELECT fid, round({_LON}, 7) AS lon, round({_LAT}, 7) AS lat FROM m",
    "local_scene": cte("bld") + f" SELECT fid, round(x, 3) AS x, round(-z, 3) AS scene_z FROM {planar_sql('bld')}",
    "box_sizes": cte("clips") + " SELECT id, round((east - west) * 111319.9e0 * cos(radians((south + north) / 2)), 3) AS width_m, round((north - south) * 111319.9e0, 3) AS height_m FROM clips",
    "centre_boxes": cte("bld") + """, k AS (SELECT *, greatest(1e0, least(10e0, pow(2e0, 15 - (10 + fid % 8)))) AS km FROM bld)
SELECT fid, km, round(lon - km / (111.32e0 * cos(radians(lat))), 7) AS west, round(lat - km / 111.32e0, 7) AS south,
round(lon + km / (111.32e0 * cos(radians(lat))), 7) AS east, round(lat + km / 111.32e0, 7) AS north FROM k""",
    "sql_functions": _RING + f""" SELECT fid, round(s * s * 2.5e0, 3) AS square_m, round(-s * s * 2.5e0, 3) AS turned, fid % 4 IN (0, 2) AS inside, round(fid % 5 * 0.2e0, 6) AS share,
round({_E}, 3) AS easting, round({_N}, 3) AS northing, 47 AS zone, round(lon, 6) AS lon_back FROM p""",
    "collection_coverage": cte("bld") + """, g AS (SELECT fid // 500 AS k, count(*) AS n, count(raw_height) AS h, count(geom_type) AS g FROM bld GROUP BY 1)
SELECT CAST(k AS VARCHAR) AS path, CASE WHEN k % 11 = 0 THEN 0 ELSE n END AS n, CASE WHEN k % 11 = 0 THEN 0 ELSE h END AS with_field, CASE WHEN k % 11 <> 0 THEN 100 * h // n END AS share,
CASE WHEN k % 11 = 0 THEN 0 ELSE g END AS with_geometry, CASE WHEN k % 11 = 0 OR g = 0 THEN 'fail' ELSE 'pass' END AS status FROM g""",
    "ring_area": _RING + " SELECT fid, round(s * s * 2.5e0, 3) AS square_m FROM p",
    "winding": _RING + " SELECT fid, round(turn * s * s * 2.5e0, 3) AS signed, round(-s * s * 2.5e0, 3) AS after FROM p",
    # a rectangle of 2 x 1 and a triangle of half a unit on its top
    "ring_centroids": _RING + """ SELECT fid, round(x + s * 1e0, 2) AS ax, round(z + s * (2 * 0.5e0 + 0.5e0 * (1 + 0.5e0 / 3)) / 2.5e0, 2) AS az,
round(x + s * 1e0, 2) AS vx, round(z + s * 0.7e0, 2) AS vz, round(x + 2 * s, 2) AS max_x, round(z, 2) AS min_z FROM p""",
    "centroid_in_box": _RING + " SELECT fid FROM p WHERE x + s > -2500 AND x + s < 1000 AND z + s * (1 + 0.5e0 * (1 + 0.5e0 / 3)) / 2.5e0 > -3200 AND z + s * (1 + 0.5e0 * (1 + 0.5e0 / 3)) / 2.5e0 < -1500",
    "centroid_delete_flag": _RING + " SELECT fid, NOT (x + s BETWEEN -2500 AND 1000 AND z + s * 0.7e0 BETWEEN -3200 AND -1500) AS deleted FROM p",
    "points_in_box": cte("bld") + " SELECT fid FROM bld WHERE lon BETWEEN 100.842e0 - 0.001e0 AND 100.845e0 + 0.001e0 AND lat BETWEEN 12.891e0 - 0.001e0 AND 12.892e0 + 0.001e0",
    "nearest_height": _SPLIT + "," + _NEAR.format(d=_XY, limit="8") + " SELECT left_id, right_id, round(d, 3) AS distance FROM ranked WHERE r = 1",
    "enriched_heights": _SPLIT + "," + _NEAR.format(d=_XY, limit="8") + """, j AS (SELECT l.*, CAST(right_id % 40 + 3 AS DOUBLE) AS survey, coalesce(raw_height > 0, false) AS known FROM l LEFT JOIN ranked ON left_id = l.id AND r = 1)
SELECT id, CASE WHEN known THEN least(raw_height, 600e0) ELSE coalesce(survey, 0e0) END AS height,
CASE WHEN known THEN 'overture' WHEN survey IS NULL THEN 'estimated_pending' ELSE 'osm' END AS height_source FROM j""",
    "nearest_degrees": _SPLIT + "," + _NEAR.format(d=_DEG, limit="50 / 111319e0") + " SELECT left_id, right_id, round(d * 111319e0, 2) AS metres FROM ranked WHERE r = 1",
    "second_heights": _SPLIT + "," + _NEAR.format(d=_DEG, limit="50 / 111319e0") + """, j AS (SELECT l.*, coalesce(raw_height > 0, false) AS known, right_id FROM l LEFT JOIN ranked ON left_id = l.id AND r = 1)
SELECT id, CASE WHEN known THEN raw_height ELSE coalesce(CAST(right_id % 9 AS DOUBLE), 0e0) END AS height, known OR right_id IS NOT NULL AS real,
CASE WHEN known THEN 'first' WHEN right_id IS NOT NULL THEN 'second' END AS provider FROM j""",
    "ring_square_m": cte("bld") + f""", b AS (SELECT fid, lon - fid % 5 * 40 AS lon0, CASE WHEN fid % 5 = 4 THEN 0e0 ELSE lat * (1 - fid % 5) END AS lat0, side * 1e-5 AS s FROM bld),
k(i, a, b) AS (VALUES (0, 0, -1), (1, 2, 0), (2, 1, 2), (3, -1, 1)), c AS (SELECT fid, i, lon0 + a * s AS lon, lat0 + b * s AS lat, CAST(trunc((lon0 + s / 2 + 180) / 6) AS BIGINT) + 1 AS zone FROM b, k),
u AS (SELECT fid, i, {_EZ} AS x, {_NZ} - CASE WHEN lat < 0 THEN 1e7 ELSE 0 END AS y FROM c)
SELECT p.fid, CASE WHEN p.fid % 13 = 0 THEN 0e0 ELSE round(abs((r.x - p.x) * (s.y - q.y) - (s.x - q.x) * (r.y - p.y)) / 2, 3) END AS square_m
FROM u p JOIN u q ON q.fid = p.fid AND q.i = 1 JOIN u r ON r.fid = p.fid AND r.i = 2 JOIN u s ON s.fid = p.fid AND s.i = 3 WHERE p.i = 0""",
    "outline_extent": _CLEAN + f", p AS (SELECT * FROM {planar_sql('cleaned')} WHERE reject_reason IS NULL) SELECT count(*) AS n, round(min(x - side / 2), 3) AS min_x, round(min(z - side / 2), 3) AS min_y, round(max(x + side / 2), 3) AS max_x, round(max(z + side / 2), 3) AS max_y FROM p",
    "pairs_within": _SPLIT + f" SELECT l.id AS left_id, o.id AS right_id FROM l JOIN l o ON l.id < o.id AND {_XY} < 3",
    "cover_anti": _SPLIT + f" SELECT id FROM l WHERE NOT EXISTS (SELECT 1 FROM o WHERE {_BLOCK.format(a='l', b='o')})",
    "smallest_cover": _TARGETS + " SELECT target, arg_min(cover, struct_pack(size := size, cover := cover)) AS cover FROM j GROUP BY 1",
    "first_cover": _TARGETS + " SELECT target, min(cover) AS cover FROM j GROUP BY 1",
    "segment_hits": cte("segments") + """, d AS (SELECT p.id AS a, q.id AS b, p.ax, p.ay, p.bx - p.ax AS dx, p.by - p.ay AS dy,
(p.bx - p.ax) * (q.by - q.ay) - (p.by - p.ay) * (q.bx - q.ax) AS det, (q.ax - p.ax) * (q.by - q.ay) - (q.ay - p.ay) * (q.bx - q.ax) AS t, (q.ax - p.ax) * (p.by - p.ay) - (q.ay - p.ay) * (p.bx - p.ax) AS u
FROM segments p JOIN segments q ON p.id < q.id AND p.road <> q.road)
SELECT a, b, round(t / det, 4) AS t, round(u / det, 4) AS u, round(ax + t / det * dx, 3) AS x, round(ay + t / det * dy, 3) AS y
FROM d WHERE abs(det) > 1e-12 AND t / det > 0.05 AND t / det < 0.95 AND u / det > 0.05 AND u / det < 0.95""",
    # a square on its tip holds the points whose distances along the axes sum to less than its size
    "pip_mask": cte("points") + """, r AS (SELECT CAST(c_custkey * 7919 % 48 AS DOUBLE) AS cx, CAST(c_custkey * 104729 % 38 AS DOUBLE) AS cy, 0.7003e0 + c_custkey % 3 AS s FROM customer)
SELECT DISTINCT id FROM points JOIN r ON abs(x - cx) + abs(z - cy) < s""",
    "zonal_polygons": cte("points") + """, c AS (SELECT floor(x * 2) AS c, floor(z * 2) AS r, avg(value) AS v, avg(CASE WHEN kind <> 'error' THEN 1 ELSE 0 END) AS p FROM points GROUP BY 1, 2),
m AS (SELECT (c + 0.5) / 2 AS x, (r + 0.5) / 2 AS y, v FROM c WHERE p > 0.5),
z AS (SELECT c_custkey AS zone, CAST(c_custkey * 31 % 48 AS DOUBLE) AS cx, CAST(c_custkey * 17 % 38 AS DOUBLE) AS cy, 2.1003e0 + c_custkey % 7 * 1.5e0 AS s FROM customer)
SELECT zone, count(*) AS cells, round(avg(v), 9) AS mean_value FROM z JOIN m ON abs(x - cx) + abs(y - cy) < s AND abs(x - cx) + abs(y - cy) > s * 0.4 GROUP BY 1""",
    "zonal_mean": cte("points") + """, c AS (SELECT floor(x) AS c, floor(z) AS r, avg(value) AS v, avg(CASE WHEN kind <> 'error' THEN 1 ELSE 0 END) AS p FROM points GROUP BY 1, 2)
SELECT CAST(floor(c / 10) AS BIGINT) AS zone_c, CAST(floor(r / 10) AS BIGINT) AS zone_r, round(avg(v), 6) AS mean_value, count(*) AS cells FROM c WHERE p > 0.5 GROUP BY 1, 2""",
    "procedural_heights": _CLEAN + f""", q AS (SELECT *, side * side * 30 AS a, fid % 31 / 10e0 - 1.5e0 AS noise FROM cleaned WHERE reject_reason IS NULL),
f AS (SELECT *, least(15, greatest(1, CASE WHEN a < 60 THEN 1 WHEN a < 150 THEN 2 WHEN a < 400 THEN 3 WHEN a < 1000 THEN 4 WHEN a < 3000 THEN 6 ELSE 8 END + noise)) AS floors,
CASE {_kinds()} WHEN a > 2000 THEN 4.5 WHEN a > 500 THEN 3.5 ELSE 2.9 END::DOUBLE AS metres FROM q)
SELECT fid, round(CASE WHEN abs(height - 10) < 0.1 OR abs(height - 8) < 0.1 OR height <= 0 THEN CASE WHEN subtype IN ('carport', 'garage', 'shed', 'roof') THEN 2.5e0 ELSE floors * metres END ELSE height END, 4) AS height FROM f""",
    "tag_heights": """WITH t AS (SELECT p_partkey AS fid, CASE p_partkey % 6 WHEN 0 THEN p_size || ' m' WHEN 1 THEN 'abc' WHEN 2 THEN p_size::VARCHAR WHEN 3 THEN '2.0' END AS height,
CASE p_partkey % 4 WHEN 0 THEN (p_size % 9)::VARCHAR WHEN 1 THEN 'x' END AS levels FROM part),
n AS (SELECT fid, coalesce(try_cast(trim(replace(height, 'm', '')) AS DOUBLE), try_cast(levels AS DOUBLE) * 3.5e0) AS a, try_cast(height AS DOUBLE) AS h, try_cast(levels AS DOUBLE) AS v FROM t)
SELECT fid, CASE WHEN a >= 2.5 THEN a END AS level_height, CASE WHEN h > 0 THEN h WHEN v > 0 THEN v * 3.5e0 ELSE 0e0 END AS import_height FROM n""",
    "class_heights": cte("bld") + " SELECT fid, CASE WHEN raw_height > 0 THEN raw_height WHEN fid % 5 > 0 THEN fid % 5 * 3.5e0 ELSE 0e0 END AS height, coalesce(nullif(subtype, ''), nullif(kind, ''), 'building') AS kind FROM bld",
    "layer_extent": cte("bld") + " SELECT " + ", ".join(f"round({f}({c}), 7) AS {n}_{c}" for c in ("lon", "lat") for n, f in (("min", "min"), ("max", "max"), ("mean", "avg"))) + " FROM bld",
    "box_overlap": cte("clips") + " SELECT id FROM clips WHERE west <= 100.9e0 AND east >= 100.89e0 AND south <= 12.93e0 AND north >= 12.9e0",
    "largest_ring": cte("bld") + " SELECT fid, round(side * side * 2, 3) AS square_m, CASE WHEN side = 0 THEN 0 ELSE 1 END AS place FROM bld",
}
