"""Queries on faces: cut by a box, in pieces, what they share, and the checks of a whole model."""

from __future__ import annotations

from pyspark.sql import functions as F

from urbanframe.functions import geometry as G
from urbanframe.operators import model_qa as MQ, overlay as OV, strips as ST
from urbanframe.plans.layers import cte, layer, spread, table
from urbanframe.plans.raster_plans import _faces

#: The box of the clipped squares reaches so far each way from their centre.
HALF = 3.0


def clip_split(spark, sf_dir):
    """Squares on their tips cut by a box: octagons become triangles, of which thin ones are dropped."""
    s = table(spark, sf_dir, "part").selectExpr("p_partkey AS id", "CASE WHEN p_size % 8 = 3 THEN 3.08e0 ELSE 1 + p_size % 8 * 0.73e0 END AS s")
    at = lambda a, b: F.struct((a * F.col("s")).alias("x"), (b * F.col("s")).alias("y"))
    faces = spread(s, "id").select("id", F.array(at(0.0, -1.0), at(1.0, 0.0), at(0.0, 1.0), at(-1.0, 0.0)).alias("ring"))
    out = ST.clip_pieces(faces, (-HALF, -HALF, HALF, HALF))
    return out.groupBy("id").agg(F.count("*").alias("pieces"), F.sum(F.size("ring")).alias("corners"), F.round(F.sum(G.area(F.col("ring"))), 6).alias("square_m"))


def strip_overlap(spark, sf_dir):
    """Area that strips of different roads share; every other one lies across."""
    s = layer(spark, sf_dir, "segments").selectExpr("id", "road", "ax", "ay", "CASE WHEN id % 2 = 0 THEN 40e0 ELSE 6e0 END AS w", "CASE WHEN id % 2 = 0 THEN 6e0 ELSE 40e0 END AS h")
    at = lambda i, j: F.struct((F.col("ax") + i * F.col("w")).alias("x"), (F.col("ay") + j * F.col("h")).alias("y"))
    faces = s.select("id", F.col("road").alias("owner"), F.array(at(0.0, 0.0), at(1.0, 0.0), at(1.0, 1.0), at(0.0, 1.0)).alias("ring"))
    return OV.overlaps(faces, digits=4).withColumnRenamed("square", "square_m")


def _measured(spark, sf_dir):
    faces = _faces(spark, sf_dir).withColumns({"layer": F.expr("CASE WHEN id % 3 = 0 THEN 'road_faces' ELSE 'road_clipped_faces' END"), "closed": F.expr("id % 997 > 0"), "strategy": F.expr("CASE id % 4 WHEN 0 THEN 'hull' WHEN 1 THEN 'fan' WHEN 2 THEN 'strip' END")})
    faces = faces.filter("NOT (layer = 'road_clipped_faces' AND (tie OR h < 1 OR NOT closed))")
    return MQ.face_measures(faces)


def model_checks(spark, sf_dir):
    """All checks of a model: each of its four tables is read once."""
    layer_is = lambda n: F.col("layer") == n
    faces = MQ.check_rows(_measured(spark, sf_dir), [MQ.face_rules(n, layer_is(n)) for n in ("road_faces", "road_clipped_faces")])
    points = layer(spark, sf_dir, "points").selectExpr("id % 2 AS half", "CASE WHEN kind <> 'error' AND value >= 5 THEN value / 100 - 0.04e0 END AS delta")
    terrain = MQ.check_rows(points, [MQ.terrain_rule("building_terrain_fit", 0.1, scope=F.col("half") == 0), MQ.terrain_rule("road_terrain_fit", 0.35, scope=F.col("half") == 1)])
    parts = table(spark, sf_dir, "part").selectExpr(
        "CASE WHEN p_partkey % 2 = 0 THEN 'body' ELSE 'foundation' END AS kind", "CASE WHEN p_partkey % 50 > 0 THEN 0.8e0 END AS colour", "0.8e0 AS body_colour", "p_size % 3 AS bevels", "0.05e0 + p_size % 5 AS shortest",
        "CASE WHEN p_partkey % 400 = 1 THEN 'zero' WHEN p_partkey % 300 = 2 THEN 'mismatch' ELSE 'good' END AS normal_state", "p_partkey % 2 AS tag", "CASE WHEN p_size % 9 > 0 THEN 0.81e0 + p_size / 1000 END AS best", "CASE WHEN p_size % 4 > 0 THEN p_size / 2000 END AS gap",
    )
    buildings = MQ.check_rows(parts, MQ.building_rules())
    dem = layer(spark, sf_dir, "dem").selectExpr("CASE WHEN masked THEN 'raw' ELSE 'fine' END AS layer")
    density = MQ.check_rows(dem, [MQ.density_rule()])
    every = faces.unionByName(terrain).unionByName(buildings).unionByName(density)
    return every.select("check", "status", "message", "n", "failed", "warned")


def model_severity(spark, sf_dir):
    return MQ.roll_up(model_checks(spark, sf_dir))


def fill_strategies(spark, sf_dir):
    out = MQ.strategies(_measured(spark, sf_dir))
    return out.select("strategy", "n", F.round("max_square_m", 4).alias("max_square_m"), F.round("max_aspect", 4).alias("max_aspect"), F.col("max_verts").cast("long").alias("max_verts"), F.round("least_angle", 4).alias("least_angle"))


QUERIES = {f.__name__: f for f in (clip_split, strip_overlap, model_checks, model_severity, fill_strategies)}

# rectangles w by h; a tie is crossed, with sides h and the diagonal
_MEASURED = """WITH f AS (SELECT p_partkey AS id, CAST(p_size AS DOUBLE) AS w, CASE WHEN p_partkey % 7 = 0 THEN 0.05e0 ELSE 1 + p_partkey % 5 END AS h, p_partkey % 10 = 0 AS tie FROM part),
g AS (SELECT *, CASE WHEN id % 3 = 0 THEN 'road_faces' ELSE 'road_clipped_faces' END AS layer, id % 997 > 0 AS closed, CASE id % 4 WHEN 0 THEN 'hull' WHEN 1 THEN 'fan' WHEN 2 THEN 'strip' END AS strategy FROM f),
m AS (SELECT *, CASE WHEN tie THEN 0e0 ELSE w * h END AS square_m, CASE WHEN tie THEN sqrt(w * w + h * h) / h ELSE greatest(w, h) / least(w, h) END AS aspect,
CASE WHEN tie THEN degrees(atan(w / h)) ELSE 90e0 END AS angle FROM g WHERE NOT (layer = 'road_clipped_faces' AND (tie OR h < 1 OR NOT closed)))
"""


def _check(name: str, source: str, scope: str, fail: list[str], warn: list[str], says: tuple[str, str, str], unusual: str = "false") -> str:
    count = lambda conditions: " + ".join(f"count(*) FILTER ({c})" for c in conditions) or "0"
    return f"""SELECT '{name}' AS "check", CASE WHEN failed > 0 THEN 'fail' WHEN unusual THEN 'warn' ELSE 'pass' END AS status,
CASE WHEN failed > 0 THEN '{says[2]}' WHEN unusual THEN '{says[1]}' ELSE '{says[0]}' END AS message, n, failed::BIGINT AS failed, warned::BIGINT AS warned
FROM (SELECT count(*) AS n, {count(fail)} AS failed, {count(warn)} AS warned, {unusual} AS unusual FROM {source} WHERE {scope})"""


_FACE = (["NOT closed", "square_m > 5000", "aspect > 500", "angle < 2", "tie"], ["square_m > 750", "aspect > 150", "angle < 5"], ("faces look bounded", "unusual face shapes", "invalid faces"), "count(*) FILTER (square_m > 750 OR aspect > 150 OR angle < 5) > 0")
_BELOW = ("terrain placement is within the threshold", "many points miss the terrain", "points below the terrain threshold")
_CHECKS = _MEASURED + ", " + cte("points", "dem").removeprefix("WITH ") + """, d AS (SELECT id % 2 AS half, CASE WHEN kind <> 'error' AND value >= 5 THEN value / 100 - 0.04e0 END AS delta FROM points),
b AS (SELECT *, p_partkey % 2 = 1 AS foundation FROM part), c AS (
""" + "\nUNION ALL ".join((
    _check("road_faces", "m", "layer = 'road_faces'", *_FACE), _check("road_clipped_faces", "m", "layer = 'road_clipped_faces'", *_FACE),
    _check("building_terrain_fit", "d", "half = 0", ["delta < -0.05"], ["delta IS NULL"], _BELOW, "count(*) FILTER (delta IS NULL) > 0.1 * count(*)"),
    _check("road_terrain_fit", "d", "half = 1", ["delta < -0.05"], ["delta IS NULL"], _BELOW, "count(*) FILTER (delta IS NULL) > 0.35 * count(*)"),
    _check("building_color", "b", "true", [], ["p_partkey % 50 = 0"], ("colours match", "parts without a colour", ""), "count(*) FILTER (p_partkey % 50 = 0) > 0"),
    _check("footprint_bevel", "b", "NOT foundation", ["p_size % 5 = 0"], [], ("corners were bevelled", "no corner was bevelled", "bevels left too short edges"), "count(*) FILTER (p_size % 3 > 0) = 0"),
    _check("building_normals", "b", "true", ["p_partkey % 400 = 1 OR p_partkey % 300 = 2"], [], ("normals are valid", "", "normals are invalid")),
    _check("foundation_tags", "b", "true", [], [], ("tags match the parts", "", "")),
    _check("foundation_normals", "b", "foundation", [], ["p_size % 9 = 0"], ("sides align with the body", "sides without a body near", ""), "count(*) FILTER (p_size % 9 = 0) > 0"),
    _check("foundation_alignment", "b", "foundation AND p_size % 4 > 0", ["p_size > 60"], [], ("tops match the body", "", "tops are offset from the body")),
    _check("terrain_density", "dem", "true", [], [], ("terrain is subdivided", "the fine terrain is no denser", ""), "count(*) FILTER (NOT masked) <= count(*) FILTER (masked)"),
)) + ")\n"

ORACLE_SQL = {
    # an octagon has four triangles with two corners on a side of the box (wide) and four between sides (slanted)
    "clip_split": f"""WITH s AS (SELECT p_partkey AS id, {HALF}e0 AS b, CASE WHEN p_size % 8 = 3 THEN 3.08e0 ELSE 1 + p_size % 8 * 0.73e0 END AS s FROM part),
t AS (SELECT *, s > b AND s < 2 * b AS cut, degrees(2 * atan((s - b) / b)) AS apex FROM s),
k AS (SELECT *, least(apex, 90 - apex / 2) >= 5 AS wide, least(90 - apex, 45 + apex / 2) >= 5 AS slanted FROM t)
SELECT id, CASE WHEN NOT cut THEN 1 ELSE 4 * (wide::BIGINT + slanted::BIGINT) END AS pieces, CASE WHEN NOT cut THEN 4 ELSE 12 * (wide::BIGINT + slanted::BIGINT) END AS corners,
round(CASE WHEN s <= b THEN 2 * s * s WHEN NOT cut THEN 4 * b * b ELSE CASE WHEN wide THEN 4 * b * (s - b) ELSE 0 END + CASE WHEN slanted THEN 2 * (b * b - (s - b) * (s - b)) ELSE 0 END END, 6) AS square_m FROM k""",
    "strip_overlap": """WITH s AS (SELECT c_custkey AS id, c_nationkey AS road, CAST(c_custkey * 7919 % 1000 AS DOUBLE) AS x, CAST(c_custkey * 104729 % 1000 AS DOUBLE) AS y,
CASE WHEN c_custkey % 2 = 0 THEN 40e0 ELSE 6e0 END AS w, CASE WHEN c_custkey % 2 = 0 THEN 6e0 ELSE 40e0 END AS h FROM customer)
SELECT a.id AS a, b.id AS b, round((least(a.x + a.w, b.x + b.w) - greatest(a.x, b.x)) * (least(a.y + a.h, b.y + b.h) - greatest(a.y, b.y)), 4) AS square_m
FROM s a JOIN s b ON a.id < b.id AND a.road <> b.road AND a.x < b.x + b.w AND b.x < a.x + a.w AND a.y < b.y + b.h AND b.y < a.y + a.h""",
    "model_checks": _CHECKS + "SELECT * FROM c",
    "model_severity": _CHECKS + """SELECT CASE WHEN bool_or(status = 'fail') THEN 'fail' WHEN bool_or(status = 'warn') THEN 'warn' ELSE 'pass' END AS status,
count(*) FILTER (status = 'pass') AS n_pass, count(*) FILTER (status = 'warn') AS n_warn, count(*) FILTER (status = 'fail') AS n_fail FROM c""",
    "fill_strategies": _MEASURED + "SELECT strategy, count(*) AS n, round(max(square_m), 4) AS max_square_m, round(max(aspect), 4) AS max_aspect, 4::BIGINT AS max_verts, round(min(angle), 4) AS least_angle FROM m WHERE strategy IS NOT NULL GROUP BY 1",
}
