"""Queries on meshes: terrain with its fallback, prisms, normals, foundations, road strips and clipped faces."""

from __future__ import annotations

from pyspark.sql import functions as F

from urbanframe.operators import areas as AR, faces as FA, raster as R, roads, strips as ST
from urbanframe.plans.layers import cte, layer, planar, planar_sql, spread, table
from urbanframe.sources import buildings as BS

#: Half the width of the test roads, in metres.
HALF_M = 2.0


def terrain_fallback(spark, sf_dir):
    out = R.sampled(layer(spark, sf_dir, "points"), layer(spark, sf_dir, "dem"), reach=3)
    return out.select("id", F.round("terrain", 6).alias("terrain"))


def dem_window(spark, sf_dir):
    out = R.windowed(layer(spark, sf_dir, "dem"), 1, 30, 10, 40)
    return out.select(F.col("row").alias("r"), F.col("col").alias("c"), "elev")


def ways_in_box(spark, sf_dir):
    """All nodes of the ways with a highway, or a building as every 6th, that have a node in the box."""
    tags = layer(spark, sf_dir, "way_tags").withColumn("building", F.expr("CASE WHEN num % 6 = 2 THEN 'yes' WHEN num % 6 = 3 THEN '' END"))
    out = roads.ways_in_box(layer(spark, sf_dir, "way_nodes"), tags, layer(spark, sf_dir, "nodes"), (100.841, 12.891, 100.8415, 12.8914))
    return out.select("way_id", "seq", "ref", "lon", "lat")


def _boxes(spark, sf_dir):
    """Rectangles of parts over the elevation grid, with a base and a height."""
    p = table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS id", "p_partkey * 7 % 44 + 0.25e0 AS x0", "p_partkey * 13 % 34 + 0.5e0 AS z0", "CAST(1 + p_size % 4 AS DOUBLE) AS w", "CAST(1 + p_size % 3 AS DOUBLE) AS h",
        "CAST(p_partkey % 100 AS DOUBLE) * 10 AS base", "CAST(2 + p_size % 5 AS DOUBLE) AS height",
    )
    at = lambda i, j: F.struct((F.col("x0") + i * F.col("w")).alias("x"), (F.col("z0") + j * F.col("h")).alias("y"))
    return spread(p, "id").withColumn("ring", F.array(at(0.0, 0.0), at(1.0, 0.0), at(1.0, 1.0), at(0.0, 1.0)))


_BOXES = """b AS (SELECT p_partkey AS id, p_partkey * 7 % 44 + 0.25e0 AS x0, p_partkey * 13 % 34 + 0.5e0 AS z0, CAST(1 + p_size % 4 AS DOUBLE) AS w, CAST(1 + p_size % 3 AS DOUBLE) AS h,
CAST(p_partkey % 100 AS DOUBLE) * 10 AS base, CAST(2 + p_size % 5 AS DOUBLE) AS height FROM part)"""


def prism_faces(spark, sf_dir):
    """Each prism's faces by part: how many, their corners, and how low and high they reach."""
    f = ST.extruded(_boxes(spark, sf_dir), "height").withColumn("p", F.explode("ring"))
    return f.groupBy("id", "part").agg(F.countDistinct("face").alias("faces"), F.count("*").alias("corners"), F.min("p.y").alias("low"), F.max("p.y").alias("high"), F.round(F.sum("p.x"), 6).alias("sum_x"))


def prism_normals(spark, sf_dir):
    """Normals of the prisms' faces; stored ones are made missing, zero and wrong for some."""
    f = ST.extruded(_boxes(spark, sf_dir), "height")
    kind = F.col("id") % 5
    own = FA.normal(F.col("ring"))
    turned = F.struct((-own["x"]).alias("x"), (-own["y"]).alias("y"), (-own["z"]).alias("z"))
    none = F.struct(F.lit(0.0).alias("x"), F.lit(0.0).alias("y"), F.lit(0.0).alias("z"))
    return FA.normal_statistics(f.withColumn("n", F.when(kind == 1, turned).when(kind == 2, none).when(kind > 2, own)), "n")


def dressed_faces(spark, sf_dir):
    """The direction of each side of the prisms, with the layer's colour."""
    f = FA.dressed(ST.extruded(_boxes(spark, sf_dir), "height"), "building").filter("part = 'side'")
    n = F.col("normal")
    return f.select("id", F.col("face").cast("long").alias("face"), F.round(n["x"] + 0.0, 6).alias("nx"), F.round(n["y"] + 0.0, 6).alias("ny"), F.round(n["z"] + 0.0, 6).alias("nz"), "red")


def foundation_edges(spark, sf_dir):
    out = FA.foundation_edges(ST.extruded(_boxes(spark, sf_dir), "height"), layer(spark, sf_dir, "dem"))
    return out.select("id", F.col("face").cast("long").alias("face"), F.round("depth_a", 6).alias("depth_a"), F.round("depth_b", 6).alias("depth_b"))


def _halves(spark, sf_dir):
    """Points with a slanted normal by kind, of even and of odd ids."""
    n = F.struct(F.expr("id % 7 / 7e0").alias("x"), F.expr("id % 5 / 5e0").alias("y"), F.expr("id % 3 / 3e0").alias("z"))
    p = layer(spark, sf_dir, "points").select("id", "x", "z", n.alias("n"))
    return p.filter("id % 2 = 0"), p.filter("id % 2 = 1")


def side_matches(spark, sf_dir):
    out = FA.side_matches(*_halves(spark, sf_dir))
    return out.select("id", F.round("best", 6).alias("best"), "status")


def edge_distances(spark, sf_dir):
    """Even points to odd ones, in cells of 20 cm."""
    out = FA.edge_distances(*_halves(spark, sf_dir), 0.2)
    return out.select("id", F.round("distance", 6).alias("distance"))


def clip_faces(spark, sf_dir):
    """Rectangles cut by a box, with what is left of their area."""
    ring = F.transform("ring", lambda p: F.struct((p["x"] - F.col("x0")).alias("x"), (p["y"] - F.col("z0")).alias("y")))
    out = ST.clip_faces(_boxes(spark, sf_dir).select("id", ring.alias("ring")), (0.5, 0.5, 3.0, 2.0))
    x, y = F.transform("ring", lambda p: p["x"]), F.transform("ring", lambda p: p["y"])
    return out.select("id", F.round((F.array_max(x) - F.array_min(x)) * (F.array_max(y) - F.array_min(y)), 6).alias("square_m"), F.size("ring").cast("long").alias("corners"))


def _lines(spark, sf_dir):
    nodes = planar(layer(spark, sf_dir, "nodes")).select(F.col("id").alias("ref"), "x", F.col("z").alias("y"))
    rows = layer(spark, sf_dir, "way_nodes").join(nodes, "ref").select(F.col("way_id").alias("road"), "seq", "ref", "x", "y")
    return rows.withColumns({"half_width": F.lit(HALF_M), "is_junction": F.col("ref").cast("long") % 3 == 0})


def _districts(spark, sf_dir):
    """The polylines in eight districts 20 km apart, of many widths, so that junctions of few and of many ends arise."""
    num = F.col("road").cast("long")
    return _lines(spark, sf_dir).withColumns({"x": F.col("x") + num % 8 * 20000, "half_width": (1 + num % 15).cast("double")})


def strip_faces(spark, sf_dir):
    out = ST.strip_quads(_lines(spark, sf_dir))
    return out.select("road", "seq", F.round("length", 2).alias("length"), F.round("square_m", 2).alias("square_m"))


def trimmed_strips(spark, sf_dir):
    """Sides of each polyline that is cut at its junctions: how many stay, and their extent along it."""
    sides, _ = ST.trimmed(_lines(spark, sf_dir))
    return sides.groupBy("road").agg(F.count("*").alias("n"), F.round(F.min("travelled"), 2).alias("first"), F.round(F.max("travelled"), 2).alias("last"))


def _fills(spark, sf_dir):
    _, ends = ST.trimmed(_districts(spark, sf_dir))
    return ST.junction_fills(ends)


def junction_surfaces(spark, sf_dir):
    """Each junction with its ends: the reason against a fill, or the fill's area and corners."""
    at = lambda c: F.col(c).cast("long").alias(c)
    return _fills(spark, sf_dir).select(at("jx"), at("jy"), at("n"), "reason", F.round("square_m", 5).alias("square_m"), at("corners"))


def junction_accounts(spark, sf_dir):
    """One row: fills, rejects by reason, and all junctions."""
    return ST.junction_accounts(_fills(spark, sf_dir))


def crossing_inserts(spark, sf_dir):
    """Points of each polyline after its middles were put in, in order and without those too near to the one before."""
    lines = _lines(spark, sf_dir).select("road", "seq", "x", "y")
    follow = "OVER (PARTITION BY road ORDER BY seq)"
    middles = lines.selectExpr("road", "seq", "0.5e0 AS t", f"(x + lead(x) {follow}) / 2 AS x", f"(y + lead(y) {follow}) / 2 AS y").filter("x IS NOT NULL")
    return ST.with_crossings(lines, middles).groupBy("road").agg(F.count("*").alias("n"))


def wkb_buildings(spark, sf_dir):
    """Footprints from well-known binary; some are null, cut short or of two parts."""
    bld = table(spark, sf_dir, "part").selectExpr("p_partkey AS fid", "CAST(p_partkey % 100 AS DOUBLE) AS x", "CAST(p_size AS DOUBLE) AS s", "CASE WHEN p_partkey % 7 > 0 THEN CAST(p_partkey % 7 - 2 AS DOUBLE) END AS height", "p_size % 5 AS num_floors", "CASE WHEN p_partkey % 3 = 0 THEN 'retail' WHEN p_partkey % 3 = 1 THEN '' END AS subtype", "CASE WHEN p_partkey % 4 = 0 THEN 'shop' END AS class")
    at = lambda i, j: F.struct((F.col("x") + i * F.col("s")).alias("lon"), (j * F.col("s")).alias("lat"))
    square = F.array(F.array(at(0.0, 0.0), at(1.0, 0.0), at(1.0, 1.0), at(0.0, 1.0), at(0.0, 0.0)))
    data = BS.encoded(F.when(F.col("fid") % 5 == 0, F.array(square, square)).otherwise(F.array(square)))
    cut = F.when(F.col("fid") % 11 == 0, F.lit(None)).when(F.col("fid") % 13 == 0, F.substring(data, 1, 20)).otherwise(data)
    out = BS.footprints(bld.withColumn("geometry", cut))
    last = F.element_at(F.element_at(F.element_at("polys", -1), 1), 3)
    return out.select("fid", F.size("polys").cast("long").alias("parts"), last["lon"].alias("lon"), last["lat"].alias("lat"), "raw_height", "real", "class")


def cache_match(spark, sf_dir):
    """The cached clip that serves each customer's box, or that of a clip itself; signatures must be the same."""
    clips = layer(spark, sf_dir, "clips").selectExpr("id AS key", "west", "south", "east", "north", "id % 2 AS signature", "id % 5 > 0 AS ready")
    t = table(spark, sf_dir, "customer").selectExpr("c_custkey AS id", "100.84e0 + c_custkey % 17 * 2e-3 AS west", "12.87e0 + c_custkey % 19 * 1e-3 AS south", "100.85e0 + c_custkey % 17 * 2e-3 AS east", "12.88e0 + c_custkey % 19 * 1e-3 AS north", "c_custkey % 2 AS signature")
    own = clips.selectExpr("-1 - key AS id", "west", "south", "east", "north", "signature")
    return AR.cache_matches(t.unionByName(own), clips)


QUERIES = {
    f.__name__: f
    for f in (
        wkb_buildings, cache_match, terrain_fallback, dem_window, ways_in_box, prism_faces, prism_normals, dressed_faces, foundation_edges, side_matches, edge_distances,
        clip_faces, strip_faces, trimmed_strips, junction_surfaces, junction_accounts, crossing_inserts,
    )
}

_QUADS = """q AS (SELECT a.row AS r, a.col AS c, a.elev AS e00, b.elev AS e01, c.elev AS e10, d.elev AS e11 FROM dem a JOIN dem b ON b.row = a.row AND b.col = a.col + 1
JOIN dem c ON c.row = a.row + 1 AND c.col = a.col JOIN dem d ON d.row = a.row + 1 AND d.col = a.col + 1)"""
_AT = "(e00 * (1 - ({x} - floor({x}))) + e01 * ({x} - floor({x}))) * (1 - ({z} - floor({z}))) + (e10 * (1 - ({x} - floor({x}))) + e11 * ({x} - floor({x}))) * ({z} - floor({z}))"
_LINES = cte("nodes", "way_nodes") + f""", q AS (SELECT way_id AS road, seq, ref, x, z AS y FROM way_nodes JOIN {planar_sql('nodes')} m ON m.id = ref),
s AS (SELECT *, coalesce(sqrt(pow(x - lag(x) OVER w, 2) + pow(y - lag(y) OVER w, 2)), 0e0) AS step,
      coalesce(lead(x) OVER w, x) - coalesce(lag(x) OVER w, x) AS dx, coalesce(lead(y) OVER w, y) - coalesce(lag(y) OVER w, y) AS dy, lead(x) OVER w IS NULL AS last FROM q WINDOW w AS (PARTITION BY road ORDER BY seq)),
a AS (SELECT *, sum(step) OVER (PARTITION BY road ORDER BY seq) AS travelled, sum(step) OVER (PARTITION BY road) AS whole, row_number() OVER (PARTITION BY road ORDER BY seq) = 1 AS first,
      CASE WHEN dx * dx + dy * dy > 0 THEN dx / sqrt(dx * dx + dy * dy) END AS tx, CASE WHEN dx * dx + dy * dy > 0 THEN dy / sqrt(dx * dx + dy * dy) END AS ty FROM s)
"""
_DISTANCE = "sqrt((a.x - b.x) * (a.x - b.x) + (a.z - b.z) * (a.z - b.z))"
_APART = "greatest(abs(floor(a.x / 0.2e0) - floor(b.x / 0.2e0)), abs(floor(a.z / 0.2e0) - floor(b.z / 0.2e0)))"

#: Hulls by all pairs: a side is a pair of corners with every other one to its left or between them.
_JUNCTIONS = _LINES.replace("SELECT way_id AS road, seq, ref, x, z AS y", "SELECT way_id AS road, seq, ref, x + way_id::BIGINT % 8 * 20000 AS x, z AS y") + """, c AS (SELECT *, 1 + road::BIGINT % 15 AS hw FROM a),
d AS (SELECT *, CASE WHEN ref::BIGINT % 3 = 0 AND (first OR last) THEN least(hw, whole * 0.45) ELSE 0 END AS cut FROM c),
k AS (SELECT * FROM d WHERE tx IS NOT NULL QUALIFY whole >= 1e-6 AND coalesce(max(cut) FILTER (first) OVER (PARTITION BY road), 0) + coalesce(max(cut) FILTER (last) OVER (PARTITION BY road), 0) < whole - 1e-4),
e AS (SELECT CAST(round_even(x, 0) AS BIGINT) AS jx, CAST(round_even(y, 0) AS BIGINT) AS jy, hw, tx, ty, x + CASE WHEN first THEN 1 ELSE -1 END * tx * cut AS px, y + CASE WHEN first THEN 1 ELSE -1 END * ty * cut AS py FROM k WHERE cut > 0),
p AS (SELECT jx, jy, hw, px - ty * hw AS x, py + tx * hw AS y FROM e UNION ALL SELECT jx, jy, hw, px + ty * hw, py - tx * hw FROM e),
g AS (SELECT jx, jy, count(*) AS n, max(hw) AS hw, avg(x) AS cx, avg(y) AS cy FROM p GROUP BY 1, 2),
w AS (SELECT jx, jy, max(sqrt(pow(x - cx, 2) + pow(y - cy, 2))) AS far FROM p JOIN g USING (jx, jy) GROUP BY 1, 2),
u AS (SELECT DISTINCT jx, jy, CAST(round_even(x * 100, 0) AS BIGINT) AS x, CAST(round_even(y * 100, 0) AS BIGINT) AS y FROM p JOIN g USING (jx, jy) WHERE n BETWEEN 3 AND 8),
sides AS (SELECT a.jx, a.jy, a.x AS ax, a.y AS ay, b.x AS qx, b.y AS qy, (b.x - a.x) * (o.y - a.y) - (b.y - a.y) * (o.x - a.x) AS turn, (o.x - a.x) * (o.x - b.x) + (o.y - a.y) * (o.y - b.y) AS inner_side
      FROM u a JOIN u b ON b.jx = a.jx AND b.jy = a.jy AND (b.x <> a.x OR b.y <> a.y) JOIN u o ON o.jx = a.jx AND o.jy = a.jy),
h AS (SELECT jx, jy, ax, ay, qx, qy FROM sides GROUP BY ALL HAVING bool_and(turn > 0 OR turn = 0 AND inner_side <= 0)),
f AS (SELECT jx, jy, count(*) AS corners, sum(ax * qy - qx * ay) / 2e4 AS square_m FROM h GROUP BY 1, 2),
r AS (SELECT g.jx, g.jy, n, CASE WHEN n < 3 THEN 'small' WHEN n > 8 THEN 'complex' WHEN far > least(18, greatest(g.hw * 2.8, 3)) THEN 'radius' WHEN coalesce(corners, 0) < 3 THEN 'small'
      WHEN square_m > least(450, g.hw * g.hw * 10) THEN 'area' END AS reason, square_m, corners FROM g JOIN w ON w.jx = g.jx AND w.jy = g.jy LEFT JOIN f ON f.jx = g.jx AND f.jy = g.jy)
"""

ORACLE_SQL = {
    "junction_surfaces": _JUNCTIONS + "SELECT jx, jy, n, reason, CASE WHEN reason IS NULL THEN round(square_m, 5) END AS square_m, CASE WHEN reason IS NULL THEN corners END AS corners FROM r",
    "junction_accounts": _JUNCTIONS + "SELECT count(*) FILTER (reason IS NULL) AS fills, " + ", ".join(f"count(*) FILTER (reason = '{k}') AS {k}" for k in ST.REASONS) + ", count(*) AS total FROM r",
    "wkb_buildings": """SELECT p_partkey AS fid, CASE WHEN p_partkey % 5 = 0 THEN 2 ELSE 1 END AS parts, CAST(p_partkey % 100 + p_size AS DOUBLE) AS lon, CAST(p_size AS DOUBLE) AS lat,
CASE WHEN p_partkey % 7 > 2 THEN p_partkey % 7 - 2e0 WHEN p_size % 5 > 0 THEN p_size % 5 * 3.5e0 ELSE 0e0 END AS raw_height, p_partkey % 7 > 2 OR p_size % 5 > 0 AS real,
CASE WHEN p_partkey % 3 = 0 THEN 'retail' WHEN p_partkey % 4 = 0 THEN 'shop' ELSE 'building' END AS class FROM part WHERE p_partkey % 11 > 0 AND p_partkey % 13 > 0""",
    "cache_match": cte("clips") + """, t AS (SELECT c_custkey AS id, 100.84e0 + c_custkey % 17 * 2e-3 AS west, 12.87e0 + c_custkey % 19 * 1e-3 AS south, 100.85e0 + c_custkey % 17 * 2e-3 AS east, 12.88e0 + c_custkey % 19 * 1e-3 AS north, c_custkey % 2 AS g
FROM customer UNION ALL SELECT -1 - id, west, south, east, north, id % 2 FROM clips)
SELECT t.id, c.id AS key, CASE WHEN c.id IS NULL THEN NULL WHEN c.west = t.west AND c.south = t.south AND c.east = t.east AND c.north = t.north THEN 'exact' ELSE 'parent_clip' END AS mode
FROM t LEFT JOIN clips c ON c.id % 5 > 0 AND c.id % 2 = g AND c.west <= t.west AND c.south <= t.south AND c.east >= t.east AND c.north >= t.north
QUALIFY row_number() OVER (PARTITION BY t.id ORDER BY (c.east - c.west) * (c.north - c.south), c.id) = 1""",
    "terrain_fallback": cte("dem", "points") + f""", {_QUADS}, t AS (SELECT p.id, p.x, p.z, {_AT.format(x='p.x', z='p.z')} AS terrain FROM points p LEFT JOIN q ON q.r = floor(p.z) AND q.c = floor(p.x)),
n AS (SELECT t.id, elev FROM t JOIN dem ON dem.row BETWEEN floor(z) - 3 AND floor(z) + 3 AND dem.col BETWEEN floor(x) - 3 AND floor(x) + 3 WHERE terrain IS NULL
QUALIFY row_number() OVER (PARTITION BY t.id ORDER BY sqrt((x - col) * (x - col) + (z - row) * (z - row)), row, col) = 1)
SELECT t.id, round(coalesce(terrain, elev), 6) AS terrain FROM t LEFT JOIN n ON n.id = t.id""",
    "dem_window": cte("dem") + " SELECT row - 1 AS r, col - 10 AS c, elev FROM dem WHERE row BETWEEN 1 AND 30 AND col BETWEEN 10 AND 40",
    "ways_in_box": cte("nodes", "way_nodes", "way_tags") + """, r AS (SELECT w.way_id, w.seq, w.ref FROM way_nodes w JOIN way_tags t ON t.way_id = w.way_id WHERE t.highway IS NOT NULL OR t.num % 6 = 2)
SELECT way_id, seq, ref, lon, lat FROM r JOIN nodes ON id = ref
WHERE way_id IN (SELECT way_id FROM r JOIN nodes ON id = ref WHERE lon BETWEEN 100.841e0 AND 100.8415e0 AND lat BETWEEN 12.891e0 AND 12.8914e0)""",
    "prism_faces": f"""WITH {_BOXES}
SELECT id, 'side' AS part, 4 AS faces, 16 AS corners, base AS low, base + height AS high, round(8 * x0 + 8 * (x0 + w), 6) AS sum_x FROM b
UNION ALL SELECT id, 'top', 1, 4, base + height, base + height, round(4 * x0 + 2 * w, 6) FROM b
UNION ALL SELECT id, 'bottom', 1, 4, base, base, round(4 * x0 + 2 * w, 6) FROM b""",
    # a ring against the clock, seen with z to the south, has its upper face turned down
    "prism_normals": """SELECT 6 * count(*) AS prims, count(*) AS up, 4 * count(*) AS side, count(*) AS down, 0 AS degenerate, 6 * count(*) FILTER (p_partkey % 5 = 0) AS missing,
6 * count(*) FILTER (p_partkey % 5 = 2) AS zero, 6 * count(*) FILTER (p_partkey % 5 = 1) AS mismatch FROM part""",
    "dressed_faces": """SELECT p_partkey AS id, face, CASE face WHEN 1 THEN -1e0 WHEN 3 THEN 1e0 ELSE 0e0 END AS nx, 0e0 AS ny, CASE face WHEN 0 THEN 1e0 WHEN 2 THEN -1e0 ELSE 0e0 END AS nz, 0.8e0 AS red
FROM part, range(4) r(face)""",
    "foundation_edges": cte("dem") + f""", {_QUADS}, {_BOXES},
sides AS (SELECT id, k AS face, base, x0 + CASE WHEN k IN (1, 2) THEN w ELSE 0 END AS ax, z0 + CASE WHEN k IN (2, 3) THEN h ELSE 0 END AS az,
      x0 + CASE WHEN k IN (0, 1) THEN w ELSE 0 END AS bx, z0 + CASE WHEN k IN (1, 2) THEN h ELSE 0 END AS bz FROM b, range(4) r(k)),
t AS (SELECT sides.*, {_AT.format(x='ax', z='az')} AS ta, NULL::DOUBLE AS tb FROM sides LEFT JOIN q ON q.r = floor(az) AND q.c = floor(ax)
UNION ALL SELECT sides.*, NULL, {_AT.format(x='bx', z='bz')} FROM sides LEFT JOIN q ON q.r = floor(bz) AND q.c = floor(bx)),
u AS (SELECT id, face, base, max(ta) AS ta, max(tb) AS tb FROM t GROUP BY 1, 2, 3),
d AS (SELECT id, face, base - coalesce(greatest(least(ta + 0.03e0, base), CASE WHEN ta IS NOT NULL THEN base - 25 END), base) AS a, base - coalesce(greatest(least(tb + 0.03e0, base), CASE WHEN tb IS NOT NULL THEN base - 25 END), base) AS b,
      ta IS NULL AS na, tb IS NULL AS nb FROM u),
e AS (SELECT id, face, CASE WHEN na THEN 0e0 ELSE a END AS a, CASE WHEN nb THEN 0e0 ELSE b END AS b FROM d)
SELECT id, face, round(a, 6) AS depth_a, round(b, 6) AS depth_b FROM e WHERE greatest(a, b) >= 0.12e0""",
    "side_matches": cte("points") + f""", n AS (SELECT id, x, z, id % 7 / 7e0 AS nx, id % 5 / 5e0 AS ny, id % 3 / 3e0 AS nz FROM points),
d AS (SELECT a.id, max(a.nx * b.nx + a.ny * b.ny + a.nz * b.nz) AS best FROM n a JOIN n b ON {_DISTANCE} <= 0.35e0 WHERE a.id % 2 = 0 AND b.id % 2 = 1 GROUP BY 1)
SELECT points.id, round(best, 6) AS best, CASE WHEN best IS NULL THEN 'no_match' WHEN best > 0.8e0 THEN 'aligned' ELSE 'mismatch' END AS status FROM points LEFT JOIN d ON d.id = points.id WHERE points.id % 2 = 0""",
    "edge_distances": cte("points") + f""", m AS (SELECT a.id, CASE WHEN {_APART} <= 1 THEN 1 ELSE 2 END AS ring, {_DISTANCE} AS d FROM points a JOIN points b ON {_APART} <= 2 WHERE a.id % 2 = 0 AND b.id % 2 = 1)
SELECT id, round(d, 6) AS distance FROM m QUALIFY row_number() OVER (PARTITION BY id ORDER BY ring, d) = 1""",
    "clip_faces": f"""WITH {_BOXES} SELECT id, round((least(w, 3e0) - 0.5e0) * (least(h, 2e0) - 0.5e0), 6) AS square_m, 4 AS corners FROM b""",
    "strip_faces": _LINES + f""", e AS (SELECT road, seq, x - ty * {HALF_M} AS lx, y + tx * {HALF_M} AS ly, x + ty * {HALF_M} AS rx, y - tx * {HALF_M} AS ry FROM a WHERE tx IS NOT NULL),
f AS (SELECT *, lead(lx) OVER w AS mx, lead(ly) OVER w AS my, lead(rx) OVER w AS sx, lead(ry) OVER w AS sy FROM e WINDOW w AS (PARTITION BY road ORDER BY seq)),
g AS (SELECT road, seq, (sqrt(pow(mx - lx, 2) + pow(my - ly, 2)) + sqrt(pow(sx - rx, 2) + pow(sy - ry, 2))) / 2 AS length,
      abs(lx * my - mx * ly + mx * sy - sx * my + sx * ry - rx * sy + rx * ly - lx * ry) / 2 AS square_m FROM f WHERE mx IS NOT NULL)
SELECT road, seq, round(length, 2) AS length, round(square_m, 2) AS square_m FROM g WHERE square_m > 1e-5""",
    "crossing_inserts": _LINES.replace("WITH ", "WITH RECURSIVE ", 1) + """, i AS (SELECT road, seq, 0 AS made, x, y, 0.05e0 AS eps FROM q
UNION ALL SELECT road, seq, 1, mx, my, 0.25e0 FROM (SELECT road, seq, (x + lead(x) OVER w) / 2 AS mx, (y + lead(y) OVER w) / 2 AS my FROM q WINDOW w AS (PARTITION BY road ORDER BY seq)) WHERE mx IS NOT NULL),
o AS (SELECT *, row_number() OVER (PARTITION BY road ORDER BY seq, made) AS k FROM i),
w(road, k, kx, ky, kept) AS (SELECT road, k, x, y, 1 FROM o WHERE k = 1 UNION ALL
SELECT o.road, o.k, CASE WHEN sqrt(pow(x - kx, 2) + pow(y - ky, 2)) >= eps THEN x ELSE kx END, CASE WHEN sqrt(pow(x - kx, 2) + pow(y - ky, 2)) >= eps THEN y ELSE ky END,
CASE WHEN sqrt(pow(x - kx, 2) + pow(y - ky, 2)) >= eps THEN 1 ELSE 0 END FROM w JOIN o ON o.road = w.road AND o.k = w.k + 1)
SELECT road, CAST(sum(kept) AS BIGINT) AS n FROM w GROUP BY 1""",
    "trimmed_strips": _LINES + f""", c AS (SELECT *, CASE WHEN ref::BIGINT % 3 = 0 AND (first OR last) THEN least({HALF_M}, whole * 0.45) ELSE 0 END AS cut FROM a),
d AS (SELECT *, max(cut) FILTER (first) OVER (PARTITION BY road) AS b, max(cut) FILTER (last) OVER (PARTITION BY road) AS e FROM c),
k AS (SELECT * FROM d WHERE whole >= 1e-6 AND b + e < whole - 1e-4 AND tx IS NOT NULL),
o AS (SELECT road, travelled FROM k WHERE travelled > b + 1e-4 AND travelled < whole - e - 1e-4 UNION ALL SELECT road, travelled + CASE WHEN first THEN cut ELSE -cut END FROM k WHERE cut > 0)
SELECT road, count(*) AS n, round(min(travelled), 2) AS first, round(max(travelled), 2) AS last FROM o GROUP BY 1""",
}
