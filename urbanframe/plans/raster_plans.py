"""Queries on elevation grids, faces and model checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from urbanframe.functions import geometry as G
from urbanframe.operators import order as O, quality as Q, raster as R
from urbanframe.plans.layers import cte, layer, spread, table
from urbanframe.sources.heightmap import tile_images, tile_pixels

DEM = cte("dem")
_SHARES = [0.01, 0.05, 0.5, 0.95, 0.99]


def dem_crop(spark, sf_dir):
    pts = layer(spark, sf_dir, "dem").selectExpr("col * 30e0 AS x", "-row * 30e0 AS z", "elev", "row", "col")
    out = R.cropped(pts, -100.0, 50.0, (0.0, -600.0, 900.0, 0.0))
    return out.select("x", "z", "elev", F.col("row").cast("long").alias("r"), F.col("col").cast("long").alias("c"))


def dem_missing(spark, sf_dir):
    rows = layer(spark, sf_dir, "dem").selectExpr("CASE WHEN col % 7 = 0 THEN 'NaN' WHEN col % 11 = 0 THEN '' ELSE CAST(col AS STRING) END AS x", "CASE WHEN row % 13 = 0 THEN 'nan' ELSE CAST(row AS STRING) END AS y")
    return rows.agg(F.count("*").alias("n"), Q.missing_cells(rows, ["x", "y"]).alias("missing"))


def dem_valid(spark, sf_dir):
    rows = layer(spark, sf_dir, "dem").withColumn("elev", F.expr("CASE WHEN col % 17 = 0 THEN -9999e0 ELSE elev END"))
    return rows.filter("elev >= -9000").agg(F.count("*").alias("n"), F.round(F.avg("elev"), 6).alias("mean_elev"))


def dense_rank_index(spark, sf_dir):
    pts = layer(spark, sf_dir, "dem").selectExpr("col * 30.004e0 AS x", "row * -29.996e0 + 5 AS z")
    return R.dense_index(pts).select(F.round("x", 2).alias("x"), F.round("z", 2).alias("z"), F.col("row").cast("long").alias("r"), F.col("col").cast("long").alias("c"))


def idw_fill(spark, sf_dir):
    out = R.idw_fill(layer(spark, sf_dir, "dem"), F.col("masked"))
    return out.select(F.col("row").alias("r"), F.col("col").alias("c"), F.round("elev", 6).alias("elev"), "filled")


def dtm_delta(spark, sf_dir):
    dem = layer(spark, sf_dir, "dem")
    d = F.col("elev") - F.col("before")
    both = R.idw_fill(dem, F.col("masked")).join(dem.select("row", "col", F.col("elev").alias("before")).hint("merge"), ["row", "col"])
    return both.agg(F.count_if("filled").alias("filled"), F.round(F.avg(F.when(F.col("filled"), d)), 6).alias("mean_delta"), F.round(F.max(F.when(F.col("filled"), F.abs(d))), 6).alias("max_delta"))


def dem_quads(spark, sf_dir):
    out = R.quads(layer(spark, sf_dir, "dem"))
    return out.select(F.col("row").alias("r"), F.col("col").alias("c"), *(F.round(e, 6).alias(e) for e in ("e00", "e01", "e10", "e11")))


def bilinear(spark, sf_dir):
    out = R.subdivided(layer(spark, sf_dir, "dem"))
    return out.select(F.col("row").alias("r"), F.col("col").alias("c"), F.round("elev", 6).alias("elev"))


def terrain_sample(spark, sf_dir):
    out = R.sampled(layer(spark, sf_dir, "points"), layer(spark, sf_dir, "dem"))
    return out.select("id", F.round("terrain", 6).alias("terrain"))


def terrain_delta_pct(spark, sf_dir):
    """Height above the terrain by kind of point: nearest-rank percentiles, misses, and those below -0.05."""
    out = R.sampled(layer(spark, sf_dir, "points"), layer(spark, sf_dir, "dem")).withColumn("delta", F.round(F.col("value") - F.col("terrain"), 6))
    n = out.groupBy("kind").agg(F.count("*").alias("n"), F.count_if(F.col("terrain").isNull()).alias("misses"), F.count_if(F.col("delta") < -0.05).alias("below"))
    return n.join(O.nearest_rank(out, "delta", _SHARES, ["kind"]), "kind", "left")


def snap_base(spark, sf_dir):
    corners = layer(spark, sf_dir, "points").withColumn("id", F.col("id") % 500)
    return R.snapped_base(corners, layer(spark, sf_dir, "dem")).select("id", F.round("base", 6).alias("base"))


def road_drape(spark, sf_dir):
    """Points laid on the terrain; where their cell lacks a corner, on the nearest grid point within two cells."""
    out = R.sampled(layer(spark, sf_dir, "points"), layer(spark, sf_dir, "dem"), reach=2)
    return out.select("id", F.round(F.greatest(F.coalesce("terrain", F.lit(0.0)), F.lit(0.0)) + R.DRAPE, 6).alias("y"))


def foundation_skirt(spark, sf_dir):
    out = R.sampled(layer(spark, sf_dir, "points"), layer(spark, sf_dir, "dem"))
    return out.select("id", F.round(R.foundation_depth(F.col("value") / 2, F.col("terrain")), 6).alias("depth"))


def _pixels(spark, sf_dir):
    dem = layer(spark, sf_dir, "dem")
    lim = dem.agg(F.min("elev").alias("lo"), F.max("elev").alias("hi"))
    return dem.join(F.broadcast(lim)).withColumn("pixel", R.encoded16(F.col("elev"), F.col("lo"), F.col("hi")))


def height_pixels(spark, sf_dir):
    """16-bit values of the grid with their high and low bytes."""
    hi, lo = R.split_bytes(F.col("pixel"))
    return _pixels(spark, sf_dir).select(F.col("row").alias("r"), F.col("col").alias("c"), "pixel").withColumns({"high": hi, "low": lo})


def heightmap_tiles(spark, sf_dir):
    """Images of 16 by 16 pixels of the grid, read back: places, their sum, and the sum by place in the tile."""
    tiles = tile_pixels(tile_images(_pixels(spark, sf_dir), 16)).groupBy("tile_row", "tile_col")
    return tiles.agg(F.count("*").alias("places"), F.sum("pixel").alias("total"), F.sum(F.col("pixel") * (F.col("r") * 16 + F.col("c"))).alias("by_place"))


def heightmap_scale(spark, sf_dir):
    points = layer(spark, sf_dir, "dem").selectExpr("col * 30e0 AS x", "row * -30e0 AS z", "elev")
    return R.landscape_scale(points, 1009).select(*(F.round(c, 6).alias(c) for c in ("scale_x", "scale_y", "scale_z", "offset_z")))


def heightmap(spark, sf_dir):
    """The full grid of all parts, eight wide, enlarged by 21 / 8 by cubic convolution."""
    part = table(spark, sf_dir, "part")
    full = part.selectExpr("CAST(floor((p_partkey - 1) / 8) AS INT) AS row", "CAST((p_partkey - 1) % 8 AS INT) AS col", "p_retailprice - 900 AS elev")
    rows = full.agg(F.max("row")).first()[0] + 1
    return R.resampled(full, rows, 8, rows * 21 // 8, 21).select(F.col("row").cast("long").alias("r"), F.col("col").cast("long").alias("c"), F.round("elev", 5).alias("elev"))


def _faces(spark, sf_dir):
    """Four-cornered faces; every 10th is a bow tie and every 7th a sliver."""
    s = table(spark, sf_dir, "part").selectExpr("p_partkey AS id", "p_size AS n", "CAST(p_size AS DOUBLE) AS w", "CASE WHEN p_partkey % 7 = 0 THEN 0.05e0 ELSE 1 + p_partkey % 5 END AS h", "p_partkey % 10 = 0 AS tie")
    at = lambda x, y: F.struct(F.col(x).alias("x") if x else F.lit(0.0).alias("x"), F.col(y).alias("y") if y else F.lit(0.0).alias("y"))
    plain, tie = F.array(at("", ""), at("w", ""), at("w", "h"), at("", "h")), F.array(at("", ""), at("w", "h"), at("w", ""), at("", "h"))
    return s.withColumn("ring", F.when(F.col("tie"), tie).otherwise(plain))


def face_rows(spark, sf_dir):
    r = F.col("ring")
    return _faces(spark, sf_dir).select("id", F.round(G.area(r), 4).alias("square_m"), F.round(G.aspect_ratio(r), 4).alias("aspect"), F.round(F.array_min(G.interior_angles(r)), 4).alias("angle"), G.self_crossings(r).cast("long").alias("crossings"))


def face_qa(spark, sf_dir):
    warn, fail = Q.FACE_LIMITS["aspect"]
    low, lowest = Q.FACE_LIMITS["angle"]
    big, _ = Q.FACE_LIMITS["area"]
    n = F.count_if
    r = F.col("ring")
    rows = _faces(spark, sf_dir).select((G.area(r) * 10).alias("area"), G.aspect_ratio(r).alias("aspect"), F.array_min(G.interior_angles(r)).alias("angle"), G.self_crossings(r).alias("hits"), F.size("ring").alias("verts"))
    return rows.agg(F.max("verts").cast("long").alias("max_verts"), n(F.col("verts") > 4).alias("ngons"), n(F.col("area") > big).alias("large"), n(F.col("aspect") > warn).alias("long_warn"), n(F.col("aspect") > fail).alias("long_fail"), n(F.col("angle") < low).alias("sharp_warn"), n(F.col("angle") < lowest).alias("sharp_fail"), n(F.col("hits") > 0).alias("crossed"), F.round(F.max("area"), 4).alias("max_area"))


def short_edges(spark, sf_dir):
    e = F.array_min(G.edge_lengths(F.col("ring")))
    return _faces(spark, sf_dir).select(e.alias("e")).agg(F.round(F.min("e"), 6).alias("min_edge"), F.count_if(F.col("e") < 0.08).alias("short"))


def normal_stats(spark, sf_dir):
    """Kinds of normals of vectors: up, side, down and degenerate."""
    v = table(spark, sf_dir, "embeddings").selectExpr("vec_id", "CAST(embedding[0] AS DOUBLE) AS x", "CAST(embedding[1] AS DOUBLE) AS y", "CASE WHEN vec_id % 50 = 0 THEN 0e0 ELSE CAST(embedding[2] AS DOUBLE) END AS z", "vec_id % 50 = 0 AS none")
    size = F.sqrt(F.col("x") * F.col("x") + F.col("y") * F.col("y") + F.col("z") * F.col("z"))
    v = v.withColumn("up", F.when(~F.col("none") & (size > 0), F.col("y") / size))
    kind = F.when(F.col("up").isNull(), "degenerate").when(F.col("up") > 0.2, "up").when(F.col("up") < -0.2, "down").otherwise("side")
    return v.groupBy(kind.alias("kind")).agg(F.count("*").alias("n"))


def bevel_corners(spark, sf_dir):
    rows = spread(_faces(spark, sf_dir).filter("NOT tie"), "id")
    both = G.let(G.bevelled(F.col("ring")), lambda r: F.struct(F.size(r).cast("long").alias("corners"), F.round(G.area(r), 4).alias("square_m")))
    return rows.select("id", both.alias("b")).select("id", "b.corners", "b.square_m")


def percentiles_by_area(spark, sf_dir):
    out = O.nearest_rank(layer(spark, sf_dir, "reports"), "value", _SHARES, ["area"])
    return out


def check_severity(spark, sf_dir):
    return Q.severity(layer(spark, sf_dir, "reports"), ["area"])


def severity_total(spark, sf_dir):
    return Q.severity(layer(spark, sf_dir, "reports"))


def latest_report(spark, sf_dir):
    out = Q.latest(layer(spark, sf_dir, "reports"), ["area", "check_name"], [F.desc("ts"), F.desc("report_id")])
    return out.select("area", "check_name", "report_id", "status")


def sampled_rows(spark, sf_dir):
    return O.every_nth(layer(spark, sf_dir, "points"), ["id"], 3000).select("id")


def first_colours(spark, sf_dir):
    c = table(spark, sf_dir, "embeddings").selectExpr("vec_id", "floor(label * 0.25e0 * 4) / 4 AS red", "label % 3 / 3e0 AS green").withColumns({"red": F.round("red", 4), "green": F.round("green", 4)})
    return c.groupBy("red", "green").agg(F.min("vec_id").alias("first_seen")).orderBy("first_seen").limit(8)


QUERIES = {
    f.__name__: f
    for f in (
        dem_crop, dem_missing, dem_valid, dense_rank_index, idw_fill, dtm_delta, dem_quads, bilinear, terrain_sample, terrain_delta_pct,
        snap_base, road_drape, foundation_skirt, height_pixels, heightmap_tiles, heightmap_scale, heightmap, face_rows, face_qa, short_edges, normal_stats,
        bevel_corners, percentiles_by_area, check_severity, severity_total, latest_report, sampled_rows, first_colours,
    )
}

_IDW = DEM + """, x AS (SELECT m.row AS r, m.col AS c, k.elev AS e, CAST((m.row - k.row) * (m.row - k.row) + (m.col - k.col) * (m.col - k.col) AS DOUBLE) AS d FROM dem m JOIN dem k
  ON k.row BETWEEN m.row - 4 AND m.row + 4 AND k.col BETWEEN m.col - 4 AND m.col + 4 WHERE m.masked AND NOT k.masked),
f AS (SELECT r, c, sum(e / d) / sum(1 / d) AS mean FROM x GROUP BY 1, 2),
filled AS (SELECT dem.row AS r, dem.col AS c, dem.elev AS before, coalesce(mean, dem.elev) AS elev, mean IS NOT NULL AS filled FROM dem LEFT JOIN f ON f.r = dem.row AND f.c = dem.col)
"""
_QUADS = DEM + """, q AS (SELECT a.row AS r, a.col AS c, a.elev AS e00, b.elev AS e01, c.elev AS e10, d.elev AS e11 FROM dem a JOIN dem b ON b.row = a.row AND b.col = a.col + 1
JOIN dem c ON c.row = a.row + 1 AND c.col = a.col JOIN dem d ON d.row = a.row + 1 AND d.col = a.col + 1)
"""
_SAMPLE = _QUADS + ", " + cte("points").removeprefix("WITH ") + """, s AS (SELECT points.*, x - floor(x) AS u, z - floor(z) AS v, e00, e01, e10, e11 FROM points LEFT JOIN q ON q.r = floor(z) AND q.c = floor(x)),
t AS (SELECT *, (e00 * (1 - u) + e01 * u) * (1 - v) + (e10 * (1 - u) + e11 * u) * v AS terrain FROM s)
"""
_REPORTS = cte("reports")


def _ranks(value: str, by: str) -> str:
    picks = ", ".join(f"max({value}) FILTER (r = round_even((n - 1) * {q}::DOUBLE, 0)) AS p{round(q * 100):02d}" for q in _SHARES)
    return f"SELECT {by}, {picks} FROM ranked GROUP BY 1"


_FACES = """WITH f AS (SELECT p_partkey AS id, CAST(p_size AS DOUBLE) AS w, CASE WHEN p_partkey % 7 = 0 THEN 0.05e0 ELSE CAST(1 + p_partkey % 5 AS DOUBLE) END AS h, p_partkey % 10 = 0 AS tie FROM part),
g AS (SELECT *, CASE WHEN tie THEN 0e0 ELSE w * h END AS a, CASE WHEN tie THEN sqrt(w * w + h * h) / h ELSE greatest(w, h) / least(w, h) END AS asp,
      CASE WHEN tie THEN degrees(acos(h / sqrt(w * w + h * h))) ELSE 90e0 END AS ang FROM f)
"""

ORACLE_SQL = {
    "dem_crop": DEM + """, m AS (SELECT col * 30e0 - 100 AS x, -row * 30e0 + 50 AS z, elev, row, col FROM dem), k AS (SELECT * FROM m WHERE x BETWEEN 0 AND 900 AND z BETWEEN -600 AND 0)
SELECT x, z, elev, row - min(row) OVER () AS r, col - min(col) OVER () AS c FROM k""",
    "dem_missing": DEM + " SELECT count(*) AS n, count(*) FILTER (col % 7 = 0 OR col % 11 = 0 OR row % 13 = 0) AS missing FROM dem",
    "dem_valid": DEM + " SELECT count(*) AS n, round(avg(elev), 6) AS mean_elev FROM dem WHERE col % 17 <> 0 AND elev >= -9000",
    "dense_rank_index": DEM + ", v AS (SELECT round(col * 30.004e0, 2) AS x, round(row * -29.996e0 + 5, 2) AS z FROM dem) SELECT x, z, dense_rank() OVER (ORDER BY z) - 1 AS r, dense_rank() OVER (ORDER BY x) - 1 AS c FROM v",
    "idw_fill": _IDW + "SELECT r, c, round(elev, 6) AS elev, filled FROM filled",
    "dtm_delta": _IDW + "SELECT count(*) FILTER (filled) AS filled, round(avg(elev - before) FILTER (filled), 6) AS mean_delta, round(max(abs(elev - before)) FILTER (filled), 6) AS max_delta FROM filled",
    "dem_quads": _QUADS + "SELECT r, c, round(e00, 6) AS e00, round(e01, 6) AS e01, round(e10, 6) AS e10, round(e11, 6) AS e11 FROM q",
    "bilinear": _QUADS + """SELECT r * 4 + i AS r, c * 4 + j AS c, round((e00 * (1 - j / 4e0) + e01 * (j / 4e0)) * (1 - i / 4e0) + (e10 * (1 - j / 4e0) + e11 * (j / 4e0)) * (i / 4e0), 6) AS elev
FROM q, range(4) a(i), range(4) b(j)""",
    "terrain_sample": _SAMPLE + "SELECT id, round(terrain, 6) AS terrain FROM t",
    "terrain_delta_pct": _SAMPLE + """, d AS (SELECT kind, terrain, round(value - terrain, 6) AS delta FROM t),
ranked AS (SELECT kind, delta, row_number() OVER (PARTITION BY kind ORDER BY delta) - 1 AS r, count(*) OVER (PARTITION BY kind) AS n FROM d WHERE delta IS NOT NULL),
a AS (SELECT kind, count(*) AS n, count(*) FILTER (terrain IS NULL) AS misses, count(*) FILTER (delta < -0.05) AS below FROM d GROUP BY 1), p AS (""" + _ranks("delta", "kind") + ") SELECT a.*, p01, p05, p50, p95, p99 FROM a LEFT JOIN p ON p.kind = a.kind",
    "snap_base": _SAMPLE + "SELECT id % 500 AS id, round(max(terrain) + 0.05e0, 6) AS base FROM t GROUP BY 1",
    "road_drape": _SAMPLE + """, g AS (SELECT DISTINCT x, z FROM t WHERE terrain IS NULL),
n AS (SELECT x, z, arg_min(elev, struct_pack(d := round(sqrt((x - col) * (x - col) + (z - row) * (z - row)), 9), r := row, c := col)) AS near
FROM g JOIN dem ON dem.row BETWEEN CAST(floor(z) AS BIGINT) - 2 AND CAST(floor(z) AS BIGINT) + 2 AND dem.col BETWEEN CAST(floor(x) AS BIGINT) - 2 AND CAST(floor(x) AS BIGINT) + 2 WHERE elev IS NOT NULL GROUP BY 1, 2)
SELECT id, round(greatest(coalesce(terrain, near, 0), 0) + 0.15e0, 6) AS y FROM t LEFT JOIN n ON n.x = t.x AND n.z = t.z""",
    "heightmap_scale": DEM + " SELECT round((max(col) - min(col)) * 30e0 * 100 / 1008, 6) AS scale_x, round((max(row) - min(row)) * 30e0 * 100 / 1008, 6) AS scale_y, round((max(elev) - min(elev)) * 100 * 128 / 32767, 6) AS scale_z, round(min(elev) * 100, 6) AS offset_z FROM dem",
    "foundation_skirt": _SAMPLE + "SELECT id, CASE WHEN value / 2 - terrain > 0.03e0 THEN round(least(25e0, greatest(0.12e0, value / 2 - terrain)), 6) END AS depth FROM t",
    "height_pixels": DEM + """, p AS (SELECT row AS r, col AS c, CAST(trunc((elev - min(elev) OVER ()) / (max(elev) OVER () - min(elev) OVER ()) * 65535) AS INT) AS pixel FROM dem)
SELECT r, c, pixel, pixel >> 8 AS high, pixel & 255 AS low FROM p""",
    "heightmap_tiles": DEM + """, p AS (SELECT row, col, CAST(trunc((elev - min(elev) OVER ()) / (max(elev) OVER () - min(elev) OVER ()) * 65535) AS BIGINT) AS pixel FROM dem)
SELECT row // 16 AS tile_row, col // 16 AS tile_col, 256 AS places, sum(pixel) AS total, sum(pixel * (row % 16 * 16 + col % 16)) AS by_place FROM p GROUP BY 1, 2""",
    "heightmap": """WITH g AS (SELECT (p_partkey - 1) // 8 AS row, (p_partkey - 1) % 8 AS col, p_retailprice - 900 AS elev FROM part), m AS (SELECT max(row) + 1 AS n FROM g),
side AS (SELECT 0 AS s, n, n * 21 // 8 AS big FROM m UNION ALL SELECT 1, 8, 21),
o AS (SELECT s, i, (i + 0.5e0) * n / big - 0.5e0 AS c, n FROM side, unnest(range(big)) t(i)),
d AS (SELECT s, i, k, abs(c - k) AS t FROM o, unnest(range(greatest(0, floor(c)::BIGINT - 2), least(n, floor(c)::BIGINT + 4))) t(k)),
w AS (SELECT s, i, k, CASE WHEN t < 1 THEN (1.5e0 * t - 2.5e0) * t * t + 1 WHEN t < 2 THEN ((t - 5) * t + 8) * t * -0.5e0 + 2 ELSE 0 END AS w FROM d),
n AS (SELECT s, i, k, w / sum(w) OVER (PARTITION BY s, i) AS w FROM w)
SELECT a.i AS r, b.i AS c, round(sum(elev * a.w * b.w), 5) AS elev FROM g JOIN n a ON a.s = 0 AND a.k = row JOIN n b ON b.s = 1 AND b.k = col GROUP BY 1, 2""",
    "face_rows": _FACES + "SELECT id, round(a, 4) AS square_m, round(asp, 4) AS aspect, round(ang, 4) AS angle, CASE WHEN tie THEN 1 ELSE 0 END AS crossings FROM g",
    "face_qa": _FACES + """SELECT 4 AS max_verts, 0 AS ngons, count(*) FILTER (a * 10 > 750) AS large, count(*) FILTER (asp > 150) AS long_warn, count(*) FILTER (asp > 500) AS long_fail,
count(*) FILTER (ang < 5) AS sharp_warn, count(*) FILTER (ang < 2) AS sharp_fail, count(*) FILTER (tie) AS crossed, round(max(a * 10), 4) AS max_area FROM g""",
    "short_edges": _FACES + "SELECT round(min(least(w, h)), 6) AS min_edge, count(*) FILTER (least(w, h) < 0.08) AS short FROM g",
    "normal_stats": """WITH v AS (SELECT vec_id, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y, embedding[3]::DOUBLE AS z FROM embeddings),
u AS (SELECT CASE WHEN vec_id % 50 <> 0 AND x * x + y * y + z * z > 0 THEN y / sqrt(x * x + y * y + z * z) END AS up FROM v)
SELECT CASE WHEN up IS NULL THEN 'degenerate' WHEN up > 0.2 THEN 'up' WHEN up < -0.2 THEN 'down' ELSE 'side' END AS kind, count(*) AS n FROM u GROUP BY 1""",
    "bevel_corners": _FACES + """, c AS (SELECT *, least(0.6e0, 0.25e0 * least(w, h)) AS cut, least(w, h) >= 0.35 AND least(0.6e0, 0.25e0 * least(w, h)) >= 0.08 AS ok FROM g WHERE NOT tie)
SELECT id, CASE WHEN ok THEN 8 ELSE 4 END AS corners, round(w * h - CASE WHEN ok THEN 2 * cut * cut ELSE 0 END, 4) AS square_m FROM c""",
    "percentiles_by_area": _REPORTS + ", ranked AS (SELECT area, value, row_number() OVER (PARTITION BY area ORDER BY value) - 1 AS r, count(*) OVER (PARTITION BY area) AS n FROM reports) " + _ranks("value", "area"),
    "check_severity": _REPORTS + """ SELECT area, CASE WHEN bool_or(status = 'fail') THEN 'fail' WHEN bool_or(status = 'warn') THEN 'warn' ELSE 'pass' END AS severity,
count(*) FILTER (status = 'pass') AS n_pass, count(*) FILTER (status = 'warn') AS n_warn, count(*) FILTER (status = 'fail') AS n_fail FROM reports GROUP BY 1""",
    "severity_total": _REPORTS + """ SELECT CASE WHEN bool_or(status = 'fail') THEN 'fail' WHEN bool_or(status = 'warn') THEN 'warn' ELSE 'pass' END AS severity,
count(*) FILTER (status = 'pass') AS n_pass, count(*) FILTER (status = 'warn') AS n_warn, count(*) FILTER (status = 'fail') AS n_fail FROM reports""",
    "latest_report": _REPORTS + " SELECT area, check_name, report_id, status FROM reports QUALIFY row_number() OVER (PARTITION BY area, check_name ORDER BY ts DESC, report_id DESC) = 1",
    "sampled_rows": "WITH r AS (SELECT event_id AS id, row_number() OVER (ORDER BY event_id) - 1 AS r, count(*) OVER () AS n FROM events) SELECT id FROM r WHERE r % greatest(1, CAST(ceil(n / 3000.0) AS BIGINT)) = 0",
    "first_colours": "WITH c AS (SELECT vec_id, round(floor(label * 0.25e0 * 4) / 4, 4) AS red, round(label % 3 / 3e0, 4) AS green FROM embeddings) SELECT red, green, min(vec_id) AS first_seen FROM c GROUP BY 1, 2 ORDER BY 3 LIMIT 8",
}
