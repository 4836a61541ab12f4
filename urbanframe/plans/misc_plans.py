"""Queries on tiles, selections, logs, addresses, runs and sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from urbanframe.functions import parsing as P
from urbanframe.operators import order as O, quality as Q, runs as U, tiles as T
from urbanframe.operators.components import connected_components
from urbanframe.plans.layers import cte, layer, table


def tile_assign(spark, sf_dir):
    """Tiles of buildings in UTM, with the buildings on each."""
    from urbanframe.functions.projection import to_utm

    e, n = to_utm(F.col("lon"), F.col("lat"), 47)
    rows = layer(spark, sf_dir, "bld").select((F.floor(e / 1000) * 1000).alias("e"), (F.floor(n / 1000) * 1000).alias("n"))
    return rows.groupBy(P.tile_id(F.lit(47), F.lit(True), F.col("e"), F.col("n")).alias("tile_id")).agg(F.count("*").alias("buildings"))


def viewport_tiles(spark, sf_dir):
    return T.tiles_of_boxes(layer(spark, sf_dir, "clips"), 47).select("id", "tile_id", "easting", "northing")


def tile_corners(spark, sf_dir):
    """The envelopes and centres of all tiles that some clip touches."""
    tiles = T.tiles_of_boxes(layer(spark, sf_dir, "clips"), 47).select("tile_id", "easting", "northing").distinct()
    return T.with_corners(tiles, 47).select("tile_id", "west", "south", "east", "north", "lon", "lat")


def tile_coverage(spark, sf_dir):
    tiles = T.with_corners(T.tiles_of_box(spark, 100.84, 12.88, 100.92, 12.95), 47)
    clips = layer(spark, sf_dir, "clips")
    return T.coverage(tiles, clips.filter("id % 9 = 0"), clips.filter("id % 9 <> 0")).select("tile_id", "source")


def _ids(spark, sf_dir):
    """Tile ids in groups: rectangles, gaps, wrong ids, blanks."""
    return table(spark, sf_dir, "customer").selectExpr(
        "c_nationkey AS g",
        "c_custkey * 7919 % 10007 AS k",
        "CASE WHEN c_nationkey = 3 AND c_custkey % 5 = 0 THEN 'nowhere' WHEN c_custkey % 11 = 0 THEN ' ' WHEN c_nationkey % 2 = 0 THEN concat('z47n_e', CAST(700000 + c_custkey % 3 * 1000 AS STRING), '_n', CAST(1430000 + c_custkey % 2 * 1000 AS STRING), '_s1000') "
        "ELSE concat('z47n_e', CAST(700000 + c_custkey % 7 * 1000 AS STRING), '_n', CAST(1430000 + c_custkey % 5 * 1000 + (c_custkey % 7) * 3000 AS STRING), '_s1000') END AS tile_id",
    )


def tile_select_check(spark, sf_dir):
    return T.selection(_ids(spark, sf_dir), ["g"])


def selection_totals(spark, sf_dir):
    """The tiles of each clip with their sources by place: how many are cached, and from where."""
    source = F.expr("CASE (easting + northing) / 1000 % 4 WHEN 0 THEN 'local' WHEN 1 THEN 'survey' WHEN 2 THEN '' END")
    out = T.selection_totals(T.tiles_of_boxes(layer(spark, sf_dir, "clips"), 47).withColumn("source", source), ["id"])
    return out.withColumn("sources", F.array_join("sources", ","))


def tile_parse(spark, sf_dir):
    rows = _ids(spark, sf_dir).select("tile_id").distinct().withColumn("t", P.tile_parts(F.col("tile_id"))).filter("t IS NOT NULL")
    return rows.select("tile_id", F.col("t.zone").cast("long").alias("zone"), "t.easting", "t.northing")


def ordered_ids(spark, sf_dir):
    """Different ids that aren't blank in the order of their first place."""
    ids = _ids(spark, sf_dir).withColumn("tile_id", F.trim("tile_id")).filter("tile_id <> ''")
    return O.first_places(ids, ["g"], "tile_id", "k")


def progress_max(spark, sf_dir):
    return U.progress(layer(spark, sf_dir, "log")).select("run", "seq", F.col("pct").cast("long").alias("pct"))


def last_lines(spark, sf_dir):
    """The last 80 lines of all runs, found by each task for its own rows first."""
    return layer(spark, sf_dir, "log").orderBy(F.desc("run"), F.desc("seq")).limit(80).select("run", "seq", "line")


def run_tail(spark, sf_dir):
    """The last three lines of each run."""
    return U.last_lines(layer(spark, sf_dir, "log"), 3).select("run", "seq", "line")


def url_parse(spark, sf_dir):
    urls = table(spark, sf_dir, "pages").selectExpr("page_id", "CASE page_id % 4 WHEN 0 THEN concat('https://maps.example.com/@', 12 + page_id % 3, '.9', page_id, ',100.8', page_id, ',', 13 + page_id % 4, 'z') WHEN 1 THEN concat('https://maps.example.com/?ll=-12.5', page_id, ',100.25') WHEN 2 THEN concat('https://maps.example.com/?a=1&q=12.75,-100.', page_id) ELSE url END AS url")
    return urls.select("page_id", P.map_centre(F.col("url")).alias("c")).select("page_id", "c.lat", "c.lon", "c.zoom")


def run_states(spark, sf_dir):
    """The last state of each run from its events."""
    events = table(spark, sf_dir, "events").select(F.col("user_id").alias("run_id"), F.col("ts").alias("time"), F.col("event_type").alias("status"), F.col("event_id").alias("seq"))
    return U.run_states(events).select("run_id", "status", "n_events")


def stale_runs(spark, sf_dir):
    """Runs whose last event is a day or more before the newest of all."""
    e = table(spark, sf_dir, "events").groupBy("user_id").agg(F.max("ts").alias("last"))
    newest = e.agg(F.max("last").alias("now"))
    return e.join(F.broadcast(newest)).filter(F.col("now") - F.col("last") >= F.expr("INTERVAL 24 HOURS")).select(F.col("user_id").alias("run_id"))


def json_levels(spark, sf_dir):
    """A value of each event's properties, 0 where it isn't a number."""
    k = F.get_json_object("props", "$.k").try_cast("long")
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.sum(F.coalesce(k, F.lit(0))).alias("total"), F.count_if(k.isNull()).alias("missing"))


def area_components(spark, sf_dir):
    """Groups of prims that share points (flood fill), with their merged extent."""
    prims = table(spark, sf_dir, "supplier").selectExpr("s_suppkey AS prim", "s_suppkey % 23 AS a", "s_suppkey * s_suppkey % 61 + 23 AS b", "CAST(s_suppkey * 7 % 100 AS DOUBLE) AS x", "CAST(s_suppkey * 11 % 90 AS DOUBLE) AS y")
    e = prims.select(F.concat(F.lit("p"), "prim").alias("src"), F.explode(F.array("a", "b")).alias("v")).select("src", F.concat(F.lit("v"), "v").alias("dst"))
    labels = connected_components(e)
    out = prims.withColumn("node", F.concat(F.lit("p"), "prim")).join(labels, "node")
    return out.groupBy("component").agg(F.count("*").alias("prims"), *(f(c).alias(f"{n}_{c}") for c in "xy" for n, f in (("min", F.min), ("max", F.max)))).filter("min_x <= 60 AND max_x >= 20 AND min_y <= 50 AND max_y >= 10")


def box_touch(spark, sf_dir):
    """Segments whose extent touches the area."""
    s = layer(spark, sf_dir, "segments")
    lo, hi = (lambda c: F.least(f"a{c}", f"b{c}")), (lambda c: F.greatest(f"a{c}", f"b{c}"))
    return s.filter((lo("x") <= 600) & (hi("x") >= 300) & (lo("y") <= 500) & (hi("y") >= 200)).select("id")


def first_samples(spark, sf_dir):
    """The first ten buildings with the sample's verdict."""
    return layer(spark, sf_dir, "bld").orderBy("fid").limit(10).select("fid", (F.coalesce(F.col("raw_height"), F.lit(0.0)) > 0).alias("valid"))


def crop_bounds(spark, sf_dir):
    """Extent of the grid with 50 m around it."""
    return layer(spark, sf_dir, "dem").agg(*(F.expr(e) for e in ("min(col * 30e0) - 50 AS min_x", "max(col * 30e0) + 50 AS max_x", "min(row * -30e0) - 50 AS min_z", "max(row * -30e0) + 50 AS max_z")))


def reject_accounts(spark, sf_dir):
    """Accepted and rejected junctions by reason: uses decide in turn."""
    from urbanframe.operators.roads import junctions

    pts = layer(spark, sf_dir, "points").select(F.col("x"), F.col("z").alias("y"))
    r = F.when(F.col("uses") < 3, "small").when(F.col("uses") > 8, "complex").otherwise("fill")
    return junctions(pts).groupBy(r.alias("reason")).agg(F.count("*").alias("n"))


def source_priority(spark, sf_dir):
    """For each nation the first source that has rows: customers' balances, else suppliers'."""
    a = table(spark, sf_dir, "customer").filter("c_acctbal > 9900").groupBy(F.col("c_nationkey").alias("k")).agg(F.count("*").alias("n"), F.lit(1).alias("priority"), F.lit("first").alias("source"))
    b = table(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").alias("k")).agg(F.count("*").alias("n"), F.lit(2).alias("priority"), F.lit("second").alias("source"))
    best = a.unionByName(b).groupBy("k").agg(F.min_by(F.struct("source", "n"), "priority").alias("b"))
    return best.select("k", "b.source", "b.n")


QUERIES = {
    f.__name__: f
    for f in (
        tile_assign, viewport_tiles, tile_corners, tile_coverage, tile_select_check, selection_totals, tile_parse, ordered_ids, progress_max, last_lines, run_tail,
        url_parse, run_states, stale_runs, json_levels, area_components, box_touch, first_samples, crop_bounds, reject_accounts,
        source_priority,
    )
}


def _oracles() -> dict[str, str]:
    from urbanframe.functions.projection import from_utm, to_utm
    from urbanframe.plans.sqltext import Sql, Text

    e, n = (str(v) for v in to_utm(Text("lon"), Text("lat"), 47, Sql))

    def tiles(west: float, south: float, east: float, north: float) -> str:
        return f"""c AS (SELECT {e} AS e, {n} AS n FROM (VALUES ({west}::DOUBLE, {south}::DOUBLE), ({west}, {north}), ({east}, {south}), ({east}, {north})) v(lon, lat)),
b AS (SELECT CAST(floor(min(e) / 1000) AS BIGINT) AS e0, CAST(floor(max(e) / 1000) AS BIGINT) AS e1, CAST(floor(min(n) / 1000) AS BIGINT) AS n0, CAST(floor(max(n) / 1000) AS BIGINT) AS n1 FROM c),
t AS (SELECT 'z47n_e' || x * 1000 || '_n' || y * 1000 || '_s1000' AS tile_id, x * 1000 AS easting, y * 1000 AS northing FROM b, unnest(range(e0, e1 + 1)) a(x), unnest(range(n0, n1 + 1)) d(y)) """

    sides = [from_utm(Text(f"(easting + {dx})"), Text(f"(northing + {dy})"), 47, True, Sql) for dx in (0, 1000) for dy in (0, 1000)]
    lon, lat = (", ".join(str(s[k]) for s in sides) for k in (0, 1))
    centre = from_utm(Text("(easting + 500e0)"), Text("(northing + 500e0)"), 47, True, Sql)
    box = f"k AS (SELECT tile_id, round(least({lon}), 7) AS west, round(least({lat}), 7) AS south, round(greatest({lon}), 7) AS east, round(greatest({lat}), 7) AS north, round({centre[0]}, 7) AS lon, round({centre[1]}, 7) AS lat FROM t) "
    of_clips = cte("clips") + f""", c AS (SELECT id, {e} AS e, {n} AS n FROM (
SELECT id, west AS lon, south AS lat FROM clips UNION ALL SELECT id, west, north FROM clips UNION ALL SELECT id, east, south FROM clips UNION ALL SELECT id, east, north FROM clips)),
b AS (SELECT id, CAST(floor(min(e) / 1000) AS BIGINT) AS e0, CAST(floor(max(e) / 1000) AS BIGINT) AS e1, CAST(floor(min(n) / 1000) AS BIGINT) AS n0, CAST(floor(max(n) / 1000) AS BIGINT) AS n1 FROM c GROUP BY 1),
s AS (SELECT id, 'z47n_e' || x * 1000 || '_n' || y * 1000 || '_s1000' AS tile_id, x * 1000 AS easting, y * 1000 AS northing
FROM b, unnest(range(e0, e1 + 1)) a(x), unnest(range(n0, n1 + 1)) d(y) WHERE (e1 - e0 + 1) * (n1 - n0 + 1) <= 400) """
    ids = """WITH i AS (SELECT c_nationkey AS g, c_custkey * 7919 % 10007 AS k, CASE WHEN c_nationkey = 3 AND c_custkey % 5 = 0 THEN 'nowhere' WHEN c_custkey % 11 = 0 THEN ' '
WHEN c_nationkey % 2 = 0 THEN 'z47n_e' || (700000 + c_custkey % 3 * 1000) || '_n' || (1430000 + c_custkey % 2 * 1000) || '_s1000'
ELSE 'z47n_e' || (700000 + c_custkey % 7 * 1000) || '_n' || (1430000 + c_custkey % 5 * 1000 + (c_custkey % 7) * 3000) || '_s1000' END AS tile_id FROM customer),
d AS (SELECT DISTINCT g, trim(tile_id) AS tile_id FROM i WHERE trim(tile_id) <> ''),
p AS (SELECT *, try_cast(regexp_extract(tile_id, '_e(\\d+)_', 1) AS BIGINT) AS e, try_cast(regexp_extract(tile_id, '_n(\\d+)_', 1) AS BIGINT) AS n FROM d)
""".replace("\\\\", "\\")
    recursive = """WITH RECURSIVE l AS (SELECT run, seq, line, row_number() OVER (PARTITION BY run ORDER BY seq) AS i FROM log),"""
    log = cte("log").removeprefix("WITH ")
    step = """CASE WHEN regexp_matches(l.line, '^\\[\\d+/\\d+\\]') THEN CASE WHEN CAST(regexp_extract(l.line, '^\\[(\\d+)/', 1) AS INT) >= 6 THEN greatest(p, 75) ELSE greatest(p, least(74, CAST(floor(CAST(regexp_extract(l.line, '^\\[(\\d+)/', 1) AS INT) / 6.0 * 75) AS INT))) END
WHEN l.line LIKE '[Houdini%' THEN greatest(p, least(99, 75 + CAST(floor(CAST(regexp_extract(l.line, ' (\\d+)/', 1) AS INT) / 7.0 * 23) AS INT)))
WHEN l.line LIKE '%[OK]%' AND p < 75 THEN least(74, p + 3) ELSE p END"""
    return {
        "tile_assign": cte("bld") + f", u AS (SELECT CAST(floor({e} / 1000) * 1000 AS BIGINT) AS e, CAST(floor({n} / 1000) * 1000 AS BIGINT) AS n FROM bld) SELECT 'z47n_e' || e || '_n' || n || '_s1000' AS tile_id, count(*) AS buildings FROM u GROUP BY 1",
        "viewport_tiles": of_clips + "SELECT * FROM s",
        "selection_totals": of_clips + """, k AS (SELECT *, CASE (easting + northing) // 1000 % 4 WHEN 0 THEN 'local' WHEN 1 THEN 'survey' END AS source FROM s)
SELECT id, min(easting) AS easting, min(northing) AS northing, count(DISTINCT easting) AS cols, count(DISTINCT northing) AS rows, count(*) AS tiles, count(source) AS cached_tiles, count(source) = count(*) AS cached,
coalesce(string_agg(DISTINCT source, ',' ORDER BY source), '') AS sources FROM k GROUP BY 1""",
        "tile_corners": of_clips + ", t AS (SELECT DISTINCT tile_id, easting, northing FROM s), " + box + "SELECT * FROM k",
        "tile_coverage": cte("clips") + "," + tiles(100.84, 12.88, 100.92, 12.95) + "," + box + """SELECT tile_id, CASE WHEN EXISTS (SELECT 1 FROM clips s WHERE s.id % 9 = 0 AND s.west <= k.west AND s.south <= k.south AND s.east >= k.east AND s.north >= k.north) THEN 'macro'
WHEN EXISTS (SELECT 1 FROM clips s WHERE s.id % 9 <> 0 AND s.west <= k.west AND s.south <= k.south AND s.east >= k.east AND s.north >= k.north) THEN 'clip' ELSE 'none' END AS source FROM k""",
        "tile_select_check": ids + """SELECT g, count(*) AS n, count(DISTINCT e) AS cols, count(DISTINCT n) AS rows, CASE WHEN count(*) FILTER (e IS NULL) > 0 THEN 'bad_id' WHEN count(*) > 256 THEN 'too_many'
WHEN ((max(e) - min(e)) // 1000 + 1) * ((max(n) - min(n)) // 1000 + 1) <> count(*) THEN 'not_rectangle' END AS reason FROM p GROUP BY 1""",
        "tile_parse": ids + "SELECT DISTINCT tile_id, 47 AS zone, e AS easting, n AS northing FROM p WHERE e IS NOT NULL",
        "ordered_ids": ids + """, f AS (SELECT g, trim(tile_id) AS tile_id, min(k) AS k FROM i WHERE trim(tile_id) <> '' GROUP BY 1, 2)
SELECT g, tile_id, row_number() OVER (PARTITION BY g ORDER BY k, tile_id) - 1 AS place FROM f""",
        "progress_max": recursive.replace("WITH RECURSIVE ", "WITH RECURSIVE " + log + ", ") + f"s(run, i, p) AS (SELECT run, 0::BIGINT, 0 FROM (SELECT DISTINCT run FROM l) UNION ALL SELECT l.run, l.i, {step} FROM s JOIN l ON l.run = s.run AND l.i = s.i + 1) SELECT l.run, l.seq, CAST(p AS BIGINT) AS pct FROM s JOIN l ON l.run = s.run AND l.i = s.i",
        "last_lines": cte("log") + " SELECT run, seq, line FROM log ORDER BY run DESC, seq DESC LIMIT 80",
        "run_tail": cte("log") + " SELECT run, seq, line FROM log QUALIFY row_number() OVER (PARTITION BY run ORDER BY seq DESC NULLS LAST, line DESC NULLS LAST) <= 3",
        "url_parse": """WITH u AS (SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'https://maps.example.com/@' || (12 + page_id % 3) || '.9' || page_id || ',100.8' || page_id || ',' || (13 + page_id % 4) || 'z' WHEN 1 THEN 'https://maps.example.com/?ll=-12.5' || page_id || ',100.25'
WHEN 2 THEN 'https://maps.example.com/?a=1&q=12.75,-100.' || page_id ELSE url END AS url FROM pages)
SELECT page_id, CASE page_id % 4 WHEN 0 THEN ((12 + page_id % 3) || '.9' || page_id)::DOUBLE WHEN 1 THEN ('-12.5' || page_id)::DOUBLE WHEN 2 THEN 12.75 END AS lat,
CASE page_id % 4 WHEN 0 THEN ('100.8' || page_id)::DOUBLE WHEN 1 THEN 100.25 WHEN 2 THEN ('-100.' || page_id)::DOUBLE END AS lon, CASE page_id % 4 WHEN 0 THEN (13 + page_id % 4)::DOUBLE WHEN 3 THEN NULL ELSE 14 END AS zoom FROM u""",
        "run_states": "SELECT user_id AS run_id, arg_max(event_type, struct_pack(t := ts, e := event_id)) AS status, count(*) AS n_events FROM events GROUP BY 1",
        "stale_runs": "SELECT user_id AS run_id FROM events GROUP BY 1 HAVING (SELECT max(ts) FROM events) - max(ts) >= INTERVAL 24 HOURS",
        "json_levels": "SELECT event_type, CAST(sum(coalesce(try_cast(json_extract_string(props, '$.k') AS BIGINT), 0)) AS BIGINT) AS total, count(*) FILTER (try_cast(json_extract_string(props, '$.k') AS BIGINT) IS NULL) AS missing FROM events GROUP BY 1",
        "area_components": """WITH RECURSIVE q AS (SELECT s_suppkey AS prim, s_suppkey % 23 AS a, s_suppkey * s_suppkey % 61 + 23 AS b, CAST(s_suppkey * 7 % 100 AS DOUBLE) AS x, CAST(s_suppkey * 11 % 90 AS DOUBLE) AS y FROM supplier),
e AS (SELECT 'p' || prim AS u, 'v' || a AS v FROM q UNION SELECT 'p' || prim, 'v' || b FROM q), w AS (SELECT u, v FROM e UNION SELECT v, u FROM e),
r(u, v) AS (SELECT u, u FROM w UNION SELECT r.u, w.v FROM r JOIN w ON w.u = r.v), c AS (SELECT u, min(v) AS component FROM r GROUP BY 1)
SELECT component, count(*) AS prims, min(x) AS min_x, max(x) AS max_x, min(y) AS min_y, max(y) AS max_y FROM q JOIN c ON u = 'p' || prim GROUP BY 1 HAVING min(x) <= 60 AND max(x) >= 20 AND min(y) <= 50 AND max(y) >= 10""",
        "box_touch": cte("segments") + " SELECT id FROM segments s WHERE least(s.ax, s.bx) <= 600 AND greatest(s.ax, s.bx) >= 300 AND least(s.ay, s.by) <= 500 AND greatest(s.ay, s.by) >= 200",
        "first_samples": cte("bld") + " SELECT fid, coalesce(raw_height, 0) > 0 AS valid FROM bld ORDER BY fid LIMIT 10",
        "crop_bounds": cte("dem") + " SELECT min(col * 30e0) - 50 AS min_x, max(col * 30e0) + 50 AS max_x, min(row * -30e0) - 50 AS min_z, max(row * -30e0) + 50 AS max_z FROM dem",
        "reject_accounts": cte("points") + ", j AS (SELECT count(*) AS uses FROM points GROUP BY round_even(x, 0), round_even(z, 0) HAVING count(*) >= 2) SELECT CASE WHEN uses < 3 THEN 'small' WHEN uses > 8 THEN 'complex' ELSE 'fill' END AS reason, count(*) AS n FROM j GROUP BY 1",
        "source_priority": """WITH a AS (SELECT c_nationkey AS k, count(*) AS n FROM customer WHERE c_acctbal > 9900 GROUP BY 1), b AS (SELECT s_nationkey AS k, count(*) AS n FROM supplier GROUP BY 1)
SELECT coalesce(a.k, b.k) AS k, CASE WHEN a.k IS NOT NULL THEN 'first' ELSE 'second' END AS source, coalesce(a.n, b.n) AS n FROM a FULL JOIN b ON a.k = b.k""",
    }


ORACLE_SQL = _oracles()
