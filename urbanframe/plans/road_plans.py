"""Queries on road ways, their network and polylines."""

from __future__ import annotations

from pyspark.sql import functions as F

from urbanframe.functions import parsing as P
from urbanframe.operators import roads as R
from urbanframe.operators.components import connected_components
from urbanframe.plans.layers import cte, layer, planar, planar_sql, table, ways


def _whole(spark, sf_dir):
    """All ways of two nodes or more."""
    return ways(spark, sf_dir).filter("size(refs) >= 2")


_WHOLE = cte("way_nodes") + """, n AS (SELECT * FROM way_nodes QUALIFY count(*) OVER (PARTITION BY way_id) >= 2),
e AS (SELECT way_id, seq, ref AS src, lead(ref) OVER (PARTITION BY way_id ORDER BY seq) AS dst FROM n),
ends AS (SELECT way_id, arg_min(ref, seq) AS a, arg_max(ref, seq) AS b FROM n GROUP BY 1)
"""
#: Least labels, of which each node keeps one, so the one large component takes few rows.
_REACH = _WHOLE.replace("WITH ", "WITH RECURSIVE ", 1) + """, both_ways AS (SELECT src::BIGINT AS u, dst::BIGINT AS v FROM e WHERE dst IS NOT NULL UNION SELECT dst::BIGINT, src::BIGINT FROM e WHERE dst IS NOT NULL),
label(u, c) USING KEY (u) AS (SELECT DISTINCT u, u FROM both_ways UNION SELECT l.u, min(near.c) FROM label near JOIN both_ways b ON b.u = near.u JOIN recurring.label l ON l.u = b.v WHERE near.c < l.c GROUP BY 1)"""


def way_filter_report(spark, sf_dir):
    out = R.way_reasons(ways(spark, sf_dir), layer(spark, sf_dir, "nodes"))
    return out.groupBy("reject_reason").agg(F.count("*").alias("n"))


def highway_hist(spark, sf_dir):
    return layer(spark, sf_dir, "way_tags").filter("highway IS NOT NULL").groupBy("highway").agg(F.count("*").alias("n"))


def highway_top(spark, sf_dir):
    return highway_hist(spark, sf_dir).orderBy(F.desc("n"), "highway").limit(8)


def road_coverage(spark, sf_dir):
    from urbanframe.operators.quality import attribute_coverage

    return attribute_coverage(layer(spark, sf_dir, "way_tags").filter("highway IS NOT NULL"))


def way_bbox_semijoin(spark, sf_dir):
    """Nodes of all ways with a highway and a node in the box, with their ways."""
    nodes = layer(spark, sf_dir, "nodes")
    inside = nodes.filter(F.col("lon").between(100.841, 100.8415) & F.col("lat").between(12.891, 12.8914)).select(F.col("id").alias("ref"))
    refs = layer(spark, sf_dir, "way_nodes").join(layer(spark, sf_dir, "way_tags").filter("highway IS NOT NULL").select("way_id"), "way_id", "left_semi")
    hit = refs.join(inside, "ref", "left_semi").select("way_id").distinct()
    return refs.join(hit, "way_id", "left_semi").groupBy("way_id").agg(F.count("*").alias("n_refs"))


def way_geometry(spark, sf_dir):
    """Ways with the middle of their known nodes; missing refs are skipped."""
    nodes = layer(spark, sf_dir, "nodes").withColumnRenamed("id", "ref")
    return layer(spark, sf_dir, "way_nodes").join(nodes, "ref").groupBy("way_id").agg(F.count("*").alias("known"), F.round(F.avg("lon"), 9).alias("lon"), F.round(F.avg("lat"), 9).alias("lat"))


def edges(spark, sf_dir):
    return R.way_edges(layer(spark, sf_dir, "way_nodes"))


def endpoints(spark, sf_dir):
    return ways(spark, sf_dir).filter("refs IS NOT NULL").select("way_id", F.element_at("refs", 1).alias("a"), F.element_at("refs", -1).alias("b"))


def road_components(spark, sf_dir):
    """All ways, most of which are one component."""
    return R.connectivity(_whole(spark, sf_dir)).withColumn("largest_share", F.round("largest_share", 6))


def node_components(spark, sf_dir):
    nodes = _whole(spark, sf_dir).select("way_id", F.posexplode("refs").alias("seq", "ref"))
    return connected_components(R.way_edges(nodes).select(F.col("src").cast("long").alias("src"), F.col("dst").cast("long").alias("dst")))


def dangling(spark, sf_dir):
    return R.end_degrees(_whole(spark, sf_dir))


def half_width(spark, sf_dir):
    rows = layer(spark, sf_dir, "way_tags").withColumns({"w": P.width_m(F.col("width")), "l": P.lane_count(F.col("lanes"))})
    return rows.select("way_id", R.half_width(F.col("highway"), F.col("w"), F.col("l")).alias("half_width"))


def tag_numbers(spark, sf_dir):
    return layer(spark, sf_dir, "way_tags").select("way_id", P.lane_count(F.col("lanes")).cast("long").alias("lanes"), P.width_m(F.col("width")).alias("width"))


def merge_groups(spark, sf_dir):
    """Ways for each set of tags that allows merging."""
    tags = [F.coalesce(F.col(t), F.lit("")).alias(t) for t in ("highway", "lanes", "width", "oneway")]
    return layer(spark, sf_dir, "way_tags").groupBy(*tags).agg(F.count("*").alias("n"))


def _polylines(spark, sf_dir):
    nodes = planar(layer(spark, sf_dir, "nodes")).select(F.col("id").alias("ref"), "x", F.col("z").alias("y"))
    return layer(spark, sf_dir, "way_nodes").join(nodes, "ref").select(F.col("way_id").alias("road"), "seq", "ref", "x", "y")


_POLY = cte("nodes", "way_nodes") + f""", q AS (SELECT way_id AS road, seq, ref, x, z AS y FROM way_nodes JOIN {planar_sql('nodes')} m ON m.id = ref),
s AS (SELECT *, coalesce(sqrt(pow(x - lag(x) OVER w, 2) + pow(y - lag(y) OVER w, 2)), 0e0) AS step,
      coalesce(lead(x) OVER w, x) - coalesce(lag(x) OVER w, x) AS dx, coalesce(lead(y) OVER w, y) - coalesce(lag(y) OVER w, y) AS dy FROM q WINDOW w AS (PARTITION BY road ORDER BY seq))
"""


def cum_len(spark, sf_dir):
    return R.along(_polylines(spark, sf_dir)).select("road", "seq", F.round("travelled", 2).alias("travelled"))


def tangents(spark, sf_dir):
    return R.along(_polylines(spark, sf_dir)).select("road", "seq", F.round("tx", 4).alias("tx"), F.round("ty", 4).alias("ty"))


def junction_places(spark, sf_dir):
    return R.junctions(_polylines(spark, sf_dir)).select(F.col("jx").cast("long").alias("jx"), F.col("jy").cast("long").alias("jy"), "uses")


def chunk_split(spark, sf_dir):
    rows = layer(spark, sf_dir, "way_nodes").withColumnRenamed("way_id", "road").withColumn("is_junction", F.col("ref").cast("long") % 3 == 0)
    return R.split_at(rows).groupBy("road", "chunk").agg(F.count("*").alias("n"), F.min("seq").cast("long").alias("first_seq"), F.max("seq").cast("long").alias("last_seq"))


def short_steps(spark, sf_dir):
    """Points of each way that stay when those nearer than 300 m to the last kept one go."""
    pts = _polylines(spark, sf_dir).groupBy("road").agg(F.sort_array(F.collect_list(F.struct("seq", "x", "y"))).alias("p"))
    kept = R.collapsed(F.transform("p", lambda v: F.struct(v["x"].alias("x"), v["y"].alias("y"))), 300.0)
    return pts.select("road", F.size("p").cast("long").alias("n_in"), F.size(kept).cast("long").alias("n_out"))


def long_segments(spark, sf_dir):
    """Segments of ways without those of hardly any length, as between two equal nodes."""
    return R.long_segments(_polylines(spark, sf_dir)).select("road", "seq", F.round("length", 2).alias("length"))


def weld_ends(spark, sf_dir):
    nodes = planar(layer(spark, sf_dir, "nodes")).select("id", "x", F.col("z").alias("y"))
    whole = _whole(spark, sf_dir).select("way_id", "refs")
    return R.weld(whole, nodes, 20.0).select("way_id", F.element_at("refs", 1).alias("a"), F.element_at("refs", -1).alias("b"), F.size("refs").cast("long").alias("n"), "welded")


def weld_first(spark, sf_dir):
    """Ends at one place become the one that is first by a given order, for ids that are no numbers."""
    named = lambda c: F.concat(F.lit("n"), c)
    nodes = planar(layer(spark, sf_dir, "nodes")).select(named("id").alias("id"), "x", F.col("z").alias("y"), (-F.col("id").cast("long")).alias("seq"))
    whole = _whole(spark, sf_dir).select("way_id", F.transform("refs", named).alias("refs"))
    return R.weld(whole, nodes).select("way_id", F.element_at("refs", 1).alias("a"), F.element_at("refs", -1).alias("b"), "welded")


def chain_merge(spark, sf_dir):
    rows = _whole(spark, sf_dir)
    for t in R.MERGE_TAGS:
        if t not in rows.columns:
            rows = rows.withColumn(t, F.lit(None).cast("string"))
    return R.merge_chains(rows).select("way_id", "highway", F.size("refs").cast("long").alias("n_refs"), "merged")


def tag_reconciliation(spark, sf_dir):
    """Merged layers hold as many tagged rows as their inputs."""
    a = layer(spark, sf_dir, "way_tags").select(F.lit("road").alias("tag"), F.col("num").alias("id"))
    b = layer(spark, sf_dir, "bld").select(F.lit("building").alias("tag"), F.col("fid").alias("id"))
    c = layer(spark, sf_dir, "dem").select(F.lit("terrain").alias("tag"), F.col("col").alias("id"))
    merged = a.unionByName(b).unionByName(c.withColumn("extra", F.lit(1)), allowMissingColumns=True)
    return merged.groupBy("tag").agg(F.count("*").alias("n"), F.count("extra").alias("with_extra"))


def dropped_ways(spark, sf_dir):
    """Difference: the ids that a filter takes away."""
    tags = layer(spark, sf_dir, "way_tags")
    return tags.select("way_id").join(tags.filter(F.col("highway").isin(*R.KINDS)).select("way_id"), "way_id", "left_anti")


QUERIES = {
    f.__name__: f
    for f in (
        way_filter_report, highway_hist, highway_top, road_coverage, way_bbox_semijoin, way_geometry, edges, endpoints, road_components,
        node_components, dangling, half_width, tag_numbers, merge_groups, cum_len, tangents, junction_places, chunk_split,
        short_steps, long_segments, weld_ends, weld_first, chain_merge, tag_reconciliation, dropped_ways,
    )
}

_KINDS = ", ".join(f"'{k}'" for k in R.KINDS)
_WIDTHS = " ".join(f"WHEN '{k}' THEN {v}e0" for k, v in R.HALF_WIDTH.items())
_LOW = " ".join(f"WHEN highway IN ({', '.join(repr(k) for k in ks)}) THEN {a}e0" for ks, a, _ in R.RANGES)
_HIGH = " ".join(f"WHEN highway IN ({', '.join(repr(k) for k in ks)}) THEN {b}e0" for ks, _, b in R.RANGES)
_TAGS = cte("way_tags") + ", t AS (SELECT *, coalesce(try_cast(trim(lanes) AS INT), 0) AS l, coalesce(try_cast(trim(replace(width, 'm', '')) AS DOUBLE), 0e0) AS w FROM way_tags) "

ORACLE_SQL = {
    # a step for each point: the place of the last kept one goes with it
    "short_steps": _POLY.replace("WITH ", "WITH RECURSIVE ", 1) + """, o AS (SELECT road, x, y, row_number() OVER (PARTITION BY road ORDER BY seq) AS k FROM q),
w(road, k, kx, ky, kept) AS (SELECT road, k, x, y, 1 FROM o WHERE k = 1 UNION ALL
SELECT o.road, o.k, CASE WHEN sqrt(pow(x - kx, 2) + pow(y - ky, 2)) >= 300 THEN x ELSE kx END, CASE WHEN sqrt(pow(x - kx, 2) + pow(y - ky, 2)) >= 300 THEN y ELSE ky END,
CASE WHEN sqrt(pow(x - kx, 2) + pow(y - ky, 2)) >= 300 THEN 1 ELSE 0 END FROM w JOIN o ON o.road = w.road AND o.k = w.k + 1)
SELECT road, count(*) AS n_in, CAST(sum(kept) AS BIGINT) AS n_out FROM w GROUP BY 1""",
    "long_segments": _POLY + """, g AS (SELECT road, seq, sqrt(pow(lead(x) OVER w - x, 2) + pow(lead(y) OVER w - y, 2)) AS length FROM q WINDOW w AS (PARTITION BY road ORDER BY seq))
SELECT road, seq, round(length, 2) AS length FROM g WHERE length >= 0.25""",
    "way_filter_report": cte("nodes", "way_nodes", "way_tags") + f""", c AS (SELECT way_id, count(*) AS n, count(*) FILTER (id IS NULL) AS missing FROM way_nodes LEFT JOIN nodes ON id = ref GROUP BY 1)
SELECT CASE WHEN coalesce(n, 0) < 2 THEN 'short' WHEN missing > 0 THEN 'orphan' WHEN highway NOT IN ({_KINDS}) THEN 'type' END AS reject_reason, count(*) AS n
FROM way_tags LEFT JOIN c ON c.way_id = way_tags.way_id GROUP BY 1""",
    "highway_hist": cte("way_tags") + " SELECT highway, count(*) AS n FROM way_tags WHERE highway IS NOT NULL GROUP BY 1",
    "highway_top": cte("way_tags") + " SELECT highway, count(*) AS n FROM way_tags WHERE highway IS NOT NULL GROUP BY 1 ORDER BY n DESC, highway LIMIT 8",
    "road_coverage": cte("way_tags") + """ SELECT count(*) AS n, count(*) FILTER (trim(coalesce(lanes, '')) NOT IN ('', '0')) AS with_lanes, count(*) FILTER (coalesce(oneway, '') <> '') AS with_oneway,
count(*) FILTER (trim(coalesce(width, '')) NOT IN ('', '0')) AS with_width FROM way_tags WHERE highway IS NOT NULL""",
    "way_bbox_semijoin": cte("nodes", "way_nodes", "way_tags") + """, r AS (SELECT n.* FROM way_nodes n JOIN way_tags t ON t.way_id = n.way_id WHERE highway IS NOT NULL)
SELECT way_id, count(*) AS n_refs FROM r WHERE way_id IN (SELECT way_id FROM r JOIN nodes ON id = ref WHERE lon BETWEEN 100.841e0 AND 100.8415e0 AND lat BETWEEN 12.891e0 AND 12.8914e0) GROUP BY 1""",
    "way_geometry": cte("nodes", "way_nodes") + " SELECT way_id, count(*) AS known, round(avg(lon), 9) AS lon, round(avg(lat), 9) AS lat FROM way_nodes JOIN nodes ON id = ref GROUP BY 1",
    "edges": cte("way_nodes") + ", e AS (SELECT way_id, seq, ref AS src, lead(ref) OVER (PARTITION BY way_id ORDER BY seq) AS dst FROM way_nodes) SELECT * FROM e WHERE dst IS NOT NULL",
    "endpoints": cte("way_nodes") + " SELECT way_id, arg_min(ref, seq) AS a, arg_max(ref, seq) AS b FROM way_nodes GROUP BY 1",
    "road_components": _REACH + """, s AS (SELECT c, count(*) AS n FROM ends JOIN label ON u = a::BIGINT GROUP BY 1),
g AS (SELECT node, count(*) AS degree FROM (SELECT a AS node FROM ends UNION ALL SELECT b FROM ends) GROUP BY 1)
SELECT count(*) AS components, CAST(sum(n) AS BIGINT) AS ways, max(n) AS largest_ways, round(max(n) / sum(n), 6) AS largest_share, (SELECT count(*) FROM g WHERE degree = 1) AS dangling,
CASE WHEN max(n) / sum(n) < 0.6 AND count(*) > 1 THEN 'warn' ELSE 'pass' END AS status FROM s""",
    "node_components": _REACH + " SELECT u AS node, c AS component FROM label",
    "dangling": _WHOLE + " SELECT node, count(*) AS degree FROM (SELECT a AS node FROM ends UNION ALL SELECT b FROM ends) GROUP BY 1",
    "half_width": _TAGS + f", h AS (SELECT *, CASE WHEN w > 0 THEN w * 0.5e0 WHEN l > 0 THEN l * 1.75e0 ELSE CASE highway {_WIDTHS} ELSE 1.5e0 END END AS h FROM t) SELECT way_id, least(CASE {_HIGH} ELSE 5e0 END, greatest(CASE {_LOW} ELSE 0.75e0 END, h)) AS half_width FROM h",
    "tag_numbers": _TAGS + " SELECT way_id, CAST(l AS BIGINT) AS lanes, w AS width FROM t",
    "merge_groups": cte("way_tags") + " SELECT coalesce(highway, '') AS highway, coalesce(lanes, '') AS lanes, coalesce(width, '') AS width, coalesce(oneway, '') AS oneway, count(*) AS n FROM way_tags GROUP BY 1, 2, 3, 4",
    "cum_len": _POLY + " SELECT road, seq, round(sum(step) OVER (PARTITION BY road ORDER BY seq), 2) AS travelled FROM s",
    "tangents": _POLY + " SELECT road, seq, CASE WHEN sqrt(dx * dx + dy * dy) > 0 THEN round(dx / sqrt(dx * dx + dy * dy), 4) END AS tx, CASE WHEN sqrt(dx * dx + dy * dy) > 0 THEN round(dy / sqrt(dx * dx + dy * dy), 4) END AS ty FROM s",
    "junction_places": _POLY + " SELECT CAST(round_even(x, 0) AS BIGINT) AS jx, CAST(round_even(y, 0) AS BIGINT) AS jy, count(*) AS uses FROM q GROUP BY 1, 2 HAVING count(*) >= 2",
    "chunk_split": cte("way_nodes") + """, m AS (SELECT *, ref::BIGINT % 3 = 0 AND seq > 1 AND lead(1) OVER (PARTITION BY way_id ORDER BY seq) IS NOT NULL AS cut FROM way_nodes),
c AS (SELECT *, sum(cut::INT) OVER (PARTITION BY way_id ORDER BY seq) AS k FROM m),
b AS (SELECT way_id, seq, k FROM c UNION ALL SELECT way_id, seq, k - 1 FROM c WHERE cut)
SELECT way_id AS road, CAST(k AS BIGINT) AS chunk, count(*) AS n, min(seq) AS first_seq, max(seq) AS last_seq FROM b GROUP BY 1, 2""",
    "weld_first": cte("nodes", "way_nodes") + """, e AS (SELECT way_id, arg_min(ref, seq) AS a, arg_max(ref, seq) AS b FROM way_nodes GROUP BY 1 HAVING count(*) >= 2),
u AS (SELECT a AS id FROM e UNION SELECT b FROM e),
r AS (SELECT id, CAST(max(CAST(id AS BIGINT)) OVER (PARTITION BY lon, lat) AS VARCHAR) AS rep FROM u JOIN nodes USING (id))
SELECT way_id, 'n' || coalesce(p.rep, a) AS a, 'n' || coalesce(q.rep, b) AS b, CAST(coalesce(p.rep, a) <> a AS INT) + CAST(coalesce(q.rep, b) <> b AS INT) AS welded
FROM e LEFT JOIN r p ON p.id = a LEFT JOIN r q ON q.id = b""",
    "tag_reconciliation": cte("way_tags", "bld", "dem") + " SELECT 'road' AS tag, count(*) AS n, 0 AS with_extra FROM way_tags UNION ALL SELECT 'building', count(*), 0 FROM bld UNION ALL SELECT 'terrain', count(*), count(*) FROM dem",
    "dropped_ways": cte("way_tags") + f" SELECT way_id FROM way_tags WHERE highway IS NULL OR highway NOT IN ({_KINDS})",
}
