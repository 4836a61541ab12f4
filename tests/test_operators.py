"""Operators that SQL can't express, against plain sequential versions; projections against known properties."""

import math
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from urbanframe.functions import geometry as G, projection as PR
from urbanframe.operators import order as O, quality as Q, roads as R, runs as U, spatial as S
from urbanframe.operators.components import connected_components


def test_keep_first(spark):
    rng = random.Random(2)
    pts = [(i, rng.uniform(0, 60), rng.uniform(0, 60)) for i in range(400)]
    kept = []
    for p in pts:
        if all(math.hypot(p[1] - q[1], p[2] - q[2]) >= 3 for q in kept):
            kept.append(p)
    df = spark.createDataFrame(pts, "id long, x double, y double").repartition(5)
    assert sorted(r.id for r in S.dedup_within(df, 3.0).collect()) == [p[0] for p in kept]


def test_chain_of_three(spark):
    df = spark.createDataFrame([(1, 0.0, 0.0), (2, 2.0, 0.0), (3, 4.0, 0.0)], "id long, x double, y double")
    assert sorted(r.id for r in S.dedup_within(df, 3.0).collect()) == [1, 3]


def test_uncovered(spark):
    primary = spark.createDataFrame([(0, 5.0, 5.0)], "id long, x double, y double")
    extra = spark.createDataFrame([(1, 20.0, 5.0), (2, 100.0, 5.0), (3, 110.0, 5.0), (4, -14.0, 5.0), (5, 140.0, 5.0)], "id long, x double, y double")
    assert sorted(r.id for r in S.uncovered(extra, primary, 15.0).collect()) == [2, 5]


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(500 + i, 501 + i) for i in range(30)] + [(7, 7)]
    label = {n: n for e in edges for n in e}
    for _ in range(60):
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    df = spark.createDataFrame([*edges, (None, 3)], "src long, dst long")
    assert {r.node: r.component for r in connected_components(df).collect()} == label


def test_weld(spark):
    ways = spark.createDataFrame([("a", ["1", "2"]), ("b", ["3", "4"]), ("c", ["5", "6"]), ("d", ["x", "1"])], "way_id string, refs array<string>")
    nodes = spark.createDataFrame([("1", 0.0, 0.0), ("2", 50.0, 0.0), ("3", 50.8, 0.0), ("4", 90.0, 0.0), ("5", 51.6, 0.0), ("6", 0.0, 70.0), ("x", 0.0, 71.0)], "id string, x double, y double")
    got = {r.way_id: (r.refs, r.welded) for r in R.weld(ways, nodes).collect()}
    assert got["b"] == (["2", "4"], 1) and got["c"][0][0] == "2" and got["a"] == (["1", "2"], 0) and got["d"][1] + got["c"][1] == 2


def test_chains(spark):
    base = dict.fromkeys(R.MERGE_TAGS, "")
    rows = [("1", ["a", "b"], "x", ""), ("2", ["b", "c"], "x", ""), ("3", ["d", "c"], "x", ""), ("4", ["d", "e"], "y", ""), ("5", ["p", "q"], "x", "yes"), ("6", ["r", "q"], "x", "yes"), ("7", ["l", "m", "l"], "x", "")]
    df = spark.createDataFrame([(w, r, *({**base, "highway": h, "oneway": o}[t] for t in R.MERGE_TAGS)) for w, r, h, o in rows], "way_id string, refs array<string>, " + ", ".join(f"{t} string" for t in R.MERGE_TAGS))
    got = {r.way_id: (list(r.refs), r.merged) for r in R.merge_chains(df).collect()}
    assert got["1"] == (["a", "b", "c", "d"], 3) and got["4"] == (["d", "e"], 1) and got["5"][1] == got["6"][1] == got["7"][1] == 1


@pytest.mark.parametrize(
    ("lon", "lat", "zone", "east", "north"),
    [(2.2945, 48.858222, 31, 448251.8, 5411932.7), (-79.387139, 43.642567, 17, 630084.0, 4833439.0), (3.0, 0.0, 31, 500000.0, 0.0)],
)
def test_known_places(lon, lat, zone, east, north):
    """Published coordinates of two towers, and the middle of a zone on the equator."""
    assert int((lon + 180) // 6) + 1 == zone
    e, n = PR.to_utm(lon, lat, zone, PR.PLAIN)
    assert abs(e - east) < 2.5 and abs(n - north) < 2.5, (e, n)
    assert max(abs(a - b) for a, b in zip(PR.from_utm(east, north, zone, lat >= 0, PR.PLAIN), (lon, lat), strict=True)) < 3e-5


def test_projection():
    p = PR.Projector(100.87, 12.92)
    assert max(map(abs, p.local(100.87, 12.92, PR.PLAIN))) < 1e-4
    x, z = p.local(100.88, 12.93, PR.PLAIN)
    assert x > 0 and z > 0 and p.scene(100.88, 12.93, PR.PLAIN)[1] == -z
    for lon, lat in ((100.1, 12.5), (101.9, -33.0), (99.2, 70.0)):
        e, n = PR.to_utm(lon, lat, 47, PR.PLAIN)
        back = PR.from_utm(e, n, 47, lat >= 0, PR.PLAIN)
        assert abs(back[0] - lon) < 1e-7 and abs(back[1] - lat) < 1e-7


def test_rings(spark):
    rows = spark.createDataFrame([(1,)], "id int")
    ring = lambda *p: F.array(*(F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in p))
    closed = ring((0, 0), (0, 0), (4, 0), (4, 4), (0, 4), (0, 0))
    r = rows.select(
        F.size(G.unique_points(closed)).alias("n"), G.signed_area(G.unique_points(closed)).alias("a"),
        G.contains(G.unique_points(closed), F.lit(1.0), F.lit(1.0)).alias("inside"), G.contains(G.unique_points(closed), F.lit(5.0), F.lit(1.0)).alias("outside"),
        F.size(G.bevelled(G.unique_points(closed))).alias("bevelled"), G.signed_area(ring((0, 0), (1, 1))).alias("two"), G.self_crossings(ring((0, 0), (1, 1), (1, 0), (0, 1))).alias("tie"),
    ).first()
    assert (r.n, r.a, r.inside, r.outside, r.bevelled, r.two, r.tie) == (4, 16.0, True, False, 8, 0.0, 1)


def test_nearest_rank(spark):
    df = spark.createDataFrame([(float(i),) for i in range(4)] + [(None,)], "v double")
    assert O.nearest_rank(df, "v", [0.5]).first().p50 == 2.0


def test_collapsed(spark):
    pts = F.array(*(F.struct(F.lit(x).alias("x"), F.lit(0.0).alias("y")) for x in (0.0, 0.2, 0.4, 0.9)))
    assert [p.x for p in spark.range(1).select(R.collapsed(pts, 0.3).alias("p")).first().p] == [0.0, 0.4, 0.9]


def test_runs(spark, tmp_path):
    assert U.run_id("a b/ü", datetime(2024, 1, 2, 3, 4, 5)) == "20240102_030405_a_b"
    with pytest.raises(ValueError):
        U.checked_id("../outside")
    with pytest.raises(ValueError):
        U.normal_box([1, 2, 0, 3])
    assert U.fingerprint({"b": 1, "a": 2}) == U.fingerprint({"a": 2, "b": 1})
    target = f"file://{tmp_path}/ready"
    assert U.publish(spark.range(3), target, lambda df: df.count() == 3) and spark.read.parquet(target).count() == 3
    assert not U.publish(spark.range(5), target, lambda df: False) and spark.read.parquet(target).count() == 3
    assert U.publish(spark.range(7), target, lambda df: True) and spark.read.parquet(target).count() == 7


def test_strips(spark):
    from urbanframe.operators import strips as ST

    pts = spark.createDataFrame([("r", 1, 0.0, 0.0, 2.0), ("r", 2, 10.0, 0.0, 2.0), ("r", 3, 20.0, 0.0, 2.0)], "road string, seq int, x double, y double, half_width double")
    assert [(r.length, r.square_m) for r in ST.strip_quads(pts).orderBy("seq").collect()] == [(10.0, 40.0)] * 2
    crossings = spark.createDataFrame([("r", 1, 0.5, 5.0, 0.0), ("r", 1, 0.51, 5.1, 0.0), ("r", 1, 0.99, 9.9, 0.0)], "road string, seq int, t double, x double, y double")
    assert [r.x for r in ST.with_crossings(pts.drop("half_width"), crossings).orderBy("seq").collect()] == [0.0, 5.0, 9.9, 10.0, 20.0]  # a point of the line stays from 5 cm on
    square = [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0)]
    assert len(ST.convex_hull([*square, (0.5, 0.5), (0.5, 0.0)])) == 4 and ST.polygon_area(ST.clipped(square, (0.5, 0.5, 9.0, 9.0))) == 0.25 and ST.clipped(square, (5.0, 5.0, 9.0, 9.0)) == []
    rows = [(1, 0, *p, 1.0) for p in square] + [(2, 0, 0.0, 0.0, 1.0)] * 2 + [(3, 0, float(i), 0.0, 1.0) for i in range(9)] + [(4, 0, 0.0, 0.0, 1.0), (4, 0, 50.0, 0.0, 1.0), (4, 0, 0.0, 50.0, 1.0)] + [(5, 0, 0.0, 0.0, 1.0), (5, 0, 1.0, 0.0, 1.0), (5, 0, 2.0, 0.0, 1.0)] + [(6, 0, 3 * x, 3 * y, 0.4) for x, y in square]
    got = {r.jx: (r.reason, r.square_m) for r in ST.junction_fills(spark.createDataFrame(rows, "jx int, jy int, x double, y double, half_width double")).collect()}
    assert got == {1: (None, 1.0), 2: ("small", None), 3: ("complex", None), 4: ("radius", None), 5: ("small", None), 6: ("area", None)}
    face = spark.createDataFrame([(1, [{"x": x, "y": y} for x, y in square], 2.0, 3.0)], "id int, ring array<struct<x:double,y:double>>, base double, height double")
    parts = [r.part for r in ST.extruded(face, "height").collect()]
    assert parts.count("side") == 4 and parts.count("top") == parts.count("bottom") == 1
    assert ST.clip_faces(face, (0.5, 0.0, 1.0, 1.0)).count() == 1 and ST.clip_faces(face, (2.0, 2.0, 3.0, 3.0)).count() == 0


def test_refine(spark):
    from urbanframe.operators import refine as RF

    ring = lambda x, s: [[{"x": x, "y": 0.0}, {"x": x + s, "y": 0.0}, {"x": x + s, "y": s}, {"x": x, "y": s}, {"x": x, "y": 0.0}]]
    b = [(1, "Polygon", ring(0.0, 5.0), 12.0, 0.0, 0.0), (2, "Polygon", ring(1.0, 5.0), 99.0, 1.0, 0.0), (3, "Polygon", ring(50.0, 1.0), 3.0, 50.0, 0.0), (4, None, None, 3.0, 60.0, 0.0), (5, "Polygon", ring(80.0, 9.0), None, 80.0, 0.0)]
    ways = [("1", ["a", "b"], "residential"), ("2", ["b", "c"], "residential"), ("3", ["a"], "residential"), ("4", ["a", "zz"], "residential"), ("5", ["a", "c"], "steps")]
    area = RF.Area(
        "x",
        spark.createDataFrame(b, "fid long, geom_type string, outer array<array<struct<x:double,y:double>>>, raw_height double, x double, y double"),
        spark.createDataFrame(ways, "way_id string, refs array<string>, highway string"),
        spark.createDataFrame([("a", 0.0, 0.0), ("b", 10.0, 0.0), ("c", 20.0, 0.0)], "id string, x double, y double"),
        spark.createDataFrame([(0, 0, 1.0), (0, 1, 9.0), (0, 2, 3.0), (0, 6, 4.0)], "row int, col int, elev double"),
        spark.createDataFrame([(1, 84.0, 0.0, 7.0)], "id long, x double, y double, height double"),
    )
    layers = RF.refine(area)
    assert {r.fid: (r.height, r.height_source) for r in layers["buildings"].collect()} == {1: (12.0, "overture"), 5: (7.0, "osm")}
    assert [(r.way_id, list(r.refs)) for r in layers["roads"].collect()] == [("1", ["a", "b", "c"])]
    assert {r.check: r.status for r in RF.output_checks(layers).collect()} == {"bld_height_present": "pass", "bld_height_source": "pass", "sample_valid": "pass", "road_connectivity": "pass"}
    assert {r.col: r.elev for r in layers["dem"].collect()} == {0: 1.0, 1: 9.0, 2: 4.0, 6: 4.0}  # under the first building, and near the last cell
    under = spark.createDataFrame([(0, 1)], "row int, col int")
    assert RF.refine_dem(area, 2, under).filter("col = 1").first().elev == 2.0
    area.dem_source = RF.BARE_EARTH
    assert RF.refine_dem(area, 2, under) is area.dem
    assert RF.recipe_key({"a": "1"}, {"r": 3}) != RF.recipe_key({"a": "1"}, {"r": 4})


def test_ranks_sums_and_every_nth_against_sorted_lists(spark, monkeypatch):
    rng = random.Random(3)
    monkeypatch.setattr(O, "RANGES", 8)
    rows = [(k, rng.choice(["a", "b", None]), None if k % 9 == 0 else float(rng.choice([1, 1, 1, 7, rng.randrange(500)])), 7) for k in range(700)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "id int, g string, v double, part int").repartition(5)
    shares = [0.0, 0.01, 0.5, 0.95, 1.0]
    got = {r.g: tuple(r)[1:] for r in O.nearest_rank(df, "v", shares, ["g"]).collect()}
    for g in ("a", "b", None):
        values = sorted(v for _, h, v, _ in rows if h == g and v is not None)
        assert got[g] == tuple(values[round((len(values) - 1) * q)] for q in shares)
    assert O.nearest_rank(df.filter("v IS NULL"), "v", [0.5]).count() == 0
    summed = O.prefix_sums(df, ["id"], {"before": F.col("id").cast("long")}, "test").collect()
    assert {(r.id, r.before, r.row_no, r.part) for r in summed} == {(k, k * (k - 1) // 2, k, 7) for k in range(700)}
    assert sorted(r.id for r in O.every_nth(df, ["id"], 100).collect()) == list(range(0, 700, 7))


def test_smallest_cover_against_all_pairs(spark):
    rng = random.Random(8)
    box = lambda k, m: (k, x := rng.uniform(-3, 3), y := rng.uniform(-3, 3), x + rng.choice([0.0, 0.01, 1, m]) * rng.random(), y + rng.choice([0.01, 1, m]) * rng.random())
    targets, covers = [box(k, 0.2) for k in range(150)], [box(k, 9) for k in range(120)] + [(500, 1.0, 1.0, 0.0, 2.0)]
    targets += [(900, 50.0, 50.0, 51.0, 51.0), (901, *covers[3][1:])]
    names = "id long, west double, south double, east double, north double"
    got = {r.target: r.cover for r in S.smallest_cover(spark.createDataFrame(targets, names), spark.createDataFrame(covers, names)).collect()}
    first = {r.target: r.cover for r in S.smallest_cover(spark.createDataFrame(targets, names), spark.createDataFrame(covers, names), order=["id"]).collect()}
    for t, w, s, e, n in targets:
        held = [c for c in covers if c[1] <= w and c[2] <= s and c[3] >= e and c[4] >= n]
        assert got[t] == (min(held, key=lambda c: ((c[3] - c[1]) * (c[4] - c[2]), c[0]))[0] if held else None)
        assert first[t] == (min(c[0] for c in held) if held else None)


def test_long_segments_and_large_rings_meet_all(spark):
    rng = random.Random(21)
    segments = [(k, k % 7, x := rng.uniform(0, 3000), y := rng.uniform(0, 3000), x + (d := rng.choice([5.0, 60.0, 2900.0])) * rng.uniform(-1, 1), y + d * rng.uniform(-1, 1)) for k in range(150)]
    df = spark.createDataFrame(segments, "id long, road int, ax double, ay double, bx double, by double")
    expected = set()
    for p in segments:
        for q in segments:
            if p[0] < q[0] and p[1] != q[1]:
                dx, dy, ex, ey = p[4] - p[2], p[5] - p[3], q[4] - q[2], q[5] - q[3]
                det = dx * ey - dy * ex
                if abs(det) > 1e-12:
                    t, u = ((q[2] - p[2]) * ey - (q[3] - p[3]) * ex) / det, ((q[2] - p[2]) * dy - (q[3] - p[3]) * dx) / det
                    if 0.05 < t < 0.95 and 0.05 < u < 0.95:
                        expected.add((p[0], q[0]))
    assert {(r.a, r.b) for r in S.segment_crossings(df, size=10.0).collect()} == expected and len(expected) > 50

    squares = [(k, rng.uniform(0, 500), rng.uniform(0, 500), rng.choice([1.0, 30.0, 400.0])) for k in range(60)]
    rings = [(k, [{"x": x, "y": y}, {"x": x + s, "y": y}, {"x": x + s, "y": y + s}, {"x": x, "y": y + s}], x, y, x + s, y + s) for k, x, y, s in squares]
    points = [(k, rng.uniform(0, 900), rng.uniform(0, 900)) for k in range(400)]
    found = S.points_in_rings(spark.createDataFrame(points, "id long, x double, y double"), spark.createDataFrame(rings, "ring_id long, ring array<struct<x:double,y:double>>, min_x double, min_y double, max_x double, max_y double"), 2.0)
    assert {(r.id, r.ring_id) for r in found.collect()} == {(p, k) for p, u, v in points for k, x, y, s in squares if x < u < x + s and y < v < y + s}
