"""Polygons over points, clipping and shared areas against plain loops; progress of long runs."""

import math
import random
from collections import Counter

from pyspark.sql import functions as F

from urbanframe.operators import overlay as OV, runs as U, strips as ST

POINT = "struct<x:double,y:double>"


def _odd(rings, x, y):
    hits = 0
    for ring in rings:
        for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1], strict=True):
            if (ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay + 1e-12) + ax:
                hits += 1
    return hits % 2 == 1


def _star(rng, cx, cy, r, n):
    turns = sorted(rng.uniform(0, 2 * math.pi) for _ in range(n))
    return [(cx + r * rng.uniform(0.3, 1) * math.cos(t), cy + r * rng.uniform(0.3, 1) * math.sin(t)) for t in turns]


def _polygons(rng):
    out = [(k, [_star(rng, rng.uniform(-50, 50), rng.uniform(-50, 50), rng.choice([0.3, 4, 40]), rng.randint(3, 14))]) for k in range(40)]
    out += [(100 + k, [_star(rng, 0, 0, 30, 9), _star(rng, 0, 0, 8, 7)]) for k in range(5)]
    square = lambda a, b, s: [(a, b), (a + s, b), (a + s, b + s), (a, b + s)]
    # corners and sides on cell borders, rings one way and the other, a hole that shares a side, a polygon without height
    return [*out, (200, [square(0.0, 0.0, 16.0)]), (201, [square(-8.0, -8.0, 16.0)[::-1], square(-8.0, -4.0, 8.0)]), (202, [[(1.0, 1.0), (9.0, 1.0), (5.0, 1.0)]]), (203, [])]


def test_points_in_polygons_with_holes(spark):
    rng = random.Random(4)
    polygons = _polygons(rng)
    points = [(k, rng.uniform(-60, 60), rng.uniform(-60, 60)) for k in range(1500)] + [(2000 + k, float(rng.randint(-20, 20)), float(rng.randint(-20, 20))) for k in range(300)]
    zones = spark.createDataFrame([(z, [[{"x": x, "y": y} for x, y in r] for r in rings]) for z, rings in polygons], f"zone int, parts array<array<{POINT}>>")
    df = spark.createDataFrame([(*p, p[0] % 7 + 0.5) for p in points], "id int, x double, y double, value double")
    expected = {(i, z) for i, x, y in points for z, rings in polygons if _odd(rings, x, y)}
    found = Counter(tuple(r) for r in OV.points_in_polygons(df, zones).collect())
    assert set(found) == expected and set(found.values()) == {1} and len(expected) > 500
    assert {r.id for r in OV.covered_points(df, zones).collect()} == {i for i, _ in expected}
    totals = {r.zone: (r.n, r.total) for r in OV.zone_totals(df, zones).collect()}
    assert totals == {z: (len(own), sum(i % 7 + 0.5 for i in own)) for z in {z for _, z in expected} for own in [[i for i, w in expected if w == z]]}
    cells = OV.polygon_cells(zones, rounds=4)
    inner = cells.filter("inner AND zone = 200").agg(F.sum(F.pow(F.lit(4.0), F.col("level")))).first()[0]
    assert inner > 0.5 * 256 and cells.filter("inner AND size(edges) > 0").count() == 0
    assert OV.points_in_polygons(df, zones.limit(0)).count() == 0 and OV.zone_totals(df.limit(0), zones).count() == 0


def _clip(ring, sides):
    for nx, ny, c in sides:
        out = []
        for p, q in zip(ring[-1:] + ring[:-1], ring, strict=True):
            a, b = nx * p[0] + ny * p[1] - c, nx * q[0] + ny * q[1] - c
            if (a <= 0) != (b <= 0):
                t = a / (a - b)
                out.append((p[0] + t * (q[0] - p[0]), p[1] + t * (q[1] - p[1])))
            if b <= 0:
                out.append(q)
        ring = out
        if not ring:
            return []
    return ring


def _area(ring):
    return abs(sum(a * d - c * b for (a, b), (c, d) in zip(ring, ring[1:] + ring[:1], strict=True))) / 2 if len(ring) > 2 else 0.0


def test_overlaps_of_slanted_faces(spark):
    rng = random.Random(8)
    faces = []
    for k in range(150):
        x, y, turn, w, h = rng.uniform(0, 60), rng.uniform(0, 60), rng.uniform(0, 3), rng.choice([1, 8, 30]), rng.choice([1, 4])
        corner = lambda i, j: (x + i * w * math.cos(turn) - j * h * math.sin(turn), y + i * w * math.sin(turn) + j * h * math.cos(turn))  # noqa: E731, B023
        faces.append((k, k % 4, [corner(-1, -1), corner(1, -1), corner(1, 1), corner(-1, 1)]))
    df = spark.createDataFrame([(i, o, [{"x": x, "y": y} for x, y in r]) for i, o, r in faces], f"id int, owner int, ring array<{POINT}>")
    got = {(r.a, r.b): r.square for r in OV.overlaps(df).collect()}
    expected = {}
    for i, o, ring in faces:
        for j, p, other in faces:
            if i < j and o != p:
                sides = [(d - b, a - c, (d - b) * a + (a - c) * b) for (a, b), (c, d) in zip(ring, ring[1:] + ring[:1], strict=True)]
                square = _area(_clip(other, sides))
                if square > 1e-9:
                    expected[i, j] = square
    assert set(got) == set(expected) and all(abs(got[k] - v) < 1e-6 for k, v in expected.items()) and len(got) > 300
    assert OV.overlaps(df.limit(0)).count() == 0


def test_pieces_of_clipped_faces(spark):
    square = [(-4.0, -4.0), (4.0, -4.0), (4.0, 4.0), (-4.0, 4.0)]
    tip = [(0.0, -5.0), (5.0, 0.0), (0.0, 5.0), (-5.0, 0.0)]
    thin = [(-9.0, 0.0), (9.0, 0.0), (9.0, 0.1), (-9.0, 0.1)]
    rows = [(1, square), (2, tip), (3, thin), (4, [(8.0, 8.0), (9.0, 8.0), (9.0, 9.0)]), (5, [(0.0, 0.0), (1.0, 0.0)]), (6, [])]
    df = spark.createDataFrame([(i, [{"x": x, "y": y} for x, y in r]) for i, r in rows], f"id int, ring array<{POINT}>")
    got = ST.clip_pieces(df, (-4.0, -4.0, 4.0, 4.0)).collect()
    assert Counter(r.id for r in got) == {1: 1, 2: 8, 3: 1} and {len(r.ring) for r in got if r.id == 2} == {3}
    assert abs(sum(_area([(p.x, p.y) for p in r.ring]) for r in got if r.id == 2) - _area(tip) + 4 * 1.0) < 1e-9
    assert "ArrowEvalPython" not in ST.clip_pieces(df, (0.0, 0.0, 1.0, 1.0))._jdf.queryExecution().toString()


def _states(lines):
    """One line after the other, by a plain reading of the formats."""
    now, out = 0, []
    for line in lines:
        if line.startswith("[Houdini"):
            k, n = map(int, line[9:].split("]")[0].split("/"))
            now = max(now, min(99, 75 + k * 23 // n))
        elif line.startswith("["):
            k, n = map(int, line[1:].split("]")[0].split("/"))
            now = max(now, 75 if k >= n else min(74, k * 75 // n))
        elif "completed" in line:
            now = max(now, 99)
        elif "[OK]" in line and now < 75:
            now = min(74, now + 3)
        out.append(now)
    return out


def test_progress_of_parts_in_a_row(spark):
    rng = random.Random(2)
    kinds = [lambda: f"[{rng.randint(1, 6)}/6] go", lambda: "one [OK] more", lambda: "talk", lambda: f"[Houdini {rng.randint(1, 7)}/7] x", lambda: "Houdini build completed"]
    rows = [(run, seq, rng.choices(kinds, (3, 10, 4, run % 2, 0.3 * (run % 3)))[0]()) for run in range(12) for seq in range(rng.randint(1, 80))]
    df = spark.createDataFrame(rows, "run int, seq int, line string").repartition(6)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {(r.run, r.seq): r.pct for r in U.progress(df).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    for run in range(12):
        own = [x for r, _, x in rows if r == run]
        assert [got[run, k] for k in range(len(own))] == _states(own)
    assert U.progress(df.limit(0)).count() == 0


def test_progress_of_a_million_lines(spark):
    lines = spark.range(1_000_000).selectExpr("7 AS run", "id AS seq", "CASE WHEN id = 999990 THEN '[6/6] last' WHEN id % 100000 = 5 THEN '[OK]' ELSE 'talk' END AS line")
    got = U.progress(lines).groupBy("pct").count().collect()
    assert {r.pct: r["count"] for r in got} == {0: 5, 75: 10} | {3 * k: 100_000 for k in range(1, 10)} | {30: 99_985}
