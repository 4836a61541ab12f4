"""Road surfaces: split polylines, strips of quads, junction fills; extruded faces and clipped polygons."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from urbanframe.functions.geometry import area, interior_angles, let
from urbanframe.operators.overlay import box_sides, clipped_by, fan, spaced
from urbanframe.operators.roads import along
from urbanframe.operators.staging import written

#: Limits of a junction's fill.
RADIUS_FACTOR, LEAST_RADIUS, MOST_RADIUS = 2.8, 3.0, 18.0
AREA_FACTOR, MOST_AREA, MOST_POINTS = 10.0, 450.0, 8
REASONS = ("small", "complex", "radius", "area")
ROAD_HEIGHT = 0.18

Point = tuple[float, float]


def with_crossings(points: DataFrame, crossings: DataFrame, eps: float = 0.25, own_eps: float = 0.05) -> DataFrame:
    """Polylines (road, seq, x, y) with the crossings (road, seq, t, x, y) put between a point and the next, in order of t.

    A crossing nearer than eps, and a point of the line nearer than own_eps, to the last point that was kept is left out.
    seq is renumbered from 1. A polyline is one record while it is walked along.
    """
    own = points.select("road", F.col("seq").alias("at"), F.lit(0.0).alias("t"), F.lit(0).alias("new"), "x", "y", F.lit(own_eps).alias("eps"))
    new = crossings.select("road", F.col("seq").alias("at"), "t", F.lit(1).alias("new"), "x", "y", F.lit(eps).alias("eps"))
    lines = own.unionByName(new).groupBy("road").agg(F.sort_array(F.collect_list(F.struct("at", "new", "t", "x", "y", "eps"))).alias("p"))
    place = lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y"))
    far = lambda kept, p: F.hypot(F.element_at(kept, -1)["x"] - p["x"], F.element_at(kept, -1)["y"] - p["y"]) >= p["eps"]
    start, rest = F.transform(F.slice("p", 1, 1), place), F.slice("p", F.lit(2), F.greatest(F.size("p") - 1, F.lit(0)))
    kept = F.aggregate(rest, start, lambda k, p: F.when(far(k, p), F.array_append(k, place(p))).otherwise(k))
    return lines.select("road", F.posexplode(kept).alias("k", "q")).select("road", (F.col("k") + 1).alias("seq"), "q.x", "q.y")


def trimmed(points: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(sides, ends) of polylines (road, seq, x, y, half_width, is_junction) that are cut back at junctions.

    sides are (road, travelled, lx, ly, rx, ry): left and right of each point that stays. A line is cut by its half width,
    at most 45 % of its length, at an end that is a junction, and gets sides there; its other points have sides unless
    they are in what was cut off or an end. Lines that would be cut away, or have no length, have none. ends are
    (jx, jy, x, y, half_width): both sides of each cut, for junction_fills, by the place of the junction in metres.
    """
    own = along(points).withColumns({"whole": F.max("travelled").over(Window.partitionBy("road")), "hw": F.col("half_width")})
    in_order = Window.partitionBy("road").orderBy("seq")
    first, last = F.row_number().over(in_order) == 1, F.lead(F.lit(1)).over(in_order).isNull()
    own = own.withColumns({"first": first, "last": last}).withColumn("cut", F.when(F.col("is_junction") & (F.col("first") | F.col("last")), F.least(F.col("hw"), F.col("whole") * 0.45)).otherwise(0.0))
    by_road = Window.partitionBy("road")
    own = own.withColumns({"start": F.max(F.when(F.col("first"), F.col("cut"))).over(by_road), "end": F.max(F.when(F.col("last"), F.col("cut"))).over(by_road)})
    own = own.filter((F.col("whole") >= 1e-6) & (F.col("start") + F.col("end") < F.col("whole") - 1e-4) & F.col("tx").isNotNull())
    side = lambda k: [(F.col("px") - k * F.col("ty") * F.col("hw")).alias("lx" if k > 0 else "rx"), (F.col("py") + k * F.col("tx") * F.col("hw")).alias("ly" if k > 0 else "ry")]
    inner = own.filter((F.col("travelled") > F.col("start") + 1e-4) & (F.col("travelled") < F.col("whole") - F.col("end") - 1e-4)).withColumns({"px": F.col("x"), "py": F.col("y")})
    sign = F.when(F.col("first"), 1.0).otherwise(-1.0)
    ends = own.filter(F.col("cut") > 0).withColumns({"px": F.col("x") + sign * F.col("tx") * F.col("cut"), "py": F.col("y") + sign * F.col("ty") * F.col("cut")})
    ends = ends.withColumn("travelled", F.col("travelled") + sign * F.col("cut"))
    sides = inner.select("road", "travelled", *side(1), *side(-1)).unionByName(ends.select("road", "travelled", *side(1), *side(-1)))
    both = ends.select(F.bround("x").alias("jx"), F.bround("y").alias("jy"), "hw", *side(1), *side(-1))
    at = lambda s: F.struct(F.col(f"{s}x").alias("x"), F.col(f"{s}y").alias("y"))
    # a union, or an inner explode's filter, would work the lines out twice
    ends = both.select("jx", "jy", F.explode_outer(F.array(at("l"), at("r"))).alias("p"), F.col("hw").alias("half_width"))
    return sides, ends.select("jx", "jy", "p.x", "p.y", "half_width")


def strip_quads(points: DataFrame) -> DataFrame:
    """(road, seq, ring, length, square_m) of the faces between the points (road, seq, x, y, half_width) of polylines.

    The sides are moved across the tangent; where that gives a face without area it is left out.
    """
    p = along(points).filter("tx IS NOT NULL")
    w = Window.partitionBy("road").orderBy("seq")
    hw = F.col("half_width")
    side = lambda k: F.struct((F.col("x") - k * F.col("ty") * hw).alias("x"), (F.col("y") + k * F.col("tx") * hw).alias("y"))
    p = p.withColumns({"l": side(1), "r": side(-1)}).withColumns({"l2": F.lead("l").over(w), "r2": F.lead("r").over(w)}).filter("l2 IS NOT NULL")
    dist = lambda a, b: F.hypot(F.col(f"{a}.x") - F.col(f"{b}.x"), F.col(f"{a}.y") - F.col(f"{b}.y"))
    cross = lambda a, b, c: (F.col(f"{b}.x") - F.col(f"{a}.x")) * (F.col(f"{c}.y") - F.col(f"{a}.y")) - (F.col(f"{c}.x") - F.col(f"{a}.x")) * (F.col(f"{b}.y") - F.col(f"{a}.y"))
    area = F.abs(cross("l", "l2", "r2") + cross("l", "r2", "r")) / 2
    out = p.select("road", "seq", F.array("l", "l2", "r2", "r").alias("ring"), ((dist("l", "l2") + dist("r", "r2")) / 2).alias("length"), area.alias("square_m"))
    return out.filter("square_m > 1e-5")


def convex_hull(points: list[Point]) -> list[Point]:
    """Against the clock, without points on an edge; points are rounded to 2 decimals, and sides are told by whole numbers."""
    unique = sorted({(round(x * 100), round(y * 100)) for x, y in points})

    def chain(ordered: list[tuple[int, int]]) -> list[tuple[int, int]]:
        out: list[tuple[int, int]] = []
        for p in ordered:
            while len(out) >= 2 and (out[-1][0] - out[-2][0]) * (p[1] - out[-2][1]) <= (out[-1][1] - out[-2][1]) * (p[0] - out[-2][0]):
                out.pop()
            out.append(p)
        return out[:-1]

    hull = unique if len(unique) < 3 else chain(unique) + chain(unique[::-1])
    return [(x / 100, y / 100) for x, y in hull]


def polygon_area(ring: list[Point]) -> float:
    """From its first point, so that rings far from the origin lose no digits."""
    near = [(x - ring[0][0], y - ring[0][1]) for x, y in ring]
    return abs(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(near, near[1:] + near[:1], strict=True))) / 2


def _fill(points: list[Point], half_width: float) -> tuple[str | None, list[Point]]:
    """The first reason against a fill, or its hull."""
    cx, cy = (sum(p[k] for p in points) / len(points) for k in (0, 1))
    if max(math.dist(p, (cx, cy)) for p in points) > min(MOST_RADIUS, max(half_width * RADIUS_FACTOR, LEAST_RADIUS)):
        return "radius", []
    hull = convex_hull(points)
    if len(hull) < 3:
        return "small", []
    return ("area", []) if polygon_area(hull) > min(MOST_AREA, half_width**2 * AREA_FACTOR) else (None, hull)


def junction_fills(ends: DataFrame) -> DataFrame:
    """(jx, jy, n, reason, square_m, corners) for strip ends (jx, jy, x, y, half_width) at junctions.

    reason is the first of small (fewer than 3 ends), complex (more than 8), radius, small again (a flat hull) and area,
    or null for a fill. Only junctions of 3 to 8 ends are gathered; the others are counted and no more. Ends are written
    first, so that they are worked out once.
    """
    ends = written(ends.select("jx", "jy", "x", "y", "half_width"), "strip-ends")
    limit = F.when(F.col("n") < 3, "small").when(F.col("n") > MOST_POINTS, "complex")
    counts = ends.groupBy("jx", "jy").agg(F.count("*").alias("n"), F.max("half_width").alias("hw")).withColumn("reason", limit)
    few = counts.filter("reason IS NULL").drop("reason")
    gathered = ends.join(few, ["jx", "jy"]).groupBy("jx", "jy", "n", "hw").agg(F.collect_list(F.array("x", "y")).alias("p"))

    @F.pandas_udf("struct<reason:string,square_m:double,corners:int>")
    def fill(points: pd.Series, width: pd.Series) -> pd.DataFrame:
        rows = [_fill([tuple(q) for q in p], max(0.1, w)) for p, w in zip(points, width, strict=True)]
        return pd.DataFrame([(r, polygon_area(h) if h else None, len(h) or None) for r, h in rows], columns=["reason", "square_m", "corners"])

    done = gathered.withColumn("f", fill("p", "hw")).select("jx", "jy", "n", "f.reason", "f.square_m", "f.corners")
    rest = counts.filter("reason IS NOT NULL").select("jx", "jy", "n", "reason", F.lit(None).cast("double").alias("square_m"), F.lit(None).cast("int").alias("corners"))
    return done.unionByName(rest)


def junction_accounts(fills: DataFrame) -> DataFrame:
    """One row of counts of what junction_fills gives: fills, each reason, and total."""
    return fills.agg(F.count_if(F.col("reason").isNull()).alias("fills"), *(F.count_if(F.col("reason") == r).alias(r) for r in REASONS), F.count("*").alias("total"))


def extruded(faces: DataFrame, height: str) -> DataFrame:
    """(id, part, face, ring) of prisms over open rings (id, ring of struct<x,y>, base, height): sides, top and bottom."""
    top = F.col("base") + F.col(height)
    lift = lambda p, y: F.struct(p["x"].alias("x"), y.alias("y"), p["y"].alias("z"))
    n = F.size("ring")

    def wall(p, i):
        q = F.element_at("ring", F.when(i + 1 < n, i + 2).otherwise(F.lit(1)).cast("int"))
        return F.struct(F.lit("side").alias("part"), F.array(lift(p, F.col("base")), lift(q, F.col("base")), lift(q, top), lift(p, top)).alias("ring"))

    cap = lambda part, y, r: F.struct(F.lit(part).alias("part"), F.transform(r, lambda p: lift(p, y)).alias("ring"))
    every = F.concat(F.transform("ring", wall), F.array(cap("top", top, F.col("ring")), cap("bottom", F.col("base"), F.reverse("ring"))))
    return faces.select("id", F.posexplode_outer(every).alias("face", "f")).filter("face IS NOT NULL").select("id", "f.part", "face", "f.ring")


#: Corners nearer than this are one, and pieces with less area or a smaller angle in degrees are dropped.
CLIP_EPS, LEAST_SQUARE, LEAST_ANGLE = 0.05, 1e-5, 5.0


def clipped(ring: list[Point], box: tuple[float, float, float, float], eps: float = 0.05) -> list[Point]:
    """The part of a polygon inside a box (min_x, min_y, max_x, max_y); corners nearer than eps to the one before go."""
    out = list(ring)
    for axis, bound, sign in ((0, box[0], 1), (0, box[2], -1), (1, box[1], 1), (1, box[3], -1)):
        inside = lambda p, a=axis, b=bound, s=sign: s * (p[a] - b) >= 0
        before, out = out, []
        for a, b in zip(before, before[1:] + before[:1], strict=True):
            if inside(a):
                out.append(a)
            if inside(a) != inside(b):
                t = (bound - a[axis]) / (b[axis] - a[axis])
                out.append((a[0] + t * (b[0] - a[0]), a[1] + t * (b[1] - a[1])))
    clean: list[Point] = []
    for p in out:
        if not clean or math.dist(p, clean[-1]) >= eps:
            clean.append(p)
    return clean if len(clean) >= 3 and polygon_area(clean) > 1e-5 else []


def clip_faces(faces: DataFrame, box: tuple[float, float, float, float], eps: float = CLIP_EPS) -> DataFrame:
    """(id, ring) of the parts of faces (id, ring of struct<x,y>) in a box; faces outside are left out."""
    cut = spaced(clipped_by(F.col("ring"), box_sides(*box)), eps)
    rings = faces.select("id", F.filter(F.array(cut), lambda r: (F.size(r) >= 3) & (area(r) > LEAST_SQUARE)).alias("r"))
    # an inner explode would filter on its input's size first, that is work the whole cut out several times
    return rings.select("id", F.explode_outer("r").alias("ring")).filter("ring IS NOT NULL")


def clip_pieces(faces: DataFrame, box: tuple[float, float, float, float], eps: float = CLIP_EPS, least_angle: float = LEAST_ANGLE) -> DataFrame:
    """(id, piece, ring) of what faces have in a box: parts of more than four corners become triangles around their mean.

    Pieces of almost no area, or with an angle below least_angle degrees, are left out; piece counts from 0 with them.
    """
    parts = clip_faces(faces, box, eps).select("id", F.posexplode_outer(fan(F.col("ring"))).alias("piece", "ring")).filter("ring IS NOT NULL")
    good = let(F.col("ring"), lambda r: (area(r) > LEAST_SQUARE) & (F.coalesce(F.array_min(interior_angles(r)), F.lit(0.0)) >= least_angle))
    return parts.filter(good)
