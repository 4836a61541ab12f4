"""Planar geometry on arrays of points as higher-order column functions; no row leaves the JVM.

A ring is an array of struct<x,y>; closed rings repeat the first point at the end. Functions that go around a ring take
it open (``unique_points``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value worked out once, however often it stands in use; filters can't paste it several times either."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _next(ring: Column, i: Column) -> Column:
    return F.element_at(ring, F.when(i + 1 < F.size(ring), i + 2).otherwise(F.lit(1)).cast("int"))


def _sum(items: Column) -> Column:
    return F.aggregate(items, F.lit(0.0), lambda a, x: a + x)


def unique_points(ring: Column) -> Column:
    """Without the closing point and without points equal to the one before."""
    kept = F.filter(ring, lambda p, i: (i == 0) | ~(p.eqNullSafe(F.element_at(ring, F.greatest(i, F.lit(1)).cast("int")))))
    closed = lambda r: (F.size(r) > 1) & F.element_at(r, 1).eqNullSafe(F.element_at(r, -1))
    return let(kept, lambda r: F.when(closed(r), F.slice(r, F.lit(1), F.size(r) - 1)).otherwise(r))


def _around(ring: Column) -> Column:
    """Sums around an open ring, from its first point: a (twice the area), x and y (moments); p is the last point met."""
    zero = F.struct(F.element_at(ring, -1).alias("p"), F.lit(0.0).alias("a"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))
    first = F.element_at(ring, 1)

    def step(s: Column, q: Column) -> Column:
        px, py, qx, qy = s["p"]["x"] - first["x"], s["p"]["y"] - first["y"], q["x"] - first["x"], q["y"] - first["y"]
        sums = lambda cross: F.struct(q.alias("p"), (s["a"] + cross).alias("a"), (s["x"] + (px + qx) * cross).alias("x"), (s["y"] + (py + qy) * cross).alias("y"))
        return let(px * qy - qx * py, sums)

    return F.aggregate(ring, zero, step)


def signed_area(ring: Column) -> Column:
    """Half the sum of cross products around an open ring: positive against the clock. Fewer than 3 points give 0."""
    return let(ring, lambda r: F.when(F.size(r) >= 3, _around(r)["a"] / 2).otherwise(F.lit(0.0)))


def area(ring: Column) -> Column:
    return F.abs(signed_area(ring))


def wound(ring: Column) -> Column:
    """The ring turned so that its signed area isn't positive, as faces to the top of a scene need."""
    return let(ring, lambda r: F.when(signed_area(r) > 0, F.reverse(r)).otherwise(r))


def vertex_mean(ring: Column) -> Column:
    mean = lambda r, axis: (_sum(F.transform(r, lambda p: p[axis])) / F.size(r)).alias(axis)
    return let(ring, lambda r: F.struct(mean(r, "x"), mean(r, "y")))


def area_centroid(ring: Column) -> Column:
    """The centre of mass of the ring's area; the vertex mean where the area is 0."""

    def of(r: Column) -> Column:
        first = F.element_at(r, 1)
        centre = lambda s: F.struct(*((first[c] + s[c] / (3 * s["a"])).alias(c) for c in "xy"))
        return let(_around(r), lambda s: F.when(s["a"] != 0, centre(s)).otherwise(vertex_mean(r)))

    return let(ring, of)


def bounds(ring: Column) -> Column:
    xs, ys = (lambda r: F.transform(r, lambda p: p["x"])), (lambda r: F.transform(r, lambda p: p["y"]))
    sides = lambda r: F.struct(F.array_min(xs(r)).alias("min_x"), F.array_min(ys(r)).alias("min_y"), F.array_max(xs(r)).alias("max_x"), F.array_max(ys(r)).alias("max_y"))
    return let(ring, sides)


def inside(point: Column, min_x: float, min_y: float, max_x: float, max_y: float) -> Column:
    """Strictly inside a box; the boundary is out."""
    return let(point, lambda p: (p["x"] > min_x) & (p["x"] < max_x) & (p["y"] > min_y) & (p["y"] < max_y))


def contains(ring: Column, x: Column, y: Column) -> Column:
    """Even-odd rule: whether a ray to the right of the point crosses an odd number of the open ring's edges."""

    def crosses(p: Column, i: Column) -> Column:
        q = _next(ring, i)
        above = (p["y"] > y) != (q["y"] > y)
        return F.when(above, x < (q["x"] - p["x"]) * (y - p["y"]) / (q["y"] - p["y"] + 1e-12) + p["x"]).otherwise(F.lit(False))

    return F.size(F.filter(F.transform(ring, crosses), lambda c: c)) % 2 == 1


def crossing(ax, ay, bx, by, cx, cy, dx, dy) -> tuple:
    """(t, u) at which the lines a-b and c-d meet, as shares of both; null for parallel ones."""
    det = (bx - ax) * (dy - cy) - (by - ay) * (dx - cx)
    safe = F.when(F.abs(det) > 1e-12, det)
    return ((cx - ax) * (dy - cy) - (cy - ay) * (dx - cx)) / safe, ((cx - ax) * (by - ay) - (cy - ay) * (bx - ax)) / safe


def edge_lengths(ring: Column) -> Column:
    return F.transform(ring, lambda p, i: F.hypot(_next(ring, i)["x"] - p["x"], _next(ring, i)["y"] - p["y"]))


def interior_angles(ring: Column) -> Column:
    """Degrees between the two edges at each corner; null where an edge has no length."""

    def angle(p: Column, i: Column) -> Column:
        before = F.element_at(ring, F.when(i > 0, i).otherwise(F.size(ring)).cast("int"))
        after = _next(ring, i)
        sides = F.struct((before["x"] - p["x"]).alias("ux"), (before["y"] - p["y"]).alias("uy"), (after["x"] - p["x"]).alias("vx"), (after["y"] - p["y"]).alias("vy"))

        def between(d: Column) -> Column:
            cos = lambda size: F.least(F.lit(1.0), F.greatest(F.lit(-1.0), (d["ux"] * d["vx"] + d["uy"] * d["vy"]) / F.when(size > 0, size)))
            return let(F.hypot(d["ux"], d["uy"]) * F.hypot(d["vx"], d["vy"]), lambda size: F.when(size > 0, F.degrees(F.acos(cos(size)))))

        return let(sides, between)

    return F.transform(ring, angle)


def aspect_ratio(ring: Column) -> Column:
    """The longest edge over the shortest one; null if an edge has no length."""
    edges = edge_lengths(ring)
    shortest = F.array_min(edges)
    return F.array_max(edges) / F.when(shortest > 0, shortest)


def self_crossings(ring: Column) -> Column:
    """Pairs of edges without a common corner that cross strictly inside both."""
    n = F.size(ring)

    def with_later(p: Column, i: Column) -> Column:
        q = _next(ring, i)

        def hit(r: Column, j: Column) -> Column:
            s = _next(ring, j)
            t, u = crossing(p["x"], p["y"], q["x"], q["y"], r["x"], r["y"], s["x"], s["y"])
            apart = (j > i + 1) & ~((i == 0) & (j == n - 1))
            return apart & F.coalesce((t > 1e-4) & (t < 0.9999) & (u > 1e-4) & (u < 0.9999), F.lit(False))

        return F.size(F.filter(F.transform(ring, hit), lambda x: x))

    return F.aggregate(F.transform(ring, with_later), F.lit(0), lambda a, x: a + x)


def bevelled(ring: Column, most: float = 0.6, share: float = 0.25, least: float = 0.08, shortest: float = 0.35, widest: float = 102.0) -> Column:
    """Each convex corner of up to ``widest`` degrees between long enough edges becomes two points.

    The cut is the lesser of ``most`` and a share of the shorter edge; shorter cuts than ``least`` are left out. The ring
    is open and goes against the clock.
    """

    def cut(p: Column, i: Column) -> Column:
        before = F.element_at(ring, F.when(i > 0, i).otherwise(F.size(ring)).cast("int"))
        after = _next(ring, i)
        sides = F.struct((before["x"] - p["x"]).alias("ux"), (before["y"] - p["y"]).alias("uy"), (after["x"] - p["x"]).alias("vx"), (after["y"] - p["y"]).alias("vy"))

        def at(d: Column) -> Column:
            ux, uy, vx, vy = (d[c] for c in ("ux", "uy", "vx", "vy"))

            def pieces(s: Column) -> Column:
                u, v = s["u"], s["v"]
                size = F.least(F.lit(most), share * F.least(u, v))
                cos = F.least(F.lit(1.0), F.greatest(F.lit(-1.0), (ux * vx + uy * vy) / F.when(u * v > 0, u * v)))
                convex = vx * uy - vy * ux > 0
                apply = convex & (F.degrees(F.acos(cos)) <= widest) & (u >= shortest) & (v >= shortest) & (size >= least)
                point = lambda dx, dy, n: F.struct((p["x"] + dx / n * size).alias("x"), (p["y"] + dy / n * size).alias("y"))
                return F.when(F.coalesce(apply, F.lit(False)), F.array(point(ux, uy, u), point(vx, vy, v))).otherwise(F.array(p))

            return let(F.struct(F.hypot(ux, uy).alias("u"), F.hypot(vx, vy).alias("v")), pieces)

        return let(sides, at)

    return F.flatten(F.transform(ring, cut))
