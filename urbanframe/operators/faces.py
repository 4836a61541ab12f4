"""Faces of meshes, as rings of struct<x,y,z>: normals, foundations and the fit of two bodies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from urbanframe.operators.raster import sampled
from urbanframe.operators.spatial import cell, near_cells

#: Normals above this point up and below its negative down; stored ones below SAME against the face's don't fit.
UPRIGHT, SAME, NO_LENGTH = 0.65, 0.8, 0.1
#: Fixed values of a foundation: steepest side, tolerance of its lower edge, least and most depth, and reach into the terrain.
SIDE_Y, LEVEL_M, LEAST_DEPTH, MOST_DEPTH, TERRAIN_EPS = 0.20, 0.01, 0.12, 25.0, 0.03
#: Metres within which sides and edges of two bodies are matched.
SIDE_M, EDGE_M = 0.35, 0.05
#: Red, green and blue of each layer.
COLOURS = {"building": (0.8, 0.78, 0.74), "road": (0.25, 0.25, 0.27), "terrain": (0.45, 0.52, 0.35)}


def normal(ring: Column) -> Column:
    """The unit normal of an open ring by sums over its edges, struct<x,y,z>; null where the ring has no area."""
    n = F.size(ring)

    def total(a: str, b: str) -> Column:
        step = lambda p, i: (p[a] - F.element_at(ring, (F.pmod(i + 1, n) + 1).cast("int"))[a]) * (p[b] + F.element_at(ring, (F.pmod(i + 1, n) + 1).cast("int"))[b])
        return F.aggregate(F.transform(ring, step), F.lit(0.0), lambda s, v: s + v)

    x, y, z = total("y", "z"), total("z", "x"), total("x", "y")
    size = F.sqrt(x * x + y * y + z * z)
    return F.when(size > 1e-12, F.struct((x / size).alias("x"), (y / size).alias("y"), (z / size).alias("z")))


def dot(a: Column, b: Column) -> Column:
    return a["x"] * b["x"] + a["y"] * b["y"] + a["z"] * b["z"]


def facing(n: Column) -> Column:
    """up, side, down, or degenerate for a face without a normal."""
    return F.when(n.isNull(), "degenerate").when(n["y"] > UPRIGHT, "up").when(n["y"] < -UPRIGHT, "down").otherwise("side")


def stored_fault(n: Column, stored: Column) -> Column:
    """missing, zero or mismatch for a stored normal that doesn't fit a face's own, else null."""
    size = F.sqrt(dot(stored, stored))
    return F.when(stored.isNull(), "missing").when(size < NO_LENGTH, "zero").when(n.isNotNull() & (dot(n, stored) < SAME), "mismatch")


def normal_statistics(faces: DataFrame, stored: str | None = None) -> DataFrame:
    """One row: faces by facing, and by the fault of their stored normals, for faces (ring, and the column stored)."""
    rows = faces.select(normal(F.col("ring")).alias("n"), *([F.col(stored).alias("stored")] if stored else []))
    fault = stored_fault(F.col("n"), F.col("stored")) if stored else F.lit(None).cast("string")
    rows = rows.select(facing(F.col("n")).alias("facing"), fault.alias("fault"))
    count = lambda c, v: F.count_if(F.col(c) == v).alias(v)
    return rows.agg(F.count("*").alias("prims"), *(count("facing", v) for v in ("up", "side", "down", "degenerate")), *(count("fault", v) for v in ("missing", "zero", "mismatch")))


def dressed(faces: DataFrame, layer: str) -> DataFrame:
    """Adds the layer's colour (red, green, blue) and the normal, one for all corners of a face, to faces (ring)."""
    return faces.withColumns({**{n: F.lit(v) for n, v in zip(("red", "green", "blue"), COLOURS[layer], strict=True)}, "normal": normal(F.col("ring"))})


def foundation_edges(faces: DataFrame, grid: DataFrame, size: float = 1.0) -> DataFrame:
    """(id, face, edge, ax, ay, az, bx, by, bz, depth_a, depth_b): the skirts under the lower edges of steep faces.

    faces are (id, face, ring). A lower edge joins corners, in ring order, that are within LEVEL_M of the lowest. The skirt
    reaches into the terrain (grid as in raster.sampled), MOST_DEPTH at most; over unknown terrain its depth is 0. Edges
    whose depth is below LEAST_DEPTH at both ends are left out.
    """
    ring, lowest = F.col("ring"), F.array_min(F.transform("ring", lambda p: p["y"]))
    steep = faces.filter(F.size(ring) >= 3).filter(F.abs(normal(ring)["y"]) <= SIDE_Y)
    low = steep.select("id", "face", F.filter(ring, lambda p: p["y"] - lowest <= LEVEL_M).alias("low")).filter(F.size("low") >= 2)
    pairs = F.transform(F.sequence(F.lit(1), F.size("low") - 1), lambda k: F.struct(F.element_at("low", k).alias("a"), F.element_at("low", k + 1).alias("b")))
    edges = low.select("id", "face", F.posexplode(pairs).alias("edge", "p"))
    edges = edges.select("id", "face", "edge", *(F.col(f"p.{e}.{c}").alias(f"{e}{c}") for e in "ab" for c in "xyz"))
    for e in "ab":
        names = {f"{e}x": "x", f"{e}z": "z"}
        at = sampled(edges.withColumnsRenamed(names), grid, size).withColumnsRenamed({v: k for k, v in names.items()})
        bottom = F.greatest(F.least(F.col("terrain") + TERRAIN_EPS, F.col(f"{e}y")), F.col(f"{e}y") - MOST_DEPTH)
        edges = at.withColumn(f"depth_{e}", F.col(f"{e}y") - F.coalesce(bottom, F.col(f"{e}y"))).drop("terrain")
    return edges.filter(F.greatest("depth_a", "depth_b") >= LEAST_DEPTH)


def side_matches(sides: DataFrame, bodies: DataFrame, radius: float = SIDE_M) -> DataFrame:
    """(id, best, status) of sides (id, x, z, n): the largest dot product with a body's side (x, z, n) within radius.

    status is aligned above SAME, mismatch up to it, and no_match where no side is near.
    """
    own = sides.select("id", "x", "z", "n")
    # rows of one place and normal meet once
    a = own.select("x", "z", "n").distinct().withColumns({"cx": cell(F.col("x"), radius), "cy": cell(F.col("z"), radius)})
    b = bodies.select("x", "z", "n").distinct().withColumn("c", F.explode(near_cells(F.col("x"), F.col("z"), radius))).select(F.col("x").alias("bx"), F.col("z").alias("bz"), F.col("n").alias("bn"), "c.cx", "c.cy")
    near = a.hint("merge").join(b.hint("merge"), ["cx", "cy"]).filter(F.hypot(F.col("x") - F.col("bx"), F.col("z") - F.col("bz")) <= radius)
    by_place = near.groupBy("x", "z", "n").agg(F.max(dot(F.col("n"), F.col("bn"))).alias("best"))
    best = own.hint("merge").join(by_place.hint("merge"), ["x", "z", "n"]).groupBy("id").agg(F.max("best").alias("best"))
    out = sides.select("id").join(best, "id", "left")
    return out.withColumn("status", F.when(F.col("best").isNull(), "no_match").when(F.col("best") > SAME, "aligned").otherwise("mismatch"))


def edge_distances(tops: DataFrame, bottoms: DataFrame, size: float = EDGE_M) -> DataFrame:
    """(id, distance) of tops (id, x, z) to the nearest of bottoms (x, z) in the 3 x 3 cells of size around, else in 5 x 5.

    Tops without any in these cells are left out.
    """
    own = tops.select("id", "x", "z")
    # places meet, of which each stands once
    a = own.select("x", "z").distinct().withColumns({"cx": cell(F.col("x"), size), "cy": cell(F.col("z"), size)})
    b = bottoms.select(F.col("x").alias("bx"), F.col("z").alias("bz")).distinct().withColumns({"ox": cell(F.col("bx"), size), "oy": cell(F.col("bz"), size)})
    spread = b.withColumn("c", F.explode(near_cells(F.col("bx"), F.col("bz"), size, 2))).select("bx", "bz", "ox", "oy", "c.cx", "c.cy")
    ring = F.when((F.abs(F.col("cx") - F.col("ox")) <= 1) & (F.abs(F.col("cy") - F.col("oy")) <= 1), 1).otherwise(2)
    d = F.struct(ring.alias("ring"), F.hypot(F.col("x") - F.col("bx"), F.col("z") - F.col("bz")).alias("distance"))
    by_place = a.hint("merge").join(spread.hint("merge"), ["cx", "cy"]).groupBy("x", "z").agg(F.min(d).alias("d"))
    near = own.hint("merge").join(by_place.hint("merge"), ["x", "z"])
    return near.groupBy("id").agg(F.min("d").alias("d")).select("id", F.col("d.distance").alias("distance"))
