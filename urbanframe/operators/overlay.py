"""Polygons over points: cells inside a polygon need no test, cells at its edge carry the edges that can count in them.

A polygon's box is covered by a few large cells. A cell that no edge touches is wholly in or out; one that an edge touches
is split into four, for some rounds or down to a least size. So most points in a large polygon meet it by an equality on
level and cell alone. The cells of one polygon never overlap, so a point meets a polygon once at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from urbanframe.functions.geometry import area, bounds, let
from urbanframe.operators.blocks import blocks, met, unfolded
from urbanframe.operators.staging import written

#: Rounds in which cells at the edge are split: one or two cells each way become up to eight.
ROUNDS = 2
#: The smallest boxes count as this wide.
LEAST_SIDE = 2.0**-20
EPS = 1e-9


def _edges(parts: Column) -> Column:
    """All edges (px, py, qx, qy) of open rings, outer ones and holes."""

    def of(ring: Column) -> Column:
        after = lambda i: F.element_at(ring, F.when(i + 1 < F.size(ring), i + 2).otherwise(F.lit(1)).cast("int"))
        edge = lambda p, q: F.struct(p["x"].alias("px"), p["y"].alias("py"), q["x"].alias("qx"), q["y"].alias("qy"))
        return F.transform(ring, lambda p, i: edge(p, after(i)))

    return F.flatten(F.transform(parts, of))


def odd(edges: Column, x: Column, y: Column) -> Column:
    """Whether a ray to the right of the point crosses an odd number of edges."""
    hit = lambda e: ((e["py"] > y) != (e["qy"] > y)) & (x < (e["qx"] - e["px"]) * (y - e["py"]) / F.when(e["qy"] != e["py"], e["qy"] - e["py"] + 1e-12) + e["px"])
    return F.size(F.filter(edges, lambda e: F.coalesce(hit(e), F.lit(False)))) % 2 == 1


def side(level: Column) -> Column:
    return F.pow(F.lit(2.0), level)


def _counts(e: Column, x0: Column, y0: Column, s: Column) -> Column:
    """Whether an edge can be met by a ray to the right from within a cell; an edge of almost no height always can."""
    slack = 1e-6 * (1 + F.abs(x0) + F.abs(e["qx"] - e["px"]))
    flat = F.abs(e["qy"] - e["py"]) < 1e-6
    return (F.least(e["py"], e["qy"]) <= y0 + s) & (F.greatest(e["py"], e["qy"]) >= y0) & (flat | (F.greatest(e["px"], e["qx"]) >= x0 - slack))


def _touches(e: Column, x0: Column, y0: Column, s: Column) -> Column:
    """Whether an edge touches a closed cell: their boxes do, and the cell's corners aren't all on one side of its line."""
    dx, dy = e["qx"] - e["px"], e["qy"] - e["py"]
    boxes = (F.least(e["px"], e["qx"]) <= x0 + s) & (F.greatest(e["px"], e["qx"]) >= x0) & (F.least(e["py"], e["qy"]) <= y0 + s) & (F.greatest(e["py"], e["qy"]) >= y0)
    corner = lambda i, j: dx * (y0 + j * s - e["py"]) - dy * (x0 + i * s - e["px"])
    corners = [corner(i, j) for i in (0, 1) for j in (0, 1)]
    slack = EPS * (F.abs(dx) + F.abs(dy)) * (F.abs(x0) + F.abs(y0) + s)
    return boxes & (F.least(*corners) <= slack) & (F.greatest(*corners) >= -slack)


def polygon_cells(polygons: DataFrame, least: float = 0.0, rounds: int = ROUNDS) -> DataFrame:
    """(zone, level, cx, cy, inner, edges) of polygons (zone, parts: open rings of struct<x,y>, holes among them).

    A cell of a level is 2 ** level wide. inner cells have no edges; the others have those that decide for their points.
    Cells aren't split below ``least``. Polygons that are null or have no points have no cells; a repeated zone has the
    cells of each of its rows.
    """
    spark = polygons.sparkSession
    whole = polygons.select("zone", _edges("parts").alias("edges")).filter("size(edges) > 0")
    end = lambda f, c: f(F.transform("edges", lambda e: e[c]))
    # few rows become many cells, so they are spread first
    whole = whole.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    boxed = whole.select("*", *(end(f, c).alias(n) for f, c, n in ((F.array_min, "px", "x0"), (F.array_min, "py", "y0"), (F.array_max, "px", "x1"), (F.array_max, "py", "y1"))))
    boxed = boxed.withColumn("level", F.ceil(F.log2(F.greatest(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0"), F.lit(LEAST_SIDE)))).cast("int"))
    step = lambda c: F.floor(F.col(c) / side(F.col("level")))
    rows = boxed.withColumn("cx", F.explode(F.sequence(step("x0"), step("x1")))).withColumn("cy", F.explode(F.sequence(step("y0"), step("y1"))))
    rows = rows.select("zone", "level", "cx", "cy", F.lit(False).alias("inner"), "edges")
    for k in range(rounds + 1):
        rows = rows.select("zone", F.explode(_sorted(least if k < rounds else None)).alias("c")).select("zone", "c.*")
    return rows


def _sorted(least: float | None) -> Column:
    """What a cell (level, cx, cy, inner, edges) becomes: nothing outside, itself inside, at an edge its four quarters unless they are too small."""
    s = side(F.col("level"))
    x0, y0 = F.col("cx") * s, F.col("cy") * s
    cell = lambda level, x, y, inner, e: F.struct(level.alias("level"), x.alias("cx"), y.alias("cy"), F.lit(inner).alias("inner"), e.alias("edges"))
    same = lambda inner, e: F.array(cell(F.col("level"), F.col("cx"), F.col("cy"), inner, e))

    def of(edges: Column) -> Column:
        none = F.slice(edges, 1, 0)
        halves = F.array(*(cell(F.col("level") - 1, F.col("cx") * 2 + i, F.col("cy") * 2 + j, False, edges) for i in (0, 1) for j in (0, 1)))
        at_edge = same(False, edges) if least is None else F.when(s / 2 >= least, halves).otherwise(same(False, edges))
        touched = F.exists(edges, lambda e: _touches(e, x0, y0, s))
        return F.when(F.col("inner"), same(True, none)).when(touched, at_edge).when(odd(edges, x0 + s / 2, y0 + s / 2), same(True, none)).otherwise(F.slice(same(False, none), 1, 0))

    return let(F.filter("edges", lambda e: _counts(e, x0, y0, s)), of)


def _at(points: DataFrame, cells: DataFrame) -> DataFrame:
    """points (x, y, any others) once for each level of written cells, of which there are some dozens at most."""
    levels = [r.level for r in cells.select("level").distinct().orderBy("level").collect()]
    spread = points.withColumn("level", F.explode(F.array(*map(F.lit, levels)).cast("array<int>")))
    return spread.withColumns({c: F.floor(F.col(v) / side(F.col("level"))) for c, v in (("cx", "x"), ("cy", "y"))})


KEYS = ["level", "cx", "cy"]


def points_in_polygons(points: DataFrame, polygons: DataFrame, least: float = 0.0) -> DataFrame:
    """(id, zone) of points (id, x, y) in polygons (zone, parts) by the even-odd rule; repeated points stay repeated."""
    cells = written(polygon_cells(polygons, least), "polygon-cells")
    return _at(points.select("id", "x", "y"), cells).join(cells, KEYS).filter(F.col("inner") | odd(F.col("edges"), F.col("x"), F.col("y"))).select("id", "zone")


def covered_points(points: DataFrame, polygons: DataFrame, least: float = 0.0) -> DataFrame:
    """The different ids of points (id, x, y) that some polygon (zone, parts) holds: a semi-join, whatever lies over a point."""
    shapes = polygons.select("parts").distinct().withColumn("zone", F.lit(0))
    cells = written(polygon_cells(shapes, least).drop("zone"), "polygon-cells")
    at, c = _at(points.select("id", "x", "y"), cells).alias("p"), cells.alias("c")
    same = [F.col(f"p.{k}") == F.col(f"c.{k}") for k in KEYS]
    return at.join(c, [*same, F.col("c.inner") | odd(F.col("c.edges"), F.col("p.x"), F.col("p.y"))], "left_semi").select("id").distinct()


def zone_totals(points: DataFrame, polygons: DataFrame, value: str = "value", least: float = 0.0) -> DataFrame:
    """(zone, n, total) over points (x, y, value) in each polygon (zone, parts), null values left out; zones without points have no row.

    Points of a cell are added up before they meet the polygons that the cell is inside of; only those in cells at an edge
    are tested one by one. Polygons of the same parts are worked out once.
    """
    shapes = written(polygons.select("parts").distinct().withColumn("shape", F.monotonically_increasing_id()), "shapes")
    cells = written(polygon_cells(shapes.withColumnRenamed("shape", "zone"), least), "polygon-cells")
    rows = _at(points.select("x", "y", F.col(value).alias("v")).filter("v IS NOT NULL"), cells)
    summed = rows.groupBy(*KEYS).agg(F.count("*").alias("n"), F.sum("v").alias("total")).join(cells.filter("inner").select("zone", *KEYS), KEYS)
    tested = rows.join(cells.filter("NOT inner"), KEYS).filter(odd(F.col("edges"), F.col("x"), F.col("y"))).select("zone", F.lit(1).cast("long").alias("n"), F.col("v").alias("total"))
    by_shape = summed.select("zone", "n", "total").unionByName(tested).groupBy(F.col("zone").alias("shape")).agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    rows = polygons.select("zone", "parts").join(shapes, "parts").join(by_shape, "shape")
    return rows.groupBy("zone").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))


def half_plane(ring: Column, nx: Column, ny: Column, c: Column) -> Column:
    """The part of an open ring of struct<x,y> where nx * x + ny * y <= c, as a ring; empty if there is none."""

    def of(r: Column) -> Column:
        def cut(p: Column, i: Column) -> Column:
            before = F.element_at(r, F.when(i > 0, i).otherwise(F.size(r)).cast("int"))

            def crossed(d: Column) -> Column:
                t = d["a"] / (d["a"] - d["b"])
                meet = F.struct((before["x"] + t * (p["x"] - before["x"])).alias("x"), (before["y"] + t * (p["y"] - before["y"])).alias("y"))
                own = F.struct(p["x"].alias("x"), p["y"].alias("y"))
                none = F.slice(F.array(own), 1, 0)
                return F.when((d["a"] <= 0) & (d["b"] <= 0), F.array(own)).when(d["b"] <= 0, F.array(meet, own)).when(d["a"] <= 0, F.array(meet)).otherwise(none)

            over = lambda q: nx * q["x"] + ny * q["y"] - c
            return let(F.struct(over(before).alias("a"), over(p).alias("b")), crossed)

        return F.flatten(F.transform(r, cut))

    return let(ring, of)


def clipped_by(ring: Column, sides: Column) -> Column:
    """An open ring cut by half planes, an array of struct<nx,ny,c>, one after the other."""
    return F.aggregate(sides, ring, lambda r, s: half_plane(r, s["nx"], s["ny"], s["c"]))


def box_sides(min_x: float, min_y: float, max_x: float, max_y: float) -> Column:
    plane = lambda nx, ny, c: F.struct(F.lit(float(nx)).alias("nx"), F.lit(float(ny)).alias("ny"), F.lit(float(c)).alias("c"))
    return F.array(plane(-1, 0, -min_x), plane(1, 0, max_x), plane(0, -1, -min_y), plane(0, 1, max_y))


def convex_sides(ring: Column) -> Column:
    """The half planes of a convex open ring that goes against the clock."""

    def of(r: Column) -> Column:
        def plane(p: Column, i: Column) -> Column:
            q = F.element_at(r, F.when(i + 1 < F.size(r), i + 2).otherwise(F.lit(1)).cast("int"))
            nx, ny = q["y"] - p["y"], p["x"] - q["x"]
            return F.struct(nx.alias("nx"), ny.alias("ny"), (nx * p["x"] + ny * p["y"]).alias("c"))

        return F.transform(r, plane)

    return let(ring, of)


def spaced(ring: Column, eps: float) -> Column:
    """Without corners nearer than eps to the one kept before, and without a last one so near to the first."""
    near = lambda p, q: F.hypot(p["x"] - q["x"], p["y"] - q["y"]) < eps
    kept = F.aggregate(ring, F.slice(ring, 1, 0), lambda a, p: F.when((F.size(a) > 0) & near(F.try_element_at(a, F.lit(-1)), p), a).otherwise(F.concat(a, F.array(p))))
    return let(kept, lambda r: F.when((F.size(r) > 1) & near(F.try_element_at(r, F.lit(1)), F.try_element_at(r, F.lit(-1))), F.slice(r, F.lit(1), F.size(r) - 1)).otherwise(r))


def fan(ring: Column) -> Column:
    """Rings of more than four corners as triangles around the mean of their corners; others as they are."""

    def of(r: Column) -> Column:
        mean = lambda c: (F.aggregate(F.transform(r, lambda p: p[c]), F.lit(0.0), lambda a, v: a + v) / F.size(r)).alias(c)
        after = lambda i: F.element_at(r, F.when(i + 1 < F.size(r), i + 2).otherwise(F.lit(1)).cast("int"))
        return F.when(F.size(r) > 4, let(F.struct(mean("x"), mean("y")), lambda m: F.transform(r, lambda p, i: F.array(m, p, after(i))))).otherwise(F.array(r))

    return let(ring, of)


def overlaps(faces: DataFrame, least: float = 1e-9, digits: int | None = None) -> DataFrame:
    """(a, b, square) for each pair a < b of convex faces (id, owner, ring against the clock) of different owners that share more than least.

    Faces of one ring are worked out once: rings meet in the cells of the larger one's size, in the one that holds the lower
    left corner of what their boxes share. The shared part is one ring cut by the sides of the other. Pairs of faces come of
    pairs of rings last, by arrays of faces, of which a ring of many faces has many. Arrays go to a ring's task once for each
    ring that it meets, not for each pair of arrays. With digits squares are rounded, once for a pair of rings.
    """
    rings = faces.filter("ring IS NOT NULL").groupBy("ring").agg(F.min("id").alias("id"), F.count("*").alias("n"))
    box = rings.select("id", "n", "ring", bounds(F.col("ring")).alias("box"))
    size = F.greatest(F.col("box.max_x") - F.col("box.min_x"), F.col("box.max_y") - F.col("box.min_y"), F.lit(LEAST_SIDE))
    boxed = written(box.withColumn("own", F.ceil(F.log2(size)).cast("int")), "face-boxes")
    levels = [r.own for r in boxed.select("own").distinct().orderBy("own").collect()]
    rows = boxed.withColumn("level", F.explode(F.filter(F.array(*map(F.lit, levels)).cast("array<int>"), lambda v: v >= F.col("own"))))
    steps = lambda c: F.explode(F.sequence(F.floor(F.col(f"box.min_{c}") / side(F.col("level"))), F.floor(F.col(f"box.max_{c}") / side(F.col("level")))))
    rows = rows.withColumn("cx", steps("x")).withColumn("cy", steps("y"))
    p, q = rows.filter("level = own").alias("p"), rows.alias("q")
    c = F.col
    first = (c("q.own") < c("p.own")) | ((c("q.own") == c("p.own")) & (c("q.id") <= c("p.id")))
    low = {d: F.greatest(c(f"p.box.min_{d}"), c(f"q.box.min_{d}")) for d in "xy"}
    meet = [low[d] < F.least(c(f"p.box.max_{d}"), c(f"q.box.max_{d}")) for d in "xy"] + [F.floor(low[d] / side(c("p.level"))) == c(f"p.c{d}") for d in "xy"]
    pairs = p.join(q, [*(c(f"p.{k}") == c(f"q.{k}") for k in KEYS), first, *meet])
    square = area(clipped_by(c("q.ring"), convex_sides(c("p.ring"))))
    many = c("p.n").cast("double") * c("q.n")
    shared = written(pairs.select(c("p.id").alias("pr"), c("q.id").alias("qr"), many.alias("pairs"), square.alias("square")), "shared-areas").filter(F.col("square") > least)
    owned = faces.filter("ring IS NOT NULL").select("id", "owner", "ring").join(boxed.select("ring", c("id").alias("r")).hint("merge"), "ring").select("id", "owner", "r")
    held = written(blocks(owned, ["r"], "id", ["owner"]), "face-blocks")
    at = lambda k: held.select(c("r").alias(f"{k}r"), c("block").alias(f"{k}_block"), c("members").alias(k))
    value = c("square") if digits is None else F.round("square", digits)
    left = shared.select("pr", "qr", value.alias("square")).join(at("p").hint("merge"), "pr")
    work = shared.groupBy("qr").agg(F.sum("pairs").alias("pairs"))
    both = unfolded(met(left, at("q"), ["qr"], ["pr", "p_block"], ["q_block"], work).select("pr", "qr", "square", "p", "q"), "p", "q")
    both = both.filter((c("p.owner") != c("q.owner")) & ((c("pr") != c("qr")) | (c("p.id") < c("q.id"))))
    return both.select(F.least("p.id", "q.id").alias("a"), F.greatest("p.id", "q.id").alias("b"), "square")
