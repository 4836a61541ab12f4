"""Joins of points, boxes, rings and segments through grid cells.

A distance predicate alone plans as a nested loop. Here one side is put into its own cell and the other into all cells
within reach, so the join is an equality on cells with the exact test as a further condition.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from urbanframe.functions.geometry import crossing
from urbanframe.operators.blocks import blocks, expanded, met, unfolded
from urbanframe.operators.order import prefix_sums
from urbanframe.operators.overlay import points_in_polygons
from urbanframe.operators.staging import remove, written

#: So many open conflicts of neighbours, or fewer, are settled by a single task.
FEW_CONFLICTS = 1_000_000
#: Boxes of more cells each way stand in larger cells.
MOST_STEPS = 8
#: A cell in which more pairs of boxes than this may meet is divided among tasks.
MOST_PAIRS = 4_000_000


def cell(value: Column, size: float) -> Column:
    return F.floor(value / size)


def near_cells(x: Column, y: Column, size: float, reach: int = 1) -> Column:
    """All cells within reach of a point's, for explode."""
    steps = F.sequence(F.lit(-reach), F.lit(reach))
    return F.flatten(F.transform(steps, lambda i: F.transform(steps, lambda j: F.struct((cell(x, size) + i).alias("cx"), (cell(y, size) + j).alias("cy")))))


def box_cells(min_x: Column, min_y: Column, max_x: Column, max_y: Column, size: float | Column) -> Column:
    """All cells that a box touches, for explode; size may depend on the box (``cell_level``)."""
    xs, ys = F.sequence(cell(min_x, size), cell(max_x, size)), F.sequence(cell(min_y, size), cell(max_y, size))
    return F.flatten(F.transform(xs, lambda i: F.transform(ys, lambda j: F.struct(i.alias("cx"), j.alias("cy")))))


def cell_level(width: Column, height: Column, size: float) -> Column:
    """How often the cell size must double so that a box touches no more than MOST_STEPS + 1 cells each way."""
    return F.greatest(F.lit(0), F.ceil(F.log2(F.greatest(width, height, F.lit(size)) / (MOST_STEPS * size))).cast("int"))


def _levels(df: DataFrame) -> Column:
    """The different levels of df, a few dozens at most, as an array."""
    return F.array(*(F.lit(r[0]) for r in df.select("level").filter("level IS NOT NULL").distinct().orderBy("level").collect())).cast("array<int>")


def _doubled(size: float, level: Column) -> Column:
    return F.lit(size) * F.pow(F.lit(2.0), level)


def _renamed(df: DataFrame, names: tuple[str, str, str], to: tuple[str, str, str]) -> DataFrame:
    return df.select(*(F.col(a).alias(b) for a, b in zip(names, to, strict=True)))


def _finite(*names: str) -> Column:
    return reduce(Column.__and__, (F.col(c) - F.col(c) == 0 for c in names))


def _near_places(a: DataFrame, b: DataFrame, radius: float, strict: bool = False) -> DataFrame:
    """All rows of a (ax, ay, others) with those of b (bx, by, others) within radius, with their distance."""
    a = a.withColumns({"cx": cell(F.col("ax"), radius), "cy": cell(F.col("ay"), radius)})
    others = [c for c in b.columns]
    b = b.withColumn("c", F.explode(near_cells(F.col("bx"), F.col("by"), radius))).select(*others, "c.cx", "c.cy")
    d = F.hypot(F.col("ax") - F.col("bx"), F.col("ay") - F.col("by"))
    near = a.hint("merge").join(b.hint("merge"), ["cx", "cy"]).withColumn("distance", d)
    return near.filter(F.col("distance") < radius if strict else F.col("distance") <= radius).drop("cx", "cy")


def within_distance(left: DataFrame, right: DataFrame, radius: float, names: tuple[str, str, str] = ("id", "x", "y"), strict: bool = False) -> DataFrame:
    """(left_id, right_id, distance) of all pairs within radius (or strictly nearer).

    Places meet, with arrays of the ids that stand there, and pairs of ids come of them last; the right side is spread over
    cells. A place of many ids has many arrays.
    """
    a = blocks(_renamed(left, names, ("left_id", "ax", "ay")), ["ax", "ay"], "left_id").withColumnRenamed("members", "l").drop("block")
    b = blocks(_renamed(right, names, ("right_id", "bx", "by")), ["bx", "by"], "right_id").withColumnRenamed("members", "r").drop("block")
    near = _near_places(a, b, radius, strict).select("l", "r", "distance")
    return expanded(near, "l", "r").select("l.left_id", "r.right_id", "distance")


def nearest(left: DataFrame, right: DataFrame, radius: float, names: tuple[str, str, str] = ("id", "x", "y")) -> DataFrame:
    """(left_id, right_id, distance) of the nearest right row within radius for each left row; of ties the smallest id.

    Each place is looked for once, and of the right rows of one place only that of the smallest id is met.
    """
    a = written(_renamed(left, names, ("left_id", "ax", "ay")), "searched")
    # places may be long expressions, which grouping would work out slowly and many times
    b = written(_renamed(right, names, ("right_id", "bx", "by")), "found")
    first = b.filter(F.col("right_id").isNotNull()).groupBy("bx", "by").agg(F.min("right_id").alias("right_id"))
    pairs = _near_places(a.select("ax", "ay").distinct(), first, radius)
    best = pairs.groupBy("ax", "ay").agg(F.min(F.struct("distance", "right_id")).alias("b"))
    found = a.hint("merge").join(best.hint("merge"), ["ax", "ay"]).groupBy("left_id").agg(F.min("b").alias("b"))
    return found.select("left_id", "b.right_id", "b.distance")


def links_within(points: DataFrame, radius: float) -> DataFrame:
    """(src, dst): edges between points (id, x, y) that give the same components as all pairs within radius.

    Ids at one place meet the least of them. Places in a cell whose diagonal is below the radius meet one of them, and
    cells meet once however many of their places are near. Radius is positive.
    """
    p = written(points.select("id", "x", "y"), "points").filter(_finite("x", "y"))
    places = p.groupBy("x", "y").agg(F.min("id").alias("first"))
    copies = p.hint("merge").join(places.hint("merge"), ["x", "y"]).filter("id <> first").select(F.col("first").alias("src"), F.col("id").alias("dst"))
    small = [cell(F.col(c), radius / 1.5).alias(f"s{c}") for c in "xy"]
    reps = places.groupBy(*small).agg(F.min("first").alias("rep"))
    held = written(places.select("*", *small).hint("merge").join(reps.hint("merge"), ["sx", "sy"]).select("x", "y", "first", "rep"), "places")
    inner = held.filter("first <> rep").select(F.col("rep").alias("src"), F.col("first").alias("dst"))
    side = lambda k: held.select(F.col("x").alias(f"{k}x"), F.col("y").alias(f"{k}y"), F.col("rep").alias(f"{k}_rep"))
    across = _near_places(side("a"), side("b"), radius).filter("a_rep < b_rep").select(F.col("a_rep").alias("src"), F.col("b_rep").alias("dst")).distinct()
    return copies.unionByName(inner).unionByName(across)


def _settled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The ids that go, from one partition's conflicts (earlier, later), taken in id order."""
    before: dict = {}
    kind = None
    for b in batches:
        kind = b.column(1).type
        for earlier, later in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            before.setdefault(later, []).append(earlier)
    gone: set = set()
    for later in sorted(before):
        if any(e not in gone for e in before[later]):
            gone.add(later)
    if gone:
        yield pa.RecordBatch.from_arrays([pa.array(sorted(gone), kind)], ["id"])


def keep_first(points: DataFrame, pairs: DataFrame, id_col: str = "id", few: int = FEW_CONFLICTS) -> DataFrame:
    """The ids that stay when rows are taken in id order and one goes if it conflicts with a row that stayed before.

    pairs (earlier, later) holds the conflicts. In each round a row without an undecided or kept earlier partner stays,
    and one with a kept earlier partner goes; that is the sequential result. Rounds end when few conflicts or fewer are
    open: one task settles these, in bounded memory. So only chains of conflicts that are long and many take many rounds.
    """
    open_ = written(pairs.select("earlier", "later").distinct(), "conflicts")
    dropped: list[DataFrame] = []
    while (left := open_.count()) > few:
        later = open_.select(F.col("later").alias("id")).distinct()
        kept = open_.select(F.col("earlier").alias("id")).distinct().join(later.hint("merge"), "id", "left_anti")
        out = written(open_.join(kept.withColumnRenamed("id", "earlier").hint("merge"), "earlier", "left_semi").select(F.col("later").alias("id")).distinct(), "dropped")
        dropped.append(out)
        gone = out.select(F.col("id").alias("later"))
        rest = open_.join(gone.hint("merge"), "later", "left_anti").join(gone.withColumnRenamed("later", "earlier").hint("merge"), "earlier", "left_anti")
        open_, old = written(rest, "conflicts"), open_
        remove(old)
    if left:
        kind = open_.schema["later"].dataType.simpleString()
        dropped.append(written(open_.coalesce(1).mapInArrow(_settled, f"id {kind}"), "dropped"))
    ids = points.select(F.col(id_col).alias("id"))
    if dropped:
        ids = ids.join(reduce(DataFrame.union, dropped).hint("merge"), "id", "left_anti")
    return ids.withColumnRenamed("id", id_col)


def dedup_within(points: DataFrame, radius: float, names: tuple[str, str, str] = ("id", "x", "y")) -> DataFrame:
    """Ids of points that have no kept point of a smaller id strictly within radius; ids are unique.

    Whatever lets the first id of a place go, or that id itself, lets the later ones there go too. So only first ids meet.
    Rows without a place stay.
    """
    p = written(_renamed(points, names, ("id", "x", "y")), "points")
    if radius <= 0:
        return p.select(F.col("id").alias(names[0]))
    known = F.coalesce(_finite("x", "y"), F.lit(False))
    first = written(p.filter(known & F.col("id").isNotNull()).groupBy("x", "y").agg(F.min("id").alias("id")), "first-places")
    side = lambda k, c: first.select(F.col("x").alias(f"{k}x"), F.col("y").alias(f"{k}y"), F.col("id").alias(c))
    pairs = _near_places(side("a", "earlier"), side("b", "later"), radius, strict=True).filter("earlier < later").select("earlier", "later")
    kept = keep_first(first, pairs).select(F.col("id").alias(names[0]))
    return kept.union(p.filter(~known | F.col("id").isNull()).select("id"))


def uncovered(extra: DataFrame, primary: DataFrame, size: float, names: tuple[str, str, str] = ("id", "x", "y"), whole: bool = True) -> DataFrame:
    """Ids of extra points without a primary point in the 3 x 3 cells around theirs; added ones cover later ones too.

    Cells are cut towards zero, so those around zero are twice as wide. With whole false only the primary points cover.
    """
    cut = lambda c: (F.col(c) / size).cast("long")
    own = _renamed(extra, names, ("id", "x", "y")).select("id", cut("x").alias("cx"), cut("y").alias("cy"))
    steps = F.sequence(F.lit(-1), F.lit(1))
    block = F.flatten(F.transform(steps, lambda i: F.transform(steps, lambda j: F.struct((F.col("cx") + i).alias("cx"), (F.col("cy") + j).alias("cy")))))
    held = _renamed(primary, names, ("id", "x", "y")).select(cut("x").alias("cx"), cut("y").alias("cy")).distinct()
    around = own.withColumn("c", F.explode(block)).select("id", "c.cx", "c.cy")
    covered = around.join(held, ["cx", "cy"], "left_semi").select("id").distinct()
    free = own.join(covered, "id", "left_anti")
    if not whole:
        return free.select(F.col("id").alias(names[0]))
    # what takes the first id of a cell, or that id, takes the later ones there: only first ids meet
    free = written(free, "uncovered")
    known = F.col("cx").isNotNull() & F.col("cy").isNotNull()
    first = written(free.filter(known & F.col("id").isNotNull()).groupBy("cx", "cy").agg(F.min("id").alias("id")), "first-cells")
    near = first.withColumn("c", F.explode(block)).select(F.col("id").alias("later"), "c.cx", "c.cy").join(first.withColumnRenamed("id", "earlier").hint("merge"), ["cx", "cy"]).filter("earlier < later")
    return keep_first(first, near, "id").union(free.filter(~known | F.col("id").isNull()).select("id")).withColumnRenamed("id", names[0])


def points_in_rings(points: DataFrame, rings: DataFrame, size: float) -> DataFrame:
    """(id, ring_id) of points (id, x, y) inside open rings (ring_id, ring); cells at the edge of a ring aren't split below size."""
    return points_in_polygons(points, rings.select(F.col("ring_id").alias("zone"), F.array("ring").alias("parts")), size).withColumnRenamed("zone", "ring_id")


def segment_crossings(segments: DataFrame, size: float = 25.0, least: float = 0.05, most: float = 0.95, limit: int | None = None, digits: tuple[int, int] | None = None) -> DataFrame:
    """(a, b, t, u, x, y) where segments (id, road, ax, ay, bx, by) of different roads cross inside both.

    Ids are unique. A pair is given once, a < b. Above limit segments there is no result, where a limit is asked for. Long segments stand in
    cells that are doubled until they touch few; a pair meets in the cells of the longer one. Segments of the same ends meet others once,
    as arrays that lie in the cells, and pairs of segments come last. With digits shares and places are rounded, once for a pair of arrays.
    """
    if limit is not None and segments.limit(limit + 1).count() > limit:
        segments = segments.limit(0)
    low = lambda f, c: f(F.col(f"a{c}"), F.col(f"b{c}"))
    ends = ["ax", "ay", "bx", "by"]
    boxed = blocks(segments, ends, "id", ["road"]).withColumns({"x0": low(F.least, "x"), "x1": low(F.greatest, "x"), "y0": low(F.least, "y"), "y1": low(F.greatest, "y")})
    boxed = boxed.withColumns({"level": cell_level(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0"), size), "first": F.array_min("members.id"), "last": F.array_max("members.id")})
    boxed = written(boxed.drop("block"), "segment-blocks")
    spread = boxed.withColumn("at", F.explode(F.filter(_levels(boxed), lambda v: v >= F.col("level"))))
    spread = spread.withColumn("c", F.explode(box_cells(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1"), _doubled(size, F.col("at"))))).select("*", "c.cx", "c.cy").drop("c")
    place = ["at", "cx", "cy"]
    n = F.sum(F.size("members")).cast("double")
    work = spread.groupBy(*place).agg((n * n).alias("pairs"))
    # whether a row stands in cells of its own level, and in its lowest one each way: what would be slow for each pair
    lowest = lambda v: cell(F.col(f"{v}0"), _doubled(size, F.col("at"))) == F.col(f"c{v}")
    spread = spread.withColumns({"own": F.col("level") == F.col("at"), "low_x": lowest("x"), "low_y": lowest("y")}).drop("level")
    side = lambda k: spread.select(*place, *(F.col(v).alias(f"{k}_{v}") for v in spread.columns if v not in place))
    pairs = met(side("p"), side("q"), place, ["p_first"], ["q_first"], work)
    c = F.col
    touch = (c("p_x0") <= c("q_x1")) & (c("q_x0") <= c("p_x1")) & (c("p_y0") <= c("q_y1")) & (c("q_y0") <= c("p_y1"))
    # of the cells of a pair, that of the lower left corner of what their boxes share
    once = (c("p_low_x") | c("q_low_x")) & (c("p_low_y") | c("q_low_y")) & (c("p_own") | c("q_own"))
    pairs = pairs.filter((c("p_first") < c("q_first")) & touch & once)
    t, u = crossing(*(c(f"{s}_{v}") for s in "pq" for v in ends))
    inside = (t > least) & (t < most) & (u > least) & (u < most)
    # a row or none, so that these tests don't become part of the join's
    ways = [F.col(f"{k}_{v}") for k in "pq" for v in (*ends, "members", "first", "last")]
    pairs = pairs.select(*ways, F.explode(F.when(inside, F.array(F.struct(t.alias("t"), u.alias("u"))))).alias("cut"))
    t, u = c("cut.t"), c("cut.u")
    share, at = (lambda v: v, lambda v: v) if digits is None else (lambda v: F.round(v, digits[0]), lambda v: F.round(v, digits[1]))
    along = lambda k, d, r: at(c(f"{k}_a{d}") + r * (c(f"{k}_b{d}") - c(f"{k}_a{d}")))
    # places are worked out along the segment of the smaller id, which may be of either array
    turned = c("p_last") > c("q_first")
    other = {f"q{d}": F.when(turned, along("q", d, u)) for d in "xy"}
    pairs = pairs.select(c("p_members").alias("p"), c("q_members").alias("q"), share(t).alias("t"), share(u).alias("u"), *(along("p", d, t).alias(f"p{d}") for d in "xy"), *(v.alias(k) for k, v in other.items()))
    rows = unfolded(pairs, "p", "q").filter(c("p.road") != c("q.road"))
    ahead = c("p.id") < c("q.id")
    either = lambda a, b: F.when(ahead, c(a)).otherwise(c(b))
    return rows.select(F.least("p.id", "q.id").alias("a"), F.greatest("p.id", "q.id").alias("b"), either("t", "u").alias("t"), either("u", "t").alias("u"), either("px", "qx").alias("x"), either("py", "qy").alias("y"))


def _level(width: Column, height: Column) -> Column:
    """The least whole power of 2 that is a box's longer side or more; boxes without a side count as very small ones."""
    return F.ceil(F.log2(F.greatest(width, height, F.lit(2.0**-40)))).cast("int")


def smallest_cover(targets: DataFrame, covers: DataFrame, order: list[str] | None = None, same: Sequence[str] = ()) -> DataFrame:
    """(target, cover) for boxes (id, west, south, east, north): the cover of least area in square degrees, then id.

    With order the first cover by these columns; with same only covers with the target's values there. A cover stands in the cells of its own level that it touches, four at
    most, and holds the south-western corner of what it covers; so the join is an equality on level and cell. There are as
    many levels as sizes of covers by powers of 2, which reach the driver. Covers are numbered in their order first, so that
    pairs are added up by a number as they come, and none is sorted or kept; the targets of a crowded cell go to many tasks,
    each with all of its covers. Repeated targets give one row.
    """
    degrees = lambda c, level: F.floor(F.col(c) / F.pow(F.lit(2.0), level))
    level = F.col("level")
    sides = ["west", "south", "east", "north"]
    # of covers of one box only the first can be a result, and targets of one box have the same
    rank = F.min(F.struct(*(F.col(c).alias(f"o{k}") for k, c in enumerate(order or [])), F.col("id").alias("cover"))).alias("first")
    held = covers.filter("east >= west AND north >= south").groupBy(*same, *sides).agg(rank)
    held = held.withColumn("level", _level(F.col("east") - F.col("west"), F.col("north") - F.col("south")))
    held = held.withColumn("size", F.lit(0.0) if order else (F.col("east") - F.col("west")) * (F.col("north") - F.col("south")))
    held = written(prefix_sums(held, ["size", "first"], {}, "ordered-covers"), "covers")
    levels = sorted(r[0] for r in held.select("level").filter("level IS NOT NULL").distinct().collect())
    steps = lambda a, b: F.explode(F.sequence(degrees(a, level), degrees(b, level)))
    place = ["level", "cx", "cy", *same]
    spread = held.drop("size", "first").withColumn("cx", steps("west", "east")).withColumn("cy", steps("south", "north"))
    box = [f"t_{c}" for c in sides]
    t = targets.select(F.col("id").alias("target"), *same, *(F.col(c).alias(b) for c, b in zip(sides, box, strict=True)))
    at = t.select(*same, *box).distinct().withColumn("level", F.explode(F.array(*map(F.lit, levels)).cast("array<int>"))).withColumns({"cx": degrees("t_west", level), "cy": degrees("t_south", level)})
    tasks = int(targets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    work = at.groupBy(*place).agg(F.count("*").alias("n")).join(spread.groupBy(*place).agg(F.count("*").alias("m")).hint("merge"), place)
    work = work.select(*place, F.least(F.lit(tasks), F.ceil(F.col("n") * F.col("m") / MOST_PAIRS)).cast("int").alias("parts"))
    at = at.join(work.hint("merge"), place).withColumn("part", F.pmod(F.xxhash64(*box), F.col("parts")).cast("int")).drop("parts")
    spread = spread.join(work.hint("merge"), place).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    inside = (F.col("west") <= F.col("t_west")) & (F.col("south") <= F.col("t_south")) & (F.col("east") >= F.col("t_east")) & (F.col("north") >= F.col("t_north"))
    best = at.join(spread.hint("merge"), [*place, "part"]).filter(inside).groupBy(*same, *box).agg(F.min("row_no").alias("row_no"))
    best = best.join(held.select("row_no", "first.cover").hint("merge"), "row_no").select(*same, *box, F.struct("row_no", "cover").alias("b"))
    found = t.hint("merge").join(best.hint("merge"), [*same, *box], "left").groupBy("target").agg(F.min("b").alias("b"))
    return found.select("target", F.col("b.cover").alias("cover"))
