"""Elevation grids as tables: (row, col, elev), or points (x, z, elev, row, col) with z to the south."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from urbanframe.operators.order import prefix_sums

#: Metres that a building stands above the highest terrain under it, and that a draped road lies above it.
BASE_GAP, DRAPE = 0.05, 0.15
#: Pixel values of a metre's hundredth at scale 1, and the pixel values above the middle.
UNITS_PER_PIXEL, HALF_RANGE = 128, 32767


def dense_index(points: DataFrame, x: str = "x", z: str = "z") -> DataFrame:
    """Adds row and col for points without them: ranks of the different z and x (2 dp), from 0.

    All places may differ, so ranks are row numbers by part. Points with a null place are left out.
    """
    out = points
    for c, name in ((z, "row"), (x, "col")):
        values = points.filter(F.col(c).isNotNull()).select(F.round(c, 2).alias("v")).distinct()
        ranked = prefix_sums(values, ["v"], {}, "dense-index").withColumnRenamed("row_no", name)
        out = out.withColumn("v", F.round(c, 2)).join(ranked, "v").drop("v")
    return out


def cropped(points: DataFrame, dx: float, dz: float, box: tuple[float, float, float, float]) -> DataFrame:
    """Points moved by (dx, dz) whose new place is in box (min_x, min_z, max_x, max_z), with row and col from 0 again."""
    x, z = F.col("x") + dx, F.col("z") + dz
    kept = points.withColumns({"x": x, "z": z}).filter(F.col("x").between(box[0], box[2]) & F.col("z").between(box[1], box[3]))
    base = kept.agg(F.min("row").alias("r0"), F.min("col").alias("c0"))
    return kept.join(F.broadcast(base)).withColumns({"row": F.col("row") - F.col("r0"), "col": F.col("col") - F.col("c0")}).drop("r0", "c0")


def idw_fill(grid: DataFrame, masked: Column, radius: int = 4, power: int = 2) -> DataFrame:
    """(row, col, elev, filled): masked cells become the mean of unmasked ones within a square, by 1 / distance ** power.

    Grids are as small in their files as they are large in memory, so no side is sent whole to a driver or task (merge
    joins, here and below). Null cells give nothing; a masked cell without neighbours keeps its value.
    """
    cells = grid.select("row", "col", "elev", masked.alias("masked"))
    steps = F.sequence(F.lit(-radius), F.lit(radius))
    around = F.flatten(F.transform(steps, lambda i: F.transform(steps, lambda j: F.struct((F.col("row") + i).alias("row"), (F.col("col") + j).alias("col"), F.pow(F.sqrt((i * i + j * j).cast("double")), F.lit(float(power))).alias("d")))))
    wanted = cells.filter("masked").select(F.col("row").alias("r"), F.col("col").alias("c"), F.explode(around).alias("n")).select("r", "c", "n.row", "n.col", "n.d").filter("d > 0")
    known = cells.filter("NOT masked AND elev IS NOT NULL").select("row", "col", F.col("elev").alias("e"))
    mean = wanted.join(known.hint("merge"), ["row", "col"]).groupBy(F.col("r").alias("row"), F.col("c").alias("col")).agg((F.sum(F.col("e") / F.col("d")) / F.sum(1 / F.col("d"))).alias("mean"))
    out = cells.join(mean.hint("merge"), ["row", "col"], "left")
    return out.select("row", "col", F.coalesce("mean", "elev").alias("elev"), F.col("mean").isNotNull().alias("filled"))


def quads(grid: DataFrame) -> DataFrame:
    """(row, col, e00, e01, e10, e11): cells whose four corners exist, between neighbouring existing rows and columns."""
    step = lambda c: grid.select(c).distinct().withColumn(f"next_{c}", F.lead(c).over(Window.orderBy(c)))
    at = grid.select("row", "col", "elev").join(step("row"), "row").join(step("col"), "col")
    corner = lambda r, c, e: grid.select(F.col("row").alias(r), F.col("col").alias(c), F.col("elev").alias(e))
    out = at.join(corner("row", "next_col", "e01").hint("merge"), ["row", "next_col"]).join(corner("next_row", "col", "e10").hint("merge"), ["next_row", "col"]).join(corner("next_row", "next_col", "e11").hint("merge"), ["next_row", "next_col"])
    return out.select("row", "col", F.col("elev").alias("e00"), "e01", "e10", "e11", "next_row", "next_col")


def bilinear(e00: Column, e01: Column, e10: Column, e11: Column, v: Column, u: Column) -> Column:
    """The elevation at share v of the rows and u of the columns of a cell."""
    return (e00 * (1 - u) + e01 * u) * (1 - v) + (e10 * (1 - u) + e11 * u) * v


def subdivided(grid: DataFrame, times: int = 4) -> DataFrame:
    """(row, col, elev) of a grid with times as many steps between neighbours; indices are multiplied by times."""
    shares = F.sequence(F.lit(0), F.lit(times - 1))
    inner = F.explode(F.flatten(F.transform(shares, lambda i: F.transform(shares, lambda j: F.struct(i.alias("i"), j.alias("j"))))))
    at = quads(grid).withColumn("s", inner)
    v, u = F.col("s.i") / float(times), F.col("s.j") / float(times)
    elev = bilinear(F.col("e00"), F.col("e01"), F.col("e10"), F.col("e11"), v, u)
    return at.select((F.col("row") * times + F.col("s.i")).alias("row"), (F.col("col") * times + F.col("s.j")).alias("col"), elev.alias("elev"))


def sampled(points: DataFrame, grid: DataFrame, size: float = 1.0, reach: int = 0) -> DataFrame:
    """Adds terrain to points (x, z, others): bilinear inside a cell of size metres of the grid.

    Where a cell lacks a corner, terrain is that of the nearest known grid point within reach cells (the one of the least
    row and column of several, as far as nanometres tell them apart), or null.
    """
    at = points.withColumns({"row": F.floor(F.col("z") / size), "col": F.floor(F.col("x") / size)})
    found = at.join(quads(grid).filter("next_row = row + 1 AND next_col = col + 1").drop("next_row", "next_col").hint("merge"), ["row", "col"], "left")
    terrain = bilinear(F.col("e00"), F.col("e01"), F.col("e10"), F.col("e11"), F.col("z") / size - F.col("row"), F.col("x") / size - F.col("col"))
    out = found.withColumn("terrain", terrain).select(*points.columns, "terrain")
    if not reach:
        return out
    places = out.filter("terrain IS NULL AND x IS NOT NULL AND z IS NOT NULL").select("x", "z").distinct()
    steps = F.sequence(F.lit(-reach), F.lit(reach))
    around = F.flatten(F.transform(steps, lambda i: F.transform(steps, lambda j: F.struct((F.floor(F.col("z") / size) + i).alias("row"), (F.floor(F.col("x") / size) + j).alias("col")))))
    near = places.withColumn("c", F.explode(around)).select("x", "z", "c.row", "c.col").join(grid.filter("elev IS NOT NULL").select("row", "col", "elev").hint("merge"), ["row", "col"])
    away = F.hypot(F.col("x") - F.col("col") * size, F.col("z") - F.col("row") * size)
    nearest = near.groupBy("x", "z").agg(F.min(F.struct(F.round(away, 9).alias("d"), "row", "col", "elev")).alias("n")).select("x", "z", F.col("n.elev").alias("near_elev"))
    return out.join(nearest.hint("merge"), ["x", "z"], "left").withColumn("terrain", F.coalesce("terrain", "near_elev")).select(*points.columns, "terrain")


def windowed(grid: DataFrame, first_row: int, last_row: int, first_col: int, last_col: int) -> DataFrame:
    """The rows and columns between two of each (included) of a grid, with row and col from 0 again."""
    kept = grid.filter(F.col("row").between(first_row, last_row) & F.col("col").between(first_col, last_col))
    return kept.withColumns({"row": F.col("row") - first_row, "col": F.col("col") - first_col})


def snapped_base(corners: DataFrame, grid: DataFrame, size: float = 1.0, reach: int = 0) -> DataFrame:
    """(id, base): the highest terrain under a footprint's corners (id, x, z) plus BASE_GAP; null where none is known."""
    return sampled(corners, grid, size, reach).groupBy("id").agg((F.max("terrain") + BASE_GAP).alias("base"))


def cubic(t: Column, a: float = -0.5) -> Column:
    """The kernel of cubic convolution."""
    x = F.abs(t)
    near = ((a + 2) * x - (a + 3)) * x * x + 1
    far = ((x - 5) * x + 8) * x * a - 4 * a
    return F.when(x < 1, near).when(x < 2, far).otherwise(F.lit(0.0))


def resampled(grid: DataFrame, rows: int, cols: int, out_rows: int, out_cols: int) -> DataFrame:
    """(row, col, elev) of a full grid enlarged by cubic convolution; samples are centred and edges lose their weight."""
    spark = grid.sparkSession

    def weights(n: int, big: int, out: str, into: str) -> DataFrame:
        centre = ((F.col("id") + 0.5) * n / big - 0.5).alias("centre")
        near = F.sequence(F.floor(F.col("centre")).cast("int") - 2, F.floor(F.col("centre")).cast("int") + 3)
        w = spark.range(big).select(F.col("id").cast("int").alias(out), centre).select(out, F.explode(near).alias(into), "centre").filter((F.col(into) >= 0) & (F.col(into) < n))
        w = w.withColumn("w", cubic(F.col("centre") - F.col(into))).filter("w <> 0")
        return w.withColumn("w", F.col("w") / F.sum("w").over(Window.partitionBy(out))).select(out, into, "w")

    down = grid.join(weights(rows, out_rows, "r", "row"), "row").groupBy("r", "col").agg(F.sum(F.col("elev") * F.col("w")).alias("elev"))
    across = down.join(weights(cols, out_cols, "c", "col"), "col").groupBy("r", "c").agg(F.sum(F.col("elev") * F.col("w")).alias("elev"))
    return across.select(F.col("r").alias("row"), F.col("c").alias("col"), "elev")


def encoded16(elev: Column, least: Column, most: Column) -> Column:
    """An elevation as 0 to 65535 between two bounds, cut towards zero."""
    return ((F.least(most, F.greatest(least, elev)) - least) / F.when(most > least, most - least).otherwise(F.lit(1.0)) * 65535).cast("int")


def landscape_scale(points: DataFrame, pixels: int) -> DataFrame:
    """What a game engine needs to place a heightmap of pixels by pixels over the points (x, z, elev), in centimetres.

    scale_x and scale_y are the steps between vertices, scale_z the height that the whole range of pixel values stands
    for, in units of the engine, offset_z the height of the lowest point. Without points all are null.
    """
    step = lambda c: ((F.max(c) - F.min(c)) * 100 / (pixels - 1)).alias
    scale = (F.max("elev") - F.min("elev")) * 100 * UNITS_PER_PIXEL / HALF_RANGE
    return points.agg(step("x")("scale_x"), step("z")("scale_y"), scale.alias("scale_z"), (F.min("elev") * 100).alias("offset_z"))


def split_bytes(pixel: Column) -> tuple[Column, Column]:
    return F.shiftright(pixel, 8), pixel.bitwiseAND(255)


def foundation_depth(bottom: Column, terrain: Column, least: float = 0.12, most: float = 25.0, eps: float = 0.03) -> Column:
    """How far a skirt reaches from an edge down to the terrain, within limits; null where the edge touches it."""
    gap = bottom - terrain
    return F.when(gap > eps, F.least(F.lit(most), F.greatest(F.lit(least), gap)))
