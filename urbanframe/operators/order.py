"""Places in a global order without a single task: row numbers, prefix sums, every n-th row and exact ranks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from urbanframe.operators.staging import written

#: Bits of a monotonically increasing id below the partition's number.
PLACE_BITS = 33
#: Ranges into which the values of a group are parted to find ranks, and how finely the splitters are estimated.
RANGES, ACCURACY = 64, 10_000


def prefix_sums(df: DataFrame, order: list[str], values: dict[str, Column], name: str) -> DataFrame:
    """Adds to each row the sums of values over all rows before it in the order of the given columns, and its ``row_no``.

    Rows are exchanged once, by sampled splitters, sorted, and written with their places in their part. Only one total for
    each part (as many as partitions) goes to every task; no task holds more than its own part, and without values
    nothing is exchanged again. Other columns pass through, whatever their names are; columns with the added names are
    replaced.
    """
    kept = [c for c in df.columns if c not in values and c != "row_no"]
    rest = {c: f"c{k}" for k, c in enumerate(df.columns)}  # the columns added here can't clash with these
    rows = df.select("*", *values.values()).toDF(*rest.values(), *(f"v{k}" for k in range(len(values))))
    by = [rest[c] for c in order]
    rows = written(rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("at", F.monotonically_increasing_id()), name)
    rows = rows.withColumns({"part": F.shiftright("at", PLACE_BITS), "place": F.col("at").bitwiseAND((1 << PLACE_BITS) - 1)})
    sums = range(len(values))
    totals = rows.groupBy("part").agg(F.count("*").alias("rows"), *(F.sum(f"v{k}").alias(f"s{k}") for k in sums))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    earlier = lambda c, to: F.coalesce(F.sum(c).over(before), F.lit(0)).alias(to)
    offsets = totals.select("part", earlier("rows", "row0"), *(earlier(f"s{k}", f"o{k}") for k in sums))
    joined = rows.join(F.broadcast(offsets), "part")
    upto = Window.partitionBy("part").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    added = [(F.col(f"o{k}") + F.coalesce(F.sum(f"v{k}").over(upto), F.lit(0))).alias(n) for k, n in enumerate(values)]
    return joined.select(*(F.col(rest[c]).alias(c) for c in kept), *added, (F.col("row0") + F.col("place")).alias("row_no"))


def first_places(df: DataFrame, by: list[str], value: str, order: str) -> DataFrame:
    """(by, value, place): each different value of a group once, with its place from 0 by where it first stands in order.

    Places are row numbers of all groups together less those before the group, so that no task holds a group. Values that
    stand at the same place of the order, or at none, go by value. Null values are left out, a null group is a group.
    """
    keys = [f"k{k}" for k in range(len(by))]
    rows = df.select(*(F.col(c).alias(k) for c, k in zip(by, keys, strict=True)), F.col(value).alias("v"), F.col(order).alias("o")).filter("v IS NOT NULL")
    first = rows.groupBy(*keys, "v").agg(F.min("o").alias("o"))
    placed = prefix_sums(first.withColumn("none", F.col("o").isNull()), [*keys, "none", "o", "v"], {}, "first-places")
    starts = placed.groupBy(*keys).agg(F.min("row_no").alias("start"))
    same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
    joined = placed.alias("a").join(starts.alias("b"), same)
    return joined.select(*(F.col(f"a.{k}").alias(c) for c, k in zip(by, keys, strict=True)), F.col("v").alias(value), (F.col("row_no") - F.col("start")).alias("place"))


def every_nth(df: DataFrame, order: list[str], most: int | None) -> DataFrame:
    """Every ceil(n / most)-th row in order; all rows with most None or no more rows than that."""
    if most is None:
        return df
    step = max(1, -(-df.count() // most))
    return prefix_sums(df, order, {}, "every-nth").filter(F.col("row_no") % step == 0).drop("row_no")


def nearest_rank(df: DataFrame, value: str, shares: list[float], by: list[str] | None = None) -> DataFrame:
    """One column for each share: the value at round((n - 1) * share), half to even, of the sorted values; nulls are left out.

    Equal values are counted first. Estimated quantiles part each group into ranges, whose rows are counted exactly; only
    the ranges that hold a wanted rank are sorted, each by itself. So the result is exact and no task sorts a group. Groups
    without values, and tables without rows, give no row.
    """
    keys = [f"k{k}" for k in range(len(by or []))] or ["k0"]
    named = [F.col(c).alias(k) for c, k in zip(by, keys, strict=True)] if by else [F.lit(0).alias("k0")]
    rows = df.filter(F.col(value).isNotNull()).select(*named, F.col(value).alias("v"))
    counts = written(rows.groupBy(*keys, "v").agg(F.count("*").alias("n")), "value-counts")
    cuts = [k / RANGES for k in range(1, RANGES)]
    splits = rows.groupBy(*keys).agg(F.percentile_approx("v", cuts, ACCURACY).alias("cuts"), F.count("*").alias("all"))
    same = lambda a, b: [F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}")) for k in keys]
    wanted = F.array(*(F.bround((F.col("all") - 1) * F.lit(q)).cast("long") for q in shares))
    splits = written(splits.withColumn("wanted", wanted), "value-splits")
    ranged = counts.alias("a").join(splits.alias("b"), same("a", "b")).select("a.*", F.size(F.filter("cuts", lambda c: c < F.col("v"))).alias("r"))
    sizes = ranged.groupBy(*keys, "r").agg(F.sum("n").alias("n"))
    upto = Window.partitionBy(*keys).orderBy("r")  # RANGES rows for each group at most
    starts = sizes.withColumn("start", F.sum("n").over(upto) - F.col("n"))
    held = starts.alias("a").join(splits.alias("b"), same("a", "b")).select("a.*", "wanted")
    hit = written(held.filter(F.exists("wanted", lambda w: (w >= F.col("start")) & (w < F.col("start") + F.col("n")))).drop("n"), "wanted-ranges")
    few = ranged.alias("a").join(hit.alias("b"), [*same("a", "b"), F.col("a.r") == F.col("b.r")]).select("a.*", "start", "wanted")
    inside = Window.partitionBy(*keys, "r").orderBy("v")
    placed = few.withColumn("last", F.col("start") + F.sum("n").over(inside))
    pick = lambda k, q: F.max(F.when((F.col("wanted")[k] >= F.col("last") - F.col("n")) & (F.col("wanted")[k] < F.col("last")), F.col("v"))).alias(f"p{round(q * 100):02d}")
    out = placed.groupBy(*keys).agg(*(pick(k, q) for k, q in enumerate(shares)))
    return out.select(*(F.col(k).alias(c) for c, k in zip(by or [], keys, strict=False)), *(f"p{round(q * 100):02d}" for q in shares))
