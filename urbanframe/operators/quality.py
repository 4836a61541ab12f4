"""Data checks: contracts, retention, percentiles and their roll-up, as tables (check, status, message)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

#: Fixed values of the contract.
HEIGHT_SOURCES = ("overture", "osm", "estimated_pending")
LOW_RETENTION, HIGH_RETENTION = 0.5, 0.995
#: Limits of faces, warn and fail.
FACE_LIMITS = {"area": (750.0, 5000.0), "aspect": (150.0, 500.0), "angle": (5.0, 2.0), "verts": (64, None)}
RANK = {"pass": 0, "warn": 1, "fail": 2}


def checks(one: DataFrame, rules: list[tuple[str, Column, Column]]) -> DataFrame:
    """Check rows from a table of one row: (name, status, message); a null status leaves the check out."""
    items = F.array(*(F.struct(F.lit(n).alias("check"), s.alias("status"), m.alias("message")) for n, s, m in rules))
    return one.select(F.explode(items).alias("c")).select("c.*").filter("status IS NOT NULL")


def building_checks(buildings: DataFrame) -> DataFrame:
    """Contract of buildings (height double, height_source string), in one pass."""
    height, source = F.col("height"), F.col("height_source")
    one = buildings.agg(
        F.count("*").alias("n"),
        F.count_if(height.isNull()).alias("missing"),
        F.count_if((height < 0) | (height > 600)).alias("outside"),
        F.count_if(source.isNull()).alias("no_source"),
        F.count_if(~source.isin(*HEIGHT_SOURCES)).alias("bad_source"),
        F.count_if(source.isin("overture", "osm")).alias("real"),
        F.count_if(source == "estimated_pending").alias("pending"),
    )
    c, some = F.col, F.col("n") > 0
    text = lambda *p: F.concat(*(x.cast("string") if isinstance(x, Column) else F.lit(x) for x in p))
    return checks(one, [
        ("bld_attr_present", F.when(~some, "fail"), F.lit("no buildings")),
        ("bld_height_present", F.when(some, F.when(c("missing") > 0, "fail").otherwise("pass")), text(c("missing"), " of ", c("n"), " without height")),
        ("bld_height_range", F.when(some & (c("outside") > 0), "warn"), text(c("outside"), " of ", c("n"), " out of range")),
        ("bld_height_source", F.when(some, F.when(c("no_source") + c("bad_source") > 0, "fail").otherwise("pass")), text(c("real"), " real, ", c("pending"), " pending, ", c("no_source") + c("bad_source"), " bad")),
    ])


def attribute_coverage(ways: DataFrame) -> DataFrame:
    """n, with_lanes, with_oneway and with_width of ways with string tags; empty and 0 count as none but for oneway."""
    known = lambda c: ~F.trim(F.coalesce(F.col(c), F.lit(""))).isin("", "0")
    return ways.agg(F.count("*").alias("n"), F.count_if(known("lanes")).alias("with_lanes"), F.count_if(F.coalesce(F.col("oneway"), F.lit("")) != "").alias("with_oneway"), F.count_if(known("width")).alias("with_width"))


def severity(rows: DataFrame, by: list[str] | None = None) -> DataFrame:
    """The worst status and the number of each, for all checks or each group."""
    rank = F.create_map(*(F.lit(x) for kv in RANK.items() for x in kv))[F.col("status")]
    name = F.element_at(F.array(*map(F.lit, RANK)), F.coalesce(F.max(rank), F.lit(0)) + 1)
    n = lambda s: F.count_if(F.col("status") == s).alias(f"n_{s}")
    return rows.groupBy(*(by or [])).agg(name.alias("severity"), *map(n, RANK))


def retention(n_in: Column, n_out: Column) -> tuple[Column, Column]:
    """(ratio, status): warn below a half and above 99.5 %; null if either is 0."""
    ratio = F.when((n_in > 0) & (n_out > 0), n_out / n_in)
    return ratio, F.when(ratio.isNull(), None).when((ratio < LOW_RETENTION) | (ratio > HIGH_RETENTION), "warn").otherwise("pass")


def missing_cells(df: DataFrame, columns: list[str]) -> Column:
    """Counts rows with an empty or nan string in any of the columns."""
    return F.count_if(F.exists(F.array(*columns), lambda v: F.lower(F.trim(v)).isin("", "nan")))


def height_anomalies(buildings: DataFrame) -> DataFrame:
    """min, mean and max height with the two anomaly rules: all heights the default of 10, and a mean below 0.5."""
    h = F.col("height")
    one = buildings.agg(F.count("*").alias("n"), F.min(h).alias("min_height"), F.avg(h).alias("mean_height"), F.max(h).alias("max_height"), F.count_if(h == 10).alias("tens"))
    return one.withColumn("anomaly", F.when(F.col("n") == 0, "empty").when(F.col("tens") == F.col("n"), "all_default").when(F.col("mean_height") < 0.5, "near_zero").otherwise("none")).drop("tens")


def latest(df: DataFrame, by: list[str], order: list[Column]) -> DataFrame:
    """The last row of each group."""
    return df.withColumn("__r", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter("__r = 1").drop("__r")
