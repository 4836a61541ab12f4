"""Elevation points as CSV with and without row and column, cells of a decoded raster, and ordered fallbacks."""

from __future__ import annotations

import warnings
from collections.abc import Callable, Sequence

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F

from urbanframe.functions.projection import Projector
from urbanframe.operators.raster import dense_index

NO_DATA = -9000.0


def read_points(spark: SparkSession, path: str) -> DataFrame:
    """(x, z, elev, row, col); files of three columns get row and col from their different coordinates."""
    raw = spark.read.option("header", True).csv(path)
    value = lambda c: F.col(c).try_cast("double")
    points = raw.select(value("x").alias("x"), value("z").alias("z"), F.when(~F.isnan(value("y")), value("y")).alias("elev"), *(F.col(c).try_cast("int").alias(c) for c in ("row", "col") if c in raw.columns))
    return points if "row" in points.columns else dense_index(points)


def write_points(points: DataFrame, path: str) -> None:
    """x, y (elevation) and z with two decimals, then row and col."""
    fixed = lambda c: F.format_string("%.2f", F.col(c))
    points.select(fixed("x").alias("x"), fixed("elev").alias("y"), fixed("z").alias("z"), "row", "col").write.option("header", True).csv(path)


def raster_points(cells: DataFrame, origin: Projector, transform: tuple[float, float, float, float]) -> DataFrame:
    """(x, z, elev, row, col) of decoded cells (row, col, value): their upper left corners, without missing values.

    transform is (lon of the left edge, degrees of a column, lat of the top edge, degrees of a row).
    """
    lon0, dlon, lat0, dlat = transform
    x, z = origin.scene(F.col("col") * dlon + lon0, F.col("row") * dlat + lat0)
    return cells.filter(F.col("value") >= NO_DATA).select(F.round(x, 2).alias("x"), F.round(z, 2).alias("z"), F.round("value", 2).alias("elev"), "row", "col")


def first_available(sources: Sequence[tuple[str, Callable[[], DataFrame]]]) -> tuple[str, DataFrame] | None:
    """The name of the first source that can be read and has rows, and its table with the name as dem_source.

    A source is passed over, with a warning that gives the reason, if Spark or the file system can't read it; other errors
    are raised.
    """
    for name, read in sources:
        try:
            df = read()
            if df.limit(1).count():
                return name, df.withColumn("dem_source", F.lit(name))
            reason = "no rows"
        except (PySparkException, Py4JError, OSError) as e:
            reason = str(e).splitlines()[0]
        warnings.warn(f"elevation source {name}: {reason}", stacklevel=2)
    return None
