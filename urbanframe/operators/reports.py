"""Reports of checks: all of them in one table by area, and views of the latest."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from urbanframe.operators.quality import severity
from urbanframe.operators.runs import checked_id

REPORT = "report_id string, ts timestamp, check string, status string, message string, area string"


def append_report(checks: DataFrame, path: str, area: str, now: datetime) -> str:
    """Adds the checks (check, status, message) of an area as one report to the table at path, and returns its id.

    Ids sort by time within an area. A report without checks adds nothing, and so isn't the latest.
    """
    report = f"{checked_id(area)}-{now:%Y%m%dT%H%M%S%f}"
    rows = checks.select(F.lit(report).alias("report_id"), F.lit(now).alias("ts"), "check", "status", "message", F.lit(area).alias("area"))
    rows.write.mode("append").partitionBy("area").parquet(path)
    return report


def reports(spark: SparkSession, path: str, area: str | None = None) -> DataFrame:
    """All rows of all reports, or of an area's; other areas' folders aren't read."""
    rows = spark.read.schema(REPORT).parquet(path)
    return rows if area is None else rows.filter(F.col("area") == area)


def latest_reports(rows: DataFrame) -> DataFrame:
    """The rows of each area's latest report; of equal times that of the greatest id."""
    newest = rows.groupBy("area").agg(F.max(F.struct("ts", "report_id")).alias("last")).select(F.col("area").alias("a"), F.col("last.report_id").alias("r"))
    return rows.join(newest, F.col("area").eqNullSafe(F.col("a")) & (F.col("report_id") == F.col("r"))).select(*rows.columns)


def overview(rows: DataFrame) -> DataFrame:
    """(area, report_id, ts, severity, n_pass, n_warn, n_fail, current) of each report; current is each area's latest."""
    each = severity(rows, ["area", "report_id", "ts"])
    place = F.row_number().over(Window.partitionBy("area").orderBy(F.desc("ts"), F.desc("report_id")))
    return each.withColumn("current", place == 1)
