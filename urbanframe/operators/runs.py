"""Runs: progress from log lines, states from events, content fingerprints and staged publication."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from urbanframe.operators.staging import new_path, written

#: Formats of progress lines.
STEP = r"^\[(\d+)/(\d+)\]"
BUILD = r"^\[Houdini\s+(\d+)/(\d+)\]"
DONE = ("[OK] 全部通过", "Houdini build completed")
#: What an id may be made of, and what becomes a line in one.
SAFE_ID = re.compile(r"^[A-Za-z0-9][A-Za-z0-9_.-]*$")
NOT_IN_ID = re.compile(r"[^A-Za-z0-9_.-]+")


def line_effect(line: Column) -> Column:
    """What a line does to a percentage: struct<least, small>. It rises to least, if that isn't null; small adds 3, up to 74."""
    part = lambda p, k: F.regexp_extract(line, p, k).try_cast("int")
    share = lambda p, whole: F.floor(F.try_divide(part(p, 1), part(p, 2)) * whole).cast("int")
    step = F.when(part(STEP, 1) >= part(STEP, 2), 75).otherwise(F.least(F.lit(74), share(STEP, 75)))
    done = F.lit(False)
    for text in DONE:
        done = done | F.contains(line, F.lit(text))
    least = F.when(part(STEP, 1).isNotNull(), step).when(part(BUILD, 1).isNotNull(), F.least(F.lit(99), share(BUILD, 23) + 75)).when(done, 99)
    return F.struct(least.alias("least"), (least.isNull() & F.coalesce(F.contains(line, F.lit("[OK]")), F.lit(False))).alias("small"))


def line_progress(line: Column, now: Column) -> Column:
    """The percentage after a line: steps lead to 75, build stages to 98, the end to 99, and an [OK] adds 3 before 75."""
    effect = line_effect(line)
    return F.when(effect["least"].isNotNull(), F.greatest(now, effect["least"])).when(effect["small"] & (now < 75), F.least(F.lit(74), now + 3)).otherwise(now)


def last_lines(log: DataFrame, most: int = 80) -> DataFrame:
    """The last lines of each run (run, seq, line), up to most; lines with a null seq come first of all.

    Tasks leave only that many lines of a run before they exchange them, so a long run fills no task.
    """
    back = Window.partitionBy("run").orderBy(F.desc_nulls_last("seq"), F.desc_nulls_last("line"))
    return log.withColumn("__back", F.row_number().over(back)).filter(F.col("__back") <= most).drop("__back")


def progress(log: DataFrame) -> DataFrame:
    """Adds pct to the lines (run, seq, line) of runs: the state after each line, in order; it never falls.

    Each line is a monotone map of percentages, and so are several in a row: with k small rises, pct below 75 becomes
    min(74, max(pct + 3 * k, m)), and pct at all becomes max(pct, h) if some line rises to h of 75 or more. k, m and h are
    running sums and maxima. They are taken within parts of the lines in order, so a long run spreads over many tasks;
    the state before each part follows from the maps of the parts before it, a row for each run and part.
    """
    rows = log.select("run", "seq", "line", line_effect(F.col("line")).alias("e")).select("run", "seq", "line", F.col("e.small").cast("int").alias("small"), F.col("e.least").alias("least"))
    rows = rows.repartitionByRange("run", "seq").sortWithinPartitions("run", "seq").withColumn("at", F.monotonically_increasing_id())
    rows = written(rows, "log-lines").withColumn("part", F.shiftright("at", 33))
    low = lambda k: F.when(F.col("least") < 75, F.col("least")) - 3 * F.col(k)
    high = F.when(F.col("least") >= 75, F.col("least"))
    upto = Window.partitionBy("run", "part").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("k", F.sum("small").over(upto))
    rows = rows.withColumns({"m": F.coalesce(F.max(low("k")).over(upto), F.lit(-300)) + 3 * F.col("k"), "h": F.max(high).over(upto)})
    last = F.max_by(F.struct("k", "m", "h"), "at").alias("map")
    parts = rows.groupBy("run", "part").agg(last).select("run", "part", "map.*")
    before = Window.partitionBy("run").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("sum", F.sum("k").over(Window.partitionBy("run").orderBy("part").rowsBetween(Window.unboundedPreceding, 0)))
    sums, tops = F.coalesce(F.sum("k").over(before), F.lit(0)), F.max("h").over(before)
    small = F.least(F.lit(74), F.greatest(3 * sums, F.coalesce(F.max(F.col("m") - 3 * F.col("sum")).over(before), F.lit(-300)) + 3 * sums))
    parts = parts.select(F.col("run").alias("of"), F.col("part").alias("in"), F.coalesce(tops, small).alias("start"))
    joined = rows.join(parts, F.col("run").eqNullSafe(F.col("of")) & (F.col("part") == F.col("in")))
    start = F.col("start")
    pct = F.when(F.col("h").isNotNull(), F.greatest(start, "h")).when(start >= 75, start).otherwise(F.least(F.lit(74), F.greatest(start + 3 * F.col("k"), F.col("m"))))
    return joined.select("run", "seq", "line", pct.cast("int").alias("pct"))


def run_states(events: DataFrame) -> DataFrame:
    """(run_id, status, n_events) from events (run_id, time, status, seq): the status of the last by time, then seq."""
    return events.groupBy("run_id").agg(F.max_by("status", F.struct("time", "seq")).alias("status"), F.count("*").alias("n_events"))


def run_id(area: str, now: datetime) -> str:
    """A readable id of a run: time and slug."""
    return f"{now:%Y%m%d_%H%M%S}_{NOT_IN_ID.sub('_', area).strip('_') or 'area'}"


def checked_id(value: str) -> str:
    """The id, if it can be part of a path."""
    if not SAFE_ID.match(value) or ".." in value:
        raise ValueError(f"{value!r} isn't a safe id")
    return value


def fingerprint(obj: object) -> str:
    """SHA-256 of a value as JSON with sorted keys; numbers of a box are normalised before by ``normal_box``."""
    return hashlib.sha256(json.dumps(obj, sort_keys=True, separators=(",", ":"), ensure_ascii=False).encode()).hexdigest()


def normal_box(box: list[float]) -> list[float]:
    west, south, east, north = (round(float(v), 7) for v in box)
    if not (west < east and south < north):
        raise ValueError(f"{box} isn't west, south, east, north")
    return [west, south, east, north]


def file_fingerprints(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, sha256) of the files under a path."""
    return spark.read.format("binaryFile").load(path).select("path", "length", F.sha2("content", 256).alias("sha256"))


def publish(df: DataFrame, target: str, ready: Callable[[DataFrame], bool]) -> bool:
    """Writes df beside target, and swaps it in only if the written table is ready; else target stays as it was."""
    spark = df.sparkSession
    staged = new_path(spark, "staged")
    df.write.parquet(staged)
    return ready(spark.read.parquet(staged)) and swapped(spark, staged, target)


def swapped(spark: SparkSession, staged: str, target: str) -> bool:
    """Puts staged in the place of target by renames; a target that can't be replaced is put back."""
    old = f"{target}.previous"
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(target).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.delete(path(old), True)
    had = fs.exists(path(target))
    if had and not fs.rename(path(target), path(old)):
        return False
    if not fs.rename(path(staged), path(target)):
        if had:
            fs.rename(path(old), path(target))
        return False
    fs.delete(path(old), True)
    return True
