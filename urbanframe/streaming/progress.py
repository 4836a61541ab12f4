"""The progress of runs from a stream of log lines."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from urbanframe.operators.runs import BUILD, DONE, STEP

SCHEMA = "run long, seq long, pct int"


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """Lines run, seq and line of JSON files that arrive in a folder."""
    return spark.readStream.schema("run long, seq long, line string").json(path)


def stream_progress(lines: DataFrame) -> DataFrame:
    """(run, seq, pct) after each line of a stream; the state of a run is one number, and it never falls."""
    step, build = (F.regexp_extract("line", p, k).try_cast("int") for p, k in ((STEP, 1), (BUILD, 1)))
    steps, builds = (F.regexp_extract("line", p, 2).try_cast("int") for p in (STEP, BUILD))
    level = F.when(step.isNotNull(), F.when(step >= steps, 75).otherwise(F.least(F.lit(74), F.floor(step / steps * 75).cast("int"))))
    level = level.when(build.isNotNull(), F.least(F.lit(99), F.floor(build / builds * 23).cast("int") + 75))
    for text in DONE:
        level = level.when(F.contains("line", F.lit(text)), 99)
    marked = lines.select("run", "seq", level.alias("level"), F.contains("line", F.lit("[OK]")).alias("ok"))

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now = state.get[0] if state.exists else 0
        rows = pd.concat(list(batches)).sort_values("seq")
        out = []
        for seq, level, ok in zip(rows["seq"], rows["level"], rows["ok"], strict=True):
            if not pd.isna(level):
                now = max(now, int(level))
            elif ok and now < 75:
                now = min(74, now + 3)
            out.append((key[0], seq, now))
        state.update((now,))
        yield pd.DataFrame(out, columns=["run", "seq", "pct"])

    return marked.groupBy("run").applyInPandasWithState(run, SCHEMA, "pct int", "append", GroupStateTimeout.NoTimeout)


def windowed_counts(events: DataFrame, late: str = "10 minutes", width: str = "5 minutes") -> DataFrame:
    """Events and the sum of their values by kind and window, with late ones up to a limit."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select("window.start", "window.end", "event_type", "n", "total")
