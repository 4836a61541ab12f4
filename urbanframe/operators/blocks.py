"""Groups as arrays of a bounded length, from which pairs of rows come last: what is equal is worked out once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

#: So many rows of one group stand in an array.
BLOCK = 256
#: A group of more pairs than this, and than a quarter of a task's share of all pairs, is dealt over several tasks.
MOST_PAIRS = 16_000_000


def blocks(rows: DataFrame, by: list[str], id_col: str, others: Sequence[str] = ()) -> DataFrame:
    """(by, block, members): the rows of each group in arrays of about BLOCK, so that no row or task holds a large group."""
    sizes = rows.groupBy(*by).agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    numbered = rows.join(sizes.hint("merge"), by).withColumn("block", F.pmod(F.xxhash64(id_col), F.col("blocks")))
    return numbered.groupBy(*by, "block").agg(F.collect_list(F.struct(id_col, *others)).alias("members"))


def expanded(pairs: DataFrame, left: str, right: str) -> DataFrame:
    """Rows with arrays of members left and right once for each pair of theirs, as columns left and right; spread over all tasks first."""
    parts = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = pairs.repartition(parts)
    return unfolded(spread, left, right)


def unfolded(pairs: DataFrame, left: str, right: str) -> DataFrame:
    """The same as expanded, where the rows are."""
    rest = [c for c in pairs.columns if c not in (left, right)]
    return pairs.select(*rest, right, F.explode(left).alias(left)).select(*rest, left, F.explode(right).alias(right))


def met(left: DataFrame, right: DataFrame, by: list[str], left_key: list[str], right_key: list[str], work: DataFrame) -> DataFrame:
    """left and right joined by equal columns; work (by, pairs) tells how many pairs come of each group.

    Rows meet where they are joined: pairs are neither exchanged nor sorted. A heavy group is a square of parts: each of its
    left rows, told apart by left_key, lies in one line and in all columns, right ones the other way round. So a group is
    sent as often as the square root of four times the tasks, at most, whatever its size. Conditions of a filter on the result
    are tested in the join. What follows it is parted from it by a coalesce that moves no row: else all that comes of one row
    of the join is kept before the first is handed on, in one long method that is compiled late.
    """
    tasks = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = work.agg(F.sum("pairs")).first()[0] or 0
    share = max(float(MOST_PAIRS), total / (4 * tasks))
    # no more than four for each task
    heavy = F.broadcast(work.filter(F.col("pairs") > share).select(*by, F.ceil(F.sqrt(F.col("pairs") / share)).cast("int").alias("side")))

    def dealt(rows: DataFrame, key: list[str], own: str, other: str) -> DataFrame:
        rows = rows.join(heavy, by, "left").withColumn("side", F.coalesce("side", F.lit(1)))
        rows = rows.withColumn(own, F.pmod(F.xxhash64(*key), F.col("side")).cast("int")).withColumn(other, F.explode(F.sequence(F.lit(0), F.col("side") - 1)))
        return rows.drop("side").repartition(tasks, *by, "part_line", "part_column")

    lines, columns = dealt(left, left_key, "part_line", "part_column"), dealt(right, right_key, "part_column", "part_line")
    return lines.hint("merge").join(columns.hint("merge"), [*by, "part_line", "part_column"]).drop("part_line", "part_column").coalesce(tasks)
