"""Exact dedup by content sort, with DataFrame operations only.

Sampled splitters range-partition the rows by the beginnings of their normalised texts. Only the text itself is
exchanged; it is normalised again afterwards. The sort inside each range by all bytes places equal texts side by side,
and neighbouring texts are compared in full. A text that many rows share would fill a range; such heavy texts are found
first by counting content hashes over all rows. A text is heavy if it has more rows than a range should have, so there
are fewer heavy texts than ranges. They skip the range exchange: every task sorts and collapses its own equal rows, so
that one row for each task and text is exchanged, and the few results go back to the rows by a broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from urbanframe.llm.common import clean_blanks, table, written

#: A text with more than this share of all rows (1 / HEAVY_PARTS) is heavy, or a smaller share if there are more ranges.
HEAVY_PARTS = 256
#: Splitters are sampled from so many first characters and a hash, so that samples of long texts don't fill the driver.
HEAD = 64
ADDED = ("keep_id", "group_size", "kept", "first", "text_sha256")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", heavy_parts: int = HEAVY_PARTS) -> DataFrame:
    """Adds keep_id, group_size, kept, first and text_sha256 to every row.

    Texts are equal when identical without white space. The row with the most code points in its original text, then the
    smallest id (of any type that can be ordered), stays. Null counts as empty; empty texts are equal to each other. Rows
    with the same id and text are rows of their own in group_size, and all of them count as kept if their id is; first is
    true for exactly one row of each group, which is a kept one. A null id loses ties. Other columns pass through, whatever
    their names are; columns of docs that have the added names are replaced. An empty table gives an empty result.
    """
    names = [c for c in docs.columns if c not in ADDED or c in (id_col, text_col)]
    rest = [f"c{k}" for k in range(len(names))]  # the operator's own columns can't clash with these
    own, text = F.col(rest[names.index(id_col)]), F.col(rest[names.index(text_col)])
    norm = clean_blanks(text)
    # the least is the best: more code points, an id, a smaller id, then any one row
    rank = F.struct((-F.length(F.coalesce(text, F.lit("")))).alias("n"), own.isNull().alias("none"), own.alias("id"), F.col("row").alias("row"))
    rows = docs.select(*(F.col(f"`{c}`").alias(k) for c, k in zip(names, rest, strict=True)), F.monotonically_increasing_id().alias("row"))

    parts = max(heavy_parts, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    counts = rows.groupBy(F.xxhash64(norm).alias("hash")).agg(F.count("*").alias("n"))
    heavy = written(counts.filter(F.col("n") * parts > docs.count()).filter("n > 1").select("hash"), "heavy-texts")
    any_heavy = heavy.limit(1).count() > 0

    rows = rows.withColumn("hash", F.xxhash64(norm))
    # the order is that of the first characters; texts that share them are ordered by hash and then by all their bytes
    same = Window.partitionBy("head", "hash", "norm")
    light = rows.join(F.broadcast(heavy), "hash", "left_anti") if any_heavy else rows
    light = light.withColumn("head", F.substring(norm, 1, HEAD)).repartitionByRange("head", "hash").withColumns({"norm": norm, "rank": rank})
    light = light.withColumns({"best": F.min("rank").over(same), "group_size": F.count("*").over(same), "text_sha256": F.sha2("norm", 256)})
    out = _finished(light, rest, own)
    if any_heavy:
        # written once, so that a row keeps its number whatever the splits of the files are when it is read again; few
        # texts, each many times, take little space
        crowd = rows.join(F.broadcast(heavy), "hash", "left_semi").drop("hash").withColumn("text_sha256", F.sha2(norm, 256))
        crowd = written(crowd, "heavy-rows").withColumns({"norm": norm, "rank": rank})
        few = crowd.groupBy("norm").agg(F.min("rank").alias("best"), F.count("*").alias("group_size"))
        few = few.select(F.sha2("norm", 256).alias("text_sha256"), "best", "group_size")
        out = out.unionByName(_finished(crowd.join(F.broadcast(few), "text_sha256"), rest, own))
    return out.select(*(F.col(k).alias(c) for c, k in zip(names, rest, strict=True) if c not in ADDED), *ADDED)


def _finished(rows: DataFrame, rest: list[str], own: Column) -> DataFrame:
    kept = own.eqNullSafe(F.col("best.id"))
    return rows.select(*rest, F.col("best.id").alias("keep_id"), "group_size", kept.alias("kept"), (F.col("row") == F.col("best.row")).alias("first"), "text_sha256")


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return exact_groups(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


ORACLE = r"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS len, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id = first_value(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
FROM n WINDOW w AS (PARTITION BY norm ORDER BY len DESC, doc_id)
"""
