"""Tables that are replaced only when their content changes, and raw snapshots that refinement never touches.

A table's digest lies in a hidden file among its data, so that both are swapped in by one rename.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import MapType

from urbanframe.operators.runs import swapped
from urbanframe.operators.staging import new_path, remove_path

#: Readers pass over files whose names begin like this.
DIGEST_FILE = "_digest.json"
#: Wide enough for the sum of 1e19 hashes of 64 bits.
HASH_SUM = "decimal(28,0)"


@dataclass(frozen=True)
class Digest:
    """What a table holds, whatever the order of its rows and files: schema, count and sums of two hashes of every row."""

    schema: str
    rows: int
    first: str
    second: str


def _plain(df: DataFrame) -> Column:
    """A row as JSON; maps as entries in order, so that equal maps are equal texts."""
    entries = lambda f: F.array_sort(F.map_entries(f.name)).alias(f.name) if isinstance(f.dataType, MapType) else F.col(f"`{f.name}`")
    return F.to_json(F.struct(*map(entries, df.schema.fields)), {"ignoreNullFields": "false"})


def content_digest(df: DataFrame) -> Digest:
    """The digest in one pass, combined by each task before anything moves. Repeated rows count, empty tables have sums of 0.

    Maps inside other columns are compared in the order of their entries. Column names take part, their order does as well.
    """
    row = df.select(_plain(df).alias("row")) if df.columns else df.select(F.lit("{}").alias("row"))
    total = lambda h: F.coalesce(F.sum(h.cast(HASH_SUM)), F.lit(0)).cast("string")
    one = row.agg(F.count("*").alias("rows"), total(F.xxhash64("row")).alias("first"), total(F.xxhash64(F.lit(1), "row")).alias("second")).first()
    return Digest(df.schema.simpleString(), one["rows"], one["first"], one["second"])


def _file(spark: SparkSession, target: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{target}/{DIGEST_FILE}")
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def stored_digest(spark: SparkSession, target: str) -> Digest | None:
    """The digest that lies with a table; None without a table, or where the file is damaged."""
    path, fs = _file(spark, target)
    if not fs.exists(path):
        return None
    stream = fs.open(path)
    try:
        return Digest(**json.loads(bytes(stream.readAllBytes())))
    except (ValueError, TypeError):
        return None
    finally:
        stream.close()


def _store(spark: SparkSession, target: str, digest: Digest) -> None:
    path, fs = _file(spark, target)
    stream = fs.create(path, True)
    try:
        stream.write(bytearray(json.dumps(asdict(digest)).encode()))
    finally:
        stream.close()


def publish_changed(df: DataFrame, target: str, ready: Callable[[DataFrame], bool] = lambda _: True, format: str = "parquet") -> str:
    """Writes df beside target and swaps it in if it is ready and differs from what target holds.

    Gives 'unchanged', 'rejected' or 'published', 'failed' if the swap was refused; in all cases but 'published' target stays
    as it was, to its files' times. df is worked out once. A format of one text column is 'text'. A table whose digest
    is missing or damaged counts as changed. A write that raises leaves target alone.
    """
    spark = df.sparkSession
    staged = new_path(spark, "staged")
    df.write.format(format).save(staged)
    written = spark.read.format(format).schema(df.schema).load(staged)
    digest = content_digest(written)
    outcome = "unchanged" if digest == stored_digest(spark, target) else "published" if ready(written) else "rejected"
    if outcome == "published":
        _store(spark, staged, digest)
        outcome = "published" if swapped(spark, staged, target) else "failed"
    if outcome != "published":
        remove_path(spark, staged)
    return outcome


def raw_snapshot(active: DataFrame, raw: str, refined_from: Digest | None = None) -> str:
    """Keeps the raw form of a source, from which refinement starts: 'initial', 'changed' or 'kept'.

    The snapshot at ``raw`` is taken once. It is taken anew only if the source at hand differs from the snapshot and from what
    the last refinement began with; without such a record the snapshot stays. So a source that refinement changed in place
    never becomes raw, and a new delivery does.
    """
    held = stored_digest(active.sparkSession, raw)
    if held is None:
        publish_changed(active, raw)
        return "initial"
    now = content_digest(active) if refined_from is not None else held
    if now in (held, refined_from):
        return "kept"
    publish_changed(active, raw)
    return "changed"
