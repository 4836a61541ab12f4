"""Shared pieces: the library's staging and global order, and text without white space."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from urbanframe.operators.order import prefix_sums
from urbanframe.operators.staging import new_path, remove, remove_path, shared_dir, written

__all__ = ["BLANK", "clean_blanks", "new_path", "prefix_sums", "remove", "remove_path", "shared_dir", "slices", "table", "written"]

#: ASCII white space of the query contracts: space and tab to carriage return.
BLANK = r"[\x20\x09-\x0D]"


def slices(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of fewer, so that a worker holds the Python form of a few texts at a time."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def clean_blanks(text: Column) -> Column:
    """Text without white space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANK + "+", "")
