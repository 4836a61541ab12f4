"""Intermediate tables in the folder that all executors share, so that iterative operators cut their lineage safely."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Only for a local master whose session names no folder, as in tests.
FALLBACK = "file:///tmp/checkpoints/urbanframe"


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found and not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return (found or FALLBACK).rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, deleted when the application ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path


def written(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """df as a table in the shared folder: lineage is cut, later readers prune columns, and lost executors lose nothing."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(df: DataFrame) -> None:
    """Deletes the files of a written() table that nothing reads any more."""
    for folder in {x.rsplit("/", 1)[0] for x in df.inputFiles()}:
        remove_path(df.sparkSession, folder)


def remove_path(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
