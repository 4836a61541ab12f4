"""GeoJSON buildings: whole collections, or a feature on each line, which is the form that can be split."""

from __future__ import annotations

import io
import json
import zipfile
import zlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from urbanframe.operators.snapshots import publish_changed

FEATURE = "struct<geometry:struct<type:string,coordinates:string>,properties:map<string,string>>"
RINGS = "array<array<array<double>>>"
#: Features that a task sends on at once.
FEATURES_AT_ONCE = 1000


def _flat(features: DataFrame, *kept: str) -> DataFrame:
    """(fid, geom_type, polys, props): a polygon is one part; other types have none."""
    kind, text = F.col("f.geometry.type"), F.col("f.geometry.coordinates")
    polys = F.when(kind == "Polygon", F.array(F.from_json(text, RINGS))).when(kind == "MultiPolygon", F.from_json(text, f"array<{RINGS}>"))
    point = lambda p: F.struct(F.element_at(p, 1).alias("lon"), F.element_at(p, 2).alias("lat"))
    return features.select(*kept, "fid", kind.alias("geom_type"), F.transform(polys, lambda poly: F.transform(poly, lambda ring: F.transform(ring, point))).alias("polys"), F.col("f.properties").alias("props"))


def read_collection(spark: SparkSession, path: str) -> DataFrame:
    """Features of a collection in file order; one record of one task, so large ones belong in lines."""
    raw = spark.read.option("multiLine", True).schema(f"features array<{FEATURE}>").json(path)
    return _flat(raw.select(F.posexplode("features").alias("fid", "f")))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Features of line-delimited GeoJSON; lines that aren't features have null geometry."""
    raw = spark.read.text(path).select(F.monotonically_increasing_id().alias("fid"), F.from_json("value", FEATURE).alias("f"))
    return _flat(raw)


def _members(content: bytes) -> list[dict]:
    """The features of a collection, or of the first collection in an archive."""
    if zipfile.is_zipfile(io.BytesIO(content)):
        with zipfile.ZipFile(io.BytesIO(content)) as z:
            names = [n for n in z.namelist() if n.endswith((".geojson", ".json"))]
            if not names:
                raise ValueError("no collection in the archive")
            content = z.read(names[0])
    found = json.loads(content)
    features = found.get("features") if isinstance(found, dict) else None
    if not isinstance(features, list):
        raise ValueError("no list of features")
    return features


def split_collections(files: DataFrame) -> DataFrame:
    """(path, fid, geom_type, polys, props, error) of collections (path, content), plain or zipped, in file order.

    Each task opens its own files and sends on one feature at a time; one file must fit a task, as it is one record. A file
    that can't be read gives one row with its error, one without features gives a row with neither. Null content is an error.
    """

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                try:
                    features, error = _members(bytes(content if content is not None else b"")), None
                except (ValueError, zlib.error, zipfile.BadZipFile, NotImplementedError, RuntimeError, EOFError) as e:
                    features, error = [], f"{type(e).__name__}: {e}"
                if not features:
                    yield pd.DataFrame({"path": [path], "fid": [None], "value": [None], "error": [error]})
                for start in range(0, len(features), FEATURES_AT_ONCE):
                    part = features[start : start + FEATURES_AT_ONCE]
                    yield pd.DataFrame({"path": path, "fid": range(start, start + len(part)), "value": [json.dumps(f) for f in part], "error": None})

    rows = files.select("path", "content").mapInPandas(split, "path string, fid long, value string, error string")
    flat = _flat(rows.withColumn("f", F.from_json("value", FEATURE)), "path", "error")
    return flat.select("path", "fid", "geom_type", "polys", "props", "error")


def read_collections(spark: SparkSession, path: str) -> DataFrame:
    """The features of all collections under a path, plain or zipped; see split_collections.

    Spark's scan passes over files of no length, as broken downloads leave them; they are found by name and give their error.
    """
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    files = [f for s in fs.globStatus(folder) or [] for f in (fs.listStatus(s.getPath()) if s.isDirectory() else [s])]
    empty = [(f.getPath().toString(), b"") for f in files if f.isFile() and not f.getLen() and f.getPath().getName()[0] not in "._"]
    scanned = spark.read.format("binaryFile").load(path).select("path", "content")
    return split_collections(scanned.unionByName(spark.createDataFrame(empty, "path string, content binary")) if empty else scanned)


def coverage(features: DataFrame, field: str = "height") -> DataFrame:
    """(path, n, with_field, share, with_geometry, status) of each file of split collections; share in whole percent.

    A file fails if it can't be read or if no feature has a geometry. An empty text counts as no value.
    """
    value = F.coalesce(F.col("props")[field], F.lit("")) != ""
    sums = features.groupBy("path").agg(
        F.count("fid").alias("n"), F.count_if(F.col("fid").isNotNull() & value).alias("with_field"), F.count("geom_type").alias("with_geometry"), F.count("error").alias("errors")
    )
    share = F.when(F.col("n") > 0, F.floor(100 * F.col("with_field") / F.col("n")))
    status = F.when((F.col("errors") > 0) | (F.col("with_geometry") == 0), "fail").otherwise("pass")
    return sums.select("path", "n", "with_field", share.alias("share"), "with_geometry", status.alias("status"))


def write_lines(features: DataFrame, path: str) -> None:
    """(geom_type, polys, props) as a feature on each line."""
    as_lines(features).write.text(path)


def publish_lines(features: DataFrame, path: str, ready: Callable[[DataFrame], bool] = lambda _: True) -> str:
    """write_lines beside path, swapped in only if the lines differ from those at path; see snapshots.publish_changed."""
    return publish_changed(as_lines(features), path, ready, "text")


def as_lines(features: DataFrame) -> DataFrame:
    """(value): a feature on each line."""
    pair = lambda p: F.array(p["lon"], p["lat"])
    nested = F.transform("polys", lambda poly: F.transform(poly, lambda ring: F.transform(ring, pair)))
    one, many = F.to_json(F.element_at(nested, 1)), F.to_json(nested)
    geometry = F.when(F.col("geom_type") == "Polygon", F.concat(F.lit('{"type":"Polygon","coordinates":'), one, F.lit("}"))).when(F.col("geom_type") == "MultiPolygon", F.concat(F.lit('{"type":"MultiPolygon","coordinates":'), many, F.lit("}"))).otherwise(F.lit("null"))
    props = F.coalesce(F.to_json("props"), F.lit("{}"))
    return features.select(F.concat(F.lit('{"type":"Feature","geometry":'), geometry, F.lit(',"properties":'), props, F.lit("}")).alias("value"))
