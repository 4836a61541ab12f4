"""Building footprints from Parquet with geometry as well-known binary, read for a box."""

from __future__ import annotations

import struct

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from urbanframe.functions.parsing import building_class, real_height

POINT = "struct<lon:double,lat:double>"
POLYS = f"array<array<array<{POINT}>>>"
#: Types of well-known binary.
POLYGON, MULTI_POLYGON = 3, 6


def _polygon(data: bytes, at: int) -> tuple[list, int]:
    """The rings of a polygon that begins at a place, and where it ends."""
    order = "<" if data[at] else ">"
    kind, n = struct.unpack_from(f"{order}II", data, at + 1)
    if kind != POLYGON:
        raise ValueError(f"type {kind} isn't a polygon")
    at, rings = at + 9, []
    for _ in range(n):
        (size,) = struct.unpack_from(f"{order}I", data, at)
        points = np.frombuffer(data, f"{order}f8", 2 * size, at + 4).reshape(-1, 2).tolist()
        rings.append([{"lon": x, "lat": y} for x, y in points])
        at += 4 + 16 * size
    return rings, at


def parts_of(data: bytes | None) -> list | None:
    """The polygons of well-known binary, each a list of rings; null for none, other types and damaged data."""
    try:
        order = "<" if data[0] else ">"
        kind, n = struct.unpack_from(f"{order}II", data, 1)
        if kind == POLYGON:
            return [_polygon(data, 0)[0]]
        if kind != MULTI_POLYGON:
            return None
        out, at = [], 9
        for _ in range(n):
            rings, at = _polygon(data, at)
            out.append(rings)
        return out
    except (TypeError, IndexError, ValueError, struct.error):
        return None


def to_binary(parts: list | None) -> bytes | None:
    """Little-endian well-known binary of polygons: one polygon, or several as a multi-polygon."""
    if parts is None or not len(parts):
        return None
    head = struct.pack("<BI", 1, POLYGON)
    one = [head + struct.pack("<I", len(rings)) + b"".join(struct.pack("<I", len(r)) + np.array([(p["lon"], p["lat"]) for p in r], "<f8").tobytes() for r in rings) for rings in parts]
    return one[0] if len(one) == 1 else struct.pack("<BII", 1, MULTI_POLYGON, len(one)) + b"".join(one)


def decoded(geometry: Column) -> Column:
    """Polygons of a column of well-known binary, in Arrow batches."""

    @F.pandas_udf(POLYS)
    def decode(values: pd.Series) -> pd.Series:
        return values.map(parts_of, na_action="ignore")

    return decode(geometry)


def encoded(polys: Column) -> Column:
    @F.pandas_udf("binary")
    def encode(values: pd.Series) -> pd.Series:
        return values.map(to_binary, na_action="ignore")

    return encode(polys)


def footprints(rows: DataFrame) -> DataFrame:
    """Adds polys, raw_height, real and class to rows (geometry, height, num_floors, subtype, class); those without polygons go.

    raw_height is that of the row, else of its floors, else 0; real tells whether it is one of the first two.
    """
    height, floors = F.col("height"), F.col("num_floors")
    real = F.coalesce(height > 0, F.lit(False)) | F.coalesce(floors > 0, F.lit(False))
    out = rows.withColumn("polys", decoded(F.col("geometry"))).filter("polys IS NOT NULL")
    return out.withColumns({"raw_height": real_height(height, floors.cast("double")), "real": real, "class": building_class(F.col("subtype"), F.col("class"))}).drop("geometry")


def read_buildings(spark: SparkSession, path: str, box: tuple[float, float, float, float]) -> DataFrame:
    """Footprints of Parquet files (geometry, bbox struct<xmin,xmax,ymin,ymax>, height, num_floors, subtype, class).

    Only those whose bbox touches the box (west, south, east, north) are decoded; the test reaches the files' statistics.
    """
    west, south, east, north = box
    touch = (F.col("bbox.xmin") <= east) & (F.col("bbox.xmax") >= west) & (F.col("bbox.ymin") <= north) & (F.col("bbox.ymax") >= south)
    return footprints(spark.read.parquet(path).filter(touch))
