"""The geometry and projection functions under names for SQL text: temporary functions of a session, without Python.

Their bodies are SQL, so the optimizer puts them into a query like any other expression. Rings are open arrays of
struct<x,y>, as in ``functions.geometry``.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from urbanframe.functions import projection as PR
from urbanframe.plans.sqltext import Sql, Text

RING = "ring ARRAY<STRUCT<x: DOUBLE, y: DOUBLE>>"
_EDGES = "transform(r, (p, i) -> struct(p, r[CAST((i + 1) % size(r) AS INT)] AS q))"
_FIRST = "r[0]"
#: Twice the signed area between the first point and an edge.
_CROSS = f"(e.p.x - {_FIRST}.x) * (e.q.y - {_FIRST}.y) - (e.q.x - {_FIRST}.x) * (e.p.y - {_FIRST}.y)"
_DET = "((bx - ax) * (dy - cy) - (by - ay) * (dx - cx))"
_SEGMENTS = ", ".join(f"{c} DOUBLE" for c in ("ax", "ay", "bx", "by", "cx", "cy", "dx", "dy"))
#: Zone 31 has its middle at 3 degrees; other zones are turned there and back.
_AS_31 = "lon - (zone * 6 - 183) + 3"


def _bound(value: str, name: str, body: str) -> str:
    """body with name for value, which is worked out once, however often name stands in body."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def definitions() -> dict[str, tuple[str, str, str]]:
    """(parameters, type, body) of each function."""
    east, north = (_bound(f"struct({_AS_31} AS x, lat AS y)", "g", str(v)) for v in PR.to_utm(Text("g.x"), Text("g.y"), 31, Sql))
    metric = "struct(easting AS x, northing - CASE WHEN northern THEN 0 ELSE 10000000 END AS y)"
    lon, lat = (_bound(metric, "g", str(v)) for v in PR.from_utm(Text("g.x"), Text("g.y"), 31, True, Sql))
    width, height = PR.box_size(*(Text(c) for c in ("west", "south", "east", "north")), Sql)
    degrees, metres, box = "lon DOUBLE, lat DOUBLE, zone INT", "easting DOUBLE, northing DOUBLE, zone INT, northern BOOLEAN", "west DOUBLE, south DOUBLE, east DOUBLE, north DOUBLE"
    doubled = f"aggregate(transform({_EDGES}, e -> {_CROSS}), 0D, (s, v) -> s + v)"
    crosses = "((e.p.y > y) <> (e.q.y > y)) AND x < (e.q.x - e.p.x) * (y - e.p.y) / (e.q.y - e.p.y + 1e-12D) + e.p.x"
    return {
        "ring_signed_area": (RING, "DOUBLE", _bound("ring", "r", f"CASE WHEN size(r) >= 3 THEN {doubled} / 2 ELSE 0D END")),
        "ring_contains": (f"{RING}, x DOUBLE, y DOUBLE", "BOOLEAN", _bound("ring", "r", f"size(filter({_EDGES}, e -> {crosses})) % 2 = 1")),
        "crossing_first": (_SEGMENTS, "DOUBLE", f"((cx - ax) * (dy - cy) - (cy - ay) * (dx - cx)) / CASE WHEN abs({_DET}) > 1e-12D THEN {_DET} END"),
        "crossing_second": (_SEGMENTS, "DOUBLE", f"((cx - ax) * (by - ay) - (cy - ay) * (bx - ax)) / CASE WHEN abs({_DET}) > 1e-12D THEN {_DET} END"),
        "utm_zone": ("lon DOUBLE", "INT", "CAST((lon + 180) / 6 AS INT) + 1"),
        "utm_easting": (degrees, "DOUBLE", str(east)),
        "utm_northing": (degrees, "DOUBLE", str(north)),
        "utm_lon": (metres, "DOUBLE", f"{lon} + (zone * 6 - 183) - 3"),
        "utm_lat": (metres, "DOUBLE", str(lat)),
        "box_width_m": (box, "DOUBLE", str(width)),
        "box_height_m": (box, "DOUBLE", str(height)),
    }


def register(spark: SparkSession) -> list[str]:
    """Defines the functions in the session, in place of earlier ones of their names; gives the names."""
    found = definitions()
    for name, (parameters, kind, body) in found.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {kind} RETURN {body}")
    return list(found)
