"""Map layers derived from the driver's tables, by one SQL text for both engines.

``layer`` gives the Spark table, ``cte`` the same text as common table expressions for DuckDB.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F

from urbanframe.functions.projection import Projector
from urbanframe.plans.sqltext import Sql, Text

ORIGIN = Projector(100.87, 12.92)

LAYERS = {
    "bld": """
SELECT p_partkey AS fid, 100.84e0 + (p_partkey % 80) * 1e-4 AS lon, 12.89e0 + p_size * 8e-5 + (p_partkey % 3) * 1e-5 AS lat,
       CAST(p_size % 12 AS DOUBLE) AS side,
       CASE WHEN p_partkey % 7 = 0 THEN NULL WHEN p_partkey % 11 = 0 THEN -1e0 WHEN p_partkey % 13 = 0 THEN 700e0 ELSE CAST(p_size AS DOUBLE) END AS raw_height,
       CASE WHEN p_partkey % 29 = 0 THEN NULL WHEN p_partkey % 31 = 0 THEN 'Point' WHEN p_partkey % 5 = 0 THEN 'MultiPolygon' ELSE 'Polygon' END AS geom_type,
       CASE p_partkey % 6 WHEN 0 THEN 'residential' WHEN 1 THEN 'retail' WHEN 2 THEN 'shed' WHEN 3 THEN 'industrial' WHEN 4 THEN '' END AS subtype, lower(p_type) AS kind
FROM {part}""",
    # nodes of roads; every 97th is missing
    "nodes": """
SELECT CAST(p_partkey AS STRING) AS id, 100.84e0 + (p_partkey % 80) * 1e-4 AS lon, 12.89e0 + p_size * 8e-5 + (p_partkey % 3) * 1e-5 AS lat
FROM {part} WHERE p_partkey % 97 <> 0""",
    "way_nodes": """
SELECT CAST(l_orderkey AS STRING) AS way_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity) AS seq,
       CAST(l_partkey AS STRING) AS ref
FROM {lineitem}""",
    "way_tags": """
SELECT CAST(o_orderkey AS STRING) AS way_id, o_orderkey AS num,
       CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'primary' WHEN '2' THEN 'residential' WHEN '3' THEN 'footway' WHEN '4' THEN 'steps' END AS highway,
       CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_orderkey % 7 AS STRING) WHEN o_orderkey % 3 = 1 THEN '' END AS lanes,
       CASE WHEN o_orderkey % 4 = 0 THEN concat(CAST(o_orderkey % 9 AS STRING), '.5 m') WHEN o_orderkey % 4 = 1 THEN 'wide' WHEN o_orderkey % 4 = 2 THEN '0' END AS width,
       CASE WHEN o_orderkey % 5 = 0 THEN 'yes' WHEN o_orderkey % 5 = 1 THEN '' END AS oneway
FROM {orders}""",
    # a 50 wide grid with holes; every 9th cell is under a building
    "dem": """
SELECT CAST(floor(p_partkey / 50) AS BIGINT) AS row, p_partkey % 50 AS col, p_retailprice - 900 AS elev, p_partkey % 9 = 0 AS masked
FROM {part} WHERE p_partkey % 41 <> 0""",
    "points": """
SELECT event_id AS id, CAST(event_id * 7919 % 49000 AS DOUBLE) / 1000 AS x, CAST(event_id * 104729 % 39000 AS DOUBLE) / 1000 AS z, value, event_type AS kind
FROM {events}""",
    "segments": """
SELECT c_custkey AS id, c_nationkey AS road, CAST(c_custkey * 7919 % 1000 AS DOUBLE) AS ax, CAST(c_custkey * 104729 % 1000 AS DOUBLE) AS ay,
       CAST(c_custkey * 7919 % 1000 + c_custkey % 41 - 20 AS DOUBLE) AS bx, CAST(c_custkey * 104729 % 1000 + c_custkey % 37 - 18 AS DOUBLE) AS by
FROM {customer}""",
    "clips": """
SELECT s_suppkey AS id, 100.80e0 + s_suppkey % 10 * 5e-3 AS west, 12.86e0 + s_suppkey % 7 * 4e-3 AS south,
       100.88e0 + s_suppkey % 11 * 6e-3 AS east, 12.90e0 + s_suppkey % 13 * 5e-3 AS north
FROM {supplier}""",
    "log": """
SELECT conv_id AS run, turn AS seq, CASE WHEN role = 'user' THEN concat('[', CAST(turn % 6 + 1 AS STRING), '/6] step')
       WHEN turn % 4 = 1 THEN 'stage [OK] done' ELSE concat('[Houdini ', CAST(turn % 7 + 1 AS STRING), '/7] build') END AS line
FROM {conversations}""",
    "reports": """
SELECT event_id AS report_id, user_id % 40 AS area, ts, CASE WHEN value < 5 THEN 'fail' WHEN value < 30 THEN 'warn' ELSE 'pass' END AS status, event_type AS check_name, value
FROM {events}""",
}

_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def layer(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    used = [t for t in _TABLES if "{" + t + "}" in LAYERS[name]]
    return spark.sql(LAYERS[name], **{t: table(spark, sf_dir, t) for t in used})


def spread(df: DataFrame, key: str) -> DataFrame:
    """Rows by key in as many partitions as shuffles have: a small file is few tasks, however much becomes of its rows."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def cte(*names: str) -> str:
    """WITH name AS (...), ... for DuckDB."""
    return "WITH " + ",\n".join(f"{n} AS ({re.sub(r'{(\w+)}', r'\1', LAYERS[n])})" for n in names)


def ways(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ways with ordered refs and tags; orders without lines have no refs."""
    refs = layer(spark, sf_dir, "way_nodes").groupBy("way_id").agg(F.sort_array(F.collect_list(F.struct("seq", "ref"))).alias("r")).select("way_id", F.col("r.ref").alias("refs"))
    return layer(spark, sf_dir, "way_tags").join(refs, "way_id", "left")


def planar(df: DataFrame) -> DataFrame:
    """Adds x and z: metres east and north of ORIGIN."""
    x, z = ORIGIN.local(F.col("lon"), F.col("lat"))
    return df.withColumns({"x": x, "z": z})


#: The same as SQL text, for oracles.
SQL_X, SQL_Z = (str(v) for v in ORIGIN.local(Text("lon"), Text("lat"), Sql))


def planar_sql(source: str) -> str:
    return f"(SELECT *, {SQL_X} AS x, {SQL_Z} AS z FROM {source})"
