"""OSM XML: nodes and ways as tables, and back. Also the JSON that a map query service answers with."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from urbanframe.functions.parsing import level_height
from urbanframe.operators.quality import checks

#: Numbers are read as texts: the XML source ends the job at a number that it can't parse, whatever its mode is.
NODE = "_id string, _lat string, _lon string"
WAY = "_id string, nd array<struct<_ref:string>>, tag array<struct<_k:string,_v:string>>"
ELEMENTS = "elements array<struct<type:string,id:long,lat:double,lon:double,nodes:array<long>,tags:map<string,string>>>"


def _no_number(name: str) -> Column:
    """Whether a text isn't null and no number either."""
    return F.col(name).isNotNull() & F.col(name).try_cast("double").isNull()


def parse_checks(spark: SparkSession, path: str) -> DataFrame:
    """(check, status, message) of OSM XML files: elements that read_nodes and read_ways leave out, and files cut short.

    A malformed node or way fails its check, as does a file without the end of its root; a file has an empty root or none at
    all where nothing was exported, and no element at all only warns.
    """

    def elements(tag: str, schema: str, numbers: tuple[str, ...] = ()) -> tuple[DataFrame, tuple]:
        raw = spark.read.format("xml").option("rowTag", tag).option("columnNameOfCorruptRecord", "bad").schema(f"{schema}, bad string").load(path)
        wrong = F.col("bad").isNotNull() | F.col("_id").isNull()
        for c in numbers:
            wrong = wrong | _no_number(c)
        # all columns are named, else only some would be parsed
        one = raw.select(wrong.alias("wrong"), F.xxhash64(*raw.columns).alias("all")).agg(F.count_if("wrong").alias("bad"), F.count(F.col("all") + 1).alias("n"))
        status = F.when(F.col("bad") > 0, "fail").when(F.col("n") == 0, "warn").otherwise("pass")
        return one, (f"osm_{tag}s", status, F.concat(F.col("bad").cast("string"), F.lit(" malformed of "), F.col("n").cast("string")))

    lines = spark.read.text(path).select(F.input_file_name().alias("file"), F.col("value").rlike(r"</osm\s*>|<osm\b[^>]*/>").alias("end"))
    files = lines.groupBy("file").agg(F.max("end").alias("end")).agg(F.count("*").alias("n"), F.count_if(~F.col("end")).alias("cut"))
    whole = ("osm_whole", F.when((F.col("cut") > 0) | (F.col("n") == 0), "fail").otherwise("pass"), F.concat(F.col("cut").cast("string"), F.lit(" cut short of "), F.col("n").cast("string")))
    found = [elements("node", NODE, ("_lat", "_lon")), elements("way", WAY), (files, whole)]
    return reduce(DataFrame.unionByName, (checks(one, [rule]) for one, rule in found))


def read_nodes(spark: SparkSession, path: str) -> DataFrame:
    """(id, lon, lat) of all nodes; malformed elements are left out (parse_checks counts them)."""
    raw = spark.read.format("xml").option("rowTag", "node").option("mode", "DROPMALFORMED").schema(NODE).load(path)
    good = raw.filter(~_no_number("_lon") & ~_no_number("_lat"))
    return good.select(F.col("_id").alias("id"), F.col("_lon").try_cast("double").alias("lon"), F.col("_lat").try_cast("double").alias("lat"))


def read_ways(spark: SparkSession, path: str) -> DataFrame:
    """(way_id, refs, tags) of all ways; of equal tag keys the last one counts."""
    raw = spark.read.format("xml").option("rowTag", "way").option("mode", "DROPMALFORMED").schema(WAY).load(path)
    tags = F.filter(F.coalesce("tag", F.array().cast("array<struct<_k:string,_v:string>>")), lambda t: t["_k"].isNotNull())
    # last one wins whatever the session's policy on equal keys is
    unique = F.filter(tags, lambda t, i: ~F.exists(F.slice(tags, i + 2, F.greatest(F.size(tags) - i - 1, F.lit(0))), lambda u: u["_k"] == t["_k"]))
    entries = F.transform(unique, lambda t: F.struct(t["_k"], t["_v"]))
    refs = F.filter(F.transform("nd", lambda n: n["_ref"]), lambda r: r.isNotNull())
    return raw.select(F.col("_id").alias("way_id"), F.coalesce(refs, F.array().cast("array<string>")).alias("refs"), F.map_from_entries(entries).alias("tags"))


def write_ways(ways: DataFrame, path: str) -> None:
    """Way elements as XML, references before tags."""
    nd = F.transform("refs", lambda r: F.struct(r.alias("_ref")))
    tag = F.transform(F.map_entries("tags"), lambda e: F.struct(e["key"].alias("_k"), e["value"].alias("_v")))
    ways.select(F.col("way_id").alias("_id"), nd.alias("nd"), tag.alias("tag")).write.format("xml").option("rootTag", "osm").option("rowTag", "way").save(path)


def write_nodes(nodes: DataFrame, path: str) -> None:
    nodes.select(F.col("id").alias("_id"), F.col("lat").alias("_lat"), F.col("lon").alias("_lon")).write.format("xml").option("rootTag", "osm").option("rowTag", "node").save(path)


def read_building_heights(spark: SparkSession, path: str) -> DataFrame:
    """(id, lon, lat, height) of a map query's answer: ways of 3 known nodes or more with a height of 2.5 m or more."""
    each = spark.read.schema(ELEMENTS).option("multiLine", True).json(path).select(F.explode("elements").alias("e")).select("e.*")
    nodes = each.filter("type = 'node'").select(F.col("id").alias("node"), "lon", "lat")
    ways = each.filter("type = 'way'").select("id", "nodes", level_height(F.col("tags.height"), F.col("tags").getItem("building:levels")).alias("height")).filter("height IS NOT NULL")
    known = ways.select("id", "height", F.explode("nodes").alias("node")).join(nodes, "node")
    return known.groupBy("id").agg(F.avg("lon").alias("lon"), F.avg("lat").alias("lat"), F.first("height").alias("height"), F.count("*").alias("n")).filter("n >= 3").drop("n")
