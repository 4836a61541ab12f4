"""Levelled refinement of an area's layers, with checks, fingerprint and staged publication."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from urbanframe.functions import geometry as G
from urbanframe.operators import buildings as B, quality as Q, raster as R, roads, spatial
from urbanframe.operators.runs import fingerprint

#: The highest level of each layer, and the smallest raw files in bytes.
MOST_LEVEL = {"buildings": 3, "roads": 2, "dem": 2}
LEAST_BYTES = {"buildings": 10 * 1024, "roads": 5 * 1024, "dem": 4 * 1024}
#: Fixed value: bytes that a written layer has at least.
LEAST_OUTPUT = 1001
BARE_EARTH = "fabdem"
#: Cell size by which grid points meet rings.
COVER_CELL_M = 25.0


@dataclass
class Area:
    """The raw layers: buildings (fid, geom_type, outer, raw_height, x, y), ways (way_id, refs, tags), nodes (id, x, y), dem."""

    area_id: str
    buildings: DataFrame
    ways: DataFrame
    nodes: DataFrame
    dem: DataFrame
    heights: DataFrame | None = None
    dem_source: str = ""
    levels: dict[str, int] = field(default_factory=dict)


def refine_buildings(area: Area, level: int) -> DataFrame:
    """Level 1 cleans and drops near duplicates, level 2 adds nothing, level 3 takes heights of a near survey (id, x, y, height)."""
    out = area.buildings
    if level >= 1:
        out = B.clean_buildings(out).filter("reject_reason IS NULL").drop("reject_reason")
        out = out.join(spatial.dedup_within(out.select(F.col("fid").alias("id"), "x", "y"), B.DUPLICATE_M).withColumnRenamed("id", "fid"), "fid", "left_semi")
    if level >= 3 and area.heights is not None:
        near = spatial.nearest(out.select(F.col("fid").alias("id"), "x", "y"), area.heights, B.ENRICH_M).withColumnRenamed("left_id", "fid")
        found = near.join(area.heights.select(F.col("id").alias("right_id"), F.col("height").alias("survey")), "right_id").select("fid", "survey")
        take = (F.col("height_source") == "estimated_pending") & F.col("survey").isNotNull()
        out = out.join(found, "fid", "left")
        out = out.withColumns({"height": F.when(take, F.col("survey")).otherwise(F.col("height")), "height_source": F.when(take, "osm").otherwise(F.col("height_source"))}).drop("survey")
    return out


def refine_roads(area: Area, level: int) -> DataFrame:
    """Level 1 filters ways, level 2 welds their ends and merges chains."""
    out = area.ways
    if level >= 1:
        out = roads.way_reasons(out, area.nodes).filter("reject_reason IS NULL AND highway IS NOT NULL").drop("reject_reason")
    if level >= 2:
        missing = {t: F.lit(None).cast("string") for t in roads.MERGE_TAGS if t not in out.columns}
        out = roads.merge_chains(roads.weld(out, area.nodes).withColumns(missing))
    return out


def covered_cells(area: Area, size: float = 1.0) -> DataFrame:
    """(row, col) of the grid points inside the buildings' outer rings, for a grid of size metres from the scene's origin."""
    points = area.dem.select(F.struct("row", "col").alias("id"), (F.col("col") * size).alias("x"), (F.col("row") * size).alias("y"))
    rings = area.buildings.select("fid", F.posexplode("outer").alias("part", "closed")).select(F.struct("fid", "part").alias("ring_id"), G.unique_points(F.col("closed")).alias("ring"))
    rings = rings.filter(F.size("ring") >= 3).withColumn("b", G.bounds(F.col("ring"))).select("ring_id", "ring", "b.min_x", "b.min_y", "b.max_x", "b.max_y")
    return spatial.points_in_rings(points, rings, max(size, COVER_CELL_M)).select("id.row", "id.col").distinct()


def refine_dem(area: Area, level: int, footprints: DataFrame | None = None) -> DataFrame:
    """Level 2 fills the cells (row, col) under footprints from their neighbours, unless the source is bare earth already."""
    if level < 2 or area.dem_source == BARE_EARTH or footprints is None:
        return area.dem
    under = footprints.select("row", "col").distinct().withColumn("under", F.lit(True))
    marked = area.dem.join(under, ["row", "col"], "left").withColumn("under", F.coalesce("under", F.lit(False)))
    return R.idw_fill(marked, F.col("under")).drop("filled")


def refine(area: Area, level: int = 3) -> dict[str, DataFrame]:
    """The layers at a level, lazily; each stops at its own highest level. Level 2 fills the terrain under the buildings."""
    at = {k: min(level, v) for k, v in MOST_LEVEL.items()}
    return {"buildings": refine_buildings(area, at["buildings"]), "roads": refine_roads(area, at["roads"]), "dem": refine_dem(area, at["dem"], covered_cells(area))}


def _file_checks(spark: SparkSession, paths: dict[str, str], least: dict[str, int], exists: str = "{}_exists", size: str = "{}_size") -> DataFrame:
    """(check, status, message) for files or folders by name: each must exist and have its least size."""
    rows = []
    for name, bytes_ in least.items():
        path = spark._jvm.org.apache.hadoop.fs.Path(paths.get(name) or "missing")
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        if not paths.get(name) or not fs.exists(path):
            rows.append((exists.format(name), "fail", f"{path.getName()} isn't there"))
        elif (found := fs.getContentSummary(path).getLength()) < bytes_:
            rows.append((size.format(name), "fail", f"{path.getName()} has {found} bytes"))
        else:
            rows.append((exists.format(name), "pass", f"{found // 1024} KB"))
    return spark.createDataFrame(rows, "check string, status string, message string")


def input_checks(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """(check, status, message) for the raw files of the layers: each must exist and have its least size."""
    return _file_checks(spark, paths, LEAST_BYTES)


def written_checks(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """(check, status, message) for the written layers: each must exist and have more than a thousand bytes."""
    return _file_checks(spark, paths, dict.fromkeys(LEAST_BYTES, LEAST_OUTPUT), "output_{}", "output_{}")


def process_checks(before: DataFrame, after: DataFrame, dem_source: str | None = None, dem_level: int = 0) -> DataFrame:
    """(check, status, message) of a run: how many buildings it kept, and whether its terrain was corrected.

    The first is left out if there were none before or after, the second if the terrain wasn't refined to level 2.
    """
    one = before.agg(F.count("*").alias("n_in")).join(F.broadcast(after.agg(F.count("*").alias("n_out"))))
    ratio, status = Q.retention(F.col("n_in"), F.col("n_out"))
    share = F.concat(F.round(ratio * 100).cast("int").cast("string"), F.lit("% kept"))
    applied = F.lit(f"applied={dem_source != BARE_EARTH}")
    return Q.checks(one, [("bld_retention", status, share), ("dem_correction", F.lit("pass" if dem_level >= 2 else None).cast("string"), applied)])


def output_checks(layers: dict[str, DataFrame]) -> DataFrame:
    """Contract checks of refined layers with their roll-up left to ``quality.severity``."""
    sample = layers["buildings"].orderBy("fid").limit(10).agg(F.count("*").alias("n"), F.count_if(F.col("height") > 0).alias("good"))
    rule = ("sample_valid", F.when(F.col("n") == 0, "fail").when(F.col("good") < F.col("n"), "warn").otherwise("pass"), F.concat(F.col("good").cast("string"), F.lit(" of "), F.col("n").cast("string"), F.lit(" with a height")))
    net = roads.connectivity(layers["roads"].filter(F.size("refs") >= 2))
    fragments = ("road_connectivity", F.col("status"), F.concat(F.col("components").cast("string"), F.lit(" components, "), F.col("dangling").cast("string"), F.lit(" open ends")))
    return Q.building_checks(layers["buildings"]).unionByName(Q.checks(sample, [rule])).unionByName(Q.checks(net, [fragments]))


def recipe_key(sources: dict[str, str], params: dict[str, object], version: int = 1) -> str:
    """A key of what a result depends on: content of the sources, parameters and the recipe's version; no paths or names."""
    return fingerprint({"sources": sources, "params": params, "recipe": version})
