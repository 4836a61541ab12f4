"""Areas: their configuration, cached clips, and the log of runs."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass
from datetime import datetime
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F

from urbanframe.operators.roads import ways_in_box
from urbanframe.operators.runs import checked_id, normal_box, run_states
from urbanframe.operators.spatial import smallest_cover

MANIFEST = "key string, box array<double>, signature string, files array<string>, _corrupt string"
EVENT = "run_id string, seq long, time timestamp, status string, phase string, message string, fields string"
#: Files that a cached clip must have, and the signature of clips that name none.
OUTPUTS, DEFAULT_SIGNATURE = ("roads", "buildings", "dem"), "default_v1"
SIDES = ("west", "south", "east", "north")


@dataclass(frozen=True)
class AreaConfig:
    """The active area: its id, its box and the paths of its raw layers."""

    area_id: str
    box: tuple[float, float, float, float]
    paths: dict[str, str]


def normal_path(value: str, root: str) -> str:
    """A path with forward slashes; a relative one stands under root, and one with a scheme, drive or root stays as it is."""
    path = value.replace("\\", "/")
    return path if re.match(r"^([A-Za-z][A-Za-z0-9+.-]*:|/)", path) else f"{root.rstrip('/')}/{path}"


def load_area(spark: SparkSession, path: str, root: str) -> AreaConfig:
    """An area's configuration from JSON (area_id, bbox, and paths of layers under any other key that ends in _file or _csv)."""
    raw: dict[str, Any] = json.loads(spark.read.text(path, wholetext=True).first()[0])
    paths = {k: normal_path(v, root) for k, v in raw.items() if k.endswith(("_file", "_csv")) and v}
    return AreaConfig(checked_id(raw["area_id"]), tuple(normal_box(raw["bbox"])), paths)


def read_manifests(spark: SparkSession, path: str) -> DataFrame:
    """(key, west, south, east, north, signature, ready) of the clips' manifests under a path; unreadable ones are left out.

    A manifest is a JSON file (key, box, signature, files) whose name doesn't begin with an underscore or a dot.
    """
    raw = spark.read.option("multiLine", True).option("recursiveFileLookup", True).option("columnNameOfCorruptRecord", "_corrupt").schema(MANIFEST).json(path)
    good = raw.filter("_corrupt IS NULL AND key IS NOT NULL AND size(box) = 4")
    ready = F.size(F.array_except(F.array(*map(F.lit, OUTPUTS)), F.coalesce("files", F.array()))) == 0
    return good.select("key", *(F.element_at("box", k + 1).alias(c) for k, c in enumerate(SIDES)), F.coalesce("signature", F.lit(DEFAULT_SIGNATURE)).alias("signature"), ready.alias("ready"))


def cache_matches(targets: DataFrame, clips: DataFrame) -> DataFrame:
    """(id, key, mode) of the clip that serves each target (id, west, south, east, north, signature).

    Only clips (key, box, signature, ready) that are ready and have the target's signature count. mode is exact for one with
    the same box, else parent_clip for the smallest that covers it (then the least key), else null.
    """
    usable = clips.filter("ready").drop("ready").withColumnRenamed("key", "id")
    found = smallest_cover(targets, usable, same=["signature"])
    boxes = usable.select(F.col("id").alias("cover"), *(F.col(c).alias(f"c_{c}") for c in SIDES))
    same = F.lit(True)
    for c in SIDES:
        same = same & (F.col(c) == F.col(f"c_{c}"))
    out = targets.join(found.withColumnRenamed("target", "id").hint("merge"), "id").join(boxes.hint("merge"), "cover", "left")
    return out.select("id", F.col("cover").alias("key"), F.when(F.col("cover").isNotNull(), F.when(same, "exact").otherwise("parent_clip")).alias("mode"))


def clipped_layers(layers: dict[str, DataFrame], box: tuple[float, float, float, float]) -> dict[str, DataFrame]:
    """The layers of a smaller box from those of a cached clip.

    way_nodes (way_id, seq, ref) keeps the ways with a node in the box, with all their nodes; tags and nodes follow.
    buildings (lon, lat of the centroid) and dem (lon, lat) keep what is in the box; dem counts row and col from 0 again.
    """
    west, south, east, north = box
    inside = F.col("lon").between(west, east) & F.col("lat").between(south, north)
    way_nodes = ways_in_box(layers["way_nodes"], layers["tags"], layers["nodes"], box)
    dem = layers["dem"].filter(inside)
    least = dem.agg(F.min("row").alias("row0"), F.min("col").alias("col0"))
    return {
        "way_nodes": way_nodes.select("way_id", "seq", "ref"),
        "tags": layers["tags"].join(way_nodes.select("way_id").distinct(), "way_id", "left_semi"),
        "nodes": layers["nodes"].join(way_nodes.select(F.col("ref").alias("id")).distinct(), "id", "left_semi"),
        "buildings": layers["buildings"].filter(inside),
        "dem": dem.join(F.broadcast(least)).withColumns({"row": F.col("row") - F.col("row0"), "col": F.col("col") - F.col("col0")}).drop("row0", "col0"),
    }


@dataclass
class RunLog:
    """Runs as an append-only table of events in a folder; the state of a run is that of its last event."""

    spark: SparkSession
    path: str

    def append(self, run_id: str, status: str, phase: str, message: str = "", fields: dict | None = None, now: datetime | None = None) -> None:
        time = now or datetime.now()
        row = (checked_id(run_id), int(time.timestamp() * 1e6), time, status, phase, message, json.dumps(fields or {}, sort_keys=True))
        self.spark.createDataFrame([row], EVENT).coalesce(1).write.mode("append").json(self.path)

    def create(self, run_id: str, area: AreaConfig, source: str, now: datetime | None = None) -> None:
        self.append(run_id, "running", "created", "pipeline run created", {"area_id": area.area_id, "bbox": list(area.box), "source": source}, now)

    def update(self, run_id: str, status: str = "running", phase: str = "", message: str = "", fields: dict | None = None, now: datetime | None = None) -> None:
        self.append(run_id, status, phase, message, fields, now)

    def fail(self, run_id: str, phase: str, message: str, now: datetime | None = None) -> None:
        self.append(run_id, "failed", phase, message, now=now)

    def complete(self, run_id: str, phase: str = "completed", message: str = "pipeline completed", now: datetime | None = None) -> None:
        self.append(run_id, "completed", phase, message, now=now)

    def events(self) -> DataFrame:
        return self.spark.read.schema(EVENT).json(self.path)

    def states(self) -> DataFrame:
        """(run_id, status, n_events) of every run."""
        return run_states(self.events())

    def latest(self) -> DataFrame:
        """The last event of the run that was last written to."""
        return self.events().orderBy(F.desc("time"), F.desc("seq")).limit(1)
