"""Readers and writers on generated files, and the streaming operators."""

import json
from datetime import datetime

from pyspark.sql import functions as F

from urbanframe.functions.projection import Projector
from urbanframe.operators.runs import progress
from urbanframe.sources import dem, geojson, osm
from urbanframe.streaming.progress import read_log, stream_progress

OSM = """<?xml version='1.0'?><osm>
<node id="1" lat="12.9" lon="100.8"/><node id="2" lat="12.91" lon="100.81"/>
<way id="7"><nd ref="1"/><nd ref="2"/><tag k="highway" v="path"/><tag k="highway" v="track"/></way><way id="8"><nd ref="1"/></way></osm>"""


def test_osm(spark, tmp_path):
    (tmp_path / "a.osm").write_text(OSM)
    nodes, ways = osm.read_nodes(spark, str(tmp_path / "a.osm")), osm.read_ways(spark, str(tmp_path / "a.osm"))
    assert {r.id: (r.lon, r.lat) for r in nodes.collect()} == {"1": (100.8, 12.9), "2": (100.81, 12.91)}
    got = {r.way_id: (r.refs, r.tags) for r in ways.collect()}
    assert got == {"7": (["1", "2"], {"highway": "track"}), "8": (["1"], {})}
    osm.write_ways(ways, str(tmp_path / "out"))
    again = osm.read_ways(spark, str(tmp_path / "out"))
    assert {r.way_id: (r.refs, r.tags) for r in again.collect()} == got


def test_building_heights(spark, tmp_path):
    node = lambda i: {"type": "node", "id": i, "lat": 12.0 + i, "lon": 100.0}
    way = lambda i, nodes, **tags: {"type": "way", "id": i, "nodes": nodes, "tags": tags}
    elements = [*map(node, range(4)), way(10, [0, 1, 2], height="12 m"), way(11, [0, 1, 2], height="abc", **{"building:levels": "3"}), way(12, [0, 1, 2], height="2.0"), way(13, [0, 1], height="9")]
    (tmp_path / "q.json").write_text(json.dumps({"elements": elements}))
    assert {r.id: r.height for r in osm.read_building_heights(spark, str(tmp_path / "q.json")).collect()} == {10: 12.0, 11: 10.5}


def test_geojson(spark, tmp_path):
    square = [[[0.0, 0.0], [1.0, 0.0], [1.0, 1.0], [0.0, 0.0]]]
    feature = lambda g, **p: {"type": "Feature", "geometry": g, "properties": p}
    features = [feature({"type": "Polygon", "coordinates": square}, height="12"), feature({"type": "MultiPolygon", "coordinates": [square, square]}), feature(None), feature({"type": "Point", "coordinates": [1.0, 2.0]})]
    (tmp_path / "c.geojson").write_text(json.dumps({"features": features}))
    rows = {r.fid: r for r in geojson.read_collection(spark, str(tmp_path / "c.geojson")).collect()}
    assert [len(rows[k].polys) if rows[k].polys else None for k in range(4)] == [1, 2, None, None] and rows[0].props["height"] == "12"
    assert rows[0].polys[0][0][1].lon == 1.0
    geojson.write_lines(geojson.read_collection(spark, str(tmp_path / "c.geojson")).filter("fid < 2"), str(tmp_path / "lines"))
    assert sorted(len(r.polys) for r in geojson.read_lines(spark, str(tmp_path / "lines")).collect()) == [1, 2]


def test_dem(spark, tmp_path):
    (tmp_path / "five.csv").write_text("x,y,z,row,col\n1.0,5.0,-2.0,3,4\n2.0,nan,-2.0,3,5\n")
    (tmp_path / "three.csv").write_text("x,y,z\n1.0,5.0,-2.0\n2.0,6.0,-1.0\n")
    five = {(r.row, r.col): r.elev for r in dem.read_points(spark, str(tmp_path / "five.csv")).collect()}
    assert five == {(3, 4): 5.0, (3, 5): None}
    assert {(r.row, r.col): r.elev for r in dem.read_points(spark, str(tmp_path / "three.csv")).collect()} == {(0, 0): 5.0, (1, 1): 6.0}
    cells = spark.createDataFrame([(0, 0, 5.0), (0, 1, -9999.0)], "row int, col int, value double")
    assert dem.raster_points(cells, Projector(100.0, 12.0), (100.0, 0.001, 12.0, -0.001)).count() == 1
    name, df = dem.first_available([("gone", lambda: spark.read.parquet(str(tmp_path / "no"))), ("empty", lambda: cells.limit(0)), ("good", lambda: cells)])
    assert name == "good" and df.count() == 2


def test_stream(spark, tmp_path):
    lines = ["[1/6] a", "x [OK] y", "[6/6] b", "[Houdini 4/7] c", "[OK] z", "Houdini build completed", "[2/6] late"]
    rows = [{"run": r, "seq": k, "line": t} for r in (1, 2) for k, t in enumerate(lines)]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text("\n".join(map(json.dumps, rows)))
    query = stream_progress(read_log(spark, str(tmp_path / "in"))).writeStream.format("memory").queryName("progress").outputMode("append").start()
    query.processAllAvailable()
    query.stop()
    got = sorted(map(tuple, spark.sql("SELECT run, seq, pct FROM progress").collect()))
    batch = progress(spark.createDataFrame([(r["run"], r["seq"], r["line"]) for r in rows], "run long, seq long, line string"))
    assert got == sorted(map(tuple, batch.select("run", "seq", F.col("pct")).collect()))
    assert [p for r, _, p in got if r == 1] == [12, 15, 75, 88, 88, 99, 99]


def test_buildings_in_a_box(spark, tmp_path):
    from urbanframe.sources import buildings as BS

    square = [[{"lon": x, "lat": y} for x, y in ((0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 0.0))]]
    big = b"\x00" + BS.struct.pack(">II", 3, 1) + BS.struct.pack(">I6d", 3, 1.0, 2.0, 3.0, 4.0, 5.0, 6.0)
    assert BS.parts_of(big) == [[[{"lon": 1.0, "lat": 2.0}, {"lon": 3.0, "lat": 4.0}, {"lon": 5.0, "lat": 6.0}]]]
    assert BS.parts_of(BS.to_binary([square, square])) == [square, square] and BS.to_binary(None) is None
    point = BS.struct.pack("<BIdd", 1, 1, 0.0, 0.0)
    assert [BS.parts_of(x) for x in (None, b"", b"\x01", point, big[:40])] == [None] * 5
    rows = [(1, BS.to_binary([square]), (0.0, 1.0, 0.0, 1.0), 5.0, None, None, "shed"), (2, None, (0.0, 1.0, 0.0, 1.0), None, 2, None, None), (3, BS.to_binary([square]), (9.0, 10.0, 0.0, 1.0), None, 2, None, None), (4, BS.to_binary([square]), (1.0, 2.0, 1.0, 2.0), None, 2, "retail", None), (5, point, (0.0, 1.0, 0.0, 1.0), None, None, None, None)]
    path = str(tmp_path / "b")
    spark.createDataFrame(rows, "id int, geometry binary, bbox struct<xmin:double,xmax:double,ymin:double,ymax:double>, height double, num_floors int, subtype string, class string").write.parquet(path)
    read = BS.read_buildings(spark, path, (0.5, 0.5, 1.0, 1.0))
    assert {r.id: (r.raw_height, r.real, r["class"], len(r.polys)) for r in read.collect()} == {1: (5.0, True, "shed", 1), 4: (7.0, True, "retail", 1)}
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    assert "PushedFilters: [" in (plan := BS.read_buildings(spark, path, (0.5, 0.5, 1.0, 1.0))._jdf.queryExecution().toString()) and "LessThanOrEqual(bbox.xmin,1.0)" in plan


def test_area_clips_and_runs(spark, tmp_path):
    from urbanframe.operators import areas as AR, refine as RF

    (tmp_path / "area.json").write_text(json.dumps({"area_id": "pier-1", "bbox": [1, 2, 3.00000001, 4], "osm_file": "raw\\roads.osm", "dem_csv": "/abs/dem.csv", "note": "x"}))
    area = AR.load_area(spark, str(tmp_path / "area.json"), "/data/")
    assert area == AR.AreaConfig("pier-1", (1.0, 2.0, 3.0, 4.0), {"osm_file": "/data/raw/roads.osm", "dem_csv": "/abs/dem.csv"})
    every = ["roads", "buildings", "dem"]
    clips = {"a": ([0, 0, 9, 9], None, every), "b": ([1, 1, 5, 5], None, every), "c": ([1, 1, 4, 4], "v2", every), "d": ([1, 1, 3, 3], None, every[:2])}
    for key, (box, signature, files) in clips.items():
        (tmp_path / "clips" / key).mkdir(parents=True)
        (tmp_path / "clips" / key / "manifest.json").write_text(json.dumps({"key": key, "box": box, "signature": signature, "files": files}, indent=1))
    (tmp_path / "clips" / "e").mkdir()
    (tmp_path / "clips" / "e" / "manifest.json").write_text("{broken")
    manifests = AR.read_manifests(spark, str(tmp_path / "clips"))
    targets = [(1, 2.0, 2.0, 3.0, 3.0, "default_v1"), (2, 1.0, 1.0, 5.0, 5.0, "default_v1"), (3, 2.0, 2.0, 3.0, 3.0, "v2"), (4, 8.0, 8.0, 10.0, 10.0, "default_v1")]
    t = spark.createDataFrame(targets, "id int, west double, south double, east double, north double, signature string")
    assert {r.id: (r.key, r.mode) for r in AR.cache_matches(t, manifests).collect()} == {1: ("b", "parent_clip"), 2: ("b", "exact"), 3: ("c", "parent_clip"), 4: (None, None)}

    layers = {
        "way_nodes": spark.createDataFrame([("1", 1, "a"), ("1", 2, "b"), ("2", 1, "b"), ("3", 1, "a")], "way_id string, seq int, ref string"),
        "tags": spark.createDataFrame([("1", "path", None), ("2", "path", None), ("3", None, None)], "way_id string, highway string, building string"),
        "nodes": spark.createDataFrame([("a", 1.0, 1.0), ("b", 9.0, 9.0), ("c", 1.0, 1.0)], "id string, lon double, lat double"),
        "buildings": spark.createDataFrame([(1, 1.0, 1.0), (2, 5.0, 1.0)], "fid int, lon double, lat double"),
        "dem": spark.createDataFrame([(3, 4, 1.0, 1.0, 7.0), (4, 4, 2.0, 1.0, 8.0), (0, 0, 9.0, 9.0, 1.0)], "row int, col int, lon double, lat double, elev double"),
    }
    out = {k: v.collect() for k, v in AR.clipped_layers(layers, (0.0, 0.0, 2.0, 2.0)).items()}
    assert sorted(tuple(r) for r in out["way_nodes"]) == [("1", 1, "a"), ("1", 2, "b")] and [r.way_id for r in out["tags"]] == ["1"]
    assert sorted(r.id for r in out["nodes"]) == ["a", "b"] and [r.fid for r in out["buildings"]] == [1]
    assert sorted((r.row, r.col, r.elev) for r in out["dem"]) == [(0, 0, 7.0), (1, 0, 8.0)]

    log = AR.RunLog(spark, str(tmp_path / "runs"))
    at = lambda s: datetime(2024, 1, 1, 0, 0, s)
    log.create("r1", area, "web", at(1))
    log.create("r2", area, "web", at(2))
    log.update("r1", phase="roads", message="half", now=at(3))
    log.fail("r2", "dem", "no rows", at(4))
    log.complete("r1", now=at(5))
    assert {r.run_id: (r.status, r.n_events) for r in log.states().collect()} == {"r1": ("completed", 3), "r2": ("failed", 2)}
    assert log.latest().first().run_id == "r1" and json.loads(log.events().filter("phase = 'created'").first().fields)["bbox"] == [1.0, 2.0, 3.0, 4.0]

    (tmp_path / "big").write_bytes(b"x" * 11_000)
    (tmp_path / "small").write_bytes(b"x" * 10)
    checks = RF.input_checks(spark, {"buildings": str(tmp_path / "big"), "roads": str(tmp_path / "small")})
    assert {r.check: r.status for r in checks.collect()} == {"buildings_exists": "pass", "roads_size": "fail", "dem_exists": "fail"}
