"""Heightmap images, areas of rings in degrees, heights of a second provider, extents, last lines and checks of OSM files."""

import random
import zlib

import pytest

from urbanframe.functions.projection import ring_square_m
from urbanframe.operators import buildings as B, raster as R, runs as U
from urbanframe.sources import heightmap as H, osm

PIXEL = "row int, col int, pixel int"


def _plain_png(image):
    """Rows of pixels by the format's rules, one by one; zlib compares the checksum of the whole stream."""
    at, stream, width = 8, b"", 0
    while at < len(image):
        size, kind = int.from_bytes(image[at : at + 4]), image[at + 4 : at + 8]
        data = image[at + 8 : at + 8 + size]
        assert zlib.crc32(kind + data) == int.from_bytes(image[at + 8 + size : at + 12 + size])
        if kind == b"IHDR":
            width = int.from_bytes(data[:4])
            assert data[8:] == bytes([16, 0, 0, 0, 0])
        stream += data if kind == b"IDAT" else b""
        at += 12 + size
    raw, rows = zlib.decompress(stream), []
    for start in range(0, len(raw), 2 * width + 1):
        row = bytearray(raw[start + 1 : start + 2 * width + 1])
        for k in range(2, len(row)):
            row[k] = (row[k] + row[k - 2]) % 256
        rows.append([row[k] << 8 | row[k + 1] for k in range(0, len(row), 2)])
    return rows


@pytest.mark.parametrize("band_bytes", [1, 100, 1 << 20])
def test_image_decodes_to_the_same_pixels(spark, tmp_path, band_bytes):
    rnd = random.Random(3)
    cells = {(rnd.randrange(23), rnd.randrange(17)): rnd.randrange(65536) for _ in range(250)}
    rows = [(r, c, p) for (r, c), p in cells.items() if r not in (7, 8)] + [(99, 1, 5), (1, 99, 5), (-1, 0, 5), (None, 1, 5), (1, None, 5), (2, 2, None), (3, 3, 65536), (4, 4, -1)]
    (r0, c0, p0), twice = rows[0], max(rows[0][2] - 1, 0)
    path = str(tmp_path / "map.png")
    H.write_image(spark.createDataFrame([*rows, (r0, c0, twice)], PIXEL), 23, 17, path, band_bytes)
    image = (tmp_path / "map.png").read_bytes()
    expected = [[cells.get((r, c), 0) if r not in (7, 8) else 0 for c in range(17)] for r in range(23)]
    assert expected[r0][c0] == p0 and _plain_png(image) == expected == H.decoded(image).tolist()
    assert [f.name for f in tmp_path.iterdir() if not f.name.endswith(".crc")] == ["map.png"]
    with pytest.raises(ValueError, match="already"):
        H.write_image(spark.createDataFrame(rows, PIXEL), 23, 17, path)
    with pytest.raises(ValueError, match="damaged"):
        H.decoded(image[:60] + bytes([image[60] ^ 1]) + image[61:])


def test_image_without_pixels_and_with_one(spark, tmp_path):
    none = spark.createDataFrame([], PIXEL)
    H.write_image(none, 3, 1, str(tmp_path / "none.png"))
    assert _plain_png((tmp_path / "none.png").read_bytes()) == [[0]] * 3
    assert H.tile_images(none, 4).count() == 0
    with pytest.raises(ValueError, match="rows and columns"):
        H.image_bands(none, 0, 5)
    one = spark.createDataFrame([(-1, 4, 65535, "x")], f"{PIXEL}, tile_row string")
    assert [(r.tile_row, r.tile_col, _plain_png(r.image)) for r in H.tile_images(one, 2).collect()] == [(-1, 2, [[0, 0], [65535, 0]])]


def test_joined_checksum():
    data = bytes(random.Random(1).randbytes(300_000))
    for cuts in ([0, 300_000], [0, 1, 70_000, 70_000, 299_999, 300_000]):
        parts = [data[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
        assert H.joined_checksum(iter((zlib.adler32(p), len(p)) for p in parts)) == zlib.adler32(data)


def test_dense_index_skips_null_places(spark):
    p = spark.createDataFrame([(1.001, 5.0), (1.004, 7.0), (None, 6.0), (-2.0, None), (3.0, 5.0)], "x double, z double")
    assert sorted((r.x, r.z, r.row, r.col) for r in R.dense_index(p).collect()) == [(1.001, 5.0, 0, 1), (1.004, 7.0, 2, 1), (3.0, 5.0, 0, 2)]


def test_ring_square_m(spark):
    def square(lon, lat, d):
        return [{"x": lon + a * d, "y": lat + b * d} for a, b in ((0, 0), (1, 0), (1, 1), (0, 1))]

    rings = [square(3.0, 45.0, 0.001), square(3.0, -45.001, 0.001), square(-177.0, -0.0005, 0.001), square(3.0, 45.0, 0.001)[:2], [], None, [*square(3.0, 45.0, 0.001)[:3], {"x": None, "y": 1.0}]]
    df = spark.createDataFrame([(k, r) for k, r in enumerate(rings)], "k int, ring array<struct<x:double,y:double>>")
    got = [r.a for r in df.withColumn("a", ring_square_m(df.ring)).orderBy("k").collect()]
    # degrees of the ellipsoid at 45 and 0 degrees, by the scale of the central meridian twice
    assert got[0] == pytest.approx(78.847 * 111.132 * 0.9996**2, rel=2e-4) and got[1] == pytest.approx(got[0], rel=1e-6)
    assert got[2] == pytest.approx(111.320 * 110.574 * 0.9996**2, rel=2e-4) and got[3:] == [0.0, 0.0, None, None]


def test_second_heights(spark):
    b = spark.createDataFrame([(1, 10.0, 5.0, 12.0), (2, 10.0, 5.0, None), (3, 10.0001, 5.0, -1.0), (4, 10.1, 5.0, 0.0), (5, None, 5.0, None)], "id int, lon double, lat double, raw_height double")
    s = spark.createDataFrame([(7, 10.0, 5.0, 0.0), (8, 10.0, 5.0, 9.0), (9, 10.0002, 5.0, 6.0), (10, 10.0, None, 4.0)], "id int, lon double, lat double, height double")
    rows = lambda x: [tuple(r) for r in B.second_heights(b, x).orderBy("id").collect()]
    got = rows(s)
    assert got[0] == (1, 12.0, True, "first") and got[1] == (2, 0.0, True, "second") and got[2][2:] == (True, "second") and got[3:] == [(4, 0.0, False, None), (5, 0.0, False, None)]
    assert [r[1:] for r in rows(s.limit(0))] == [(12.0, True, "first")] + [(0.0, False, None)] * 4


def test_outline_extent(spark):
    ring = lambda *p: [{"x": float(x), "y": float(y)} for x, y in p]
    rows = [([ring((0, 1), (2, 3), (1, 9)), ring((99, 99), (100, 100), (99, 100))],), ([ring((-5, 2), (0, 0), (1, 1))],), ([],), (None,)]
    df = spark.createDataFrame(rows, "outer array<array<struct<x:double,y:double>>>")
    assert tuple(B.outline_extent(df).first()) == (2, -5.0, 0.0, 2.0, 9.0)
    assert tuple(B.outline_extent(df.limit(0)).first()) == (0, None, None, None, None)


def test_last_lines(spark):
    log = spark.createDataFrame([("a", k, f"line {k}") for k in range(200)] + [("b", 1, "x"), ("b", None, "y"), (None, 2, None)], "run string, seq int, line string")
    got = U.last_lines(log)
    assert {(r.run, r.seq) for r in got.collect()} == {("a", k) for k in range(120, 200)} | {("b", 1), ("b", None), (None, 2)}
    assert {(r.run, r.seq) for r in U.last_lines(log, 1).collect()} == {("a", 199), ("b", 1), (None, 2)}
    plan = U.last_lines(log)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # before and after the exchange


def test_parse_checks(spark, tmp_path):
    good = "<osm>\n<node id='1' lat='1.5' lon='2.5'/>\n<way id='7'><nd ref='1'/></way>\n</osm>"

    def found(name, text):
        (tmp_path / name).write_text(text)
        return {r.check: r.status for r in osm.parse_checks(spark, str(tmp_path / name)).collect()}

    assert found("good.osm", good) == {"osm_nodes": "pass", "osm_ways": "pass", "osm_whole": "pass"}
    two = good.replace("<way", "<node id='2' lat='north' lon='2.5'/>\n<node id='3'/>\n<way")
    assert found("number.osm", two) == {"osm_nodes": "fail", "osm_ways": "pass", "osm_whole": "pass"}
    assert {(r.id, r.lat) for r in osm.read_nodes(spark, str(tmp_path / "number.osm")).collect()} == {("1", 1.5), ("3", None)}
    assert found("nameless.osm", good.replace("way id='7'", "way"))["osm_ways"] == "fail"
    assert found("cut.osm", good[:-8])["osm_whole"] == "fail"
    assert found("empty.osm", "<osm version='0.6'/>") == {"osm_nodes": "warn", "osm_ways": "warn", "osm_whole": "pass"}


def test_long_segments(spark):
    from urbanframe.operators.roads import long_segments

    p = spark.createDataFrame([("a", 1, 0.0, 0.0), ("a", 2, 0.0, 0.2), ("a", 3, 0.0, 0.45), ("a", 5, 3.0, 4.45), ("a", 6, None, 1.0), ("a", 7, 0.0, 0.0), ("b", 1, 0.0, 0.0)], "road string, seq int, x double, y double")
    assert sorted((r.road, r.seq, round(r.length, 6)) for r in long_segments(p).collect()) == [("a", 2, 0.25), ("a", 3, 5.0)]
    assert long_segments(p.limit(0)).count() == 0


def test_selection_totals(spark):
    from urbanframe.operators.tiles import selection_totals

    rows = [("a", 0, 0, "x"), ("a", 0, 0, ""), ("a", 1000, 0, None), ("a", 0, 1000, "b"), ("a", 1000, 1000, "x"), ("b", 5000, 7000, "x"), ("b", 5000, 7000, "x"), ("c", None, 1, "x"), (None, 1, 2, "")]
    got = {r.g: tuple(r)[1:] for r in selection_totals(spark.createDataFrame(rows, "g string, easting long, northing long, source string"), ["g"]).collect()}
    assert got == {"a": (0, 0, 2, 2, 4, 3, False, ["b", "x"]), "b": (5000, 7000, 1, 1, 1, 1, True, ["x"]), None: (1, 2, 1, 1, 1, 0, False, [])}


def test_reports(spark, tmp_path):
    from datetime import datetime

    from urbanframe.operators import reports as RP

    path, schema = str(tmp_path / "reports"), "check string, status string, message string"
    checks = lambda *s: spark.createDataFrame([(f"c{k}", x, "m") for k, x in enumerate(s)], schema)
    first = RP.append_report(checks("pass", "fail"), path, "north", datetime(2024, 1, 1, 9))
    second = RP.append_report(checks("pass", "warn"), path, "north", datetime(2024, 1, 2, 9))
    other = RP.append_report(checks("pass"), path, "south", datetime(2024, 1, 1, 8))
    RP.append_report(checks("fail").limit(0), path, "south", datetime(2025, 1, 1))
    rows = RP.reports(spark, path)
    assert {(r.area, r.report_id, r.check, r.status) for r in RP.latest_reports(rows).collect()} == {("north", second, "c0", "pass"), ("north", second, "c1", "warn"), ("south", other, "c0", "pass")}
    seen = {r.report_id: (r.severity, r.n_pass, r.n_warn, r.n_fail, r.current) for r in RP.overview(rows).collect()}
    assert seen == {first: ("fail", 1, 0, 1, False), second: ("warn", 1, 1, 0, True), other: ("pass", 1, 0, 0, True)}
    one = RP.reports(spark, path, "south")
    assert one.count() == 1 and "PartitionFilters: [isnotnull(area" in one._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError, match="safe"):
        RP.append_report(checks("pass"), path, "../x", datetime(2024, 1, 1))


def test_process_and_output_checks(spark, tmp_path):
    from urbanframe.operators import refine as RF

    rows = lambda *a, **k: [tuple(r) for r in RF.process_checks(*a, **k).collect()]
    assert rows(spark.range(10), spark.range(4), "cop30", 2) == [("bld_retention", "warn", "40% kept"), ("dem_correction", "pass", "applied=True")]
    assert rows(spark.range(10), spark.range(9), RF.BARE_EARTH, 2)[1:] == [("dem_correction", "pass", "applied=False")]
    assert rows(spark.range(10), spark.range(9)) == [("bld_retention", "pass", "90% kept")] and rows(spark.range(0), spark.range(0)) == []
    (tmp_path / "b.json").write_bytes(b"x" * 1001)
    (tmp_path / "r.osm").write_bytes(b"x" * 1000)
    found = RF.written_checks(spark, {"buildings": str(tmp_path / "b.json"), "roads": str(tmp_path / "r.osm")})
    assert {r.check: r.status for r in found.collect()} == {"output_buildings": "pass", "output_roads": "fail", "output_dem": "fail"}
