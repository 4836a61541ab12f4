"""Tables that are replaced only when they change, raw snapshots, collections in archives, and functions by SQL names."""

import io
import json
import os
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from urbanframe.functions import geometry as G, projection as PR
from urbanframe.functions.sql import register
from urbanframe.operators import order as O, roads as R
from urbanframe.operators.snapshots import DIGEST_FILE, content_digest, publish_changed, raw_snapshot, stored_digest
from urbanframe.sources import geojson


def _files(path):
    return sorted((name, os.stat(path / name).st_mtime_ns) for name in os.listdir(path))


def test_digest_is_of_the_rows_only(spark):
    rows = [(k % 7, None if k % 5 == 0 else f"t{k}", k / 3, {"a": str(k), "b": "x"} if k % 2 else {"b": "x", "a": str(k)}) for k in range(200)]
    schema = "k int, t string, v double, m map<string,string>"
    base = content_digest(spark.createDataFrame(rows, schema).repartition(1))
    other = [(k, t, v, dict(reversed(m.items()))) for k, t, v, m in rows]
    assert content_digest(spark.createDataFrame(random.Random(1).sample(other, 200), schema).repartition(7)) == base and base.rows == 200
    changed = [rows[:-1], [*rows, rows[0]], [*rows[:-1], rows[0]], [(0, "t0", 0.0, None), *rows[1:]], [(0, "", 0.0, rows[0][3]), *rows[1:]]]
    assert len({content_digest(spark.createDataFrame(r, schema)) for r in changed} | {base}) == 6
    empty = spark.createDataFrame([], schema)
    assert content_digest(empty).rows == 0 and content_digest(empty) != content_digest(empty.withColumnRenamed("t", "u"))


def test_publish_only_what_changed(spark, tmp_path):
    target = tmp_path / "t"
    one, two = spark.range(50).withColumn("v", F.col("id") * 2), spark.range(50).withColumn("v", F.col("id") * 3)
    assert publish_changed(one, str(target)) == "published" and DIGEST_FILE in os.listdir(target)
    before = _files(target)
    assert publish_changed(one.repartition(5), str(target)) == "unchanged" and _files(target) == before
    assert publish_changed(two, str(target), lambda df: df.count() > 50) == "rejected" and _files(target) == before
    with pytest.raises(Exception, match="boom"):
        publish_changed(two.withColumn("v", F.raise_error(F.lit("boom"))), str(target))
    assert _files(target) == before and stored_digest(spark, str(target)) == content_digest(one)
    assert publish_changed(two, str(target)) == "published" and spark.read.parquet(str(target)).agg(F.sum("v")).first()[0] == 3 * 1225
    (target / DIGEST_FILE).write_text("{broken")
    (target / f".{DIGEST_FILE}.crc").unlink(missing_ok=True)
    assert stored_digest(spark, str(target)) is None and publish_changed(two, str(target)) == "published"
    assert publish_changed(two.limit(0), str(target)) == "published" and spark.read.parquet(str(target)).count() == 0


def test_raw_snapshots(spark, tmp_path):
    raw, first = str(tmp_path / "raw"), spark.range(20)
    assert raw_snapshot(first, raw) == "initial"
    refined_from = stored_digest(spark, raw)
    assert raw_snapshot(first.repartition(3), raw, refined_from) == "kept"
    assert raw_snapshot(spark.range(15), raw) == "kept" and spark.read.parquet(raw).count() == 20  # no record of a refinement
    assert raw_snapshot(spark.range(30), raw, refined_from) == "changed" and spark.read.parquet(raw).count() == 30
    assert raw_snapshot(first, raw, refined_from) == "kept" and spark.read.parquet(raw).count() == 30  # what refinement began with


def _zip(**members):
    with zipfile.ZipFile(out := io.BytesIO(), "w", zipfile.ZIP_DEFLATED) as z:
        for name, data in members.items():
            z.writestr(name.replace("__", "."), data)
    return out.getvalue()


def test_collections_plain_zipped_and_damaged(spark, tmp_path):
    point = {"type": "Point", "coordinates": [1.0, 2.0]}
    square = {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1], [0, 0]]]}
    feature = lambda g, **p: {"type": "Feature", "geometry": g, "properties": p}
    text = json.dumps({"features": [feature(square, height=3.5), feature(None, height=""), feature(point), feature(point, height=None)] * 600})
    flat = json.dumps({"features": [feature(None, height="9")]})
    files = {"a.geojson": text.encode(), "b.zip": _zip(note__txt="x", c__json=text), "c.zip": _zip(note__txt="x"), "d.zip": _zip(c__json=text)[:300], "e.json": b"", "f.json": b"[1]", "g.json": flat.encode(), "h.json": b'{"features": []}'}
    for name, data in files.items():
        (tmp_path / name).write_bytes(data)
    found = geojson.read_collections(spark, str(tmp_path))
    got = {r.path.rsplit("/", 1)[1]: tuple(r)[1:] for r in geojson.coverage(found).collect()}
    bad = (0, 0, None, 0, "fail")
    assert got == {"a.geojson": (2400, 600, 25, 1800, "pass"), "b.zip": (2400, 600, 25, 1800, "pass"), "c.zip": bad, "d.zip": bad, "e.json": bad, "f.json": bad, "g.json": (1, 1, 100, 0, "fail"), "h.json": bad}
    one = found.filter("path LIKE '%b.zip'").orderBy("fid").collect()
    assert [r.fid for r in one] == list(range(2400)) and one[2396].polys[0][0][1].lon == 1.0 and one[1].error is None
    nulls = spark.createDataFrame([("x", None), (None, text.encode())], "path string, content binary")
    assert {(r.path, r.n) for r in geojson.coverage(geojson.split_collections(nulls)).collect()} == {("x", 0), (None, 2400)}
    assert geojson.split_collections(nulls.limit(0)).count() == 0
    polygons = found.filter("geom_type = 'Polygon'")
    out = str(tmp_path / "lines")
    assert [geojson.publish_lines(polygons, out), geojson.publish_lines(polygons.repartition(3), out)] == ["published", "unchanged"] and geojson.read_lines(spark, out).count() == 1200


def test_first_places(spark):
    rng = random.Random(3)
    rows = [(rng.choice([None, "a", "b"]), rng.choice([None, *"pqrstu"]), rng.choice([None, *range(8)])) for _ in range(120)]
    first = {}
    for g, v, o in rows:
        if v is not None:
            first[g, v] = min(first.get((g, v), 99), 99 if o is None else o)
    expected = {(g, v, k) for group in {g for g, _ in first} for k, (g, v) in enumerate(sorted((x for x in first if x[0] == group), key=lambda x: (first[x], x[1])))}
    got = [tuple(r) for r in O.first_places(spark.createDataFrame(rows, "g string, v string, o int"), ["g"], "v", "o").collect()]
    assert set(got) == expected and len(got) == len(expected)
    assert O.first_places(spark.createDataFrame(rows[:0], "g string, v string, o int"), ["g"], "v", "o").count() == 0


def test_weld_takes_the_first_in_node_order(spark):
    ways = spark.createDataFrame([("a", ["p", "q"]), ("b", ["r", "s"]), ("c", ["1", "t"]), ("d", ["7", "30"])], "way_id string, refs array<string>")
    nodes = [("p", 0.0, 0), ("q", 50.0, 4), ("r", 50.8, 3), ("s", 90.0, 1), ("1", 51.6, 9), ("t", 120.0, 2), ("7", 200.0, 8), ("30", 200.5, 7)]
    df = spark.createDataFrame([(i, x, 0.0, s) for i, x, s in nodes], "id string, x double, y double, seq int")
    assert {r.way_id: r.refs for r in R.weld(ways, df).collect()} == {"a": ["p", "r"], "b": ["r", "s"], "c": ["r", "t"], "d": ["7", "7"]}
    assert {r.way_id: r.refs[0] for r in R.weld(ways, df.drop("seq")).collect()}["c"] == "1"


def test_sql_names_give_what_the_columns_give(spark):
    assert register(spark) == register(spark)
    rng = random.Random(5)
    rows = [(k, [(rng.uniform(-5, 5), rng.uniform(-5, 5)) for _ in range(rng.randint(0, 9))], rng.uniform(-179, 179), rng.uniform(-70, 70), *(rng.uniform(-5, 5) for _ in range(8))) for k in range(300)]
    names = ("ax", "ay", "bx", "by", "cx", "cy", "dx", "dy")
    df = spark.createDataFrame(rows, "id int, ring array<struct<x:double,y:double>>, lon double, lat double, " + ", ".join(f"{c} double" for c in names))
    ends = ", ".join(names)
    t, u = G.crossing(*(F.col(c) for c in names))
    side = spark.sql(f"SELECT *, ring_signed_area(ring) AS a, ring_contains(ring, ax, ay) AS c, crossing_first({ends}) AS t, crossing_second({ends}) AS u, utm_zone(lon) AS z, utm_easting(lon, lat, utm_zone(lon)) AS e, utm_northing(lon, lat, utm_zone(lon)) AS n FROM {{df}}", df=df)
    side = spark.sql("SELECT *, utm_lon(e, n, z, lat >= 0) AS lon2, utm_lat(e, n, z, lat >= 0) AS lat2, box_width_m(lon, lat, lon + 1, lat + 1) AS w, box_height_m(lon, lat, lon + 1, lat + 1) AS h FROM {df}", df=side)
    w, h = PR.box_size(F.col("lon"), F.col("lat"), F.col("lon") + 1, F.col("lat") + 1)
    for r in side.select("*", G.signed_area(F.col("ring")).alias("a0"), G.contains(F.col("ring"), F.col("ax"), F.col("ay")).alias("c0"), t.alias("t0"), u.alias("u0"), PR.zone_number(F.col("lon")).alias("z0"), w.alias("w0"), h.alias("h0")).collect():
        e, n = PR.to_utm(r.lon, r.lat, r.z, PR.PLAIN)
        for got, expected, near in ((r.a, r.a0, 1e-9), (r.t, r.t0, 1e-9), (r.u, r.u0, 1e-9), (r.e, e, 1e-5), (r.n, n, 1e-5), (r.lon2, r.lon, 1e-5), (r.lat2, r.lat, 1e-5), (r.w, r.w0, 1e-6), (r.h, r.h0, 1e-6)):
            assert (got is None) == (expected is None) and (got is None or abs(got - expected) < near)
        assert (r.c, r.z) == (r.c0, r.z0)
