"""Rules over tables: each status of each check, no rows, groups, and one pass whatever the number of rules."""

from pyspark.sql import functions as F

from urbanframe.operators import model_qa as MQ

FACE = "id int, ring array<struct<x:double,y:double>>, closed boolean, strategy string"


def _ring(*points):
    return [{"x": float(x), "y": float(y)} for x, y in points]


def _faces(spark, *extra):
    return MQ.face_measures(spark.createDataFrame([(1, _ring((0, 0), (4, 0), (4, 4), (0, 4)), True, "hull"), *extra], FACE))


def _status(df, rules):
    return {r.check: r for r in MQ.check_rows(df, rules).collect()}


def test_faces(spark):
    rule = [MQ.face_rules("faces")]
    assert _status(_faces(spark), rule)["faces"].status == "pass"
    cases = {
        "open": (2, _ring((0, 0), (4, 0), (4, 4), (0, 4)), False, None), "large_fail": (2, _ring((0, 0), (80, 0), (80, 80), (0, 80)), True, None),
        "many_corners": (2, _ring(*((k, k * k) for k in range(70))), True, None), "long_fail": (2, _ring((0, 0), (600, 0), (600, 1), (0, 1)), True, None),
        "sharp_fail": (2, _ring((0, 0), (9, 0), (9, 0.1)), True, None), "crossed": (2, _ring((0, 0), (4, 4), (4, 0), (0, 4)), True, None),
    }
    for name, face in cases.items():
        r = _status(_faces(spark, face), rule)["faces"]
        assert r.status == "fail" and r.counts[name] == 1 and r.n == 2 and r.message == "invalid faces", name
    r = _status(_faces(spark, (2, _ring((0, 0), (30, 0), (30, 30), (0, 30)), True, None)), rule)["faces"]
    assert (r.status, r.failed, r.warned, r.counts["large"]) == ("warn", 0, 1, 1)
    assert _status(_faces(spark).limit(0), rule)["faces"].status == "fail"
    nothing = _faces(spark, (2, None, None, "fan"), (3, [], True, "fan"))
    assert _status(nothing, rule)["faces"].n == 3
    found = {r.strategy: r for r in MQ.strategies(nothing).collect()}
    assert found["hull"].n == 1 and found["hull"].max_square_m == 16 and found["fan"].n == 2


def test_terrain_and_density(spark):
    points = lambda *d: spark.createDataFrame([(x,) for x in d], "delta double")
    status = lambda df, share=0.1: _status(df, [MQ.terrain_rule("t", share)])["t"].status
    assert status(points(0.0, -0.05, 1.0)) == "pass" and status(points(0.0, -0.06)) == "fail"
    assert status(points(*[0.0] * 9, None)) == "pass" and status(points(*[0.0] * 8, None)) == "warn" and status(points(0.0, None), 0.5) == "pass"
    assert status(points().limit(0)) == "warn"
    dense = lambda raw, fine: _status(spark.createDataFrame([("raw",)] * raw + [("fine",)] * fine, "layer string"), [MQ.density_rule()])["terrain_density"].status
    assert (dense(1, 2), dense(2, 2), dense(0, 0)) == ("pass", "warn", "warn")


PARTS = "kind string, colour double, body_colour double, bevels int, shortest double, normal_state string, tag int, best double, gap double"
GOOD = [("body", 0.8, 0.8, 4, 0.4, "good", 0, None, None), ("foundation", 0.8, 0.8, 0, 0.4, "good", 1, 0.99, 0.01)]


def test_buildings(spark):
    status = lambda rows: {c: r.status for c, r in _status(spark.createDataFrame(rows, PARTS), MQ.building_rules()).items()}
    good = status(GOOD)
    assert set(good.values()) == {"pass"} and len(good) == 6
    changed = lambda k, **v: [*GOOD, tuple(v.get(n, x) for n, x in zip([c.split()[0] for c in PARTS.split(", ")], GOOD[k], strict=True))]
    for check, rows, expected in (
        ("building_color", changed(0, colour=0.1), "fail"), ("building_color", changed(0, colour=None), "warn"), ("footprint_bevel", changed(0, shortest=0.01), "fail"),
        ("building_normals", changed(0, normal_state="zero"), "fail"), ("foundation_tags", changed(0, tag=None), "fail"), ("foundation_tags", changed(1, tag=0), "fail"),
        ("foundation_normals", changed(1, best=0.5), "fail"), ("foundation_normals", changed(1, best=None), "warn"), ("foundation_alignment", changed(1, gap=0.2), "fail"),
    ):
        got = status(rows)
        assert got.pop(check) == expected and set(got.values()) == {"pass"}, check
    none = status([GOOD[0][:3] + (0,) + GOOD[0][4:]])
    assert none["footprint_bevel"] == "warn" and none["foundation_normals"] == none["foundation_alignment"] == "warn"


def test_groups_and_one_pass(spark):
    faces = _faces(spark, (2, _ring((0, 0), (4, 4), (4, 0), (0, 4)), True, "fan"))
    checks = MQ.check_rows(faces, [MQ.face_rules("a"), MQ.face_rules("b", F.col("id") < 0)], ["strategy"])
    assert {(r.strategy, r.check): r.status for r in checks.collect()} == {("hull", "a"): "pass", ("hull", "b"): "fail", ("fan", "a"): "fail", ("fan", "b"): "fail"}
    plan = MQ.check_rows(faces, [MQ.face_rules(str(k)) for k in range(5)])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange SinglePartition") == 1
    one = MQ.roll_up(checks).first()
    assert (one.status, one.n_pass, one.n_warn, one.n_fail) == ("fail", 1, 0, 3) and MQ.roll_up(checks.limit(0)).first().status == "pass"
