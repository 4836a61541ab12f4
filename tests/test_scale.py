"""Work that must not grow with copies of places, boxes or rings, nor stand in a plan many times."""

from urbanframe import registry
from urbanframe.operators import overlay as OV, spatial as S

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_projection_stands_in_a_plan_only_a_few_times(spark):
    for name in ("bld_height_provenance", "contract_checks", "procedural_heights", "outline_extent"):
        assert plan(registry.queries()[name](spark, SF)).lower().count("sin(") < 60, name


def counted(monkeypatch, module, name: str) -> list[int]:
    """The rows of each result of a function from now on."""
    seen, real = [], getattr(module, name)

    def run(*args, **kwargs):
        out = real(*args, **kwargs)
        seen.append(out.count())
        return out

    monkeypatch.setattr(module, name, run)
    return seen


def copies(spark, first: int, n: int = 40):
    """n ids at each of two places 1 m apart, and one far away."""
    return spark.createDataFrame([(first + k, float(k % 2), 0.0) for k in range(2 * n)] + [(first + 2 * n, 500.0, 0.0)], "id long, x double, y double")


def test_copies_of_places_meet_once(spark, monkeypatch):
    left, right = copies(spark, 0), copies(spark, 1000)
    seen = counted(monkeypatch, S, "_near_places")
    found = {r.left_id: (r.right_id, r.distance) for r in S.nearest(left, right, 8.0).collect()}
    assert found == {k: (1000 + k % 2, 0.0) for k in range(80)} | {80: (1080, 0.0)}
    assert sorted(r.id for r in S.dedup_within(left, 3.0).collect()) == [0, 80]
    edges = S.links_within(left, 3.0).collect()
    assert len(edges) <= 81 and {v for e in edges for v in e} == set(range(80))
    pairs = S.within_distance(left, right, 8.0)
    assert pairs.count() == 80 * 80 + 1 and pairs.distinct().count() == 80 * 80 + 1
    assert seen == [5, 5, 5, 5]


def test_boxes_of_many_rows_meet_once(spark, monkeypatch):
    targets = spark.createDataFrame([(k, 0.2, 0.2, 0.3, 0.3) for k in range(50)], "id long, west double, south double, east double, north double")
    covers = spark.createDataFrame([(k, 0.0, 0.0, 1.0 + k % 2, 1.0) for k in range(60)], targets.schema)
    seen = counted(monkeypatch, S, "written")
    assert {tuple(r) for r in S.smallest_cover(targets, covers).collect()} == {(k, 0) for k in range(50)}
    assert {tuple(r) for r in S.smallest_cover(targets, covers.filter("id > 0"), ["id"]).collect()} == {(k, 1) for k in range(50)}
    assert seen == [2, 2]


def test_faces_and_polygons_of_one_ring_meet_once(spark, monkeypatch):
    at = lambda x, y: {"x": float(x), "y": float(y)}
    ring = lambda x: [at(x, 0), at(x + 4, 0), at(x + 4, 2), at(x, 2)]
    faces = spark.createDataFrame([(k, k % 3, ring(k % 2 * 3)) for k in range(60)], "id long, owner long, ring array<struct<x:double,y:double>>")
    seen = counted(monkeypatch, OV, "written")
    got = {(r.a, r.b): r.square for r in OV.overlaps(faces).collect()}
    assert got == {(a, b): 8.0 if a % 2 == b % 2 else 2.0 for a in range(60) for b in range(a + 1, 60) if a % 3 != b % 3}
    assert seen[:2] == [2, 3]
    zones = spark.createDataFrame([(k, [ring(0)]) for k in range(30)], "zone long, parts array<array<struct<x:double,y:double>>>")
    points = spark.createDataFrame([(1, 1.0, 1.0, 5.0), (2, 9.0, 9.0, 1.0)], "id long, x double, y double, value double")
    before = len(seen)
    assert {tuple(r) for r in OV.zone_totals(points, zones).collect()} == {(k, 1, 5.0) for k in range(30)}
    assert seen[before] == 1 and [r.id for r in OV.covered_points(points, zones).collect()] == [1]


def test_grids_and_conflicts_are_not_broadcast(spark):
    for name in ("idw_fill", "dtm_delta"):
        assert "Broadcast" not in registry.queries()[name](spark, SF)._jdf.queryExecution().sparkPlan().toString(), name


def test_crossings_need_no_exchange_of_pairs(spark):
    assert "Deduplicate" not in registry.queries()["segment_hits"](spark, SF)._jdf.queryExecution().analyzed().toString()


def test_faces_are_cut_and_bevelled_once(spark):
    for name in ("clip_faces", "prism_faces"):
        tree = plan(registry.queries()[name](spark, SF)).lower()
        assert not any("filter (" in line and ("aggregate(" in line or "transform(" in line) for line in tree.splitlines()), name
    assert plan(registry.queries()["bevel_corners"](spark, SF)).lower().count("acos(") == 1


def test_faces_of_a_small_file_are_spread(spark):
    for name in ("clip_faces", "clip_split", "prism_faces", "bevel_corners"):
        assert "RepartitionByExpression" in plan(registry.queries()[name](spark, SF)), name


def test_crowded_boxes_are_divided_and_no_pair_of_them_is_sorted(spark, monkeypatch):
    monkeypatch.setattr(S, "MOST_PAIRS", 20)
    targets = [(k, 0.4 + k % 7 / 100, 0.4, 0.5 + k % 7 / 100, 0.5) for k in range(40)]
    covers = [(k, k % 5 / 10, k % 3 / 10, 0.4 + k % 11 / 20, 0.5 + k % 2 / 10) for k in range(90)]
    names = "id long, west double, south double, east double, north double"
    frames = spark.createDataFrame(targets, names), spark.createDataFrame(covers, names)
    held = {t[0]: [c for c in covers if c[1] <= t[1] and c[2] <= t[2] and c[3] >= t[3] and c[4] >= t[4]] for t in targets}
    out = S.smallest_cover(*frames)
    assert {tuple(r) for r in out.collect()} == {(t, min(((c[3] - c[1]) * (c[4] - c[2]), c[0]) for c in cs)[1]) for t, cs in held.items()}
    assert {tuple(r) for r in S.smallest_cover(*frames, order=["id"]).collect()} == {(t, min(c[0] for c in cs)) for t, cs in held.items()}
    sums = [line for line in out._jdf.queryExecution().executedPlan().toString().splitlines() if "min(row_no" in line]
    assert sums and all("HashAggregate" in line for line in sums)


def test_places_are_projected_before_they_are_grouped(spark):
    for name in ("nearest_height", "enriched_heights"):
        trees = plan(registry.queries()[name](spark, SF)).lower()
        grouped = [line for line in trees.splitlines() if "aggregate [" in line]
        assert grouped and not any("sin(" in line for line in grouped), name
    assert "sin(" not in plan(registry.queries()["nearest_height"](spark, SF)).lower()


def test_lines_are_walked_along_once_for_junctions(spark, monkeypatch):
    from urbanframe.operators import strips as ST

    seen, real = [], ST.written
    monkeypatch.setattr(ST, "written", lambda df, name: (seen.append(plan(df)), real(df, name))[1])
    tree = plan(registry.queries()["junction_accounts"](spark, SF))
    assert "Window" not in tree and "Scan" not in tree and len(seen) == 1 and "Union" not in seen[0]


def test_ways_are_gathered_once_for_their_components(spark, monkeypatch):
    from urbanframe.operators import roads as RO

    seen, real = [], RO.written
    monkeypatch.setattr(RO, "written", lambda df, name: (seen.append(name), real(df, name))[1])
    tree = plan(registry.queries()["road_components"](spark, SF))
    assert "Window" not in tree and "collect_list" not in tree and seen == ["ways"]
    rows = spark.createDataFrame([(["1", "2", "3"],), (["3", "4"],), (["7", "7"],), (["8", "9"],)], "refs array<string>")
    (r,) = RO.connectivity(rows).collect()
    assert (r.components, r.ways, r.largest_ways, r.dangling, r.status) == (3, 4, 2, 4, "warn")


def test_chains_pass_python_as_sorted_rows(spark):
    tree = plan(registry.queries()["chain_merge"](spark, SF))
    assert "MapInArrow" in tree and "FlatMapGroups" not in tree


def test_arrays_of_faces_meet_where_they_are_joined(spark, monkeypatch):
    from urbanframe.operators import blocks as BL

    monkeypatch.setattr(BL, "BLOCK", 4)
    monkeypatch.setattr(BL, "MOST_PAIRS", 20, raising=False)
    at = lambda x, y: {"x": float(x), "y": float(y)}
    ring = lambda x: [at(x, 0), at(x + 4, 0), at(x + 4, 2), at(x, 2)]
    place = [0 if k % 5 else (3 if k % 2 else 9) for k in range(70)]
    faces = spark.createDataFrame([(k, k % 3, ring(place[k])) for k in range(70)], "id long, owner long, ring array<struct<x:double,y:double>>")
    sides, real = [], BL.F.broadcast
    monkeypatch.setattr(BL.F, "broadcast", lambda df: (sides.extend(r.side for r in df.collect()), real(df))[1])
    out = OV.overlaps(faces)
    want = {(a, b): 2.0 * max(0, 4 - abs(place[a] - place[b])) for a in range(70) for b in range(a + 1, 70) if a % 3 != b % 3 and abs(place[a] - place[b]) < 4}
    tree = plan(out)
    assert "Repartition 4, true" not in tree and "Repartition 4, false" in tree
    assert sides and max(sides) > 2
    rows = out.collect()
    assert len(rows) == len(want) and {(r.a, r.b): r.square for r in rows} == want


def test_segments_of_the_same_ends_cross_once(spark, monkeypatch):
    from urbanframe.operators import blocks as BL

    ends = [(0.1, 0.3, 17.7, 13.9), (0.7, 14.3, 19.1, 1.9), (9.3, -3.1, 8.7, 21.7), (0.1, 0.3, 3.0, 20.0), (300.0, 0.0, 310.0, 0.0), (11.0, -90.0, 3.1, 95.3)]
    rows = [(k, k % 3, *ends[k * 7 % 6 if k % 4 else k % 2]) for k in range(80)]
    frame = spark.createDataFrame([*rows, (90, 1, None, 0.0, 1.0, 1.0)], "id long, road long, ax double, ay double, bx double, by double")
    want = {}
    for a, ra, ax, ay, bx, by in rows:
        for b, rb, cx, cy, dx, dy in rows[a + 1 :]:
            det = (bx - ax) * (dy - cy) - (by - ay) * (dx - cx)
            if ra == rb or abs(det) <= 1e-12:
                continue
            t, u = ((cx - ax) * (dy - cy) - (cy - ay) * (dx - cx)) / det, ((cx - ax) * (by - ay) - (cy - ay) * (bx - ax)) / det
            if 0.05 < t < 0.95 and 0.05 < u < 0.95:
                want[a, b] = (t, u, ax + t * (bx - ax), ay + t * (by - ay))
    for block, most in ((256, 16_000_000), (4, 20)):
        monkeypatch.setattr(BL, "BLOCK", block)
        monkeypatch.setattr(BL, "MOST_PAIRS", most, raising=False)
        with monkeypatch.context() as m:
            seen = counted(m, S, "written")
            got = S.segment_crossings(frame).collect()
        assert len(got) == len(want) > 500 and {(r.a, r.b): (r.t, r.u, r.x, r.y) for r in got} == want
        assert len(seen) == 1 and (block == 4 or seen == [6])
    rounded = S.segment_crossings(frame, digits=(4, 3)).collect()
    assert all(abs(v - w) < 6e-4 and round(v, 4) == v for r in rounded for v, w in zip((r.t, r.u, r.x, r.y), want[r.a, r.b], strict=True)) and len(rounded) == len(want)
