"""Operators that depend on an order, against plain sequential versions."""

import math
import random
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from urbanframe.operators import roads as R, spatial as S
from urbanframe.plans import road_plans
from urbanframe.plans.layers import layer, planar, ways

SF = "/root/testdata/sf0.001"


TAGS = ("highway", "lanes", "width", "oneway")


def _all_ways(spark):
    return sorted((r.way_id, tuple(r[t] or "" for t in TAGS), list(r.refs)) for r in ways(spark, SF).collect() if r.refs and len(r.refs) >= 2)


def _merged(rows, reversible=True):
    """One pair at a time, looking at all ways again after each."""
    found = {way: (refs, 1) for way, refs in rows}
    while True:
        uses = defaultdict(list)
        for way, (refs, _) in found.items():
            if refs[0] != refs[-1]:
                uses[refs[0]].append((way, True))
                uses[refs[-1]].append((way, False))
        two = next((v for v in uses.values() if len(v) == 2 and v[0][0] != v[1][0] and (reversible or v[0][1] != v[1][1])), None)
        if two is None:
            return [(way, refs, n) for way, (refs, n) in found.items()]
        (a, a_first), (b, b_first) = two
        (x, n), (y, m) = found[a], found.pop(b)
        y = y if a_first != b_first else y[::-1]
        found[a] = (y + x[1:] if a_first else x + y[1:], n + m)


def test_chains_of_all_ways(spark):
    groups = defaultdict(list)
    for way, tags, refs in _all_ways(spark):
        groups[tags].append((way, refs))
    expected = [(way, tags[0], len(refs), m) for tags, rows in groups.items() for way, refs, m in _merged(rows, tags[3] != "yes")]
    got = [tuple(r) for r in road_plans.chain_merge(spark, SF).select("way_id", "highway", "n_refs", "merged").collect()]
    key = lambda r: tuple(map(str, r))
    assert sorted(((w, h or "", n, m) for w, h, n, m in got), key=key) == sorted(expected, key=key) and max(m for *_, m in got) > 1


def test_chains_with_tags_and_one_ways(spark):
    rng = random.Random(11)
    rows = [(f"w{k:03d}", [str(rng.randrange(90)) for _ in range(rng.randint(2, 4))], rng.choice(["primary", "service"]), rng.choice([None, "2"]), rng.choice([None, "", "yes", "-1", "no"])) for k in range(260)]
    df = spark.createDataFrame(rows, "way_id string, refs array<string>, highway string, lanes string, oneway string")
    for t in R.MERGE_TAGS:
        if t not in df.columns:
            df = df.withColumn(t, F.lit(None).cast("string"))
    groups = defaultdict(list)
    for way, refs, highway, lanes, oneway in sorted(rows):
        groups[highway, lanes or "", oneway or ""].append((way, refs))
    expected = [(way, refs, m) for tags, group in groups.items() for way, refs, m in _merged(group, tags[2] not in ("yes", "-1"))]
    got = [(r.way_id, list(r.refs), r.merged) for r in R.merge_chains(df).collect()]
    assert sorted(got) == sorted(expected) and max(m for *_, m in got) > 2


def _way_table(spark, rows):
    df = spark.createDataFrame(rows, "way_id string, refs array<string>, highway string, oneway string")
    return df.withColumns({t: F.lit(None).cast("string") for t in R.MERGE_TAGS if t not in df.columns})


def test_chains_that_close_in_many_small_networks(spark):
    rng = random.Random(16)
    rows = []
    for net in range(400):
        nodes = rng.randint(2, 9)
        for _ in range(rng.randint(1, 14)):
            rows.append((f"w{rng.randrange(10**9):09d}", [str(rng.randrange(nodes)) for _ in range(rng.choice([2, 2, 2, 3]))], f"net{net}", rng.choice(["yes", "-1"]) if net % 4 == 0 else None))
    for net, loops in enumerate(([(0, 1), (1, 2), (2, 0), (0, 3), (3, 4), (4, 0)], [(0, 1), (1, 2), (2, 1), (1, 3)], [(0, 1), (1, 2), (2, 1), (1, 3), (3, 4), (4, 3), (3, 0), (5, 0), (0, 6)])):
        for turn in range(30):  # the same loops with ways named in other orders
            names = rng.sample(range(10**6), len(loops))
            rows += [(f"x{n:06d}", [str(a), str(b)] if rng.random() < 0.5 else [str(b), str(a)], f"loops{net}/{turn}", None) for n, (a, b) in zip(names, loops, strict=True)]
    groups = defaultdict(list)
    for way, refs, highway, oneway in sorted(rows):
        groups[highway, oneway].append((way, refs))
    expected = [(way, refs, m) for tags, group in groups.items() for way, refs, m in _merged(group, tags[1] is None)]
    got = [(r.way_id, list(r.refs), r.merged) for r in R.merge_chains(_way_table(spark, rows)).collect()]
    assert sorted(got) == sorted(expected) and sum(refs[0] == refs[-1] and m > 1 for _, refs, m in expected) > 100


def test_chains_of_a_city_stay_small_groups(spark):
    n = 12  # a grid of crossings, each street of three ways between them
    streets = [((x, y), (x + i, y + 1 - i)) for x in range(n) for y in range(n) for i in (0, 1) if max(x + i, y + 1 - i) < n]
    rows = [(f"w{k:05d}/{p}", [f"{a if p == 0 else (a, b, p)}", f"{b if p == 2 else (a, b, p + 1)}"], "primary", None) for k, (a, b) in enumerate(streets) for p in range(3)]
    ways = _way_table(spark, rows)
    found = R.chain_clusters(ways.selectExpr("way_id", "'g' AS g", "refs[0] AS a", "refs[1] AS b", "false AS one_way")).groupBy("cluster").count().collect()
    assert max(r["count"] for r in found) == 6 and sum(r["count"] > 3 for r in found) == 4  # only the corners have two ends
    assert Counter(r.merged for r in R.merge_chains(ways).collect()) == {3: len(streets) - 8, 6: 4}


def test_ways_that_nothing_joins_pass(spark):
    rows = [("a", None, "primary", None), ("b", [], "primary", None), ("c", ["1"], "primary", None), ("d", ["1", "2", "1"], "primary", None), ("e", ["1", "3"], None, None), ("f", ["1", "9"], "", None)]
    got = {r.way_id: (r.refs, r.merged) for r in R.merge_chains(_way_table(spark, rows)).collect()}
    assert got == {"a": (None, 1), "b": ([], 1), "c": (["1"], 1), "d": (["1", "2", "1"], 1), "e": (["9", "1", "3"], 2)}
    assert R.merge_chains(_way_table(spark, rows).limit(0)).count() == 0


def test_near_copies_in_rounds_and_in_one_task(spark):
    rng = random.Random(12)
    points = [(k, rng.uniform(0, 60), rng.uniform(0, 60)) for k in range(400)] + [(1000 + k, 100.0 + k, 5.0) for k in range(40)]
    kept = []
    for p in points:
        if all(math.hypot(p[1] - q[1], p[2] - q[2]) >= 3 for q in kept):
            kept.append(p)
    df = spark.createDataFrame(points, "id long, x double, y double")
    pairs = S.within_distance(df, df, 3.0, strict=True).filter("left_id < right_id").select(F.col("left_id").alias("earlier"), F.col("right_id").alias("later"))
    for few in (0, 60, 10**6):
        assert sorted(r.id for r in S.keep_first(df, pairs, few=few).collect()) == [p[0] for p in kept]


def test_added_cover_against_a_plain_loop(spark):
    rng = random.Random(13)
    cut = lambda v: int(v / 15)
    primary = [(k, rng.uniform(-200, 200), rng.uniform(-200, 200)) for k in range(30)]
    extra = [(k, rng.uniform(-200, 200), rng.uniform(-200, 200)) for k in range(300)]
    held, kept = {(cut(x), cut(y)) for _, x, y in primary}, []
    for k, x, y in extra:
        if not any((cut(x) + i, cut(y) + j) in held for i in (-1, 0, 1) for j in (-1, 0, 1)):
            held.add((cut(x), cut(y)))
            kept.append(k)
    names = "id long, x double, y double"
    got = S.uncovered(spark.createDataFrame(extra, names), spark.createDataFrame(primary, names), 15.0)
    assert sorted(r.id for r in got.collect()) == kept


def test_collapse_against_a_plain_loop(spark):
    rng = random.Random(14)
    lines = [(k, [{"x": rng.uniform(0, 5), "y": rng.uniform(0, 5)} for _ in range(rng.randint(0, 30))]) for k in range(60)]
    df = spark.createDataFrame(lines, "road long, p array<struct<x:double,y:double>>")
    for r in df.select("road", R.collapsed(F.col("p"), 1.5).alias("kept")).collect():
        kept = []
        for p in lines[r.road][1]:
            if not kept or math.hypot(p["x"] - kept[-1][0], p["y"] - kept[-1][1]) >= 1.5:
                kept.append((p["x"], p["y"]))
        assert [(p.x, p.y) for p in r.kept] == kept


def test_welds_of_all_ways(spark):
    rows = _all_ways(spark)
    used = {e for _, _, refs in rows for e in (refs[0], refs[-1])}
    at = [(r.id, r.x, r.z) for r in planar(layer(spark, SF, "nodes")).collect() if r.id in used]
    rep = {i: i for i, *_ in at}
    for i, x, z in at:
        for j, u, w in at:
            if (x - u) ** 2 + (z - w) ** 2 <= 400 and rep[i] != rep[j]:
                low, high = sorted((rep[i], rep[j]), key=int)
                rep = {k: low if v == high else v for k, v in rep.items()}
    expected = [(way, rep.get(refs[0], refs[0]), rep.get(refs[-1], refs[-1]), len(refs)) for way, _, refs in rows]
    got = [tuple(r) for r in road_plans.weld_ends(spark, SF).select("way_id", "a", "b", "n").collect()]
    assert Counter(got) == Counter(expected)


def test_components_of_all_ways(spark):
    (r,) = road_plans.road_components(spark, SF).collect()
    assert r.ways == len(_all_ways(spark))


def test_heights_of_all_parts(spark):
    from urbanframe.plans import raster_plans

    parts = layer(spark, SF, "bld").count()
    assert raster_plans.heightmap(spark, SF).count() == -(-parts // 8) * 21 // 8 * 21


def test_crossings_put_into_lines_against_a_plain_loop(spark):
    from urbanframe.operators import strips as ST

    rng = random.Random(15)
    at = lambda: rng.choice([rng.uniform(0, 2), 1.0])
    points = [(road, seq, at(), at()) for road in range(25) for seq in range(1, rng.randint(2, 9))]
    crossings = [(road, seq, t / 5, at(), at()) for road, seq, *_ in points for t in rng.sample(range(1, 5), rng.randint(0, 2))]
    expected = {}
    for road in {p[0] for p in points}:
        kept = []
        for _, seq, x, y in sorted(p for p in points if p[0] == road):
            for eps, u, v in [(0.05, x, y)] + [(0.25, c[3], c[4]) for c in sorted(crossings) if c[:2] == (road, seq)]:
                if not kept or math.hypot(kept[-1][0] - u, kept[-1][1] - v) >= eps:
                    kept.append((u, v))
        expected[road] = [(k + 1, *p) for k, p in enumerate(kept)]
    names = "x double, y double"
    got = defaultdict(list)
    for r in ST.with_crossings(spark.createDataFrame(points, f"road int, seq int, {names}"), spark.createDataFrame(crossings, f"road int, seq int, t double, {names}")).collect():
        got[r.road].append((r.seq, r.x, r.y))
    assert {k: sorted(v) for k, v in got.items()} == expected


def test_junction_hulls_against_all_pairs(spark):
    """Hulls of random ends, many of them on one line or twice in one place: a side has every other point to its left or within it."""
    import random

    from urbanframe.operators import strips as ST

    rnd = random.Random(5)

    def corners(points):
        unique = {(round(x * 100), round(y * 100)) for x, y in points}
        turn = lambda a, b, o: (b[0] - a[0]) * (o[1] - a[1]) - (b[1] - a[1]) * (o[0] - a[0])
        within = lambda a, b, o: (o[0] - a[0]) * (o[0] - b[0]) + (o[1] - a[1]) * (o[1] - b[1]) <= 0
        sides = [(a, b) for a in unique for b in unique if a != b and all((t := turn(a, b, o)) > 0 or (t == 0 and within(a, b, o)) for o in unique)]
        return {a for a, _ in sides}, sum(a[0] * b[1] - b[0] * a[1] for a, b in sides) / 2e4

    rows, expected = [], {}
    for j in range(300):
        step = rnd.choice([1.0, 0.25, 0.01])
        points = [(rnd.randrange(4) * step + 1000 * j, rnd.randrange(4) * step) for _ in range(rnd.randrange(3, 9))]
        hull, square_m = corners(points)
        got = ST.convex_hull(points)
        assert {(round(x * 100), round(y * 100)) for x, y in got} == (hull or {(round(x * 100), round(y * 100)) for x, y in points})
        expected[j] = ("small", None, None) if len(hull) < 3 else (None, round(square_m, 6), len(hull))
        rows += [(j, 0, *p, 4.0) for p in points]
    found = ST.junction_fills(spark.createDataFrame(rows, "jx int, jy int, x double, y double, half_width double"))
    assert {r.jx: (r.reason, r.square_m and round(r.square_m, 6), r.corners) for r in found.collect()} == expected
    counts = ST.junction_accounts(found).first()
    assert counts.total == 300 and counts.fills + counts.small == 300 and counts.complex == 0
    assert ST.junction_accounts(found.filter("jx < 0")).first().asDict() == {"fills": 0, "small": 0, "complex": 0, "radius": 0, "area": 0, "total": 0}
