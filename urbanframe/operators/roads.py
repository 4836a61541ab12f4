"""Road ways: filters, topology, welding, chains and widths."""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from urbanframe.operators.components import connected_components
from urbanframe.operators.spatial import links_within
from urbanframe.operators.staging import written

#: The kinds of road that stay.
KINDS = (
    "motorway", "trunk", "primary", "secondary", "tertiary", "residential", "service", "unclassified", "living_street",
    "motorway_link", "trunk_link", "primary_link", "secondary_link", "tertiary_link",
    "footway", "pedestrian", "path", "cycleway", "track",
)
#: Metres from the middle of a road to its side by kind, and the range that a width is held to.
HALF_WIDTH = {
    "motorway": 5.0, "motorway_link": 3.5, "trunk": 4.5, "trunk_link": 3.0, "primary": 4.0, "primary_link": 2.5,
    "secondary": 3.5, "secondary_link": 2.0, "tertiary": 2.5, "tertiary_link": 1.5, "residential": 2.0, "living_street": 2.0,
    "unclassified": 2.0, "service": 1.5, "track": 1.5, "pedestrian": 2.5, "footway": 0.75, "path": 0.75, "bridleway": 0.75,
    "cycleway": 0.75, "steps": 0.6,
}
HALF_WIDTH_ELSE, LANE_HALF = 1.5, 1.75
RANGES = (
    (("footway", "path", "bridleway", "cycleway"), 0.5, 1.5),
    (("steps",), 0.4, 1.2),
    (("service", "track"), 1.0, 3.0),
    (("residential", "living_street", "unclassified"), 1.2, 3.5),
    (("tertiary", "tertiary_link"), 1.5, 4.5),
    (("secondary", "secondary_link", "primary", "primary_link"), 2.0, 7.5),
    (("trunk", "trunk_link", "motorway", "motorway_link"), 2.5, 8.0),
    (("pedestrian",), 1.0, 4.0),
)
RANGE_ELSE = (0.75, 5.0)
#: Tags that must be the same for two ways to become one.
MERGE_TAGS = ("highway", "lanes", "width", "oneway", "bridge", "tunnel", "layer", "surface")
#: Lower-cased values of a way that goes in one direction.
ONE_WAY = ("yes", "1", "true", "-1")
WELD_M = 1.0
#: Merged ways that a task sends on at once, or more by one cluster.
BATCH = 2_000
#: Begins the names of nodes that tie chains; no way id holds it.
HUB = "\x00node"


def way_reasons(ways: DataFrame, nodes: DataFrame) -> DataFrame:
    """Adds reject_reason to ways (way_id, refs, highway): the first of short, orphan and type, else null."""
    refs = ways.select("way_id", F.explode("refs").alias("id"))
    orphans = refs.join(nodes.select("id"), "id", "left_anti").select("way_id").distinct().withColumn("orphan", F.lit(True))
    reason = (
        F.when(F.coalesce(F.size("refs"), F.lit(0)) < 2, "short")
        .when(F.col("orphan"), "orphan")
        .when(F.col("highway").isNotNull() & ~F.col("highway").isin(*KINDS), "type")
    )
    return ways.join(orphans, "way_id", "left").withColumn("reject_reason", reason).drop("orphan")


def ways_in_box(way_nodes: DataFrame, tags: DataFrame, nodes: DataFrame, box: tuple[float, float, float, float]) -> DataFrame:
    """(way_id, ref, seq, lon, lat): all known nodes of the ways with a highway or building tag and a node in the box.

    way_nodes are (way_id, seq, ref), tags (way_id, highway, building), nodes (id, lon, lat) and the box (west, south, east,
    north), edges included. Refs that no node has are left out.
    """
    west, south, east, north = box
    tagged = tags.filter((F.coalesce("highway", F.lit("")) != "") | (F.coalesce("building", F.lit("")) != "")).select("way_id")
    places = nodes.select(F.col("id").alias("ref"), "lon", "lat")
    inside = places.filter(F.col("lon").between(west, east) & F.col("lat").between(south, north)).select("ref")
    rows = way_nodes.join(tagged, "way_id", "left_semi")
    hit = rows.join(inside, "ref", "left_semi").select("way_id").distinct()
    return rows.join(hit, "way_id", "left_semi").join(places, "ref").select("way_id", "ref", "seq", "lon", "lat")


def half_width(kind: Column, width: Column, lanes: Column) -> Column:
    """Half of the measured width, else of the lanes, else by kind; held to the kind's range."""
    table = F.create_map(*(F.lit(v) for kv in HALF_WIDTH.items() for v in kv))
    own = F.when(width > 0, width * 0.5).when(lanes > 0, lanes * LANE_HALF).otherwise(F.coalesce(table[kind], F.lit(HALF_WIDTH_ELSE)))
    low, high = F.lit(RANGE_ELSE[0]), F.lit(RANGE_ELSE[1])
    for kinds, a, b in RANGES:
        low, high = F.when(kind.isin(*kinds), a).otherwise(low), F.when(kind.isin(*kinds), b).otherwise(high)
    return F.least(high, F.greatest(low, own))


def way_edges(way_nodes: DataFrame) -> DataFrame:
    """(way_id, seq, src, dst): consecutive nodes of ways (way_id, seq, ref)."""
    follow = Window.partitionBy("way_id").orderBy("seq")
    return way_nodes.withColumn("dst", F.lead("ref").over(follow)).filter("dst IS NOT NULL").select("way_id", "seq", F.col("ref").alias("src"), "dst")


def end_degrees(ways: DataFrame) -> DataFrame:
    """(node, degree): how many way ends stand on a node; a closed way counts twice on its own."""
    ends = ways.select(F.explode(F.array(F.element_at("refs", 1), F.element_at("refs", -1))).alias("node"))
    return ends.groupBy("node").agg(F.count("*").alias("degree"))


def connectivity(ways: DataFrame) -> DataFrame:
    """components, largest_share (of ways), dangling ends and the status, for ways (refs) of two nodes or more, which are worked out once."""
    ways = written(ways.select("refs"), "ways")
    steps = lambda from_: F.slice("refs", F.lit(from_), F.size("refs") - 1)
    edges = ways.select(F.explode_outer(F.arrays_zip(steps(1).alias("src"), steps(2).alias("dst"))).alias("e")).select("e.src", "e.dst")
    labels = connected_components(edges)
    first = ways.select(F.element_at("refs", 1).alias("node")).join(labels, "node")
    sizes = first.groupBy("component").agg(F.count("*").alias("ways"))
    one = sizes.agg(F.count("*").alias("components"), F.max("ways").alias("largest_ways"), F.sum("ways").alias("ways"))
    dangling = end_degrees(ways).agg(F.count_if(F.col("degree") == 1).alias("dangling"))
    share = F.col("largest_ways") / F.col("ways")
    out = one.withColumn("k", F.lit(0)).join(dangling.withColumn("k", F.lit(0)), "k")
    return out.select("components", "ways", "largest_ways", share.alias("largest_share"), "dangling", F.when((share < 0.6) & (F.col("components") > 1), "warn").otherwise("pass").alias("status"))


def weld(ways: DataFrame, nodes: DataFrame, radius: float = WELD_M) -> DataFrame:
    """Ways (way_id, refs) with their first and last node put to one for all ends within radius, directly or by steps.

    The representative is the lowest id as a number. If an id isn't a number it is the first in node order, which is the
    column seq of nodes where they have one, else the order of the texts. Adds welded, the number of ends that changed.
    nodes are (id, x, y) in metres; ids are strings.
    """
    ends = ways.select(F.explode(F.array(F.element_at("refs", 1), F.element_at("refs", -1))).alias("id")).distinct().join(nodes, "id")
    ends = ends if "seq" in nodes.columns else ends.withColumn("seq", F.lit(0))
    labels = connected_components(links_within(ends, radius))
    number = F.col("node").try_cast("long")
    placed = labels.join(ends.select(F.col("id").alias("node"), "seq"), "node")
    chosen = placed.groupBy("component").agg(F.min(F.struct(number.alias("n"), F.col("node"))).alias("low"), F.min(F.struct("seq", "node")).alias("first"), F.count_if(number.isNull()).alias("others"))
    rep = labels.join(chosen, "component").select("node", F.when(F.col("others") == 0, F.col("low.node")).otherwise(F.col("first.node")).alias("rep"))
    out = ways.withColumns({"__a": F.element_at("refs", 1), "__b": F.element_at("refs", -1)})
    for end in ("__a", "__b"):
        out = out.join(rep.select(F.col("node").alias(end), F.col("rep").alias(f"{end}_rep")), end, "left").withColumn(f"{end}_new", F.coalesce(f"{end}_rep", end))
    middle = F.slice("refs", F.lit(2), F.greatest(F.size("refs") - 2, F.lit(0)))
    refs = F.concat(F.array("__a_new"), middle, F.array("__b_new"))
    welded = (F.col("__a") != F.col("__a_new")).cast("int") + (F.col("__b") != F.col("__b_new")).cast("int")
    return out.select(*[c for c in ways.columns if c != "refs"], refs.alias("refs"), welded.alias("welded"))


def _one_way(value: str | None) -> bool:
    return (value or "").lower() in ONE_WAY


def _chained(rows: list[tuple[str, list[str]]], reversible: bool, meeting: set[str]) -> list[tuple[str, list[str], list[str]]]:
    """Ways in order, merged greedily at ends that exactly two different open ways share; (id, refs, ids merged into it).

    Ends join only at meeting nodes, of which all open ways must be among the rows.
    """
    ways = {way: (list(refs), [way]) for way, refs in rows}
    order = {way: k for k, way in enumerate(ways)}
    uses: dict[str, dict[tuple[int, bool], str]] = {}  # of each node: place of the way and whether it is its last end
    heap: list[tuple[tuple[int, bool], str]] = []  # nodes by their first use; old entries stay until they come up

    def ends(way: str) -> list[tuple[str, tuple[int, bool]]]:
        refs = ways[way][0]
        both = [(refs[0], (order[way], False)), (refs[-1], (order[way], True))] if len(refs) >= 2 and refs[0] != refs[-1] else []
        return [end for end in both if end[0] in meeting]

    def add(way: str) -> None:
        for node, use in ends(way):
            uses.setdefault(node, {})[use] = way

    def look(nodes: Iterable[str]) -> None:
        for node in nodes:
            if len(uses.get(node, ())) == 2:
                heapq.heappush(heap, (min(uses[node]), node))

    for way in ways:
        add(way)
    look(uses)
    while heap:
        first, node = heapq.heappop(heap)
        two = sorted(uses.get(node, ()))
        if len(two) != 2 or two[0] != first:
            continue
        a, b = uses[node][two[0]], uses[node][two[1]]
        a_first, b_first = not two[0][1], not two[1][1]
        x, y = ways[a][0], ways[b][0]
        if a_first != b_first:
            refs = y + x[1:] if a_first else x + y[1:]
        elif reversible:
            refs = y[::-1] + x[1:] if a_first else x + y[::-1][1:]
        else:
            continue
        changed = ends(a) + ends(b)
        for end, use in changed:
            del uses[end][use]
        ways[a] = (refs, ways[a][1] + ways.pop(b)[1])
        add(a)
        look({end for end, _ in changed})

    return [(way, refs, merged) for way, (refs, merged) in ways.items()]


def _linked(nodes: DataFrame) -> DataFrame:
    """(src, dst) of the nodes (one_way, x, y) at which x and y can follow each other; x and y are struct<id, last>."""
    return nodes.filter(~F.col("one_way") | (F.col("x.last") != F.col("y.last"))).select(F.col("x.id").alias("src"), F.col("y.id").alias("dst"))


def chain_clusters(ways: DataFrame) -> DataFrame:
    """(way_id, cluster, meeting): the ways that can take part in a merge, and which of them must be looked at together.

    ways are (way_id, g, a, b, one_way): a group of the same tags, the nodes of both ends, whether it can't be turned round;
    ids are unique and a isn't b. meeting are the end nodes of a way that can join. Two ends at a node with no third make a
    chain, whatever the order of merges is. The order counts only where a chain comes back to a node N that has more ends: it
    closes there and N loses two ends. If two others are then left they join, and if only closed chains meet in N, the last of
    them closes elsewhere. So such nodes tie their chains to a cluster, and joined chains may close in turn: as many
    rounds as loops are nested. Crossings of more ends tie nothing, so a cluster is a chain with the loops on it, not a network.
    """
    ends = ways.select("g", "one_way", F.col("way_id").alias("id"), F.explode(F.array(F.struct(F.col("a").alias("node"), F.lit(False).alias("last")), F.struct(F.col("b").alias("node"), F.lit(True).alias("last")))).alias("e"))
    ends = written(ends.select("g", "one_way", "id", "e.node", "e.last"), "chain-ends")
    end = F.struct("id", "last")
    nodes = ends.groupBy("g", "node").agg(F.count("*").alias("n"), F.first("one_way").alias("one_way"), F.min(end).alias("x"), F.max(end).alias("y"))
    free = ~F.col("one_way") | (F.col("x.last") != F.col("y.last"))
    plain = written(nodes.filter((F.col("n") == 2) & free).drop("n"), "chain-nodes")
    ties, meeting = _linked(plain), plain.select("g", "node")
    labels = clusters = connected_components(ties)
    rest = ends.join(meeting, ["g", "node"], "left_anti")
    closed = lambda rows: rows.groupBy("g", "node", "id").agg(F.count("*").alias("n"), F.first("one_way").alias("one_way"), F.max("last").alias("last"))
    chained = None
    while True:
        # only what was joined can come back to a node, so the ends of single ways are looked at only where a chain does
        named = rest.join(labels.withColumnRenamed("node", "id"), "id").withColumn("id", F.col("component")).drop("component")
        if chained is not None:
            again = chained.join(labels.withColumnRenamed("node", "id"), "id", "left").withColumn("id", F.coalesce("component", "id")).drop("component")
            named = named.unionByName(again)
        chained = written(named, "chain-ends")
        single = rest.join(labels.select(F.col("node").alias("id")), "id", "left_anti")
        looped = closed(chained).filter("n = 2").select("g", "node").distinct()
        both = closed(chained.join(looped, ["g", "node"], "left_semi").unionByName(single.join(looped, ["g", "node"], "left_semi")))
        other = F.when(F.col("n") == 1, end)
        sums = both.groupBy("g", "node").agg(F.count_if(F.col("n") == 2).alias("loops"), F.count_if(F.col("n") == 1).alias("others"), F.first("one_way").alias("one_way"), F.min(other).alias("x"), F.max(other).alias("y"))
        hubs = written(sums.filter((F.col("loops") > 0) & ((F.col("others") == 2) | (F.col("others") == 0) & (F.col("loops") > 1))), "chain-hubs")
        if hubs.isEmpty():
            break
        at, rest = hubs.select("g", "node"), written(single, "chain-ends")
        tied = chained.unionByName(rest).join(at, ["g", "node"]).select(F.col("id").alias("src"), F.concat_ws("/", F.lit(HUB), "g", "node").alias("dst"))
        ties, meeting, clusters = ties.union(tied), meeting.union(at), None
        labels = connected_components(_linked(hubs.filter("others = 2")))
        chained, rest = (rows.join(at, ["g", "node"], "left_anti") for rows in (chained, rest))
    clusters = connected_components(ties) if clusters is None else clusters
    by_way = ends.join(meeting, ["g", "node"]).groupBy("id").agg(F.collect_set("node").alias("meeting"))
    return by_way.join(clusters.withColumnRenamed("node", "id"), "id").select(F.col("id").alias("way_id"), F.col("component").alias("cluster"), "meeting")


def merge_chains(ways: DataFrame) -> DataFrame:
    """Ways (way_id, refs, MERGE_TAGS) with chains of the same tags made one: adds merged, the number of ways in each.

    Only ends within the same tags count, and way ids are unique. The result is that of merging one pair at a time, in way
    order. Ways that nothing can join pass through without Python, as do closed ways and those without refs; of the rest a
    task reads sorted rows and holds one cluster at a time, which is little more than the row that comes of it.
    """
    tags = [F.coalesce(F.col(t), F.lit("")).alias(t) for t in MERGE_TAGS]
    own = {"g": F.sha2(F.to_json(F.array(*MERGE_TAGS)), 256), "a": F.try_element_at("refs", F.lit(1)), "b": F.try_element_at("refs", F.lit(-1)), "one_way": F.lower("oneway").isin(*ONE_WAY)}
    base = written(ways.select("way_id", "refs", *tags).withColumns(own), "chain-ways")
    found = written(chain_clusters(base.filter((F.size("refs") >= 2) & (F.col("a") != F.col("b"))).select("way_id", *own)), "chain-clusters")
    columns = ["way_id", "refs", *MERGE_TAGS]
    schema = ", ".join(["way_id string", "refs array<string>", *(f"{t} string" for t in MERGE_TAGS), "merged int"])
    oneway = columns.index("oneway")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
        out: list[tuple] = []
        for _, group in groupby(rows, itemgetter(-1)):
            held = list(group)
            first = held[0]
            chains = _chained([r[:2] for r in held], not _one_way(first[oneway]), {node for r in held for node in r[-2]})
            out += [(w, refs, *first[2:-2], len(m)) for w, refs, m in chains]
            if len(out) >= BATCH:
                yield _batch(out)
                out = []
        if out:
            yield _batch(out)

    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.string(), pa.list_(pa.string()), *(pa.string() for _ in MERGE_TAGS), pa.int32()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], [*columns, "merged"])

    alone = base.join(found, "way_id", "left_anti").select(*columns, F.lit(1).alias("merged"))
    tied = base.select(*columns).join(found, "way_id").select(*columns, "meeting", "cluster").repartition(F.col("cluster")).sortWithinPartitions("cluster", "way_id")
    return alone.unionByName(tied.mapInArrow(run, schema))


def along(points: DataFrame, road: str = "road", order: str = "seq") -> DataFrame:
    """Adds step, travelled (length up to a point) and the tangent tx, ty to the points (road, seq, x, y) of polylines.

    The tangent is the central difference, one-sided at both ends, of length 1; null where the neighbours coincide.
    """
    w = Window.partitionBy(road).orderBy(order)
    before = lambda c: F.coalesce(F.lag(c).over(w), F.col(c))
    after = lambda c: F.coalesce(F.lead(c).over(w), F.col(c))
    out = points.withColumns({"step": F.hypot(F.col("x") - before("x"), F.col("y") - before("y")), "__dx": after("x") - before("x"), "__dy": after("y") - before("y")})
    size = F.hypot("__dx", "__dy")
    return out.withColumns({
        "travelled": F.sum("step").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        "tx": F.when(size > 0, F.col("__dx") / size),
        "ty": F.when(size > 0, F.col("__dy") / size),
    }).drop("__dx", "__dy")


#: Fixed value: shorter segments give no surface.
LEAST_SEGMENT_M = 0.25


def long_segments(points: DataFrame, least: float = LEAST_SEGMENT_M) -> DataFrame:
    """(road, seq, ax, ay, bx, by, length) between the points (road, seq, x, y) of polylines and the next; short ones are left out.

    Points without a place count as points, so that the segments at them are left out too.
    """
    w = Window.partitionBy("road").orderBy("seq")
    ends = points.select("road", "seq", F.col("x").alias("ax"), F.col("y").alias("ay"), F.lead("x").over(w).alias("bx"), F.lead("y").over(w).alias("by"))
    return ends.withColumn("length", F.hypot(F.col("bx") - F.col("ax"), F.col("by") - F.col("ay"))).filter(F.col("length") >= least)


def junctions(points: DataFrame) -> DataFrame:
    """(jx, jy, uses): whole-metre places (half to even) that vertices stand on twice or more."""
    return points.groupBy(F.bround("x").alias("jx"), F.bround("y").alias("jy")).agg(F.count("*").alias("uses")).filter("uses >= 2")


def split_at(points: DataFrame, marked: str = "is_junction") -> DataFrame:
    """Adds chunk to the points (road, seq) of polylines cut at marked vertices; such a vertex ends one chunk and begins the next."""
    w = Window.partitionBy("road").orderBy("seq")
    inner = F.col(marked) & (F.row_number().over(w) > 1) & F.lead(F.lit(1)).over(w).isNotNull()
    cut = points.withColumn("__cut", inner)
    base = cut.withColumn("chunk", F.sum(F.col("__cut").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    both = F.when(F.col("__cut"), F.array(F.col("chunk") - 1, F.col("chunk"))).otherwise(F.array("chunk"))
    return base.withColumn("chunk", F.explode(both)).drop("__cut")


def collapsed(points: Column, eps: float) -> Column:
    """An array of struct<x,y> without points nearer than eps to the last one kept."""
    start = F.slice(points, 1, 1)
    far = lambda kept, p: F.hypot(F.element_at(kept, -1)["x"] - p["x"], F.element_at(kept, -1)["y"] - p["y"]) >= eps
    return F.aggregate(F.slice(points, F.lit(2), F.greatest(F.size(points) - 1, F.lit(0))), start, lambda kept, p: F.when(far(kept, p), F.concat(kept, F.array(p))).otherwise(kept))

