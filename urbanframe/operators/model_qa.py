"""Checks of models: rules on the rows of a table, all counted in one pass, as rows (check, status, message) that roll up.

A rule names conditions of a row that fail it or that only warn. All conditions of all rules of a table become counts of
one aggregation, whatever their number; the statuses follow from the counts. Faces, normals, colours, tags, matches and
depths below the terrain are such tables.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from urbanframe.functions import geometry as G
from urbanframe.operators.quality import FACE_LIMITS, RANK

Counts = dict[str, Column]


@dataclass(frozen=True)
class Rule:
    """A check of the rows in scope.

    fail and warn are named conditions; more rows than the shares of those in scope must meet one (null meets none). holds
    is a condition on the counts, by name and ``n``, without which the check warns. Without rows in scope it is ``empty``;
    null leaves the check out. says are the messages of a pass, a warning and a failure.
    """

    check: str
    fail: dict[str, Column] = field(default_factory=dict)
    warn: dict[str, Column] = field(default_factory=dict)
    says: tuple[str, str, str] = ("as expected", "unusual", "invalid")
    scope: Column | None = None
    share: float = 0.0
    holds: Callable[[Counts], Column] | None = None
    counts: dict[str, Column] = field(default_factory=dict)
    empty: str | None = "warn"


def check_rows(table: DataFrame, rules: list[Rule], by: list[str] | None = None) -> DataFrame:
    """(by, check, status, message, n, failed, warned, counts) for each rule, for the whole table or each group of it.

    failed and warned add up the conditions, so a row can count several times; counts has each by its name. A table
    without rows gives the rules' empty status, unless it is checked by groups.
    """
    sums, rows = [], []
    for k, rule in enumerate(rules):
        scope = F.lit(True) if rule.scope is None else F.coalesce(rule.scope, F.lit(False))
        named = {**rule.fail, **rule.warn, **rule.counts}
        n = F.col(f"n{k}")
        sums += [F.count_if(scope).alias(f"n{k}"), *(F.count_if(scope & F.coalesce(c, F.lit(False))).alias(f"n{k}_{j}") for j, c in enumerate(named.values()))]
        count = {name: F.col(f"n{k}_{j}") for j, name in enumerate(named)}
        total = lambda names, c=count: sum((c[x] for x in names), F.lit(0).cast("long"))
        warned = F.lit(False)
        for name in rule.warn:
            warned = warned | (count[name] > rule.share * n)
        if rule.holds is not None:
            warned = warned | ~F.coalesce(rule.holds({**count, "n": n}), F.lit(False))
        status = F.when(n == 0, F.lit(rule.empty)).when(total(rule.fail) > 0, "fail").when(warned, "warn").otherwise("pass")
        message = F.when(n == 0, "nothing to check").when(status == "fail", rule.says[2]).when(status == "warn", rule.says[1]).otherwise(rule.says[0])
        every = F.create_map(*(x for name, c in count.items() for x in (F.lit(name), c))) if count else F.create_map().cast("map<string,bigint>")
        rows.append(F.struct(F.lit(rule.check).alias("check"), status.alias("status"), message.alias("message"), n.alias("n"), total(rule.fail).alias("failed"), total(rule.warn).alias("warned"), every.alias("counts")))
    one = table.groupBy(*(by or [])).agg(*sums)
    return one.select(*(by or []), F.inline(F.array(*rows))).filter("status IS NOT NULL")


def roll_up(checks: DataFrame) -> DataFrame:
    """One row: the worst status of all checks, and how many there are of each."""
    rank = F.create_map(*(F.lit(x) for kv in RANK.items() for x in kv))[F.col("status")]
    worst = F.element_at(F.array(*map(F.lit, RANK)), F.coalesce(F.max(rank), F.lit(0)) + 1)
    return checks.agg(worst.alias("status"), *(F.count_if(F.col("status") == s).alias(f"n_{s}") for s in RANK))


def face_measures(faces: DataFrame) -> DataFrame:
    """Adds square_m, aspect, angle, crossings and verts to faces (ring, any others), each worked out once."""
    r = F.col("ring")
    measures = {"square_m": G.area(r), "aspect": G.aspect_ratio(r), "angle": F.array_min(G.interior_angles(r)), "crossings": G.self_crossings(r), "verts": F.size(r)}
    return faces.withColumns(measures)


def face_rules(check: str, scope: Column | None = None) -> Rule:
    """Of measured faces (closed, any others): open, large, many-cornered, long, sharp or self-crossing ones."""
    c, limit = F.col, FACE_LIMITS
    fail = {
        "open": ~c("closed"), "large_fail": c("square_m") > limit["area"][1], "many_corners": c("verts") > limit["verts"][0], "long_fail": c("aspect") > limit["aspect"][1],
        "sharp_fail": c("angle") < limit["angle"][1], "crossed": c("crossings") > 0,
    }
    warn = {"large": c("square_m") > limit["area"][0], "long": c("aspect") > limit["aspect"][0], "sharp": c("angle") < limit["angle"][0]}
    return Rule(check, fail, warn, ("faces look bounded", "unusual face shapes", "invalid faces"), scope, empty="fail")


def terrain_rule(check: str, share: float, least: float = -0.05, scope: Column | None = None) -> Rule:
    """Of points (delta above the terrain, null where none was hit): none is below least, and few miss it."""
    says = ("terrain placement is within the threshold", "many points miss the terrain", "points below the terrain threshold")
    return Rule(check, {"below": F.col("delta") < least}, {"misses": F.col("delta").isNull()}, says, scope, share)


def building_rules() -> list[Rule]:
    """Of building parts: kind (body or foundation), colour, body_colour, bevels, shortest, normal_state, tag, best, gap.

    best is the cosine to the normal of the nearest side of the body, gap the distance of a foundation's top to it; both
    are null where there is none or nothing is compared.
    """
    c = F.col
    foundation = c("kind") == "foundation"
    return [
        Rule("building_color", {"differs": c("colour") != c("body_colour")}, {"none": c("colour").isNull()}, ("colours match", "parts without a colour", "a part's colour differs from its body's")),
        Rule("footprint_bevel", {"short": c("shortest") < 0.08}, {}, ("corners were bevelled", "no corner was bevelled", "bevels left too short edges"), c("kind") == "body", holds=lambda n: n["bevelled"] > 0, counts={"bevelled": c("bevels") > 0}, empty="fail"),
        Rule("building_normals", {s: c("normal_state") == s for s in ("missing", "zero", "mismatch", "degenerate")}, {}, ("normals are valid", "", "normals are invalid"), empty="fail"),
        Rule("foundation_tags", {"wrong": ~c("tag").eqNullSafe(foundation.cast("int"))}, {}, ("tags match the parts", "", "tags don't match the parts"), empty="fail"),
        Rule("foundation_normals", {"mismatch": c("best") <= 0.8}, {"no_match": c("best").isNull()}, ("sides align with the body", "sides without a body near", "sides disagree with the body"), foundation),
        Rule("foundation_alignment", {"offset": c("gap") > 0.03}, {}, ("tops match the body", "no tops", "tops are offset from the body"), foundation & c("gap").isNotNull()),
    ]


def density_rule() -> Rule:
    """Of terrain points (layer raw or fine): the fine layer has more."""
    layer = F.col("layer")
    return Rule("terrain_density", {}, {}, ("terrain is subdivided", "the fine terrain is no denser", ""), holds=lambda n: n["fine"] > n["raw"], counts={"raw": layer == "raw", "fine": layer == "fine"})


def strategies(faces: DataFrame) -> DataFrame:
    """(strategy, n, max_square_m, max_aspect, max_verts, least_angle) of measured junction faces; faces without one are left out."""
    kept = faces.filter("strategy IS NOT NULL").groupBy("strategy")
    return kept.agg(F.count("*").alias("n"), F.max("square_m").alias("max_square_m"), F.max("aspect").alias("max_aspect"), F.max("verts").alias("max_verts"), F.min("angle").alias("least_angle"))
