"""SimHash near-dedup by vantage-point trees over fingerprints.

Fingerprints that differ in few bits are found exactly, and only distinct ones are compared. A vantage-point tree splits
fingerprints by their Hamming distance to a vantage point: within its radius, or beyond. By the triangle inequality
whatever lies within ``bits`` of a fingerprint can only be on the sides that the ball of that size around it touches, so
the other branches are pruned.

In 64 bits alone most distances are near 32 and nearly every ball touches both sides. So there is a tree for each of
``bits + 1`` blocks of bits, with the Hamming distance in that block: linked fingerprints agree in one block, where the
ball shrinks to radius 0 and touches one side of every vantage point; the finest such partition has a shard for each
value of the block. A shard with too many fingerprints for a task is split further by a tree with the full distance,
made from a bounded sample of it: a fingerprint lives in one part, and is a query in every part that its ball of radius
``bits`` touches. Tasks then search the trees of their parts. They join what is linked and send a spanning forest, not
all pairs, and components are taken over these links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from urbanframe.llm.common import remove, slices, table, written
from urbanframe.operators.components import connected_components

SHINGLE, BITS, SEED = 4, 4, 42
#: Bits of a block that name a shard at most.
WIDEST = 20
#: Shingles whose bits a task counts at a time, and texts that it holds.
BLOCK, TEXTS = 1 << 15, 100
#: Fingerprints that live in a part of a shard, as far as a sample can tell.
MOST = 1 << 14
#: Fingerprints that the tree of a large shard is made from, of one and of all shards, and the fewest for each of its parts.
SAMPLE, SAMPLES, EACH = 1 << 11, 1 << 22, 4
#: Leaves of the trees inside tasks, queries that go down them together, and the least share of a split that is worth it.
LEAF, QUERIES, LEAST_SIDE = 512, 1 << 12, 1 / 32
#: Fingerprints that are compared with a leaf at a time are such that there are so many pairs.
PAIRS = 1 << 18


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """Bit k is set if it is set in over half of the XXH64 hashes of the runs of ``size`` words, repeats included.

    Words are runs of characters other than the ASCII blanks, with A-Z lower-cased; fewer words are one run; none give 0.
    """
    words = text.encode().lower().split() if text else []  # bytes: A-Z and the six ASCII blanks only
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    size = min(size, len(words))
    starts, stops = np.r_[0, ends[:-1]][: len(words) - size + 1].tolist(), (ends[size - 1 :] - 1).tolist()
    counts = np.zeros(64, np.int64)
    for at in range(0, len(starts), BLOCK):
        hashes = [xxhash.xxh64_intdigest(line[a:b], SEED) for a, b in zip(starts[at : at + BLOCK], stops[at : at + BLOCK], strict=True)]
        counts += np.unpackbits(np.array(hashes, ">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(starts)).tobytes(), "big")


def _describe(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, TEXTS):
            prints = np.array([fingerprint(t, size) for t in b.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(prints.view(np.int64))], ["id", "fp"])

    return run


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b)


def blocks(bits: int) -> list[tuple[int, int]]:
    """(lowest bit, bits) of bits + 1 blocks that make up 64 bits; of wide blocks the lowest WIDEST bits."""
    cuts = [64 * k // (bits + 1) for k in range(bits + 2)]
    return [(a, min(WIDEST, b - a)) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


class Tree:
    """A vantage-point tree over fingerprints: within the median distance of a vantage point, or beyond it."""

    def __init__(self, points: np.ndarray, at: np.ndarray, leaf: int):
        self.at, self.sides = at, None
        if len(at) <= leaf:
            return
        self.point = points[at[0]]
        far = distance(points[at], self.point)
        self.radius = int(np.median(far))
        near = far <= self.radius
        if near.all():  # then the median is the greatest distance
            self.radius -= 1
            near = far <= self.radius
        if LEAST_SIDE <= near.mean() <= 1 - LEAST_SIDE:
            self.sides = [Tree(points, at[near], leaf), Tree(points, at[~near], leaf)]

    def leaves(self, queries: np.ndarray, rows: np.ndarray, reach: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(queries, points) of every leaf that some queries' balls of radius reach touch, as numbers of both."""
        if not len(rows):
            return
        if self.sides is None:
            yield rows, self.at
            return
        far = distance(queries[rows], self.point).astype(np.int16)
        yield from self.sides[0].leaves(queries, rows[far - reach <= self.radius], reach)
        yield from self.sides[1].leaves(queries, rows[far + reach > self.radius], reach)


class Splits:
    """The parts of a shard: a tree of a sample in arrays, small enough to be sent to every task."""

    def __init__(self, sample: np.ndarray, parts: int):
        self.nodes: list[tuple[int, int, int, int]] = []  # point, radius, both sides; a side below 0 is part -1 - side
        self.parts = 0
        self.root = self._add(Tree(sample, np.arange(len(sample)), max(1, len(sample) // parts)))

    def _add(self, tree: Tree) -> int:
        if tree.sides is None:
            self.parts += 1
            return -self.parts
        at = len(self.nodes)
        self.nodes.append((0, 0, 0, 0))
        self.nodes[at] = (int(tree.point), tree.radius, *(self._add(s) for s in tree.sides))
        return at

    def touched(self, x: np.ndarray, reach: int) -> Iterator[tuple[int, np.ndarray]]:
        """(part, numbers of the fingerprints whose balls touch it); with reach 0 every fingerprint has one part."""
        open_ = [(self.root, np.arange(len(x)))]
        while open_:
            node, rows = open_.pop()
            if node < 0:
                yield -1 - node, rows
            elif len(rows):
                point, radius, near, beyond = self.nodes[node]
                far = distance(x[rows], np.uint64(point)).astype(np.int16)
                open_ += [(near, rows[far - reach <= radius]), (beyond, rows[far + reach > radius])]


def _deal(splits: dict[int, Splits], bits: int):
    """(shard, part, role, fp) of every fingerprint and block: role 0 in the part where it lives, 1 where it is a query only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.column(0).to_numpy().view(np.uint64)
            for k, (low, width) in enumerate(blocks(bits)):
                shard = ((x >> np.uint64(low)) & np.uint64((1 << width) - 1)).astype(np.int32) + (k << 24)
                large = np.isin(shard, list(splits))
                yield _dealt(shard[~large], 0, 0, x[~large])
                for s in np.unique(shard[large]).tolist():
                    own = x[shard == s]
                    homes = dict(splits[s].touched(own, 0))
                    for part, rows in splits[s].touched(own, bits):
                        home = np.isin(rows, homes.get(part, rows[:0]))
                        yield _dealt(np.full(len(rows), s, np.int32), part, np.where(home, 0, 1), own[rows])

    return run


def _dealt(shard: np.ndarray, part: int, role: int | np.ndarray, x: np.ndarray) -> pa.RecordBatch:
    n = len(shard)
    roles = np.broadcast_to(np.asarray(role, np.int32), n)
    return pa.RecordBatch.from_arrays([pa.array(shard), pa.array(np.full(n, part, np.int32)), pa.array(roles), pa.array(x.view(np.int64))], ["shard", "part", "role", "fp"])


class Forest:
    """Components of numbered fingerprints, and the links that joined them."""

    def __init__(self, n: int):
        self.root = np.arange(n)
        self.links: list[tuple[int, int]] = []

    def top(self, k: int) -> int:
        while self.root[k] != k:
            self.root[k] = k = self.root[self.root[k]]
        return k

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        """Links a[k] with b[k]; those of roots that are already one are left out."""
        for u, v in zip(a.tolist(), b.tolist(), strict=True):
            p, q = self.top(u), self.top(v)
            if p != q:
                self.root[max(p, q)] = min(p, q)
                self.links.append((u, v))

    def flat(self) -> np.ndarray:
        while not np.array_equal(up := self.root[self.root], self.root):
            self.root = up
        return self.root


def search(x: np.ndarray, tree: Tree, queries: np.ndarray, forest: Forest, bits: int) -> None:
    """Joins, in the forest, those of x[queries] and the tree's points (numbers in x) that differ in no more than bits."""
    for rows, points in tree.leaves(x, queries, bits):
        step = max(1, PAIRS // len(points))
        for at in range(0, len(rows), step):
            some, root = rows[at : at + step], forest.flat()
            near = (distance(x[some][:, None], x[points][None, :]) <= bits) & (root[some][:, None] != root[points][None, :])
            i, j = np.nonzero(near)
            if len(i):
                _, first = np.unique(root[some[i]] * np.int64(len(x)) + root[points[j]], return_index=True)
                forest.join(some[i[first]], points[j[first]])


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(a number for each part, roles, fingerprints) of rows sorted by shard, part and role, in pieces as they come."""
    turn, last = 0, None
    for b in batches:
        if not b.num_rows:
            continue
        shard, part, role, x = (b.column(k).to_numpy() for k in range(4))
        key = shard.astype(np.int64) << 16 | part
        cuts = np.r_[0, np.flatnonzero(np.diff(key)) + 1, len(key)]
        for a, z in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            turn += last is not None and key[a] != last
            last = key[a]
            yield turn, role[a:z], x[a:z].view(np.uint64)


def _links(bits: int):
    """A spanning forest of the links in every part; the fingerprints that live there are held, queries pass by."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn, homes, queries, tree = None, [], [], None

        def found() -> Iterator[pa.RecordBatch]:
            nonlocal tree
            own = np.concatenate(homes) if homes else np.zeros(0, np.uint64)
            if len(homes) > 1:
                homes[:] = [own]
            if not len(own):
                return
            x = np.concatenate([own, *queries])
            if len(x) < 2:
                return
            forest = Forest(len(x))
            new = tree is None
            tree = tree or Tree(x, np.arange(len(own)), LEAF)
            rows = np.arange(0 if new else len(own), len(x))
            for at in range(0, len(rows), QUERIES):
                search(x, tree, rows[at : at + QUERIES], forest, bits)
            if forest.links:
                a, b = (x[list(side)].view(np.int64) for side in zip(*forest.links, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        for at, role, x in _shards(batches):
            if at != turn:
                yield from found()
                turn, homes, queries, tree = at, [], [], None
            if (role == 0).any():
                homes.append(x[role == 0])
            if (role == 1).any():
                queries.append(x[role == 1])
                if sum(map(len, queries)) >= 4 * QUERIES:
                    yield from found()
                    queries.clear()
        yield from found()

    return run


def _splits(shards: DataFrame, bits: int, most: int) -> dict[int, Splits]:
    """Trees of the shards (fp, shard) with more than most fingerprints; as many as blocks have values, 41,000 for 4 bits."""
    crowded = written(shards.groupBy("shard").agg(F.count("*").alias("n")).filter(F.col("n") > most), "crowded-shards")
    sizes = {r.shard: r.n for r in crowded.collect()}
    if not sizes:
        return {}
    each = max(2 * EACH, min(SAMPLE, SAMPLES // len(sizes)))
    # a shard's sample are the fingerprints with the least hashes
    drawn = F.pmod(F.xxhash64("fp", F.lit(bits)), F.lit(1 << 30)) < F.lit(each * float(1 << 30)) / F.col("n")
    few: dict[int, list[int]] = {}
    for r in shards.join(F.broadcast(crowded), "shard").filter(drawn).select("shard", "fp").toLocalIterator():
        few.setdefault(r.shard, []).append(r.fp)
    out = {}
    for s, x in few.items():
        points = np.random.default_rng(s).permutation(np.array(sorted(x), np.int64).view(np.uint64))
        out[s] = Splits(points, min(-(-sizes[s] // most), max(1, len(points) // EACH)))
    return out


def near_prints(prints: DataFrame, bits: int = BITS, most: int = MOST) -> DataFrame:
    """Links (a, b) between distinct fingerprints (one column fp, 64 bits as long) that connect all within ``bits`` bits.

    Only links are returned that differ in no more than ``bits`` (0 to 15) bits, and enough of them that whoever is linked
    is connected. No fingerprint is left out: the samples bound what the trees of large shards are made from, not what is
    searched.
    """
    keys = [F.shiftrightunsigned("fp", low).bitwiseAND((1 << width) - 1).cast("int") + (k << 24) for k, (low, width) in enumerate(blocks(bits))]
    splits = _splits(prints.select("fp", F.explode(F.array(*keys)).alias("shard")), bits, most)
    dealt = prints.select("fp").mapInArrow(_deal(splits, bits), "shard int, part int, role int, fp long")
    together = dealt.repartition("shard", "part").sortWithinPartitions("shard", "part", "role")
    return together.mapInArrow(_links(bits), "a long, b long")


def simhash_components(docs: DataFrame, size: int = SHINGLE, bits: int = BITS, id_col: str = "doc_id", text_col: str = "text", most: int = MOST) -> DataFrame:
    """(id, fingerprint, component_id) for every row of docs; other columns are left out.

    fingerprint has 16 lowercase hex digits. Rows are linked if their fingerprints differ in no more than ``bits`` bits;
    texts without words and null texts have the fingerprint zero and are linked like any others. component_id is the
    smallest id that links lead to; a null id is reached by links but is no id, so a component of null ids only has a null
    component_id. Repeated rows stay repeated. An empty table gives an empty result.
    """
    source = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    rows = written(source.mapInArrow(_describe(size), f"id {kind}, fp long"), "prints")
    prints = written(rows.groupBy("fp").agg(F.min("id").alias("least")), "distinct-prints")
    links = written(near_prints(prints.select("fp"), bits, most), "print-links")
    labels = connected_components(links, "a", "b").select(F.col("node").alias("fp"), "component")
    owned = prints.join(labels, "fp", "left").select("fp", "least", F.coalesce("component", "fp").alias("comp"))
    least = written(owned.groupBy("comp").agg(F.min("least").alias("component_id")), "component-ids")
    fates = written(owned.join(least, "comp").select("fp", "component_id"), "fates")
    remove(links)
    out = rows.join(fates, "fp", "left")  # the fates are one row each, so a fingerprint of many rows can be split
    return out.select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op12_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents"))
