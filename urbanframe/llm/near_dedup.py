"""MinHash near-dedup by min-max hashing.

Every permutation of the shingle hashes gives two signature values, its minimum and its maximum, so half as many hash
evaluations fill the bands. Equal shingle sets are one class. Classes that share a band are candidates, and a link counts
only after the full sets have been compared.

Most candidates are left out before any text moves, by an exact bound: shingles fall into 256 classes by their hashes, and
two sets have no more in common than the sum of the lesser counts of each class.

A band that a large group of near copies shares would give a square of pairs. Only the components are wanted, so each
round compares the members of a bucket with one leader of the bucket, drawn anew by hash, unless both are already in one
component; components are joined after each round. A round costs a pair for each bucket member at most. When few pairs
of different components are left in the buckets, or a round helps no more, all pairs that are left are compared: so no
link between different components is lost, whatever the leaders were. In small buckets these pairs are joined; in large
ones the members outside the largest component meet the bucket's members of like sizes block by block: first their class counts, then
the texts of those that the bound leaves, and only links come out.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from math import log

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F

from urbanframe.llm.common import remove, table, written
from urbanframe.llm.substring_dedup import rolling, word_hashes
from urbanframe.operators.components import connected_components

#: A pair with a similarity of 0.8 shares none of 40 bands of 5 values with a probability of 1.3e-7.
BANDS, ROWS = 40, 5
#: Classes of shingles for the bound; a count of FULL stands for any from there on.
CLASSES, FULL = 256, 255
#: Digests of shingle sets that a task remembers, so that it sends the bands and words of equal ones once.
REMEMBERED = 100_000
#: Leader rounds end when the buckets hold fewer unjoined pairs than this many for each of their rows, or after MOST_ROUNDS.
PAIRS_EACH, MOST_ROUNDS = 2, 8
#: Buckets of more members are compared in blocks of so many.
LARGE, BLOCK_ROWS = 32, 512
_seeds = np.random.default_rng(20_240_701)
#: A permutation of 64-bit values is an exclusive or and a product with an odd number.
XORS = _seeds.integers(0, 2**64, BANDS * ROWS // 2, np.uint64)
ODDS = _seeds.integers(0, 2**63, BANDS * ROWS // 2, np.uint64) * np.uint64(2) + np.uint64(1)
#: Which signature values a band takes; minimum and maximum of a permutation are dealt to different bands.
DEAL = _seeds.permutation(BANDS * ROWS // 2)
BLOCK = 2048


def shingle_set(words: list[bytes], size: int) -> np.ndarray:
    """The sorted distinct 64-bit hashes of all runs of size words; fewer words count as one run."""
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < size:
        return np.array([xxhash.xxh3_64_intdigest(b"\x00".join(words), seed=len(words))], np.uint64)
    x = rolling(word_hashes(words), size) * np.uint64(0xBF58476D1CE4E5B9)
    return np.unique(x ^ (x >> np.uint64(32)))


def signature(x: np.ndarray) -> np.ndarray:
    """Minima, then maxima, of all permutations of a set that isn't empty."""
    low, high = np.full(len(XORS), 2**64 - 1, np.uint64), np.zeros(len(XORS), np.uint64)
    for at in range(0, len(x), BLOCK):
        y = (x[None, at : at + BLOCK] ^ XORS[:, None]) * ODDS[:, None]
        np.minimum(low, y.min(1), out=low)
        np.maximum(high, y.max(1), out=high)
    return np.concatenate([low[DEAL], high[np.roll(DEAL, ROWS)]])


def band_keys(x: np.ndarray) -> np.ndarray:
    values = signature(x).reshape(ROWS, BANDS).T  # a band takes values of ROWS different permutations
    mixed = np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for k in range(ROWS):
        mixed = (mixed ^ values[:, k]) * np.uint64(0xD6E8FEB86659FD93)
        mixed ^= mixed >> np.uint64(32)
    return mixed.view(np.int64)


def class_counts(x: np.ndarray) -> bytes:
    return np.minimum(np.bincount((x >> np.uint64(8)).view(np.int64) & (CLASSES - 1), minlength=CLASSES), FULL).astype(np.uint8).tobytes()


def may_link(a: np.ndarray, b: np.ndarray, total: np.ndarray, percent: int) -> np.ndarray:
    """Which rows of class counts a and b leave a link possible, total being the sum of both sizes."""
    both = np.minimum(a, b)
    common = np.where((both == FULL).any(1), total, both.sum(1, dtype=np.int64))
    return 100 * common >= percent * (total - common)


def _words(text: str | None) -> list[bytes]:
    return text.encode().lower().split() if text else []  # bytes: A-Z and the six ASCII blanks only


def _describe(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zip_, seen = zstandard.ZstdCompressor(level=3), set()
        for b in batches:
            sizes, digests, bands, counts, packed = [], [], [], [], []
            if len(seen) > REMEMBERED:
                seen.clear()
            for text in b.column(1).to_pylist():
                words = _words(text)
                x = shingle_set(words, size)
                digest = xxhash.xxh3_128_digest(x.tobytes()) if len(x) else None
                new = digest is not None and digest not in seen
                seen.add(digest)
                sizes.append(len(x))
                digests.append(digest)
                bands.append(band_keys(x) if new else None)
                counts.append(class_counts(x) if new else None)
                packed.append(zip_.compress(b" ".join(words)) if new else None)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(sizes, pa.int64()), *(pa.array(v, kind) for v, kind in ((digests, pa.binary()), (bands, pa.list_(pa.int64())), (counts, pa.binary()), (packed, pa.binary())))],
                ["doc_id", "n_shingles", "digest", "bands", "counts", "packed"],
            )

    return run


def _table(column: pa.Array) -> np.ndarray:
    """Class counts as rows."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), CLASSES)


def _possible(percent: int):
    """The pairs (a, b, ca, cb) of those with sizes and class counts that may be links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            total = b.column("na").to_numpy() + b.column("nb").to_numpy()
            good = may_link(_table(b.column("counts_a")), _table(b.column("counts_b")), total, percent)
            yield pa.RecordBatch.from_arrays([b.column(c) for c in ("a", "b", "ca", "cb")], ["a", "b", "ca", "cb"]).filter(pa.array(good))

    return run


def _linked(size: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unzip = zstandard.ZstdDecompressor()
        kept: dict[int, np.ndarray] = {}

        def full(num: int, packed: bytes) -> np.ndarray:
            if num not in kept:
                if len(kept) >= 512:
                    kept.clear()
                kept[num] = shingle_set(unzip.decompress(packed).split(), size)
            return kept[num]

        for batch in batches:
            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            good = [_similar(full(u, p.as_py()), full(v, q.as_py()), percent) for u, v, p, q in zip(a, b, batch.column(2), batch.column(3), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"]).filter(pa.array(good, pa.bool_()))

    return run


def _similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    if min(len(x), len(y)) * 100 < percent * max(len(x), len(y)):
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= percent * (len(x) + len(y) - both)


class _Block:
    """Rows of one block (key, bm, bu, role, num, comp, n, counts, further): members have role 0 and queries 1."""

    def __init__(self, rows: list[tuple], percent: int):
        self.percent = percent
        self.members, self.queries = [r for r in rows if not r[3]], [r for r in rows if r[3]]
        self.comps = np.array([r[5] for r in self.members], np.int64)
        self.sizes = np.array([r[6] for r in self.members], np.int64)
        self.counts = np.frombuffer(b"".join(r[7] for r in self.members), np.uint8).reshape(-1, CLASSES)

    def partners(self, query: tuple) -> np.ndarray:
        """Numbers of the members of other components that may be linked with a query."""
        own = np.frombuffer(query[7], np.uint8)[None, :]
        return np.flatnonzero((self.comps != query[5]) & may_link(self.counts, own, self.sizes + query[6], self.percent))


def _by_block(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    rows: list[tuple] = []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if rows and row[:3] != rows[0][:3]:
                yield rows
                rows = []
            rows.append(row)
    if rows:
        yield rows


def _involved(percent: int):
    """The rows of blocks that have a possible partner, without their class counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _by_block(batches):
            block, met, out = _Block(rows, percent), set(), []
            for query in block.queries:
                found = block.partners(query).tolist()
                met.update(found)
                if found:
                    out.append(query[:7])
            out += [block.members[k][:7] for k in sorted(met)]
            if out:
                kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], ["key", "bm", "bu", "role", "num", "comp", "n"])

    return run


def _block_links(size: int, percent: int):
    """Links between the components of members and queries of each block; rows have packed words at the end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unzip = zstandard.ZstdDecompressor()
        shingles = lambda r: shingle_set(unzip.decompress(r[8]).split(), size)
        for rows in _by_block(batches):
            block, sets, found = _Block(rows, percent), {}, set()
            for query in block.queries:
                own = None
                for k in block.partners(query).tolist():
                    link = (query[5], int(block.comps[k]))
                    if link in found:
                        continue
                    own = shingles(query) if own is None else own
                    if k not in sets:
                        sets[k] = shingles(block.members[k])
                    if _similar(own, sets[k], percent):
                        found.add(link)
            yield _pairs(found)

    return run


def _pairs(found: set[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], ["a", "b"])


def _moved(members: DataFrame, links: DataFrame) -> DataFrame:
    """members (key, num, n, comp) after joining the components that the links (a, b) connect."""
    labels = connected_components(links, "a", "b").select(F.col("node").alias("comp"), "component")
    return members.join(labels, "comp", "left").select("key", "num", "n", F.coalesce("component", "comp").alias("comp"))


def _small_pairs(mixed: DataFrame) -> DataFrame:
    """Pairs of different components in each bucket."""
    side = lambda c: mixed.select("key", F.col("num").alias(c), F.col("n").alias(f"n{c}"), F.col("comp").alias(f"c{c}"))
    return side("a").join(side("b"), "key").filter(F.col("ca") < F.col("cb"))


def _blocks(mixed: DataFrame, percent: int) -> DataFrame:
    """Members, and as queries those outside the main component, dealt so that every query meets once every member it may link with.

    Sets fall into classes of sizes such that links join sets of one class or of neighbouring ones, so only blocks of
    these meet. bm and bu are the blocks of members and of queries, with their classes in the higher bits.
    """
    # a little wider than the greatest ratio of linked sizes, so that rounding can't part them by two classes
    kind = F.floor(F.log("n") / (max(0.01, log(100 / percent)) * 1.000001)).cast("int")
    mixed = mixed.withColumn("kind", kind)
    tally = mixed.groupBy("key", "kind").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("m"), F.ceil(F.sum((F.col("comp") != F.col("main")).cast("int")) / BLOCK_ROWS).cast("int").alias("u"))
    tally = tally.groupBy("key").agg(F.map_from_entries(F.collect_list(F.struct("kind", F.struct("m", "u")))).alias("tally"))  # a row for each ratio of sizes
    mixed = mixed.join(written(tally, "block-sizes"), "key")
    blocks = lambda c, k: F.coalesce(F.try_element_at("tally", k)[c], F.lit(0))
    own = lambda c: F.shiftleft("kind", 20) + F.pmod(F.hash("num"), blocks(c, F.col("kind")))
    near = lambda c: F.flatten(F.transform(F.array(*(F.col("kind") + d for d in (-1, 0, 1))), lambda k: F.transform(F.slice(F.sequence(F.lit(0), blocks(c, k)), F.lit(1), blocks(c, k)), lambda j: k * (1 << 20) + j)))
    members = mixed.select("key", own("m").alias("bm"), F.explode(near("u")).alias("bu"), F.lit(0).alias("role"), "num", "comp", "n")
    queries = mixed.filter("comp <> main").select("key", F.explode(near("m")).alias("bm"), own("u").alias("bu"), F.lit(1).alias("role"), "num", "comp", "n")
    return members.unionByName(queries)


def near_components(docs: DataFrame, size: int, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Adds n_shingles, component_id and kept to every row of docs (id, text); other columns are left out.

    A text's set holds its distinct runs of ``size`` words, words being runs of characters other than the ASCII blanks
    with A-Z lower-cased; fewer words count as one run. Sets are linked if 100 * common >= percent * all. component_id is
    the smallest id that links lead to; a row is kept if that is its own. Texts without words, and null texts, have no
    shingles and no links. Rows of one id share their fate if their texts are linked; a null id counts as no id: the row
    is in its component, but gives no component_id unless no other row does. Shingles are compared by 64-bit hashes.
    """
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    rows = source.mapInArrow(_describe(size), f"doc_id {kind}, n_shingles long, digest binary, bands array<long>, counts binary, packed binary")
    rows = written(rows.withColumn("num", F.monotonically_increasing_id()), "sets")

    # the first row of a set in each task has its bands; that with the smallest number stands for the set
    classes = rows.filter("digest IS NOT NULL").groupBy("digest").agg(F.min("num").alias("num"), F.min("doc_id").alias("least"), F.first("n_shingles").alias("n"))
    classes = written(classes, "set-classes")
    # a band is of use if two different sets have it; 32 bits of their digests differ but for one pair in 4e9
    banded = rows.filter("bands IS NOT NULL").select(F.explode("bands").alias("key"), F.hash("digest").alias("d"), "num")
    shared = written(banded.groupBy("key").agg(F.min("d").alias("lo"), F.max("d").alias("hi")).filter("lo <> hi").select("key"), "shared-bands")
    buckets = banded.select("key", "num").join(shared, "key", "left_semi")
    members = written(buckets.join(classes.select("num", "n"), "num").select("key", "num", "n", F.col("num").alias("comp")), "members")
    texts = written(rows.select("num", "counts", "packed").join(members.select("num").distinct(), "num", "left_semi"), "candidate-sets")

    def confirmed(pairs: DataFrame) -> DataFrame:
        """The links among pairs (a, b, na, nb, ca, cb), as their component numbers."""
        pairs = pairs.select("a", "b", "na", "nb", "ca", "cb").distinct()
        own, other = (texts.select(F.col("num").alias(c), F.col("counts").alias(f"counts_{c}")) for c in "ab")
        possible = pairs.join(other, "b").join(own, "a").select("a", "b", "na", "nb", "ca", "cb", "counts_a", "counts_b")
        pairs = written(possible.mapInArrow(_possible(percent), "a long, b long, ca long, cb long"), "pairs")
        needed = pairs.select(F.col("a").alias("num")).union(pairs.select("b"))
        held = texts.select("num", "packed").join(needed, "num", "left_semi")
        left, right = (held.select(F.col("num").alias(c), F.col("packed").alias(f"packed_{c}")) for c in "ab")
        full = pairs.select("a", "b").join(right, "b").join(left, "a").select("a", "b", "packed_a", "packed_b")
        links = full.mapInArrow(_linked(size, percent), "a long, b long")
        links = written(links.join(pairs, ["a", "b"]).select(F.col("ca").alias("a"), F.col("cb").alias("b")).distinct(), "links")
        remove(pairs)
        return links

    near_size = F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent
    links, rows_in, before, turn = [], members.count(), 0, 0
    while True:
        drawn = F.min(F.struct(F.xxhash64(F.lit(turn), "num").alias("h"), F.col("num"), F.col("n"), F.col("comp"))).alias("lead")
        leaders = members.groupBy("key").agg(drawn, F.count("*").alias("m"))
        leaders = written(leaders.filter("m > 1").select("key", "m", F.col("lead.num").alias("b"), F.col("lead.n").alias("nb"), F.col("lead.comp").alias("cb")), "leaders")
        apart = members.join(leaders, "key").filter("comp <> cb")
        apart = written(apart.select("key", "m", F.col("num").alias("a"), "b", F.col("n").alias("na"), "nb", F.col("comp").alias("ca"), "cb"), "apart")
        remove(leaders)
        left = apart.agg(F.sum("m")).first()[0] or 0  # pairs that comparing each of these rows with its whole bucket takes
        if left <= PAIRS_EACH * rows_in or turn == MOST_ROUNDS or turn > 1 and left > 0.9 * before:
            break
        links.append(confirmed(apart.filter(near_size)))
        still = members.join(apart.select("key").distinct(), "key", "left_semi")  # components only grow: the other buckets are done
        members, old = written(_moved(still, links[-1]), "members"), members
        remove(old)
        remove(apart)
        before, turn = left, turn + 1
    if left:
        held = written(apart.groupBy("key").agg(F.first("m").alias("m"), F.count("*").alias("u"), F.first("cb").alias("main")), "mixed-buckets")
        mixed = written(members.join(held, "key"), "mixed-members")
        links.append(confirmed(_small_pairs(mixed.filter(F.col("m") <= LARGE)).filter(near_size)))
        together = lambda df: df.repartition("key", "bm", "bu").sortWithinPartitions("key", "bm", "bu", "role")
        parts = ["key", "bm", "bu", "role", "num", "comp", "n"]
        counts = together(_blocks(mixed.filter(F.col("m") > LARGE).drop("m", "u"), percent).join(texts.select("num", "counts"), "num").select(*parts, "counts"))
        involved = written(counts.mapInArrow(_involved(percent), "key long, bm int, bu int, role int, num long, comp long, n long"), "involved")
        blocks = together(involved.join(texts, "num").select(*parts, "counts", "packed"))
        links.append(written(blocks.mapInArrow(_block_links(size, percent), "a long, b long"), "links"))
        remove(mixed)
        remove(involved)
    remove(texts)
    remove(members)

    owned = classes.withColumn("comp", F.col("num"))
    if links:
        labels = connected_components(reduce(DataFrame.unionByName, links), "a", "b").select(F.col("node").alias("num"), "component")
        owned = classes.join(labels, "num", "left").withColumn("comp", F.coalesce("component", "num"))
    least = owned.groupBy("comp").agg(F.min("least").alias("component_id"))
    fates = written(owned.join(written(least, "component-ids"), "comp").select("digest", "component_id"), "fates")
    out = rows.select("doc_id", "n_shingles", "digest").join(fates, "digest", "left").withColumn("component_id", F.coalesce("component_id", "doc_id"))
    return out.select(F.col("doc_id").alias(id_col), "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_components(table(spark, sf_dir, "documents"), size=2)


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
         ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END)) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
inside AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
link AS (
  SELECT x, y FROM inside JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * i >= 80 * (a.n + b.n - i)),
e AS (SELECT x, y FROM link UNION SELECT y, x FROM link),
reach(doc_id, r) AS (SELECT doc_id, doc_id FROM documents UNION SELECT reach.doc_id, e.y FROM reach JOIN e ON reach.r = e.x),
c AS (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY 1)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, w.doc_id = component_id AS kept
FROM w LEFT JOIN n ON n.doc_id = w.doc_id JOIN c ON c.doc_id = w.doc_id
"""
