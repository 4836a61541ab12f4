"""Sharding by histogram sort.

Rows are ordered by a content key and the id, so equal texts stand next to each other. The boundaries between parts are
found without moving rows: every partition counts the exact weight below each of a few candidate boundaries, the counts
are summed, and the candidates are drawn closer around each target until a boundary meets its tolerance. Every shard is
several parts, as many as fill the cluster; only the boundaries of shards must be exact. Then the rows are exchanged,
once, straight to the part that the boundaries give them, and sorted there; how many rows stand before each part is
known from the counts.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegralType

from urbanframe.llm.common import remove, table, written

#: Candidate boundaries tried for each splitter in a round.
PROBES = 48
HASH_BITS = 60
LEAST_ID = -(2**63)
#: A boundary inside a shard may be off by this share of a part.
SLACK = 8
#: Bits of a monotonically increasing id below the partition's number.
PLACE_BITS = 33


class Splitter(NamedTuple):
    h: int
    id: int
    rows: int  # below it


def content_key(text: Column) -> Column:
    """The first 60 bits of the text's MD5 as a non-negative integer; null counts as empty."""
    return F.conv(F.substring(F.md5(F.coalesce(text, F.lit(""))), 1, HASH_BITS // 4), 16, 10).cast("long")


def _reached(hashes: np.ndarray, ids: np.ndarray, h: np.ndarray, i: np.ndarray) -> np.ndarray:
    """How many of the sorted boundaries (hashes, ids) are at or before each row's (h, i)."""
    at, upto = np.searchsorted(hashes, h, "left"), np.searchsorted(hashes, h, "right")
    for x in np.unique(h[at < upto]):  # rows with the hash of a boundary: the id decides
        same, lo, hi = h == x, np.searchsorted(hashes, x, "left"), np.searchsorted(hashes, x, "right")
        at[same] = lo + np.searchsorted(ids[lo:hi], i[same], "right")
    return at


def _below(keys: DataFrame, probes: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The weight and the number of all rows whose (h, id) is below each of the sorted probes."""
    hashes = np.array([p[0] for p in probes], np.int64)
    ids = np.array([p[1] for p in probes], np.int64)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, number = np.zeros(len(probes) + 1, np.int64), np.zeros(len(probes) + 1, np.int64)
        for b in batches:
            h, i, w = (b.column(c).to_numpy(zero_copy_only=False) for c in range(3))
            at = _reached(hashes, ids, h, i)
            np.add.at(weight, at, w)
            np.add.at(number, at, 1)
        at = np.flatnonzero(number)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(weight[at]), pa.array(number[at])], ["at", "w", "n"])

    counted = keys.select("h", "id", "w").mapInArrow(count, "at int, w long, n long")
    found = {r.at: (r.w, r.n) for r in counted.groupBy("at").agg(F.sum("w").alias("w"), F.sum("n").alias("n")).collect()}
    each = np.array([found.get(k, (0, 0)) for k in range(len(probes))], dtype=object).reshape(-1, 2)
    return [(int(w), int(n)) for w, n in np.cumsum(each, axis=0)]


def find_splitters(keys: DataFrame, parts: int, tolerance: int = 0, probes: int = PROBES, exact_every: int = 1) -> list[Splitter]:
    """Keys that part rows (h, id, w) into parts: the weight below the k-th is k / parts of all.

    It may be more by up to tolerance, and but for each exact_every-th splitter by up to 1 / SLACK of a part. With
    tolerance 0 an exact splitter has below it the least rows in order that weigh its target or more.
    """
    one = keys.agg(F.sum("w").alias("w"), F.count("*").alias("n"), F.min("id").alias("least"), F.max("id").alias("most")).first()
    if not one.n:
        return [Splitter(0, LEAST_ID, 0)] * (parts - 1)
    span = one.most - one.least + 1
    key = lambda x: (x // span, one.least + x % span)
    targets = [-(-one.w * k // parts) for k in range(1, parts)]
    allowed = [tolerance if k % exact_every == 0 else max(tolerance, one.w // (parts * SLACK)) for k in range(1, parts)]
    # for each target: what is below low weighs less, what is below high weighs enough
    low, high = [(0, 0, 0)] * len(targets), [(span << HASH_BITS, one.w, one.n)] * len(targets)
    left = set(range(len(targets)))
    while left:
        tried: set[int] = set()
        for k in left:
            step = -(-(high[k][0] - low[k][0]) // (probes + 1))
            tried.update(range(low[k][0] + step, high[k][0], step))
        order = sorted(tried)
        below = _below(keys, [key(x) for x in order])
        weights = [w for w, _ in below]
        for k in [*left]:
            at = bisect_left(weights, targets[k])
            if at > 0:
                low[k] = max(low[k], (order[at - 1], *below[at - 1]))
            if at < len(order):
                high[k] = min(high[k], (order[at], *below[at]))
            if high[k][0] - low[k][0] <= 1 or high[k][2] - low[k][2] <= 1 or high[k][1] - targets[k] <= allowed[k]:
                left.discard(k)
    return [Splitter(*key(x), n) for x, _, n in high]


def _dealt(splitters: list[Splitter], each: int):
    """A function of (h, id) for the part, its shard, and the rows of the shard that stand before the part."""
    hashes, ids = (np.array([s[k] for s in splitters], np.int64) for k in (0, 1))
    before = np.array([0, *(s.rows for s in splitters)], np.int64)
    shards = np.arange(len(before)) // each
    start = before - before[shards * each]

    @F.pandas_udf("part int, shard int, start long")
    def deal(h: pd.Series, i: pd.Series) -> pd.DataFrame:
        part = _reached(hashes, ids, h.to_numpy(), i.to_numpy())
        return pd.DataFrame({"part": part.astype(np.int32), "shard": shards[part].astype(np.int32), "start": start[part]})

    return deal


def shard(docs: DataFrame, shards: int = 16, law: str = "bytes", tolerance: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Adds size, shard and slot to every row.

    size is the text's UTF-8 bytes (null: none) plus 1. law ``bytes``: a row is in the shard in which the bytes before it
    end, so sizes differ by no more than one row; ``rows``: the same for counts. Slots count from 0 without gaps, in the
    order of the content key and the id; ids that are no integers stand in the order of their hashes. Rows of the same id
    and text keep their neighbourhood, in any order; a null id comes as the least. Equal texts stand together and are
    parted only where a boundary runs through them, as it must if one of them is larger than a shard. Other columns pass
    through, whatever their names are; columns with the added names are replaced. An empty table stays empty.
    """
    if law not in ("bytes", "rows"):
        raise ValueError(f"law {law!r} is neither bytes nor rows")
    names = [c for c in docs.columns if c not in ("size", "shard", "slot") or c in (id_col, text_col)]
    rest = [f"c{k}" for k in range(len(names))]  # the operator's own columns can't clash with these
    whole = isinstance(docs.schema[id_col].dataType, IntegralType)
    own, text = F.col(rest[names.index(id_col)]), F.col(rest[names.index(text_col)])
    rows = docs.select(*(F.col(f"`{c}`").alias(k) for c, k in zip(names, rest, strict=True))).withColumns({
        "size": F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1,
        "h": content_key(text),
        "id": F.coalesce(own if whole else F.when(own.isNotNull(), F.xxhash64(own)), F.lit(LEAST_ID)).cast("long"),
    })
    weight = F.col("size") if law == "bytes" else F.lit(1).cast("long")
    keys = written(rows.select("h", "id", weight.alias("w")), "shard-keys")
    each = max(1, -(-int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) // shards))
    splitters = find_splitters(keys, shards * each, tolerance, exact_every=each)
    remove(keys)
    placed = rows.withColumn("to", _dealt(splitters, each)("h", "id")).withColumn("part", F.col("to.part")).repartitionById(shards * each, "part")
    placed = placed.sortWithinPartitions("h", "id").withColumn("place", F.monotonically_increasing_id().bitwiseAND((1 << PLACE_BITS) - 1))
    added = ["size", F.col("to.shard").alias("shard"), (F.col("to.start") + F.col("place")).alias("slot")]
    return placed.select(*(F.col(k).alias(c) for c, k in zip(names, rest, strict=True) if c not in ("size", "shard", "slot")), *added)


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shard(table(spark, sf_dir, "documents").select("doc_id", "text"))
    crc = F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    return out.select("doc_id", "size", crc.alias("text_crc32"), F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


#: CRC-32 by its rule: the 256 remainders of the reflected polynomial, then a fold over the bytes.
ORACLE = """
WITH RECURSIVE bits(b, k, c) AS (
  SELECT i, 0, i FROM range(256) r(i) UNION ALL
  SELECT b, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM bits WHERE k < 8),
remainders AS (SELECT list(c ORDER BY b) AS rem FROM bits WHERE k = 8),
k AS (
  SELECT doc_id, coalesce(text, '') AS text, coalesce(strlen(text), 0) + 1 AS size,
         ('0x' || substr(md5(coalesce(text, '')), 1, 15))::BIGINT AS h FROM documents),
s AS (SELECT *, sum(size) OVER (ORDER BY h, doc_id) - size AS before, sum(size) OVER () AS total FROM k),
p AS (SELECT *, (SELECT count(*) FROM range(1, 16) r(i) WHERE before * 16 >= total * i) AS shard FROM s),
hexed AS (SELECT p.*, hex(encode(text)) AS x, rem FROM p, remainders),
crc AS (
  SELECT *, xor(4294967295, list_reduce([ii for ii in range(0, size - 1)], lambda c, i:
           xor(c >> 8, rem[(xor(c, ('0x' || substr(x, 2 * i + 1, 2))::BIGINT) & 255) + 1]), 4294967295)) AS text_crc32 FROM hexed)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard::INT AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY h, doc_id) - 1 AS slot, NULL::INT AS grown_shard
FROM crc
"""
