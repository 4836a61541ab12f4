"""Substring dedup: Rabin-Karp hashes of every window of a fixed number of words, counted in Spark.

Sending every window would move many times the input. A window that repeats also repeats its anchor, the least hash of
the ``ANCHOR`` words long grams inside it, and anchors are a fraction of all windows. So the steps are

1. each document's words are hashed; its anchors, and a digest of its whole word sequence, are written down;
2. anchors that two different word sequences have, or one has twice, are found by counting;
3. only documents with such anchors are read again, once for each word sequence (the smallest id); the windows around
   the anchors are hashed to 96 bits, and all but the first window of each hash are marked. A batch of documents marks
   the repeats within itself first, so a very common passage costs one row for each batch;
4. marked windows merge to maximal intervals, whose words go. Documents whose word sequence a smaller id has lose all
   words if they have a window at all.

Nothing grows with the number of copies in a single task, and no text is exchanged twice.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from urbanframe.llm.common import table, written

#: Words of a window, and of the grams whose least hash is a window's anchor.
WINDOW, ANCHOR = 20, 5
#: Odd bases of the rolling hashes modulo 2 ** 64, and a multiplier that mixes bits.
BASE, BASE_2, MIX = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xBF58476D1CE4E5B9
EMPTY = hashlib.sha256(b"").hexdigest()

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base ** i and base ** -i modulo 2 ** 64 for i < n at least."""
    found = _powers.get(base)
    if found is None or len(found[0]) < n:
        size = 1 << max(12, n.bit_length())
        out = []
        for b in (base, pow(base, -1, 2**64)):
            steps = np.full(size, b, np.uint64)
            steps[0] = 1
            out.append(np.multiply.accumulate(steps))
        found = _powers[base] = (out[0], out[1])
    return found


def rolling(x: np.ndarray, width: int, base: int = BASE) -> np.ndarray:
    """The Rabin-Karp hash of every run of width values: differences of prefix hashes, moved to the origin."""
    n = len(x) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    up, down = _power_tables(base, len(x))
    prefix = np.concatenate([np.zeros(1, np.uint64), np.cumsum(x * up[: len(x)], dtype=np.uint64)])
    return (prefix[width:] - prefix[:-width]) * down[:n]


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def anchors(x: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """The anchor's hash for every window, and the place of its gram."""
    g = rolling(x, gram) * np.uint64(MIX)
    g ^= g >> np.uint64(31)
    if len(x) < window:
        return g[:0], np.zeros(0, np.int64)
    at = np.lib.stride_tricks.sliding_window_view(g, window - gram + 1).argmin(1) + np.arange(len(x) - window + 1)
    return g[at], at


def window_hashes(x: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Two independent hashes of every window, of 64 and 32 bits."""
    return rolling(x, window), rolling(x ^ (x >> np.uint64(29)) * np.uint64(MIX), window, BASE_2) >> np.uint64(32)


def _words(text: str | None) -> list[bytes]:
    return text.encode().split() if text else []  # bytes split at the six ASCII blanks only


def _lists(parts: list[np.ndarray], kind: type) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*parts, np.zeros(0, kind)]).astype(kind)))


def _describe(window: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            counts, digests, once, more = [], [], [], []
            for text in b.column(1).to_pylist():
                words = _words(text)
                counts.append(len(words))
                digests.append(hashlib.sha256(b" ".join(words)).digest())
                hashes, at = anchors(word_hashes(words), window, gram) if len(words) >= window else (np.zeros(0, np.uint64), None)
                if at is not None:
                    hashes = hashes[np.concatenate([[True], at[1:] != at[:-1]])]  # one for each place
                distinct, number = np.unique(hashes, return_counts=True)
                once.append(distinct.view(np.int64))
                more.append(distinct[number > 1].view(np.int64))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(counts, pa.int64()), pa.array(digests), _lists(once, np.int64), _lists(more, np.int64)], ["doc_id", "n_words", "digest", "anchors", "again"])

    return run


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    zip_ = zstandard.ZstdCompressor(level=3)
    for b in batches:
        texts = [b" ".join(_words(t)) for t in b.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array([hashlib.sha256(t).digest() for t in texts]), pa.array([zip_.compress(t) for t in texts], pa.binary())], ["doc_id", "digest", "packed"])


def _unpacked(column: pa.Array) -> Iterator[list[bytes]]:
    unzip = zstandard.ZstdDecompressor()
    for packed in column.to_pylist():
        yield unzip.decompress(packed).split()


def _windows(window: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, num, lists = b.column(0).to_numpy(), b.column(1).to_numpy(), b.column(3)
            found: list[list[np.ndarray]] = [[], [], [], []]
            for i, words in enumerate(_unpacked(b.column(2))):
                x = word_hashes(words)
                own, _ = anchors(x, window, gram)
                here = np.flatnonzero(np.isin(own, lists[i].values.to_numpy().view(np.uint64)))
                h, g = window_hashes(x, window)
                for out, part in zip(found, (h[here], g[here], here, np.full(len(here), i)), strict=True):
                    out.append(part)
            if not found[0]:
                continue
            h, g, pos, doc = (np.concatenate(p) for p in found)
            order = np.lexsort((pos, num[doc], ids[doc], g, h))  # the first of each hash in this batch leads its run
            h, g, pos, doc = h[order], g[order], pos[order], doc[order]
            lead = np.ones(len(h), bool)
            lead[1:] = (h[1:] != h[:-1]) | (g[1:] != g[:-1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(h.view(np.int64)), pa.array(g.astype(np.int64)), pa.array(ids[doc]), pa.array(num[doc]), pa.array(pos.astype(np.int32)), pa.array(lead)],
                ["h", "g", "doc_id", "num", "pos", "lead"],
            )

    return run


def _strip(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            removed, digests = [], []
            for words, marks in zip(_unpacked(b.column(1)), b.column(2), strict=True):
                gone = np.zeros(len(words) + 1, np.int64)
                if marks.is_valid:
                    at = marks.values.to_numpy()
                    np.add.at(gone, at, 1)
                    np.add.at(gone, at + window, -1)
                keep = np.cumsum(gone)[:-1] == 0
                removed.append(int(len(words) - keep.sum()))
                digests.append(hashlib.sha256(b" ".join([w for w, k in zip(words, keep, strict=True) if k])).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(removed, pa.int64()), pa.array(digests)], ["num", "n_removed", "kept_sha256"])

    return run


def repeated_windows(docs: DataFrame, window: int = WINDOW, gram: int = ANCHOR) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(described, firsts, suspects, marks) for docs (doc_id, text).

    described: doc_id, n_words and digest of every row. firsts: the smallest id of every digest. suspects: num, doc_id, digest and packed words of the documents that may have repeated windows. marks: num and the starts of their windows
    that begin earlier elsewhere.
    """
    docs = docs.select("doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    seen = written(docs.mapInArrow(_describe(window, gram), f"doc_id {kind}, n_words long, digest binary, anchors array<long>, again array<long>"), "anchors")
    firsts = written(seen.groupBy("digest").agg(F.min(F.coalesce("doc_id", F.lit(-(2**63)))).alias("first")), "first-sequences")

    content = F.xxhash64("digest").alias("s")
    once = seen.select(F.explode("anchors").alias("a"), content)
    twice = seen.select(F.explode("again").alias("a"), content).withColumn("again", F.lit(True))
    counted = once.withColumn("again", F.lit(False)).unionByName(twice).groupBy("a").agg(F.min("s").alias("least"), F.max("s").alias("most"), F.max("again").alias("again"))
    common = written(counted.filter("least <> most OR again").select("a"), "common-anchors")
    by_content = once.join(common, "a", "left_semi").groupBy("s").agg(F.collect_set("a").alias("anchors"))

    chosen = firsts.withColumn("s", F.xxhash64("digest")).join(by_content, "s").drop("s")
    packed = docs.mapInArrow(_pack, f"doc_id {kind}, digest binary, packed binary").withColumn("doc_id", F.coalesce("doc_id", F.lit(-(2**63))))
    suspects = packed.join(chosen.withColumnRenamed("first", "doc_id"), ["doc_id", "digest"]).withColumn("num", F.monotonically_increasing_id())
    suspects = written(suspects.select("doc_id", "digest", "packed", "anchors", "num"), "suspects")

    rows = suspects.select("doc_id", "num", "packed", "anchors").mapInArrow(_windows(window, gram), "h long, g long, doc_id long, num long, pos int, lead boolean")
    # repeats within a batch need no comparison: they form groups of their own, in which nothing is first
    rows = rows.withColumns({"own": F.when(F.col("lead"), F.lit(-1).cast("long")).otherwise(F.col("num"))})
    order = Window.partitionBy("h", "g", "own").orderBy("doc_id", "num", "pos")
    marks = rows.withColumn("r", F.row_number().over(order)).filter("r > 1 OR NOT lead").groupBy("num").agg(F.collect_list("pos").alias("marks"))
    return seen.select("doc_id", "n_words", "digest"), firsts, suspects, marks


def strip_repeats(docs: DataFrame, window: int = WINDOW, gram: int = ANCHOR) -> DataFrame:
    """n_words, n_removed and kept_sha256 of every row of docs (doc_id, text).

    Words are runs of characters other than the ASCII blanks; null and empty texts have none. A word goes if it is in a
    window whose words also start earlier: in a smaller id, or before in the same document. Rows with the same id and the
    same words are one document, repeated; of rows with the same id and other words either may count as earlier. A null
    id is the smallest. Other columns are left out.
    """
    seen, firsts, suspects, marks = repeated_windows(docs, window, gram)
    fate = suspects.select("num", "packed").join(marks, "num", "left").select("num", "packed", "marks").mapInArrow(_strip(window), "num long, n_removed long, kept_sha256 string")
    # a first row that is repeated is a suspect each time; the least number is judged before the others and so rightly
    fate = suspects.select("num", "digest").join(fate, "num").groupBy("digest").agg(F.min(F.struct("num", "n_removed", "kept_sha256")).alias("f"))
    fate = fate.select("digest", "f.n_removed", "f.kept_sha256")
    is_first = F.coalesce("doc_id", F.lit(-(2**63))) == F.col("first")
    # written, so that a digest that many rows share can be split when it meets its one row here
    joined = seen.join(written(firsts.join(fate, "digest", "left"), "sequence-fates"), "digest")
    whole = ~is_first & (F.col("n_words") >= window)
    return joined.select(
        "doc_id",
        "n_words",
        F.when(whole, F.col("n_words")).when(is_first, F.coalesce("n_removed", F.lit(0))).otherwise(0).cast("long").alias("n_removed"),
        F.when(whole, F.lit(EMPTY)).when(is_first & F.col("kept_sha256").isNotNull(), F.col("kept_sha256")).otherwise(F.lower(F.hex("digest"))).alias("kept_sha256"),
    )


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return strip_repeats(table(spark, sf_dir, "documents"))


ORACLE = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (
  SELECT doc_id, p, array_to_string(list_slice(w, p, p + {WINDOW - 1}), ' ') AS s
  FROM d, unnest(range(1, len(w) - {WINDOW - 2})) r(p) WHERE len(w) >= {WINDOW}),
later AS (SELECT doc_id, p FROM win QUALIFY row_number() OVER (PARTITION BY s ORDER BY doc_id, p) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + {WINDOW})) AS i FROM later),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS t, count(*) AS n FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY 1)
SELECT d.doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept ON kept.doc_id = d.doc_id
"""
