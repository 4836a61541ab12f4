"""Filter interaction audit: what each of five filters removes in every order in which they can be applied.

A document's failures are five bits. A table of 32 by 120 gives, for any failures and any order of the filters, the step
at which the document goes. Tasks look their documents up in it and count removals by part, order and step, for all
documents, good ones and toxic ones, with ``np.bincount``; the tasks' counts are then summed. So no document meets an
order more than once, and what is exchanged is one row for each task, part and order.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from urbanframe.llm.common import slices, table, written

FILTERS = "ABCDE"
ORDERS = tuple("".join(p) for p in permutations(FILTERS))
#: A: fewer words. B: a lower share of distinct words in percent. C: a higher share of capitals. D: one of these characters.
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 100, 80, 10
ODD = re.compile(rb"[#$%&*|]")
CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
#: Parts that a task counts at a time, at 20 kB each; with more it sends what it has.
MOST_PARTS = 256
STEPS = range(1, len(FILTERS) + 1)


def first_failures() -> np.ndarray:
    """For failures (bit k: filter k) and orders, the number of steps passed before a document goes; 5 if none fails it."""
    place = np.array([[order.index(f) for f in FILTERS] for order in ORDERS])
    fails = (np.arange(32)[:, None] >> np.arange(5)) & 1 == 1
    return np.where(fails[:, None, :], place[None], len(FILTERS)).min(2)


def failures(text: str | None) -> int:
    """Bits of filters A to D for a whole text; null is empty."""
    data = (text or "").encode()
    words = data.split()  # bytes: the six ASCII blanks only
    upper = len(data) - len(data.translate(None, CAPITALS))
    low = 100 * len(set(words)) < LEAST_DISTINCT * len(words)
    return (len(words) < LEAST_WORDS) | low << 1 | (100 * upper > MOST_CAPITALS * len(text or "")) << 2 | bool(ODD.search(data)) << 3


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches, 100):
        texts = b.column(2).to_pylist()
        fails = pa.array([failures(t) for t in texts], pa.int32())
        digests = pa.array([hashlib.sha256((t or "").encode()).digest() for t in texts], pa.binary())
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), fails, digests], ["doc_id", "part", "fails", "digest"])


class _Counts:
    """Removals (label, order, step) and failures (filter; filter alone) of one part's documents."""

    def __init__(self) -> None:
        self.gone = np.zeros((3, len(ORDERS), 6), np.int64)
        self.masks = np.zeros(32, np.int64)

    def add(self, fails: np.ndarray, labels: tuple[np.ndarray, ...], steps: np.ndarray) -> None:
        """labels: which documents count; steps: the table."""
        size = len(ORDERS) * 6
        at = np.arange(len(ORDERS)) * 6 + steps[fails]
        for k, label in enumerate(labels):
            self.gone[k] += np.bincount(at[label].ravel(), minlength=size).reshape(len(ORDERS), 6)
        self.masks += np.bincount(fails, minlength=32)

    def rows(self, part: str) -> pa.RecordBatch:
        n = len(ORDERS)
        same = lambda v: pa.array(np.full(n, v, np.int64))
        bits = (np.arange(32)[:, None] >> np.arange(5)) & 1
        columns = {"part": pa.array([part] * n), "filter_order": pa.array(ORDERS), "docs": same(self.masks.sum())}
        for k, name in enumerate(("removed", "good", "toxic")):
            columns |= {f"{name}{s}": pa.array(self.gone[k, :, s - 1]) for s in STEPS}
        columns |= {f"fails{f}": same(self.masks @ bits[:, k]) for k, f in enumerate(FILTERS)}
        columns |= {f"only{f}": same(self.masks[1 << k]) for k, f in enumerate(FILTERS)}
        return pa.RecordBatch.from_pydict(columns)


NUMBERS = ["docs", *(f"{name}{s}" for name in ("removed", "good", "toxic") for s in STEPS), *(f"{name}{f}" for name in ("fails", "only") for f in FILTERS)]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (part, fails, good, toxic) the counts of each part, a row for each order."""
    steps, parts = first_failures(), {}
    for b in slices(batches, 2000):
        found = b.column(0).dictionary_encode()
        codes, names = found.indices.to_numpy(), found.dictionary.to_pylist()
        fails, good, toxic = (b.column(k).to_numpy(zero_copy_only=False) for k in (1, 2, 3))
        for k, name in enumerate(names):
            own = codes == k
            parts.setdefault(name, _Counts()).add(fails[own], (slice(None), good[own], toxic[own]), steps)
            if len(parts) >= MOST_PARTS:
                yield from (c.rows(p) for p, c in parts.items())
                parts = {}
    yield from (c.rows(p) for p, c in parts.items())


def failing(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, part, fails, good, toxic) for every row of docs (doc_id, text, lang); fails has a bit for each filter.

    E fails rows whose whole text is that of a row with a smaller doc_id: the smallest id of every text is found by its
    SHA-256, and rows meet it by text and id, so that copies of one text, however many, spread over all tasks. A row with
    a null id is no copy and makes none. Labels (doc_id, quality, toxic) may repeat: a document is good if any of its
    labels has quality 1, and toxic if any has toxic 1; labels without an id count for nothing.
    """
    read = docs.select(F.col("doc_id"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"), F.col("text"))
    kind = read.schema["doc_id"].dataType.simpleString()
    judged = written(read.mapInArrow(_judge, f"doc_id {kind}, part string, fails int, digest binary"), "failures")
    first = judged.filter("doc_id IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("is_first", F.lit(True))
    marks = labels.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    rows = judged.join(written(first, "first-ids"), ["digest", "doc_id"], "left").join(written(marks, "marks"), "doc_id", "left")
    copy = (F.col("doc_id").isNotNull() & F.col("is_first").isNull()).cast("int")
    known = lambda c: F.coalesce(F.col(c), F.lit(False)).alias(c)
    return rows.select("doc_id", "part", F.col("fails").bitwiseOR(copy * 16).alias("fails"), known("good"), known("toxic"))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row for each part (lang; null is the empty string), order of the five filters and step, zeros included.

    kept: documents left after the step. removed: gone at it. redundant: failing its filter but gone before. unique_fails:
    failing its filter only. good_lost, toxic_lost: removed and labelled so. shapley: removed by its filter, summed over
    all orders. Null texts are empty; repeated rows all count. Columns other than doc_id, text and lang are not read. A
    table without rows has no parts and gives no row.
    """
    names = ", ".join(f"{n} long" for n in NUMBERS)
    counts = failing(docs, labels).select("part", "fails", "good", "toxic").mapInArrow(_count, f"part string, filter_order string, {names}")
    total = counts.groupBy("part", "filter_order").agg(*(F.sum(n).alias(n) for n in NUMBERS))
    letter = lambda s: F.substring("filter_order", s, 1)
    of = lambda name, s: F.coalesce(*(F.when(letter(s) == f, F.col(f"{name}{f}")) for f in FILTERS))
    gone = lambda s: sum((F.col(f"removed{k}") for k in range(1, s + 1)), F.lit(0))
    step = lambda s: F.struct(
        F.lit(s).alias("step"), letter(s).alias("filter"), (F.col("docs") - gone(s)).alias("kept"), F.col(f"removed{s}").alias("removed"),
        (of("fails", s) - F.col(f"removed{s}")).alias("redundant"), of("only", s).alias("unique_fails"),
        F.col(f"good{s}").alias("good_lost"), F.col(f"toxic{s}").alias("toxic_lost"),
    )
    rows = total.select("part", "filter_order", F.inline(F.array(*map(step, STEPS))))
    # 120 rows in each window
    return rows.withColumn("shapley", F.sum("removed").over(Window.partitionBy("part", "filter"))).drop("filter")


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ORACLE = r"""
WITH t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w, coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false) AS copy FROM t),
marks AS (SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic FROM labels GROUP BY 1),
f AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
         MAP {'A': len(w) < 100, 'B': 100 * len(list_distinct(w)) < 80 * len(w),
              'C': 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text),
              'D': regexp_matches(text, '[#$%&*|]'), 'E': copy} AS fails
  FROM w LEFT JOIN marks ON marks.doc_id = w.doc_id),
g AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM f GROUP BY 1, 2),
l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l),
o AS (
  SELECT [a.l, b.l, c.l, d.l, e.l] AS o FROM l a, l b, l c, l d, l e
  WHERE len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5),
s AS (SELECT o, unnest([1, 2, 3, 4, 5]) AS step FROM o),
r AS (
  SELECT part, array_to_string(o, '') AS filter_order, step, o[step] AS own,
         fails[o[step]] AS fail, len(list_filter(o[:step - 1], lambda k: fails[k])) > 0 AS gone,
         len(list_filter(o, lambda k: fails[k])) AS all_fails, n, good, toxic
  FROM g, s),
a AS (
  SELECT part, filter_order, step, own, coalesce(sum(n) FILTER (NOT gone AND NOT fail), 0) AS kept, coalesce(sum(n) FILTER (fail AND NOT gone), 0) AS removed,
         coalesce(sum(n) FILTER (fail AND gone), 0) AS redundant, coalesce(sum(n) FILTER (fail AND all_fails = 1), 0) AS unique_fails,
         coalesce(sum(good) FILTER (fail AND NOT gone), 0) AS good_lost, coalesce(sum(toxic) FILTER (fail AND NOT gone), 0) AS toxic_lost
  FROM r GROUP BY 1, 2, 3, 4)
SELECT part, filter_order, step::INTEGER AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM a
"""
