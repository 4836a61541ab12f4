"""Benchmark decontamination: n-gram seeds, then Smith-Waterman alignment.

All n-grams of an item are seeds, however common, and n is so small that no alignment that reaches the threshold is
without one. A change, a missing or an added word costs something, so such an alignment also has a least number of seeds,
and these stand close to one diagonal. Where so many seeds of an item stand in a document, the passage around them is
aligned with the item by words; the score is the alignment's share of a perfect one, so copies with changed, missing and
added words are found too. The number of seeds and an upper bound from the words in common spare most alignments and
change no result: it is that of aligning every document with every item.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from urbanframe.llm.common import slices, table

#: Most words of a seed, share of a perfect alignment that counts as a leak, and the scores of a match, a change and a gap.
SEED, THRESHOLD = 3, 0.6
MATCH, CHANGE, GAP = 2, -1, -1
#: Words of the test items that are searched in one pass; more items take more passes.
BLOCK_WORDS = 500_000
WORD = re.compile(r"[^\W_]+")


def words_of(text: str | None) -> list[str]:
    """Lower-cased runs of letters and digits."""
    return WORD.findall(text.lower()) if text else []


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int, int]:
    """Smith-Waterman by rows: the best score, and where its alignment begins and ends in the passage."""
    score, end_item, end = _best(item, passage)
    if not score:
        return 0, 0, 0
    # the same alignment from its end backwards, up to where it reaches the score
    _, _, length = _best(item[:end_item][::-1], passage[:end][::-1])
    return score, end - length, end


def _best(item: np.ndarray, passage: np.ndarray) -> tuple[int, int, int]:
    steps = -GAP * np.arange(len(passage) + 1)
    above, best = np.zeros(len(passage) + 1, np.int64), (0, 0, 0)
    for i, word in enumerate(item, 1):
        here = np.zeros_like(above)
        here[1:] = above[:-1] + np.where(passage == word, MATCH, CHANGE)
        np.maximum(here, above + GAP, out=here)
        np.maximum(here, 0, out=here)
        above = np.maximum.accumulate(here + steps) - steps  # gaps along the passage
        at = int(above.argmax())
        if above[at] > best[0]:
            best = (int(above[at]), i, at)
    return best


def _least_seeds(n: int, size: int, threshold: float) -> float:
    """How many seeds of size words an alignment with an item of n words has at least, if it reaches the threshold.

    Of m matches in r runs, m - r * (size - 1) or more begin a seed. The r - 1 changes or gaps between the runs cost one or
    more each, and no more than MATCH * m less the score can be lost; for a size of two or more the least is at m = n.
    """
    return n * threshold if size == 1 else n - (size - 1) * (MATCH * n * (1 - threshold) + 1)


@dataclass
class ItemIndex:
    """Seeds of a block of test items."""

    items: list[tuple[object, list[str]]]
    seed: int = SEED
    threshold: float = THRESHOLD
    vocabulary: dict[str, int] = field(default_factory=dict)
    coded: list[np.ndarray] = field(default_factory=list)

    def __post_init__(self) -> None:
        for _, words in self.items:
            self.coded.append(np.array([self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words], np.int64))
        sizes = [self._size(len(x)) for x in self.coded]
        self.sizes = sorted(set(sizes))
        codes = [self.codes(x, size) for x, size in zip(self.coded, sizes, strict=True)]
        every, owner = np.concatenate(codes), np.repeat(np.arange(len(codes)), [len(c) for c in codes])
        order = np.argsort(every, kind="stable")
        self.grams, first = np.unique(every[order], return_index=True)  # sorted codes
        self.first = np.append(first, len(every))  # of each gram in owner and place
        self.owner, self.place = owner[order], np.concatenate([np.arange(len(c)) for c in codes])[order]
        self.lengths = np.array([len(x) for x in self.coded], np.int64)
        self.least = np.array([max(1, math.ceil(_least_seeds(len(x), size, self.threshold) - 1e-9)) for x, size in zip(self.coded, sizes, strict=True)], np.int64)
        # gaps that an alignment can have, so how far its seeds can be from one diagonal
        self.drift = np.floor(MATCH * self.lengths * (1 - self.threshold) + 1e-9).astype(np.int64)

    def _size(self, n: int) -> int:
        return next((k for k in range(min(self.seed, n), 1, -1) if _least_seeds(n, k, self.threshold) > 1e-9), 1)

    def codes(self, x: np.ndarray, size: int) -> np.ndarray:
        """One number for each run of size words; runs with a word that no item has get -1. Shorter runs never equal longer ones."""
        n, base = len(x) - size + 1, len(self.vocabulary) + 1
        if n <= 0 or not size:
            return np.zeros(0, np.int64)
        code, known = np.zeros(n, np.int64), np.ones(n, bool)
        for k in range(size):
            part = x[k : n + k]
            code = code * base + part
            known &= part > 0
        return np.where(known, code, -1)

    def encode(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.vocabulary.get, words, repeat(0)), np.int64, len(words))

    def hits(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in a document, and numbers of the grams that stand there."""
        places, numbers = [], []
        for size in self.sizes:
            codes = self.codes(x, size)
            at = np.flatnonzero(codes >= 0)
            k = np.minimum(np.searchsorted(self.grams, codes[at]), len(self.grams) - 1)
            good = self.grams[k] == codes[at]
            places.append(at[good])
            numbers.append(k[good])
        return (np.concatenate(places), np.concatenate(numbers)) if places else (np.zeros(0, np.int64),) * 2

    def near(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Items and diagonals, in order, of the seeds in a document from which on there are enough for an alignment."""
        places, numbers = self.hits(x)
        times = self.first[numbers + 1] - self.first[numbers]
        k = np.repeat(self.first[numbers] - np.cumsum(times) + times, times) + np.arange(times.sum())
        item, diagonal = self.owner[k], np.repeat(places, times) - self.place[k]
        enough = np.bincount(item, minlength=len(self.items)) >= self.least
        item, diagonal = item[enough[item]], diagonal[enough[item]]
        low = int(self.lengths.max())
        width = len(x) + low + int(self.drift.max()) + 1  # so no drift reaches the next item's
        key = np.sort(item * width + diagonal + low)
        item = key // width
        good = np.searchsorted(key, key + self.drift[item], "right") - np.arange(len(key)) >= self.least[item]
        return item[good], key[good] % width - low

    def leaks(self, x: np.ndarray) -> list[tuple[int, float, int, int]]:
        """(item, score, first word, word after the last) of the best passage for each item that reaches the threshold."""
        spans: dict[int, list[tuple[int, int]]] = {}
        for item, diagonal in zip(*(v.tolist() for v in self.near(x)), strict=True):
            slack = int(self.drift[item])
            spans.setdefault(item, []).append((max(0, diagonal - slack), min(len(x), diagonal + len(self.coded[item]) + slack)))
        out = []
        for item, own in spans.items():
            word, best = self.coded[item], (0, 0, 0)
            need = Counter(word.tolist())
            for lo, hi in _merged(own):
                have = Counter(x[lo:hi].tolist())
                if sum(min(n, have[w]) for w, n in need.items()) < self.threshold * len(word) - 1e-9:
                    continue
                score, start, end = align(word, x[lo:hi])
                if score > best[0]:
                    best = (score, lo + start, lo + end)
            if best[0] and best[0] >= self.threshold * MATCH * len(word) - 1e-9:
                out.append((item, best[0] / (MATCH * len(word)), best[1], best[2]))
        return out


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for lo, hi in sorted(spans):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], hi))
        else:
            out.append((lo, hi))
    return out


def _blocks(items: DataFrame, seed: int, threshold: float) -> Iterator[ItemIndex]:
    block, size = [], 0
    for item, text in items.toLocalIterator():
        words = words_of(text)
        if not words:
            continue
        block.append((item, words))
        size += len(words)
        if size >= BLOCK_WORDS:
            yield ItemIndex(block, seed, threshold)
            block, size = [], 0
    if block:
        yield ItemIndex(block, seed, threshold)


def find_leaks(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """doc_id, item_id, score, start_word and end_word of every document and test item with an alignment of threshold or more.

    The best passage of a document for an item is given, the first of equally good ones. Words are lower-cased runs of
    letters and digits; items and documents without any match nothing. Repeated documents and items are searched each on their own; null ids are kept. Other columns are left out.
    Ids are of any type. Items are searched in blocks of BLOCK_WORDS words, each in a pass over all documents: the index of a
    block is what is broadcast, so its size is bounded, and the time grows with documents times blocks of items.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    tests = items.select(F.col(item_col).alias("item_id"), F.col(item_text_col).alias("text"))
    kinds = rows.schema["doc_id"].dataType, tests.schema["item_id"].dataType
    schema = f"doc_id {kinds[0].simpleString()}, item_id {kinds[1].simpleString()}, score double, start_word long, end_word long"
    out = docs.sparkSession.createDataFrame([], schema)
    item_type = to_arrow_type(kinds[1])
    for index in _blocks(tests, seed, threshold):
        sent = docs.sparkSession.sparkContext.broadcast(index)

        def search(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            index = sent.value
            for b in slices(batches):
                at, found = [], []
                for i, text in enumerate(b.column(1).to_pylist()):
                    new = index.leaks(index.encode(words_of(text)))
                    at += [i] * len(new)
                    found += new
                k = list(zip(*found, strict=True)) or [()] * 4
                ids = pa.array([index.items[i][0] for i in k[0]], item_type)
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at, pa.int64())), ids, pa.array(k[1], pa.float64()), pa.array(k[2], pa.int64()), pa.array(k[3], pa.int64())], ["doc_id", "item_id", "score", "start_word", "end_word"])

        out = out.union(rows.mapInArrow(search, schema))
    return out


def without_leaks(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, seed: int = SEED, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The rows of docs, with all their columns, that find_leaks would find no leak in; no row is exchanged."""
    tests = items.select(item_col, item_text_col)
    at, out = docs.columns.index(text_col), docs
    for index in _blocks(tests, seed, threshold):
        sent = docs.sparkSession.sparkContext.broadcast(index)
        out = out.mapInArrow(_clean(sent, at), docs.schema)
    return out


def _clean(sent, at: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = sent.value
        for b in slices(batches):
            yield b.filter(pa.array([not index.leaks(index.encode(words_of(t))) for t in b.column(at).to_pylist()], pa.bool_()))

    return run


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
