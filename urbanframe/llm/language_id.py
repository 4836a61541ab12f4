"""Language identification by string kernels.

The kernel of two texts is the blended spectrum of presence: for n from 1 to ``max_n``, the number of distinct character
n-grams that both have, over the root of the product of their own numbers, averaged over n. Letters count in lower case,
and all other characters as one and the same. Landmarks are drawn from the
labelled sample (Nystroem), and one-versus-rest ridge regression on the landmark features learns a weight for each
landmark and language. A batch of whole texts is scored by two matrix products: n-gram presence times the landmarks'
presence, and the normalised kernel times the weights.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, replace
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType
from pyspark.sql.window import Window

from urbanframe.llm.common import slices, table

UNKNOWN = "und"
#: Bound of the labelled sample: rows of each language, fewer if all languages together would have more than MAX_TRAIN.
TRAIN_ROWS, MAX_TRAIN = 400, 25_600
#: Languages that are learned at most, and characters of a text that is learned from.
MAX_LANGS, LONGEST = 1_000, 1 << 20
#: Landmarks of each language (fewer, but one at least, if all together would be more than MAX_LANDMARKS), n-gram sizes,
#: ridge, and how sharply the outputs are turned into shares.
LANDMARKS, MAX_LANDMARKS, MAX_N, RIDGE, SHARPNESS = 24, 512, 3, 1e-3, 6.0
BATCH = 64
#: Bits of a character in the code of an n-gram; three fit into 63. Tables of flags have so many places at most.
BITS, MOST_FLAGS = 21, 1 << 22


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


@lru_cache(1)
def _is_letter() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


def grams(texts: Sequence[str], max_n: int) -> list[list[np.ndarray]]:
    """For each text and n the sorted codes of its different n-grams."""
    points = [np.frombuffer(t.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64) for t in texts]
    every = np.concatenate(points) if points else np.zeros(0, np.int64)
    letters, number = np.unique(np.where(_is_letter()[every], every, 0), return_inverse=True)
    base, at, out = len(letters), 0, [[] for _ in texts]
    flags = [np.zeros(base**n, bool) if base**n <= MOST_FLAGS else None for n in range(1, max_n + 1)]
    for own, p in zip(out, points, strict=True):
        s = number[at : at + len(p)]
        at += len(p)
        code = s  # n-grams as numbers in the base of the letters of these texts
        for n, flag in enumerate(flags, 1):
            if n > 1:
                code = code[:-1] * base + s[n - 1 :] if len(s) >= n else s[:0]
            if flag is None:
                found = np.unique(code)
            else:
                flag[code] = True
                found = np.flatnonzero(flag)
                flag[found] = False
            whole, rest = np.zeros(len(found), np.int64), found
            for k in range(n):
                whole |= letters[rest % base] << (BITS * k)
                rest = rest // base
            own.append(whole)
    return out


@dataclass(frozen=True)
class Model:
    max_n: int
    langs: tuple[str, ...]
    codes: tuple[np.ndarray, ...]  # for each n: the sorted codes that landmarks have
    presence: np.ndarray  # landmarks x codes of all n, as bits
    sizes: np.ndarray  # landmarks x n, different n-grams
    weights: np.ndarray  # landmarks + 1 x languages

    def features(self, texts: Sequence[str]) -> np.ndarray:
        """The kernel of every text with every landmark."""
        width = [len(c) for c in self.codes]
        landmarks = np.unpackbits(self.presence, axis=1, count=sum(width)).astype(np.float32)
        out = np.zeros((len(texts), len(self.sizes)), np.float32)
        for at in range(0, len(texts), BATCH):
            part = texts[at : at + BATCH]
            x = np.zeros((len(part), sum(width)), np.float32)
            own = np.zeros((len(part), self.max_n), np.float32)
            for i, found in enumerate(grams(part, self.max_n)):
                offset = 0
                for n, (codes, known) in enumerate(zip(found, self.codes, strict=True)):
                    own[i, n] = len(codes)
                    if len(known):
                        k = np.minimum(np.searchsorted(known, codes), len(known) - 1)
                        x[i, offset + k[known[k] == codes]] = 1
                    offset += len(known)
            offset = 0
            for n, w in enumerate(width):
                shared = x[:, offset : offset + w] @ landmarks[:, offset : offset + w].T
                out[at : at + BATCH] += shared / np.sqrt(np.maximum(own[:, n, None] * self.sizes[None, :, n], 1))
                offset += w
        return out / self.max_n

    def predict(self, texts: Sequence[str | None]) -> tuple[list[str], np.ndarray]:
        """A language and a score from 0 to 1 for each text; und and 0 for null and for texts without a letter."""
        known = [i for i, t in enumerate(texts) if t and has_letter(t)]
        langs, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        if known and self.langs:
            k = self.features([texts[i] for i in known])
            outputs = np.hstack([k, np.ones((len(k), 1), np.float32)]) @ self.weights
            shares = np.exp(SHARPNESS * (outputs - outputs.max(1, keepdims=True)))
            shares /= shares.sum(1, keepdims=True)
            for i, best, share in zip(known, shares.argmax(1), shares.max(1), strict=True):
                langs[i], scores[i] = self.langs[best], share
        return langs, scores


def fit(rows: Iterable[tuple[str, str]], landmarks: int = LANDMARKS, max_n: int = MAX_N, ridge: float = RIDGE) -> Model:
    """A model from (text, language) rows; texts that are null or have no letter are left out. Equal rows give equal models."""
    rows = [(t, lang) for t, lang in rows if t and lang is not None and has_letter(t)]
    langs = tuple(sorted({lang for _, lang in rows}))
    each = max(1, min(landmarks, MAX_LANDMARKS // max(1, len(langs))))
    chosen = [t for lang in langs for t in [x for x, y in rows if y == lang][:each]]
    found = grams(chosen, max_n)
    codes = tuple(np.unique(np.concatenate([g[n] for g in found])) if found else np.zeros(0, np.int64) for n in range(max_n))
    presence = np.zeros((len(chosen), sum(map(len, codes))), np.uint8)
    for i, g in enumerate(found):
        offset = 0
        for n in range(max_n):
            presence[i, offset + np.searchsorted(codes[n], g[n])] = 1
            offset += len(codes[n])
    sizes = np.array([[len(x) for x in g] for g in found], np.float32).reshape(len(chosen), max_n)
    model = Model(max_n, langs, codes, np.packbits(presence, axis=1), sizes, np.zeros((len(chosen) + 1, len(langs)), np.float32))
    if not rows:
        return model
    k = model.features([t for t, _ in rows]).astype(float)
    own = model.features(chosen).astype(float)
    values, vectors = np.linalg.eigh((own + own.T) / 2)
    good = values > 1e-6 * values.max()
    half = vectors[:, good] / np.sqrt(values[good])
    phi = np.hstack([k @ half, np.ones((len(k), 1))])
    y = np.where(np.array([lang for _, lang in rows])[:, None] == np.array(langs)[None, :], 1.0, -1.0)
    share = np.array([1 / sum(x == lang for _, x in rows) for _, lang in rows])[:, None]  # all languages weigh the same
    a = phi.T @ (phi * share) + ridge * np.eye(phi.shape[1])
    w = np.linalg.solve(a, phi.T @ (y * share))
    weights = np.vstack([half @ w[:-1], w[-1:]]).astype(np.float32)
    return replace(model, weights=weights)


def labelled_sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str, rows: int = TRAIN_ROWS) -> list[tuple[str, str]]:
    """At most ``rows`` texts of each language, in the order of a hash of the id; fewer if all would be more than MAX_TRAIN.

    Languages are counted over all rows; with more than MAX_LANGS the most frequent ones are learned, of equally frequent
    ones the first by name. Texts of more than LONGEST characters aren't learned from. Of each one only the ids are exchanged whose hash is below a share that leaves
    three times as many as are wanted, so their number doesn't grow with the table; then the chosen texts are read whole.
    """
    spark, low_bits = docs.sparkSession, (1 << 32) - 1
    frequent = docs.groupBy(F.col(lang_col).alias("lang")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang")
    counts = {r.lang: r.n for r in frequent.limit(MAX_LANGS).collect()}
    rows = max(1, min(rows, MAX_TRAIN // max(1, len(counts))))
    shares = spark.createDataFrame([(lang, int(min(1.0, (3 * rows + 50) / n) * (1 << 32))) for lang, n in counts.items()], "lang string, below long")
    own = docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.xxhash64(id_col).alias("h"))
    few = own.join(F.broadcast(shares), "lang").filter(F.col("h").bitwiseAND(low_bits) < F.col("below"))
    order = Window.partitionBy("lang").orderBy(F.col("h").bitwiseAND(low_bits), "id")
    ids = few.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= rows).select("id").distinct()
    texts = docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("t"))
    found = texts.join(F.broadcast(ids), "id").join(F.broadcast(shares.select("lang")), "lang").filter(F.length("t") <= LONGEST).select("id", "lang", "t").orderBy(F.xxhash64("id"), "id", "lang", "t").limit(MAX_TRAIN + len(counts))
    return [(r.t, r.lang) for r in found.collect()]


def held_out(id_col: str = "doc_id"):
    """A quarter of all rows, by the CRC of the id as text; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """Adds lang_pred and score to every row, reading whole texts.

    Null texts and texts without a letter are und with score 0, as is every text where nothing could be learned. Rows,
    repeated ones and other columns pass through; columns with the added names are replaced.
    """
    rest = [c for c in docs.columns if c not in ("lang_pred", "score")]
    rows = docs.select(*rest)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    at = rest.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            langs, scores = sent.value.predict(batch.column(at).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(langs, pa.string()), pa.array(scores)], [*batch.schema.names, "lang_pred", "score"])

    return rows.mapInArrow(run, StructType([*rows.schema.fields, StructField("lang_pred", StringType()), StructField("score", DoubleType())]))


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """A model from the labelled rows that are not held out."""
    return fit(labelled_sample(docs.filter(~held_out(id_col) & F.col(lang_col).isNotNull()), id_col, text_col, lang_col))


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = learn(docs.select("doc_id", "text", "lang"))
    return identify(docs.select("doc_id", "text"), model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
