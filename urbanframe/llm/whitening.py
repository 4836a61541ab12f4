"""Embedding whitening: a covariance merged from partitions, its eigenvectors, and a second pass that verifies the result.

Entries become whole numbers first, so sums are exact. Every task reduces its vectors to a count, exact sums, a mean and a
centred scatter matrix; two such summaries merge by the pairwise formula of Chan, Golub and LeVeque, and ``treeReduce``
merges them in a tree. A summary's size depends on the vectors' length alone, so what reaches the driver is bounded. The
driver takes the eigenvectors, and a second pass over the same vectors summarises what they became: its covariance must
be the identity.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from urbanframe.llm.common import table, written

#: Entries are counted in steps of 1 / SCALE.
SCALE = 256
COMPONENTS = 4
#: A summary has the square of a vector's length in numbers: 128 MB at this length. Longer vectors are refused.
MOST_ENTRIES = 4096
#: Rows of the matrices that a task works on at a time are such that they hold about this many entries.
BLOCK_ENTRIES = 1 << 18
#: Levels of the tree in which summaries merge.
DEPTH = 3
#: Whole numbers up to here can be multiplied or summed in pairs without leaving 64 bits or losing digits as doubles.
SAFE = 2**31


@dataclass(frozen=True)
class Summary:
    """n vectors: exact sums as Python numbers (none for doubles), mean and centred scatter."""

    n: int
    sums: list[int]
    mean: np.ndarray
    scatter: np.ndarray

    def merged(self, other: Summary) -> Summary:
        """Both together; the scatter between their means is added to those around them."""
        if not self.n or not other.n:
            return self if self.n else other
        n, apart = self.n + other.n, other.mean - self.mean
        between = np.outer(apart, apart) * (self.n * (other.n / n))
        sums = [a + b for a, b in zip(self.sums, other.sums, strict=True)]
        return Summary(n, sums, self.mean + apart * (other.n / n), self.scatter + other.scatter + between)


NOTHING = Summary(0, [], np.zeros(0), np.zeros((0, 0)))


@dataclass(frozen=True)
class Whitening:
    """The fit: ``axes`` has a unit eigenvector in each column, by falling eigenvalue; ``error`` is set by the second pass."""

    n: int
    sums: list[int]
    values: np.ndarray
    axes: np.ndarray
    explained: np.ndarray
    error: float | None = None

    @property
    def size(self) -> int:
        return len(self.sums)

    def project(self, x: np.ndarray) -> np.ndarray:
        """x without its mean, on every component, over the root of its eigenvalue; NaN where there is no variance."""
        mean = np.array([s / self.n for s in self.sums])
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(self.values > 0, (x - mean) @ self.axes / np.sqrt(self.values), np.nan)


def steps(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * entry) of every entry as long; null for a vector that is null or empty, or has null or non-finite entries."""
    finite = ~F.exists(vector, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")))
    return F.when((F.size(vector) > 0) & finite, F.transform(vector, lambda c: F.floor(c.cast("double") * F.lit(float(scale)))))


def _matrices(column: pa.Array) -> Iterator[np.ndarray]:
    """Equally long vectors as the rows of whole-number matrices, some at a time."""
    size = len(column[0]) if len(column) else 0
    rows = max(1, BLOCK_ENTRIES // max(1, size))
    for at in range(0, len(column), rows):
        yield column.slice(at, rows).flatten().to_numpy().reshape(-1, size)


def _exact_sums(x: np.ndarray) -> list[int]:
    wide = x if np.abs(x, dtype=float).max(initial=0) < SAFE else x.astype(object)
    return [int(s) for s in wide.sum(0)]


def summary(x: np.ndarray) -> Summary:
    """Of a matrix of whole numbers or doubles with at least one row, centred before it is multiplied."""
    whole = x.dtype.kind == "i"
    sums = _exact_sums(x) if whole else []
    mean = np.array([s / len(x) for s in sums]) if whole else x.mean(0)
    centred = x - mean
    return Summary(len(x), sums or [0] * x.shape[1], mean, centred.T @ centred)


def _summaries(model: Whitening | None):
    """One row for each task: the summary of its vectors, or of what the model makes of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = NOTHING
        for b in batches:
            for x in _matrices(b.column(0)):
                total = total.merged(summary(x if model is None else model.project(x)))
        if total.n:
            columns = [pa.array([total.n], pa.int64()), pa.array([[str(s) for s in total.sums]]), pa.array([total.mean.tobytes()]), pa.array([total.scatter.tobytes()])]
            yield pa.RecordBatch.from_arrays(columns, ["n", "sums", "mean", "scatter"])

    return run


def _total(vectors: DataFrame, model: Whitening | None = None) -> Summary:
    rows = vectors.mapInArrow(_summaries(model), "n long, sums array<string>, mean binary, scatter binary").rdd

    def read(r) -> Summary:
        size = len(r.sums)
        return Summary(r.n, [int(s) for s in r.sums], np.frombuffer(r.mean), np.frombuffer(r.scatter).reshape(size, size))

    none = vectors.sparkSession.sparkContext.parallelize([NOTHING], 1)
    return rows.map(read).union(none).treeReduce(Summary.merged, DEPTH)


def eigen(total: Summary, components: int) -> Whitening:
    """The fit of a summary. Eigenvalues within rounding of 0 count as 0; every component's largest entry is positive."""
    values, axes = np.linalg.eigh(total.scatter / total.n)
    trace = float(np.trace(total.scatter)) / total.n
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    values = np.where(values > total.scatter.shape[0] * np.finfo(float).eps * max(trace, 0.0), values, 0.0)
    turned = np.sign(axes[np.abs(axes).argmax(0), np.arange(axes.shape[1])])
    return Whitening(total.n, total.sums, values, axes * turned, values / trace if trace > 0 else np.zeros(len(values)))


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of distinct vectors (one column x, whole numbers, equally long), verified; None without any.

    ``error`` is the largest absolute entry of the covariance of the whitened vectors minus the identity, over the
    components that have any variance (NaN if none has).
    """
    total = _total(vectors)
    if not total.n:
        return None
    model = eigen(total, components)
    whitened = _total(vectors, model)
    seen = model.values > 0
    off = np.abs(whitened.scatter / whitened.n - np.eye(len(seen)))[np.ix_(seen, seen)]
    return Whitening(model.n, model.sums, model.values, model.axes, model.explained, float(off.max()) if off.size else float("nan"))


def _deviations(x: np.ndarray, model: Whitening) -> list[int | None]:
    """Sum over entries of (n * x - S)^2, exact; None where it is no 64-bit number."""
    high = max(int(x.max()), -int(x.min())) * model.n + max(abs(s) for s in model.sums)
    if high * high * x.shape[1] < 2**63:
        apart = x * model.n - np.array(model.sums, np.int64)
        return (apart * apart).sum(1).tolist()
    apart = x.astype(object) * model.n - np.array(model.sums, object)
    return [s if s < 2**63 else None for s in (apart * apart).sum(1).tolist()]


def _applied(model: Whitening, kind: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(model.values)
        one = lambda v, n: pa.array(np.tile(v, n), from_pandas=True)
        for b in batches:
            at = 0
            for x in _matrices(b.column(1)):
                n, ids = len(x), b.column(0).slice(at, len(x))
                at += n
                rows = np.repeat(np.arange(n), k)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(rows)).cast(kind), one(np.arange(1, k + 1, dtype=np.int32), n), pa.array(np.full(n * k, model.n, np.int64)),
                        pa.array(_deviations(x, model), pa.int64()).take(pa.array(rows)), pa.array(model.project(x).ravel(), from_pandas=True),
                        one(model.explained, n), pa.array(np.full(n * k, model.error), from_pandas=True),
                    ],
                    ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return run


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """One row for each vector and component: id, component, n, deviation, whitened, explained, identity_error.

    Vectors that are null or empty, or hold null or non-finite entries, are dropped, and so are those that don't have the
    most frequent length (of equally frequent ones the greatest): they can't share a covariance. An entry c becomes
    floor(scale * c), within 64 bits. The fit is over each distinct vector once, so repeated rows, all of which are
    returned, weigh nothing in it. Vectors shorter than ``components`` have fewer of them. A component without variance has
    a null whitened value and explains 0. A deviation beyond 64 bits is null. Null and repeated ids stay as they are; other
    columns are left out. Without a vector the result is empty.
    """
    kind = df.schema[id_col].dataType
    named = df.select(F.col(f"`{id_col}`").alias("id"), steps(F.col(f"`{vector_col}`"), scale).alias("x")).filter("x IS NOT NULL")
    names = f"id {kind.simpleString()}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    fitted, model = written(named.select("x").distinct(), "vectors"), None
    length = named.groupBy(F.size("x").alias("length")).count().orderBy(F.desc("count"), F.desc("length")).first()
    if length is not None:
        if length.length > MOST_ENTRIES:
            raise ValueError(f"vectors of {length.length} entries; {MOST_ENTRIES} at most")
        model = fit(fitted.filter(F.size("x") == length.length), components)
    if model is None:
        return df.sparkSession.createDataFrame([], names).withColumnRenamed("id", id_col)
    usable = named.filter(F.size("x") == model.size)
    return usable.mapInArrow(_applied(model, _arrow(kind)), names).withColumnRenamed("id", id_col)


def _arrow(kind) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))
