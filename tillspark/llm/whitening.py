"""Whitened embeddings by Golub-Kahan-Lanczos bidiagonalisation of the centred rows.

Method. Entries become whole numbers, so their sums and the squared deviations are exact. X holds
the centred rows. Starting from a fixed unit vector v, one distributed pass gives u = X v, less
the part along earlier u, its norm, and X'u; the next v is X'u less the part along all earlier
v. Both sides are reorthogonalised in full, twice. Every u lies in the range of X and is kept as
the y with u = X y, as wide as a vector, so nothing as long as the table is ever stored; products
u_i'u come from the X'u_i of earlier passes. A product that vanishes ends a block, and a fresh
direction starts the next one. The singular values and right vectors of the small bidiagonal
matrix yield deviations and components.

Scale. A pass reads one column of binary blocks of whole numbers (a few KB each) and every task
sends one number per dimension, summed by dimension; the driver holds matrices of width times
steps. There are as many steps as the vectors have dimensions unless ``steps`` says fewer: equal
deviations can only be told apart by the whole space. Nothing is grouped by value, so copies of a
vector cost no more than other rows.

Defined cases. A null vector, one with a null or non-finite entry, and one shorter than the
longest (its entries are missing) take no part; an empty table, or one of empty vectors, gives an
empty result. Entries are held within 2**31 after scaling. Repeated rows and ids, null ids too,
each give rows of their own. Directions without any deviation are no components, so equal
vectors give no rows. A deviation beyond a long is null. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tillspark.llm.vectors import binary_rows, flat_values, usable, whole_numbers
from tillspark.session import staged

SCALE = 1024
SHIFT = 100_000  # no result depends on it but the exactness of what is added up
COMPONENTS = 8
LARGEST = 2**31 - 1
BLOCK_BYTES = 4096  # of a stored block of rows
CHUNK = 8192  # rows worked on at a time
NOTHING = 1e-8  # a singular value below this share of the whole is none
SEED = 5
RESULT = "component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


def _blocks(vectors: DataFrame, key: str, vector: str, scale: int, shift: int) -> DataFrame:
    """Usable vectors as stored blocks of rows: ``keys``, ``width`` and the entries ``x``."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole, lengths, entries = usable(batch.column("v"))
            keys = batch.column("k").filter(pa.array(whole))
            numbers = whole_numbers(entries, scale, shift, LARGEST)
            ends = np.cumsum(lengths)
            for width in np.unique(lengths[lengths > 0]):
                rows = np.flatnonzero(lengths == width)
                x = numbers[(ends[rows] - width)[:, None] + np.arange(width)]
                size = max(1, BLOCK_BYTES // (4 * int(width)))
                starts = np.arange(0, len(rows), size)
                counts = np.diff(np.append(starts, len(rows)))
                offsets = pa.array(np.append(starts, len(rows)), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.ListArray.from_arrays(offsets, keys.take(pa.array(rows))),
                        pa.array(np.full(len(starts), width, np.int32)),
                        binary_rows(x.reshape(-1), counts * width),
                    ],
                    ["keys", "width", "x"],
                )

    named = vectors.select(F.col(key).alias("k"), F.col(vector).alias("v"))
    kind = named.schema["k"].dataType.simpleString()
    packed = named.mapInArrow(pack, f"keys array<{kind}>, width int, x binary")
    return staged(packed, "whitening-blocks")


def _chunks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[np.ndarray]:
    for batch in batches:
        rows = flat_values(batch.column("x")).reshape(-1, width)
        for at in range(0, len(rows), CHUNK):
            yield rows[at : at + CHUNK]


def _summed(blocks: DataFrame, parts: Callable[[Iterator[pa.RecordBatch]], np.ndarray], kind: str) -> list:
    """Sum of what ``parts`` returns for each task, place by place."""
    column = pa.int64() if kind == "bigint" else pa.float64()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = parts(batches)
        yield pa.RecordBatch.from_arrays([pa.array(range(len(part)), pa.int32()), pa.array(part, column)], ["place", "part"])

    total = F.sum(F.col("part").cast("decimal(38,0)") if kind == "bigint" else F.col("part"))
    rows = blocks.select("x").mapInArrow(run, f"place int, part {kind}").groupBy("place").agg(total.alias("t")).collect()
    return [row["t"] for row in sorted(rows)]


@dataclass(frozen=True)
class Centre:
    """Number of rows and exact sums; rows are centred by the whole part first, then by the rest."""

    n: int
    sums: tuple[int, ...]

    @property
    def whole(self) -> np.ndarray:
        return np.array([s // self.n for s in self.sums], np.int64)

    @property
    def rest(self) -> np.ndarray:
        return np.array([s % self.n for s in self.sums])

    def rows(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole).astype(np.float64) - self.rest.astype(np.float64) / self.n

    def deviations(self, x: np.ndarray) -> pa.Array:
        """Per row the sum over the dimensions of (n * x - sum) squared, exactly."""
        apart = x - self.whole
        largest = self.n * (int(np.abs(apart).max(initial=0)) + 1)
        if largest**2 * x.shape[1] < 2**63:
            scaled = self.n * apart - self.rest.astype(np.int64)
            return pa.array((scaled * scaled).sum(axis=1), pa.int64())
        scaled = self.n * apart.astype(object) - self.rest.astype(object)
        return pa.array([d if d < 2**63 else None for d in (scaled * scaled).sum(axis=1).tolist()], pa.int64())


def _centre(blocks: DataFrame, width: int) -> Centre:
    def parts(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        total = np.zeros(width + 1, np.int64)
        for x in _chunks(batches, width):
            total[0] += len(x)
            total[1:] += x.sum(axis=0, dtype=np.int64)
        return total

    n, *sums = (int(t) for t in _summed(blocks, parts, "bigint"))
    return Centre(n, tuple(sums))


def _products(blocks: DataFrame, centre: Centre, y: np.ndarray) -> tuple[np.ndarray, float, float]:
    """One pass: X'(X y), the squared norm of X y and that of X."""
    width = len(y)

    def parts(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        total = np.zeros(width + 2)
        for x in _chunks(batches, width):
            rows = centre.rows(x)
            u = rows @ y
            total[:width] += u @ rows
            total[width] += u @ u
            total[width + 1] += np.vdot(rows, rows)
        return total

    *back, norm, whole = _summed(blocks, parts, "double")
    return np.array(back), norm, whole


def _apart(vector: np.ndarray, basis: list[np.ndarray]) -> np.ndarray:
    """``vector`` less its part along the orthonormal ``basis``, taken off twice."""
    for _ in range(2 if basis else 0):
        known = np.array(basis)
        vector = vector - (known @ vector) @ known
    return vector


def bidiagonalise(
    products: Callable[[np.ndarray], tuple[np.ndarray, float, float]], width: int, steps: int
) -> tuple[np.ndarray, np.ndarray, float]:
    """Right vectors (as rows), the bidiagonal matrix and the squared norm of X.

    ``products(y)`` returns X'(X y), the squared norm of X y and that of X.
    """
    random = np.random.default_rng(SEED)
    right: list[np.ndarray] = []  # the v
    within: list[np.ndarray] = []  # the y with u = X y
    back: list[np.ndarray] = []  # X'u
    entries: list[tuple[int, int, float]] = []  # of the bidiagonal matrix
    linked, whole = 0.0, 0.0
    v = random.standard_normal(width)
    v /= np.linalg.norm(v)
    while True:
        y = v - linked * within[-1] if linked else v
        for _ in range(2 if within else 0):
            y = y - (np.array(back) @ y) @ np.array(within)
        product, norm, whole = products(y)
        if linked:
            entries.append((len(within) - 1, len(right), linked))
        right.append(v)
        length = np.sqrt(max(norm, 0.0))
        rest = np.zeros(width)
        if length > NOTHING * np.sqrt(whole):
            entries.append((len(within), len(right) - 1, length))
            within.append(y / length)
            back.append(product / length)
            rest = _apart(back[-1] - length * v, right)
        if len(right) >= min(steps, width):
            break
        linked = float(np.linalg.norm(rest))
        if linked <= 1e-12 * np.sqrt(whole):
            linked, rest = 0.0, _apart(random.standard_normal(width), right)
        v = _apart(rest / np.linalg.norm(rest), right)
        v /= np.linalg.norm(v)
    matrix = np.zeros((max(1, len(within)), len(right)))
    for row, column, value in entries:
        matrix[row, column] = value
    return np.array(right), matrix, whole


@dataclass(frozen=True)
class Whitening:
    """What turns a row into its whitened components; deviations are those of the fitted rows."""

    centre: Centre
    components: np.ndarray  # unit vectors as rows, by falling deviation
    deviations: np.ndarray
    explained: np.ndarray  # share of each component in the whole variance

    def apply(self, x: np.ndarray) -> np.ndarray:
        return self.centre.rows(x) @ (self.components / self.deviations[:, None]).T


def fit(blocks: DataFrame, width: int, components: int = COMPONENTS, steps: int | None = None) -> Whitening:
    """Components of the stored blocks, at most ``components`` of them."""
    centre = _centre(blocks, width)
    right, matrix, whole = bidiagonalise(lambda y: _products(blocks, centre, y), width, steps or width)
    _, values, turned = np.linalg.svd(matrix, full_matrices=False)
    kept = [i for i in range(min(components, len(values))) if values[i] > NOTHING * np.sqrt(whole)]
    vectors = turned[kept] @ right
    return Whitening(centre, vectors, values[kept] / np.sqrt(centre.n), values[kept] ** 2 / whole if kept else values[kept])


def identity_error(blocks: DataFrame, model: Whitening) -> float:
    """Largest entry of the covariance of the whitened rows minus the identity."""
    width, size = model.components.shape[1], len(model.deviations)

    def parts(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        total = np.zeros((size + 1, size))
        for x in _chunks(batches, width):
            white = model.apply(x)
            total[:size] += white.T @ white
            total[size] += white.sum(axis=0)
        return total.reshape(-1)

    total = np.array(_summed(blocks, parts, "double")).reshape(size + 1, size) / model.centre.n
    mean = total[size]
    return float(np.abs(total[:size] - np.outer(mean, mean) - np.eye(size)).max())


def whitened(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    components: int = COMPONENTS,
    steps: int | None = None,
    scale: int = SCALE,
    shift: int = SHIFT,
) -> DataFrame:
    """A row per usable vector and component: key, component, n, deviation, whitened, explained, identity_error."""
    schema = StructType([StructField("key", vectors.select(key).schema[0].dataType), *StructType.fromDDL(RESULT)])
    spark = vectors.sparkSession
    blocks = _blocks(vectors, key, vector, scale, shift)
    width = blocks.agg(F.max("width")).first()[0]
    if width is None:
        return spark.createDataFrame([], schema).withColumnRenamed("key", key)
    blocks = blocks.where(F.col("width") == width)
    model = fit(blocks, width, components, steps)
    if not len(model.deviations):
        return spark.createDataFrame([], schema).withColumnRenamed("key", key)
    error = identity_error(blocks, model)
    size = len(model.deviations)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("keys").flatten()
            x = flat_values(batch.column("x")).reshape(-1, width)
            for at in range(0, len(x), CHUNK):
                part = x[at : at + CHUNK]
                each = pa.array(np.repeat(np.arange(len(part)), size))
                yield pa.RecordBatch.from_arrays(
                    [
                        keys.slice(at, len(part)).take(each),
                        pa.array(np.tile(np.arange(1, size + 1, dtype=np.int32), len(part))),
                        pa.array(np.full(len(part) * size, model.centre.n, np.int64)),
                        model.centre.deviations(part).take(each),
                        pa.array(model.apply(part).reshape(-1)),
                        pa.array(np.tile(model.explained, len(part))),
                        pa.array(np.full(len(part) * size, error)),
                    ],
                    schema.names,
                )

    return blocks.select("keys", "x").mapInArrow(rows, schema).withColumnRenamed("key", key)
