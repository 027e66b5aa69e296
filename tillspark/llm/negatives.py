"""Hard negatives by exact integer inner products: Strassen tiles, then mergeable heaps.

Method. Entries become whole numbers. Anchors and candidates meet in the cells of a grid; in a
cell, int64 tiles of anchors and candidates, filled up with zeros to even sides, are multiplied by
Strassen's recursion (seven products instead of eight; sums of int64 are exact). A leaf is
multiplied in doubles where its sums provably stay below 2**53, else in int64. Scores of the first
pass go into one heap per anchor, the best rows of the same label; merged over all cells these are
the positives. The second pass fills one heap per positive with the best rows of another label
whose scores lie in that positive's window. Heaps hold ``count`` entries, and those of different
cells merge to the same result in any order.

Scale. A stated set of anchors against all rows is quadratic work, done in cells of bounded size
(CELL_ROWS candidates, CELL_ANCHORS anchors), however many there are and whatever their labels.
The grid deals rows by a digest of their number; candidates are copied once per anchor column of
the grid, anchors once per candidate row. Of each cell only heaps leave, and Spark keeps the first
of each anchor in every task before it shuffles them.

Defined cases. Rows with a null label, a null vector or a null or non-finite entry take no part. A
shorter vector counts as filled up with zeros. Entries are held within ``largest_entry`` after scaling,
so that every score is exact. A repeated row is another row: it can be the positive of its copy,
and gives rows of its own. A null id is never an anchor by ``id % 100 = 0`` and comes last among
equal scores. An anchor without positives, or a positive without negatives, gives no row. Labels
are whole numbers. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillspark.llm.vectors import binary_rows, padded_matrix, usable, whole_numbers
from tillspark.session import staged

SCALE = 256
COUNT = 5  # positives of an anchor, and negatives of a positive
WINDOW = (80, 100)  # percent of the positive's score
LEAF = 32  # tiles with a side up to this are multiplied directly
TILE_ANCHORS, TILE_ROWS = 512, 4096
CELL_ANCHORS, CELL_ROWS = 1 << 17, 1 << 18
NONE = np.iinfo(np.int64).min


def largest_entry(width: int) -> int:
    """Bound of the entries for which a sum of ``width`` products stays below 2**49."""
    return 1 << ((49 - max(1, width).bit_length()) // 2)


def _leaf(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    largest = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * a.shape[1]
    if largest < 2**53:
        return (a.astype(np.float64) @ b.astype(np.float64)).astype(np.int64)
    return a @ b


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """The int64 matrix product of any two tiles that fit each other."""
    rows, inner, columns = a.shape[0], a.shape[1], b.shape[1]
    if min(rows, inner, columns) <= leaf:
        return _leaf(a, b)
    a = np.pad(a, ((0, rows % 2), (0, inner % 2)))
    b = np.pad(b, ((0, inner % 2), (0, columns % 2)))
    m, k, n = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:m, :k], a[:m, k:], a[m:, :k], a[m:, k:]
    b11, b12, b21, b22 = b[:k, :n], b[:k, n:], b[k:, :n], b[k:, n:]
    p1 = strassen(a11 + a22, b11 + b22, leaf)
    p2 = strassen(a21 + a22, b11, leaf)
    p3 = strassen(a11, b12 - b22, leaf)
    p4 = strassen(a22, b21 - b11, leaf)
    p5 = strassen(a11 + a12, b22, leaf)
    p6 = strassen(a21 - a11, b11 + b12, leaf)
    p7 = strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((2 * m, 2 * n), np.int64)
    out[:m, :n] = p1 + p4 - p5 + p7
    out[:m, n:] = p3 + p5
    out[m:, :n] = p2 + p4
    out[m:, n:] = p1 - p2 + p3 + p6
    return out[:rows, :columns]


@dataclass
class Heaps:
    """The best entries of many lists: score, known id or not, id; free places have score NONE."""

    scores: np.ndarray
    unknown: np.ndarray
    ids: np.ndarray

    @classmethod
    def empty(cls, lists: int, count: int) -> Heaps:
        return cls(np.full((lists, count), NONE), np.zeros((lists, count), bool), np.zeros((lists, count), np.int64))

    def merge(self, lists: np.ndarray, scores: np.ndarray, unknown: np.ndarray, ids: np.ndarray) -> None:
        """Offer a row of entries to each of ``lists``; the best stay, higher scores and smaller ids first."""
        count = self.scores.shape[1]
        scores = np.concatenate([self.scores[lists], scores], axis=1)
        unknown = np.concatenate([self.unknown[lists], unknown], axis=1)
        ids = np.concatenate([self.ids[lists], ids], axis=1)
        order = np.lexsort((ids, unknown, ~scores), axis=1)[:, :count]  # the last key decides first
        self.scores[lists] = np.take_along_axis(scores, order, 1)
        self.unknown[lists] = np.take_along_axis(unknown, order, 1)
        self.ids[lists] = np.take_along_axis(ids, order, 1)

    def offer(self, first: int, scores: np.ndarray, fits: np.ndarray, tile: Tile) -> None:
        """Offer the fitting entries of a score tile, whose rows are the lists from ``first`` on."""
        count = self.scores.shape[1]
        best = np.where(fits, scores, NONE)
        last = self.scores[first : first + len(scores), -1]
        better = np.flatnonzero((best.max(axis=1, initial=NONE) >= last) & fits.any(axis=1))
        if not len(better):
            return
        best = best[better]
        size = best.shape[1]
        # one number in the order of the heap: candidates of a tile are sorted by id
        key = np.where(best == NONE, NONE, best * size + np.arange(size - 1, -1, -1))
        if size > count:
            at = np.argpartition(key, size - count, axis=1)[:, size - count :]
        else:
            at = np.broadcast_to(np.arange(size), key.shape)
        self.merge(first + better, np.take_along_axis(best, at, 1), tile.unknown[at], tile.ids[at])


@dataclass
class Tile:
    """Rows of a cell: matrix, labels, ids and row numbers."""

    x: np.ndarray
    labels: np.ndarray
    ids: np.ndarray
    unknown: np.ndarray
    numbers: np.ndarray

    @classmethod
    def of(cls, table: pa.Table, width: int) -> Tile:
        ids = table["id"].combine_chunks()
        return cls(
            padded_matrix(_one(table["x"]), width),
            table["label"].to_numpy(),
            pc.fill_null(ids, 0).to_numpy(),
            ids.is_null().to_numpy(zero_copy_only=False),
            table["number"].to_numpy(),
        )

    def part(self, start: int, size: int) -> Tile:
        of = slice(start, start + size)
        return Tile(self.x[of], self.labels[of], self.ids[of], self.unknown[of], self.numbers[of])


def _one(column: pa.ChunkedArray) -> pa.Array:
    return column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)


def _scored(anchors: Tile, rows: Tile) -> Iterator[tuple[int, Tile, Tile, np.ndarray]]:
    """Score tiles of a cell: the first anchor's place, its tile, the candidates' and the scores."""
    for start in range(0, len(rows.ids), TILE_ROWS):
        candidates = rows.part(start, TILE_ROWS)
        turned = np.ascontiguousarray(candidates.x.T)
        for first in range(0, len(anchors.ids), TILE_ANCHORS):
            tile = anchors.part(first, TILE_ANCHORS)
            yield first, tile, candidates, strassen(tile.x, turned)


def _width(*tables: pa.Table) -> int:
    return max(pc.max(pc.binary_length(t["x"])).as_py() or 0 for t in tables) // 4


def _by_id(table: pa.Table) -> pa.Table:
    return table.sort_by([("id", "ascending")])  # nulls last


def _entries(heaps: Heaps, extra: dict[str, np.ndarray]) -> pa.Table:
    """Taken places of the heaps as rows; ``extra`` has a value per list."""
    lists, places = np.nonzero(heaps.scores != NONE)
    columns = {name: pa.array(values[lists]) for name, values in extra.items()}
    columns["score"] = pa.array(heaps.scores[lists, places])
    columns["id"] = pa.array(heaps.ids[lists, places], mask=heaps.unknown[lists, places])
    return pa.table(columns)


def _positives_of(count: int):
    def cell(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        width = _width(anchors, rows)
        own, all_rows = Tile.of(anchors, width), Tile.of(_by_id(rows), width)
        heaps = Heaps.empty(len(own.ids), count)
        for first, tile, candidates, scores in _scored(own, all_rows):
            fits = tile.labels[:, None] == candidates.labels[None, :]
            _, mine, itself = np.intersect1d(tile.numbers, candidates.numbers, return_indices=True)
            fits[mine, itself] = False
            heaps.offer(first, scores, fits, candidates)
        return _entries(heaps, {"anchor": own.numbers})

    return cell


def _negatives_of(count: int, window: tuple[int, int]):
    low, high = window

    def cell(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        width = _width(anchors, rows)
        own, all_rows = Tile.of(anchors, width), Tile.of(_by_id(rows), width)
        wanted = padded_positives(anchors["positives"])
        places = wanted.shape[1]
        heaps = [Heaps.empty(len(own.ids), count) for _ in range(places)]
        for first, tile, candidates, scores in _scored(own, all_rows):
            other = tile.labels[:, None] != candidates.labels[None, :]
            hundred = 100 * scores
            for place in range(places):
                score = wanted[first : first + len(tile.ids), place, None]
                there = score != NONE
                score = np.where(there, score, 0)
                fits = other & there & (hundred >= low * score) & (hundred <= high * score)
                heaps[place].offer(first, scores, fits, candidates)
        found = [
            _entries(h, {"anchor": own.numbers, "place": np.full(len(own.ids), p, np.int32)}) for p, h in enumerate(heaps)
        ]
        return pa.concat_tables(found)

    return cell


def padded_positives(lists: pa.ChunkedArray) -> np.ndarray:
    """Scores of the positives of each anchor, NONE where there are fewer."""
    column = _one(lists)
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    out = np.full((len(column), int(lengths.max(initial=1))), NONE)
    out[np.arange(out.shape[1])[None, :] < lengths[:, None]] = column.flatten().to_numpy()
    return out


def _prepared(vectors: DataFrame, key: str, vector: str, label: Column, anchor: Column, scale: int) -> DataFrame:
    """Usable rows, numbered and stored: number, id, label, anchor and the entries ``x``."""

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole, lengths, entries = usable(batch.column("x"))
            numbers = whole_numbers(entries, scale, 0, largest_entry(int(lengths.max(initial=1))))
            kept = batch.filter(pa.array(whole))
            yield pa.RecordBatch.from_arrays(
                [kept.column("id"), kept.column("label"), kept.column("anchor"), binary_rows(numbers, lengths)],
                ["id", "label", "anchor", "x"],
            )

    rows = vectors.select(
        F.col(key).cast("bigint").alias("id"),
        label.cast("bigint").alias("label"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"),
        F.col(vector).alias("x"),
    ).where(F.col("label").isNotNull() & F.col("x").isNotNull())
    cleaned = rows.mapInArrow(clean, "id bigint, label bigint, anchor boolean, x binary")
    return staged(cleaned.withColumn("number", F.monotonically_increasing_id()), "negative-rows")


@dataclass(frozen=True)
class Grid:
    """Cells where anchors and candidates meet: ``across`` parts of anchors, ``down`` of candidates."""

    across: int
    down: int

    def _dealt(self, parts: int) -> Column:
        return F.pmod(F.xxhash64("number"), F.lit(parts)).cast("int")

    def anchors(self, rows: DataFrame) -> DataFrame:
        copies = F.explode(F.sequence(F.lit(0), F.lit(self.down - 1))).alias("_down")
        return rows.select("*", self._dealt(self.across).alias("_across"), copies)

    def candidates(self, rows: DataFrame) -> DataFrame:
        copies = F.explode(F.sequence(F.lit(0), F.lit(self.across - 1))).alias("_across")
        return rows.select("*", self._dealt(self.down).alias("_down"), copies)

    def meet(self, anchors: DataFrame, rows: DataFrame, cell, schema: str) -> DataFrame:
        left = self.anchors(anchors).groupBy("_across", "_down")
        return left.cogroup(self.candidates(rows).groupBy("_across", "_down")).applyInArrow(cell, schema)


def _grid(spark, anchors: int, rows: int) -> Grid:
    """Cells of bounded size; where all would fit into few, as many as there are cores to work on them."""
    few = min(2 * spark.sparkContext.defaultParallelism, -(-rows // TILE_ROWS))
    return Grid(max(1, -(-anchors // CELL_ANCHORS)), max(1, few, -(-rows // CELL_ROWS)))


def _first(entries: DataFrame, per: list[str], count: int) -> DataFrame:
    """The heaps of all cells merged: the first entries per key, with their rank."""
    order = Window.partitionBy(*per).orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    return entries.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)


def hard_negatives(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    label: Column | str = "label",
    anchor: Column | None = None,
    count: int = COUNT,
    window: tuple[int, int] = WINDOW,
    scale: int = SCALE,
) -> DataFrame:
    """For each anchor and positive the ``count`` best rows of another label within the window.

    Anchors are the rows where ``anchor`` holds: by default those whose id divides by 100.
    """
    label = F.col(label) if isinstance(label, str) else label
    anchor = F.col(key) % 100 == 0 if anchor is None else anchor
    rows = _prepared(vectors, key, vector, label, anchor, scale)
    chosen = rows.where("anchor")
    sizes = rows.agg(F.count("*").alias("rows"), F.count_if("anchor").alias("anchors")).first()
    grid = _grid(vectors.sparkSession, sizes["anchors"], sizes["rows"])
    plain = ["number", "id", "label", "x"]

    offered = grid.meet(
        chosen.select(*plain), rows.select(*plain), _positives_of(count), "anchor bigint, score bigint, id bigint"
    )
    merged = _first(offered, ["anchor"], count).groupBy("anchor")
    ranked = merged.agg(F.sort_array(F.collect_list(F.struct("rank", "score", "id"))).alias("_positives"))
    found = chosen.join(ranked.withColumnRenamed("anchor", "number"), "number")
    with_positives = staged(found.drop("anchor"), "negative-positives")

    offered = grid.meet(
        with_positives.select(*plain, F.col("_positives.score").alias("positives")),
        rows.select(*plain),
        _negatives_of(count, window),
        "anchor bigint, place int, score bigint, id bigint",
    )
    names = with_positives.select(F.col("number").alias("anchor"), F.col("id").alias("anchor_id"), "_positives")
    result = _first(offered, ["anchor", "place"], count).join(names, "anchor")
    positive = F.get("_positives", F.col("place"))
    return result.select(
        "anchor_id",
        positive["id"].alias("positive_id"),
        "rank",
        F.col("id").alias("negative_id"),
        positive["score"].alias("positive_score"),
        F.col("score").alias("negative_score"),
    )
