"""Benchmark decontamination by spaced seeds.

Method. Words are lower-cased runs of letters and digits. Fixed masks slide over the words of
every benchmark item and of every document; a mask hashes only the words under its ones, so a
substitution under a zero leaves the hash as it is. Equal hashes join a document to an item
on one diagonal. There every word of the item is compared with the document's, and the longest
stretch of which 80 % are equal counts as leaked when it has at least ``MIN_WORDS`` words (the
whole item, where that is shorter). The masks miss none: every placement of so many
substitutions leaves one of them a window (a longer stretch holds one of 12 to 23 words that
is 80 % equal, so those lengths decide).

Scale. The documents are read once per block of the benchmark and never shuffled. A block's
seeds go to the tasks as sorted arrays of at most ``BLOCK_SEEDS`` entries, so what is sent
has a fixed bound however large the benchmark is. A larger one takes more blocks, one after the
other: what a block found is written before the next one is sent, and the block's seeds are let go.

Defined cases. A null or empty text, document or item, matches nothing. An item of 5 to
9 words may have one word substituted, one of 4 none; items of fewer than ``SHORTEST_ITEM``
words are not searched. Repeated documents are each marked; repeated items
are reported under each id, items without an id under none (they still mark the document).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillspark.llm.words import LETTERS_AND_DIGITS, U64, words_of
from tillspark.session import staged

MASKS = ("111101", "101000111", "110111")
MASKED_ITEM = 10  # words from which an item has the masks above
MIN_WORDS = 12
MIN_EQUAL_PERCENT = 80
SHORTEST_ITEM = 4
BLOCK_SEEDS = 2_000_000
BATCH_ROWS = 256
TABLE_BITS = 22


def _window_hashes(hashes: np.ndarray, mask: str) -> np.ndarray:
    """Hash of the words under the ones of ``mask`` at every position."""
    size = len(hashes) - len(mask) + 1
    if size <= 0:
        return np.empty(0, U64)
    total = np.full(size, U64(len(mask)))
    factor = 0x9E3779B97F4A7C15
    for offset, bit in enumerate(mask):
        factor = factor * 0xD6E8FEB86659FD93 % (1 << 64)
        if bit == "1":
            total += hashes[offset : offset + size] * U64(factor)
    return total


def _masks(words: int) -> tuple[str, ...]:
    """The masks of an item of so many words; shorter ones than the masks allow are masked whole."""
    if words >= MASKED_ITEM:
        return MASKS
    if 100 * (words - 1) < MIN_EQUAL_PERCENT * words:
        return ("1" * words,)
    # the one substitution is in one third of the item
    cuts = [words * k // 3 for k in range(4)]
    return tuple("1" * a + "0" * (b - a) + "1" * (words - b) for a, b in zip(cuts, cuts[1:]))


@dataclass
class SeedIndex:
    """Seeds of one block of items: per mask sorted hashes with their item and position."""

    ids: list[int | None]
    words: list[np.ndarray]
    seeds: dict[str, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]

    @classmethod
    def of(cls, rows: list[tuple[int | None, str | None]]) -> SeedIndex:
        split = words_of(pa.array([text for _, text in rows], pa.string()), LETTERS_AND_DIGITS)
        words = [split.of(i) for i in range(len(rows))]
        found: dict[str, list] = {}
        for item, own in enumerate(words):
            if len(own) < SHORTEST_ITEM:
                continue
            for mask in _masks(len(own)):
                hashes = _window_hashes(own, mask)
                found.setdefault(mask, []).append(
                    (hashes, np.full(len(hashes), item), np.arange(len(hashes)))
                )
        seeds = {}
        for mask, parts in found.items():
            hashes, items, places = (np.concatenate(x) for x in zip(*parts))
            order = np.argsort(hashes, kind="stable")
            hashes = hashes[order]
            table = np.zeros(1 << TABLE_BITS, bool)
            table[(hashes >> U64(64 - TABLE_BITS)).astype(np.int64)] = True
            seeds[mask] = (hashes, items[order], places[order], table)
        return cls([i for i, _ in rows], words, seeds)

    def matches(self, texts: pa.Array) -> list[list[tuple[int | None, int]]]:
        """Per text the leaked items as (item id, words in the leaked stretch)."""
        split = words_of(texts, LETTERS_AND_DIGITS)
        candidates = [np.empty((0, 3), np.int64)]
        for mask, (seeds, items, places, table) in self.seeds.items():
            hashes = _window_hashes(split.hashes, mask)
            at = np.flatnonzero(table[(hashes >> U64(64 - TABLE_BITS)).astype(np.int64)])
            low = np.searchsorted(seeds, hashes[at], "left")
            high = np.searchsorted(seeds, hashes[at], "right")
            many = high - low
            at, low, many = at[many > 0], low[many > 0], many[many > 0]
            if not len(at):
                continue
            text = np.searchsorted(split.first, at, "right") - 1
            inside = at + len(mask) <= split.first[text + 1]
            at, low, many, text = at[inside], low[inside], many[inside], text[inside]
            entry = np.repeat(low - np.cumsum(many) + many, many) + np.arange(many.sum())
            diagonal = np.repeat(at - split.first[text], many) - places[entry]
            candidates.append(np.stack([np.repeat(text, many), items[entry], diagonal], axis=1))
        out: list[list[tuple[int | None, int]]] = [[] for _ in range(len(texts))]
        for text, item, diagonal in np.unique(np.concatenate(candidates), axis=0):
            stretch = leaked_words(split.of(text), self.words[item], int(diagonal))
            if stretch:
                out[text].append((self.ids[item], stretch))
        return out


# from a batch and a block's index to the batch with what was found
Mark = Callable[[pa.RecordBatch, SeedIndex], pa.RecordBatch]


def leaked_words(document: np.ndarray, item: np.ndarray, diagonal: int) -> int:
    """Words of the best stretch of ``item`` laid on the document at ``diagonal``; 0: no leak."""
    low, high = max(0, -diagonal), min(len(item), len(document) - diagonal)
    equal = item[low:high] == document[low + diagonal : high + diagonal]
    if not len(equal):
        return 0
    # longest stretch over which the score does not fall: for every end the first start as low
    score = np.concatenate([[0], np.cumsum(np.where(equal, 100 - MIN_EQUAL_PERCENT, -MIN_EQUAL_PERCENT))])
    lowest = np.minimum.accumulate(score)
    length = int((np.arange(len(score)) - np.searchsorted(-lowest, -score)).max())
    return length if length >= min(MIN_WORDS, len(item)) else 0


def _marked(docs: DataFrame, benchmark: DataFrame, block_seeds: int, mark: Mark) -> DataFrame:
    """``docs`` after ``mark`` was applied for every block of about ``block_seeds`` seeds.

    One block's index is with the driver and the tasks at a time.
    """
    items = benchmark.select(F.col("item_id").cast("bigint"), F.col("text").cast("string").alias("text"))
    # a word has at least one byte and one separator, so bytes / 2 bounds the words
    most = items.agg(F.sum(F.octet_length("text") / 2 + 1)).first()[0] or 0
    blocks = int(most * len(MASKS) // block_seeds) + 1
    number = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    for block in range(blocks):
        index = SeedIndex.of([tuple(row) for row in items.where(number == block).toLocalIterator()])
        sent = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches, sent=sent):
            for batch in batches:
                for at in range(0, batch.num_rows, BATCH_ROWS):
                    yield mark(batch.slice(at, BATCH_ROWS), sent.value)

        docs = docs.mapInArrow(run, docs.schema)
        if block < blocks - 1:
            docs = staged(docs, "decontaminated")
            sent.destroy()
    return docs


def leaked_items(docs: DataFrame, benchmark: DataFrame, block_seeds: int = BLOCK_SEEDS) -> DataFrame:
    """Per row of ``docs``: doc_id, contaminated, item_ids (sorted) and the longest stretch."""
    found = docs.select(
        F.col("doc_id").cast("bigint"),
        F.col("text").cast("string").alias("text"),
        F.array().cast("array<bigint>").alias("item_ids"),
        F.lit(0).cast("bigint").alias("leaked_words"),
    )

    def mark(part: pa.RecordBatch, index: SeedIndex) -> pa.RecordBatch:
        hits = index.matches(part.column("text"))
        ids = [
            sorted({*before, *(i for i, _ in new if i is not None)})
            for before, new in zip(part.column("item_ids").to_pylist(), hits)
        ]
        most = [max([before, *(n for _, n in new)]) for before, new in zip(part.column("leaked_words").to_pylist(), hits)]
        return pa.RecordBatch.from_arrays(
            [part.column(0), part.column(1), pa.array(ids, pa.list_(pa.int64())), pa.array(most, pa.int64())],
            ["doc_id", "text", "item_ids", "leaked_words"],
        )

    found = _marked(found, benchmark, block_seeds, mark)
    return found.select("doc_id", (F.col("leaked_words") > 0).alias("contaminated"), "item_ids", "leaked_words")


def remove_leaks(docs: DataFrame, benchmark: DataFrame, block_seeds: int = BLOCK_SEEDS) -> DataFrame:
    """The rows of ``docs``, with all their columns, that hold no leaked item."""
    text = docs.columns.index("text")
    rows = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])  # any names pass

    def mark(part: pa.RecordBatch, index: SeedIndex) -> pa.RecordBatch:
        return part.filter(pa.array([not hit for hit in index.matches(part.column(text))], pa.bool_()))

    return _marked(rows, benchmark, block_seeds, mark).toDF(*docs.columns)
