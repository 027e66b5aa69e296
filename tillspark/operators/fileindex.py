"""What each data file may hold: Bloom filters of its keys or of the trigrams of its texts.

A file's filter is cut into cells of 32,768 bits, one per ``KEYS_PER_CELL`` keys, so that building
and probing are plain aggregates and joins on (file, cell) whatever the size of a file. A key sets
``POSITIONS`` bits of its cell; one that is absent passes for present about once in 200 times. A key
index knows the range of the first key column, too.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CELL_BITS = 8 * 4096  # the size of Spark's own bitmaps
KEYS_PER_CELL = 2000
POSITIONS = 3
FILE = "_file"


def key_token(keys: Sequence[str]) -> Column:
    """One number per key; parts that are NULL are passed over, for stored and probed keys alike."""
    return F.xxhash64(*keys)


def _positions(token: Column) -> list[Column]:
    return [F.pmod(F.xxhash64(token, F.lit(i)), F.lit(CELL_BITS)) for i in range(POSITIONS)]


def _number() -> Column:
    """A short stand-in for a file's path; should two files share one, each may only seem to hold more."""
    return F.xxhash64(FILE).alias("_number")


def _cells(tokens: DataFrame, files: DataFrame) -> DataFrame:
    """One row per file and cell, from (_number, _token) rows and the ``rows`` of each file."""
    files = files.withColumns({"cells": F.ceil(F.col("rows") / KEYS_PER_CELL), "_number": _number()})
    placed = tokens.join(files.select("_number", "cells").distinct(), "_number")
    bits = placed.select(
        "_number", F.pmod("_token", "cells").alias("cell"), F.explode(F.array(*_positions(F.col("_token")))).alias("_bit")
    )
    cells = bits.groupBy("_number", "cell").agg(F.bitmap_construct_agg("_bit").alias("bits"))
    return cells.join(files, "_number").drop("_number")


def index_rows(rows: DataFrame, keys: Sequence[str], partitions: Sequence[str] = ()) -> DataFrame:
    """The index of all files that ``rows`` come from, one row per file and cell.

    ``rows`` carries the file of each row as ``_file``. All rows of a file share ``partitions``.
    """
    tokens = rows.select(FILE, *partitions, F.col(keys[0]).alias("_first"), key_token(keys).alias("_token"))
    files = tokens.groupBy(FILE, *partitions).agg(
        F.count("*").alias("rows"),
        F.min("_first").alias("low"),
        F.max("_first").alias("high"),
        F.bool_or(F.col("_first").isNull()).alias("blanks"),
    )
    return _cells(tokens.select(_number(), "_token"), files)


def _bit_set(bits: Column, position: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, (F.floor(position / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.call_function("shiftright", byte, F.pmod(position, F.lit(8)).cast("int")).bitwiseAND(1) == 1


def files_that_may_hold(
    index: DataFrame, batch: DataFrame, keys: Sequence[str], partitions: Sequence[str] = ()
) -> DataFrame:
    """Files (``_file``) whose range and filter let at least one key of ``batch`` pass."""
    probes = batch.select(
        *[F.col(p).alias(f"_probe_{p}") for p in partitions],
        F.col(keys[0]).alias("_first"),
        key_token(keys).alias("_token"),
    ).distinct()
    files = index.select(FILE, *partitions, "low", "high", "blanks", "cells").distinct()
    inside = F.when(F.col("_first").isNull(), F.col("blanks")).otherwise(F.col("_first").between(F.col("low"), F.col("high")))
    for p in partitions:
        inside &= F.col(p).eqNullSafe(F.col(f"_probe_{p}"))
    near = probes.join(files, inside).select(FILE, "_token", F.pmod("_token", "cells").alias("cell"))
    tested = near.join(index.select(FILE, "cell", "bits"), [FILE, "cell"])
    passed = F.lit(True)
    for position in _positions(F.col("_token")):
        passed &= _bit_set(F.col("bits"), position)
    return tested.where(passed).select(FILE).distinct()


# --- texts -----------------------------------------------------------------------------

GRAM = 3


def text_index_rows(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The trigram index of all files that ``rows`` come from, one row per file and cell.

    A trigram counts for its column alone. Values are made distinct in each task before they
    are cut, and trigrams before they meet those of the same file.
    """
    texts = [F.struct(F.lit(c).alias("column"), F.lower(F.col(c).cast("string")).alias("text")) for c in columns]
    values = rows.select(_number(), F.inline(F.array(*texts))).where(F.length("text") >= GRAM).distinct()
    # a row per start, because a lambda over the starts is not compiled
    starts = values.select("*", F.explode(F.sequence(F.lit(1), F.length("text") - (GRAM - 1))).alias("_at"))
    gram = F.substring("text", F.col("_at"), F.lit(GRAM))
    distinct = starts.select("_number", F.xxhash64("column", gram).alias("_token")).distinct()
    names = rows.select(FILE, _number()).distinct()
    counted = distinct.groupBy("_number").agg(F.count("*").alias("rows")).join(names, "_number").drop("_number")
    return _cells(distinct, counted)


def term_pieces(term: str) -> list[str]:
    """Literal parts of a search term long enough to have trigrams; ``%`` and ``_`` are wildcards.

    A term with an escape says nothing.
    """
    if "\\" in term:
        return []
    return [piece for piece in re.split("[%_]", term) if len(piece) >= GRAM]


def files_that_may_contain(index: DataFrame, columns: Sequence[str], term: str) -> DataFrame | None:
    """Files (``_file``) where every trigram of ``term`` may occur in one of ``columns``.

    None where the term has no trigram, so that any file may hold it.
    """
    # the same lower case as the stored texts, so that both are cut alike
    lowered = [index.sparkSession.range(1).select(F.lower(F.lit(p))).first()[0] for p in term_pieces(term)]
    grams = sorted({piece[i : i + GRAM] for piece in lowered for i in range(len(piece) - GRAM + 1)})
    if not grams:
        return None
    wanted = [F.struct(F.lit(c).alias("column"), F.xxhash64(F.lit(c), F.lit(g)).alias("token")) for c in columns for g in grams]
    files = index.select(FILE, "cells").distinct().select(FILE, "cells", F.inline(F.array(*wanted)))
    placed = files.withColumn("cell", F.pmod("token", "cells")).join(index.select(FILE, "cell", "bits"), [FILE, "cell"])
    passed = F.lit(True)
    for position in _positions(F.col("token")):
        passed &= _bit_set(F.col("bits"), position)
    complete = placed.where(passed).groupBy(FILE, "column").agg(F.count_distinct("token").alias("_found"))
    return complete.where(F.col("_found") == len(grams)).select(FILE).distinct()
