"""Packing of tokenised documents into sequences by cutting-stock column generation.

Method. A document's ids are cut into full sequences and a rest. The histogram of the rests,
in classes of ``CLASS_WIDTH`` tokens, is a cutting-stock problem: a linear program over
patterns (which classes share one sequence), solved by column generation, where an unbounded
knapsack over the sequence length prices new columns. Pattern counts are rounded down, and
the documents, ranked within their class, take the places of the patterns in order. What
rounding leaves over, and classes whose patterns would waste more than ``MAX_WASTE`` of a
sequence, is cut once more, into pieces with power-of-two lengths: equal ones fill sequences
of the full length exactly, and the last few make shorter sequences of a power of two.

Scale. The driver sees the histogram only: at most ``length / CLASS_WIDTH`` numbers, whatever
the input. Ranks are made of a running number within each input split, counted while
tokenising, plus the counts of earlier splits, so no class is ever gathered or sorted. Ids are
written once to the shared folder and joined to their pieces by row.

Defined cases. A null or empty text is a document of the end token alone. Repeated rows, and
rows without doc_id, are packed each on its own. An empty table gives no piece.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tillspark.llm.words import NOT_SPACE, words_of
from tillspark.session import staged

SEQUENCE_TOKENS = 2048
END_TOKEN = 1
CLASS_WIDTH = 8
MAX_WASTE = 0.01
NEAR_BOUND = 1.001  # a solution this close to the lower bound is good enough
MAX_COLUMNS = 5_000  # generated before the best solution so far is taken
CACHED_CHUNKS = 300_000  # encoded text chunks in a generation of a Python worker's memory
JOINED_CHUNKS = 100
MARKS = ".,;:!?%$&*#|"
BATCH_ROWS = 1024

_chunks: list[dict[int, bytes]] = [{}, {}]
_tokenizers: dict[str, object] = {}


def _tokenizer(path: str):
    """(tokenizer, plain tokenizer or None, whether a token ends a word) of a vocabulary file.

    The plain one takes words that need no normalising and no splitting but at spaces. It
    exists where the vocabulary marks the ends of words.
    """
    if path not in _tokenizers:
        import os

        from tokenizers import Tokenizer, pre_tokenizers

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        whole, plain, ends = Tokenizer.from_file(path), None, None
        suffix = whole.model.end_of_word_suffix
        if suffix:
            plain = Tokenizer.from_file(path)
            plain.normalizer = None
            split = [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
            plain.pre_tokenizer = pre_tokenizers.Sequence(split)
            ends = np.zeros(plain.get_vocab_size() + 1, bool)
            ends[[number for token, number in plain.get_vocab().items() if token.endswith(suffix)]] = True
        _tokenizers[path] = whole, plain, ends
    return _tokenizers[path]


def _groups(chunks: list[str]) -> list[str]:
    return [" ".join(chunks[i : i + JOINED_CHUNKS]) for i in range(0, len(chunks), JOINED_CHUNKS)]


def _encode_words(words: list[str], path: str) -> list[bytes]:
    """Ids of lower-case words of Latin-1 letters; each ends with the first token that ends one."""
    _, plain, ends = _tokenizer(path)
    encoded = plain.encode_batch_fast(_groups(words), add_special_tokens=False)
    ids = np.concatenate([np.empty(0, "<u4"), *(np.array(e.ids, "<u4") for e in encoded)]).astype("<u4")
    cuts = [0, *(4 * (np.flatnonzero(ends[ids]) + 1)).tolist()]
    raw = ids.tobytes()
    if len(cuts) != len(words) + 1:
        raise ValueError("the vocabulary does not end every word with a token that ends words")
    return [raw[low:high] for low, high in zip(cuts, cuts[1:])]


def _encode_chunks(chunks: list[str], path: str) -> list[bytes]:
    """Ids of any chunks, joined with a space and told apart by the tokens' places."""
    out = []
    whole, _, _ = _tokenizer(path)
    for at, encoded in enumerate(whole.encode_batch(_groups(chunks), add_special_tokens=False)):
        group = chunks[at * JOINED_CHUNKS : (at + 1) * JOINED_CHUNKS]
        ids = np.array(encoded.ids, "<u4")
        starts = np.fromiter((start for start, _ in encoded.offsets), np.int64, len(ids))
        ends = np.cumsum([len(chunk) + 1 for chunk in group])  # a chunk and the space after it
        raw, low = ids.tobytes(), 0
        for cut in np.searchsorted(starts, ends).tolist():
            out.append(raw[4 * low : 4 * cut])
            low = cut
    return out


def _is_latin(chunk: str) -> bool:
    return chunk.isascii() or max(chunk) <= "\xff"


def _encode_distinct(keys: list[int], raw: bytes, low: list[int], high: list[int], path: str) -> list[bytes]:
    """Ids of distinct chunks, given as hashes; the i-th is ``raw[low[i] : high[i]]``.

    A worker remembers two generations of chunks: when the younger is full it becomes the
    older one, and chunks still in use move over. Words of Latin-1 letters, alone or with marks
    behind them (two runs of the splitting pattern), need no normalising but lower case.
    """
    young, old = _chunks
    if len(young) > CACHED_CHUNKS:
        young, old = {}, young
        _chunks[:] = [young, old]
    parts = list(map(young.get, keys))
    words: dict[str, int] = {}
    others: dict[str, int] = {}
    found: list[tuple[int, int, int]] = []  # chunk, its word, its marks or -1
    rest: list[tuple[int, int]] = []
    plain = _tokenizer(path)[1] is not None
    for i, part in enumerate(parts):
        if part is not None:
            continue
        part = old.get(keys[i])
        if part is not None:
            parts[i] = young[keys[i]] = part
            continue
        chunk = raw[low[i] : high[i]].decode()
        word = chunk if chunk.isalpha() else chunk.rstrip(MARKS)
        if plain and word.isalpha() and _is_latin(word):
            marks = -1 if len(word) == len(chunk) else others.setdefault(chunk[len(word) :], len(others))
            if not word.isascii():
                word = word.lower()
            found.append((i, words.setdefault(word, len(words)), marks))
        else:
            rest.append((i, others.setdefault(chunk, len(others))))
    of_word = _encode_words(list(words), path) if words else []
    of_other = _encode_chunks(list(others), path) if others else []
    for i, word, marks in found:
        parts[i] = young[keys[i]] = of_word[word] if marks < 0 else of_word[word] + of_other[marks]
    for i, other in rest:
        parts[i] = young[keys[i]] = of_other[other]
    return parts


def encode(texts: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """(ids, offsets): ids of all texts, each with the end token last; text i begins at offsets[i].

    This holds for tokenizers whose pieces never span white space, which drop it and ignore
    case: a text is the sequence of its chunks between white space, and equal chunks of a batch
    are encoded once. A text with the opening of a special token is encoded as it stands.
    """
    special = pc.fill_null(pc.match_substring(texts, "<|"), False)
    if pc.any(special).as_py():
        whole = _tokenizer(path)[0]
        rows = [
            encode(texts.slice(i, 1), path)[0]
            if not odd
            else np.array([*whole.encode(texts[i].as_py(), add_special_tokens=False).ids, END_TOKEN], "<u4")
            for i, odd in enumerate(special.to_pylist())
        ]
        return np.concatenate(rows), np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    split = words_of(texts, NOT_SPACE)
    keys, first, inverse = np.unique(split.hashes, return_index=True, return_inverse=True)
    low, high = split.starts[first].tolist(), split.ends[first].tolist()
    parts = _encode_distinct(keys.tolist(), split.data.tobytes(), low, high, path)
    flat = np.frombuffer(b"".join(parts), "<u4")
    sizes = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
    begins = np.concatenate([[0], np.cumsum(sizes)])[:-1] if len(sizes) else sizes
    # every chunk's ids, in the order of the texts
    counts = sizes[inverse]
    ends = np.concatenate([[0], np.cumsum(counts)])
    ids = flat[np.repeat(begins[inverse] - ends[:-1], counts) + np.arange(ends[-1])]
    tokens = ends[split.first]  # where each text's ids begin, end tokens not counted
    offsets = tokens + np.arange(len(tokens))
    out = np.full(offsets[-1], END_TOKEN, "<u4")
    out[np.arange(len(ids)) + np.repeat(np.arange(len(texts)), np.diff(tokens))] = ids
    return out, offsets


def tokenised(docs: DataFrame, path: str, length: int = SEQUENCE_TOKENS, width: int = CLASS_WIDTH) -> DataFrame:
    """Per row: (split, row) as its identity, doc_id, n tokens, class of the rest, ids.

    ``class_rank`` and ``full_before`` number the rest within its class and the full
    sequences within the split.
    """

    def run(batches):
        split = TaskContext.get().partitionId()
        ranks, row, full = np.zeros(length // width + 1, np.int64), 0, 0
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(at, BATCH_ROWS)
                ids, offsets = encode(part.column("text"), path)
                sizes = np.diff(offsets)
                kinds = -(-(sizes % length) // width)
                before, fulls = [], []
                for n, kind in zip(sizes.tolist(), kinds.tolist()):
                    before.append(int(ranks[kind]))
                    fulls.append(full)
                    ranks[kind] += 1
                    full += n // length
                rows = len(sizes)
                where = pa.py_buffer((4 * offsets).astype(np.int32).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(rows, split, np.int64)),
                        pa.array(np.arange(row, row + rows)),
                        part.column("doc_id"),
                        pa.array(sizes, pa.int64()),
                        pa.array(kinds, pa.int32()),
                        pa.array(before, pa.int64()),
                        pa.array(fulls, pa.int64()),
                        pa.Array.from_buffers(pa.binary(), rows, [None, where, pa.py_buffer(ids.tobytes())]),
                    ],
                    ["split", "row", "doc_id", "n", "class", "class_rank", "full_before", "ids"],
                )
                row += rows

    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(
        run,
        "split bigint, row bigint, doc_id bigint, n bigint, class int, class_rank bigint,"
        " full_before bigint, ids binary",
    )


# --- the linear program ---------------------------------------------------------------


def _best_pattern(values: np.ndarray, capacity: int) -> np.ndarray:
    """Unbounded knapsack: counts of classes 1..capacity of the most valuable pattern."""
    best = np.zeros(capacity + 1)
    choice = np.zeros(capacity + 1, np.int64)
    for room in range(1, capacity + 1):
        options = values[:room] + best[room - 1 :: -1][:room]  # class c leaves room - c
        pick = int(np.argmax(options))
        if options[pick] > best[room - 1] + 1e-15:
            best[room], choice[room] = options[pick], pick + 1
        else:
            best[room] = best[room - 1]
    counts, room = np.zeros(capacity), capacity
    while room > 0:
        if choice[room]:
            counts[choice[room] - 1] += 1
            room -= choice[room]
        else:
            room -= 1
    return counts


def column_generation(demand: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(patterns, amounts): class counts per pattern, and how often each is used (fractional).

    ``demand[c]`` documents have class c + 1; a sequence has room for ``len(demand)`` units.
    Revised simplex: the dual prices of the basis go to the knapsack, whose pattern enters
    until the solution is within ``NEAR_BOUND`` of the tokens' lower bound or none improves it.
    """
    capacity = len(demand)
    used = np.flatnonzero(demand > 0)
    basis = np.zeros((len(used), len(used)))  # columns are patterns
    basis[np.arange(len(used)), np.arange(len(used))] = capacity // (used + 1)
    inverse = np.diag(1.0 / np.diag(basis)) if len(used) else basis
    amounts = inverse.diagonal() * demand[used]
    bound = (demand[used] * (used + 1)).sum() / capacity
    for _ in range(MAX_COLUMNS):
        prices = inverse.sum(axis=0)  # cost 1 for every basic column
        values = np.zeros(capacity)
        values[used] = prices
        pattern = _best_pattern(values, capacity)[used]
        if (prices * pattern).sum() <= 1 + 1e-6 or amounts.sum() <= NEAR_BOUND * bound:
            break
        direction = (inverse * pattern).sum(axis=1)  # element-wise: no threads of a BLAS
        positive = direction > 1e-9
        ratios = np.where(positive, amounts / np.where(positive, direction, 1), np.inf)
        leaving = int(np.argmin(ratios))
        step = ratios[leaving]
        amounts = np.maximum(amounts - step * direction, 0)
        amounts[leaving] = step
        basis[:, leaving] = pattern
        pivot = inverse[leaving] / direction[leaving]
        inverse -= np.outer(direction, pivot)
        inverse[leaving] = pivot
    patterns = np.zeros((len(used), capacity), np.int64)
    patterns[:, used] = np.rint(basis.T)
    return patterns, amounts


@dataclass
class Places:
    """Which place of which sequence the documents of each class take, by rank.

    Places are runs: in class ``c`` the ranks from ``low[c][k]`` on go to pattern
    ``pattern[c][k]``, ``per[c][k]`` to a sequence, from slot ``slot[c][k]`` on.
    """

    low: list[np.ndarray]
    pattern: list[np.ndarray]
    per: list[np.ndarray]
    slot: list[np.ndarray]
    placed: np.ndarray  # per class, how many documents have a place
    first: np.ndarray  # first sequence of each pattern
    sequences: int

    @classmethod
    def of(cls, demand: np.ndarray, max_waste: float = MAX_WASTE) -> Places:
        capacity = len(demand)
        patterns, amounts = column_generation(demand.astype(float))
        kinds = np.arange(1, capacity + 1)
        copies = np.floor(amounts + 1e-6).astype(np.int64)
        copies[patterns @ kinds < (1 - max_waste) * capacity] = 0
        supply = patterns.T @ copies if len(patterns) else np.zeros(capacity, np.int64)
        while (over := np.flatnonzero(supply > demand)).size:  # from rounding errors only
            worst = int(np.argmax(patterns[:, over[0]] * (copies > 0)))
            copies[worst] -= 1
            supply -= patterns[worst]
        first = np.concatenate([[0], np.cumsum(copies)])
        runs = ([], [], [], [])
        for c in range(capacity):
            own = np.flatnonzero((patterns[:, c] > 0) & (copies > 0)) if len(patterns) else np.empty(0, np.int64)
            per = patterns[own, c] if len(own) else own
            runs[0].append(np.concatenate([[0], np.cumsum(per * copies[own])])[:-1].astype(np.int64))
            runs[1].append(own)
            runs[2].append(per)
            # the larger classes of a pattern come first in its sequences
            runs[3].append(patterns[own, c + 1 :].sum(axis=1) if len(own) else own)
        return cls(*runs, supply, first[:-1], int(first[-1]))

    def find(self, kinds: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, slot) of documents by class (from 1) and rank; -1 where there is no place."""
        sequence, slot = np.full(len(kinds), -1, np.int64), np.full(len(kinds), -1, np.int64)
        for kind in np.unique(kinds[kinds > 0]):
            c = kind - 1
            rows = np.flatnonzero((kinds == kind) & (ranks < self.placed[c]))
            if not len(rows):
                continue
            run = np.searchsorted(self.low[c], ranks[rows], "right") - 1
            inside = ranks[rows] - self.low[c][run]
            sequence[rows] = self.first[self.pattern[c][run]] + inside // self.per[c][run]
            slot[rows] = self.slot[c][run] + inside % self.per[c][run]
        return sequence, slot


# --- pieces ---------------------------------------------------------------------------


def _ranked(rows: DataFrame) -> DataFrame:
    """Add the rank in the class over all splits and the number of earlier full sequences."""
    earlier = Window.orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    of_class = rows.groupBy("class", "split").agg(F.count("*").alias("rows"))
    ranks = of_class.select(
        "class", "split", F.coalesce(F.sum("rows").over(earlier.partitionBy("class")), F.lit(0)).alias("rank_base")
    )
    return rows.join(ranks, ["class", "split"]).withColumn("rank", F.col("rank_base") + F.col("class_rank"))


def _placed(ranked: DataFrame, places: Places) -> DataFrame:
    """Add pattern_sequence and slot, both -1 where the rest has no place in a pattern."""
    sent = ranked.sparkSession.sparkContext.broadcast(places)
    added = ("pattern_sequence", "slot")

    def run(batches):
        for batch in batches:
            kinds, ranks = (batch.column(c).to_numpy() for c in ("class", "rank"))
            found = sent.value.find(kinds, ranks)
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, found)], [*batch.schema.names, *added])

    schema = StructType([*ranked.schema, *(StructField(c, LongType()) for c in added)])
    return ranked.mapInArrow(run, schema)


def _long(value: Column) -> Column:
    return value.cast("bigint")


_OF_DOCUMENT = ("split", "row", "doc_id", "doc_tokens")
_OF_PIECE = (*_OF_DOCUMENT, "start", "length", "sequence_id", "offset")


def _full_pieces(found: DataFrame, length: int) -> DataFrame:
    """Sequences of one document each, numbered by split and by place within it."""
    number = F.explode(F.sequence(_long(F.lit(0)), F.floor(F.col("doc_tokens") / length) - 1)).alias("k")
    return found.where(F.col("doc_tokens") >= length).select(*_OF_DOCUMENT, "full_before", number).select(
        *_OF_DOCUMENT,
        (F.col("k") * length).alias("start"),
        _long(F.lit(length)).alias("length"),
        (4 * (F.col("split") * (1 << 36) + F.col("full_before") + F.col("k"))).alias("sequence_id"),
        _long(F.lit(0)).alias("offset"),
    )


def _pattern_pieces(found: DataFrame) -> DataFrame:
    """Rests in patterns; offsets are sums of true lengths over one sequence's few pieces."""
    before = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    pieces = found.where("pattern_sequence >= 0").select(
        *_OF_DOCUMENT,
        (F.col("doc_tokens") - F.col("rest")).alias("start"),
        F.col("rest").alias("length"),
        (4 * F.col("pattern_sequence") + 1).alias("sequence_id"),
        "slot",
    )
    return pieces.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0))).select(*_OF_PIECE)


def _has_bit(number: Column, bit: Column) -> Column:
    return _long(F.floor(number / F.pow(F.lit(2), bit))) % 2 == 1


def _numbered_cuts(found: DataFrame, bits: Column) -> DataFrame:
    """One piece for every power of two in a rest, largest first, ranked among its equals.

    ``rank`` counts pieces of the same length over all splits, ``all`` is their number.
    """
    bit = F.explode(F.filter(bits, lambda b: _has_bit(F.col("rest"), b))).alias("bit")
    size = _long(F.pow(F.lit(2), F.col("bit")))
    cuts = found.where("pattern_sequence < 0 and class > 0").select(*_OF_DOCUMENT, "rest", bit)
    cuts = cuts.select(
        *_OF_DOCUMENT, "bit", size.alias("length"), (F.col("doc_tokens") - F.col("rest") % (2 * size)).alias("start")
    )
    cuts = staged(cuts, "packing-cuts")
    counts = cuts.groupBy("bit", "split").agg(F.count("*").alias("pieces"))
    earlier = Window.partitionBy("bit").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select(
        "bit",
        "split",
        F.coalesce(F.sum("pieces").over(earlier), F.lit(0)).alias("base"),
        F.sum("pieces").over(Window.partitionBy("bit")).alias("all"),
    )
    in_split = F.row_number().over(Window.partitionBy("bit", "split").orderBy("row")) - 1
    return cuts.withColumn("in_split", in_split).join(bases, ["bit", "split"]).withColumn(
        "rank", F.col("base") + F.col("in_split")
    )


def _power_pieces(found: DataFrame, length: int) -> DataFrame:
    """Rests cut into powers of two: equal pieces fill sequences; the last few, shorter ones."""
    bits = F.sequence(F.lit(length.bit_length() - 2), F.lit(0))
    pieces = _numbered_cuts(found, bits).withColumn("per", _long(F.lit(length) / F.col("length")))
    pieces = pieces.withColumn("left", F.col("all") % F.col("per"))  # pieces in no whole sequence
    pieces = pieces.withColumn("tail", F.col("rank") - (F.col("all") - F.col("left")))

    def add_digit(state: Column, bit: Column) -> Column:
        here = _has_bit(F.col("left"), bit)
        reached = here & (state["begin"] <= F.col("tail"))
        after = state["begin"] + _long(F.pow(F.lit(2), bit))
        return F.struct(
            F.when(here, after).otherwise(state["begin"]).alias("begin"),
            F.when(reached, state["begin"]).otherwise(state["own"]).alias("own"),
            F.when(reached, _long(bit)).otherwise(state["digit"]).alias("digit"),
        )

    # the binary digits of what is left, largest first, are sequences; the rank tells which
    nothing = F.struct(*[_long(F.lit(0)).alias(c) for c in ("begin", "own", "digit")])
    pieces = pieces.withColumn("digits", F.when(F.col("tail") >= 0, F.aggregate(bits, nothing, add_digit)))
    whole = F.col("tail") < 0
    sequence = _long(F.floor(F.col("rank") / F.col("per"))) * 16 + F.col("bit")
    shorter = F.col("bit") * 16 + F.col("digits.digit")
    return pieces.select(
        *_OF_DOCUMENT,
        "start",
        "length",
        F.when(whole, 4 * sequence + 2).otherwise(4 * shorter + 3).alias("sequence_id"),
        (F.when(whole, F.col("rank") % F.col("per")).otherwise(F.col("tail") - F.col("digits.own")) * F.col("length")).alias("offset"),
    )


def plan_pieces(
    tokens: DataFrame, length: int = SEQUENCE_TOKENS, width: int = CLASS_WIDTH, max_waste: float = MAX_WASTE
) -> DataFrame:
    """(split, row, doc_id, doc_tokens, start, length, sequence_id, offset) of every piece.

    Sequence ids have four kinds by their remainder modulo 4: full sequences of one document,
    patterns, sequences of equal power-of-two pieces, and the shorter last ones of these.
    """
    rows = tokens.select("split", "row", "doc_id", "n", "class", "class_rank", "full_before")
    demand = np.zeros(length // width, np.int64)
    for row in rows.where("class > 0").groupBy("class").count().collect():
        demand[row["class"] - 1] = row["count"]
    placed = _placed(_ranked(rows), Places.of(demand, max_waste))
    found = placed.withColumnRenamed("n", "doc_tokens").withColumn("rest", F.col("doc_tokens") % length)
    found = staged(found, "packing-places")
    return _full_pieces(found, length).unionByName(_pattern_pieces(found)).unionByName(_power_pieces(found, length))


def packed_pieces(
    docs: DataFrame,
    tokenizer: str,
    length: int = SEQUENCE_TOKENS,
    width: int = CLASS_WIDTH,
    max_waste: float = MAX_WASTE,
) -> DataFrame:
    """Every piece with its ids: doc_id, doc_tokens, start, length, sequence_id, offset, ids.

    ``ids`` are unsigned little-endian 32-bit numbers; the pieces of a sequence, in order of
    ``offset``, are the sequence. ``length`` has to be a power of two.
    """
    if length & (length - 1) or length % width:
        raise ValueError("length must be a power of two and a multiple of width")
    tokens = staged(tokenised(docs, tokenizer, length, width), "packing-tokens")
    pieces = plan_pieces(tokens, length, width, max_waste)
    ids = tokens.select("split", "row", F.col("ids").alias("all_ids"))
    own = F.expr("substring(all_ids, int(start * 4 + 1), int(length * 4))").alias("ids")
    return ids.join(pieces, ["split", "row"]).select(
        "doc_id", "doc_tokens", "start", "length", "sequence_id", "offset", own
    )
