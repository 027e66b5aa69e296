"""Toxicity scores of texts whose obfuscated words are restored first.

Method. Words in disguise (digits and signs for letters, letters set apart, letters repeated)
are spans found by patterns. Each is a lattice: every sign may stand for some letters at a
cost, a run of one letter for one or two of it, separators for nothing or the end of a word. A
Viterbi search picks the cheapest path under a character trigram model counted over the whole
corpus. Signs at a word's end, spans set apart with signs and those of mostly signs stay as
they are where that costs less. The restored text, and only it, is then scored by a logistic model over the words it holds and
over their beginnings (4, 5 and 6 bytes).

Training. The labelled rows outside the held-out quarter are joined to their texts; if they
are more than ``TRAINING_ROWS``, those with the smallest hash of doc_id are taken. A
distributed count per feature and label selects the ``FEATURES`` most telling ones; the
logistic regression is fitted to the sample's matrix on the driver, both bounded by
parameters. doc_id, language, source and labels are no inputs of a score.

Scale. One pass over all texts counts characters (the alphabet bounds what is gathered), one
scores them; neither shuffles texts. The sample's ids have a fixed bound and are broadcast.

Defined cases. A null or empty text is scored like any text without words: the model's base
rate. A row without doc_id is scored and never held out. Labels without doc_id are ignored;
of contradicting labels the toxic one counts. Without any training row every score is 0.
A span of any length is read; one without a letter stays as it is.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillspark.llm.words import LETTERS_AND_DIGITS, U64, mix, text_bytes, words_of
from tillspark.session import staged

TRAINING_ROWS = 20_000
FEATURES = 4096
LEAST_ROWS = 3  # training rows a feature is in
PREFIXES = (4, 5, 6)
TOXIC_FROM = 0.3
HELD_OUT = 2  # the remainder of crc32(doc_id) modulo 4 that is never learned from
KNOWN_SPAN = 40  # characters of a span whose reading is remembered; longer ones are read again
BATCH_ROWS = 256

# --- characters -----------------------------------------------------------------------

SYMBOLS = 28  # 0: no letter, 1-26: a-z, 27: any byte of another letter
_CODE = np.zeros(256, np.int64)
_CODE[97:123] = np.arange(1, 27)
_CODE[65:91] = np.arange(1, 27)
_CODE[128:] = 27


def character_counts(docs: DataFrame) -> DataFrame:
    """(trigram, count) over all texts; a trigram is a number in base ``SYMBOLS``."""

    def run(batches):
        total = np.zeros(SYMBOLS**3, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_ROWS):
                data, offsets = text_bytes(batch.column("text").slice(at, BATCH_ROWS))
                codes = _CODE[data]
                codes = np.insert(codes, offsets[:-1], 0)  # a text begins like a word
                if len(codes) > 2:
                    total += np.bincount(
                        (codes[:-2] * SYMBOLS + codes[1:-1]) * SYMBOLS + codes[2:], minlength=SYMBOLS**3
                    )
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["trigram", "count"])

    counts = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "trigram bigint, count bigint")
    return counts.groupBy("trigram").agg(F.sum("count").alias("count"))


def character_costs(counts: DataFrame) -> np.ndarray:
    """Costs (negative log probabilities) of a symbol after two others, smoothed."""
    table = np.full(SYMBOLS**3, 0.5)
    for row in counts.collect():  # at most SYMBOLS ** 3 rows
        table[row["trigram"]] += row["count"]
    table = table.reshape(SYMBOLS, SYMBOLS, SYMBOLS)
    return -np.log(table / table.sum(axis=2, keepdims=True))


# what a sign may stand for, and what that costs; a letter stands for itself
SIGNS = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¥": "y",
}
SIGN_COST = 1.0
DOUBLE_COST = 1.5  # a run of three or more read as a doubled letter
KEPT_COST = 3.0  # a run of a sign left as it is: which of the signs it is

_SIGN = r"0-9@$!|+(€£¥"
_APART = rf"(?:(?<![^\W\d_])[^\W\d_](?![^\W\d_])|(?<![^\W_])[{_SIGN}](?![^\W_]))"
SUSPECT = re.compile(
    rf"{_APART}(?:[ .\-_*]{_APART}){{3,}}"  # letters and signs set apart
    rf"|[@$]?(?<![A-Za-z0-9])(?=[A-Za-z]++[{_SIGN}]|[0-9][{_SIGN}]*+(?:[A-Za-z]{{2}}|[A-Za-z][{_SIGN}]))[A-Za-z0-9][A-Za-z{_SIGN}]*+"
    # a long run of signs that leads to no word is passed over at once and stays as it is
    rf"|(?<![A-Za-z0-9])[0-9][{_SIGN}]{{40,}}(?=[{_SIGN}])"
    r"|(?<![A-Za-z])[A-Za-z]*([A-Za-z])\1\1[A-Za-z]*"  # letters repeated
)
_SEPARATORS = " .-_*"


def _runs(span: str) -> list[tuple[str, int, bool, int]]:
    """(sign, length, whether a separator is inside or after it, where it begins) of every run."""
    runs: list[list] = []
    for at, sign in enumerate(span):
        if sign in _SEPARATORS:
            if runs:
                runs[-1][2] = True
        elif runs and runs[-1][0] == sign:
            runs[-1][1] += 1
        else:
            runs.append([sign, 1, False, at])
    return [tuple(run) for run in runs]


def _code(letter: str) -> int:
    return 0 if letter == " " else ord(letter) - 96 if "a" <= letter <= "z" else 27


def _cheapest(span: str, costs: np.ndarray, tail: int) -> tuple[float, str]:
    """Cost and letters of the cheapest reading: Viterbi over (previous two symbols).

    Everything from a run of signs at or after ``tail`` on may stay as it is.
    """
    # paths: state (two last symbols) -> (cost, letters as links to the one before)
    paths = {(0, 0): (0.0, None)}

    def step(paths, letter, extra):
        code = _code(letter)
        out = {}
        for (x, y), (cost, letters) in paths.items():
            new = cost + extra + float(costs[x, y, code])
            if (y, code) not in out or new < out[y, code][0]:
                out[y, code] = (new, (letters, letter))
        return out

    def merged(ways):
        out = {}
        for way in ways:
            for state, found in way.items():
                if state not in out or found[0] < out[state][0]:
                    out[state] = found
        return out

    def ended(paths):
        return min(((c + float(costs[x, y, 0]), letters) for (x, y), (c, letters) in paths.items()), key=lambda p: p[0])

    runs = _runs(span)
    best = None
    for number, (sign, length, apart, at) in enumerate(runs):
        if number and at >= tail:
            cost, letters = ended(paths)
            cost += KEPT_COST * (len(runs) - number)
            if best is None or cost < best[0]:
                best = (cost, letters, at)
        readings = SIGNS.get(sign)
        ways = []
        for letter, extra in [(letter, SIGN_COST) for letter in readings] if readings else [(sign, 0.0)]:
            once = step(paths, letter, extra)
            before = merged([once, step(once, " ", 0.0)]) if apart and length > 1 else once
            if length > 2:
                ways += [once, step(before, letter, DOUBLE_COST)]
            elif length == 2:
                ways.append(step(before, letter, extra))
            else:
                ways.append(once)
        paths = merged(ways)
        if apart and number < len(runs) - 1:
            paths = merged([paths, step(paths, " ", 0.0)])
    cost, letters = ended(paths)
    kept = ""
    if best is not None and best[0] < cost:
        cost, letters, at = best
        kept = span[len(span[:at].rstrip(_SEPARATORS)) :]
    out = []
    while letters is not None:
        letters, letter = letters
        out.append(letter)
    return cost, "".join(reversed(out)).rstrip(" ") + kept


def restore_word(span: str, costs: np.ndarray) -> str:
    """The cheapest reading of one span with all its signs read."""
    text = span.lower()
    return _cheapest(text, costs, len(text))[1]


def _kept_cost(span: str, costs: np.ndarray) -> float:
    """What the span costs as it stands: every run of a sign is one symbol that is no letter."""
    runs = _runs(span)
    codes = [0, 0]
    for sign, length, apart, _ in runs:
        codes += [0] if sign in SIGNS else [_code(sign)] * length
        codes += [0] if apart and codes[-1] else []
    if codes[-1]:
        codes.append(0)
    signs = sum(sign in SIGNS for sign, *_ in runs)
    return KEPT_COST * signs + sum(float(costs[x, y, z]) for x, y, z in zip(codes, codes[1:], codes[2:]))


def _read(span: str, costs: np.ndarray) -> str:
    """The span restored, or as it is where that costs less than signs read for letters."""
    text = span.lower()
    letters = sum(c.isalpha() for c in text)
    if not letters:
        return span
    signs = sum(c in SIGNS for c in text)
    # signs that may stay: those after the last letter, or the last digit of a word with signs inside
    tail = len(text.rstrip("".join(SIGNS) + _SEPARATORS))
    if any(c in SIGNS for c in text[:tail]):
        tail = len(text.rstrip("".join(c for c in SIGNS if not c.isdigit()) + _SEPARATORS))
    cost, reading = _cheapest(text, costs, tail)
    apart = any(c in _SEPARATORS for c in text)
    if signs and (apart or 3 * letters < len(text)) and _kept_cost(text, costs) <= cost:
        return span
    return reading


def restored(text: str, costs: np.ndarray, known: dict[str, str] | None = None) -> str:
    """``text`` with every span in disguise replaced by its reading."""
    known = {} if known is None else known

    def read(match: re.Match) -> str:
        span = match.group()
        if len(span) > KNOWN_SPAN:
            return _read(span, costs)
        if span not in known:
            if len(known) > 100_000:
                known.clear()
            known[span] = _read(span, costs)
        return known[span]

    return SUSPECT.sub(read, text)


# --- features and model ---------------------------------------------------------------


def _feature_hashes(words) -> np.ndarray:
    """One row per kind of feature, one column per word."""
    rows = [words.hashes, *(mix(words.prefixes(size) + U64(size)) for size in PREFIXES)]
    return np.stack(rows)


@dataclass
class Model:
    """Logistic model: sorted feature hashes, their weights, and the base weight."""

    features: np.ndarray
    weights: np.ndarray
    base: float

    def __post_init__(self):
        self.table = np.zeros(1 << 20, bool)
        self.table[(self.features >> U64(44)).astype(np.int64)] = True

    def hits(self, words) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (text, feature number) pairs."""
        if not len(self.features) or not len(words.starts):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        hashes = _feature_hashes(words)
        kind, word = np.nonzero(self.table[(hashes >> U64(44)).astype(np.int64)])
        found = hashes[kind, word]
        at = np.minimum(np.searchsorted(self.features, found), len(self.features) - 1)
        real = self.features[at] == found
        text = np.searchsorted(words.first, word[real], "right") - 1
        pairs = np.unique(text * len(self.features) + at[real])
        return pairs // len(self.features), pairs % len(self.features)

    def scores(self, words) -> np.ndarray:
        text, feature = self.hits(words)
        texts = len(words.offsets) - 1
        total = self.base + np.bincount(text, self.weights[feature], minlength=texts)
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _restored_words(part: pa.RecordBatch, costs: np.ndarray, known: dict[str, str]):
    texts = [restored(t, costs, known) if t else "" for t in part.column("text").to_pylist()]
    return words_of(pa.array(texts, pa.large_string()), LETTERS_AND_DIGITS)


def is_held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == HELD_OUT, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> DataFrame:
    """(text, toxic) of at most ``rows`` labelled documents outside the held-out quarter."""
    known = labels.where("doc_id is not null and toxic is not null")
    known = known.groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    sample = known.where(~is_held_out(F.col("doc_id"))).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    texts = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string").alias("text"))
    joined = texts.join(F.broadcast(sample), "doc_id")
    # one row per id, however often it is repeated
    return joined.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic")).drop("doc_id")


def fit(docs: DataFrame, labels: DataFrame, costs: np.ndarray, rows: int = TRAINING_ROWS) -> Model:
    """Select features by distributed counts and fit the logistic model to the sample."""
    sample = staged(training_rows(docs, labels, rows), "toxic-sample")

    def features(batches):
        known: dict[str, str] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(at, BATCH_ROWS)
                words = _restored_words(part, costs, known)
                hashes = _feature_hashes(words)
                toxic = part.column("toxic").to_numpy()
                found, labels = [], []
                for row in range(part.num_rows):
                    own = np.unique(hashes[:, words.first[row] : words.first[row + 1]])
                    found.append(own)
                    labels.append(np.full(len(own), toxic[row], np.int32))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(found).view(np.int64)), pa.array(np.concatenate(labels), pa.int32())],
                    ["feature", "toxic"],
                )

    counts = (
        sample.mapInArrow(features, "feature bigint, toxic int")
        .groupBy("feature")
        .agg(F.count("*").alias("rows"), F.sum("toxic").alias("toxic"))
        .where(F.col("rows") >= LEAST_ROWS)
    )
    size, toxic = sample.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not size or not toxic or toxic == size:
        return Model(np.empty(0, U64), np.empty(0), -30.0 if not toxic else 30.0)
    share = toxic / size
    expected = F.col("rows") * share
    surprise = F.abs(F.col("toxic") - expected) / F.sqrt(expected * (1 - share))
    best = counts.orderBy(surprise.desc(), "feature").limit(FEATURES).collect()
    chosen = Model(np.sort(np.array([r["feature"] for r in best], np.int64).view(U64)), np.zeros(len(best)), 0.0)

    def matrix(batches):
        known: dict[str, str] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(at, BATCH_ROWS)
                text, feature = chosen.hits(_restored_words(part, costs, known))
                split = np.split(feature, np.searchsorted(text, np.arange(1, part.num_rows)))
                yield pa.RecordBatch.from_arrays(
                    [part.column("toxic"), pa.array([f.astype(np.int16) for f in split], pa.list_(pa.int16()))],
                    ["toxic", "features"],
                )

    collected = sample.mapInArrow(matrix, "toxic int, features array<smallint>").toArrow()
    target = collected.column("toxic").to_numpy().astype(float)
    lists = collected.column("features").combine_chunks()
    row = np.repeat(np.arange(len(target)), np.diff(lists.offsets.to_numpy()))
    weights, base = _logistic(row, lists.flatten().to_numpy().astype(np.int64), target, len(chosen.features))
    return Model(chosen.features, weights, base)


def _logistic(row: np.ndarray, feature: np.ndarray, target: np.ndarray, size: int) -> tuple[np.ndarray, float]:
    """Weights and base weight of a ridge logistic regression on a sparse 0/1 matrix."""
    weights, base = np.zeros(size), float(np.log(target.mean() / (1 - target.mean())))
    squares, base_squares = np.full(size, 1e-8), 1e-8
    penalty = 1e-4
    for _ in range(200):
        total = base + np.bincount(row, weights[feature], minlength=len(target))
        error = 1 / (1 + np.exp(-np.clip(total, -30, 30))) - target
        slope = np.bincount(feature, error[row], minlength=size) / len(target) + penalty * weights
        base_slope = error.mean()
        squares += slope**2
        base_squares += base_slope**2
        weights -= 0.3 * slope / np.sqrt(squares)
        base -= 0.3 * base_slope / np.sqrt(base_squares)
    return weights, base


def scored(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> DataFrame:
    """Per row: doc_id, held_out, score and predicted."""
    costs = character_costs(character_counts(docs))
    model = fit(docs, labels, costs, rows)
    sent = docs.sparkSession.sparkContext.broadcast((model, costs))

    def run(batches):
        model, costs = sent.value
        known: dict[str, str] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(at, BATCH_ROWS)
                words = _restored_words(part, costs, known)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(model.scores(words), pa.float64())], ["doc_id", "score"]
                )

    rows_in = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string").alias("text"))
    return rows_in.mapInArrow(run, "doc_id bigint, score double").select(
        "doc_id",
        is_held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"),
    )
