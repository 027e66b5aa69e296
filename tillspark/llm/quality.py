"""Quality rules with DataFrame functions only: text statistics, then a likelihood ratio.

Method. Words are runs of anything but white space. The base rules fail a text of fewer than
``MIN_WORDS`` words, or one with over 20 % of its words in 5-word windows that occur twice or
more. Every other text gets the log-likelihood ratio of its hashed unigrams and bigrams under
two multinomials, of the trusted target (texts labelled as good) and of the raw corpus (every
text), divided by the number of n-grams. A fixed threshold decides; nothing is drawn.

Scale. The raw counts cover every text; they and the target's are one aggregate over
``BUCKETS`` buckets, combined in each task first. Both grow with the corpus: every trusted id
counts. The ids are counted and broadcast up to ``BROADCAST_IDS`` of them; more are joined by a
shuffle of the texts, with the same counts. The model is ``BUCKETS`` numbers however large the
corpus is; it becomes a constant of the scoring expression, so texts are scored where they are
scanned and not shuffled for that.

Defined cases. A null text has no words, like an empty one: all counts 0, base rules failed.
A label without doc_id is ignored, and without any trusted row (or without labels) the ratio
is 0 for every text, which keeps it. Repeated rows count as often as they occur. Extra columns
stay as they are; the result is one added struct, ``quality``, which replaces a column of
that name (``keep_good`` adds nothing and keeps every column).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillspark.functions.once import with_columns_once
from tillspark.session import staged

MIN_WORDS = 10
WINDOW = 5
MAX_REPEAT_PERCENT = 20
BUCKETS = 1 << 14
BROADCAST_IDS = 1_000_000  # trusted ids in a broadcast (16 MB); more are joined by a shuffle
SMOOTHING = 1.0
MIN_RATIO = -0.1  # mean log ratio per n-gram; texts below are rejected

SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), "")


def _pairwise(values: Column, size: Column, width: int) -> Column:
    """Hash of every window of ``width`` neighbouring values."""
    windows = F.transform(
        F.sequence(F.lit(0), size - width), lambda i: F.xxhash64(*[F.get(values, i + k) for k in range(width)])
    )
    return F.when(size >= width, windows).otherwise(F.array().cast("array<bigint>"))


def _hashed(df: DataFrame, text: str) -> DataFrame:
    """Add _words and _hashes, the hash of every word."""
    split = with_columns_once(df, _words=_words(F.col(text)))
    return with_columns_once(split, _hashes=F.transform("_words", lambda w: F.xxhash64(w)))


def _grams(hashes: Column, buckets: int) -> Column:
    """Bucket of every unigram and bigram."""
    bigrams = _pairwise(hashes, F.size(hashes), 2)
    return F.concat(
        F.transform(hashes, lambda h: F.pmod(h, F.lit(buckets)).cast("int")),
        F.transform(bigrams, lambda h: F.pmod(h, F.lit(buckets)).cast("int")),
    )


def ratio_model(
    docs: DataFrame,
    labels: DataFrame,
    buckets: int = BUCKETS,
    smoothing: float = SMOOTHING,
    broadcast_ids: int = BROADCAST_IDS,
) -> DataFrame:
    """One row: ``ratios``, the log ratio of target to corpus probability of each bucket."""
    ids = labels.where("quality = 1 and doc_id is not null").select(F.col("doc_id").cast("bigint").alias("_id"))
    trusted = staged(ids.distinct(), "trusted-ids")
    few = trusted.count() <= broadcast_ids
    trusted = trusted.withColumn("_trusted", F.lit(1))
    texts = docs.select(F.col("doc_id").cast("bigint").alias("_id"), F.col("text").cast("string").alias("_text"))
    marked = texts.join(F.broadcast(trusted) if few else trusted, "_id", "left").drop("_id")
    counts = (
        _hashed(marked, "_text")
        .select("_trusted", F.explode(_grams(F.col("_hashes"), buckets)).alias("bucket"))
        .groupBy("bucket")
        .agg(F.count("*").alias("raw"), F.count("_trusted").alias("target"))
    )
    # every bucket, also those without an n-gram
    whole = (
        docs.sparkSession.range(buckets)
        .select(F.col("id").cast("int").alias("bucket"))
        .join(counts, "bucket", "left")
        .select("bucket", F.coalesce("raw", F.lit(0)).alias("raw"), F.coalesce("target", F.lit(0)).alias("target"))
    )
    rows = F.sort_array(F.collect_list(F.struct("bucket", "raw", "target")))
    model = whole.agg(F.sum("raw").alias("n_raw"), F.sum("target").alias("n_target"), rows.alias("rows"))

    def log_share(count: Column, total: str) -> Column:
        return F.log((count + smoothing) / (F.col(total) + smoothing * buckets))

    ratios = F.transform("rows", lambda r: log_share(r["target"], "n_target") - log_share(r["raw"], "n_raw"))
    none = F.transform("rows", lambda r: F.lit(0.0))
    return model.select(F.when(F.col("n_target") > 0, ratios).otherwise(none).alias("ratios"))


def _scored(
    docs: DataFrame,
    labels: DataFrame,
    min_ratio: float = MIN_RATIO,
    buckets: int = BUCKETS,
    broadcast_ids: int = BROADCAST_IDS,
) -> DataFrame:
    """``docs`` with its columns numbered c0, c1, ... and a struct ``quality``."""
    model = ratio_model(docs, labels, buckets, broadcast_ids=broadcast_ids).first()["ratios"]
    # one foldable expression: the optimiser makes it a constant array
    ratios = F.split(F.lit(",".join(f"{x:.9g}" for x in model)), ",").cast("array<double>")
    names = [f"c{i}" for i in range(len(docs.columns))]  # clash with nothing added here
    text = F.col(names[docs.columns.index("text")]).cast("string")
    df = docs.toDF(*names).withColumn("_text", F.coalesce(text, F.lit("")))
    df = _hashed(df, "_text")
    df = with_columns_once(
        df,
        _n=F.size("_words"),
        _chars=F.length(F.array_join("_words", "")),
        _symbols=F.regexp_count("_text", F.lit(SYMBOLS)),
        _lines=F.filter(F.split("_text", "\n"), lambda line: line.rlike(WORD)),
        _windows=_pairwise(F.col("_hashes"), F.size("_hashes"), WINDOW),
    ).drop("_words", "_text")
    # windows with their place, in order of their hash: equal ones are neighbours
    placed = F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    repeats = F.size(F.array_distinct("_windows")) < F.size("_windows")
    df = with_columns_once(
        df,
        _dup_lines=F.size("_lines") - F.size(F.array_distinct("_lines")),
        _placed=F.when(repeats, placed),
    ).drop("_windows", "_lines")
    sorted_windows = F.col("_placed")
    equal = F.filter(
        sorted_windows,
        lambda w, k: w["h"].eqNullSafe(F.get(sorted_windows, k - 1)["h"])
        | w["h"].eqNullSafe(F.get(sorted_windows, k + 1)["h"]),
    )
    df = with_columns_once(df, _places=F.sort_array(F.transform(equal, lambda w: w["i"]))).drop("_placed")
    places = F.col("_places")
    covered = F.aggregate(
        F.transform(places, lambda p, k: F.coalesce(F.least(F.get(places, k + 1) - p, F.lit(WINDOW)), F.lit(WINDOW))),
        F.lit(0),
        lambda total, step: total + step,
    )
    df = with_columns_once(df, _repeat=F.coalesce(covered, F.lit(0))).drop("_places")
    failed = (F.col("_n") < MIN_WORDS) | (100 * F.col("_repeat") > MAX_REPEAT_PERCENT * F.col("_n"))
    total = F.aggregate(
        _grams(F.col("_hashes"), buckets), F.lit(0.0), lambda score, bucket: score + F.get(ratios, bucket)
    )
    df = with_columns_once(
        df, _failed=failed, _ratio=F.when(~failed, total / (2 * F.size("_hashes") - 1))
    )
    quality = F.struct(
        F.col("_n").cast("bigint").alias("n_words"),
        F.col("_chars").cast("bigint").alias("word_chars"),
        F.col("_symbols").cast("bigint").alias("n_symbols"),
        F.col("_dup_lines").cast("bigint").alias("n_dup_lines"),
        F.col("_repeat").cast("bigint").alias("n_repeat_words"),
        F.col("_failed").alias("base_failed"),
        F.col("_ratio").alias("log_ratio"),
        F.coalesce(F.col("_ratio") >= min_ratio, F.lit(False)).alias("kept"),
    )
    return df.select(*names, quality.alias("quality"))


def with_quality(docs: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    """``docs`` with a struct ``quality``: the statistics, the ratio and the verdict."""
    scored = _scored(docs, labels, **settings)
    own = [F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns) if c != "quality"]
    return scored.select(*own, "quality")


def keep_good(docs: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` that pass the base rules and the ratio's threshold."""
    return _scored(docs, labels, **settings).where("quality.kept").drop("quality").toDF(*docs.columns)
