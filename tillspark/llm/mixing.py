"""A mix of sources that meets target weights, by Pareto order sampling with DataFrame functions only.

Method. Sources, in code point order and null last, get their share of all words by weight; a
target stops at ``cap`` times its source's words and the excess is shared again by weight among
the others. A source whose target is k times its words and a rest takes k certain whole copies of
every document. The rest is a sample with inclusion proportional to size, p = min(1, size / t),
where t solves sum(size * p) = rest: documents of size t and more are certain, the others are
ranked by their random odds divided by their inclusion odds, u / (1 - u) over p / (1 - p), and
taken in that order until the words of the rest are reached. The size of the sample is fixed in
words: the last document gives the words still missing, and rows of equal rank there share them by
size. u is a keyed digest of the id, so a rerun takes the same words.

Scale. Nothing sorts the documents of a source. Ranks are bounded to [0, 1) and counted in 4,096
bins per source, then the bin that holds the last document in 4,096 finer ones, and only the
finer one, of one document in 16 million, by value; each is an aggregate combined in each task first. The
threshold t comes from counts per distinct size. Weights and targets need running sums over the
sources; these are taken per range of a sorted, stored table. Documents are joined to their
source's thresholds, on the side that adaptive execution splits where a source is hot.

Defined cases. A null text has size 0; documents of size 0 take 0. A null source is a source of
its own. Rows that share an id also share their u: equal ones take equally much. A null id counts
as the empty text. Without any word all targets are 0; an empty table gives an empty result. Other
columns stay as they are; the result is one added struct, ``mix``, which replaces a column of
that name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillspark.session import staged

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)  # repeated over the sources
CAP = 3
SEED = "mix"
BITS = 52  # of the digest that becomes u
BINS = 4096
EXACT = "decimal(38,0)"


def word_count(text: Column) -> Column:
    """Number of words of a text; 0 for a null one."""
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORD)), F.lit(0)).cast("bigint")


def _uniform(key: Column, seed: str) -> Column:
    """A number strictly between 0 and 1 that depends on the key alone."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))))
    return (F.conv(F.substring(digest, 1, BITS // 4), 16, 10).cast("bigint") + 0.5) / float(1 << BITS)


def _running(df: DataFrame, order: Sequence[Column], **sums: Column) -> DataFrame:
    """Add sums over all rows up to each one in ``order``; no task sees more than its range."""
    sorted_rows = df.orderBy(*order).withColumn("_place", F.monotonically_increasing_id())
    placed = staged(sorted_rows, "mix-order").withColumn("_range", F.shiftright("_place", 33))
    totals = placed.groupBy("_range").agg(*[F.sum(c).alias(f"_all_{n}") for n, c in sums.items()])
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    before = totals.select("_range", *[F.sum(f"_all_{n}").over(earlier).alias(f"_before_{n}") for n in sums])
    within = Window.partitionBy("_range").orderBy("_place")
    summed = placed.withColumns({n: F.sum(c).over(within) for n, c in sums.items()}).join(before, "_range")
    return summed.select(
        *df.columns, "_place",
        *[(F.col(n) + F.coalesce(F.col(f"_before_{n}"), F.lit(0))).alias(n) for n in sums],
    )


def source_targets(sized: DataFrame, weights: Sequence[int] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """Per ``_source``: its words (``_words``) and ``_target``, from rows of ``_source`` and ``_size``."""
    sources = sized.groupBy("_source").agg(F.sum("_size").cast("bigint").alias("_words"))
    ranked = _running(sources, [F.col("_source").asc_nulls_last()], _rank=F.lit(1))
    turn = F.pmod(F.col("_rank") - 1, F.lit(len(weights))).cast("int")
    weighted = ranked.withColumn("_weight", F.get(F.array(*map(F.lit, weights)), turn)).drop("_rank", "_place")
    # sources that reach their cap at the lowest level come first
    weighted = weighted.withColumn("_ratio", cap * F.col("_words") / F.col("_weight"))
    filled = staged(
        _running(
            weighted, [F.col("_ratio"), F.col("_source")],
            _capped=(cap * F.col("_words")).cast(EXACT), _weights=F.col("_weight").cast(EXACT),
        ),
        "mix-levels",
    )
    whole = filled.agg(F.sum("_words").alias("words"), F.sum("_weight").alias("weights")).first()
    # the level where exactly the sources before this one are held at their cap
    left = F.lit(whole["words"] or 0).cast(EXACT) - F.col("_capped") + cap * F.col("_words")
    shared = F.lit(whole["weights"] or 0).cast(EXACT) - F.col("_weights") + F.col("_weight")
    level = left.cast("double") / shared.cast("double")
    found = filled.where(level <= F.col("_ratio")).agg(F.min_by(F.struct(level.alias("level"), "_place"), "_place").alias("f"))
    first = found.first()["f"]
    if first is None:  # no source at all
        first = {"level": 0.0, "_place": 0}
    held = F.col("_place") < first["_place"]
    target = F.when(held, (cap * F.col("_words")).cast("double")).otherwise(F.col("_weight") * F.lit(first["level"]))
    return filled.select("_source", "_words", target.alias("_target"))


def _same(name: str = "_source") -> Column:
    return F.col(name).eqNullSafe(F.col(f"_plan{name}"))


def _with_plan(sized: DataFrame, plan: DataFrame) -> DataFrame:
    """Rows with their source's plan; a hot source is a skewed join, never a group."""
    return sized.join(plan.withColumnRenamed("_source", "_plan_source"), _same(), "left").drop("_plan_source")


def _inclusion(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """Per source: whole copies, the words left, the size that is certain and the words to be ranked for."""
    words, goal = F.col("_words"), F.round("_target").cast("bigint")
    copies = F.when(words > 0, F.floor(goal / words)).otherwise(0).cast("bigint")
    goals = targets.withColumn("_goal", goal).withColumn("_copies", copies)
    # the quotient is rounded: put it right by exact products
    exact = F.col("_copies") - F.when(F.col("_copies") * words > F.col("_goal"), 1).otherwise(0)
    goals = goals.withColumn("_copies", exact).withColumn("_rest", F.col("_goal") - F.col("_copies") * words)
    goals = staged(goals.drop("_goal"), "mix-goals")
    counts = sized.where("_size > 0").groupBy("_source", "_size").agg(F.count("*").alias("_rows"))
    sizes = _with_plan(counts, goals.where("_rest > 0").select("_source", "_words", "_rest")).where("_rest > 0")
    by_size = Window.partitionBy("_source").orderBy("_size")
    size, rows = F.col("_size").cast(EXACT), F.col("_rows").cast(EXACT)
    steps = sizes.select(
        "_source",
        "_size",
        F.sum((size * size).cast(EXACT) * rows).over(by_size).cast("double").alias("_squares"),
        (F.col("_words") - F.sum(F.col("_size") * F.col("_rows")).over(by_size)).alias("_larger"),
        F.lead("_size").over(by_size).alias("_next"),
        "_rest",
    )
    ranked_for = F.col("_rest") - F.col("_larger")
    fits = F.col("_next").isNull() | (F.col("_squares") <= ranked_for.cast("double") * F.col("_next"))
    # the smallest step that fits; below it more would be certain than there is room for
    chosen = (
        steps.where((ranked_for > 0) & fits)
        .groupBy("_source")
        .agg(F.min_by(F.struct((F.col("_squares") / ranked_for).alias("t"), ranked_for.alias("r")), "_size").alias("_c"))
        .select("_source", F.col("_c.t").alias("_certain"), F.col("_c.r").cast("bigint").alias("_ranked"))
    )
    return staged(_with_plan(goals, chosen), "mix-inclusion")


def _rank(u: Column, size: Column, certain: Column) -> Column:
    """Random odds over inclusion odds, where the inclusion probability is size / certain."""
    return (u * (certain - size)) / ((1 - u) * size)


def _place_of(rank: Column) -> Column:
    """Bin of a rank, of BINS * BINS bins in rank order."""
    return F.least(F.floor(rank / (1 + rank) * float(BINS * BINS)), F.lit(BINS * BINS - 1))


def _cut(competing: DataFrame, plan: DataFrame, step: str, left: str) -> DataFrame:
    """``plan`` with the value of ``step`` at which the words ``left`` are reached, and what is left there."""
    words = competing.groupBy("_source", step).agg(F.sum("_size").alias("_here"))
    limits = plan.select("_source", F.col(left).alias("_left"))
    upto = F.sum("_here").over(Window.partitionBy("_source").orderBy(step))
    reached = _with_plan(words, limits).withColumn("_upto", upto).where("_upto >= _left")
    last = reached.groupBy("_source").agg(
        F.min_by(F.struct(step, (F.col("_left") - F.col("_upto") + F.col("_here")).alias("l"), F.col("_here").alias("h")), step).alias("_l")
    )
    found = last.select("_source", F.col(f"_l.{step}").alias(f"_last{step}"), F.col("_l.l").alias(f"{left}_in"), F.col("_l.h").alias("_shared"))
    return staged(_with_plan(plan.drop("_shared"), found), "mix-cut")


def mix_plan(sized: DataFrame, weights: Sequence[int] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """One row per source with all that decides its documents, from ``_source``, ``_size`` and ``_u``."""
    plan = _inclusion(sized, source_targets(sized, weights, cap))
    ranked = _with_plan(sized, plan.where("_ranked is not null").select("_source", "_certain"))
    ranked = ranked.where((F.col("_size") > 0) & (F.col("_size") < F.col("_certain")))
    ranked = ranked.select("_source", "_size", _rank(F.col("_u"), F.col("_size"), F.col("_certain")).alias("_rank"))
    ranked = ranked.withColumn("_bin", F.floor(_place_of(F.col("_rank")) / BINS))
    plan = _cut(ranked, plan, "_bin", "_ranked")
    inside = _with_plan(ranked, plan.select("_source", "_last_bin")).where("_bin = _last_bin")
    inside = inside.withColumn("_fine", _place_of(F.col("_rank")))
    plan = _cut(inside, plan, "_fine", "_ranked_in")
    inside = _with_plan(inside, plan.select("_source", "_last_fine")).where("_fine = _last_fine")
    return _cut(inside, plan, "_rank", "_ranked_in_in")


def _decision(u: Column) -> Column:
    """Words taken of a row that carries its size and its source's plan."""
    size, rank = F.col("_size"), _rank(u, F.col("_size"), F.col("_certain"))
    shared = F.floor(F.col("_ranked_in_in_in") * size / F.col("_shared")).cast("bigint")
    extra = (
        F.when((size == 0) | F.col("_certain").isNull(), 0)
        .when(size >= F.col("_certain"), size)
        .when(rank < F.col("_last_rank"), size)
        .when(rank == F.col("_last_rank"), F.least(shared, size))
        .otherwise(0)
    )
    return (F.col("_copies") * size + extra).cast("bigint")


def with_mix(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    cap: int = CAP,
    *,
    size: str,
    source: str = "source",
    key: str = "doc_id",
    seed: str = SEED,
) -> DataFrame:
    """``docs`` with a struct ``mix``: size, source_size, target (its source's) and taken, in words.

    ``docs`` is read several times; ``size`` names a column that holds each row's words.
    """
    names = [f"c{i}" for i in range(len(docs.columns))]  # clash with nothing added here
    place = dict(zip(docs.columns, names))
    rows = docs.toDF(*names).withColumns(
        {
            "_source": F.col(place[source]).cast("string"),
            "_size": F.coalesce(F.col(place[size]).cast("bigint"), F.lit(0).cast("bigint")),
            "_u": _uniform(F.col(place[key]), seed),
        }
    )
    plan = mix_plan(rows.select("_source", "_size", "_u"), weights, cap)
    mix = F.struct(
        F.col("_size").alias("size"),
        F.col("_words").alias("source_size"),
        F.col("_target").alias("target"),
        _decision(F.col("_u")).alias("taken"),
    )
    own = [F.col(place[c]).alias(c) for c in docs.columns if c != "mix"]
    return _with_plan(rows, plan).select(*own, mix.alias("mix"))


def mixture(docs: DataFrame, **settings) -> DataFrame:
    """The mix itself: a row per copy, with its number (from 1) and the words it takes of the text."""
    mixed = with_mix(docs, **settings)
    size, taken = F.col("mix.size"), F.col("mix.taken")
    copies = F.ceil(taken / size).cast("int")
    # words of each copy: whole ones, then what is left
    words = F.transform(F.sequence(F.lit(0), copies - 1), lambda i: F.least(size, taken - i * size))
    named = F.transform(words, lambda w, i: F.struct((i + 1).alias("copy"), w.alias("words")))
    own = [c for c in mixed.columns if c not in ("mix", "copy")]
    return mixed.where(taken > 0).select(*own, F.explode(named).alias("copy"))
