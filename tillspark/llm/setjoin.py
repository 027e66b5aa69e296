"""Exact Jaccard self-join of shingle sets, by set relations and index lists.

Method. Sets whose elements are equal are one class from the start, so copies are never
compared. The remaining sets are indexed by prefix lists, in two levels:

1. The elements of a set are ordered by hash and the first third forms its entry in the
   index. Two sets that link share at least ``ceil(2n/15)`` of these (n: size of the larger).
   Elements that only one set has can be dropped; a set left with fewer is skipped whole.
2. What is left is ordered from rare to common, and only as many lists as that bound needs
   are looked at. An entry of a list keeps its position: from there on, the set has ``reach``
   elements in the index, and it needs ``need`` of them. Two sets whose first common element
   this is share at most the smaller reach and need the larger ``need``, so that they cannot
   link unless their ranges [need, reach] meet. A list falls into blocks of ranges that hang
   together; a set skips all blocks of the list but its own.

3. The elements of the sets that are left are counted in full; a set that shares less than the
   wanted percentage of its elements with other sets, whichever these are, is skipped as well.

Within a block, pairs are not enumerated. Its most typical set, the one most of whose
elements others share, is its leader and every set of the block is compared with it.
From these overlaps the answers of similar sets follow: sets linked to the same leader are
connected and need no comparison, and two sets a, b have at most
``min(|a & leader|, |b & leader|) + min(|a' - leader|, |b' - leader|)`` elements in common,
where a', b' leave out the elements that no other set has. The sets of a leader with equal
size and overlaps form a block: blocks which that bound rules out are skipped whole, and only
pairs with a set of the blocks left are compared. The result is exact: no cap, no sampling; hash values are 64 bits wide.

Defined cases. A null or empty text has the empty set and links with nothing. Repeated rows
and equal texts are members of one class. A row without doc_id takes part; it gets the
component of its class, null where no member has an id. Only ``doc_id`` and the text column
are read, so other columns of any name do no harm.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillspark.llm import components
from tillspark.llm.words import NOT_SPACE, U64, shingles, words_of
from tillspark.session import staged

SHINGLE_WORDS = 5
LINK_PERCENT = 80
BATCH_ROWS = 256  # rows whose words are held at once
BROADCAST_IDS = 1_000_000  # ids in a broadcast; more are joined by a shuffle
HOT_PARTS = 1000  # a class of over this part of all rows is hot; there are fewer than this many


def _sets(batches: Iterator[pa.RecordBatch], width: int):
    """(batch, row, sorted set, set key) of every row; the key is 0 for an empty set."""
    for batch in batches:
        for at in range(0, batch.num_rows, BATCH_ROWS):
            part = batch.slice(at, BATCH_ROWS)
            words = words_of(part.column("text"), NOT_SPACE)
            rows = []
            for row in range(part.num_rows):
                found = np.unique(shingles(words.of(row), width))
                key = int.from_bytes(blake2b(found.tobytes(), digest_size=8).digest(), "little", signed=True)
                rows.append((found, key if len(found) else 0))
            yield part, rows


def set_members(docs: DataFrame, width: int = SHINGLE_WORDS) -> DataFrame:
    """Per row: doc_id, a hash of its text, size of its set and the key of the set."""

    def run(batches):
        for part, rows in _sets(batches, width):
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    part.column("text_key"),
                    pa.array([len(found) for found, _ in rows], pa.int64()),
                    pa.array([key for _, key in rows], pa.int64()),
                ],
                ["doc_id", "text_key", "n_shingles", "set_key"],
            )

    keyed = _columns(docs).withColumn("text_key", _text_key("text"))
    return keyed.mapInArrow(run, "doc_id bigint, text_key bigint, n_shingles bigint, set_key bigint")


def _text_key(text: str) -> Column:
    """Tells the texts of one doc_id apart."""
    return F.xxhash64(F.col(text).cast("string"))


def _columns(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string").alias("text"))


def _index_entries(docs: DataFrame, width: int) -> DataFrame:
    """(token, set_key, n): the first third of every set in hash order."""

    def run(batches):
        seen = set()
        for _, rows in _sets(batches, width):
            fresh = []
            for found, key in rows:
                if len(found) and key not in seen:
                    seen.add(key)
                    fresh.append((found[: len(found) - 2 * len(found) // 3], key, len(found)))
            if fresh:
                sizes = [len(tokens) for tokens, _, _ in fresh]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([t for t, _, _ in fresh]).view(np.int64)),
                        pa.array(np.repeat(np.array([k for _, k, _ in fresh], np.int64), sizes)),
                        pa.array(np.repeat(np.array([n for _, _, n in fresh], np.int32), sizes)),
                    ],
                    ["token", "set_key", "n"],
                )

    return _columns(docs).mapInArrow(run, "token bigint, set_key bigint, n int")


def _lists(entries: DataFrame, percent: int) -> DataFrame:
    """Index lists that can hold a link: (token, set_key, need, reach), one row per entry."""
    shared = (
        entries.groupBy("token")
        .agg(F.count("*").alias("df"), F.min("set_key").alias("low"), F.max("set_key").alias("high"))
        .where("low <> high")
        .select("token", "df")
    )
    of_set = Window.partitionBy("set_key")
    # no aggregate beside the join, so that a token of very many sets can be split there
    ranked = (
        entries.join(shared, "token")
        .repartition("set_key")
        .dropDuplicates(["set_key", "token"])
        .withColumn("live", F.count("*").over(of_set))
        .withColumn("rank", F.row_number().over(of_set.orderBy("df", "token")))
    )
    # of the n elements, n - floor(2n/3) are entries; two linked sets share this many of them
    needed = F.ceil((F.lit(percent) * F.col("n") * 3 - F.col("n") * 200) / 300)
    reach = F.col("live") - F.col("rank") + 1
    found = ranked.select("token", "set_key", needed.cast("int").alias("need"), reach.cast("int").alias("reach"))
    return found.where("reach >= need")


FILTER_BITS = 1 << 23
BITMAP_BITS = 1 << 15  # of one bitmap of Spark


def _key_filter(keys: DataFrame) -> bytes:
    """A bitmap of fixed size (1 MiB) that has a bit for every key; more keys set more bits."""
    bit = F.pmod("set_key", F.lit(FILTER_BITS)) + 1
    words = (
        keys.select(bit.alias("bit"))
        .groupBy((F.bitmap_bucket_number("bit") - 1).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bitmap"))
    )
    out = np.zeros((FILTER_BITS // BITMAP_BITS, BITMAP_BITS // 8), np.uint8)
    for row in words.collect():
        bitmap = np.frombuffer(bytes(row["bitmap"]), np.uint8)
        out[row["bucket"], : len(bitmap)] = bitmap
    return out.tobytes()


def _set_arrays(docs: DataFrame, keys: DataFrame, width: int) -> DataFrame:
    """(set_key, tokens) of the sets in ``keys``, each once.

    The bitmap keeps most other sets from being shuffled; the semi-join decides.
    """
    bits = docs.sparkSession.sparkContext.broadcast(_key_filter(keys))

    def run(batches):
        table = np.frombuffer(bits.value, np.uint8)
        seen = set()
        for _, rows in _sets(batches, width):
            keep = []
            for found, key in rows:
                bit = key % FILTER_BITS
                if len(found) and table[bit // 8] >> (bit % 8) & 1 and key not in seen:
                    seen.add(key)
                    keep.append((found, key))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([key for _, key in keep], pa.int64()),
                    pa.array([found.tobytes() for found, _ in keep], pa.binary()),
                ],
                ["set_key", "tokens"],
            )

    found = _columns(docs).mapInArrow(run, "set_key bigint, tokens binary")
    return found.join(keys, "set_key", "left_semi").groupBy("set_key").agg(F.first("tokens").alias("tokens"))


def _live_sets(sets: DataFrame, percent: int) -> DataFrame:
    """(set_key, n, live): of each set the elements, sorted, that another set has as well.

    Only these can be in an overlap. A set that keeps fewer than ``percent`` of its elements
    links with nothing and is left out.
    """

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(at, BATCH_ROWS)
                tokens = [np.frombuffer(t.as_py(), np.int64) for t in part.column("tokens")]
                sizes = np.array([len(t) for t in tokens], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(tokens)),
                        pa.array(np.repeat(part.column("set_key").to_numpy(), sizes)),
                        pa.array(np.repeat(sizes, sizes)),
                    ],
                    ["token", "set_key", "n"],
                )

    rows = sets.mapInArrow(run, "token bigint, set_key bigint, n bigint")
    shared = (
        rows.groupBy("token")
        .agg(F.min("set_key").alias("low"), F.max("set_key").alias("high"))
        .where("low <> high")
        .select("token")
    )
    live = F.sort_array(F.collect_list("token"))  # at most the words of one document
    return (
        rows.join(shared, "token")
        .groupBy("set_key", "n")
        .agg(live.alias("live"))
        .where(100 * F.size("live") >= percent * F.col("n"))
    )


def _overlaps(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, size_a, size_b, overlap) of the pairs (a, b), from their live elements."""

    def values(column) -> list[np.ndarray]:
        where, flat = column.offsets.to_numpy(), column.values.to_numpy()
        return [flat[low:high] for low, high in zip(where[:-1], where[1:])]

    def run(batches):
        for batch in batches:
            common = []
            for x, y in zip(values(batch.column("live_a")), values(batch.column("live_b"))):
                if len(x) > len(y):
                    x, y = y, x
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                common.append(int(np.count_nonzero(y[at] == x)))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("a", "b", "size_a", "size_b")), pa.array(common, pa.int64())],
                ["a", "b", "size_a", "size_b", "overlap"],
            )

    def side(name: str) -> DataFrame:
        return sets.select(
            F.col("set_key").alias(name), F.col("n").alias(f"size_{name}"), F.col("live").alias(f"live_{name}")
        )

    joined = pairs.join(side("a"), "a").join(side("b"), "b")
    return joined.mapInArrow(run, "a bigint, b bigint, size_a bigint, size_b bigint, overlap bigint")


def _linked(percent: int):
    return 100 * F.col("overlap") >= percent * (F.col("size_a") + F.col("size_b") - F.col("overlap"))


def _leaders(lists: DataFrame) -> DataFrame:
    """(token, need, leader) of the blocks of every list that have more than one set.

    The windows see one row per length of a list's sets, not its entries.
    """
    typical = F.struct((F.col("live") * 1000 / F.col("n")).cast("int").alias("share"), "n", "set_key")
    of_need = lists.groupBy("token", "need").agg(
        F.max("reach").alias("reach"), F.max(typical).alias("top"), F.count("*").alias("sets")
    )
    of_list = Window.partitionBy("token").orderBy("need")
    before = F.max("reach").over(of_list.rowsBetween(Window.unboundedPreceding, -1))
    apart = of_need.withColumn("apart", F.coalesce(F.col("need") > before, F.lit(False)).cast("int"))
    blocks = apart.withColumn("block", F.sum("apart").over(of_list))
    of_block = Window.partitionBy("token", "block")
    led = blocks.withColumn("first", F.max("top").over(of_block)).withColumn("all", F.sum("sets").over(of_block))
    return led.where(F.col("all") > 1).select("token", "need", F.col("first.set_key").alias("leader"))


def _compared_with_leader(lists: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(leader, set_key, n, inside, outside, near) of every set in the blocks of a leader.

    ``inside`` counts the elements a set shares with the leader, ``outside`` its other live
    ones. The leader of a block is the set most of whose elements others share.
    """
    led = lists.join(_leaders(lists), ["token", "need"]).select("leader", "set_key", "n", "live").distinct()
    led = staged(led, "set-led")
    pairs = led.where("leader <> set_key").select(F.col("leader").alias("a"), F.col("set_key").alias("b"))
    compared = _overlaps(pairs, sets).select(
        F.col("a").alias("leader"), F.col("b").alias("set_key"), "overlap", _linked(percent).alias("linked")
    )
    # the leader's own overlap is whole
    return led.join(compared, ["leader", "set_key"], "left").select(
        "leader",
        "set_key",
        "n",
        F.coalesce("overlap", "live").alias("inside"),
        (F.col("live") - F.coalesce("overlap", "live")).alias("outside"),
        F.coalesce("linked", F.lit(True)).alias("near"),
    )


def set_links(docs: DataFrame, percent: int = LINK_PERCENT, width: int = SHINGLE_WORDS) -> DataFrame:
    """Links (a, b) between set keys that connect exactly what the Jaccard join connects.

    Every pair of sets that links is connected by these. A pair shares a block and so a leader:
    either both are linked to it, or the pair is among those that are compared below.
    ``percent`` has to be over 66, as a third of a set is indexed.
    """
    if not 66 < percent <= 100:
        raise ValueError("percent must be over 66 and at most 100")
    lists = staged(_lists(_index_entries(docs, width), percent), "set-lists")
    found = staged(_set_arrays(docs, lists.select("set_key").distinct(), width), "set-arrays")
    sets = staged(_live_sets(found, percent), "set-live")
    sizes = sets.select("set_key", "n", F.size("live").cast("bigint").alias("live"))
    lists = lists.join(sizes, "set_key")
    members = staged(_compared_with_leader(lists, sets, percent), "set-relations")
    linked = members.where("near and set_key <> leader").select(F.col("leader").alias("a"), F.col("set_key").alias("b"))
    # once more among the sets that are far from their leader: it connects their own groups
    far_lists = lists.join(
        members.where("not near").select("set_key").distinct(), "set_key", "left_semi"
    )
    second = _compared_with_leader(far_lists, sets, percent).where("near and set_key <> leader")
    linked = staged(
        linked.unionByName(second.select(F.col("leader").alias("a"), F.col("set_key").alias("b"))).distinct(), "set-links"
    )
    groups = components.connected(linked).withColumnRenamed("node", "set_key")
    members = staged(
        members.join(groups, "set_key", "left").withColumn("component", F.coalesce("component", "set_key")), "set-groups"
    )
    # members with equal numbers are one block; a block that the bound rules out is skipped
    block = ["n", "inside", "outside"]
    blocks = members.groupBy("leader", *block).agg(F.count("*").alias("sets"))
    far = members.where("not near").select(
        "leader", F.col("set_key").alias("a"), F.col("component").alias("component_a"),
        *[F.col(c).alias(f"{c}_a") for c in block],
    )
    most = F.least("inside_a", "inside") + F.least("outside_a", "outside")
    visited = far.join(blocks, "leader").where(100 * most >= percent * (F.col("n_a") + F.col("n") - most))
    other = members.withColumnRenamed("set_key", "b").alias("other")
    same_block = [visited[c] == F.col(f"other.{c}") for c in ("leader", *block)]
    open_pairs = visited.join(
        other, [*same_block, F.col("component_a") != F.col("component"), F.col("near") | (F.col("a") < F.col("b"))]
    )
    open_pairs = open_pairs.select("a", "b").distinct()
    rest = _overlaps(open_pairs, sets).where(_linked(percent)).select("a", "b")
    # a group's own links are stood for by those to its first set
    grouped = groups.where("set_key <> component").select(F.col("set_key").alias("a"), F.col("component").alias("b"))
    return grouped.unionByName(rest)


def _with_components(docs: DataFrame, percent: int, width: int) -> DataFrame:
    """Per row: doc_id, text_key, n_shingles and component_id.

    Rows meet their class by key. A class of over a ``HOT_PARTS``-th of all rows would be one
    task there; of these there are fewer than ``HOT_PARTS``, so that they are broadcast.
    """
    members = staged(set_members(docs, width), "set-members")
    nodes = members.where("n_shingles > 0").groupBy("set_key").agg(
        F.min("doc_id").alias("least"), F.count("*").alias("rows")
    )
    groups = components.connected(set_links(docs, percent, width))
    # the smallest doc_id of each group of sets that has more than one
    named = (
        groups.join(nodes, groups["node"] == nodes["set_key"])
        .select("component", "set_key", "least")
    )
    smallest = named.groupBy("component").agg(F.min("least").alias("of_group"))
    linked = named.join(smallest, "component").select("set_key", "of_group")
    classes = nodes.join(linked, "set_key", "left").select(
        "set_key", "rows", F.coalesce("of_group", "least").alias("component_id")
    )
    classes = staged(classes, "set-classes")
    hot = F.broadcast(classes.where(F.col("rows") * HOT_PARTS > members.count()).drop("rows"))
    classes = classes.drop("rows")
    empty = members.where("n_shingles = 0").withColumn("component_id", F.col("doc_id"))
    filled = members.where("n_shingles > 0")
    others = filled.join(hot, "set_key", "left_anti").join(classes, "set_key")
    whole = others.unionByName(filled.join(hot, "set_key")).unionByName(empty)
    return whole.select("doc_id", "text_key", "n_shingles", "component_id")


def similar_components(
    docs: DataFrame, percent: int = LINK_PERCENT, width: int = SHINGLE_WORDS
) -> DataFrame:
    """Per row: doc_id, n_shingles and component_id, the smallest doc_id reachable by links."""
    return _with_components(docs, percent, width).drop("text_key")


def _few(rows: DataFrame, name: str) -> DataFrame:
    """Distinct rows, written; marked for broadcast where they are few enough for that."""
    rows = staged(rows.distinct(), name)
    return F.broadcast(rows) if rows.count() <= BROADCAST_IDS else rows


def keep_first(docs: DataFrame, percent: int = LINK_PERCENT, width: int = SHINGLE_WORDS) -> DataFrame:
    """The rows of ``docs`` whose doc_id is the smallest of their component.

    Equal rows under one id stay once. Rows without doc_id have no place in that order: they
    stay. Of an id with several texts, those go whose own component has a smaller id.
    """
    groups = staged(_with_components(docs, percent, width), "set-components")
    gone = _few(
        groups.where("doc_id <> component_id").select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")),
        "texts-gone",
    )
    # each side's columns are named apart from those of the documents
    doc_id = F.col("doc_id").cast("bigint")
    names = [f"c{i}" for i in range(len(docs.columns))]
    own = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(docs.columns, names)], doc_id.alias("_id"), _text_key("text").alias("_key"))
    kept = own.join(gone, ["_id", "_key"], "left_anti")
    twice = groups.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("rows")).where("rows > 1")
    twice = _few(twice.select(F.col("doc_id").alias("_id")), "ids-twice")
    if not twice.isEmpty():
        again = kept.join(twice, "_id", "left_semi").dropDuplicates(["_id", "_key"])
        kept = kept.join(twice, "_id", "left_anti").unionByName(again.select(*kept.columns))
    return kept.select(*names).toDF(*docs.columns)
