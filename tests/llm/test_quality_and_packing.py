"""Quality rules and packing against brute force."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

from tillspark.llm import packing, quality

SF_DIR = "/root/testdata/sf0.001"
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def base_statistics(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)),
        len(covered), len(words) < 10 or 100 * len(covered) > 20 * len(words),
    )


def signed(x):
    return x - (1 << 64) if x >= 1 << 63 else x


def grams(text, buckets):
    def of_long(value, seed):
        return xxhash.xxh64_intdigest(value.to_bytes(8, "little", signed=True), seed)

    hashes = [signed(xxhash.xxh64_intdigest(w.encode(), 42)) for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
    pairs = [signed(of_long(b, of_long(a, 42))) for a, b in zip(hashes, hashes[1:])]
    return [h % buckets for h in hashes + pairs]


def test_the_target_grows_with_the_trusted_rows_whichever_join(spark):
    rows = [(i % 300, f"w{i % 7} w{i % 11} w{i}") for i in range(600)]  # every id twice
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    few = spark.createDataFrame([(i, 1) for i in range(100)] * 2 + [(None, 1), (200, 0)], "doc_id long, quality int")
    many = spark.createDataFrame([(i, 1) for i in range(250)], "doc_id long, quality int")
    models = {}
    for name, labels in (("few", few), ("many", many)):
        raw, target = Counter(), Counter()
        for doc_id, text in rows:
            raw.update(grams(text, 64))
            if doc_id < (100 if name == "few" else 250):
                target.update(grams(text, 64))
        for limit in (0, 1_000_000):
            (found,) = quality.ratio_model(docs, labels, 64, broadcast_ids=limit).collect()
            expected = [
                math.log((target[b] + 1) / (target.total() + 64)) - math.log((raw[b] + 1) / (raw.total() + 64))
                for b in range(64)
            ]
            assert found["ratios"] == pytest.approx(expected, abs=1e-9)
        models[name] = found["ratios"]
    assert models["few"] != models["many"]


def rows_of(spark, name):
    return [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/{name}.parquet").collect()]


def test_statistics_and_ratio_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    odd = [(-1, None), (-2, ""), (-3, " \n\t"), (-4, "a b c d e " * 30), (-5, "x\nx\n \nx y"), (-5, "x\nx\n \nx y")]
    docs = docs.unionByName(spark.createDataFrame(odd, "doc_id long, text string"))
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    found = quality.with_quality(docs, labels, buckets=512).select("doc_id", "quality.*").collect()
    texts = [tuple(r) for r in docs.collect()]
    trusted = {r["doc_id"] for r in labels.where("quality = 1").collect()}
    raw, target = Counter(), Counter()
    for doc_id, text in texts:
        raw.update(grams(text, 512))
        if doc_id in trusted:
            target.update(grams(text, 512))
    n_raw, n_target = raw.total() + 512, target.total() + 512
    by_id = {r["doc_id"]: r for r in found}
    assert len(found) == len(texts)
    for doc_id, text in texts:
        row, expected = by_id[doc_id], base_statistics(text)
        assert tuple(row)[1:7] == expected
        if expected[-1]:
            assert row["log_ratio"] is None and not row["kept"]
            continue
        own = grams(text, 512)
        ratio = sum(math.log((target[g] + 1) / n_target) - math.log((raw[g] + 1) / n_raw) for g in own) / len(own)
        assert row["log_ratio"] == pytest.approx(ratio, abs=1e-6)
        assert row["kept"] == (row["log_ratio"] >= quality.MIN_RATIO)


def test_good_texts_stay_and_junk_goes(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns
    ids = {r["doc_id"] for r in kept.select("doc_id").collect()}
    marked = {r["doc_id"]: r["quality"] for r in labels.collect()}
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    good = [d for d, q in marked.items() if q and not base_statistics(text[d])[-1]]
    bad = [d for d, q in marked.items() if not q]
    assert sum(d in ids for d in good) >= 0.99 * len(good)
    assert sum(d not in ids for d in bad) >= 0.9 * len(bad)


def test_quality_of_odd_tables(spark):
    labels = spark.createDataFrame([(None, 1), (5, None)], "doc_id long, quality int")
    docs = spark.createDataFrame(
        [(None, "a b c d e f g h i j k", 1, 2), (1, None, 3, 4)], "doc_id long, text string, quality int, `_text` int"
    )
    found = quality.with_quality(docs, labels)
    assert found.columns == ["doc_id", "text", "_text", "quality"]
    assert sorted(r["quality"]["kept"] for r in found.collect()) == [False, True]  # no target: ratio 0
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns and kept.first()["quality"] == 1
    assert quality.keep_good(docs.limit(0), labels.limit(0)).collect() == []


# --- packing --------------------------------------------------------------------------


def check_pieces(texts, pieces, length=2048):
    """Every id in exactly one piece, sequences gapless; returns the share of padding."""
    tokenizer = Tokenizer.from_file(TOKENIZER)
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"]].append(p)
        by_sequence[p["sequence_id"]].append(p)
    for doc_id, text in texts:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for p in sorted(by_doc[doc_id], key=lambda p: p["start"]):
            assert p["start"] == at and p["doc_tokens"] == len(ids)
            assert bytes(p["ids"]) == ids[at : at + p["length"]].tobytes()
            at += p["length"]
        assert at == len(ids)
    padding = held = 0
    for own in by_sequence.values():
        at = 0
        for p in sorted(own, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= length
        held += at
        padding += length - at if at & (at - 1) else 0
    return padding / (padding + held)


def test_pieces_of_a_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    pieces = packing.packed_pieces(docs, TOKENIZER).collect()
    assert check_pieces([(r["doc_id"], r["text"]) for r in docs.collect()], pieces) < 0.01


@pytest.mark.parametrize("words", [0, 1, 1100, 2047, 2048, 5000])
def test_lengths_that_fit_badly_are_cut(spark, words):
    texts = [(i, "a " * words) for i in range(30)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    assert check_pieces(texts, packing.packed_pieces(docs, TOKENIZER).collect()) < 0.01


def test_packing_of_odd_rows(spark):
    texts = [(1, None), (2, ""), (3, " \n"), (4, "Don't STOP!!.., now"), (5, "İΣ naïve ＡＢ <|endoftext|> x\x1cy\x85z"), (6, "b " * 9)]
    docs = spark.createDataFrame([(*t, 0, 0) for t in texts], "doc_id long, text string, row int, ids int")
    pieces = packing.packed_pieces(docs, TOKENIZER)
    check_pieces(texts, pieces.collect())
    assert packing.packed_pieces(docs.limit(0), TOKENIZER).collect() == []
    again = spark.createDataFrame([(None, "x y"), (None, "x y")], "doc_id long, text string")
    rows = packing.packed_pieces(again, TOKENIZER).collect()
    assert sum(r["length"] for r in rows) == 6 and {zlib.crc32(bytes(r["ids"])) for r in rows}


def test_column_generation_reaches_the_optimum():
    demand = np.zeros(10)
    demand[[2, 3, 6]] = [30, 20, 40]  # sizes 3, 4 and 7 in sequences of 10
    patterns, amounts = packing.column_generation(demand)
    assert amounts.sum() == pytest.approx(40 + 8, rel=0.2) and amounts.sum() >= (90 + 80 + 280) / 10 - 1e-6
    assert np.allclose(patterns.T @ amounts, demand, atol=1e-6)
    assert ((patterns * np.arange(1, 11)).sum(axis=1) <= 10).all()
