"""Word splitting, the Jaccard join and decontamination against brute force."""

import random
import re
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from tillspark.llm import decontaminate, setjoin
from tillspark.llm.words import LETTERS_AND_DIGITS, NOT_SPACE, words_of

SF_DIR = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TEXTS = ["", None, " ", "One two,Three\tÉa\x0b x\x1cy", "a", "ÄB c-d 12é", "tail \n", "x" * 3000 + " y"]


@pytest.mark.parametrize(
    "table, pattern", [(NOT_SPACE, r"[^\x20\x09-\x0D]+"), (LETTERS_AND_DIGITS, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")]
)
def test_words_are_those_of_the_pattern(table, pattern):
    split = words_of(pa.array(TEXTS, pa.string()), table)
    by_word = {}
    for i, text in enumerate(TEXTS):
        expected = re.findall(pattern, (text or "").translate(LOWER))
        low, high = split.first[i], split.first[i + 1]
        found = [split.data[s:e].tobytes().decode() for s, e in zip(split.starts[low:high], split.ends[low:high])]
        assert found == expected
        for word, value in zip(expected, split.of(i).tolist()):
            assert by_word.setdefault(word, value) == value
    assert len(set(by_word.values())) == len(by_word)


def test_word_hashes_do_not_depend_on_blocks():
    long = " ".join(f"w{i % 977}" for i in range(300_000))  # several blocks
    split = words_of(pa.array([long, "w5"]), NOT_SPACE)
    assert split.of(0)[5] == split.of(0)[5 + 977] == split.of(1)[0]


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute_components(rows):
    sets = [shingle_set(text) for _, text in rows]
    group = list(range(len(rows)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        common = len(sets[i] & sets[j])
        if common and 100 * common >= 80 * (len(sets[i]) + len(sets[j]) - common):
            group[root(j)] = root(i)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(i)] = min(least.get(root(i), doc_id), doc_id)
    return sorted(
        ((doc_id, len(sets[i]), least.get(root(i)) if sets[i] else doc_id) for i, (doc_id, _) in enumerate(rows)), key=str
    )


def corpus_of_copies(seed):
    """Copies, copies of copies, copies changed in few or many places, shared passages."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(3000)]
    passage = " ".join(rng.choices(words, k=60))
    texts = ["", None, "  ", "one two", "One two", "a b c d e", "A b c d e", "a b c d e f"]
    for _ in range(3):
        base = rng.choices(words, k=rng.randint(30, 160))
        texts.append(" ".join(base))
        for _ in range(40):
            copy = list(base if rng.random() < 0.6 else texts[-1].split())
            for _ in range(rng.randint(0, 5)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            if rng.random() < 0.2:
                del copy[rng.randrange(len(copy)) :][:3]
            texts.append(" ".join(copy))
    for _ in range(60):
        texts.append(" ".join(rng.choices(words, k=rng.randint(5, 90))) + " " + passage)
    rng.shuffle(texts)
    return [(i, text) for i, text in enumerate(texts)]


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_brute_force(spark, seed):
    rows = corpus_of_copies(seed)
    rows += [(None, rows[10][1]), (7, rows[7][1])]  # no id; a repeated row
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = sorted(map(tuple, setjoin.similar_components(docs).collect()), key=str)
    assert found == brute_components(rows)


def test_components_of_an_empty_table_and_other_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert setjoin.similar_components(empty).collect() == []
    docs = spark.createDataFrame(
        [(1, "a b c", 5, 6), (2, "a b c", 7, 8)], "doc_id int, text string, set_key int, component_id int"
    )
    assert sorted(map(tuple, setjoin.similar_components(docs).collect())) == [(1, 1, 1), (2, 1, 1)]
    assert [r["doc_id"] for r in setjoin.keep_first(docs).collect()] == [1]


def test_keep_first_keeps_rows_without_id_and_one_of_equal_rows(spark):
    rows = [(1, "a b c"), (1, "a b c"), (2, "a b c"), (None, "a b c"), (3, "x y"), (4, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted((tuple(r) for r in setjoin.keep_first(docs).collect()), key=str)
    assert kept == sorted([(1, "a b c"), (None, "a b c"), (3, "x y"), (4, None)], key=str)


def test_keep_first_decides_for_every_text_of_an_id(spark, monkeypatch):
    monkeypatch.setattr(setjoin, "BROADCAST_IDS", 0)  # other tests broadcast
    rows = [(1, "a b c", 1), (2, "a b c", 2), (2, "d e f", 3), (2, "d e f", 3), (3, "d e f", 4), (3, None, 5)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, _id int").repartition(3)
    kept = setjoin.keep_first(docs)
    assert kept.columns == docs.columns
    found = sorted(map(tuple, kept.collect()), key=str)
    assert found == [(1, "a b c", 1), (2, "d e f", 3), (3, None, 5)]


def test_components_with_hot_classes_and_empty_texts_apart(spark, monkeypatch):
    monkeypatch.setattr(setjoin, "HOT_PARTS", 4)  # in small tables every class is hot otherwise
    rows = corpus_of_copies(3) + [(1000 + i, "one text that a third of all rows has") for i in range(60)]
    rows += [(2000 + i, text) for i, text in enumerate([None, "", " \n"] * 10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert sorted(map(tuple, setjoin.similar_components(docs).collect()), key=str) == brute_components(rows)


def test_blocks_of_a_list_are_the_ranges_that_hang_together(spark):
    rng = random.Random(5)
    rows = []
    for token in range(30):
        for key in range(rng.choice([1, 2, 12])):
            need = rng.randint(1, 40)
            rows.append((token, 100 * token + key, need, need + rng.choice([0, 0, 1, 6]), rng.randint(50, 99), 100))
    lists = spark.createDataFrame(rows, "token long, set_key long, need int, reach int, live long, n long")
    leader = {(r["token"], r["need"]): r["leader"] for r in setjoin._leaders(lists).collect()}
    for token in range(30):
        entries = [row for row in rows if row[0] == token]
        block = {row[1]: {row[1]} for row in entries}
        for x, y in combinations(entries, 2):
            if max(x[2], y[2]) <= min(x[3], y[3]):
                whole = block[x[1]] | block[y[1]]
                block.update({key: whole for key in whole})
        share = {row[1]: (row[4] * 10, row[1]) for row in entries}
        for _, key, need, _, _, _ in entries:
            members = block[key]
            wanted = max(members, key=share.get) if len(members) > 1 else None
            # sets of one need are one block, also where one of them is alone otherwise
            assert leader.get((token, need)) == wanted


def test_sets_of_other_lengths_share_a_list_but_no_block(spark):
    """Texts of every length that share one passage, some of them with near copies."""
    rng = random.Random(6)
    passage = [f"p{i}" for i in range(40)]
    rows = []
    for i in range(60):
        own = [f"o{i}-{k}" for k in range(rng.choice([5, 15, 40, 160, 600]))]
        rows.append((i, " ".join(own + passage)))
        if i % 3 == 0:
            rows.append((100 + i, " ".join(own[:-1] + ["x"] + passage)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted(map(tuple, setjoin.similar_components(docs).collect()), key=str) == brute_components(rows)


# --- decontamination ------------------------------------------------------------------


def tokens(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute_leaks(text, items):
    """Items that overlap on any diagonal, by comparing every diagonal of every item."""
    doc, found = tokens(text), set()
    for item_id, item in items:
        own = tokens(item)
        if len(own) < decontaminate.SHORTEST_ITEM:
            continue
        for diagonal in range(-len(own) + 1, len(doc)):
            a = np.array([hash(w) for w in doc], dtype=np.int64)
            b = np.array([hash(w) for w in own], dtype=np.int64)
            if decontaminate.leaked_words(a, b, diagonal):
                found.add(item_id)
    return sorted(found)


def leaky_documents():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(14, 50)))) for i in range(6)]
    items += [(90, "alpha beta gamma delta epsilon"), (91, None), (92, ""), (None, " ".join(rng.choices(words, k=20)))]
    docs = [(0, None), (1, ""), (2, "Alpha, BETA gamma; delta epsilon!"), (3, "alpha beta gamma delta other")]
    for i in range(4, 60):
        body = rng.choices(words, k=rng.randint(5, 80))
        if i % 2:
            _, item = rng.choice(items[:6] + items[-1:])
            copied = item.split()
            for at in range(rng.randint(4, 9), len(copied), rng.randint(7, 11)):  # substitutions
                copied[at] = "changed"
            at = rng.randrange(len(body))
            body[at:at] = copied if i % 3 else copied[: rng.randint(5, len(copied))]
        docs.append((i, " ".join(body)))
    return docs, items


def test_leaks_equal_brute_force_where_a_seed_hits(spark):
    docs, items = leaky_documents()
    table = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    one = {r["doc_id"]: r for r in decontaminate.leaked_items(table, bench).collect()}
    many = {r["doc_id"]: r for r in decontaminate.leaked_items(table, bench, block_seeds=40).collect()}
    assert one == many  # blocks of the benchmark change nothing
    whole = 0
    for doc_id, text in docs:
        expected = brute_leaks(text, items)
        assert one[doc_id]["item_ids"] == [i for i in expected if i is not None]
        assert one[doc_id]["contaminated"] == bool(expected)
        whole += bool(expected)
    assert whole > 15
    kept = {r["doc_id"] for r in decontaminate.remove_leaks(table, bench).collect()}
    assert kept == {doc_id for doc_id, _ in docs if not one[doc_id]["contaminated"]}


def test_one_index_is_out_at_a_time(spark, monkeypatch):
    docs, items = leaky_documents()
    out, most, real = set(), [0, 0], type(spark.sparkContext).broadcast

    def broadcast(context, value):
        sent = real(context, value)
        out.add(id(sent))
        most[:] = [max(most[0], len(out)), most[1] + 1]
        destroy = sent.destroy
        monkeypatch.setattr(sent, "destroy", lambda: (out.discard(id(sent)), destroy()))
        return sent

    table = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    expected = sorted(r["doc_id"] for r in decontaminate.remove_leaks(table, bench).collect())
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", broadcast)
    kept = decontaminate.remove_leaks(table, bench, block_seeds=120)
    assert most[1] >= 10 and most[0] == 1
    assert sorted(r["doc_id"] for r in kept.collect()) == expected


def test_leaks_without_rows_and_with_odd_columns(spark):
    bench = spark.createDataFrame([], "item_id long, text string")
    docs = spark.createDataFrame([(1, "a b", 2)], "doc_id long, text string, `item.ids` int")
    assert decontaminate.remove_leaks(docs, bench).collect() == docs.collect()
    assert decontaminate.leaked_items(docs.limit(0), bench).collect() == []
    assert not decontaminate.leaked_items(docs, bench).first()["contaminated"]


def most_words(equal):
    """Longest stretch that is 80 % equal, by trying every one."""
    spans = [(i, j) for i in range(len(equal)) for j in range(i + 1, len(equal) + 1)]
    return max([j - i for i, j in spans if 5 * sum(equal[i:j]) >= 4 * (j - i)], default=0)


def test_stretches_equal_brute_force():
    rng = random.Random(7)
    for _ in range(500):
        size = rng.randint(1, 30)
        equal = [rng.random() < rng.choice([0.6, 0.8, 0.9]) for _ in range(size)]
        item = np.arange(size)
        document = np.where(equal, item, -1)
        longest = most_words(equal)
        assert decontaminate.leaked_words(document, item, 0) == (longest if longest >= min(12, size) else 0)


def test_items_with_a_fifth_substituted_are_found():
    rng = random.Random(11)
    cases = [(15, (3, 7, 11)), (15, (11,)), (12, (11,))]  # the words substituted
    cases += [(n, rng.sample(range(n), k)) for n in range(14, 26) for k in range(1, n // 5 + 1) for _ in range(40)]
    cases += [(n, rng.sample(range(n), n // 5)) for n in range(4, 14) for _ in range(20)]
    items = [(i, " ".join(f"w{i}x{k}" for k in range(n))) for i, (n, _) in enumerate(cases)]
    texts = []
    for (i, item), (_, places) in zip(items, cases):
        copied = item.split()
        for at in places:
            copied[at] = "changed"
        texts.append(" ".join(["before"] * 7 + copied + ["after"] * 7))
    found = decontaminate.SeedIndex.of(items).matches(pa.array(texts))
    assert [i for i, own in enumerate(found) if [item for item, _ in own] != [i]] == []


def test_items_with_more_substituted_are_not_found():
    item = [f"w{k}" for k in range(15)]
    index = decontaminate.SeedIndex.of([(1, " ".join(item)), (2, "one two three four five")])
    changed = [w if k % 4 else "changed" for k, w in enumerate(item)]  # 4 of 15
    assert index.matches(pa.array([" ".join(changed), "one two x y five"])) == [[], []]


def test_short_items_allow_one_substitution_from_five_words():
    items = [(n, " ".join(f"i{n}w{k}" for k in range(n))) for n in range(3, 10)]
    index = decontaminate.SeedIndex.of(items)
    assert index.matches(pa.array([f"x {text} y" for _, text in items])) == [[], *[[(n, n)] for n in range(4, 10)]]
    for n, text in items:
        for at in range(n):
            changed = [w if k != at else "changed" for k, w in enumerate(text.split())]
            assert index.matches(pa.array([" ".join(["x", *changed, "y"])])) == [[(n, n)] if n >= 5 else []]
