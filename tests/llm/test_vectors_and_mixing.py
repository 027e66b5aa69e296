"""Whitening, hard negatives and source mixing against brute force."""

import hashlib
import math
import random
from collections import defaultdict

import numpy as np
import oracle
import pyarrow as pa
import pytest

import __spark_entry__ as entry_points
from tillspark.llm import mixing, negatives, whitening
from tillspark.session import staged

SF_DIR = "/root/testdata/sf0.001"
VECTORS = "vec_id long, embedding array<float>, label int"


@pytest.fixture(autouse=True, scope="module")
def shipped(spark):
    entry_points.text_queries.ship_package(spark)


def table(spark, name):
    return spark.read.parquet(f"{SF_DIR}/{name}.parquet")


# --- whitening -------------------------------------------------------------------------


def whole_rows(rows):
    return np.array([[math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] for _, v, _ in rows])


def checked_whitening(found, rows, components=8, tolerance=1e-9):
    """Compare with the covariance's own eigenvectors, up to the sign of each component."""
    x = whole_rows(rows)
    n, sums = len(x), [sum(int(v) for v in column) for column in x.T]
    centred = x - np.array(sums) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    expected = centred @ vectors / np.sqrt(values)
    by_row = defaultdict(dict)
    for r in found:
        assert r["n"] == n and r["identity_error"] <= 1e-4
        assert r["explained"] == pytest.approx(values[r["component"] - 1] * n / (centred**2).sum(), rel=1e-9)
        by_row[r["vec_id"]][r["component"]] = r
    assert len(found) == n * components
    got = np.array([[by_row[k][c + 1]["whitened"] for c in range(components)] for k, _, _ in rows])
    signs = np.sign((got * expected).sum(axis=0))
    assert np.abs(got * signs - expected).max() < tolerance
    for (key, _, _), own in zip(rows, x.tolist()):
        assert by_row[key][1]["deviation"] == sum((n * a - s) ** 2 for a, s in zip(own, sums))


def test_whitening_of_the_whole_table_equals_eigenvectors(spark):
    found = entry_points.queries()["op11_embedding_whitening"](spark, SF_DIR).collect()
    checked_whitening(found, [tuple(r) for r in table(spark, "embeddings").select("vec_id", "embedding", "label").collect()])


def test_whitening_odd_rows(spark):
    random.seed(3)
    good = [(i, [random.gauss(0, s) for s in (3, 1, 0.5)], None) for i in range(60)]
    bad = [(100, None, 1), (101, [1.0, None, 2.0], 1), (102, [float("nan"), 0.0, 0.0], 1),
           (103, [float("inf"), 0.0, 0.0], 1), (104, [], 1), (105, [1.0, 2.0], 1)]
    df = spark.createDataFrame(good + bad, VECTORS).withColumnRenamed("label", "n").repartition(3)
    found = whitening.whitened(df).collect()
    checked_whitening(found, good, components=3)
    assert not {r["vec_id"] for r in found} & set(range(100, 106))


def test_whitening_repeated_rows_and_empty_tables(spark):
    rows = [(1, [1.0, 2.0], 0)] * 3 + [(None, [4.0, 2.5], 0), (2, [0.0, 7.0], 0)]
    found = whitening.whitened(spark.createDataFrame(rows, VECTORS)).collect()
    assert sorted((r["vec_id"] is None, r["vec_id"] or 0, r["component"]) for r in found) == sorted(
        (k is None, k or 0, c) for k, _, _ in rows for c in (1, 2)
    )
    assert len({(r["component"], r["whitened"]) for r in found if r["vec_id"] == 1}) == 2
    for nothing in ([], [(1, None, 0)], [(1, [], 0)], [(1, [2.0, 3.0], 0)] * 4):
        assert whitening.whitened(spark.createDataFrame(nothing, VECTORS)).collect() == []


def dense_products(x):
    return lambda y: (x.T @ (x @ y), float((x @ y) @ (x @ y)), float((x * x).sum()))


@pytest.mark.parametrize("kind", ["equal deviations", "low rank", "graded", "one row"])
def test_bidiagonalisation_on_hard_matrices(kind):
    draw = np.random.default_rng(1)
    x = {
        "equal deviations": np.concatenate([np.eye(6), -np.eye(6)]),
        "low rank": draw.standard_normal((50, 3)) @ draw.standard_normal((3, 9)),
        "graded": draw.standard_normal((80, 10)) * 10.0 ** -np.arange(10),
        "one row": draw.standard_normal((1, 5)),
    }[kind]
    right, matrix, whole = whitening.bidiagonalise(dense_products(x), x.shape[1], x.shape[1])
    assert np.abs(right @ right.T - np.eye(len(right))).max() < 1e-12
    assert whole == pytest.approx((x * x).sum())
    found, expected = np.linalg.svd(matrix)[1], np.linalg.svd(x)[1]
    size = min(len(found), len(expected))
    assert np.allclose(found[:size], expected[:size], rtol=0, atol=1e-7 * expected[0])


def test_deviations_beyond_64_bits():
    centre = whitening.Centre(10**8, (100_000 * 10**8 + 7,))
    x = np.array([[100_003], [100_000 + 2**31 - 200_000]])
    assert centre.deviations(x).to_pylist() == [(10**8 * 3 - 7) ** 2, None]


# --- hard negatives ----------------------------------------------------------------------


@pytest.mark.parametrize("shape", [(1, 1, 1), (3, 70, 5), (65, 64, 67), (130, 33, 257), (0, 4, 4), (64, 64, 64)])
def test_strassen_is_exact(shape):
    rows, inner, columns = shape
    draw = np.random.default_rng(7)
    for bound in (2**8, 2**23, 2**29):
        a = draw.integers(-bound, bound, (rows, inner))
        b = draw.integers(-bound, bound, (inner, columns))
        assert (negatives.strassen(a, b, leaf=4) == a @ b).all()


def brute_negatives(rows, count=5):
    usable = [
        (k, tuple(math.floor(256 * float(np.float32(c))) for c in v), label)
        for k, v, label in rows
        if label is not None and v is not None and all(c is not None and math.isfinite(c) for c in v)
    ]

    def order(entry):
        return -entry[0], entry[1] is None, entry[1] or 0

    out = []
    for a, (key, x, label) in enumerate(usable):
        if key is None or key % 100:
            continue
        scored = [(sum(p * q for p, q in zip(x, y)), k, other) for b, (k, y, other) in enumerate(usable) if b != a]
        for score, positive, _ in sorted((s for s in scored if s[2] == label), key=order)[:count]:
            window = [s for s in scored if s[2] != label and 80 * score <= 100 * s[0] <= 100 * score]
            for rank, (own, k, _) in enumerate(sorted(window, key=order)[:count], 1):
                out.append((key, positive, rank, k, score, own))
    return sorted(out, key=str)


def found_negatives(df):
    return sorted((tuple(r) for r in negatives.hard_negatives(df).collect()), key=str)


def odd_vectors():
    random.seed(11)
    rows = [(i, [random.gauss(0.4, 0.3) for _ in range(7)], i % 3) for i in range(0, 900, 5)]
    same = [0.5] * 7
    rows += [(1000 + i, same, i % 2) for i in range(40)]  # many equal scores
    rows += [(1100, same, 0), (1100, same, 0), (1100, same, 1), (None, same, 1), (None, same, 0)]
    rows += [(1200, None, 1), (1300, same, None), (1400, [None] * 7, 1), (1500, [float("nan")] * 7, 0),
             (1600, [float("-inf")] * 7, 0), (1700, [], 2), (1800, [0.5, 0.5], 1), (1900, [-1.0] * 7, 4),
             (2000, [0.0] * 7, 0), (2100, same, 99)]
    return rows


def test_negatives_equal_brute_force(spark):
    rows = odd_vectors()
    df = spark.createDataFrame(rows, VECTORS).repartition(5).withColumnRenamed("label", "number")
    found = sorted((tuple(r) for r in negatives.hard_negatives(df, label="number").collect()), key=str)
    assert found == brute_negatives(rows)


def test_negatives_do_not_depend_on_the_grid(spark, monkeypatch):
    df = spark.createDataFrame(odd_vectors(), VECTORS)
    expected = found_negatives(df)
    for name, size in (("CELL_ANCHORS", 3), ("CELL_ROWS", 17), ("TILE_ROWS", 5), ("TILE_ANCHORS", 2)):
        monkeypatch.setattr(negatives, name, size)
    assert found_negatives(df) == expected


def test_heaps_merge_in_any_order():
    draw = np.random.default_rng(2)
    entries = [(int(s), bool(u), int(k)) for s, u, k in zip(draw.integers(0, 9, 60), draw.random(60) < 0.2, draw.integers(0, 20, 60))]
    expected = sorted(entries, key=lambda e: (-e[0], e[1], e[2]))[:5]
    for _ in range(5):
        random.shuffle(entries)
        heaps = negatives.Heaps.empty(1, 5)
        for at in range(0, 60, 7):
            scores, unknown, ids = (np.array([column]) for column in zip(*entries[at : at + 7]))
            heaps.merge(np.array([0]), scores, unknown, ids)
        assert list(zip(heaps.scores[0], heaps.unknown[0], heaps.ids[0])) == expected


def test_no_negatives(spark):
    for rows in ([], [(0, [1.0], 1)], [(0, [1.0], 1), (1, [1.0], 2)], [(7, [1.0], 1), (8, [1.0], 1), (9, [1.0], 2)]):
        assert found_negatives(spark.createDataFrame(rows, VECTORS)) == []


def test_entries_out_of_range_are_held(spark):
    rows = [(0, [1e30, 0.0], 1), (1, [1e30, 1.0], 1), (2, [1e30, 0.5], 2)]
    bound = negatives.largest_entry(2)
    assert found_negatives(spark.createDataFrame(rows, VECTORS)) == [(0, 1, 1, 2, bound**2, bound**2)]


# --- mixing --------------------------------------------------------------------------------


def brute_targets(sizes, cap=3):
    """Targets as the rule says it: share, hold what is above its cap, share the excess again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weights = {s: 1 + i % 3 for i, s in enumerate(order)}
    free, target, left = set(order), {}, float(sum(sizes.values()))
    while free:
        whole = sum(weights[s] for s in free)
        above = [s for s in free if left * weights[s] / whole > cap * sizes[s]]
        if not above:
            return target | {s: left * weights[s] / whole for s in free}
        for s in above:
            target[s] = cap * sizes[s]
            free.discard(s)
        left -= sum(target[s] for s in above)
    return target


def brute_mix(rows, seed="mix"):
    """Sort each source by rank and take documents until its words are reached."""
    sized = [(k, s, len((t or "").split())) for k, s, t in rows]
    words = defaultdict(int)
    for _, s, n in sized:
        words[s] += n
    targets = brute_targets(words)
    taken = {}
    for source, total in words.items():
        goal = round(targets[source])
        copies, rest = divmod(goal, total) if total else (0, 0)
        own = [i for i, (_, s, n) in enumerate(sized) if s == source]
        for i in own:
            taken[i] = copies * sized[i][2]
        if not rest:
            continue
        low, high = 0.0, float(total) ** 2 + 1
        for _ in range(300):  # the t at which the expected words are the rest
            t = (low + high) / 2
            expected = sum(sized[i][2] * min(1, sized[i][2] / t) for i in own)
            low, high = (t, high) if expected > rest else (low, t)
        ranks = []
        for i in own:
            n = sized[i][2]
            if n >= high * (1 - 1e-12):
                taken[i] += n
                rest -= n
            elif n:
                digest = hashlib.md5(f"{seed}:{'' if sized[i][0] is None else sized[i][0]}".encode()).hexdigest()
                u = (int(digest[:13], 16) + 0.5) / 2**52
                p = n / high
                ranks.append(((u / (1 - u)) / (p / (1 - p)), n, i))
        at = 0
        ranks.sort()
        while rest > 0:
            tied = [r for r in ranks[at:] if abs(r[0] - ranks[at][0]) <= 1e-9 * r[0]]
            shared = sum(n for _, n, _ in tied)
            for _, n, i in tied:
                taken[i] += n if shared <= rest else rest * n // shared
            rest -= shared
            at += len(tied)
    return targets, sized, taken


def mixed(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(4)
    sized = staged(df.withColumn("c0", mixing.word_count(df["text"])), "test-sizes")
    return mixing.with_mix(sized, size="c0")


def mix_rows():
    random.seed(5)
    rows = []
    for source, docs, longest in (("a", 300, 50), ("b", 5, 8), ("Z", 60, 400), ("é", 1, 30), ("z", 200, 20), (None, 40, 40), ("", 7, 9)):
        rows += [(len(rows) + i, source, "w " * int(longest ** random.random())) for i in range(docs)]
    rows += [(None, "a", "one two"), (None, "a", "one two"), (3, "a", None), (4, "none", ""), (5, "none", None)]
    return rows + [(7000, "z", " \t x y z \n")] * 6 + [(7001, "a", "long " * 3000)]


def test_mix_equals_brute_force(spark):
    rows = [(k, s, t and t.replace(" ", "_").replace(" ", "_")) for k, s, t in mix_rows()]
    targets, sized, taken = brute_mix(rows)
    expected = sorted((str(k), str(s), n, taken[i]) for i, (k, s, n) in enumerate(sized))
    found = mixed(spark, rows).collect()
    assert sorted((str(r["doc_id"]), str(r["source"]), r["mix"]["size"], r["mix"]["taken"]) for r in found) == expected
    for r in found:
        assert r["mix"]["target"] == pytest.approx(targets[r["source"]])
        assert r["mix"]["taken"] <= 3 * r["mix"]["size"]


def test_mix_meets_its_targets_and_reruns_agree(spark):
    first, again = ({(r["doc_id"], r["source"], r["mix"]) for r in mixed(spark, mix_rows()).collect()} for _ in range(2))
    assert first == again
    words, target = defaultdict(int), {}
    for r in mixed(spark, mix_rows()).collect():
        words[r["source"]] += r["mix"]["taken"]
        target[r["source"]] = r["mix"]["target"]
    for source, goal in target.items():
        assert abs(words[source] - goal) <= 8  # the words that equal rows cannot share


def test_mixture_has_a_row_per_copy(spark):
    df = spark.createDataFrame([(1, "a", 10), (2, "b", 10), (3, "c", 0)], "doc_id long, source string, size int")
    rows = mixing.mixture(df, size="size").collect()
    words = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r["doc_id"], r["copy"]["copy"])):
        words[r["doc_id"]].append(r["copy"]["words"])
    assert words == {1: [7], 2: [10, 3]}


def test_mix_of_nothing(spark):
    assert mixed(spark, []).collect() == []
    only_empty = mixed(spark, [(1, "a", None), (2, None, "")]).collect()
    assert [(r["mix"]["target"], r["mix"]["taken"]) for r in only_empty] == [(0.0, 0)] * 2


def test_mix_runs_without_python_workers(spark):
    df = spark.createDataFrame([(1, "a", 10)], "doc_id long, source string, size int")
    plan = mixing.with_mix(staged(df, "plan"), size="size")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_words_are_counted_by_their_bytes(spark):
    texts = ["", None, " a b c\x0b\x0cd\re\n", " ", "\x1f \x1c"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(mixing.word_count(df["t"])).collect()] == [0, 0, 4, 1, 2]


@pytest.mark.parametrize("name", ["op12_source_mixing", "op13_hard_negatives"])
def test_query_matches_sql(spark, name):
    db = oracle.connect(SF_DIR)
    assert oracle.difference(entry_points.queries()[name](spark, SF_DIR), db, entry_points.oracle_sql()[name]) is None


def test_padded_positives():
    found = negatives.padded_positives(pa.chunked_array([[[5, 4], [], [9]]]))
    assert found.tolist() == [[5, 4], [negatives.NONE] * 2, [9, negatives.NONE]]
