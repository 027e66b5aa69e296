"""Surrogates, license rules and toxicity."""

import random
import re
import time
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tillspark.llm import licenses, surrogates, toxicity
from tillspark.session import staged

SF_DIR = "/root/testdata/sf0.01"
KEY = b"test key"

PRIVATE = (
    'Mail a.b-1@mail1.example.com or A.B-1@MAIL1.EXAMPLE.COM, call +1 (244) 555-4688 now, card 4111 1111 1111 1111;'
    ' ip 78.241.210.149. password=36fdea71d793cf922e token = "0641917ea4e9feb9cda83477b57ac2654884f485" by'
    " Mr John Smith and Ms SMITH, Herr Braun. DE89 3704 0044 0532 0130 00 ssn 123-45-6789 (555) 123-4567"
)


def with_ids(spark, texts, extra=""):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", *([extra] if extra else []))


def test_surrogates_keep_type_format_and_identity(spark):
    docs = with_ids(spark, [PRIVATE, "see 78.241.210.149, Mr J Smith", "no data here", None, "", PRIVATE])
    out = {r["doc_id"]: r for r in surrogates.with_surrogates(docs, KEY).collect()}
    text = out[0]["text"]
    for start, end, _, _ in surrogates.mentions(PRIVATE):
        assert PRIVATE[start:end] not in text
    pattern = (
        r"Mail ([a-z]\.[a-z]-\d@\w+\.example) or ([A-Z]\.[A-Z]-\d@\w+\.EXAMPLE), call (\+1 \(\d{3}\) \d{3}-\d{4}) now,"
        r" card (\d{4} \d{4} \d{4} \d{4}); ip ([\d.]+)\. password=([0-9a-f]{18}) token = \"([0-9a-f]{40})\" by"
        r" Mr (\w+) (\w+) and Ms (\w+), Herr (\w+)\. (DE\d\d \d{4} \d{4} \d{4} \d{4} \d\d) ssn (\d{3}-\d\d-\d{4}) (\(\d{3}\) \d{3}-\d{4})"
    )
    found = re.fullmatch(pattern, text).groups()
    assert found[0].upper() == found[1]  # one address in two cases
    assert surrogates.luhn(found[3].replace(" ", "")) == 0
    assert found[7] in surrogates.GIVEN["latin", "m"] or found[7].endswith("us")
    assert found[8].upper() == found[9]  # one family
    iban = found[11].replace(" ", "")
    assert int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1
    assert found[4] in out[1]["text"] and found[8] in out[1]["text"]  # the same across texts
    assert (out[2]["text"], out[2]["n_replaced"]) == ("no data here", 0)
    assert (out[3]["text"], out[3]["n_replaced"], out[4]["text"]) == (None, 0, "")
    assert out[5]["text"] == text and out[0]["n_replaced"] == len(surrogates.mentions(PRIVATE))


def test_surrogates_are_distinct_though_lists_are_short(spark):
    names = [f"{a}{b}" for a in ("Bar", "Cor", "Del", "Fen", "Gam") for b in ("do", "lin", "mar", "net", "pol", "rik", "sun", "tov")]
    names += list(surrogates.FAMILY["latin"])  # surrogates that are entities of the corpus
    entities = spark.createDataFrame(
        [("family-latin", n.casefold()) for n in names] + [("phone", f"155501{i:03d}") for i in range(50)]
        + [("ip", f"10.0.0.{i}") for i in range(50)],
        "kind string, value string",
    )
    rows = surrogates.assign_surrogates(entities, KEY).collect()
    assert len(rows) == entities.count()
    assert len({(r["kind"], r["surrogate"]) for r in rows}) == len(rows)
    real = {(r["kind"], r["value"]) for r in rows}
    assert not any((r["kind"], r["surrogate"]) in real for r in rows)
    again = surrogates.assign_surrogates(entities.repartition(3), KEY).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))
    other = surrogates.assign_surrogates(entities, b"other").collect()
    assert sorted(map(tuple, rows)) != sorted(map(tuple, other))


@pytest.mark.parametrize("script, mention", [("cyrillic", "г-н Иван Петров"), ("greek", "Κύριος Νίκος Μελάς"), ("latin", "Mme Claire Petit")])
def test_names_keep_script_and_gender(spark, script, mention):
    new = surrogates.with_surrogates(with_ids(spark, [f"x {mention} y"]), KEY).first()["text"]
    given, family = new.split()[2:4]
    gender = "f" if script == "latin" else "m"
    assert given in surrogates.GIVEN[script, gender] or surrogates.script_of(given) == script
    assert surrogates.script_of(family) == script and family not in mention


def test_surrogates_of_a_whole_table_leave_no_entity(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    out = surrogates.with_surrogates(docs, KEY)
    assert out.columns == [*docs.columns, "n_replaced"]
    changed = 0
    for row in out.collect():
        old = before[row["doc_id"]]
        found = surrogates.mentions(old)
        assert row["n_replaced"] == len(found) and row["n_chars"] == len(row["text"])
        assert (row["text"] == old) == (not found)
        assert not any(old[s:e] in row["text"] for s, e, _, _ in found)
        changed += bool(found)
    assert changed > 20


def test_surrogates_of_odd_tables(spark):
    docs = spark.createDataFrame([(None, "a@b.example.org", 1), (None, None, 2)], "doc_id long, text string, `row.x` int")
    out = surrogates.with_surrogates(docs, KEY)
    assert out.columns == ["doc_id", "text", "row.x", "n_replaced"]
    assert sorted(r[2] for r in out.collect()) == [1, 2]
    assert surrogates.with_surrogates(docs.limit(0), KEY).collect() == []


FOLLOWING = [
    ("Mr Smith and Mrs Jones", ["Smith", "Jones"]),
    ("Mr. Smith met Dr. Jones", ["Smith", "Jones"]),
    ("Mr Smith Mrs Jones", ["Smith", "Jones"]),
    ("Prof. Dr. Braun and Herr Dr Lang", ["Braun", "Lang"]),
    ("Mr Smith at john@x.com", ["Smith", "john@x.com"]),
    ("Mr Smith john@x.com", ["Smith", "john@x.com"]),
    ("Mr John@x.com", ["John@x.com"]),
    ("Dr Lee or bob.w@x.org", ["Lee", "bob.w@x.org"]),
    ("Dr Lee to O'bob@x.org", ["Lee", "bob@x.org"]),
    ("Ms Petit Password: correcthorse", ["Petit", "correcthorse"]),
    ("Frau Braun DE89 3704 0044 0532 0130 00", ["Braun", "DE89 3704 0044 0532 0130 00"]),
    ("Mr John Henry Smith of Mr lower", ["John", "Henry", "Smith"]),
    ("г-н Петров и г-жа Орлова", ["Петров", "Орлова"]),
]


def test_mentions_that_follow_each_other(spark):
    for text, entities in FOLLOWING:
        assert [text[start:end] for start, end, _, _ in surrogates.mentions(text)] == entities
    for row in surrogates.with_surrogates(with_ids(spark, [t for t, _ in FOLLOWING]), KEY).collect():
        entities = FOLLOWING[row["doc_id"]][1]
        assert row["n_replaced"] == len(entities) and not any(e in row["text"] for e in entities)


# what is personal in a text, told by hand, and what must stay
PERSONS = [
    ("Mr John Smith came. John Smith left. Smith slept.", ["John", "Smith"], ["Mr", "came", "left", "slept"]),
    ("Dr Wendy Lang and Mrs Wendy Lang", ["Wendy", "Lang"], ["Dr", "and Mrs"]),
    ("Mr J. Smith wrote; J. Smith signed.", ["Smith", "J."], ["wrote", "signed"]),
    ("Mr. John Q. Public paid", ["John", "Public", "Q."], ["paid"]),
    ("Mr Smith's car is Smith’s", ["Smith"], ["'s car is", "’s"]),
    ("MR SMITH AND DR LEE", ["SMITH", "LEE"], ["MR", "AND DR"]),
    ("Mr.  Smith", ["Smith"], ["Mr.  "]),
    ("Mr.\nSmith", ["Smith"], ["Mr.\n"]),
    ("Dr.\u00a0Lee", ["Lee"], ["Dr.\u00a0"]),
    ("Mr van Dyke and Prof. de Vries", ["Dyke", "Vries"], ["Mr van", "Prof. de"]),
    ("Frau Anna von der Leyen sprach; Leyen ging.", ["Anna", "Leyen"], ["von der", "sprach", "ging"]),
    ("Mr O'Shea-Jones told Mr Lee-Smith", ["O'Shea", "Lee-Smith"], ["told"]),
    ("г-н Петров ушёл. Петров пришёл.", ["Петров"], ["ушёл", "пришёл"]),
    ("Mr Stone saw a stone and 3 Stone2 and no Stones", ["Mr Stone saw"], ["a stone and 3 Stone2 and no Stones"]),
]


def test_persons_leave_no_name(spark):
    out = {r["doc_id"]: r["text"] for r in surrogates.with_surrogates(with_ids(spark, [t for t, _, _ in PERSONS]), KEY).collect()}
    for at, (text, gone, kept) in enumerate(PERSONS):
        assert not any(name in out[at] for name in gone), (text, out[at])
        assert all(part in out[at] for part in kept), (text, out[at])
    came, left, slept = re.fullmatch(r"Mr (\w+ \w+) came\. (\w+ \w+) left\. (\w+) slept\.", out[0]).groups()
    assert came == left and came.endswith(f" {slept}")
    doctor, lady = re.fullmatch(r"Dr (\w+ \w+) and Mrs (\w+ \w+)", out[1]).groups()
    assert doctor == lady and surrogates._genders().get(doctor.split()[0].casefold(), "f") == "f"
    first, second = re.fullmatch(r"Mr ([A-Z]\. \w+) wrote; ([A-Z]\. \w+) signed\.", out[2]).groups()
    assert first == second


def test_an_initial_follows_its_given_name(spark):
    text = "Mrs Clara Weiss spoke. C. Weiss sat down. B. Weiss did not."
    new = surrogates.with_surrogates(with_ids(spark, [text]), KEY).first()["text"]
    given, initial, other = re.fullmatch(r"Mrs (\w+) \w+ spoke\. (\w)\. \w+ sat down\. (\w)\. \w+ did not\.", new).groups()
    assert given[0] == initial and other != "B"


def test_numbers_keep_country_and_books(spark):
    texts = ["+49 30 1234567", "+353 1 234 5678", "+1 244 555 4688", "+7 495 123 45 67", "ISBN 978-3-16-148410-0 stays", "978-3-16-148410-1"]
    out = {r["doc_id"]: r["text"] for r in surrogates.with_surrogates(with_ids(spark, texts), KEY).collect()}
    for at, code in enumerate(("+49 ", "+353 ", "+1 ", "+7 ")):
        assert out[at].startswith(code) and out[at] != texts[at]
        assert re.sub(r"\d", "0", out[at]) == re.sub(r"\d", "0", texts[at])
    assert out[4] == texts[4] and out[5] != texts[5]


def test_full_number_spaces_come_to_an_end(spark):
    phones = spark.range(10**5).selectExpr("'phone' as kind", "format_string('55%05d', id) as value")
    entities = phones.unionByName(spark.createDataFrame([("phone", "5612345"), ("ip", "1.2.3.4")], "kind string, value string"))
    # all numbers that begin with 5 and have seven digits
    entities = entities.unionByName(spark.range(9 * 10**5).selectExpr("'phone'", "format_string('5%06d', if(id < 500000, id, id + 100000))").toDF("kind", "value"))
    entities = entities.distinct()
    done = staged(surrogates.assign_surrogates(entities, KEY), "test-surrogates")
    assert done.count() == entities.count() > 10**6
    assert done.select("kind", "surrogate").distinct().count() == done.count()
    assert done.join(entities.withColumnRenamed("value", "surrogate"), ["kind", "surrogate"]).count() == 0


def test_a_task_holds_few_texts_at_a_time(spark, monkeypatch):
    docs, runs = with_ids(spark, [PRIVATE]), []
    whole = type(docs).mapInArrow
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, run, *a, **b: runs.append(run) or whole(self, run, *a, **b))
    surrogates.with_surrogates(docs, KEY)
    find, rewrite = runs[0], runs[-1]
    monkeypatch.setattr(surrogates, "BATCH_BYTES", 1 << 18, raising=False)
    texts = ["plain words " * 400 + "a@b.example.org"] * 500 + ["plain words " * 20_000 + "a@b.example.org"] * 3
    mapping = [[{"kind": "email", "value": "a@b.example.org", "surrogate": "c@d.example"}]] * len(texts)
    rows = [{"doc_id": i} for i in range(len(texts))]
    for run, columns in ((find, {"text_key": list(map(str, range(len(texts))))}), (rewrite, {"row": rows, "mapping": mapping})):
        batch = pa.RecordBatch.from_pydict({**columns, "text": texts})
        tracemalloc.start()
        outs = [(out.num_rows, out.nbytes) for out in run(iter([batch]))]
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert sum(n for n, _ in outs) == len(texts) and max(size for _, size in outs) < 1 << 20
        assert most < 2 << 20  # of 3 MB of text, which would be held more than once


def test_endless_draws_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(surrogates, "ATTEMPTS", 2)
    monkeypatch.setattr(surrogates, "surrogate", lambda kind, value, key, attempt: value)
    with pytest.raises(RuntimeError, match="without a surrogate"):
        surrogates.assign_surrogates(spark.createDataFrame([("key", "a")], "kind string, value string"), KEY).collect()


@pytest.mark.parametrize(
    "text",
    ["a" * 10**6, "0123456789abcdef" * 62_500, "a.b-" * 250_000, "@" * 10**6, "Mr " * 300_000, "Mr A. " * 160_000, "Mr Smith " * 110_000,
     "token=" * 160_000, "+1 " * 300_000, "Mr. " + "Ab-" * 300_000, "1 " * 500_000, "AB12 " * 200_000, "漢字" * 500_000],
)
def test_a_megabyte_of_anything_takes_seconds(text):
    started = time.perf_counter()
    surrogates.mentions(text)
    assert time.perf_counter() - started < 20


# least texts of every kind; digits outside ASCII are digits, too
LEAST = {
    "email": ["a@b.cd"],
    "secret": ["password: correcthorse", "API-Key=abcdef", "my paſſwd = abcdef", "my to\u212aen = abcdef", "'token': \"abcdef\""],
    "iban": ["DE89 3704 0044", "DE٨٩ABCDABCD"],
    "ip": ["1.2.3.4"],
    "ssn": ["123-45-6789", "١٢٣-٤٥-٦٧٨٩"],
    "plus_phone": ["+1 234 567", "+٤٤ ٢٠٧٩ ٤٦٠٠"],
    "card": ["4111 1111 1111 1", "٤١١١١١١١١١١١١"],
    "phone": ["(555) 123-4567"],
    "key": ["0" * 32, "abcdef" * 6, "ABCDEF" * 6],
    "name": [f"{title} Zorn" for title in surrogates.TITLES] + [f"({title}. Zorn" for title in surrogates.TITLES],
}


def test_candidates_hold_every_kind(spark):
    assert LEAST.keys() == surrogates.KINDS.keys()
    texts = [t for own in LEAST.values() for t in own]
    assert [surrogates.PATTERN.search(t).lastgroup for t in texts] == [kind for kind, own in LEAST.items() for _ in own]
    rows = with_ids(spark, texts).withColumn("candidate", surrogates.candidate(F.col("text"))).collect()
    assert [r["text"] for r in rows if not r["candidate"]] == []
    docs = with_ids(spark, ["password: correcthorse", "+٤٤ ٢٠٧٩ ٤٦٠٠", "abcdef" * 6, "the word password alone"])
    found = {r["doc_id"]: (r["n_replaced"], r["text"]) for r in surrogates.with_surrogates(docs, KEY).collect()}
    assert [found[i][0] for i in range(4)] == [1, 1, 1, 0]
    assert "correcthorse" not in found[0][1] and found[3][1] == "the word password alone"


# --- licenses -------------------------------------------------------------------------


def brute_base(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    found = []
    for phrase, label in licenses.BASE.items():
        own = phrase.split()
        found += [(i, label) for i in range(len(words) - len(own) + 1) if words[i : i + len(own)] == own]
    places = sorted(i for i, _ in found)
    labels = ",".join(sorted({label for _, label in found}))
    return len(words), len(places), places[0] if places else None, places[-1] if places else None, labels


LICENSE_TEXTS = [
    None, "", "MIT", "mit license mit  License", "GNU-General\nPUBLIC license, Apache.License; cc/by cc by", "ücc by", "cc byé",
    "gnu general public licenses", "x " * 5000 + "the MIT License.", "İ mit license", "cc0 cc by cc0",
]


def test_base_phrases_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame([(-i, t) for i, t in enumerate(LICENSE_TEXTS, 1)], "doc_id long, text string")
    texts = {r["doc_id"]: r["text"] for r in docs.unionByName(odd).collect()}
    for row in licenses.scan(docs.unionByName(odd)).collect():
        assert tuple(row)[1:6] == brute_base(texts[row["doc_id"]]), row
        assert set(filter(None, row["base_labels"].split(","))) <= set(row["labels"].split(","))
        assert 0 <= row["score"] <= 1 and (row["score"] > 0) == bool(row["labels"])
    assert licenses.scan(docs.limit(0)).collect() == []


@pytest.mark.parametrize(
    "text, expected",
    [
        ("licensed under the GNU General Public License, version 3.", [("gpl-3.0", "grant")]),
        ("Licensed under CC BY-NC 4.0.", [("cc-by-nc", "grant")]),
        ("SPDX-License-Identifier: (BSD-3-Clause)", [("bsd-3-clause", "spdx")]),
        ("see https://www.apache.org/licenses/LICENSE-2.0 for", [("apache-2.0", "url")]),
        ("under the GNU Lesser General Public License, all rights reserved", [("lgpl-3.0", "name"), ("all-rights-reserved", "name")]),
        ("a permit licenses nothing", []),
    ],
)
def test_rules_suppress_contained_detections(text, expected):
    assert [(r.label, r.form) for _, _, r in licenses.detections(text.lower())] == expected


def test_every_rule_is_reached_through_its_keyword():
    assert len(licenses.rules()) > 300
    for label, (names, _, _) in licenses.FAMILIES.items():
        for name in names:
            plain = re.sub(r"\(\?:[^()]*\)\?", "", name)  # optional groups left out
            plain = re.sub(r"\(\?:([^()|]*)\|[^()]*\)", r"\1", plain)
            plain = re.sub(r"\\w\*", "", re.sub(r" ?\?|\\d", "", re.sub(r"\[(.)[^\]]*\]", r"\1", plain)))
            plain = re.sub(r"\(\?:([^()]*)\)", r"\1", plain)
            found = {licenses.rules()[n].label for n in licenses.active_rules(f"is {plain} .")}
            assert label in found, (label, plain)


# --- toxicity -------------------------------------------------------------------------


def costs_of(words):
    counts = np.full(toxicity.SYMBOLS**3, 0.01).reshape((toxicity.SYMBOLS,) * 3)
    for word in words:
        codes = [0, 0, *(ord(c) - 96 for c in word), 0]
        for x, y, z in zip(codes, codes[1:], codes[2:]):
            counts[x, y, z] += 1
    return -np.log(counts / counts.sum(axis=2, keepdims=True))


@pytest.mark.parametrize(
    "disguised, plain",
    [
        ("you 1d10t!", "you idiot!"), ("i d i o t", "idiot"), ("stuuuupid", "stupid"), ("$tup1d", "stupid"),
        ("i.d.i.o.t here", "idiot here"), ("an idiot", "an idiot"), ("in 2024 it was 15", "in 2024 it was 15"), ("l0ser", "loser"),
        ("good$$$ work!!", "good$$$ work!!"),
    ],
)
def test_disguises_are_read(disguised, plain):
    costs = costs_of(["idiot", "stupid", "loser", "an", "you", "here", "good", "work"] * 20)
    assert toxicity.restored(disguised, costs) == plain


@pytest.mark.parametrize(
    "disguised, plain",
    [
        ("y o u a r e a w o r t h l e s s i d i o t", "you are a worthless idiot"), ("stup" + "i" * 40 + "d", "stupid"),
        ("t4773r5", "tatters"), ("1 d 1 0 t", "idiot"), ("m.0.r.0.n", "moron"), ("s-t-u-p-1-d", "stupid"), ("an idio7 here", "an idiot here"),
        ("you are a m o r o n", "you are a moron"), ("s t u u u p i d", "stupid"), ("stupid! 1d10t!", "stupid! idiot!"),
        ("1 2 3 4 5", "1 2 3 4 5"), ("2024-01-05 1.2.3.4", "2024-01-05 1.2.3.4"), ("i d i o t 1 5", "idiot 1 5"), ("$tup1d!", "stupid!"), ("m0r0n5", "morons"),
        ("i-d-i-o-t " * 3 + "s t u p i d", "idiot idiot idiot stupid"),
    ],
)
def test_whole_disguises_are_read(disguised, plain):
    words = "idiot stupid moron morons tatters you are a an here worthless work good".split()
    assert toxicity.restored(disguised, costs_of_text(" ".join(words * 20) + " 2024 15")) == plain


def costs_of_text(text):
    counts = np.full(toxicity.SYMBOLS**3, 0.01).reshape((toxicity.SYMBOLS,) * 3)
    codes = [0, *(ord(c) - 96 if c.isalpha() else 0 for c in text), 0]
    for x, y, z in zip(codes, codes[1:], codes[2:]):
        counts[x, y, z] += 1
    return -np.log(counts / counts.sum(axis=2, keepdims=True))


def test_long_spans_take_linear_time():
    costs = costs_of_text("you are an idiot " * 20)
    assert toxicity.restored("i d i o t " * 2000, costs) == "idiot " * 2000


def brute_word(span, costs):
    """Cheapest reading by enumerating every reading of a span without repeated signs."""
    best = {0: [("", 0.0)]}
    readings = [("", 0.0)]
    for sign in span.lower():
        options = [(c, toxicity.SIGN_COST) for c in toxicity.SIGNS[sign]] if sign in toxicity.SIGNS else [(sign, 0.0)]
        readings = [(text + c, cost + extra) for text, cost in readings for c, extra in options]
    del best

    def total(text, cost):
        codes = [0, 0, *(ord(c) - 96 if "a" <= c <= "z" else 27 for c in text), 0]
        return cost + sum(costs[x, y, z] for x, y, z in zip(codes, codes[1:], codes[2:]))

    return min(readings, key=lambda r: total(*r))[0]


def test_viterbi_equals_enumeration():
    rng = random.Random(3)
    costs = costs_of(["".join(rng.choices("abdegilost", k=rng.randint(3, 7))) for _ in range(300)])
    for _ in range(200):
        span = "".join(rng.choices("abdegilost0135678@$!", k=rng.randint(2, 7)))
        if re.search(r"(.)\1", span):
            continue
        assert toxicity.restore_word(span, costs) == brute_word(span, costs)


def test_held_out_texts_are_told_apart(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    marked = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    found = toxicity.scored(docs, labels).collect()
    assert len(found) == docs.count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in found)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in found)
    held = [(marked[r["doc_id"]], r["predicted"]) for r in found if r["held_out"] and r["doc_id"] in marked]
    hits = sum(a and b for a, b in held)
    assert hits >= 0.85 * sum(a for a, _ in held) and hits >= 0.95 * sum(b for _, b in held)


def test_scores_without_labels_and_of_odd_rows(spark):
    docs = spark.createDataFrame([(None, "x"), (1, None), (2, ""), (2, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(None, 1), (7, None)], "doc_id long, toxic int")
    assert [(r["score"] < 0.01, r["predicted"]) for r in toxicity.scored(docs, labels).collect()] == [(True, 0)] * 4
    assert toxicity.scored(docs.limit(0), labels.limit(0)).collect() == []


def test_character_counts_cover_every_text(spark):
    docs = spark.createDataFrame([("ab",), (None,), ("Ab é",)], "text string")
    counts = {r["trigram"]: r["count"] for r in toxicity.character_counts(docs).collect()}
    n = toxicity.SYMBOLS
    assert counts[(0 * n + 1) * n + 2] == 2  # both texts begin with ab
    assert docs.agg(F.count("text")).first()[0] == 2


def plain_suppression(found):
    """The rule as it reads: by priority, then length, against all that were kept so far."""
    kept = []
    for start, end, rule in sorted(found, key=lambda d: (-d[2].priority, d[0] - d[1], d[0], d[2].label)):
        inside = any(s <= start and end <= e for s, e, _ in kept)
        crossed = any(s < end and start < e and r.priority > rule.priority for s, e, r in kept)
        if not inside and not crossed:
            kept.append((start, end, rule))
    return sorted(kept, key=lambda d: d[:2])


def test_suppression_equals_the_plain_rule():
    words = ["mit license", "gnu general public license", "version 2", "apache license", "v3", "or later", "gpl-2.0", "apache.org/licenses/license-2",
             "spdx-license-identifier:", "bsd", "3-clause license", "licensed under the", "gnu lesser general public license", ","]
    random.seed(9)
    for _ in range(150):
        text = " ".join(random.choices(words, k=random.randint(1, 40)))
        found = [
            (m.start(), m.end(), licenses.rules()[n]) for n in sorted(licenses.active_rules(text)) for m in licenses.rules()[n].pattern.finditer(text)
        ]
        ours, plain = licenses.detections(text), plain_suppression(found)
        assert [(s, e, r.label) for s, e, r in ours] == [(s, e, r.label) for s, e, r in plain]


@pytest.mark.parametrize("text", ["яmit license", "mit licenseя", "mit license漢", "émit license", "mit license\u0130", "xmit license"])
def test_letters_of_any_script_are_letters(spark, text):
    row = licenses.scan(with_ids(spark, [text])).first()
    assert (row["labels"], row["base_labels"], row["n_base"]) == ("", "", 0)


@pytest.mark.parametrize("text", ["mit license " * 80_000, "gnu general public license version 2 " * 27_000, "gpl-2.0 " * 120_000, "apache " * 140_000])
def test_a_megabyte_of_licenses_takes_seconds(text):
    started = time.perf_counter()
    licenses.detections(text)
    assert time.perf_counter() - started < 30


@pytest.mark.parametrize(
    "text", ["!" * 10**6, "@$" * 500_000, "0!" * 500_000, "0" * 10**6, "ab" * 500_000, "a b " * 250_000, "0! " * 330_000, "a" * 10**6, "0!" * 500_000 + "moron"]
)
def test_a_megabyte_of_signs_takes_seconds(text):
    costs = np.ones((toxicity.SYMBOLS,) * 3)
    started = time.perf_counter()
    toxicity.restored(text, costs)
    assert time.perf_counter() - started < 60


def test_long_runs_of_signs_keep_what_follows():
    costs = np.ones((toxicity.SYMBOLS,) * 3)
    run = "0!" * 60
    assert toxicity.SUSPECT.findall("x " + run + " i d i o t")
    assert [m.group() for m in toxicity.SUSPECT.finditer(f"{run}idiot m0ron")] == [f"{run}idiot", "m0ron"]
    assert toxicity.restored(f"{run} m0ron", costs).startswith(run)
    spaced = [m.group() for m in toxicity.SUSPECT.finditer(f"1{'!' * 60} m 0 r 0 n")]
    assert spaced[-1].endswith("m 0 r 0 n")
