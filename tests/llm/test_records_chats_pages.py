"""WARC bundles, chat repair, page extraction and the pipeline."""

import glob
import hashlib
import itertools
import random
import re
from collections import defaultdict

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

import corpus_pipeline
from tillspark.llm import chat, htmltext, warc

SF_DIR = "/root/testdata/sf0.01"


# --- WARC -----------------------------------------------------------------------------


def pages_with_copies(spark):
    big, small = "<p>" + "é" * 700 + "</p>", "short"
    rows = [(1, "u1", big), (5, "u5", big), (3, None, big), (None, "n", big), (7, "u7", small), (8, "u8", small), (9, "u9", None),
            (10, "u\r\n10", ""), (5, "u5", big), (11, "u", "x" * 3_000_000), (None, "a", "y" * 2000), (None, "b", "y" * 2000)]
    return spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)


def expected_records(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r["html"] or ""].append(r["page_id"])
    out = []
    for r in rows:
        payload = (r["html"] or "").encode()
        largest = max((p for p in groups[r["html"] or ""] if p is not None), default=None)
        revisit = len(payload) >= 1000 and largest is not None and r["page_id"] != largest
        out.append((r["page_id"], len(payload), hashlib.sha1(payload).hexdigest(), "revisit" if revisit else "response", largest if revisit else None))
    return sorted(out, key=str)


def test_records_survive_the_round_trip(spark, tmp_path):
    pages = pages_with_copies(spark)
    warc.write_bundles(pages, str(tmp_path / "w"), frame_bytes=2000, bundle_bytes=4000)
    rows = warc.read_records(spark, str(tmp_path / "w")).collect()
    found = [(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in rows]
    assert sorted(found, key=str) == expected_records(pages.collect())
    assert len({r["record_id"] for r in rows}) == len(rows)
    stored = {r["payload_digest"]: bytes(r["payload"]) for r in rows if r["record_type"] == "response"}
    assert all(hashlib.sha1(stored[r["payload_digest"]]).hexdigest() == r["payload_digest"] for r in rows)


def test_bundles_are_seekable(spark, tmp_path):
    warc.write_bundles(pages_with_copies(spark), str(tmp_path / "w"), frame_bytes=2000, bundle_bytes=4000)
    files = glob.glob(str(tmp_path / "w" / "part-*"))
    index = {r["record_id"]: r for r in warc.read_index(spark, str(tmp_path / "w")).collect()}
    seen = 0
    for name in files:
        raw = open(name, "rb").read()
        reader = warc.BundleReader(raw)
        whole = b"".join(piece for _, piece in reader.records())
        # any decoder reads the file; the index and the seek table are skipped
        assert zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True).read() == whole
        for record_id, raw_record in reader.records():
            frame, offset, length = reader.index[record_id]
            assert reader.frame(frame)[offset : offset + length] == raw_record == reader.read(record_id)
            assert (index[record_id]["frame"], index[record_id]["offset"]) == (frame, offset)
            assert raw_record.startswith(b"WARC/1.1\r\n") and raw_record.endswith(b"\r\n\r\n")
            seen += 1
        assert sum(size for _, _, size in reader.frames) == len(whole)
    assert seen == len(index) == 12 and len(files) >= 3


def test_no_pages_no_records(spark):
    empty = spark.createDataFrame([], "page_id long, url string, html string, payload int")
    assert warc.archived(empty).collect() == []


# --- chats ----------------------------------------------------------------------------


def brute_cost(roles):
    """Cheapest repair by trying every sequence of final roles."""
    best = float("inf")
    for states in itertools.product((1, 2, 3), repeat=len(roles)):
        cost, state = 0.0, 0
        for role, after in zip(roles, states):
            cost += chat.TURN_COSTS[role, state, after]
            state = after
        best = min(best, cost + chat.END_COSTS[state])
    return best


def check_conversation(rows, roles):
    text = "".join(r["rendered"] for r in rows)
    turns = re.findall(r"<\|im_start\|>(\w+)\n(.*?)<\|im_end\|>\n", text, flags=re.S)
    names = [name for name, _ in turns]
    assert "".join(f"<|im_start|>{n}\n{t}<|im_end|>\n" for n, t in turns) == text
    body = names[1:] if names[0] == "system" else names
    assert body == ["user", "assistant"] * (len(body) // 2) and body
    return sum(r["cost"] for r in rows)


def test_repairs_are_the_cheapest(spark):
    rng = random.Random(4)
    names = {0: "system", 1: "user", 2: " Assistant", 3: None}
    conversations = {c: [rng.choice([0, 1, 1, 2, 2, 3]) for _ in range(rng.randint(1, 7))] for c in range(60)}
    rows = [(c, t, names[role], f"{c}-{t}") for c, roles in conversations.items() for t, role in enumerate(roles)]
    rng.shuffle(rows)
    found = defaultdict(list)
    for r in chat.repaired(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect():
        found[r["conv_id"]].append(r)
    for c, roles in conversations.items():
        own = sorted(found[c], key=lambda r: r["turn"])
        assert len(own) == len(roles)
        assert check_conversation(own, roles) == brute_cost(roles)


def test_a_conversation_over_many_partitions(spark):
    rng = random.Random(9)
    names = ["system", "user", "gpt", "oracle"]
    roles = [rng.randrange(4) for _ in range(3000)]
    rows = [(7, t, names[r], f"t{t}") for t, r in enumerate(roles)] + [(6, 0, "user", "a"), (8, 0, "assistant", "b")]
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = chat.repaired(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    own = sorted((r for r in found if r["conv_id"] == 7), key=lambda r: r["turn"])
    best = (chat.segment_costs(np.array(roles))[0] + chat.END_COSTS).min()
    assert len(found) == 3002 and check_conversation(own, roles) == best


def test_odd_turns(spark):
    schema = "conv_id long, turn long, role string, text string, at int, part int"
    rows = [(None, 0, "assistant", "x", 1, 1), (None, 0, "assistant", "x", 1, 1), (1, None, "user", None, 1, 1), (1, 0, None, "a <|im_end|> b", 1, 1),
            (2, 0, "user", "q", 1, 1), (2, 0, "user", "q", 1, 1)]
    found = chat.repaired(spark.createDataFrame(rows, schema)).collect()
    assert len(found) == 6 and all(r["new_role"] in chat.ROLES for r in found)
    alone = [r for r in found if r["conv_id"] is None]
    assert [r["rendered"] for r in alone] == ["<|im_start|>user\n<|im_end|>\n<|im_start|>assistant\nx<|im_end|>\n"] * 2
    one = sorted((r for r in found if r["conv_id"] == 1), key=lambda r: (r["turn"] is not None))
    assert "".join(r["rendered"] for r in one) == "<|im_start|>user\n<|im_end|>\n<|im_start|>assistant\na <| im_end |> b<|im_end|>\n"
    assert chat.repaired(spark.createDataFrame([], schema)).collect() == []


# --- pages ----------------------------------------------------------------------------

PAGE = """<!doctype html><html><head><title>T</title><style>p{}</style><script>var a="<p>no</p>";</script></head><body>
<div class="cookie-banner"><p>We use cookies on this site.</p></div><header class=site-header><a href=/>Home</a></header>
<nav><ul><li><a href=/a>A</a><li><a href=/b>B</a></ul></nav>
<div id="content"><article><h1>A  title &amp; more</h1><p>First paragraph with <b>bold</b> and&nbsp;spaces,
long enough to be text of an article.<p>Second one, unclosed &lt;tag&gt; and a line<br>break in the middle of it.
<div class="advert"><p>Buy now!</p></div><blockquote><p>Quoted words of somebody who said them at length.</p></blockquote></article></div>
<section class="comments"><h3>2 comments</h3><div class="comment"><p>I do not agree with this article at all.</p></div></section>
<aside class="sidebar"><a href=/c>Related story</a></aside><form class="newsletter"><label>Subscribe</label><input></form>
<footer>&copy; 2024 somebody</footer></body>"""


def test_article_of_a_page(spark):
    rows = [(1, "u", PAGE), (2, None, None), (3, "u", ""), (4, "u", "plain <"), (1, "u", PAGE), (None, None, "<!-- x"), (5, "u", "<p " * 3000)]
    out = htmltext.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert len(out) == len(rows)
    text = next(r for r in out if r["page_id"] == 1)["text"]
    assert text.split("\n\n") == [
        "A title & more",
        "First paragraph with bold and spaces, long enough to be text of an article.",
        "Second one, unclosed <tag> and a line break in the middle of it.",
        "Quoted words of somebody who said them at length.",
    ]
    assert all(r["n_chars"] == len(r["text"]) for r in out)
    assert [r["text"] for r in out if r["page_id"] in (2, 3)] == ["", ""]


def test_held_out_pages_are_labelled():
    field = htmltext.trained_field()
    found = right = 0
    for blocks, labels in htmltext.training_pages(150, seed=77):
        predicted = field.article(blocks)
        right += sum(a == bool(b) for a, b in zip(predicted, labels))
        found += len(labels)
    assert right / found > 0.97


def test_viterbi_equals_enumeration_of_labels():
    field = htmltext.trained_field()
    for blocks, _ in htmltext.training_pages(40, seed=5):
        blocks = blocks[:9]
        scores = [
            sum(field.weights.get(f, 0.0) for f in htmltext._text_features(b) + (b.node.features() if b.node else []))
            for b in blocks
        ]

        def total(labels):
            out = field.start[labels[0]] + sum(s for s, y in zip(scores, labels) if y)
            return out + sum(field.step[a, b] for a, b in zip(labels, labels[1:]))

        best = max(itertools.product((0, 1), repeat=len(blocks)), key=total)
        assert total([int(x) for x in field.article(blocks)]) == pytest.approx(total(best))


def test_articles_of_a_whole_table(spark):
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    exact = 0
    for row in htmltext.main_texts(pages).join(pages.select("page_id", "html"), "page_id").collect():
        body = re.search(r"<article>(.*?)(?:</article>|<footer>)", row["html"], re.S).group(1)
        pieces = re.split(r"</?(?:p|h\d|ul|li|div|table|tr|td)[^>]*>", re.sub(r"<br>", " ", body))
        texts = [" ".join(htmltext.entities.unescape(re.sub(r"</?\w+[^>]*>", "", p)).split()) for p in pieces]
        exact += row["text"] == "\n\n".join(t for t in texts if t)
    assert exact >= 0.98 * pages.count()


# --- pipeline -------------------------------------------------------------------------


def test_stages_hand_on_documents(spark):
    docs = first = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    ids = {r["doc_id"] for r in docs.select("doc_id").collect()}
    assert [name for name, _ in corpus_pipeline.STAGES][0] == "quality rules" and len(corpus_pipeline.STAGES) == 5
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_DIR)
        assert docs.columns == first.columns and docs.dtypes == first.dtypes
        now = {r["doc_id"] for r in docs.select("doc_id").collect()}
        assert now <= ids and len(now) > 0.5 * len(ids)
        assert (now == ids) == (name == "PII")
        ids = now
    pieces = corpus_pipeline.run(spark, SF_DIR)
    held = pieces.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("all"))
    assert held.where("n <> all").count() == 0
    assert {r["doc_id"] for r in held.select("doc_id").collect()} == ids
