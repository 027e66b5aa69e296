"""Main texts of hand-written layouts, none of them written by the generator of training pages."""

import time

import pytest

from tillspark.llm import htmltext

A = "The committee met on Tuesday and agreed to publish the report in full."
B = "Nobody expected the vote to be this close, said one of its members!"
C = "The next meeting takes place in spring, after the budget has been settled."
HEAD = "<!DOCTYPE html><html><head><meta charset=utf-8><title>The report - Daily</title></head>"

# page and the blocks of its article
LAYOUTS = {
    "menu and footer": (f"<body><nav><a href=/>Home</a></nav><article><p>{A}</p><p>{B}</p></article><footer>(c)</footer>", [A, B]),
    "linked list": (f"{HEAD}<body><article><p>{A}</p><ul><li><a href=1>First part</a><li><a href=2>Second part</a></ul><p>{B}</p></article></body>",
                    [A, "First part", "Second part", B]),
    "title and one paragraph": (f"<title>Report</title><article><p>{A}</p></article>", [A]),
    "title and plain paragraphs": (f"<title>Report</title><p>{A}</p><p>{B}</p>", [A, B]),
    "title and plain divs": (f"<title>Report</title><div>{A}</div><div>{B}</div>", [A, B]),
    "three paragraphs": (f"<article><p>{A}</p><p>{B}</p><p>{C}</p></article>", [A, B, C]),
    "no script": (f"<article><h1>The report</h1><p>{A}</p><noscript>Please enable JavaScript</noscript></article>", ["The report", A]),
    "drawing": (f"<article><svg><title>icon</title><text>..</text></svg><p>{A}</p></article>", [A]),
    "no markup": (A, [A]),
    "one open paragraph": (f"<p>{A}", [A]),
    "main": (f"<main><h1>The report</h1><p>{A}</p></main>", ["The report", A]),
    "cookie banner": (f"<body><div class=cookie-banner>We use cookies to improve your experience.</div><main><p>{A}</p></main>"
                      "<footer><p>Copyright 2020 by Us.</p></footer>", [A]),
    "sidebar": (f"<body><header><a href=/>Site</a></header><div id=content><p>{A}</p><p>{B}</p></div>"
                "<aside><h3>Related</h3><ul><li><a href=1>One</a></li></ul></aside>", [A, B]),
    "reader comments": (f"<body><article><p>{A}</p><p>{B}</p></article><section id=comments><h3>Comments</h3>"
                        f"<div class=comment><p>{C}</p></div></section>", [A, B]),
    "advert inside": (f"<article><p>{A}</p><div class=ad>Buy one now and get one free today.</div><p>{B}</p></article>", [A, B]),
    "table page": (f"<html><body><table><tr><td>{A}</td></tr></table></body></html>", [A]),
    "login form": (f"{HEAD}<body><form action=/login><label>Name</label><input><button>Log in</button></form>"
                   f"<article><h2>The report</h2><p>{A}</p><p>{B}</p></article></body>", ["The report", A, B]),
    "select": (f"<body><select><option>English<option>Deutsch</select><article><p>{A}</p><p>{B}</p></article>", [A, B]),
    "template and textarea": (f"<article><template><p>{C}</p></template><p>{A}</p><textarea>Your text</textarea></article>", [A]),
    "newsletter": (f"{HEAD}<body><div class=wrapper><div class=entry-content><p>{A}</p><div class=newsletter><p>Subscribe to our "
                   f"newsletter.</p></div><p>{B}</p></div></div></body>", [A, B]),
    "breadcrumb": (f"{HEAD}<body><ul class=breadcrumb><li><a href=/>Home</a><li><a href=/n>News</a></ul><div class=post><h1>The report</h1>"
                   f"<p>{A}</p></div></body>", ["The report", A]),
    "quoted value with an end": (f'<article><p title="a > b">{A}</p><p data-x=\'</p>\'>{B}</p></article>', [A, B]),
    "bold and breaks": (f"<article><p>The <b>com</b>mittee met<br>on&nbsp;Tuesday &amp; left.</p><p>{B}</p></article>",
                        ["The committee met on Tuesday & left.", B]),
    "quotation": (f"<article><p>{A}</p><blockquote><p>{B}</p></blockquote><p>{C}</p></article>", [A, B, C]),
    "long menu": ("<body><nav><ul>" + "<li><a href=#>Entry</a></li>" * 30 + f"</ul></nav><main><h1>The report</h1><p>{A}</p><p>{B}</p></main>",
                  ["The report", A, B]),
}


@pytest.mark.parametrize("name", sorted(LAYOUTS))
def test_article_of_a_layout(name):
    page, expected = LAYOUTS[name]
    assert htmltext.trained_field().text(page) == "\n\n".join(expected)


@pytest.mark.parametrize(
    "page",
    ["<nav><ul><li><a href=1>One</a><li><a href=2>Two</a></ul></nav>", "<footer><p>&copy; 2020 Us</p></footer>",
     "<script>var a = '<p>text</p>';</script>", "<style>p{}</style>", "<!-- <p>hidden</p> -->", "<title>Only a title</title>"],
)
def test_pages_without_an_article(page):
    assert htmltext.trained_field().text(page) == ""


LONG = {
    "open tags": "<a " * 330_000,
    "deep": "<div>x" * 160_000,
    "quotes": '"' * 1_000_000,
    "quotes in tags": "<b x='>" * 150_000,
    "two kinds of quotes": "<b x=\"'>" * 125_001,
    "odd quote": "<a \"" * 250_000,
    "wrong ends": "<p>x</q>" * 125_000,
    "deep unknown": "<foo>" * 100_000 + "<p>x</p>" * 60_000,
    "comments": "<!--" * 250_000,
    "drawings": "<svg>" * 200_000,
    "names": "<p class=x1 id=y>a" * 50_000,
    "new names": "".join(f"<div class=n{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676 % 26)}>x" for i in range(50_000)),
    "signs": "&" * 1_000_000,
    "ends of sentences": ".)" * 500_000,
    "spaces in a tag": "<a =" + " " * 1_000_000 + ">x",
}


@pytest.mark.parametrize("name", sorted(LONG))
def test_a_megabyte_of_anything_takes_seconds(name):
    field = htmltext.trained_field()
    started = time.perf_counter()
    field.text(LONG[name])
    assert time.perf_counter() - started < 20


def test_depth_is_bounded_and_nothing_is_lost():
    deep = "<div>" * 2000 + f"<p>{A}</p>" + "</div>" * 2000 + f"<p>{B}</p>"
    found = htmltext.blocks(deep)
    assert [b.text for b in found] == [A, B]
    assert found[1].node.parent is None
