"""Main text of web pages: a linear-chain conditional random field over DOM leaf blocks.

Method. A forgiving scan of the tags (unclosed, wrongly nested and unknown ones occur) turns
a page into its leaf blocks in page order: the text between two block-level tags, with the
open ancestors and their class, id and role words. A block's features are those ancestors and
words, its own tag, its length, share of linked text and punctuation. The field has
one weight per feature and transitions between article and other blocks; it is fitted by
gradient steps on the likelihood of the labelled pages in ``training_pages`` and decoded
by Viterbi. Scripts, styles, titles, fallbacks, drawings, templates and markup are never text.

Labelled pages. They are written by a seeded generator of page layouts, ``TRAINING_PAGES``
of them: articles and boilerplate in containers of many names, bare pages without any, articles
of a single block, with ads and comments inside articles, and the label of every block known.
Fitting takes seconds on the driver and depends on no input.

Scale. One pass over the pages, no shuffle; only the weights are sent. The scan takes time in
proportion to the page whatever is in it, and blocks share their ancestors.

Defined cases. A null or empty page, or one without an article block, gives an empty text.
Repeated pages are extracted each. Pages of any length are read whole; tags nested deeper than
``MAX_DEPTH`` belong to the deepest one counted, as in browsers. A tag that no ``>`` ends is text,
with all that follows. Only ``page_id``, ``url`` and ``html`` are read.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from dataclasses import dataclass
from functools import cache
from random import Random

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TRAINING_PAGES = 2400
EPOCHS = 8

MAX_DEPTH = 512
# where markup may begin: a comment, a CDATA section, a declaration or a tag
_BEGIN = re.compile(r"<(?:(!--)|(!\[CDATA\[)|([!?])|(/?)([a-zA-Z][a-zA-Z0-9:-]*+))")
# where a tag may end, or a quoted value begin that may hold what looks like an end
_IN_TAG = re.compile(r">|=\s*+([\"'])")
_NAMES = re.compile(r"(?<![\w-])(?:class|id|role|itemprop|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
# never text, up to their end tag; what stands in the first group is no markup either
_RAW = {"script", "style", "title", "textarea"}
_HIDDEN = {"noscript", "template", "svg", "select", "iframe", "object", "canvas", "audio", "video", "math"}
_END_TAG = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*+>?", re.I) for tag in _RAW | _HIDDEN}
_INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span strike"
    " strong sub sup time tt u var wbr br".split()
)
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
# an opening tag that ends an open one of these, up to the nearest of the second set
_ENDS = {
    **{tag: ({"p"}, {"td", "th", "li", "div", "article", "section", "body", "blockquote"}) for tag in
       "p div h1 h2 h3 h4 h5 h6 ul ol dl table article section aside nav header footer form blockquote pre hr figure main address".split()},
    "li": ({"li"}, {"ul", "ol"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}), "body": ({"head"}, {"html"}),
}


class Node:
    """An open element: its tag, its names, its parent, and which features it adds to its parent's."""

    __slots__ = ("tag", "names", "parent", "added", "own", "score", "nearest", "landmark")

    def __init__(self, tag: str, names: tuple[str, ...], parent: Node | None, added: tuple[str, ...]):
        self.tag, self.names, self.parent, self.added = tag, names, parent, added
        self.nearest = names or (parent.nearest if parent else ())
        self.landmark = tag if tag in _LANDMARKS else parent.landmark if parent else "none"
        self.own = [f"own:{tag}", *[f"own-name:{w}" for w in names], *[f"nearest-name:{w}" for w in self.nearest]]
        self.own += [f"landmark:{self.landmark}", f"parent:{parent.tag if parent else ''}"]
        self.score: float | None = None  # of all added features up to here, once a field has asked

    def features(self) -> list[str]:
        """All features of the path to here."""
        out, node = list(self.own), self
        while node:
            out += node.added
            node = node.parent
        return out


@dataclass
class Block:
    """Text of a leaf, its innermost open element, and its number of linked characters."""

    text: str
    node: Node | None
    linked: int


class _Tags:
    """Finds the markup of a page from left to right, in time proportional to its length."""

    def __init__(self, page: str):
        self.page = page
        self.last = {sign: page.rfind(sign) for sign in (">", '"', "'")}
        self.quotes = True  # until a quoted value has run over the last end of a tag

    def end_of(self, start: int) -> int:
        """Where the tag ends whose name ends at ``start``: the place after its ``>``, or -1."""
        if start > self.last[">"]:
            return -1
        at = start
        while self.quotes:
            stop = _IN_TAG.search(self.page, at)
            if not stop:
                self.quotes = False
                break
            sign = stop.group(1)
            if not sign:
                return stop.end()
            at = stop.end()
            if at <= self.last[sign]:
                at = self.page.index(sign, at) + 1
        return self.page.index(">", start) + 1

    def after(self, sign: str, start: int) -> int:
        """The place after the next ``sign``; without one, the end of the page."""
        found = self.page.find(sign, start)
        return len(self.page) if found < 0 else found + len(sign)


def blocks(page: str) -> list[Block]:
    """Leaf blocks with text, in page order."""
    out: list[Block] = []
    stack: list[Node] = []
    seen: Counter[str] = Counter()  # features of the open elements, and how many of them have each
    pieces: list[str] = []
    unclosed: set[str] = set()  # of hidden elements: no end tag is left
    tags = _Tags(page)
    linked = links = at = skipped = 0

    def flush():
        nonlocal linked
        if pieces:
            text = " ".join(entities.unescape("".join(pieces)).split())
            if text:
                out.append(Block(text, stack[-1] if stack else None, linked))
            pieces.clear()
        linked = 0

    def add(text: str):
        nonlocal linked
        pieces.append(text)
        if links:
            linked += len(text)

    def close(depth: int):
        for node in stack[depth:]:
            for name in _path_names(node.tag, node.names):
                seen[name] -= 1
        del stack[depth:]

    while match := _BEGIN.search(page, at):
        start = match.end()
        comment, section, declaration, slash, tag = match.groups()
        end = -1 if not tag else tags.end_of(start)
        if tag and end < 0:
            break  # nothing ends a tag any more
        if match.start() > at:
            add(page[at : match.start()])
        if not tag:
            at = tags.after("-->" if comment else "]]>" if section else ">", start)
            continue
        at, rest, tag = end, page[start : end - 1], tag.lower()
        if slash:
            if tag == "a":
                links = max(0, links - 1)
            elif tag not in _INLINE:
                flush()
                if skipped and tag == stack[-1].tag:
                    skipped -= 1
                elif seen[f"in:{tag}"]:
                    depth = len(stack) - 1
                    while stack[depth].tag != tag:
                        depth -= 1
                    close(depth)
                    skipped = 0
            continue
        if tag in _END_TAG and tag not in unclosed and not rest.endswith("/"):
            found = _END_TAG[tag].search(page, at)
            if found or tag in ("script", "style"):
                flush()
                at = found.end() if found else len(page)
                continue
            unclosed.add(tag)
        if tag in ("br", "wbr", "img"):
            add(" ")
            continue
        if tag == "a":
            links += 0 if rest.endswith("/") else 1
        if tag in _INLINE:
            continue
        flush()
        if tag in _ENDS and any(seen[f"in:{t}"] for t in _ENDS[tag][0]):
            ended, until = _ENDS[tag]
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth].tag in ended:
                    close(depth)
                    skipped = 0
                    if tag != "tr":
                        break
                elif stack[depth].tag in until:
                    break
        if tag not in _VOID and not rest.endswith("/"):
            links = 0
            if len(stack) >= MAX_DEPTH:
                skipped += tag == stack[-1].tag
                continue
            names = _name_words(" ".join(a or b or c for a, b, c in _NAMES.findall(rest))) if rest else ()
            path = _path_names(tag, names)
            stack.append(Node(tag, names, stack[-1] if stack else None, tuple(n for n in path if not seen[n])))
            seen.update(path)
    if at < len(page):
        add(page[at:])
    flush()
    return out


def _path_names(tag: str, names: tuple[str, ...]) -> list[str]:
    """Features that an element gives to all that is in it."""
    return [f"in:{tag}", *[f"name:{word}" for word in names]]


@cache
def _known_names(names: str) -> tuple[str, ...]:
    spaced = re.sub(r"([a-z])([A-Z])", r"\1 \2", names).lower()
    return tuple(dict.fromkeys(w.rstrip("s") for w in re.findall(r"[a-z]{2,}", spaced)))


def _name_words(names: str) -> tuple[str, ...]:
    """Words of class and id names, singular; long attributes are not remembered."""
    if not names:
        return ()
    return _known_names(names) if len(names) < 80 else _known_names.__wrapped__(names)


_LANDMARKS = {"article", "main", "nav", "header", "footer", "aside", "form", "section", "head", "table", "ul", "ol"}


_SENTENCE = re.compile(r"[.!?…。][\"'”’)\]]*$")


def _text_features(block: Block) -> list[str]:
    words = block.text.count(" ") + 1
    share = block.linked / len(block.text)
    size = 0 if words < 3 else 1 if words < 6 else 2 if words < 12 else 3 if words < 25 else 4 if words < 60 else 5
    return [
        f"words:{size}",
        f"linked:{0 if share == 0 else 1 if share < 0.3 else 2 if share < 0.7 else 3}",
        f"sentence:{bool(_SENTENCE.search(block.text))}",
        f"sign:{any(s in block.text for s in '©®»›')}",
    ]


# --- the field ------------------------------------------------------------------------


@dataclass
class Field:
    """Weights of "article" against "other" by feature; log weights of start and transitions."""

    weights: dict[str, float]
    start: np.ndarray
    step: np.ndarray

    def _added(self, node: Node) -> float:
        """Weights of the features of all open elements; kept with each of them."""
        chain = []
        while node and node.score is None:
            chain.append(node)
            node = node.parent
        total = node.score if node else 0.0
        for node in reversed(chain):
            total += sum(self.weights.get(f, 0.0) for f in node.added)
            node.score = total
        return total

    def score(self, block: Block) -> float:
        """Weight of the block for "article" by its own features."""
        own = _text_features(block) + (block.node.own if block.node else [])
        return sum(self.weights.get(f, 0.0) for f in own) + (self._added(block.node) if block.node else 0.0)

    def article(self, found: list[Block]) -> list[bool]:
        """The most likely labels of a page's blocks (Viterbi)."""
        if not found:
            return []
        (oo, oa), (ao, aa) = self.step.tolist()
        other, article = self.start.tolist()
        back = []
        for place, block in enumerate(found):
            score = self.score(block)
            if place:
                back.append((ao + article > oo + other, aa + article >= oa + other))
                other, article = max(oo + other, ao + article), max(oa + other, aa + article)
            article += score
        label = article > other
        labels = [label]
        for from_article in reversed(back):
            label = from_article[label]
            labels.append(label)
        return labels[::-1]

    def text(self, page: str | None) -> str:
        """Article blocks of the page, joined by an empty line."""
        found = blocks(page or "")
        return "\n\n".join(block.text for block, kept in zip(found, self.article(found)) if kept)


def fit(pages: list[tuple[list[Block], list[int]]], epochs: int = EPOCHS) -> Field:
    """Fit a field to labelled blocks (1: article) by adaptive gradient steps, page by page."""
    numbers: dict[str, int] = {}
    coded = []
    for found, labels in pages:
        rows, columns = [], []
        for place, block in enumerate(found):
            for name in _text_features(block) + (block.node.features() if block.node else []):
                rows.append(place)
                columns.append(numbers.setdefault(name, len(numbers)))
        coded.append((np.array(rows), np.array(columns), np.array(labels)))
    weights, start, step = np.zeros(len(numbers)), np.zeros(2), np.zeros((2, 2))
    squares = [np.full_like(x, 1e-6) for x in (weights, start, step)]
    random = Random(7)
    sums, taken = [np.zeros_like(x) for x in (weights, start, step)], 0
    for epoch in range(epochs):
        random.shuffle(coded)
        for rows, columns, labels in coded:
            n = len(labels)
            scores = np.zeros((n, 2))
            scores[:, 1] = np.bincount(rows, weights[columns], minlength=n)
            forward, backward = np.zeros((n, 2)), np.zeros((n, 2))
            forward[0] = start + scores[0]
            for i in range(1, n):
                forward[i] = np.logaddexp(*(forward[i - 1][:, None] + step)) + scores[i]
            for i in range(n - 2, -1, -1):
                backward[i] = np.logaddexp(*(step + scores[i + 1] + backward[i + 1]).T)
            total = np.logaddexp(*forward[-1])
            share = np.exp(forward + backward - total)
            pairs = np.zeros((2, 2))
            if n > 1:
                joint = forward[:-1, :, None] + step + (scores[1:] + backward[1:])[:, None, :] - total
                pairs = np.exp(joint).sum(axis=0)
                np.add.at(pairs, (labels[:-1], labels[1:]), -1)
            slope = np.bincount(columns, (share[:, 1] - labels)[rows], minlength=len(weights)) + 2e-4 * weights
            first = share[0].copy()
            first[labels[0]] -= 1
            for value, own, seen in ((weights, slope, squares[0]), (start, first, squares[1]), (step, pairs, squares[2])):
                seen += own**2
                value -= 0.3 * own / np.sqrt(seen)
            if 2 * epoch >= epochs:  # the mean of the later steps is steadier than the last one
                taken += 1
                for mean, value in zip(sums, (weights, start, step)):
                    mean += value
    weights, start, step = (x / max(taken, 1) for x in sums)
    return Field({name: float(weights[i]) for name, i in numbers.items()}, start, step)


# --- labelled pages -------------------------------------------------------------------

_ARTICLE = "content,article,post,entry,story,main,body,text,article-body,post-content,entry-content,page-content,story-body,main-content,articleBody,prose,markdown-body,rich-text,blog-post,single-post".split(",")
_NEUTRAL = "wrapper,container,row,col,inner,page,site,section,box,block,grid,layout,group,clearfix,,,".split(",")
# name of the part -> (tags, names); all of it is no article
_OTHER = {
    "menu": (["nav", "ul", "div"], "nav,menu,navbar,navigation,main-menu,top-nav,topbar,breadcrumb,breadcrumbs,site-nav,mega-menu,tabs,skip-link".split(",")),
    "header": (["header", "div"], "header,site-header,masthead,page-header,top,logo,branding,banner,hero-banner".split(",")),
    "footer": (["footer", "div"], "footer,site-footer,page-footer,bottom,copyright,colophon,legal,imprint,footer-links".split(",")),
    "sidebar": (["aside", "div", "section"], "sidebar,side,widget,widget-area,aside,rail,right-col,related,related-posts,recommended,recommendations,popular,trending,most-read,read-more,see-also,teaser,tag-cloud,tags,archive,author-box,about-author,bio".split(",")),
    "notice": (["div", "section", "p"], "notice,cookie,cookies,cookie-banner,cookie-notice,consent,gdpr,alert,popup,modal,overlay,announcement,warning,disclaimer,toast,message,paywall".split(",")),
    "advert": (["div", "aside", "section", "ins", "p"], "ad,ads,advert,advertisement,adsbygoogle,ad-slot,banner-ad,sponsor,sponsored,promo,promotion,promoted,commercial,affiliate,outbrain,taboola".split(",")),
    "form": (["form", "div"], "form,search,search-box,newsletter,subscribe,subscription,signup,sign-up,login,register,contact-form,poll,survey,feedback".split(",")),
    "comments": (["div", "section", "ol", "aside"], "comments,comment,comment-list,comments-area,responses,reply,replies,discussion,disqus,reader-comments,user-comments,respond,reviews,guestbook".split(",")),
    "share": (["div", "ul"], "share,sharing,social,social-links,follow,like,print,pagination,pager,next-prev,byline,meta,post-meta,entry-meta,toolbar".split(",")),
}


class _Page:
    """One generated page; every text carries a number, by which its block is labelled."""

    def __init__(self, random: Random):
        self.random, self.out, self.labels = random, [], []

    def words(self, low: int, high: int, sentence: bool = True) -> str:
        r = self.random
        words = ["".join(r.choice("bcdfglmnprstv") + r.choice("aeiou") for _ in range(r.randint(1, 4))) for _ in range(r.randint(low, high))]
        for i in range(8, len(words), r.randint(9, 15)):
            words[i] += r.choice([",", ".", ";"])
        text = " ".join(words).capitalize()
        return text + r.choice([".", ".", ".", "!", "?"]) if sentence else text

    def leaf(self, tag: str, text: str, label: int, attributes: str = "", link: bool = False):
        mark = f"#{len(self.labels)}#"
        self.labels.append(label)
        text = f"<a href='/x'>{mark}{text}</a>" if link else mark + text
        if not link and self.random.random() < 0.15:
            text = f"<b>{text}</b>"
        close = "" if tag == "p" and self.random.random() < 0.15 else f"</{tag}>"
        self.out.append(f"<{tag}{attributes}>{text}{close}")

    def open(self, tags: list[str], names: list[str], bare: float = 0.2) -> str:
        r = self.random
        tag, name = r.choice(tags), r.choice(names)
        plain = tag in ("nav", "header", "footer", "aside", "article", "main", "form") and r.random() < 0.5
        if plain or not name or r.random() < bare and tag not in ("div", "section", "p", "ul", "ol"):
            self.out.append(f"<{tag}>")
        else:
            extra = " " + r.choice(_NEUTRAL) if r.random() < 0.3 else ""
            self.out.append(f'<{tag} {r.choice(["class", "class", "id"])}="{name}{extra}">')
        return tag

    def other(self, kind: str):
        r = self.random
        tags, names = _OTHER[kind]
        tag = self.open(tags, names, 0.0)
        if r.random() < 0.2 and tag not in ("ul", "ol"):  # a few words and nothing else
            link = kind in ("menu", "header", "share") and r.random() < 0.7
            mark = f"#{len(self.labels)}#" + self.words(1, 12, r.random() < 0.5)
            self.labels.append(0)
            self.out.append(f"<a href='/x'>{mark}</a>" if link else r.choice(["", "&copy; "] if kind == "footer" else [""]) + mark)
        elif tag == "p":
            self.leaf("span", self.words(3, 25), 0)
        elif kind in ("menu", "share") or kind in ("footer", "sidebar", "header") and r.random() < 0.5:
            if r.random() < 0.4:
                self.leaf(r.choice(["h3", "h4", "div", "span"]), self.words(1, 3, False), 0)
            for _ in range(r.randint(2, 8)):
                self.leaf("li", self.words(1, 5, False), 0, link=True)
        elif kind == "form":
            self.leaf(r.choice(["label", "p", "h3", "legend"]), self.words(1, 14, r.random() < 0.5), 0)
            self.out.append("<input type=text>")
            self.leaf("button", self.words(1, 2, False), 0)
        elif kind == "comments":
            self.leaf("h3", self.words(1, 3, False), 0)
            for _ in range(r.randint(1, 5)):
                self.out.append(r.choice(["<div class='comment'>", "<li>", "<div>", "<article>"]))
                close = re.match(r"<(\w+)", self.out[-1]).group(1)
                if r.random() < 0.6:
                    self.leaf(r.choice(["div", "h4", "cite", "p"]), self.words(1, 3, False), 0)
                for _ in range(r.randint(1, 2)):
                    self.leaf("p", self.words(4, 60), 0)
                self.out.append(f"</{close}>")
        else:
            for _ in range(r.randint(1, 3)):
                self.leaf(r.choice(["p", "div", "p", "h4"]), self.words(2, 45), 0, link=r.random() < 0.3)
            if kind == "footer" and r.random() < 0.7:
                self.leaf("div", "&copy; " + self.words(1, 6, False), 0)
        self.out.append(f"</{tag}>")

    def article(self):
        r = self.random
        tags = [self.open(["div", "section"], _NEUTRAL) for _ in range(r.randint(0, 2))]
        tags.append(self.open(["article", "article", "main", "main", "div", "section", "div"], _ARTICLE))
        if r.random() < 0.3:
            tags.append(self.open(["div", "section"], _ARTICLE + _NEUTRAL))
        if r.random() < 0.6:
            self.leaf(r.choice(["h1", "h1", "h2"]), self.words(2, 12, False), 1)
        self.body(r.choice([1, 1, 1, 2, 2, 3, 5, 8, 12]))
        if r.random() < 0.15:
            self.other("comments")
        self.out += [f"</{t}>" for t in reversed(tags)]

    def body(self, count: int):
        """Paragraphs, headings, lists, quotes and tables of an article, with strange parts among them."""
        r = self.random
        for _ in range(count):
            draw = r.random()
            if draw < 0.08:
                self.leaf(r.choice(["h2", "h3"]), self.words(1, 8, False), 1)
            elif draw < 0.14:
                linked = r.random() < 0.4
                self.out.append("<ul>")
                for _ in range(r.randint(2, 5)):
                    self.leaf("li", self.words(1, 20, r.random() < 0.5), 1, link=linked)
                self.out.append("</ul>")
            elif draw < 0.18:
                self.out.append("<blockquote>")
                self.leaf("p", self.words(5, 40), 1)
                self.out.append("</blockquote>")
            elif draw < 0.20:
                self.out.append("<table><tr>")
                for _ in range(r.randint(2, 6)):
                    self.leaf("td", self.words(1, 6, False), 1)
                self.out.append("</tr></table>")
            elif draw < 0.32:
                self.other(r.choice(["advert", "advert", "share", "sidebar", "notice", "form"]))
            else:
                short = r.random() < 0.15
                ended = r.random() < 0.75  # articles hold lists, verses and noise too
                self.leaf(r.choice(["p"] * 9 + ["div", "pre", "figcaption"]), self.words(1, 4, ended) if short else self.words(5, 150, ended), 1)

    def bare(self):
        """An article in no container, or in one without a name."""
        r = self.random
        tags = [self.open(["div", "section", "main", "article"], [""]) for _ in range(r.choice([0, 0, 1]))]
        if r.random() < 0.4:
            self.leaf(r.choice(["h1", "h2"]), self.words(2, 12, False), 1)
        for _ in range(r.choice([1, 1, 2, 2, 3, 6])):
            self.leaf(r.choice(["p", "p", "p", "div"]), self.words(3, 60, r.random() < 0.85), 1)
        self.out += [f"</{t}>" for t in reversed(tags)]

    def whole(self) -> tuple[str, list[int]]:
        r = self.random
        framed = r.random() < 0.9
        if framed:
            self.out.append("<!DOCTYPE html><html><head><style>p{margin:0}</style></head><body>")
        tags = [self.open(["div"], _NEUTRAL) for _ in range(r.randint(0, 2))]
        often, seldom = (0.75, 0.4) if r.random() < 0.6 else (0.5, 0.1)
        before = [k for k in ("notice", "header", "menu", "advert", "form", "sidebar") if r.random() < (often if k == "menu" else seldom)]
        after = [k for k in ("share", "advert", "comments", "sidebar", "form", "notice", "footer") if r.random() < (often if k == "footer" else seldom)]
        if r.random() < 0.3:
            before = []
        if r.random() < 0.3:  # cut off, or nothing follows
            after = []
        for kind in before:
            self.other(kind)
        if r.random() < 0.2:
            self.bare()
        else:
            self.article()
        for kind in after:
            self.other(kind)
        self.out += [f"</{t}>" for t in reversed(tags)]
        return "".join(self.out) + ("</body></html>" if framed else ""), self.labels


def training_pages(count: int = TRAINING_PAGES, seed: int = 11) -> list[tuple[list[Block], list[int]]]:
    """Blocks and labels of generated pages; the same for the same seed."""
    out = []
    random = Random(seed)
    for _ in range(count):
        page, labels = _Page(random).whole()
        found = blocks(page)
        own = []
        for block in found:
            mark = re.search(r"#(\d+)#", block.text)
            own.append(labels[int(mark.group(1))])
            block.text = re.sub(r"#\d+#", "", block.text) or "."
        out.append((found, own))
    return out


@cache
def trained_field(count: int = TRAINING_PAGES) -> Field:
    return fit(training_pages(count))


def main_texts(pages: DataFrame, training: int = TRAINING_PAGES) -> DataFrame:
    """Per row: page_id, url, text (empty where there is none) and n_chars."""
    sent = pages.sparkSession.sparkContext.broadcast(trained_field(training))

    def run(batches):
        for batch in batches:
            texts = [sent.value.text(page) for page in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"]
            )

    rows = pages.select(
        F.col("page_id").cast("bigint"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")
    )
    found = rows.mapInArrow(run, "page_id bigint, url string, text string")
    return found.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))
