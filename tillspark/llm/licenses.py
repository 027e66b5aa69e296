"""License scan by ordered signature rules behind a keyword prefilter.

Method. A text is lower-cased (A-Z). An Aho-Corasick automaton over the rules' keywords reads
it once; only rules whose keywords occur are run as regular expressions. Detections
are resolved in order of priority, then length, then place: one that lies inside a detection
already kept, or overlaps a kept one of higher priority, is suppressed. Labels are those of
the kept detections, together with the base labels: the phrases of ``BASE`` whose words stand
consecutively anywhere (these are counted before any suppression).

The rules are signatures of license families. Each family lists its names, identifiers and
addresses as patterns written by hand; a signature is one of these in one of the forms in
which licenses are granted, and the form gives the priority.

Scale. One pass over the texts, no shuffle; what is sent to the tasks is the code.

Defined cases. A null or empty text has no words and no detection: counts 0, places null,
labels empty, score 0. Repeated rows are scanned each. Only ``doc_id`` and ``text`` are read.
Keywords and rules see whole texts of any length.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from bisect import bisect_right
from functools import cache
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillspark.llm.words import LETTERS_AND_DIGITS, words_of

# phrases whose words stand consecutively, and their labels
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
BATCH_ROWS = 256

GAP = r"[\x00-\x2f\x3a-\x60\x7b-\x7f]+"  # between two words
# beside no letter or digit, where every character beyond ASCII, or byte of one, is a letter
LEFT, RIGHT = r"(?<![^\x00-\x2f\x3a-\x60\x7b-\x7f])", r"(?![^\x00-\x2f\x3a-\x60\x7b-\x7f])"

# label: (names, identifiers, addresses). Blanks stand for any gap between words. A name's
# keyword is its first literal word of four letters or more.
FAMILIES: dict[str, tuple[list[str], list[str], list[str]]] = {
    "agpl-1.0": (["affero general public license(?: version)? v?1"], ["agpl-1.0"], [r"affero\.org/oagpl"]),
    "agpl-3.0": (["(?:gnu )?affero general public license(?: as published by the free software foundation)?(?: either)?(?: version)? v?3", "gnu affero general public license"], ["agpl-3.0"], [r"gnu\.org/licenses/agpl"]),
    "gpl-1.0": (["gnu general public license(?: version)? v?1"], ["gpl-1.0"], [r"gnu\.org/licenses/old-licenses/gpl-1"]),
    "gpl-2.0": (["gnu general public license(?: as published by the free software foundation)?(?: either)?(?: version)? v?2"], ["gpl-2.0"], [r"gnu\.org/licenses/(?:old-licenses/)?gpl-2"]),
    "gpl-3.0": (["gnu general public license(?: as published by the free software foundation)?(?: either)?(?: version)? v?3"], ["gpl-3.0"], [r"gnu\.org/licenses/gpl-3", r"gnu\.org/copyleft/gpl"]),
    "lgpl-2.0": (["gnu library general public license"], ["lgpl-2.0"], [r"gnu\.org/licenses/old-licenses/lgpl-2\.0"]),
    "lgpl-2.1": (["gnu lesser general public license(?: version)? v?2"], ["lgpl-2.1"], [r"gnu\.org/licenses/(?:old-licenses/)?lgpl-2\.1"]),
    "lgpl-3.0": (["gnu lesser general public license(?: version)? v?3", "gnu lesser general public license"], ["lgpl-3.0"], [r"gnu\.org/licenses/lgpl-3"]),
    "gfdl-1.3": (["gnu free documentation license"], ["gfdl-1.1", "gfdl-1.2", "gfdl-1.3"], [r"gnu\.org/licenses/fdl"]),
    "apache-1.1": (["apache (?:software )?license(?: version)? v?1"], ["apache-1.0", "apache-1.1"], [r"apache\.org/licenses/license-1"]),
    "apache-2.0": (["apache (?:software )?license(?: version)? v?2", "asl 2"], ["apache-2.0"], [r"apache\.org/licenses/license-2"]),
    "mit": (["mit license", "expat license", "x11 license", "permission is hereby granted free of charge to any person obtaining a copy"], ["mit", "x11"], [r"opensource\.org/licen[sc]es/mit"]),
    "mit-0": (["mit no attribution"], ["mit-0"], [r"github\.com/aws/mit-0"]),
    "bsd-2-clause": (["(?:simplified|freebsd|2 clause|two clause) bsd license", "bsd 2 clause"], ["bsd-2-clause"], [r"opensource\.org/licen[sc]es/bsd-2-clause"]),
    "bsd-3-clause": (["(?:new|modified|revised|3 clause|three clause) bsd license", "bsd 3 clause", "redistribution and use in source and binary forms"], ["bsd-3-clause"], [r"opensource\.org/licen[sc]es/bsd-3-clause"]),
    "bsd-4-clause": (["(?:original|4 clause|four clause) bsd license", "bsd 4 clause"], ["bsd-4-clause"], []),
    "0bsd": (["zero clause bsd", "bsd zero clause license"], ["0bsd"], [r"opensource\.org/licen[sc]es/0bsd"]),
    "isc": (["isc license", "permission to use copy modify and or distribute this software for any purpose"], ["isc"], [r"opensource\.org/licen[sc]es/isc"]),
    "mpl-1.1": (["mozilla public license(?: version)? v?1"], ["mpl-1.0", "mpl-1.1"], [r"mozilla\.org/mpl/1\.1"]),
    "mpl-2.0": (["mozilla public license(?: version)? v?2", "mozilla public license"], ["mpl-2.0"], [r"mozilla\.org/(?:en-us/)?mpl/2\.0"]),
    "epl-1.0": (["eclipse public license(?: version)? v?1"], ["epl-1.0"], [r"eclipse\.org/legal/epl-v10"]),
    "epl-2.0": (["eclipse public license(?: version)? v?2", "eclipse public license"], ["epl-2.0"], [r"eclipse\.org/legal/epl-2\.0"]),
    "edl-1.0": (["eclipse distribution license"], ["edl-1.0"], [r"eclipse\.org/org/documents/edl-v10"]),
    "cddl-1.0": (["common development and distribution license(?: version)? v?1", "common development and distribution license"], ["cddl-1.0"], [r"opensource\.org/licen[sc]es/cddl-1"]),
    "cddl-1.1": (["common development and distribution license(?: version)? v?1 1"], ["cddl-1.1"], []),
    "cpl-1.0": (["common public license"], ["cpl-1.0"], [r"opensource\.org/licen[sc]es/cpl"]),
    "cpal-1.0": (["common public attribution license"], ["cpal-1.0"], []),
    "ipl-1.0": (["ibm public license"], ["ipl-1.0"], []),
    "eupl-1.2": (["european union public licen[cs]e"], ["eupl-1.1", "eupl-1.2"], [r"joinup\.ec\.europa\.eu/[^ ]*eupl"]),
    "osl-3.0": (["open software license"], ["osl-3.0"], []),
    "afl-3.0": (["academic free license"], ["afl-2.1", "afl-3.0"], []),
    "artistic-1.0": (["artistic license(?: version)? v?1", "perl artistic license"], ["artistic-1.0"], []),
    "artistic-2.0": (["artistic license(?: version)? v?2"], ["artistic-2.0"], [r"perlfoundation\.org/artistic_license_2_0"]),
    "bsl-1.0": (["boost software license"], ["bsl-1.0"], [r"boost\.org/license_1_0"]),
    "busl-1.1": (["business source license"], ["busl-1.1"], [r"mariadb\.com/bsl11"]),
    "sspl-1.0": (["server side public license"], ["sspl-1.0"], [r"mongodb\.com/licensing/server-side-public-license"]),
    "elastic-2.0": (["elastic license"], ["elastic-2.0"], [r"elastic\.co/licensing/elastic-license"]),
    "zlib": (["zlib license", "zlib libpng license"], ["zlib"], [r"zlib\.net/zlib_license"]),
    "libpng": (["libpng license", "png reference library license"], ["libpng-2.0"], []),
    "unlicense": (["this is free and unencumbered software released into the public domain", "the unlicense"], ["unlicense"], [r"unlicense\.org"]),
    "wtfpl": (["do what the fuck you want to public license"], ["wtfpl"], [r"wtfpl\.net"]),
    "cc0-1.0": (["cc0(?: 1 0)?(?: universal)?", "creative commons (?:zero|cc0)", "creative commons public domain dedication"], ["cc0-1.0"], [r"creativecommons\.org/publicdomain/zero"]),
    "cc-pdm": (["public domain mark 1"], ["cc-pddc"], [r"creativecommons\.org/publicdomain/mark"]),
    "cc-by-3.0": (["cc by 3 0", "creative commons attribution 3 0"], ["cc-by-3.0"], [r"creativecommons\.org/licenses/by/3"]),
    "cc-by-4.0": (["cc by 4 0", "creative commons attribution 4 0", "creative commons attribution (?:international )?license"], ["cc-by-4.0"], [r"creativecommons\.org/licenses/by/4"]),
    "cc-by-sa": (["cc by sa(?: \\d \\d)?", "creative commons attribution share ?alike"], ["cc-by-sa-3.0", "cc-by-sa-4.0"], [r"creativecommons\.org/licenses/by-sa"]),
    "cc-by-nd": (["cc by nd(?: \\d \\d)?", "creative commons attribution no ?deriv\\w*"], ["cc-by-nd-4.0"], [r"creativecommons\.org/licenses/by-nd"]),
    "cc-by-nc": (["cc by nc(?: \\d \\d)?", "creative commons attribution non ?commercial"], ["cc-by-nc-3.0", "cc-by-nc-4.0"], [r"creativecommons\.org/licenses/by-nc/"]),
    "cc-by-nc-sa": (["cc by nc sa(?: \\d \\d)?", "creative commons attribution non ?commercial share ?alike"], ["cc-by-nc-sa-4.0"], [r"creativecommons\.org/licenses/by-nc-sa"]),
    "cc-by-nc-nd": (["cc by nc nd(?: \\d \\d)?", "creative commons attribution non ?commercial no ?deriv\\w*"], ["cc-by-nc-nd-4.0"], [r"creativecommons\.org/licenses/by-nc-nd"]),
    "odbl-1.0": (["open data(?:base)?(?: commons)?(?: open database)? license"], ["odbl-1.0"], [r"opendatacommons\.org/licenses/odbl"]),
    "odc-by-1.0": (["open data commons attribution license"], ["odc-by-1.0"], [r"opendatacommons\.org/licenses/by"]),
    "pddl-1.0": (["public domain dedication and license"], ["pddl-1.0"], [r"opendatacommons\.org/licenses/pddl"]),
    "ogl-3.0": (["open government licen[cs]e"], ["ogl-uk-3.0"], [r"nationalarchives\.gov\.uk/doc/open-government-licence"]),
    "ofl-1.1": (["sil open font license"], ["ofl-1.0", "ofl-1.1"], [r"scripts\.sil\.org/ofl"]),
    "psf-2.0": (["python software foundation license", "psf license"], ["psf-2.0", "python-2.0"], [r"python\.org/psf/license"]),
    "php-3.01": (["php license"], ["php-3.0", "php-3.01"], [r"php\.net/license"]),
    "ruby": (["ruby license"], ["ruby"], [r"ruby-lang\.org/[^ ]*license"]),
    "openssl": (["openssl license"], ["openssl"], [r"openssl\.org/source/license"]),
    "curl": (["curl license"], ["curl"], []),
    "postgresql": (["postgresql licen[cs]e"], ["postgresql"], [r"opensource\.org/licen[sc]es/postgresql"]),
    "ncsa": (["university of illinois(?: ncsa)? open source license"], ["ncsa"], []),
    "w3c": (["w3c software (?:notice and )?license"], ["w3c"], [r"w3\.org/consortium/legal/[^ ]*copyright-software"]),
    "unicode": (["unicode license agreement"], ["unicode-3.0", "unicode-dfs-2016"], [r"unicode\.org/copyright"]),
    "vim": (["vim license"], ["vim"], []),
    "ms-pl": (["microsoft public license"], ["ms-pl"], []),
    "ms-rl": (["microsoft reciprocal license"], ["ms-rl"], []),
    "sleepycat": (["sleepycat license"], ["sleepycat"], []),
    "qpl-1.0": (["q public license"], ["qpl-1.0"], []),
    "lppl-1.3c": (["latex project public license"], ["lppl-1.3c"], [r"latex-project\.org/lppl"]),
    "upl-1.0": (["universal permissive license"], ["upl-1.0"], []),
    "mulanpsl-2.0": (["mulan permissive software license"], ["mulanpsl-2.0"], [r"license\.coscl\.org\.cn/mulanpsl2"]),
    "blueoak-1.0.0": (["blue oak model license"], ["blueoak-1.0.0"], [r"blueoakcouncil\.org/license"]),
    "openrail": (["(?:creativeml )?open ?rail(?: m)?(?: license)?", "responsible ai license"], ["openrail", "creativeml-openrail-m"], []),
    "json": (["the software shall be used for good not evil"], ["json"], [r"json\.org/license"]),
    "beerware": (["beer ?ware license"], ["beerware"], []),
    "all-rights-reserved": (["all rights reserved"], [], []),
    "proprietary": (["proprietary and confidential", "unauthori[sz]ed (?:copying|use|distribution) of this (?:file|software|document)"], [], []),
    "public-domain": (["released into the public domain", "dedicated to the public domain", "in the public domain"], [], []),
}

# statements that stand for themselves: no grant names them
STATEMENTS = {"all-rights-reserved", "proprietary", "public-domain"}

# form of a signature: (pattern around the name or identifier, its keyword, priority, score)
NAME_FORMS = {
    "grant": (
        r"(?:licen[cs]ed|released|distributed|published|available|redistribute[d]? (?:it )?and or modify it)"
        r" (?:to you )?under (?:the )?(?:terms (?:and conditions )?of (?:the )?)?{}(?: licen[cs]e)?",
        "under",
        40,
        1.0,
    ),
    "notice": (r"(?:licen[cs]e|copying|permitted under|governed by|subject to)(?: is)?(?: the)? {}", "", 30, 0.9),
    "name": (r"{}", "", 20, 0.7),
}
ID_FORMS = {
    "spdx": (r"spdx licen[cs]e identifier(?: expression)? \(?{}(?: only| or later)?", "licen", 50, 1.0),
    "field": (r"licen[cs]e[ds]?(?: id| name| type)? {}(?: only| or later)?", "licen", 35, 0.8),
}
URL_PRIORITY, URL_SCORE = 45, 0.95
BASE_SCORE = 0.5


@dataclass(frozen=True)
class Rule:
    label: str
    form: str
    pattern: re.Pattern[str]
    keyword: str
    also: str  # a second keyword, of the form; empty where it has none
    priority: int
    score: float


def _spaced(pattern: str) -> str:
    """Blanks become gaps; the gap before an optional group belongs into the group."""
    pattern = re.sub(r"\(\?: ", f"(?:{GAP}".replace("\\", r"\\"), pattern)
    return pattern.replace(" ?", f"(?:{GAP})?").replace(" ", GAP)


def _keyword(pattern: str) -> str:
    """The longest literal word outside groups: it is in every text the pattern matches."""
    plain = re.sub(r"\(\?:[^()]*(?:\([^()]*\)[^()]*)*\)\??", " ", pattern)
    literal = re.findall(r"(?<![\\\[])[a-z0-9]+(?![?*\]\[a-z0-9])", re.sub(r"\[[^\]]*\]", " [", re.sub(r"\\.", " ", plain)))
    return max(literal, key=len)


@cache
def rules() -> tuple[Rule, ...]:
    """All signature rules, in order of priority."""
    out = []

    def add(label, form, pattern, core, also, priority, score):
        compiled = re.compile(LEFT + _spaced(pattern) + RIGHT)
        out.append(Rule(label, form, compiled, _keyword(core), also, priority, score))

    for label, (names, identifiers, urls) in FAMILIES.items():
        for name in names:
            for form, (around, also, priority, score) in NAME_FORMS.items():
                if label in STATEMENTS and form != "name":
                    continue
                add(label, form, around.format(f"(?:{name})"), name, also, priority, score)
        for identifier in identifiers:
            words = " ".join(re.findall(r"[a-z0-9]+", identifier))
            for form, (around, also, priority, score) in ID_FORMS.items():
                add(label, form, around.format(words), words, also, priority, score)
        for url in urls:
            out.append(Rule(label, "url", re.compile(url), _keyword(url), "", URL_PRIORITY, URL_SCORE))
    return tuple(sorted(out, key=lambda rule: -rule.priority))


@cache
def _prefilter():
    import ahocorasick

    automaton = ahocorasick.Automaton()
    for keyword in {k for rule in rules() for k in (rule.keyword, rule.also) if k}:
        automaton.add_word(keyword, keyword)
    automaton.make_automaton()
    return automaton


@cache
def _by_keyword() -> dict[str, list[tuple[int, str]]]:
    out: dict[str, list[tuple[int, str]]] = {}
    for number, rule in enumerate(rules()):
        out.setdefault(rule.keyword, []).append((number, rule.also))
    return out


@cache
def _base_patterns() -> tuple[tuple[str, re.Pattern[bytes]], ...]:
    gap = GAP.encode()
    return tuple(
        (label, re.compile(LEFT.encode() + gap.join(w.encode() for w in phrase.split()) + RIGHT.encode()))
        for phrase, label in BASE.items()
    )


def active_rules(text: str) -> set[int]:
    """Numbers of the rules whose keywords are all in the lower-cased text."""
    found = {keyword for _, keyword in _prefilter().iter(text)}
    return {
        number
        for keyword in found
        for number, also in _by_keyword().get(keyword, ())
        if not also or also in found
    }


def detections(text: str, active: set[int] | None = None) -> list[tuple[int, int, Rule]]:
    """Kept detections (start, end, rule) of a lower-cased text, in order of place."""
    found = []
    for number in sorted(active_rules(text) if active is None else active):
        rule = rules()[number]
        found += [(m.start(), m.end(), rule) for m in rule.pattern.finditer(text)]
    found.sort(key=lambda d: (-d[2].priority, d[0], -d[1], d[2].label))
    kept: list[tuple[int, int, Rule]] = []
    taken: list[tuple[int, int]] = []  # by rules of higher priority: apart from each other, in order
    for _, level in groupby(found, key=lambda d: d[2].priority):
        reached = -1  # within a level, what begins earlier or lasts longer comes first
        own = []
        for start, end, rule in level:
            if end > reached and not _crosses(taken, start, end):
                own.append((start, end, rule))
                reached = end
        kept += own
        taken = _united([*taken, *[d[:2] for d in own]])
    return sorted(kept, key=lambda d: d[:2])


def _crosses(spans: list[tuple[int, int]], start: int, end: int) -> bool:
    """Whether any of ``spans``, apart from each other and in order, has a place in common."""
    at = bisect_right(spans, start, key=lambda s: s[1])
    return at < len(spans) and spans[at][0] < end


def _united(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def scan(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_words, base phrases and their places, labels, detections, score.

    ``detections`` holds (label, form, start, end) of the kept detections, in characters.
    """

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(at, BATCH_ROWS)
                words = words_of(part.column("text"), LETTERS_AND_DIGITS)
                out = [_scanned(words, row) for row in range(part.num_rows)]
                columns = list(zip(*out))
                types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), _DETECTIONS, pa.float64()]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(words.counts(), pa.int64()),
                        *(pa.array(c, t) for c, t in zip(columns, types)),
                    ],
                    ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "detections", "score"],
                )

    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(
        run,
        "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string,"
        " labels string, detections array<struct<label: string, form: string, start: int, end: int>>, score double",
    )


_DETECTIONS = pa.list_(pa.struct([("label", pa.string()), ("form", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def _scanned(words, row: int) -> tuple:
    low, high = words.offsets[row], words.offsets[row + 1]
    raw = words.data[low:high].tobytes()
    text = raw.decode()
    active = active_rules(text)
    if not active:  # the base phrases contain keywords too
        return 0, None, None, "", "", [], 0.0
    places, base = [], set()
    for label, pattern in _base_patterns():
        for match in pattern.finditer(raw):
            places.append(match.start())
            base.add(label)
    kept = detections(text, active)
    starts = words.starts[words.first[row] : words.first[row + 1]] - low
    first = int(np.searchsorted(starts, min(places))) if places else None
    last = int(np.searchsorted(starts, max(places))) if places else None
    score = max([0.0, BASE_SCORE if base else 0.0, *(rule.score for _, _, rule in kept)])
    found = [{"label": r.label, "form": r.form, "start": s, "end": e} for s, e, r in kept]
    labels = ",".join(sorted(base | {rule.label for _, _, rule in kept}))
    return len(places), first, last, ",".join(sorted(base)), labels, found, score
