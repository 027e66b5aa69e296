"""Personal data replaced by keyed surrogates of the same type, gender, script and format.

Method. Patterns find entities; a canonical form (digits of a phone number, lower-case
address, single name words) makes mentions of one entity equal. A form of address makes a person
known to its text: their family name is then found without it, too, with given names or initials
before it, and neutral forms ("Dr") take the gender that others of that text tell. Every distinct
entity of the corpus gets a surrogate drawn from a keyed hash: digits for digits, letters for letters,
country codes and check digits valid where they were, names of the same gender and script. A collision
check over the whole corpus keeps the mapping one to one: of entities that draw the same surrogate one
keeps it, and a surrogate that is itself an entity of the corpus is refused; the others draw again.
From attempt ``WIDER`` on, every attempt draws from a larger space (longer numbers and words; addresses
of version 6 for IPs), so that a corpus which holds all short numbers ends, too; after ``ATTEMPTS`` it
is an error. The mapping is then written back into the texts, in the spacing and case of each mention.

Scale. Texts without a digit, an @, a form of address, the name of a secret or 32 letters a to f in
a row pass unread by Python and unshuffled; the others are stored once with their digest.
The mapping is keyed by entity and joined to texts by their digest, so a text that a third of
the rows repeat is a skewed join that adaptive execution splits, never a group; only the
distinct entities of one text are ever collected. The rounds of the collision check are
written to the shared folder and handle ever fewer entities. A task turns only a few of its texts into
Python's strings at a time, so what it holds does not grow with the length of all. Patterns start at the beginning of a run
of characters only, so their time is in proportion to the text.

Defined cases. A null text stays null, an empty one empty. Repeated rows and mentions get the
same surrogate, with or without doc_id. Other columns are returned as they are, ``n_chars``
recomputed where it exists. Overlapping mentions: the earlier wins, then the kind listed
first. A family name that is also a word is replaced wherever it is capitalised in a text that names
the person. An initial becomes that of the given name it stands for, where its text tells one,
else another letter. Book numbers (ISBN) are no personal data.
"""

from __future__ import annotations

import hashlib
import hmac
import re
import sys
from dataclasses import dataclass
from functools import cache, reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tillspark.session import staged

# forms of address and the gender they tell
TITLES = {
    "Mr": "m", "Mister": "m", "Herr": "m", "Sr": "m", "Señor": "m", "Monsieur": "m", "г-н": "m", "Господин": "m", "Κύριος": "m",
    "Mrs": "f", "Ms": "f", "Miss": "f", "Frau": "f", "Sra": "f", "Srta": "f", "Señora": "f", "Mme": "f", "Madame": "f", "Mlle": "f",
    "г-жа": "f", "Госпожа": "f", "Κυρία": "f",
    "Dr": "n", "Prof": "n", "Professor": "n",
}
# given names by script and gender: they tell the gender of a mention and serve as surrogates
GIVEN = {
    ("latin", "m"): "Adrian Albert Anton Bruno Carlos Clement Daniel David Diego Emil Erik Felix Frank George Henri Hugo James Jan John Jonas Jorge Julian Karl Leon Louis Lucas Marc Martin Max Miguel Oscar Otto Paul Pedro Peter Robert Simon Thomas Victor Walter".split(),
    ("latin", "f"): "Ada Alice Anna Beatrice Camille Carla Clara Claire Diana Elena Elise Emma Eva Flora Gloria Greta Helen Ida Ines Irene Jane Julia Karin Laura Lena Lucia Marie Maria Martha Mary Nina Olga Paula Petra Rosa Sarah Sofia Sylvia Teresa Vera".split(),
    ("cyrillic", "m"): "Алексей Андрей Борис Виктор Владимир Дмитрий Иван Игорь Максим Михаил Николай Олег Павел Сергей".split(),
    ("cyrillic", "f"): "Алла Анна Вера Галина Дарья Елена Ирина Ксения Лариса Мария Надежда Ольга Светлана Татьяна".split(),
    ("greek", "m"): "Αλέξανδρος Γιώργος Δημήτρης Ηλίας Κώστας Μιχάλης Νίκος Παύλος Πέτρος Στέφανος".split(),
    ("greek", "f"): "Αθηνά Άννα Βασιλική Δήμητρα Ελένη Ζωή Ιωάννα Κατερίνα Μαρία Σοφία".split(),
}
FAMILY = {
    "latin": "Albrecht Bauer Becker Berger Blanc Brandt Carter Castro Collins Dubois Duran Fischer Fontaine Foster Garcia Gomez Graham Hartmann Hoffman Jensen Keller Kramer Lambert Lang Lopez Marchand Martens Meyer Molina Moreau Navarro Neumann Olsen Ortega Parker Perrin Ramos Renard Richter Rivera Romero Roth Sanders Schubert Serrano Simmons Torres Turner Vargas Vidal Vogel Wagner Walker Weber Winter Wood".split(),
    "cyrillic": "Волков Громов Жуков Зайцев Козлов Лебедев Морозов Новиков Орлов Павлов Соколов Тихонов".split(),
    "greek": "Αγγέλου Βλάχος Γεωργίου Δημητρίου Ιωάννου Κωνσταντίνου Νικολάου Παππάς Παύλου Χρήστου".split(),
}
# syllables of made-up names, for draws after the lists
SYLLABLES = {
    "latin": "ba be da do el fa ga in ka la le ma mi na no or pa ra re sa so ta ti va".split(),
    "cyrillic": "ба ве га до ка ла ма на ро са та ви".split(),
    "greek": "βα γε δα κα λα μα να ρο σα τα".split(),
}
ENDINGS = {
    ("latin", "m"): "us", ("latin", "f"): "ia", ("cyrillic", "m"): "ан", ("cyrillic", "f"): "ия",
    ("greek", "m"): "ος", ("greek", "f"): "ία",
}
LIST_DRAWS = 3  # draws from the lists before names are made up

_SECRET = r"password|passwd|pwd|token|secret|api[_-]?key|access[_-]?key"
_BYTE = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
# in this order where two begin at the same place; the group of that name is what is replaced
KINDS = {
    "email": r"(?P<email>(?<![\w.%+-])[\w.%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,})",
    "secret": rf"(?<![A-Za-z])(?i:{_SECRET})[\"']?[ ]?[=:][ ]?[\"']?(?P<secret>[^\s\"',;]{{6,}})",
    "iban": r"(?P<iban>(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?(?![A-Za-z0-9]))",
    "ip": rf"(?P<ip>(?<![\w.])(?:{_BYTE}\.){{3}}{_BYTE}(?!\.?\w))",
    "ssn": r"(?P<ssn>(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-]))",
    "plus_phone": r"(?P<plus_phone>(?<![\w+])\+\d{1,3}(?:[ .-]?\(?\d{1,4}\)?){2,5}(?!\w))",
    "card": r"(?P<card>(?<![\w.+-])\d(?:[ -]?\d){12,18}(?![\w-]))",
    "phone": r"(?P<phone>(?<![\w+(.-])(?:\(\d{3}\)[ ]?|\d{3}[.-])\d{3}[.-]\d{4}(?![\w-]))",
    "key": r"(?P<key>(?<![A-Za-z0-9])(?:[0-9a-f]{32,64}|[0-9A-F]{32,64})(?![A-Za-z0-9]))",
}


def _capitals() -> str:
    """The inside of a character class of every letter that ``str.isupper`` accepts."""
    codes = [i for i in range(sys.maxunicode + 1) if chr(i).isupper() and chr(i).isalpha()]
    begins = [c for c, before in zip(codes, [-1, *codes]) if c != before + 1]
    ends = [c for c, after in zip(codes, [*codes[1:], -1]) if c != after - 1]
    return "".join(f"{chr(a)}-{chr(b)}" for a, b in zip(begins, ends))


# A person: one to three capitalised words. A word ends where an entity of another kind begins,
# and one that begins a mention of its own is no further word.
_OTHER = "|".join(re.sub(r"\(\?P<\w+>", "(?:", kind) for kind in KINDS.values())
_LETTERS = rf"(?!{_OTHER})[^\W\d_]+"
_BLANK = r"[ \u00a0\u202f]{1,2}"
# in capitals any word looks like a name; these are none
_NO_NAMES = "AND|OR|OF|THE|AT|IN|ON|TO|FOR|FROM|BY|IS|ARE|WAS|HAS|HAD|WITH|UND|ODER|IST|HAT|MIT|VON|ET|OU|EST|AVEC|Y|CON|ES"
_WORD = rf"(?!(?:{_NO_NAMES})\b)(?=[{_capitals()}]){_LETTERS}(?:['’-](?![sS]\b){_LETTERS})*"
_INITIAL = rf"[{_capitals()}]\.(?={_BLANK}?[{_capitals()}])"
_PARTICLE = r"(?:van|von|vom|zu|zum|zur|de|del|della|der|den|di|da|do|dos|du|la|le|los|el|al|bin|ibn|ter|ten|af|av)"
_PARTICLES = rf"(?:{_PARTICLE}{_BLANK}){{0,3}}"
_TITLES = "|".join(sorted({re.escape(form) for t in TITLES for form in (t, t.upper())}, key=len, reverse=True))
_FORM = rf"(?:{_TITLES})(?:\.\s*+|\s++)"
_PART = rf"(?:{_INITIAL}|{_WORD})"
KINDS["name"] = (
    rf"(?<!\w)(?P<title>{_TITLES})(?:\.\s*+|\s++)(?:{_FORM})*"
    rf"(?P<name>{_PARTICLES}{_PART}(?:{_BLANK}?(?<=[\s.\u00a0\u202f])(?!(?:{_FORM})+{_PARTICLES}{_PART}){_PARTICLES}{_PART}){{0,3}})"
)
PATTERN = re.compile("|".join(KINDS.values()))
_NAME_PART = re.compile(rf"(?P<initial>{_INITIAL})|(?P<word>{_WORD})|{_PARTICLE}\b")
_TOKEN = re.compile(r"[^\W\d_]+(?:['’-](?![sS]\b)[^\W\d_]+)*")
# what any of these needs to contain, as patterns for the scan; words first, which are found faster
ALWAYS = r"[0-9@\p{Nd}]|[a-f]{32}|[A-F]{32}"
ADDRESSED = rf"(^|[^\p{{L}}\p{{N}}_])({_TITLES})(\.|[\s\p{{Z}}])"
SECRET = rf"(?iu:{_SECRET})[\"']?\x20?[=:]"
SECRET_WORDS = ["passw", "pwd", "token", "secret", "api", "access"]


def candidate(text: Column) -> Column:
    """Whether a text may hold an entity; null for a null text."""
    # the Kelvin sign is a k in any case, but has no capital
    secret = reduce(Column.__or__, [F.upper(text).contains(w.upper()) for w in SECRET_WORDS]) | text.contains("\u212a")
    forms = {form[:2] for t in TITLES for form in (t, t.upper())}
    addressed = reduce(Column.__or__, [text.contains(f) for f in sorted(forms)])
    return text.rlike(ALWAYS) | (addressed & text.rlike(ADDRESSED)) | (secret & text.rlike(SECRET))


def script_of(word: str) -> str:
    first = ord(word[0])
    return "cyrillic" if 0x400 <= first < 0x530 else "greek" if 0x370 <= first < 0x400 or 0x1F00 <= first < 0x2000 else "latin"


@cache
def _genders() -> dict[str, str]:
    return {name.casefold(): gender for (_, gender), names in GIVEN.items() for name in names}


def luhn(digits: str) -> int:
    """The Luhn sum modulo 10; 0 for a valid number."""
    return sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(map(int, reversed(digits)))) % 10


@dataclass
class _Person:
    """A mention with a form of address: its gender, and (start, end, word) of its parts."""

    gender: str
    given: list[tuple[int, int, str]]
    initials: list[tuple[int, int, str]]
    family: tuple[int, int, str]


def _person(match: re.Match) -> _Person | None:
    """None where nothing but initials follows the form of address."""
    at, title = match.start("name"), match["title"]
    words, initials = [], []
    for part in _NAME_PART.finditer(match["name"]):
        if part["word"]:
            words.append((at + part.start(), at + part.end(), part["word"]))
        elif part["initial"]:
            initials.append((at + part.start(), at + part.start() + 1, part["initial"][0]))
    gender = _title_genders()[title]
    return _Person(gender, words[:-1], initials, words[-1]) if words else None


@cache
def _title_genders() -> dict[str, str]:
    return {form: gender for title, gender in TITLES.items() for form in (title, title.upper())}


def _named(persons: list[_Person], text: str, taken: list[tuple[int, int]]) -> list[tuple[int, int, str, str]]:
    """Mentions of the persons of one text, with a form of address and without."""
    told: dict[str, set[str]] = {}  # genders of a given name by forms of address
    for p in persons:
        for _, _, word in p.given:
            told.setdefault(word.casefold(), set()).update({p.gender} - {"n"})

    def given(word: str, own: str = "n") -> tuple[str, str]:
        value = word.casefold()
        known = told.get(value, set())
        gender = own if own != "n" else next(iter(known)) if len(known) == 1 else _genders().get(value, "n")
        return f"given-{gender}-{script_of(word)}", value

    families: dict[str, dict[str, tuple[str, str]]] = {}  # of a family name: its given names
    for p in persons:
        known = families.setdefault(p.family[2].casefold(), {})
        for _, _, word in p.given:
            known.setdefault(word.casefold(), given(word, p.gender))

    def initial(letter: str, family: str) -> tuple[str, str]:
        meant = [entity for name, entity in families[family].items() if name[0] == letter.casefold()]
        return meant[0] if len(meant) == 1 else (f"initial-{script_of(letter)}", letter.casefold())

    found = []
    for p in persons:
        start, end, word = p.family
        family = word.casefold()
        found += [(s, e, *given(w, p.gender)) for s, e, w in p.given]
        found += [(s, e, *initial(w, family)) for s, e, w in p.initials]
        found.append((start, end, f"family-{script_of(word)}", family))
    covered = sorted([*taken, *[(s, e) for s, e, _, _ in found]])
    inside, before = 0, None
    for token in _TOKEN.finditer(text):
        start, end = token.span()
        while inside < len(covered) and covered[inside][1] <= start:
            inside += 1
        free = inside == len(covered) or covered[inside][0] >= end
        word, last, before = token.group(), before, token if free else None
        family = word.casefold()
        if not free or family not in families or not word[0].isupper() or _joined(text, start, end):
            continue
        found.append((start, end, f"family-{script_of(word)}", family))
        if last and text[last.end() : start] in _BETWEEN and not _joined(text, *last.span()):
            name = last.group()
            if name.casefold() in families[family] and name[0].isupper():
                found.append((*last.span(), *families[family][name.casefold()]))
        elif last and len(last.group()) == 1 and last.group().isupper() and text[last.end() : start] in _AFTER_INITIAL:
            found.append((*last.span(), *initial(last.group(), family)))
    return found


_BETWEEN = {" ", "\u00a0", "\u202f", "  "}
_AFTER_INITIAL = {".", ". ", ".\u00a0", ".\u202f"}


def _joined(text: str, start: int, end: int) -> bool:
    """Whether a word is part of a larger one with digits, underscores or hyphens."""
    return text[start - 1 : start] in _JOINS or text[end : end + 1] in _JOINS


_JOINS = set("0123456789_-")


def _isbn(digits: str) -> bool:
    return len(digits) == 13 and digits[:3] in ("978", "979") and sum(int(d) * (1 + 2 * (i % 2)) for i, d in enumerate(digits)) % 10 == 0


def mentions(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, canonical value) of every entity in ``text``, left to right.

    A person's mention gives one entity per name word: given names with their gender, the
    last word as family name, so that "Mr Smith" and "John Smith" agree in the family name.
    """
    found, persons = [], []
    for match in PATTERN.finditer(text):
        kind = match.lastgroup
        start, end = match.span(kind)
        value = text[start:end]
        if kind == "name":
            if person := _person(match):
                persons.append(person)
            continue
        digits = "".join(str(int(c)) for c in value if c.isdecimal())
        if kind in ("plus_phone", "phone"):
            if len(digits) >= 7:
                found.append((start, end, "phone", f"+{digits}" if kind == "plus_phone" else digits))
        elif kind == "card":
            if not _isbn(digits):
                found.append((start, end, "number" if luhn(digits) else "card", digits))
        elif kind == "ssn":
            found.append((start, end, "ssn", value.replace("-", "")))
        elif kind == "iban":
            found.append((start, end, "iban", value.replace(" ", "")))
        elif kind == "email":
            found.append((start, end, "email", value.lower()))
        else:
            found.append((start, end, kind, value))
    if persons:
        found = sorted([*found, *_named(persons, text, [(s, e) for s, e, _, _ in found])])
    return found


# country codes of two digits; of the others those that begin with 1 or 7 have one digit, the rest three
TWO_DIGIT_CODES = set(
    "20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split()
)
# attempts after which spaces widen, and after which there must be something wrong
WIDER, ATTEMPTS = 8, 200


def _country_code(digits: str) -> str:
    return digits[:1] if digits[0] in "17" else digits[:2] if digits[:2] in TWO_DIGIT_CODES else digits[:3]


@cache
def _alphabet(key: bytes, script: str) -> str:
    """The capital letters of a script in a keyed order."""
    first, last = {"latin": "AZ", "greek": "ΑΩ", "cyrillic": "АЯ"}[script]
    letters = [chr(i) for i in range(ord(first), ord(last) + 1) if chr(i).isalpha()]
    return "".join(sorted(letters, key=lambda c: hmac.new(key, f"letter\0{c}".encode(), hashlib.sha256).digest()))


class _Draws:
    """A stream of keyed pseudo-random numbers for one entity and attempt."""

    def __init__(self, key: bytes, kind: str, value: str, attempt: int):
        self.seed = hmac.new(key, f"{kind}\0{value}\0{attempt}".encode(), hashlib.sha256).digest()
        self.block, self.state = 0, 0

    def below(self, n: int) -> int:
        if self.state < 1 << 64:
            more = hashlib.sha256(self.seed + self.block.to_bytes(8, "little")).digest()
            self.block += 1
            self.state = self.state << 256 | int.from_bytes(more, "little")
        self.state, out = divmod(self.state, n)
        return out

    def pick(self, options):
        return options[self.below(len(options))]

    def like(self, value: str) -> str:
        """Digits for digits, letters for letters, hexadecimal for hexadecimal."""
        low, high = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
        if re.fullmatch(r"[0-9a-f]+", value):
            low = "abcdef"
        return "".join(
            self.pick("0123456789") if c.isdigit() else self.pick(low) if c.islower() else self.pick(high) if c.isupper() else c
            for c in value
        )


def surrogate(kind: str, value: str, key: bytes, attempt: int) -> str:
    """A canonical surrogate of the same kind and format as the canonical ``value``."""
    draw = _Draws(key, kind, value, attempt)
    if kind == "email":
        local, domain = value.split("@")
        # addresses of one domain stay together, under a name reserved for examples
        host = _Draws(key, "domain", domain, 0)
        return f"{draw.like(local)}{'x' * (attempt // 8)}@{''.join(host.pick(SYLLABLES['latin']) for _ in range(4))}.example"
    if kind.startswith("initial"):
        # one to one without draws: the next letter in a keyed order
        letters = _alphabet(key, kind.split("-")[1]).casefold()
        place = letters.find(value)
        return letters[(place + 1) % len(letters)] if place >= 0 else value
    more = "".join(draw.pick("0123456789") for _ in range(max(0, attempt - WIDER)))
    if kind == "ip":
        if more:
            return "2001:db8:" + ":".join(f"{draw.below(1 << 16):x}" for _ in range(6))
        return ".".join(map(str, (1 + draw.below(126), draw.below(256), draw.below(256), draw.below(256))))
    if kind == "card":
        body = value[0] + draw.like(value[1:-1]) + more
        return body + str((10 - luhn(body + "0")) % 10)
    if kind == "number":
        body = value[0] + draw.like(value[1:]) + more
        return body if luhn(body) else body[:-1] + str((int(body[-1]) + 1) % 10)
    if kind == "phone":
        held = "+" + _country_code(value[1:]) if value[0] == "+" else value[:1]
        return held + draw.like(value[len(held) :]) + more
    if kind == "iban":
        body = value[:2] + "00" + draw.like(value[4:]) + more
        number = int("".join(str(int(c, 36)) for c in body[4:] + body[:4]))
        return f"{body[:2]}{98 - number % 97:02d}{body[4:]}"
    if kind.startswith(("given", "family")):
        role, *gender, script = kind.split("-")
        if attempt < LIST_DRAWS:
            if role == "family":
                return draw.pick(FAMILY[script]).casefold()
            names = GIVEN[script, gender[0]] if gender[0] != "n" else GIVEN[script, "m"] + GIVEN[script, "f"]
            return draw.pick(names).casefold()
        made = "".join(draw.pick(SYLLABLES[script]) for _ in range(2 + attempt // 2))
        return made + (ENDINGS.get((script, gender[0]), "") if role == "given" else "")
    # ssn, secret, key: the same characters' classes; a longer one once short ones run out
    return draw.like(value) + more


def shaped(value: str, mention: str) -> str:
    """The canonical surrogate in the spacing, punctuation and case of the mention."""
    if any(c.isdigit() for c in mention) and not any(c.isalpha() for c in mention) and not set(".:") & set(value):
        left = iter(value.lstrip("+"))
        out = "".join(next(left, "") if c.isdigit() else c for c in mention)
        return out + "".join(left)
    if " " in mention:  # IBAN groups
        left = iter(value)
        return "".join(c if c == " " else next(left, "") for c in mention) + "".join(left)
    if "@" in mention:
        return value.upper() if mention.isupper() else value
    return value


def replaced(text: str, mapping: dict[tuple[str, str], str]) -> tuple[str, int]:
    """The text with every mention replaced, and the number of mentions."""
    out, at, count = [], 0, 0
    for start, end, kind, value in mentions(text):
        new, old = mapping[kind, value], text[start:end]
        if kind.startswith(("given", "family", "initial")):
            whole = new if len(old) > 1 or len(value) == 1 else new[:1]  # an initial of a known name
            new = whole.upper() if old.isupper() and len(old) > 1 else whole[:1].upper() + whole[1:]
        else:
            new = shaped(new, old)
        out += [text[at:start], new]
        at, count = end, count + 1
    return "".join([*out, text[at:]]), count


# --- on DataFrames --------------------------------------------------------------------

BATCH_ROWS, BATCH_BYTES = 256, 4 << 20  # rows and bytes of texts (one text at least) held as Python objects at once


def _parts(batches, column="text"):
    """Every batch in slices of few rows and little text, because each text is held several times."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        at = held = 0
        for row, size in enumerate(sizes):
            if row > at and (row - at == BATCH_ROWS or held + size > BATCH_BYTES):
                yield batch.slice(at, row - at)
                at, held = row, 0
            held += size
        if sizes:
            yield batch.slice(at)


def _entities(texts: DataFrame) -> DataFrame:
    """(text_key, kind, value): the distinct entities of every text."""

    def run(batches):
        for part in _parts(batches):
            rows = [
                (key, kind, value)
                for key, text in zip(part.column("text_key").to_pylist(), part.column("text").to_pylist())
                for kind, value in {(m[2], m[3]) for m in mentions(text)}
            ]
            columns = zip(*rows) if rows else ([], [], [])
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], ["text_key", "kind", "value"])

    return texts.mapInArrow(run, "text_key string, kind string, value string").distinct()


def _drawn(pending: DataFrame, key: bytes, attempt: int) -> DataFrame:
    def run(batches):
        for part in _parts(batches, "value"):
            new = [
                surrogate(kind, value, key, attempt)
                for kind, value in zip(part.column("kind").to_pylist(), part.column("value").to_pylist())
            ]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(new, pa.string())], ["kind", "value", "surrogate"])

    return pending.select("kind", "value").mapInArrow(run, "kind string, value string, surrogate string")


def assign_surrogates(entities: DataFrame, key: bytes) -> DataFrame:
    """(kind, value, surrogate), one to one within a kind, for distinct (kind, value).

    A surrogate never equals an entity of the corpus or the surrogate of another one.
    """
    entities = staged(entities, "entities")
    letters = F.col("kind").startswith("initial")
    done = _drawn(entities.where(letters), key, 0)  # one to one by itself
    pending = entities = entities.where(~letters)
    for attempt in range(ATTEMPTS):
        drawn = staged(_drawn(pending, key, attempt), "drawn")
        # of those that drew the same, the first keeps it
        first = drawn.groupBy("kind", "surrogate").agg(F.min("value").alias("value"))
        taken = entities.select("kind", F.col("value").alias("surrogate")).unionByName(done.select("kind", "surrogate"))
        good = staged(first.join(taken, ["kind", "surrogate"], "left_anti").select("kind", "value", "surrogate"), "kept")
        done = done.unionByName(good)
        pending = staged(drawn.join(good, ["kind", "value"], "left_anti").select("kind", "value"), "pending")
        if pending.isEmpty():
            return done
    raise RuntimeError(f"after {ATTEMPTS} draws entities are without a surrogate, such as {pending.first()}")


def with_surrogates(docs: DataFrame, key: bytes) -> DataFrame:
    """``docs`` with every personal detail in ``text`` replaced, and ``n_replaced``."""
    names = [c for c in docs.columns if c != "n_replaced"]
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in names if c != "text"]).alias("row")
        if len(names) > 1
        else F.struct(F.lit(None).alias("none")).alias("row"),
        F.col("text").cast("string").alias("text"),
    )
    may_hold = F.coalesce(candidate(F.col("text")), F.lit(False))
    # read twice: for its entities and to be rewritten
    some = staged(rows.where(may_hold).withColumn("text_key", F.md5("text")), "texts")
    found = staged(_entities(some.select("text_key", "text")), "mentions")
    assigned = assign_surrogates(found.select("kind", "value").distinct(), key)
    mapping = (
        found.join(assigned, ["kind", "value"])
        .groupBy("text_key")
        .agg(F.collect_list(F.struct("kind", "value", "surrogate")).alias("mapping"))
    )

    def run(batches):
        for part in _parts(batches):
            texts, counts = [], []
            for text, pairs in zip(part.column("text").to_pylist(), part.column("mapping").to_pylist()):
                new, count = replaced(text, {(p["kind"], p["value"]): p["surrogate"] for p in pairs or ()})
                texts.append(new)
                counts.append(count)
            yield pa.RecordBatch.from_arrays(
                [part.column("row"), pa.array(texts, pa.string()), pa.array(counts, pa.int64())], ["row", "text", "n_replaced"]
            )

    joined = some.join(mapping, "text_key", "left").select("row", "text", "mapping")
    changed = joined.mapInArrow(run, StructType([rows.schema["row"], rows.schema["text"], StructField("n_replaced", LongType())]))
    same = rows.where(~may_hold).withColumn("n_replaced", F.lit(0).cast("bigint"))
    every = changed.unionByName(same)
    columns = []
    for c in names:
        if c == "text":
            columns.append(F.col("text"))
        elif c == "n_chars":
            columns.append(F.length("text").cast(docs.schema[c].dataType).alias(c))
        else:
            columns.append(F.col(f"row.`{c}`"))
    return every.select(*columns, "n_replaced")
