"""Finding personal data in a text, and writing keyed surrogates of the same type and format."""

from __future__ import annotations

import hashlib
import re
import unicodedata
from typing import NamedTuple


class Entity(NamedTuple):
    """What must be replaced consistently: `norm` is one spelling for all ways to write it, unique within `scope`."""

    kind: str
    scope: str
    norm: str


class Span(NamedTuple):
    start: int
    end: int
    entity: Entity


# Forms of address by gender, and given names that are common enough to tell a person's name.
MALE_TITLES = ("Mr", "Mister", "Sir", "Herr", "Herrn", "Monsieur", "Señor", "Sr", "г-н", "господин", "κύριος")
FEMALE_TITLES = (
    "Mrs", "Ms", "Miss", "Madam", "Frau", "Madame", "Mme", "Mlle", "Señora", "Señorita", "Sra", "Srta", "г-жа", "госпожа", "κυρία",
)
TITLES = ("Dr", "Prof", "Professor")
MALE_NAMES = (
    "James", "John", "Robert", "Michael", "William", "David", "Richard", "Thomas", "Charles", "Daniel", "Matthew", "Peter",
    "Paul", "Mark", "George", "Andrew", "Anthony", "Brian", "Edward", "Jason", "Joseph", "Kenneth", "Kevin", "Ryan",
    "Steven", "Stephen", "Timothy", "Hans", "Klaus", "Jürgen", "Wolfgang", "Stefan", "Andreas", "Matthias", "Uwe", "Jean",
    "Pierre", "Michel", "François", "Louis", "Philippe", "Laurent", "José", "Juan", "Carlos", "Luis", "Miguel", "Pedro",
    "Antonio", "Javier", "Giovanni", "Marco", "Giuseppe", "João", "Paulo", "Piotr", "Tomasz", "Mohammed", "Mohamed",
    "Muhammad", "Ahmed", "Ali", "Hassan", "Ibrahim", "Omar", "Mehmet", "Mustafa", "Raj", "Amit", "Rahul", "Wei", "Hiroshi",
    "Kenji", "Иван", "Сергей", "Александр", "Дмитрий", "Алексей", "Γιώργος", "Δημήτρης", "Νίκος",
)
FEMALE_NAMES = (
    "Mary", "Patricia", "Jennifer", "Linda", "Elizabeth", "Barbara", "Susan", "Jessica", "Sarah", "Karen", "Nancy", "Emily",
    "Alice", "Amanda", "Ashley", "Catherine", "Deborah", "Donna", "Helen", "Kimberly", "Lisa", "Margaret", "Melissa",
    "Michelle", "Rebecca", "Sandra", "Stephanie", "Anna", "Emma", "Laura", "Sabine", "Petra", "Monika", "Ursula", "Heike",
    "Katrin", "Claudia", "Marie", "Nathalie", "Isabelle", "Sylvie", "Françoise", "Chantal", "Camille", "María", "Carmen",
    "Ana", "Isabel", "Lucía", "Pilar", "Elena", "Giulia", "Francesca", "Beatriz", "Agnieszka", "Katarzyna", "Fatima",
    "Aisha", "Zeynep", "Leila", "Amina", "Priya", "Anjali", "Mei", "Yuki", "Анна", "Мария", "Ольга", "Наталья", "Елена",
    "Μαρία", "Ελένη", "Κατερίνα",
)
# What stands right before a person's full name.
BEFORE_NAMES = (
    "name is ", "ame: ", "I am ", "I'm ", "egards, ", "egards,\n", "incerely, ", "incerely,\n", "igned by ", "ontact: ",
    "ttn: ", "uthor: ", "atient: ", "ustomer: ", "Name ist ", "m'appelle ", "me llamo ",
)
GENDER = {**dict.fromkeys(MALE_NAMES + MALE_TITLES, "m"), **dict.fromkeys(FEMALE_NAMES + FEMALE_TITLES, "f")}

_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_NAME = r"[^\W\d_a-zа-яα-ω][^\W\d_A-ZА-ЯΑ-Ω]+(?:[-'’][^\W\d_]+)?"
_ANY = "|".join
_PATTERNS = {
    "email": r"(?<![\w.+%-])[\w+%-][\w.+%-]*@(?:[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?\.)+[A-Za-z]{2,}(?![\w-])",
    # A secret of letters alone is known by what it is assigned to, or by its quotes.
    "assigned": r"\b(?i:(?:(?P<sure>password|passwd|pwd|api[_-]?key)|access[_-]?key|token|secret)\b[\"']?\s{0,3}[=:]\s{0,3}(?P<quote>[\"'])?)"
    r"(?P<value>(?=[A-Za-z+/_.~-]*\d)[A-Za-z0-9+/_.~-]{8,}(?<![.])|(?(sure)|(?(quote)|(?!)))[A-Za-z+/_~-]{8,}(?!\w))",
    "key": r"\b(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{20,}|sk-[A-Za-z0-9_-]{20,}|[0-9a-f]{32,}|[0-9A-F]{32,})\b",
    "ipv6": r"(?<![\w:])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6})(?![\w:])",
    "iban": r"\b[A-Z]{2}\d{2}(?:(?: [A-Z0-9]{4}){3,7}(?: [A-Z0-9]{1,3})?|[A-Z0-9]{11,30})\b",
    "ipv4": rf"(?<![\w.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\w|\.\d)",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "card": r"(?<![\w-])(?:\d{13,19}|\d{4}(?P<gap>[ -])\d{4}(?P=gap)\d{4}(?P=gap)\d{4}|\d{4}[ -]\d{6}[ -]\d{5})(?![\w-])",
    "phone": r"(?<![\w+])(?:\+\d{1,3}(?:[ .-]?\(\d{1,5}\))?(?:[ .-]?\d{2,5}){2,5}|\(\d{3,5}\)[ .-]?\d{3,4}[ .-]\d{3,5}|\d{3}[.-]\d{3}[.-]\d{4})(?!\w)",
    # National forms: with spaces, and from a trunk zero on. Numbers that stand in a row of numbers are none.
    "national": r"(?<![\w+.,/-])(?<!\d )(?:\d{3} \d{3} \d{4}|0\d(?:[ .]\d{2}){4}|0\d{1,4}[ /-]\d{3,8}(?:[ -]\d{2,5}){0,3})(?![\w/]|[ .,-]?\d)",
    "person": rf"\b(?=[^\W\d_a-z])(?:(?P<title>{_ANY(MALE_TITLES + FEMALE_TITLES + TITLES)})\.?[ \u00a0]+(?P<first>{_NAME})(?:[ \u00a0](?P<last>{_NAME}))?"
    rf"|(?P<given>{_ANY(MALE_NAMES + FEMALE_NAMES)})[ \u00a0](?P<family>{_NAME})"
    rf"|(?:{_ANY(f'(?<={b})' for b in BEFORE_NAMES)})(?P<called>{_NAME})[ \u00a0](?P<surname>{_NAME}))(?!\w)",
}
_FIND = re.compile("|".join(f"(?P<{k}>{p})" for k, p in _PATTERNS.items()))
_DIGIT = re.compile("[0-9@]")
_CAPITAL = re.compile("[A-ZА-ЯΑ-Ω][^\\W_]*")
_NAMES = frozenset([*GENDER, *TITLES])
_SIGNS = (*(t for t in _NAMES if t[0].islower()), *BEFORE_NAMES)
_ASSIGNED = ("passw", "pwd", "token", "secret", "key")


def _hint(text: str) -> bool:
    """Whether anything can be found; cheap, as most texts hold nothing."""
    return bool(
        _DIGIT.search(text)
        or "::" in text
        or not _NAMES.isdisjoint(_CAPITAL.findall(text))
        or any(t in text for t in _SIGNS)
        or any(t in low for low in [text.lower()] for t in _ASSIGNED)
    )


def find(text: str | None) -> list[Span]:
    """Spans of the entities, ascending and without overlap."""
    if not text or not _hint(text):
        return []
    spans, people = [], {}
    for m in _FIND.finditer(text):
        kind, whole = m.lastgroup, m.group()
        kind = next(k for k in _PATTERNS if m.group(k) is not None)
        if kind == "email":
            local, _, domain = whole.rpartition("@")
            at = m.start() + len(local)
            spans.append(Span(m.start(), at, Entity("mailbox", domain.lower(), local.lower())))
            spans.append(Span(at + 1, m.end(), Entity("domain", "", domain.lower())))
        elif kind == "assigned":
            value = m.group("value")
            spans.append(Span(*m.span("value"), Entity("secret", "", _secret(value))))
        elif kind == "key":
            spans.append(Span(m.start(), m.end(), Entity("secret", "", _secret(whole))))
        elif kind == "person":
            gender = GENDER.get(m.group("title") or m.group("given"), "n")
            first, last = next(p for p in (("given", "family"), ("called", "surname"), ("first", "last")) if m.group(p[0]))
            if not (m.group(first)[0].isupper() and (m.group(last) or "X")[0].isupper()):
                continue
            if m.group(last):
                name = m.group(first)
                mine = Entity("given", script(name) + GENDER.get(name, gender), name.lower())
                spans.append(Span(*m.span(first), mine))
                people[name] = mine
            name = m.group(last) or m.group(first)
            if m.group(last) or name not in GENDER:
                mine = Entity("family", script(name), name.lower())
            else:
                mine = Entity("given", script(name) + GENDER[name], name.lower())
            spans.append(Span(*m.span(last if m.group(last) else first), mine))
            people[name] = mine
        elif kind in ("ipv4", "ipv6"):
            spans.append(Span(m.start(), m.end(), Entity(kind, "", whole.lower())))
        else:
            digits = re.sub(r"[\W_]", "", whole).upper()
            if kind == "phone" and not 7 <= len(digits) <= 15 or kind == "national" and not 9 <= len(digits) <= 12:
                continue
            kind = "phone" if kind == "national" else kind
            spans.append(Span(m.start(), m.end(), Entity(kind, "+" * (whole[0] == "+"), digits)))
    if people:
        # The same people named by one part of their name alone.
        taken = {s.start for s in spans}
        again = re.compile(rf"\b(?:{_ANY(sorted(map(re.escape, people), key=len, reverse=True))})\b")
        for m in again.finditer(text):
            if m.start() not in taken:
                spans.append(Span(m.start(), m.end(), people[m.group()]))
        spans = _apart(sorted(spans))
    return spans


def _apart(spans: list[Span]) -> list[Span]:
    kept: list[Span] = []
    for s in spans:
        if not kept or s.start >= kept[-1].end:
            kept.append(s)
    return kept


def _secret(value: str) -> str:
    """Hexadecimal keys are the same in either case."""
    return value.lower() if re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", value) else value


def script(word: str) -> str:
    """Script of the first letter: LATIN, CYRILLIC, GREEK, ..."""
    for c in word:
        if c.isalpha():
            return unicodedata.name(c, "LATIN").split()[0]
    return "LATIN"


# ---- surrogates ----

# Letters from which surrogate names are spelled, by script.
_SOUNDS = {
    "LATIN": ("bdfgklmnprstvz", "aeiou"),
    "CYRILLIC": ("бвгдзклмнпрст", "аеиоу"),
    "GREEK": ("βγδζκλμνπρστ", "αεηιο"),
}
# Endings that read as male, female or neither.
_ENDINGS = {
    "LATIN": {"m": ("n", "r", "s", "k"), "f": ("a", "ia", "ina", "elle"), "n": ("y", "is", "el", "in"), "": ("man", "ley", "ski", "ero")},
    "CYRILLIC": {"m": ("н", "р", "й", "л"), "f": ("а", "ия", "на", "я"), "n": ("и", "е", "у", "о"), "": ("ко", "ук", "ич", "ян")},
    "GREEK": {"m": ("ς", "ος", "ης", "ας"), "f": ("α", "ία", "ώ", "η"), "n": ("ι", "ω", "υ", "ο"), "": ("ίδης", "άκης", "ού", "έας")},
}
# Lower-case letters of scripts other than ASCII; letters elsewhere stay within their block of 32 code points.
_ALPHABETS = ((0xE0, 0xF6), (0xF8, 0xFE), (0x3B1, 0x3C1), (0x3C3, 0x3C9), (0x430, 0x44F), (0x5D0, 0x5EA), (0x3041, 0x3096), (0x30A1, 0x30FA))
_ALPHABETS += ((0x4E00, 0x9FA5), (0xAC00, 0xD7A3))


class _Stream:
    """Keyed numbers that depend on the entity and the attempt alone."""

    def __init__(self, key: bytes, entity: Entity, attempt: int):
        self.seed = "\x1f".join((*entity, str(attempt))).encode()
        self.key, self.block, self.bits = key, 0, 0
        self.left = 0

    def below(self, n: int) -> int:
        if self.left < n << 64:
            digest = hashlib.blake2b(self.seed + self.block.to_bytes(8, "big"), key=self.key).digest()
            self.bits, self.left, self.block = int.from_bytes(digest, "big"), 1 << 512, self.block + 1
        self.bits, chosen = divmod(self.bits, n)
        self.left //= n
        return chosen

    def of(self, choices):
        return choices[self.below(len(choices))]

    def like(self, c: str) -> str:
        """A character of the same class and script."""
        if c.isascii():
            if c.isdigit():
                return str(self.below(10))
            if c.islower():
                return chr(97 + self.below(26))
            return chr(65 + self.below(26)) if c.isupper() else c
        if not c.isalpha():
            return c
        lower = c.lower()
        if len(lower) == 1 and lower != c:
            return self.like(lower).upper()
        for low, high in _ALPHABETS:
            if low <= ord(c) <= high:
                return chr(low + self.below(high - low + 1))
        block = [d for d in map(chr, range(ord(c) & ~31, (ord(c) | 31) + 1)) if d.isalpha()]
        return self.of(block)


def surrogate(entity: Entity, attempt: int, key: bytes) -> str:
    """The replacement for `entity.norm`. Attempts give other values; after some the value may grow longer."""
    draw = _Stream(key, entity, attempt)
    make = _MAKERS.get(entity.kind, _digits)
    return make(entity, draw, attempt // 8)


def _digits(entity: Entity, draw: _Stream, grow: int) -> str:
    return "".join(draw.like(c) for c in entity.norm) + "".join(str(draw.below(10)) for _ in range(grow))


def _phone(entity: Entity, draw: _Stream, grow: int) -> str:
    """Keeps a country code's first digit, and a trunk zero."""
    keep = 1 if entity.scope == "+" or entity.norm[0] == "0" else 0
    return entity.norm[:keep] + _digits(entity._replace(norm=entity.norm[keep:]), draw, grow)


def _ssn(entity: Entity, draw: _Stream, grow: int) -> str:
    area = draw.below(898) + 1
    return f"{area + (area >= 666):03}{draw.below(99) + 1:02}{draw.below(9999) + 1:04}" + "0" * grow


def _luhn(digits: str) -> int:
    doubled = [int(d) * 2 if i % 2 else int(d) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10


def _card(entity: Entity, draw: _Stream, grow: int) -> str:
    """Keeps the first digit (the network) and whether the check digit is right."""
    norm = entity.norm
    body = norm[0] + "".join(str(draw.below(10)) for _ in range(len(norm) - 2 + grow))
    right = (10 - _luhn(body + "0")) % 10
    if _luhn(norm) == 0:
        return body + str(right)
    return body + str((right + 1 + draw.below(9)) % 10)


def _iban(entity: Entity, draw: _Stream, grow: int) -> str:
    """Keeps the country, and writes right check digits if they were."""

    def rest(text: str) -> int:
        return int("".join(str(int(c, 36)) for c in text)) % 97

    norm = entity.norm
    body = "".join(draw.like(c) for c in norm[4:]) + "".join(str(draw.below(10)) for _ in range(grow))
    if rest(norm[4:] + norm[:4]) == 1:
        return norm[:2] + f"{98 - rest(body + norm[:2] + '00'):02}" + body
    return norm[:2] + "".join(draw.like(c) for c in norm[2:4]) + body


# The private networks stay private, and no other address becomes one.
_PRIVATE = re.compile(r"10\.|127\.|192\.168\.|169\.254\.|172\.(?:1[6-9]|2\d|3[01])\.")


def _ipv4(entity: Entity, draw: _Stream, grow: int) -> str:
    """A private address stays in its network, and where that is full becomes one of 10.0.0.0/8, then any other; where
    these are full too, a port follows, with as many digits as it takes."""
    prefix = m.group() if (m := _PRIVATE.match(entity.norm)) else ""
    if prefix and grow > 1:
        prefix, entity = ("10." if grow == 2 else ""), entity._replace(norm="10.1.1.1")
    port = f":{draw.below(10 ** (grow - 4))}" if grow > 5 else ""
    while True:
        parts = []
        for octet in entity.norm[len(prefix) :].split("."):
            low, high = {1: (1, 9), 2: (10, 99), 3: (100, 254)}[len(octet)] if not grow else (1, 254)
            parts.append(str(low + draw.below(high - low + 1)))
        made = prefix + ".".join(parts)
        if prefix or not _PRIVATE.match(made):
            return made + port


def _ipv6(entity: Entity, draw: _Stream, grow: int) -> str:
    """Keeps the form, and where all addresses of a short form are taken is a full address."""
    if grow:
        return ":".join(f"{draw.below(1 << 16):04x}" for _ in range(8))
    return "".join("0123456789abcdef"[draw.below(16)] if c != ":" else c for c in entity.norm)


def _secret_like(entity: Entity, draw: _Stream, grow: int) -> str:
    norm = entity.norm
    if re.fullmatch(r"[0-9a-f]+", norm):
        return "".join("0123456789abcdef"[draw.below(16)] for _ in range(len(norm) + grow))
    keep = len(m.group()) if (m := re.match(r"AKIA|gh[pousr]_|sk-", norm)) else 0
    return norm[:keep] + "".join(map(draw.like, norm[keep:])) + "".join(chr(97 + draw.below(26)) for _ in range(grow))


def _mailbox(entity: Entity, draw: _Stream, grow: int) -> str:
    return "".join(map(draw.like, entity.norm)) + "".join(chr(97 + draw.below(26)) for _ in range(grow))


def _domain(entity: Entity, draw: _Stream, grow: int) -> str:
    labels, _, top = entity.norm.rpartition(".")
    return "".join(map(draw.like, labels)) + "".join(chr(97 + draw.below(26)) for _ in range(grow)) + "." + top


def _name(entity: Entity, draw: _Stream, grow: int) -> str:
    """A name that can be spoken, in the script; given names end as names of the gender do."""
    family = entity.kind == "family"
    writing = entity.scope if family else entity.scope[:-1]
    if writing not in _SOUNDS:
        return "".join(map(draw.like, entity.norm)) + "".join(draw.like(entity.norm[0]) for _ in range(grow))
    consonants, vowels = _SOUNDS[writing]
    endings = _ENDINGS[writing]["" if family else entity.scope[-1]]
    ending = draw.of(endings)
    body = "".join(draw.of(consonants) + draw.of(vowels) for _ in range(2 + family + grow))
    if ending[0] in "aeiouyαεηιοωυάέίώύαеиоуяаи":
        body = body[:-1]
    return body + ending


_MAKERS = {
    "phone": _phone, "ssn": _ssn, "card": _card, "iban": _iban, "ipv4": _ipv4, "ipv6": _ipv6, "secret": _secret_like,
    "mailbox": _mailbox, "domain": _domain, "given": _name, "family": _name,
}


def written(original: str, entity: Entity, value: str) -> str:
    """`value` in the way `original` writes its entity: separators and case of letters stay."""
    if entity.kind in ("given", "family"):
        return value.upper() if original.isupper() and len(original) > 1 else value[:1].upper() + value[1:]
    if entity.kind in ("phone", "ssn", "card", "iban"):
        rest = iter(value)
        return "".join(next(rest) if c.isalnum() else c for c in original) + "".join(rest)
    if original == entity.norm:
        return value
    if original.isupper():
        return value.upper()
    if entity.kind in ("mailbox", "domain") and len(value) == len(original):
        return "".join(v.upper() if c.isupper() else v for c, v in zip(original, value))
    return value
