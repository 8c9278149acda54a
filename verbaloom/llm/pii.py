"""Personal data in whole texts, disguised or not, by source offsets (operator 6)."""

from __future__ import annotations

import re
import unicodedata
import uuid
from bisect import bisect_right

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verbaloom.llm.common import quoted, with_text_columns

KINDS = ["email", "ip", "card", "phone"]
SPANS = "array<struct<kind: string, start: int, end: int, base: boolean>>"

# The identifiers' patterns. Possessive digits and the look-behind change no
# match; they keep long runs of digits linear.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")


def emails(text: str):
    """Spans of ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``, from each ``@`` back
    over the local part, so that long words cost no more than their length."""
    at, end = text.find("@"), 0
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at) if start < at else None
        if found:
            end = found.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def ips(text: str):
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") for p in m[0].split(".")]
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            yield m.span()


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def cards(text: str):
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            yield m.span()


def phones(text: str):
    for m in _PHONE.finditer(text):
        if 9 <= len(_DIGIT.findall(m[0])) <= 15:
            yield m.span()


def identifiers(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of a plain text, kinds as numbered in KINDS, then by start."""
    found = [(0, a, b) for a, b in emails(text)]
    if _DIGIT.search(text):
        for kind, detect in ((1, ips), (2, cards), (3, phones)):
            found.extend((kind, a, b) for a, b in detect(text))
    return found


# Letters of other scripts that look like Latin ones, in pairs.
LOOKALIKES = dict(
    zip(
        "АВЕЗКМНОРСТУХаеорсухіјѕԁԛԝѵΑΒΕΖΗΙΚΜΝΟΡΤΥΧανορτυχ",
        "ABE3KMHOPCTYXaeopcyxijsdqwvABEZHIKMNOPTYXavoptux",
    )
)
# Dashes, dots and at signs with another form; characters without width.
SIGNS = dict.fromkeys("‐‑‒–—−﹣", "-") | dict.fromkeys("․。｡﹒", ".") | {"﹫": "@"}
INVISIBLE = "­​‌‍⁠﻿"
# Digits as words, zero to nine, in four languages, and other spellings.
SPELLED = [
    "zero one two three four five six seven eight nine",
    "zéro un deux trois quatre cinq six sept huit neuf",
    "null eins zwei drei vier fünf sechs sieben acht neun",
    "cero uno dos tres cuatro cinco seis siete ocho nueve",
]
DIGIT_WORDS = {w: str(d) for line in SPELLED for d, w in enumerate(line.split())}
DIGIT_WORDS |= {"oh": "0", "une": "1", "ein": "1", "zwo": "2"}
# Words for the signs.
PLUS_WORDS = ["plus", "más", "mas"]
DOT_WORDS = ["dot", "point", "punkt", "punto"]
AT_WORDS = ["at", "arobase", "arroba", "ät"]

_words = "|".join(sorted(DIGIT_WORDS, key=len, reverse=True))
_dots, _ats, _plus = "|".join(DOT_WORDS), "|".join(AT_WORDS), "|".join(PLUS_WORDS)
# Four digit words or more in a row, with dots between some, perhaps after a plus.
_DIGIT_RUN = re.compile(
    rf"(?<!\w)(?:(?:{_plus}|\+)\s?)?(?:(?:{_words})(?:[\s,-]{{1,2}}(?:{_dots})[\s,-]{{1,2}}|[\s,-]{{1,2}}))"
    rf"{{3,}}(?:{_words})(?!\w)",
    re.IGNORECASE,
)
_RUN_PART = re.compile(rf"({_plus})|({_dots})|({_words})|[\s,-]+", re.IGNORECASE)
_OPEN, _SHUT = r"\s{0,2}[\[({<]\s?", r"\s?[\])}>]\s{0,2}"
_AT_SIGN = re.compile(rf"(?<=[\w.%+-]){_OPEN}(?:{_ats}|@){_SHUT}(?=\w)", re.IGNORECASE)
_DOT_SIGN = re.compile(rf"(?<=\w){_OPEN}(?:{_dots}|\.){_SHUT}(?=\w)", re.IGNORECASE)
# name at host dot com, with words or signs that stand apart; a sign or a dot word must be there.
# The part before the mark is read backwards from it, see _spoken_runs.
_AT_MARK = re.compile(rf"\s(?:{_ats})(?=\s)|\s?@", re.IGNORECASE)
_DOT_BEFORE = re.compile(rf"\s(?:{_dots})\s\Z", re.IGNORECASE)
_LONGEST_DOT = max(map(len, DOT_WORDS)) + 2
_SPOKEN_HOST = re.compile(rf"[A-Za-z0-9-]+(?:\s(?:{_dots})\s[A-Za-z0-9-]+)+(?!\w)", re.IGNORECASE)
_DOTTED_HOST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", re.IGNORECASE)
# Patterns that ignore case take these four as letters, too.
_DOTTED_LOCAL = _LOCAL | frozenset("\u0130\u0131\u017f\u212a")
_SPOKEN_LOCAL = _DOTTED_LOCAL - {"."}
_SPOKEN_PART = re.compile(rf"\s(?:({_ats})|({_dots}))\s|\s?@\s?", re.IGNORECASE)
_odd = "".join([*LOOKALIKES, *SIGNS, *INVISIBLE])
_ODD = re.compile(
    rf"[{re.escape(_odd)}！-～٠-٩۰-۹०-९\U0001d7ce-\U0001d7ff]"
)


def _plain(char: str) -> str:
    if char in LOOKALIKES or char in SIGNS:
        return LOOKALIKES.get(char) or SIGNS[char]
    if char in INVISIBLE:
        return ""
    digit = unicodedata.decimal(char, None)
    return str(digit) if digit is not None else chr(ord(char) - 0xFEE0)


class Tape:
    """A rewritten text that knows where its characters come from.

    Each rewriting keeps its edits alone, so long texts cost no more than a copy.
    """

    def __init__(self, text: str):
        self.text = text
        self.layers: list[tuple[list[int], list[tuple[int, int, int]]]] = []

    def rewrite(self, edits: list[tuple[int, int, str]]) -> None:
        """Apply (start, end, replacement) edits, in order and apart. The characters of a
        replacement all stand for the whole source of what they replace."""
        texts, begins, ends, at, size = [], [], [], 0, 0
        for a, b, new in edits:
            texts += [self.text[at:a], new]
            size += a - at
            begins.append(size)
            size += len(new)
            ends.append((size, a, b))
            at = b
        self.text = "".join([*texts, self.text[at:]])
        self.layers.append((begins, ends))

    def source(self, start: int, end: int) -> tuple[int, int]:
        """The span of the first text that a span of this one stands for."""
        first, last = start, end - 1
        for begins, ends in reversed(self.layers):
            first = self._below(begins, ends, first, False)
            last = self._below(begins, ends, last, True)
        return first, last + 1

    @staticmethod
    def _below(begins, ends, at: int, is_last: bool) -> int:
        i = bisect_right(begins, at) - 1
        if i < 0:
            return at
        end, a, b = ends[i]
        if at >= end:
            return b + at - end
        return b - 1 if is_last else a


def _lookalike_edits(text: str):
    return [(m.start(), m.end(), _plain(m[0])) for m in _ODD.finditer(text)]


def _digit(word: str) -> str:
    # Patterns that ignore case also take a long s, and an i without or with its dot.
    return DIGIT_WORDS[word.casefold().replace("i\u0307", "i").replace("\u0131", "i")]


def _digit_edits(text: str):
    for run in _DIGIT_RUN.finditer(text):
        for m in _RUN_PART.finditer(text, run.start(), run.end()):
            new = "+" if m[1] else "." if m[2] else _digit(m[3]) if m[3] else ""
            yield m.start(), m.end(), new


def _sign_edits(text: str):
    edits = [(m.start(), m.end(), "@") for m in _AT_SIGN.finditer(text)]
    edits += [(m.start(), m.end(), ".") for m in _DOT_SIGN.finditer(text)]
    return sorted(edits)


def _name_start(text: str, at: int, floor: int, chars: frozenset[str]) -> int:
    while at > floor and text[at - 1] in chars:
        at -= 1
    return at


def _starts_word(text: str, at: int) -> bool:
    before = text[at - 1 : at]
    return not before.isalnum() and before not in _DOTTED_LOCAL


def _spoken_start(text: str, at: int, floor: int) -> int | None:
    """The first start, not before ``floor``, of a name that ends at ``at``: any number of
    parts with dots or dot words between them."""
    start = None
    while (part := _name_start(text, at, floor, _SPOKEN_LOCAL)) < at:
        if _starts_word(text, part):
            start = part
        if text[part - 1 : part] == ".":
            at = part - 1
        elif dot := _DOT_BEFORE.search(text, max(floor, part - _LONGEST_DOT), part):
            at = dot.start()
        else:
            break
    return start


def _spoken_runs(text: str):
    """Spoken addresses: from each at mark, the host after it, then the name before it. An
    address does not reach back over an earlier one, so that long texts stay linear."""
    floor = 0
    mark = _AT_MARK.search(text)
    while mark:
        at, after = mark.span()
        is_spaced = text[after : after + 1].isspace()
        start = None
        if host := _SPOKEN_HOST.match(text, after + is_spaced):
            start = _spoken_start(text, at, floor)
        elif is_spaced and after - at == 2 and text[after - 1] == "@":
            if host := _DOTTED_HOST.match(text, after + 1):
                part = _name_start(text, at, floor, _DOTTED_LOCAL)
                start = part if part < at and _starts_word(text, part) else None
        if start is not None:
            floor = host.end()
            yield start, floor
        mark = _AT_MARK.search(text, max(after, floor))


def _spoken_edits(text: str):
    for start, end in _spoken_runs(text):
        for m in _SPOKEN_PART.finditer(text, start, end):
            yield m.start(), m.end(), "." if m[2] else "@"


def disguised(text: str, hints: bool = True) -> list[tuple[int, int, int]]:
    """Identifiers of the text after the transducers, as spans of the source. Without
    ``hints`` no transducer is left out; the spans are the same."""
    tape = None
    for hint, step in _STEPS:
        plain = text if tape is None else tape.text
        edits = list(step(plain)) if not hints or hint.search(plain) else []
        if edits:
            tape = tape or Tape(text)
            tape.rewrite(edits)
    if tape is None:
        return []
    return [(k, *tape.source(a, b)) for k, a, b in identifiers(tape.text)]


# Each transducer with a cheap pattern that is found wherever the transducer finds anything,
# as it is a part of each of its matches: the second of four digit words stands after a
# separator and before one and a word; a sign stands in brackets; a spoken address has a dot
# word or an @ between white space.
_STEPS = [
    (_ODD, _lookalike_edits),
    (
        re.compile(rf"[\s,-](?:{_words})[\s,-]{{1,2}}(?:{_words}|{_dots})", re.IGNORECASE),
        _digit_edits,
    ),
    (re.compile(rf"[\[({{<]\s?(?:{_ats}|{_dots}|@|\.)\s?[\])}}>]", re.IGNORECASE), _sign_edits),
    (re.compile(rf"\s(?:{_dots}|@)\s", re.IGNORECASE), _spoken_edits),
]


def find_spans(text: str) -> list[tuple[str, int, int, bool]]:
    base = identifiers(text)
    held = {k: [(a, b) for kind, a, b in base if kind == k] for k in range(len(KINDS))}
    added = [
        (k, a, b)
        for k, a, b in disguised(text)
        if not any(a < d and c < b for c, d in held[k])
    ]
    spans = [(*s, True) for s in base] + [(*s, False) for s in set(added)]
    return [(KINDS[k], a, b, is_base) for k, a, b, is_base in sorted(spans)]


def with_pii(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with pii: the spans (kind, start, end, base) of e-mail and IP addresses, card
    and phone numbers, in code points of the source text, by kind and start.

    ``base`` spans match the plain patterns. The others are found after transducers have
    put look-alike characters, digits spelled in words and at/dot disguises into plain
    form; they are mapped back to the characters they came from, and left out where they
    overlap a base span of their kind. A null or empty text has none. Repeated rows are
    read each, an earlier column ``pii`` is replaced, texts of any length are read whole.
    No shuffle.
    """
    fields = T.StructType([T.StructField("pii", T._parse_datatype_string(SPANS))])
    names = ("kind", "start", "end", "base")

    def make(texts):
        return [[[dict(zip(names, s)) for s in find_spans(t)] for t in texts]]

    return with_text_columns(df, text, fields, make)


def redact(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with every span of personal data in ``text`` replaced by its kind in angle
    brackets. Spans that overlap are one, named after the first. Null texts stay null, empty
    ones empty; repeated rows and other columns, whatever their names, stay as they are."""

    def make(texts):
        return [[redacted(t) for t in texts]]

    name = f"redacted_{uuid.uuid4().hex}"
    fields = T.StructType([T.StructField(name, T.StringType())])
    made = with_text_columns(df, text, fields, make)
    kept = F.when(F.col(text).isNotNull(), F.col(name))
    return made.withColumn(text, kept).select(*quoted(df.columns))


def redacted(text: str) -> str:
    out, at = [], 0
    for start, end, kind in sorted((a, b, k) for k, a, b, _ in find_spans(text)):
        if start >= at:
            out += [text[at:start], f"<{kind.upper()}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])
