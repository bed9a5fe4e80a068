"""Personal data in texts, also when disguised, with positions in the source.

Plain identifiers are found in the text as it stands. A text with signs of a disguise
is also normalised by a chain of transducers: look-alike and zero-width
characters, spelled digits, and disguised at signs and dots. Each rewrites a tape and
remembers which parts of it came from where, so an identifier found on the last tape is
mapped back to the source. Spans that the plain search has already covered are not
repeated. A plain fragment of a disguised identifier, as the end of an address with one
look-alike letter, stays a span beside the whole. A bare "at" before a plain domain counts
only if what stands before it looks like a mailbox or a word nearby speaks of one.

Positions are code points, the end exclusive. A null text counts as empty; repeated
rows are searched each; very long texts are searched whole, in time that grows with
their length; an empty table gives an empty result; other columns are
ignored.
"""

import re
import sys
import unicodedata
from bisect import bisect_right
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from daybook.llm.common import column, ship_library

KINDS = ("email", "ip", "card", "phone")
SPAN = "array<struct<kind:string,start:bigint,end:bigint,plain:boolean,value:string>>"

Span = tuple[int, int]

# Plain identifiers

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# Digits before a run's first can't start a match where the run's first can't.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NO_DIGIT = re.compile("[^0-9]+")


def find_emails(text: str) -> Iterator[Span]:
    """Leftmost longest addresses, looking back from each at sign.

    Trying a match at every character would take quadratic time in long words.
    """
    done = 0
    at = text.find("@")
    while at >= 0:
        domain = _DOMAIN.match(text, at + 1)
        start = at
        while domain and start > done and text[start - 1] in _LOCAL:
            start -= 1
        if domain and start < at:
            yield start, domain.end()
            done = domain.end()
        at = text.find("@", max(done, at + 1))


def find_ips(text: str) -> Iterator[Span]:
    for match in _IP.finditer(text):
        parts = [part.lstrip("0") for part in match.group().split(".")]
        if all(len(part) <= 3 and int(part or "0") <= 255 for part in parts):
            yield match.span()


def passes_luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def find_cards(text: str) -> Iterator[Span]:
    for match in _CARD.finditer(text):
        if 16 <= match.end() - match.start():
            digits = _NO_DIGIT.sub("", match.group())
            if 16 <= len(digits) <= 19 and passes_luhn(digits):
                yield match.span()


def find_phones(text: str) -> Iterator[Span]:
    for match in _PHONE.finditer(text):
        if 8 <= len(_NO_DIGIT.sub("", match.group())) <= 15:
            yield match.span()


FINDERS: dict[str, Callable[[str], Iterator[Span]]] = {
    "email": find_emails,
    "ip": find_ips,
    "card": find_cards,
    "phone": find_phones,
}

# Disguises

# Letters of other scripts that look like Latin ones.
LOOK_ALIKES = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k",
    "м": "m", "н": "h", "о": "o", "р": "p", "ѕ": "s", "т": "t", "у": "y", "х": "x", "ԛ": "q",
    "ԝ": "w", "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P",
    "С": "C", "Т": "T", "Х": "X", "І": "I", "Ј": "J", "Ѕ": "S", "α": "a", "ο": "o", "ρ": "p",
    "ν": "v", "ι": "i", "κ": "k", "τ": "t", "υ": "u", "χ": "x", "ε": "e", "Α": "A", "Β": "B",
    "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P",
    "Τ": "T", "Υ": "Y", "Χ": "X", "ı": "i", "ɡ": "g", "ɑ": "a", "。": ".", "‐": "-", "‑": "-",
    "‒": "-", "–": "-", "—": "-", "−": "-", " ": " ", " ": " ", " ": " ",
}
ZERO_WIDTH = ("​", "‌", "‍", "⁠", "﻿", "­")
# Spelled digits.
DIGIT_WORDS = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5",
    "six": "6", "seven": "7", "eight": "8", "nine": "9",
}


@cache
def _characters() -> dict[str, str]:
    """Every character that stands for an ASCII one: listed, or compatible with it."""
    table = {}
    for code in range(0x80, sys.maxunicode + 1):
        character = chr(code)
        # Superscripts, ordinals and the like are ordinary writing in Latin-1.
        if code >= 0x100 and unicodedata.decomposition(character).startswith("<"):
            plain = unicodedata.normalize("NFKC", character)
            if len(plain) == 1 and plain.isascii():
                table[character] = plain
        elif code >= 0x100 and (digit := unicodedata.decimal(character, None)) is not None:
            table[character] = str(digit)
    return table | LOOK_ALIKES | dict.fromkeys(ZERO_WIDTH, "")


@dataclass
class Edits:
    """What a transducer rewrote, in order: where each output lies, and the part of the input it came from.

    Between edits, output and input run side by side, so this grows with the number of
    edits and not with the text.
    """

    out_starts: list[int]
    out_ends: list[int]
    in_starts: list[int]
    in_ends: list[int]

    def input(self, start: int, end: int) -> Span:
        """The part of the input that output from start to end came from."""
        first, last = bisect_right(self.out_starts, start) - 1, bisect_right(self.out_starts, end - 1) - 1
        if first >= 0:
            inside = start < self.out_ends[first]
            start = self.in_starts[first] if inside else start - self.out_ends[first] + self.in_ends[first]
        if last >= 0:
            inside = end <= self.out_ends[last]
            end = self.in_ends[last] if inside else end - self.out_ends[last] + self.in_ends[last]
        return start, end


@dataclass
class Tape:
    """A text and the edits that led to it from the source."""

    text: str
    history: list[Edits]

    def source(self, start: int, end: int) -> Span:
        for edits in reversed(self.history):
            start, end = edits.input(start, end)
        return start, end


@dataclass
class Transducer:
    """Replaces each match of a pattern that a condition accepts; the output came from the whole match."""

    pattern: re.Pattern
    output: Callable[[re.Match], str]
    accepts: Callable[[re.Match], bool] = lambda match: True

    def __call__(self, tape: Tape) -> Tape:
        text, done, size, edits = [], 0, 0, Edits([], [], [], [])
        for match in self.pattern.finditer(tape.text):
            start, end = match.span()
            if start == end or not self.accepts(match):
                continue
            new = self.output(match)
            text += tape.text[done:start], new
            size += start - done
            edits.out_starts.append(size)
            size += len(new)
            edits.out_ends.append(size)
            edits.in_starts.append(start)
            edits.in_ends.append(end)
            done = end
        if not edits.out_starts:
            return tape
        text.append(tape.text[done:])
        return Tape("".join(text), [*tape.history, edits])


_WORD = "|".join(DIGIT_WORDS)
# A single digit word is a digit only beside a spelled dot or digits.
_SPELLED = (
    rf"\b(?:{_WORD})(?:[ \t]*[-,]?[ \t]*(?:{_WORD})\b)+"
    rf"|\b(?:{_WORD})(?=\s+dot\s)|(?<=\sdot\s)(?:{_WORD})\b"
    rf"|(?:(?<=[0-9])|(?<=[0-9][ \t.,()-]))(?:{_WORD})(?![A-Za-z])"
    rf"|(?<![A-Za-z])(?:{_WORD})(?=[ \t.,()-]?[0-9])"
)
_AT = r"\s{0,3}[\[({<]\s{0,3}(?:at|@)\s{0,3}[\])}>]\s{0,3}"
_DOT = r"\s{0,3}[\[({<]\s{0,3}(?:dot|\.)\s{0,3}[\])}>]\s{0,3}|(?<=[A-Za-z0-9])\s{1,3}dot\s{1,3}(?=[A-Za-z0-9])"
# A bare "at" counts only where the domain after it had a disguised dot.
_MARKED_DOT = "\x00"
_BARE_AT = rf"(?<=[A-Za-z0-9])\s{{1,3}}at\s{{1,3}}(?=[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*{_MARKED_DOT})"

# Before a plain domain with one of these endings (fixed values), a bare "at" counts where what
# stands before it looks like a mailbox, or a word nearby speaks of one.
_ENDINGS = "com|org|net|edu|gov|info|io|co|uk|de|fr|es|eu"
_PLAIN_AT = rf"(?<=[A-Za-z0-9])\s{{1,3}}at\s{{1,3}}(?=[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.(?:{_ENDINGS})\b)"
_MAILBOX = re.compile(r"[A-Za-z0-9%+-]*(?:[._][A-Za-z0-9]|[0-9])[A-Za-z0-9._%+-]*\Z")
_CUE = re.compile(r"\b(?:e-?mail|mail|mailbox|contact|write to|reach|address)\b[^.!?\n]*\Z", re.IGNORECASE)
_NEARBY = 64


def _names_a_mailbox(match: re.Match) -> bool:
    before = match.string[max(0, match.start() - _NEARBY) : match.start()]
    return _MAILBOX.search(before) is not None or _CUE.search(before) is not None


def _digits(match: re.Match) -> str:
    words = re.findall(_WORD, match.group(), re.IGNORECASE)
    return "".join(DIGIT_WORDS[word.lower()] for word in words)


def _fold(text: str) -> Transducer:
    """For the look-alikes in this text; a class of all of them would be slow."""
    table = _characters()
    present = sorted(table.keys() & set(text))
    pattern = re.compile(f"[{''.join(map(re.escape, present))}]" if present else r"(?!)")
    return Transducer(pattern, lambda m: table[m.group()])


_CHAIN = [
    Transducer(re.compile(rf"\bplus\s+(?=[0-9]|{_WORD})", re.IGNORECASE), lambda m: "+"),
    Transducer(re.compile(_SPELLED, re.IGNORECASE), _digits),
    Transducer(re.compile(_AT, re.IGNORECASE), lambda m: "@"),
    Transducer(re.compile(_DOT, re.IGNORECASE), lambda m: _MARKED_DOT),
    Transducer(re.compile(_BARE_AT, re.IGNORECASE), lambda m: "@"),
    Transducer(re.compile(_MARKED_DOT), lambda m: "."),
    Transducer(re.compile(_PLAIN_AT, re.IGNORECASE), lambda m: "@", _names_a_mailbox),
]
_BRACKETS = re.compile(r"[\[({<]\s{0,3}(?:at|@|dot|\.)\s{0,3}[\])}>]")
_TWO_DIGITS = re.compile(rf"(?:{_WORD})[ \t]*[-,]?[ \t]*(?:{_WORD})")
_SPACED_AT = re.compile(_PLAIN_AT)
_BY_DIGITS = re.compile(rf"[0-9][ \t.,()-]?(?:{_WORD})|(?:{_WORD})[ \t.,()-]?[0-9]")


def has_signs(text: str) -> bool:
    """Whether a transducer might rewrite something that matters."""
    if not text.isascii() and not _characters().keys().isdisjoint(set(text)):
        return True
    lowered = text.lower()
    return (
        "dot" in lowered
        or "plus" in lowered
        or _BRACKETS.search(lowered) is not None
        or _TWO_DIGITS.search(lowered) is not None
        or _BY_DIGITS.search(lowered) is not None
        or _SPACED_AT.search(lowered) is not None
    )


def normalise(text: str) -> Tape:
    tape = Tape(text.replace(_MARKED_DOT, " "), [])
    for transducer in [_fold(text), *_CHAIN]:
        tape = transducer(tape)
    return tape


def find_spans(text: str) -> list[tuple[str, int, int, bool, str]]:
    """(kind, start, end, plain, value) in order of kind and start.

    value is the identifier as normalised; for a plain one, the text itself.
    """
    tape = normalise(text) if has_signs(text) else None
    spans = []
    for kind, find in FINDERS.items():
        plain = list(find(text))
        found = [(start, end, True, text[start:end]) for start, end in plain]
        if tape is not None:
            # Plain spans are sorted and apart: only the last that starts in time can hold another.
            starts = [start for start, _ in plain]
            for start, end in find(tape.text):
                first, last = tape.source(start, end)
                before = bisect_right(starts, first) - 1
                if before < 0 or last > plain[before][1]:
                    found.append((first, last, False, tape.text[start:end]))
        spans += [(kind, *span) for span in sorted(found)]
    return spans


def find_pii(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id and the spans found in the whole text."""
    ship_library(docs.sparkSession)
    names = ["kind", "start", "end", "plain", "value"]

    @F.pandas_udf(SPAN)
    def spans(texts: pd.Series) -> pd.Series:
        return pd.Series(
            [[dict(zip(names, span)) for span in find_spans(value or "")] for value in texts],
            dtype=object,
        )

    return docs.select(column(doc_id).alias("doc_id"), spans(column(text)).alias("spans"))


def count_of(kind: str, spans: str = "spans") -> Column:
    return F.size(F.filter(F.col(spans), lambda s: s["kind"] == kind)).cast("long")


def listed(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )
