"""Personal data in texts, plain or disguised, with offsets into the source."""

import re
import sys
import unicodedata
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tapeline.llm.common import fresh, rows_per_batch

KINDS = ("email", "ip", "card", "phone")
SPAN_TYPE = "array<struct<kind:string,start:int,end:int,base:boolean,value:string>>"

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DIGIT = re.compile(r"[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]")
# a match can't start within a run of digits: one from its start would have been found
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done = 0
    sign = text.find("@")
    while sign >= 0:
        start = sign
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, sign + 1) if start < sign else None
        if found:
            done = found.end()
            yield start, done
        sign = text.find("@", max(done, sign + 1))


def luhn(digits: str) -> bool:
    total = 0
    for at, digit in enumerate(reversed(digits)):
        value = int(digit) << (at & 1)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def find(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the plain identifiers of a text, by start, then kind as listed."""
    spans = [(a, b, 0) for a, b in _emails(text)]
    if _DIGIT.search(text):
        for match in _IP.finditer(text):
            # longer parts than three digits are within 255 only after leading zeros
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in match[0].split(".")):
                spans.append((*match.span(), 1))
        for match in _CARD.finditer(text):
            digits = _NOT_DIGIT.sub("", match[0])
            if 12 <= len(digits) <= 19 and luhn(digits):
                spans.append((*match.span(), 2))
        for match in _PHONE.finditer(text):
            if 9 <= len(_NOT_DIGIT.sub("", match[0])) <= 15:
                spans.append((*match.span(), 3))
    return [(a, b, KINDS[k]) for a, b, k in sorted(spans, key=lambda s: (s[0], s[2]))]


@dataclass
class Mapped:
    """A text and, for each of its characters, the source range it came from."""

    text: str
    start: np.ndarray
    end: np.ndarray

    @classmethod
    def of(cls, text: str) -> "Mapped":
        at = np.arange(len(text), dtype=np.int64)
        return cls(text, at, at + 1)

    def rewrite(self, edits: list[tuple[int, int, str]]) -> "Mapped":
        """Replace ranges (start, end, new text), in order and without overlap."""
        texts, starts, ends, last = [], [], [], 0
        for a, b, new in [*edits, (len(self.text), len(self.text), "")]:
            texts += [self.text[last:a], new]
            starts += [self.start[last:a]]
            ends += [self.end[last:a]]
            if new:
                starts.append(np.full(len(new), self.start[a]))
                ends.append(np.full(len(new), self.end[b - 1]))
            last = b
        return Mapped("".join(texts), np.concatenate(starts), np.concatenate(ends))


#: fixed values: letters of other scripts that look like ASCII ones
_LOOKALIKES = dict(
    zip(
        "АВЕКМНОРСТУХЅІЈаеорсухѕіјԁԛԝһΑΒΕΖΗΙΚΜΝΟΡΤΥΧαινορυχ",
        "ABEKMHOPCTYXSIJaeopcyxsijdqwhABEZHIKMNOPTYXaivopux",
        strict=True,
    )
)
_INVISIBLE = dict.fromkeys("­​‌‍⁠﻿", "")
_OTHER_SIGNS = {"․": ".", "。": ".", "｡": ".", "‐": "-", "‑": "-", "‒": "-", "–": "-", " ": " ", " ": " ", " ": " "}
#: the zeros of all scripts; the other nine decimal digits follow each
_ZEROS = [c for c in range(0x80, sys.maxunicode + 1) if unicodedata.decimal(chr(c), None) == 0]
_DISGUISED = re.compile(
    "["
    + "".join({**_LOOKALIKES, **_INVISIBLE, **_OTHER_SIGNS})
    + "".join(f"{chr(zero)}-{chr(zero + 9)}" for zero in _ZEROS)
    + "²³¹⁰-₎①-⑳！-～"
    + "\U0001d400-\U0001d7ff]"
)


def _plain_character(character: str) -> str:
    """The ASCII character that one stands for, or itself; invisible ones give nothing."""
    for known in (_LOOKALIKES, _INVISIBLE, _OTHER_SIGNS):
        if character in known:
            return known[character]
    digit = unicodedata.digit(character, None)
    if digit is not None:
        return str(digit)
    plain = unicodedata.normalize("NFKC", character)
    return plain if len(plain) == 1 and plain.isascii() else character


def homoglyphs(source: Mapped) -> list[tuple[int, int, str]]:
    if source.text.isascii():
        return []
    found = ((m.start(), m.end(), _plain_character(m[0])) for m in _DISGUISED.finditer(source.text))
    return [(a, b, new) for a, b, new in found if new != source.text[a:b]]


_LETTER, _NO_WORD_BEFORE, _NO_WORD_AFTER = r"[^\W\d_]", r"(?<![^\W_])", r"(?![^\W_])"

#: letters that stand for digits where all else in a word is digits
_DIGIT_LETTERS = {"O": "0", "o": "0", "l": "1", "I": "1"}
_MIXED_HINT = re.compile(r"[0-9](?:(?=[OolI])|(?<=[OolI][0-9]))")
_MIXED = re.compile(rf"{_NO_WORD_BEFORE}(?=[OolI]*[0-9])(?=[0-9]*[OolI])[0-9OolI]+{_NO_WORD_AFTER}")


def digit_letters(source: Mapped) -> list[tuple[int, int, str]]:
    """``O49`` and ``l51``: O and l beside digits in a word of nothing else become digits."""
    if not _MIXED_HINT.search(source.text):
        return []
    found = (m.start() + i for m in _MIXED.finditer(source.text) for i, c in enumerate(m[0]) if c in _DIGIT_LETTERS)
    return [(at, at + 1, _DIGIT_LETTERS[source.text[at]]) for at in found]


#: fixed values: the digits in English, German, French and Spanish, and English tens
_NUMBER_WORDS = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4",
    "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9",
    "null": "0", "eins": "1", "zwei": "2", "zwo": "2", "drei": "3", "vier": "4",
    "fünf": "5", "sechs": "6", "sieben": "7", "acht": "8", "neun": "9",
    "zéro": "0", "un": "1", "deux": "2", "trois": "3", "quatre": "4",
    "cinq": "5", "sept": "7", "huit": "8", "neuf": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4",
    "cinco": "5", "seis": "6", "siete": "7", "ocho": "8", "nueve": "9",
    "ten": "10", "eleven": "11", "twelve": "12", "thirteen": "13", "fourteen": "14", "fifteen": "15",
    "sixteen": "16", "seventeen": "17", "eighteen": "18", "nineteen": "19", "twenty": "20", "thirty": "30",
    "forty": "40", "fifty": "50", "sixty": "60", "seventy": "70", "eighty": "80", "ninety": "90",
}
_REPEATS = {"double": 2, "triple": 3, "doppel": 2, "doble": 2}
_POINT_WORDS = frozenset(("dot", "point", "punkt", "punto"))


def _any_of(words: Iterable[str]) -> str:
    """A pattern of the words, longest first; first letters are told apart before the rest."""
    by_first: dict[str, list[str]] = {}
    for word in sorted(words, key=len, reverse=True):
        by_first.setdefault(word[0], []).append(word[1:])
    return "|".join(f"{first}(?:{'|'.join(rest)})" for first, rest in by_first.items())


_NUMBER = _any_of(_NUMBER_WORDS)
_POINTS = "|".join(sorted(_POINT_WORDS))
_GAP = r"[\s-]+"
_WORD = rf"{_NO_WORD_BEFORE}(?:(?:{'|'.join(_REPEATS)}){_GAP})?(?:{_NUMBER}){_NO_WORD_AFTER}"
#: words may also have a comma between them
_COMMA = rf"(?<=[^\W\d_])\s*,\s*(?={_WORD})"
_HAS_NUMBER = re.compile(rf"(?i){_WORD}")
_SPELLED = re.compile(
    rf"(?i)(?:\bplus{_GAP}(?=(?:{_NUMBER}){_NO_WORD_AFTER}|[0-9]))?(?:{_WORD}|{_NO_WORD_BEFORE}[0-9]+)"
    rf"(?:(?:{_GAP}|{_COMMA})(?:{_WORD}|[0-9]+{_NO_WORD_AFTER}))+"
)
_ONE = rf"(?:{_WORD}|(?<![0-9])[0-9](?![0-9]))"
_TWO = r"(?<![0-9])[0-9]{2}(?![0-9])"
#: up to three digits in several parts, or digits in one
_OCTET = rf"(?:{_ONE}(?:{_GAP}{_ONE}){{2}}|{_ONE}{_GAP}{_TWO}|{_TWO}{_GAP}{_ONE}|{_ONE}{_GAP}{_ONE}|{_ONE}|(?<![0-9])[0-9]+(?![0-9]))"
_POINT = rf"(?:\.|{_GAP}(?:{_POINTS}){_GAP})"
_SPELLED_IP = re.compile(rf"(?i)(?:\bplus{_GAP})?{_OCTET}(?:{_POINT}{_OCTET}){{3}}")
#: what a lower-cased text holds if _SPELLED or _SPELLED_IP finds a number word in it: one of the
#: words, beside another, a digit or a point, and for an address three points
_SOME_WORDS = re.compile("[a-zéü]+")
_BESIDE = re.compile(
    rf"(?:{_NUMBER})(?:[\s-]+|\s*,\s*|\.|{_GAP}(?:{_POINTS}){_GAP})(?:{_NUMBER}|{'|'.join(_REPEATS)}|[0-9])"
    rf"|[0-9](?:[\s-]+|\.|{_GAP}(?:{_POINTS}){_GAP})(?:(?:{'|'.join(_REPEATS)}){_GAP})?(?:{_NUMBER})"
)
_SOME_POINTS = re.compile(rf"[^\W_]\.(?=[^\W_])|{_POINTS}")
_PART = re.compile(rf"{_LETTER}+|[0-9]+|[\s,-]+|\.")


def _digits(words: list[str]) -> Iterator[tuple[int, str]]:
    """(place, text) of what each of the words and digits of a run becomes."""
    times = 1
    parts = [(i, w.lower()) for i, w in enumerate(words) if w[0] not in " ,-" and not w[0].isspace()]
    for at, (i, word) in enumerate(parts):
        following = _NUMBER_WORDS.get(parts[at + 1][1], "") if at + 1 < len(parts) else ""
        if word in _REPEATS:
            times = _REPEATS[word]
            yield i, ""
            continue
        if word in _NUMBER_WORDS:
            number = _NUMBER_WORDS[word]
            if len(number) == 2 and number[0] > "1" and len(following) == 1 and following != "0":
                number = number[0]  # twenty one
            yield i, number * times
        elif word in _POINT_WORDS:
            yield i, "."
        else:
            yield i, "+" if word == "plus" else word
        times = 1


def _spelled_addresses(text: str) -> Iterator[re.Match]:
    """Four octets with a number word, each at most 255, in order and without overlap."""
    for match in _SPELLED_IP.finditer(text):
        if _HAS_NUMBER.search(match[0]):
            plain = "".join(new for _, new in _digits([p[0] for p in _PART.finditer(match[0])]) if new != "+")
            octets = [o.lstrip("0") for o in plain.split(".")]
            if len(octets) == 4 and all(len(o) <= 3 and int(o or 0) <= 255 for o in octets):
                yield match


def _spelled_edits(match: re.Match) -> Iterator[tuple[int, int, str]]:
    parts = list(_PART.finditer(match[0]))
    becomes = dict(_digits([p[0] for p in parts]))
    for at, part in enumerate(parts):
        new = becomes.get(at, "")
        if new != part[0]:
            yield match.start() + part.start(), match.start() + part.end(), new


def spelled_digits(source: Mapped) -> list[tuple[int, int, str]]:
    """Runs with a spelled digit become digits; ``plus`` before one becomes a sign.

    Words may be of any of the languages, doubled, or tens, with white space, hyphens or commas
    between them. An address may have octets of one word, with points written out between them.
    """
    text, edits, last = source.text, [], 0
    lowered = text.lower()
    if _NUMBER_WORDS.keys().isdisjoint(_SOME_WORDS.findall(lowered)) or not _BESIDE.search(lowered):
        return edits
    pointed = len(_SOME_POINTS.findall(lowered)) >= 3
    for address in [*(_spelled_addresses(text) if pointed else ()), None]:
        for match in _SPELLED.finditer(text, last, address.start() if address else len(text)):
            if _HAS_NUMBER.search(match[0]):
                edits += _spelled_edits(match)
        if address:
            edits += _spelled_edits(address)
            last = address.end()
    return edits


_AT_WORDS = "arroba|arobase|klammeraffe"
_DOT_TOKEN = rf"(?:{_POINTS}|\.)"
_IN_BRACKETS = r"[\[({{<]\s*(?:{0})\s*[\])}}>]"
#: what a lower-cased text holds if _AT finds something in it
_AT_PARTS = (*_POINT_WORDS, *_AT_WORDS.split("|"), "_at_")
_AT_PART = re.compile(rf"(?:{_POINTS}|{_AT_WORDS})(?=[\s\])}}>_])|_at_")
_AT_SIGNS = re.compile(r"[\[({<]\s*(?:at|[@.])\s*[\])}>]|[0-9]\s+\.\s+[0-9]")
#: what a written-out domain looks like after a bare ``at``
_DOMAIN_AHEAD = rf"(?=[0-9A-Za-z-]+(?:\s+(?:{_POINTS})\s+|\s*{_IN_BRACKETS.format(_DOT_TOKEN)}\s*)[A-Za-z])"
_AT = re.compile(
    rf"(?i)(?P<at>{_IN_BRACKETS.format(f'at|@|{_AT_WORDS}')})"
    rf"|(?P<dot>{_IN_BRACKETS.format(_DOT_TOKEN)})"
    r"|(?<=[0-9A-Za-z])\s+(?P<word>dot|punkt|punto)\s+(?=[0-9A-Za-z])"
    rf"|(?<=[0-9A-Za-z])\s+(?P<point>point)\s+(?=(?:fr|be|ch|com|org|net|eu){_NO_WORD_AFTER})"
    r"|(?<=[0-9])\s+(?P<spaced>\.)\s+(?=[0-9])"
    rf"|(?<=[0-9A-Za-z])\s+(?P<known>{_AT_WORDS})\s+(?=[0-9A-Za-z])"
    rf"|(?<=[0-9A-Za-z])\s+(?P<bare>at)\s+{_DOMAIN_AHEAD}"
    r"|(?<=[0-9A-Za-z])_(?P<low_at>at)_(?=[0-9A-Za-z-]+_(?:dot|punkt|punto)_[A-Za-z])"
    r"|(?<=[0-9A-Za-z])_(?P<low_dot>dot|punkt|punto)_(?=[A-Za-z])"
)
#: words that announce an address, with those of the languages
_CUES = frozenset(
    "mail mails email emails e-mail mailto write contact reach address schreib schreibe schreiben adresse kontakt "
    "courriel mél écrire écrivez contactez contacter correo escribe escriba escribir contacto dirección".split()
)
_ALONE_FROM, _ALONE_TO = re.compile(r"[\n,;:()<>\"']\s*$|^\s*$"), re.compile(r"\s*(?:[\n,;:()<>\"'.!?]|$)")
_DOMAIN_WORDS = re.compile(rf"(?i)\s+at\s+[0-9A-Za-z-]+(?:(?:\s+(?:{_POINTS})\s+|\s*{_IN_BRACKETS.format(_DOT_TOKEN)}\s*)[0-9A-Za-z-]+)+")
_BEFORE = 100  # characters in which words that announce an address are looked for


def _is_address(text: str, at: int) -> bool:
    """Whether what stands before a bare ``at`` is a mailbox rather than a word of a sentence.

    It is if it holds a digit, a dot or another sign, if a word like ``mail`` is among the three
    before it, or if the whole address stands alone between line ends or punctuation.
    """
    start = at
    while start and text[start - 1] in _LOCAL:
        start -= 1
    if not text[start:at].isalpha():
        return True
    before = text[max(0, start - _BEFORE) : start]
    if any(w.strip(".,;:()<>\"'").lower() in _CUES for w in before.split()[-3:]):
        return True
    domain = _DOMAIN_WORDS.match(text, at)
    return bool(domain and _ALONE_FROM.search(before) and _ALONE_TO.match(text, domain.end()))


def at_and_dot(source: Mapped) -> list[tuple[int, int, str]]:
    """Written-out ``at`` and ``dot`` become signs: in brackets, with any blanks around, or as words."""
    text, edits, last = source.text, [], 0
    lowered = text.lower()
    some = any(part in lowered for part in _AT_PARTS) and _AT_PART.search(lowered)
    if not some and not _AT_SIGNS.search(lowered):
        return edits
    for match in _AT.finditer(text):
        start, end = match.span()
        if match["bare"] and not _is_address(text, start):
            continue
        while start > last and text[start - 1].isspace():
            start -= 1
        while end < len(text) and text[end].isspace():
            end += 1
        is_at = match["at"] or match["known"] or match["bare"] or match["low_at"]
        edits.append((max(start, last), end, "@" if is_at else "."))
        last = end
    return edits


#: applied in this order, each to the output of the one before
TRANSDUCERS = (homoglyphs, digit_letters, at_and_dot, spelled_digits)


def spans(text: str | None) -> list[tuple[str, int, int, bool, str]]:
    """(kind, start, end, base, value) of a text, ends exclusive, in code points.

    Base spans are those of the text as it stands. Then the transducers run; what is
    found in their output and holds something they changed is mapped back to the
    source range it came from, and added unless it lies within a base span of its kind.
    ``value`` is the text of a base span, else the normalised text.
    """
    if not text:
        return []
    found = [(kind, a, b, True, text[a:b]) for a, b, kind in find(text)]
    plain = mapped = Mapped(text, *(np.empty(0, dtype=np.int64),) * 2)
    for transducer in TRANSDUCERS:
        if edits := transducer(mapped):
            mapped = (Mapped.of(text) if mapped is plain else mapped).rewrite(edits)
    if mapped is not plain:
        base = {kind: [s[1:3] for s in found if s[0] == kind] for kind in KINDS}  # in order, apart
        added = []
        for a, b, kind in find(mapped.text):
            start, end = int(mapped.start[a]), int(mapped.end[b - 1])
            value, known = mapped.text[a:b], base[kind]
            at = bisect_right(known, start, key=lambda s: s[0])
            if text[start:end] != value and not (at and end <= known[at - 1][1]):
                added.append((kind, start, end, False, value))
        found += added
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def with_spans(docs: DataFrame, spans_col: str = "spans", text_col: str = "text") -> DataFrame:
    """``docs`` with the identifiers of every whole text as an array of SPAN_TYPE.

    Null and empty texts have none, and an empty table stays empty. Rows are kept as they are,
    repeated ones too; a column that has the name of the result is replaced. A text is searched
    in one task, in time and memory in proportion to its length, however many spans it holds.
    """
    names = [c for c in docs.columns if c != spans_col]
    text = fresh(docs, "_text")
    rows = docs.select(*names, F.col(text_col).alias(text))
    struct = pa.struct(
        [("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_()), ("value", pa.string())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                [dict(zip(("kind", "start", "end", "base", "value"), s, strict=True)) for s in spans(t)]
                for t in batch.column(len(names)).to_pylist()
            ]
            columns = [batch.column(i) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(found, pa.list_(struct))], names=[*names, spans_col]
            )

    rows_per_batch(docs.sparkSession)
    kept = rows.select(*names).schema.add(spans_col, StructType.fromDDL(f"spans {SPAN_TYPE}")["spans"].dataType)
    return rows.mapInArrow(run, kept)


def masked(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with every identifier replaced by its kind in angle brackets.

    Where spans overlap, the range they cover together takes the kind of the first.
    Null and empty texts stay so, an empty table has no rows, and other columns, however called,
    are left alone. Very long texts take time in proportion; see :func:`with_spans`.
    """
    position = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([mask(t) for t in batch.column(position).to_pylist()], pa.string())
            columns = [texts if i == position else c for i, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    rows_per_batch(docs.sparkSession)
    return docs.mapInArrow(run, docs.schema)


def mask(text: str | None) -> str | None:
    merged: list[list] = []
    for kind, a, b, _, _ in spans(text):
        if merged and a < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b, kind])
    if not merged:
        return text
    parts, last = [], 0
    for a, b, kind in merged:
        parts += [text[last:a], f"<{kind}>"]
        last = b
    return "".join([*parts, text[last:]])
