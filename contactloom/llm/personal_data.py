"""Personal data in plain and in disguised form, with spans of the source text.

Plain matches are found in the text as it stands.  Where a text shows a sign of disguise, transducers rewrite it and
keep for every written character the source characters it came from: look-alike letters and digits become ASCII,
invisible characters go, runs of spelled digits become digits, at and dot in words or brackets become @ and the full
stop, bracketed dots between numbers too.  The same detectors run on what was written; a match that took any rewriting, and that overlaps no match of its
kind already found, is mapped back to the source and added.

Kinds and plain patterns (leftmost, not overlapping, a match that fails its test is dropped and not tried anew):
email; ip (four parts, at most 255); card (14 to 19 digits, Luhn); phone (10 to 15 digits).  Offsets are code points,
end exclusive.  Null or empty text has no spans; rows repeat as they are; a null id stays null; only doc_id and text
are read.  Detectors and transducers go through a text once, so very long texts take time in proportion."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contactloom.llm.shared import byte_set, bytes_of, hash_spans, hash_text, runs, slices, texts

KINDS = ("email", "ip", "card", "phone")
Span = tuple[str, int, int]

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def emails(text: str) -> Iterator[Span]:
    """Every @ is looked at once: back over the local part, no further than the last match, then on over the domain."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield "email", start, found.end()
            done = found.end()
        at = text.find("@", max(at + 1, done))


def addresses(text: str) -> Iterator[Span]:
    """A chain of dotted numbers is taken four at a time."""
    for found in DOTTED.finditer(text):
        if found.group().count(".") < 3:
            continue
        at, parts = found.start(), found.group().split(".")
        for k in range(0, len(parts) - len(parts) % 4, 4):
            four = parts[k:k + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in four):
                yield "ip", at, end
            at = end + 1


def luhn(digits: list[int]) -> bool:
    return (sum(digits[-1::-2]) + sum(2 * d - 9 * (d > 4) for d in digits[-2::-2])) % 10 == 0


def cards(text: str) -> Iterator[Span]:
    for found in CARD.finditer(text):
        digits = [ord(c) - 48 for c in found.group() if c not in " -"]
        if 14 <= len(digits) <= 19 and luhn(digits):
            yield "card", found.start(), found.end()


def phones(text: str) -> Iterator[Span]:
    at = text.find("+")
    while at >= 0:
        found = PHONE.match(text, at)
        if found and 10 <= sum(c.isdigit() for c in found.group()) <= 15:
            yield "phone", at, found.end()
        at = text.find("+", found.end() if found else at + 1)


DETECTORS = (emails, addresses, cards, phones)


def detect(text: str) -> list[Span]:
    out = [span for find in DETECTORS for span in find(text)]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


#: Cyrillic and Greek letters that look like an ASCII letter.
LOOK_ALIKE = dict(zip("АВЕЅІЈКМНОРСТУХаеѕіјорсухһԁԛԝΑΒΕΖΗΙΚΜΝΟΡΤΥΧαοιν", "ABESIJKMHOPCTYXaesijopcyxhdqwABEZHIKMNOPTYXaoiv",
                      strict=True))
#: Characters without width.
INVISIBLE = frozenset("­​‌‍⁠﻿")
#: Dashes and stops that stand for the ASCII one.
STAND_INS = dict.fromkeys("‐‑‒–—―−", "-") | dict.fromkeys("。｡․", ".")


def plain_char(c: str) -> str:
    """ASCII form of a character, empty if it is invisible, itself if it has none."""
    if c < "\x80":
        return c
    if c in INVISIBLE:
        return ""
    if c in LOOK_ALIKE or c in STAND_INS:
        return LOOK_ALIKE.get(c) or STAND_INS[c]
    if (digit := unicodedata.decimal(c, None)) is not None:
        return str(digit)
    folded = unicodedata.normalize("NFKC", c)
    return folded if len(folded) == 1 and folded < "\x80" else c


class Written:
    """A rewritten text: for each of its characters the source span and whether it was rewritten."""

    def __init__(self, text: str):
        self.text = text
        self.start = np.arange(len(text))
        self.end = self.start + 1
        self.new = np.zeros(len(text), bool)

    def rewrite(self, edits: list[tuple[int, int, str]]) -> Written:
        """Put other characters in place of parts (sorted, apart).  What is written stands for its whole part; a
        part that goes without trace is marked on the character after it."""
        out, parts, cuts, at, gone = Written(""), [], [], 0, []
        size = 0
        for a, b, by in [*edits, (len(self.text), len(self.text), "")]:
            parts.append(self.text[at:a])
            cuts.append((self.start[at:a], self.end[at:a], self.new[at:a]))
            size += a - at
            if by:
                parts.append(by)
                cuts.append((np.full(len(by), self.start[a]), np.full(len(by), self.end[b - 1]), np.ones(len(by), bool)))
                size += len(by)
            elif b > a:
                gone.append(size)
            at = b
        out.text = "".join(parts)
        out.start, out.end, out.new = (np.concatenate([c[k] for c in cuts]) for k in range(3))
        out.new[[g for g in gone if g < len(out.new)]] = True
        return out


_OPEN, _CLOSE = r"\s{0,3}[\[({<]\s{0,3}", r"\s{0,3}[\])}>]\s{0,3}"
_DOT_WORD, _AT_WORD = r"(?:dot|point|punkt|punto)", r"(?:at|arobase|arroba)"
_BRACKET_DOT = rf"{_OPEN}(?:{_DOT_WORD}|\.){_CLOSE}"
DOT = rf"(?:{_BRACKET_DOT}|\s{{1,3}}{_DOT_WORD}\s{{1,3}})"
AT = rf"(?:{_OPEN}(?:{_AT_WORD}|@){_CLOSE}|\s{{1,3}}{_AT_WORD}\s{{1,3}}|\s{{0,3}}@\s{{0,3}})"
AT_SIGN = re.compile(AT, re.I)
AFTER_AT = re.compile(rf"[a-z0-9-]++(?:(?:{DOT}|\.)[a-z0-9-]++)+", re.I)
BEFORE_AT = re.compile(rf"[a-z0-9._%+-]+(?:{DOT}[a-z0-9._%+-]+)*\Z", re.I)
DOT_SIGN = re.compile(DOT, re.I)
NUMBER_DOT = re.compile(rf"(?<=[0-9]){_BRACKET_DOT}(?=[0-9])", re.I)
#: Code points of a disguised local part that are looked at, twice over what mail allows for a whole address.
REACH = 640

#: Digits as words, in the languages of the corpus.
DIGIT_WORDS = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7",
    "eight": "8", "nine": "9",
    "null": "0", "eins": "1", "zwei": "2", "zwo": "2", "drei": "3", "vier": "4", "fünf": "5", "sechs": "6",
    "sieben": "7", "acht": "8", "neun": "9",
    "zéro": "0", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7", "huit": "8", "neuf": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7",
    "ocho": "8", "nueve": "9"}
SIGN_WORDS = {"plus": "+", "dot": ".", "point": ".", "punkt": ".", "punto": ".", "dash": "-", "hyphen": "-"}
_WORDS = "|".join(sorted((*DIGIT_WORDS, *SIGN_WORDS), key=len, reverse=True))
_PART = rf"(?:(?:{_WORDS})(?![^\W_])|[0-9]++)"
SPOKEN = re.compile(rf"(?<![^\W_])(?:\+\s?)?{_PART}(?:[ ,.()-]{{1,3}}{_PART}){{3,}}", re.I)
SPOKEN_PART = re.compile(rf"({_WORDS})|([0-9]+)|([ ,.()-]+)|(\+\s?)", re.I)


def disguised_emails(text: str) -> list[tuple[int, int, str]]:
    """Edits that write @ and full stops.  A bare word for at needs a disguised dot after it, as "at example.com" is
    ordinary prose."""
    edits: list[tuple[int, int, str]] = []
    done = 0
    for at in AT_SIGN.finditer(text):
        domain = AFTER_AT.match(text, at.end())
        if at.start() < done or not domain:
            continue
        dots = [(m.start(), m.end(), ".") for m in DOT_SIGN.finditer(text, at.end(), domain.end())]
        if not dots and not re.search(r"[\[({<]", at.group()):
            continue
        lo = max(done, at.start() - REACH)
        local = BEFORE_AT.search(text[lo:at.start()])
        if local:
            own = [(m.start(), m.end(), ".") for m in DOT_SIGN.finditer(text, lo + local.start(), at.start())]
            edits += [*own, (at.start(), at.end(), "@"), *dots]
            done = domain.end()
    return edits


def spoken_digits(text: str) -> list[tuple[int, int, str]]:
    """Edits that write runs of four or more digit words, numbers among them, as digits without gaps; the gap between
    two numbers stays."""
    edits: list[tuple[int, int, str]] = []
    for run in SPOKEN.finditer(text):
        if not any(m.group(1) for m in SPOKEN_PART.finditer(run.group())):
            continue
        found = list(SPOKEN_PART.finditer(text, run.start(), run.end()))
        for k, m in enumerate(found):
            if m.group(1):
                word = m.group(1).lower()
                edits.append((m.start(), m.end(), DIGIT_WORDS.get(word) or SIGN_WORDS[word]))
            elif m.group(3) and "." not in m.group() and 0 < k < len(found) - 1 and (found[k - 1].group(1) or found[k + 1].group(1)):
                edits.append((m.start(), m.end(), ""))
    return edits


def deobfuscate(text: str) -> Written:
    """The transducers one after the other."""
    out = Written(text)
    if not text.isascii():
        out = out.rewrite([(i, i + 1, plain_char(c)) for i, c in enumerate(text) if c >= "\x80" and plain_char(c) != c])
    out = out.rewrite(spoken_digits(out.text))
    out = out.rewrite(disguised_emails(out.text))
    return out.rewrite([(m.start(), m.end(), ".") for m in NUMBER_DOT.finditer(out.text)])


def hidden(text: str, base: list[Span]) -> list[Span]:
    """Spans that only show after rewriting, in source offsets."""
    written = deobfuscate(text)
    taken = {k: np.zeros(len(text) + 1, bool) for k in KINDS}
    for kind, a, b in base:
        taken[kind][a:b] = True
    out = []
    for kind, a, b in detect(written.text):
        lo, hi = int(written.start[a]), int(written.end[b - 1])
        if (written.new[a:b].any() or hi - lo != b - a) and not taken[kind][lo:hi].any():
            out.append((kind, lo, hi))
    return out


_PLAIN = byte_set(b"@+0123456789")
_OPENS, _INSIDE = byte_set(b"[({<"), byte_set(b"@.")
_LETTERS = byte_set(bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(128, 256)))
#: Lead bytes of characters outside ASCII and the accented letters.
_ODD = byte_set(bytes([0xC2, *range(0xC4, 256)]))


def _hashes(words: Iterable[str]) -> np.ndarray:
    return np.unique(np.array([hash_text(x) for w in words for x in (w, w.upper())], np.uint64))


_DIGITS, _DOTS, _ATS = (_hashes(w) for w in ([*DIGIT_WORDS, "plus", "dash", "hyphen"], ("dot", "point", "punkt", "punto"),
                                             ("at", "arobase", "arroba")))


def signs_of_disguise(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Which of consecutive texts the transducers may rewrite.  No text that one of them changes is left out:

    characters: all but ASCII and the accented letters count, and of the block of these the signs for times and divided by,
    so what stands beside a word below is a letter or no part of it;
    addresses: an edit needs a disguised dot, or @ or a word for at behind a bracket and up to three spaces.  A disguised
    dot is a word for dot, or a full stop behind such a bracket; that goes for dots between numbers too;
    digits: an edit needs a digit or sign word in a run that the transducer's own pattern finds."""
    odd = np.flatnonzero(_ODD[data])
    signs = np.flatnonzero(data[:-1] == 0xC3)
    signs = signs[(data[signs + 1] == 0x97) | (data[signs + 1] == 0xB7)]
    starts, ends = runs(_LETTERS[data], off)
    h = hash_spans(data, starts, ends)
    inside = np.concatenate([np.flatnonzero(_INSIDE[data]), starts[np.isin(h, _ATS)]])
    inside = inside[np.any([_OPENS[data[np.maximum(inside - k, 0)]] for k in range(1, 5)], axis=0)]
    found = np.concatenate([odd, signs, inside, starts[np.isin(h, _DOTS)]])
    out = np.zeros(len(off) - 1, bool)
    out[np.searchsorted(off, found, side="right") - 1] = True
    for k in np.unique(np.searchsorted(off, starts[np.isin(h, _DIGITS)], side="right") - 1):
        out[k] = out[k] or bool(SPOKEN.search(data[off[k]:off[k + 1]].tobytes().decode()))
    return out


def spans_of(text: str, disguised: bool) -> list[tuple[str, int, int, bool]]:
    base = detect(text)
    more = hidden(text, base) if disguised else []
    found = [(*s, True) for s in base] + [(*s, False) for s in more]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def _run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))
    for batch in batches:
        data, off = bytes_of(batch.column(1))
        out: list[list[dict]] = []
        for i, j in slices(off):
            part, own = data[off[i]:off[j]], off[i:j + 1] - off[i]
            disguised = signs_of_disguise(part, own)
            plain = np.diff(np.concatenate([[0], np.cumsum(_PLAIN[part])])[own]) > 0
            for k in range(j - i):
                spans = []
                if disguised[k] or plain[k]:
                    spans = spans_of(part[own[k]:own[k + 1]].tobytes().decode(), bool(disguised[k]))
                out.append([{"kind": a, "start": s, "end": e, "base": b} for a, s, e, b in spans])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, kind)], ["doc_id", "spans"])


def find_personal_data(docs: DataFrame) -> DataFrame:
    """(doc_id, spans) of every row; spans by start, then kind, with ``base`` for those found in the plain text."""
    rows = texts(docs)
    return rows.mapInArrow(_run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, "
                           "spans array<struct<kind: string, start: bigint, end: bigint, base: boolean>>")


def _is(kind: str) -> Callable[[Column], Column]:
    return lambda x: x == kind


def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_personal_data(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    told = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    base = F.filter("spans", lambda s: s["base"])
    kinds = F.transform(base, lambda s: s["kind"])
    counts = [F.size(F.filter(kinds, _is(k))).cast("bigint").alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *counts,
                        F.sha2(F.array_join(F.transform(base, told), ",").cast("binary"), 256).alias("base_sha256"),
                        F.array_join(F.transform("spans", told), ",").alias("spans"))
