"""Personal data: plain patterns, and offset-preserving deobfuscation.

Small transducers rewrite disguised spellings (homoglyphs, spelled digits, "at" and "dot" in words or brackets) into plain
ones while keeping, for every character written, the span of source characters it came from. The same patterns then run
over the rewritten text, and what they find is mapped back to the source.

Null texts are empty; rows, repeated or not, are handled one by one; extra columns are ignored; an empty table gives
an empty result.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecart.llm.common import pieces, schema_with

KINDS = ("email", "ip", "card", "phone")
Span = tuple[str, int, int]

# The lookbehinds only spare starts that cannot win: a match never begins inside a run of digits.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

# Characters that look like ASCII ones, and characters that are not seen.
HOMOGLYPHS = {
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y", "х": "x",
    "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "ɡ": "g", "ո": "n", "ս": "u",
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "Х": "X", "І": "I",
    "ο": "o", "α": "a", "ι": "i", "ν": "v", "ρ": "p", "υ": "u", "Ο": "O", "Α": "A", "Β": "B", "Ε": "E", "Ι": "I", "Ρ": "P",
    "\u2024": ".", "\u3002": ".", "\uff61": ".", "\ufe6b": "@", "\u2010": "-", "\u2011": "-", "\u2012": "-", "\u2013": "-", "\u2212": "-",
    "\u00a0": " ", "\u2009": " ", "\u202f": " ",
    "\u200b": "", "\u200c": "", "\u200d": "", "\u2060": "", "\ufeff": "", "\u00ad": "",
}
HOMOGLYPHS |= {chr(c): chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)}  # full-width forms
HOMOGLYPHS |= {chr(base + d): str(d) for base in (0x660, 0x6F0, 0x966, 0x1D7CE, 0x1D7D8, 0x1D7E2, 0x1D7EC, 0x1D7F6) for d in range(10)}
# Digits as words (English, German, French, Spanish), separators as words.
DIGIT_WORDS = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7",
    "eight": "8", "nine": "9", "null": "0", "eins": "1", "zwei": "2", "drei": "3", "vier": "4", "fünf": "5", "sechs": "6",
    "sieben": "7", "acht": "8", "neun": "9", "zéro": "0", "un": "1", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5",
    "sept": "7", "huit": "8", "neuf": "9", "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5",
    "seis": "6", "siete": "7", "ocho": "8", "nueve": "9",
}
MARK_WORDS = {"plus": "+", "más": "+", "dot": ".", "point": ".", "punkt": ".", "punto": ".", "dash": "-", "hyphen": "-"}
_AT, _DOT = "at|arroba|arobase|ät", "dot|point|punkt|punto"
_TOP = "com|org|net|edu|gov|info|io|co|de|fr|es|eu|uk"

_GLYPH = re.compile("[" + "".join(map(re.escape, HOMOGLYPHS)) + "]")
_WORD = "|".join(sorted([*DIGIT_WORDS, *MARK_WORDS], key=len, reverse=True))
_ANY_DIGIT = "|".join(sorted(DIGIT_WORDS, key=len, reverse=True))
# A digit or mark as a word or a character, and what may stand between two of them.
_ATOM = re.compile(rf"(?<!\w)(?:{_WORD})(?!\w)|[0-9+]", re.IGNORECASE)
_BETWEEN = re.compile(r"[\s,.-]{1,2}")
_OPEN, _CLOSE = r"[\(\[\{<]\s?", r"\s?[\)\]\}>]"
_AT_BOX = rf"\s?{_OPEN}(?:{_AT}|@){_CLOSE}\s?"
_DOT_BOX = rf"\s?{_OPEN}(?:{_DOT}|\.){_CLOSE}\s?"
_DOT_ANY = rf"(?:{_DOT_BOX}|\s(?:{_DOT})\s)"
_LABEL = r"[A-Za-z0-9-]+"
_AT_ANY = re.compile(rf"(?P<box>{_AT_BOX}|\s?@\s?)|\s(?:{_AT})\s", re.IGNORECASE)
_BOXED_DOMAIN = re.compile(rf"{_LABEL}(?:(?:\.|{_DOT_ANY}){_LABEL})+", re.IGNORECASE)
_BARE_DOMAIN = re.compile(rf"{_LABEL}(?:(?:\.|{_DOT_ANY}){_LABEL})*(?:{_DOT_ANY}|\.)(?:{_TOP})(?![A-Za-z0-9-])", re.IGNORECASE)
_DOT_BEFORE = re.compile(rf"{_DOT_ANY}\Z", re.IGNORECASE)
#: No written dot is longer.
_LONGEST_DOT = 16
_DOTS = re.compile(_DOT_ANY, re.IGNORECASE)
_MAYBE_ADDRESS = re.compile(rf"[\(\[\{{<]\s?(?:{_AT}|@|{_DOT}|\.)\s?[\)\]\}}>]|\s@|@\s|\s(?:{_DOT})\s|\s(?:{_AT})\s{_LABEL}\.[A-Za-z0-9]", re.IGNORECASE)
_MAYBE_SPELLED = re.compile(rf"(?<!\w)(?:{_ANY_DIGIT})[\s,.-]{{1,2}}(?:{_WORD}|[0-9])(?!\w)", re.IGNORECASE)


def _luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = int(d) * (2 if k % 2 else 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(_DIGIT.findall(text))


def plain_spans(text: str) -> list[Span]:
    """Leftmost, non-overlapping matches of each kind, by start and then kind. Linear in the text."""
    found: list[Span] = []
    if "@" in text:
        floor = 0
        for m in _DOMAIN.finditer(text):
            start = m.start()
            while start > floor and text[start - 1] in _LOCAL:
                start -= 1
            if start < m.start():
                found.append(("email", start, m.end()))
                floor = m.end()
            else:
                floor = max(floor, m.start())
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            # Zeros in front are cut off first: they may be more than a number can have digits.
            if all(len(p) <= 3 and int(p or 0) <= 255 for p in (x.lstrip("0") for x in m.group().split("."))):
                found.append(("ip", *m.span()))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 12 and 12 <= len(d := _digits(m.group())) <= 19 and _luhn(d):
                found.append(("card", *m.span()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= len(_digits(m.group())) <= 15:
                    found.append(("phone", *m.span()))
    return in_order(found)


def in_order(spans: Iterable[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


class Tape:
    """A text with the source span of each of its characters; rewriting keeps the spans."""

    def __init__(self, text: str):
        self.text, self.starts, self.ends = text, range(len(text)), range(1, len(text) + 1)
        self.changed: bytes | bytearray = bytes(len(text))

    def rewrite(self, edits: list[tuple[int, int, str]]) -> None:
        """Replace disjoint spans, given in order. Each character written comes from the whole span replaced; a span that
        vanishes is joined to nothing, so a match around it still maps to all it covers."""
        if not edits:
            return
        out, starts, ends, changed, at = [], [], [], bytearray(), 0
        for a, b, new in [*edits, (len(self.text), len(self.text), "")]:
            out.append(self.text[at:a])
            starts.extend(self.starts[at:a])
            ends.extend(self.ends[at:a])
            changed += self.changed[at:a]
            if b > a:
                out.append(new)
                starts.extend([self.starts[a]] * len(new))
                ends.extend([self.ends[b - 1]] * len(new))
                changed += b"\x01" * len(new)
                if not new and changed:
                    changed[-1] = 1
            at = b
        self.text, self.starts, self.ends, self.changed = "".join(out), starts, ends, changed

    def source(self, start: int, end: int) -> tuple[int, int]:
        return self.starts[start], self.ends[end - 1]


def _spell(tape: Tape) -> None:
    """Write runs of four or more spelled digits and marks plainly. One pass: atoms are found left to right and chained; a
    chain counts from its first atom that no word character precedes to its last digit that none follows."""
    text, edits = tape.text, []
    chain: list[re.Match] = []

    def close() -> None:
        # The two ends of a chain of n atoms are found in n steps.
        inside = lambda at: 0 <= at < len(text) and (text[at].isalnum() or text[at] == "_")
        start = next((i for i, m in enumerate(chain) if not inside(m.start() - 1)), len(chain))
        unit = lambda m: DIGIT_WORDS.get(m.group().lower()) or MARK_WORDS.get(m.group().lower(), m.group())
        end = next((i for i in range(len(chain) - 1, -1, -1) if unit(chain[i]).isdigit() and not inside(chain[i].end())), -1)
        if end - start >= 3 and any(m.group()[0].isalpha() for m in chain[start : end + 1]):
            edits.append((chain[start].start(), chain[end].end(), "".join(map(unit, chain[start : end + 1]))))
        chain.clear()

    for m in _ATOM.finditer(text):
        if chain:
            last = chain[-1]
            gap = text[last.end() : m.start()] if m.start() - last.end() <= 2 else None
            joined = gap is not None and (bool(_BETWEEN.fullmatch(gap)) if gap else last.group()[-1] in "0123456789+" and m.group().isdigit())
            if not joined:
                close()
        chain.append(m)
    if chain:
        close()
    tape.rewrite(edits)


def _local_start(text: str, end: int, floor: int) -> int:
    """Where the local part that ends at ``end`` begins: runs of its characters, joined by written dots, from right to left."""
    start = end
    while True:
        at = start
        while at > floor and text[at - 1] in _LOCAL:
            at -= 1
        if at == start:
            return start
        start = at
        dot = _DOT_BEFORE.search(text[max(floor, start - _LONGEST_DOT) : start])
        before = start - len(dot.group()) if dot else floor
        if not dot or before <= floor or text[before - 1] not in _LOCAL:
            return start
        start = before


def _addresses(tape: Tape) -> None:
    """Write disguised addresses plainly. A bare "at" between words counts only before a domain that ends in
    a well-known top level, so that ordinary prose stays as it is. Every "at" is looked at once, with the domain after it and
    the local part before it; neither reaches past another "at"."""
    text = tape.text
    edits: list[tuple[int, int, str]] = []
    floor, at = 0, _AT_ANY.search(tape.text)
    while at:
        domain = (_BOXED_DOMAIN if at.group("box") else _BARE_DOMAIN).match(text, at.end())
        start = _local_start(text, at.start(), floor) if domain else at.start()
        if start < at.start():
            edits += [(*d.span(), ".") for d in _DOTS.finditer(text, start, at.start())]
            if at.group() != "@":
                edits.append((*at.span(), "@"))
            edits += [(*d.span(), ".") for d in _DOTS.finditer(text, *domain.span())]
            floor = domain.end()
        at = _AT_ANY.search(text, max(floor, at.start() + 1))
    tape.rewrite(edits)


def spans(text: str) -> tuple[list[Span], list[Span]]:
    """(plain spans, all spans). A disguised span is added only where rewriting changed something inside it, and unless a
    plain span of its kind covers it."""
    base = plain_spans(text)
    glyphs = None if text.isascii() else _GLYPH.search(text)
    spelled, address = _MAYBE_SPELLED.search(text), _MAYBE_ADDRESS.search(text)
    if not (glyphs or spelled or address):
        return base, base
    tape = Tape(text)
    if glyphs:
        tape.rewrite([(*m.span(), HOMOGLYPHS[m.group()]) for m in _GLYPH.finditer(text)])
    if spelled or glyphs:
        _spell(tape)
    if address or glyphs:
        _addresses(tape)
    taken = {k: [s for s in base if s[0] == k] for k in KINDS}  # by start, and apart from one another
    begins = {k: [s[1] for s in taken[k]] for k in KINDS}
    added = set()
    for kind, a, b in plain_spans(tape.text):
        if 1 in tape.changed[a:b]:
            start, end = tape.source(a, b)
            near = bisect_right(begins[kind], start) - 1
            if near < 0 or end > taken[kind][near][2]:
                added.add((kind, start, end))
    return base, in_order({*base, *added})


def _written(found: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in found)


_OUT = pa.schema(
    [(f"n_{k}", pa.int64()) for k in KINDS] + [("base", pa.string()), ("spans", pa.string()), ("clean", pa.string())]
)


def masked(text: str, found: list[Span]) -> str:
    """The text with each span replaced by its kind in brackets; overlapping spans are merged under the first one's kind."""
    out, at = [], 0
    for kind, start, end in found:
        if start >= at:
            out += [text[at:start], f"<{kind}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def find_pii(docs: DataFrame, text: str = "text", mask: bool = False) -> DataFrame:
    """``docs`` with ``n_email``, ``n_ip``, ``n_card``, ``n_phone`` (plain spans), ``base`` and ``spans`` (kind:start:end,
    code points, end exclusive, comma-joined) and, with ``mask``, ``clean``: the text with all spans replaced.

    One pass per row, no shuffle. Columns of these names in ``docs`` are replaced.
    """
    made = [*(f"n_{k}" for k in KINDS), "base", "spans", *(["clean"] if mask else [])]
    kept = docs.drop(*[c for c in made if c != text])
    fields = [f for f in _OUT if f.name in made]
    names = kept.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in pieces(whole, names.index(text))):
            rows = []
            for value in batch.column(names.index(text)).to_pylist():
                value = value or ""
                base, found = spans(value)
                kinds = [s[0] for s in base]
                rows.append((*(kinds.count(k) for k in KINDS), _written(base), _written(found), masked(value, found) if mask else ""))
            columns = list(zip(*rows)) or [()] * len(_OUT)
            arrays = [pa.array(columns[_OUT.get_field_index(f.name)], f.type) for f in fields]
            yield pa.RecordBatch.from_arrays([*batch.columns, *arrays], names=[*names, *(f.name for f in fields)])

    kind = {pa.int64(): "long", pa.string(): "string"}
    return kept.mapInArrow(run, schema_with(kept, **{f.name: kind[f.type] for f in fields}))


def report(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, counts, digest of the plain spans, and all spans."""
    found = find_pii(docs.select("doc_id", "text"))
    counts = [f"n_{k}" for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"), "spans")
