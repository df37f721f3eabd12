"""Fill-in-the-middle: a text is cut at two line ends and written as prefix, suffix and middle, so that a model learns to fill gaps.

The line ends of a text are a set of code point offsets, kept as a Roaring-style set: offsets share a container by their high
16 bits, and a container holds its low 16 bits as a sorted array, a bitmap or runs, whichever is smallest. Cumulative
cardinalities over the containers find the one that holds the k-th offset, a select inside it gives the offset; so both
cuts are found without a list of lines.

A null text is empty; an empty text and one that contains a sentinel stay plain. A null id counts as the empty text in the
draw. Rows are handled one by one, repeated or not; columns of the input stay, except those with a name of the results. An
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidecart.llm.common import schema_with

# The sentinels, and the seed and shares of the draw.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED, RATE, SPM_SHARE = 7, 100, 50
MADE = ["n", "form", "prefix_chars", "middle_chars", "output"]

#: A result batch is handed on when it holds about this many characters.
_BATCH_CHARS = 16 << 20
_LOW = 1 << 16
_ONES = np.array([bin(b).count("1") for b in range(256)], np.int64)


class _Array:
    """Low halves as a sorted array."""

    def __init__(self, low: np.ndarray):
        self.low = low.astype(np.uint16)

    def select(self, k: int) -> int:
        return int(self.low[k])


class _Bitmap:
    """One bit per low half, with the number of bits before each byte."""

    def __init__(self, low: np.ndarray):
        bits = np.zeros(_LOW, bool)
        bits[low] = True
        self.bytes = np.packbits(bits, bitorder="little")
        self.before = np.concatenate([[0], np.cumsum(_ONES[self.bytes])])

    def select(self, k: int) -> int:
        at = int(np.searchsorted(self.before, k, "right")) - 1
        inside = np.flatnonzero(np.unpackbits(self.bytes[at : at + 1], bitorder="little"))
        return 8 * at + int(inside[k - self.before[at]])


class _Runs:
    """First values of the runs, with the number of values before each run."""

    def __init__(self, first: np.ndarray, lengths: np.ndarray):
        self.first = first.astype(np.uint16)
        self.before = np.concatenate([[0], np.cumsum(lengths)])

    def select(self, k: int) -> int:
        run = int(np.searchsorted(self.before, k, "right")) - 1
        return int(self.first[run]) + k - int(self.before[run])


def _container(low: np.ndarray) -> _Array | _Bitmap | _Runs:
    """The smallest of the three: two bytes a value, 8 KB, or four bytes a run."""
    starts = np.flatnonzero(np.diff(low, prepend=-2) != 1)
    sizes = {_Runs: 4 * len(starts), _Array: 2 * len(low), _Bitmap: _LOW // 8}
    kind = min(sizes, key=sizes.get)
    return _Runs(low[starts], np.diff(starts, append=len(low))) if kind is _Runs else kind(low)


class BoundarySet:
    """A set of offsets, given in ascending order, with select: the offset at a place."""

    def __init__(self, offsets: np.ndarray):
        high = offsets >> 16
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(high)) + 1, [len(offsets)]])
        self.high = high[cuts[:-1]]
        self.before = cuts  # cardinality of all containers before each
        self.containers = [_container(offsets[a:b] & (_LOW - 1)) for a, b in zip(cuts[:-1], cuts[1:])]

    def __len__(self) -> int:
        return int(self.before[-1])

    def select(self, k: int) -> int:
        if not 0 <= k < len(self):
            raise IndexError(k)
        at = int(np.searchsorted(self.before, k, "right")) - 1
        return (int(self.high[at]) << 16) + self.containers[at].select(k - int(self.before[at]))


def boundaries(text: str) -> BoundarySet:
    """Offsets of a text's line ends, with 0 and the end: one more than it has lines."""
    if text.isascii():
        ends = np.flatnonzero(np.frombuffer(text.encode("ascii"), np.uint8) == 10) + 1
    else:
        ends = np.flatnonzero(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32) == 10) + 1
    last = [len(text)] if text and not text.endswith("\n") else []
    return BoundarySet(np.concatenate([[0], ends, last]).astype(np.int64))


def draw(doc_id, seed: int = SEED) -> list[int]:
    """Four unsigned 32-bit numbers of a document: the first groups of eight digits of a sha256."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[k : k + 8], 16) for k in (0, 8, 16, 24)]


def transform(doc_id, text: str, seed: int = SEED, rate: int = RATE, spm_share: int = SPM_SHARE) -> tuple:
    """(lines, form, characters of the prefix, of the middle, output)."""
    places = boundaries(text)
    n = len(places) - 1
    h1, h2, h3, h4 = draw(doc_id, seed)
    if not text or PREFIX in text or SUFFIX in text or MIDDLE in text or h3 % 100 >= rate:
        return n, "plain", None, None, text
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = places.select(first), places.select(second)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < spm_share:
        return n, "spm", a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


_OUT = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]


def fill_in_middle(docs: DataFrame, seed: int = SEED, rate: int = RATE, spm_share: int = SPM_SHARE) -> DataFrame:
    """``docs`` with ``n`` lines, ``form``, ``prefix_chars``, ``middle_chars`` and ``output``. One pass, no shuffle."""
    kept = docs.drop(*MADE)
    names = kept.columns
    ids, texts = names.index("doc_id"), names.index("text")

    def part(batch: pa.RecordBatch, low: int, rows: list[tuple]) -> pa.RecordBatch:
        made = [pa.array(values, kind) for values, kind in zip(zip(*rows), _OUT)]
        return pa.RecordBatch.from_arrays([*batch.slice(low, len(rows)).columns, *made], names=[*names, *MADE])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            low, rows, held = 0, [], 0
            for doc_id, text in zip(batch.column(ids).to_pylist(), batch.column(texts)):
                text = text.as_py() or ""
                rows.append(transform(doc_id, text, seed, rate, spm_share))
                held += len(text)
                if held > _BATCH_CHARS:
                    yield part(batch, low, rows)
                    low, rows, held = low + len(rows), [], 0
            if rows:
                yield part(batch, low, rows)

    return kept.mapInArrow(run, schema_with(kept, n="long", form="string", prefix_chars="long", middle_chars="long", output="string"))


def restored(output: Column, form: Column) -> Column:
    """The text an output was made from. Neither its parts nor their seams hold a sentinel, so the first one found is the cut."""
    at = {mark: F.instr(output, mark) for mark in (PREFIX, SUFFIX, MIDDLE)}

    def between(mark: str, following: str | None) -> Column:
        start = at[mark] + F.lit(len(mark))
        return F.substring(output, start, (at[following] if following else F.length(output) + F.lit(1)) - start)

    psm = F.concat(between(PREFIX, SUFFIX), between(MIDDLE, None), between(SUFFIX, MIDDLE))
    spm = F.concat(between(PREFIX, MIDDLE), between(MIDDLE, None), between(SUFFIX, PREFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def report(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, lines, form, characters of prefix and middle, digests of the output and of the text rebuilt from it."""
    made = fill_in_middle(docs.select("doc_id", "text"))
    digest = lambda text: F.sha2(text.cast("binary"), 256)
    rebuilt = digest(restored(F.col("output"), F.col("form")))
    return made.select("doc_id", *MADE[:4], digest(F.col("output")).alias("output_sha256"), rebuilt.alias("restored_sha256"))
