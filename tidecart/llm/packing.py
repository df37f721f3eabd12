"""Best-fit packing of token pieces into sequences, in bulk-synchronous rounds.

1. Tokenize; cut what is longer than a sequence; checksum each piece.
2. Range-sort the pieces by length (ties by a hash, so that one common length is spread over many tasks) and number them
   within their length.
3. Rounds: a sweep from long to short gives each piece the smallest gap that takes it (its successor); pieces and gaps
   of one length meet by rank, each gap serving one length a round; gaps shrink; repeat. When nothing fits, as many
   sequences open as the rest needs at least.
4. Each piece looks up its place by length and rank.

There are at most as many lengths and gaps as a sequence has tokens, so both sorted lists are swept in run-length form:
(length, count) runs against (gap, run of sequence numbers). What the rounds exchange is bounded by the sequence length
however large the corpus is; all rows are sorted, numbered and placed in parallel.

Null texts are empty (one piece: the end id). Rows that repeat a doc_id are packed one by one, extra columns are ignored,
an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecart.llm.common import schema_with, slices, stored

CAPACITY = 1024
END_ID = 2
SPECIAL = {"<|endoftext|>": 50256}
#: Distinct blank-separated chunks a task remembers; then it starts anew.
CACHE = 300_000
# Where a blank is one of several white spaces, or the last character, chunks cannot be cut at it.
_UNCUTTABLE = re.compile(r"\s (?:\s|\Z)|\A \Z")


class _Encoder(dict):
    """Ids (little-endian uint32) of a chunk that starts at a blank; the byte-level vocabulary never merges across one."""

    def __init__(self, path: str):
        super().__init__()
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.coder = tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL)

    def ids(self, text: str) -> bytes:
        return np.array(self.coder.encode(text, allowed_special="all"), "<u4").tobytes()

    def __missing__(self, chunk: str) -> bytes:
        if len(self) >= CACHE:
            self.clear()
        value = self[chunk] = self.ids(" " + chunk)
        return value

    def encode(self, text: str) -> bytes:
        if _UNCUTTABLE.search(text):
            return self.ids(text)
        head, *chunks = text.split(" ")
        return self.ids(head) + b"".join(map(self.__getitem__, chunks))


def pieces(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 and, if asked for, ids (binary, little-endian uint32), one row per piece.

    ``path`` is the vocabulary file of the byte-level tokenizer in rank form (ids as the ``tokenizers`` form gives them).
    """
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    end = np.array([END_ID], "<u4").tobytes()
    names = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _Encoder(path)
        for batch in batches:
            keys, cut = batch.column(0).to_pylist(), []
            for key, text in zip(keys, batch.column(1)):
                ids = encoder.encode(text.as_py() or "") + end
                n = len(ids) // 4
                first = n % capacity or capacity
                start, number = 0, 0
                while start < n:
                    stop = first if not start else start + capacity
                    part = ids[4 * start : 4 * stop]
                    cut.append((key, number, start, stop - start, zlib.crc32(part), *([part] if with_ids else [])))
                    start, number = stop, number + 1
            columns = list(zip(*cut)) or [()] * len(names)
            kinds = [batch.schema.field(0).type, pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + (", ids binary" if with_ids else "")
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _numbered(parts: DataFrame) -> tuple[DataFrame, np.ndarray, np.ndarray, np.ndarray]:
    """``parts`` range-sorted, with ``_part`` and ``_local`` (number within length and task); and per task and length the rows:
    at most one entry per task and per length, since the order is global."""
    n = slices(parts.sparkSession)
    tie = F.xxhash64("doc_id", "piece")
    parts = stored(parts)  # range-sorting reads its input twice
    ranged = parts.repartitionByRange(n, F.col("length"), tie).sortWithinPartitions("length", tie)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, seen = -1, 0
        for batch in batches:
            length = batch.column(batch.schema.get_field_index("length")).to_numpy()
            if not len(length):
                continue
            begins = np.flatnonzero(np.r_[True, length[1:] != length[:-1]])
            sizes = np.diff(np.r_[begins, len(length)])
            local = np.arange(len(length)) - np.repeat(begins, sizes)
            if length[0] == last:
                local[: sizes[0]] += seen
            last, seen = length[-1], int(local[-1]) + 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(local, pa.int64())], names=[*batch.schema.names, "_local"])

    withpart = ranged.withColumn("_part", F.spark_partition_id())
    table = stored(withpart.mapInArrow(number, schema_with(withpart, _local="long")))
    counts = table.groupBy("_part", "length").agg(F.count(F.lit(1)).alias("n")).orderBy("length", "_part").toPandas()
    return table, counts["_part"].to_numpy(np.int64), counts["length"].to_numpy(np.int64), counts["n"].to_numpy(np.int64)


def sweep_plan(counts: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Places for ``counts[length]`` pieces of each length: runs (length, first rank, pieces per sequence, first sequence,
    offset), each up to the next run of its length, and the number of sequences."""
    left = {s: n for s, n in sorted(counts.items(), reverse=True) if n > 0}
    taken = dict.fromkeys(left, 0)
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap -> runs of sequences (first, how many)
    plan: list[tuple[int, int, int, int, int]] = []
    opened = 0

    def place(s: int, g: int, first: int, bins: int, each: int, after: dict) -> None:
        plan.append((s, taken[s], each, first, capacity - g))
        taken[s] += bins * each
        left[s] -= bins * each
        after.setdefault(g - each * s, []).append((first, bins))

    for s in [s for s in left if 2 * s > capacity]:  # no two of these share a sequence
        n = left[s]
        place(s, capacity, opened, n, 1, gaps)
        opened += n
    left = {s: n for s, n in left.items() if n}
    while left:
        after: dict[int, list[tuple[int, int]]] = {}
        ascending = sorted(g for g in gaps if g > 0)
        stack: list[int] = []  # gaps that take the current length, smallest on top
        matched = False
        for s in list(left):
            while ascending and ascending[-1] >= s:
                stack.append(ascending.pop())
            while left[s] and stack:
                g = stack[-1]
                first, bins = gaps[g].pop()
                each = min(g // s, left[s])
                used = min(bins, left[s] // each)
                place(s, g, first, used, each, after)
                matched = True
                if used < bins:
                    gaps[g].append((first + used, bins - used))
                if not gaps[g]:
                    del gaps[g]
                    stack.pop()
        for g, runs in after.items():
            gaps.setdefault(g, []).extend(runs)
        gaps.pop(0, None)
        left = {s: n for s, n in left.items() if n}
        if not matched and left:
            new = -(-sum(s * n for s, n in left.items()) // capacity)
            gaps.setdefault(capacity, []).append((opened, new))
            opened += new
    return plan, opened


def pack(parts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``parts`` (doc_id, piece, length of 1 to ``capacity``, more) with ``sequence_id`` and ``offset``."""
    table, part, length, n = _numbered(parts)
    sizes = np.unique(length)
    totals = {int(s): int(n[length == s].sum()) for s in sizes}
    plan, _ = sweep_plan(totals, capacity)
    rows = np.array(sorted(plan), np.int64).reshape(-1, 5)
    base = {}
    for s in sizes:
        at = np.flatnonzero(length == s)
        base.update(zip(zip(part[at].tolist(), length[at].tolist()), (np.cumsum(n[at]) - n[at]).tolist()))
    held = table.sparkSession.sparkContext.broadcast((rows, base))
    names = [*parts.columns, "sequence_id", "offset"]
    shift = 44  # lengths and ranks in one sortable number

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs, first = held.value
        keys = (runs[:, 0] << shift) | runs[:, 1]
        for batch in batches:
            get = lambda name: batch.column(batch.schema.get_field_index(name)).to_numpy()
            size, of = get("length"), get("_part")
            rank = get("_local") + np.array([first[k] for k in zip(of.tolist(), size.tolist())], np.int64)
            run = runs[np.searchsorted(keys, (size << shift) | rank, "right") - 1] if len(size) else runs[:0]
            step = rank - run[:, 1]
            kept = [c for name, c in zip(batch.schema.names, batch.columns) if name not in ("_part", "_local")]
            made = [pa.array(run[:, 3] + step // run[:, 2], pa.int64()), pa.array(run[:, 4] + (step % run[:, 2]) * size, pa.int64())]
            yield pa.RecordBatch.from_arrays([*kept, *made], names=names)

    return table.mapInArrow(look_up, schema_with(parts, sequence_id="long", offset="long"))


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """Tokenize and pack: doc_id, piece, start, length, ids_crc32, (ids,) sequence_id, offset."""
    return pack(pieces(docs, capacity, path, with_ids), capacity)
