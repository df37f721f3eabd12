"""Questions of many texts to a table too large for any task, in packed rows.

A task gathers the keys that a block of its texts asks for, and a note of what it will do with the answers. Keys travel to the part of
the key space where that part of the table is, answers and notes meet again by block. A row holds thousands of keys as one
binary, so Spark moves and sorts few rows however many keys there are. Parts are dealt out by hash: a frequent key is asked for once
by each block and lies in one row of the table, so no part grows with its frequency.

Keys are 64-bit hashes; blocks are numbered by task and order, so a task that runs again sends the same rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecart.llm.common import mixed, slices

#: Rows of a table, or keys counted by a task, that are packed at once.
PACKED = 1_000_000
_PACKED = "place long, block long, kind int, keys binary, items binary"
_NAMES = ["place", "block", "kind", "keys", "items"]
_TABLE, _ASKED, _NOTE = 0, 1, 2


def placed(keys: np.ndarray, parts: int) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """The order of ``keys`` by their mixed value, and (part, from, to) in that order: a part is a range of mixed values."""
    spread = mixed(keys)
    order = np.argsort(spread)
    part = ((spread[order] >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
    edges = np.searchsorted(part, np.arange(parts + 1, dtype=np.uint64))
    return order, [(p, int(a), int(b)) for p, (a, b) in enumerate(zip(edges[:-1], edges[1:])) if b > a]


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * 5
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=_NAMES)


def grouped(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[Iterator[dict]]:
    """Runs of rows with one value of ``column``, each as an iterator that the next run ends."""
    rows = (dict(zip(batch.schema.names, row)) for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
    ahead: list[dict] = [row for row in [next(rows, None)] if row is not None]

    def run(value: object) -> Iterator[dict]:
        while ahead and ahead[0][column] == value:
            yield ahead.pop()
            ahead.extend(row for row in [next(rows, None)] if row is not None)

    while ahead:
        group = run(ahead[0][column])
        yield group
        for _ in group:
            pass


def summed(frame: DataFrame, count: Callable[[Iterator[pa.RecordBatch]], Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]], item: np.dtype, finish: Callable, schema: str) -> DataFrame:
    """Counts by (key, item) over the cluster. ``count`` yields (keys, items, times) of a task, as often as it likes; ``finish`` gets
    the distinct (key, item) of a part, in that order, with their sums, and returns the columns of ``schema``."""
    parts = slices(frame.sparkSession)
    kinds = np.dtype(item)
    names = [c.split()[0] for c in schema.split(", ")]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, items, times in count(batches):
            order, cuts = placed(keys, parts)
            keys, items, times = keys[order], items[order].astype(kinds), times[order].astype(np.int64)
            for p, a, b in cuts:
                yield _rows([(p, 0, _TABLE, keys[a:b].tobytes(), items[a:b].tobytes() + times[a:b].astype(np.uint32).tobytes())])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in grouped(batches, "place"):
            keys, items, times = [], [], []
            for row in group:
                k = np.frombuffer(row["keys"], np.uint64)
                keys.append(k)
                items.append(np.frombuffer(row["items"], kinds, len(k)))
                times.append(np.frombuffer(row["items"], np.uint32, len(k), len(k) * kinds.itemsize))
            key, at, n = np.concatenate(keys), np.concatenate(items), np.concatenate(times).astype(np.int64)
            del keys, items, times
            order = np.lexsort((at, key))
            key, at, n = key[order], at[order], n[order]
            first = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (at[1:] != at[:-1])])
            columns = finish(key[first], at[first], np.add.reduceat(n, first))
            for low in range(0, len(columns[0]), PACKED):
                yield pa.RecordBatch.from_arrays([pa.array(c[low : low + PACKED]) for c in columns], names=names)

    packed = frame.mapInArrow(pack, _PACKED).repartition(parts, "place").sortWithinPartitions("place")
    return packed.mapInArrow(merge, schema)


def answered(
    frame: DataFrame,
    ask: Callable[[Iterator[pa.RecordBatch]], Iterator[tuple[np.ndarray, bytes]]],
    table: DataFrame,
    finish: Callable[[bytes, np.ndarray, np.ndarray], Iterator[pa.RecordBatch]],
    schema: str,
    kinds: list[tuple[str, str]],
) -> DataFrame:
    """What ``finish`` makes of (note, found, values) for each (keys, note) that ``ask`` yields of the rows of ``frame``. ``keys`` are
    distinct uint64, in the order of their mixed values; ``found`` tells which are in ``table`` (key long, and columns sent as
    ``kinds``), ``values`` are the records of those."""
    parts = slices(frame.sparkSession)
    record = np.dtype(kinds)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0

        def out() -> Iterator[pa.RecordBatch]:
            t = pa.Table.from_batches(held)
            keys = t["key"].to_numpy().view(np.uint64)
            values = np.empty(len(keys), record)
            for name in record.names:
                values[name] = t[name].to_numpy()
            order, cuts = placed(keys, parts)
            keys, values = keys[order], values[order]
            for p, a, b in cuts:
                yield _rows([(p, 0, _TABLE, keys[a:b].tobytes(), values[a:b].tobytes())])

        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= PACKED:
                yield from out()
                held, size = [], 0
        if size:
            yield from out()

    def asks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        for number, (keys, note) in enumerate(ask(batches)):
            block = (task << 32) | number
            yield _rows([(block % parts, block, _NOTE, None, note)])
            for p, a, b in placed(keys, parts)[1]:
                yield _rows([(p, block, _ASKED, keys[a:b].tobytes(), None)])

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in grouped(batches, "place"):
            held: list[tuple[np.ndarray, np.ndarray]] = []
            ready = None
            for row in group:
                if row["kind"] == _TABLE:
                    keys = np.frombuffer(row["keys"], np.uint64)
                    held.append((keys, np.frombuffer(row["items"], record)))
                elif row["kind"] == _NOTE:
                    yield _rows([tuple(row.values())])
                else:
                    if ready is None:
                        keys = np.concatenate([np.empty(0, np.uint64), *[k for k, _ in held]])
                        order = np.argsort(keys)
                        ready = keys[order], np.concatenate([np.empty(0, record), *[v for _, v in held]])[order]
                        held.clear()
                    keys, values = ready
                    asked = np.frombuffer(row["keys"], np.uint64)
                    at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
                    found = keys[at] == asked if len(keys) else np.zeros(len(asked), bool)
                    kept = values[at[found]].tobytes() if len(keys) else b""
                    yield _rows([(row["place"], row["block"], _ASKED, np.packbits(found).tobytes() + np.uint32(len(asked)).tobytes(), kept)])

    def end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in grouped(batches, "block"):
            found, values, note = [np.empty(0, bool)], [np.empty(0, record)], b""
            for row in group:
                if row["kind"] == _NOTE:
                    note = row["items"]
                else:
                    n = int(np.frombuffer(row["keys"][-4:], np.uint32)[0])
                    found.append(np.unpackbits(np.frombuffer(row["keys"][:-4], np.uint8), count=n).astype(bool))
                    values.append(np.frombuffer(row["items"], record))
            yield from finish(note, np.concatenate(found), np.concatenate(values))

    both = table.mapInArrow(pack, _PACKED).unionByName(frame.mapInArrow(asks, _PACKED))
    met = both.repartition(parts, "place").sortWithinPartitions("place", "kind").mapInArrow(answer, _PACKED)
    # A block's answers come back by part, the order in which its keys were sent.
    return met.repartition(parts, "block").sortWithinPartitions("block", F.desc("kind"), "place").mapInArrow(end, schema)
