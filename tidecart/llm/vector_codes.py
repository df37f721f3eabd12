"""Vectors compressed to four one-byte codes, with codebooks trained in exact integer arithmetic.

Components become integers, vectors are cut into four consecutive parts, and each part position has a codebook of up to 256
entries. Distances come from per-dimension value dictionaries: a block of vectors lists the distinct integers of each
dimension once, their squared differences to all entries are tabulated, and the distance of a part to every entry is a
gather and an add per dimension over the dictionary codes. Blocks are bounded, so tables are too.

A round is one pass over the stored integers: a task adds up its parts per entry before anything is shuffled, and only
(entry, position) sums, at most 256 times the length of a vector, reach the driver. Sums are decimals, so no order of adding
and no lost executor changes them.

Defined results: a null vector, or one with a null or non-finite component, is dropped. The width is that of the smallest kept
vec_id (nulls last, repeats by their components); a vector of another width keeps its row with a null code and error. A
width that four does not divide gives parts that differ by one. Components beyond +-262144 count as that, so that distances are
exact in 64 bits; an error beyond 64 bits counts as the largest long. Repeated rows count as often as they occur. Extra
columns are ignored; empty in, empty out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from tidecart.llm.common import schema_with, small, stored

# The grid of the integers, parts of a vector, entries of a codebook, rounds of training.
SCALE, PARTS, ENTRIES, ROUNDS = 1024, 4, 256, 4
#: Largest integer of a component; rows of a block, and of a step whose distances stay in cache.
LIMIT, BLOCK, STEP = 1 << 28, 8192, 512
_LONGEST = (1 << 63) - 1

Books = list[np.ndarray]  # by part: entries x components


def integers(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, x): usable vectors with integer components."""
    x = F.transform("embedding", lambda v: v.cast("double"))
    fine = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))

    def whole(v: Column) -> Column:
        return F.floor(F.greatest(F.lit(float(-LIMIT)), F.least(F.lit(float(LIMIT)), v * F.lit(float(SCALE))))).cast("int")

    rows = vectors.where(F.col("embedding").isNotNull()).select("vec_id", "label", x.alias("x"))
    return rows.where(F.coalesce(fine, F.lit(False))).select("vec_id", "label", F.transform("x", whole).alias("x"))


def cuts(width: int) -> list[int]:
    return [width * k // PARTS for k in range(PARTS + 1)]


def squared(x: np.ndarray, book: np.ndarray) -> Iterator[tuple[slice, np.ndarray]]:
    """For steps of rows, the squared distances of a part's rows to all entries, by value dictionaries."""
    n, width = x.shape
    most = max(int(np.abs(x).max(initial=0)), int(np.abs(book).max(initial=0)))
    bound = width * (2 * most) ** 2
    kind = np.int32 if bound < 1 << 31 else np.int64 if bound <= _LONGEST else object
    codes, tables = [], []
    for k in range(width):
        values, code = np.unique(x[:, k], return_inverse=True)
        table = np.subtract.outer(values.astype(kind), book[:, k].astype(kind))
        codes.append(code)
        tables.append(table * table)
    for low in range(0, n, STEP):
        rows = slice(low, min(low + STEP, n))
        total = np.zeros((rows.stop - low, len(book)), kind)
        for code, table in zip(codes, tables):
            total += table[code[rows]]
        yield rows, total


def nearest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry of each row (ties to the lower index) and its squared distance."""
    at, best = np.zeros(len(x), np.int64), np.zeros(len(x), object if x.shape[1] * (4 * LIMIT) ** 2 > _LONGEST else np.int64)
    for rows, total in squared(x, book):
        at[rows] = total.argmin(1)
        best[rows] = total[np.arange(len(total)), at[rows]]
    return at, best


def _blocks(batch: pa.RecordBatch, column: str, width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, components) of the vectors of the width, in bounded blocks."""
    lists = batch.column(batch.schema.get_field_index(column))
    fits = np.flatnonzero(lists.value_lengths().to_numpy(zero_copy_only=False) == width)
    for low in range(0, len(fits), BLOCK):
        places = fits[low : low + BLOCK]
        yield places, lists.take(pa.array(places)).flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(places), width)


def _sums(ints: DataFrame, books: Books, width: int) -> DataFrame:
    """(part, entry, position, total, n) over all vectors, added up in each task first. Position -1 holds the row count, so that
    parts without components count too."""
    held = ints.sparkSession.sparkContext.broadcast(books)
    edges = cuts(width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = held.value
        totals = [np.zeros((len(b), b.shape[1]), np.int64) for b in books]
        counts = [np.zeros(len(b), np.int64) for b in books]
        for batch in batches:
            for _, x in _blocks(batch, "x", width):
                for p, book in enumerate(books):
                    part = x[:, edges[p] : edges[p + 1]]
                    at, _ = nearest(part, book)
                    counts[p] += np.bincount(at, minlength=len(book))
                    for k in range(part.shape[1]):
                        # Exact in doubles: a block adds up to less than 2**42.
                        totals[p][:, k] += np.bincount(at, part[:, k], len(book)).astype(np.int64)
        for p, (total, n) in enumerate(zip(totals, counts)):
            used = np.flatnonzero(n)
            rows = np.concatenate([n[used, None], total[used]], 1)
            size = rows.shape[1]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(rows.size, p, np.int32)),
                    pa.array(np.repeat(used, size).astype(np.int32)),
                    pa.array(np.tile(np.arange(-1, size - 1, dtype=np.int32), len(used))),
                    pa.array(rows.reshape(-1)),
                ],
                names=["part", "entry", "position", "total"],
            )

    each = ints.select("x").mapInArrow(run, "part int, entry int, position int, total long")
    return each.groupBy("part", "entry", "position").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))


def first_books(ints: DataFrame) -> tuple[Books, int]:
    """The parts of the smallest vec_ids, and the width. At most ``ENTRIES`` rows of the width leave the cluster."""
    by = [F.col("vec_id").asc_nulls_last(), F.col("x")]
    first = ints.orderBy(*by).limit(1).collect()
    if not first:
        return [], 0
    width = len(first[0]["x"])
    rows = ints.where(F.size("x") == width).orderBy(*by).limit(ENTRIES).collect()
    x = np.array([r["x"] for r in rows], np.int64).reshape(len(rows), width)
    edges = cuts(width)
    return [x[:, a:b].copy() for a, b in zip(edges, edges[1:])], width


def trained(ints: DataFrame, rounds: int = ROUNDS) -> tuple[Books, int]:
    """The codebooks after ``rounds`` of assigning every part and moving each used entry to the floor of its parts' mean."""
    books, width = first_books(ints)
    for _ in range(rounds if books else 0):
        sums = {(r["part"], r["entry"], r["position"]): int(r["total"]) for r in _sums(ints, books, width).collect()}
        books = [book.copy() for book in books]
        for (p, e, k), total in sums.items():
            if k >= 0:
                books[p][e, k] = total // sums[p, e, -1]
    return books, width


def encoded(ints: DataFrame, books: Books, width: int) -> DataFrame:
    """(vec_id, label, code, error) of every vector."""
    held = ints.sparkSession.sparkContext.broadcast(books)
    edges = cuts(width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = held.value
        for batch in batches:
            code, error = np.full(batch.num_rows, None, object), np.full(batch.num_rows, None, object)
            for places, x in _blocks(batch, "x", width):
                ats, total = np.zeros((len(places), PARTS), np.uint8), np.zeros(len(places), object)
                for p, book in enumerate(books):
                    ats[:, p], best = nearest(x[:, edges[p] : edges[p + 1]], book)
                    total += best.astype(object)
                code[places] = [row.tobytes().hex() for row in ats]
                error[places] = [min(int(t), _LONGEST) for t in total]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in range(2)), pa.array(code, pa.string()), pa.array(error, pa.int64())],
                names=["vec_id", "label", "code", "error"],
            )

    fields = {f.name: f.dataType.simpleString() for f in ints.schema.fields}
    return ints.select("vec_id", "label", "x").mapInArrow(run, f"vec_id {fields['vec_id']}, label {fields['label']}, code string, error long")


def digest(books: Books) -> str:
    """sha256 of all entries' components, by part, entry and position."""
    return hashlib.sha256(",".join(str(int(v)) for book in books for v in book.reshape(-1)).encode()).hexdigest()


def compress(vectors: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, Books]:
    """(vec_id, label, code, error) as a stored table, and the codebooks."""
    ints = stored(integers(vectors.select("vec_id", "label", "embedding")))
    books, width = trained(ints, rounds)
    return stored(encoded(ints, books, width)), books


def decoded(codes: DataFrame, books: Books) -> DataFrame:
    """``codes`` with ``approx``: the components that a code stands for, on the scale of the input."""
    held = codes.sparkSession.sparkContext.broadcast(books)
    names = codes.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = held.value
        for batch in batches:
            written = batch.column(names.index("code")).to_pylist()
            approx = [c and np.concatenate([book[i] for book, i in zip(books, bytes.fromhex(c))]) / SCALE for c in written]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(approx, pa.list_(pa.float64()))], names=[*names, "approx"])

    return codes.mapInArrow(run, schema_with(codes, approx=ArrayType(DoubleType())))


def report(vectors: DataFrame) -> DataFrame:
    """Per kept row: vec_id, code, error, the error summed over its label, and the digest of the codebooks."""
    codes, books = compress(vectors)
    total = F.sum(F.col("error").cast("decimal(38,0)"))
    total = F.when(total > F.lit(_LONGEST), F.lit(_LONGEST)).otherwise(total).cast("long")
    sums = stored(codes.groupBy("label").agg(total.alias("label_error"))).withColumnRenamed("label", "_label")
    rows = codes.join(small(sums, 32), F.col("label").eqNullSafe(F.col("_label")))
    return rows.select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
