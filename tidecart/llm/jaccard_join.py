"""Exact Jaccard join of shingle sets in the metric space of the Jaccard distance d = 1 - |x & y| / |x | y|.

Texts whose sets are equal are one point. Two points within distance r = 1 - threshold share one of the first
floor(r * size) + 1 shingles of each, in any order common to all points; so a point needs to look for partners only in those
cells. The first one they share bounds what they have in common by what comes after it, so a point meets in a cell only points
up to a size that its place there gives. A point without anyone to meet in a cell leaves it. The order puts shingles of many texts
last (that alone keeps passages that everybody quotes from gathering everybody; it changes no result).

1. Voronoi regions: every point takes as pivot the most central point it shares a cell with (the one with the largest share
   of shared cells), and is replicated to the regions of all points it meets in a cell: the boundary.
2. Distances to the pivot are exact and link what lies within r; beyond the size window they are at least 1 - smaller / larger.
3. What is linked so far is contracted. Regions with points that are still apart from their pivot join again: pairs of a point
   that has the region as its own and any other point, one of them an outsider, that may share a cell (by bit sets), within the
   triangle-inequality window |d(x, p) - d(y, p)| <= r, the size window, and a bound on the symmetric difference from
   histograms. Large regions are dealt out as pairs of blocks.
4. The pairs left are verified exactly; links of both steps give the components.

A text is lower-cased in A-Z and cut at ASCII white space; a set holds its distinct runs of five words, or the whole
sequence if it is shorter. Null texts and texts without words have no set and link with nothing. Rows that repeat a doc_id are
separate points with that id; a null id takes part but is never the smallest. Extra columns are ignored; empty in, empty
out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cached_property, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from tidecart.llm.common import Sums, hashed_words, row_key, schema_with, slices, small, small_batches, stored, text_bytes
from tidecart.llm.graph import components

WORDS, THRESHOLD = 5, 80  # words of a shingle; similarity in per cent
#: A shingle of at least so many points comes last in the order; at most so many are listed (the list only steers cost).
COMMON, COMMON_LISTED = 48, 200_000
#: Buckets of a set's histogram, one byte each: at least and at most so many, and otherwise one for every four shingles, so that large
#: sets are told apart as well as small ones. Counts beyond 255 stay there: differences then only look smaller.
BUCKETS, MOST_BUCKETS = 256, 1 << 14
#: 64-bit words of the set of cells of a point, hashed to bits.
MARKS = 16
#: Points a task remembers so as to take each once; beyond that repeats are dropped later, or only weigh more in the order.
REMEMBERED = 2_000_000
#: Points of one block of a region.
BLOCK = 1024
#: Buckets of the finer histogram that is compared before two sets are.
FINE = 512


def shingle_sets(column: pa.Array, words: int = WORDS) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each row of a binary column."""
    for low, high, hashes, begins in hashed_words(column, lower=True):
        sums = Sums(hashes)
        place = np.arange(max(len(hashes) - words + 1, 0))
        runs = sums.of(place, place + words)
        for a, b in zip(begins[:-1], begins[1:]):
            if b - a >= words:
                found = np.sort(runs[a : b - words + 1])
                yield found[np.r_[True, found[1:] != found[:-1]]]
            else:
                yield sums.of(np.array([a]), np.array([b])) if b > a else np.empty(0, np.uint64)


def _node(shingles: np.ndarray) -> int:
    return int(np.frombuffer(xxhash.xxh3_64_digest(shingles.tobytes()), np.int64)[0]) if len(shingles) else 0


def _each_set(frame: DataFrame, make: Callable, schema: str, kinds: list[pa.DataType], words: int) -> DataFrame:
    """Rows that ``make`` yields from (ids before the text, set) of every row; the text is the last column."""
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            ids = list(zip(*[c.to_pylist() for c in batch.columns[:-1]])) or [()] * batch.num_rows
            rows: list[list] = [[] for _ in names]

            def out() -> pa.RecordBatch:
                arrays = []
                for c, k in zip(rows, kinds):
                    parts = [pa.array(x, k) if isinstance(x, np.ndarray) else x for x in c]
                    arrays.append(pa.concat_arrays(parts) if parts and isinstance(parts[0], pa.Array) else pa.array(parts, k))
                return pa.RecordBatch.from_arrays(arrays, names=names)

            size = 0
            for row, found in zip(ids, shingle_sets(batch.columns[-1], words)):
                for made in step(row, found):
                    for c, value in zip(rows, made):
                        c.append(value)
                    size += len(made[0]) if isinstance(made[0], np.ndarray) else 1
                if size > 500_000:
                    yield out()
                    rows, size = [[] for _ in names], 0
            yield out()

    return frame.mapInArrow(run, schema)


def _read(docs: DataFrame, words: int) -> DataFrame:
    """Points and shingle counts in one pass over the texts: (doc_id, doc_key, n_shingles, node, null, null) per row, where ``node``
    names the set and is null without one, and (null, null, null, null, h, times) for shingles that points of a task share."""
    schema = StructType().add("doc_id", docs.schema["doc_id"].dataType)
    for name in ("doc_key", "n_shingles", "node", "h", "times"):
        schema = schema.add(name, "long")
    kinds = [to_arrow_type(f.dataType) for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, held, size = set(), [], 0

        def rows(given: dict[int, pa.Array]) -> pa.RecordBatch:
            n = len(next(iter(given.values())))
            return pa.RecordBatch.from_arrays([given.get(k, pa.nulls(n, kind)) for k, kind in enumerate(kinds)], names=schema.names)

        def shared() -> pa.RecordBatch:
            """Shingles held at least twice, sorted in place and without counting the others: a worker has little room."""
            values = np.concatenate([np.empty(0, np.uint64), *held])
            held.clear()
            values.sort()
            twice = values[1:] == values[:-1]  # those of one shingle are a run of its times less one
            edges = np.flatnonzero(np.diff(np.r_[False, twice, False].view(np.int8)))
            return rows({4: pa.array(values[edges[::2]].view(np.int64)), 5: pa.array(edges[1::2] - edges[::2] + 1)})

        for batch in batches:
            n, nodes = [], []
            for s in shingle_sets(batch.column(2), words):
                node = _node(s)
                n.append(len(s))
                nodes.append(node if len(s) else None)
                if node not in seen:
                    if len(seen) < REMEMBERED:
                        seen.add(node)
                    held.append(s)
                    size += len(s)
                    if size > 6_000_000:
                        yield shared()
                        size = 0
            yield rows({0: batch.column(0), 1: batch.column(1), 2: pa.array(n, pa.int64()), 3: pa.array(nodes, pa.int64())})
        yield shared()

    return docs.select("doc_id", row_key("doc_id", "text").alias("doc_key"), text_bytes().alias("t")).mapInArrow(run, schema)


def points(docs: DataFrame, words: int = WORDS) -> tuple[DataFrame, DataFrame]:
    """(doc_id, doc_key, n_shingles, node) per row, and (h, times) of shingles that points share."""
    both = stored(_read(docs, words))
    return both.where("times is null").drop("h", "times"), both.where("times is not null").select("h", "times")


def _common_shingles(shared: DataFrame) -> np.ndarray:
    """Shingles of many points, sorted: counted in full per task, handed on from two points a task on."""
    total = shared.groupBy("h").agg(F.sum("times").alias("n")).where(F.col("n") >= COMMON)
    rows = total.orderBy(F.desc("n"), "h").limit(COMMON_LISTED).select("h").toPandas()
    return np.sort(rows["h"].to_numpy(np.int64).view(np.uint64))


def cells(docs: DataFrame, common: np.ndarray, words: int = WORDS, threshold: int = THRESHOLD) -> DataFrame:
    """(h, most, node, n): the first shingles of each point of size ``n``, as cells. If ``h`` is the first shingle that the point shares
    with a linked one, that one is at most ``most`` large; rows without another such point in their cell are left out."""
    held = docs.sparkSession.sparkContext.broadcast(common)

    def make() -> Callable:
        last, seen = held.value, set()

        def step(_: tuple, s: np.ndarray) -> Iterator[tuple]:
            node = _node(s)
            if not len(s) or node in seen:
                return
            if len(seen) < REMEMBERED:
                seen.add(node)
            take = len(s) * (100 - threshold) // 100 + 1
            if len(last):
                at = np.minimum(np.searchsorted(last, s), len(last) - 1)
                often = last[at] == s
                s = np.r_[s[~often], s[often]]
            most = (len(s) - np.arange(take)) * (100 + threshold) // threshold - len(s)
            yield s[:take].view(np.int64), most.astype(np.int32), np.full(take, node, np.int64), np.full(take, len(s), np.int32)

        return step

    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int32()]
    rows = _each_set(docs.select(text_bytes().alias("t")), make, "h bigint, most int, node bigint, n int", kinds, words)
    ranged = rows.repartition(slices(docs.sparkSession), "h").sortWithinPartitions("h", "n", "node")

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Distinct rows that may meet another of their cell. The rows come by cell and size; the last one is carried from batch to
        batch, with the largest ``most`` before it in its cell (-1 if none is) and the least size there."""
        carry: pa.Table | None = None
        reached, least, kept = -1, 0, False
        for batch in batches:
            table = pa.Table.from_batches([batch])
            if carry is not None:
                table = pa.concat_tables([carry, table])
            if table.num_rows == 0:
                continue
            h, node = table["h"].to_numpy(), table["node"].to_numpy()
            fresh = np.r_[True, (h[1:] != h[:-1]) | (node[1:] != node[:-1])]
            table, h = table.filter(pa.array(fresh)), h[fresh]
            n, most = (table[c].to_numpy().astype(np.int64) for c in ("n", "most"))
            new = np.r_[carry is None, h[1:] != h[:-1]]
            cell = np.cumsum(new)
            high = cell << 33  # sets the cells apart in one running maximum
            before = np.maximum.accumulate(np.where(new, -1, np.r_[reached, most[:-1]]) + high) - high
            first = np.maximum.accumulate(np.where(new, np.arange(len(h)), 0))
            smallest = np.where(cell == 0, least, n[first])
            after = np.r_[(n[1:] <= most[:-1]) & ~new[1:], False]
            keep = (before >= n) & (smallest <= most) | after
            yield from table.slice(0, len(h) - 1).filter(pa.array(keep[:-1])).combine_chunks().to_batches()
            carry, reached, least, kept = table.slice(len(h) - 1), int(before[-1]), int(smallest[-1]), bool(keep[-1])
        if kept:
            yield from carry.combine_chunks().to_batches()

    return ranged.mapInArrow(met, rows.schema)


def _texts_of(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, t): the texts of each point in ``nodes`` (node, doc_key); a row that repeats comes as often."""
    texts = docs.select(row_key("doc_id", "text").alias("doc_key"), text_bytes().alias("t"))
    return texts.join(small(nodes, 48), "doc_key").select("node", "t")


def _sketches(docs: DataFrame, nodes: DataFrame, words: int) -> DataFrame:
    """(node, n, sketch) of each point: the size and histogram of its set."""

    def make() -> Callable:
        def step(row: tuple, s: np.ndarray) -> Iterator[tuple]:
            yield (row[0], len(s), _sketch(s).tobytes())

        return step

    rows = _each_set(_texts_of(docs, nodes), make, "node bigint, n bigint, sketch binary", [pa.int64(), pa.int64(), pa.binary()], words)
    return rows.dropDuplicates(["node"])


def _sets(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, words: int) -> DataFrame:
    """(node, items) of the points that ``pairs`` (a, b) are made of, read again; a point may come more than once."""

    def make() -> Callable:
        def step(row: tuple, s: np.ndarray) -> Iterator[tuple]:
            yield (row[0], s.view(np.int64).tobytes())

        return step

    needed = stored(nodes.join(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "node"))
    return _each_set(_texts_of(docs, needed), make, "node bigint, items binary", [pa.int64(), pa.binary()], words)


def _dealt(pairs: DataFrame) -> DataFrame:
    """``pairs`` (a, b) with a ``place``: those of one ``a`` together, at most about ``BLOCK`` of them."""
    many = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("k"))
    return pairs.join(many, "a").select("a", "b", F.xxhash64("a", F.pmod(F.xxhash64("b"), F.col("k"))).alias("place"))


def _sketch(shingles: np.ndarray) -> np.ndarray:
    """Histogram of a set by the leading bits of its shingles; the number of buckets is a power of two."""
    bits = max(BUCKETS.bit_length() - 1, min((len(shingles) // 4).bit_length(), MOST_BUCKETS.bit_length() - 1))
    return np.minimum(np.bincount((shingles >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits), 255).astype(np.uint8)


def _folded(rows: np.ndarray, width: int) -> np.ndarray:
    """Histograms with ``width`` buckets, made of finer ones."""
    while rows.shape[1] > width:
        rows = np.minimum(rows[:, ::2].astype(np.uint16) + rows[:, 1::2], 255).astype(np.uint8)
    return rows


def _apart(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Sums of differences of histograms, in the buckets of the coarser ones: at most the size of the symmetric difference."""
    width = min(x.shape[1], y.shape[1])
    x, y = _folded(x, width), _folded(y, width)
    return (np.maximum(x, y) - np.minimum(x, y)).sum(1, dtype=np.int64)


class _Sketches:
    """Histograms of the rows of a binary column, in one array for each number of buckets."""

    def __init__(self, column: pa.Array | pa.ChunkedArray):
        values = column.to_pylist()
        self.width = np.array([len(v) for v in values], np.int64)
        self.place = np.empty(len(values), np.int64)
        self.rows = {}
        for w in np.unique(self.width).tolist():
            at = np.flatnonzero(self.width == w)
            self.place[at] = np.arange(len(at))
            self.rows[w] = np.frombuffer(b"".join([values[k] for k in at.tolist()]), np.uint8).reshape(len(at), w)

    @cached_property
    def coarse(self) -> np.ndarray:
        """All rows with the fewest buckets, to be compared first."""
        result = np.empty((len(self.width), BUCKETS), np.uint8)
        for w, rows in self.rows.items():
            result[self.width == w] = _folded(rows, BUCKETS)
        return result

    def of(self, width: int, at: np.ndarray | int) -> np.ndarray:
        return self.rows[width][self.place[at]]

    def apart_from(self, x: int, y: np.ndarray) -> np.ndarray:
        """How far the rows ``y`` are from row ``x`` at least."""
        mine = self.of(int(self.width[x]), x)[None]
        if len(self.rows) == 1:
            return _apart(self.of(int(self.width[x]), y), mine)
        result = np.empty(len(y), np.int64)
        for w in np.unique(self.width[y]).tolist():
            k = self.width[y] == w
            result[k] = _apart(self.of(w, y[k]), mine)
        return result


def _apart_by_row(x: _Sketches, y: _Sketches) -> np.ndarray:
    result = np.empty(len(x.width), np.int64)
    for v in x.rows:
        for w in y.rows:
            at = np.flatnonzero((x.width == v) & (y.width == w))
            if len(at):
                result[at] = _apart(x.of(v, at), y.of(w, at))
    return result


def _marks() -> list:
    """Aggregates that set one bit for each cell of a point."""
    return [F.expr(f"bit_or(if(pmod(h, {64 * MARKS}) div 64 = {k}, shiftleft(1L, cast(pmod(h, 64) as int)), 0L))").alias(f"m{k}") for k in range(MARKS)]


def _is_link(threshold: int):
    return F.col("common") * 100 >= (F.col("na") + F.col("nb") - F.col("common")) * threshold


def _block_pairs(regions: DataFrame, facts: DataFrame, threshold: int) -> DataFrame:
    """Candidate pairs (a, b, place), within the three windows. Two points that share a cell meet in the home region of each: the one
    with the smaller name asks, at home, and the other is told, so a pair is met once, in the block pair ``place``. A pair links
    two clusters, so one of it is an outsider of the region: in large regions only outsiders are told to who is not one. What
    lies near a pivot is known, so ``regions`` has no pivots. ``facts`` (node, sketch, marks) join the members where they are dealt out."""
    asking = F.col("home")
    number = lambda those: F.sum(those.cast("long"))
    counts = regions.groupBy("pivot").agg(
        F.count(F.lit(1)).alias("all"), number(F.col("outside")).alias("out"), number(asking).alias("ask"), number(asking & F.col("outside")).alias("ask_out")
    )
    large = F.col("ask") > BLOCK
    blocks_of = lambda n: F.ceil(n / BLOCK).cast("int")
    n_blocks = counts.where("out > 0 and ask > 0 and all > 1").select(
        "pivot", large.alias("large"), blocks_of(F.col("all")).alias("told_all"), blocks_of(F.col("out")).alias("told_out"),
        blocks_of(F.when(large, F.col("ask_out")).otherwise(F.col("ask"))).alias("ask_all"),
        blocks_of(F.when(large, F.col("ask") - F.col("ask_out")).otherwise(0)).alias("ask_few"),
    )
    dealt = regions.join(n_blocks, "pivot").withColumn("every", ~F.col("large") | F.col("outside"))
    fields = ["pivot", "node", "n", "root", "low", "high"]
    spot = F.xxhash64("node")
    each = lambda count: F.explode(F.sequence(F.lit(0), count - 1))
    mine = F.pmod(spot, F.when(F.col("every"), F.col("ask_all")).otherwise(F.col("ask_few"))).cast("int")
    asks = dealt.where(asking).select(
        *fields, "every", mine.alias("i"), each(F.when(F.col("every"), F.col("told_all")).otherwise(F.col("told_out"))).alias("j"), F.lit(True).alias("asks")
    )

    def told(rows: DataFrame, every: bool, count: str, blocks: str) -> DataFrame:
        met = rows.where(F.col(count) > 0)
        return met.select(*fields, F.lit(every).alias("every"), each(F.col(count)).alias("i"), F.pmod(spot, F.col(blocks)).cast("int").alias("j"), F.lit(False).alias("asks"))

    both = asks.unionByName(told(dealt, True, "ask_all", "told_all")).unionByName(told(dealt.where("outside"), False, "ask_few", "told_out"))
    place = F.xxhash64("pivot", "every", "i", "j")
    both = both.select(place.alias("place"), "node", "n", "root", "low", "high", "asks").join(facts, "node")
    ranged = both.repartition(slices(regions.sparkSession), "place").sortWithinPartitions("place", F.desc("asks"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []

        def blocks() -> Iterator[pa.Table]:
            nonlocal held
            for batch in batches:
                if batch.num_rows == 0:
                    continue
                table = pa.Table.from_batches([batch])
                place = table["place"].to_numpy()
                cuts = np.flatnonzero(place[1:] != place[:-1]) + 1
                if held and held[-1]["place"][-1].as_py() != place[0]:
                    yield pa.concat_tables(held)
                    held = []
                at = 0
                for cut in cuts.tolist():
                    yield pa.concat_tables([*held, table.slice(at, cut - at)])
                    held, at = [], cut
                held.append(table.slice(at))
            if held:
                yield pa.concat_tables(held)

        for table in blocks():
            asks = table["asks"].to_numpy()
            k = int(asks.sum())
            if not k or k == len(asks):
                continue
            n, node, root, least, most = (table[c].to_numpy() for c in ("n", "node", "root", "low", "high"))
            sketches = _Sketches(table["sketch"])
            marks = pc.list_flatten(table["marks"]).to_numpy().reshape(len(n), MARKS)
            order = k + np.argsort(n[k:], kind="stable")
            told_n, told_node, told_root, told_least, told_most = (v[order] for v in (n, node, root, least, most))
            told_marks = np.ascontiguousarray(marks[order].T)
            a_out, b_out = [], []
            for x in range(k):
                low, high = np.searchsorted(told_n, [-(-n[x] * threshold // 100), n[x] * 100 // threshold + 1])
                at = np.flatnonzero(marks[x])
                fits = np.bitwise_or.reduce(told_marks[at, low:high] & marks[x, at][:, None], axis=0) != 0
                fits &= (told_node[low:high] > node[x]) & (told_root[low:high] != root[x])
                fits &= np.maximum(told_least[low:high] - most[x], least[x] - told_most[low:high]) <= (100 - threshold) / 100 + 1e-9
                y = order[low + np.flatnonzero(fits)]
                if not len(y):
                    continue
                y = y[_apart(sketches.coarse[y], sketches.coarse[x][None]) * (100 + threshold) <= (n[y] + n[x]) * (100 - threshold)]
                if len(y) and max(sketches.rows) > BUCKETS:
                    y = y[sketches.apart_from(x, y) * (100 + threshold) <= (n[y] + n[x]) * (100 - threshold)]
                a_out.append(np.full(len(y), node[x]))
                b_out.append(node[y])
            if a_out:
                pair = np.concatenate(a_out), np.concatenate(b_out)
                here = np.full(len(pair[0]), table["place"][0].as_py(), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(pair[0]), pa.array(pair[1]), pa.array(here)], names=["a", "b", "place"])

    return ranged.mapInArrow(run, "a long, b long, place long")


def _verified_by_place(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """``pairs`` (a, b, place) as (a, b, na, nb, common): both sizes and the size of the intersection, null where a finer histogram
    already rules a link out. The sets of a place are brought there once, not once per pair."""
    needed = pairs.select("place", F.explode(F.array("a", "b")).alias("a")).distinct()
    items = needed.join(sets.select(F.col("node").alias("a"), "items"), "a").select("place", "a", F.lit(None).cast("long").alias("b"), "items")
    both = items.unionByName(pairs.select("place", "a", "b", F.lit(None).cast("binary").alias("items")))
    ranged = both.repartition(slices(pairs.sparkSession), "place").sortWithinPartitions("place", F.col("b").asc_nulls_first())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, held, fine, at = None, [], [], {}
        for batch in batches:
            places, a, b = (batch.column(k).to_pylist() for k in range(3))
            x, y = [], []

            def out() -> Iterator[pa.RecordBatch]:
                if x:
                    i, j = np.array([at[n] for n in x]), np.array([at[n] for n in y])
                    n = np.array([len(v) for v in held], np.int64)
                    rows = np.stack(fine).astype(np.int32)
                    common: list[int | None] = [None] * len(x)
                    for k in range(0, len(i), 8192):
                        u, v = i[k : k + 8192], j[k : k + 8192]
                        apart = np.abs(rows[u] - rows[v]).sum(1)
                        for p in np.flatnonzero(apart * (100 + threshold) <= (n[u] + n[v]) * (100 - threshold)).tolist():
                            common[k + p] = len(np.intersect1d(held[u[p]], held[v[p]], assume_unique=True))
                    columns = [x, y, n[i], n[j], common]
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["a", "b", "na", "nb", "common"])
                    x.clear()
                    y.clear()

            for k, here in enumerate(places):
                if here != place:
                    yield from out()
                    place, held, fine, at = here, [], [], {}
                if b[k] is None:
                    values = np.frombuffer(batch.column(3)[k].as_py(), np.uint64)
                    at[a[k]] = len(held)
                    held.append(values)
                    fine.append(np.bincount((values >> np.uint64(55)).astype(np.int64), minlength=FINE).astype(np.int32))
                else:
                    x.append(a[k])
                    y.append(b[k])
            yield from out()

    return ranged.select("place", "a", "b", "items").mapInArrow(run, "a long, b long, na long, nb long, common long")


def _verified_in_rounds(pairs: DataFrame, sets: DataFrame, found: DataFrame, threshold: int) -> list[DataFrame]:
    """The links (a, b) among ``pairs``, as stored tables. A set is brought to every place that compares it; so many places take part
    in a round that it moves no more than all sets of the input take once, and its shuffle files go before the next."""
    needed = pairs.select("place", F.explode(F.array("a", "b")).alias("node")).distinct()
    size = sets.select("node", F.octet_length("items").alias("size"))
    moved = needed.join(size, "node").agg(F.sum("size")).first()[0] or 0
    held = 8 * (found.agg(F.sum("n_shingles")).first()[0] or 1)
    rounds = max(1, -(-moved // held))
    links = []
    for k in range(rounds):
        some = pairs.where(F.pmod("place", F.lit(rounds)) == k)
        links.append(stored(_verified_by_place(some, sets, threshold).where(_is_link(threshold)).select("a", "b"), free=True))
    return links


def links(docs: DataFrame, found: DataFrame, shared: DataFrame, words: int = WORDS, threshold: int = THRESHOLD) -> DataFrame:
    """Enough links (a, b) between points to connect all that are connected; each holds exactly."""
    common = _common_shingles(shared)
    cell = stored(cells(docs, common, words, threshold))
    places = F.max(F.floor(F.col("n") * (100 - threshold) / 100) + 1)
    ranks = stored(cell.groupBy("node").agg((-F.count(F.lit(1)) / places).alias("rank"), *_marks()), free=True)
    ranked = cell.join(ranks.select("node", "rank"), "node").select("h", F.struct("rank", "node", "n").alias("x"))
    center = ranked.groupBy("h").agg(F.min("x").alias("top"))
    top = cell.select("h", "node", "n").join(center, "h").groupBy("node", "n").agg(F.min("top").alias("p"))
    pivots = stored(top.select("node", "n", F.col("p.node").alias("pivot"), F.col("p.n").alias("pn")), free=True)
    # A region has its own points and every point that meets one of them in a cell.
    own = cell.join(pivots.select("node", "pivot", "pn"), "node")
    reach = own.groupBy("h", "pivot", "pn").agg(F.min("n").alias("least"), F.max("most").alias("reached"))
    met = cell.join(reach, "h").where("n <= reached and least <= most").select("node", "n", "pivot", "pn")
    members = stored(pivots.union(met).where("node <> pivot").distinct(), cell, free=True)
    one_text = found.where("node is not null").groupBy("node").agg(F.min("doc_key").alias("doc_key"))
    texts = stored(one_text.join(pivots.select("node"), "node"))
    sizes = stored(_sketches(docs, texts, words), free=True)
    # Distance to the pivot: exact where the size and histogram bounds allow a link, else known to be beyond r.
    less, more = F.least("n", "pn"), F.greatest("n", "pn")
    members = members.withColumns({c: F.col(c).cast("long") for c in ("n", "pn")}).withColumn("like", less * 100 >= more * threshold)
    sketch = sizes.select("node", "sketch")
    like = members.where("like").join(sketch.select(F.col("node").alias("pivot"), F.col("sketch").alias("ps")), "pivot").join(sketch, "node")
    unlike = members.where("not like").select("pivot", "node", "n", F.lit(False).alias("maybe"), (1 - less / more).alias("least"))
    known = stored(_bounded(like, threshold).union(unlike), members, free=True)
    near = stored(_dealt(known.where("maybe").select(F.col("pivot").alias("a"), F.col("node").alias("b"))))
    sets = stored(_sets(docs, texts, near, words), free=True)
    checked = stored(_verified_by_place(near, sets, threshold), near, sets, free=True)
    first = checked.where(_is_link(threshold)).select("a", "b")
    roots = components(first)
    label = sizes.select("node").join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"))
    label = stored(label)
    exact = (1 - F.col("common") / (F.col("na") + F.col("nb") - F.col("common"))).alias("exact")
    apart = checked.select(F.col("a").alias("pivot"), F.col("b").alias("node"), exact)
    region = (
        known.join(label, "node")
        .join(label.select(F.col("node").alias("pivot"), F.col("root").alias("proot")), "pivot")
        .join(pivots.select("node", F.col("pivot").alias("own")), "node")
        .join(apart, ["pivot", "node"], "left")
        .select("pivot", "node", "n", "root", (F.col("own") == F.col("pivot")).alias("home"), (F.col("root") != F.col("proot")).alias("outside"),
                F.coalesce("exact", "least").alias("low"), F.coalesce("exact", F.lit(1.0)).alias("high"))
    )
    tried = checked.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    region = stored(region, known, label, free=True)
    marks = ranks.select("node", F.array(*[f"m{k}" for k in range(MARKS)]).alias("marks"))
    facts = stored(sizes.select("node", "sketch").join(marks, "node"), ranks, sizes, free=True)
    rest = stored(_block_pairs(region, facts, threshold).join(tried, ["a", "b"], "left_anti"), region, facts, free=True)
    sets = stored(_sets(docs, texts, rest, words), free=True)
    second = _verified_in_rounds(rest, sets, found, threshold)
    return stored(reduce(DataFrame.union, second, first), rest, sets, checked, texts, *second, free=True)


def _bounded(rows: DataFrame, threshold: int) -> DataFrame:
    """(pivot, node, n, maybe, least): whether a link to the pivot is possible by size and histogram."""
    schema = "pivot long, node long, n long, maybe boolean, least double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, pn = batch.column(2).to_numpy(), batch.column(4).to_numpy()
            apart = _apart_by_row(_Sketches(batch.column(3)), _Sketches(batch.column(5)))
            maybe = (apart * (100 + threshold) <= (n + pn) * (100 - threshold)) & (np.minimum(n, pn) * 100 >= np.maximum(n, pn) * threshold)
            least = 1 - np.maximum(n + pn - apart, 0) / (n + pn + apart)
            arrays = [*batch.columns[:3], pa.array(maybe), pa.array(least)]
            yield pa.RecordBatch.from_arrays(arrays, names=["pivot", "node", "n", "maybe", "least"])

    return rows.select("pivot", "node", "n", "sketch", "pn", "ps").mapInArrow(run, schema)


def join_components(docs: DataFrame, words: int = WORDS, threshold: int = THRESHOLD) -> DataFrame:
    """doc_id, doc_key, n_shingles, component_id (smallest doc_id reachable by links, itself included) per row."""
    with small_batches(docs.sparkSession):
        found, shared = points(docs, words)
        roots = components(links(docs, found, shared, words, threshold))
    grouped = found.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = grouped.where("root is not null").groupBy("root").agg(F.min("doc_id").alias("least"))
    return grouped.join(least, "root", "left").select(
        "doc_id", "doc_key", "n_shingles", F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id")
    )


def report(docs: DataFrame) -> DataFrame:
    return join_components(docs.select("doc_id", "text")).select("doc_id", "n_shingles", "component_id")
