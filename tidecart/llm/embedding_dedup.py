"""Near copies among embeddings with an inverted multi-index.

1. Equal vectors are one point with a multiplicity; vectors that are null, zero, or hold null or non-finite components are
   set aside.
2. Each half of the normed vectors gets its own codebook (k-means on a bounded, hashed sample); a point lies in the cell of its
   two nearest codewords.
3. Multi-sequence traversal: from the two lists of codewords by distance, each point visits the cells in order of the sum of
   both distances, so many that at least ``TARGET`` of the true neighbours of a sample lie in them (measured against all
   points, in blocks), and as many of the neighbours made for the sample right at the threshold, which stand in where near copies
   are rare. Every point is indexed and every point asks.
4. Cells are verified in double precision, block against block; only counts and a spanning set of links leave a block. A link
   that one of its ends finds counts for both: the end that is found is credited too, unless it visits the finder's cell itself.

Vectors of different lengths never link. Rows that repeat a vec_id are vectors of their own with that id; a null id is never
the smallest. Extra columns are ignored; empty in, empty out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecart.llm.common import slices, stored
from tidecart.llm.graph import components

THRESHOLD = 0.95
#: Recall the traversal is calibrated to (of the sample's true neighbours), and the rows of the samples.
TARGET, TRAIN_ROWS, PROBE_ROWS = 0.998, 8192, 2048
#: Points per cell aimed at, codewords per half at most, points of one block.
PER_CELL, CODEWORDS, BLOCK = 4.0, 1024, 2048
#: Numbers of one step of an exact distance table.
STEP = 1 << 21


def points(vectors: DataFrame) -> DataFrame:
    """(point, dim, x, copies): distinct usable vectors; ``point`` is a hash of the components, ``x`` their doubles."""
    x = F.transform(F.col("embedding"), lambda v: v.cast("double"))
    usable = F.col("embedding").isNotNull() & (F.size("embedding") > 0)
    fine = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))) & F.exists("x", lambda v: v != 0)
    rows = vectors.where(usable).select("vec_id", x.alias("x")).where(F.coalesce(fine, F.lit(False)))
    return rows.select("vec_id", F.xxhash64("x", F.size("x")).alias("point"), "x")


def _normed(batch: pa.RecordBatch, column: int) -> np.ndarray:
    flat = batch.column(column)
    width = len(flat[0]) if len(flat) else 1
    x = flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)
    x = x / np.abs(x).max(1, keepdims=True)  # so that squares neither overflow nor vanish
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def kmeans(x: np.ndarray, k: int, rounds: int = 12, seed: int = 7) -> np.ndarray:
    rng = np.random.default_rng(seed)
    k = max(1, min(k, len(np.unique(x, axis=0))))
    centers = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        near = np.concatenate([_distances(x[low : low + 2048], centers).argmin(1) for low in range(0, len(x), 2048)])
        sums = np.zeros_like(centers)
        np.add.at(sums, near, x)
        counts = np.bincount(near, minlength=k)
        centers = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centers)
    return centers


def _distances(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] + (centers * centers).sum(1)[None] - 2 * x @ centers.T, 0)


def _exact(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Squared distances that come out the same in whatever block a row stands."""
    out = np.empty((len(x), len(centers)))
    step = max(1, STEP // max(1, centers.size))
    for low in range(0, len(x), step):
        apart = x[low : low + step, None] - centers[None]
        out[low : low + step] = (apart * apart).sum(2)
    return out


def traversal(first: np.ndarray, second: np.ndarray, cells: int) -> tuple[np.ndarray, np.ndarray]:
    """For each row the ``cells`` nearest cells of the product grid as i * columns + j, nearest first and ties by number, and the
    sum of both distances. Only codewords among the first ``cells`` of a half can be part of it, and (a, b) comes after all
    (a', b') with a' <= a and b' <= b: ranks with (a + 1) * (b + 1) > cells need not be looked at."""
    ka, kb = first.shape[1], second.shape[1]
    cells = min(cells, ka * kb)
    oa, ob = np.argsort(first, 1, kind="stable"), np.argsort(second, 1, kind="stable")
    a, b = np.meshgrid(np.arange(min(ka, cells)), np.arange(min(kb, cells)), indexing="ij")
    inside = (a + 1) * (b + 1) <= cells
    a, b = a[inside], b[inside]
    sums = np.take_along_axis(first, oa, 1)[:, a] + np.take_along_axis(second, ob, 1)[:, b]
    cell = oa[:, a] * kb + ob[:, b]
    best = np.lexsort((cell, sums), 1)[:, :cells]
    return np.take_along_axis(cell, best, 1), np.take_along_axis(sums, best, 1)


def _halves(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    cut = max(1, x.shape[1] // 2)
    return x[:, :cut], x[:, cut:]


def _calibrate(one: DataFrame, x: np.ndarray, books: tuple[np.ndarray, np.ndarray], threshold: float) -> int:
    """Cells to visit so that ``TARGET`` of the true neighbours of sampled points (brute force over all points) are found, and of
    neighbours in random directions at the threshold itself."""
    made = _made_neighbours(x, books, threshold)
    held = one.sparkSession.sparkContext.broadcast((x, books))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        probes, (left, right) = held.value
        pa_, pb_ = _halves(probes)
        da, db = _distances(pa_, left), _distances(pb_, right)
        wide = len(right)
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                y = _normed(batch.slice(at, 1024), 0)
                q, r = np.nonzero(probes @ y.T >= threshold)
                ya, yb = _halves(y)
                home = _distances(ya, left).argmin(1) * wide + _distances(yb, right).argmin(1)
                met, n = np.unique(q * (len(left) * wide) + home[r], return_counts=True)
                q, cell = np.divmod(met, len(left) * wide)
                rank = [int(((da[i][:, None] + db[i]) < da[i, c // wide] + db[i, c % wide]).sum()) + 1 for i, c in zip(q, cell)]
                yield pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(rank, pa.int64()), pa.array(n, pa.int64())], names=["q", "cells", "n"])

    found = one.select("x").mapInArrow(run, "q long, cells long, n long").groupBy("q", "cells").agg(F.sum("n").alias("n")).toPandas()
    if not len(found):
        return made
    # Recall over all pairs, and with each point counting alike, so that a large group does not speak for all.
    found["even"] = found["n"] / found.groupby("q")["n"].transform("sum")
    found = found.sort_values("cells")
    share = np.minimum(*[(found[c].cumsum() / found[c].sum()).to_numpy() for c in ("n", "even")])
    return max(made, int(found["cells"].to_numpy()[int((share >= TARGET).argmax())]))


def _made_neighbours(x: np.ndarray, books: tuple[np.ndarray, np.ndarray], threshold: float, seed: int = 11) -> int:
    """Cells to visit so that ``TARGET`` of made pairs are found, from one end or the other."""
    if x.shape[1] < 2:
        return 1
    u = np.random.default_rng(seed).normal(size=x.shape)
    u -= (u * x).sum(1, keepdims=True) * x
    u /= np.maximum(np.sqrt((u * u).sum(1, keepdims=True)), 1e-300)
    y = threshold * x + np.sqrt(1 - threshold**2) * u
    wide = len(books[1])
    tables = [[_exact(half, book) for half, book in zip(_halves(z), books)] for z in (x, y)]
    homes = [(a.argmin(1), b.argmin(1)) for a, b in tables]
    ranks = []
    for (first, second), (i, j) in zip(tables, reversed(homes)):
        rows = np.arange(len(x))
        reach = first[rows, i] + second[rows, j]
        # Per row, cells that are nearer than the partner's: for each codeword of one half, those of the other that fit.
        second = np.sort(second, 1)
        nearer = [sum(np.searchsorted(s, r - f) for f in fs) if wide > 64 else int(((fs[:, None] + s) < r).sum()) for fs, s, r in zip(first, second, reach)]
        ranks.append(np.array(nearer) + 1)
    return int(np.quantile(np.minimum(*ranks), TARGET, method="higher"))


def _sample(one: DataFrame, rows: int) -> np.ndarray:
    batch = pa.RecordBatch.from_pandas(one.orderBy(F.xxhash64("point")).limit(rows).select("x").toPandas())
    return _normed(batch, 0)


def _labels(near: np.ndarray) -> np.ndarray:
    """Component (smallest place) of each side's rows in a block of links, rows first, then columns."""
    n, m = near.shape
    of = np.arange(n + m)
    a, b = np.nonzero(near)
    b = b + n
    while len(a):
        low = np.minimum(of[a], of[b])
        new = of.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == of).all():
            return of
        of = new
    return of


VISIT = ["point", "cell", "rank", "home", "last", "last_cell"]


def _verify(one: DataFrame, books: tuple[np.ndarray, np.ndarray], cells: int, dim: int, threshold: float) -> DataFrame:
    """(a, b, n): ``n`` copies of others next to point ``a`` in one block (b null), or a link between a and b (n null)."""
    spark = one.sparkSession
    held = spark.sparkContext.broadcast(books)

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left, right = held.value
        for batch in batches:
            if not batch.num_rows:
                continue
            xa, xb = _halves(_normed(batch, 1))
            # The candidates of a row are about cells * log(cells).
            step = max(1, STEP // (cells * (1 + int(cells).bit_length())))
            for low in range(0, batch.num_rows, step):
                some = slice(low, low + step)
                to, sums = traversal(_exact(xa[some], left), _exact(xb[some], right), cells)
                n, wide = to.shape
                rows = pa.array(np.repeat(np.arange(low, low + n), wide))
                rank = pa.array(np.tile(np.arange(wide), n), pa.int32())
                each = [pa.array(np.repeat(v, wide)) for v in (to[:, 0], sums[:, -1], to[:, -1])]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), pa.array(to.reshape(-1)), rank, *each], names=VISIT)

    visits = stored(one.select("point", "x").mapInArrow(visit, "point long, cell long, rank int, home long, last double, last_cell long"))
    load = visits.groupBy("cell").agg(
        F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("kq"),
        F.ceil(F.sum((F.col("rank") == 0).cast("long")) / BLOCK).cast("int").alias("kr"),
        F.count(F.lit(1)).alias("all"),
    ).where((F.col("kr") > 0) & (F.col("all") > 1))  # a cell with nobody at home answers nothing
    dealt = visits.join(load, "cell")
    i = F.pmod(F.xxhash64("point"), F.col("kq")).cast("int")
    j = F.pmod(F.xxhash64("point", F.lit(1)), F.col("kr")).cast("int")
    facts = ["home", "last", "last_cell"]
    asks = dealt.select("point", "cell", *facts, i.alias("i"), F.explode(F.sequence(F.lit(0), F.col("kr") - 1)).alias("j"), F.lit(True).alias("asks"))
    home = dealt.where("rank = 0").select("point", "cell", *facts, F.explode(F.sequence(F.lit(0), F.col("kq") - 1)).alias("i"), j.alias("j"), F.lit(False).alias("asks"))
    both = asks.union(home).join(one.select("point", "x", "copies"), "point")
    ranged = both.repartition(slices(spark), "cell", "i", "j").sortWithinPartitions("cell", "i", "j")

    def block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = ["cell", "i", "j"]
        left, right = held.value
        wide = len(right)

        def solve(table: pa.Table) -> pa.RecordBatch:
            asks = table["asks"].to_numpy()
            point, copies = table["point"].to_numpy(), table["copies"].to_numpy()
            x = _normed(table.select(["x"]).combine_chunks().to_batches()[0], 0)
            near = x[asks] @ x[~asks].T >= threshold
            near &= point[asks][:, None] != point[~asks][None]
            # The found end is credited here unless it comes to the finder's home cell itself.
            goal = table["home"].to_numpy()[asks]
            last, last_cell = (table[c].to_numpy()[~asks][None] for c in ("last", "last_cell"))
            ha, hb = _halves(x[~asks])
            way = _exact(ha, left)[:, goal // wide].T + _exact(hb, right)[:, goal % wide].T
            comes = (way < last) | ((way == last) & (goal[:, None] <= last_cell))
            names = np.r_[point[asks], point[~asks]]
            counts = np.r_[near @ copies[~asks], (near & ~comes).T @ copies[asks]]
            some = counts > 0
            of = _labels(near)
            linked = names[of] != names
            a = np.r_[names[some], names[linked]]
            b = [None] * int(some.sum()) + names[of][linked].tolist()
            n = counts[some].tolist() + [None] * int(linked.sum())
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(n, pa.int64())], names=["a", "b", "n"])

        held_rows: list[pa.Table] = []
        key = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            cols = np.stack([table[k].to_numpy() for k in keys])
            cuts = [0, *(np.flatnonzero((cols[:, 1:] != cols[:, :-1]).any(0)) + 1).tolist(), table.num_rows]
            for lo, hi in zip(cuts, cuts[1:]):
                here = tuple(cols[:, lo])
                if key is not None and here != key:
                    yield solve(pa.concat_tables(held_rows))
                    held_rows = []
                key = here
                held_rows.append(table.slice(lo, hi - lo))
        if held_rows:
            yield solve(pa.concat_tables(held_rows))

    return ranged.mapInArrow(block, "a long, b long, n long")


def near_copies(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links, component_id, kept, cells_visited for every row."""
    rows = stored(points(vectors))
    distinct = stored(rows.groupBy("point").agg(F.first("x").alias("x"), F.count(F.lit(1)).alias("copies")).withColumn("dim", F.size("x")))
    sizes = distinct.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).orderBy("dim").collect()  # one row per vector length
    found, depth = None, 0
    for dim, n in sizes:
        one = distinct.where(F.col("dim") == dim)
        k = int(np.clip(np.sqrt(n / PER_CELL), 1, CODEWORDS))
        sample = _sample(one, max(TRAIN_ROWS, 16 * k))
        books = tuple(kmeans(half, k) if half.shape[1] else np.zeros((1, 0)) for half in _halves(sample))
        cells = _calibrate(one, sample[:PROBE_ROWS], books, threshold)
        depth = max(depth, cells)
        part = _verify(one, books, cells, dim, threshold)
        found = part if found is None else found.union(part)
    spark = vectors.sparkSession
    found = stored(found) if found is not None else spark.createDataFrame([], "a long, b long, n long")
    linked = found.where("n is not null").groupBy(F.col("a").alias("point")).agg(F.sum("n").alias("n"))
    roots = components(found.where("b is not null").select("a", "b")).withColumnRenamed("node", "point")
    facts = distinct.select("point", "copies").join(linked, "point", "left").join(roots, "point", "left")
    facts = facts.select("point", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.coalesce("root", "point").alias("root"))
    member = stored(rows.select("vec_id", "point").join(facts, "point"))
    least = member.groupBy("root").agg(F.min("vec_id").alias("component_id"))
    good = member.join(least, "root").select("vec_id", F.col("n_links").cast("long").alias("n_links"), "component_id")
    usable = F.xxhash64(F.transform("embedding", lambda v: v.cast("double")), F.size("embedding"))
    rest = vectors.select("vec_id", usable.alias("point")).join(distinct.select("point"), "point", "left_anti")
    result = good.union(rest.select("vec_id", F.lit(0).cast("long"), F.col("vec_id")))
    return result.select("vec_id", "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)).alias("kept"), F.lit(depth).alias("cells_visited"))


def report(vectors: DataFrame) -> DataFrame:
    return near_copies(vectors.select("vec_id", "embedding")).select("vec_id", "n_links", "component_id", "kept", "cells_visited")
