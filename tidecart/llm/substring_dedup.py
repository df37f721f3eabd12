"""Exact removal of long repeated passages on a compacted de Bruijn graph of token k-mers.

The windows of ``window`` words whose smallest k-mer (by hash) is the same edge of the graph, at the same place of a text, form a
path; consecutive paths cover the text. Any window that repeats selects the same k-mer in each text, so only k-mers that
start paths in more than one document need to be looked at, and of the windows nothing else is exchanged than one
row per path (about one in thirteen windows).

1. Paths of every text: smallest k-mer, 128-bit digest of the words covered, document, place.
2. K-mers with paths in two documents survive (partial minima and maxima, then a join on the k-mer).
3. Nonbranching: paths with one digest are one node, whose windows all belong to its smallest document.
4. Branching: where one k-mer has several digests, one path of each is opened into its windows, read again at its source
   coordinates, and the windows are matched by digest.
5. Spans of covered words are cut from the texts.

Words are runs of other than ASCII white space, unchanged. Null texts have no words. Rows without an id are kept whole and
are no source; rows that repeat an id are no source for each other. Extra columns are ignored; empty in, empty out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecart.llm.common import Sums, hashed_words, mixed, row_key, small, stored, text_bytes

WINDOW, KMER = 50, 25
_DIGEST = ["d1", "d2"]


#: Windows of one path at most, so that a text that repeats one word is no single endless path.
LONGEST = 64
_OTHER_BASE = 0xA24BAED4963EE407


class _Digests:
    """128-bit digests of ranges of words."""

    def __init__(self, hashes: np.ndarray):
        self.one, self.two = Sums(hashes), Sums(mixed(hashes), _OTHER_BASE)

    def of(self, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return tuple(s.of(start, end).view(np.int64) for s in (self.one, self.two))


def paths(docs: DataFrame, window: int = WINDOW, kmer: int = KMER) -> DataFrame:
    """(km, d1, d2, doc_id, doc_key, at, n): windows ``at`` to ``at + n - 1`` of a text share the smallest k-mer ``km``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, hashes, begins in hashed_words(batch.column(2), lower=False):
                least, row, at, n = _paths_of(hashes, begins, window, kmer)
                first = begins[row] + at
                digests = _Digests(hashes).of(first, first + n + window - 1)
                rows = pa.array(row + low)
                ids = [batch.column(k).take(rows) for k in (0, 1)]
                arrays = [pa.array(least), *map(pa.array, digests), *ids, pa.array(at, pa.int32()), pa.array(n, pa.int32())]
                yield pa.RecordBatch.from_arrays(arrays, names=["km", "d1", "d2", "doc_id", "doc_key", "at", "n"])

    schema = "km long, d1 long, d2 long, doc_id long, doc_key long, at int, n int"
    source = docs.where("doc_id is not null").select(
        F.col("doc_id").cast("long"), row_key("doc_id", "text").alias("doc_key"), text_bytes().alias("t")
    )
    return source.mapInArrow(run, schema)


def _paths_of(hashes: np.ndarray, begins: np.ndarray, window: int, kmer: int) -> tuple[np.ndarray, ...]:
    """Smallest k-mer, row, first window and number of windows of each path of a block of texts laid end to end."""
    n = len(hashes) - window + 1
    if n <= 0:
        return tuple(np.empty(0, np.int64) for _ in range(4))
    place = np.arange(len(hashes) - kmer + 1)
    least, covered = Sums(hashes).of(place, place + kmer), 1
    span = window - kmer + 1
    while covered < span:  # minima of ever longer runs of k-mers
        step = min(covered, span - covered)
        least = np.minimum(least[:-step], least[step:])
        covered += step
    sizes = np.diff(begins)
    row = np.repeat(np.arange(len(sizes)), sizes)[:n]
    inside = np.arange(n) + window <= begins[row + 1]
    place, least, row = np.flatnonzero(inside), least[:n][inside], row[inside]
    if not len(place):
        return tuple(np.empty(0, np.int64) for _ in range(4))
    starts = np.r_[True, (least[1:] != least[:-1]) | (row[1:] != row[:-1])]
    run = np.flatnonzero(starts)
    since = np.arange(len(place)) - np.repeat(run, np.diff(np.r_[run, len(place)]))
    run = np.flatnonzero(since % LONGEST == 0)
    return least[run].view(np.int64), row[run], place[run] - begins[row[run]], np.diff(np.r_[run, len(place)])


def _opened(docs: DataFrame, wanted: DataFrame, window: int) -> DataFrame:
    """(d1, d2, j, w1, w2): digest of window ``j`` of each path in ``wanted`` (doc_key, paths), read from its text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, hashes, begins in hashed_words(batch.column(0), lower=False):
                todo = batch.column(1).slice(low, high - low)
                of = np.repeat(np.arange(high - low), np.diff(todo.offsets.to_numpy()))
                flat = todo.flatten()
                d1, d2, at, n = (flat.field(k).to_numpy() for k in ("d1", "d2", "at", "n"))
                path = np.repeat(np.arange(len(n)), n)
                j = np.arange(len(path)) - np.repeat(np.cumsum(n) - n, n)
                first = begins[of[path]] + at[path] + j
                w1, w2 = _Digests(hashes).of(first, first + window)
                arrays = [pa.array(d1[path]), pa.array(d2[path]), pa.array(j, pa.int32()), pa.array(w1), pa.array(w2)]
                yield pa.RecordBatch.from_arrays(arrays, names=["d1", "d2", "j", "w1", "w2"])

    texts = docs.select(row_key("doc_id", "text").alias("doc_key"), text_bytes().alias("t")).where(F.octet_length("t") > 0)
    # Few texts are read again; only those are brought to their paths.
    some = texts.join(small(wanted.select("doc_key"), 16), "doc_key", "left_semi")
    chosen = some.join(small(wanted, 32 + 48 * F.size("paths")), "doc_key").select("doc_key", "t", "paths")
    once = chosen.dropDuplicates(["doc_key"]).select("t", "paths")
    return once.mapInArrow(run, "d1 long, d2 long, j int, w1 long, w2 long")


def repeated_spans(docs: DataFrame, window: int = WINDOW, kmer: int = KMER) -> DataFrame:
    """(doc_key, first, last): places of words covered by windows that also start in a document with a smaller id."""
    every = stored(paths(docs, window, kmer))
    shared = every.groupBy("km").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high").select("km")
    kept = stored(every.join(shared, "km"), every, free=True)
    # One node per digest: its smallest document, and one occurrence there as source coordinates.
    nodes = stored(
        kept.groupBy("km", *_DIGEST).agg(F.min(F.struct("doc_id", "doc_key", "at", "n")).alias("source")).select("km", *_DIGEST, "source"), free=True
    )
    owner = nodes.select(*_DIGEST, F.col("source.doc_id").alias("owner"))
    branching = nodes.groupBy("km").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("km")
    open_nodes = stored(nodes.join(branching, "km").select(*_DIGEST, "source"))
    todo = open_nodes.select("source.doc_key", F.struct(*_DIGEST, "source.at", "source.n").alias("p"))
    wanted = stored(todo.groupBy("doc_key").agg(F.collect_list("p").alias("paths")))
    opened = stored(_opened(docs, wanted, window).join(open_nodes.select(*_DIGEST, F.col("source.doc_id").alias("owner")), _DIGEST), wanted, free=True)
    earliest = opened.groupBy("w1", "w2").agg(F.min("owner").alias("low"), F.max("owner").alias("high")).where("low < high").select("w1", "w2", "low")
    partly = opened.join(earliest, ["w1", "w2"]).where("low < owner").groupBy(*_DIGEST).agg(F.collect_set("j").alias("js"))
    placed = kept.join(owner, _DIGEST).select("doc_key", "at", "n", *_DIGEST, (F.col("owner") < F.col("doc_id")).alias("whole"))
    reach = window - 1
    whole = placed.where("whole").select("doc_key", F.col("at").alias("first"), (F.col("at") + F.col("n") - 1 + reach).alias("last"))
    part = placed.where("not whole").join(partly, _DIGEST).select("doc_key", "at", F.explode("js").alias("j"))
    part = part.select("doc_key", (F.col("at") + F.col("j")).alias("first"), (F.col("at") + F.col("j") + reach).alias("last"))
    return stored(whole.union(part).distinct(), kept, nodes, open_nodes, opened, free=True)


def remove_repeats(docs: DataFrame, window: int = WINDOW, kmer: int = KMER) -> DataFrame:
    """doc_id, doc_key, n_words, n_removed and ``kept`` (the remaining words joined by one blank) for every row of ``docs``."""
    spans = repeated_spans(docs, window, kmer)
    cuts = stored(spans.groupBy("doc_key").agg(F.collect_list(F.struct("first", "last")).alias("cuts")), spans, free=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, todo in zip(batch.column(2), batch.column(3)):
                words = text.as_py().split()
                n, gone, kept = len(words), 0, words
                if todo.is_valid:
                    edge = np.zeros(n + 1, np.int64)
                    for c in todo.as_py():
                        edge[c["first"]] += 1
                        edge[c["last"] + 1] -= 1
                    keep = np.cumsum(edge[:n]) == 0
                    kept = [words[k] for k in np.flatnonzero(keep)]
                    gone = n - len(kept)
                rows.append((n, gone, b" ".join(kept).decode("utf-8", "replace")))
            n_words, removed, kept_text = zip(*rows) if rows else ((), (), ())
            arrays = [batch.column(0), batch.column(1), pa.array(n_words, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept_text, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "doc_key", "n_words", "n_removed", "kept"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", row_key("doc_id", "text").alias("doc_key"), text_bytes().alias("t"))
    # Texts without a cut, by far the most, stay where they are.
    keys = small(cuts.select("doc_key"), 16)
    none = F.lit(None).cast(cuts.schema["cuts"].dataType)
    cut = rows.join(keys, "doc_key", "left_semi").join(small(cuts, 32 + 24 * F.size("cuts")), "doc_key", "left")
    joined = cut.select("doc_id", "doc_key", "t", "cuts").union(rows.join(keys, "doc_key", "left_anti").select("doc_id", "doc_key", "t", none))
    return joined.mapInArrow(run, f"doc_id {kind}, doc_key long, n_words long, n_removed long, kept string")


def report(docs: DataFrame) -> DataFrame:
    found = remove_repeats(docs.select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
