"""Class-based n-gram language model (Brown classes by exchange) and perplexity of whole texts.

1. Counts of all training words: summed per task first, then by word over the cluster.
2. To begin with, each of the most frequent words is a unit, all others are by the spelling of their ending. Unit bigrams are
   counted over the whole training text; their number is bounded by the number of units squared.
3. Exchange clustering moves units between classes while the class-bigram likelihood grows.
4. Then every other word leaves its spelling: it is counted which classes stand before and behind it, and it moves to the class that
   makes its own bigrams most likely. All words move at once; class bigrams are counted anew with the classes they moved to.
5. log10 P(text) = sum of log10 P(class | class before) + log10 P(word | class), both smoothed. Frequent words are looked up
   in a table of bounded size; the rest, by 64-bit hashes, in the shards of the table of all words. A word that is not in the training
   text has the class that its ending had to begin with.

A text is lower-cased in A-Z, cut at ASCII white space, and ends with one end token. Null is the empty text. Rows that
repeat a doc_id are scored one by one, repeats of a whole row count each time they occur in training. Extra columns are
ignored. An empty training set gives uniform scores; an empty table an empty result.
"""

from __future__ import annotations

import pickle
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecart.llm.common import crc, dropped, mixed, row_key, small_batches, stored, text_bytes
from tidecart.llm.shards import answered, summed

#: Words looked up in tasks (a bounded table), words that are units of their own, spelling groups, classes.
HEAD_WORDS, UNIT_WORDS, GROUPS, CLASSES = 150_000, 640, 383, 48
#: Distinct words a task counts before it hands them on, neighbours it counts at once, words it asks for at once.
FLUSH, COUNTED, ASKED = 300_000, 2_000_000, 100_000
ALPHA, KAPPA, ROUNDS = 0.1, 5.0, 12
END = b""


def tokens(text: bytes) -> list[bytes]:
    return [*text.lower().split(), END]


def word_counts(docs: DataFrame, cut: Callable[[bytes], list[bytes]] = tokens) -> DataFrame:
    """(word binary, n) over whole texts as ``cut`` gives them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"]
            )

        for batch in batches:
            for text in batch.column(0):
                counts.update(cut(text.as_py()))
                if len(counts) >= FLUSH:
                    yield out()
                    counts.clear()
        yield out()

    partial = docs.select(text_bytes()).mapInArrow(run, "word binary, n long")
    return partial.groupBy("word").agg(F.sum("n").alias("n"))


def _group(word: bytes) -> int:
    return zlib.crc32(word[-3:]) % GROUPS


def unit_bigrams(docs: DataFrame, units: dict[bytes, int], end_unit: int) -> np.ndarray:
    """Counts of consecutive units over whole texts (a text begins after the end token), as a square array."""
    size = UNIT_WORDS + GROUPS + 1
    held = docs.sparkSession.sparkContext.broadcast(units)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = _Units(held.value)
        total = np.zeros(size * size, np.int64)
        for batch in batches:
            for text in batch.column(0):
                words = text.as_py().lower().split()
                line = np.empty(len(words) + 2, np.int64)
                line[0] = line[-1] = end_unit
                line[1:-1] = np.fromiter(map(get.__getitem__, words), np.int64, len(words))
                np.add.at(total, line[:-1] * size + line[1:], 1)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["cell", "n"])

    cells = docs.select(text_bytes()).mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    result = np.zeros(size * size)
    result[cells["cell"].to_numpy()] = cells["n"].to_numpy()
    return result.reshape(size, size)


class _Units(dict):
    """Unit of a word: its own, or that of its ending (not remembered: endings are cheap and words many)."""

    def __missing__(self, word: bytes) -> int:
        return UNIT_WORDS + _group(word)


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1.0))


def exchange(pairs: np.ndarray, classes: int = CLASSES, rounds: int = ROUNDS) -> np.ndarray:
    """Class of each unit: units move, most frequent first, to the class that gains most likelihood, until none moves."""
    units = len(pairs)
    weight = pairs.sum(0) + pairs.sum(1)
    order = np.argsort(-weight, kind="stable")
    of = np.empty(units, np.int64)
    of[order] = np.arange(units) % classes
    table = np.zeros((classes, classes))
    np.add.at(table, (of[:, None], of[None, :]), pairs)
    live = [u for u in order if weight[u] > 0]
    for _ in range(rounds):
        moved = 0
        for u in live:
            row = np.bincount(of, pairs[u], classes)
            col = np.bincount(of, pairs[:, u], classes)
            own, was = pairs[u, u], of[u]
            row[was] -= own
            col[was] -= own
            table[was] -= row
            table[:, was] -= col
            table[was, was] -= own
            gain = (_xlogx(table + row) - _xlogx(table)).sum(1) + (_xlogx(table.T + col) - _xlogx(table.T)).sum(1)
            d = table.diagonal()
            gain += _xlogx(d + row + col + own) - _xlogx(d + row) - _xlogx(d + col) + _xlogx(d)
            out, into = table.sum(1) + col, table.sum(0) + row  # what meets the unit counts wherever it goes
            gain -= _xlogx(out + row.sum() + own) - _xlogx(out) + _xlogx(into + col.sum() + own) - _xlogx(into)
            best = int(np.argmax(gain))
            if gain[best] <= gain[was] + 1e-9:
                best = int(was)
            moved += best != was
            of[u] = best
            table[best] += row
            table[:, best] += col
            table[best, best] += own
        if not moved:
            break
    return of


@dataclass
class Model:
    """What scoring needs: the bounded tables for tasks, and the table of all words."""

    classes: DataFrame  # key, n, c: hash, count and class of each word that is no unit
    total: int
    distinct: int
    head: list[tuple[bytes, int]]
    of: np.ndarray  # class of each unit
    local: np.ndarray  # class of each word of the head, and of the end token if it is not there
    step: np.ndarray  # log10 P(class | class before)
    room: np.ndarray  # log10 of the denominator of P(word | class)


def frequent_words(counts: DataFrame, limit: int) -> list[tuple[bytes, int]]:
    """The end token, then the most frequent words (equal ones by spelling): ``limit`` in all. Words are first counted by frequency,
    and only those as frequent as the last one needed are sorted; so neither the driver nor a task gets ``limit`` words from every
    partition."""
    sizes = counts.groupBy("n").agg(F.count(F.lit(1)).alias("v")).toArrow()
    n, v = sizes["n"].to_numpy(), sizes["v"].to_numpy()
    order = np.argsort(-n)
    full = np.flatnonzero(np.cumsum(v[order]) >= limit)
    least = int(n[order[full[0]]]) if len(full) else 0
    is_end = F.octet_length("word") == 0
    top = counts.where(is_end | (F.col("n") >= least)).orderBy(~is_end, F.desc("n"), "word").limit(limit).toArrow()
    return list(zip(top["word"].to_pylist(), top["n"].to_pylist()))


def _steps(table: np.ndarray) -> np.ndarray:
    alone = (table.sum(0) + 1) / (table.sum() + CLASSES)
    return np.log10((table + KAPPA * alone) / (table.sum(1, keepdims=True) + KAPPA))


def _hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def word_classes(docs: DataFrame, units: dict[bytes, int], of: np.ndarray, table: np.ndarray) -> DataFrame:
    """(key, n, c): the count of each word that is no unit, and the class under which the classes beside it, as ``of`` the units they
    have, are most likely with class bigrams as in ``table``."""
    held = docs.sparkSession.sparkContext.broadcast(units)
    step, room = _steps(table), np.log10(table.sum(0) + 1)
    end = UNIT_WORDS + GROUPS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        get = _Units(held.value)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def out() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            key, cell = (np.concatenate([x[k] for x in found]) for k in (0, 1))
            order = np.argsort(key + cell)  # equal ones come together
            key, cell = key[order], cell[order]
            first = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (cell[1:] != cell[:-1])])
            return key[first], cell[first], np.diff(np.r_[first, len(key)])

        for batch in batches:
            for text in batch.column(0):
                words = text.as_py().lower().split()
                line = np.full(len(words) + 2, end, np.int64)
                line[1:-1] = np.fromiter(map(get.__getitem__, words), np.int64, len(words))
                at = np.flatnonzero((line >= UNIT_WORDS) & (line < end))
                key = _hashes([words[k] for k in (at - 1).tolist()])
                classes = of[line].astype(np.uint8)
                found += [(key, classes[at - 1]), (key, classes[at + 1] + np.uint8(CLASSES))]
                size += 2 * len(key)
                if size > COUNTED:
                    yield out()
                    found, size = [], 0
        if size:
            yield out()

    def finish(key: np.ndarray, cell: np.ndarray, n: np.ndarray) -> list[np.ndarray]:
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        ends = np.r_[first, len(key)]
        total, best = np.empty(len(first), np.int64), np.empty(len(first), np.int64)
        for low in range(0, len(first), 16_384):
            high = min(low + 16_384, len(first))
            near = np.zeros((high - low, 2 * CLASSES))
            some = slice(ends[low], ends[high])
            near[np.repeat(np.arange(high - low), np.diff(ends[low : high + 1])), cell[some]] = n[some]
            before, behind = near[:, :CLASSES], near[:, CLASSES:]
            total[low:high] = before.sum(1)
            best[low:high] = np.argmax(before @ step + behind @ step.T - before.sum(1, keepdims=True) * room, axis=1)
        return [key[first].view(np.int64), total, best]

    return summed(docs.select(text_bytes()), count, np.uint8, finish, "key long, n long, c long")


class _Block:
    """Texts as classes: of a word that tasks look up its class, of any other ``CLASSES`` and its number among those to be asked for."""

    def __init__(self, head: dict[bytes, int], local: np.ndarray, of: np.ndarray):
        self.head, self.local, self.of = head, local, of
        self.asked: dict[bytes, int] = {}

    def line(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The code of each word, and its place in the head (-1 if it is not there)."""
        at = np.fromiter(map(self.head.get, words, repeat(-1)), np.int64, len(words))
        codes = self.local[at]
        rest = np.flatnonzero(at < 0)
        if len(rest):
            asked = self.asked
            codes[rest] = [CLASSES + asked.setdefault(words[k], len(asked)) for k in rest.tolist()]
        return codes, at

    def question(self, *note) -> tuple[np.ndarray, bytes]:
        keys = _hashes(list(self.asked))
        order = np.argsort(mixed(keys))
        place = np.empty(len(keys), np.uint32)
        place[order] = np.arange(len(keys))
        spelled = self.of[[UNIT_WORDS + _group(w) for w in self.asked]].astype(np.uint8) if self.asked else np.empty(0, np.uint8)
        self.asked = {}
        return keys[order], pickle.dumps((place, spelled, *note))


def _answers(place: np.ndarray, spelled: np.ndarray, found: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Class by code, and counts of the words asked for."""
    has = found[place]
    n, c = np.zeros(len(place)), spelled.astype(np.int64)
    at = (np.cumsum(found) - 1)[place[has]]
    n[has], c[has] = values["n"][at], values["c"][at]
    return np.r_[np.arange(CLASSES), c], n


_KINDS = [("n", "u4"), ("c", "u1")]


def class_bigrams(docs: DataFrame, classes: DataFrame, head: list[bytes], local: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Counts of consecutive classes over whole texts, with the class of each word."""
    held = docs.sparkSession.sparkContext.broadcast(head)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, bytes]]:
        block = _Block(dict(zip(held.value, range(len(held.value)))), local, of)
        steps: list[np.ndarray] = []

        def out() -> tuple[np.ndarray, bytes]:
            pair, n = np.unique(np.concatenate(steps), return_counts=True)
            return block.question(pair, n)

        for batch in batches:
            for text in batch.column(0):
                codes = block.line(tokens(text.as_py()))[0]
                steps.append((np.r_[codes[-1], codes[:-1]] << 32) | codes)  # the end token is last, and comes before the first
                if len(block.asked) > ASKED or len(steps) >= 20_000:
                    yield out()
                    steps.clear()
        if steps:
            yield out()

    def finish(note: bytes, found: np.ndarray, values: np.ndarray) -> Iterator[pa.RecordBatch]:
        place, spelled, pair, n = pickle.loads(note)
        of_code, _ = _answers(place, spelled, found, values)
        cells = np.bincount(of_code[pair >> 32] * CLASSES + of_code[pair & 0xFFFFFFFF], n, CLASSES * CLASSES).astype(np.int64)
        at = np.flatnonzero(cells)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(cells[at], pa.int64())], names=["cell", "n"])

    rows = answered(docs.select(text_bytes()), ask, classes, finish, "cell long, n long", _KINDS)
    cells = rows.groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    result = np.zeros(CLASSES * CLASSES)
    result[cells["cell"].to_numpy()] = cells["n"].to_numpy()
    return result.reshape(CLASSES, CLASSES)


def train(docs: DataFrame) -> Model:
    counts = stored(word_counts(docs))
    size = counts.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).first()
    total, distinct = size["n"] or 0, size["v"]
    # The end token, the one empty word, comes first: it has a unit of its own however many words are more frequent.
    head = frequent_words(counts, HEAD_WORDS)
    dropped(counts)
    end_unit = UNIT_WORDS + GROUPS
    units = {w: k for k, (w, _) in enumerate([h for h in head if h[0] != END][:UNIT_WORDS])}
    units[END] = end_unit
    pairs = unit_bigrams(docs, units, end_unit)
    of = exchange(pairs)
    table = np.zeros((CLASSES, CLASSES))
    np.add.at(table, (of[:, None], of[None, :]), pairs)
    with small_batches(docs.sparkSession):
        classes = stored(word_classes(docs, units, of, table), free=True)
        words = [w for w, _ in head]
        if END not in words:
            words.append(END)
        asked = [w for w in words if w not in units]
        key = pa.table({"key": pa.array(_hashes(asked).view(np.int64))})
        known = classes.join(F.broadcast(docs.sparkSession.createDataFrame(key)), "key").select("key", "c").toArrow() if asked else None
        class_of = dict(zip(known["key"].to_pylist(), known["c"].to_pylist())) if asked else {}
        local = np.array([of[units[w]] if w in units else class_of[k] for w, k in zip(words, _hashes(words).view(np.int64).tolist())], np.int64)
        table = class_bigrams(docs, classes, words, local, of)
    n_class, v_class = np.zeros(CLASSES), np.zeros(CLASSES)
    for r in classes.groupBy("c").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).collect():
        n_class[r["c"]], v_class[r["c"]] = r["n"], r["v"]
    for word, n in head:
        if word in units:
            n_class[of[units[word]]] += n
            v_class[of[units[word]]] += 1
    room = np.log10(n_class + ALPHA * (v_class + 1))
    return Model(classes, total, distinct, head, of, local, _steps(table), room)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, doc_key, n_tokens, n_known, base_score and score (log10 probabilities), perplexity."""
    counts = np.array([n for _, n in model.head], np.float64)
    counts = np.r_[counts, np.zeros(len(model.local) - len(counts))]
    words = [w for w, _ in model.head] + [END] * (len(model.local) - len(model.head))
    held = docs.sparkSession.sparkContext.broadcast((words, model.local, np.log10(counts + ALPHA), counts > 0, model.of, model.step, model.room))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, bytes]]:
        words, local, logs, known, of, step, room = held.value
        block = _Block(dict(zip(words, range(len(words)))), local, of)
        kept: list[pa.RecordBatch] = []
        rows: list[tuple] = []
        pairs: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def out() -> tuple[np.ndarray, bytes]:
            row, x, y = (np.concatenate([p[k] for p in pairs]) for k in range(3))
            question = block.question(pa.Table.from_batches(kept).combine_chunks(), [np.array(c) for c in zip(*rows)], row, x, y)
            kept.clear(), rows.clear(), pairs.clear()
            return question

        for batch in batches:
            for low in range(0, batch.num_rows, 500):
                part = batch.slice(low, 500)
                kept.append(part.select([0, 1]))
                for text in part.column(2):
                    codes, at = block.line(tokens(text.as_py()))
                    before = np.r_[codes[-1], codes[:-1]]
                    inside = at >= 0
                    both = (codes < CLASSES) & (before < CLASSES)
                    path = step[before[both], codes[both]].sum() - room[codes[inside]].sum()
                    pairs.append((np.full(len(both) - int(both.sum()), len(rows), np.uint32), before[~both].astype(np.uint32), codes[~both].astype(np.uint32)))
                    rows.append((len(codes), int(known[at[inside]].sum()), logs[at[inside]].sum(), path))
                if len(block.asked) > ASKED or len(rows) >= 20_000:
                    yield out()
        if rows:
            yield out()

    def finish(note: bytes, found: np.ndarray, values: np.ndarray) -> Iterator[pa.RecordBatch]:
        _, _, _, _, _, step, room = held.value
        place, spelled, ids, (n_tokens, seen, logs, path), row, x, y = pickle.loads(note)
        of_code, n = _answers(place, spelled, found, values)
        a, b = of_code[x], of_code[y]
        rest = y >= CLASSES
        times = n[y[rest] - CLASSES]
        add = lambda at, v: np.bincount(at, v, len(n_tokens)).astype(np.float64)
        path = path + add(row, step[a, b]) - add(row[rest], room[b[rest]])
        logs = logs + add(row[rest], np.log10(times + ALPHA))
        seen = seen + add(row[rest], times > 0).astype(np.int64)
        arrays = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in ids.columns]
        yield pa.Table.from_arrays([*arrays, *map(pa.array, (n_tokens, seen, logs, path))], names=_LOCAL).to_batches()[0]

    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", row_key("doc_id", "text").alias("doc_key"), text_bytes())
    with small_batches(docs.sparkSession):
        local = stored(
            answered(texts, ask, model.classes, finish, f"doc_id {kind}, doc_key long, n_tokens long, n_known long, logs double, path double", _KINDS)
        )
    base_room = float(np.log10(model.total + ALPHA * (model.distinct + 1)))
    return local.select(
        "doc_id",
        "doc_key",
        "n_tokens",
        "n_known",
        (F.col("logs") - F.col("n_tokens") * F.lit(base_room)).alias("base_score"),
        (F.col("logs") + F.col("path")).alias("score"),
        F.pow(F.lit(10.0), -(F.col("logs") + F.col("path")) / F.col("n_tokens")).alias("perplexity"),
    )


_LOCAL = ["doc_id", "doc_key", "n_tokens", "n_known", "logs", "path"]


def report(docs: DataFrame) -> DataFrame:
    """Learn from rows whose crc32(doc_id) mod 10 is not 0 and score all rows."""
    fold = crc("doc_id") % 10 == 0
    model = train(docs.where(~fold))
    return score(docs, model).select(
        "doc_id", fold.alias("held_out"), "n_tokens", "n_known", F.lit(model.total).cast("long").alias("train_tokens"),
        "base_score", "score", "perplexity",
    )
