"""Quality by perplexity under an interpolated modified Kneser-Ney bigram model of trusted text.

1. Bigram counts of all words of trusted text, summed per task and then by bigram. Discounts from counts of counts; continuation
   counts and the mass left per context from the same table; joins of counts by context and by word give what each bigram
   gains over backing off.
2. What the discounts of continuation counts leave goes evenly to all spellings: those of trusted texts and ``OTHER_FORMS`` that
   they lack. So a word seen once is hardly more likely than a new one.
3. Every text adds up what backing off gives and what its bigrams gain. The most frequent words and bigrams (bounded tables, which
   only save the way) are looked up in tasks, all others in the shards of the count table, in rounds by context.
4. A trusted document is judged as if its own bigrams had not been counted: most bigrams occur once, and a model that has read a
   text would find it far more likely than others as good.
5. A document is rejected if its perplexity, drawn toward the language's usual one as if it had ``PRIOR`` more words, lies
   beyond a limit set by quantiles of the trusted documents of its language.

Words are runs of other than ASCII white space, told apart by 64-bit hashes. Null and empty texts hold the end of text only. A null
language, or one without trusted documents, takes the limits of all trusted documents. Rows that repeat a doc_id are judged one
by one. Without trusted text nothing is rejected. Extra columns are ignored; empty in, empty out.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecart.llm.class_lm import word_counts
from tidecart.llm.common import dropped, hashed_words, mixed, row_key, small, small_batches, stored, text_bytes
from tidecart.llm.shards import answered, summed

#: Words and bigrams that tasks look up themselves, at most.
LOCAL_WORDS, FREQUENT = 150_000, 200_000
OTHER_FORMS, PRIOR = 1_000_000, 12.0
#: The limit: this quantile, and so many times its distance from the median beyond it.
QUANTILE, REACH = 0.98, 1.0
OTHER, EDGE = 0, 1
_SHIFT = 20
#: Bigrams are counted and asked for in rounds by context, so that shuffle files of all do not lie on the disks at once: one for
#: so many bytes of trusted text, and at most so many.
ROUND_BYTES, ROUNDS = 4 << 20, 5
#: Bigrams a task counts before it hands them on, and keys it asks for at once.
COUNTED, ASKED = 2_000_000, 200_000


def _cut(text: bytes) -> list[bytes]:
    return text.split()


def _lines(column: pa.Array, known: tuple[np.ndarray, np.ndarray] | None) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """Rows ``low`` to ``high``, their words as contexts and as followers (a text begins and ends with the edge), and the row of each.
    Words are their hashes, or with ``known`` (sorted hashes, ids) their ids and ``OTHER``."""
    for low, high, words, begins in hashed_words(column, lower=False):
        if known is not None:
            at, found = _places(known[0], words)
            words = np.where(found, known[1][at], np.uint64(OTHER)) if len(known[0]) else np.full(len(words), OTHER, np.uint64)
        a = np.insert(words, begins[:-1], np.uint64(EDGE))
        yield low, high, a, np.r_[a[1:], np.uint64(EDGE)], np.repeat(np.arange(high - low), np.diff(begins) + 1)


def _places(table: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where ``values`` are in a sorted table, and whether they are."""
    if not len(table):
        return np.zeros(len(values), np.int64), np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(table, values), len(table) - 1)
    return at, table[at] == values


def _added(row: np.ndarray, values: np.ndarray, rows: int) -> np.ndarray:
    return np.bincount(row, values, rows).astype(np.float64)  # of nothing it makes integers


def _keys(a: np.ndarray, b: np.ndarray, bounded: bool) -> np.ndarray:
    if bounded:
        return (a << np.uint64(_SHIFT)) | b
    return a ^ ((b << np.uint64(1)) | (b >> np.uint64(63)))


def _key(bounded: bool):
    if bounded:
        return F.shiftleft("a", _SHIFT).bitwiseOR(F.col("b"))
    return F.col("a").bitwiseXOR(F.shiftleft("b", 1).bitwiseOR(F.shiftrightunsigned("b", 63)))


def _follower(key: np.ndarray, a: np.ndarray, bounded: bool) -> np.ndarray:
    """The word that makes ``key`` with context ``a``."""
    if bounded:
        return key & np.uint64((1 << _SHIFT) - 1)
    turned = key ^ a
    return (turned >> np.uint64(1)) | (turned << np.uint64(63))


def _round_of(words: np.ndarray, rounds: int) -> np.ndarray:
    return (words >> np.uint64(40)) % np.uint64(rounds)


@dataclass
class Model:
    known: tuple[np.ndarray, np.ndarray] | None  # hashes and ids, if other words are one class
    words: np.ndarray  # words looked up in tasks, sorted
    back: np.ndarray  # log10 of the mass such a word leaves as context
    alone: np.ndarray  # log10 of its continuation probability (of one spelling, for the class of other words)
    new: float  # the same of a spelling that trusted texts lack
    discounts: list[float]
    frequent: tuple[np.ndarray, np.ndarray]  # sorted keys, gains
    counts: tuple[np.ndarray, np.ndarray]  # of these: how often, and what one more is worth against backing off
    tables: list[DataFrame]  # by round: key, n, x of all bigrams; of words n is 0, x what they add beyond a new spelling

    def gain(self, n: np.ndarray, x: np.ndarray) -> np.ndarray:
        """log10 of what a bigram seen ``n`` times has over backing off."""
        d = np.array([0.0, *self.discounts])[np.clip(n, 0, 3).astype(np.int64)]
        return np.log10(1 + np.maximum(n - d, 0) * x)


def bigram_counts(docs: DataFrame, known: tuple[np.ndarray, np.ndarray] | None = None, part: int = 0, rounds: int = 1) -> DataFrame:
    """(a, b, n): all bigrams of whole texts whose context is of this part."""
    held = docs.sparkSession.sparkContext.broadcast(known)
    bounded = known is not None

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        lines: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def out() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            a, b = (np.concatenate([x[k] for x in lines]) for k in (0, 1))
            key = _keys(a, b, bounded)
            order = np.argsort(key)
            key, a = key[order], a[order]
            first = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (a[1:] != a[:-1])])
            return key[first], a[first], np.diff(np.r_[first, len(key)])

        for batch in batches:
            for _, _, a, b, _ in _lines(batch.column(0), held.value):
                mine = _round_of(a, rounds) == part
                lines.append((a[mine], b[mine]))
                size += len(lines[-1][0])
                if size > COUNTED:
                    yield out()
                    lines, size = [], 0
        if size:
            yield out()

    def finish(key: np.ndarray, a: np.ndarray, n: np.ndarray) -> list[np.ndarray]:
        return [a.view(np.int64), _follower(key, a, bounded).view(np.int64), n]

    return summed(docs.select(text_bytes()), count, np.uint64, finish, "a long, b long, n long")


def _discounts(counts: list[float]) -> list[float]:
    """D1, D2, D3+ from the numbers of entries seen once to four times; plain 0.5, 1, 1.5 where they are too few to tell."""
    n1, n2, n3, n4 = counts
    if min(counts) <= 0:
        return [0.5, 1.0, 1.5]
    y = n1 / (n1 + 2 * n2)
    found = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
    return [float(min(max(d, 0.05), k + 0.95)) for k, d in enumerate(found)]


def _with_discount(n: str, d: list[float]):
    return F.when(F.col(n) == 1, d[0]).when(F.col(n) == 2, d[1]).otherwise(d[2])


def _seen(table: DataFrame, n: str) -> list[float]:
    row = table.agg(*[F.sum((F.col(n) == k).cast("long")).alias(f"n{k}") for k in (1, 2, 3, 4)]).first()
    return [float(v or 0) for v in row]


def _most(table: DataFrame, limit: int) -> DataFrame:
    """The rows of the greatest ``n``, at most ``limit`` (all or none of those with equal ones), found by counting rows by ``n``."""
    sizes = table.groupBy("n").agg(F.count(F.lit(1)).alias("v")).toArrow()
    n, v = sizes["n"].to_numpy(), sizes["v"].to_numpy()
    order = np.argsort(-n)
    fits = np.flatnonzero(np.cumsum(v[order]) <= limit)
    return table.where(F.col("n") >= int(n[order[fits[-1]]])) if len(fits) else table.where("false")


def _vocabulary(trusted: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, ids) of the most frequent words."""
    top = word_counts(trusted, _cut).orderBy(F.desc("n"), "word").limit(size).toArrow()
    words = pa.array([bytes(w) for w in top["word"].to_pylist()], pa.binary())
    hashes = np.concatenate([np.empty(0, np.uint64), *[h for _, _, h, _ in hashed_words(words, lower=False)]]) if len(words) else np.empty(0, np.uint64)
    order = np.argsort(hashes)
    return hashes[order], (order + 2).astype(np.uint64)


def train(trusted: DataFrame, vocabulary_size: int | None = None) -> Model:
    """With ``vocabulary_size`` all words but the most frequent are one class, which shares its probability among ``OTHER_FORMS``.
    ``trusted`` is deleted once it is counted if it is a table that ``stored`` made."""
    known = None if vocabulary_size is None else _vocabulary(trusted, vocabulary_size)
    bounded = known is not None
    size = trusted.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    rounds = min(ROUNDS, 1 + size // ROUND_BYTES)
    counted = [stored(bigram_counts(trusted, known, k, rounds), free=True) for k in range(rounds)]
    dropped(trusted)
    pair = reduce(DataFrame.union, counted)
    d = _discounts(_seen(pair, "n"))
    # Contexts: how often they occur and how much mass their bigrams leave. Words: in how many contexts they occur.
    context = pair.groupBy(F.col("a").alias("w")).agg(F.sum("n").alias("n"), F.sum(_with_discount("n", d)).alias("left"))
    word = pair.groupBy(F.col("b").alias("w")).agg(F.count(F.lit(1)).alias("c"))
    words = stored(context.join(word, "w"), free=True)  # every word is followed, by the edge at last
    e = _discounts(_seen(words, "c"))
    left = F.sum(_with_discount("c", e)).alias("left")
    every = words.agg(F.sum("c").alias("n"), left, F.sum((F.col("w") != OTHER).cast("long")).alias("v")).first()
    total = float(every["n"] or 1)
    spread = float(every["left"] or 1) / total / ((every["v"] or 0) + OTHER_FORMS)
    p = (F.col("c") - _with_discount("c", e)) / total + F.when(F.col("w") == OTHER, spread * OTHER_FORMS).otherwise(spread)
    back, new = F.log10(F.col("left") / F.col("n")), float(np.log10(spread))
    tables = []
    for k, part in enumerate(counted):
        mass = words.select(F.col("w").alias("a"), "left").hint("shuffle_hash")
        follows = words.select(F.col("w").alias("b"), p.alias("p")).hint("shuffle_hash")
        gains = part.join(mass, "a").join(follows, "b").select(_key(bounded).alias("key"), "n", (1 / (F.col("left") * F.col("p"))).cast("float").alias("x"))
        mine = words.where(F.shiftrightunsigned("w", 40) % rounds == k)
        more = mine.select(F.col("w").alias("key"), F.lit(0).cast("long").alias("n"), (back + F.log10(p) - new).cast("float").alias("x"))
        tables.append(stored(gains if bounded else gains.union(more), part, free=True))
    head = _most(words, LOCAL_WORDS).select("w", back.alias("back"), F.log10(p).alias("alone")).toArrow()
    w, backs, alone = (head[c].to_numpy() for c in ("w", "back", "alone"))
    if bounded:  # ids are places
        some = np.argsort(w)
        given, w = w[some], np.arange(len(known[0]) + 2)
        backs, alone = (np.where(np.isin(w, given), v[some][_places(given, w)[0]] if len(given) else 0.0, d) for v, d in ((backs, 0.0), (alone, new)))
        alone[OTHER] = alone[OTHER] - np.log10(OTHER_FORMS) if OTHER in given else new
    order = np.argsort(w.view(np.uint64))
    dropped(words)
    hot = _most(reduce(DataFrame.union, tables).where("n > 0"), FREQUENT).toArrow()
    n, x = (hot[c].to_numpy() for c in ("n", "x"))
    keys = hot["key"].to_numpy().view(np.uint64)
    first = np.argsort(keys)
    model = Model(known, w.view(np.uint64)[order], backs[order], alone[order], new, d, (keys[first], n[first]), (n[first], x[first]), tables)
    model.frequent = keys[first], model.gain(n[first], x[first])
    return model


def score(docs: DataFrame, model: Model, last: bool = False) -> DataFrame:
    """doc_id, doc_key, lang, n_tokens (with the end of text), log_prob (log10), and own: the same as if the bigrams of the row had not
    been counted, for every row. With ``last`` the tables of the model are deleted once they are read."""
    rounds = len(model.tables)
    texts = docs.select(row_key("doc_id", "text").alias("doc_key"), text_bytes().alias("t"))
    found = []
    for k, table in enumerate(model.tables):
        found.append(stored(_summed_up(texts, model, table, k, rounds), table if last else None, free=True))
    sums = reduce(DataFrame.union, found).groupBy("doc_key")
    # Exact repeats share a key and what is found for each of them in each round.
    sums = sums.agg(F.avg("n").cast("long").alias("n_tokens"), (F.avg("logs") * rounds).alias("log_prob"), (F.avg("own") * rounds).alias("own"))
    rows = docs.select("doc_id", row_key("doc_id", "text").alias("doc_key"), F.col("lang").cast("string").alias("lang"))
    return rows.join(sums, "doc_key").select("doc_id", "doc_key", "lang", "n_tokens", "log_prob", "own")


def _summed_up(texts: DataFrame, model: Model, table: DataFrame, part: int, rounds: int) -> DataFrame:
    """(doc_key, n, logs, own): what the words of this part add to the logarithm of each text, and their bigrams."""
    held = texts.sparkSession.sparkContext.broadcast(replace(model, tables=[]))
    bounded = model.known is not None

    def counted(what: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        order = np.argsort(what)
        order = order[np.argsort(row[order].astype(np.uint16), kind="stable")] if len(row) and row[-1] < 1 << 16 else np.lexsort((what, row))
        what, row = what[order], row[order]
        first = np.flatnonzero(np.r_[True, (what[1:] != what[:-1]) | (row[1:] != row[:-1])][: len(what)])
        return what[first], row[first], np.diff(np.r_[first, len(what)])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, bytes]]:
        m: Model = held.value
        sums: list[tuple] = []
        asked: list[tuple] = []
        rows = size = 0

        def out() -> tuple[np.ndarray, bytes]:
            key, row, times = (np.concatenate([x[k] for x in asked]) for k in range(3))
            order = np.argsort(mixed(key))
            row, key, times = row[order], key[order], times[order]
            new = np.r_[True, key[1:] != key[:-1]][: len(key)]
            fit = lambda v: v.astype(np.min_scalar_type(v.max(initial=0)))
            return key[new], pickle.dumps((*[np.concatenate([x[k] for x in sums]) for k in range(4)], fit(row), np.packbits(new), fit(times)))

        for batch in batches:
            keys = batch.column(0).to_numpy()
            for low, high, a, b, row in _lines(batch.column(1), m.known):
                n = np.bincount(row, minlength=high - low)
                mine = _round_of(a, rounds) == part
                a, b, row = a[mine], b[mine], row[mine]
                # Every word is once a context and once a follower; both are added where it is the context.
                at, has = _places(m.words, a)
                words = np.full(len(a), m.new)
                words[has] = m.back[at[has]] + m.alone[at[has]]
                logs = _added(row, words, high - low)
                rare, r, times = counted(a[~has], row[~has])
                asked.append((rare, r + rows, times))
                pair, r, times = counted(_keys(a, b, bounded), row)
                at, has = _places(m.frequent[0], pair)
                at = at[has]
                own = logs + _added(r[has], times[has] * m.gain(m.counts[0][at] - times[has], m.counts[1][at]), high - low)
                logs = logs + _added(r[has], times[has] * m.frequent[1][at], high - low)
                asked.append((pair[~has], r[~has] + rows, times[~has]))
                sums.append((keys[low:high], n, logs, own))
                rows += high - low
                size += len(asked[-1][0]) + len(asked[-2][0])
                if size > ASKED:
                    yield out()
                    sums, asked, rows, size = [], [], 0, 0
        if sums:
            yield out()

    def finish(note: bytes, found: np.ndarray, values: np.ndarray) -> Iterator[pa.RecordBatch]:
        keys, count, logs, own, row, new, times = pickle.loads(note)
        at = np.cumsum(np.unpackbits(new, count=len(row)), dtype=np.int64) - 1
        has = found[at]
        row, times, at = row[has], times[has].astype(np.float64), (np.cumsum(found) - 1)[at[has]]
        n, x = (values[k][at].astype(np.float64) for k in ("n", "x"))
        more = np.where(n > 0, held.value.gain(n, np.maximum(x, 0)), x)
        less = np.where(n > 0, held.value.gain(n - times, np.maximum(x, 0)), x)
        logs, own = (v + _added(row, times * w, len(keys)) for v, w in ((logs, more), (own, less)))
        yield pa.RecordBatch.from_arrays([pa.array(v) for v in (keys, count, logs, own)], names=["doc_key", "n", "logs", "own"])

    return answered(texts, ask, table, finish, "doc_key long, n long, logs double, own double", [("n", "u4"), ("x", "f4")])


def judge(docs: DataFrame, trusted_ids: DataFrame) -> DataFrame:
    """doc_id, doc_key, lang, n_tokens, log_prob, perplexity, level (log10 perplexity, drawn to the usual one), limit, rejected.

    ``trusted_ids`` (doc_id) names trusted documents; all of them are learned from, and all of them set the limits.
    """
    ids = trusted_ids.select("doc_id").where("doc_id is not null").distinct()
    marked = stored(docs.select("doc_id").join(ids, "doc_id", "left_semi").distinct())
    # Training reads the texts in rounds, so they are stored: a list of ids beyond a broadcast would move them by shuffle each time.
    learned = stored(docs.join(small(marked, 24), "doc_id", "left_semi").select("text"), free=True)
    with small_batches(docs.sparkSession):
        model = train(learned)
        plain = score(docs, model, last=True).join(small(marked.withColumn("_trusted", F.lit(True)), 24), "doc_id", "left")
        log_prob = F.when(F.col("_trusted"), F.col("own")).otherwise(F.col("log_prob"))
        scored = stored(plain.withColumn("log_prob", log_prob).drop("own"))
    raw = -F.col("log_prob") / F.col("n_tokens")
    trusted = scored.where("_trusted").drop("_trusted").withColumn("raw", raw)
    scored = scored.drop("_trusted")
    usual = trusted.groupBy("lang").agg(F.percentile_approx("raw", 0.5, 10000).alias("usual"))
    overall = trusted.agg(F.percentile_approx("raw", 0.5, 10000)).first()[0] or 0.0
    usual = F.broadcast(usual.withColumnRenamed("lang", "_lang"))  # one row per language of the trusted rows

    def level(frame: DataFrame) -> DataFrame:
        met = frame.join(usual, F.col("lang").eqNullSafe(F.col("_lang")), "left").drop("_lang")
        middle = F.coalesce("usual", F.lit(overall))
        return met.withColumn("level", (PRIOR * middle - F.col("log_prob")) / (F.col("n_tokens") + PRIOR))

    levels = level(trusted.drop("raw"))
    quantiles = F.percentile_approx("level", [0.5, QUANTILE], 10000).alias("q")
    bound = F.col("q")[1] + REACH * (F.col("q")[1] - F.col("q")[0])
    limits = F.broadcast(levels.groupBy(F.col("lang").alias("_lang")).agg(quantiles).select("_lang", bound.alias("own")))
    common = levels.agg(quantiles).select(bound.alias("own")).first()[0]
    out = level(scored).join(limits, F.col("lang").eqNullSafe(F.col("_lang")), "left")
    limit = F.coalesce("own", F.lit(common).cast("double"))
    return out.select(
        "doc_id", "doc_key", "lang", "n_tokens", "log_prob", F.pow(F.lit(10.0), F.least(raw, F.lit(300.0))).alias("perplexity"),
        "level", limit.alias("limit"), F.coalesce(F.col("level") > limit, F.lit(False)).alias("rejected"),
    )


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return judge(docs.select("doc_id", "text", "lang"), labels.where("quality = 1")).drop("doc_key")
