"""Benchmark decontamination with a distributed positional index, in DataFrame operations only.

1. Corpus frequency of every test term (one counting pass).
2. Each window of a test item is looked up by its rarest term; a window with a term that no document has cannot occur.
3. Postings (document, position, neighbouring words) are kept for those rarest terms alone, and the lists of the other
   terms are intersected at their offsets: the words around a posting must equal the words around the term in the item.
4. A run of equal words as long as a window is a match.

Null texts have no words, items without words no windows. Rows that repeat a doc_id are judged one by one (repeats of a
whole row alike); items that repeat an item_id count once. A null item_id counts as the empty text. Extra columns
are ignored; with an empty benchmark nothing is hit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidecart.llm.common import row_key, small, stored
from tidecart.operators.parsing import evaluated_once

WINDOW = 10
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """Words of a text, A-Z lower-cased; letters and digits of ASCII, and everything beyond ASCII."""
    lowered = F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)
    return F.array_remove(F.split(lowered, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")




def _around(array: Column, at: Column, reach: int) -> Column:
    """The words up to ``reach`` before and after position ``at``; the word itself is at ``least(at, reach)``."""
    first = F.greatest(at - F.lit(reach), F.lit(0))
    return F.slice(array, first + 1, at + F.lit(reach + 1) - first)


def _anchors(items: DataFrame, frequency: DataFrame, window: int) -> DataFrame:
    """(term, item_id, q, m, near): the rarest term of each window, with its place q among the item's m words."""
    start = F.explode(F.sequence(F.lit(0), F.greatest(F.col("m") - window, F.lit(0)))).alias("s")
    place = F.explode(F.sequence(F.col("s"), F.least(F.col("s") + window, F.col("m")) - 1)).alias("q")
    terms = items.select("item_key", "m", F.posexplode("w").alias("q", "term"))
    known = terms.join(frequency, "term", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    cells = items.select("item_key", "m", start).select("item_key", "s", place)
    rarest = (
        cells.join(known.select("item_key", "q", "term", "n"), ["item_key", "q"])
        .groupBy("item_key", "s")
        .agg(F.min(F.struct("n", "q", "term")).alias("a"))
        .where("a.n > 0")
        .select("item_key", "a.q", "a.term")
        .distinct()
    )
    return rarest.join(items, "item_key").select(
        "term", "item_id", "q", "m", _around(F.col("w"), F.col("q"), window - 1).alias("near")
    )


def _run(step: int, reach: int) -> Column:
    """How many words beside the anchor are equal, going left (step -1) or right (1). One pass over two arrays: written out word by
    word, and copied by the optimizer, it made a method so large that compiling it took more memory than the rows."""

    def beside(array: str, at: str) -> Column:
        place = F.least(at, F.lit(reach))
        return F.slice(array, place + 2, F.lit(reach)) if step > 0 else F.reverse(F.slice(array, F.lit(1), place))

    same = F.zip_with(beside("ctx", "p"), beside("near", "q"), lambda here, there: here.eqNullSafe(there))
    other = F.array_position(same, False).cast("int")
    return F.when(other > 0, other - 1).otherwise(F.size(same))


def phrase_matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Maximal runs of item words around each anchor: doc_id, doc_key, item_id, first, last (word places, inclusive). Runs
    that two anchors find may overlap; together they cover every occurrence of every window and nothing else."""
    items = stored(
        benchmark.select(
            F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), words(F.col("text")).alias("w")
        )
        .withColumn("m", F.size("w"))
        .where("m > 0")
        .distinct()
        .withColumn("item_key", row_key("item_id", "w"))
    )
    terms = stored(items.select(F.explode("w").alias("term")).distinct())
    texts = docs.select("doc_id", row_key("doc_id", "text").alias("doc_key"), words(F.col("text")).alias("w"))
    frequency = stored(
        texts.select(F.explode("w").alias("term"))
        .join(small(terms, F.octet_length("term") + 24), "term")
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    anchors = stored(_anchors(items, frequency, window))
    weight = F.aggregate("near", F.lit(64), lambda total, word: total + F.octet_length(word) + 16)
    reach = window - 1
    found = (
        texts.select("doc_id", "doc_key", "w", F.posexplode("w").alias("p", "term"))
        .join(small(anchors, weight), "term")
        .select("doc_id", "doc_key", "item_id", "p", "q", "m", "near", _around(F.col("w"), F.col("p"), reach).alias("ctx"))
    )
    run = F.struct((F.col("p") - _run(-1, reach)).alias("first"), (F.col("p") + _run(1, reach)).alias("last"))
    return (
        evaluated_once(found, run, "run", ["doc_id", "doc_key", "item_id", "m"])
        .where((F.col("run.last") - F.col("run.first") + 1) >= F.least(F.lit(window), F.col("m")))
        .select("doc_id", "doc_key", "item_id", "run.first", "run.last")
        .distinct()
    )


def proximity_matches(docs: DataFrame, phrase: str, within: int) -> DataFrame:
    """doc_id and ``first`` of places where all distinct words of ``phrase`` stand within ``within`` words from the rarest one's
    place on: the postings of that word alone are kept, and the others looked for around them."""
    wanted = docs.sparkSession.range(1).select(F.explode(F.array_distinct(words(F.lit(phrase)))).alias("term"))
    texts = docs.select("doc_id", words(F.col("text")).alias("w"))
    count = texts.select(F.explode("w").alias("term")).join(F.broadcast(wanted), "term").groupBy("term").count()
    ranked = wanted.join(count, "term", "left").orderBy(F.coalesce("count", F.lit(0)), "term").collect()
    if not ranked or ranked[0]["count"] is None:
        return texts.where("false").select("doc_id", F.lit(0).alias("first"))
    rest = F.array(*[F.lit(r["term"]) for r in ranked])
    near = _around(F.col("w"), F.col("p"), within - 1)
    return (
        texts.select("doc_id", "w", F.posexplode("w").alias("p", "term"))
        .where(F.col("term") == ranked[0]["term"])
        .where(F.size(F.array_except(rest, near)) == 0)
        .select("doc_id", F.col("p").alias("first"))
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per row of ``docs``: doc_id, doc_key, n_words, n_hit, n_items, items (sorted ids), contaminated."""
    spans = stored(phrase_matches(docs, benchmark, window))
    by = Window.partitionBy("doc_id", "doc_key").orderBy("first", "last")
    before = F.coalesce(F.max("last").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(-1))
    hit = (
        spans.select("doc_id", "doc_key", "first", "last")
        .distinct()
        .select("doc_id", "doc_key", F.greatest(F.col("last") - F.greatest(before, F.col("first") - 1), F.lit(0)).alias("new"))
        .groupBy("doc_id", "doc_key")
        .agg(F.sum("new").alias("n_hit"))
    )
    items = spans.groupBy("doc_id", "doc_key").agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    facts = hit.join(items, hit.doc_key.eqNullSafe(items.doc_key) & hit.doc_id.eqNullSafe(items.doc_id)).select(
        hit.doc_id.alias("_id"), hit.doc_key.alias("_key"), "n_hit", "items"
    )
    count = F.size(words(F.col("text"))).cast("long")
    rows = docs.select("doc_id", row_key("doc_id", "text").alias("doc_key"), count.alias("n_words"))
    return rows.join(facts, (F.col("doc_key") == F.col("_key")) & F.col("doc_id").eqNullSafe(F.col("_id")), "left").select(
        "doc_id",
        "doc_key",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(F.greatest(F.size("items"), F.lit(0)), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    digest = F.sha2(F.array_join("items", ",").cast("binary"), 256)
    found = decontaminate(docs.select("doc_id", "text"), benchmark.select("item_id", "text"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest.alias("items_sha256"), "contaminated")
