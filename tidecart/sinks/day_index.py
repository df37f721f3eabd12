"""A day table that is searched by words.

Rows are kept by day and id like any keyed table. Beside them a postings table holds (day, word, id) for every word of the text
column. A search reads the postings of its words of one day, which lie together in the files, intersects them from the rarest
word on, and takes the rows of the ids that are left; no row without the rarest word is looked at. A row whose text
changed leaves postings of its old words behind, so what is found is tested again: postings only ever pass too much.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from tidecart.functions.text import matches_all_words, tokens, words
from tidecart.operators.lookup import BROADCAST_BYTES
from tidecart.sinks.ledger import KeyedLedger, SetLedger

#: Bytes a posting takes in a broadcast table, at most, beside its id's text.
_POSTING = 64


class _Postings(SetLedger):
    """Postings, sorted by word within a file, so that a word's lie in few row groups."""

    def _save(self, df: DataFrame, folder: str) -> None:
        sorted_rows = df.hint("rebalance", F.col(self.partition)).sortWithinPartitions(self.partition, "word")
        sorted_rows.write.mode("overwrite").partitionBy(self.partition).parquet(f"{self.path}/{folder}")


class DayIndex:
    """``schema`` holds the ``day`` and ``key`` columns, which name a row, and the ``text`` that is searched."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, day: str, key: str, text: str):
        self.day, self.key, self.text = day, key, text
        self.table = KeyedLedger(spark, f"{path}/rows", schema, [day, key], partition=day)
        kinds = {f.name: f.dataType for f in schema.fields}
        posting = StructType().add("word", StringType()).add(key, kinds[key]).add(day, kinds[day])
        self.postings = _Postings(spark, f"{path}/postings", posting, ["word", key, day], partition=day)

    @property
    def tables(self) -> list:
        return [self.table, self.postings]

    def bind(self, run: str) -> None:
        for table in self.tables:
            table.bind(run)

    def compact(self, upto: int | None = None) -> None:
        for table in self.tables:
            table.compact(upto)

    def vacuum(self, **options) -> None:
        for table in self.tables:
            table.vacuum(**options)

    def write(self, rows: DataFrame, batch_id: int) -> None:
        """Upsert the rows of a batch. Postings go first: a row without postings would not be found."""
        word = F.explode(F.array_distinct(tokens(F.col(self.text))))
        rows.persist()
        try:
            self.postings.write(rows.select(word.alias("word"), self.key, self.day), batch_id)
            self.table.write(rows, batch_id)
        finally:
            rows.unpersist()

    def read(self, day: str | None = None) -> DataFrame:
        """All rows of a day, or of all days."""
        return self.table.read(part=day)

    def _listed(self, word: str, day: str | None) -> DataFrame:
        return self.postings.read(where=F.col("word") == word, part=day).select(self.day, self.key)

    def search(self, query: str, day: str | None = None) -> DataFrame:
        """Rows of a day (or of all days) whose text holds every word of ``query``; none for a query without words."""
        terms = words(query)
        if not terms:
            return self.read(day).where(F.lit(False))
        held = self.postings.read(where=F.col("word").isin(terms), part=day)
        counts = held.groupBy("word").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(F.col(self.key).cast("string"))).alias("b"))
        found = {r["word"]: (r["n"], r["b"] or 0) for r in counts.collect()}  # a row per word of the query
        if len(found) < len(terms):
            return self.read(day).where(F.lit(False))
        by_rarity = sorted(terms, key=lambda t: found[t])
        same = [self.day, self.key]
        ids = self._listed(by_rarity[0], day)
        n, size = found[by_rarity[0]]
        few = n * _POSTING + size <= BROADCAST_BYTES
        for word in by_rarity[1:]:
            # The shorter list is on the right of the semi join, so that it is what may be broadcast.
            listed = self._listed(word, day)
            ids = listed.join(F.broadcast(ids) if few else ids, same, "left_semi")
        rows = self.read(day).join(F.broadcast(ids) if few else ids, same, "left_semi")
        return rows.where(matches_all_words(F.col(self.text), query))
