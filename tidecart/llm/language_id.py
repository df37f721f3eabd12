"""Language by compression: the language whose dictionary makes a text smallest.

For each language a raw-content zstandard dictionary holds text of that language. A text is compressed with every
dictionary; the smallest result names the language, and a narrow margin rejects it. Texts longer than a block are
compressed block by block, each with the dictionary in reach, so the whole text counts.

Null texts and texts without a letter are ``und`` with score 0, as is every text where nothing could be learned (no labelled
rows). Ties go to the language first in alphabetical order. Extra columns are ignored, repeated rows are scored
alike, an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecart.llm.common import crc, sample_by_hash

#: Bound of the sample the dictionaries are made of: rows and bytes per language.
SAMPLE_ROWS = 200
DICTIONARY_BYTES = 48 * 1024
BLOCK_BYTES = 8 * 1024
LEVEL = 6
#: Characters taken of a sampled row, at a place that its hash chooses, in times of its share of the dictionary.
SPAN = 8
#: Relative margin between the two smallest sizes below which a language is rejected.
MARGIN = 0.01
_BETWEEN = re.compile(r"[\W\d_]+")


def _plain(text: str) -> bytes:
    """Lower-cased letters with single blanks between words: case, digits and marks say nothing about the language."""
    return _BETWEEN.sub(" ", text.lower()).encode("utf-8", "replace")


def learn(labelled: DataFrame, rows: int = SAMPLE_ROWS, size: int = DICTIONARY_BYTES) -> dict[str, bytes]:
    """A dictionary text for each non-null ``lang``, from at most ``rows`` rows of each (bounded, chosen by hash of the id), the
    language with the most rows first. Each row gives an equal share of the dictionary, so that one long row does not fill it,
    from a place anywhere in its text that its hash chooses."""
    usable = labelled.where(F.col("lang").isNotNull() & (F.length("text") > 0)).select("doc_id", "lang", "text")
    span = max(1, size // rows) * SPAN
    place = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit(1)), F.greatest(F.length("text") - span, F.lit(0)) + 1)
    sample = sample_by_hash(usable, "doc_id", rows, per="lang").withColumn("text", F.substring("text", place.cast("int") + 1, F.lit(span)))
    by_rows = usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang")
    texts: dict[str, list[bytes]] = {row["lang"]: [] for row in by_rows.collect()}
    for row in sample.orderBy("lang", F.xxhash64(F.col("doc_id").cast("string")), "doc_id", "text").toLocalIterator():
        texts[row["lang"]].append(_plain(row["text"]))
    result = {}
    for lang, parts in texts.items():
        share = max(size // len(parts), min(64, size))
        content = b"\n".join(p[:share] for p in parts)
        # Short rows leave room: fill it with what the long ones have left.
        for p in parts:
            if len(content) >= size:
                break
            content += p[share:][: size - len(content)]
        result[lang] = content.ljust(8, b" ")[-size:]
    return result


def classify(docs: DataFrame, dictionaries: dict[str, bytes], margin: float = MARGIN) -> DataFrame:
    """doc_id, ``lang_pred`` (best language, of several the first in ``dictionaries``; ``und`` without letters), ``score`` (0 to 1, the share of the best one if each byte
    saved doubles the odds), ``margin`` and ``rejected`` (the margin is narrow). One pass, no shuffle."""
    held = docs.sparkSession.sparkContext.broadcast(dictionaries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coders = []
        for lang, content in held.value.items():
            data = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            data.precompute_compress(level=LEVEL)
            coders.append((lang, zstandard.ZstdCompressor(level=LEVEL, dict_data=data, write_content_size=False, write_checksum=False, write_dict_id=False)))
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                if not coders or not text or not any(map(str.isalpha, text)):
                    rows.append(("und", 0.0, 0.0, True))
                    continue
                data = _plain(text)
                blocks = [data[k : k + BLOCK_BYTES] for k in range(0, len(data), BLOCK_BYTES)]
                sizes = [sum(len(c.compress(b)) for b in blocks) for _, c in coders]
                best = min(range(len(sizes)), key=sizes.__getitem__)
                share = 1.0 / sum(2.0 ** -min(s - sizes[best], 1000) for s in sizes)
                second = min((s for k, s in enumerate(sizes) if k != best), default=2 * sizes[best])
                gap = (second - sizes[best]) / max(second, 1)
                rows.append((coders[best][0], share, gap, gap < margin))
            lang, score, gap, rejected = zip(*rows) if rows else ((), (), (), ())
            arrays = [batch.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(gap, pa.float64()), pa.array(rejected, pa.bool_())]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "lang_pred", "score", "margin", "rejected"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, lang_pred string, score double, margin double, rejected boolean")


def report(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Learn from rows whose crc32(doc_id) mod 4 is not 2 and predict all rows."""
    fold = crc("doc_id") % 4 == 2
    found = classify(docs, learn(docs.where(~fold)))
    return found.select("doc_id", fold.alias("held_out"), "lang_pred", "score", "margin", "rejected")
