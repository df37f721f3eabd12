"""URL filter: a short list of host and path rules, and a long list of URLs behind a blocked Bloom filter.

Rules decide first: a rule fits its host and all subdomains where the path starts with the rule's, and the longest wins (then the
longer host, then block). What no rule fits is looked up in a list of URLs, both sides in canonical form. The list is
hashed into a blocked Bloom filter: a key sets one bit in each of the eight words of one 512-bit block, a block is one
row, and the words of a block are or-ed before and after the shuffle. Only pages whose eight bits are all set are possible
hits; those alone are joined exactly with the list, which removes the false positives. Others are decided without a shuffle
as long as the filter is measured small enough to broadcast; beyond that pages meet their block in a shuffled join that
adaptive execution splits under skew.

A null URL, or one without ``://``, has an empty host and path, fits no rule and is not listed: it is allowed. Rows are judged
one by one, repeated or not. Columns of the input stay, except those with a name of the results. An empty list blocks
nothing; an empty table gives an empty result. No Python code runs on rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidecart.llm.common import small, stored


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str

    @property
    def written(self) -> str:
        return self.host + self.path


# The rules, and names of hosts whose pages are on the list.
RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)
SPAM_NAMES = ("cheap-pills", "spam-farm")

MADE = ["host", "path", "rule", "verdict", "canonical"]
#: Bits of the filter for each listed URL; eight are set. About one page in a thousand passes by chance.
BITS_PER_URL, BLOCK_BITS, WORDS = 16, 512, 8
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + F.lit(3), F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def canonical(url: Column) -> Column:
    """One spelling for the addresses of a page: no scheme, user, port, ``www.``, closing dots, doubled or closing slashes, index
    page, fragment or tracking arguments; other arguments in order. Empty without a host."""
    host = F.regexp_replace(F.regexp_replace(host_of(url), r"(?s)^.*@", ""), r":[0-9]*\z", "")
    host = F.regexp_replace(F.rtrim(host, F.lit(".")), r"^www\.", "")
    path = F.regexp_replace(F.regexp_replace(path_of(url), r"/+", "/"), r"/(index\.html?)?\z", "")
    asked = F.split(F.regexp_extract(_rest(url), r"^[^?#]*\?([^#]*)", 1), "&")
    asked = F.array_sort(F.filter(asked, lambda a: (a != "") & ~a.rlike(r"^(utm_[a-z]+|ref|gclid|fbclid)=")))
    query = F.array_join(asked, "&")
    return F.when(host == "", "").otherwise(F.concat(host, path, F.when(query == "", "").otherwise(F.concat(F.lit("?"), query))))


def ruled(host: Column, path: Column, rules: Sequence[Rule] = RULES) -> Column:
    """(rule, verdict) of the rule that wins, as a struct; null where none fits. ``rules`` is a short list kept in the plan."""
    best = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in sorted(rules, key=lambda r: (len(r.written), len(r.host), r.verdict == "block", r.written)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        best = F.when(fits, F.struct(F.lit(r.written).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(best)
    return best


def _word_bits(key: Column) -> list[Column]:
    """For each word of the block, the word with the key's bit set: six bits of a second hash choose it."""
    h = F.xxhash64(key, F.lit(1))
    place = [F.shiftrightunsigned(h, 6 * k).bitwiseAND(F.lit(63)).cast("int") for k in range(WORDS)]
    return [F.call_function("shiftleft", F.lit(1).cast("long"), p) for p in place]


def _block_of(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks).cast("long"))


def bloom_filter(listed: DataFrame, blocks: int) -> DataFrame:
    """(block, w0 to w7): the blocks that hold a bit of ``listed`` (canonical)."""
    words = [bits.alias(f"w{k}") for k, bits in enumerate(_word_bits(F.col("canonical")))]
    rows = listed.select(_block_of(F.col("canonical"), blocks).alias("block"), *words)
    return rows.groupBy("block").agg(*[F.bit_or(f"w{k}").alias(f"w{k}") for k in range(WORDS)])


def possible(pages: DataFrame, blooms: DataFrame, blocks: int) -> DataFrame:
    """``pages`` (canonical, open) with ``maybe``: false where the filter rules the list out, or nothing is asked."""
    key = F.col("canonical")
    asked = F.when(F.col("open") & (key != ""), _block_of(key, blocks))
    hit = F.lit(True)
    for k, bits in enumerate(_word_bits(key)):
        hit = hit & (F.col(f"w{k}").bitwiseAND(bits) == bits)
    probed = pages.withColumn("_block", asked).join(blooms.withColumnRenamed("block", "_of"), F.col("_block") == F.col("_of"), "left")
    return probed.withColumn("maybe", F.coalesce(hit, F.lit(False))).drop("_block", "_of", *[f"w{k}" for k in range(WORDS)])


def judge(pages: DataFrame, listed: DataFrame, rules: Sequence[Rule] = RULES, url: str = "url") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule``, ``verdict`` (allow or block) and ``canonical``.

    ``listed`` holds the URLs to block (column ``url``), in any spelling, repeated or not.
    """
    spelled = listed.select(canonical(F.col("url")).alias("canonical")).where(F.col("canonical") != "")
    names = stored(spelled.distinct())
    n = names.count()
    blocks = max(1, -(-n * BITS_PER_URL // BLOCK_BITS))
    blooms = small(stored(bloom_filter(names, blocks)), 8 * (WORDS + 1))
    kept = pages.drop(*[c for c in MADE if c != url])
    address = F.coalesce(F.col(url), F.lit(""))
    rows = kept.withColumns({"host": host_of(address), "path": path_of(address), "canonical": canonical(address)})
    rows = rows.withColumn("_ruled", ruled(F.col("host"), F.col("path"), rules)).withColumn("open", F.col("_ruled").isNull())
    probed = possible(rows, blooms, blocks)
    exact = names.select(F.col("canonical").alias("_listed"))
    size = F.length("_listed") + F.lit(16)
    hits = probed.where("maybe").join(small(exact, size), F.col("canonical") == F.col("_listed"), "left")
    sure = probed.where("not maybe").withColumn("_listed", F.lit(None).cast("string"))
    verdict = F.coalesce("_ruled.verdict", F.when(F.col("_listed").isNotNull(), "block").otherwise("allow"))
    columns = [F.col(c) for c in kept.columns]
    return sure.unionByName(hits).select(*columns, "host", "path", F.col("_ruled.rule").alias("rule"), verdict.alias("verdict"), "canonical")


def spam_list(pages: DataFrame, rules: Sequence[Rule] = RULES, names: Sequence[str] = SPAM_NAMES) -> DataFrame:
    """(url): pages on hosts with a spam name as one of their labels, and pages that a rule blocks (whose other spellings no
    rule may fit)."""
    address = F.coalesce(F.col("url"), F.lit(""))
    host, path = host_of(address), path_of(address)
    named = host.rlike(r"(^|\.)(" + "|".join(names) + r")\.")
    blocked = F.coalesce(ruled(host, path, rules).getField("verdict") == "block", F.lit(False))
    return pages.where(named | blocked).select("url")


def report(pages: DataFrame) -> DataFrame:
    """Per row: page_id, host, path, rule and verdict, with the canonical URL."""
    return judge(pages.select("page_id", "url"), spam_list(pages)).select("page_id", *MADE)
