"""URL filter: a blocked Bloom filter before an exact hash join, after host rules (operator 5).

Everything is DataFrame expressions. A canonical URL's hashes pick one block of the filter
and eight bits in it (one in each of eight 32-bit words). The filter is a table of
blocks, built by a bitwise-or aggregation over the listed URLs; pages meet their block in
one join (a broadcast where Spark finds the block table small enough, otherwise a shuffle
join; filter and list are staged, so that adaptive execution can split a hot block or URL). Pages whose bits are all set are possible
hits; they alone take part in the exact join with the list, which removes false positives.

A null URL, or one without ``://``, has an empty host and path, fits no rule and is never
listed. Null or empty listed URLs are ignored, repeated ones count once, an empty list
blocks nothing; repeated pages are judged each for itself; extra columns pass through.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORDS = 8               # 32-bit words of a block
BITS_PER_KEY = 16
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)(?:\?([^#]*))?"


def host(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, PARTS, 1), F.lit("")), UPPER, LOWER)


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def canonical(url: Column) -> Column:
    """Host without ``www.`` or ``m.``, path without a last ``/``, query sorted and without
    tracking parameters; no scheme, no fragment. Null where there is no host."""
    site = F.regexp_replace(host(url), r"^(www|m)\.", "")
    query = F.filter(F.array_sort(F.split(F.coalesce(F.regexp_extract(url, PARTS, 3), F.lit("")), "&")),
                     lambda p: (p != "") & ~p.rlike("^(utm_[a-z]+|ref)="))
    rest = F.concat(site, F.regexp_replace(path(url), "/+$", ""), F.when(F.size(query) > 0, F.concat(F.lit("?"), F.concat_ws("&", query))).otherwise(""))
    return F.when(site != "", rest)


def match_rule(host_col: Column, path_col: Column, rules: list[tuple[str, str]]) -> Column:
    """struct(rule, action) of the longest rule that fits, null if none does. A rule is
    (``host/path``, action); it fits its host and all subdomains where the path starts so."""
    fits = F.lit(None).cast("struct<rule:string,action:string>")
    for rule, action in sorted(rules, key=lambda r: len(r[0])):
        site, _, rest = rule.partition("/")
        on_host = (host_col == site) | host_col.endswith(f".{site}")
        fits = F.when(on_host & path_col.startswith(f"/{rest}"), F.struct(F.lit(rule).alias("rule"), F.lit(action).alias("action"))).otherwise(fits)
    return fits


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def _masks(key: Column) -> list[Column]:
    """One bit in each word, from five bits each of a second hash."""
    h = F.xxhash64(key, F.lit("bits"))
    return [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(h, 5 * i).bitwiseAND(F.lit(31)).cast("int")) for i in range(WORDS)]


def bloom_blocks(listed: DataFrame, key: str, keys: int) -> tuple[DataFrame, int]:
    """The filter's block table (block, w0..w7) and its number of blocks."""
    blocks = max(1, -(-keys * BITS_PER_KEY // (32 * WORDS)))
    rows = listed.select(_block(F.col(key), blocks).alias("__block"), *[m.alias(f"__m{i}") for i, m in enumerate(_masks(F.col(key)))])
    return rows.groupBy("__block").agg(*[F.bit_or(f"__m{i}").alias(f"__w{i}") for i in range(WORDS)]), blocks


def possible_hits(pages: DataFrame, key: str, filter_blocks: DataFrame, blocks: int) -> DataFrame:
    """``pages`` with a boolean column ``__possible``."""
    nowhere = F.lit(-1) - F.monotonically_increasing_id()   # pages without a key meet no block and spread
    joined = pages.withColumn("__block", F.when(F.col(key).isNotNull(), _block(F.col(key), blocks)).otherwise(nowhere)).join(filter_blocks, "__block", "left")
    hit = reduce(lambda a, b: a & b, [F.col(f"__w{i}").bitwiseAND(m) == m for i, m in enumerate(_masks(F.col(key)))])
    return joined.withColumn("__possible", F.coalesce(hit, F.lit(False))).drop("__block", *[f"__w{i}" for i in range(WORDS)])


def judge(pages: DataFrame, listed_urls: DataFrame, rules: list[tuple[str, str]], url_col: str = "url", listed_col: str = "url") -> DataFrame:
    """``pages`` with host, path, rule, listed and verdict (``allow`` or ``block``): the longest
    rule's action, else ``block`` for a listed URL."""
    listed = stage(listed_urls.select(canonical(F.col(listed_col)).alias("__key")).where(F.col("__key").isNotNull()).distinct(), "listed")
    filter_blocks, blocks = bloom_blocks(listed, "__key", listed.count())
    filter_blocks = stage(filter_blocks, "bloom")
    keyed = possible_hits(pages.withColumn("__key", canonical(F.col(url_col))), "__key", filter_blocks, blocks)
    unlisted = keyed.where(~F.col("__possible")).withColumn("__listed", F.lit(False))
    checked = (keyed.where("__possible").join(listed.withColumn("__exact", F.lit(True)), "__key", "left")
               .withColumn("__listed", F.coalesce("__exact", F.lit(False))).drop("__exact"))
    both = unlisted.unionByName(checked).withColumns({"__host": host(F.col(url_col)), "__path": path(F.col(url_col))})
    both = both.withColumn("__rule", match_rule(F.col("__host"), F.col("__path"), rules))
    verdict = F.coalesce(F.col("__rule.action"), F.when(F.col("__listed"), "block").otherwise("allow"))
    made = ("host", "path", "rule", "listed", "verdict")   # replace columns of these names
    return both.select(*[F.col(c) for c in pages.columns if c not in made], F.col("__host").alias("host"), F.col("__path").alias("path"),
                       F.col("__rule.rule").alias("rule"), F.col("__listed").alias("listed"), verdict.alias("verdict"))
