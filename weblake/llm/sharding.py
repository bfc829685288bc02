"""Reproducible shuffle into shards: a Feistel permutation of row numbers (operator 6).

Rows get global numbers 0..N-1 in the order of their key (ties by size, then checksum;
rows equal in all three are interchangeable). A balanced Feistel network over the smallest
even-bit domain that holds N permutes the numbers; a result of N or more walks on through
the cycle until it falls below N, so the network is a bijection of 0..N-1. A row's place p
gives its shard ``p % shards`` and slot ``p // shards``: shard sizes differ by at most one,
slots have no gaps, and both can be computed from (row number, N, seed) alone.

The numbering sorts a slim table (key, size, checksum) by range, stages it, and adds the
row counts of earlier partitions; no row passes through a single task. Null keys sort
first, a null text has size 1 and checksum 0, an empty table gives an empty result,
repeated rows get places of their own; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage

ROUNDS = 6
_PRIME, _BASE = (1 << 31) - 1, 48271   # round keys are successive terms of this multiplicative sequence


def round_keys(seed: int) -> list[tuple[int, int]]:
    """(multiplier, offset) of every round, from the seed."""
    x, keys = seed % _PRIME or 1, []
    for _ in range(ROUNDS):
        a = x = x * _BASE % _PRIME
        b = x = x * _BASE % _PRIME
        keys.append((a | 1, b))
    return keys


def half_bits(n: int) -> int:
    """Bits of either half of the smallest domain that holds ``n`` numbers."""
    return max(1, -(-max(n - 1, 1).bit_length() // 2))


def feistel(x: np.ndarray, bits: int, keys: list[tuple[int, int]]) -> np.ndarray:
    """One pass of the network over numbers of ``2 * bits`` bits (``bits`` at most 31)."""
    mask, shift = np.uint64((1 << bits) - 1), np.uint64(bits)
    left, right = x >> shift, x & mask
    for a, b in keys:
        mixed = ((right * np.uint64(a) + np.uint64(b)) % np.uint64(_PRIME)) ** np.uint64(2) % np.uint64(_PRIME)
        left, right = right, left ^ (mixed & mask)
    return (left << shift) | right


def permute(rows: np.ndarray, n: int, seed: int) -> np.ndarray:
    """The places of row numbers among 0..n-1."""
    bits, keys = half_bits(n), round_keys(seed)
    out = feistel(rows.astype(np.uint64), bits, keys)
    while (outside := out >= np.uint64(n)).any():
        out[outside] = feistel(out[outside], bits, keys)
    return out.astype(np.int64)


def row_numbers(rows: DataFrame, order: list[str], out_col: str = "row") -> DataFrame:
    """``rows`` (slim) with gapless global numbers in the given order."""
    spark = rows.sparkSession
    rows = stage(rows, "unnumbered")   # the range sampling then reads the slim table, not its source
    count = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spread = F.monotonically_increasing_id()   # lets rows that tie in all columns fall in several ranges
    tagged = stage(rows.withColumn("__tie", spread).repartitionByRange(count, *order, "__tie")
                   .sortWithinPartitions(*order, "__tie").drop("__tie")
                   .withColumn("__part", F.spark_partition_id())
                   .withColumn("__at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))), "numbered")
    counts = sorted((r[0], r[1]) for r in tagged.groupBy("__part").count().collect())   # one row per partition
    before, total = [], 0
    for part, n in counts:
        before.append((part, total))
        total += n
    offsets = spark.createDataFrame(before, "__part int, __before bigint")
    return (tagged.join(F.broadcast(offsets), "__part").withColumn(out_col, F.col("__before") + F.col("__at"))
            .drop("__part", "__at", "__before"))


def shuffle_shards(docs: DataFrame, shards: int = 16, seed: int = 20_231, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, size (UTF-8 bytes plus 1), text_crc32, row, place, shard, slot."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    slim = docs.select(F.col(id_col), (F.octet_length(text).cast("long") + 1).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    numbered = stage(row_numbers(slim, [id_col, "size", "text_crc32"]), "rows")
    n = numbered.count()

    @F.pandas_udf("long")
    def place(rows: pd.Series) -> pd.Series:
        return pd.Series(permute(rows.to_numpy(), n, seed))

    placed = numbered.withColumn("place", place("row"))
    return placed.withColumn("shard", F.pmod("place", F.lit(shards)).cast("int")).withColumn("slot", F.expr(f"place div {shards}"))
