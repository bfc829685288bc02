"""IPv4 interval join: attach to each log row every range that contains its host.

A plain ``BETWEEN`` join condition gives Catalyst no equality to hash or sort on,
so it plans a Cartesian / nested-loop join. Here each range is cut into aligned
blocks of a size that suits it: the finest multiple of four bits at which it
touches at most ``MAX_BLOCKS`` blocks. A host probes each block size that the
ranges use (at most nine), the (size, block) pair is the equi-join key, and the
exact ``BETWEEN`` is applied to the candidates. However wide a range is, it
makes at most ``MAX_BLOCKS`` rows, so the planner's size estimate of the block
table, which does not see the fan-out of an explode, is off by that constant at
most. Spark picks a broadcast hash join when the block table is small and a
sort-merge join otherwise; AQE's skew handling splits a hot block on the log side.

With a broadcast the probes cost no shuffle. Where the block table is too large for one and uses several
sizes, probing log rows would shuffle each of them once per size. Then every distinct host is looked up
once (its probes, the blocks, the exact bounds), and the log rows, shuffled once, join their host's
ranges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ip import (ip_to_long, is_ipv4, range_end_text, range_start_text, two_octet_key,
                           valid_ip_to_long)

STEP_BITS = 4
MAX_BLOCKS = 17   # a range at its size touches at most this many blocks
PROBE_ROWS = 100_000   # block rows up to which log rows are probed directly (a table that Spark can broadcast)


def range_blocks(ranges: DataFrame, range_col: str = "iprange") -> DataFrame:
    """Distinct ranges with numeric bounds, one row per block covered (``__bits``, ``__block``)."""
    r = (ranges.distinct()
         .withColumn("__lo", ip_to_long(range_start_text(range_col)))
         .withColumn("__hi", ip_to_long(range_end_text(range_col)))
         .filter(F.col("__lo") <= F.col("__hi")))
    fits = F.lit(32)
    for bits in range(32 - STEP_BITS, -1, -STEP_BITS):   # the finest size that fits comes last
        touched = F.shiftright("__hi", bits) - F.shiftright("__lo", bits) + 1
        fits = F.when(touched <= MAX_BLOCKS, bits).otherwise(fits)
    r = r.withColumn("__bits", fits)
    shift = F.pow(F.lit(2), F.col("__bits")).cast("bigint")
    return r.withColumn("__block", F.explode(F.sequence(F.floor(F.col("__lo") / shift), F.floor(F.col("__hi") / shift))))


def _probed(hosts: DataFrame, sizes: list[int], blocks: DataFrame) -> DataFrame:
    """Rows with ``__ip`` joined with the blocks that hold it, by exact bounds."""
    probes = [F.struct(F.lit(b).alias("bits"), F.shiftright("__ip", b).alias("block")) for b in sizes]
    if len(probes) > 1:
        hosts = hosts.withColumn("__probe", F.explode(F.array(*probes)))
    else:
        hosts = hosts.withColumn("__probe", probes[0] if probes else F.struct(F.lit(0).alias("bits"), F.col("__ip").alias("block")))
    hosts = hosts.withColumns({"__bits": F.col("__probe.bits"), "__block": F.col("__probe.block")}).drop("__probe")
    return hosts.join(blocks, on=["__bits", "__block"], how="inner").filter(F.col("__ip").between(F.col("__lo"), F.col("__hi")))


def ip_range_join(logs: DataFrame, ranges: DataFrame, host_col: str = "host",
                  range_col: str = "iprange", mode: str = "exact", probe_rows: int = PROBE_ROWS) -> DataFrame:
    """Inner join of ``logs`` with every range (``start-end``, inclusive) holding the host.

    ``mode="exact"``: equi join on blocks + exact bounds (default).
    ``mode="two_octet"``: the legacy coarse key -- the first two octets of host and
    range start concatenated -- then the bounds; it loses ranges wider than a /16
    and is kept for comparison only.

    Hosts that are not IPv4 dotted quads never match. A host inside two ranges
    gives two rows. Output: the log columns followed by the range columns.
    """
    range_cols = list(ranges.columns)
    # Only IPv4 hosts can match: drop the rest before any shuffle (so junk or
    # IPv6 traffic never piles up on one join key), then parse once.
    lg = logs.filter(is_ipv4(host_col)).withColumn("__ip", valid_ip_to_long(host_col))
    if mode == "exact":
        blocks = range_blocks(ranges, range_col)
        used = dict(blocks.groupBy("__bits").count().collect())   # at most nine sizes
        sizes = sorted(used)
        if len(sizes) > 1 and sum(used.values()) > probe_rows:
            found = _probed(lg.select("__ip").distinct(), sizes, blocks).select("__ip", "__lo", "__hi", *range_cols)
            joined = lg.join(found, on="__ip", how="inner")
        else:
            joined = _probed(lg, sizes, blocks)
    elif mode == "two_octet":
        rk = (ranges.distinct()
              .withColumn("__key", two_octet_key(range_col))
              .withColumn("__lo", ip_to_long(range_start_text(range_col)))
              .withColumn("__hi", ip_to_long(range_end_text(range_col))))
        lg = lg.withColumn("__key", two_octet_key(host_col))
        joined = lg.join(rk, on="__key", how="inner").filter(F.col("__ip").between(F.col("__lo"), F.col("__hi")))
    else:
        raise ValueError(f"unknown range join mode {mode!r}")
    return joined.select(*[F.col(c) for c in logs.columns + range_cols])
