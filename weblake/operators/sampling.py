"""Seeded, repeatable sampling without all-pairs enumeration.

``seeded_draw`` turns (seed, parts...) into a uniform 32-bit integer through
md5, so a draw depends only on the row's own values -- not on partitioning or
task order -- and equals the same md5 computation in any SQL engine.

``sample_per_group`` takes k distinct items for each group, independently of every
other group's. Items are put in a seeded random order (a global sort on their hash,
numbered 0..n-1); a group has a keyed pseudo-random permutation of 0..n-1 of its own
(:func:`permuted`) and takes the items at the first k of its positions, which are
distinct. Work is proportional to the output size (sum of k), never to
groups x items, and a group with a very large k is cut into chunks that are
spread over tasks before its positions are generated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHUNK = 4096
BUCKET_HEX = 3         # 4096 hash buckets for a global order
WITHIN_BUCKET_HEX = 1  # 16 per key: splits a hot key without multiplying small keys


ROUNDS = 4             # of the permutation's network
WALK = 24              # steps outside 0..n-1 that are followed


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hash_text(seed, *parts) -> Column:
    """md5 hex of ``seed:part1:part2...``; parts are column names or Columns
    (pass salts as ``F.lit``), rendered as text."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[_c(p).cast("string") for p in parts]))



def seeded_draw(seed, *parts) -> Column:
    """Uniform integer in [0, 2^32) from md5 of ``seed:parts``."""
    return F.conv(F.substring(hash_text(seed, *parts), 1, 8), 16, 10).cast("bigint")


def _quotient(a: Column, b: Column) -> Column:
    return ((a - F.pmod(a, b)) / b).cast("bigint")   # exact: a multiple of b below 2**53


def permuted(df: DataFrame, i: str, n: str, seed, *key, name: str = "__pos") -> DataFrame:
    """``df`` with column ``name``: where the permutation of 0..n-1 that belongs to ``key`` puts ``i``.

    A Feistel network over pairs (l, r), l < a and r < b, with a the root of n and a * b just not
    below n; round functions are md5 of (seed, key, round, other half). A value from n on (fewer than
    a of them) is permuted again until it falls below n (cycle walking): each step stays
    outside with a chance of at most 1 / root of n, so ``WALK`` steps never suffice to stay there
    (were it to happen, the query fails rather than repeat an item). ``i`` and ``n`` name columns, n at
    most 2**52 and not zero. The rounds are columns of their own, so that each hash is computed once."""
    size, a, b = F.col("__size"), F.col("__a"), F.col("__b")

    def halves(v: Column) -> tuple[Column, Column]:
        return _quotient(v, b), F.pmod(v, b)

    def step(k: int, left: Column, right: Column) -> Column:
        own, other, m = (left, right, a) if k % 2 == 0 else (right, left, b)
        draw = F.conv(F.substring(hash_text(seed, *key, F.lit(f"round-{k}"), other), 1, 15), 16, 10).cast("bigint")
        return F.pmod(own + draw, m)

    def once(v: Column) -> Column:
        left, right = halves(v)
        for k in range(ROUNDS):
            left, right = (step(k, left, right), right) if k % 2 == 0 else (left, step(k, left, right))
        return left * b + right

    out = df.withColumn("__size", F.col(n).cast("bigint")).withColumn("__a", F.ceil(F.sqrt("__size")).cast("bigint"))
    out = out.withColumn("__b", _quotient(size + a - 1, a))
    left, right = halves(F.col(i).cast("bigint"))
    out = out.withColumns({"__l": left, "__r": right})
    for k in range(ROUNDS):
        out = out.withColumn("__l" if k % 2 == 0 else "__r", step(k, F.col("__l"), F.col("__r")))
    out = out.withColumn("__v", F.col("__l") * b + F.col("__r"))
    walked = F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), F.col("__v"), lambda v, _: F.when(v < size, v).otherwise(once(v)))
    out = out.withColumn("__v", F.when(F.col("__v") < size, F.col("__v")).otherwise(walked))
    stuck = F.raise_error(F.lit("sample: a walk did not return")).cast("bigint")
    # Never null, and said to be: a join on a nullable position first filters it, and that filter is pushed
    # below all rounds with their hashes written out inside each other.
    return (out.withColumn(name, F.coalesce(F.when(F.col("__v") < size, F.col("__v")).otherwise(stuck), F.lit(-1).cast("bigint")))
            .drop("__size", "__a", "__b", "__l", "__r", "__v"))


def _bucket(h: Column, digits: int = BUCKET_HEX) -> Column:
    return F.coalesce(F.conv(F.substring(h, 1, digits), 16, 10).cast("int"), F.lit(0))   # never null, see permuted


def rank_by_hash(items: DataFrame, key: str, seed, salt: str, name: str = "__pos",
                 within: str | None = None, with_sizes: bool = False):
    """``items`` numbered 0..n-1 in the order of md5(seed:salt:[within:]key) --
    globally, or inside each value of ``within``.

    md5 is uniform, so its first hex digits cut the order into equal buckets
    with fixed bounds: each row's number is the count of rows in earlier
    buckets plus its rank inside its own bucket. This is deterministic (no
    dependence on how the input is partitioned), a group with very many items
    is spread over many buckets, and only per-bucket counts are combined.
    With ``with_sizes`` also returns the item count per ``within`` value (from
    the same bucket counts).
    """
    parts = [F.lit(salt)] + ([within] if within else []) + [key]
    h = hash_text(seed, *parts)
    grp = [within] if within else []
    digits = WITHIN_BUCKET_HEX if within else BUCKET_HEX
    tagged = items.withColumn("__h", h).withColumn("__b", _bucket(F.col("__h"), digits))
    tagged = tagged.withColumn("__h", F.unhex("__h"))   # the same order in half the bytes to shuffle and sort
    counts = tagged.groupBy(*grp, "__b").agg(F.count(F.lit(1)).alias("__bn"))
    earlier = Window.partitionBy(*grp).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*grp, "__b", F.coalesce(F.sum("__bn").over(earlier), F.lit(0)).alias("__boff"))
    inner = Window.partitionBy(*grp, "__b").orderBy("__h", key)
    ranked = tagged.withColumn("__r", F.row_number().over(inner))
    if not within:
        offsets = F.broadcast(offsets)  # one row per bucket: at most 16**BUCKET_HEX rows
    out = (ranked.join(offsets, on=grp + ["__b"], how="inner")
           .withColumn(name, F.col("__boff") + F.col("__r") - 1)
           .drop("__h", "__b", "__r", "__boff"))
    if with_sizes:
        return out, counts.groupBy(*grp).agg(F.sum("__bn").alias("__size"))
    return out


def sample_per_group(groups: DataFrame, group_col: str, k_col: str, items: DataFrame, item_col: str,
                     seed, salt: str, chunk: int = CHUNK) -> DataFrame:
    """For each group row, min(k, n) distinct items (n = number of items).

    Returns the group columns joined with the chosen item rows.
    """
    n = items.select(F.count(F.lit(1))).scalar()
    ranked = rank_by_hash(items, item_col, seed, salt)
    too_many = F.raise_error(F.lit("sample: more than 2**52 items")).cast("bigint")
    g = (groups.withColumn("__n", n).withColumn("__n", F.when(F.col("__n") <= 1 << 52, F.col("__n")).otherwise(too_many))
         .withColumn("__k", F.least(F.col(k_col).cast("bigint"), F.col("__n")))
         .filter(F.col("__k") > 0))
    # Chunk rows are few and small, so AQE would coalesce their shuffle into one
    # partition and generate every position in one task; an explicit partition
    # count (never coalesced) keeps the chunks -- and what they expand into --
    # spread over the cluster.
    slots = int(groups.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = (g.withColumn("__chunk", F.explode(F.sequence(F.lit(0).cast("bigint"),
                                                           F.ceil(F.col("__k") / chunk).cast("bigint") - 1)))
              .repartition(slots, group_col, "__chunk"))
    idx = chunks.withColumn("__i", F.explode(F.sequence(F.col("__chunk") * chunk,
                                                        F.least(F.col("__k"), (F.col("__chunk") + 1) * chunk) - 1)))
    idx = (permuted(idx, "__i", "__n", seed, F.lit(f"{salt}-walk"), group_col)
           .drop("__k", "__n", "__chunk", "__i"))
    # The position side grows with sum(k) but its size estimate does not (an
    # explode hides the fan-out), so never let the planner broadcast it.
    return idx.join(ranked.hint("merge"), on="__pos", how="inner").drop("__pos")


def pick_one_per_key(choices: DataFrame, keys: list[str], options: DataFrame, option_key: str, option_id: str,
                     seed, salt: str) -> DataFrame:
    """For each row of ``choices``, one of the ``options`` sharing ``option_key``.

    Options are numbered inside their key in seeded hash order (see
    :func:`rank_by_hash`; a key with very many options is split into buckets);
    each choice draws a position modulo its key's option count. Choices whose
    key has no option are dropped.
    """
    local, sizes = rank_by_hash(options, option_id, seed, salt, name="__opt", within=option_key,
                                with_sizes=True)
    sizes = sizes.withColumnRenamed("__size", "__m")
    draw = F.pmod(seeded_draw(seed, F.lit(salt + "-pick"), *keys), F.col("__m"))
    draw = F.coalesce(draw, F.lit(-1).cast("bigint"))   # never null, see permuted: or each draw is made again by a filter
    picks = choices.join(sizes, on=option_key, how="inner").withColumn("__opt", draw).drop("__m")
    return picks.join(local.hint("merge"), on=[option_key, "__opt"], how="inner").drop("__opt")
