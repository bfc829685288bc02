"""Exact distinct counts from mergeable state.

``count(distinct x)`` has to see all rows again whenever some are added. Here a part of the rows (a month, a
batch) is reduced to a state, states of parts are merged by union, and counts are read from the merged
state: the same numbers as a recount, without the rows.

* Whole numbers (order ids) become bitmaps: one row per group and run of 32,768 consecutive values,
  merged bit by bit and counted. A state of dense ids takes about a bit per id.
* Other values, and numbers that lie far apart (addresses), stay one row per group and value.

Both are combined in each task before the shuffle, and a group with very many values is many rows of
state, so none has to fit into one row or one task. Null values count nothing, but keep their group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKET, BITS, VALUE = "bucket", "bits", "value"


def bitmap_state(rows: DataFrame, groups: list[str], value: str) -> DataFrame:
    """State of the distinct whole numbers ``value`` per group: (groups, bucket, bits)."""
    number = F.col(value).cast("bigint")
    return rows.groupBy(*groups, F.bitmap_bucket_number(number).alias(BUCKET)).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias(BITS))


def value_state(rows: DataFrame, groups: list[str], value: str) -> DataFrame:
    """State of distinct values of any type per group: (groups, value)."""
    return rows.select(*groups, F.col(value).alias(VALUE)).distinct()


def merge_states(states: DataFrame, groups: list[str]) -> DataFrame:
    """One state from the union of several, by fewer groups if wanted (months of a year)."""
    if BITS in states.columns:
        return states.groupBy(*groups, BUCKET).agg(F.bitmap_or_agg(BITS).alias(BITS))
    return states.select(*groups, VALUE).distinct()


def distinct_counts(states: DataFrame, groups: list[str], name: str = "n") -> DataFrame:
    """Distinct values per group over all given states (which may overlap)."""
    merged = merge_states(states, groups)
    count = F.sum(F.bitmap_count(BITS)) if BITS in states.columns else F.count(VALUE)
    return merged.groupBy(*groups).agg(count.alias(name))
