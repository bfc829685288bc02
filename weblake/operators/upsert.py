"""MERGE on a condition and insert-if-absent as DataFrame compositions.

Parquet tables have no MERGE; the merged table is a full outer join of target and source, so
each side is exchanged once:

* a matched target row takes the source row's values, an unmatched one is kept,
  an unmatched source row is inserted;
* rows with a null key part never match: they are passed through without being
  shuffled, so a flood of null keys cannot create a hot partition.

The condition is a list of key columns, or any boolean condition over the aliases ``target`` and
``source`` with at least one equality between the two. Equalities become the keys of the exchange
(found in the condition as Catalyst has analysed it), the rest is evaluated inside the join.

A target row matched by several source rows is an error (never a silent pick). The number of
source rows of a key is counted over the exchange the join needs anyway. Where the keys are the
whole condition, a filter on the joined row raises. With a further condition several source rows
of a key are legal as long as each target row meets one of them: only the source rows of such
keys are joined apart (the source's exchange is used again, of the target the keys and what the
condition reads are exchanged once more), and the matches are counted per target row.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MULTI_MATCH_ERROR = "upsert: a target row is matched by more than one source row"
DUPLICATE_BATCH_ERROR = "insert_if_absent: a key occurs more than once in the batch"


def _keys_not_null(keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def _aligned(source: DataFrame, target: DataFrame) -> DataFrame:
    """``source`` with exactly the target's columns, order and types."""
    types = dict(target.dtypes)
    return source.select(*[F.col(c).cast(types[c]).alias(c) for c in target.columns])


def _failing_rows(violations: DataFrame, target: DataFrame, message: str) -> DataFrame:
    """No rows when ``violations`` is empty; otherwise one row that raises ``message``.

    Violations are counted first (a global aggregate: partial counts per task,
    one tiny final merge); the raise is conditional on that count, so even if a
    filter is pushed onto this expression it can only fire for a real violation.
    """
    types = dict(target.dtypes)
    n = F.col("__violations")
    counted = violations.agg(F.count(F.lit(1)).alias("__violations")).filter(n > 0)
    return counted.select(*[F.when(n > 0, F.raise_error(F.lit(message))).cast(types[c]).alias(c)
                            for c in target.columns])


@dataclass
class MergeCondition:
    """Key expressions of both sides (over the aliases ``target`` and ``source``) and the rest of the condition."""
    target_keys: list[Column]
    source_keys: list[Column]
    rest: Column | None = None

    def keyed(self, side: DataFrame, alias: str) -> DataFrame:
        """``side`` under its alias, with its keys as columns ``__k0``, ``__k1``, ..."""
        keys = self.target_keys if alias == "target" else self.source_keys
        return side.alias(alias).select(f"{alias}.*", *[k.alias(n) for n, k in zip(self.names, keys)])

    @property
    def names(self) -> list[str]:
        return [f"__k{i}" for i in range(len(self.target_keys))]

    def matches(self) -> Column:
        """The condition between two sides made by :meth:`keyed` (and given their aliases again)."""
        keys = [F.col(f"target.{n}") == F.col(f"source.{n}") for n in self.names]
        return reduce(lambda a, b: a & b, keys if self.rest is None else [*keys, self.rest])


def _conjuncts(expression) -> list:
    if expression.getClass().getSimpleName() == "And":
        return _conjuncts(expression.left()) + _conjuncts(expression.right())
    return [expression]


def merge_condition(target: DataFrame, source: DataFrame, on: list[str] | str | Column) -> MergeCondition:
    """``on`` split into key equalities and the rest. Text and columns name the sides ``target`` and ``source``."""
    if isinstance(on, (list, tuple)):
        if not on:
            raise ValueError("a merge needs at least one key column")
        return MergeCondition([F.col(f"target.`{k}`") for k in on], [F.col(f"source.`{k}`") for k in on])
    condition = F.expr(on) if isinstance(on, str) else on
    joined = target.alias("target").join(source.alias("source"), condition, "inner")._jdf.queryExecution().analyzed()
    sides = [(joined.left().outputSet(), "target"), (joined.right().outputSet(), "source")]
    found, rest = MergeCondition([], []), []
    for part in _conjuncts(joined.condition().get()):
        if part.getClass().getSimpleName() == "EqualTo":
            of = [[name for output, name in sides if not e.references().isEmpty() and e.references().subsetOf(output)]
                  for e in (part.left(), part.right())]
            if of == [["target"], ["source"]] or of == [["source"], ["target"]]:
                one, two = F.expr(part.left().sql()), F.expr(part.right().sql())
                found.target_keys.append(one if of[0] == ["target"] else two)
                found.source_keys.append(two if of[0] == ["target"] else one)
                continue
        rest.append(F.expr(part.sql()))
    if not found.target_keys:
        raise ValueError("a merge condition needs an equality between target and source")
    found.rest = reduce(lambda a, b: a & b, rest) if rest else None
    return found


def upsert(target: DataFrame, source: DataFrame, on: list[str] | str | Column) -> DataFrame:
    """The target after ``MERGE source ON on WHEN MATCHED UPDATE * WHEN NOT MATCHED INSERT *``."""
    src = _aligned(source, target)
    cond = merge_condition(target, src, on)
    columns, names = target.columns, cond.names
    ok = _keys_not_null(names)
    t, s = cond.keyed(target, "target"), cond.keyed(src, "source")
    counted = s.filter(ok).withColumn("__rows", F.count(F.lit(1)).over(Window.partitionBy(*names))).alias("source")
    here = t.filter(ok).withColumn("__old", F.lit(True))
    if cond.rest is not None:
        here = here.withColumn("__id", F.monotonically_increasing_id())
    here = here.alias("target")
    joined = here.join(counted, cond.matches(), "full_outer")
    several = F.col("target.__old") & (F.col("source.__rows") > 1)
    clash = F.raise_error(F.lit(MULTI_MATCH_ERROR)).cast("boolean")
    new = F.col("source.__rows").isNotNull()
    values = [F.when(new, F.col(f"source.`{c}`")).otherwise(F.col(f"target.`{c}`")).alias(c) for c in columns]
    if cond.rest is None:
        merged = joined.filter(F.when(several, clash).otherwise(True)).select(*values)
    else:
        met = here.join(counted.filter(F.col("__rows") > 1), cond.matches(), "inner")
        matches = F.count(F.lit(1)).over(Window.partitionBy(*[F.col(f"target.{n}") for n in names], F.col("target.__id")))
        met = met.withColumn("__matches", matches).filter(F.when(F.col("__matches") > 1, clash).otherwise(True))
        merged = (joined.filter(F.coalesce(~several, F.lit(True))).select(*values)
                  .unionByName(met.select(*[F.col(f"source.`{c}`").alias(c) for c in columns])))
    return merged.unionByName(t.filter(~ok).select(*columns)).unionByName(s.filter(~ok).select(*columns))


def rows_if_absent(target: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of ``batch`` that :func:`insert_if_absent` would add (with the
    repeated-key guard)."""
    src = _aligned(batch, target)
    ok = _keys_not_null(keys)
    s_ok = src.filter(ok)
    repeated = (s_ok.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
                .filter(F.col("__n") > 1).select(*keys))
    guard = _failing_rows(repeated, target, DUPLICATE_BATCH_ERROR)
    new_rows = s_ok.join(target.filter(ok).select(*keys), on=keys, how="left_anti")
    return new_rows.unionByName(src.filter(~ok)).unionByName(guard)


def insert_if_absent(target: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """``INSERT ... ON CONFLICT (keys) DO NOTHING``-like: existing rows win.

    A key repeated inside the batch is an error, as a single multi-row insert
    with an on-conflict clause cannot touch one row twice.
    """
    return target.unionByName(rows_if_absent(target, batch, keys))
