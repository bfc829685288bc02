"""Data-quality checks for keys, references and required columns.

Every check gives summary rows (``check_name``, ``violations``) over whole tables. A table's
key and not-null checks share one grouping on the key (counts combined before the shuffle);
all reference checks share one anti join: foreign-key values are counted before they are
shuffled, so a hot value is one row, and a child or parent table is read once for all its
checks.

The same counts can be kept for growing tables: :func:`key_state` holds how many rows each key value has,
and :func:`unique_change` / :func:`reference_change` give by how much a batch of added and removed rows
changes the violations, looking only at the key values that the batch touches.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values held by more than one row (with their row count)."""
    return (df.filter(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))
            .groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > 1))


def orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Child rows whose non-null ``fk`` matches no parent ``pk``."""
    return (child.filter(F.col(fk).isNotNull())
            .join(parent.select(F.col(pk).alias("__pk")), F.col(fk) == F.col("__pk"), "left_anti"))


def _summary(name: str, df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(name).alias("check_name"), "violations")


def unique_check(name: str, df: DataFrame, keys: list[str]) -> DataFrame:
    return _summary(name, duplicate_keys(df, keys))


def reference_check(name: str, child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    return _summary(name, orphans(child, fk, parent, pk))


def not_null_check(name: str, df: DataFrame, cols: list[str]) -> DataFrame:
    """One row per column: rows where it is null (computed in one pass)."""
    counts = df.agg(*[F.coalesce(F.sum(F.col(c).isNull().cast("bigint")), F.lit(0)).alias(f"{name}.{c}")
                      for c in cols])
    return counts.unpivot([], [f"`{name}.{c}`" for c in cols], "check_name", "violations")


def table_check(unique_name: str, df: DataFrame, keys: list[str], nn_name: str | None = None, cols: list[str] = ()) -> DataFrame:
    """:func:`unique_check` on ``keys`` and :func:`not_null_check` on ``cols`` from one grouping."""
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows"),
                                   *[F.sum(F.col(c).isNull().cast("bigint")).alias(f"__null_{i}") for i, c in enumerate(cols)])
    names = [unique_name, *[f"{nn_name}.{c}" for c in cols]]
    counts = [F.sum((whole & (F.col("__rows") > 1)).cast("bigint")), *[F.sum(f"__null_{i}") for i in range(len(cols))]]
    summary = groups.agg(*[F.coalesce(c, F.lit(0)).alias(n) for n, c in zip(names, counts)])
    return summary.unpivot([], [f"`{n}`" for n in names], "check_name", "violations")


def reference_checks(checks: list[tuple[str, DataFrame, str, DataFrame, str]]) -> DataFrame:
    """One row per (name, child, fk, parent, pk): child rows whose non-null ``fk`` matches no parent ``pk``."""
    def listed(side: int) -> DataFrame:
        tables: dict[int, tuple[DataFrame, list]] = {}
        for check in checks:
            tables.setdefault(id(check[side]), (check[side], []))[1].append(
                F.struct(F.lit(check[0]).alias("check_name"), F.col(check[side + 1]).cast("string").alias("value")))
        return reduce(DataFrame.unionByName, [df.select(F.inline(F.array(*pairs))) for df, pairs in tables.values()])

    spark = checks[0][1].sparkSession
    counted = listed(1).where("value is not null").groupBy("check_name", "value").agg(F.count(F.lit(1)).alias("n"))
    found = counted.join(listed(3), ["check_name", "value"], "left_anti").groupBy("check_name").agg(F.sum("n").alias("n"))
    names = spark.createDataFrame([(c[0],) for c in checks], "check_name string")
    return names.join(found, "check_name", "left").select("check_name", F.coalesce("n", F.lit(0)).alias("violations"))


def signed_keys(added: DataFrame | None, removed: DataFrame | None, keys: list[str]) -> DataFrame:
    """A batch as changes of row counts per (whole, non-null) key value: columns k0.., rows."""
    parts = [df.select(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], F.lit(sign).cast("bigint").alias("rows"))
             for df, sign in ((added, 1), (removed, -1)) if df is not None]
    names = [f"k{i}" for i in range(len(keys))]
    rows = reduce(DataFrame.unionByName, parts).filter(reduce(lambda a, b: a & b, [F.col(n).isNotNull() for n in names]))
    return rows.groupBy(*names).agg(F.sum("rows").alias("rows")).filter("rows <> 0")


def key_state(df: DataFrame, keys: list[str]) -> DataFrame:
    """How many rows each non-null key value has: what a batch is checked against."""
    return signed_keys(df, None, keys)


def merge_state(state: DataFrame, change: DataFrame) -> DataFrame:
    """The state after a batch (values without rows are gone)."""
    names = [c for c in state.columns if c != "rows"]
    return state.unionByName(change).groupBy(*names).agg(F.sum("rows").alias("rows")).filter("rows <> 0")


def _before(change: DataFrame, state: DataFrame, name: str) -> DataFrame:
    """``change`` with the rows that its values had in ``state``."""
    names = [c for c in state.columns if c != "rows"]
    return change.join(state.withColumnRenamed("rows", name), names, "left").fillna({name: 0})


def unique_change(name: str, state: DataFrame, change: DataFrame) -> DataFrame:
    """By how many the violations of a unique key change with a batch."""
    now = _before(change, state, "old").select(((F.col("old") + F.col("rows")) > 1).cast("bigint").alias("new"), (F.col("old") > 1).cast("bigint").alias("old"))
    return now.agg(F.coalesce(F.sum(F.col("new") - F.col("old")), F.lit(0)).alias("violations")).select(F.lit(name).alias("check_name"), "violations")


def reference_change(name: str, children: DataFrame, child_change: DataFrame, parents: DataFrame, parent_change: DataFrame) -> DataFrame:
    """By how many the violations of a reference change with a batch of children and of parents: children of
    touched values that had, or now have, no parent."""
    touched = (child_change.select("k0", F.col("rows").alias("c"), F.lit(0).cast("bigint").alias("p"))
               .unionByName(parent_change.select("k0", F.lit(0).cast("bigint").alias("c"), F.col("rows").alias("p")))
               .groupBy("k0").agg(F.sum("c").alias("c"), F.sum("p").alias("p")))
    both = _before(_before(touched, children, "old_c"), parents, "old_p")
    old = F.when(F.col("old_p") == 0, F.col("old_c")).otherwise(0)
    new = F.when(F.col("old_p") + F.col("p") == 0, F.col("old_c") + F.col("c")).otherwise(0)
    return both.agg(F.coalesce(F.sum(new - old), F.lit(0)).alias("violations")).select(F.lit(name).alias("check_name"), "violations")


def report_after(before: DataFrame, changes: list[DataFrame]) -> DataFrame:
    """A report brought up to date by the changes of a batch."""
    return before.unionByName(report(changes)).groupBy("check_name").agg(F.sum("violations").alias("violations"))


def report(checks: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)
