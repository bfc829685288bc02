"""Mergeable distinct counts, violations of a batch, balanced JDBC reads, the range join by hosts."""

import os
import random

from pyspark.sql import functions as F

from weblake.operators import distinct as D
from weblake.operators import quality as Q
from weblake.operators.range_join import ip_range_join
from weblake.sinks import jdbc as JS
from weblake.sources import jdbc as JR

from .test_skew import _skew_conf


def test_distinct_counts_of_overlapping_states(spark):
    rng = random.Random(1)
    rows = [(rng.choice("ab"), rng.choice(["x", "y", None]), rng.choice([None, 0, -5, 1, 32768, 32769, 10**12, rng.randrange(10**6)]))
            for _ in range(3000)] + [("only null", "x", None)]
    df = spark.createDataFrame(rows, "part string, g string, id long")
    want, whole = {}, {}
    for part, g, i in rows:
        want.setdefault(g, set()).add(i)
        whole.setdefault((part, g), set()).add(i)
    want, whole = ({k: len(v - {None}) for k, v in x.items()} for x in (want, whole))
    for state in (D.bitmap_state, D.value_state):
        parts = [state(df.filter(F.col("part") == p), ["part", "g"], "id") for p in ("a", "b", "only null")]
        merged = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[0])   # one part twice
        assert {r.g: r.n for r in D.distinct_counts(merged, ["g"]).collect()} == want
        again = D.merge_states(merged, ["part", "g"])
        assert {(r.part, r.g): r.n for r in D.distinct_counts(again, ["part", "g"]).collect()} == whole
        assert D.distinct_counts(state(df.limit(0), ["g"], "id"), ["g"]).count() == 0


def test_violations_after_batches_equal_the_whole_report(spark):
    rng = random.Random(2)
    schema = "id long, ref long"
    row = lambda: (rng.choice([None, *range(12)]), rng.choice([None, *range(8)]))
    child, parent = [row() for _ in range(30)], [(i, None) for i in rng.sample(range(8), 3)]

    def frame(rows):
        return spark.createDataFrame(rows, schema)

    def whole():
        return {r.check_name: r.violations for r in Q.report([
            Q.unique_check("pk", frame(child), ["id"]), Q.reference_check("fk", frame(child), "ref", frame(parent), "id")]).collect()}

    report = Q.report([Q.unique_check("pk", frame(child), ["id"]), Q.reference_check("fk", frame(child), "ref", frame(parent), "id")])
    ids, refs, parents = Q.key_state(frame(child), ["id"]), Q.key_state(frame(child), ["ref"]), Q.key_state(frame(parent), ["id"])
    for _ in range(3):
        added, removed = [row() for _ in range(10)], rng.sample(child, 8)
        new, gone = [(i, None) for i in rng.sample(range(8), 2)], rng.sample(parent, 1)
        id_change, ref_change = (Q.signed_keys(frame(added), frame(removed), [k]) for k in ("id", "ref"))
        parent_change = Q.signed_keys(frame(new), frame(gone), ["id"])
        report = Q.report_after(report, [Q.unique_change("pk", ids, id_change), Q.reference_change("fk", refs, ref_change, parents, parent_change)])
        for r in removed:
            child.remove(r)
        for r in gone:
            parent.remove(r)
        child, parent = child + added, parent + new
        got = {r.check_name: r.violations for r in report.collect()}
        assert got == whole()
        report = spark.createDataFrame(list(got.items()), "check_name string, violations long")
        states = [spark.createDataFrame(Q.merge_state(s, c).collect(), "k0 long, rows long") for s, c in ((ids, id_change), (refs, ref_change), (parents, parent_change))]
        ids, refs, parents = states
        assert {r.k0: r.rows for r in ids.collect()} == {r.k0: r.rows for r in Q.key_state(frame(child), ["id"]).collect()}


def test_balanced_strides_of_a_skewed_key(spark, tmp_path):
    url, props = f"jdbc:derby:{os.path.join(tmp_path, 'db')};create=true", {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    key = F.when(F.col("id") < 9000, F.col("id") % 3000).otherwise(F.col("id") * 1000)   # nine tenths in a thousandth of the range
    JS.write_jdbc(spark.range(10_000).select(key.alias("OrderId"), F.lit("x").alias("v")), url, "items", props)
    even = JR.read_range_partitioned(spark, url, "items", '"OrderId"', 0, 10_000_000, 8, props)
    balanced = JR.read_balanced(spark, url, "items", "OrderId", 8, props, quote='"')

    def sizes(df):
        return sorted(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())
    assert max(sizes(even)) >= 9000
    assert len(sizes(balanced)) == 8 and max(sizes(balanced)) <= 2 * 10_000 / 8 and min(sizes(balanced)) >= 10_000 / 8 / 2
    assert balanced.count() == 10_000 and balanced.distinct().count() == even.distinct().count()
    nulls = spark.createDataFrame([(None,), (3,), (5,)], "k long")
    assert JR.quantile_predicates(nulls, "k", 1) == ["1 = 1"] and JR.quantile_predicates(nulls.limit(0), "k", 4) == ["1 = 1"]
    assert JR.quantile_predicates(nulls, "k", 4)[0].endswith("or k is null")


def _shuffled_rows(df):
    """Rows written by the exchanges of an executed plan."""
    total, seen, open_ = 0, set(), [df._jdf.queryExecution().executedPlan()]
    while open_:
        node = open_.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            open_.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            open_.append(node.plan())
        elif name != "ReusedExchangeExec":
            if name == "ShuffleExchangeExec" and node.id() not in seen:
                seen.add(node.id())
                total += node.metrics().get("shuffleRecordsWritten").get().value()
            children = node.children()
            open_ += [children.apply(i) for i in range(children.size())]
    return total


def test_log_rows_are_shuffled_once_when_ranges_use_several_sizes(spark):
    with _skew_conf(spark):
        i = F.col("id")
        logs = spark.range(60_000).select(F.concat_ws(".", (i % 40 + 20).cast("string"), (i % 7).cast("string"), F.lit("1"), (i % 50).cast("string")).alias("host"))
        ranges = [(f"n{k}", f"{20 + k}.1.1.3-{20 + k}.1.1.9") for k in range(40)] + [(f"m{k}", f"{20 + k}.0.0.0-{20 + k}.3.255.255") for k in range(40)]
        ranges += [("all", "0.0.0.0-255.255.255.255"), ("odd", "19.255.255.255-30.0.0.0"), ("one", "21.1.1.1-21.1.1.1")]
        ranges = spark.createDataFrame(ranges, "country string, iprange string")
        direct, by_host = ip_range_join(logs, ranges, probe_rows=1 << 40), ip_range_join(logs, ranges, probe_rows=0)
        rows = [sorted(map(tuple, df.groupBy("host", "country").count().collect())) for df in (direct, by_host)]
        assert rows[0] == rows[1] and sum(r[2] for r in rows[0]) > 60_000
        direct.collect(), by_host.collect()
        assert 2 * _shuffled_rows(by_host) < _shuffled_rows(direct)
        plan = by_host._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_a_hot_host_is_split_when_hosts_are_joined(spark):
    with _skew_conf(spark):
        i = F.col("id")
        logs = spark.range(300_000).select(F.when(i % 3 == 0, F.lit("10.1.1.1")).otherwise(
            F.concat_ws(".", (i % 200 + 20).cast("string"), (i % 7).cast("string"), (i % 250).cast("string"), F.lit("1"))).alias("host"), F.xxhash64("id").alias("v"))
        ranges = spark.createDataFrame([("wide", "0.0.0.0-255.255.255.255"), ("hot", "10.1.1.1-10.1.1.1")], "country string, iprange string")
        df = ip_range_join(logs, ranges, probe_rows=0)
        assert len(df.collect()) == 400_000
        assert "SortMergeJoin(skew=true)" in df._jdf.queryExecution().executedPlan().toString()
