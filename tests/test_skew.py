"""Hot keys: a third of the rows on one key must give whole, correct results."""

from contextlib import contextmanager

from pyspark.sql import functions as F

from weblake.operators import quality as Q
from weblake.operators.range_join import MAX_BLOCKS, ip_range_join, range_blocks
from weblake.operators.sampling import sample_per_group
from weblake.operators.upsert import upsert
from weblake.plans.weblogs import product_visits


def test_range_join_hot_block_and_junk(spark):
    n = 3000
    hosts = ([f"10.1.{i % 200}.{i % 250}" for i in range(n)]          # one hot /16
             + ["junk", "::1", "300.1.1.1"] * (n // 3)                 # a third invalid
             + [f"{20 + i % 50}.{i % 7}.1.1" for i in range(n)])
    logs = spark.createDataFrame([(h,) for h in hosts], "host string").repartition(6)
    ranges = spark.createDataFrame([("HOT", "10.1.0.0-10.1.99.255"), ("ALL", "0.0.0.0-255.255.255.255")]
                                   + [(f"c{i}", f"{20 + i}.0.0.0-{20 + i}.3.255.255") for i in range(50)],
                                   "country string, iprange string")
    got = ip_range_join(logs, ranges).groupBy("country").count()
    counts = {r.country: r["count"] for r in got.collect()}
    assert counts["ALL"] == 2 * n
    assert counts["HOT"] == sum(1 for i in range(n) if i % 200 < 100)
    assert sum(v for k, v in counts.items() if k.startswith("c")) == sum(1 for i in range(n) if i % 7 <= 3)


def test_upsert_with_a_third_null_keys(spark):
    t = spark.range(0, 3000).select(F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id")).alias("k"),
                                    F.lit("t").alias("v"))
    s = spark.range(1500, 4500).select(F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id")).alias("k"),
                                       F.lit("s").alias("v"))
    out = upsert(t, s, ["k"])
    c = {(r.null_key, r.v): r["count"] for r in out.groupBy(F.col("k").isNull().alias("null_key"), "v")
         .count().collect()}
    assert c[(True, "t")] == 1000 and c[(True, "s")] == 1000
    assert c[(False, "s")] == 2000 and c[(False, "t")] == 1000


def test_sample_hot_group(spark):
    items = spark.range(1, 20001).withColumnRenamed("id", "item")
    groups = spark.createDataFrame([(1, 20000), (2, 5), (3, 7)], "g bigint, k bigint")
    out = sample_per_group(groups, "g", "k", items, "item", 11, "hot", chunk=1000)
    c = {r.g: (r.n, r.d) for r in out.groupBy("g").agg(F.count("*").alias("n"),
                                                       F.count_distinct("item").alias("d")).collect()}
    assert c == {1: (20000, 20000), 2: (5, 5), 3: (7, 7)}


def test_quality_hot_foreign_key(spark):
    child = spark.range(0, 9000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 100)
                                        .alias("fk"))
    parent = spark.range(0, 50).withColumnRenamed("id", "pk")
    got = Q.reference_check("fk", child, "fk", parent, "pk").first().violations
    assert got == sum(1 for i in range(9000) if i % 3 != 0 and i % 100 >= 50)
    dup = Q.unique_check("pk", child, ["fk"]).first().violations
    assert dup == 100
    rows = child.select(F.when(F.col("fk") != 5, F.col("fk")).alias("fk"), F.when(F.col("fk") > 9, F.col("fk")).alias("other"))
    both = {r.check_name: r.violations for r in Q.table_check("pk", rows, ["fk"], "nn", ["fk", "other"]).collect()}
    assert both == {"pk": 99, "nn.fk": rows.filter("fk is null").count(), "nn.other": rows.filter("other is null").count()}
    checks = [("a", rows, "fk", parent, "pk"), ("b", rows, "other", parent, "pk"), ("c", rows, "fk", rows, "fk")]
    refs = {r.check_name: r.violations for r in Q.reference_checks(checks).collect()}
    assert refs == {c[0]: Q.orphans(*c[1:]).count() for c in checks}
    assert refs["c"] == 0 < refs["a"]


@contextmanager
def _skew_conf(spark):
    """No broadcasts, small skew thresholds: joins are sort-merge joins that AQE may split."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_hot_block_is_split_by_aqe_when_not_broadcast(spark):
    """Without a broadcast, the block join is a sort-merge join and AQE
    splits the partition of a block holding a third of the log rows."""
    with _skew_conf(spark):
        ids = spark.range(0, 300000)
        host = (F.when(F.col("id") % 3 == 0, F.concat(F.lit("10.1.1."), (F.col("id") % 200).cast("string")))
                .otherwise(F.concat((F.col("id") % 200 + 20).cast("string"), F.lit("."),
                                    (F.col("id") % 7).cast("string"), F.lit(".1.1"))))
        ranges = spark.createDataFrame([("HOT", "10.1.0.0-10.1.255.255")]
                                       + [(f"c{i}", f"{20 + i}.0.0.0-{20 + i}.6.255.255") for i in range(200)],
                                       "country string, iprange string")
        df = ip_range_join(ids.select(host.alias("host")), ranges)
        assert len(df.collect()) == 300000
        assert "SortMergeJoin(skew=true)" in df._jdf.queryExecution().executedPlan().toString()


def test_hot_product_is_split_by_aqe(spark):
    with _skew_conf(spark):
        i = F.col("id")
        enriched = spark.range(0, 300000).select(
            F.concat(F.lit("10.1."), (i % 250).cast("string"), F.lit("."), F.floor(i / 250).cast("string")).alias("HostIp"), F.lit("A").alias("Country"),
            F.timestamp_seconds(i).cast("timestamp_ntz").alias("VisitedAt"), F.lit("product").alias("PageType"),
            F.when(i % 2 == 0, F.lit("7")).otherwise((i % 500).cast("string")).alias("Id"))
        products = spark.range(0, 500).select(F.col("id").alias("ProductId"), F.concat(F.lit("p"), F.col("id")).alias("ProductName"))
        df = product_visits(enriched, products)
        assert len(df.collect()) == 300000
        assert "SortMergeJoin(skew=true)" in df._jdf.queryExecution().executedPlan().toString()


def test_wide_ranges_make_few_blocks(spark):
    ranges = spark.createDataFrame([(f"w{i}", "0.0.0.0-255.255.255.255") for i in range(1000)]
                                   + [("one", "1.2.3.4-1.2.3.4"), ("odd", "9.255.255.255-10.0.0.0"), ("big", "1.0.0.1-200.0.0.1")],
                                   "country string, iprange string")
    per = {r.country: r["count"] for r in range_blocks(ranges).groupBy("country").count().collect()}
    assert len(per) == 1003 and max(per.values()) <= MAX_BLOCKS and per["one"] == 1
    logs = spark.createDataFrame([("1.2.3.4",), ("10.0.0.0",), ("255.255.255.255",), ("200.0.0.2",)], "host string")
    got = {(r.host, r.country) for r in ip_range_join(logs, ranges).filter("country not like 'w%'").collect()}
    assert got == {("1.2.3.4", "one"), ("1.2.3.4", "big"), ("10.0.0.0", "odd"), ("10.0.0.0", "big")}
    assert ip_range_join(logs, ranges).count() == 4000 + 4
    assert ip_range_join(logs, ranges.limit(0)).count() == 0
