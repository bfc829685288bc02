"""IPv4 codec and the range join (FIXTURES section 4 edge rows)."""

from pyspark.sql import functions as F

from weblake.functions.ip import ip_to_long, long_to_ip, range_end_text, range_start_text
from weblake.operators.range_join import ip_range_join


def _ip(spark, text):
    return spark.createDataFrame([(text,)], "h string").select(ip_to_long("h").alias("v")).first().v


def test_ip_above_128_is_positive_bigint(spark):
    assert _ip(spark, "200.1.0.9") == 3355508745


def test_ip_bounds_and_invalid(spark):
    assert _ip(spark, "0.0.0.0") == 0
    assert _ip(spark, "255.255.255.255") == 4294967295
    for bad in ["::1", "junk", "1.2.3.256", "1.2.3", "1.2.3.4.5", "01.2.3.4", " 1.2.3.4", "", None]:
        assert _ip(spark, bad) is None, bad


def test_long_to_ip_round_trip(spark):
    vals = [0, 1, 255, 256, 16777216, 3355508745, 4294967295]
    df = spark.createDataFrame([(v,) for v in vals], "n bigint")
    out = df.select("n", long_to_ip("n").alias("t")).select("n", "t", ip_to_long("t").alias("back")).collect()
    assert all(r.n == r.back for r in out)
    assert [r.t for r in out if r.n == 3355508745] == ["200.1.0.9"]
    assert spark.createDataFrame([(-1,), (4294967296,)], "n bigint").select(long_to_ip("n").alias("t")) \
        .filter(F.col("t").isNotNull()).count() == 0


def test_range_text(spark):
    df = spark.createDataFrame([("1.2.0.0-1.2.255.255",), ("9.9.9.9",)], "r string")
    rows = df.select(range_start_text("r").alias("a"), range_end_text("r").alias("b")).collect()
    assert [(r.a, r.b) for r in rows] == [("1.2.0.0", "1.2.255.255"), ("9.9.9.9", "9.9.9.9")]


def _join(spark, hosts, ranges, mode="exact"):
    logs = spark.createDataFrame([(h,) for h in hosts], "host string")
    rg = spark.createDataFrame(ranges, "country string, iprange string")
    return sorted((r.host, r.country) for r in ip_range_join(logs, rg, mode=mode).collect())


def test_range_across_128(spark):
    assert _join(spark, ["128.0.0.1"], [("X", "127.255.0.0-128.0.255.255")]) == [("128.0.0.1", "X")]


def test_inclusive_ends(spark):
    got = _join(spark, ["10.0.0.0", "10.0.199.255", "10.0.200.0"], [("A", "10.0.0.0-10.0.199.255")])
    assert got == [("10.0.0.0", "A"), ("10.0.199.255", "A")]


def test_two_octet_collision_has_no_false_match(spark):
    assert _join(spark, ["12.3.0.1"], [("A", "1.23.0.0-1.23.255.255")]) == []
    assert _join(spark, ["12.3.0.1"], [("A", "1.23.0.0-1.23.255.255")], mode="two_octet") == []


def test_invalid_hosts_dropped(spark):
    assert _join(spark, ["::1", "junk", "1.2.3.256", None], [("A", "0.0.0.0-255.255.255.255")]) == []


def test_overlapping_ranges_give_two_rows(spark):
    got = _join(spark, ["5.5.5.5"], [("A", "5.5.0.0-5.5.255.255"), ("B", "5.0.0.0-5.255.255.255")])
    assert got == [("5.5.5.5", "A"), ("5.5.5.5", "B")]


def test_wide_range_exact_vs_two_octet(spark):
    ranges = [("W", "20.0.0.0-20.2.255.255")]
    hosts = ["20.0.1.1", "20.1.1.1", "20.2.1.1"]
    assert len(_join(spark, hosts, ranges)) == 3
    assert _join(spark, hosts, ranges, mode="two_octet") == [("20.0.1.1", "W")]


def test_duplicate_ranges_collapse(spark):
    assert _join(spark, ["5.5.5.5"], [("A", "5.5.0.0-5.5.255.255"), ("A", "5.5.0.0-5.5.255.255")]) == \
        [("5.5.5.5", "A")]


def test_range_join_equals_brute_force(spark):
    import random
    rnd = random.Random(7)
    ranges = []
    for i in range(40):
        lo = rnd.randrange(0, 2**32 - 2**20)
        hi = lo + rnd.randrange(0, 2**20)
        ranges.append((f"c{i}", lo, hi))
    hosts = [rnd.randrange(0, 2**32) for _ in range(300)] + [r[1] for r in ranges] + [r[2] for r in ranges]

    def txt(n):
        return ".".join(str((n >> s) & 255) for s in (24, 16, 8, 0))
    expect = sorted((txt(h), c) for h in hosts for c, lo, hi in ranges if lo <= h <= hi)
    got = _join(spark, [txt(h) for h in hosts], [(c, f"{txt(lo)}-{txt(hi)}") for c, lo, hi in ranges])
    assert got == expect


def test_range_join_plan_is_equi_join(spark):
    logs = spark.createDataFrame([("1.2.3.4",)], "host string")
    rg = spark.createDataFrame([("A", "1.2.0.0-1.2.255.255")], "country string, iprange string")
    plan = ip_range_join(logs, rg)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    assert "HashJoin" in plan or "SortMergeJoin" in plan
