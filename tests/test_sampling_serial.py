"""Serial keys, seeded sampling and the catalog build."""

import math
import os
import statistics

from pyspark.sql import functions as F

from weblake import registry as R
from weblake.operators.sampling import permuted, pick_one_per_key, rank_by_hash, sample_per_group, seeded_draw
from weblake.operators.serial import serial_keys
from weblake.plans import catalog as C

from .conftest import SF_SMALL


def test_serial_keys_dense_and_ordered(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5003).alias("v")).repartition(7)
    rows = serial_keys(df, ["v"], name="s", start=1).collect()
    got = sorted((r.s, r.v) for r in rows)
    assert [s for s, _ in got] == list(range(1, 5001))
    assert [v for _, v in got] == sorted(v for _, v in got)


def test_serial_keys_scan_order(spark):
    df = spark.createDataFrame([(c,) for c in "abcdef"], "c string").coalesce(1)
    assert [r.c for r in serial_keys(df, [], name="n").orderBy("n").collect()] == list("abcdef")


def test_rank_by_hash_is_a_permutation_and_repeatable(spark):
    items = spark.range(0, 3000).withColumnRenamed("id", "item")
    a = {r.item: r.p for r in rank_by_hash(items, "item", 1, "x", name="p").collect()}
    b = {r.item: r.p for r in rank_by_hash(items.repartition(5), "item", 1, "x", name="p").collect()}
    assert sorted(a.values()) == list(range(3000)) and a == b


def test_sample_per_group_exact_k_distinct(spark):
    items = spark.range(1, 501).withColumnRenamed("id", "item")
    groups = spark.createDataFrame([(1, 3), (2, 500), (3, 900), (4, 0), (5, 10000)], "g bigint, k bigint")
    out = sample_per_group(groups, "g", "k", items, "item", 9, "t", chunk=64).collect()
    per = {}
    for r in out:
        per.setdefault(r.g, []).append(r.item)
    assert {g: len(v) for g, v in per.items()} == {1: 3, 2: 500, 3: 500, 5: 500}
    assert all(len(set(v)) == len(v) for v in per.values())
    again = sample_per_group(groups, "g", "k", items.repartition(3), "item", 9, "t", chunk=7).collect()
    assert sorted((r.g, r.item) for r in again) == sorted((r.g, r.item) for r in out)


def test_pick_one_per_key_brute_force(spark):
    opts = spark.createDataFrame([(p, s) for p in range(1, 30) for s in range(1, p % 6 + 2)], "p bigint, s bigint")
    choices = spark.createDataFrame([(c, p) for c in range(1, 6) for p in range(1, 35)], "c bigint, p bigint")
    got = {(r.c, r.p): r.s for r in pick_one_per_key(choices, ["c", "p"], opts, "p", "s", 5, "o").collect()}
    # brute force: options of p ordered by md5 text, position = draw mod count
    ranked = {r.p: r.s_sorted for r in opts.groupBy("p").agg(
        F.transform(F.array_sort(F.collect_list(F.struct(F.md5(F.concat_ws(":", F.lit("5"), F.lit("o"), "p", "s")).alias("h"), "s"))),
                    lambda x: x["s"]).alias("s_sorted")).collect()}
    draws = {(r.c, r.p): r.d for r in choices.select("c", "p", seeded_draw(5, F.lit("o-pick"), "c", "p").alias("d")).collect()}
    expect = {k: ranked[k[1]][d % len(ranked[k[1]])] for k, d in draws.items() if k[1] in ranked}
    assert got == expect


def test_positions_and_picks_are_hashed_once(spark):
    """No filter on a join's position repeats the hashes it is made of, and values equal the permutation's."""
    items = spark.range(90).withColumnRenamed("id", "item")
    groups = spark.createDataFrame([(g, 40) for g in range(6)], "g bigint, k bigint")
    sampled = sample_per_group(groups, "g", "k", items, "item", 9, "t")
    opts = spark.createDataFrame([(p, s) for p in range(90) for s in range(p % 4)], "p bigint, s bigint")
    picked = pick_one_per_key(sampled.withColumnRenamed("item", "p"), ["g", "p"], opts, "p", "s", 5, "o")
    for df in (sampled, picked):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "md5(" in plan
        assert not [line for line in plan.splitlines() if "Filter" in line and "md5(" in line]
    ranked = {r.p: r.item for r in rank_by_hash(items, "item", 9, "t", name="p").collect()}
    draws = groups.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(39)))).withColumn("n", F.lit(90))
    want = {(r.g, ranked[r.p]) for r in permuted(draws, "i", "n", 9, F.lit("t-walk"), "g", name="p").collect()}
    assert {(r.g, r.item) for r in sampled.collect()} == want and len(want) == 240
    assert {(r.g, r.p) for r in picked.collect()} == {(g, p) for g, p in want if p % 4}


def test_price_lists_read_line_items_once(spark):
    products, suppliers, companies = R._catalog_inputs(R.Fixture(spark, SF_SMALL))
    assert not [f for df in (suppliers, companies) for f in df.inputFiles() if "lineitem" in f]
    assert 0 < suppliers.count() < companies.count() == companies.select("CompanyId").distinct().count()


def test_catalog_build_properties(spark):
    products = spark.createDataFrame([(p, float(p)) for p in range(1, 41)], "ProductId bigint, DefaultPrice double")
    companies = spark.createDataFrame([(c, c <= 4, 7 * c, c) for c in range(1, 11)], "CompanyId bigint, IsSupplier boolean, k bigint, Increment bigint")
    existing = spark.createDataFrame([(1, 1, 5, None, 123.0)],
                                     "CatalogId bigint, ProductId bigint, CompanyId bigint, SupplierId bigint, Price double")
    out = C.catalog_build(existing, products, companies, 3).collect()
    keys = [(r.CompanyId, r.ProductId) for r in out]
    assert len(keys) == len(set(keys))
    assert sorted(r.CatalogId for r in out) == list(range(1, len(out) + 1))
    assert [r.Price for r in out if (r.CompanyId, r.ProductId) == (5, 1)] == [123.0]  # existing row wins
    sup = {(r.ProductId, r.CompanyId): r.Price for r in out if r.CompanyId <= 4}
    assert len(sup) == 7 + 14 + 21 + 28   # the output grows with the sum of the sizes
    for r in out:
        if r.CompanyId > 4 and r.CatalogId != 1:
            assert (r.ProductId, r.SupplierId) in sup and r.Price - sup[(r.ProductId, r.SupplierId)] == r.CompanyId
        if r.CompanyId <= 4:
            assert r.SupplierId is None and r.Price - r.ProductId == r.CompanyId


def test_positional_join_zips_to_shorter(spark):
    from weblake.operators.serial import positional_join
    a = spark.createDataFrame([(i, f"a{i}") for i in range(10)], "ia int, va string")
    b = spark.createDataFrame([(i, f"b{i}") for i in range(7)], "ib int, vb string")
    got = sorted((r.va, r.vb) for r in positional_join(a, b, ["ia"], [F.desc("ib")]).collect())
    assert got == sorted((f"a{i}", f"b{6 - i}") for i in range(7))


def test_samples_of_groups_are_independent(spark):
    """Overlaps of any two groups' samples have the mean and the spread of independent draws (hypergeometric)."""
    n, k, g = 600, 60, 90
    items = spark.range(n).withColumnRenamed("id", "item")
    groups = spark.createDataFrame([(i, k) for i in range(g)], "g bigint, k bigint")
    picked = {}
    for r in sample_per_group(groups, "g", "k", items, "item", 4, "w").collect():
        picked.setdefault(r.g, set()).add(r.item)
    assert all(len(v) == k for v in picked.values())
    overlaps = [len(picked[a] & picked[b]) for a in picked for b in picked if a < b]
    mean, variance = k * k / n, k * k / n * (1 - k / n) * (n - k) / (n - 1)
    assert abs(statistics.mean(overlaps) - mean) < 4 * math.sqrt(variance / len(overlaps))
    assert 0.85 * variance < statistics.variance(overlaps) < 1.15 * variance
    chosen = [sum(i in v for v in picked.values()) for i in range(n)]   # every item about as often
    expect = g * k / n * (1 - k / n)
    assert 0.8 * expect < statistics.variance(chosen) < 1.25 * expect


def test_permutation_is_one_to_one_for_every_size(spark):
    for n in (1, 2, 3, 5, 16, 17, 1000, 4099):
        df = spark.range(n).withColumn("n", F.lit(n))
        rows = permuted(permuted(df, "id", "n", 7, F.lit(1), name="p1"), "id", "n", 7, F.lit(2), name="p2").collect()
        assert sorted(r.p1 for r in rows) == sorted(r.p2 for r in rows) == list(range(n))
        assert n < 16 or [r.p1 for r in rows] != [r.p2 for r in rows]


def test_permutation_of_more_than_two_to_the_thirtieth(spark):
    for n in ((1 << 33) + 7, (1 << 52) - 5):
        got = [r.p for r in permuted(spark.range(20_000).withColumn("n", F.lit(n)), "id", "n", 7, F.lit("g"), name="p").collect()]
        assert len(set(got)) == len(got) and 0 <= min(got) and max(got) < n
        assert abs(statistics.mean(got) / n - 0.5) < 0.01   # spread over the whole range


def test_serial_keys_in_file_order(spark, tmp_path):
    """A small first file and larger later ones, cut into several splits: Spark deals the larger splits first."""
    from weblake.sources.files import read_domain_csv
    files = {"a.csv": ["first"], "b.csv": [f"b{i}" for i in range(3000)], "c.csv": [], "d.csv": [f"d{i}" for i in range(700)], "e.csv": ["last"]}
    for name, lines in files.items():
        with open(os.path.join(tmp_path, name), "w") as fh:
            fh.write("".join(f"{x}, TRUE\n" for x in lines))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for size in ("4096", old):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            rows = read_domain_csv(spark, str(tmp_path), "name string, flag boolean", key="Id").orderBy("Id").collect()
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        assert [(r.Id, r.name) for r in rows] == list(enumerate((x for lines in files.values() for x in lines), start=1))
    by_name = read_domain_csv(spark, str(tmp_path), "name string, flag boolean", key="Id", order_by=["name"]).orderBy("Id").collect()
    assert [r.name for r in by_name] == sorted(x for lines in files.values() for x in lines)
