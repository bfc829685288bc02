"""Property tests: the native IPv4 parser against the standard library."""

import ipaddress

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from weblake.functions.ip import ip_to_long, long_to_ip


def _reference(text):
    try:
        addr = ipaddress.ip_address(text)
    except ValueError:
        return None
    return int(addr) if addr.version == 4 else None


octet_text = st.one_of(st.integers(0, 300).map(str), st.sampled_from(["", "00", "01", "007", "+1", " 1", "a", "-1"]))
quads = st.lists(octet_text, min_size=3, max_size=5).map(".".join)
texts = st.one_of(quads, st.text(max_size=12), st.sampled_from(["::1", "fe80::1", "1.2.3.4", "255.255.255.255"]))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(texts, min_size=50, max_size=200))
def test_ip_to_long_matches_ipaddress(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "h string")
    got = [r.v for r in df.select(ip_to_long("h").alias("v")).collect()]
    assert got == [_reference(v) for v in values]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 2**32 - 1), min_size=50, max_size=200))
def test_long_to_ip_matches_ipaddress(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "n bigint")
    got = [r.t for r in df.select(long_to_ip("n").alias("t")).collect()]
    assert got == [str(ipaddress.IPv4Address(v)) for v in values]


def _merge_model(target, source):
    """MERGE semantics in plain Python: (rows, error?)."""
    from collections import Counter
    skeys = Counter(k for k, _ in source if k is not None)
    tkeys = {k for k, _ in target if k is not None}
    if any(skeys[k] > 1 for k in tkeys):
        return None
    by_key = {k: v for k, v in source if k is not None}
    out = [(k, by_key[k]) if k is not None and k in by_key else (k, v) for k, v in target]
    out += [(k, v) for k, v in source if k is None or k not in tkeys]
    return sorted(out, key=lambda r: (r[0] is None, r[0] or 0, r[1]))


rows = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 6)), st.sampled_from("abcd")), max_size=12)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows, rows)
def test_upsert_matches_model(spark, target, source):
    from weblake.operators.upsert import upsert
    t = spark.createDataFrame(target, "k int, v string")
    s = spark.createDataFrame(source, "k int, v string")
    expect = _merge_model(target, source)
    if expect is None:
        import pytest
        with pytest.raises(Exception):
            upsert(t, s, ["k"]).collect()
    else:
        got = sorted((tuple(r) for r in upsert(t, s, ["k"]).collect()),
                     key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        assert got == expect


def _conditional_model(target, source):
    """MERGE ON target.k = source.k AND source.v > target.v in plain Python; None for a multi-match."""
    out, used = [], set()
    for k, v in target:
        hits = [i for i, (sk, sv) in enumerate(source) if k is not None and sk == k and sv > v]
        if len(hits) > 1:
            return None
        used.update(hits)
        out.append(source[hits[0]] if hits else (k, v))
    out += [r for i, r in enumerate(source) if i not in used]
    return sorted(out, key=lambda r: (r[0] is None, r[0] or 0, r[1]))


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows, rows)
def test_upsert_on_a_condition_matches_model(spark, target, source):
    import pytest
    from pyspark.sql import functions as F
    from weblake.operators.upsert import upsert
    t, s = spark.createDataFrame(target, "k int, v string"), spark.createDataFrame(source, "k int, v string")
    expect = _conditional_model(target, source)
    for on in ("source.v > target.v and target.k = source.k", (F.col("target.k") == F.col("source.k")) & (F.col("source.v") > F.col("target.v"))):
        if expect is None:
            with pytest.raises(Exception, match="more than one source row"):
                upsert(t, s, on).collect()
        else:
            assert sorted((tuple(r) for r in upsert(t, s, on).collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1])) == expect
