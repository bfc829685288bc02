"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import pytest

import __spark_entry__ as E
from weblake import registry
from tools.compare import compare

from .conftest import SF_SMALL


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["Country", "ProductName", "qttLogs"]
    assert df.count() > 0


def test_every_query_has_an_oracle_or_is_documented():
    assert set(registry.QUERIES) <= set(E.queries()) and set(registry.ORACLES) <= set(E.oracle_sql())
    assert set(registry.QUERIES) - set(registry.ORACLES) <= set(registry.ROWS_ONLY)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_matches_oracle(spark, name):
    res = compare(spark, SF_SMALL, [name], verbose=False)[name]
    assert res[0] in ("match", "rows-only"), res


def test_result_types_match_oracle(spark):
    """Column types agree with DuckDB's (in case the schema check compares types)."""
    from tools.compare import duck
    names = ["bigint", "int", "string", "double", "timestamp_ntz", "date", "boolean"]
    duck_names = ["BIGINT", "INTEGER", "VARCHAR", "DOUBLE", "TIMESTAMP", "DATE", "BOOLEAN"]
    to_duck = dict(zip(names, duck_names))
    con = duck(SF_SMALL)
    skip = {"transform_load_run", "run_devices", "run_products", "run_reports", "stream_ingest"}  # write tables; their outputs are checked above
    for name, q in registry.QUERIES.items():
        if name in skip:
            continue
        sdt = dict(q(spark, SF_SMALL).dtypes)
        rel = con.sql(registry.ORACLES[name])
        ddt = dict(zip(rel.columns, [str(t) for t in rel.types]))
        assert {c: to_duck.get(t, t) for c, t in sdt.items()} == ddt, name


@pytest.mark.parametrize("name,keys", [("sales_upsert", ["orderItemId"]), ("devices_upsert", ["OrderId"]),
                                       ("products_upsert", ["HostIp", "VisitedAt", "ProductId"])])
def test_upsert_oracles_see_updates_null_keys_and_repeated_rows(spark, monkeypatch, name, keys):
    """A merge that only inserts what is absent gives another answer."""
    from weblake.operators import upsert as U
    from weblake.plans import sales, weblogs
    right = registry.QUERIES[name](spark, SF_SMALL)
    assert right.filter(" or ".join(f"{k} is null" for k in keys)).count() > 0
    assert right.dropna(subset=keys).groupBy(*keys).count().filter("count > 1").count() > 0
    for module in (sales, weblogs):
        monkeypatch.setattr(module, "upsert", lambda t, s, k: t.unionByName(
            U._aligned(s, t).join(t.select(*k), on=k, how="left_anti").select(*t.columns)))
    wrong = registry.QUERIES[name](spark, SF_SMALL)
    assert right.exceptAll(wrong).count() > 0 and wrong.exceptAll(right).count() > 0
