"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Every statement starts from the driver tables; the source views of FIXTURES.md
are inlined as common table expressions.
"""

from __future__ import annotations

# the oracles' own patterns: a dotted quad of numbers up to 255, and the text in the first brackets
OCTET = "(0|[1-9][0-9]?|1[0-9][0-9]|2[0-4][0-9]|25[0-5])"
DOTTED_QUAD = "[.]".join([OCTET] * 4)
FIRST_BRACKETS = "[(]([^)]*)[)]"

FIXTURE_VIEWS = {
    "src_customers": "select c_custkey as CustomerId, c_name as CustomerName from customer",
    "src_products": "select p_partkey as ProductId, p_name as ProductName from part",
    "src_companies": "select s_suppkey as CompanyId, s_name as CompanyName, s_suppkey % 2 = 0 as IsSupplier from supplier",
    "src_catalog": "select p_partkey as CatalogId, p_partkey as ProductId, p_partkey % 10 as CompanyId, case when p_partkey % 2 = 1 then (p_partkey % 5) * 2 end as SupplierId, p_retailprice as Price from part",
    "src_orders": "select o_orderkey as OrderId, o_custkey as CustomerId, o_orderdate as OrderDate from orders",
    "src_orderitems": "select l_orderkey * 10 + l_linenumber as OrderItemId, l_orderkey as OrderId, min(l_partkey) as CatalogId from lineitem group by l_orderkey, l_linenumber",
    "src_ipsrangelist": "select n_name as country, concat(cast(n_nationkey * 9 + 10 as string), '.', cast(n_nationkey % 4 as string), '.0.0-', cast(n_nationkey * 9 + 10 as string), '.', cast(case when n_nationkey % 5 = 0 then n_nationkey % 4 + 2 else n_nationkey % 4 end as string), case when n_nationkey % 5 = 0 then '.255.255' else '.199.255' end) as iprange from nation",
    "src_weblogs": "select event_id, concat(cast((user_id % 25) * 9 + 10 as string), '.', cast((user_id % 25) % 4 + case when event_id % 3 = 0 then 1 else 0 end as string), '.', cast(event_id % 256 as string), '.', cast(user_id % 256 as string)) as host, '-' as ident, case when event_type = 'error' then 'unknown' else concat('customer#', lpad(cast(user_id as string), 9, '0')) end as username, cast(cast(ts as date) as string) as date, concat(lpad(cast(hour(ts) as string), 2, '0'), ':', lpad(cast(minute(ts) as string), 2, '0'), ':', lpad(cast(cast(floor(second(ts)) as int) as string), 2, '0')) as time, '-' as request, '200' as status, '-' as size, case when event_type = 'purchase' then concat('http://shop.example.com/orders/', cast(event_id as string)) when event_type in ('view', 'click') then concat('http://shop.example.com/products/', cast(event_id % 200 as string)) when event_type = 'signup' then 'http://shop.example.com/account/new' else 'http://shop.example.com' end as referer, ['curl/7.81', 'Mozilla/5.0 (Windows NT 10.0; Win64; x64) Gecko', 'Mozilla/5.0 (X11; Linux x86_64) Gecko', 'Mozilla/5.0 (iPhone; CPU iPhone OS 15_0) Safari (x)', 'Mozilla/5.0 (Macintosh; Intel Mac OS X 12_1) Safari', 'Mozilla/5.0 (Linux; Android 12; Pixel 6) Chrome', 'Mozilla/5.0 (compatible) Bot'][event_id % 7 + 1] as useragent from events",
}


def ip_sql(x: str) -> str:
    parts = " + ".join(f"cast(split_part({x}, '.', {i + 1}) as bigint) * {256 ** (3 - i)}" for i in range(4))
    return f"(case when regexp_full_match({x}, '{DOTTED_QUAD}') then {parts} end)"


def range_start_sql(r: str) -> str:
    return f"trim(split_part({r}, '-', 1))"


def range_end_sql(r: str) -> str:
    return f"trim(case when strpos({r}, '-') > 0 then split_part({r}, '-', 2) else {r} end)"


def with_views(ctes: list[tuple[str, str]], body: str) -> str:
    """``WITH`` the fixture views used by ``body`` (in dependency order) plus ``ctes``."""
    names = [n for n in FIXTURE_VIEWS if n in body or any(n in c for _, c in ctes)]
    parts = [f"{n} as ({FIXTURE_VIEWS[n]})" for n in names] + [f"{n} as ({q})" for n, q in ctes]
    recursive = "recursive " if any("_walk(" in n for n, _ in ctes) else ""
    return (f"with {recursive}" + ",\n".join(parts) + "\n" + body) if parts else body


# --- reusable query texts (referencing fixture views or earlier CTEs) ---

def sales_sql(orders: str = "src_orders", join: str = "left", items_filter: str = "") -> str:
    return f"""select cast(i.OrderItemId as bigint) as orderItemId, cast(i.OrderId as bigint) as orderId,
  c.Price as price, o.OrderDate as orderDate,
  strftime(o.OrderDate, '%Y') as year_partition, strftime(o.OrderDate, '%m') as month_partition
from src_orderitems i {join} join {orders} o on i.OrderId = o.OrderId
left join src_catalog c on i.CatalogId = c.CatalogId {items_filter}"""


PARSED_LOGS = f"""select host as HostIp, username as Username,
  try_strptime(date || ' ' || time, '%Y-%m-%d %H:%M:%S') as VisitedAt,
  case string_split(referer, '/')[4] when 'products' then 'product' when 'orders' then 'order' end as PageType,
  string_split(referer, '/')[5] as Id,
  '[' || replace(regexp_extract(useragent, '{FIRST_BRACKETS}', 1), ';', ', ') || ']' as Device,
  strftime(try_cast(date as date), '%Y') as year_partition,
  strftime(try_cast(date as date), '%m') as month_partition,
  {ip_sql('host')} as ip
from LOGS"""

RANGE_BOUNDS = f"""select country, {ip_sql(range_start_sql('iprange'))} as lo, {ip_sql(range_end_sql('iprange'))} as hi
from (select distinct country, iprange from src_ipsrangelist)"""

ENRICHED_BODY = """select p.HostIp, b.country as Country, p.Username, p.VisitedAt, p.PageType, p.Id, p.Device,
  p.year_partition, p.month_partition
from PARSED p join bounds b on p.ip between b.lo and b.hi"""


def enriched_ctes(name: str = "enriched", logs: str = "src_weblogs") -> list[tuple[str, str]]:
    """CTEs ``<name>_parsed`` and ``<name>`` for logs ``logs``; needs a ``bounds`` CTE."""
    return [(f"{name}_parsed", PARSED_LOGS.replace("LOGS", logs)),
            (name, ENRICHED_BODY.replace("PARSED", f"{name}_parsed"))]


def order_devices_sql(enriched: str) -> str:
    return f"""select Username, VisitedAt, try_cast(Id as bigint) as OrderId, Device
from {enriched} where PageType = 'order'"""


def product_visits_sql(enriched: str) -> str:
    return f"""select distinct e.HostIp, e.Country, e.VisitedAt, p.ProductId, p.ProductName
from {enriched} e join src_products p on try_cast(e.Id as bigint) = p.ProductId
where e.PageType = 'product'"""


def upsert_sql(tgt: str, src: str, keys: list[str]) -> str:
    on = " and ".join(f"t.{k} = s.{k}" for k in keys)
    t_ok = " and ".join(f"t.{k} is not null" for k in keys)
    s_ok = " and ".join(f"s.{k} is not null" for k in keys)
    any_null_t = " or ".join(f"{k} is null" for k in keys)
    return f"""select s.* from {tgt} t join {src} s on {on}
union all select t.* from {tgt} t where {t_ok} and not exists (select 1 from {src} s where {on})
union all select s.* from {src} s where {s_ok} and not exists (select 1 from {tgt} t where {on})
union all select * from {tgt} where {any_null_t}
union all select * from {src} where {any_null_t}"""


def draw_sql(*parts: str) -> str:
    """DuckDB twin of ``seeded_draw``: parts are SQL expressions rendered as text."""
    return f"cast('0x' || substr(md5(concat_ws(':', {', '.join(f'cast({p} as varchar)' for p in parts)})), 1, 8) as bigint)"


def hash_sql(*parts: str) -> str:
    return f"md5(concat_ws(':', {', '.join(f'cast({p} as varchar)' for p in parts)}))"


def _sized_sql(groups: str, salt: str, seed: str, n: str, inc: int) -> str:
    """Groups with their price increment, sample size and the sides of their permutation's grid."""
    return f"""select *, (n + a - 1) // a as b from (select CompanyId, least(k, n) as k, {draw_sql(seed, repr(salt + '-inc'), 'CompanyId')} % {inc} + 1 as inc,
             n, cast(ceil(sqrt(n)) as bigint) as a from ({groups}) g, {n}) where n > 0"""


def _permute_sql(source: str, salt: str, seed: str) -> str:
    """One pass of every group's permutation over column v."""
    sql = f"select *, v // b as l, v % b as r from ({source})"
    for k in range(4):
        own, other, m = ("l", "r", "a") if k % 2 == 0 else ("r", "l", "b")
        drawn = draw_sql(seed, repr(f"{salt}-walk"), "CompanyId", repr(f"round-{k}"), other).replace("1, 8)", "1, 15)")
        sql = f"select * replace (({own} + {drawn}) % {m} as {own}) from ({sql})"
    return f"select CompanyId, inc, n, a, b, l * b + r as v from ({sql})"


def _positions(name: str, groups: str, salt: str, seed: str) -> tuple[str, str]:
    """The recursive CTE that walks all positions until they fall below n."""
    start = f"select CompanyId, inc, n, a, b, unnest(range(k)) as v from {groups}"
    return (f"{name}(CompanyId, inc, n, a, b, v)", f"{_permute_sql(start, salt, seed)} union all {_permute_sql(f'select * from {name} where v >= n', salt, seed)}")


def catalog_ctes(seed: int) -> list[tuple[str, str]]:
    sd = f"'{seed}'"
    sized = """select CompanyId, coalesce(k, 0) as k from src_companies
               left join (select l_suppkey as CompanyId, count(distinct l_partkey) as k from lineitem group by 1) using (CompanyId) where {}"""
    return [
        ("prod", "select p_partkey as ProductId, p_retailprice as DefaultPrice from part"),
        ("prod_n", "select count(*) as n from prod"),
        ("prod_ranked", f"select ProductId, DefaultPrice, row_number() over (order by {hash_sql(sd, repr('supplier'), 'ProductId')}) - 1 as pos from prod"),
        ("sup", _sized_sql(sized.format("IsSupplier"), "supplier", sd, "prod_n", 9)),
        _positions("sup_walk", "sup", "supplier", sd), ("sup_idx", "select CompanyId, inc, v as pos from sup_walk where v < n"),
        ("sup_rows", """select p.ProductId, s.CompanyId, cast(null as bigint) as SupplierId, p.DefaultPrice + s.inc as Price
           from sup_idx s join prod_ranked p on s.pos = p.pos"""),
        ("offered", "select distinct ProductId from sup_rows"),
        ("offered_n", "select count(*) as n from offered"),
        ("offered_ranked", f"select ProductId, row_number() over (order by {hash_sql(sd, repr('company'), 'ProductId')}) - 1 as pos from offered"),
        ("com", _sized_sql(sized.format("not IsSupplier"), "company", sd, "offered_n", 29)),
        _positions("com_walk", "com", "company", sd), ("com_idx", "select CompanyId, inc, v as pos from com_walk where v < n"),
        ("com_pick", "select c.CompanyId, c.inc, o.ProductId from com_idx c join offered_ranked o on c.pos = o.pos"),
        ("opts", f"""select ProductId, CompanyId as SupplierId, Price as sp,
             row_number() over (partition by ProductId order by {hash_sql(sd, repr('offer'), 'ProductId', 'CompanyId')}) - 1 as opt,
             count(*) over (partition by ProductId) as m from sup_rows"""),
        ("com_rows", f"""select p.ProductId, p.CompanyId, o.SupplierId, o.sp + p.inc as Price
           from com_pick p join opts o on o.ProductId = p.ProductId
            and o.opt = {draw_sql(sd, "'offer-pick'", 'p.CompanyId', 'p.ProductId')} % o.m"""),
        ("batch", "select * from sup_rows union all select * from com_rows"),
        ("new_rows", """select b.* from batch b where not exists
           (select 1 from src_catalog c where c.CompanyId = b.CompanyId and c.ProductId = b.ProductId)"""),
        ("catalog_out", """select CatalogId, ProductId, CompanyId, SupplierId, Price from src_catalog
           union all
           select (select coalesce(max(CatalogId), 0) from src_catalog)
                  + row_number() over (order by CompanyId, ProductId) as CatalogId,
                  ProductId, CompanyId, SupplierId, Price from new_rows"""),
    ]
