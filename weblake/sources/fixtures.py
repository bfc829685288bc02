"""The driver's parquet tables presented as the order database and the landing logs.

Each method returns a lazily planned DataFrame with the column names of the
source system (see FIXTURES.md, section 3). Only the columns a view needs are
read, so parquet column pruning and filter pushdown reach the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.sampling import seeded_draw

# fixed values: user agents assigned to synthetic log rows by event id
FIXTURE_USER_AGENTS = [
    "curl/7.81",
    "Mozilla/5.0 (Windows NT 10.0; Win64; x64) Gecko",
    "Mozilla/5.0 (X11; Linux x86_64) Gecko",
    "Mozilla/5.0 (iPhone; CPU iPhone OS 15_0) Safari (x)",
    "Mozilla/5.0 (Macintosh; Intel Mac OS X 12_1) Safari",
    "Mozilla/5.0 (Linux; Android 12; Pixel 6) Chrome",
    "Mozilla/5.0 (compatible) Bot",
]
# fixed value: site root of the synthetic referers
FIXTURE_SITE = "http://shop.example.com"


def _user_agent(number):
    """One of the user agents, by a row's number."""
    return F.element_at(F.array(*[F.lit(u) for u in FIXTURE_USER_AGENTS]), (number % len(FIXTURE_USER_AGENTS) + 1).cast("int"))


class Fixture:
    """Source tables derived from the driver parquet files in ``sf_dir``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        """The scan of one driver table."""
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    # --- domain tables ---
    def customers(self) -> DataFrame:
        return self.table("customer").select(F.col("c_custkey").alias("CustomerId"),
                                             F.col("c_name").alias("CustomerName"))

    def products(self) -> DataFrame:
        return self.table("part").select(F.col("p_partkey").alias("ProductId"),
                                         F.col("p_name").alias("ProductName"))

    def companies(self) -> DataFrame:
        return self.table("supplier").select(F.col("s_suppkey").alias("CompanyId"),
                                             F.col("s_name").alias("CompanyName"),
                                             (F.col("s_suppkey") % 2 == 0).alias("IsSupplier"))

    def catalog(self) -> DataFrame:
        k = F.col("p_partkey")
        return self.table("part").select(
            k.alias("CatalogId"), k.alias("ProductId"), (k % 10).alias("CompanyId"),
            F.when(k % 2 == 1, (k % 5) * 2).alias("SupplierId"),
            F.col("p_retailprice").alias("Price"))

    def offered_parts(self) -> DataFrame:
        """How many different parts each company has delivered: the size of its price list."""
        return (self.table("lineitem").select("l_suppkey", "l_partkey").distinct()
                .groupBy(F.col("l_suppkey").alias("CompanyId")).agg(F.count(F.lit(1)).alias("k")))

    def price_list_companies(self, seed) -> DataFrame:
        """Companies with the size and the price increment (drawn by seed: 1 to 9 for suppliers, 1 to 29
        for others) of their price lists."""
        def drawn(salt: str, top: int):
            return F.pmod(seeded_draw(seed, F.lit(salt), "CompanyId"), F.lit(top)) + 1
        return (self.companies().join(self.offered_parts(), "CompanyId", "left").fillna({"k": 0})
                .withColumn("Increment", F.when(F.col("IsSupplier"), drawn("supplier-inc", 9)).otherwise(drawn("company-inc", 29))))

    def product_prices(self) -> DataFrame:
        """Products with their list price (the default price of the catalog build)."""
        return self.table("part").select(F.col("p_partkey").alias("ProductId"),
                                         F.col("p_retailprice").alias("DefaultPrice"))

    # --- event tables ---
    def orders(self) -> DataFrame:
        return self.table("orders").select(F.col("o_orderkey").alias("OrderId"),
                                           F.col("o_custkey").alias("CustomerId"),
                                           F.col("o_orderdate").alias("OrderDate"))

    def orderitems(self) -> DataFrame:
        """One row per (order, line): the line number is folded into the item id.

        The driver data repeats (l_orderkey, l_linenumber); the grouping makes the
        item id unique, with partial aggregation before its shuffle.
        """
        li = self.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
        return (li
                .groupBy("l_orderkey", "l_linenumber")
                .agg(F.min("l_partkey").alias("CatalogId"))
                .select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("OrderItemId"),
                        F.col("l_orderkey").alias("OrderId"), "CatalogId"))

    def order_context(self) -> DataFrame:
        """Orders with the customer's name, an address inside the customer's
        nation range and a user agent: the inputs of the order log export."""
        c = self.table("customer").select("c_custkey", "c_name", "c_nationkey")
        o = self.orders()
        n, oid = F.col("c_nationkey"), F.col("OrderId")
        host = F.concat((n * 9 + 10).cast("string"), F.lit("."), (n % 4).cast("string"), F.lit("."),
                        (oid % 200).cast("string"), F.lit("."), (F.col("CustomerId") % 256).cast("string"))
        ua = _user_agent(oid)
        return (o.join(c, o.CustomerId == c.c_custkey, "inner")
                .select("OrderId", "OrderDate", F.col("c_name").alias("CustomerName"), host.alias("HostIp"),
                        ua.alias("UserAgent")))

    def ipsrangelist(self) -> DataFrame:
        n = F.col("n_nationkey")
        first = (n * 9 + 10).cast("string")
        wide = n % 5 == 0
        return self.table("nation").select(
            F.col("n_name").alias("country"),
            F.concat(first, F.lit("."), (n % 4).cast("string"), F.lit(".0.0-"), first, F.lit("."),
                     F.when(wide, n % 4 + 2).otherwise(n % 4).cast("string"),
                     F.when(wide, F.lit(".255.255")).otherwise(F.lit(".199.255"))).alias("iprange"))

    def nested_ranges(self) -> DataFrame:
        """:meth:`ipsrangelist` with a wider range around and a narrow one inside each nation's."""
        n, name = F.col("n_nationkey"), F.col("n_name")
        nation = self.table("nation")
        middle = (n * 9 + 10).cast("string")
        wide = F.concat((n * 9 + 8).cast("string"), F.lit(".0.0.0-"), (n * 9 + 12).cast("string"), F.lit(".255.255.255"))
        head = F.concat(middle, F.lit("."), (n % 4).cast("string"))
        narrow = F.concat(head, F.lit(".7.0-"), head, F.lit(".9.99"))
        return (self.ipsrangelist()
                .unionByName(nation.select(F.concat(name, F.lit(" and around")).alias("country"), wide.alias("iprange")))
                .unionByName(nation.select(F.concat(name, F.lit(" narrow")).alias("country"), narrow.alias("iprange"))))

    def landing_weblogs(self) -> DataFrame:
        """:meth:`weblogs` with the landing folder columns (event year and month)."""
        d = F.col("date").try_cast("date")
        return self.weblogs().drop("event_id").withColumns({"year": F.year(d), "month": F.month(d)})

    def weblogs(self) -> DataFrame:
        """Parsed access-log rows (the columns of the landing log schema)."""
        e = self.table("events").select("event_id", "ts", "user_id", "event_type")
        eid, uid, ts, et = F.col("event_id"), F.col("user_id"), F.col("ts"), F.col("event_type")

        def pad2(c):
            return F.lpad(c.cast("string"), 2, "0")

        host = F.concat((uid % 25 * 9 + 10).cast("string"), F.lit("."),
                        (uid % 25 % 4 + F.when(eid % 3 == 0, 1).otherwise(0)).cast("string"), F.lit("."),
                        (eid % 256).cast("string"), F.lit("."), (uid % 256).cast("string"))
        ua = _user_agent(eid)
        referer = (F.when(et == "purchase", F.concat(F.lit(FIXTURE_SITE + "/orders/"), eid.cast("string")))
                   .when(et.isin("view", "click"),
                         F.concat(F.lit(FIXTURE_SITE + "/products/"), (eid % 200).cast("string")))
                   .when(et == "signup", F.lit(FIXTURE_SITE + "/account/new"))
                   .otherwise(F.lit(FIXTURE_SITE)))
        return e.select(
            eid.alias("event_id"),
            host.alias("host"),
            F.lit("-").alias("ident"),
            F.when(et == "error", F.lit("unknown"))
             .otherwise(F.concat(F.lit("customer#"), F.lpad(uid.cast("string"), 9, "0"))).alias("username"),
            ts.cast("date").cast("string").alias("date"),
            F.concat(pad2(F.hour(ts)), F.lit(":"), pad2(F.minute(ts)), F.lit(":"),
                     pad2(F.floor(F.second(ts)).cast("int"))).alias("time"),
            F.lit("-").alias("request"),
            F.lit("200").alias("status"),
            F.lit("-").alias("size"),
            referer.alias("referer"),
            ua.alias("useragent"))
