"""Catalog build: supplier price lists, company price lists, insert-if-absent.

Suppliers each offer a seeded random subset of the products at the product's
default price plus the supplier's increment; companies each sell a seeded
random subset of the *offered* products, buying each from one seeded random
supplier of it, at that supplier's price plus the company's increment. Increment and size
of a list (column ``k``) are given with the company, so the output grows with the
sum of the sizes, not with companies x products. New
(CompanyId, ProductId) pairs are added to the existing catalog -- existing rows
win -- and receive serial CatalogIds after the current maximum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.sampling import pick_one_per_key, sample_per_group
from ..operators.serial import serial_keys
from ..operators.upsert import rows_if_absent
from ..session import stage

CATALOG_COLUMNS = ["CatalogId", "ProductId", "CompanyId", "SupplierId", "Price"]
CATALOG_KEYS = ["CompanyId", "ProductId"]


def supplier_price_list(products: DataFrame, suppliers: DataFrame, seed) -> DataFrame:
    """(ProductId, CompanyId=supplier, SupplierId=null, Price=default+increment).

    ``products``: ProductId, DefaultPrice. ``suppliers``: CompanyId, k
    (the number of products on offer, at most all), Increment.
    """
    s = suppliers.select("CompanyId", F.col("k").alias("__k"), F.col("Increment").alias("__inc"))
    picked = sample_per_group(s, "CompanyId", "__k", products.select("ProductId", "DefaultPrice"),
                              "ProductId", seed, "supplier")
    return picked.select("ProductId", "CompanyId", F.lit(None).cast("bigint").alias("SupplierId"),
                         (F.col("DefaultPrice") + F.col("__inc")).alias("Price"))


def company_price_list(offers: DataFrame, companies: DataFrame, seed) -> DataFrame:
    """(ProductId, CompanyId, SupplierId, Price=supplier price+increment).

    ``offers``: ProductId, CompanyId (the supplier), Price. ``companies``: CompanyId, k, Increment.
    The offers are read three times (products offered, their count, the options
    per product): pass a staged table, not a long lineage.
    """
    offered = stage(offers.select("ProductId").distinct(), "offered")   # read for its size and for its order
    c = companies.select("CompanyId", F.col("k").alias("__k"), F.col("Increment").alias("__inc"))
    picked = sample_per_group(c, "CompanyId", "__k", offered, "ProductId", seed, "company")
    opts = offers.select("ProductId", F.col("CompanyId").alias("SupplierId"), F.col("Price").alias("__sp"))
    chosen = pick_one_per_key(picked, ["CompanyId", "ProductId"], opts, "ProductId", "SupplierId", seed, "offer")
    return chosen.select("ProductId", "CompanyId", "SupplierId", (F.col("__sp") + F.col("__inc")).alias("Price"))


def supplier_offers(catalog: DataFrame, companies: DataFrame) -> DataFrame:
    """Each product's offers: catalog rows of supplier companies (normalised, one row per offer)."""
    sup = companies.filter(F.col("IsSupplier")).select("CompanyId")
    return (catalog.join(sup, on="CompanyId", how="left_semi")
            .select("ProductId", F.col("CompanyId").alias("SupplierId"), "Price"))


def catalog_build(existing: DataFrame, products: DataFrame, companies: DataFrame, seed) -> DataFrame:
    """The catalog after adding both price lists (existing rows win). ``companies``: CompanyId,
    IsSupplier, k, Increment."""
    suppliers = companies.filter(F.col("IsSupplier"))
    buyers = companies.filter(~F.col("IsSupplier"))
    sup_rows = stage(supplier_price_list(products, suppliers, seed), "supplier-price-list")
    com_rows = company_price_list(sup_rows.select("ProductId", "CompanyId", "Price"), buyers, seed)
    batch = sup_rows.unionByName(com_rows)
    current = existing.select(*CATALOG_COLUMNS)
    new_rows = rows_if_absent(current.drop("CatalogId"), batch, CATALOG_KEYS)
    top = current.select(F.coalesce(F.max("CatalogId"), F.lit(0))).scalar()
    numbered = serial_keys(new_rows, CATALOG_KEYS, name="__serial", start=1)
    numbered = numbered.withColumn("CatalogId", F.col("__serial") + top).drop("__serial")
    return current.unionByName(numbered.select(*CATALOG_COLUMNS))
