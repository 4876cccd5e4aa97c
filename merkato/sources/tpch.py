"""The order-entry tables (TPC-H style) loaded into the sales warehouse.

Mapping: lines with their orders are the sales, nations the territories, parts the
products (brand = product line, type = subcategory), discounts the special offers and
customers the customers. Parts of size 40 and above were reclassified on 1998-07-01 and
therefore have two product versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from merkato.functions.ordering import number_within
from merkato.operators import loading
from merkato.session import beside_facts, new_path, store
from merkato.sources.tables import Warehouse

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
]

FIRST_LOAD = "1990-01-01 00:00:00"
RECLASSIFIED = "1998-07-01 00:00:00"
LTV_BOUNDS = (1_500_000, 3_000_000)
LOYALTY_BOUNDS = (600_000, 350_000, 200_000)

LINE_CENTS = (
    "(cast(round(l_extendedprice * 100) as bigint) * (100 - cast(round(l_discount * 100) as bigint)) + 50) div 100"
)


def source(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def money(cents: str):
    return F.expr(f"cast(cast({cents} as decimal(20,0)) * 0.01BD as decimal(18,2))")


def _instant(text: str):
    return F.lit(text).cast("timestamp_ntz")


def order_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Sales lines: one row per line item with its order's customer, date and territory, which are joined per order."""
    nation = source(spark, folder, "customer").select("c_custkey", F.col("c_nationkey").cast("long").alias("territory_id"))
    ordered = source(spark, folder, "orders")
    orders = ordered.select("o_orderkey", "o_custkey", "o_orderdate").join(
        beside_facts(nation), F.col("o_custkey") == F.col("c_custkey"), "left")
    return source(spark, folder, "lineitem").join(
        beside_facts(orders, ordered), F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_orderkey").alias("order_id"), F.col("o_orderdate").alias("order_date"),
        F.col("o_custkey").alias("customer_id"), "territory_id", F.col("l_partkey").alias("product_id"),
        F.expr("cast(round(l_discount * 100) as bigint)").alias("offer_id"),
        money(LINE_CENTS).alias("line_total"), F.col("l_quantity").cast("long").alias("order_qty"),
        "l_linenumber", "l_suppkey", "l_shipdate", "l_extendedprice", "l_tax", "l_returnflag", "l_linestatus",
    )


LINE_ORDER = [
    "order_id", "l_linenumber", "product_id", "l_suppkey", "l_shipdate", "l_extendedprice", "order_qty", "offer_id",
    "l_tax", "l_returnflag", "l_linestatus",
]

LINE_MARKS = ["l_linenumber", "l_suppkey", "l_extendedprice", "l_tax", "l_returnflag", "l_linestatus"]


def parts(spark: SparkSession, folder: str, reclassified: bool = False) -> DataFrame:
    """Product rows as of the first load, or as of the reclassification."""
    kind, size = F.col("p_type"), F.col("p_size")
    grade = F.when(size <= 15, "L").when(size <= 35, "M").otherwise("H")
    if reclassified:
        kind = F.when(size >= 40, F.concat("p_type", F.lit(" PLUS"))).otherwise(kind)
    return source(spark, folder, "part").select(
        F.col("p_partkey").alias("product_id"), F.col("p_name").alias("name"), size.alias("model_id"),
        kind.alias("subcategory_id"), F.col("p_brand").alias("line"), grade.alias("class"),
        F.lit("U").alias("style"), _instant(RECLASSIFIED if reclassified else FIRST_LOAD).alias("effective"),
    )


def models(products: DataFrame) -> DataFrame:
    return products.select("model_id").distinct().withColumn("model_name", F.concat(F.lit("Size "), "model_id"))


def subcategories(products: DataFrame) -> DataFrame:
    return products.select("subcategory_id").distinct().withColumn("subcategory_name", F.col("subcategory_id"))


def offers(spark: SparkSession, folder: str) -> DataFrame:
    cents = F.expr("cast(round(l_discount * 100) as bigint)")
    return source(spark, folder, "lineitem").select(cents.alias("SpecialOffer_ID")).distinct().select(
        "SpecialOffer_ID", F.expr("cast(SpecialOffer_ID * 0.01BD as decimal(5,2))").alias("DiscountPct"),
        F.expr("CASE WHEN SpecialOffer_ID = 0 THEN 'No Discount' WHEN SpecialOffer_ID <= 5 THEN 'Seasonal' "
               "ELSE 'Volume' END").alias("Type"),
        F.expr("CASE WHEN SpecialOffer_ID <= 5 THEN 'Customer' ELSE 'Reseller' END").alias("Category"),
        _instant(FIRST_LOAD).alias("effective"),
    )


def territory_inputs(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    nation = source(spark, folder, "nation")
    return (
        nation.select(F.col("n_nationkey").cast("long").alias("territory_id")),
        nation.select(F.col("n_nationkey").cast("long").alias("territory_id"),
                      F.col("n_nationkey").alias("country_code")),
        nation.select(F.col("n_nationkey").alias("country_code"), F.col("n_name").alias("country")),
    )


def customers(spark: SparkSession, folder: str) -> DataFrame:
    return source(spark, folder, "customer").select(
        F.col("c_custkey").alias("customer_id"), F.col("c_mktsegment").alias("gender"),
        _instant(FIRST_LOAD).alias("effective"),
    )


def last_order_date(spark: SparkSession, folder: str):
    return source(spark, folder, "orders").agg(F.max("o_orderdate").cast("date")).first()[0]


class TpchWarehouse(Warehouse):
    """Loads each warehouse table on first use and reads it from the shared folder afterwards."""

    _loaded: dict[tuple[str, str], "TpchWarehouse"] = {}

    def __init__(self, spark: SparkSession, folder: str):
        super().__init__(spark, new_path(spark, "warehouse"))
        self.folder = folder
        self._ready: set[str] = set()
        self._numbered: DataFrame | None = None
        self._lines: DataFrame | None = None

    @classmethod
    def of(cls, spark: SparkSession, folder: str) -> "TpchWarehouse":
        key = (spark.sparkContext.applicationId, folder.rstrip("/"))
        if key not in cls._loaded:
            cls._loaded[key] = cls(spark, folder)
        return cls._loaded[key]

    def table(self, name: str) -> DataFrame:
        if name not in self._ready:
            self.save(name, getattr(self, f"_build_{name}")())
            self._ready.add(name)
        return super().table(name)

    def load(self) -> "TpchWarehouse":
        for name in ("DimTerritory", "DimTime", "DimProduct", "DimSpecialOffer", "DimCustomer",
                     "BridgeProductSpecialOffer", "FactSale"):
            self.table(name)
        return self

    def _build_DimTerritory(self):
        return loading.build_dim_territory(*territory_inputs(self.spark, self.folder))

    def _build_DimTime(self):
        return loading.build_dim_time(source(self.spark, self.folder, "orders"), "o_orderdate")

    def _build_DimProduct(self):
        first, second = parts(self.spark, self.folder), parts(self.spark, self.folder, reclassified=True)
        base = loading.build_dim_product(first, models(first), subcategories(first))
        return loading.build_dim_product(second, models(second), subcategories(second), base)

    def _build_DimSpecialOffer(self):
        return loading.build_dim_special_offer(offers(self.spark, self.folder))

    def _build_DimCustomer(self):
        return loading.build_dim_customer(
            customers(self.spark, self.folder), self.numbered_lines(),
            F.lit(last_order_date(self.spark, self.folder)), LTV_BOUNDS, LOYALTY_BOUNDS,
        )

    def numbered_lines(self) -> DataFrame:
        """Order lines with detail number and territory, written once and read by whatever is built from sales."""
        if self._numbered is None:
            lines = number_within(order_lines(self.spark, self.folder), LINE_ORDER[0], LINE_ORDER[1:], "detail_id")
            # What only tells lines apart is of no use once they are numbered.
            self._numbered = store(lines.drop(*LINE_MARKS), "lines")
        return self._numbered

    def lines(self) -> DataFrame:
        """Order lines with product and offer keys."""
        if self._lines is None:
            self._lines = loading.lookup_product_offer(
                self.numbered_lines(), self.table("DimProduct"), self.table("DimSpecialOffer"))
        return self._lines

    def bridge_pairs(self) -> DataFrame:
        pairs = self.lines().select("ProductSuggorateKey", "SpecialOfferSuggorateKey").distinct()
        start = self.table("DimProduct").select("ProductSuggorateKey", F.col("ValidFrom").alias("effective"))
        return pairs.join(beside_facts(start), "ProductSuggorateKey")

    def _build_BridgeProductSpecialOffer(self):
        return loading.close_superseded(loading.build_bridge(self.bridge_pairs()), self.table("DimProduct"))

    def sale_build(self) -> tuple[DataFrame, DataFrame]:
        bridge = self.table("BridgeProductSpecialOffer")
        lines = loading.lookup_bridge(self.numbered_lines(), bridge, self.table("DimProduct"), self.table("DimSpecialOffer"))
        return loading.build_fact_sale(
            lines, bridge, self.table("DimCustomer"), self.table("DimTerritory"), self.table("DimTime"))

    def _build_FactSale(self):
        return self.sale_build()[0]
