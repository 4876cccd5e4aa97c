"""Warehouse loading (L)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from merkato.operators import loading
from merkato.plans.refresh import StoredWarehouse
from merkato.plans.catalog.registry import query
from merkato.session import new_path
from merkato.sources.dimensions import VersionedDimension
from merkato.sources import tpch
from merkato.sources.tpch import source

_V = "CAST(ValidFrom AS VARCHAR) AS validfrom, CAST(ValidTo AS VARCHAR) AS validto, IsActive AS isactive"


@query("L1_versioned_merge", f"""
SELECT CASE v WHEN 0 THEN row_number() OVER (PARTITION BY v ORDER BY c_custkey)
    ELSE (SELECT count(*) FROM customer) + row_number() OVER (PARTITION BY v ORDER BY c_custkey) END AS sk,
  c_custkey AS customer_id, segment, {_V}
FROM (
  SELECT 0 AS v, c_custkey, c_mktsegment AS segment, TIMESTAMP '1990-01-01' AS ValidFrom,
    CASE WHEN c_mktsegment = 'BUILDING' THEN TIMESTAMP '1996-01-01' ELSE TIMESTAMP '9999-12-31 23:59:59' END AS ValidTo,
    c_mktsegment <> 'BUILDING' AS IsActive FROM customer
  UNION ALL SELECT 1, c_custkey, 'CONSTRUCTION', TIMESTAMP '1996-01-01', TIMESTAMP '9999-12-31 23:59:59', true
  FROM customer WHERE c_mktsegment = 'BUILDING')""", source=True)
def _(spark, folder):
    def batch(segment, day):
        return source(spark, folder, "customer").select(
            F.col("c_custkey").alias("customer_id"), segment.alias("segment"),
            F.lit(day).cast("timestamp_ntz").alias("effective"))

    name = F.col("c_mktsegment")
    renamed = F.when(name == "BUILDING", "CONSTRUCTION").otherwise(name)
    first = loading.scd2_merge(None, batch(name, "1990-01-01"), ["customer_id"], ["segment"], "sk")
    second = loading.scd2_merge(first, batch(renamed, "1996-01-01"), ["customer_id"], ["segment"], "sk")
    # Replaying a batch changes nothing.
    return loading.scd2_merge(second, batch(renamed, "1996-01-01"), ["customer_id"], ["segment"], "sk")


@query("L1_stored_batches", """
SELECT sk, c_custkey AS customer_id, segment, CAST(f AS VARCHAR) AS validfrom,
  CAST(coalesce(t, TIMESTAMP '9999-12-31 23:59:59') AS VARCHAR) AS validto, t IS NULL AS isactive,
  CAST(CASE WHEN t IS NULL THEN 0 ELSE year(t) * 100 + month(t) END AS INTEGER) AS closedmonth
FROM v""", source=True, ctes="""
c AS (SELECT c_custkey, c_mktsegment, c_mktsegment = 'BUILDING' AS b, c_custkey % 10 = 0 AS l FROM customer),
sizes AS (SELECT count(*) AS n, count(*) FILTER (b) AS nb FROM c),
v AS (
  SELECT row_number() OVER (ORDER BY c_custkey) AS sk, c_custkey, c_mktsegment AS segment, TIMESTAMP '1990-01-01' AS f,
    CASE WHEN l THEN TIMESTAMP '1993-03-15' WHEN b THEN TIMESTAMP '1996-01-01' END AS t FROM c
  UNION ALL SELECT (SELECT n FROM sizes) + row_number() OVER (ORDER BY c_custkey), c_custkey, 'CONSTRUCTION',
    TIMESTAMP '1996-01-01', NULL FROM c WHERE b
  UNION ALL SELECT (SELECT n + nb FROM sizes) + row_number() OVER (ORDER BY c_custkey), c_custkey, 'LATE',
    TIMESTAMP '1993-03-15', CASE WHEN b THEN TIMESTAMP '1996-01-01' END FROM c WHERE l)""")
def _(spark, folder):
    fields = "sk long, customer_id long, segment string, ValidFrom timestamp_ntz, ValidTo timestamp_ntz, IsActive boolean"
    stored = VersionedDimension(
        spark, new_path(spark, "customer-versions"), spark.createDataFrame([], fields).schema, ["customer_id"], "sk")

    def batch(segment, day):
        return source(spark, folder, "customer").select(
            F.col("c_custkey").alias("customer_id"), segment.alias("segment"), F.lit(day).cast("timestamp_ntz").alias("effective"))

    name = F.col("c_mktsegment")
    second = batch(F.when(name == "BUILDING", "CONSTRUCTION").otherwise(name), "1996-01-01")
    stored.apply(1, batch(name, "1990-01-01"))
    stored.apply(2, second)
    # A late change, of which the second batch knew nothing.
    stored.apply(3, batch(F.lit("LATE"), "1993-03-15").where("customer_id % 10 = 0"))
    stored.apply(2, second)  # was applied before
    return stored.rows()


@query("L2_fixed_load", """
SELECT CASE WHEN known THEN row_number() OVER (PARTITION BY known ORDER BY n_nationkey)
    ELSE (SELECT count(DISTINCT s_nationkey) FROM supplier)
      + row_number() OVER (PARTITION BY known ORDER BY n_nationkey) END AS sk,
  CAST(n_nationkey AS BIGINT) AS territory_id, CASE WHEN known THEN 'first ' ELSE 'later ' END || n_name AS countryregion
FROM (SELECT *, n_nationkey IN (SELECT s_nationkey FROM supplier) AS known FROM nation)""", source=True)
def _(spark, folder):
    nation = source(spark, folder, "nation").select(
        F.col("n_nationkey").cast("long").alias("territory_id"), F.col("n_name").alias("name"))
    supplied = source(spark, folder, "supplier").select(F.col("s_nationkey").cast("long").alias("territory_id")).distinct()

    def named(df, label):
        return df.select("territory_id", F.concat(F.lit(label), "name").alias("countryregion"))

    first = loading.scd0_load(None, named(nation.join(supplied, "territory_id"), "first "), ["territory_id"], "sk")
    return loading.scd0_load(first, named(nation, "later "), ["territory_id"], "sk")


@query("L3_surrogate_keys", "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS sk FROM orders",
       source=True)
def _(spark, folder):
    orders = source(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    return loading.assign_keys(orders, ["o_orderdate", "o_orderkey"], "sk").select("o_orderkey", "sk")


@query("L4_time_dimension", "SELECT TimeSuggorateKey AS timesuggoratekey, DateKey AS datekey, Day AS day, Month AS month, "
       "Quarter AS quarter, Season AS season, Year AS year FROM dim_time")
def _(wh):
    return wh.table("DimTime")


@query("L5_territory_dimension", "SELECT TerritorySuggorateKey AS territorysuggoratekey, Territory_ID AS territory_id, "
       "CountryRegion AS countryregion FROM dim_territory")
def _(wh):
    return wh.table("DimTerritory")


@query("L6_product_dimension", "SELECT ProductSuggorateKey AS productsuggoratekey, Product_ID AS product_id, ProductName AS "
       "productname, Subcategory AS subcategory, Model AS model, ProductLine AS productline, Class AS class, Style AS style, "
       f"{_V} FROM dim_product")
def _(wh):
    return wh.table("DimProduct")


@query("L6_offer_dimension", "SELECT SpecialOfferSuggorateKey AS specialoffersuggoratekey, SpecialOffer_ID AS "
       "specialoffer_id, CAST(DiscountPct AS DOUBLE) AS discountpct, Type AS type, Category AS category, "
       f"{_V} FROM dim_offer")
def _(wh):
    return wh.table("DimSpecialOffer")


@query("L7_customer_dimension", "SELECT CustomerSuggorateKey AS customersuggoratekey, Customer_ID AS customer_id, Gender AS "
       "gender, CAST(LifeTimeValue AS DOUBLE) AS lifetimevalue, LtvTier AS ltvtier, LoyaltyStatus AS loyaltystatus, "
       f"{_V} FROM dim_customer")
def _(wh):
    return wh.table("DimCustomer")


@query("L8_bridge", "SELECT BrdgProductSpecialOfferKey AS brdgproductspecialofferkey, ProductSuggorateKey AS "
       f"productsuggoratekey, SpecialOfferSuggorateKey AS specialoffersuggoratekey, {_V} FROM bridge")
def _(wh):
    return wh.table("BridgeProductSpecialOffer")


@query("L9_sales_facts", "SELECT SalesOrderID AS salesorderid, SalesOrderDetailID AS salesorderdetailid, "
       "BrdgProductSpecialOfferKey AS brdgproductspecialofferkey, DimTerritoryKey AS dimterritorykey, DimTimeKey AS "
       "dimtimekey, DimCustomerKey AS dimcustomerkey, CAST(Revenue AS DOUBLE) AS revenue, ProductQuantity AS "
       "productquantity, ProductRange AS productrange FROM fact_sale")
def _(wh):
    return wh.table("FactSale").drop("SaleMonth")


# Two batches for a warehouse in files: sales before 1997, then the others with the parts as reclassified and new customer tiers.
_TIERS = """CAST(coalesce(ltv, 0) AS DECIMAL(18,2)) AS value,
    CASE WHEN coalesce(ltv, 0) < 1500000 THEN 'Low' WHEN coalesce(ltv, 0) < 3000000 THEN 'Medium' ELSE 'High' END AS tier,
    CASE WHEN coalesce(recent, 0) >= 600000 THEN 'Platinum' WHEN coalesce(recent, 0) >= 350000 THEN 'Gold'
      WHEN coalesce(recent, 0) >= 200000 THEN 'Silver' ELSE 'Bronze' END AS loyalty"""
_SECOND = f"""early AS (
  SELECT customer_id, sum(line_total) AS ltv, sum(line_total) FILTER (CAST(order_date AS DATE) > DATE '1995-12-31') AS recent
  FROM lines WHERE order_date < TIMESTAMP '1997-01-01' GROUP BY 1),
first_customers AS (SELECT c_custkey, c_mktsegment, {_TIERS} FROM customer LEFT JOIN early ON c_custkey = customer_id),
last_customers AS (SELECT c_custkey, c_mktsegment, {_TIERS} FROM customer LEFT JOIN customer_totals ON c_custkey = customer_id),
changed AS (SELECT l.* FROM last_customers l JOIN first_customers f USING (c_custkey)
  WHERE (l.value, l.tier, l.loyalty) IS DISTINCT FROM (f.value, f.tier, f.loyalty)),
customers_after AS (
  SELECT row_number() OVER (ORDER BY f.c_custkey) AS sk, f.*, TIMESTAMP '1990-01-01' AS ValidFrom,
    CASE WHEN c.c_custkey IS NULL THEN TIMESTAMP '9999-12-31 23:59:59' ELSE TIMESTAMP '1997-01-01' END AS ValidTo,
    c.c_custkey IS NULL AS IsActive
  FROM first_customers f LEFT JOIN changed c USING (c_custkey)
  UNION ALL SELECT (SELECT count(*) FROM customer) + row_number() OVER (ORDER BY c_custkey), *, TIMESTAMP '1997-01-01',
    TIMESTAMP '9999-12-31 23:59:59', true FROM changed),
pairs_after AS (
  SELECT row_number() OVER (ORDER BY batch, ProductSuggorateKey, SpecialOfferSuggorateKey) AS pair, * FROM (
    SELECT ProductSuggorateKey, SpecialOfferSuggorateKey, min(CASE WHEN order_date < TIMESTAMP '1997-01-01' THEN 1 ELSE 2 END) AS batch
    FROM keyed_lines GROUP BY 1, 2))"""


def _grown(wh):
    def made():
        grown = StoredWarehouse(wh.spark, new_path(wh.spark, "stored-warehouse"))
        spark, folder, lines = wh.spark, wh.folder, wh.numbered_lines()
        cut = F.lit("1997-01-01").cast("timestamp_ntz")
        early = F.col("order_date") < cut

        def customers(sales, effective, as_of):
            named = tpch.customers(spark, folder).withColumn("effective", effective)
            return loading.customer_rows(named, sales, as_of, tpch.LTV_BOUNDS, tpch.LOYALTY_BOUNDS)

        def products(reclassified):
            found = tpch.parts(spark, folder, reclassified)
            return loading.product_rows(found, tpch.models(found), tpch.subcategories(found))

        start = F.lit(tpch.FIRST_LOAD).cast("timestamp_ntz")
        first = dict(
            products=products(False), offers=tpch.offers(spark, folder), territories=wh.table("DimTerritory").select(
                "Territory_ID", "CountryRegion"),
            customers=customers(lines.where(early), start, F.lit(dt.date(1996, 12, 31))), lines=lines.where(early))
        second = dict(products=products(True), lines=lines.where(~early),
                      customers=customers(lines, cut, F.lit(tpch.last_order_date(spark, folder))))
        for batch, changes in ((1, first), (2, second), (2, second)):  # the repetition changes nothing
            grown.apply(batch, **changes)
        return grown

    if "grown" not in wh.parts:
        wh.parts["grown"] = made()
    return wh.parts["grown"]


@query("L9_second_batch", """
SELECT k.order_id AS salesorderid, k.detail_id AS salesorderdetailid, p.pair AS brdgproductspecialofferkey,
  t.TerritorySuggorateKey AS dimterritorykey, CAST(strftime(k.order_date, '%Y%m%d') AS BIGINT) AS dimtimekey,
  c.sk AS dimcustomerkey, CAST(k.line_total AS DOUBLE) AS revenue, k.order_qty AS productquantity,
  CASE WHEN k.line_total < 10000 THEN 'Low' WHEN k.line_total < 50000 THEN 'Medium' ELSE 'High' END AS productrange
FROM keyed_lines k JOIN pairs_after p USING (ProductSuggorateKey, SpecialOfferSuggorateKey)
JOIN customers_after c ON k.customer_id = c.c_custkey AND k.order_date >= c.ValidFrom AND k.order_date < c.ValidTo
JOIN dim_territory t ON k.territory_id = t.Territory_ID""", ctes=_SECOND)
def _(wh):
    return _grown(wh).table("FactSale").drop("SaleMonth")


@query("L7_second_batch", f"SELECT sk AS customersuggoratekey, c_custkey AS customer_id, c_mktsegment AS gender, CAST(value AS DOUBLE) "
       f"AS lifetimevalue, tier AS ltvtier, loyalty AS loyaltystatus, {_V} FROM customers_after", ctes=_SECOND)
def _(wh):
    return _grown(wh).table("DimCustomer")


@query("L9_rejected_sales", "SELECT count(*) AS rejected FROM lineitem LEFT JOIN dim_time d ON d.DateKey = "
       "CAST(strftime(l_shipdate, '%Y%m%d') AS BIGINT) WHERE d.DateKey IS NULL")
def _(wh):
    # Dated by shipping, some lines fall outside the order calendar and must be rejected.
    lines = wh.lines().withColumn("order_date", F.col("l_shipdate"))
    _, rejects = loading.build_fact_sale(
        lines, wh.table("BridgeProductSpecialOffer"), wh.table("DimCustomer"), wh.table("DimTerritory"),
        wh.table("DimTime"))
    return rejects.agg(F.count_if("no_day").alias("rejected"))


