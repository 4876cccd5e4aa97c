"""Registration of queries, plain output types, and the warehouse expressed in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from merkato.operators import star
from merkato.session import tune
from merkato.sources.tpch import TpchWarehouse

QUERIES: dict[str, Callable] = {}
SQL: dict[str, str] = {}

# Clusters of the labelled rows: six stand-in labels, and one more that stays empty.
LABELS, K = 6, 7


def plain(df: DataFrame) -> DataFrame:
    """Lower-case names; decimals and floats as doubles, timestamps as text."""
    def column(f: T.StructField):
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DecimalType, T.FloatType)):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = c.cast("string")
        return c.alias(f.name.lower())

    return df.select(*[column(f) for f in df.schema.fields])


def query(name: str, sql: str | None = None, ctes: str = "", source: bool = False):
    """Register ``fn(wh)`` as a query; with ``source`` it is ``fn(spark, folder)`` on the raw tables."""
    def register(fn):
        def run(spark, folder):
            tune(spark)
            return plain(fn(spark, folder) if source else fn(TpchWarehouse.of(spark, folder)))

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = f"WITH RECURSIVE {WAREHOUSE}{',' + ctes if ctes else ''} {sql}"
        return fn

    return register


def labelled(wh) -> DataFrame:
    """Current-version sales with a deterministic stand-in for the cluster label."""
    rows = star.sales_star(wh, keep=["DimTerritoryKey"])
    return rows.withColumn("cluster", F.pmod("DimTerritoryKey", F.lit(LABELS)).cast("int")).drop("DimTerritoryKey")


def r(expression: str, digits: int = 6) -> str:
    """SQL rounding that never gives a negative zero."""
    return f"(round({expression}, {digits}) + 0.0)"


def rounded(df: DataFrame, columns: list[str], digits: int = 6) -> DataFrame:
    return df.select(*[
        (F.round(F.col(c).cast("double"), digits) + F.lit(0.0)).alias(c) if c in columns else F.col(f"`{c}`")
        for c in df.columns
    ])


WAREHOUSE = """
lines AS (
  SELECT l_orderkey AS order_id, o_orderdate AS order_date, o_custkey AS customer_id, l_partkey AS product_id,
    CAST(round(l_discount * 100) AS BIGINT) AS offer_id, CAST(l_quantity AS BIGINT) AS order_qty,
    CAST((CAST(round(l_extendedprice * 100) AS BIGINT) * (100 - CAST(round(l_discount * 100) AS BIGINT)) + 50) // 100
      * 0.01 AS DECIMAL(18,2)) AS line_total,
    c_nationkey AS territory_id,
    row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice,
      CAST(l_quantity AS BIGINT), CAST(round(l_discount * 100) AS BIGINT), l_tax, l_returnflag, l_linestatus)
      AS detail_id
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey
),
dim_product AS (
  SELECT row_number() OVER (ORDER BY p_partkey) AS ProductSuggorateKey, p_partkey AS Product_ID,
    p_name AS ProductName, p_type AS Subcategory, 'Size ' || p_size AS Model, p_brand AS ProductLine,
    CASE WHEN p_size <= 15 THEN 'L' WHEN p_size <= 35 THEN 'M' ELSE 'H' END AS Class, 'U' AS Style,
    TIMESTAMP '1990-01-01 00:00:00' AS ValidFrom,
    CASE WHEN p_size >= 40 THEN TIMESTAMP '1998-07-01 00:00:00' ELSE TIMESTAMP '9999-12-31 23:59:59' END AS ValidTo,
    p_size < 40 AS IsActive
  FROM part
  UNION ALL
  SELECT (SELECT count(*) FROM part) + row_number() OVER (ORDER BY p_partkey), p_partkey, p_name,
    p_type || ' PLUS', 'Size ' || p_size, p_brand, 'H', 'U', TIMESTAMP '1998-07-01 00:00:00',
    TIMESTAMP '9999-12-31 23:59:59', true
  FROM part WHERE p_size >= 40
),
dim_offer AS (
  SELECT row_number() OVER (ORDER BY offer_id) AS SpecialOfferSuggorateKey, offer_id AS SpecialOffer_ID,
    CAST(offer_id * 0.01 AS DECIMAL(5,2)) AS DiscountPct,
    CASE WHEN offer_id = 0 THEN 'No Discount' WHEN offer_id <= 5 THEN 'Seasonal' ELSE 'Volume' END AS Type,
    CASE WHEN offer_id <= 5 THEN 'Customer' ELSE 'Reseller' END AS Category,
    TIMESTAMP '1990-01-01 00:00:00' AS ValidFrom, TIMESTAMP '9999-12-31 23:59:59' AS ValidTo, true AS IsActive
  FROM (SELECT DISTINCT CAST(round(l_discount * 100) AS BIGINT) AS offer_id FROM lineitem)
),
dim_territory AS (
  SELECT row_number() OVER (ORDER BY n_nationkey) AS TerritorySuggorateKey, CAST(n_nationkey AS BIGINT) AS Territory_ID,
    n_name AS CountryRegion
  FROM nation
),
dim_time AS (
  SELECT row_number() OVER (ORDER BY d) AS TimeSuggorateKey, CAST(strftime(d, '%Y%m%d') AS BIGINT) AS DateKey,
    CAST(day(d) AS INTEGER) AS Day, CAST(month(d) AS INTEGER) AS Month, CAST(quarter(d) AS INTEGER) AS Quarter,
    CASE WHEN month(d) IN (12, 1, 2) THEN 'Winter' WHEN month(d) IN (3, 4, 5) THEN 'Spring'
      WHEN month(d) IN (6, 7, 8) THEN 'Summer' ELSE 'Autumn' END AS Season, CAST(year(d) AS INTEGER) AS Year
  FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)
),
customer_totals AS (
  SELECT customer_id, sum(line_total) AS ltv,
    sum(line_total) FILTER (CAST(order_date AS DATE) > (SELECT CAST(max(o_orderdate) AS DATE) FROM orders)
      - INTERVAL 12 MONTH) AS recent
  FROM lines GROUP BY 1
),
dim_customer AS (
  SELECT row_number() OVER (ORDER BY c_custkey) AS CustomerSuggorateKey, c_custkey AS Customer_ID,
    c_mktsegment AS Gender, CAST(coalesce(ltv, 0) AS DECIMAL(18,2)) AS LifeTimeValue,
    CASE WHEN coalesce(ltv, 0) < 1500000 THEN 'Low' WHEN coalesce(ltv, 0) < 3000000 THEN 'Medium' ELSE 'High' END
      AS LtvTier,
    CASE WHEN coalesce(recent, 0) >= 600000 THEN 'Platinum' WHEN coalesce(recent, 0) >= 350000 THEN 'Gold'
      WHEN coalesce(recent, 0) >= 200000 THEN 'Silver' ELSE 'Bronze' END AS LoyaltyStatus,
    TIMESTAMP '1990-01-01 00:00:00' AS ValidFrom, TIMESTAMP '9999-12-31 23:59:59' AS ValidTo, true AS IsActive
  FROM customer LEFT JOIN customer_totals ON c_custkey = customer_id
),
keyed_lines AS (
  SELECT l.*, p.ProductSuggorateKey, o.SpecialOfferSuggorateKey
  FROM lines l
  LEFT JOIN dim_product p ON l.product_id = p.Product_ID AND l.order_date >= p.ValidFrom AND l.order_date < p.ValidTo
  LEFT JOIN dim_offer o ON l.offer_id = o.SpecialOffer_ID
),
bridge AS (
  SELECT row_number() OVER (ORDER BY k.ProductSuggorateKey, k.SpecialOfferSuggorateKey)
      AS BrdgProductSpecialOfferKey,
    k.ProductSuggorateKey, k.SpecialOfferSuggorateKey, p.ValidFrom, p.ValidTo, p.IsActive
  FROM (SELECT DISTINCT ProductSuggorateKey, SpecialOfferSuggorateKey FROM keyed_lines) k
  JOIN dim_product p USING (ProductSuggorateKey)
),
fact_sale AS (
  SELECT k.order_id AS SalesOrderID, k.detail_id AS SalesOrderDetailID, b.BrdgProductSpecialOfferKey,
    t.TerritorySuggorateKey AS DimTerritoryKey, CAST(strftime(k.order_date, '%Y%m%d') AS BIGINT) AS DimTimeKey,
    c.CustomerSuggorateKey AS DimCustomerKey, k.line_total AS Revenue, k.order_qty AS ProductQuantity,
    CASE WHEN k.line_total < 10000 THEN 'Low' WHEN k.line_total < 50000 THEN 'Medium' ELSE 'High' END AS ProductRange
  FROM keyed_lines k
  JOIN bridge b USING (ProductSuggorateKey, SpecialOfferSuggorateKey)
  JOIN dim_customer c ON k.customer_id = c.Customer_ID
  JOIN dim_territory t ON k.territory_id = t.Territory_ID
),
star_current AS (
  SELECT f.Revenue, f.ProductQuantity, p.ProductName, p.Subcategory, p.Model, p.ProductLine, t.CountryRegion,
    c.Gender, c.LifeTimeValue, c.LoyaltyStatus, d.Year, d.Quarter, d.Month, d.Season, f.DimTerritoryKey,
    f.SalesOrderID, f.SalesOrderDetailID, f.DimCustomerKey, o.DiscountPct
  FROM fact_sale f
  JOIN bridge b ON b.BrdgProductSpecialOfferKey = f.BrdgProductSpecialOfferKey AND b.IsActive
  JOIN dim_product p ON p.ProductSuggorateKey = b.ProductSuggorateKey AND p.IsActive
  JOIN dim_customer c ON c.CustomerSuggorateKey = f.DimCustomerKey AND c.IsActive
  JOIN dim_offer o ON o.SpecialOfferSuggorateKey = b.SpecialOfferSuggorateKey AND o.IsActive
  JOIN dim_territory t ON t.TerritorySuggorateKey = f.DimTerritoryKey
  LEFT JOIN dim_time d ON d.DateKey = f.DimTimeKey
),
star_recorded AS (
  SELECT f.Revenue, f.ProductQuantity, p.ProductName, p.Subcategory, p.Model, p.ProductLine, t.CountryRegion,
    c.Gender, c.LifeTimeValue, c.LoyaltyStatus, d.Year, d.Quarter, d.Month, d.Season
  FROM fact_sale f
  JOIN bridge b ON b.BrdgProductSpecialOfferKey = f.BrdgProductSpecialOfferKey
  JOIN dim_product p ON p.ProductSuggorateKey = b.ProductSuggorateKey
  JOIN dim_customer c ON c.CustomerSuggorateKey = f.DimCustomerKey
  JOIN dim_territory t ON t.TerritorySuggorateKey = f.DimTerritoryKey
  JOIN dim_time d ON d.DateKey = f.DimTimeKey
),
labelled AS (SELECT *, CAST(DimTerritoryKey % 6 AS INTEGER) AS cluster FROM star_current),
monthly AS (
  SELECT t.CountryRegion AS market, d.Year AS year, d.Month AS month, max(d.DateKey) AS datekey,
    sum(f.Revenue) AS revenue, CAST(sum(f.ProductQuantity) AS BIGINT) AS quantity,
    count(DISTINCT f.SalesOrderID) AS ordercount, count(DISTINCT f.DimCustomerKey) AS customercount,
    CAST(sum(f.Revenue) AS DOUBLE) / count(f.Revenue) AS avgordervalue,
    count(DISTINCT p.Subcategory) AS uniquesubcategories, count(DISTINCT p.ProductLine) AS uniqueproductlines
  FROM fact_sale f
  JOIN bridge b ON b.BrdgProductSpecialOfferKey = f.BrdgProductSpecialOfferKey AND b.IsActive
  JOIN dim_product p ON p.ProductSuggorateKey = b.ProductSuggorateKey AND p.IsActive
  JOIN dim_territory t ON t.TerritorySuggorateKey = f.DimTerritoryKey
  LEFT JOIN dim_time d ON d.DateKey = f.DimTimeKey
  GROUP BY 1, 2, 3
),
recent AS (
  SELECT DISTINCT year, month FROM monthly WHERE year IS NOT NULL ORDER BY year DESC, month DESC LIMIT 12
),
lagged AS (
  SELECT m.*, lag(revenue) OVER w AS prevrevenue, lag(quantity) OVER w AS prevquantity
  FROM monthly m JOIN recent USING (year, month) WINDOW w AS (PARTITION BY market ORDER BY year, month)
),
series AS (
  SELECT *,
    coalesce((CAST(revenue AS DOUBLE) - CAST(prevrevenue AS DOUBLE)) / (CAST(prevrevenue AS DOUBLE) + 1e-6), 0.0)
      AS revenuegrowth,
    coalesce((CAST(quantity AS DOUBLE) - CAST(prevquantity AS DOUBLE)) / (CAST(prevquantity AS DOUBLE) + 1e-6), 0.0)
      AS quantitygrowth
  FROM lagged
),
static AS (
  SELECT CountryRegion AS market, CAST(sum(DiscountPct) AS DOUBLE) / count(DiscountPct) AS avgdiscount,
    CAST(count(DISTINCT DimCustomerKey) FILTER (LoyaltyStatus = 'Platinum') AS DOUBLE)
      / count(DISTINCT DimCustomerKey) AS platinumshare,
    CAST(count(DISTINCT DimCustomerKey) FILTER (LoyaltyStatus = 'Gold') AS DOUBLE)
      / count(DISTINCT DimCustomerKey) AS goldshare,
    CAST(count(DISTINCT DimCustomerKey) FILTER (LoyaltyStatus = 'Silver') AS DOUBLE)
      / count(DISTINCT DimCustomerKey) AS silvershare,
    CAST(sum(LifeTimeValue) AS DOUBLE) / count(LifeTimeValue) AS avgltv,
    count(DISTINCT ProductLine) AS totalproductlines, count(DISTINCT Subcategory) AS totalsubcategories
  FROM star_current GROUP BY 1
),
steps AS (
  SELECT *, 7 - back AS step FROM (
    SELECT *, row_number() OVER (PARTITION BY market ORDER BY year DESC, month DESC) AS back,
      count(*) OVER (PARTITION BY market) AS n
    FROM series) WHERE n >= 6 AND back <= 6
),
latest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY market ORDER BY year DESC, month DESC) AS n FROM series)
  WHERE n = 1
),
summary AS (
  SELECT i.cluster, coalesce(size, 0) AS size, coalesce(total_revenue, 0) AS total_revenue,
    coalesce(avg_revenue, 0) AS avg_revenue, CAST(coalesce(size, 0) AS DOUBLE) AS total_customers,
    CAST(coalesce(size, 0) AS DOUBLE) AS avg_customers
  FROM (SELECT CAST(unnest(range(7)) AS INTEGER) AS cluster) i
  LEFT JOIN (
    SELECT cluster, count(*) AS size, CAST(sum(Revenue) AS DOUBLE) AS total_revenue,
      CAST(sum(Revenue) AS DOUBLE) / count(Revenue) AS avg_revenue
    FROM labelled GROUP BY 1) s USING (cluster)
),
scored AS (
  SELECT *, 0.5 * (CAST(size AS DOUBLE) / CAST(max(size) OVER () AS DOUBLE))
      + 0.5 * (total_revenue / max(total_revenue) OVER ()) AS priority_score,
    total_revenue / nullif(total_customers, 0) AS revenue_per_customer
  FROM summary
),
flagged AS (
  SELECT *, CASE WHEN priority_score >= 0.7 THEN 'High' WHEN priority_score >= 0.4 THEN 'Medium' ELSE 'Low' END
      AS priority_band,
    CASE WHEN revenue_per_customer >= (SELECT quantile_cont(revenue_per_customer, 0.75) FROM scored) THEN 'high'
      WHEN revenue_per_customer <= (SELECT quantile_cont(revenue_per_customer, 0.25) FROM scored) THEN 'low' END
      AS value_flag
  FROM scored
)
"""
