"""Projections, filters and scalar expressions (P)."""

from __future__ import annotations

from pyspark.sql import functions as F

from merkato.functions import expressions as X
from merkato.operators import features as feat
from merkato.operators import series, star, summaries
from merkato.plans.catalog.registry import labelled, query, r, rounded
from merkato.sources import tpch
from merkato.sources.tpch import source


@query("P1_projection", "SELECT CountryRegion AS market, Year AS year, Month AS month, CAST(Revenue AS DOUBLE) AS revenue, "
       "ProductQuantity AS quantity FROM star_current")
def _(wh):
    return star.sales_star(wh).select(
        F.col("CountryRegion").alias("market"), "Year", "Month", "Revenue", F.col("ProductQuantity").alias("quantity"))


@query("P2_current_versions", "SELECT ProductSuggorateKey AS productsuggoratekey, Product_ID AS product_id, "
       "Subcategory AS subcategory FROM dim_product WHERE IsActive")
def _(wh):
    return star.current(wh.table("DimProduct")).select("ProductSuggorateKey", "Product_ID", "Subcategory")


@query("P3_product_range", "SELECT SalesOrderDetailID AS detail, ProductRange AS product_range FROM fact_sale")
def _(wh):
    return wh.table("FactSale").select(
        F.col("SalesOrderDetailID").alias("detail"), X.product_range(F.col("Revenue")).alias("product_range"))


@query("P4_lifetime_value_tier", "SELECT Customer_ID AS customer_id, CASE WHEN LifeTimeValue < 1500000 THEN 'Low' "
       "WHEN LifeTimeValue < 3000000 THEN 'Medium' ELSE 'High' END AS tier FROM dim_customer")
def _(wh):
    return wh.table("DimCustomer").select(
        "Customer_ID", X.ltv_tier(F.col("LifeTimeValue"), tpch.LTV_BOUNDS).alias("tier"))


@query("P5_loyalty_tier", "SELECT c_custkey AS customer_id, CASE WHEN coalesce(recent, 0) >= 600000 THEN 'Platinum' "
       "WHEN coalesce(recent, 0) >= 350000 THEN 'Gold' WHEN coalesce(recent, 0) >= 200000 THEN 'Silver' ELSE 'Bronze' "
       "END AS tier FROM customer LEFT JOIN customer_totals ON c_custkey = customer_id", source=True)
def _(spark, folder):
    from merkato.operators.loading import trailing_revenue

    recent = trailing_revenue(tpch.order_lines(spark, folder), F.lit(tpch.last_order_date(spark, folder)))
    customers = source(spark, folder, "customer").select(F.col("c_custkey").alias("customer_id"))
    return customers.join(recent, "customer_id", "left").select(
        "customer_id", X.loyalty_tier(F.coalesce("trailing_revenue", F.lit(0)), tpch.LOYALTY_BOUNDS).alias("tier"))


@query("P6_safe_ratio", "SELECT offer_id, CAST(sum(line_total) AS DOUBLE) / nullif(CAST(sum(offer_id) AS DOUBLE), 0) "
       "AS revenue_per_point FROM lines GROUP BY 1", source=True)
def _(spark, folder):
    return tpch.order_lines(spark, folder).groupBy("offer_id").agg(
        X.ratio(F.sum("line_total"), F.sum("offer_id")).alias("revenue_per_point"))


@query("P7_growth_rate", f"SELECT market, year, month, {r('revenuegrowth', 9)} AS revenuegrowth, "
       f"{r('quantitygrowth', 9)} AS quantitygrowth FROM series")
def _(wh):
    grown = series.market_series(wh).select("market", "year", "month", "revenuegrowth", "quantitygrowth")
    return rounded(grown, ["revenuegrowth", "quantitygrowth"], 9)


@query("P8_null_fill", "SELECT coalesce(nullif(c_mktsegment, 'HOUSEHOLD'), '__UNKNOWN__') AS segment, "
       "coalesce(CASE WHEN c_acctbal >= 0 THEN c_acctbal END, 0) AS balance FROM customer", source=True)
def _(spark, folder):
    gaps = source(spark, folder, "customer").select(
        F.nullif("c_mktsegment", F.lit("HOUSEHOLD")).alias("segment"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("balance"))
    return feat.fill_unknown(gaps)


@query("P9_lenient_number", "SELECT p_partkey, TRY_CAST(p_brand AS DOUBLE) AS bad, "
       "TRY_CAST(replace(p_brand, 'Brand#', '') AS DOUBLE) AS good FROM part", source=True)
def _(spark, folder):
    return source(spark, folder, "part").select(
        "p_partkey", X.lenient_number(F.col("p_brand")).alias("bad"),
        X.lenient_number(F.replace("p_brand", F.lit("Brand#"), F.lit(""))).alias("good"))


_PRODUCT_COLUMNS = ["ProductSuggorateKey", "Product_ID", "ProductName", "Subcategory", "Model", "ProductLine", "Class",
                    "Style", "ValidFrom", "ValidTo", "IsActive"]


def _listed(df, names):
    return df.sparkSession.createDataFrame([(n,) for n in names], "column_name string")


@query("P10_constant_columns", "SELECT column_name FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(DISTINCT {c}) + CAST(count(*) > count({c}) AS INTEGER) AS n FROM dim_product"
    for c in _PRODUCT_COLUMNS) + ") WHERE n <= 1")
def _(wh):
    product = wh.table("DimProduct")
    return _listed(product, feat.constant_columns(product))


_P11_COLUMNS = ["order_year", "half_year", "order_month", "orderstatus"]


@query("P11_narrow_time_columns", "SELECT column_name FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n FROM periods" for c in _P11_COLUMNS[:3])
       + ") WHERE n <= 2", ctes="periods AS (SELECT year(o_orderdate) AS order_year, CASE WHEN month(o_orderdate) <= 6 "
       "THEN 1 ELSE 2 END AS half_year, month(o_orderdate) AS order_month FROM orders)", source=True)
def _(spark, folder):
    day = F.col("o_orderdate").cast("date")
    rows = source(spark, folder, "orders").select(
        F.year(day).alias("order_year"), F.when(F.month(day) <= 6, 1).otherwise(2).alias("half_year"),
        F.month(day).alias("order_month"), F.col("o_orderstatus").alias("orderstatus"))
    return _listed(rows, feat.narrow_time_columns(rows))


_STAR = [*star.STAR_COLUMNS]


@query("P12_feature_selection", "SELECT column_name FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n, CAST(count(*) > count({c}) AS INTEGER) AS gap FROM star_current"
    for c in _STAR) + ") WHERE n + gap > 1 AND NOT (regexp_matches(lower(column_name), 'year|month|day|date|time') AND n <= 2)")
def _(wh):
    rows = star.sales_star(wh)
    return _listed(rows, feat.select_features(rows))


@query("P13_column_types", "SELECT count(*) AS row_count, 'Revenue,ProductQuantity,LifeTimeValue,Year,Quarter,Month' AS "
       "numeric, 'ProductName,Subcategory,Model,ProductLine,CountryRegion,Gender,LoyaltyStatus,Season' AS categorical "
       "FROM star_current")
def _(wh):
    rows = star.sales_star(wh)
    numeric, categorical = feat.split_types(rows)
    return rows.agg(F.count("*").alias("row_count")).select(
        "row_count", F.lit(",".join(numeric)).alias("numeric"), F.lit(",".join(categorical)).alias("categorical"))


@query("P14_country_columns", "SELECT CountryRegion AS country, count(*) AS row_count FROM star_current GROUP BY 1")
def _(wh):
    rows = star.sales_star(wh)
    name = feat.country_columns(rows)[0]
    return rows.groupBy(F.col(name).alias("country")).agg(F.count("*").alias("row_count"))


_TEXTS = ["ProductName", "Subcategory", "Model", "ProductLine", "CountryRegion", "Gender", "LoyaltyStatus", "Season"]


@query("P15_narrow_categories", "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS distinct_values FROM star_current" for c in _TEXTS)
       + ") WHERE distinct_values <= 12")
def _(wh):
    return feat.few_values(star.sales_star(wh), _TEXTS, feat.MAX_CATEGORIES)


@query("P16_rare_categories", "SELECT coalesce(k.model, 'Other') AS model, count(*) AS row_count FROM gaps g LEFT JOIN "
       "(SELECT model FROM gaps WHERE model IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, model LIMIT 10) k "
       "USING (model) GROUP BY 1",
       ctes="gaps AS (SELECT nullif(Model, 'Size 7') AS model FROM star_current)")
def _(wh):
    gaps = star.sales_star(wh).select(F.nullif("Model", F.lit("Size 7")).alias("model"))
    return feat.collapse_rare(gaps, "model").groupBy("model").agg(F.count("*").alias("row_count"))


@query("P17_key_length", "SELECT count(*) FILTER (length(CAST(SalesOrderID AS VARCHAR)) != 4) AS other_lengths, "
       "count(*) FILTER (length(CAST(DimTimeKey AS VARCHAR)) != 8) AS bad_days FROM fact_sale")
def _(wh):
    return wh.table("FactSale").agg(
        F.count_if(~X.has_length(F.col("SalesOrderID"), 4)).alias("other_lengths"),
        F.count_if(~X.has_length(F.col("DimTimeKey"), 8)).alias("bad_days"))


@query("P18_rounding", "SELECT c_custkey, " + ", ".join(
    f"round_even(c_acctbal * {10**d}.0, 0) / {10**d}.0 + 0.0 AS d{d}" for d in range(4)) + " FROM customer", source=True)
def _(spark, folder):
    return source(spark, folder, "customer").select(
        "c_custkey", *[(X.half_even(F.col("c_acctbal"), d) + F.lit(0.0)).alias(f"d{d}") for d in range(4)])


@query("P19_date_parts", "SELECT o.o_orderkey, DateKey AS datekey, Day AS day, Month AS month, Quarter AS quarter, "
       "Season AS season, Year AS year FROM orders o JOIN dim_time ON DateKey = CAST(strftime(o.o_orderdate, '%Y%m%d') "
       "AS BIGINT)", source=True)
def _(spark, folder):
    return source(spark, folder, "orders").select("o_orderkey", *X.date_parts(F.col("o_orderdate")))


@query("P20_unique_column_names", "SELECT cluster, CAST(sum(ProductQuantity) AS DOUBLE) / count(*) AS productquantity, "
       "CAST(sum(ProductQuantity) AS DOUBLE) / count(*) AS productquantity__dup1 FROM labelled GROUP BY 1")
def _(wh):
    means = summaries.cluster_means(labelled(wh), ["ProductQuantity"])
    return feat.beside(means, means)
