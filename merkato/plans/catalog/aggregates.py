"""Aggregations (A)."""

from __future__ import annotations

from pyspark.sql import functions as F

from merkato.functions.ordering import exact_quantiles
from merkato.operators import features as feat
from merkato.operators.cube import MonthCube
from merkato.operators import decisions, loading, quality, series, star, summaries
from merkato.plans.catalog.registry import K, LABELS, labelled, query, r, rounded
from merkato.session import store
from merkato.sources import tpch
from merkato.sources.tpch import source

_METRICS = ("market, year, month, datekey, CAST(revenue AS DOUBLE) AS revenue, quantity, ordercount, customercount, "
            "avgordervalue, uniquesubcategories, uniqueproductlines")


@query("A1_market_month_metrics", f"SELECT {_METRICS} FROM monthly")
def _(wh):
    return MonthCube.of(wh).metrics()


@query("A1_distinct_over_months", """
SELECT CountryRegion AS market, count(DISTINCT SalesOrderID) AS ordercount, count(DISTINCT DimCustomerKey) AS customercount,
  count(DISTINCT Subcategory) AS uniquesubcategories, count(DISTINCT ProductLine) AS uniqueproductlines
FROM star_current s JOIN recent r ON s.Year = r.year AND s.Month = r.month GROUP BY 1""")
def _(wh):
    cube = MonthCube.of(wh)
    return cube.distinct_counts(["market"], cube.months()[-12:])


@query("A1_market_day_metrics", f"""
SELECT CountryRegion AS market, Year AS year, Month AS month, DimTimeKey AS datekey,
  CAST(sum(Revenue) AS DOUBLE) AS revenue, CAST(sum(ProductQuantity) AS BIGINT) AS quantity,
  count(DISTINCT SalesOrderID) AS ordercount, count(DISTINCT DimCustomerKey) AS customercount,
  CAST(sum(Revenue) AS DOUBLE) / count(Revenue) AS avgordervalue,
  count(DISTINCT Subcategory) AS uniquesubcategories, count(DISTINCT ProductLine) AS uniqueproductlines
FROM star_current JOIN (SELECT SalesOrderDetailID, DimTimeKey FROM fact_sale) USING (SalesOrderDetailID)
GROUP BY 1, 2, 3, 4""")
def _(wh):
    return series.period_metrics(series.market_rows(wh), "day")


@query("A2_static_features", "SELECT * FROM static")
def _(wh):
    return feat.static_features(feat.static_rows(wh))


@query("A2_static_features_by_row", "SELECT market, avgdiscount, platinum / customers AS platinumshare, "
       "gold / customers AS goldshare, silver / customers AS silvershare, avgltv, totalproductlines, totalsubcategories "
       "FROM static JOIN (SELECT CountryRegion AS market, "
       "CAST(count(*) FILTER (LoyaltyStatus = 'Platinum') AS DOUBLE) AS platinum, "
       "CAST(count(*) FILTER (LoyaltyStatus = 'Gold') AS DOUBLE) AS gold, "
       "CAST(count(*) FILTER (LoyaltyStatus = 'Silver') AS DOUBLE) AS silver, "
       "count(DISTINCT DimCustomerKey) AS customers FROM star_current GROUP BY 1) USING (market)")
def _(wh):
    return feat.static_features(feat.static_rows(wh), "row")


@query("A3_conditional_counts", "SELECT count(*) FILTER (IsActive) AS active, count(*) FILTER (NOT IsActive) AS inactive, "
       "CAST(sum(CASE WHEN IsActive THEN SpecialOfferSuggorateKey ELSE 0 END) AS BIGINT) AS active_offer_sum FROM bridge")
def _(wh):
    return wh.table("BridgeProductSpecialOffer").agg(
        F.count_if("IsActive").alias("active"), F.count_if(~F.col("IsActive")).alias("inactive"),
        F.sum(F.when(F.col("IsActive"), F.col("SpecialOfferSuggorateKey")).otherwise(0)).alias("active_offer_sum"))


@query("A4_duplicate_keys", "SELECT count(*) AS issues FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber "
       "HAVING count(*) > 1)", source=True)
def _(spark, folder):
    return quality.duplicate_groups(source(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("A5_coverage", "SELECT min(DateKey) AS first_date, max(DateKey) AS last_date, count(*) AS dates FROM dim_time")
def _(wh):
    return quality.date_coverage(wh.table("DimTime"))


@query("A6_cluster_summary", "SELECT * FROM summary")
def _(wh):
    return summaries.cluster_summary(labelled(wh), K)


@query("A6_cluster_summary_customers", "SELECT i.cluster, coalesce(size, 0) AS size, coalesce(total_revenue, 0) AS "
       "total_revenue, coalesce(avg_revenue, 0) AS avg_revenue, coalesce(tc, 0) AS total_customers, coalesce(ac, 0) AS "
       "avg_customers FROM (SELECT cluster FROM summary) i LEFT JOIN (SELECT cluster, count(*) AS size, "
       "CAST(sum(Revenue) AS DOUBLE) AS total_revenue, CAST(sum(Revenue) AS DOUBLE) / count(*) AS avg_revenue, "
       "CAST(sum(ProductQuantity) AS DOUBLE) AS tc, CAST(sum(ProductQuantity) AS DOUBLE) / count(*) AS ac "
       "FROM labelled GROUP BY 1) USING (cluster)")
def _(wh):
    return summaries.cluster_summary(labelled(wh), K, customers="ProductQuantity")


@query("A7_cluster_metrics", "SELECT cluster, count(*) AS points, round_even(count(*) / sum(count(*)) OVER () * 100 * 10.0, 0) "
       "/ 10.0 AS pct_of_total, CAST(round_even(CAST(sum(Revenue) AS DOUBLE), 0) AS BIGINT) AS total_revenue, "
       "CAST(round_even(CAST(sum(Revenue) AS DOUBLE) / count(*), 0) AS BIGINT) AS avg_revenue, "
       "CAST(sum(ProductQuantity) AS DOUBLE) AS total_customers, CAST(round_even(CAST(sum(Revenue) AS DOUBLE) / "
       "CAST(sum(ProductQuantity) AS DOUBLE), 0) AS BIGINT) AS revenue_per_customer FROM labelled GROUP BY 1")
def _(wh):
    return summaries.cluster_metrics(labelled(wh), customers="ProductQuantity")


@query("A8_totals", "SELECT count(*) AS points, 6 AS clusters, round_even(count(*) / 6.0 * 10.0, 0) / 10.0 AS "
       "avg_points_per_cluster, CAST(sum(Revenue) AS DOUBLE) AS total_revenue FROM labelled")
def _(wh):
    return summaries.totals(labelled(wh), LABELS)


def _segments(wh):
    latest = series.latest_period(series.market_series(wh))
    return latest.withColumn("segment", F.length("market") % 3).select("market", "segment", "revenue", "quantity")


_SEGMENTS = """segments AS (SELECT market, CAST(length(market) % 3 AS INTEGER) AS segment, revenue, quantity
  FROM latest)"""


def _measures(column):
    as_double = f"CAST({column} AS DOUBLE)"
    return (f"round_even(CAST(sum({column}) AS DOUBLE) / count(*) * 100.0, 0) / 100.0 AS {column}_mean, "
            f"round_even(CAST(sum({column}) AS DOUBLE) * 100.0, 0) / 100.0 AS {column}_sum, "
            f"round_even(stddev_samp({as_double}) * 100.0, 0) / 100.0 AS {column}_std")


@query("A9_segment_statistics", f"SELECT segment, count(*) AS markets, {_measures('revenue')}, {_measures('quantity')} "
       "FROM segments GROUP BY 1", ctes=_SEGMENTS)
def _(wh):
    return summaries.segment_statistics(_segments(wh))


@query("A10_segment_distribution", "SELECT segment, count(*) AS markets FROM segments GROUP BY 1", ctes=_SEGMENTS)
def _(wh):
    return summaries.segment_distribution(_segments(wh))


# Clusters that mix within a country: the quarter of the sale.
_QUARTERS = """tied AS (SELECT CountryRegion, Revenue, CAST(Quarter - 1 AS INTEGER) AS cluster FROM star_current),
country_cluster AS (SELECT CountryRegion AS country, cluster, count(*) AS count,
  CAST(sum(Revenue) AS DOUBLE) AS revenue FROM tied GROUP BY 1, 2)"""


def _by_country(wh):
    rows = star.sales_star(wh).withColumn("cluster", (F.col("Quarter") - 1).cast("int"))
    return summaries.country_clusters(rows, "CountryRegion")


@query("A11_country_clusters", "SELECT * FROM country_cluster", ctes=_QUARTERS)
def _(wh):
    return _by_country(wh)


@query("A12_country_totals", "SELECT country, CAST(sum(count) AS BIGINT) AS rows, CAST(sum(revenue) AS DOUBLE) AS revenue "
       "FROM (SELECT country, count, CAST(revenue AS DECIMAL(38,2)) AS revenue FROM country_cluster) GROUP BY 1",
       ctes=_QUARTERS)
def _(wh):
    by_cluster = _by_country(wh)
    revenue = summaries.country_totals(
        by_cluster.withColumn("revenue", F.col("revenue").cast("decimal(28,2)")), "revenue")
    return summaries.country_totals(by_cluster).withColumnRenamed("value", "rows").join(
        revenue.withColumnRenamed("value", "revenue"), "country")


@query("A13_dominant_cluster", "SELECT country, cluster AS dominant_cluster FROM (SELECT *, row_number() OVER (PARTITION BY "
       "country ORDER BY count DESC, cluster) AS n FROM country_cluster) WHERE n = 1", ctes=_QUARTERS)
def _(wh):
    return summaries.dominant_cluster(_by_country(wh))


@query("A14_country_composition", "SELECT country, " + ", ".join(
    f'CAST(coalesce(sum(count) FILTER (cluster = {i}), 0) AS BIGINT) AS "{i}"' for i in range(5))
       + " FROM country_cluster WHERE country IN (SELECT country FROM country_cluster GROUP BY 1 ORDER BY sum(count) DESC, 1 "
       "LIMIT 12) GROUP BY 1", ctes=_QUARTERS)
def _(wh):
    return summaries.country_composition(_by_country(wh), 5)


@query("A15_category_counts", "SELECT CAST(NULL AS INTEGER) AS cluster, LoyaltyStatus AS loyaltystatus, count(*) AS count "
       "FROM labelled GROUP BY 2 UNION ALL SELECT cluster, LoyaltyStatus, count(*) FROM labelled GROUP BY 1, 2")
def _(wh):
    rows = store(labelled(wh).select("cluster", "LoyaltyStatus"), "labelled")
    overall = summaries.category_counts(rows, "LoyaltyStatus").withColumn("cluster", F.lit(None).cast("int"))
    return overall.unionByName(summaries.category_counts_by_cluster(rows, "LoyaltyStatus"))


@query("A16_category_shares", "SELECT cluster, gender, count(*) AS count, 100.0::DOUBLE * count(*) / CAST(sum(count(*)) OVER "
       "(PARTITION BY cluster) AS DOUBLE) AS share_pct FROM gaps GROUP BY 1, 2",
       ctes="gaps AS (SELECT cluster, nullif(Gender, 'HOUSEHOLD') AS gender FROM labelled)")
def _(wh):
    rows = labelled(wh).select("cluster", F.nullif("Gender", F.lit("HOUSEHOLD")).alias("gender"))
    return summaries.category_shares(rows, "gender")


_NUMERIC = ["Revenue", "ProductQuantity", "LifeTimeValue", "Year", "Quarter", "Month"]
_MEANS = ", ".join(f"CAST(sum({c}) AS DOUBLE) / count({c}) AS {c.lower()}" for c in _NUMERIC)


@query("A17_global_means", f"SELECT {_MEANS} FROM labelled")
def _(wh):
    return summaries.global_means(labelled(wh), _NUMERIC)


@query("A18_cluster_means", f"SELECT cluster, {_MEANS} FROM labelled GROUP BY 1")
def _(wh):
    return summaries.cluster_means(labelled(wh), _NUMERIC)


@query("A18_encoded_cluster_means", "SELECT cluster, CAST(sum(Revenue) AS DOUBLE) / count(*) AS revenue, " + ", ".join(
    f"CAST(count(*) FILTER (LoyaltyStatus = '{v}') AS DOUBLE) / count(*) AS loyaltystatus_{v.lower()}"
    for v in ("Gold", "Platinum", "Silver")) + " FROM labelled GROUP BY 1")
def _(wh):
    return summaries.encoded_means(labelled(wh), ["Revenue"], ["LoyaltyStatus"])


@query("A18_encoded_mean_rows", """
SELECT cluster, 'Revenue' AS feature, NULL::VARCHAR AS category, round(CAST(sum(Revenue) AS DOUBLE) / count(*), 6) AS mean FROM labelled GROUP BY 1
UNION ALL SELECT cluster, feature, category, round(count(*) / CAST(any_value(size) AS DOUBLE), 6) FROM (
  SELECT cluster, unnest(['LoyaltyStatus', 'ProductName']) AS feature, unnest([LoyaltyStatus, ProductName]) AS category FROM labelled)
JOIN (SELECT cluster, count(*) AS size FROM labelled GROUP BY 1) USING (cluster)
JOIN (SELECT min(LoyaltyStatus) AS l, min(ProductName) AS p FROM labelled) ON category > CASE feature WHEN 'ProductName' THEN p ELSE l END
GROUP BY 1, 2, 3""")
def _(wh):
    return rounded(summaries.encoded_mean_rows(labelled(wh), ["Revenue"], ["LoyaltyStatus", "ProductName"]), ["mean"])


@query("A19_quartiles", f"SELECT {r('quantile_cont(revenue_per_customer, 0.25)')} AS p25, "
       f"{r('quantile_cont(revenue_per_customer, 0.75)')} AS p75 FROM scored")
def _(wh):
    value = decisions.revenue_per_customer(summaries.cluster_summary(labelled(wh), K))
    share = F.percentile("revenue_per_customer", F.array(F.lit(0.25), F.lit(0.75)))
    return rounded(value.agg(share.alias("p")).select(F.col("p")[0].alias("p25"), F.col("p")[1].alias("p75")), ["p25", "p75"])


@query("A19_quantiles_of_rows", "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, {p}::DOUBLE AS probability, {r(f'quantile_cont(CAST({c} AS DOUBLE), {p})')} AS quantile "
    "FROM fact_sale" for c in ("Revenue", "ProductQuantity") for p in (0.2, 0.25, 0.75, 0.8)) + ")")
def _(wh):
    return rounded(exact_quantiles(wh.table("FactSale"), ["Revenue", "ProductQuantity"], [0.2, 0.25, 0.75, 0.8]), ["quantile"])


@query("A20_distinct_counts", "SELECT count(DISTINCT gender) AS without_null, count(DISTINCT gender) + CAST(count(*) > "
       "count(gender) AS INTEGER) AS with_null, count(DISTINCT ProductName) AS products FROM gaps",
       ctes="gaps AS (SELECT nullif(Gender, 'HOUSEHOLD') AS gender, ProductName FROM labelled)")
def _(wh):
    gender = F.nullif("Gender", F.lit("HOUSEHOLD"))
    return labelled(wh).agg(
        F.count_distinct(gender).alias("without_null"),
        (F.count_distinct(gender) + F.max(gender.isNull().cast("int"))).alias("with_null"),
        F.count_distinct("ProductName").alias("products"))


_PROFILE = """
scores AS (SELECT LoyaltyStatus, 1 - (row_number() OVER (ORDER BY sum(Revenue) DESC, LoyaltyStatus) - 1)
  / (count(*) OVER () - 1.0) AS score FROM labelled GROUP BY 1),
profile AS (
  SELECT i.cluster, coalesce(tc, 0) AS total_customers, coalesce(tr, 0) AS total_revenue,
    coalesce(q, 0) AS avg_product_qty, coalesce(ltv, 0) AS avg_ltv, coalesce(s, 0) AS loyalty_score
  FROM (SELECT cluster FROM summary) i LEFT JOIN (
    SELECT cluster, CAST(count(*) AS DOUBLE) AS tc, CAST(sum(Revenue) AS DOUBLE) AS tr,
      CAST(sum(ProductQuantity) AS DOUBLE) / count(*) AS q, CAST(sum(LifeTimeValue) AS DOUBLE) / count(*) AS ltv,
      avg(CAST(score AS DOUBLE)) AS s
    FROM labelled JOIN scores USING (LoyaltyStatus) GROUP BY 1) USING (cluster))"""
_AXES = ["total_customers", "total_revenue", "avg_product_qty", "avg_ltv", "loyalty_score"]


@query("A21_ratio_to_max", "SELECT cluster, " + ", ".join(
    r(f"{c} / coalesce(nullif(max({c}) OVER (), 0), 1)") + f" AS {c}" for c in _AXES) + " FROM profile", ctes=_PROFILE)
def _(wh):
    return rounded(summaries.ratio_to_max(summaries.cluster_profile(labelled(wh), K), _AXES), _AXES)


# Only the mean of scores depends on the order of addition; the other axes are exact sums and their quotients.
@query("A22_cluster_profile", f"SELECT cluster, {', '.join(_AXES[:4])}, {r('loyalty_score')} AS loyalty_score FROM profile",
       ctes=_PROFILE)
def _(wh):
    return rounded(summaries.cluster_profile(store(labelled(wh), "labelled"), K), ["loyalty_score"])


@query("A23_periods_per_market", "SELECT market, count(*) AS periods FROM series GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5")
def _(wh):
    return series.periods_per_market(series.market_series(wh))


@query("A24_extract_summary", "SELECT count(*) AS row_count, count(DISTINCT market) AS markets, min(datekey) AS "
       "first_datekey, max(datekey) AS last_datekey FROM series")
def _(wh):
    return series.extract_summary(series.market_series(wh))


@query("A25_sample_summary", "SELECT CAST(sum(Revenue) AS DOUBLE) AS total_revenue, CAST(sum(Revenue) AS DOUBLE) / count(*) "
       "AS avg_revenue, CAST(sum(ProductQuantity) AS BIGINT) AS total_quantity, count(DISTINCT ProductName) AS "
       "unique_products FROM star_recorded")
def _(wh):
    return summaries.sample_summary(star.sales_star(wh, "as_recorded"))


@query("A26_lifetime_value", "SELECT customer_id, CAST(sum(line_total) AS DOUBLE) AS lifetime_value FROM lines GROUP BY 1",
       source=True)
def _(spark, folder):
    return loading.lifetime_value(tpch.order_lines(spark, folder))


@query("A27_trailing_revenue", "SELECT customer_id, CAST(recent AS DOUBLE) AS trailing_revenue FROM customer_totals "
       "WHERE recent IS NOT NULL", source=True)
def _(spark, folder):
    return loading.trailing_revenue(tpch.order_lines(spark, folder), F.lit(tpch.last_order_date(spark, folder)))
