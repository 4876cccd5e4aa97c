"""Joins (J)."""

from __future__ import annotations

from pyspark.sql import functions as F

from merkato.functions import expressions as X
from merkato.operators import features as feat
from merkato.operators import quality, series, star, summaries
from merkato.plans.catalog.registry import labelled, query, r, rounded
from merkato.session import store
from merkato.sources.tables import union_all
from merkato.sources.tpch import source

_STAR = ("CAST(Revenue AS DOUBLE) AS revenue, ProductQuantity AS productquantity, ProductName AS productname, "
         "Subcategory AS subcategory, Model AS model, ProductLine AS productline, CountryRegion AS countryregion, "
         "Gender AS gender, CAST(LifeTimeValue AS DOUBLE) AS lifetimevalue, LoyaltyStatus AS loyaltystatus, "
         "Year AS year, Quarter AS quarter, Month AS month, Season AS season")


@query("J1_star_current", f"SELECT {_STAR} FROM star_current")
def _(wh):
    return star.sales_star(wh)


@query("J2_star_as_recorded", f"SELECT {_STAR} FROM star_recorded")
def _(wh):
    return star.sales_star(wh, "as_recorded")


@query("J3_left_join_time", "SELECT d.Year AS year, d.Season AS season, count(*) AS lines FROM lineitem LEFT JOIN dim_time d "
       "ON d.DateKey = CAST(strftime(l_shipdate, '%Y%m%d') AS BIGINT) GROUP BY 1, 2")
def _(wh):
    ships = source(wh.spark, wh.folder, "lineitem").select(X.date_key(F.col("l_shipdate")).alias("DimTimeKey"))
    return star.join_time(ships, wh.table("DimTime")).groupBy("Year", "Season").agg(F.count("*").alias("lines"))


@query("J4_star_with_offers", "SELECT CountryRegion AS market, DimCustomerKey AS dimcustomerkey, CAST(DiscountPct AS DOUBLE) "
       "AS discountpct, LoyaltyStatus AS loyaltystatus, CAST(LifeTimeValue AS DOUBLE) AS lifetimevalue, "
       "Subcategory AS subcategory, ProductLine AS productline FROM star_current")
def _(wh):
    return feat.static_rows(wh)


@query("J5_orphans", """
SELECT 'active bridge' AS parent, count(*) AS orphans FROM fact_sale f LEFT JOIN (SELECT * FROM bridge WHERE IsActive) b
  USING (BrdgProductSpecialOfferKey) WHERE b.ProductSuggorateKey IS NULL
UNION ALL SELECT 'bridge', count(*) FROM fact_sale f LEFT JOIN bridge b USING (BrdgProductSpecialOfferKey)
  WHERE b.ProductSuggorateKey IS NULL
UNION ALL SELECT 'active product', count(*) FROM bridge b LEFT JOIN (SELECT * FROM dim_product WHERE IsActive) p
  USING (ProductSuggorateKey) WHERE p.Product_ID IS NULL
UNION ALL SELECT 'order date', count(*) FROM lineitem LEFT JOIN dim_time d
  ON d.DateKey = CAST(strftime(l_shipdate, '%Y%m%d') AS BIGINT) WHERE d.DateKey IS NULL""")
def _(wh):
    fact, bridge = wh.table("FactSale"), wh.table("BridgeProductSpecialOffer")
    ships = source(wh.spark, wh.folder, "lineitem").select(X.date_key(F.col("l_shipdate")).alias("day"))
    key = "BrdgProductSpecialOfferKey"
    found = {
        "active bridge": star.orphans(fact, key, star.current(bridge), key),
        "bridge": star.orphans(fact, key, bridge, key),
        "active product": star.orphans(
            bridge, "ProductSuggorateKey", star.current(wh.table("DimProduct")), "ProductSuggorateKey"),
        "order date": star.orphans(ships, "day", wh.table("DimTime"), "DateKey"),
    }
    return union_all([df.select(F.lit(name).alias("parent"), "orphans") for name, df in found.items()])


@query("J6_overlapping_validity", "SELECT count(*) AS issues FROM orders a JOIN orders b ON a.o_custkey = b.o_custkey AND "
       "a.o_orderkey < b.o_orderkey WHERE a.o_orderdate < b.o_orderdate + INTERVAL 60 DAY AND "
       "a.o_orderdate + INTERVAL 60 DAY > b.o_orderdate", source=True)
def _(spark, folder):
    spans = source(spark, folder, "orders").select(
        "o_custkey", F.col("o_orderdate").alias("ValidFrom"),
        (F.col("o_orderdate") + F.expr("INTERVAL 60 DAY")).alias("ValidTo"))
    return quality.overlapping_pairs(spans, ["o_custkey"])


@query("J7_recent_periods", "SELECT m.market, m.year, m.month, CAST(m.revenue AS DOUBLE) AS revenue FROM monthly m "
       "JOIN recent USING (year, month)")
def _(wh):
    return series.recent_metrics(wh).select("market", "year", "month", "revenue")


@query("J8_markets_with_static", "SELECT market, count(*) AS steps FROM steps SEMI JOIN static USING (market) GROUP BY 1")
def _(wh):
    steps = series.last_steps(series.market_series(wh))
    kept = series.with_static(steps, feat.static_features(feat.static_rows(wh)))
    return kept.groupBy("market").agg(F.count("*").alias("steps"))


@query("J9_in_top_countries", "SELECT CountryRegion AS country, cluster, count(*) AS row_count FROM labelled WHERE "
       "CountryRegion IN (SELECT CountryRegion FROM labelled GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 12) GROUP BY 1, 2")
def _(wh):
    by_cluster = summaries.country_clusters(labelled(wh), "CountryRegion")
    return star.in_top(by_cluster, "country", summaries.top_countries(by_cluster)).select(
        "country", "cluster", F.col("count").alias("row_count"))


@query("J10_category_score", f"SELECT cluster, {r('avg(score)')} AS score FROM labelled LEFT JOIN (SELECT LoyaltyStatus, "
       "1 - (row_number() OVER (ORDER BY sum(Revenue) DESC, LoyaltyStatus) - 1) / (count(*) OVER () - 1.0) AS score "
       "FROM labelled GROUP BY 1) USING (LoyaltyStatus) GROUP BY 1")
def _(wh):
    rows = store(labelled(wh).select("cluster", "LoyaltyStatus", "Revenue"), "labelled")
    scored = star.mapped_score(rows, "LoyaltyStatus", feat.category_scores(rows, "LoyaltyStatus", "Revenue"), "score")
    return rounded(scored.groupBy("cluster").agg(F.avg("score").alias("score")), ["score"])


@query("J11_as_of_version", "SELECT detail_id, ProductSuggorateKey AS productsuggoratekey, SpecialOfferSuggorateKey AS "
       "specialoffersuggoratekey FROM keyed_lines")
def _(wh):
    return wh.lines().select("detail_id", "ProductSuggorateKey", "SpecialOfferSuggorateKey")


# Every order as a version of its customer that lasts 400 days: far more than until the next one.
_OVERLAPPING = """
SELECT l_orderkey, l_linenumber, CASE WHEN l_shipdate < v.o_orderdate + INTERVAL 400 DAY THEN v.last_order END AS last_order
FROM (SELECT l_orderkey, l_linenumber, l_shipdate, o_custkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey) e
ASOF LEFT JOIN (SELECT o_custkey, o_orderdate, max(o_orderkey) AS last_order FROM orders GROUP BY 1, 2) v
  ON e.o_custkey = v.o_custkey AND e.l_shipdate >= v.o_orderdate"""


def _overlapping(spark, folder):
    orders = source(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", F.col("o_orderdate").cast("timestamp_ntz").alias("ValidFrom"))
    versions = orders.select("o_custkey", F.col("o_orderkey").alias("last_order"), "ValidFrom",
                             (F.col("ValidFrom") + F.expr("INTERVAL 400 DAY")).alias("ValidTo"))
    ships = source(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_shipdate").cast("timestamp_ntz").alias("shipped"))
    return ships.join(orders, F.col("l_orderkey") == F.col("o_orderkey")), versions


@query("J11_as_of_overlaps", _OVERLAPPING, source=True)
def _(spark, folder):
    rows, versions = _overlapping(spark, folder)
    return star.as_of_lookup(rows, versions, "o_custkey", "o_custkey", "shipped", "last_order").select(
        "l_orderkey", "l_linenumber", "last_order")


@query("J11_as_of_merge", _OVERLAPPING, source=True)
def _(spark, folder):
    rows, versions = _overlapping(spark, folder)
    return star.as_of_lookup(rows, versions, "o_custkey", "o_custkey", "shipped", "last_order", joined=0).select(
        "l_orderkey", "l_linenumber", "last_order")
