"""Windows, sorting, limits, top-k (W), and set operations and reshaping (R)."""

from __future__ import annotations

from pyspark.sql import functions as F

from merkato.operators.cube import MonthCube
from merkato.operators import decisions, series, summaries
from merkato.operators import features as feat
from merkato.plans.catalog.registry import K, labelled, query, r, rounded
from merkato.sources.tables import union_all
from merkato.sources.tpch import source

_NUMERIC = ["Revenue", "ProductQuantity", "LifeTimeValue", "Year", "Quarter", "Month"]

DEVIATIONS = "deviations AS (SELECT cluster, feature, diff, CAST(row_number() OVER (PARTITION BY cluster ORDER BY " \
    "abs(diff) DESC, pos) AS INTEGER) AS rank FROM (" + " UNION ALL ".join(
        f"SELECT cluster, '{c}' AS feature, {i} AS pos, CAST(sum({c}) AS DOUBLE) / count(*) - "
        f"(SELECT CAST(sum({c}) AS DOUBLE) / count({c}) FROM labelled) AS diff FROM labelled GROUP BY 1"
        for i, c in enumerate(_NUMERIC)) + "))"


@query("W1_previous_period", "SELECT market, year, month, CAST(prevrevenue AS DOUBLE) AS prevrevenue, prevquantity "
       "FROM (SELECT *, lag(revenue) OVER w AS prevrevenue, lag(quantity) OVER w AS prevquantity FROM monthly "
       "WINDOW w AS (PARTITION BY market ORDER BY year, month))")
def _(wh):
    metrics = MonthCube.of(wh).metrics().select("market", "year", "month", "revenue", "quantity")
    return series.with_previous(metrics).drop("revenue", "quantity")


@query("W2_recent_periods", "SELECT year, month FROM recent")
def _(wh):
    return series.recent_periods(MonthCube.of(wh).metrics())


@query("W3_last_steps", "SELECT market, year, month, CAST(revenue AS DOUBLE) AS revenue, CAST(step AS INTEGER) AS step "
       "FROM steps")
def _(wh):
    return series.last_steps(series.market_series(wh)).select("market", "year", "month", "revenue", "step")


@query("W4_latest_period", "SELECT market, datekey, CAST(revenue AS DOUBLE) AS revenue, quantity, CASE WHEN revenue < 10000 "
       "THEN 'Low' WHEN revenue < 50000 THEN 'Medium' ELSE 'High' END AS productrange FROM latest")
def _(wh):
    return series.latest_period(series.market_series(wh))


@query("W5_category_rank_score", f"SELECT LoyaltyStatus AS loyaltystatus, {r('score')} AS score FROM (SELECT LoyaltyStatus, "
       "CAST(1 - (row_number() OVER (ORDER BY sum(Revenue) DESC, LoyaltyStatus) - 1) / (count(*) OVER () - 1.0) AS DOUBLE) "
       "AS score FROM labelled GROUP BY 1)")
def _(wh):
    return rounded(feat.category_scores(labelled(wh), "LoyaltyStatus", "Revenue"), ["score"])


@query("W6_sequences", "SELECT market, CAST(step - 1 AS INTEGER) AS step, CAST(pos AS INTEGER) AS position, "
       f"{r('value', 9)} AS value FROM (" + " UNION ALL ".join(
           f"SELECT market, step, {i} AS pos, CAST({c} AS DOUBLE) AS value FROM steps"
           for i, c in enumerate(series.STEP_FEATURES)) + ")")
def _(wh):
    built = series.assemble_sequences(series.last_steps(series.market_series(wh)))
    exploded = built.select("market", F.posexplode("sequence").alias("step", "v")).select(
        "market", "step", F.posexplode("v").alias("position", "value"))
    return rounded(exploded, ["value"], 9)


@query("W7_top_deviations", f"SELECT cluster, feature, {r('diff')} AS diff, rank FROM deviations WHERE rank <= 4",
       ctes=DEVIATIONS)
def _(wh):
    return rounded(summaries.deviations(labelled(wh), _NUMERIC), ["diff"])


@query("W8_top_priority", f"SELECT cluster, {r('priority_score')} AS priority_score FROM scored ORDER BY "
       "scored.priority_score DESC, cluster LIMIT 3")
def _(wh):
    scored = decisions.priority_score(summaries.cluster_summary(labelled(wh), K))
    return rounded(decisions.top_priority(scored).select("cluster", "priority_score"), ["priority_score"])


@query("W9_top_countries", "SELECT CountryRegion AS country, count(*) AS value FROM labelled GROUP BY 1 ORDER BY 2 DESC, 1 "
       "LIMIT 12")
def _(wh):
    return summaries.top_countries(summaries.country_clusters(labelled(wh), "CountryRegion"))


@query("W9_top_categories", "SELECT ProductName AS productname, count(*) AS count FROM labelled GROUP BY 1 ORDER BY 2 DESC, 1 "
       "LIMIT 10")
def _(wh):
    return feat.top_categories(labelled(wh), "ProductName")


@query("W10_top_revenue_cluster", "SELECT cluster FROM summary ORDER BY total_revenue DESC, cluster LIMIT 1")
def _(wh):
    return decisions.top_revenue_cluster(summaries.cluster_summary(labelled(wh), K))


@query("W11_sorted_series", "SELECT market, year, month, CAST(revenue AS DOUBLE) AS revenue FROM series ORDER BY 1, 2, 3")
def _(wh):
    return series.market_series(wh).select("market", "year", "month", "revenue").orderBy("market", "year", "month")


@query("R1_distinct_periods", "SELECT DISTINCT Year AS year, Month AS month FROM dim_time")
def _(wh):
    return wh.table("DimTime").select("Year", "Month").distinct()


@query("R2_row_union", "SELECT c_nationkey AS nationkey, c_acctbal AS balance FROM customer UNION ALL "
       "SELECT s_nationkey, s_acctbal FROM supplier", source=True)
def _(spark, folder):
    return union_all([
        source(spark, folder, t).select(F.col(f"{p}_nationkey").alias("nationkey"), F.col(f"{p}_acctbal").alias("balance"))
        for t, p in (("customer", "c"), ("supplier", "s"))])


@query("R3_column_concat", "SELECT cluster, CAST(sum(Revenue) AS DOUBLE) / count(*) AS revenue, CAST(sum(ProductQuantity) AS "
       "DOUBLE) / count(*) AS productquantity, count(*) AS size FROM labelled GROUP BY 1")
def _(wh):
    rows = labelled(wh)
    sizes = rows.groupBy("cluster").agg(F.count("*").alias("size"))
    return feat.beside(summaries.cluster_means(rows, ["Revenue", "ProductQuantity"]), sizes)


@query("R4_dense_clusters", "SELECT cluster, size FROM summary")
def _(wh):
    sizes = labelled(wh).groupBy("cluster").agg(F.count("*").alias("size"))
    return summaries.dense_clusters(sizes, K)
