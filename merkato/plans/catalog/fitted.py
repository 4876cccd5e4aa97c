"""The dashboard over fitted clusters (A, W, D): what must hold of its frames, whatever the clusters are."""

from __future__ import annotations

from pyspark.sql import functions as F

from merkato.operators import clustering, star
from merkato.plans.catalog.registry import query, r, rounded
from merkato.plans.dashboard import run_dashboard
from merkato.session import store

_COLUMNS = ["Revenue", "ProductQuantity", "LoyaltyStatus", "ProductLine"]
_K = clustering.DEFAULT_ROW_CLUSTERS


def _dashboard(wh):
    return run_dashboard(store(star.sales_star(wh), "sales-rows"), _COLUMNS, starts=3)


@query("A6_fitted_summary", f"SELECT CAST({_K} AS BIGINT) AS clusters, count(*) AS points, CAST(sum(Revenue) AS DOUBLE) AS revenue, "
       f"true AS as_totals, true AS as_metrics FROM star_current")
def _(wh):
    board = _dashboard(wh)
    totals, metrics = board.totals(), board.metrics()
    same = lambda mine, theirs: F.abs(F.col(mine) - theirs.scalar()) < 0.01
    found = board.summary.agg(F.count("*").alias("clusters"), F.sum("size").alias("points"), F.sum(
        F.col("total_revenue").cast("decimal(28,2)")).cast("double").alias("revenue"))
    return found.select(
        "clusters", "points", "revenue",
        (same("points", totals.select("points")) & same("revenue", totals.select("total_revenue"))).alias("as_totals"),
        (same("points", metrics.agg(F.sum("points"))) & (F.abs(metrics.agg(F.sum("pct_of_total")).scalar() - 100) < 1)).alias("as_metrics"))


@query("A14_fitted_countries", "SELECT CountryRegion AS country, count(*) AS points, true AS dominant_is_largest FROM star_current GROUP BY 1 "
       "ORDER BY 2 DESC, 1 LIMIT 12")
def _(wh):
    board = _dashboard(wh)
    counts = [F.col(f"`{i}`") for i in range(_K)]
    beside = board.composition().join(board.dominant(), "country")
    own = F.element_at(F.array(*counts), F.col("dominant_cluster") + 1)
    return beside.select("country", sum(counts[1:], counts[0]).alias("points"), (own == F.greatest(*counts)).alias("dominant_is_largest"))


@query("A16_fitted_shares", f"SELECT LoyaltyStatus AS loyaltystatus, count(*) AS count, {r('100.0 * count(*) / CAST(sum(count(*)) OVER () AS DOUBLE)')} "
       "AS share_pct FROM star_current GROUP BY 1")
def _(wh):
    board = _dashboard(wh)
    shares = board.shares("LoyaltyStatus").join(board.summary.select("cluster", "size"), "cluster")
    found = shares.groupBy("LoyaltyStatus").agg(F.sum("count").alias("count"), F.sum(F.col("share_pct") * F.col("size")).alias("weighed"))
    points = board.totals().select("points").scalar()
    return rounded(found.select("LoyaltyStatus", "count", (F.col("weighed") / points).alias("share_pct")), ["share_pct"])


@query("A22_fitted_profile", f"SELECT CAST(count(*) AS DOUBLE) AS customers, CAST(sum(Revenue) AS DOUBLE) AS revenue, "
       f"{r('CAST(sum(ProductQuantity) AS DOUBLE) / count(*)', 4)} AS quantity, {r('CAST(sum(LifeTimeValue) AS DOUBLE) / count(*)', 2)} AS ltv, "
       "true AS largest_are_one FROM star_current")
def _(wh):
    size, relative = F.col("total_customers"), ["total_customers", "total_revenue", "avg_product_qty", "avg_ltv", "loyalty_score"]
    largest = F.lit(True)
    for axis in relative:
        largest = largest & (F.max(f"{axis}_to_max") == 1)
    found = _dashboard(wh).profile().agg(
        F.sum(size).alias("customers"), F.sum(F.col("total_revenue").cast("decimal(28,2)")).cast("double").alias("revenue"),
        (F.sum(F.col("avg_product_qty") * size) / F.sum(size)).alias("quantity"), (F.sum(F.col("avg_ltv") * size) / F.sum(size)).alias("ltv"),
        largest.alias("largest_are_one"))
    return rounded(rounded(found, ["quantity"], 4), ["ltv"], 2)


@query("D8_fitted_decisions", f"SELECT CAST({_K} AS BIGINT) AS clusters, 1.0::DOUBLE AS weights, true AS budgets_add_up, true AS all_recommended, "
       "true AS focus_on_first, count(*) > 0 AS most_revenue_first FROM star_current")
def _(wh):
    board = _dashboard(wh)
    decided = board.decided().agg(
        F.count("*").alias("clusters"), F.sum("priority_weight").alias("weights"),
        (F.abs(F.sum("pct_of_flexible_budget") - 70) < 0.5).alias("budgets_add_up"), F.max_by("cluster", "priority_score").alias("first"),
        F.max("total_revenue").alias("most"), F.count_if(F.col("strategy_bucket").isNull() | F.col("priority_band").isNull()).alias("undecided"))
    kinds = board.recommendations().groupBy("kind").agg(F.count_distinct("cluster").alias("n"))
    whole = kinds.agg(F.count_if((F.col("n") == _K) & F.col("kind").isin("priority", "drivers", "categories")))
    actions = board.actions().join(board.summary.select("cluster", "total_revenue"), "cluster")
    focus = actions.agg(F.max(F.when((F.col("kind") == "focus") & (F.col("position") == 1), F.col("cluster"))))
    top = actions.agg(F.max(F.when(F.col("kind") == "top_revenue", F.col("total_revenue"))))
    return rounded(decided.select(
        "clusters", "weights", "budgets_add_up", ((whole.scalar() == 3) & (F.col("undecided") == 0)).alias("all_recommended"),
        (focus.scalar() == F.col("first")).alias("focus_on_first"), (top.scalar() == F.col("most")).alias("most_revenue_first")), ["weights"])
