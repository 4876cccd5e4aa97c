"""Decision support on cluster summaries (one row per cluster)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merkato.functions import expressions as X
from merkato.operators.summaries import whole

# Priority bands, quartiles, budget shares, strategy names.
HIGH_PRIORITY, MEDIUM_PRIORITY = 0.7, 0.4
FLEXIBLE_SHARE, FLEXIBLE_OF_TOTAL = 0.7, 0.8
NICHE_SIZE, MASS_SIZE = 0.25, 0.4
NICHE_VIP = "Niche VIP — Retain & Upsell"
HIGH_VALUE = "High-Value — Scale & Retain"
MASS_LOW_VALUE = "Mass Low-Value — Efficiency & Acquisition"
UNDERPERFORMING = "Underperforming — Investigate & Test"
LARGE = "Large — Growth & Monetize"
SMALL = "Small — Test/Research"
BALANCED = "Balanced"


def revenue_per_customer(summary: DataFrame) -> DataFrame:
    return summary.select("*", X.ratio(F.col("total_revenue"), F.col("total_customers")).alias("revenue_per_customer"))


def _to_max(column: str) -> Column:
    largest = F.max(column).over(whole())
    return F.col(column).cast("double") / F.coalesce(F.nullif(largest, F.lit(0)), F.lit(1)).cast("double")


def priority_score(summary: DataFrame) -> DataFrame:
    """Half relative size, half relative revenue; size alone without revenue."""
    score = _to_max("size")
    if "total_revenue" in summary.columns:
        both = 0.5 * score + 0.5 * _to_max("total_revenue")
        score = F.when(F.count("total_revenue").over(whole()) > 0, both).otherwise(score)
    return summary.select("*", score.alias("priority_score"))


def priority_band(scored: DataFrame) -> DataFrame:
    score = F.col("priority_score")
    return scored.select("*", F.when(score >= HIGH_PRIORITY, "High").when(
        score >= MEDIUM_PRIORITY, "Medium").otherwise("Low").alias("priority_band"))


def quartile(column: str, share: float) -> Column:
    return F.percentile(F.col(column).cast("double"), F.lit(share)).over(whole())


def value_flag(summary: DataFrame) -> DataFrame:
    """``high`` from the upper quartile of revenue per customer, ``low`` up to the lower one."""
    value = F.col("revenue_per_customer")
    flag = F.when(value >= quartile("revenue_per_customer", 0.75), "high").when(
        value <= quartile("revenue_per_customer", 0.25), "low")
    return summary.select("*", flag.alias("value_flag"))


def drivers(deviations: DataFrame) -> DataFrame:
    """The ranked deviations of each cluster as one list of at most four entries."""
    listed = F.sort_array(F.collect_list(F.struct("rank", "feature", "diff")))
    return deviations.groupBy("cluster").agg(listed.alias("drivers"))


def recommendations(summary: DataFrame, deviations: DataFrame, representatives: DataFrame) -> DataFrame:
    """Rows ``(cluster, kind, text)``: priority band, value flag, drivers, category indicators."""
    rated = value_flag(priority_band(summary))
    as_text = F.transform("drivers", lambda d: F.format_string("%s (%+.2f)", d["feature"], d["diff"]))
    named = F.sort_array(F.collect_list(F.format_string("%s=%s (%.0f%%)", "feature", "value", "share_pct")))
    base = rated.select("cluster", F.explode(F.array(
        F.struct(F.lit("priority").alias("kind"), F.col("priority_band").alias("text")),
        F.struct(F.lit("value").alias("kind"), F.col("value_flag").alias("text")),
    )).alias("r")).select("cluster", "r.*").where("text IS NOT NULL")
    return base.unionByName(
        drivers(deviations).select("cluster", F.lit("drivers").alias("kind"), F.array_join(as_text, ", ").alias("text"))
    ).unionByName(
        representatives.groupBy("cluster").agg(F.array_join(named, ", ").alias("text")).select(
            "cluster", F.lit("categories").alias("kind"), "text")
    )


def top_priority(scored: DataFrame, top: int = 3) -> DataFrame:
    return scored.orderBy(F.col("priority_score").desc(), "cluster").limit(top)


def top_revenue_cluster(summary: DataFrame) -> DataFrame:
    """The cluster with most revenue; on a tie the lowest."""
    return summary.agg(F.max_by("cluster", F.struct(F.col("total_revenue"), -F.col("cluster"))).alias("cluster"))


def platform_actions(scored: DataFrame) -> DataFrame:
    """Rows ``(kind, position, cluster)``: the clusters to focus on and the top revenue cluster."""
    order = F.array_sort(F.collect_list(F.struct((-F.col("priority_score")).alias("s"), "cluster")))
    best = F.max_by("cluster", F.struct(F.col("total_revenue"), -F.col("cluster")))
    both = scored.agg(F.transform(order, lambda e: e["cluster"]).alias("o"), best.alias("b"))
    return both.select(F.explode(F.concat(
        F.transform(F.slice("o", 1, 3), lambda c, i: F.struct(
            F.lit("focus").alias("kind"), (i + 1).cast("int").alias("position"), c.alias("cluster"))),
        F.array(F.struct(F.lit("top_revenue").alias("kind"), F.lit(1).alias("position"), F.col("b").alias("cluster"))),
    )).alias("a")).select("a.*")


def budget(scored: DataFrame) -> DataFrame:
    """Share of the flexible and of the total budget, in percent, by priority."""
    total = F.sum("priority_score").over(whole())
    weight = F.col("priority_score") / F.when(total > 0, total).otherwise(1.0)
    flexible = X.half_even(weight * 100 * FLEXIBLE_SHARE, 1)
    return scored.select(
        "*", weight.alias("priority_weight"), flexible.alias("pct_of_flexible_budget"),
        (flexible * FLEXIBLE_OF_TOTAL).alias("pct_of_total_budget"),
    )


def strategy_bucket(summary: DataFrame) -> DataFrame:
    size, value = F.col("size"), F.col("revenue_per_customer")
    relative = size / F.greatest(F.max("size").over(whole()), F.lit(1))
    by_size = (
        F.when(size >= quartile("size", 0.75), LARGE).when(size <= quartile("size", 0.25), SMALL).otherwise(BALANCED)
    )
    bucket = (
        F.when(value >= quartile("revenue_per_customer", 0.75),
               F.when(relative < NICHE_SIZE, NICHE_VIP).otherwise(HIGH_VALUE))
        .when(value <= quartile("revenue_per_customer", 0.25),
              F.when(relative > MASS_SIZE, MASS_LOW_VALUE).otherwise(UNDERPERFORMING))
        .otherwise(by_size)
    )
    return summary.select("*", bucket.alias("strategy_bucket"))


def potential(summary: DataFrame) -> DataFrame:
    """Clusters in the top fifth (``high``) or bottom fifth (``low``) by revenue."""
    revenue = F.col("total_revenue")
    marked = summary.select("*", F.when(revenue > quartile("total_revenue", 0.8), "high").when(
        revenue < quartile("total_revenue", 0.2), "low").alias("potential"))
    return marked.where(F.col("potential").isNotNull())
