"""Summaries of labelled rows: clusters, segments, countries, categories, profiles.

``rows`` carry an integer ``cluster``. Every summary is a grouped aggregate with map-side
combining, so a cluster with most of the rows costs no more than the others. Frames with
one row per cluster have k rows, and only those use windows without partition keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from merkato.functions import expressions as X
from merkato.operators import features as feat
from merkato.operators import star
from merkato.session import store
from merkato.sources.tables import union_all


def whole():
    """The window over a whole frame; used only where the frame has one row per cluster."""
    return Window.partitionBy()



def number(column: str) -> Column:
    return F.col(column).cast("double")


def dense_clusters(summary: DataFrame, k: int) -> DataFrame:
    """One row for each cluster 0…k−1; numbers of absent clusters become 0."""
    ids = summary.sparkSession.range(k).select(F.col("id").cast("int").alias("cluster"))
    return ids.join(summary, "cluster", "left").na.fill(0)


def cluster_summary(rows: DataFrame, k: int, revenue: str | None = "Revenue",
                    customers: str | None = None) -> DataFrame:
    """Size, revenue and customers per cluster; without a customers column a row is a customer."""
    aggregates = [F.count("*").alias("size")]
    if revenue:
        aggregates += [number_sum(revenue).alias("total_revenue"), mean(revenue).alias("avg_revenue")]
    if customers:
        aggregates += [number_sum(customers).alias("total_customers"), mean(customers).alias("avg_customers")]
    summary = dense_clusters(rows.groupBy(F.col("cluster").cast("int").alias("cluster")).agg(*aggregates), k)
    if not customers:
        summary = summary.select(
            "*", F.col("size").cast("double").alias("total_customers"),
            F.col("size").cast("double").alias("avg_customers"),
        )
    return summary


def number_sum(column: str) -> Column:
    return F.sum(column).cast("double")


def mean(column: str) -> Column:
    """Sum divided by count, exact for decimals up to the final division."""
    return X.ratio(F.sum(column), F.count(column))


def cluster_metrics(rows: DataFrame, revenue: str | None = "Revenue", customers: str | None = None) -> DataFrame:
    """Rounded display metrics of the clusters that occur."""
    aggregates = [F.count("*").alias("points")]
    if revenue:
        aggregates += [number_sum(revenue).alias("_revenue"), mean(revenue).alias("_mean")]
    if customers:
        aggregates.append(number_sum(customers).alias("_customers"))
    grouped = rows.groupBy("cluster").agg(*aggregates)
    columns = [
        F.col("cluster"), F.col("points"),
        X.half_even(F.col("points") / F.sum("points").over(whole()) * 100, 1).alias("pct_of_total"),
    ]
    if revenue:
        columns += [
            X.half_even(F.col("_revenue"), 0).cast("long").alias("total_revenue"),
            X.half_even(F.col("_mean"), 0).cast("long").alias("avg_revenue"),
        ]
    if customers:
        columns.append(F.col("_customers").alias("total_customers"))
    if revenue and customers:
        per_customer = X.half_even(X.ratio(F.col("_revenue"), F.col("_customers")), 0)
        columns.append(F.coalesce(per_customer, F.lit(0.0)).cast("long").alias("revenue_per_customer"))
    return grouped.select(*columns)


def totals(rows: DataFrame, k: int, revenue: str | None = "Revenue") -> DataFrame:
    return rows.agg(
        F.count("*").alias("points"), F.lit(k).alias("clusters"),
        X.half_even(F.count("*") / F.lit(k), 1).alias("avg_points_per_cluster"),
        *([number_sum(revenue).alias("total_revenue")] if revenue else []),
    )


def segment_statistics(segments: DataFrame, segment: str = "segment") -> DataFrame:
    """Count, and mean, sum and sample deviation of revenue and quantity, to 2 decimals."""
    measures = []
    for c in ("revenue", "quantity"):
        measures += [
            X.half_even(mean(c), 2).alias(f"{c}_mean"), X.half_even(number_sum(c), 2).alias(f"{c}_sum"),
            X.half_even(F.stddev_samp(number(c)), 2).alias(f"{c}_std"),
        ]
    return segments.groupBy(segment).agg(F.count("*").alias("markets"), *measures)


def segment_distribution(segments: DataFrame, segment: str = "segment") -> DataFrame:
    return segments.groupBy(segment).agg(F.count("*").alias("markets")).orderBy(segment)


# ------------------------------------------------------------------- countries


def country_clusters(rows: DataFrame, country: str, revenue: str | None = "Revenue") -> DataFrame:
    total = number_sum(revenue) if revenue else F.lit(0.0)
    return rows.groupBy(F.col(country).alias("country"), "cluster").agg(
        F.count("*").alias("count"), total.alias("revenue")
    )


def country_totals(by_cluster: DataFrame, value: str = "count") -> DataFrame:
    return by_cluster.groupBy("country").agg(F.sum(value).alias("value"))


def dominant_cluster(by_cluster: DataFrame) -> DataFrame:
    """The most frequent cluster of each country; on a tie the lowest."""
    rank = F.struct(F.col("count"), -F.col("cluster"))
    return by_cluster.groupBy("country").agg(F.max_by("cluster", rank).alias("dominant_cluster"))


def top_countries(by_cluster: DataFrame, top: int = 12) -> DataFrame:
    return country_totals(by_cluster).orderBy(F.col("value").desc(), "country").limit(top)


def country_composition(by_cluster: DataFrame, k: int, top: int = 12) -> DataFrame:
    """Counts per cluster as columns ``0``…``k−1`` for the countries with most rows."""
    chosen = star.in_top(by_cluster, "country", top_countries(by_cluster, top))
    return chosen.groupBy("country").pivot("cluster", list(range(k))).agg(F.sum("count")).na.fill(0)


# ------------------------------------------------------------------ categories


def category_counts(rows: DataFrame, column: str) -> DataFrame:
    return rows.groupBy(column).agg(F.count("*").alias("count"))


def category_counts_by_cluster(rows: DataFrame, column: str) -> DataFrame:
    return rows.groupBy("cluster", column).agg(F.count("*").alias("count"))


def category_shares(rows: DataFrame, column: str) -> DataFrame:
    """Share of each category in its cluster, in percent of all the cluster's rows."""
    counts = category_counts_by_cluster(rows, column)
    sizes = counts.groupBy("cluster").agg(F.sum("count").alias("_size"))
    return counts.join(sizes, "cluster").select(
        "cluster", column, "count", (F.lit(100.0) * F.col("count") / F.col("_size")).alias("share_pct")
    )


def representatives(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Most frequent category per cluster and column with its share; on a tie the first in order."""
    long = feat.fill_unknown(rows.select(F.col("cluster").cast("string"), *columns)).unpivot(
        ["cluster"], columns, "feature", "value"
    )
    counts = long.groupBy("cluster", "feature", "value").agg(F.count("*").alias("n"))
    best = F.min(F.struct((-F.col("n")).alias("rank"), F.col("value")))
    return counts.groupBy("cluster", "feature").agg(best.alias("b"), F.sum("n").alias("size")).select(
        F.col("cluster").cast("int").alias("cluster"), "feature", F.col("b.value").alias("value"),
        (F.lit(-100.0) * F.col("b.rank") / F.col("size")).alias("share_pct"),
    )


# ---------------------------------------------------------------------- means


def global_means(rows: DataFrame, columns: list[str]) -> DataFrame:
    return rows.agg(*[mean(c).alias(c) for c in columns])


def cluster_means(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Means per cluster: the cluster centres in original units once K-Means has converged."""
    return rows.groupBy("cluster").agg(*[mean(c).alias(c) for c in columns])


def deviations(rows: DataFrame, columns: list[str], top: int = 4) -> DataFrame:
    """The features whose cluster centre lies farthest from the overall mean.

    Centres count NULL as 0, as clustering does; the overall mean ignores it. Both come
    from one pass: the overall mean is put together from the per-cluster sums.
    """
    parts = rows.groupBy("cluster").agg(F.count("*").alias("_rows"), *[
        e for c in columns for e in (F.sum(c).alias(f"s_{c}"), F.count(c).alias(f"n_{c}"))
    ])
    diffs = parts.select("cluster", *[
        (F.coalesce(X.ratio(F.col(f"s_{c}"), F.col("_rows")), F.lit(0.0))
         - X.ratio(F.sum(f"s_{c}").over(whole()), F.sum(f"n_{c}").over(whole()))).alias(c)
        for c in columns
    ])
    position = F.array_position(F.array(*[F.lit(c) for c in columns]), F.col("feature"))
    order = Window.partitionBy("cluster").orderBy(F.abs("diff").desc_nulls_last(), position)
    return diffs.unpivot("cluster", columns, "feature", "diff").select(
        "*", F.row_number().over(order).alias("rank")
    ).where(F.col("rank") <= top)


def encoded_means(rows: DataFrame, numeric: list[str], categorical: list[str]) -> DataFrame:
    """Means of numeric and one-hot columns per cluster; gaps count as 0 and as the unknown category.

    One column for every category: for few categories. ``encoded_mean_rows`` takes any number.
    """
    filled = rows.select(
        "cluster", *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in numeric],
        *[F.coalesce(F.col(c).cast("string"), F.lit(X.UNKNOWN)).alias(c) for c in categorical])
    encoded = feat.one_hot_columns(filled, categorical)
    return cluster_means(encoded, [c for c in encoded.columns if c != "cluster"])


def encoded_mean_rows(rows: DataFrame, numeric: list[str], categorical: list[str]) -> DataFrame:
    """``(cluster, feature, category, mean)``: the same means as rows, without those that are 0.

    A one-hot column's mean is the category's share of the cluster, so rows are counted and never encoded. Each
    column's first category has no row.
    """
    sizes = rows.groupBy("cluster").agg(F.count("*").alias("_size"), *[
        F.sum(feat.filled_number(c)).alias(c) for c in numeric])
    parts = [sizes.select("cluster", F.lit(c).alias("feature"), F.lit(None).cast("string").alias("category"),
                          (F.col(c) / F.col("_size")).alias("mean")) for c in numeric]
    for c in categorical:
        counted = store(rows.groupBy("cluster", feat.filled_text(c).alias("category")).agg(F.count("*").alias("_n")), "category-counts")
        first = counted.agg(F.min("category")).scalar()
        # Clusters are few and categories many: the sizes are joined to the counts.
        parts.append(counted.where(F.col("category") > first).join(
            sizes.select(F.col("cluster").alias("_of"), "_size"), F.col("cluster").eqNullSafe(F.col("_of"))).select(
            "cluster", F.lit(c).alias("feature"), "category", (F.col("_n") / F.col("_size")).alias("mean")))
    return union_all(parts)


# --------------------------------------------------------------------- profile


def cluster_profile(rows: DataFrame, k: int, revenue: str | None = "Revenue", quantity: str | None = "ProductQuantity",
                    ltv: str | None = "LifeTimeValue", loyalty: str | None = "LoyaltyStatus",
                    customers: str | None = None) -> DataFrame:
    """The five profile measures of each cluster; a measure without its column is left out."""
    if loyalty:
        scores = feat.category_scores(rows, loyalty, revenue, "_loyalty")
        rows = star.mapped_score(rows, loyalty, scores, "_loyalty")
    aggregates = [
        (number_sum(customers) if customers else F.count("*").cast("double")).alias("total_customers"),
        (number_sum(revenue) if revenue else F.lit(0.0)).alias("total_revenue"),
    ]
    if quantity:
        aggregates.append(mean(quantity).alias("avg_product_qty"))
    if ltv:
        value = F.col(ltv)
        if dict(rows.dtypes)[ltv] == "string":
            value = X.lenient_number(value)
        aggregates.append(X.ratio(F.sum(value), F.count(value)).alias("avg_ltv"))
    if loyalty:
        aggregates.append(F.avg("_loyalty").alias("loyalty_score"))
    return dense_clusters(rows.groupBy(F.col("cluster").cast("int").alias("cluster")).agg(*aggregates), k)


def ratio_to_max(profile: DataFrame, columns: list[str]) -> DataFrame:
    """Each measure divided by its maximum; a maximum of 0 counts as 1."""
    return profile.select("cluster", *[
        (F.col(c) / F.coalesce(F.nullif(F.max(c).over(whole()), F.lit(0)), F.lit(1)).cast("double")).alias(c)
        for c in columns
    ])


def sample_summary(rows: DataFrame) -> DataFrame:
    return rows.agg(
        number_sum("Revenue").alias("total_revenue"), mean("Revenue").alias("avg_revenue"),
        F.sum("ProductQuantity").alias("total_quantity"), F.count_distinct("ProductName").alias("unique_products"),
    )
