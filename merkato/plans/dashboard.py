"""Clusters of sales rows and everything that is shown of them, from one fit.

Rows are clustered once and stored with their label. All frames read that table: what counts countries, categories and means
is one grouped aggregate each, and what ranks or compares clusters works on frames with one row per cluster.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merkato.operators import clustering, decisions, kmeans, summaries
from merkato.operators import features as feat
from merkato.session import store


@dataclass
class Shown:
    """Which columns play which part; None where the rows have no such column."""

    revenue: str | None = "Revenue"
    quantity: str | None = "ProductQuantity"
    customers: str | None = None
    ltv: str | None = "LifeTimeValue"
    loyalty: str | None = "LoyaltyStatus"
    country: str | None = "CountryRegion"

    def present(self, columns: list[str]) -> "Shown":
        return Shown(**{part: name if name in columns else None for part, name in vars(self).items()})


@dataclass
class Dashboard:
    """Frames over labelled rows; each is computed when asked for.

    Without a revenue column revenue and value are NULL, priority follows size alone, and no cluster has most revenue.
    """

    rows: DataFrame
    #: ``(cluster, feature, category, centre)`` of the fit.
    centres: DataFrame
    k: int
    numeric: list[str]
    categorical: list[str]
    shown: Shown

    @cached_property
    def summary(self) -> DataFrame:
        """One stored row per cluster: size, revenue, customers, value, priority."""
        found = summaries.cluster_summary(self.rows, self.k, self.shown.revenue, self.shown.customers)
        if not self.shown.revenue:
            found = found.withColumn("total_revenue", F.lit(None).cast("double"))
        return store(decisions.priority_score(decisions.revenue_per_customer(found)), "cluster-summary")

    @cached_property
    def countries(self) -> DataFrame:
        """One stored row per country and cluster."""
        if not self.shown.country:
            raise ValueError("the rows have no country column")
        return store(summaries.country_clusters(self.rows, self.shown.country, self.shown.revenue), "country-clusters")

    @cached_property
    def deviations(self) -> DataFrame:
        return store(summaries.deviations(self.rows, self.numeric), "cluster-deviations")

    @cached_property
    def representatives(self) -> DataFrame:
        return store(summaries.representatives(self.rows, self.categorical), "cluster-representatives")

    def metrics(self) -> DataFrame:
        return summaries.cluster_metrics(self.rows, self.shown.revenue, self.shown.customers)

    def totals(self) -> DataFrame:
        return summaries.totals(self.rows, self.k, self.shown.revenue)

    def means(self) -> DataFrame:
        """``(cluster, feature, category, mean)`` of all columns, categories as shares."""
        return summaries.encoded_mean_rows(self.rows, self.numeric, self.categorical)

    def composition(self, top: int = 12) -> DataFrame:
        return summaries.country_composition(self.countries, self.k, top)

    def dominant(self) -> DataFrame:
        return summaries.dominant_cluster(self.countries)

    def shares(self, column: str) -> DataFrame:
        return summaries.category_shares(self.rows, column)

    def profile(self) -> DataFrame:
        """Five measures of each cluster, and each as a part of its largest value (``…_to_max``)."""
        s = self.shown
        found = store(summaries.cluster_profile(self.rows, self.k, s.revenue, s.quantity, s.ltv, s.loyalty, s.customers), "cluster-profile")
        axes = [c for c in found.columns if c != "cluster"]
        relative = summaries.ratio_to_max(found, axes)
        return found.join(relative.select("cluster", *[F.col(c).alias(f"{c}_to_max") for c in axes]), "cluster")

    def decided(self) -> DataFrame:
        """One row per cluster: priority, value, budget shares, strategy."""
        rated = decisions.value_flag(decisions.priority_band(self.summary))
        return decisions.strategy_bucket(decisions.budget(rated))

    def recommendations(self) -> DataFrame:
        return decisions.recommendations(self.summary, self.deviations, self.representatives)

    def actions(self) -> DataFrame:
        found = decisions.platform_actions(self.summary)
        return found if self.shown.revenue else found.where("kind = 'focus'")

    def potential(self) -> DataFrame:
        return decisions.potential(self.summary)


def run_dashboard(rows: DataFrame, columns: list[str] | None = None, k: int = clustering.DEFAULT_ROW_CLUSTERS,
                  shown: Shown | None = None, seed: int = kmeans.SEED, starts: int = kmeans.STARTS) -> Dashboard:
    """Cluster ``rows`` by ``columns`` (all that vary, if None) and prepare what is shown of the clusters."""
    chosen = feat.select_features(rows, columns)
    labelled, centres, _ = clustering.fitted_rows(rows, chosen, k, seed, starts)
    numeric, categorical = feat.split_types(rows, chosen)
    return Dashboard(store(labelled, "labelled-rows"), centres, k, numeric, categorical, (shown or Shown()).present(rows.columns))
