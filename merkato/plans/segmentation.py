"""Market segmentation from the warehouse to the stored segments."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merkato.functions.ordering import number_rows
from merkato.operators import clustering, density, encoder, kmeans, series, summaries
from merkato.operators import features as feat
from merkato.session import store
from merkato.sources.tables import require_rows, upsert_segments

METHODS = ("kmeans", "dbscan")


@dataclass
class Settings:
    lookback: int = 12
    sequence_length: int = 6
    clusters: int = clustering.DEFAULT_MARKET_CLUSTERS
    method: str = "kmeans"
    seed: int = kmeans.SEED
    share_basis: str = "customer"
    grain: str = "month"


@dataclass
class Segmentation:
    segments: DataFrame
    vectors: DataFrame
    records: DataFrame
    #: Mean silhouette of the segments, and the distance it is measured by.
    score: float
    score_form: str = "euclidean"

    def statistics(self) -> DataFrame:
        """One row per segment: markets, and mean, sum and deviation of revenue and quantity."""
        return summaries.segment_statistics(self.segments)

    def distribution(self) -> DataFrame:
        return summaries.segment_distribution(self.segments)

    def projection(self) -> DataFrame:
        """``(market, segment, revenue, pc1, pc2, explained1, explained2)``: the clustered vectors on their two widest axes."""
        placed = clustering.project(self.vectors.select("market", "vector"), "vector", 2).select(
            "market", *[F.col(c)[i].alias(f"{c}{i + 1}") for c in ("pc", "explained") for i in range(2)])
        return self.segments.select("market", "segment", "revenue").join(placed, "market")


def market_sequences(market_series: DataFrame, static: DataFrame, settings: Settings) -> DataFrame:
    """Standardised sequences of the markets with enough periods and static features."""
    steps = series.with_static(
        series.last_steps(market_series, settings.sequence_length, settings.grain), static)
    return series.assemble_sequences(feat.scale_steps(steps, series.STEP_FEATURES))


def cluster_vectors(vectors: DataFrame, settings: Settings) -> DataFrame:
    """``(market, cluster)`` of standardised hybrid vectors."""
    scaled = feat.standardize_vectors(vectors, "vector")
    if settings.method == "kmeans":
        return clustering.kmeans_labels(scaled.select("market", "vector"), "vector", settings.clusters, settings.seed)
    if settings.method == "dbscan":
        # Clusters are numbered in market order, so the id follows the market name.
        numbered = number_rows(scaled, [F.col("market")], "id", 0)
        return numbered.join(density.dbscan(numbered, "vector", "id"), "id").select("market", "vector", "cluster")
    raise ValueError(f"method must be one of {METHODS}")


def run_segmentation(wh, settings: Settings | None = None, run_date: dt.date | None = None,
                     target: str | None = None) -> Segmentation:
    """Extract, embed, cluster and score the markets; with ``target`` also upsert the segments there."""
    settings = settings or Settings()
    market_series = store(series.market_series(wh, settings.lookback, settings.grain), "series")
    require_rows(market_series, "no sales in the look-back periods: is FactSale loaded?")
    static = store(feat.static_features(feat.static_rows(wh), settings.share_basis), "static")
    sequences = store(market_sequences(market_series, static, settings), "sequences")
    require_rows(sequences, f"no market has {settings.sequence_length} periods and static features")
    embedded = encoder.principal_embedding(sequences)
    vectors = store(feat.hybrid_vectors(embedded, static), "vectors")
    labelled = store(cluster_vectors(vectors, settings), "labels")
    numbered = number_rows(labelled, [F.col("market")], "id", 0)
    score = clustering.silhouette(numbered, "vector", "cluster", "id").first()[0]
    metadata = series.latest_period(market_series, settings.grain)
    records = clustering.segment_records(
        metadata, labelled, vectors, F.lit(score), run_date or dt.date.today())
    if target:
        upsert_segments(wh.spark, target, records, F.current_timestamp().cast("timestamp_ntz"))
    segments = metadata.join(labelled.select("market", F.col("cluster").alias("segment")), "market").select(
        "market", "segment", "revenue", "quantity", "productrange")
    return Segmentation(segments, vectors, records, score)
