"""K-Means, silhouette, projection, and segment records."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merkato.functions import expressions as X
from merkato.operators import blocks as B
from merkato.operators import kmeans
from merkato.operators import features as feat
from merkato.session import store

# The default numbers of clusters.
DEFAULT_ROW_CLUSTERS, DEFAULT_MARKET_CLUSTERS = 6, 5


def kmeans_labels(df: DataFrame, vector: str, k: int, seed: int = kmeans.SEED, starts: int = kmeans.STARTS) -> DataFrame:
    """``df`` with ``cluster`` from the cheapest of several K-Means fits of an array column."""
    return kmeans.assign(df, vector, kmeans.fit(df, vector, k, seed, starts))


# ------------------------------------------------------------------ silhouette


# Blocks that stay in a task while all others pass by; labels whose sums are held at once.
STAYING, HELD_LABELS = 4, 512


def _distance_sums(batches):
    """Sums of distances by point and label, for one group of blocks after the other.

    Each group's own blocks (``side`` 0) come first and stay; the others (``side`` 1) are used and forgotten.
    """
    group, parts, own, sums = None, [], None, {}

    def made():
        for label, total in sums.items():
            yield pd.DataFrame({"id": own["id"], "other": label, "total": total})

    for batch in batches:
        for row in batch.itertuples(index=False):
            if row.group != group:
                yield from made()
                group, parts, own, sums = row.group, [], None, {}
            block = {"id": np.asarray(row.id), "w": np.asarray(row.w), "label": np.asarray(row.label)}
            block["v"] = np.asarray(row.v).reshape(len(block["id"]), -1)
            if row.side == 0:
                parts.append(block)
                continue
            if own is None:
                own = {name: np.concatenate([p[name] for p in parts]) for name in ("id", "v")}
            order = np.argsort(block["label"], kind="stable")
            weight = block["w"][order]
            labels, starts = np.unique(block["label"][order], return_index=True)
            distance = np.sqrt(B.squared_distances(own["v"], block["v"][order]))
            for label, first, last in zip(labels, starts, [*starts[1:], len(order)], strict=True):
                sums[label] = sums.get(label, 0.0) + distance[:, first:last] @ weight[first:last]
            if len(sums) > HELD_LABELS:
                yield from made()
                sums = {}
    yield from made()


def silhouette_points(df: DataFrame, vector: str, label: str, id_column: str, staying: int = STAYING) -> DataFrame:
    """Exact Euclidean silhouette ``(id, w, silhouette)`` of each distinct point.

    Every point needs its distance to all others, which is quadratic work by definition. A task holds a few blocks and
    lets all blocks pass by; it returns one sum for each of its points and each label. So what is exchanged grows with
    points × labels, and the blocks are copied once for each ``staying`` of them. For data where that is too much, ask for
    ``silhouette_squared``.
    """
    tagged = df.select(vector, id_column, F.col(label).cast("int").alias("label"))
    points = store(B.distinct_points(tagged, vector, id_column, "label"), "points")
    packed, directory = B.pack(points, F.array().cast("array<int>"), ["label"])
    blocks = directory.agg(F.max("blocks")).first()[0] or 0
    groups = -(-blocks // staying)
    fields = ["id", "w", "label", "v"]
    stay = packed.select((F.col("block") / staying).cast("int").alias("group"), F.lit(0).alias("side"), "block", *fields)
    passing = packed.select(F.explode(F.sequence(F.lit(0), F.lit(max(groups - 1, 0)))).alias("group"), F.lit(1).alias("side"), "block", *fields)
    lined = stay.unionByName(passing).repartitionByRange(max(groups, 1), "group").sortWithinPartitions("group", "side", "block")
    sums = lined.mapInPandas(_distance_sums, "id long, other int, total double").groupBy("id", "other").agg(
        F.sum("total").alias("total"))
    sizes = points.groupBy("label").agg(F.sum("w").alias("size"))
    mine = points.select("id", "label", "w")
    means = sums.join(mine, "id").join(sizes.withColumnRenamed("label", "other"), "other")
    own = F.col("other") == F.col("label")
    within = F.max(F.when(own & (F.col("size") > 1), F.col("total") / (F.col("size") - 1)))
    apart = F.min(F.when(~own, F.col("total") / F.col("size")))
    return means.groupBy("id", "w").agg(within.alias("a"), apart.alias("b")).select(
        "id", "w", F.coalesce((F.col("b") - F.col("a")) / F.nullif(F.greatest("a", "b"), F.lit(0.0)),
                              F.lit(0.0)).alias("silhouette"),
    )


def silhouette(df: DataFrame, vector: str, label: str, id_column: str) -> DataFrame:
    """One row: the mean silhouette; 0 with a single label. Noise counts as a label."""
    points = silhouette_points(df, vector, label, id_column)
    return points.agg(
        F.coalesce(F.sum(F.col("silhouette") * F.col("w")) / F.sum("w"), F.lit(0.0)).alias("silhouette"))


def silhouette_squared(df: DataFrame, vector: str, label: str) -> float:
    """Linear-time silhouette on squared distances, a different value chosen explicitly."""
    return ClusteringEvaluator(
        featuresCol=vector, predictionCol=label, distanceMeasure="squaredEuclidean"
    ).evaluate(df)


# ------------------------------------------------------------------- projection


def principal_axes(df: DataFrame, vector: str, k: int):
    """PCA of the mean-centred array column; fitted on the covariance, d×d on the driver."""
    centred = df.select("*", feat.vector_stats(df, vector).alias("_stats")).withColumn(
        "_centred", array_to_vector(F.zip_with(
            F.col(vector).cast("array<double>"), F.col("_stats.mean"), lambda x, m: x - m))
    ).drop("_stats")
    return PCA(k=k, inputCol="_centred", outputCol="_pc").fit(centred), centred


def project(df: DataFrame, vector: str, k: int = 2) -> DataFrame:
    """``df`` with ``pc`` (array of k components) and ``explained`` (their variance ratios).

    The sign of each axis is fixed so that its largest loading is positive.
    """
    model, centred = principal_axes(df, vector, k)
    loadings = model.pc.toArray()
    signs = [float(np.sign(loadings[np.argmax(np.abs(loadings[:, j])), j]) or 1.0) for j in range(k)]
    fixed = F.array(*[F.lit(s) for s in signs])
    return model.transform(centred).select(
        *df.columns, F.zip_with(vector_to_array("_pc"), fixed, lambda x, s: x * s).alias("pc"),
        F.array(*[F.lit(float(e)) for e in model.explainedVariance]).alias("explained"),
    )


# ------------------------------------------------------------- row segmentation


@dataclass
class RowEncoder:
    """How rows became vectors: numbers in the first positions, then one position for each category but a column's first."""

    numeric: list[str]
    categorical: list[str]
    deviations: list[float]
    categories: DataFrame

    @classmethod
    def fit(cls, df: DataFrame, columns: list[str]) -> "RowEncoder":
        numeric, categorical = feat.split_types(df, columns)
        found = df.agg(F.lit(0).alias("_"), *[F.stddev_samp(feat.filled_number(c)).alias(c) for c in numeric]).first()
        return cls(numeric, categorical, [float(found[c] or 0.0) for c in numeric], feat.category_table(df, categorical))

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with ``features``: sparse vectors, every position scaled to unit deviation.

        Positions are not centred: that would fill the sparse vectors, and a shift common to
        all rows changes no distance between them.
        """
        numbers = [F.struct(F.lit(i).alias("at"), (feat.filled_number(c) / F.lit(s)).alias("value"))
                   for i, (c, s) in enumerate(zip(self.numeric, self.deviations, strict=True)) if s > 0]
        placed, marks = df, []
        for i, c in enumerate(self.categorical):
            own = self.categories.where(F.col("feature") == c).select(
                F.col("category").alias("_category"), (F.col("position") + len(self.numeric)).cast("int").alias(f"_at{i}"),
                F.col("deviation").alias(f"_deviation{i}"))
            placed = placed.join(own, feat.filled_text(c) == F.col("_category"), "left").drop("_category")
            marks.append(F.when(F.col(f"_deviation{i}") > 0, F.struct(
                F.col(f"_at{i}").alias("at"), (1 / F.col(f"_deviation{i}")).alias("value"))))
        entries = F.array_compact(F.array(*numbers, *marks)) if numbers or marks else F.array().cast("array<struct<at:int,value:double>>")
        return placed.select(*df.columns, entries.alias("_entries")).select(
            *df.columns, F.struct(F.col("_entries.at").alias("at"), F.col("_entries.value").alias("value")).alias("features"))

    def centres(self, model: kmeans.Model) -> DataFrame:
        """``(cluster, feature, category, centre)`` in the columns' own units.

        Of a number that is the cluster's mean, of a category its share of the cluster; a column's first category has the rest.
        """
        spark, size = self.categories.sparkSession, len(self.numeric)
        rows = [(k, p, float(x)) for k, centre in enumerate(model.centres) for p, x in enumerate(centre)]
        numbers = [(k, c, None, float(model.centres[k, i]) * s) for k in range(len(model.centres))
                   for i, (c, s) in enumerate(zip(self.numeric, self.deviations, strict=True)) if s > 0 and i < model.centres.shape[1]]
        schema = "cluster int, feature string, category string, centre double"
        placed = spark.createDataFrame([(k, p - size, x) for k, p, x in rows if p >= size], "cluster int, position long, x double")
        shares = placed.join(self.categories, "position").select("cluster", "feature", "category", (F.col("x") * F.col("deviation")).alias("centre"))
        return spark.createDataFrame(numbers, schema).unionByName(shares)


def segment_rows(df: DataFrame, columns: list[str] | None = None, k: int = DEFAULT_ROW_CLUSTERS,
                 seed: int = kmeans.SEED, starts: int = kmeans.STARTS) -> DataFrame:
    """``df`` with a ``cluster`` for every row, from the features that vary."""
    return fitted_rows(df, columns, k, seed, starts)[0]


def fitted_rows(df: DataFrame, columns: list[str] | None = None, k: int = DEFAULT_ROW_CLUSTERS, seed: int = kmeans.SEED,
                starts: int = kmeans.STARTS) -> tuple[DataFrame, DataFrame, kmeans.Model]:
    """The rows with their ``cluster``, the centres in the columns' own units, and the model."""
    encoder = RowEncoder.fit(df, feat.select_features(df, columns))
    encoded = encoder.transform(df)
    model = kmeans.fit(encoded, "features", k, seed, starts)
    return kmeans.assign(encoded, "features", model).drop("features"), encoder.centres(model), model


# --------------------------------------------------------------- segment records


def confidence(score: Column) -> Column:
    return score.cast("decimal(5,4)")


def segment_records(metadata: DataFrame, labels: DataFrame, embeddings: DataFrame, score: Column,
                    run_date: dt.date) -> DataFrame:
    """Rows for the segment table: one per market with its label, metrics and embedding."""
    return metadata.join(labels.select("market", "cluster"), "market").join(
        embeddings.select("market", "embedding"), "market"
    ).select(
        F.col("datekey").alias("DateKey"), F.col("market").alias("MarketNameKey"),
        F.col("cluster").cast("int").alias("SegmentID"), F.col("revenue").cast("decimal(18,2)").alias("Revenue"),
        F.col("quantity").cast("long").alias("Quantity"), F.col("productrange").alias("ProductRange"),
        X.model_version(run_date).alias("ModelVersion"), F.to_json("embedding").alias("EmbeddingJSON"),
        confidence(score).alias("ConfidenceScore"),
    )
