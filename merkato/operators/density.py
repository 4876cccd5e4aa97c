"""DBSCAN on Spark: grid cells, bounded block pairs, star-contraction components."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from merkato.functions.ordering import number_rows
from merkato.operators import blocks as B
from merkato.session import store

# Default radius, neighbours and noise label.
EPS, MIN_SAMPLES, NOISE = 0.5, 2, -1


def _pairs(points: DataFrame, eps: float, extra: list[str]) -> DataFrame:
    """Block pairs that can hold points within ``eps``.

    The grid has side ``eps`` on the axes with most variance. Leaving out axes only
    shortens distances, so two points within ``eps`` are always in adjoining cells.
    """
    axes = B.widest_axes(points)
    cell = F.array(*[F.floor(F.col("v")[i] / F.lit(eps)) for i in axes])
    packed, directory = B.pack(points, cell, extra)
    return B.paired_blocks(packed, B.neighbour_pairs(directory, len(axes)))


def _neighbour_sums(eps: float):
    def run(batches):
        for same, a, b in B.block_pairs(batches):
            near = B.squared_distances(a["v"], b["v"], eps * eps) <= eps * eps
            ids, sums = [a["id"]], [near @ b["w"]]
            if not same:
                ids.append(b["id"])
                sums.append(near.T @ a["w"])
            yield pd.DataFrame({"id": np.concatenate(ids), "n": np.concatenate(sums)})

    return run


def neighbour_counts(df: DataFrame, vector: str, id_column: str, eps: float = EPS) -> DataFrame:
    """``(id, neighbours)``: points within ``eps``, the point itself included."""
    points = store(B.distinct_points(df, vector, id_column), "points")
    counted = _count(points, eps)
    return _expand(df, vector, id_column, points.join(counted, "id").select("v", "neighbours"))


def _count(points: DataFrame, eps: float) -> DataFrame:
    sums = _pairs(points, eps, []).mapInPandas(_neighbour_sums(eps), "id long, n long")
    return sums.groupBy("id").agg(F.sum("n").alias("neighbours"))


def _expand(df: DataFrame, vector: str, id_column: str, per_vector: DataFrame) -> DataFrame:
    """Give every copy of a vector its result."""
    keyed = df.select(F.col(id_column).alias("id"), F.transform(
        F.col(vector), lambda x: x.cast("double") + F.lit(0.0)).alias("v"))
    return keyed.join(per_vector, "v").drop("v")


def _edges(eps: float):
    """Core–core edges reduced to a spanning forest, and every core neighbour of a border point.

    A border point has fewer neighbours than ``min_samples``, so its edges are few.
    """
    def forest(near: np.ndarray) -> tuple[list[int], list[int]]:
        child, root = [], []
        unseen = np.ones(len(near), dtype=bool)
        for start in range(len(near)):
            if not unseen[start]:
                continue
            unseen[start] = False
            frontier = np.array([start])
            while len(frontier):
                reached = near[frontier].any(axis=0) & unseen
                unseen &= ~reached
                frontier = np.flatnonzero(reached)
                child += frontier.tolist()
                root += [start] * len(frontier)
        return child, root

    def run(batches):
        for same, a, b in B.block_pairs(batches):
            near = B.squared_distances(a["v"], b["v"], eps * eps) <= eps * eps
            if not same:  # what lies within one block comes with that block's own pair
                across, near = near, np.zeros((len(a["id"]) + len(b["id"]),) * 2, dtype=bool)
                near[:len(across), len(across):], near[len(across):, :len(across)] = across, across.T
                a = {name: np.concatenate([a[name], b[name]]) for name in ("id", "core")}
            core, ids = a["core"].astype(bool), a["id"]
            at = np.flatnonzero(core)
            child, root = forest(near[np.ix_(at, at)])
            border, by = np.nonzero(near & ~core[:, None] & core[None, :])
            yield pd.DataFrame({
                "src": np.concatenate([ids[at[child]], ids[border]]).astype("int64"),
                "dst": np.concatenate([ids[at[root]], ids[by]]).astype("int64"),
                "core": np.concatenate([np.ones(len(child), bool), np.zeros(len(border), bool)]),
            })

    return run


def components(edges: DataFrame) -> DataFrame:
    """``(id, root)`` with the lowest id of each component, for vertices that have edges.

    Alternates the large-star and small-star steps of Kiveris et al. (2014) until a round
    changes nothing. Each round is written to the shared folder, so neither the plan nor
    its lineage grows.
    """
    current = store(edges.select("src", "dst").where("src <> dst").distinct(), "edges")
    seen = None
    while True:
        both = current.unionByName(current.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        lowest = both.groupBy("src").agg(F.least(F.min("dst"), F.col("src")).alias("m"))
        large = both.join(lowest, "src").where("dst > src").select(
            F.col("dst").alias("src"), F.col("m").alias("dst"))
        down = large.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")).where(
            "src <> dst").distinct()
        least = down.groupBy("src").agg(F.min("dst").alias("m"))
        small = down.join(least, "src").select(F.col("dst").alias("src"), F.col("m").alias("dst")).unionByName(
            least.select("src", F.col("m").alias("dst")))
        watch = Observation()
        checksum = F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)"))
        current = store(small.where("src <> dst").distinct().observe(
            watch, F.count("*").alias("edges"), checksum.alias("checksum")), "edges")
        state = watch.get
        if state == seen:
            return current.select(F.col("src").alias("id"), F.col("dst").alias("root")).unionByName(
                current.select(F.col("dst").alias("id"), F.col("dst").alias("root")).distinct())
        seen = state


def dbscan(df: DataFrame, vector: str, id_column: str, eps: float = EPS, min_samples: int = MIN_SAMPLES) -> DataFrame:
    """``(id, cluster)``: clusters numbered by their lowest core id, −1 for noise.

    A border point joins the lowest-numbered cluster among its core neighbours. Exact
    copies of a vector are treated once, with their number as weight.
    """
    points = store(B.distinct_points(df, vector, id_column), "points")
    marked = store(points.join(_count(points, eps), "id").withColumn(
        "core", F.col("neighbours") >= min_samples), "core-points")
    edges = store(_pairs(marked, eps, ["core"]).mapInPandas(_edges(eps), "src long, dst long, core boolean"), "edges")
    linked = components(edges.where("core"))
    cores = marked.where("core").select("id").join(linked, "id", "left").select(
        "id", F.coalesce("root", "id").alias("root"))
    labels = number_rows(cores.select("root").distinct(), [F.col("root")], "cluster", 0)
    core_labels = store(cores.join(labels, "root").select("id", F.col("cluster").cast("int")), "core-labels")
    border = edges.where("NOT core").select(F.col("src").alias("point"), F.col("dst").alias("id")).join(
        core_labels, "id").groupBy("point").agg(F.min("cluster").alias("cluster"))
    labelled = core_labels.unionByName(border.select(F.col("point").alias("id"), "cluster"))
    per_vector = marked.join(labelled, "id", "left").select("v", F.coalesce("cluster", F.lit(NOISE)).alias("cluster"))
    return _expand(df, vector, id_column, per_vector)
