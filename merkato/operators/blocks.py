"""Distance work between bounded blocks of vectors.

Some results need the distance between many pairs of points. The pairs are never rows
of a DataFrame: points are packed into blocks of limited size, blocks are joined by
key, and each task reduces one pair of blocks to sums or to a few edges.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merkato.session import store

BLOCK_ROWS = 2048
GRID_AXES = 2


def distinct_points(df: DataFrame, vector: str, id_column: str, *extra: str) -> DataFrame:
    """One row per distinct vector (and extra column) with its lowest id and its number of copies."""
    as_double = F.transform(F.col(vector), lambda x: x.cast("double") + F.lit(0.0))
    return df.groupBy(as_double.alias("v"), *extra).agg(F.min(id_column).alias("id"), F.count("*").alias("w"))


def widest_axes(points: DataFrame, count: int = GRID_AXES) -> list[int]:
    """The vector positions with the largest variance."""
    variance = points.agg(vector_to_array(Summarizer.variance(array_to_vector("v"))).alias("s")).first()[0]
    return [int(i) for i in np.argsort(variance)[::-1][:count]]


def pack(points: DataFrame, cell, extra: list[str], rows: int = BLOCK_ROWS) -> tuple[DataFrame, DataFrame]:
    """Blocks ``(cell, block, id, w, …, v)`` and the directory ``(cell, blocks)``, stored once.

    A block is one row of arrays, with all its vectors in a single flat array.

    A cell with many points is cut into several blocks of about ``rows`` points.
    """
    placed = points.withColumn("cell", cell)
    directory = placed.groupBy("cell").agg(F.ceil(F.count("*") / F.lit(rows)).cast("int").alias("blocks"))
    numbered = placed.join(directory, "cell").withColumn("block", F.pmod(F.xxhash64("id"), "blocks").cast("int"))
    rows = F.collect_list(F.struct("id", "w", "v", *extra))
    packed = numbered.groupBy("cell", "block").agg(rows.alias("pts")).select(
        "cell", "block", *[F.col(f"pts.{c}").alias(c) for c in ("id", "w", *extra)], F.flatten("pts.v").alias("v"),
    )
    packed = store(packed, "blocks")
    return packed, packed.groupBy("cell").agg((F.max("block") + 1).alias("blocks"))


def neighbour_pairs(directory: DataFrame, axes: int) -> DataFrame:
    """Unordered block pairs of each cell with itself and its adjoining cells.

    A cell is an array of ``axes`` grid numbers; ``axes=0`` puts all points in one cell.
    """
    shifted = directory.select(F.col("cell").alias("a"), F.col("blocks").alias("na"), F.col("cell").alias("b"))
    for axis in range(axes):
        moved = [F.array(*[F.col("b")[i] + (step if i == axis else 0) for i in range(axes)]) for step in (-1, 0, 1)]
        shifted = shifted.select("a", "na", F.explode(F.array(*moved)).alias("b"))
    adjoining = shifted.where(F.col("a") <= F.col("b")).join(
        directory.select(F.col("cell").alias("b"), F.col("blocks").alias("nb")), "b")
    pairs = adjoining.select(
        "a", "b", "nb", F.explode(F.sequence(F.lit(0), F.col("na") - 1)).alias("block_a")
    ).select("a", "b", "block_a", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)).alias("block_b"))
    return pairs.where((F.col("a") < F.col("b")) | (F.col("block_a") <= F.col("block_b")))


def paired_blocks(packed: DataFrame, pairs: DataFrame) -> DataFrame:
    """One row per pair of blocks: ``same``, and the columns of both with prefixes ``l_`` and ``r_``."""
    fields = [c for c in packed.columns if c not in ("cell", "block")]
    left = packed.select(F.col("cell").alias("a"), F.col("block").alias("block_a"),
                         *[F.col(c).alias(f"l_{c}") for c in fields])
    right = packed.select(F.col("cell").alias("b"), F.col("block").alias("block_b"),
                          *[F.col(c).alias(f"r_{c}") for c in fields])
    return pairs.join(left, ["a", "block_a"]).join(right, ["b", "block_b"]).select(
        ((F.col("a") == F.col("b")) & (F.col("block_a") == F.col("block_b"))).alias("same"),
        *[f"{side}_{c}" for side in "lr" for c in fields],
    )


def block_pairs(batches):
    """``(same, left, right)`` of each row, with the vectors as matrices."""
    for batch in batches:
        sides = [[c for c in batch.columns if c.startswith(p)] for p in ("l_", "r_")]
        for _, row in batch.iterrows():
            left, right = ({c[2:]: np.asarray(row[c]) for c in names} for names in sides)
            for side in (left, right):
                side["v"] = side["v"].reshape(len(side["id"]), -1)
            yield row["same"], left, right


#: Left rows multiplied at once, pairs whose differences are held at once.
SLAB, PAIRS = 256, 1 << 15
#: Parts of the squared norms: a distance below the first, or this near to a border by the second, is taken from differences.
CANCELLED, DOUBTFUL = 1e-5, 1e-9


def squared_distances(a: np.ndarray, b: np.ndarray, border: float | None = None) -> np.ndarray:
    """Squared distances by matrix products; from differences where a product is not exact enough.

    That is so for points that nearly agree, whose norms cancel out, for numbers that are not finite, and for distances about
    ``border``, so that comparing with it gives what the differences give.
    """
    out = np.empty((len(a), len(b)))
    if not out.size:
        return out
    middle = b.mean(axis=0)
    if not np.isfinite(middle).all():
        middle = np.zeros(b.shape[1])
    right = b - middle
    right_norms = np.einsum("ij,ij->i", right, right)
    for first in range(0, len(a), SLAB):
        slab, own = out[first:first + SLAB], a[first:first + SLAB]
        left = own - middle
        left_norms = np.einsum("ij,ij->i", left, left)[:, None]
        with np.errstate(invalid="ignore", over="ignore"):
            np.matmul(-2 * left, right.T, out=slab)
            slab += left_norms
            slab += right_norms
            largest = left_norms.max() + right_norms.max()
            plain = slab.min() > CANCELLED * largest and np.isfinite(4 * largest)
            if border is not None:
                from_border = np.abs(slab - border)
                plain = plain and from_border.min() > DOUBTFUL * largest
            if plain:
                continue
            norms = left_norms + right_norms
            unsure = ~(slab > CANCELLED * norms) | ~np.isfinite(4 * norms)
            if border is not None:
                unsure |= from_border <= DOUBTFUL * norms
        row, column = np.nonzero(unsure)
        for k in range(0, len(row), PAIRS):
            i, j = row[k:k + PAIRS], column[k:k + PAIRS]
            diff = b[j] - own[i]
            slab[i, j] = np.einsum("ij,ij->i", diff, diff)
    return out
