"""Global order without a global window: numbering, neighbours, exact quantiles.

A window without partition keys, or one over a key that holds a third of the rows,
runs in a single task. The functions here range-partition the rows instead, store
them once so that every later step sees the same slices, and carry small per-slice
totals from one slice to the next.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from merkato.session import beside_facts, store

_SLICE, _POSITION = "_slice", "_position"
_LOW_33_BITS = (1 << 33) - 1

# A group of up to this many rows is sorted inside one task; a larger one is sliced.
ROWS_PER_TASK = 1_000_000


def in_slices(df: DataFrame, order: list[Column], label: str) -> DataFrame:
    """``df`` written in range slices of an order, with ``_slice`` and, rising within it, ``_position``."""
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return store(
        ranged.withColumn(_SLICE, F.spark_partition_id()).withColumn(
            _POSITION, F.monotonically_increasing_id().bitwiseAND(F.lit(_LOW_33_BITS))
        ),
        label,
    )


def _offsets(rows: DataFrame, size: Column) -> DataFrame:
    """What comes before each slice. One row per slice, so the window is bounded by the partitions."""
    before = Window.orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    return rows.groupBy(_SLICE).agg(size.alias("_size")).select(
        _SLICE, F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before")
    )


def number_rows(df: DataFrame, order: list[Column], name: str, start: int = 1) -> DataFrame:
    """Dense numbers ``start, start+1, …`` in the given order, for any row count.

    The order should tell rows apart; where it may not, use ``number_copies``.
    """
    rows = in_slices(df, order, "numbered")
    return (
        rows.join(F.broadcast(_offsets(rows, F.count("*"))), _SLICE)
        .withColumn(name, (F.col("_before") + F.col(_POSITION) + start).cast("long"))
        .select(*df.columns, name)
    )


# Copies of one row that a task writes out in one go.
COPIES_PER_TASK = 100_000


def number_copies(df: DataFrame, order: list[str], name: str, start: int = 1) -> DataFrame:
    """Like ``number_rows`` where rows may be exact copies of each other.

    Copies are counted before the sort, which could not split them, and written out
    afterwards. A row with very many copies is written by several tasks.
    """
    rows = in_slices(df.groupBy(*df.columns).agg(F.count("*").alias("_copies")), [F.col(c) for c in order], "numbered")
    upto = F.sum("_copies").over(Window.partitionBy(_SLICE).orderBy(_POSITION))
    placed = rows.withColumn("_upto", upto).join(F.broadcast(_offsets(rows, F.sum("_copies"))), _SLICE).withColumn(
        "_first", F.col("_before") + F.col("_upto") - F.col("_copies") + start)

    def written(part: DataFrame, count: Column) -> DataFrame:
        step = F.explode(F.sequence(F.lit(0).cast("long"), count - 1))
        return part.select(*df.columns, "_first", "_copies", step.alias("_step"))

    few = written(placed.where(F.col("_copies") <= COPIES_PER_TASK), F.col("_copies")).select(
        *df.columns, (F.col("_first") + F.col("_step")).alias(name))
    chunks = written(placed.where(F.col("_copies") > COPIES_PER_TASK),
                     F.ceil(F.col("_copies") / COPIES_PER_TASK).cast("long"))
    spread = chunks.repartition(F.col("_first"), F.col("_step")).select(
        *df.columns, (F.col("_first") + F.col("_step") * COPIES_PER_TASK).alias("_first"),
        F.least(F.lit(COPIES_PER_TASK).cast("long"), F.col("_copies") - F.col("_step") * COPIES_PER_TASK).alias("_copies"))
    many = written(spread, F.col("_copies")).select(*df.columns, (F.col("_first") + F.col("_step")).alias(name))
    return few.unionByName(many)


def number_within(df: DataFrame, group: str, order: list[str], name: str, start: int = 1) -> DataFrame:
    """Dense numbers in order of ``group`` and, within it, ``order``; rows that agree in all of it may be exact copies.

    Only the groups' sizes are put in order, by ranges. The rows are numbered within their group and add its start, so
    rows that are already partitioned by group are not exchanged. With a group beyond one task's rows, ``number_copies`` is used.
    """
    sizes = store(df.groupBy(group).agg(F.count("*").alias("_size")), "group-sizes")
    if (sizes.agg(F.max("_size")).first()[0] or 0) > ROWS_PER_TASK:
        return number_copies(df, [group, *order], name, start)
    rows = in_slices(sizes, [F.col(group)], "group-starts")
    upto = F.sum("_size").over(Window.partitionBy(_SLICE).orderBy(_POSITION))
    starts = rows.withColumn("_upto", upto).join(F.broadcast(_offsets(rows, F.sum("_size"))), _SLICE).select(
        group, (F.col("_before") + F.col("_upto") - F.col("_size") + (start - 1)).alias("_first"))
    place = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    return df.withColumn("_place", place).join(beside_facts(starts, sizes), group).select(
        *df.columns, (F.col("_first") + F.col("_place")).cast("long").alias(name))


def largest_group(df: DataFrame, keys: list[str]) -> int:
    return df.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0


def neighbour(df: DataFrame, keys: list[str], order: list[str], columns: list[str], step: int,
              largest: int | None = None) -> DataFrame:
    """Add ``prev_<c>`` (step −1) or ``next_<c>`` (step +1) for each column within ``keys``.

    Ordinary keys use a plain window. When some key has more rows than one task
    should sort, its rows are sliced by range and the value at each slice border
    comes from the adjoining slice. ``largest`` is the size of the largest group where
    the caller knows it (an upper bound will do).
    """
    prefix, fn = ("prev_", F.lag) if step < 0 else ("next_", F.lead)
    if (largest_group(df, keys) if largest is None else largest) <= ROWS_PER_TASK:
        window = Window.partitionBy(*keys).orderBy(*order)
        return df.select("*", *[fn(c).over(window).alias(prefix + c) for c in columns])

    rows = in_slices(df, [F.col(c) for c in keys + order], "neighbours")
    packed = F.struct(*[F.col(c) for c in columns])
    rank = F.struct(*[F.col(c) for c in order])
    edge = F.max_by(packed, rank) if step < 0 else F.min_by(packed, rank)
    across = Window.partitionBy(*keys).orderBy(_SLICE)  # at most one row per slice
    borders = rows.groupBy(*keys, _SLICE).agg(edge.alias("_edge")).select(
        *[F.col(k).alias("_b_" + k) for k in keys], F.col(_SLICE).alias("_b_slice"),
        fn("_edge").over(across).alias("_border"),
    )
    within = Window.partitionBy(_SLICE, *keys).orderBy(*order)
    same = [F.col(k).eqNullSafe(F.col("_b_" + k)) for k in keys]
    joined = rows.withColumn("_near", fn(packed).over(within)).join(
        borders, [*same, F.col(_SLICE) == F.col("_b_slice")], "left"
    )
    near = F.coalesce(F.col("_near"), F.col("_border"))
    return joined.select(*df.columns, *[near[c].alias(prefix + c) for c in columns])


def exact_quantiles(df: DataFrame, columns: list[str], probabilities: list[float]) -> DataFrame:
    """Linearly interpolated quantiles ``(column_name, probability, quantile)`` of whole columns.

    The built-in exact percentile keeps every distinct value in one buffer. Here the
    values are counted, range-partitioned and located by cumulative position.
    """
    values = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        [], columns, "column_name", "value"
    ).where("value IS NOT NULL AND NOT isnan(value)")
    counts = values.groupBy("column_name", "value").agg(F.count("*").alias("n"))
    rows = in_slices(counts, [F.col("column_name"), F.col("value")], "quantiles")
    across = Window.partitionBy("column_name").orderBy(_SLICE)
    slices = rows.groupBy("column_name", _SLICE).agg(F.sum("n").alias("m")).select(
        "column_name", _SLICE,
        F.coalesce(F.sum("m").over(across.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
    )
    within = Window.partitionBy(_SLICE, "column_name").orderBy("value")
    placed = rows.join(F.broadcast(slices), ["column_name", _SLICE]).select(
        "column_name", "value", "n",
        (F.col("_before") + F.sum("n").over(within)).alias("_upto"),
    )
    # One row per column and probability.
    targets = rows.groupBy("column_name").agg(F.sum("n").alias("total")).select(
        "column_name", F.explode(F.array(*[F.lit(float(p)) for p in probabilities])).alias("probability"), "total"
    ).withColumn("_at", (F.col("total") - 1) * F.col("probability")).select(
        "column_name", "probability", "_at", F.floor("_at").alias("_low"), F.ceil("_at").alias("_high")
    )

    def holds(position: str) -> Column:
        return (F.col(position) < F.col("_upto")) & (F.col(position) >= F.col("_upto") - F.col("n"))

    hits = placed.join(F.broadcast(targets), "column_name").where(holds("_low") | holds("_high"))
    low = F.max(F.when(holds("_low"), F.col("value")))
    high = F.max(F.when(holds("_high"), F.col("value")))
    return hits.groupBy("column_name", "probability").agg(
        (low + (high - low) * (F.first("_at") - F.first("_low"))).alias("quantile")
    )
