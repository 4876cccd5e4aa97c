"""Mixing sources to target weights by capped water-filling.

Every source gets ``share × all words × its weight``, clamped at ``max_epochs`` times its own words;
what a clamp leaves over goes to the others by weight, until no source is above its clamp. A
source's documents are then taken whole as often as the target allows, and one more time each in a
seeded order until the rest of the target is reached, to within half a document.

Everything is counted over all rows. The driver sees one row of sums per round, never the sources.
A source with a third of all rows is one entry of the sums, and its order is made by a
range exchange that cuts it into slices.

Defined cases: a null text has size 0; a null source is a source of its own, last in order; sizes
of 0 take nothing; repeated rows (even with one id) are mixed as rows of their own; an empty table
gives an empty result; a null id is an id of its own; a very long text is counted whole where it is read; other
columns are not read, and ``mixed_documents`` carries them along under any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from merkato.functions.ordering import number_rows
from merkato.llm.common import BLANK, store, unused, whole_text

#: Fixed values of the mix: weights by place of the source, share of all words, most epochs.
WEIGHTS, SHARE, MAX_EPOCHS = (5, 2, 1), 1.5, 2


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(f"[^{BLANK}]+")).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """``(source, source_size, target)`` from ``(source, size)``.

    Each round computes the level ``(total - clamped) / weights left`` and clamps the sources above
    it; raising the level can only clamp more, so the rounds end when none is added.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    numbered = number_rows(per_source, [F.col("source").asc_nulls_last()], "place", start=0)
    choice = F.element_at(F.array(*[F.lit(w).cast("double") for w in weights]),
                          (F.col("place") % len(weights) + 1).cast("int"))
    sources = store(numbered.select("source", "source_size", choice.alias("weight"),
                                    (F.col("source_size") * F.lit(max_epochs)).cast("double").alias("clamp")), "sources")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    clamped, level, known = F.lit(False), None, -1
    while True:
        sums = sources.groupBy().agg(
            F.sum(F.when(clamped, F.col("clamp"))).alias("clamped"), F.count(F.when(clamped, 1)).alias("n"),
            F.sum(F.when(~clamped, F.col("weight"))).alias("weight")).first()
        if not sums.weight or sums.n == known:
            break
        known = sums.n
        level = (share * total - (sums.clamped or 0.0)) / sums.weight
        clamped = F.col("weight") * F.lit(level) > F.col("clamp")
    share_of = F.lit(0.0) if level is None else F.least(F.col("clamp"), F.col("weight") * F.lit(level))
    return sources.select("source", "source_size", share_of.alias("target"))


KEY = ["doc_id", "source", "size"]


def _sized(docs: DataFrame, *others: str) -> DataFrame:
    return docs.select("doc_id", "source", *others, word_count(whole_text()).alias("size"))


def repetitions(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, max_epochs: float = MAX_EPOCHS,
                seed: int = 0) -> DataFrame:
    """``(doc_id, source, size, copies, source_size, target, repeats)`` from rows of ``(doc_id, source, size)``.

    Rows that agree in all three are one entry with its number of copies, and share their repeats.
    """
    sized = store(sizes.groupBy(*KEY).agg(F.count("*").alias("copies")), "sizes")
    mass = F.col("size") * F.col("copies")
    targets = source_targets(sized.select("source", mass.alias("size")), weights, share, max_epochs)
    drawn = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    order = ["source", "draw", "doc_id", "size"]
    # Slices of the seeded order; a total per slice and source carries over, so a hot source is many slices.
    ranged = sized.withColumn("mass", mass).withColumn("draw", drawn).repartitionByRange(*order).sortWithinPartitions(*order)
    sliced = store(ranged.withColumn("slice", F.spark_partition_id()).withColumn(
        "position", F.monotonically_increasing_id()), "mix-order")
    earlier = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = sliced.groupBy("source", "slice").agg(F.sum("mass").alias("sum")).select(
        F.col("source").alias("of"), F.col("slice").alias("at"), F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("start"))
    within = Window.partitionBy("slice", "source").orderBy("position").rowsBetween(Window.unboundedPreceding, -1)
    placed = sliced.withColumn("inside", F.coalesce(F.sum("mass").over(within), F.lit(0)))
    placed = placed.join(starts, F.col("source").eqNullSafe(F.col("of")) & (F.col("slice") == F.col("at")))
    goal = targets.select(F.col("source").alias("goal_of"), "source_size", "target")
    placed = placed.join(goal, F.col("source").eqNullSafe(F.col("goal_of")))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    rest = F.col("target") - whole * F.col("source_size")
    middle = (F.col("start") + F.col("inside")).cast("double") + F.col("mass") / F.lit(2.0)
    repeats = whole + F.when((F.col("size") > 0) & (middle <= rest), 1).otherwise(0)
    return placed.select(*KEY, "copies", "source_size", "target", repeats.cast("long").alias("repeats"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """One row per document: ``(doc_id, size, source_size, target, taken)``."""
    return repetitions(_sized(docs), **options).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("repeats")).alias("taken"),
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy")).drop("copy")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix, each as often as it was taken, with the columns of ``docs``."""
    of_id, of_source, of_size, repeats, repeat = unused(docs, "of_id", "of_source", "of_size", "repeats", "repeat")
    taken = repetitions(_sized(docs), **options).where("repeats > 0").select(
        F.col("doc_id").alias(of_id), F.col("source").alias(of_source), F.col("size").alias(of_size),
        F.col("repeats").alias(repeats))
    joined = docs.join(taken, F.col("doc_id").eqNullSafe(F.col(of_id)) & F.col("source").eqNullSafe(F.col(of_source))
                       & (word_count(whole_text()) == F.col(of_size)))
    return joined.select(
        *docs.columns, F.explode(F.sequence(F.lit(1).cast("long"), F.col(repeats))).alias(repeat)).select(*docs.columns)
