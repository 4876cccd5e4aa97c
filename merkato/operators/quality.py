"""Warehouse checks. Each gives ``check_name, issues, status``; the report is their union."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from merkato import schemas
from merkato.functions import expressions as X
from merkato.functions.ordering import exact_quantiles
from merkato.operators import star
from merkato.sources.tables import union_all

# Natural keys of the versioned tables, and the allowed loyalty values.
VERSIONED = {
    "DimProduct": (["Product_ID"], "ProductSuggorateKey"),
    "DimSpecialOffer": (["SpecialOffer_ID"], "SpecialOfferSuggorateKey"),
    "DimCustomer": (["Customer_ID"], "CustomerSuggorateKey"),
    "BridgeProductSpecialOffer": (
        ["ProductSuggorateKey", "SpecialOfferSuggorateKey"], "BrdgProductSpecialOfferKey"),
}
SURROGATE_KEYS = {
    **{table: key for table, (_, key) in VERSIONED.items()},
    "DimTerritory": "TerritorySuggorateKey",
    "DimTime": "TimeSuggorateKey",
}
LOYALTY_VALUES = ["Platinum", "Gold", "Silver", "Bronze"]


def result(name: str, issues: DataFrame, info: bool = False) -> DataFrame:
    """Turn a one-row count into a check result."""
    count = F.coalesce(F.col(issues.columns[0]), F.lit(0)).cast("long")
    status = F.lit("INFO") if info else F.when(count == 0, "OK").otherwise("ISSUE")
    return issues.select(F.lit(name).alias("check_name"), count.alias("issues"), status.alias("status"))


def rows_where(df: DataFrame, condition) -> DataFrame:
    return df.agg(F.count_if(condition).alias("issues"))


def duplicate_groups(df: DataFrame, keys: list[str]) -> DataFrame:
    """How many key values occur more than once."""
    repeated = df.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > 1)
    return repeated.agg(F.count("*").alias("issues"))


# ---------------------------------------------------------------- foreign keys


def fact_to_bridge(wh) -> DataFrame:
    return result("FactSale -> Bridge", star.orphans(
        wh.table("FactSale"), "BrdgProductSpecialOfferKey", wh.table("BridgeProductSpecialOffer"),
        "BrdgProductSpecialOfferKey"))


def bridge_to_product(wh) -> DataFrame:
    return result("Bridge -> DimProduct", star.orphans(
        wh.table("BridgeProductSpecialOffer"), "ProductSuggorateKey", wh.table("DimProduct"), "ProductSuggorateKey"))


def fact_to_dimensions(wh) -> DataFrame:
    fact = wh.table("FactSale")
    return union_all([
        result(f"FactSale -> {table}", star.orphans(fact, fact_key, wh.table(table), key))
        for table, fact_key, key in (
            ("DimCustomer", "DimCustomerKey", "CustomerSuggorateKey"),
            ("DimTerritory", "DimTerritoryKey", "TerritorySuggorateKey"),
            ("DimTime", "DimTimeKey", "DateKey"),
        )
    ])


def bridge_to_offer(wh) -> DataFrame:
    return result("Bridge -> DimSpecialOffer", star.orphans(
        wh.table("BridgeProductSpecialOffer"), "SpecialOfferSuggorateKey", wh.table("DimSpecialOffer"),
        "SpecialOfferSuggorateKey"))


# -------------------------------------------------------------------- versions


def several_active(dim: DataFrame, natural_key: list[str]) -> DataFrame:
    return duplicate_groups(star.current(dim), natural_key)


def overlapping_pairs(dim: DataFrame, natural_key: list[str], by: str | None = None) -> DataFrame:
    """How many pairs of versions of one key overlap, without forming the pairs; for each value of ``by``, a part of the key.

    Intervals are half-open; NULL bounds never match. Two well-formed versions either
    overlap or one ends before the other starts, so the overlaps are all pairs minus the
    (start, earlier end) combinations. Those are counted with running totals, first
    within each day and then over the days, so a key with very many versions is spread
    over its days. A version of zero length overlaps those that started before and end
    after its instant, which the same totals give. Only versions whose end lies before
    their start (corrupt rows) are compared by a join, after equal ones are counted together.
    """
    keys = [F.col(c).alias(f"k{i}") for i, c in enumerate(natural_key)]
    names = [f"k{i}" for i in range(len(natural_key))]
    bounded = dim.where(F.col("ValidFrom").isNotNull() & F.col("ValidTo").isNotNull())
    for c in natural_key:
        bounded = bounded.where(F.col(c).isNotNull())
    versions = bounded.select(*keys, F.col("ValidFrom").alias("f"), F.col("ValidTo").alias("t")).groupBy(
        *names, "f", "t").agg(F.count("*").alias("n"))
    proper, instant = F.col("f") < F.col("t"), F.col("f") == F.col("t")

    def events(moment: str, kind: str):
        zero = F.lit(0).cast("long")
        return F.struct(F.col(moment).alias("at"), *[
            (F.col("n") if kind == k else zero).alias(k) for k in ("starts", "ends", "points")])

    moments = versions.where(proper | instant).select(*names, F.explode(
        F.when(instant, F.array(events("f", "points"))).otherwise(F.array(events("f", "starts"), events("t", "ends")))
    ).alias("e")).select(*names, "e.*").groupBy(*names, "at").agg(*[F.sum(k).alias(k) for k in ("starts", "ends", "points")])
    days = moments.groupBy(*names, F.to_date("at").alias("day")).agg(
        F.sum("starts").alias("ds"), F.sum("ends").alias("de"))
    earlier_days = Window.partitionBy(*names).orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    days = days.select(*names, "day", *[
        F.coalesce(F.sum(c).over(earlier_days), F.lit(0)).alias(f"b{c}") for c in ("ds", "de")])
    same_day = Window.partitionBy(*names, "day").orderBy("at")
    before = same_day.rowsBetween(Window.unboundedPreceding, -1)
    upto = same_day.rowsBetween(Window.unboundedPreceding, 0)
    placed = moments.withColumn("day", F.to_date("at")).join(days, [*names, "day"]).select(
        *names, "starts", "points",
        (F.col("bde") + F.sum("ends").over(upto)).alias("ended"),
        (F.col("bds") + F.coalesce(F.sum("starts").over(before), F.lit(0))).alias("started"),
    )
    wide = "decimal(38,0)"
    group = [] if by is None else [F.col(f"k{natural_key.index(by)}")]
    swept = placed.groupBy(*names).agg(
        F.sum(F.col("starts").cast(wide)).alias("m"),
        F.sum(F.col("starts").cast(wide) * F.col("ended").cast("decimal(18,0)")).alias("apart"),
        F.sum(F.col("points").cast(wide) * (F.col("started") - F.col("ended")).cast("decimal(18,0)")).alias("inside"),
    ).groupBy(*group).agg(F.sum((F.col("m").cast("decimal(19,0)") * (F.col("m") - 1).cast("decimal(19,0)") / 2) - F.col("apart")
                + F.col("inside")).cast("long").alias("pairs"))
    corrupt = versions.where(F.col("f") > F.col("t")).select(*names, F.col("f").alias("cf"), F.col("t").alias("ct"),
                                                              F.col("n").alias("cn"))
    crossed = versions.where(proper).join(corrupt, names).where(
        (F.col("f") < F.col("ct")) & (F.col("t") > F.col("cf"))
    ).groupBy(*group).agg(F.sum(F.col("n") * F.col("cn")).alias("pairs"))
    total = F.coalesce(F.sum("pairs"), F.lit(0)).cast("long").alias("issues")
    return swept.unionByName(crossed).groupBy(*group).agg(total).select(*[g.alias(by) for g in group], "issues")


def wrong_open_end(dim: DataFrame) -> DataFrame:
    """Active versions whose end is not the open end; a NULL end is not counted."""
    return rows_where(dim, F.col("IsActive") & (F.col("ValidTo") != F.lit(schemas.OPEN_END).cast("timestamp_ntz")))


def _per_versioned(wh, label: str, check) -> DataFrame:
    return union_all([
        result(f"{table}: {label}", check(wh.table(table), keys)) for table, (keys, _) in VERSIONED.items()
    ])


def active_checks(wh) -> DataFrame:
    return _per_versioned(wh, "several active versions", several_active)


def overlap_checks(wh) -> DataFrame:
    return _per_versioned(wh, "overlapping versions", overlapping_pairs)


def open_end_checks(wh) -> DataFrame:
    return _per_versioned(wh, "active version with an end", lambda dim, _: wrong_open_end(dim))


# -------------------------------------------------------------- time dimension


def date_key_format(time: DataFrame) -> DataFrame:
    return result("DateKey format", rows_where(time, ~X.has_length(F.col("DateKey"), 8)))


def duplicate_date_keys(time: DataFrame) -> DataFrame:
    return result("Duplicate DateKeys", duplicate_groups(time, ["DateKey"]))


def date_coverage(time: DataFrame) -> DataFrame:
    return time.agg(
        F.min("DateKey").alias("first_date"), F.max("DateKey").alias("last_date"), F.count("*").alias("dates")
    )


def bridge_activity(bridge: DataFrame) -> DataFrame:
    return union_all([
        result("Active bridge records", rows_where(bridge, F.col("IsActive")), info=True),
        result("Inactive bridge records", rows_where(bridge, ~F.col("IsActive")), info=True),
    ])


# ---------------------------------------------------------------- column checks


def duplicate_surrogates(wh) -> DataFrame:
    return union_all([
        result(f"{table}: duplicate {key}", duplicate_groups(wh.table(table), [key]))
        for table, key in SURROGATE_KEYS.items()
    ])


def null_counts(df: DataFrame, table: str) -> DataFrame:
    """NULLs per column, counted for all columns in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return counts.unpivot([], df.columns, "column_name", "nulls").select(F.lit(table).alias("table_name"), "*")


def column_mean(df: DataFrame, c: str) -> Column:
    """Mean of a number, exact up to the division where its type is."""
    if isinstance(df.schema[c].dataType, T.FractionalType):
        return F.avg(c) if not isinstance(df.schema[c].dataType, T.DecimalType) else X.ratio(F.sum(c), F.count(c))
    return X.ratio(F.sum(F.col(c).cast("decimal(38,0)")), F.count(c))


def distribution(df: DataFrame, table: str) -> DataFrame:
    """Count, range, mean, sample deviation and exact quartiles of the numeric columns."""
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]

    stats = df.agg(*[F.struct(
        F.count(c).alias("values"), F.min(c).cast("double").alias("min"), F.max(c).cast("double").alias("max"),
        column_mean(df, c).alias("mean"),
        F.stddev_samp(F.col(c).cast("double")).alias("std"),
    ).alias(c) for c in numeric]).unpivot([], numeric, "column_name", "s")
    quartiles = exact_quantiles(df, numeric, [0.25, 0.5, 0.75]).groupBy("column_name").agg(*[
        F.max(F.when(F.col("probability") == p, F.col("quantile"))).alias(name)
        for p, name in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"))
    ])
    return stats.join(quartiles, "column_name", "left").select(
        F.lit(table).alias("table_name"), "column_name", "s.*", "p25", "p50", "p75"
    )


# Size of a quantile sketch, and how far the rank of what it returns may be off.
SKETCH, RANK_ERROR = 800, 0.01


def quantile_sketches(df: DataFrame, columns: list[str], by: list[str] = (), size: int = SKETCH) -> DataFrame:
    """One row per group with a mergeable sketch of each column, in one pass: so the sketches of months give those of years."""
    return df.groupBy(*by).agg(*[F.kll_sketch_agg_double(F.col(c).cast("double"), size).alias(c) for c in columns])


def merged_sketches(sketches: DataFrame, columns: list[str], by: list[str] = ()) -> DataFrame:
    return sketches.groupBy(*by).agg(*[F.kll_merge_agg_double(c).alias(c) for c in columns])


def sketched_quantiles(sketches: DataFrame, columns: list[str], by: list[str] = (), probabilities=(0.25, 0.5, 0.75)) -> DataFrame:
    """``(by, column_name, values, probability, quantile)``; a quantile's rank is within ``RANK_ERROR`` for sketches of ``SKETCH``."""
    entries = [F.struct(F.lit(c).alias("column_name"), F.kll_sketch_get_n_double(c).alias("values"), F.lit(float(p)).alias("probability"),
                        F.when(F.kll_sketch_get_n_double(c) > 0, F.kll_sketch_get_quantile_double(c, F.lit(float(p)))).alias("quantile"))
               for c in columns for p in probabilities]
    return sketches.select(*by, F.explode(F.array(*entries)).alias("e")).select(*by, "e.*")


def rank_errors(df: DataFrame, quantiles: DataFrame) -> DataFrame:
    """``(column_name, probability, error)``: how far a quantile's true rank is from its probability; 0 within a run of equals.

    Needs the values once more, so it is for checking. There is one row per column and probability.
    """
    asked = [r for r in quantiles.select("column_name", "probability", "quantile").collect() if r.quantile is not None]
    if not asked:
        return quantiles.select("column_name", "probability", F.lit(None).cast("double").alias("error")).limit(0)
    parts = []
    for r in asked:
        x, at = F.col(r.column_name).cast("double"), F.lit(r.quantile)
        below, upto, n = F.count_if(x < at), F.count_if(x <= at), F.count(x)
        error = F.greatest(below / n - r.probability, F.lit(r.probability) - upto / n, F.lit(0.0))
        parts.append(F.struct(F.lit(r.column_name).alias("column_name"), F.lit(r.probability).alias("probability"), error.alias("error")))
    return df.agg(F.array(*parts).alias("e")).select(F.explode("e").alias("e")).select("e.*")


def domain_checks(customer: DataFrame, offer: DataFrame) -> DataFrame:
    return union_all([
        result("LoyaltyStatus in the four tiers", rows_where(customer, ~F.col("LoyaltyStatus").isin(LOYALTY_VALUES))),
        result("LifeTimeValue not negative", rows_where(customer, F.col("LifeTimeValue") < 0)),
        result("DiscountPct between 0 and 1",
               rows_where(offer, (F.col("DiscountPct") < 0) | (F.col("DiscountPct") > 1))),
    ])


def any_issue(results: DataFrame) -> DataFrame:
    return results.agg(F.coalesce(F.bool_or(F.col("status") == "ISSUE"), F.lit(False)).alias("has_issues"))


def full_report(wh, nulls: list[str] = ()) -> DataFrame:
    """Every check as rows of one frame, from about two scans a table; also the NULLs in the columns of some tables."""
    from merkato.operators import report

    return report.run_rules(wh, [*report.RULES, *report.null_rules(list(nulls))])
