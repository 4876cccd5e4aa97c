"""Monthly sales series per market: metrics, growth, recent periods, sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from merkato.functions import expressions as X
from merkato.operators import star
from merkato.operators.cube import MonthCube

# The features of one time step, in the order the encoder reads them.
STEP_FEATURES = [
    "revenue", "quantity", "ordercount", "customercount", "avgordervalue", "uniquesubcategories",
    "uniqueproductlines", "revenuegrowth", "quantitygrowth",
]
GRAINS = {"month": ["year", "month"], "day": ["year", "month", "datekey"]}


def period_columns(grain: str) -> list[str]:
    if grain not in GRAINS:
        raise ValueError(f"grain must be one of {sorted(GRAINS)}")
    return GRAINS[grain]


def market_rows(wh, months: list[int] | None = None) -> DataFrame:
    """Current-version sales with market, period and product attributes.

    ``months`` (YYYYMM values) prunes the fact files to those months.
    """
    facts = wh.table("FactSale")
    if months is not None:
        facts = facts.where(F.col("SaleMonth").isin(months))
    rows = star.join_products(facts, star.offered_products(wh))
    rows = star.join_territory(rows, wh.table("DimTerritory"))
    rows = star.join_time(rows, wh.table("DimTime"))
    return rows.select(
        F.col("CountryRegion").alias("market"), F.col("Year").alias("year"), F.col("Month").alias("month"),
        F.when(F.col("Year").isNotNull(), F.col("DimTimeKey")).alias("datekey"), "Revenue", "ProductQuantity",
        "SalesOrderID", "DimCustomerKey", "Subcategory", "ProductLine",
    )


def period_metrics(rows: DataFrame, grain: str = "month") -> DataFrame:
    """Sales metrics per market and period; ``avgordervalue`` is the mean revenue of a line.

    Each exact distinct count is first de-duplicated by its own values, so one market
    with most of the rows is still spread over all tasks.
    """
    periods = period_columns(grain)
    aggregates = [
        F.sum("Revenue").alias("revenue"),
        F.sum("ProductQuantity").alias("quantity"),
        F.count_distinct("SalesOrderID").alias("ordercount"),
        F.count_distinct("DimCustomerKey").alias("customercount"),
        X.ratio(F.sum("Revenue"), F.count("Revenue")).alias("avgordervalue"),
        F.count_distinct("Subcategory").alias("uniquesubcategories"),
        F.count_distinct("ProductLine").alias("uniqueproductlines"),
    ]
    if grain == "month":
        aggregates.append(F.max("datekey").alias("datekey"))
    return rows.groupBy("market", *periods).agg(*aggregates).select(
        "market", "year", "month", "datekey", "revenue", "quantity", "ordercount", "customercount", "avgordervalue",
        "uniquesubcategories", "uniqueproductlines",
    )


def recent_periods(metrics: DataFrame, count: int = 12, grain: str = "month") -> DataFrame:
    """The latest ``count`` distinct periods over all markets; unknown periods are left out."""
    periods = period_columns(grain)
    known = metrics.where(F.col("year").isNotNull() & F.col("month").isNotNull())
    return known.select(*periods).distinct().orderBy(*[F.col(p).desc_nulls_last() for p in periods]).limit(count)


def within_periods(metrics: DataFrame, periods: DataFrame) -> DataFrame:
    """Rows of the listed periods. The list holds at most the look-back length, so it is broadcast."""
    return metrics.join(F.broadcast(periods), periods.columns, "left_semi")


def with_previous(metrics: DataFrame, grain: str = "month") -> DataFrame:
    """Add the previous available period's revenue and quantity of the same market."""
    window = Window.partitionBy("market").orderBy(*period_columns(grain))
    return metrics.select(
        "*", F.lag("revenue").over(window).alias("prevrevenue"), F.lag("quantity").over(window).alias("prevquantity")
    )


def with_growth(metrics: DataFrame) -> DataFrame:
    return metrics.select(
        "*",
        X.growth(F.col("revenue"), F.col("prevrevenue")).alias("revenuegrowth"),
        X.growth(F.col("quantity"), F.col("prevquantity")).alias("quantitygrowth"),
    )


def recent_months(wh, lookback: int, grain: str = "month") -> list[int]:
    """Months (YYYYMM) of the latest periods that have current-version sales.

    The newest months of the partition list are tried first and older ones only if
    those hold too few periods, so old files are not read. The list has one entry per
    month of history.
    """
    stored = wh.table("FactSale").select("SaleMonth").where("SaleMonth IS NOT NULL").distinct()
    candidates = sorted((r[0] for r in stored.collect()), reverse=True)
    tried = lookback if grain == "month" else 1
    while True:
        rows = market_rows(wh, candidates[:tried])
        found = recent_periods(rows, lookback, grain).collect()
        if len(found) == lookback or tried >= len(candidates):
            return sorted({r["year"] * 100 + r["month"] for r in found})
        tried *= 2


def market_series(wh, lookback: int = 12, grain: str = "month") -> DataFrame:
    """Metrics with growth of every market over the latest ``lookback`` periods.

    Months come from the stored cube; of days, the months that hold them prune the fact files before the wide
    aggregation.
    """
    if period_columns(grain) == GRAINS["month"]:
        return with_growth(with_previous(recent_metrics(wh, lookback)))
    months = recent_months(wh, lookback, grain)
    recent = market_rows(wh, months).where((F.col("year") * 100 + F.col("month")).isin(months))
    metrics = period_metrics(recent, grain)
    metrics = within_periods(metrics, recent_periods(metrics, lookback, grain))
    return with_growth(with_previous(metrics, grain))


def recent_metrics(wh, lookback: int = 12) -> DataFrame:
    """Metrics of the latest ``lookback`` months, from the cube's files of their years alone."""
    cube = MonthCube.of(wh)
    metrics = cube.metrics(cube.months()[-lookback:] if lookback > 0 else [])
    return within_periods(metrics, recent_periods(metrics, lookback))


def last_steps(series: DataFrame, length: int = 6, grain: str = "month") -> DataFrame:
    """The latest ``length`` periods of each market that has that many, numbered ``step`` 1…length."""
    periods = period_columns(grain)
    latest = Window.partitionBy("market").orderBy(*[F.col(p).desc() for p in periods])
    return series.select(
        "*", F.row_number().over(latest).alias("_back"), F.count("*").over(Window.partitionBy("market")).alias("_n")
    ).where((F.col("_n") >= length) & (F.col("_back") <= length)).select(
        *series.columns, (F.lit(length) + 1 - F.col("_back")).alias("step")
    )


def short_markets(series: DataFrame, length: int = 6) -> DataFrame:
    return series.groupBy("market").agg(F.count("*").alias("periods")).where(F.col("periods") < length)


def latest_period(series: DataFrame, grain: str = "month") -> DataFrame:
    """Metadata of each market's latest period."""
    row = F.max_by(F.struct("datekey", "revenue", "quantity"), F.struct(*period_columns(grain)))
    return series.groupBy("market").agg(row.alias("_row")).select(
        "market", "_row.datekey", "_row.revenue", "_row.quantity",
        X.product_range(F.col("_row.revenue")).alias("productrange"),
    )


def with_static(steps: DataFrame, static: DataFrame) -> DataFrame:
    """Steps of markets that have static features."""
    return steps.join(static.select("market"), "market", "left_semi")


def without_static(steps: DataFrame, static: DataFrame) -> DataFrame:
    return steps.select("market").distinct().join(static.select("market"), "market", "left_anti")


def assemble_sequences(steps: DataFrame, features: list[str] = STEP_FEATURES) -> DataFrame:
    """One row per market with its steps in order: ``sequence array<array<double>>``.

    A group holds one row per step, a number fixed by the sequence length.
    """
    vector = F.array(*[F.col(c).cast("double") for c in features])
    ordered = F.sort_array(F.collect_list(F.struct("step", vector.alias("v"))))
    return steps.groupBy("market").agg(F.transform(ordered, lambda s: s["v"]).alias("sequence"))


def periods_per_market(series: DataFrame, top: int = 5) -> DataFrame:
    return series.groupBy("market").agg(F.count("*").alias("periods")).orderBy(
        F.col("periods").desc(), "market"
    ).limit(top)


def extract_summary(series: DataFrame) -> DataFrame:
    return series.agg(
        F.count("*").alias("row_count"), F.count_distinct("market").alias("markets"),
        F.min("datekey").alias("first_datekey"), F.max("datekey").alias("last_datekey"),
    )
