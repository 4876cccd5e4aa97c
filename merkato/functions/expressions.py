"""Column expressions: tiers, ratios, growth, date parts, lenient casts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Tier bounds, growth offset, null marker, season names by month.
PRODUCT_RANGE_BOUNDS = (10000, 50000)
LTV_BOUNDS = (100, 300)
LOYALTY_BOUNDS = (2000, 1000, 500)
GROWTH_OFFSET = 1e-6
UNKNOWN = "__UNKNOWN__"
SEASONS = {
    "Winter": (12, 1, 2),
    "Spring": (3, 4, 5),
    "Summer": (6, 7, 8),
    "Autumn": (9, 10, 11),
}
MODEL_TAG = "lstm_hybrid_v2.0"


def product_range(revenue: Column, bounds=PRODUCT_RANGE_BOUNDS) -> Column:
    """Low / Medium / High by revenue; NULL and NaN land in High, as no bound holds for them."""
    low, medium = bounds
    is_number = ~F.isnan(revenue.cast("double"))
    return (
        F.when(is_number & (revenue < low), "Low").when(is_number & (revenue < medium), "Medium").otherwise("High")
    )


def ltv_tier(value: Column, bounds=LTV_BOUNDS) -> Column:
    low, medium = bounds
    return F.when(value < low, "Low").when(value < medium, "Medium").when(value.isNotNull(), "High")


def loyalty_tier(revenue: Column, bounds=LOYALTY_BOUNDS) -> Column:
    platinum, gold, silver = bounds
    return (
        F.when(revenue >= platinum, "Platinum")
        .when(revenue >= gold, "Gold")
        .when(revenue >= silver, "Silver")
        .otherwise("Bronze")
    )


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division in doubles, NULL where the denominator is zero."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def growth(current: Column, previous: Column) -> Column:
    now, before = current.cast("double"), previous.cast("double")
    return F.coalesce(F.try_divide(now - before, before + F.lit(GROWTH_OFFSET)), F.lit(0.0))


def lenient_number(text: Column) -> Column:
    return text.try_cast("double")


def has_length(number: Column, length: int) -> Column:
    return F.length(number.cast("string")) == length


def half_even(value: Column, digits: int) -> Column:
    """Round in doubles, a tie to the even digit."""
    scale = F.lit(float(10**digits))
    return F.rint(value.cast("double") * scale) / scale


def date_key(moment: Column) -> Column:
    day = moment.cast("date")
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("long")


def season(moment: Column, names=SEASONS) -> Column:
    month = F.month(moment.cast("date"))
    picked = F.lit(None).cast("string")
    for name, months in names.items():
        picked = F.when(month.isin(*months), name).otherwise(picked)
    return picked


def date_parts(moment: Column, names=SEASONS) -> list[Column]:
    day = moment.cast("date")
    return [
        date_key(moment).alias("DateKey"),
        F.dayofmonth(day).alias("Day"),
        F.month(day).alias("Month"),
        F.quarter(day).alias("Quarter"),
        season(moment, names).alias("Season"),
        F.year(day).alias("Year"),
    ]


def model_version(run_date: dt.date | Column, tag: str = MODEL_TAG) -> Column:
    day = run_date if isinstance(run_date, Column) else F.lit(run_date)
    return F.concat(F.lit(tag + "_"), F.date_format(day, "yyyyMMdd"))
