"""Static market features and feature preparation for clustering."""

from __future__ import annotations

import re

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from merkato.functions import expressions as X
from merkato.functions.ordering import number_rows
from merkato.operators import star
from merkato.session import store

# Static features in vector order, loyalty tiers, name patterns, limits.
STATIC_FEATURES = [
    "avgdiscount", "platinumshare", "goldshare", "silvershare", "avgltv", "totalproductlines", "totalsubcategories",
]
TIER_SHARES = {"platinumshare": "Platinum", "goldshare": "Gold", "silvershare": "Silver"}
TIME_NAME = r"year|month|day|date|time"
COUNTRY_NAME = r"country|region|territory|nation|countryname"
PREFERRED_CATEGORIES = [
    "Gender", "gender", "CountryRegion", "Country", "Model", "model", "ProductLine", "Subcategory", "city",
]
MAX_CATEGORIES = 12
TOP_CATEGORIES = 10

SHARE_BASES = ("customer", "row")


# ------------------------------------------------------------ static features


def static_rows(wh) -> DataFrame:
    """Current-version sales with market, offer, customer and product attributes."""
    rows = star.join_products(wh.table("FactSale"), star.offered_products(wh, offers=True))
    rows = star.join_customer(rows, wh.table("DimCustomer"))
    rows = star.join_territory(rows, wh.table("DimTerritory"))
    return rows.select(
        F.col("CountryRegion").alias("market"), "DimCustomerKey", "DiscountPct", "LoyaltyStatus", "LifeTimeValue",
        "Subcategory", "ProductLine",
    )


def static_features(rows: DataFrame, share_basis: str = "customer") -> DataFrame:
    """Discount, loyalty shares, lifetime value and product mix per market.

    Loyalty shares divide customers by customers, or sales rows by customers with
    ``share_basis='row'``. Sales are reduced to one row per market and customer before
    the market aggregate, and to distinct products, so no market meets in one task.
    """
    if share_basis not in SHARE_BASES:
        raise ValueError(f"share_basis must be one of {SHARE_BASES}")
    kinds = ["market", "ProductLine", "Subcategory"]
    measures = ["lines", "discount", "discounts", "ltv", "ltvs"]
    # The joined sales are read once, for the customers and for the products.
    reduced = store(rows.groupBy(*kinds, "DimCustomerKey", "LoyaltyStatus").agg(
        F.count("*").alias("lines"), F.sum("DiscountPct").alias("discount"), F.count("DiscountPct").alias("discounts"),
        F.sum("LifeTimeValue").alias("ltv"), F.count("LifeTimeValue").alias("ltvs"),
    ), "static-rows")
    per_customer = reduced.groupBy("market", "DimCustomerKey", "LoyaltyStatus").agg(
        *[F.sum(m).alias(m) for m in measures])
    weight = F.lit(1) if share_basis == "customer" else F.col("lines")

    def share(tier: str) -> Column:
        hits = F.sum(F.when(F.col("LoyaltyStatus") == tier, weight).otherwise(0))
        return X.ratio(hits, F.count("DimCustomerKey"))

    behaviour = per_customer.groupBy("market").agg(
        X.ratio(F.sum("discount"), F.sum("discounts")).alias("avgdiscount"),
        *[share(tier).alias(name) for name, tier in TIER_SHARES.items()],
        X.ratio(F.sum("ltv"), F.sum("ltvs")).alias("avgltv"),
    )
    mix = reduced.select(*kinds).distinct().groupBy("market").agg(
        F.count_distinct("ProductLine").alias("totalproductlines"),
        F.count_distinct("Subcategory").alias("totalsubcategories"),
    )
    return fill_zero(behaviour.join(mix, "market"))


def fill_zero(df: DataFrame) -> DataFrame:
    return df.na.fill(0)


def fill_unknown(df: DataFrame) -> DataFrame:
    """NULL categories become the unknown marker, NULL numbers 0."""
    numeric, categorical = split_types(df)
    return df.select(*[
        F.coalesce(F.col(c).cast("string"), F.lit(X.UNKNOWN)).alias(c) if c in categorical
        else F.coalesce(F.col(c), F.lit(0).cast(df.schema[c].dataType)).alias(c)
        for c in df.columns
    ])


# ---------------------------------------------------------- column selection


def split_types(df: DataFrame, columns: list[str] | None = None) -> tuple[list[str], list[str]]:
    columns = columns or df.columns
    numeric = [c for c in columns if isinstance(df.schema[c].dataType, T.NumericType)]
    return numeric, [c for c in columns if c not in numeric]


def country_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if re.search(COUNTRY_NAME, c, re.I)]


def few_values(df: DataFrame, columns: list[str], at_most: int) -> DataFrame:
    """Exact distinct non-null counts ``(column_name, distinct_values)`` of columns with few values.

    A sketch first rules out the wide columns. At most n values set at most n of its 512
    registers, which keeps its estimate below n + 1 up to n = 31, so no column is missed.
    Only the rest is counted exactly; for a larger n every column is.
    """
    narrow = columns
    if at_most <= 31:
        sketched = df.agg(*[F.approx_count_distinct(c).alias(c) for c in columns]).first()
        narrow = [c for c in columns if sketched[c] <= at_most + 1]
    if not narrow:
        return df.sparkSession.createDataFrame([], "column_name string, distinct_values long")
    counted = df.agg(*[F.count_distinct(c).alias(c) for c in narrow])
    return counted.unpivot([], narrow, "column_name", "distinct_values").where(F.col("distinct_values") <= at_most)


def constant_columns(df: DataFrame, columns: list[str] | None = None) -> list[str]:
    """Columns with a single value, NULL counted as a value; one pass without distinct counts."""
    columns = columns or df.columns
    tests = df.agg(*[
        ((F.count(c) == 0) | ((F.count(c) == F.count("*")) & F.min(c).eqNullSafe(F.max(c)))).alias(c)
        for c in columns
    ]).first()
    return [c for c in columns if tests[c]]


def narrow_time_columns(df: DataFrame, columns: list[str] | None = None, at_most: int = 2) -> list[str]:
    named = [c for c in (columns or df.columns) if re.search(TIME_NAME, c, re.I)]
    return [r[0] for r in few_values(df, named, at_most).select("column_name").collect()] if named else []


def select_features(df: DataFrame, columns: list[str] | None = None) -> list[str]:
    """The columns worth clustering on: constants and near-constant time columns are dropped."""
    chosen = list(columns or df.columns)
    constant = set(constant_columns(df, chosen))
    chosen = [c for c in chosen if c not in constant]
    narrow = set(narrow_time_columns(df, chosen))
    return require_two([c for c in chosen if c not in narrow])


def require_two(columns: list[str]) -> list[str]:
    if len(columns) < 2:
        raise ValueError("select at least 2 features that vary")
    return columns


def categorical_columns(df: DataFrame, at_most: int = MAX_CATEGORIES) -> list[str]:
    """Preferred category columns that exist, then string columns with few values."""
    preferred = [c for c in PREFERRED_CATEGORIES if c in df.columns]
    others = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in preferred]
    if not others:
        return preferred
    few = {r[0] for r in few_values(df, others, at_most).select("column_name").collect()}
    return preferred + [c for c in others if c in few]


# ------------------------------------------------------------------ categories


def top_categories(df: DataFrame, column: str, top: int = TOP_CATEGORIES) -> DataFrame:
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("count")).orderBy(
        F.col("count").desc(), column
    ).limit(top)


def collapse_rare(df: DataFrame, column: str, top: int = TOP_CATEGORIES) -> DataFrame:
    """Keep the most frequent values; all others and NULL become ``Other``."""
    kept = top_categories(df, column, top).select(F.col(column).alias("_kept"))
    collapsed = F.coalesce("_kept", F.lit("Other")).alias(column)
    return df.join(F.broadcast(kept), F.col(column) == F.col("_kept"), "left").select(
        *[collapsed if c == column else F.col(c) for c in df.columns]
    )


def category_scores(df: DataFrame, column: str, revenue: str | None = None, score: str = "score") -> DataFrame:
    """Rank categories by revenue (or count) and spread scores linearly from 1 down to 0."""
    by = F.sum(revenue) if revenue else F.count("*")
    sums = df.where(F.col(column).isNotNull()).groupBy(column).agg(by.alias("_by"))
    ranked = number_rows(sums, [F.col("_by").desc(), F.col(column)], "_rank")
    last = ranked.agg(F.max("_rank")).scalar()
    # Stored, so that the join with all rows knows how small the categories are.
    return store(ranked.select(
        column, F.when(last == 1, 1.0).otherwise(1 - (F.col("_rank") - 1) / (last - 1)).alias(score)
    ), "scores")


# --------------------------------------------------------------------- scaling


def standardize(df: DataFrame, columns: list[str]) -> DataFrame:
    """Zero mean and unit population deviation; a constant column becomes 0."""
    stats = df.agg(F.struct(
        *[F.avg(F.col(c).cast("double")).alias(f"m_{c}") for c in columns],
        *[F.stddev_pop(F.col(c).cast("double")).alias(f"s_{c}") for c in columns],
    )).scalar()
    return df.select(*[
        F.coalesce(F.try_divide(F.col(c).cast("double") - stats[f"m_{c}"], stats[f"s_{c}"]), F.lit(0.0)).alias(c)
        if c in columns else F.col(c)
        for c in df.columns
    ])


def vector_stats(df: DataFrame, column: str) -> Column:
    """Mean, population deviation and count of an array column, as one scalar struct."""
    summary = df.select(array_to_vector(F.col(column).cast("array<double>")).alias("v")).agg(
        Summarizer.metrics("mean", "variance", "count").summary(F.col("v")).alias("s")
    )
    n = F.col("s.count")
    to_population = F.when(n > 1, (n - 1) / n).otherwise(F.lit(0.0))
    return summary.select(F.struct(
        vector_to_array("s.mean").alias("mean"),
        F.transform(vector_to_array("s.variance"), lambda v: F.sqrt(v * to_population)).alias("std"),
        n.alias("count"),
    )).scalar()


def standardize_vectors(df: DataFrame, column: str) -> DataFrame:
    """The same scaling for each position of an array column."""
    with_stats = df.select("*", vector_stats(df, column).alias("_stats"))
    centred = F.zip_with(F.col(column).cast("array<double>"), F.col("_stats.mean"), lambda x, m: x - m)
    scaled = F.zip_with(centred, F.col("_stats.std"), lambda x, s: F.when(s > 0, x / s).otherwise(0.0))
    return with_stats.withColumn(column, scaled).drop("_stats")


def scale_steps(steps: DataFrame, features: list[str]) -> DataFrame:
    """Standardise time-step features over all (market, step) rows."""
    return standardize(steps, features)


def hybrid_vectors(embeddings: DataFrame, static: DataFrame, features: list[str] = STATIC_FEATURES) -> DataFrame:
    """``[embedding, scaled static features]`` per market."""
    scaled = standardize(static.select("market", *features), features)
    return embeddings.join(scaled, "market").select(
        *embeddings.columns,
        F.concat(F.col("embedding").cast("array<double>"), F.array(*features)).alias("vector"),
    )


# --------------------------------------------------------------------- one-hot

# Categories of a column up to which they may become columns of their own.
WIDE = 1_000


def one_hot_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Numeric columns first, then 0/1 columns ``<column>_<value>`` without each first value.

    The result has a column for every value, so the values are read to name them. That is for few values: with more
    than ``WIDE`` of them the call is refused, and ``one_hot_entries`` gives the same as rows.
    """
    values = {}
    for c in columns:
        found = df.select(c).where(F.col(c).isNotNull()).distinct().orderBy(c).limit(WIDE + 2).collect()
        if len(found) > WIDE + 1:
            raise ValueError(f"{c} has more than {WIDE} values for columns of their own: use one_hot_entries")
        values[c] = [r[0] for r in found][1:]
    rest = [c for c in df.columns if c not in columns]
    return df.select(*rest, *[
        F.coalesce(F.col(c) == F.lit(v), F.lit(False)).cast("int").alias(f"{c}_{v}") for c in columns for v in values[c]
    ])


def filled_number(column: str) -> Column:
    return F.coalesce(F.col(column).cast("double"), F.lit(0.0))


def filled_text(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(X.UNKNOWN))


def category_table(df: DataFrame, columns: list[str]) -> DataFrame:
    """``(feature, category, rows, deviation, position)``: the categories of the columns, but for each column's first.

    Positions count from 0 over all columns, in order of column and category. The table is written, so a join with it is
    broadcast only where its size allows; no category passes through the driver.
    """
    empty = df.sparkSession.createDataFrame([], "feature string, category string, rows long")
    counted = empty
    for c in columns:
        counted = counted.unionByName(df.groupBy(filled_text(c).alias("category")).agg(F.count("*").alias("rows")).select(
            F.lit(c).alias("feature"), "category", "rows"))
    counted = store(counted, "categories")
    of_column = counted.groupBy("feature").agg(F.min("category").alias("_first"), F.sum("rows").alias("_all"))
    later = counted.join(of_column, "feature").where(F.col("category") > F.col("_first"))
    share = F.col("rows") / F.col("_all")
    deviation = F.sqrt(share * (1 - share) * F.try_divide(F.col("_all"), F.col("_all") - 1))
    numbered = number_rows(later, [F.col("feature"), F.col("category")], "position", 0)
    return store(numbered.select("feature", "category", "rows", deviation.alias("deviation"), "position"), "category-table")


def one_hot_entries(df: DataFrame, keys: list[str], columns: list[str], table: DataFrame | None = None) -> DataFrame:
    """``(keys, feature, position)``: one row for each 1 of the one-hot encoding, whatever the number of categories."""
    table = category_table(df, columns) if table is None else table
    entries = None
    for c in columns:
        own = table.where(F.col("feature") == c).select(F.col("category").alias("_category"), "feature", "position")
        part = df.select(*keys, filled_text(c).alias("_category")).join(own, "_category").select(*keys, "feature", "position")
        entries = part if entries is None else entries.unionByName(part)
    return entries


def unique_names(columns: list[str]) -> list[str]:
    """Repeated names get the suffix ``__dup1``, ``__dup2``, … in order."""
    earlier = [columns[:place].count(name) for place, name in enumerate(columns)]
    return [name + f"__dup{count}" * bool(count) for name, count in zip(columns, earlier, strict=True)]


def beside(left: DataFrame, right: DataFrame, key: str = "cluster") -> DataFrame:
    """Two frames side by side on their key, with repeated column names made unique."""
    names = unique_names([c for c in left.columns] + [c for c in right.columns if c != key])
    renamed = right.toDF(*[f"_r{i}" for i in range(len(right.columns))])
    at = right.columns.index(key)
    joined = left.join(renamed, F.col(key) == F.col(f"_r{at}"), "left").drop(f"_r{at}")
    return joined.toDF(*names)
