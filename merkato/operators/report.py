"""All checks of a warehouse from about two scans of each table.

Rules are declared, then compiled. What looks at single rows becomes one aggregate for each table. What looks at keys
(uniqueness, references) becomes one count by rule and key: each table is read once, its rows give one entry per key they
are checked for, entries are combined where they are read, and the keys of both ends of a reference meet in the same group.
Versions of all tables are swept together for overlaps.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from merkato import schemas
from merkato.functions import expressions as X
from merkato.operators import quality
from merkato.sources.tables import union_all

#: Numbers in a column's profile.
PROFILE = ["min", "max", "mean", "std", "p25", "p50", "p75"]
#: Most columns of a key.
KEY_COLUMNS = 2


@dataclass(frozen=True)
class Rows:
    """Rows of a table for which a condition holds."""

    name: str
    table: str
    condition: Callable[[], Column]
    info: bool = False


@dataclass(frozen=True)
class Unique:
    """Keys that occur more than once, among active rows or all."""

    name: str
    table: str
    keys: list[str]
    active: bool = False


@dataclass(frozen=True)
class Reference:
    """Rows whose key is NULL or has no row in the parent table."""

    name: str
    table: str
    key: str
    parent: str
    parent_key: str


@dataclass(frozen=True)
class Disjoint:
    """Pairs of versions of one key that overlap."""

    name: str
    table: str
    keys: list[str]


def _versioned(table: str, keys: list[str]) -> list:
    return [
        Unique(f"{table}: several active versions", table, keys, active=True),
        Disjoint(f"{table}: overlapping versions", table, keys),
        Rows(f"{table}: active version with an end", table,
             lambda: F.col("IsActive") & (F.col("ValidTo") != F.lit(schemas.OPEN_END).cast("timestamp_ntz"))),
    ]


_BRIDGE = "BridgeProductSpecialOffer"

RULES = [
    Reference("FactSale -> Bridge", "FactSale", "BrdgProductSpecialOfferKey", _BRIDGE, "BrdgProductSpecialOfferKey"),
    Reference("Bridge -> DimProduct", _BRIDGE, "ProductSuggorateKey", "DimProduct", "ProductSuggorateKey"),
    Reference("FactSale -> DimCustomer", "FactSale", "DimCustomerKey", "DimCustomer", "CustomerSuggorateKey"),
    Reference("FactSale -> DimTerritory", "FactSale", "DimTerritoryKey", "DimTerritory", "TerritorySuggorateKey"),
    Reference("FactSale -> DimTime", "FactSale", "DimTimeKey", "DimTime", "DateKey"),
    Reference("Bridge -> DimSpecialOffer", _BRIDGE, "SpecialOfferSuggorateKey", "DimSpecialOffer", "SpecialOfferSuggorateKey"),
    *[rule for table, (keys, _) in quality.VERSIONED.items() for rule in _versioned(table, keys)],
    Rows("DateKey format", "DimTime", lambda: ~X.has_length(F.col("DateKey"), 8)),
    Unique("Duplicate DateKeys", "DimTime", ["DateKey"]),
    Rows("Active bridge records", _BRIDGE, lambda: F.col("IsActive"), info=True),
    Rows("Inactive bridge records", _BRIDGE, lambda: ~F.col("IsActive"), info=True),
    *[Unique(f"{table}: duplicate {key}", table, [key]) for table, key in quality.SURROGATE_KEYS.items()],
    Rows("LoyaltyStatus in the four tiers", "DimCustomer", lambda: ~F.col("LoyaltyStatus").isin(quality.LOYALTY_VALUES)),
    Rows("LifeTimeValue not negative", "DimCustomer", lambda: F.col("LifeTimeValue") < 0),
    Rows("DiscountPct between 0 and 1", "DimSpecialOffer", lambda: (F.col("DiscountPct") < 0) | (F.col("DiscountPct") > 1)),
]


def null_rules(tables: list[str]) -> list[Rows]:
    """One informative rule for each column: its NULLs."""
    return [Rows(f"{table}.{column}: NULL", table, lambda column=column: F.col(column).isNull(), info=True)
            for table in tables for column in schemas.TABLES[table].fieldNames()]


def table_profile(df: DataFrame, table: str) -> DataFrame:
    """One row per column, from one scan: NULLs, values, and for numbers range, mean, sample deviation and quartiles.

    Quartiles come from sketches, so their rank is within ``quality.RANK_ERROR``; ``quality.distribution`` has exact ones.
    """
    def of(field) -> Column:
        c = F.col(field.name)
        parts = [F.lit(field.name).alias("column_name"), F.count_if(c.isNull()).alias("nulls"), F.count(c).alias("values")]
        if isinstance(field.dataType, T.NumericType):
            x, sketch = c.cast("double"), F.kll_sketch_agg_double(c.cast("double"), quality.SKETCH)
            numbers = [F.min(x), F.max(x), quality.column_mean(df, field.name), F.stddev_samp(x),
                       *[F.when(F.count(c) > 0, F.kll_sketch_get_quantile_double(sketch, F.lit(p))) for p in (0.25, 0.5, 0.75)]]
        else:
            numbers = [F.lit(None)] * len(PROFILE)
        return F.struct(*parts, *[n.cast("double").alias(name) for name, n in zip(PROFILE, numbers, strict=True)])

    return df.agg(F.array(*[of(f) for f in df.schema.fields]).alias("e")).select(F.explode("e").alias("e")).select(
        F.lit(table).alias("table_name"), "e.*")


def table_profiles(wh, tables: list[str]) -> DataFrame:
    """``table_profile`` of the declared columns of each table."""
    return union_all([table_profile(wh.table(t).select(*schemas.TABLES[t].fieldNames()), t) for t in tables])


def run_rules(wh, rules: list = RULES) -> DataFrame:
    """One row ``(check_name, issues, status)`` per rule."""
    numbered = list(enumerate(rules))
    parts = [
        *_row_counts(wh, [(i, rule) for i, rule in numbered if isinstance(rule, Rows)]),
        *_key_counts(wh, [(i, rule) for i, rule in numbered if isinstance(rule, (Unique, Reference))]),
        *_overlaps(wh, [(i, rule) for i, rule in numbered if isinstance(rule, Disjoint)]),
    ]
    spark = wh.spark
    names = spark.createDataFrame([(i, rule.name, isinstance(rule, Rows) and rule.info) for i, rule in numbered],
                                  "rule int, check_name string, info boolean")
    # A rule over nothing found nothing. One row per rule.
    counted = union_all([names.select("rule", F.lit(0).cast("long").alias("issues")), *parts]).groupBy("rule").agg(
        F.sum("issues").cast("long").alias("issues"))
    status = F.when(F.col("info"), "INFO").when(F.col("issues") == 0, "OK").otherwise("ISSUE")
    return names.join(F.broadcast(counted), "rule").select("check_name", "issues", status.alias("status"))


def _row_counts(wh, rules) -> list[DataFrame]:
    parts = []
    for table in dict.fromkeys(rule.table for _, rule in rules):
        own = [(i, rule) for i, rule in rules if rule.table == table]
        counts = wh.table(table).agg(*[F.count_if(rule.condition()).alias(f"c{i}") for i, rule in own])
        parts.append(counts.select(F.explode(F.array(*[
            F.struct(F.lit(i).alias("rule"), F.col(f"c{i}").alias("issues")) for i, _ in own])).alias("e")).select("e.*"))
    return parts


def _entry(rule: int, keys: list[str], when: Column | None = None, child: bool = False, parent: bool = False) -> Column:
    if len(keys) > KEY_COLUMNS:
        raise ValueError(f"a key has at most {KEY_COLUMNS} columns")
    columns = [F.col(c).cast("long") for c in keys] + [F.lit(0).cast("long")] * (KEY_COLUMNS - len(keys))
    entry = F.struct(F.lit(rule).alias("rule"), *[c.alias(f"k{i}") for i, c in enumerate(columns)],
                     F.lit(child).alias("child"), F.lit(parent).alias("parent"))
    return entry if when is None else F.when(when, entry)


def _key_counts(wh, rules) -> list[DataFrame]:
    entries: dict[str, list[Column]] = {}
    for i, rule in rules:
        own = entries.setdefault(rule.table, [])
        if isinstance(rule, Unique):
            own.append(_entry(i, rule.keys, F.col("IsActive") if rule.active else None))
        else:
            own.append(_entry(i, [rule.key], child=True))
            entries.setdefault(rule.parent, []).append(_entry(i, [rule.parent_key], parent=True))
    if not entries:
        return []
    rows = union_all([wh.table(table).select(F.explode(F.array_compact(F.array(*own))).alias("e")).select("e.*")
                      for table, own in entries.items()])
    keys = rows.groupBy("rule", "k0", "k1").agg(
        F.count("*").alias("rows"), F.count_if("child").alias("children"), F.bool_or("parent").alias("parent"))
    references = [i for i, rule in rules if isinstance(rule, Reference)]
    missing = F.when(F.col("k0").isNull() | ~F.col("parent"), F.col("children")).otherwise(0)
    issues = F.when(F.col("rule").isin(references), missing).otherwise((F.col("rows") > 1).cast("long"))
    return [keys.groupBy("rule").agg(F.sum(issues).alias("issues"))]


def _overlaps(wh, rules) -> list[DataFrame]:
    if not rules:
        return []
    versions = union_all([wh.table(rule.table).select(F.lit(i).alias("rule"), *[
        F.col(rule.keys[n]).cast("long").alias(f"k{n}") if n < len(rule.keys) else F.lit(0).cast("long").alias(f"k{n}")
        for n in range(KEY_COLUMNS)], "ValidFrom", "ValidTo") for i, rule in rules])
    return [quality.overlapping_pairs(versions, ["rule", "k0", "k1"], by="rule")]
