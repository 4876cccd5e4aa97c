"""Warehouse checks (Q)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from merkato import schemas
from merkato.operators import quality, report, star
from merkato.plans.catalog.registry import query, r, rounded
from merkato.session import store
from merkato.sources.tables import union_all

_SQL_NAMES = {"DimProduct": "dim_product", "DimSpecialOffer": "dim_offer", "DimCustomer": "dim_customer",
              "BridgeProductSpecialOffer": "bridge", "DimTerritory": "dim_territory", "DimTime": "dim_time"}


def _check(name: str, count: str) -> str:
    return (f"SELECT '{name}' AS check_name, n AS issues, CASE WHEN n = 0 THEN 'OK' ELSE 'ISSUE' END AS status "
            f"FROM (SELECT CAST(coalesce(({count}), 0) AS BIGINT) AS n)")


def _all(checks) -> str:
    return " UNION ALL ".join(_check(name, count) for name, count in checks)


def _orphans(child, child_key, parent, parent_key):
    return (f"SELECT count(*) FROM {child} c LEFT JOIN {parent} p ON c.{child_key} = p.{parent_key} "
            f"WHERE p.{parent_key} IS NULL")


_BRIDGE = "BrdgProductSpecialOfferKey"
_VERSIONED = [(t, _SQL_NAMES[t], keys, sk) for t, (keys, sk) in quality.VERSIONED.items()]


def _groups(prefix: str = "") -> dict[str, list[tuple[str, str]]]:
    """Name and counting SQL of every check, over the warehouse's tables or those of the same name behind ``prefix``."""
    fact, bridge, product, offer, customer, territory, time = (prefix + t for t in (
        "fact_sale", "bridge", "dim_product", "dim_offer", "dim_customer", "dim_territory", "dim_time"))
    return {
        "Q1": [("FactSale -> Bridge", _orphans(fact, _BRIDGE, bridge, _BRIDGE))],
        "Q2": [("Bridge -> DimProduct", _orphans(bridge, "ProductSuggorateKey", product, "ProductSuggorateKey"))],
        "Q3": [
            ("FactSale -> DimCustomer", _orphans(fact, "DimCustomerKey", customer, "CustomerSuggorateKey")),
            ("FactSale -> DimTerritory", _orphans(fact, "DimTerritoryKey", territory, "TerritorySuggorateKey")),
            ("FactSale -> DimTime", _orphans(fact, "DimTimeKey", time, "DateKey")),
        ],
        "Q4": [("Bridge -> DimSpecialOffer", _orphans(bridge, "SpecialOfferSuggorateKey", offer, "SpecialOfferSuggorateKey"))],
        "Q5": [(f"{t}: several active versions",
                f"SELECT count(*) FROM (SELECT 1 FROM {prefix}{s} WHERE IsActive GROUP BY {', '.join(keys)} HAVING count(*) > 1)")
               for t, s, keys, _ in _VERSIONED],
        "Q6": [(f"{t}: overlapping versions",
                f"SELECT count(*) FROM (SELECT *, row_number() OVER (ORDER BY {sk}) AS n FROM {prefix}{s}) a "
                f"JOIN (SELECT *, row_number() OVER (ORDER BY {sk}) AS n FROM {prefix}{s}) b "
                f"ON {' AND '.join(f'a.{k} = b.{k}' for k in keys)} AND a.n < b.n "
                "WHERE a.ValidFrom < b.ValidTo AND a.ValidTo > b.ValidFrom") for t, s, keys, sk in _VERSIONED],
        "Q7": [(f"{t}: active version with an end",
                f"SELECT count(*) FROM {prefix}{s} WHERE IsActive AND ValidTo != TIMESTAMP '9999-12-31 23:59:59'")
               for t, s, _, _ in _VERSIONED],
        "Q8": [("DateKey format", f"SELECT count(*) FROM {time} WHERE length(CAST(DateKey AS VARCHAR)) != 8")],
        "Q9": [("Duplicate DateKeys", f"SELECT count(*) FROM (SELECT 1 FROM {time} GROUP BY DateKey HAVING count(*) > 1)")],
        "Q12": [(f"{t}: duplicate {k}",
                 f"SELECT count(*) FROM (SELECT 1 FROM {prefix}{_SQL_NAMES[t]} GROUP BY {k} HAVING count(*) > 1)")
                for t, k in quality.SURROGATE_KEYS.items()],
        "Q15": [
            ("LoyaltyStatus in the four tiers",
             f"SELECT count(*) FROM {customer} WHERE LoyaltyStatus NOT IN ('Platinum', 'Gold', 'Silver', 'Bronze')"),
            ("LifeTimeValue not negative", f"SELECT count(*) FROM {customer} WHERE LifeTimeValue < 0"),
            ("DiscountPct between 0 and 1", f"SELECT count(*) FROM {offer} WHERE DiscountPct < 0 OR DiscountPct > 1"),
        ],
    }


def _activity(prefix: str = "") -> str:
    return (f"SELECT 'Active bridge records' AS check_name, count(*) FILTER (IsActive) AS issues, 'INFO' AS status FROM {prefix}bridge "
            f"UNION ALL SELECT 'Inactive bridge records', count(*) FILTER (NOT IsActive), 'INFO' FROM {prefix}bridge")


_CHECKS, _Q11 = _groups(), _activity()


@query("Q1_fact_to_bridge", _all(_CHECKS["Q1"]))
def _(wh):
    return quality.fact_to_bridge(wh)


@query("Q2_bridge_to_product", _all(_CHECKS["Q2"]))
def _(wh):
    return quality.bridge_to_product(wh)


@query("Q3_fact_to_dimensions", _all(_CHECKS["Q3"]))
def _(wh):
    return quality.fact_to_dimensions(wh)


@query("Q4_bridge_to_offer", _all(_CHECKS["Q4"]))
def _(wh):
    return quality.bridge_to_offer(wh)


@query("Q5_several_active_versions", _all(_CHECKS["Q5"]))
def _(wh):
    return quality.active_checks(wh)


@query("Q6_overlapping_versions", _all(_CHECKS["Q6"]))
def _(wh):
    return quality.overlap_checks(wh)


@query("Q7_active_version_with_end", _all(_CHECKS["Q7"]))
def _(wh):
    return quality.open_end_checks(wh)


@query("Q8_date_key_format", _all(_CHECKS["Q8"]))
def _(wh):
    return quality.date_key_format(wh.table("DimTime"))


@query("Q9_duplicate_date_keys", _all(_CHECKS["Q9"]))
def _(wh):
    return quality.duplicate_date_keys(wh.table("DimTime"))


@query("Q10_date_coverage", "SELECT min(DateKey) AS first_date, max(DateKey) AS last_date, count(*) AS dates FROM dim_time")
def _(wh):
    return quality.date_coverage(wh.table("DimTime"))


@query("Q11_bridge_activity", _Q11)
def _(wh):
    return quality.bridge_activity(wh.table("BridgeProductSpecialOffer"))


@query("Q12_duplicate_surrogates", _all(_CHECKS["Q12"]))
def _(wh):
    return quality.duplicate_surrogates(wh)


_NULLABLE = ["loyalty", "lifetimevalue", "season", "revenue"]


@query("Q13_null_counts", " UNION ALL ".join(
    f"SELECT 'sales' AS table_name, '{c}' AS column_name, count(*) - count({c}) AS nulls FROM gaps" for c in _NULLABLE),
       ctes="gaps AS (SELECT nullif(LoyaltyStatus, 'Bronze') AS loyalty, LifeTimeValue AS lifetimevalue, "
       "nullif(Season, 'Winter') AS season, Revenue AS revenue FROM star_current)")
def _(wh):
    gaps = star.sales_star(wh).select(
        F.nullif("LoyaltyStatus", F.lit("Bronze")).alias("loyalty"), F.col("LifeTimeValue").alias("lifetimevalue"),
        F.nullif("Season", F.lit("Winter")).alias("season"), F.col("Revenue").alias("revenue"))
    return quality.null_counts(gaps, "sales")


_STATS = ["Revenue", "ProductQuantity", "LifeTimeValue", "Month"]


@query("Q14_distribution", " UNION ALL ".join(
    f"SELECT 'sales' AS table_name, '{c}' AS column_name, count({c}) AS values, CAST(min({c}) AS DOUBLE) AS min, "
    f"CAST(max({c}) AS DOUBLE) AS max, {r(f'CAST(sum({c}) AS DOUBLE) / count({c})', 4)} AS mean, "
    f"{r(f'stddev_samp(CAST({c} AS DOUBLE))', 4)} AS std, " + ", ".join(
        f"{r(f'quantile_cont(CAST({c} AS DOUBLE), {p / 100})', 4)} AS p{p}" for p in (25, 50, 75)) + " FROM star_current"
    for c in _STATS))
def _(wh):
    found = quality.distribution(star.sales_star(wh).select(*_STATS), "sales")
    return rounded(found, ["mean", "std", "p25", "p50", "p75"], 4)


_ALL_NUMBERS = {table: [f.name for f in schemas.TABLES[table].fields if isinstance(f.dataType, T.NumericType)]
                for table in [*_SQL_NAMES, "FactSale"]}


@query("Q14_sketched_quantiles", " UNION ALL ".join(
    f"SELECT '{table}' AS table_name, '{c}' AS column_name, count({c}) AS values, true AS within_error FROM {_SQL_NAMES.get(table, 'fact_sale')}"
    for table, columns in _ALL_NUMBERS.items() for c in columns))
def _(wh):
    parts = []
    for table, columns in _ALL_NUMBERS.items():
        df = wh.table(table)
        # Facts are sketched by month and merged, as a growing table would be.
        sketches = quality.quantile_sketches(df, columns, ["SaleMonth"] if table == "FactSale" else [])
        if table == "FactSale":
            sketches = quality.merged_sketches(sketches, columns)
        found = store(quality.sketched_quantiles(sketches, columns), "quantiles")
        errors = quality.rank_errors(df, found)
        parts.append(found.join(errors, ["column_name", "probability"]).groupBy("column_name").agg(
            F.max("values").alias("values"), F.bool_and(F.col("error") <= quality.RANK_ERROR).alias("within_error")).select(
            F.lit(table).alias("table_name"), "column_name", "values", "within_error"))
    return union_all(parts)


@query("Q15_domain_checks", _all(_CHECKS["Q15"]))
def _(wh):
    return quality.domain_checks(wh.table("DimCustomer"), wh.table("DimSpecialOffer"))


@query("Q16_any_issue", f"SELECT max(n) > 0 AS has_issues FROM (SELECT ({_orphans('fact_sale', _BRIDGE, '(SELECT * FROM bridge WHERE IsActive)', _BRIDGE)}) AS n)")
def _(wh):
    bridge = star.current(wh.table("BridgeProductSpecialOffer"))
    return quality.any_issue(union_all([
        quality.fact_to_bridge(wh),
        quality.result("FactSale -> active bridge", star.orphans(wh.table("FactSale"), _BRIDGE, bridge, _BRIDGE))]))


@query("Q_full_report", _all(sum(_CHECKS.values(), [])) + " UNION ALL " + _Q11)
def _(wh):
    return quality.full_report(wh)


# Faults planted by key, the same in both languages: table, SQL of its columns replaced, copies of rows added.
_END = "9999-12-31 23:59:59"
_FAULTS = {
    "FactSale": ({
        "BrdgProductSpecialOfferKey": "CASE WHEN SalesOrderDetailID % 89 = 0 THEN NULL ELSE BrdgProductSpecialOfferKey END",
        "DimCustomerKey": "CASE WHEN SalesOrderDetailID % 97 = 0 THEN -DimCustomerKey ELSE DimCustomerKey END",
        "DimTerritoryKey": "CASE WHEN SalesOrderDetailID % 83 = 0 THEN DimTerritoryKey + 1000 ELSE DimTerritoryKey END",
        "DimTimeKey": "CASE WHEN SalesOrderDetailID % 79 = 0 THEN 19000101 ELSE DimTimeKey END",
    }, None),
    "BridgeProductSpecialOffer": ({
        "ProductSuggorateKey": "CASE WHEN BrdgProductSpecialOfferKey % 50 = 1 THEN -ProductSuggorateKey ELSE ProductSuggorateKey END",
        "SpecialOfferSuggorateKey": "CASE WHEN BrdgProductSpecialOfferKey % 50 = 2 THEN NULL ELSE SpecialOfferSuggorateKey END",
        "ValidTo": f"CASE WHEN BrdgProductSpecialOfferKey % 50 = 3 THEN {{ts}}'2050-01-01 00:00:00' ELSE ValidTo END",
    }, "BrdgProductSpecialOfferKey % 50 = 4"),
    "DimProduct": ({
        "ValidTo": "CASE WHEN ProductSuggorateKey % 40 = 2 THEN {ts}'2050-01-01 00:00:00' ELSE ValidTo END",
        "Class": "CASE WHEN ProductSuggorateKey % 40 = 3 THEN NULL ELSE Class END",
    }, "ProductSuggorateKey % 40 = 1"),
    "DimSpecialOffer": ({
        "DiscountPct": "CASE WHEN SpecialOfferSuggorateKey = 3 THEN 1.5 ELSE DiscountPct END",
        "ValidTo": "CASE WHEN SpecialOfferSuggorateKey = 2 THEN {ts}'2050-01-01 00:00:00' ELSE ValidTo END",
    }, "SpecialOfferSuggorateKey = 1"),
    "DimCustomer": ({
        "LoyaltyStatus": "CASE WHEN CustomerSuggorateKey % 30 = 1 THEN 'Tin' ELSE LoyaltyStatus END",
        "LifeTimeValue": "CASE WHEN CustomerSuggorateKey % 30 = 2 THEN -1 ELSE LifeTimeValue END",
        "ValidTo": "CASE WHEN CustomerSuggorateKey % 30 = 4 THEN {ts}'2050-01-01 00:00:00' ELSE ValidTo END",
    }, "CustomerSuggorateKey % 30 = 3"),
    "DimTerritory": ({}, "TerritorySuggorateKey % 5 = 1"),
    "DimTime": ({"DateKey": "CASE WHEN TimeSuggorateKey % 25 = 1 THEN DateKey * 10 ELSE DateKey END"}, "TimeSuggorateKey % 25 = 2"),
}


def _faulty_cte(table: str) -> str:
    name = _SQL_NAMES.get(table, "fact_sale")
    replaced, copied = _FAULTS[table]
    columns = ", ".join(f"{expression.format(ts='TIMESTAMP ')} AS {c}" for c, expression in replaced.items())
    sql = f"SELECT * REPLACE ({columns}) FROM {name}" if replaced else f"SELECT * FROM {name}"
    twice = f"{sql} UNION ALL {sql} WHERE {copied}" if copied else sql
    return f"bad_{name} AS ({twice})"


class FaultyWarehouse:
    """The warehouse with every kind of fault in some of its rows."""

    def __init__(self, wh):
        self.wh, self.spark = wh, wh.spark

    def table(self, name: str):
        df, (replaced, copied) = self.wh.table(name), _FAULTS[name]
        bad = df.withColumns({c: F.expr(expression.format(ts="timestamp_ntz")).cast(df.schema[c].dataType)
                              for c, expression in replaced.items()})
        return bad.unionByName(bad.join(df.where(copied).select(df.columns[0]), df.columns[0], "left_semi")) if copied else bad


_NULLS = " UNION ALL ".join(
    f"SELECT '{table}.{c}: NULL' AS check_name, count(*) - count({c}) AS issues, 'INFO' AS status FROM bad_{_SQL_NAMES.get(table, 'fact_sale')}"
    for table in _FAULTS for c in schemas.TABLES[table].fieldNames())


@query("Q_planted_faults", _all(sum(_groups("bad_").values(), [])) + " UNION ALL " + _activity("bad_") + " UNION ALL " + _NULLS,
       ctes=", ".join(map(_faulty_cte, _FAULTS)))
def _(wh):
    return quality.full_report(FaultyWarehouse(wh), nulls=list(_FAULTS))


def _profiled(table: str, field: T.StructField) -> str:
    c, name = field.name, _SQL_NAMES.get(table, "fact_sale")
    numbers = (f"CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max, {r(f'CAST(sum({c}) AS DOUBLE) / count({c})', 3)} AS mean, "
               f"{r(f'stddev_samp(CAST({c} AS DOUBLE))', 3)} AS std, count({c}) > 0 AS has_quartiles")
    if not isinstance(field.dataType, T.NumericType):
        numbers = "NULL::DOUBLE AS min, NULL::DOUBLE AS max, NULL::DOUBLE AS mean, NULL::DOUBLE AS std, false AS has_quartiles"
    return f"SELECT '{table}' AS table_name, '{c}' AS column_name, count(*) - count({c}) AS nulls, count({c}) AS values, {numbers} FROM bad_{name}"


@query("Q13_table_profiles", " UNION ALL ".join(_profiled(t, f) for t in _FAULTS for f in schemas.TABLES[t].fields),
       ctes=", ".join(map(_faulty_cte, _FAULTS)))
def _(wh):
    found = report.table_profiles(FaultyWarehouse(wh), list(_FAULTS))
    ordered = F.coalesce((F.col("min") <= F.col("p25")) & (F.col("p25") <= F.col("p50")) & (F.col("p50") <= F.col("p75"))
                         & (F.col("p75") <= F.col("max")), F.lit(False))
    return rounded(found.withColumn("has_quartiles", ordered).drop("p25", "p50", "p75"), ["mean", "std"], 3)
