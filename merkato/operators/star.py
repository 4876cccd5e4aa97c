"""Joins between the sales facts and their dimensions.

No join carries a broadcast hint: Spark broadcasts a dimension only when its files, or
the bytes that reached the shuffle, are below ``autoBroadcastJoinThreshold``. The files of
keys and repeated names are a small part of their size in memory, so a dimension with more than
``BROADCAST_ROWS`` rows is sort-merged whatever its files' size (``beside_facts``), and
adaptive execution splits a key that holds too many rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from merkato.functions import ordering
from merkato.session import beside_facts

VERSIONS = ("current", "as_recorded")

STAR_COLUMNS = [
    "Revenue", "ProductQuantity", "ProductName", "Subcategory", "Model", "ProductLine", "CountryRegion", "Gender",
    "LifeTimeValue", "LoyaltyStatus", "Year", "Quarter", "Month", "Season",
]


def current(dim: DataFrame) -> DataFrame:
    return dim.where("IsActive")


def _versions(dim: DataFrame, version: str) -> DataFrame:
    if version not in VERSIONS:
        raise ValueError(f"version must be one of {VERSIONS}")
    return current(dim) if version == "current" else dim


def offered_products(wh, version: str = "current", offers: bool = False) -> DataFrame:
    """Bridge rows with their product (and offer) attributes.

    Joining the dimensions to each other first leaves one join for the facts. The result
    is written once per warehouse: its file size tells Spark whether the facts must be
    shuffled for that join at all.
    """
    tables = ["BridgeProductSpecialOffer", "DimProduct", *(["DimSpecialOffer"] if offers else [])]
    return wh.derived(f"products-{version}-{offers}", lambda: _offered_products(wh, version, offers), tables)


def _offered_products(wh, version: str, offers: bool) -> DataFrame:
    bridge = _versions(wh.table("BridgeProductSpecialOffer"), version).select(
        "BrdgProductSpecialOfferKey", "ProductSuggorateKey", "SpecialOfferSuggorateKey")
    product = _versions(wh.table("DimProduct"), version).select(
        "ProductSuggorateKey", "ProductName", "Subcategory", "Model", "ProductLine")
    joined = bridge.join(beside_facts(product), "ProductSuggorateKey")
    if offers:
        joined = joined.join(_versions(wh.table("DimSpecialOffer"), version).select(
            "SpecialOfferSuggorateKey", "DiscountPct"), "SpecialOfferSuggorateKey")
    return joined.drop("ProductSuggorateKey", "SpecialOfferSuggorateKey")


def join_products(facts: DataFrame, products: DataFrame) -> DataFrame:
    return facts.join(beside_facts(products), "BrdgProductSpecialOfferKey")


def join_customer(rows: DataFrame, customer: DataFrame, version: str = "current") -> DataFrame:
    return rows.join(
        beside_facts(_versions(customer, version).select(
            F.col("CustomerSuggorateKey").alias("DimCustomerKey"), "Gender", "LifeTimeValue", "LoyaltyStatus"
        )), "DimCustomerKey",
    )


def join_territory(rows: DataFrame, territory: DataFrame) -> DataFrame:
    return rows.join(
        territory.select(F.col("TerritorySuggorateKey").alias("DimTerritoryKey"), "CountryRegion"), "DimTerritoryKey"
    )


def join_time(rows: DataFrame, time: DataFrame, how: str = "left") -> DataFrame:
    return rows.join(
        time.select(F.col("DateKey").alias("DimTimeKey"), "Year", "Quarter", "Month", "Season"), "DimTimeKey", how
    )


def sales_star(wh, version: str = "current", keep: list[str] | None = None) -> DataFrame:
    """One row per sale with its product, customer, territory and period.

    ``current`` keeps only sales whose dimension versions are still active and allows
    an unknown period; ``as_recorded`` keeps every version and needs the period.
    """
    rows = join_products(wh.table("FactSale"), offered_products(wh, version))
    rows = join_customer(rows, wh.table("DimCustomer"), version)
    rows = join_territory(rows, wh.table("DimTerritory"))
    rows = join_time(rows, wh.table("DimTime"), "left" if version == "current" else "inner")
    return rows.select(*STAR_COLUMNS, *(keep or []))


def orphans(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """One row ``(orphans)``: child rows without a parent; a NULL key is an orphan.

    Child rows are counted per key first, so only distinct keys reach the join.
    """
    keys = child.groupBy(F.col(child_key).alias("_key")).agg(F.count("*").alias("_rows"))
    missing = keys.join(beside_facts(parent.select(F.col(parent_key).alias("_key"))), "_key", "left_anti")
    return missing.agg(F.coalesce(F.sum("_rows"), F.lit(0)).cast("long").alias("orphans"))


# A key with up to this many versions is looked up by a join, which compares each row with all of them.
VERSIONS_JOINED = 64


def disjoint_versions(dim: DataFrame, natural_key: str, surrogate_key: str, largest: int | None = None) -> DataFrame:
    """``(_nk, _from, _to, surrogate key)``: each version ends where the next one of its key starts, if not before.

    Of versions that start together the one with the highest surrogate key stays, so at any instant a key has one
    version at most: the last one started.
    """
    versions = dim.select(
        F.col(natural_key).alias("_nk"), F.col("ValidFrom").alias("_from"), F.col("ValidTo").alias("_to"), F.col(surrogate_key),
    ).dropna(subset=["_nk", "_from", "_to"])
    chained = ordering.neighbour(versions, ["_nk"], ["_from", surrogate_key], ["_from"], +1, largest)
    return chained.withColumn("_to", F.least("_to", F.coalesce("next__from", "_to"))).where("_from < _to").drop("next__from")


def as_of_lookup(rows: DataFrame, dim: DataFrame, row_key: str, natural_key: str, moment: str,
                 surrogate_key: str, joined: int = VERSIONS_JOINED) -> DataFrame:
    """Add the surrogate key of the version valid at ``moment``; NULL when there is none.

    Of overlapping versions the last one started is taken, so that a row is never multiplied. Where keys have few
    versions this is a join, which needs no exchange of the rows if the dimension is small enough for Spark to
    broadcast. With more than ``joined`` versions of a key, rows and versions are merged in order instead.
    """
    largest = ordering.largest_group(dim.dropna(subset=[natural_key]), [natural_key])
    versions = disjoint_versions(dim, natural_key, surrogate_key, largest)
    if largest > joined:
        return as_of_merge(rows, versions, row_key, moment, surrogate_key)
    valid = (F.col(row_key) == F.col("_nk")) & (F.col(moment) >= F.col("_from")) & (F.col(moment) < F.col("_to"))
    return rows.join(beside_facts(versions, dim), valid, "left").drop("_nk", "_from", "_to")


def as_of_merge(rows: DataFrame, versions: DataFrame, row_key: str, moment: str, surrogate_key: str,
                largest: int | None = None) -> DataFrame:
    """``rows`` with the last of the ``disjoint_versions`` started by then, by one pass over both in order.

    Work grows with rows plus versions, not with their product. A key with more rows than one task should sort is cut into
    range slices; the version that holds at a slice's start comes from the slices before it. ``largest`` is the row
    count of the largest key where it is known.
    """
    kinds = dict(versions.dtypes)
    version = F.struct(F.col(surrogate_key), F.col("_to"))
    found = f"struct<{surrogate_key}:{kinds[surrogate_key]},_to:{kinds['_to']}>"
    able = F.col(row_key).isNotNull() & F.col(moment).isNotNull()
    events = rows.where(able).select(
        F.col(row_key).cast(kinds["_nk"]).alias("_nk"), F.col(moment).cast(kinds["_from"]).alias("_at"), F.lit(1).alias("_kind"),
        F.lit(None).cast(found).alias("_version"), F.struct(*rows.columns).alias("_row"))
    starts = versions.select("_nk", F.col("_from").alias("_at"), F.lit(0).alias("_kind"), version.alias("_version"),
                             F.lit(None).cast(events.schema["_row"].dataType).alias("_row"))
    both, order = events.unionByName(starts), ["_at", "_kind"]
    if (ordering.largest_group(events, ["_nk"]) if largest is None else largest) <= ordering.ROWS_PER_TASK:
        last = F.last("_version", ignorenulls=True).over(Window.partitionBy("_nk").orderBy(*order))
        merged = both.withColumn("_version", last)
    else:
        merged = _merged_in_slices(both, order)
    valid = F.when(F.col("_at") < F.col("_version._to"), F.col(f"_version.{surrogate_key}"))
    matched = merged.where("_kind = 1").select("_row.*", valid.alias(surrogate_key))
    return matched.unionByName(rows.where(~able).withColumn(surrogate_key, F.lit(None).cast(kinds[surrogate_key])))


def _merged_in_slices(both: DataFrame, order: list[str]) -> DataFrame:
    sliced = ordering.in_slices(both, [F.col(c) for c in ["_nk", *order]], "as-of")
    per_slice = sliced.groupBy("_nk", "_slice").agg(F.max_by("_version", F.when(F.col("_kind") == 0, F.col("_position"))).alias("_last"))
    across = Window.partitionBy("_nk").orderBy("_slice")  # at most one row per slice
    # A slice's border cuts one key at most, so the keys in several slices have fewer than two rows per slice here.
    carried = per_slice.select(
        F.col("_nk").alias("_of"), F.col("_slice").alias("_in"), F.count("*").over(Window.partitionBy("_nk")).alias("_slices"),
        F.last("_last", ignorenulls=True).over(across.rowsBetween(Window.unboundedPreceding, -1)).alias("_carried"),
    ).where("_slices > 1 AND _carried IS NOT NULL").drop("_slices")
    within = F.last("_version", ignorenulls=True).over(Window.partitionBy("_slice", "_nk").orderBy("_position"))
    return sliced.withColumn("_version", within).join(
        F.broadcast(carried), (F.col("_nk") == F.col("_of")) & (F.col("_slice") == F.col("_in")), "left"
    ).withColumn("_version", F.coalesce("_version", "_carried"))


def in_top(rows: DataFrame, column: str, top: DataFrame) -> DataFrame:
    """Rows whose value is in the top-k frame, which holds k rows."""
    return rows.join(F.broadcast(top.select(column)), column, "left_semi")


def mapped_score(rows: DataFrame, column: str, scores: DataFrame, score: str) -> DataFrame:
    """``rows`` with the score of each category; a category without one scores 0."""
    return rows.join(scores.select(column, score), column, "left").withColumn(
        score, F.coalesce(score, F.lit(0.0))
    )
