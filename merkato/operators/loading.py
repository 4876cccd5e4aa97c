"""Warehouse loading: slowly changing dimensions, surrogate keys, dimension and fact builds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merkato import schemas
from merkato.functions import expressions as X
from merkato.functions.ordering import largest_group, neighbour, number_rows
from merkato.operators.star import VERSIONS_JOINED, as_of_lookup, disjoint_versions
from merkato.session import beside_facts, store


def open_end() -> Column:
    return F.lit(schemas.OPEN_END).cast("timestamp_ntz")


def assign_keys(rows: DataFrame, natural_key: list[str], surrogate_key: str,
                existing: DataFrame | None = None) -> DataFrame:
    """Number new rows from ``max(existing)+1`` in natural-key order."""
    start = 1
    if existing is not None:
        start = (existing.agg(F.max(surrogate_key)).first()[0] or 0) + 1
    return number_rows(rows, [F.col(c) for c in natural_key], surrogate_key, start)


def scd0_load(existing: DataFrame | None, incoming: DataFrame, natural_key: list[str],
              surrogate_key: str) -> DataFrame:
    """Insert keys not seen before; rows already present never change. Of rows with one key, the smallest is taken."""
    values = [c for c in incoming.columns if c not in natural_key]
    unseen = incoming.groupBy(*natural_key).agg(F.min(F.struct(F.lit(0).alias("_"), *values)).alias("_row")).select(
        *[F.col(f"_row.{c}") if c in values else F.col(c) for c in incoming.columns])
    if existing is None:
        return assign_keys(unseen, natural_key, surrogate_key)
    unseen = unseen.join(beside_facts(existing), natural_key, "left_anti")
    return existing.unionByName(assign_keys(unseen, natural_key, surrogate_key, existing).select(*existing.columns))


def scd2_merge(current: DataFrame | None, incoming: DataFrame, natural_key: list[str], tracked: list[str],
               surrogate_key: str, effective: str = "effective") -> DataFrame:
    """Apply dated changes to a versioned dimension; ``current=None`` is the first load.

    ``incoming`` holds the natural key, the tracked columns and the instant from which
    they hold. A key may change several times in one batch, a change may arrive late,
    and replaying a batch changes nothing. Keys absent from the batch stay as they are.
    """
    changes = dated_changes(incoming, natural_key, tracked, effective)
    if current is None:
        return changed_versions(None, changes, natural_key, tracked, surrogate_key, 1)
    keys = beside_facts(changes.select(*natural_key).distinct(), changes)
    start = (current.agg(F.max(surrogate_key)).first()[0] or 0) + 1
    changed = changed_versions(current.join(keys, natural_key, "left_semi"), changes, natural_key, tracked, surrogate_key, start)
    untouched = current.join(keys, natural_key, "left_anti").select(*changed.columns)
    return untouched.unionByName(changed)


def dated_changes(incoming: DataFrame, natural_key: list[str], tracked: list[str], effective: str = "effective") -> DataFrame:
    """One written row ``(natural key, ValidFrom, _new)`` per key and instant; rows that lack either are left out.

    The incoming rows may be costly to derive, and a merge reads its changes several times.
    """
    keyed = incoming.dropna(subset=[*natural_key, effective])
    return store(
        keyed.groupBy(*natural_key, F.col(effective).alias("ValidFrom")).agg(F.max(F.struct(*tracked)).alias("_new")), "changes")


def changed_versions(versions: DataFrame | None, changes: DataFrame, natural_key: list[str], tracked: list[str],
                     surrogate_key: str, start: int) -> DataFrame:
    """All versions, after ``changes``, of the keys that these name; ``versions`` are those keys' stored ones.

    New versions are numbered from ``start``. Both the merge and the chain of versions are written once.
    """
    columns = [surrogate_key, *natural_key, *tracked, "ValidFrom", "ValidTo", "IsActive"]
    if versions is None:
        merged = changes.select(
            *natural_key, "ValidFrom", F.lit(None).cast("long").alias(surrogate_key), F.col("_new").alias("_values"))
    else:
        old = versions.select(*natural_key, "ValidFrom", surrogate_key, F.struct(*tracked).alias("_old"))
        merged = store(old.join(changes, [*natural_key, "ValidFrom"], "full_outer").select(
            *natural_key, "ValidFrom", surrogate_key, F.coalesce("_new", "_old").alias("_values")), "merged-versions")
    largest = largest_group(merged, natural_key)
    steps = neighbour(merged, natural_key, ["ValidFrom"], ["_values"], -1, largest)
    # A stored version stays even when it repeats its predecessor; a new row must differ.
    kept = steps.where(F.col(surrogate_key).isNotNull() | ~F.col("_values").eqNullSafe(F.col("prev__values")))
    chained = neighbour(kept.drop("prev__values"), natural_key, ["ValidFrom"], ["ValidFrom"], +1, largest).select(
        *natural_key, "ValidFrom", surrogate_key, "_values.*",
        F.coalesce("next_ValidFrom", open_end()).alias("ValidTo"),
        F.col("next_ValidFrom").isNull().alias("IsActive"),
    )
    order = [F.col(c) for c in [*natural_key, "ValidFrom"]]
    if versions is None:
        return number_rows(chained.drop(surrogate_key), order, surrogate_key, start).select(*columns)
    chained = store(chained, "chained-versions")
    new = chained.where(F.col(surrogate_key).isNull()).drop(surrogate_key)
    numbered = number_rows(new, order, surrogate_key, start).select(*columns)
    return chained.where(F.col(surrogate_key).isNotNull()).select(*columns).unionByName(numbered)


# ---------------------------------------------------------------- dimensions


def build_dim_time(orders: DataFrame, order_date: str, seasons=X.SEASONS) -> DataFrame:
    days = orders.select(F.col(order_date).cast("date").alias("_day")).where("_day IS NOT NULL").distinct()
    return assign_keys(days.select(*X.date_parts(F.col("_day"), seasons)), ["DateKey"], "TimeSuggorateKey")


def add_days(known: DataFrame, orders: DataFrame, order_date: str, seasons=X.SEASONS) -> DataFrame:
    """The time dimension with the days it lacks; known days keep their keys."""
    new = build_dim_time(orders, order_date, seasons).drop("TimeSuggorateKey").join(known, "DateKey", "left_anti")
    return known.unionByName(assign_keys(new, ["DateKey"], "TimeSuggorateKey", known).select(*known.columns))


def build_dim_territory(territories: DataFrame, provinces: DataFrame, countries: DataFrame,
                        existing: DataFrame | None = None) -> DataFrame:
    """``territories(territory_id)`` ⋈ ``provinces(territory_id, country_code)`` ⋈ ``countries(country_code, country)``."""
    incoming = (
        territories.join(provinces.select("territory_id", "country_code").distinct(), "territory_id")
        .join(countries, "country_code")
        .select(F.col("territory_id").cast("long").alias("Territory_ID"), F.col("country").alias("CountryRegion"))
        .groupBy("Territory_ID").agg(F.min("CountryRegion").alias("CountryRegion"))
    )
    return scd0_load(existing, incoming, ["Territory_ID"], "TerritorySuggorateKey")


PRODUCT_TRACKED = ["ProductName", "Subcategory", "Model", "ProductLine", "Class", "Style"]
OFFER_TRACKED = ["DiscountPct", "Type", "Category"]
CUSTOMER_TRACKED = ["Gender", "LifeTimeValue", "LtvTier", "LoyaltyStatus"]


def product_rows(products: DataFrame, models: DataFrame, subcategories: DataFrame) -> DataFrame:
    """Product attributes with the names of their model and subcategory."""
    return (
        products.join(models, "model_id", "left")
        .join(subcategories, "subcategory_id", "left")
        .select(
            F.col("product_id").cast("long").alias("Product_ID"), F.col("name").alias("ProductName"),
            F.col("subcategory_name").alias("Subcategory"), F.col("model_name").alias("Model"),
            F.col("line").alias("ProductLine"), F.col("class").alias("Class"), F.col("style").alias("Style"),
            F.col("effective"),
        )
    )


def build_dim_product(products: DataFrame, models: DataFrame, subcategories: DataFrame,
                      existing: DataFrame | None = None) -> DataFrame:
    incoming = product_rows(products, models, subcategories)
    return scd2_merge(existing, incoming, ["Product_ID"], PRODUCT_TRACKED, "ProductSuggorateKey")


def build_dim_special_offer(offers: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    return scd2_merge(existing, offers, ["SpecialOffer_ID"], OFFER_TRACKED, "SpecialOfferSuggorateKey")


def lifetime_value(sales: DataFrame, customer: str = "customer_id", amount: str = "line_total") -> DataFrame:
    return sales.groupBy(customer).agg(F.sum(amount).alias("lifetime_value"))


def trailing_revenue(sales: DataFrame, as_of: Column, months: int = 12, customer: str = "customer_id",
                     amount: str = "line_total", order_date: str = "order_date") -> DataFrame:
    day = F.col(order_date).cast("date")
    return sales.where((day > F.add_months(as_of, -months)) & (day <= as_of)).groupBy(customer).agg(
        F.sum(amount).alias("trailing_revenue")
    )


def customer_rows(customers: DataFrame, sales: DataFrame, as_of: Column, ltv_bounds=X.LTV_BOUNDS,
                  loyalty_bounds=X.LOYALTY_BOUNDS) -> DataFrame:
    """``customers(customer_id, gender, effective)`` with lifetime value and loyalty computed from sales.

    Both sums come out of one aggregation, so the sales are shuffled once.
    """
    day, amount = F.col("order_date").cast("date"), F.col("line_total")
    recent = (day > F.add_months(as_of, -12)) & (day <= as_of)
    totals = sales.groupBy("customer_id").agg(
        F.sum(amount).alias("_ltv"), F.sum(F.when(recent, amount)).alias("_recent")
    )
    ltv = F.coalesce("_ltv", F.lit(0)).cast("decimal(18,2)")
    return customers.join(totals, "customer_id", "left").select(
        F.col("customer_id").cast("long").alias("Customer_ID"), F.col("gender").alias("Gender"),
        ltv.alias("LifeTimeValue"), X.ltv_tier(ltv, ltv_bounds).alias("LtvTier"),
        X.loyalty_tier(F.coalesce("_recent", F.lit(0)), loyalty_bounds).alias("LoyaltyStatus"),
        F.col("effective"),
    )


def build_dim_customer(customers: DataFrame, sales: DataFrame, as_of: Column, ltv_bounds=X.LTV_BOUNDS,
                       loyalty_bounds=X.LOYALTY_BOUNDS, existing: DataFrame | None = None) -> DataFrame:
    incoming = customer_rows(customers, sales, as_of, ltv_bounds, loyalty_bounds)
    return scd2_merge(existing, incoming, ["Customer_ID"], CUSTOMER_TRACKED, "CustomerSuggorateKey")


def build_bridge(pairs: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """One version per distinct ``(ProductSuggorateKey, SpecialOfferSuggorateKey, effective)`` pair."""
    keys = ["ProductSuggorateKey", "SpecialOfferSuggorateKey"]
    present = F.lit(True).alias("_present")  # a pair has no attributes that could change
    base = None if existing is None else existing.select("*", present)
    merged = scd2_merge(base, pairs.select(*keys, "effective", present), keys, ["_present"],
                        "BrdgProductSpecialOfferKey")
    return merged.drop("_present")


def close_superseded(bridge: DataFrame, dim_product: DataFrame) -> DataFrame:
    """End a bridge version together with the product version it points at."""
    product = dim_product.select(
        "ProductSuggorateKey", F.col("ValidTo").alias("_to"), F.col("IsActive").alias("_active")
    )
    return bridge.join(beside_facts(product), "ProductSuggorateKey", "left").select(
        *[c for c in bridge.columns if c not in ("ValidTo", "IsActive")],
        F.least("ValidTo", F.coalesce("_to", "ValidTo")).alias("ValidTo"),
        (F.col("IsActive") & F.coalesce("_active", F.lit(True))).alias("IsActive"),
    ).select(*bridge.columns)


# --------------------------------------------------------------------- facts


def lookup_product_offer(lines: DataFrame, dim_product: DataFrame, dim_offer: DataFrame) -> DataFrame:
    """Add the product version valid on the order date and the offer version for the line's discount."""
    with_product = as_of_lookup(lines, dim_product, "product_id", "Product_ID", "order_date", "ProductSuggorateKey")
    return as_of_lookup(with_product, dim_offer, "offer_id", "SpecialOffer_ID", "order_date",
                        "SpecialOfferSuggorateKey")


def lookup_bridge(lines: DataFrame, bridge: DataFrame, dim_product: DataFrame, dim_offer: DataFrame) -> DataFrame:
    """Add the bridge row of the product and offer versions valid on the order date.

    Product versions are joined with their bridge rows first, so the lines are exchanged once for both.
    """
    keys = bridge.select("BrdgProductSpecialOfferKey", "ProductSuggorateKey", "SpecialOfferSuggorateKey")
    largest = largest_group(dim_product.dropna(subset=["Product_ID"]), ["Product_ID"])
    if largest > VERSIONS_JOINED:
        return lookup_product_offer(lines, dim_product, dim_offer).join(
            beside_facts(keys), ["ProductSuggorateKey", "SpecialOfferSuggorateKey"], "left")
    with_offer = as_of_lookup(lines, dim_offer, "offer_id", "SpecialOffer_ID", "order_date", "SpecialOfferSuggorateKey")
    offered = disjoint_versions(dim_product, "Product_ID", "ProductSuggorateKey", largest).join(
        beside_facts(keys.withColumnRenamed("SpecialOfferSuggorateKey", "_offer")), "ProductSuggorateKey").drop("ProductSuggorateKey")
    valid = ((F.col("product_id") == F.col("_nk")) & (F.col("SpecialOfferSuggorateKey") == F.col("_offer"))
             & (F.col("order_date") >= F.col("_from")) & (F.col("order_date") < F.col("_to")))
    return with_offer.join(beside_facts(offered, bridge), valid, "left").drop("_nk", "_offer", "_from", "_to")


def build_fact_sale(lines: DataFrame, bridge: DataFrame, dim_customer: DataFrame, dim_territory: DataFrame,
                    dim_time: DataFrame, written: bool = False) -> tuple[DataFrame, DataFrame]:
    """Facts and rejects from ``lines`` that already carry product and offer keys, or their bridge row.

    Expected columns: order_id, detail_id, order_date, customer_id, territory_id,
    line_total, order_qty, and BrdgProductSpecialOfferKey or ProductSuggorateKey, SpecialOfferSuggorateKey.
    With ``written``, for a caller that takes both frames, the lines with their keys are written once and both are read from that.
    """
    if "BrdgProductSpecialOfferKey" not in lines.columns:
        bridge_keys = bridge.select("BrdgProductSpecialOfferKey", "ProductSuggorateKey", "SpecialOfferSuggorateKey")
        lines = lines.join(beside_facts(bridge_keys), ["ProductSuggorateKey", "SpecialOfferSuggorateKey"], "left")
    found = (
        as_of_lookup(lines, dim_customer, "customer_id", "Customer_ID", "order_date", "CustomerSuggorateKey")
        .join(dim_territory.select(F.col("Territory_ID").alias("territory_id"), "TerritorySuggorateKey"),
              "territory_id", "left")
        .withColumn("_day", X.date_key(F.col("order_date")))
        .join(dim_time.select(F.col("DateKey").alias("_day"), F.lit(True).alias("_known_day")), "_day", "left")
    )
    keys = ["BrdgProductSpecialOfferKey", "TerritorySuggorateKey", "_known_day", "CustomerSuggorateKey"]
    if written:
        found = store(found.select("order_id", "detail_id", "_day", "line_total", "order_qty", *keys), "found-sales")
    complete = F.lit(True)
    for key in keys:
        complete = complete & F.col(key).isNotNull()
    facts = found.where(complete).select(
        F.col("order_id").alias("SalesOrderID"), F.col("detail_id").alias("SalesOrderDetailID"),
        "BrdgProductSpecialOfferKey", F.col("TerritorySuggorateKey").alias("DimTerritoryKey"),
        F.col("_day").alias("DimTimeKey"), F.col("CustomerSuggorateKey").alias("DimCustomerKey"),
        F.col("line_total").alias("Revenue"), F.col("order_qty").alias("ProductQuantity"),
        X.product_range(F.col("line_total")).alias("ProductRange"),
    )
    rejects = found.where(~complete).select(
        "order_id", "detail_id",
        *[F.col(k).isNull().alias(label) for k, label in
          zip(keys, ["no_bridge", "no_territory", "no_day", "no_customer"])],
    )
    return facts, rejects
