"""A warehouse in files that grows by batches: dimension changes, then the sales they describe.

Every table notes the batches it has taken, so a refresh that failed anywhere is repeated as a whole and changes only what
it had not changed. Dimensions are replaced by closed month, sales by month; the bridge, which has one row per product
version and offer, is derived again from its rows so far and the new pairs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from merkato import schemas
from merkato.operators import loading
from merkato.operators.quality import VERSIONED
from merkato.session import beside_facts, store
from merkato.sources.batches import StagedTable
from merkato.sources.dimensions import VersionedDimension
from merkato.sources.tables import Warehouse

BRIDGE = "BridgeProductSpecialOffer"
REJECTS = "order_id long, detail_id long, no_bridge boolean, no_territory boolean, no_day boolean, no_customer boolean"
SALE_KEYS = ["SalesOrderID", "SalesOrderDetailID"]


class StoredWarehouse(Warehouse):
    """The warehouse's tables under ``root``, changed only by ``apply``."""

    def __init__(self, spark: SparkSession, root: str):
        super().__init__(spark, root)
        self.dimensions = {
            name: VersionedDimension(spark, self.path(name), schemas.TABLES[name], *VERSIONED[name])
            for name in ("DimProduct", "DimSpecialOffer", "DimCustomer")}
        self.others = {name: StagedTable(spark, self.path(name), schemas.TABLES[name], "SaleMonth" if name == "FactSale" else None)
                       for name in ("DimTerritory", "DimTime", BRIDGE, "FactSale")}
        self.rejects = StagedTable(spark, self.path("RejectedSale"), spark.createDataFrame([], REJECTS).schema, "Batch")

    def table(self, name: str) -> DataFrame:
        if name in self.dimensions:
            return self.dimensions[name].rows().select(*schemas.TABLES[name].fieldNames())
        return self.others[name].rows()

    def save(self, name: str, df: DataFrame, replace: bool = False) -> None:
        raise NotImplementedError("a stored warehouse is changed by apply()")

    def apply(self, batch: int, products: DataFrame | None = None, offers: DataFrame | None = None,
              customers: DataFrame | None = None, territories: DataFrame | None = None, lines: DataFrame | None = None) -> None:
        """Take one batch. ``products``, ``offers`` and ``customers`` are dated changes; ``territories`` has new ones.

        ``lines`` are sales: order_id, detail_id, order_date, customer_id, territory_id, product_id, offer_id, line_total,
        order_qty. A line that comes again in its month replaces the one before. Lines that lack a row in a dimension
        are kept apart in ``rejects``.
        """
        for name, changes in (("DimProduct", products), ("DimSpecialOffer", offers), ("DimCustomer", customers)):
            if changes is not None:
                self.dimensions[name].apply(batch, changes)
        if territories is not None:
            self.others["DimTerritory"].replace(
                batch, lambda known: loading.scd0_load(known, territories, ["Territory_ID"], "TerritorySuggorateKey"))
        if lines is not None:
            self._apply_lines(batch, lines)
        self._derived.clear()
        self.parts.clear()

    def _apply_lines(self, batch: int, lines: DataFrame) -> None:
        if all(table.has(batch) for table in (self.others["DimTime"], self.others[BRIDGE], self.others["FactSale"], self.rejects)):
            return  # a repetition looks nothing up
        self.others["DimTime"].replace(batch, lambda known: loading.add_days(known, lines, "order_date"))
        keyed = store(loading.lookup_product_offer(lines, self.table("DimProduct"), self.table("DimSpecialOffer")), "keyed-lines")
        starts = self.table("DimProduct").select("ProductSuggorateKey", F.col("ValidFrom").alias("effective"))
        pairs = keyed.select("ProductSuggorateKey", "SpecialOfferSuggorateKey").dropna().distinct().join(
            beside_facts(starts), "ProductSuggorateKey")
        self.others[BRIDGE].replace(
            batch, lambda known: loading.close_superseded(loading.build_bridge(pairs, known), self.table("DimProduct")))
        facts, rejects = loading.build_fact_sale(
            keyed, self.table(BRIDGE), self.table("DimCustomer"), self.table("DimTerritory"), self.table("DimTime"),
            written=True)
        month = (F.col("DimTimeKey") / 100).cast("int")
        self.others["FactSale"].upsert(batch, facts.withColumn("SaleMonth", month), SALE_KEYS)
        self.rejects.upsert(batch, rejects.withColumn("Batch", F.lit(batch).cast("int")), ["order_id", "detail_id"])
