"""Monthly sales metrics from a stored cube whose exact distinct counts can be merged.

Sums can be added up over months, distinct counts cannot. The cube therefore keeps, for each month of facts and each market, the
set of orders, customers, subcategories and product lines as bitmaps of 32,768 numbers each. Bitmaps of several months
are combined with a bitwise or, so any span of months has an exact count without another look at the facts.

Values are numbered once, in order of the month in which they first occur, market by market. The orders of a month and market
then have consecutive numbers and fill few bitmaps, whatever their ids look like. A value keeps its number.

``refresh`` computes only months that the cube lacks, or those it is told to compute again. It reads the facts of these
months once, for a narrow projection; sums and sets are then taken from that projection, each kind of set from its own
columns, so no fact row is expanded into one row per kind.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merkato.functions import expressions as X
from merkato.functions.ordering import number_rows
from merkato.operators import star
from merkato.session import beside_facts, new_path, store
from merkato.sources.tables import union_all

#: What is counted: the metric's name and the column of the projection.
KINDS = {
    "ordercount": "SalesOrderID", "customercount": "DimCustomerKey", "uniquesubcategories": "Subcategory",
    "uniqueproductlines": "ProductLine",
}
_CELL = ["market", "year", "month"]
_NUMBERS = "kind string, id long, name string, number long"
_SETS = "market string, year int, month int, kind string, bucket long, bits binary, SaleMonth int, SaleYear int"
_SUMS = ("market string, year int, month int, datekey long, revenue decimal(38,2), quantity long, lines long, SaleMonth int, SaleYear int")


def month_rows(wh, months: list[int]) -> DataFrame:
    """Current-version sales of some months (YYYYMM) with market and period."""
    rows = star.join_products(wh.table("FactSale").where(F.col("SaleMonth").isin(months)), star.offered_products(wh))
    rows = star.join_time(star.join_territory(rows, wh.table("DimTerritory")), wh.table("DimTime"))
    return rows.select(
        "SaleMonth", F.col("CountryRegion").alias("market"), F.col("Year").alias("year"), F.col("Month").alias("month"),
        F.when(F.col("Year").isNotNull(), F.col("DimTimeKey")).alias("datekey"), "Revenue", "ProductQuantity", *KINDS.values())


class MonthCube:
    """The cube of one warehouse, in files under ``path``."""

    def __init__(self, wh, path: str | None = None):
        self.wh, self.path = wh, path or new_path(wh.spark, "month-cube")

    @classmethod
    def of(cls, wh) -> "MonthCube":
        """The warehouse's own cube, complete; it is made anew once a dimension has other files."""
        stamp = wh.stamp(["BridgeProductSpecialOffer", "DimProduct", "DimTerritory", "DimTime"])
        if wh.parts.get("month-cube", (None, None))[0] != stamp:
            cube = cls(wh)
            cube.refresh()
            wh.parts["month-cube"] = stamp, cube
        return wh.parts["month-cube"][1]

    def _read(self, name: str, schema: str) -> DataFrame:
        spark = self.wh.spark
        try:
            return spark.read.schema(schema).parquet(f"{self.path}/{name}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], schema)

    def sums(self) -> DataFrame:
        return self._read("sums", _SUMS)

    def sets(self) -> DataFrame:
        return self._read("sets", _SETS)

    def numbers(self) -> DataFrame:
        return self._read("numbers", _NUMBERS)

    def months(self) -> list[int]:
        """Months of known periods that have sales, oldest first. One row per month of history."""
        found = self.sums().where("year IS NOT NULL AND month IS NOT NULL").select(
            (F.col("year") * 100 + F.col("month")).alias("m")).distinct()
        return sorted(r.m for r in found.collect())

    def refresh(self, months: list[int] | None = None) -> list[int]:
        """Compute the given months, or those in the facts but not in the cube; returns them."""
        if months is None:
            stored = self.wh.table("FactSale").select("SaleMonth").where("SaleMonth IS NOT NULL").distinct()
            known = self.sums().select("SaleMonth").distinct()
            months = [r.SaleMonth for r in stored.join(known, "SaleMonth", "left_anti").collect()]
        if not months:
            return []
        rows = store(month_rows(self.wh, months), "month-rows")
        cell = ["SaleMonth", *_CELL]
        sums = rows.groupBy(*cell).agg(
            F.max("datekey").alias("datekey"), F.sum("Revenue").alias("revenue"), F.sum("ProductQuantity").alias("quantity"),
            F.count("Revenue").alias("lines"))
        values = store(union_all([self._values(rows, cell, kind) for kind in KINDS]), "month-values")
        self._number(values)
        columns = {kind: "name" if dict(rows.dtypes)[column] == "string" else "id" for kind, column in KINDS.items()}
        sets = self._bitmaps(self._placed(values, self.numbers(), columns), cell)
        # The sums come last: a month is in the cube once it is there, so a refresh that failed is simply repeated.
        for name, part, schema in (("sets", sets, _SETS), ("sums", sums, _SUMS)):
            typed = self.wh.spark.createDataFrame([], schema).schema
            fresh = part.withColumn("SaleYear", (F.col("SaleMonth") / 100).cast("int")).select(
                *[F.col(f.name).cast(f.dataType).alias(f.name) for f in typed])
            # Files are by year, as a month's are small: the year's other months are copied, not computed.
            years = sorted({month // 100 for month in months})
            rest = self._read(name, schema).where(F.col("SaleYear").isin(years) & ~F.col("SaleMonth").isin(months))
            store(fresh.unionByName(rest), name).repartition(len(years), "SaleYear").write.mode("overwrite").option(
                "partitionOverwriteMode", "dynamic").partitionBy("SaleYear").parquet(f"{self.path}/{name}")
        return sorted(months)

    @staticmethod
    def _placed(values: DataFrame, numbers: DataFrame, columns: dict[str, str]) -> DataFrame:
        """Values with their numbers, each kind by the one column that holds its values: a single key is sorted fastest."""
        parts = []
        for kind, column in columns.items():
            known = numbers.where(F.col("kind") == kind).select(column, "number")
            parts.append(values.where(F.col("kind") == kind).join(beside_facts(known), column).select(*values.columns, "number"))
        return union_all(parts)

    @staticmethod
    def _bitmaps(placed: DataFrame, cell: list[str]) -> DataFrame:
        """One bitmap per cell, kind and 32,768 numbers.

        The numbers are exchanged and not bitmaps: any task has values of most cells, and would send 4 KB for each of these.
        """
        gathered = placed.withColumn("bucket", F.bitmap_bucket_number("number")).repartition(*cell, "kind", "bucket")
        return gathered.groupBy(*cell, "kind", "bucket").agg(
            F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits"))

    @staticmethod
    def _values(rows: DataFrame, cell: list[str], kind: str) -> DataFrame:
        column = KINDS[kind]
        text = dict(rows.dtypes)[column] == "string"
        return rows.where(F.col(column).isNotNull()).select(
            *cell, F.lit(kind).alias("kind"), F.lit(None).cast("long").alias("id") if text else F.col(column).alias("id"),
            F.col(column).alias("name") if text else F.lit(None).cast("string").alias("name")).distinct()

    @staticmethod
    def _first_seen(values: DataFrame) -> DataFrame:
        """``(kind, id, name, first)`` per value; ``first`` orders by month, then keeps a market's values together.

        Month and market's checksum make one number, as the least of numbers is found by hashing and that of structs by sorting.
        """
        first = F.col("SaleMonth").cast("long") * (1 << 32) + F.coalesce(F.crc32(F.col("market").cast("binary")), F.lit(0))
        return values.groupBy("kind", "id", "name").agg(F.min(first).alias("first"))

    def _number(self, values: DataFrame) -> None:
        """Give numbers to values that have none yet."""
        known = self.numbers()
        last = known.agg(F.max("number")).first()[0] or 0
        new = self._first_seen(values)
        if last:
            new = new.alias("v").join(beside_facts(known).alias("n"), (F.col("v.kind") == F.col("n.kind")) & F.col("v.id").eqNullSafe(F.col("n.id"))
                                      & F.col("v.name").eqNullSafe(F.col("n.name")), "left_anti")
        numbered = number_rows(new, [F.col(c) for c in ("kind", "first", "id", "name")], "number", last + 1)
        numbered.select("kind", "id", "name", "number").write.mode("append").parquet(f"{self.path}/numbers")

    @staticmethod
    def _within(rows: DataFrame, months: list[int] | None) -> DataFrame:
        if months is None:
            return rows
        return rows.where(F.col("SaleYear").isin(sorted({m // 100 for m in months})) & F.col("SaleMonth").isin(months))

    def distinct_counts(self, by: list[str], months: list[int] | None = None) -> DataFrame:
        """Exact distinct counts for any of market, year and month, over all months or only some (YYYYMM)."""
        merged = self._within(self.sets(), months).groupBy(*by, "kind", "bucket").agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("n"))
        return merged.groupBy(*by).agg(*[
            F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("n"))), F.lit(0)).alias(kind) for kind in KINDS])

    def metrics(self, months: list[int] | None = None) -> DataFrame:
        """The rows of ``series.period_metrics`` by month; only the given months are read, and only from their years' files."""
        sums = self._within(self.sums(), months)
        names = {"datekey": "long", "revenue": "decimal(38,2)", "quantity": "long", "lines": "long", **dict.fromkeys(KINDS, "long")}
        parts = [part.select(*_CELL, *[(F.col(c) if c in part.columns else F.lit(None)).cast(t).alias(c) for c, t in names.items()])
                 for part in (sums, self.distinct_counts(_CELL, months))]
        add = lambda c: F.sum(c).alias(c)
        total = union_all(parts).groupBy(*_CELL).agg(
            F.max("datekey").alias("datekey"), add("revenue"), add("quantity"), add("lines"),
            *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in KINDS])
        return total.select(
            *_CELL, "datekey", "revenue", "quantity", "ordercount", "customercount",
            X.ratio(F.col("revenue"), F.col("lines")).alias("avgordervalue"), "uniquesubcategories", "uniqueproductlines")
