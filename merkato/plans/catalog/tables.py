"""Sources, sinks and table plumbing (S)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from merkato import schemas
from merkato.functions import expressions as X
from merkato.operators.cube import MonthCube
from merkato.operators import series
from merkato.plans.catalog.registry import query
from merkato.session import new_path
from merkato.sources import tables as io
from merkato.sources.tpch import TABLES, source


@query("S1_table_scan", "SELECT SalesOrderID AS salesorderid, SalesOrderDetailID AS salesorderdetailid, "
       "CAST(Revenue AS DOUBLE) AS revenue, ProductQuantity AS productquantity FROM fact_sale")
def _(wh):
    wh.table("FactSale")
    return io.scan(wh.spark, wh.path("FactSale"), io.stored_schema("FactSale"),
                   ["SalesOrderID", "SalesOrderDetailID", "Revenue", "ProductQuantity"])


@query("S2_csv_source", "SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, c_mktsegment "
       "FROM customer", source=True)
def _(spark, folder):
    path = io.write_csv(source(spark, folder, "customer"), new_path(spark, "csv"), "customer")
    read = io.read_csv(spark, path)
    return read.select(F.col("c_custkey").cast("long"), "c_name", F.col("c_nationkey").cast("long"),
                       F.col("c_acctbal").cast("double"), "c_mktsegment")


@query("S2_csv_rejects", """
SELECT CASE WHEN o_orderkey % 50 = 0 THEN 'wrong number of values' WHEN o_orderkey % 50 = 1 THEN 'o_totalprice is not double: many'
    WHEN o_orderkey % 50 = 2 THEN 'o_custkey is empty' END AS reason, count(*) AS records, CAST(sum(CASE WHEN o_orderkey % 50 > 2 THEN
    o_custkey END) AS BIGINT) AS custkeys FROM orders GROUP BY 1""", source=True)
def _(spark, folder):
    key = F.col("o_orderkey") % 50
    lines = source(spark, folder, "orders").select(F.concat_ws(
        ",", "o_orderkey", F.when(key == 2, "").otherwise(F.col("o_custkey").cast("string")),
        F.when(key == 1, "many").otherwise(F.col("o_totalprice").cast("string")), F.when(key == 0, "one more")).alias("o_orderkey,o_custkey,o_totalprice"))
    path = new_path(spark, "csv-lines")
    lines.write.csv(path, header=True, sep="\x01")  # so that the commas are the record's own
    schema = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType(), False),
                           T.StructField("o_totalprice", T.DoubleType())])
    good, rejects = io.read_csv_checked(spark, path, schema)
    kept = good.agg(F.lit(None).cast("string").alias("reason"), F.count("*").alias("records"), F.sum("o_custkey").alias("custkeys"))
    return rejects.groupBy("reason").agg(F.count("*").alias("records"), F.lit(None).cast("long").alias("custkeys")).unionByName(kept)


@query("S3_replaced_table", "SELECT SpecialOffer_ID + 100 AS specialoffer_id, Type AS type FROM dim_offer WHERE SpecialOffer_ID > 2")
def _(wh):
    own = io.Warehouse(wh.spark, new_path(wh.spark, "replaced"))
    own.save("DimSpecialOffer", wh.table("DimSpecialOffer"))
    later = own.table("DimSpecialOffer").where("SpecialOffer_ID > 2")
    own.save("DimSpecialOffer", later.withColumn("SpecialOffer_ID", F.col("SpecialOffer_ID") + 100), replace=True)
    return own.table("DimSpecialOffer").select("SpecialOffer_ID", "Type")


@query("S3_table_layout", "SELECT CAST(DimTimeKey // 100 AS INTEGER) AS salemonth, count(*) AS row_count "
       "FROM fact_sale GROUP BY 1")
def _(wh):
    return wh.table("FactSale").groupBy("SaleMonth").agg(F.count("*").alias("row_count"))


_NAMES = ", ".join(f"'{t}'" for t in TABLES)


@query("S4_schema_discovery", "SELECT table_name, CAST(ordinal_position AS INTEGER) AS ordinal, column_name "
       f"FROM information_schema.columns WHERE table_name IN ({_NAMES})", source=True)
def _(spark, folder):
    found = io.table_columns(spark, {t: f"{folder}/{t}.parquet" for t in TABLES})
    return found.select("table_name", "ordinal", "column_name")


@query("S5_table_counts", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in TABLES), source=True)
def _(spark, folder):
    return io.table_counts(spark, {t: f"{folder}/{t}.parquet" for t in TABLES}).select("table_name", "row_count")


@query("S6_lower_case_columns", "SELECT ProductSuggorateKey AS productsuggoratekey, ProductName AS productname, "
       "Subcategory AS subcategory FROM dim_product")
def _(wh):
    return io.lower_columns(wh.table("DimProduct")).select("productsuggoratekey", "productname", "subcategory")


@query("S7_resolve_column", "SELECT c_mktsegment AS segment, count(*) AS customers FROM customer GROUP BY 1", source=True)
def _(spark, folder):
    customers = source(spark, folder, "customer")
    name = io.find_column(customers, "market_segment", " C_MktSegment ")
    return customers.groupBy(F.col(name).alias("segment")).agg(F.count("*").alias("customers"))


_S8_CTES = """
target AS (
  SELECT datekey, market, 0 AS segmentid, CAST(revenue AS DOUBLE) AS revenue, quantity, 'Low' AS productrange,
    '2000-01-01 00:00:00' AS createdat FROM monthly),
source AS (
  SELECT datekey, market, 1 AS segmentid, CAST(revenue AS DOUBLE) AS revenue, quantity,
    CASE WHEN revenue < 10000 THEN 'Low' WHEN revenue < 50000 THEN 'Medium' ELSE 'High' END AS productrange,
    '2001-01-01 00:00:00' AS createdat
  FROM (SELECT *, row_number() OVER (PARTITION BY market ORDER BY year DESC, month DESC) AS n FROM monthly) WHERE n = 1
  UNION ALL
  SELECT datekey, market || '''s', 2, CAST(revenue AS DOUBLE), quantity, 'High', '2001-01-01 00:00:00' FROM monthly)
"""


@query("S8_segment_upsert", "SELECT datekey, market AS marketnamekey, segmentid, revenue, quantity, productrange, "
       "createdat FROM source UNION ALL SELECT * FROM target t WHERE NOT EXISTS (SELECT 1 FROM source s WHERE "
       "s.datekey = t.datekey AND s.market = t.market)", ctes=_S8_CTES)
def _(wh):
    metrics = MonthCube.of(wh).metrics()
    columns = ["DateKey", "MarketNameKey", "SegmentID", "Revenue", "Quantity", "ProductRange"]

    def shaped(df, segment, label):
        return df.select(
            F.col("datekey").alias("DateKey"), F.col("market").alias("MarketNameKey"),
            F.lit(segment).alias("SegmentID"), F.col("revenue").alias("Revenue"), F.col("quantity").alias("Quantity"),
            (F.lit(label) if label else F.col("productrange")).alias("ProductRange"))

    path = new_path(wh.spark, "segment-table")
    latest = shaped(series.latest_period(metrics), 1, None)
    added = shaped(metrics.withColumn("market", F.concat("market", F.lit("'s"))), 2, "High")
    for rows, at in ((shaped(metrics, 0, "Low"), "2000-01-01 00:00:00"), (latest.unionByName(added), "2001-01-01 00:00:00")):
        io.upsert_segments(wh.spark, path, rows, F.lit(at).cast("timestamp_ntz"))
    return io.scan(wh.spark, path, schemas.TABLES["FactMarketSegmentation"], [*columns, "CreatedAt"])


@query("S9_csv_export", "SELECT market, CAST(sum(revenue) AS DOUBLE) AS revenue, CAST(sum(quantity) AS BIGINT) AS quantity "
       "FROM monthly GROUP BY 1")
def _(wh):
    totals = MonthCube.of(wh).metrics().groupBy("market").agg(
        F.sum("revenue").alias("revenue"), F.sum("quantity").alias("quantity"))
    path = io.write_csv(totals, new_path(wh.spark, "export"), "market_segmentation")
    return io.read_csv(wh.spark, path, "market string, revenue double, quantity bigint")


@query("S10_preview", "SELECT SalesOrderID AS salesorderid, SalesOrderDetailID AS salesorderdetailid, "
       "CAST(Revenue AS DOUBLE) AS revenue FROM fact_sale ORDER BY 1, 2 LIMIT 100")
def _(wh):
    rows = wh.table("FactSale").select("SalesOrderID", "SalesOrderDetailID", "Revenue")
    return io.preview(rows, ["SalesOrderID", "SalesOrderDetailID"], 100)


@query("S11_vector_json", "SELECT vec_id, CAST(pos - 1 AS INTEGER) AS position, CAST(embedding[pos] AS DOUBLE) AS value "
       "FROM embeddings, unnest(range(1, len(embedding) + 1)) AS u(pos)", source=True)
def _(spark, folder):
    text = source(spark, folder, "embeddings").select("vec_id", io.vector_to_json(F.col("embedding")).alias("json"))
    back = text.select("vec_id", F.posexplode(io.json_to_vector(F.col("json"))).alias("position", "value"))
    return back.withColumn("value", F.col("value").cast("float").cast("double"))


@query("S12_model_version", "SELECT DateKey AS datekey, 'lstm_hybrid_v2.0_' || DateKey AS version FROM dim_time")
def _(wh):
    day = F.to_date(F.col("DateKey").cast("string"), "yyyyMMdd")
    return wh.table("DimTime").select("DateKey", X.model_version(day).alias("version"))


@query("S13_require_rows", "SELECT market, count(*) AS periods FROM series GROUP BY 1")
def _(wh):
    found = io.require_rows(series.market_series(wh), "no sales")
    return found.groupBy("market").agg(F.count("*").alias("periods"))


