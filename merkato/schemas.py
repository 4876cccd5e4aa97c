"""Column types of the eight warehouse tables.

Names keep the warehouse's own spelling, ``Suggorate`` included, so that existing
queries against the tables keep working.
"""

from pyspark.sql import types as T

# The far end of an open validity interval, and the table names.
OPEN_END = "9999-12-31 23:59:59"

_LONG, _INT, _TEXT, _FLAG, _TS = (
    T.LongType(), T.IntegerType(), T.StringType(), T.BooleanType(), T.TimestampNTZType(),
)
_MONEY = T.DecimalType(18, 2)


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


_VERSION = {"ValidFrom": _TS, "ValidTo": _TS, "IsActive": _FLAG}

DIM_PRODUCT = _struct(
    ProductSuggorateKey=_LONG, Product_ID=_LONG, ProductName=_TEXT, Subcategory=_TEXT, Model=_TEXT,
    ProductLine=_TEXT, Class=_TEXT, Style=_TEXT, **_VERSION,
)
DIM_SPECIAL_OFFER = _struct(
    SpecialOfferSuggorateKey=_LONG, SpecialOffer_ID=_LONG, DiscountPct=T.DecimalType(5, 2), Type=_TEXT,
    Category=_TEXT, **_VERSION,
)
DIM_TERRITORY = _struct(TerritorySuggorateKey=_LONG, Territory_ID=_LONG, CountryRegion=_TEXT)
DIM_TIME = _struct(
    TimeSuggorateKey=_LONG, DateKey=_LONG, Day=_INT, Month=_INT, Quarter=_INT, Season=_TEXT, Year=_INT,
)
DIM_CUSTOMER = _struct(
    CustomerSuggorateKey=_LONG, Customer_ID=_LONG, Gender=_TEXT, LifeTimeValue=_MONEY, LtvTier=_TEXT,
    LoyaltyStatus=_TEXT, **_VERSION,
)
BRIDGE = _struct(
    BrdgProductSpecialOfferKey=_LONG, ProductSuggorateKey=_LONG, SpecialOfferSuggorateKey=_LONG, **_VERSION,
)
FACT_SALE = _struct(
    SalesOrderID=_LONG, SalesOrderDetailID=_LONG, BrdgProductSpecialOfferKey=_LONG, DimTerritoryKey=_LONG,
    DimTimeKey=_LONG, DimCustomerKey=_LONG, Revenue=_MONEY, ProductQuantity=_LONG, ProductRange=_TEXT,
)
FACT_MARKET_SEGMENTATION = _struct(
    DateKey=_LONG, MarketNameKey=_TEXT, SegmentID=_INT, Revenue=_MONEY, Quantity=_LONG, ProductRange=_TEXT,
    ModelVersion=_TEXT, EmbeddingJSON=_TEXT, ConfidenceScore=T.DecimalType(5, 4), CreatedAt=_TS,
)

TABLES = {
    "DimProduct": DIM_PRODUCT,
    "DimSpecialOffer": DIM_SPECIAL_OFFER,
    "DimTerritory": DIM_TERRITORY,
    "DimTime": DIM_TIME,
    "DimCustomer": DIM_CUSTOMER,
    "BridgeProductSpecialOffer": BRIDGE,
    "FactSale": FACT_SALE,
    "FactMarketSegmentation": FACT_MARKET_SEGMENTATION,
}

# Physical layout: facts are split by month so that period filters prune files.
PARTITIONS = {"FactSale": "SaleMonth", "FactMarketSegmentation": "DateKey"}
