"""Schemas and fixed type choices shared by every layer.

Money is exact decimal throughout: unit prices at scale 4 (a CSV price
of 0.001 must stay positive), line revenue and sums at scale 4, and the
published mart columns rounded to scale 2.
"""

from __future__ import annotations

from pyspark.sql import types as T

PRICE_TYPE = T.DecimalType(14, 4)
REVENUE_TYPE = T.DecimalType(22, 4)
SUM_TYPE = T.DecimalType(28, 4)
MONEY_TYPE = T.DecimalType(18, 2)

CUSTOMER_ID = "Customer ID"

MONEY_COLUMNS = ["GrossSales", "ReturnAmount", "CancelledAmount", "NetRevenue"]

# --- fixed values (field names, order and mart columns must not change) --------
RAW_SCHEMA = T.StructType(
    [
        T.StructField("Invoice", T.StringType(), True),
        T.StructField("StockCode", T.StringType(), True),
        T.StructField("Description", T.StringType(), True),
        T.StructField("Quantity", T.IntegerType(), True),
        T.StructField("InvoiceDate", T.TimestampNTZType(), True),
        T.StructField("Price", PRICE_TYPE, True),
        T.StructField("Customer ID", T.StringType(), True),
        T.StructField("Country", T.StringType(), True),
    ]
)
SILVER_COLUMNS = [
    "Invoice", "StockCode", "Description", "Quantity", "InvoiceDate", "Price", "Customer ID", "Country",
    "TransactionType", "IsReturn", "Revenue",
]
DAILY_COLUMNS = [
    "SaleDate", "Year", "Month", "MonthName", "Country", "Orders", "Customers", "UnitsSold", "ReturnUnits",
    "GrossSales", "ReturnAmount", "CancelledAmount", "NetRevenue",
]
PRODUCT_COLUMNS = [
    "StockCode", "Description", "Orders", "UnitsSold", "ReturnUnits",
    "GrossSales", "ReturnAmount", "CancelledAmount", "NetRevenue", "ReturnRate", "RevenueRank",
]
CUSTOMER_COLUMNS = [
    "Customer ID", "Country", "Orders", "UnitsPurchased", "ReturnUnits",
    "GrossSales", "ReturnAmount", "CancelledAmount", "NetRevenue", "AverageOrderValue", "CustomerRank",
]
COUNTRY_COLUMNS = [
    "Country", "Orders", "Customers", "UnitsSold", "ReturnUnits",
    "GrossSales", "ReturnAmount", "CancelledAmount", "NetRevenue", "CountryRank",
]
# --------------------------------------------------------------------------------

RAW_COLUMNS = [f.name for f in RAW_SCHEMA.fields]
