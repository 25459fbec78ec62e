"""Independent SQL for every registered query, as DuckDB runs it over the
test tables (registered as views under their own names).

The SQL is written straight from the rules, line level, without the
pre-aggregates and distributed ranks the Spark side uses, so it checks
them. Shared conventions: units are BIGINT, money sums DECIMAL(28,4),
published money DECIMAL(18,2), ranks BIGINT, and every rank orders by
NetRevenue DESC NULLS LAST, then the grain key ASC NULLS FIRST.
"""

from __future__ import annotations

_RAW_SELECT = """
    SELECT
      CASE WHEN l_orderkey % 50 = 0 THEN concat('C', CAST(100000 + l_orderkey AS VARCHAR))
           ELSE CAST(100000 + l_orderkey AS VARCHAR) END AS Invoice,
      CASE WHEN l_partkey % 97 = 0 THEN 'POST'
           WHEN l_partkey % 101 = 0 THEN 'BANK CHARGES'
           ELSE concat(CASE WHEN l_linenumber % 2 = 0 THEN ' p' ELSE 'P' END,
                       lpad(CAST(l_partkey AS VARCHAR), 8, '0')) END AS StockCode,
      CASE WHEN l_partkey % 43 = 0 THEN NULL ELSE concat(p_name, ' ') END AS Description,
      CAST(CASE WHEN l_orderkey % 50 = 0 OR (l_returnflag = 'R' AND l_linenumber = 1)
                  OR l_partkey % 211 = 0 OR n_nationkey = 7
                THEN -l_quantity ELSE l_quantity END AS INTEGER) AS Quantity,
      o_orderdate AS InvoiceDate,
      CAST(CASE WHEN l_linenumber = 7 AND l_returnflag = 'A' THEN 0 ELSE p_retailprice END
           AS DECIMAL(14,4)) AS Price,
      CASE WHEN o_custkey % 5 = 0 THEN NULL
           ELSE concat(CAST(o_custkey AS VARCHAR), '.0') END AS "Customer ID",
      concat(n_name, ' ') AS Country,
      l_orderkey
    FROM lineitem
    JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey
    JOIN part ON l_partkey = p_partkey
"""

_RAW_COLS = 'Invoice, StockCode, Description, Quantity, InvoiceDate, Price, "Customer ID", Country'

CTE_RAW = f"""
raw_keyed AS ({_RAW_SELECT}),
raw AS (
    SELECT {_RAW_COLS} FROM raw_keyed
    UNION ALL
    SELECT {_RAW_COLS} FROM raw_keyed WHERE l_orderkey % 30 = 1
)"""

# the further defects of the dirty view, over the same lines
CTE_DIRTY = CTE_RAW.replace("raw AS (", "raw_plain AS (", 1) + """,
numbered AS (
    SELECT *, TRY_CAST(regexp_extract(Invoice, '[0-9]+') AS BIGINT) AS n,
           TRY_CAST(regexp_extract(StockCode, '[0-9]+') AS BIGINT) AS p
    FROM raw_plain
),
raw AS (
    SELECT CASE WHEN n % 43 = 7 THEN NULL ELSE Invoice END AS Invoice,
           CASE WHEN p % 61 = 6 THEN 'adjust' WHEN p % 67 = 8 THEN '47'
                WHEN p % 71 = 9 THEN NULL ELSE StockCode END AS StockCode,
           CASE WHEN p % 29 = 4 OR (p % 29 = 5 AND n % 2 = 0) THEN '   '
                WHEN (p + n) % 31 = 6 THEN '15CM "BALL", LIGHTS ' ELSE Description END AS Description,
           CASE WHEN n % 37 = 3 THEN NULL WHEN n % 41 = 5 THEN 0 ELSE Quantity END AS Quantity,
           CASE WHEN n % 83 = 11 THEN NULL ELSE InvoiceDate END AS InvoiceDate,
           CAST(CASE WHEN p % 59 = 3 THEN 0.001 WHEN p % 53 = 2 THEN -Price
                     WHEN p % 5 = 1 THEN Price + 0.0049 ELSE Price END AS DECIMAL(14,4)) AS Price,
           "Customer ID", Country
    FROM numbered
)"""


def over_dirty_lines(sql: str) -> str:
    """The same SQL, over the dirty view."""
    return sql.replace(CTE_RAW.strip(), CTE_DIRTY.strip())


CTE_CLEAN = CTE_RAW + """,
dedup AS (SELECT DISTINCT * FROM raw),
clean AS (
    SELECT trim(Invoice) AS Invoice,
           upper(trim(StockCode)) AS StockCode,
           trim(Description) AS Description,
           Quantity, InvoiceDate, Price,
           regexp_replace("Customer ID", '\\.0$', '') AS "Customer ID",
           trim(Country) AS Country,
           CASE WHEN starts_with(trim(Invoice), 'C') THEN 'Cancelled' ELSE 'Normal' END
             AS TransactionType,
           coalesce(Quantity < 0, false) AS IsReturn,
           CAST(Quantity * Price AS DECIMAL(22,4)) AS Revenue
    FROM dedup
)"""

_PASSES = "(coalesce(Price > 0, false) AND coalesce(regexp_matches(StockCode, '^[a-zA-Z0-9]{5,}'), false))"

CTE_SILVER = CTE_CLEAN + f""",
silver AS (SELECT * FROM clean WHERE {_PASSES})"""

CTE_BASE = CTE_SILVER + """,
base AS (
    SELECT *,
      CAST(InvoiceDate AS DATE) AS SaleDate,
      CAST(year(InvoiceDate) AS INTEGER) AS Year,
      CAST(month(InvoiceDate) AS INTEGER) AS Month,
      monthname(InvoiceDate) AS MonthName,
      CASE WHEN TransactionType = 'Normal' AND Quantity > 0 THEN Revenue
           ELSE CAST(0 AS DECIMAL(22,4)) END AS GrossSales,
      CASE WHEN TransactionType = 'Normal' AND Quantity < 0 THEN abs(Revenue)
           ELSE CAST(0 AS DECIMAL(22,4)) END AS ReturnAmount,
      CASE WHEN TransactionType = 'Cancelled' THEN abs(Revenue)
           ELSE CAST(0 AS DECIMAL(22,4)) END AS CancelledAmount,
      CASE WHEN TransactionType = 'Normal' AND Quantity < 0 THEN abs(Quantity) ELSE 0 END
        AS ReturnUnits,
      CASE WHEN TransactionType = 'Normal' AND Quantity > 0 THEN Quantity ELSE 0 END
        AS SoldUnits,
      CASE WHEN TransactionType = 'Cancelled' THEN 'Cancelled'
           WHEN Quantity < 0 THEN 'Return'
           WHEN Quantity > 0 THEN 'Sale'
           ELSE 'Zero' END AS TransactionClass
    FROM silver
)"""


def _sums(units: str = "UnitsSold") -> str:
    return f"""CAST(sum(SoldUnits) AS BIGINT) AS {units},
      CAST(sum(ReturnUnits) AS BIGINT) AS ReturnUnits,
      CAST(sum(GrossSales) AS DECIMAL(28,4)) AS GrossSales,
      CAST(sum(ReturnAmount) AS DECIMAL(28,4)) AS ReturnAmount,
      CAST(sum(CancelledAmount) AS DECIMAL(28,4)) AS CancelledAmount"""


_NET = "CAST(GrossSales - ReturnAmount - CancelledAmount AS DECIMAL(28,4)) AS NetRevenue"


def _money(c: str) -> str:
    return f"CAST(round({c}, 2) AS DECIMAL(18,2)) AS {c}"


_MONEY = ", ".join(_money(c) for c in ("GrossSales", "ReturnAmount", "CancelledAmount", "NetRevenue"))

_RETURN_RATE = """CAST(CASE WHEN UnitsSold > 0
        THEN CAST((ReturnUnits * 20000 + UnitsSold) // (2 * UnitsSold) AS DECIMAL(20,0)) / 100
        ELSE 0 END AS DECIMAL(18,2)) AS ReturnRate"""

_AOV = """CAST(CASE WHEN Orders > 0
        THEN CAST((2 * CAST(GrossSales * 10000 AS BIGINT) + 100 * Orders) // (200 * Orders)
                  AS DECIMAL(20,0)) / 100
        ELSE 0 END AS DECIMAL(18,2)) AS AverageOrderValue"""

DAILY_PART = f"""
daily_agg AS (
    SELECT SaleDate, Country,
      CAST(count(DISTINCT Invoice) AS BIGINT) AS Orders,
      CAST(count(DISTINCT "Customer ID") AS BIGINT) AS Customers,
      {_sums()}
    FROM base GROUP BY SaleDate, Country
),
daily AS (
    SELECT SaleDate, CAST(year(SaleDate) AS INTEGER) AS Year,
      CAST(month(SaleDate) AS INTEGER) AS Month, monthname(SaleDate) AS MonthName,
      Country, Orders, Customers, UnitsSold, ReturnUnits, {_MONEY}
    FROM (SELECT *, {_NET} FROM daily_agg)
)"""

PRODUCT_PART = f"""
product_agg AS (
    SELECT StockCode,
      coalesce(min(nullif(Description, '')), min(Description)) AS Description,
      CAST(count(DISTINCT Invoice) AS BIGINT) AS Orders,
      {_sums()}
    FROM base GROUP BY StockCode
),
product_ranked AS (
    SELECT *, CAST(row_number() OVER (ORDER BY NetRevenue DESC NULLS LAST,
                                      StockCode ASC NULLS FIRST) AS BIGINT) AS RevenueRank
    FROM (SELECT *, {_NET} FROM product_agg)
),
product AS (
    SELECT StockCode, Description, Orders, UnitsSold, ReturnUnits, {_MONEY},
      {_RETURN_RATE}, RevenueRank
    FROM product_ranked
)"""

CUSTOMER_PART = f"""
customer_agg AS (
    SELECT "Customer ID", Country,
      CAST(count(DISTINCT Invoice) AS BIGINT) AS Orders,
      {_sums("UnitsPurchased")}
    FROM base WHERE "Customer ID" IS NOT NULL GROUP BY "Customer ID", Country
),
customer_ranked AS (
    SELECT *, CAST(row_number() OVER (ORDER BY NetRevenue DESC NULLS LAST,
                                      "Customer ID" ASC NULLS FIRST,
                                      Country ASC NULLS FIRST) AS BIGINT) AS CustomerRank
    FROM (SELECT *, {_NET} FROM customer_agg)
),
customer_m AS (
    SELECT "Customer ID", Country, Orders, UnitsPurchased, ReturnUnits, {_MONEY},
      {_AOV}, CustomerRank
    FROM customer_ranked
)"""

COUNTRY_PART = f"""
country_agg AS (
    SELECT Country,
      CAST(count(DISTINCT Invoice) AS BIGINT) AS Orders,
      CAST(count(DISTINCT "Customer ID") AS BIGINT) AS Customers,
      {_sums()}
    FROM base GROUP BY Country
),
country_ranked AS (
    SELECT *, CAST(row_number() OVER (ORDER BY NetRevenue DESC NULLS LAST,
                                      Country ASC NULLS FIRST) AS BIGINT) AS CountryRank
    FROM (SELECT *, {_NET} FROM country_agg)
),
country AS (
    SELECT Country, Orders, Customers, UnitsSold, ReturnUnits, {_MONEY}, CountryRank
    FROM country_ranked
)"""

CTE_DAILY = CTE_BASE + "," + DAILY_PART
CTE_PRODUCT = CTE_BASE + "," + PRODUCT_PART
CTE_CUSTOMER = CTE_BASE + "," + CUSTOMER_PART
CTE_COUNTRY = CTE_BASE + "," + COUNTRY_PART
CTE_MARTS = CTE_BASE + "," + ",".join([DAILY_PART, PRODUCT_PART, CUSTOMER_PART, COUNTRY_PART])


def with_ctes(ctes: str, body: str) -> str:
    return f"WITH {ctes.strip()}\n{body.strip()}"


# --- profiling, over raw lines ---------------------------------------------

RAW_COLUMN_NAMES = ["Invoice", "StockCode", "Description", "Quantity", "InvoiceDate", "Price",
                    "Customer ID", "Country"]


def _q(name: str) -> str:
    return f'"{name}"'


NULL_COUNTS = with_ctes(CTE_RAW, "SELECT " + ", ".join(
    f"CAST(sum(CAST({_q(c)} IS NULL AS INTEGER)) AS BIGINT) AS {_q(c)}" for c in RAW_COLUMN_NAMES
) + " FROM raw")

DISTINCT_COUNTS = with_ctes(CTE_RAW, """
SELECT CAST(count(DISTINCT Invoice) AS BIGINT) AS DistinctInvoices,
       CAST(count(DISTINCT StockCode) AS BIGINT) AS DistinctProducts,
       CAST(count(DISTINCT Description) AS BIGINT) AS DistinctDescriptions,
       CAST(count(DISTINCT "Customer ID") AS BIGINT) AS DistinctCustomers,
       CAST(count(DISTINCT Country) AS BIGINT) AS DistinctCountries
FROM raw""")

DATE_RANGE = with_ctes(CTE_RAW, """
SELECT min(InvoiceDate) AS MinInvoiceDate, max(InvoiceDate) AS MaxInvoiceDate FROM raw""")

DUPLICATE_ROWS = with_ctes(CTE_RAW, """
SELECT TotalRows, DistinctRows, TotalRows - DistinctRows AS DuplicateRows
FROM (SELECT CAST((SELECT count(*) FROM raw) AS BIGINT) AS TotalRows,
             CAST((SELECT count(*) FROM (SELECT DISTINCT * FROM raw)) AS BIGINT) AS DistinctRows)""")


def stats_sql(source: str, columns: list[str]) -> str:
    return "\nUNION ALL\n".join(
        f"""SELECT '{c}' AS ColumnName, CAST(count({c}) AS BIGINT) AS NonNullCount,
       CAST(avg({c}) AS DECIMAL(18,4)) AS Mean,
       CAST(stddev_samp(CAST({c} AS DOUBLE)) AS DECIMAL(18,4)) AS StdDev,
       CAST(min({c}) AS DECIMAL(18,4)) AS MinValue,
       CAST(max({c}) AS DECIMAL(18,4)) AS MaxValue
FROM {source}"""
        for c in columns
    )


QUANTITY_PRICE_STATS = with_ctes(CTE_RAW, stats_sql("raw", ["Quantity", "Price"]))

PRICE_QUALITY_COUNTS = with_ctes(CTE_RAW, """
SELECT count(*) FILTER (WHERE Price = 0) AS ZeroPriceRows,
       count(*) FILTER (WHERE Price < 0) AS NegativePriceRows,
       count(*) FILTER (WHERE Price <= 0) AS InvalidPriceRows
FROM raw""")

CANCELLED_ROWS = with_ctes(CTE_RAW, """
SELECT count(*) FILTER (WHERE starts_with(Invoice, 'C')) AS CancelledRows FROM raw""")

NEGATIVE_QUANTITY_ROWS = with_ctes(CTE_RAW, """
SELECT count(*) FILTER (WHERE Quantity < 0) AS NegativeQuantityRows FROM raw""")

ROWS_BY_COUNTRY = with_ctes(CTE_RAW, """
SELECT Country, count(*) AS RowCount FROM raw GROUP BY Country
ORDER BY RowCount DESC, Country ASC NULLS FIRST""")

ROWS_BY_INVOICE_TYPE = with_ctes(CTE_RAW, """
SELECT CASE WHEN starts_with(Invoice, 'C') THEN 'Cancelled' ELSE 'Normal' END AS InvoiceType,
       count(*) AS RowCount
FROM raw GROUP BY 1""")

# --- Silver reports, over cleaned lines -------------------------------------

SILVER_TYPE_COUNTS = with_ctes(CTE_CLEAN, f"""
SELECT 'TransactionType' AS Breakdown, TransactionType AS Value,
       CAST(count(*) AS BIGINT) AS RowsBeforeFilter,
       CAST(count(*) FILTER (WHERE {_PASSES}) AS BIGINT) AS RowsAfterFilter
FROM clean GROUP BY TransactionType
UNION ALL
SELECT 'IsReturn' AS Breakdown, CAST(IsReturn AS VARCHAR) AS Value,
       CAST(count(*) AS BIGINT), CAST(count(*) FILTER (WHERE {_PASSES}) AS BIGINT)
FROM clean GROUP BY IsReturn""")

QUALITY_REPORT = with_ctes(CTE_CLEAN, f"""
SELECT count(*) AS TotalRows,
       count(*) FILTER (WHERE Price <= 0) AS InvalidPriceRows,
       count(*) FILTER (WHERE Quantity = 0) AS ZeroQuantityRows,
       count(*) FILTER (WHERE "Customer ID" IS NULL) AS MissingCustomerRows,
       count(*) FILTER (WHERE Description IS NULL) AS MissingDescriptionRows,
       count(*) FILTER (WHERE InvoiceDate IS NULL) AS MissingDateRows,
       count(*) FILTER (WHERE {_PASSES}) AS KeptRows,
       count(*) FILTER (WHERE NOT {_PASSES}) AS RejectedRows,
       count(*) FILTER (WHERE {_PASSES} AND Price <= 0) AS RemainingInvalidPriceRows
FROM clean""")

REJECTS_BY_REASON = with_ctes(CTE_CLEAN, """
SELECT RejectReason, count(*) AS RowCount
FROM (SELECT CASE WHEN NOT coalesce(Price > 0, false) THEN 'NonPositivePrice'
                  WHEN NOT coalesce(regexp_matches(StockCode, '^[a-zA-Z0-9]{5,}'), false)
                    THEN 'InvalidStockCode' END AS RejectReason
      FROM clean)
WHERE RejectReason IS NOT NULL GROUP BY RejectReason""")

CLEAN_LINE_STATS = with_ctes(CTE_CLEAN, stats_sql("clean", ["Quantity", "Price", "Revenue"]))

OVERLAP_CHECK = with_ctes(CTE_SILVER, """
SELECT count(*) FILTER (WHERE TransactionType = 'Cancelled' AND Quantity < 0)
       AS CancelledNegativeRows
FROM silver""")

# --- Gold extras ---------------------------------------------------------------

INVOICE_GRAIN = with_ctes(CTE_BASE, """
SELECT SaleDate, Country, Invoice, "Customer ID",
       CAST(sum(SoldUnits) AS BIGINT) AS SoldUnits,
       CAST(sum(ReturnUnits) AS BIGINT) AS ReturnUnits,
       CAST(sum(GrossSales) AS DECIMAL(28,4)) AS GrossSales,
       CAST(sum(ReturnAmount) AS DECIMAL(28,4)) AS ReturnAmount,
       CAST(sum(CancelledAmount) AS DECIMAL(28,4)) AS CancelledAmount
FROM base GROUP BY SaleDate, Country, Invoice, "Customer ID"
""")

TOP_PRODUCTS = with_ctes(CTE_PRODUCT, "SELECT * FROM product WHERE RevenueRank <= 10")
TOP_CUSTOMERS = with_ctes(CTE_CUSTOMER, "SELECT * FROM customer_m WHERE CustomerRank <= 10")
TOP_COUNTRIES = with_ctes(CTE_COUNTRY, "SELECT * FROM country WHERE CountryRank <= 10")

# --- checks ----------------------------------------------------------------------

_MART_SOURCES = [
    # mart, aggregate CTE (unrounded), rounded CTE, units column, Silver filter
    ("daily", "daily_agg", "daily", "UnitsSold", ""),
    ("product", "product_agg", "product", "UnitsSold", ""),
    ("customer", "customer_agg", "customer_m", "UnitsPurchased", 'WHERE "Customer ID" IS NOT NULL'),
    ("country", "country_agg", "country", "UnitsSold", ""),
]

_SOURCE_EXPR = {
    "GrossSales": "sum(GrossSales)",
    "ReturnAmount": "sum(ReturnAmount)",
    "CancelledAmount": "sum(CancelledAmount)",
    "UnitsSold": "sum(SoldUnits)",
    "ReturnUnits": "sum(ReturnUnits)",
    "NetRevenue": "sum(GrossSales) - sum(ReturnAmount) - sum(CancelledAmount)",
}


def _gold_expr(metric: str, units: str) -> str:
    if metric == "UnitsSold":
        return f"sum({units})"
    if metric == "NetRevenue":
        return "sum(GrossSales) - sum(ReturnAmount) - sum(CancelledAmount)"
    return f"sum({metric})"


def _reconcile_rows(marts: list[str], rounded: bool) -> str:
    parts = []
    for mart, agg, final, units, where in _MART_SOURCES:
        if mart not in marts:
            continue
        gold_table = final if rounded else agg
        for metric, src in _SOURCE_EXPR.items():
            parts.append(
                f"SELECT '{mart}' AS Mart, '{metric}' AS Metric, "
                f"(SELECT CAST(coalesce({src}, 0) AS DECIMAL(28,4)) FROM base {where}) AS SourceValue, "
                f"(SELECT CAST(coalesce({_gold_expr(metric, units)}, 0) AS DECIMAL(28,4)) "
                f"FROM {gold_table}) AS GoldValue"
            )
    return "\nUNION ALL\n".join(parts)


RECONCILIATION = with_ctes(CTE_MARTS, f"""
SELECT Mart, Metric, SourceValue, GoldValue,
       CAST(SourceValue - GoldValue AS DECIMAL(28,4)) AS Difference,
       SourceValue = GoldValue AS Passed
FROM ({_reconcile_rows(["daily", "product", "customer", "country"], rounded=False)})""")

GRAIN_CHECKS = with_ctes(CTE_MARTS, """
SELECT Mart, DuplicateKeys, DuplicateKeys = 0 AS Passed FROM (
  SELECT 'daily' AS Mart, CAST(count(*) FILTER (WHERE n > 1) AS BIGINT) AS DuplicateKeys
  FROM (SELECT count(*) AS n FROM daily GROUP BY SaleDate, Country)
  UNION ALL
  SELECT 'product', CAST(count(*) FILTER (WHERE n > 1) AS BIGINT)
  FROM (SELECT count(*) AS n FROM product GROUP BY StockCode)
  UNION ALL
  SELECT 'customer', CAST(count(*) FILTER (WHERE n > 1) AS BIGINT)
  FROM (SELECT count(*) AS n FROM customer_m GROUP BY "Customer ID", Country)
  UNION ALL
  SELECT 'country', CAST(count(*) FILTER (WHERE n > 1) AS BIGINT)
  FROM (SELECT count(*) AS n FROM country GROUP BY Country))""")

NULL_KEY_CHECKS = with_ctes(CTE_MARTS, """
SELECT Mart, KeyColumn, NullKeys, NullKeys = 0 AS Passed FROM (
  SELECT 'product' AS Mart, 'StockCode' AS KeyColumn,
         CAST(count(*) FILTER (WHERE StockCode IS NULL) AS BIGINT) AS NullKeys FROM product
  UNION ALL
  SELECT 'country', 'Country', CAST(count(*) FILTER (WHERE Country IS NULL) AS BIGINT) FROM country
  UNION ALL
  SELECT 'customer', 'Customer ID',
         CAST(count(*) FILTER (WHERE "Customer ID" IS NULL) AS BIGINT) FROM customer_m)""")

NEGATIVE_NET = with_ctes(CTE_MARTS, """
SELECT 'product' AS Mart, CAST(count(*) FILTER (WHERE NetRevenue < 0) AS BIGINT) AS NegativeRows
FROM product
UNION ALL
SELECT 'customer', CAST(count(*) FILTER (WHERE NetRevenue < 0) AS BIGINT) FROM customer_m
UNION ALL
SELECT 'country', CAST(count(*) FILTER (WHERE NetRevenue < 0) AS BIGINT) FROM country""")


def _rank_stats(mart: str, table: str, rank: str) -> str:
    return (f"SELECT '{mart}' AS Mart, CAST(count(*) AS BIGINT) AS RowCount, min({rank}) AS MinRank, "
            f"max({rank}) AS MaxRank, CAST(count(DISTINCT {rank}) AS BIGINT) AS DistinctRanks "
            f"FROM {table}")


RANK_CHECKS = with_ctes(CTE_MARTS, f"""
SELECT *, RowCount = 0 OR (MinRank = 1 AND MaxRank = RowCount AND DistinctRanks = RowCount)
          AS Passed
FROM ({_rank_stats('product', 'product', 'RevenueRank')}
      UNION ALL {_rank_stats('customer', 'customer_m', 'CustomerRank')}
      UNION ALL {_rank_stats('country', 'country', 'CountryRank')})""")

LAYER_COUNTS = with_ctes(CTE_MARTS, """
SELECT 'raw' AS Layer, CAST(count(*) AS BIGINT) AS RowCount FROM raw
UNION ALL SELECT 'silver', count(*) FROM silver
UNION ALL SELECT 'daily', count(*) FROM daily_agg
UNION ALL SELECT 'product', count(*) FROM product_agg
UNION ALL SELECT 'customer', count(*) FROM customer_agg
UNION ALL SELECT 'country', count(*) FROM country_agg""")

# --- dimension join, skew, layout, ingestion ------------------------------------

COUNTRY_REGION_SALES = with_ctes(CTE_COUNTRY, """
SELECT c.*, r.r_name AS Region
FROM country c
LEFT JOIN nation n ON c.Country = n.n_name
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey""")

PRODUCT_PART_SALES = with_ctes(CTE_BASE, """
SELECT p_brand AS Brand, p_type AS PartType, count(*) AS Lines,
       CAST(sum(SoldUnits) AS BIGINT) AS UnitsSold,
       CAST(sum(GrossSales) AS DECIMAL(28,4)) AS GrossSales,
       CAST(sum(CASE WHEN SoldUnits > 0 THEN CAST(SoldUnits * CAST(p_retailprice AS DECIMAL(14,4)) AS DECIMAL(28,4)) END)
            AS DECIMAL(28,4)) AS ListValue,
       count(*) FILTER (WHERE SoldUnits > 0 AND Price < CAST(p_retailprice AS DECIMAL(14,4))) AS LinesBelowList,
       CAST(max(p_size) AS INTEGER) AS LargestSize
FROM base LEFT JOIN part ON StockCode = concat('P', lpad(CAST(p_partkey AS VARCHAR), 8, '0'))
GROUP BY p_brand, p_type""")

COUNTRY_SKEW = with_ctes(CTE_SILVER, """
SELECT Country, count(*) AS RowCount,
       CAST(count(*) / sum(count(*)) OVER () AS DECIMAL(18,6)) AS RowShare
FROM silver GROUP BY Country""")

COUNTRY_UNITS_SALTED = with_ctes(CTE_BASE, """
SELECT Country, CAST(sum(SoldUnits) AS BIGINT) AS UnitsSold,
       CAST(sum(GrossSales) AS DECIMAL(28,4)) AS GrossSales
FROM base GROUP BY Country""")

DAILY_SALES_YEAR = with_ctes(CTE_DAILY, "SELECT * FROM daily WHERE Year = 1998")

CSV_ROUNDTRIP = with_ctes(CTE_RAW, "SELECT * FROM raw")

BRONZE_ROW_CHECK = with_ctes(CTE_RAW, """
SELECT 'bronze' AS CheckName, count(*) AS SourceRows, count(*) AS TargetRows,
       8 AS SourceColumns, 8 AS TargetColumns, true AS Passed
FROM raw""")

LAYERED_RUN = with_ctes(CTE_MARTS, """
SELECT 'bronze' AS Stage, 'bronze' AS Layer, CAST(count(*) AS BIGINT) AS RowCount FROM raw
UNION ALL SELECT 'silver', 'silver', count(*) FROM silver
UNION ALL SELECT 'gold', 'daily', count(*) FROM daily_agg
UNION ALL SELECT 'gold', 'product', count(*) FROM product_agg
UNION ALL SELECT 'gold', 'customer', count(*) FROM customer_agg
UNION ALL SELECT 'gold', 'country', count(*) FROM country_agg""")

RAW_OVERVIEW = with_ctes(CTE_RAW, "SELECT count(*) AS TotalRows, " + ", ".join(
    f"count(*) FILTER (WHERE {_q(c)} IS NULL) AS Null{c.replace(' ', '')}" for c in RAW_COLUMN_NAMES
) + """,
       min(InvoiceDate) AS MinInvoiceDate, max(InvoiceDate) AS MaxInvoiceDate,
       count(*) FILTER (WHERE Price = 0) AS ZeroPriceRows,
       count(*) FILTER (WHERE Price < 0) AS NegativePriceRows,
       count(*) FILTER (WHERE Quantity < 0) AS NegativeQuantityRows,
       count(*) FILTER (WHERE Quantity = 0) AS ZeroQuantityRows,
       min(Quantity) AS MinQuantity, max(Quantity) AS MaxQuantity,
       count(*) FILTER (WHERE starts_with(Invoice, 'C')) AS CancelledRows
FROM raw""")


_REJECTED = {"Quantity": "right(StockCode, 1) = '7'", "InvoiceDate": "right(StockCode, 1) = '8'"}
MALFORMED_CELLS = with_ctes(CTE_RAW, """
SELECT count(*) AS TotalRows, count(*) FILTER (WHERE right(StockCode, 1) IN ('7', '8')) AS CorruptRows,
       CAST(0 AS BIGINT) AS MisshapenRows, """ + ", ".join(
    f"count(*) FILTER (WHERE {_REJECTED.get(c, 'false')}) AS Rejected{c.replace(' ', '')}" for c in RAW_COLUMN_NAMES
) + " FROM raw")

LAYER_PROFILE = with_ctes(CTE_RAW, "SELECT count(*) AS Rows, CAST(8 AS INTEGER) AS Columns FROM raw")

QUARTER_SALES = with_ctes(CTE_DAILY, """
SELECT Country, Year, CAST((Month + 2) // 3 AS INTEGER) AS Quarter, count(*) AS Days,
       CAST(sum(UnitsSold) AS BIGINT) AS UnitsSold, CAST(sum(NetRevenue) AS DECIMAL(28,2)) AS NetRevenue
FROM daily WHERE Month >= 10 GROUP BY ALL""")

COUNTRY_DISTINCTS = with_ctes(CTE_COUNTRY, "SELECT Country, Orders, Customers FROM country")

COUNTRY_MONTH_DISTINCTS = with_ctes(CTE_BASE, """
SELECT Country, Year, Month, CAST(count(DISTINCT Invoice) AS BIGINT) AS Orders,
       CAST(count(DISTINCT "Customer ID") AS BIGINT) AS Customers
FROM base GROUP BY Country, Year, Month""")

LAYER_FINGERPRINTS = with_ctes(CTE_MARTS, """
SELECT Layer, n AS WrittenRows, n AS FileRows, true AS SameRows, true AS Passed FROM (
  SELECT 'bronze' AS Layer, count(*) AS n FROM raw
  UNION ALL SELECT 'silver', count(*) FROM silver
  UNION ALL SELECT 'invoice_grain', count(*) FROM (SELECT DISTINCT SaleDate, Country, Invoice, "Customer ID" FROM base)
  UNION ALL SELECT 'daily', count(*) FROM daily
  UNION ALL SELECT 'product', count(*) FROM product
  UNION ALL SELECT 'customer', count(*) FROM customer_m
  UNION ALL SELECT 'country', count(*) FROM country)""")
