"""Raw retail lines derived from the TPC-H-style test tables.

The test tables are clean, so the rules of the Silver layer would have
nothing to do. This view reshapes every lineitem row into a raw retail
line and plants the dirty cases deterministically from the keys:
cancelled invoices, postage and bank-charge codes, missing descriptions,
negative quantities, zero prices, float-formatted customer ids, padded
text, and a second exact copy of some lines. It reads the whole tables;
the key arithmetic only decides which rows carry which defect.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.schemas import CUSTOMER_ID, PRICE_TYPE, RAW_COLUMNS

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def retail_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw 8-column retail lines over lineitem, orders, customer,
    nation and part (inner joins on their keys; Catalyst/AQE choose the
    join strategies from the table sizes)."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_returnflag"
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    # cast once per part: a double becomes a decimal by way of its text
    part = table(spark, sf_dir, "part").select(
        "p_partkey", "p_name", F.col("p_retailprice").cast(PRICE_TYPE).alias("p_retailprice"))

    joined = (
        li.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(cust, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
    )

    ok, pk, ln = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_linenumber")
    invoice_no = (ok + 100000).cast("string")
    negative = (
        (ok % 50 == 0)
        | ((F.col("l_returnflag") == "R") & (ln == 1))
        | (pk % 211 == 0)
        | (F.col("n_nationkey") == 7)
    )
    lines = joined.select(
        F.when(ok % 50 == 0, F.concat(F.lit("C"), invoice_no)).otherwise(invoice_no).alias("Invoice"),
        F.when(pk % 97 == 0, F.lit("POST"))
        .when(pk % 101 == 0, F.lit("BANK CHARGES"))
        .otherwise(
            F.concat(
                F.when(ln % 2 == 0, F.lit(" p")).otherwise(F.lit("P")),
                F.lpad(pk.cast("string"), 8, "0"),
            )
        )
        .alias("StockCode"),
        F.when(pk % 43 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.col("p_name"), F.lit(" ")))
        .alias("Description"),
        F.when(negative, -F.col("l_quantity")).otherwise(F.col("l_quantity")).cast("int").alias("Quantity"),
        F.col("o_orderdate").alias("InvoiceDate"),
        F.when((ln == 7) & (F.col("l_returnflag") == "A"), F.lit(0).cast(PRICE_TYPE))
        .otherwise(F.col("p_retailprice"))
        .alias("Price"),
        F.when(F.col("o_custkey") % 5 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.col("o_custkey").cast("string"), F.lit(".0")))
        .alias(CUSTOMER_ID),
        F.concat(F.col("n_name"), F.lit(" ")).alias("Country"),
        # every line once, lines of every 30th order twice (exact copies)
        F.explode(
            F.when(ok % 30 == 1, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
        ).alias("_copy"),
    )
    return lines.select(*[F.col(f"`{c}`") for c in RAW_COLUMNS])


def dirty_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``retail_lines`` with the defects that it lacks, on whole invoices
    (n, the digits of Invoice) and products (p, those of StockCode): null
    and zero quantities, null invoices, dates and stock codes, stray codes,
    sub-cent, tiny and negative prices, blank, mixed and quoted descriptions."""
    n = F.regexp_extract("Invoice", "[0-9]+", 0).try_cast("bigint")
    p = F.regexp_extract("StockCode", "[0-9]+", 0).try_cast("bigint")
    dirt = {
        "Invoice": F.when(n % 43 == 7, F.lit(None)).otherwise(F.col("Invoice")),
        "StockCode": F.when(p % 61 == 6, F.lit("adjust")).when(p % 67 == 8, F.lit("47"))
        .when(p % 71 == 9, F.lit(None)).otherwise(F.col("StockCode")),
        "Description": F.when((p % 29 == 4) | ((p % 29 == 5) & (n % 2 == 0)), F.lit("   "))
        .when((p + n) % 31 == 6, F.lit('15CM "BALL", LIGHTS ')).otherwise(F.col("Description")),
        "Quantity": F.when(n % 37 == 3, F.lit(None)).when(n % 41 == 5, F.lit(0)).otherwise(F.col("Quantity")),
        "InvoiceDate": F.when(n % 83 == 11, F.lit(None)).otherwise(F.col("InvoiceDate")),
        "Price": F.when(p % 59 == 3, F.lit("0.001")).when(p % 53 == 2, (-F.col("Price")).cast("string"))
        .when(p % 5 == 1, (F.col("Price") + F.expr("0.0049BD")).cast("string"))
        .otherwise(F.col("Price").cast("string")).cast(PRICE_TYPE),
    }
    return retail_lines(spark, sf_dir).select(*[dirt.get(c, F.col(f"`{c}`")).alias(c) for c in RAW_COLUMNS])
