"""Silver cleaning and classification rules as Column expressions.

All of these are built-in functions, so they stay inside whole-stage
codegen and push through Catalyst like any other projection.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillroll.constants import (  # noqa: F401  (re-exported)
    CANCELLED,
    CANCELLED_PREFIX,
    CUSTOMER_ID_SUFFIX,
    NORMAL,
    STOCK_CODE_PATTERN,
)
from tillroll.schemas import REVENUE_TYPE

# Reject reasons, in the order the quality filter applies them.
REASON_PRICE = "NonPositivePrice"
REASON_STOCK_CODE = "InvalidStockCode"


def clean_text(c: str | Column) -> Column:
    """Strip leading and trailing spaces (tabs stay)."""
    return F.trim(F.col(c) if isinstance(c, str) else c)


def clean_stock_code(c: str | Column) -> Column:
    return F.upper(clean_text(c))


def clean_customer_id(c: str | Column) -> Column:
    """``13085.0`` -> ``13085``; null stays null."""
    return F.regexp_replace(F.col(c) if isinstance(c, str) else c, CUSTOMER_ID_SUFFIX, "")


def transaction_type(invoice: str | Column) -> Column:
    """Cancelled when the invoice starts with C (case-sensitive), else
    Normal; a null invoice is Normal."""
    inv = F.col(invoice) if isinstance(invoice, str) else invoice
    return F.when(inv.startswith(CANCELLED_PREFIX), F.lit(CANCELLED)).otherwise(F.lit(NORMAL))


def is_return(quantity: str | Column) -> Column:
    q = F.col(quantity) if isinstance(quantity, str) else quantity
    return F.coalesce(q < 0, F.lit(False))


def line_revenue(quantity: str | Column, price: str | Column) -> Column:
    """Signed revenue, exact: Quantity * Price as decimal(22,4)."""
    q = F.col(quantity) if isinstance(quantity, str) else quantity
    p = F.col(price) if isinstance(price, str) else price
    return (q * p).cast(REVENUE_TYPE)


def passes_price(price: str | Column) -> Column:
    p = F.col(price) if isinstance(price, str) else price
    return F.coalesce(p > 0, F.lit(False))


def passes_stock_code(stock_code: str | Column) -> Column:
    s = F.col(stock_code) if isinstance(stock_code, str) else stock_code
    return F.coalesce(s.rlike(STOCK_CODE_PATTERN), F.lit(False))


def reject_reason(price: str | Column = "Price",
                  stock_code: str | Column = "StockCode") -> Column:
    """Why a cleaned line fails the Silver quality rules; null if it passes.

    The price rule is checked first, then the stock-code rule, so every
    rejected row is counted under exactly one reason.
    """
    return (
        F.when(~passes_price(price), F.lit(REASON_PRICE))
        .when(~passes_stock_code(stock_code), F.lit(REASON_STOCK_CODE))
    )
