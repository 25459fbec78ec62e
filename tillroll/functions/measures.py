"""Gold measures: calendar columns, per-line metric columns, the shared
mart aggregates, and exact half-up rounding.

Rounding is done on integers (``div`` is exact integer division), never
on doubles, so the results do not depend on the engine's float rounding.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.constants import CANCELLED, MONEY_PLACES, MONTH_NAME_FORMAT, NORMAL
from tillroll.schemas import MONEY_TYPE, REVENUE_TYPE, SUM_TYPE


def _zero_money() -> Column:
    return F.lit(0).cast(REVENUE_TYPE)


def calendar_columns(ts: str = "InvoiceDate") -> dict[str, Column]:
    """SaleDate, Year, Month and the full English month name.

    They are all functions of the date, so marts group by SaleDate alone
    and derive the other three after aggregation.
    """
    c = F.col(ts)
    return {
        "SaleDate": F.to_date(c),
        "Year": F.year(c).cast(T.IntegerType()),
        "Month": F.month(c).cast(T.IntegerType()),
        "MonthName": F.date_format(c, MONTH_NAME_FORMAT),
    }


def _line_classes() -> tuple[Column, Column, Column]:
    """Is a Silver line a sale, a return, a cancelled line?"""
    normal, qty = F.col("TransactionType") == NORMAL, F.col("Quantity")
    return normal & (qty > 0), normal & (qty < 0), F.col("TransactionType") == CANCELLED


def line_metrics() -> dict[str, Column]:
    """Per-line measures over a Silver line.

    GrossSales/SoldUnits: normal lines with positive quantity.
    ReturnAmount/ReturnUnits: normal lines with negative quantity.
    CancelledAmount: every cancelled line, whatever its sign, as abs(Revenue).
    A cancelled line with negative quantity is not a return.
    """
    qty, rev = F.col("Quantity"), F.col("Revenue")
    sale, ret, cancelled = _line_classes()
    return {
        "GrossSales": F.when(sale, rev).otherwise(_zero_money()),
        "ReturnAmount": F.when(ret, F.abs(rev)).otherwise(_zero_money()),
        "CancelledAmount": F.when(cancelled, F.abs(rev)).otherwise(_zero_money()),
        "ReturnUnits": F.when(ret, F.abs(qty)).otherwise(F.lit(0)),
        "SoldUnits": F.when(sale, qty).otherwise(F.lit(0)),
    }


# A sum of decimals of more than 18 digits makes several objects for every
# row. Sums over lines therefore take an amount as two longs, ``High`` * _PIECE
# + ``Low`` ten-thousandths, both with its sign. The sums of the pairs hold
# what SUM_TYPE holds, to 9e22, and the lower one 9e10 lines.
_PIECE = 100_000_000
_ORDINARY = 1e10  # below it the double times 10,000 is less than 0.02 off an integer
MONEY_SUMS = ("GrossSales", "ReturnAmount", "CancelledAmount")
UNIT_SUMS = ("SoldUnits", "ReturnUnits")


def _high_low(amount: str) -> tuple[Column, Column]:
    """An amount (a decimal column of scale 4) as High and Low."""
    value = F.col(amount).cast("double")
    ticks = F.rint(value * 10000).cast("bigint")
    exact = F.expr(f"CAST(`{amount}` * 10000BD AS DECIMAL(28,0))")
    piece, ordinary = F.lit(_PIECE).cast("bigint"), F.abs(value) < _ORDINARY
    high = F.when(ordinary, F.call_function("div", ticks, piece)).otherwise(
        F.call_function("div", exact, piece.cast("decimal(20,0)")))
    return high, F.when(ordinary, ticks % piece).otherwise((exact % piece).cast("bigint"))


def with_line_pieces(lines: DataFrame) -> DataFrame:
    """Silver lines with the measures of ``line_metrics`` in the form that
    ``piece_sums`` adds up: units, and money as High and Low."""
    high, low = _high_low("Revenue")
    split = lines.withColumns({"_high": high, "_low": low})
    sale, ret, cancelled = _line_classes()
    none, units = F.lit(0).cast("bigint"), line_metrics()
    pieces = {c: units[c] for c in UNIT_SUMS}
    for side in ("High", "Low"):
        amount = F.col(f"_{side.lower()}")
        pieces |= {
            f"GrossSales{side}": F.when(sale, amount).otherwise(none),
            f"ReturnAmount{side}": F.when(ret, F.abs(amount)).otherwise(none),
            f"CancelledAmount{side}": F.when(cancelled, F.abs(amount)).otherwise(none),
        }
    return split.withColumns({f"_{c}": e for c, e in pieces.items()}).drop("_high", "_low")


def with_sum_pieces(grain: DataFrame) -> DataFrame:
    """The same columns from a pre-aggregate with the five measures."""
    pieces = {f"_{c}": F.col(c) for c in UNIT_SUMS}
    for m in MONEY_SUMS:
        pieces[f"_{m}High"], pieces[f"_{m}Low"] = _high_low(m)
    return grain.withColumns(pieces)


PIECE_COLUMNS = [f"_{c}" for c in UNIT_SUMS] + [f"_{m}{side}" for m in MONEY_SUMS for side in ("High", "Low")]


def piece_sums() -> list[Column]:
    """Sums of line pieces that keep their names, for a pre-aggregate."""
    return [F.sum(c).alias(c) for c in PIECE_COLUMNS]


def money_of_pieces(measure: str, where: Column | None = None) -> Column:
    """The exact sum of a money measure over line pieces or sums of them."""
    high, low = [F.sum(_where(f"_{measure}{side}", where)) for side in ("High", "Low")]
    ticks = high.cast("decimal(20,0)") * F.expr(f"{_PIECE}BD") + low.cast("decimal(20,0)")
    return (ticks * F.expr("0.0001BD")).cast(SUM_TYPE)


def units_of_pieces(measure: str, where: Column | None = None) -> Column:
    return F.sum(_where(f"_{measure}", where)).cast(T.LongType())


def _where(column: str, where: Column | None) -> Column:
    return F.col(column) if where is None else F.when(where, F.col(column))


def sums_of_pieces(sold_name: str = "SoldUnits") -> list[Column]:
    """The five additive measures every mart carries, from line pieces, sums
    of them, or the pieces of a pre-aggregate."""
    return [
        units_of_pieces("SoldUnits").alias(sold_name),
        units_of_pieces("ReturnUnits").alias("ReturnUnits"),
        *[money_of_pieces(m).alias(m) for m in MONEY_SUMS],
    ]


def transaction_class() -> Column:
    """Sale / Return / Cancelled / Zero: the three business classes plus
    lines that move no units (quantity 0 or unknown)."""
    qty = F.col("Quantity")
    return (
        F.when(F.col("TransactionType") == CANCELLED, F.lit("Cancelled"))
        .when(qty < 0, F.lit("Return"))
        .when(qty > 0, F.lit("Sale"))
        .otherwise(F.lit("Zero"))
    )


def net_revenue() -> Column:
    return (F.col("GrossSales") - F.col("ReturnAmount") - F.col("CancelledAmount")).cast(SUM_TYPE)


def _hundredths(units: Column) -> Column:
    """An integer count of hundredths as decimal(18,2), exactly."""
    return (units.cast(T.DecimalType(20, 0)) / F.lit(100)).cast(MONEY_TYPE)


def return_rate(return_units: str = "ReturnUnits", units_sold: str = "UnitsSold") -> Column:
    """ReturnUnits / UnitsSold * 100, half-up to 2 places; 0 when nothing sold.

    In hundredths of a percent: (RU * 20000 + US) div (2 * US).
    """
    hundredths = F.expr(
        f"(`{return_units}` * 20000 + `{units_sold}`) div (2 * `{units_sold}`)"
    )
    return (
        F.when(F.col(units_sold) > 0, _hundredths(hundredths))
        .otherwise(F.lit(0).cast(MONEY_TYPE))
    )


def average_order_value(gross: str = "GrossSales", orders: str = "Orders") -> Column:
    """GrossSales / Orders half-up to cents; 0 when there are no orders.

    With g = GrossSales * 10000 as an integer: (2g + 100 * Orders) div
    (200 * Orders) cents. GrossSales is never negative.
    """
    cents = F.expr(
        f"(2 * CAST(`{gross}` * 10000 AS BIGINT) + 100 * `{orders}`) div (200 * `{orders}`)"
    )
    return (
        F.when(F.col(orders) > 0, _hundredths(cents))
        .otherwise(F.lit(0).cast(MONEY_TYPE))
    )


def round_money(c: str | Column) -> Column:
    """Half-up (away from zero) to 2 places, as decimal(18,2)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.round(col, MONEY_PLACES).cast(MONEY_TYPE)
