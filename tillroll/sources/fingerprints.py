"""Order-free fingerprints of the rows of a table.

A fingerprint is the number of rows and the sums of two 64-bit hashes of
every row. The sums do not depend on the order or the partitioning of the
rows, are exact (decimal), and each value of a row enters with a flag for
null, so that a changed cell, a value that moved to another column, a lost
and a doubled row all change them. It is taken with ``observe`` in the tasks
that write a layer, and again from the files. A hash is summed in three
parts of at most 22 bits, as longs (a sum of decimals costs several times as
much for every row); the parts are put together once, at the end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

METRICS = ("Rows", "HashA", "HashB")
_PART_BITS = 21  # of the two lower parts; the upper one has 22 and the sign
_SUM_TYPE = "decimal(38,0)"


def _row_hash(columns: list[str], seed: int) -> Column:
    values = [v for c in columns for v in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))]
    return F.xxhash64(F.lit(seed), *values)


def _exact_sum(value: Column) -> Column:
    """The sum of a long as a decimal; its parts overflow after 2^41 rows."""
    mask = F.lit((1 << _PART_BITS) - 1)
    parts = [
        (F.shiftright(value, 2 * _PART_BITS), 2 * _PART_BITS),
        (F.shiftright(value, _PART_BITS).bitwiseAND(mask), _PART_BITS),
        (value.bitwiseAND(mask), 0),
    ]
    high, middle, low = [F.sum(part).cast("decimal(20,0)") * F.expr(f"{1 << shift}BD") for part, shift in parts]
    return (high + middle + low).cast(_SUM_TYPE)


def fingerprint_metrics(columns: list[str]) -> list[Column]:
    """Rows, HashA, HashB over the given columns, in the order of their
    names (for ``agg`` or ``observe``)."""
    columns = sorted(columns)
    sums = [F.coalesce(_exact_sum(_row_hash(columns, seed)), F.lit(0)).cast(_SUM_TYPE) for seed in (1, 2)]
    return [F.count(F.lit(1)).alias("Rows"), sums[0].alias("HashA"), sums[1].alias("HashB")]


def fingerprint(df: DataFrame) -> DataFrame:
    """The fingerprint of all rows as one row."""
    return df.agg(*fingerprint_metrics(df.columns))
