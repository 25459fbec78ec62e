"""Raw transaction lines: CSV in with an explicit schema, CSV out.

The reader never infers a schema. Quoted fields escape a quote by
doubling it (``"15CM ""BALL"", LIGHTS"``); a cell that does not parse
becomes null (PERMISSIVE mode) and, when asked for, the whole line is
kept in a corrupt-record column so rejected rows can be counted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.schemas import RAW_COLUMNS, RAW_SCHEMA

CORRUPT_COLUMN = "_corrupt_record"
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"


def read_raw(spark: SparkSession, path: str | list[str], *,
             keep_corrupt: bool = False,
             timestamp_format: str | None = None) -> DataFrame:
    """Read raw lines with the fixed 8-column schema.

    ``keep_corrupt`` adds ``_corrupt_record``, non-null on lines whose
    cells did not all parse (their unparsable cells are null).
    Dates are read in all forms that Spark takes by default (a date, a date
    and minutes or seconds or fractions, with a blank or a T between);
    ``timestamp_format`` is a Spark datetime pattern that replaces them
    (e.g. ``M/d/yyyy H:mm`` for exports that write dates that way). Uncompressed CSV splits into
    many tasks; gzip files do not, so deliver those as many files.
    """
    schema = RAW_SCHEMA
    if keep_corrupt:
        schema = T.StructType(
            RAW_SCHEMA.fields + [T.StructField(CORRUPT_COLUMN, T.StringType(), True)]
        )
    reader = (
        spark.read.schema(schema)
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
    )
    if timestamp_format:
        reader = reader.option("timestampNTZFormat", timestamp_format)
    if keep_corrupt:
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
    return reader.csv(path)


def rejected_cells(df: DataFrame) -> DataFrame:
    """Lines read with ``keep_corrupt=True`` plus ``Rejected``: an array of
    (Column, Value), the cells whose text could not be read as their type.

    The cells of a corrupt line are taken from its kept text, all as
    strings; one that has text there and is null in its type was rejected,
    one that is empty was not. Lines that parsed are not read again.
    """
    cells = F.from_csv(F.col(CORRUPT_COLUMN), ", ".join(f"`{c}` string" for c in RAW_COLUMNS), {"quote": '"', "escape": '"'})
    with_text = df.withColumn("_cells", F.when(F.col(CORRUPT_COLUMN).isNotNull(), cells))
    one_by_one = [
        F.when(F.col("_cells")[c].isNotNull() & F.col(f"`{c}`").isNull(),
               F.struct(F.lit(c).alias("Column"), F.col("_cells")[c].alias("Value")))
        for c in RAW_COLUMNS
    ]
    return with_text.withColumn("Rejected", F.array_compact(F.array(*one_by_one))).drop("_cells")


def read_report(df: DataFrame) -> DataFrame:
    """One row over lines read with ``keep_corrupt=True``: total lines,
    lines that did not fully parse, those of them without a rejected cell
    (too few or too many cells), and the rejected cells per column. One
    scan."""
    cells = rejected_cells(df)
    names = F.transform("Rejected", lambda cell: cell["Column"])
    corrupt = F.col(CORRUPT_COLUMN).isNotNull()
    return cells.agg(
        F.count(F.lit(1)).alias("TotalRows"),
        F.count_if(corrupt).alias("CorruptRows"),
        F.count_if(corrupt & (F.size("Rejected") == 0)).alias("MisshapenRows"),
        *[F.count_if(F.array_contains(names, c)).alias(f"Rejected{c.replace(' ', '')}") for c in RAW_COLUMNS],
    )


def conform_raw(df: DataFrame) -> DataFrame:
    """Any raw-shaped DataFrame (e.g. Parquet with a double price or a
    string date) cast to the fixed 8-column schema, in schema order.

    Unparsable values become null (``try_cast``), as the CSV reader does;
    so does a quantity with a fraction.
    """

    def conformed(f: T.StructField) -> Column:
        c = F.col(f"`{f.name}`")
        fractional = isinstance(df.schema[f.name].dataType, (T.DoubleType, T.FloatType, T.DecimalType))
        if fractional and isinstance(f.dataType, T.IntegerType):
            c = F.when(c == F.floor(c), c)
        return c.try_cast(f.dataType).alias(f.name)

    return df.select(*[conformed(f) for f in RAW_SCHEMA.fields])


def read_raw_parquet(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Raw lines delivered as Parquet, conformed to the raw schema."""
    return conform_raw(spark.read.parquet(*([path] if isinstance(path, str) else path)))


def write_raw_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write lines as quoted CSV that ``read_raw`` reads back unchanged.

    Leading and trailing spaces are kept (the writer trims them by
    default) and timestamps use the reader's format. An empty string
    reads back as null, like any empty CSV cell.
    """
    (
        df.select(*[F.col(f"`{c}`") for c in RAW_COLUMNS])
        .write.mode(mode)
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("timestampNTZFormat", TIMESTAMP_FORMAT)
        .csv(path)
    )
