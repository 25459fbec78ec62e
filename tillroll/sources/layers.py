"""Parquet layers: write, read back, profile.

Each layer is a Parquet directory written in full (overwrite) with an
explicit codec. The daily mart can be laid out by Year/Month so a query
on a year reads only that year's files (partition pruning); lines can be
clustered by stock code so a query on a few products reads few row groups.
"""

from __future__ import annotations

import uuid
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

DEFAULT_CODEC = "snappy"


def rebalanced(df: DataFrame, partition_by: list[str]) -> DataFrame:
    """Rows dealt out for a write by ``partition_by`` (the REBALANCE hint):
    each task writes few, large files per partition value instead of one
    small file per value per input task; AQE splits a value that is too big
    for one task and merges small ones (advisory partition size)."""
    return df.hint("rebalance", *partition_by)


def write_layer(df: DataFrame, path: str, *, partition_by: list[str] | None = None,
                mode: str = "overwrite", codec: str = DEFAULT_CODEC,
                max_records_per_file: int | None = None, rebalance: bool = True,
                metrics: list[Column] | None = None) -> dict[str, Any]:
    """Write a layer as Parquet; return the values of ``metrics``.

    With ``partition_by`` the rows are ``rebalanced`` first (unless they are
    already). The metrics are observed after that, in the tasks that write:
    those of a result stage count once however often they run, which map
    tasks of a shuffle would not.
    """
    out = rebalanced(df, partition_by) if partition_by and rebalance else df
    observation = Observation(f"write-{uuid.uuid4().hex[:8]}") if metrics else None
    if observation is not None:
        out = out.observe(observation, *metrics)
    writer = out.write.mode(mode).option("compression", codec)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return {} if observation is None else observation.get


def write_clustered(df: DataFrame, path: str, by: list[str], *, row_group_bytes: int = 32 << 20,
                    bloom_values: int = 100_000, codec: str = DEFAULT_CODEC) -> None:
    """Write a layer clustered by columns, for reads that look for few of
    their values.

    Rows are dealt out by ranges of ``by`` and sorted in each, so files and
    row groups hold neighbouring values and a filter on the first column
    skips all others by their least and largest value; Parquet bloom filters
    on every column of ``by`` (sized for ``bloom_values`` different ones a
    row group) skip row groups for the rest. A value with a large share of
    the rows would be one range, so a hash of the row follows in the order
    and splits it.
    """
    row = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    order = [*[F.col(f"`{c}`") for c in by], row]
    writer = (
        df.repartitionByRange(*order).sortWithinPartitions(*order)
        .write.mode("overwrite").option("compression", codec).option("parquet.block.size", row_group_bytes)
    )
    for c in by:
        writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true").option(
            f"parquet.bloom.filter.expected.ndv#{c}", bloom_values)
    writer.parquet(path)


def read_layer(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def layer_profile(df: DataFrame) -> DataFrame:
    """One row: rows, non-empty partitions, column count, schema and the
    Spark version.

    One scan; partitions are counted from ``spark_partition_id`` rather
    than through the RDD API.
    """
    return df.select(F.spark_partition_id().alias("_pid")).agg(
        F.count(F.lit(1)).alias("Rows"),
        F.countDistinct("_pid").alias("Partitions"),
        F.lit(len(df.columns)).alias("Columns"),
        F.lit(df.schema.simpleString()).alias("Schema"),
        F.lit(df.sparkSession.version).alias("SparkVersion"),
    )


def row_count_check(source: DataFrame, target: DataFrame, name: str) -> DataFrame:
    """Source-to-target row and column match as one check row (both sides
    counted in one aggregate over their union; no join)."""
    sides = source.select(F.lit(True).alias("_src")).unionByName(
        target.select(F.lit(False).alias("_src"))
    )
    return (
        sides.agg(
            F.count_if(F.col("_src")).alias("SourceRows"),
            F.count_if(~F.col("_src")).alias("TargetRows"),
        )
        .select(
            F.lit(name).alias("CheckName"),
            "SourceRows",
            "TargetRows",
            F.lit(len(source.columns)).alias("SourceColumns"),
            F.lit(len(target.columns)).alias("TargetColumns"),
        )
        .withColumn(
            "Passed",
            (F.col("SourceRows") == F.col("TargetRows"))
            & (F.col("SourceColumns") == F.col("TargetColumns")),
        )
    )


def copy_check(name: str, source_rows: int, source_columns: int, target: DataFrame) -> DataFrame:
    """The check row of a copy whose source rows were counted in the write;
    the target rows come from the written files."""
    return target.agg(F.count(F.lit(1)).alias("TargetRows")).select(
        F.lit(name).alias("CheckName"),
        F.lit(source_rows).cast("bigint").alias("SourceRows"),
        "TargetRows",
        F.lit(source_columns).alias("SourceColumns"),
        F.lit(len(target.columns)).alias("TargetColumns"),
    ).withColumn(
        "Passed",
        (F.col("SourceRows") == F.col("TargetRows"))
        & (F.col("SourceColumns") == F.col("TargetColumns")),
    )


def write_checked(df: DataFrame, path: str, name: str, **write_kw) -> DataFrame:
    """Write a layer and return its source-to-target check row. The source
    (e.g. a large CSV) is read once."""
    rows = write_layer(df, path, metrics=[F.count(F.lit(1)).alias("n")], **write_kw)["n"]
    return copy_check(name, int(rows), len(df.columns), read_layer(df.sparkSession, path))
