"""Session helpers: a local session for tests and the bench, and the
shared folder for checkpoints and intermediate tables.

On a cluster the folder comes from ``spark.checkpoint.dir`` (a shared
filesystem every executor can reach). Only a local-mode session without
that setting gets a private temporary folder.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SCRATCH_ROOT = "tillroll.scratch.root"  # session setting: the folder of a scratch_scope


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "tillroll") -> SparkSession:
    """A local session configured the way the tests and the bench run."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def cluster_conf(total_cores: int, checkpoint_dir: str) -> dict[str, str]:
    """Suggested session settings for very large inputs on a cluster.

    Shuffle width starts at ~3x the cores and AQE merges partitions up to
    the advisory size (so small stages do not run thousands of tiny
    tasks) and splits skewed join partitions. ``checkpoint_dir`` must be a
    shared folder (HDFS, object store): rank inputs and scratch tables are
    written there.
    """
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 << 20),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": str(max(200, 3 * total_cores)),
        "spark.sql.files.maxPartitionBytes": str(256 << 20),
        "spark.sql.parquet.compression.codec": "snappy",
        "spark.checkpoint.dir": checkpoint_dir,
    }


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints, set on the context if needed.

    Reads ``spark.checkpoint.dir`` (or a directory already set on the
    context). A local session without one gets a temporary folder; a
    cluster session without one is an error, since a machine-local folder
    would not survive the loss of that machine.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not configured:
        if not _is_local(spark):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a shared folder "
                "(HDFS, object store) that every executor can reach"
            )
        configured = tempfile.mkdtemp(prefix="tillroll-ckpt-")
    sc.setCheckpointDir(configured)
    return (sc.getCheckpointDir() or configured).rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder, or under the
    folder of the ``scratch_scope`` around it."""
    root = spark.conf.get(SCRATCH_ROOT, None) or checkpoint_dir(spark)
    return f"{root}/tillroll-{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def scratch_scope(spark: SparkSession, name: str) -> Iterator[str]:
    """Scratch tables of the block go to one folder, deleted at its end.
    DataFrames that still read them must not leave the block."""
    outer = spark.conf.get(SCRATCH_ROOT, None)
    root = scratch_path(spark, name)
    spark.conf.set(SCRATCH_ROOT, root)
    try:
        yield root
    finally:
        if outer is None:
            spark.conf.unset(SCRATCH_ROOT)
        else:
            spark.conf.set(SCRATCH_ROOT, outer)
        delete_path(spark, root)


def _file_system(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder on whatever file system it lies."""
    files, target = _file_system(spark, path)
    files.delete(target, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text file, there whole or not at all."""
    files, target = _file_system(spark, path)
    _, part = _file_system(spark, f"{path}.part-{uuid.uuid4().hex[:8]}")
    out = files.create(part, True)
    out.write(bytearray(text.encode()))
    out.close()
    files.delete(target, False)
    if not files.rename(part, target):
        raise OSError(f"could not write {path}")


def read_text(spark: SparkSession, path: str) -> str | None:
    """The content of a small text file; None if there is none."""
    files, target = _file_system(spark, path)
    if not files.exists(target):
        return None
    stream = files.open(target)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def materialize(df, name: str):
    """Write ``df`` as Parquet under the shared checkpoint folder and
    return it read back: a lineage cut that is columnar and compressed
    (cheaper than an RDD checkpoint of serialized rows)."""
    return materialize_counted(df, name)[0]


def materialize_counted(df, name: str):
    """``materialize`` plus the number of rows written, observed during
    the write itself (no second job)."""
    from pyspark.sql import Observation
    from pyspark.sql import functions as F

    path = scratch_path(df.sparkSession, name)
    obs = Observation(f"rows-{name}")
    df.observe(obs, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path), int(obs.get["n"])


def free_names(taken: list[str], *names: str) -> list[str]:
    """The names, each with as many underscores before it as it takes to
    differ from ``taken`` (helper columns beside columns of any name)."""
    used = {t.lower() for t in taken}
    out = []
    for name in names:
        while name.lower() in used:
            name = f"_{name}"
        used.add(name.lower())
        out.append(name)
    return out
