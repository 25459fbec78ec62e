"""The ledger of a layered run: which layers are written, with the
fingerprint of their rows and that of what they were built from.

An entry is a small file ``<root>/_ledger/<layer>.json``. It is taken away
when the write of its layer begins and put back when all of it is there, so
a run that stops in between leaves none. A layer need not be built again if
it has an entry that names the present inputs.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.session import delete_path, read_text, write_text
from tillroll.sources.fingerprints import METRICS, fingerprint


@dataclass(frozen=True)
class Ledger:
    spark: SparkSession
    root: str

    def _path(self, layer: str) -> str:
        return f"{self.root}/{layer}.json"

    def entry(self, layer: str) -> dict | None:
        """Inputs, Columns and the fingerprint of a finished layer."""
        text = read_text(self.spark, self._path(layer))
        return text and json.loads(text)

    def begin(self, layer: str) -> None:
        delete_path(self.spark, self._path(layer))

    def finish(self, layer: str, inputs: str | None, values: dict, df: DataFrame) -> None:
        entry = {"Layer": layer, "Inputs": inputs, "Columns": df.schema.simpleString(), **{m: int(values[m]) for m in METRICS}}
        write_text(self.spark, self._path(layer), json.dumps(entry))

    def identity(self, layer: str) -> str | None:
        """The fingerprint of a finished layer as text: what the layers
        built from it name as their input."""
        e = self.entry(layer)
        return e and ":".join(str(e[m]) for m in METRICS)

    def holds(self, layer: str, inputs: str | None) -> bool:
        """Is the layer finished, from these inputs?"""
        e = self.entry(layer)
        return e is not None and inputs is not None and e["Inputs"] == inputs

    def check(self, layers: dict[str, DataFrame]) -> DataFrame:
        """One row per layer: rows written, rows in the files, and whether
        both fingerprints of its rows agree. Scans the files once."""
        rows = []
        for layer, df in layers.items():
            want = self.entry(layer) or dict.fromkeys(METRICS)
            written = [F.lit(None if want[m] is None else str(want[m])).cast("decimal(38,0)") for m in METRICS]
            rows.append(fingerprint(df).select(
                F.lit(layer).alias("Layer"), written[0].cast("bigint").alias("WrittenRows"), F.col("Rows").alias("FileRows"),
                F.coalesce((F.col("HashA") == written[1]) & (F.col("HashB") == written[2]), F.lit(False)).alias("SameRows"),
            ))
        out = rows[0]
        for other in rows[1:]:
            out = out.unionByName(other)
        return out.withColumn("Passed", F.coalesce((F.col("WrittenRows") == F.col("FileRows")) & F.col("SameRows"), F.lit(False)))


def source_identity(spark: SparkSession, source: str | DataFrame) -> str | None:
    """The names, sizes and times of the files of a source path, hashed
    (their content is not read). None for a DataFrame: only its rows would
    tell."""
    if not isinstance(source, str):
        return None
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(source).select("path", "length", "modificationTime")
    row = fingerprint(files).first()
    return "files " + ":".join(str(row[m]) for m in METRICS)
