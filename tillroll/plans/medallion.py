"""The layer-by-layer run: raw CSV -> Bronze -> Silver -> Gold -> checks.

Each stage is its own function over paths, so it can run alone; each
writes its layer with one job and the next stage reads that layer back
(the written table is the lineage cut, so a lost executor never forces a
recompute from the raw files). Stage results come back as small
DataFrames of rows, not printouts.

Every layer is entered in a ledger with the fingerprint of its rows, taken
in the tasks that write it, and that of the layer it was built from. The
validation takes the fingerprints again from the files; a later run may
``resume``: it builds only what is not finished or has other inputs now.

Gold writes the invoice-grain pre-aggregate once and builds the daily,
customer and country marts from it; the product mart reads Silver. The
daily mart is laid out by Year/Month for partition pruning.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tillroll.operators import checks, marts, silver
from tillroll.plans.ledger import Ledger, source_identity
from tillroll.schemas import SILVER_COLUMNS
from tillroll.session import scratch_scope
from tillroll.sources.fingerprints import fingerprint_metrics
from tillroll.sources.layers import copy_check, read_layer, rebalanced, write_layer
from tillroll.sources.raw import conform_raw, read_raw

DAILY_LAYOUT = ["Year", "Month"]


@dataclass(frozen=True)
class LayerPaths:
    root: str

    def _p(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    @property
    def bronze(self) -> str:
        return self._p("bronze", "retail_lines")

    @property
    def silver(self) -> str:
        return self._p("silver", "retail_lines")

    @property
    def silver_totals(self) -> str:
        return self._p("silver", "_kept_totals")

    @property
    def silver_quality(self) -> str:
        return self._p("silver", "_quality")

    @property
    def invoice_grain(self) -> str:
        return self._p("gold", "_invoice_grain")

    @property
    def mart_totals(self) -> str:
        return self._p("gold", "_totals")

    @property
    def mart_stats(self) -> str:
        return self._p("gold", "_stats")

    def check(self, name: str) -> str:
        return self._p("gold", f"_check_{name}")

    @property
    def ledger(self) -> str:
        return self._p("_ledger")

    def mart(self, name: str) -> str:
        return self._p("gold", {
            "daily": "daily_sales",
            "product": "product_performance",
            "customer": "customer",
            "country": "country_sales",
        }[name])


def _recorded(paths: LayerPaths, layer: str, inputs: str | None, df: DataFrame, path: str,
              after: Callable[[], None] | None = None, **write_kw) -> dict:
    """Write a layer and enter it in the ledger with the fingerprint of the
    rows written; ``after`` writes what belongs to the layer before the entry
    is completed."""
    ledger = Ledger(df.sparkSession, paths.ledger)
    ledger.begin(layer)
    values = write_layer(df, path, metrics=fingerprint_metrics(df.columns), **write_kw)
    if after is not None:
        after()
    ledger.finish(layer, inputs, values, df)
    return values


def run_bronze(spark: SparkSession, source: str | DataFrame, paths: LayerPaths) -> DataFrame:
    """Copy raw lines (a CSV path or a DataFrame) to Parquet; return the
    source-to-target row check (source counted during the copy)."""
    inputs = source_identity(spark, source)
    raw = read_raw(spark, source) if isinstance(source, str) else conform_raw(source)
    rows = _recorded(paths, "bronze", inputs, raw, paths.bronze)["Rows"]
    return copy_check("bronze", int(rows), len(raw.columns), read_layer(spark, paths.bronze))


def run_silver(spark: SparkSession, paths: LayerPaths) -> DataFrame:
    """Dedup, clean, filter and write Silver; return the quality report
    of the cleaned lines as one row.

    The report is observed during the write (``observe``): its counts
    are accumulated by the same tasks that write Silver, after the dedup
    shuffle, so Bronze is read and deduplicated once. Each task's metrics
    are applied once, even when tasks are retried.
    """
    bronze = read_layer(spark, paths.bronze)
    judged = silver.judged_lines(silver.clean_lines(bronze))
    quality, totals = silver.quality_metrics(F.col(silver.KEPT)), silver.kept_totals_metrics()
    obs = Observation("silver_quality")
    observed = judged.observe(obs, *quality, *totals)
    lines = observed.filter(F.col(silver.KEPT)).select(*[F.col(f"`{c}`") for c in SILVER_COLUMNS])

    def keep_report() -> None:
        # the kept-line totals feed the validation gate (no Silver scan there)
        for metrics, path in ((totals, paths.silver_totals), (quality, paths.silver_quality)):
            schema = judged.agg(*metrics).schema
            write_layer(spark.createDataFrame([{f.name: obs.get[f.name] for f in schema}], schema), path)

    _recorded(paths, "silver", Ledger(spark, paths.ledger).identity("bronze"), lines, paths.silver, keep_report)
    return read_layer(spark, paths.silver_quality)


def run_gold(spark: SparkSession, paths: LayerPaths, *, resume: bool = False) -> dict[str, DataFrame]:
    """Build and write the four marts; return them read back.

    The exact totals of each mart, and those of its published columns, are
    observed while it is written and kept beside the marts for validation.
    With ``resume``, marts finished from the present Silver stay.
    """
    ledger = Ledger(spark, paths.ledger)
    inputs = ledger.identity("silver")

    def finished(layer: str) -> bool:
        return resume and ledger.holds(layer, inputs)

    s = read_layer(spark, paths.silver)
    if not finished("invoice_grain"):
        _recorded(paths, "invoice_grain", inputs, marts.invoice_grain(s), paths.invoice_grain)
    grain = read_layer(spark, paths.invoice_grain)
    exact = {
        "daily": lambda: rebalanced(marts.daily_sales(s, grain=grain, rounded=False), DAILY_LAYOUT),
        "product": lambda: marts.product_performance(s, rounded=False),
        "customer": lambda: marts.customer_mart(s, grain=grain, rounded=False),
        "country": lambda: marts.country_sales(s, grain=grain, rounded=False),
    }
    for name, build in exact.items():
        if not finished(name):
            with scratch_scope(spark, f"gold-{name}"):
                _write_mart(paths, name, inputs, build())
    return read_marts(spark, paths)


def _write_mart(paths: LayerPaths, name: str, inputs: str | None, mart: DataFrame) -> None:
    """Write an exact mart as published, with its totals beside it. They are
    observed after any shuffle of its rows, in the tasks that write."""
    metrics = checks.totals_metrics(name)
    obs = Observation(f"totals-{name}")

    def keep_totals() -> None:
        schema = mart.agg(*metrics).schema
        write_layer(mart.sparkSession.createDataFrame([obs.get], schema), f"{paths.mart_totals}/Mart={name}")

    _recorded(paths, name, inputs, marts.publish(mart.observe(obs, *metrics), name), paths.mart(name), keep_totals,
              partition_by=DAILY_LAYOUT if name == "daily" else None, rebalance=False)


def read_marts(spark: SparkSession, paths: LayerPaths) -> dict[str, DataFrame]:
    """The written marts, each in its published column order (partition
    columns come back last)."""
    return {m: read_layer(spark, paths.mart(m)).select(*[F.col(f"`{c}`") for c in marts.PUBLISHED_COLUMNS[m]])
            for m in checks.MART_NAMES}


def run_validation(spark: SparkSession, paths: LayerPaths, *, enforce: bool = True) -> dict[str, DataFrame]:
    """Checks over the written layers. With ``enforce`` the blocking ones
    (fingerprints of every layer, reconciliation gate of all four marts,
    published values, grain, null keys, ranks) raise on failure; negative
    revenue and the cancelled/negative overlap are reported only. The
    fingerprints scan every layer once. The gate compares totals observed
    while Silver and the marts were written, without any scan; each mart is
    scanned for its statistics and for the grouping of its grain check."""
    s = read_layer(spark, paths.silver)
    m = read_marts(spark, paths)
    # one job computes every per-mart statistic (each mart scanned once);
    # the checks below read that tiny table, the grain check groups the marts
    st = checks.stats_table(m, paths.mart_stats)
    totals = read_layer(spark, paths.mart_totals)

    def once(name: str, check: DataFrame) -> DataFrame:
        # a few rows from a scan of whole layers: written, so that enforcing
        # them and reading them afterwards is one scan
        write_layer(check.coalesce(1), paths.check(name))
        return read_layer(spark, paths.check(name))

    result = {
        "rows": once("rows", layer_fingerprints(spark, paths)),
        "gate": checks.gate_rows(s, totals, read_layer(spark, paths.silver_totals)),
        "published": checks.published_checks(st, totals),
        "grain": once("grain", checks.grain_checks(m)),
        "null_keys": checks.null_key_checks(m, st),
        "ranks": checks.rank_checks(m, st),
        "negative_net": checks.negative_net(m, st),
        "overlap": silver.overlap_count(s),
        "layer_counts": checks.layer_counts({"silver": s, **m}),
    }
    if enforce:
        blocking = reduce(
            lambda a, b: a.unionByName(b),
            [result["rows"].select(F.lit("rows").alias("Check"), F.col("Layer").alias("Mart"), "Passed")]
            + [result[k].select(F.lit(k).alias("Check"), "Mart", "Passed")
               for k in ("gate", "published", "grain", "null_keys", "ranks")],
        )
        checks.enforce(blocking, "Gold validation")
    return result


def layer_fingerprints(spark: SparkSession, paths: LayerPaths) -> DataFrame:
    """One row per written layer: are its files the rows that were written?"""
    layers = {"bronze": read_layer(spark, paths.bronze), "silver": read_layer(spark, paths.silver),
              "invoice_grain": read_layer(spark, paths.invoice_grain), **read_marts(spark, paths)}
    return Ledger(spark, paths.ledger).check(layers)


def run_layers(spark: SparkSession, source: str | DataFrame, out_dir: str, *,
               enforce: bool = True, report: dict[str, DataFrame] | None = None, resume: bool = False) -> DataFrame:
    """All stages in order. Returns rows (Stage, Layer, RowCount); the
    results of the stages (bronze copy check, Silver quality report, each
    validation check) are put into ``report`` if one is given.

    With ``resume``, layers that an earlier run finished under ``out_dir``
    from the same inputs stay. A source path is the same if its files have
    the same names, sizes and times; the rows of a DataFrame are copied
    again, and what follows stays if they have the same fingerprint. The
    validation runs in full.

    Raises (``ValidationError``) if the bronze copy lost rows or a
    blocking Gold check fails. The session belongs to the caller.
    """
    paths = LayerPaths(out_dir)
    ledger = Ledger(spark, paths.ledger)
    if resume and ledger.holds("bronze", source_identity(spark, source)):
        copied = ledger.entry("bronze")
        bronze = read_layer(spark, paths.bronze)
        bronze_check = copy_check("bronze", copied["Rows"], len(bronze.columns), bronze)
    else:
        bronze_check = run_bronze(spark, source, paths)
    if enforce:
        checks.enforce(bronze_check, "Bronze copy")
    if resume and ledger.holds("silver", ledger.identity("bronze")):
        quality = read_layer(spark, paths.silver_quality)
    else:
        quality = run_silver(spark, paths)
    run_gold(spark, paths, resume=resume)
    validation = run_validation(spark, paths, enforce=enforce)
    if report is not None:
        report |= {"bronze": bronze_check, "quality": quality, **validation}
    layers = {"bronze": read_layer(spark, paths.bronze), "silver": read_layer(spark, paths.silver),
              **read_marts(spark, paths)}
    stage = {"bronze": "bronze", "silver": "silver"}
    return reduce(
        lambda a, b: a.unionByName(b),
        [df.agg(F.count(F.lit(1)).alias("RowCount")).select(
            F.lit(stage.get(name, "gold")).alias("Stage"), F.lit(name).alias("Layer"), "RowCount")
         for name, df in layers.items()],
    )
