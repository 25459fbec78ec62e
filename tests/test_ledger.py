"""Fingerprints of written layers, and runs that resume."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from tillroll.operators.checks import ValidationError
from tillroll.plans import medallion
from tillroll.plans.ledger import Ledger, source_identity
from tillroll.plans.medallion import LayerPaths, layer_fingerprints, read_marts, run_layers, run_validation
from tillroll.sources.fingerprints import fingerprint
from tillroll.sources.layers import read_layer, write_layer


def _print(df):
    return tuple(fingerprint(df).first())


def test_fingerprint_ignores_order_and_partitions(spark):
    df = spark.range(500).select("id", (F.col("id") % 7).cast("string").alias("a b"), F.lit(None).cast("double").alias("c"))
    want = _print(df)
    assert want[0] == 500
    assert _print(df.repartition(7)) == want == _print(df.orderBy(F.col("id").desc()).select("c", "id", "a b"))


@pytest.mark.parametrize("change", ["cell", "null", "moved", "lost", "doubled", "swapped"])
def test_fingerprint_sees_every_change(spark, change):
    rows = [(i, f"t{i % 5}", i % 3, None) for i in range(60)]
    bad = list(rows)
    if change == "cell":
        bad[7] = (7, "t9", 1, None)
    elif change == "null":
        bad[7] = (7, None, 1, None)
    elif change == "moved":  # the same value in another column
        bad[7] = (7, "t2", None, 1)
    elif change == "lost":
        bad = bad[1:]
    elif change == "doubled":
        bad[1] = bad[0]
    else:  # two rows exchange one value
        bad[0], bad[1] = (0, "t1", 0, None), (1, "t0", 1, None)
    kind = "k int, t string, n int, m int"
    assert _print(spark.createDataFrame(rows, kind)) != _print(spark.createDataFrame(bad, kind))


def test_empty_table_has_a_fingerprint(spark):
    assert _print(spark.range(0)) == (0, 0, 0)


@pytest.fixture(scope="module")
def finished(spark, raw_csv_path, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("ledger"))
    run_layers(spark, raw_csv_path, root).collect()
    return root


def _changed(rows):
    r = rows[0].asDict()
    column = "Description" if "Description" in r else "Country"
    return [type(rows[0])(**(r | {column: "OTHER"})), *rows[1:]]


SPOILT = {"cell": _changed, "lost": lambda rows: rows[1:], "doubled": lambda rows: [*rows, rows[-1]]}


@pytest.mark.parametrize("layer", ["silver", "product", "customer", "daily", "country"])
def test_a_changed_lost_or_doubled_row_fails(spark, finished, layer, tmp_path):
    paths, ledger = LayerPaths(finished), Ledger(spark, LayerPaths(finished).ledger)
    good = read_layer(spark, paths.silver) if layer == "silver" else read_marts(spark, paths)[layer]
    assert ledger.check({layer: good}).first()["Passed"]
    rows = good.collect()
    for name, spoil in SPOILT.items():
        files = f"{tmp_path}/{name}"
        write_layer(spark.createDataFrame(spoil(rows), good.schema).coalesce(1), files)
        check = ledger.check({layer: read_layer(spark, files)}).first()
        assert not check["Passed"] and not check["SameRows"] and (check["WrittenRows"] == check["FileRows"]) == (name == "cell")


def test_validation_enforces_the_fingerprints(spark, finished):
    paths = LayerPaths(finished)
    good = read_layer(spark, paths.silver)
    rows, schema = good.collect(), good.schema
    write_layer(spark.createDataFrame(_changed(rows), schema), paths.silver)
    with pytest.raises(ValidationError, match="'rows', 'Mart': 'silver'"):
        run_validation(spark, paths)
    write_layer(spark.createDataFrame(rows, schema), paths.silver)
    assert layer_fingerprints(spark, paths).filter("NOT Passed").count() == 0


def _count_writes(monkeypatch):
    written = []
    real = medallion._recorded

    def recorded(paths, layer, *args, **kw):
        written.append(layer)
        return real(paths, layer, *args, **kw)

    monkeypatch.setattr(medallion, "_recorded", recorded)
    return written


def test_a_run_stopped_in_gold_starts_again_in_gold(spark, raw_csv_path, scratch, monkeypatch):
    root = os.path.join(scratch, "stopped")
    real = medallion._write_mart

    def stop_at_customer(paths, name, *args):
        if name == "customer":
            raise RuntimeError("the cluster went away")
        real(paths, name, *args)

    monkeypatch.setattr(medallion, "_write_mart", stop_at_customer)
    with pytest.raises(RuntimeError):
        run_layers(spark, raw_csv_path, root)
    monkeypatch.setattr(medallion, "_write_mart", real)
    written = _count_writes(monkeypatch)
    report = {}
    again = run_layers(spark, raw_csv_path, root, resume=True, report=report)
    assert written == ["customer", "country"]
    assert {r["Layer"] for r in again.filter("RowCount > 0").collect()} == {"bronze", "silver", "daily", "product", "customer", "country"}
    assert report["rows"].count() == 7 and report["quality"].first()["TotalRows"] == 17


def test_an_open_entry_is_built_again(spark, raw_csv_path, scratch, monkeypatch):
    root = os.path.join(scratch, "open")
    run_layers(spark, raw_csv_path, root)
    Ledger(spark, LayerPaths(root).ledger).begin("silver")  # a write began and never ended
    written = _count_writes(monkeypatch)
    run_layers(spark, raw_csv_path, root, resume=True)
    assert written == ["silver"]  # the same rows again, so Gold stays


def test_other_inputs_are_built_again(spark, scratch, monkeypatch):
    from tests.conftest import RAW_CSV

    root, source = os.path.join(scratch, "inputs"), os.path.join(scratch, "lines.csv")
    with open(source, "w") as f:
        f.write(RAW_CSV)
    run_layers(spark, source, root)
    written = _count_writes(monkeypatch)
    run_layers(spark, source, root, resume=True)
    assert written == []
    with open(source, "a") as f:
        f.write("489500,85048,NEW LINE,2,2010-01-05 10:00:00,3.00,13085.0,France\n")
    counts = {r["Layer"]: r["RowCount"] for r in run_layers(spark, source, root, resume=True).collect()}
    assert written == ["bronze", "silver", "invoice_grain", "daily", "product", "customer", "country"]
    assert counts["bronze"] == 19
    written.clear()
    frame = read_layer(spark, LayerPaths(root).bronze).repartition(3)
    assert source_identity(spark, frame) is None
    kept = os.path.join(scratch, "copy-of-bronze")
    write_layer(frame, kept)
    run_layers(spark, read_layer(spark, kept), root, resume=True)
    assert written == ["bronze"]  # the same rows from a DataFrame


def test_scratch_tables_of_a_run_are_deleted(spark, raw_csv_path, scratch):
    from tillroll.session import checkpoint_dir

    folder = checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    run_layers(spark, raw_csv_path, os.path.join(scratch, "clean")).collect()
    assert set(os.listdir(folder)) == before


def test_metrics_are_observed_in_the_tasks_that_write(spark, scratch):
    """The metrics of a partitioned write stand above its rebalance."""
    df = spark.range(1000).withColumn("Year", F.col("id") % 3)
    seen = write_layer(df, os.path.join(scratch, "p"), partition_by=["Year"], metrics=[F.count(F.lit(1)).alias("n")])
    assert seen == {"n": 1000}
    from tillroll.sources.layers import rebalanced

    plan = rebalanced(df, ["Year"]).observe("x", F.count(F.lit(1)).alias("n"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("CollectMetrics") < plan.index("RebalancePartitions")
