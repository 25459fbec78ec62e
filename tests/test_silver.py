from __future__ import annotations

from decimal import Decimal

from pyspark.sql import functions as F

from tillroll.operators import silver
from tillroll.sources.raw import read_raw


def _by_desc(rows):
    return {r["Description"]: r for r in rows}


def test_csv_quoting_and_types(raw_lines):
    rows = raw_lines.collect()
    assert len(rows) == 18
    first = rows[0]
    assert first["Description"] == '15CM "BALL", LIGHTS'
    assert first["Quantity"] == 12
    assert first["Price"] == Decimal("6.9500")
    assert str(first["InvoiceDate"]) == "2009-12-01 07:45:00"
    tiny = [r for r in rows if r["Description"] == "TINY PRICE"][0]
    assert tiny["Price"] == Decimal("0.0010")  # stays positive at scale 4


def test_unparsable_cells_become_null_and_are_reported(spark, raw_csv_path):
    df = read_raw(spark, raw_csv_path, keep_corrupt=True)
    bad = df.filter(F.col("_corrupt_record").isNotNull()).select("Description", "InvoiceDate").collect()
    assert [r["Description"] for r in bad] == ["BAD DATE"]
    assert bad[0]["InvoiceDate"] is None


def test_read_report_counts_rejected_lines(spark, raw_csv_path):
    from tillroll.sources.raw import read_report

    rep = read_report(read_raw(spark, raw_csv_path, keep_corrupt=True)).first()
    assert (rep["TotalRows"], rep["CorruptRows"], rep["MisshapenRows"], rep["RejectedInvoiceDate"]) == (18, 1, 0, 1)
    assert rep["RejectedPrice"] == 0 and rep["RejectedCustomerID"] == 0


def test_rejected_cells_are_those_with_unreadable_text(spark, scratch):
    """An empty cell of a corrupt line was not rejected; a line with too few
    or too many cells need not hold a rejected one."""
    import os

    from tillroll.sources.raw import read_report, rejected_cells

    path = os.path.join(scratch, "odd.csv")
    lines = [
        '1,85048,"A ""B"", C",many,2009-12-01 07:45:00,6.95,,UK',      # quantity; the customer is empty
        "2,85048,B,,never,x,13085.0,UK",                               # date and price; the quantity is empty
        "3,85048,C,3,2009-12-01 07:45:00,1.5,13085.0,UK",              # fine
        "4,85048,D,4,2009-12-01 07:45:00,1.5",                         # too few cells
        "5,85048,E,5,2009-12-01 07:45:00,1.5,13085.0,UK,more",         # too many
        "6,85048,F, 6,2009-12-01 07:45:00,99999999999999.5,13085.0,",  # a blank before the number; price too large
    ]
    with open(path, "w") as f:
        f.write("Invoice,StockCode,Description,Quantity,InvoiceDate,Price,Customer ID,Country\n" + "\n".join(lines) + "\n")
    raw = read_raw(spark, path, keep_corrupt=True)
    found = {r["Invoice"]: {c["Column"]: c["Value"] for c in r["Rejected"]} for r in rejected_cells(raw).collect()}
    assert found == {"1": {"Quantity": "many"}, "2": {"InvoiceDate": "never", "Price": "x"}, "3": {}, "4": {}, "5": {},
                     "6": {"Quantity": " 6", "Price": "99999999999999.5"}}
    rep = read_report(raw).first().asDict()
    assert rep == {"TotalRows": 6, "CorruptRows": 5, "MisshapenRows": 2, "RejectedInvoice": 0, "RejectedStockCode": 0,
                   "RejectedDescription": 0, "RejectedQuantity": 2, "RejectedInvoiceDate": 1, "RejectedPrice": 2,
                   "RejectedCustomerID": 0, "RejectedCountry": 0}


def test_dedup_runs_before_cleaning(raw_lines):
    deduped = silver.dedup_lines(raw_lines)
    assert deduped.count() == 17  # only the exact pair collapses
    cleaned = silver.clean_lines(raw_lines).filter(F.col("StockCode") == "85123A")
    assert cleaned.count() == 2  # equal only after trim/upper: both kept


def test_cleaning_rules(raw_lines):
    rows = silver.clean_lines(raw_lines).collect()
    d = _by_desc(rows)
    heart = d["CREAM HEART"]
    assert heart["Country"] == "United Kingdom"
    assert heart["Customer ID"] == "13085"
    assert d["PAPER BUNTING"]["TransactionType"] == "Cancelled"
    assert d["PAPER BUNTING"]["IsReturn"] is True
    assert d["PAPER BUNTING"]["Revenue"] == Decimal("-35.4000")
    assert d["STRAWBERRY MUG"]["Customer ID"] is None
    assert d["STRAWBERRY MUG"]["TransactionType"] == "Normal"
    assert d["NULL QTY"]["IsReturn"] is False
    assert d["NULL QTY"]["Revenue"] is None
    assert "" in d  # whitespace-only description trims to '' (not null)


def test_quality_filter(raw_lines):
    kept = {r["StockCode"] for r in silver.silver_lines(raw_lines).collect()}
    assert "ADJUST" in kept
    assert "22113" in kept  # price 0.001
    for dropped in ("POST", "BANK CHARGES", "GIFT_0001_80", "22112", "22114"):
        assert dropped not in kept


def test_quality_report_and_reasons(raw_lines):
    clean = silver.clean_lines(raw_lines)
    rep = silver.quality_report(clean).first().asDict()
    assert rep == {
        "TotalRows": 17,
        "InvalidPriceRows": 2,
        "ZeroQuantityRows": 1,
        "MissingCustomerRows": 2,
        "MissingDescriptionRows": 0,
        "MissingDateRows": 1,
        "KeptRows": 12,
        "RejectedRows": 5,
        "RemainingInvalidPriceRows": 0,
    }
    reasons = {r["RejectReason"]: r["RowCount"] for r in silver.rejects_by_reason(clean).collect()}
    assert reasons == {"NonPositivePrice": 2, "InvalidStockCode": 3}


def test_type_counts(raw_lines):
    got = {
        (r["Breakdown"], r["Value"]): (r["RowsBeforeFilter"], r["RowsAfterFilter"])
        for r in silver.type_counts(silver.clean_lines(raw_lines)).collect()
    }
    assert got[("TransactionType", "Cancelled")] == (2, 2)
    assert got[("TransactionType", "Normal")] == (15, 10)
    assert got[("IsReturn", "true")] == (2, 2)
    assert got[("IsReturn", "false")] == (15, 10)


def test_silver_schema(raw_lines):
    s = silver.silver_lines(raw_lines)
    assert s.columns == [
        "Invoice", "StockCode", "Description", "Quantity", "InvoiceDate", "Price",
        "Customer ID", "Country", "TransactionType", "IsReturn", "Revenue",
    ]
    assert s.schema["Revenue"].dataType.simpleString() == "decimal(22,4)"


def test_dedup_is_idempotent(raw_lines):
    once = silver.dedup_lines(raw_lines)
    assert silver.dedup_lines(once).count() == once.count()
