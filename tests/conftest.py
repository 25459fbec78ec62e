from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tillroll.session import checkpoint_dir, local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"

# Hand-made raw CSV: every edge case of the cleaning and classification
# rules, one line each (plus an exact duplicate pair and a pair that is
# equal only after trim/upper).
RAW_CSV = """Invoice,StockCode,Description,Quantity,InvoiceDate,Price,Customer ID,Country
489434,85048,"15CM ""BALL"", LIGHTS",12,2009-12-01 07:45:00,6.95,13085.0,United Kingdom
489434,85048,"15CM ""BALL"", LIGHTS",12,2009-12-01 07:45:00,6.95,13085.0,United Kingdom
489435,85123a,CREAM HEART ,6,2009-12-01 07:46:00,2.55,13085.0, United Kingdom
489435, 85123A,CREAM HEART ,6,2009-12-01 07:46:00,2.55,13085.0, United Kingdom
C489449,22087,PAPER BUNTING,-12,2009-12-01 10:33:00,2.95,16321.0,Australia
C489450,22088,PAPER BUNTING RED,5,2009-12-01 10:34:00,1.00,16321.0,Australia
489436,21232,STRAWBERRY MUG,-3,2009-12-01 09:06:00,1.25,,United Kingdom
489437,22111,   ,4,2009-12-01 09:08:00,4.25,13078.0,France
489438,22112,ZERO PRICE,4,2009-12-01 09:08:00,0.00,13078.0,France
489439,22113,TINY PRICE,1000,2009-12-01 09:08:00,0.001,13078.0,France
489440,22114,NEGATIVE PRICE,1,2009-12-01 09:08:00,-11062.06,,United Kingdom
489441,22115,ZERO QTY,0,2009-12-01 09:08:00,1.50,13078.0,France
489442,22116,NULL QTY,,2009-12-01 09:08:00,1.50,13078.0,France
489443,POST,POSTAGE,1,2009-12-01 09:08:00,18.00,12682.0,France
489444,BANK CHARGES,Bank Charges,1,2009-12-01 09:08:00,15.00,12682.0,France
489445,GIFT_0001_80,GIFT VOUCHER,1,2009-12-01 09:08:00,80.00,12682.0,France
489446,ADJUST,Adjustment,1,2009-12-01 09:08:00,100.00,12682.0,France
489447,22117,BAD DATE,2,not a date,3.00,12682.0,France
"""


@pytest.fixture(scope="session")
def spark():
    s = local_session(cores=4, shuffle_partitions=8)
    checkpoint_dir(s)  # keeps spark.checkpoint.dir if set, else a temporary folder
    yield s


@pytest.fixture(scope="session")
def raw_csv_path():
    d = tempfile.mkdtemp(prefix="tillroll-test-raw-")
    path = os.path.join(d, "lines.csv")
    with open(path, "w") as f:
        f.write(RAW_CSV)
    return path


@pytest.fixture(scope="session")
def raw_lines(spark, raw_csv_path):
    from tillroll.sources.raw import read_raw

    return read_raw(spark, raw_csv_path)


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="tillroll-test-")
