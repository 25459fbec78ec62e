"""Spark results against a brute-force Python model of the rules, on
random raw lines (random padding, case, nulls, cancel prefixes, bad
codes, duplicates)."""
from __future__ import annotations

import datetime as dt
import random
import re
from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal

from tillroll.operators import marts, silver
from tillroll.schemas import RAW_SCHEMA

CODES = ["85123a", "85123A", " 22087", "POST", "BANK CHARGES", "GIFT_0001_80", "ADJUST",
         "DOT", "21232 ", "m", None]
COUNTRIES = ["United Kingdom", " United Kingdom", "France", "EIRE ", None]


def _random_lines(seed: int, n: int):
    rnd = random.Random(seed)
    rows = []
    for _ in range(n):
        inv = rnd.choice(["", "C", "c", " C"]) + str(rnd.randint(500000, 500060))
        rows.append((
            None if rnd.random() < 0.03 else inv,
            rnd.choice(CODES),
            rnd.choice(["HEART", " HEART ", "   ", None, "MUG"]),
            None if rnd.random() < 0.03 else rnd.randint(-12, 24),
            None if rnd.random() < 0.02 else dt.datetime(2010, rnd.randint(1, 12), rnd.randint(1, 28), 9),
            rnd.choice([None, Decimal("0"), Decimal("-1.5"), Decimal("0.001"), Decimal("2.55"),
                        Decimal("6.95")]),
            rnd.choice(["17850.0", "13085", None, "12583.0"]),
            rnd.choice(COUNTRIES),
        ))
    rows += rnd.sample(rows, n // 10)  # exact duplicates
    return rows


def _strip(s):
    return None if s is None else s.strip(" ")


def model_silver(rows):
    out = []
    for inv, code, desc, qty, ts, price, cust, country in set(rows):
        inv_c = _strip(inv)
        code_c = None if code is None else code.strip(" ").upper()
        cust_c = None if cust is None else re.sub(r"\.0$", "", cust)
        if price is None or price <= 0 or code_c is None or not re.match(r"^[a-zA-Z0-9]{5,}", code_c):
            continue
        ttype = "Cancelled" if inv_c is not None and inv_c.startswith("C") else "Normal"
        rev = None if qty is None else Decimal(qty) * price
        out.append(dict(Invoice=inv_c, StockCode=code_c, Description=_strip(desc), Quantity=qty,
                        InvoiceDate=ts, Price=price, **{"Customer ID": cust_c}, Country=_strip(country),
                        TransactionType=ttype, IsReturn=qty is not None and qty < 0, Revenue=rev))
    return out


def _metrics(r):
    normal, qty, rev = r["TransactionType"] == "Normal", r["Quantity"], r["Revenue"]
    sale = normal and qty is not None and qty > 0
    ret = normal and qty is not None and qty < 0
    return {
        "GrossSales": rev if sale else Decimal(0),
        "ReturnAmount": abs(rev) if ret else Decimal(0),
        "CancelledAmount": (abs(rev) if rev is not None else None) if not normal else Decimal(0),
        "UnitsSold": qty if sale else 0,
        "ReturnUnits": abs(qty) if ret else 0,
    }


def _sum(vals):
    vals = [v for v in vals if v is not None]
    return sum(vals, Decimal(0)) if vals else None


def _money(x):
    return None if x is None else x.quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)


def model_country(lines):
    groups = defaultdict(list)
    for r in lines:
        groups[r["Country"]].append(r)
    out = {}
    for country, rs in groups.items():
        ms = [_metrics(r) for r in rs]
        g, ra, ca = (_sum(m[k] for m in ms) for k in ("GrossSales", "ReturnAmount", "CancelledAmount"))
        net = None if None in (g, ra, ca) else g - ra - ca
        out[country] = dict(
            Orders=len({r["Invoice"] for r in rs if r["Invoice"] is not None}),
            Customers=len({r["Customer ID"] for r in rs if r["Customer ID"] is not None}),
            UnitsSold=sum(m["UnitsSold"] for m in ms), ReturnUnits=sum(m["ReturnUnits"] for m in ms),
            GrossSales=_money(g), ReturnAmount=_money(ra), CancelledAmount=_money(ca),
            NetRevenue=_money(net), _net=net,
        )
    order = sorted(out, key=lambda c: (out[c]["_net"] is None, -(out[c]["_net"] or 0),
                                       c is not None, c or ""))
    for rank, c in enumerate(order, 1):
        out[c]["CountryRank"] = rank
        del out[c]["_net"]
    return out


def model_product_ranks(lines):
    """RevenueRank: NetRevenue high to low (null last), then StockCode."""
    groups = defaultdict(list)
    for r in lines:
        groups[r["StockCode"]].append(_metrics(r))
    net = {}
    for code, ms in groups.items():
        g, ra, ca = (_sum(m[k] for m in ms) for k in ("GrossSales", "ReturnAmount", "CancelledAmount"))
        net[code] = None if None in (g, ra, ca) else g - ra - ca
    order = sorted(net, key=lambda c: (net[c] is None, -(net[c] or 0), c))
    return {c: i for i, c in enumerate(order, 1)}


def _rows(df):
    return [r.asDict() for r in df.collect()]


def test_silver_and_marts_match_model(spark):
    for seed in (1, 2, 3):
        rows = _random_lines(seed, 400)
        raw = spark.createDataFrame(rows, RAW_SCHEMA)
        s = silver.silver_lines(raw)

        def canon(r):
            def norm(v):
                return str(v.quantize(Decimal("0.0001"))) if isinstance(v, Decimal) else str(v)
            return tuple(sorted((k, norm(v)) for k, v in r.items()))

        want = model_silver(rows)
        got = _rows(s)
        assert sorted(map(canon, got)) == sorted(map(canon, want)), seed

        country = {r["Country"]: r for r in _rows(marts.country_sales(s))}
        for c, exp in model_country(want).items():
            for k, v in exp.items():
                assert country[c][k] == v, (seed, c, k, country[c][k], v)

        ranks = {r["StockCode"]: r["RevenueRank"] for r in _rows(marts.product_performance(s))}
        assert ranks == model_product_ranks(want), seed
