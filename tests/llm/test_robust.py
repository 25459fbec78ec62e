"""Minimum-covariance-determinant estimates against plain numpy."""

from __future__ import annotations

import random

import numpy as np
import pandas as pd
import pytest

from tillroll.llm import robust_rules as rules

FLOOR = np.diag(np.square(rules.FLOOR))


def _by_force(x, starts=60):
    """Exact concentration steps from many random starts, reweighted."""
    rng, best = np.random.default_rng(2), None
    for _ in range(starts):
        inner = rng.choice(len(x), 12, replace=False)
        last = None
        while last is None or not np.array_equal(last, inner):
            last = inner
            centre, spread = x[inner].mean(0), rules.CONSISTENCY * np.cov(x[inner].T, bias=True) + FLOOR
            away = np.einsum("ij,jk,ik->i", x - centre, np.linalg.inv(spread), x - centre)
            inner = np.sort(np.argsort(away, kind="stable")[: int(rules.SHARE * len(x))])
        if best is None or np.linalg.slogdet(spread)[1] < best[0]:
            best = np.linalg.slogdet(spread)[1], away
    near = x[best[1] <= rules.REWEIGHT]
    return near.mean(0), rules.REWEIGHT_CONSISTENCY * np.cov(near.T, bias=True) + FLOOR


@pytest.mark.parametrize("stray", [0.0, 0.2])
def test_estimate_equals_plain_numpy(spark, stray):
    """Also with a fifth of strays on one side, which the start by medians
    alone leans towards."""
    rng = np.random.default_rng(3)
    mix = rng.normal(size=(5, 5))
    x = rng.normal(size=(900, 5)) @ mix
    n = int(stray * len(x))
    x[:n] = rng.normal(size=(n, 5)) * 0.3 + 14
    rows = [("g", *map(float, v)) for v in x] + [("h", *map(float, v)) for v in rng.normal(size=(40, 5))]
    vectors = spark.createDataFrame(rows, "group string, x0 double, x1 double, x2 double, x3 double, x4 double")
    got = {r["group"]: r for r in rules.estimates(vectors).collect()}
    centre, spread = _by_force(x)
    own = np.array(got["g"]["spread"]).reshape(5, 5)
    assert got["g"]["members"] == 900 and got["h"]["members"] == 40
    assert np.abs(np.linalg.slogdet(own)[1] - np.linalg.slogdet(spread)[1]) < 0.1
    distance = lambda c, s: np.einsum("ij,jk,ik->i", x - c, np.linalg.inv(s), x - c)
    ours, theirs = distance(np.array(got["g"]["centre"]), own), distance(centre, spread)
    assert np.abs(ours[n:] - theirs[n:]).max() < 0.05 * theirs[n:].max()
    assert (ours[:n] > rules.CUTOFF).all() and (theirs[:n] > rules.CUTOFF).all()
    assert (ours[n:] > rules.CUTOFF).sum() == (theirs[n:] > rules.CUTOFF).sum() == 0


def test_repeated_lines_are_an_outlier_where_none_repeat(spark):
    rnd = random.Random(8)
    word = lambda: "".join(rnd.choice("abcdefghijklmnoprstuvw") for _ in range(rnd.randint(3, 9)))
    line = lambda: " ".join(word() for _ in range(8))
    rows = [(k, "\n".join(line() for _ in range(24)), "en", "a") for k in range(300)]
    for k in range(300, 310):  # 11 of 24 lines are one short line again
        lines = [line() for _ in range(12)] + ["read more"] * 12
        rnd.shuffle(lines)
        rows.append((k, "\n".join(lines), "en", "a"))
    rows += [(k, "\n".join(line() for _ in range(20 + k % 9)), "de", f"s{k}") for k in range(400, 440)]  # groups of one
    rows += [(450, None, None, None), (451, "", "en", "a"), (452, "\n".join(f"{w}#$%&" for w in line().split() * 3), "fr", "z")]
    judged = {r["doc_id"]: r for r in rules.judged(spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")).collect()}
    sound = [k for k in judged if not judged[k]["base_failed"]]
    planted = [k for k in range(300, 310) if k in sound]
    assert planted and not any(judged[k]["kept"] for k in planted)
    assert all(judged[k]["kept"] for k in sound if k < 300 or 400 <= k < 440)
    assert not judged[450]["kept"] and judged[450]["distance"] is None


def test_small_groups_lean_without_a_step():
    pool = np.zeros(5), np.eye(5)
    sizes = [1, 10, 49, 50, 51, 500, 10**6]
    own = pd.DataFrame([(str(n), [1.0] * 5, (4 * np.eye(5)).ravel().tolist(), n) for n in sizes], columns=["group", "centre", "spread", "members"])
    out = rules.leaning(own, pool)
    first = np.array([c[0] for c in out["centre"]])
    assert (np.diff(first) > 0).all() and first[0] < 0.001 and first[-1] > 0.999 and abs(first[2] - first[4]) < 0.03
