"""Shuffle / broadcast report for every registered retail query.

Usage: python scripts/plan_report.py [sf_dir] > PLANS.md

Runs each query with Spark's event log on and lists, from the final
adaptive plan of every job that it ran (the writes of intermediate tables
and layers included): hash shuffles and their keys, range and
single-partition shuffles and what feeds them, broadcasts, reused
exchanges, sort-based aggregates, top-k and window operators. A
single-partition shuffle that is not fed by a partial aggregate is flagged.
"""

from __future__ import annotations

import glob
import json
import os
import re
import sys
import tempfile
from collections import Counter

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tillroll.session import local_session  # noqa: E402


def _clean(s: str) -> str:
    s = re.sub(r"#\d+L?", "", s)
    s = re.sub(r", \[plan_id=\d+\]", "", s)
    return re.sub(r"^[\s:+|-]*(\*\(\d+\) )?", "", s)


def final_plan(lines: list[str]) -> list[str]:
    if any("== Final Plan ==" in ln for ln in lines):
        out, on = [], False
        for ln in lines:
            if "== Final Plan ==" in ln:
                on = True
                continue
            if "== Initial Plan ==" in ln:
                on = False
            if on:
                out.append(ln)
        return out
    return lines


def logged_plans(folder: str) -> dict[str, list[list[str]]]:
    """Query name -> final plans of its jobs, from the event log."""
    names, plans = {}, {}
    for path in sorted(glob.glob(f"{folder}/*")):
        with open(path, errors="replace") as f:
            for line in f:
                if "physicalPlanDescription" not in line:
                    continue
                event = json.loads(line)
                if event["Event"].endswith("SQLExecutionStart"):
                    names[event["executionId"]] = event["description"]
                plans[event["executionId"]] = event["physicalPlanDescription"].splitlines()
    out: dict[str, list[list[str]]] = {}
    for k in sorted(plans):
        out.setdefault(names.get(k, ""), []).append(final_plan(plans[k]))
    return out


def summarize(lines: list[str]) -> dict:
    hashed, single, flags = [], 0, []
    counts = Counter()
    for i, ln in enumerate(lines):
        c = _clean(ln)
        if c.startswith("Exchange hashpartitioning("):
            keys = c[len("Exchange hashpartitioning("):].split("), ")[0]
            keys = ", ".join(k.strip() for k in keys.split(",")[:-1])
            kind = "REBALANCE" if "REBALANCE" in c else ""
            hashed.append(f"{keys}{' (rebalance)' if kind else ''}")
        elif c.startswith("Exchange SinglePartition"):
            single += 1
            child = next((_clean(x) for x in lines[i + 1:] if _clean(x)), "")
            if not (child.startswith(("HashAggregate", "SortAggregate")) and "partial_" in child) \
                    and "TakeOrdered" not in child:
                flags.append(f"UNEXPECTED single partition fed by: {child[:70]}")
        elif c.startswith("Exchange rangepartitioning"):
            counts["RangeShuffle"] += 1
        for word in ("BroadcastExchange", "ReusedExchange", "SortAggregate", "TakeOrderedAndProject",
                     "Window ", "Expand"):
            if c.startswith(word):
                counts[word.strip()] += 1
    return {"hash": hashed, "single": single, "counts": counts, "flags": flags}


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    folder = tempfile.mkdtemp(prefix="tillroll-plans-")
    spark = SparkSession.builder.config(map={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{folder}", "spark.eventLog.compress": "false",
        "spark.eventLog.rolling.enabled": "false", "spark.sql.ui.explainMode": "simple", "spark.sql.maxPlanStringLength": "1000000",
        "spark.sql.maxMetadataStringLength": "2000", "spark.sql.debug.maxToStringFields": "200", "spark.ui.enabled": "false",
        "spark.master": "local[8]",
    }).getOrCreate()
    spark = local_session(cores=8, shuffle_partitions=16)
    from tillroll.plans import catalog

    queries = catalog.queries()
    for name, fn in queries.items():
        spark.sparkContext.setJobDescription(name)
        fn(spark, sf_dir).collect()
        print(name, file=sys.stderr, flush=True)
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(60_000)
    spark.stop()
    logged = logged_plans(folder)

    print("# Plans of the registered retail queries\n")
    print(f"Final AQE plans of every job at `{sf_dir}`, `local[8]`, generated by "
          "`scripts/plan_report.py`. Every query starts from the test-table view "
          "(four joins, broadcast here because the test dimensions are small) and most "
          "from the full-row dedup shuffle. Jobs without a shuffle are only counted.\n")
    print("The expected single-partition shuffles are the final merge of a global aggregate, fed "
          "by a partial aggregate (one row per task). Anything else is marked UNEXPECTED. A rank is "
          "a `RangeShuffle` (and a sort) in the job that writes its input; the shuffle by `range` after it "
          "carries one row per range.\n")
    print("| Query | Jobs | Hash shuffles (keys), job by job | Single-partition | Other |")
    print("|---|---:|---|---:|---|")
    for name in queries:
        jobs = [summarize(p) for p in logged.get(name, [])]
        counts = sum((j["counts"] for j in jobs), Counter())
        other = ", ".join(f"{k} {v}" for k, v in sorted(counts.items()))
        hashed = "<br>".join(dict.fromkeys("; ".join(f"`{h}`" for h in j["hash"]) for j in jobs if j["hash"])) or "—"
        flags = list(dict.fromkeys(f for j in jobs for f in j["flags"]))
        flag = ("<br>" + "; ".join(flags)) if flags else ""
        print(f"| `{name}` | {len(jobs)} | {hashed} | {sum(j['single'] for j in jobs)} | {other}{flag} |", flush=True)


if __name__ == "__main__":
    main()
