"""Time the headline queries and print one JSON line.

Landing the sales lines, the fact table and the lake is timed apart; the reports read them from there.  Everything else
starts from the given Parquet files.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from ledgerloom.plans import catalogue, notice_inputs, retail  # noqa: E402
from ledgerloom.session import local_session, remove_scratch  # noqa: E402

HEADLINE = [
    "dedup_lines", "scd2_fact", "monthly_revenue", "reconcile", "category_revenue", "dash_kpi", "dash_top_products",
    "price_as_of_late", "void_policy", "line_type_audit", "partition_pruned_scan", "full_scan",
    "profile_lengths", "clean_text", "shingles_clean", "minhash_signature", "lsh_bands", "lsh_candidates_capped",
    "verify_pairs", "cards", "threshold_sweep", "roc_auc", "banding_grid", "work_distribution",
]

LANDINGS = {
    "land_lines": retail.lines, "land_fact": retail.fact, "land_lake": retail.landed,
    "land_signed": notice_inputs.signed_notices, "land_scored": lambda spark, sf_dir: notice_inputs.scored(spark, sf_dir, raw=True),
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session("bench", os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()
    wanted = sys.argv[1:] or HEADLINE
    seconds = {}
    for name, land in LANDINGS.items():  # reports read what is landed once
        started = time.perf_counter()
        land(spark, sf_dir)
        seconds[name] = round(time.perf_counter() - started, 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    for name in wanted:
        started = time.perf_counter()
        catalogue.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    remove_scratch(spark)
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": float(scale.group(1)) if scale else None,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
