"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from sparkcurate.operators.cluster import ClusterRules
from sparkcurate.plans import all_queries
from sparkcurate.plans import catalog_quality as quality
from sparkcurate.plans.curate import CurationRules, curate
from sparkcurate.session import build_session

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINE = [
    "b5_adaptive_minimum", "d1_qc_breakdown", "d2_length_summary", "e1_keep_first", "e2_protected_first_cap",
    "e8_short_ids", "e9_quota_sample", "e3_paralog_choice", "h5_assembly", "d8_assembly_counters",
    "e5_marker_outliers", "h7_concatenation", "d18_gap_trim", "c2_prefer_resolved", "c14_leaf_closure",
    "h8_node_labels", "e6_branch_outliers", "h9_rooting_scores", "a1_flat_files", "a12_newick_nodes",
    "h11_ingest_plan", "d15_summary_rows",
]


def curation(spark, folder):
    """The flagship with the fast hash."""
    rules = CurationRules(quality=quality.RULES, clusters=ClusterRules(molecule="text"))
    return curate(quality.base(spark, folder), rules).selected


def main() -> None:
    spark = build_session(
        "bench", f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS, "spark.driver.memory": "20g", "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{FOLDER}/documents.parquet").selectExpr("sum(n_chars)").collect()
    catalogue = all_queries()
    runs = {name: catalogue[name] for name in HEADLINE}
    runs["h10_curation_xxhash"] = curation
    times = {}
    for name, fn in runs.items():
        start = time.perf_counter()
        fn(spark, FOLDER).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {times[name]}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total time of the headline queries", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(FOLDER.rstrip("/")),
    }))


if __name__ == "__main__":
    main()
