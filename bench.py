"""Times the headline queries on the driver's tables and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from cairnsift.queries import catalogue
from cairnsift.queries.registry import QUERIES, Tables
from cairnsift.session import local_session

HEADLINE = (
    "s2_listing_index", "f12_token_acquisition", "j1_resolve", "j7_loose_members", "a15_content_groups", "a12_folder_stats", "t_status", "t_files", "a23_verdict",
    "p3_exclusion_reasons", "a21_unit_objects", "a22_download_groups", "w9_plan_order", "m1_disk_need", "g1_current_state", "w5_outage_streaks", "w6_retry_schedule", "w7_state_intervals",
    "a3_campaign_summary", "w2_chain_check", "j18_lineage", "a6_concordance", "a8_agreement", "r1_apply_groups", "i4_input_balance", "u5_i13_partition_check", "w10_encoding_choice",
    "store_objects", "d1_redaction_findings", "e1_accession_verdict", "g6_attempt_rates_stream",
)


def main() -> None:
    root = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, shuffle_partitions=int(cores) if cores.isdigit() else 8, app="bench")
    catalogue.load()
    names = sys.argv[1:] or list(HEADLINE)
    Tables(spark, root)["lineitem"].count()
    took: dict[str, float] = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name].build(Tables(spark, root)).write.format("noop").mode("overwrite").save()
        took[name] = round(time.perf_counter() - start, 3)
    folder = os.path.basename(root.rstrip("/"))
    print(json.dumps({"metric": "total wall time of the headline queries", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took,
                      "sf": float(folder[2:]) if folder.startswith("sf") else folder}))


if __name__ == "__main__":
    main()
