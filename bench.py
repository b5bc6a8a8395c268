"""Headline queries on local[$BENCH_CPUS] over $BENCH_SF_DIR; prints one JSON line.

Each query runs to completion into a sink that discards rows, so the time is the query's
and not the cost of moving its result to Python. One warm-up run loads the JVM.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

HEADLINE = [
    "src1_scan", "src2_token_ranges", "src5_bulk_write", "src7_changes", "src8_dump_json",
    "q6_tuple_slice", "p9_static_rows", "p10_first_row",
    "a3_sum_wrap", "a11_group_prefix", "a12_group_star", "l2_per_partition_limit", "l6_latest", "l8_top_partitions",
    "f20_token_xxhash64", "f20_token_murmur3",
    "m1_reconcile_lines", "m1_reconcile_group", "m3_live_rows", "m4_range_deletes", "m8_compact", "m15_verify",
    "w1_upsert", "w9_counters", "w10_if_value",
    "v1_view_rows", "v3_delta", "d1_diff", "d2_digest", "d4_repair",
    "x5_filters", "x6_search_terms", "x8_term_index", "src3_word_count",
    "n1_histogram", "n2_table_histograms", "u3_fold_with_merge",
    "t2_latest_state", "t5_counters",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
    from cellspark.plans import QUERIES
    from cellspark.session import local_session

    spark = local_session(cpus)
    names = sys.argv[1:] or HEADLINE
    QUERIES["a3_sum_wrap"](spark, folder).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    sf = re.search(r"sf([0-9.]+)", folder)
    print(json.dumps({
        "metric": "total time of headline queries", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": float(sf[1]) if sf else None}))
    spark.stop()


if __name__ == "__main__":
    main()
