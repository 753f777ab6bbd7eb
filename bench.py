"""Time the headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
"""

from __future__ import annotations

import json
import os
import time

from tidegate import catalog
from tidegate.session import local_session

HEADLINE = (
    "c2_unique_key_check", "b8_column_registry", "g14_outlier_scan", "b16_content_hash",
    "d5_account_candidates", "d7_shared_account_user_bands", "d9_prior_event_velocity", "d10_prior_min_gap",
    "d15_latest_asof_join", "d18_star_assembly", "e11_rule_validation", "e14_backtest_report",
    "e15_monthly_rule_report", "e16_band_by_month", "f1_roc_auc", "f12_depth_metrics", "f13_band_report",
    "h1_edge_extraction", "h8_near_flagged", "h9_component_census", "h11_user_projection", "h18_leakfree_replay",
    "i1_weight_of_evidence", "i10_subgroup_search", "j1_span_pairing", "j3_uncovered_time",
)


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    queries = catalog.queries()
    spark.read.parquet(f"{sf}/orders.parquet").groupBy("o_orderstatus").count().collect()  # start the JVM paths
    times = {}
    for name in HEADLINE:
        began = time.perf_counter()
        queries[name](spark, sf).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - began, 3)
        spark.catalog.clearCache()  # queries do not share frames
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
