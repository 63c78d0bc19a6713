"""Headline-query benchmark: prints one JSON line with per-query wall seconds.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Each query runs to completion through a no-op sink (full execution, nothing collected).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from hazardflow.plans.catalog import REGISTRY  # noqa: E402
from hazardflow.session import build_session  # noqa: E402

HEADLINE = [
    "cohort_reorder",
    "km_reorder_by_priority",
    "km_lineqty_by_status",
    "logrank_pairwise_reorder",
    "cif_gap_by_type",
    "describe_reorder",
    "cox_fit_reorder",
    "cox_survival_reorder",
    "cox_median_reorder",
    "cindex_cox_reorder",
    "brier_cox_reorder",
    "auc_cox_reorder",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = build_session(app_name="hazardflow-bench")
    timings = {}
    for name in HEADLINE:
        t0 = time.time()
        REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.time() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": round(sum(timings.values()), 3),
                      "unit": "sec", "queries": timings, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
