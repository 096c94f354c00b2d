"""Time the headline queries. Prints one JSON line.

    BENCH_SF_DIR   folder of the test tables, default /root/testdata/sf0.1
    BENCH_CPUS     local cores, default 8
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = [
    "aml_round_amount_alerts", "aml_structuring_alerts", "aml_velocity_alerts", "rfm_raw", "rfm_segments",
    "product_holdings", "cross_sell_behaviour", "cross_sell", "pnl_net_interest", "pnl_fee_income",
    "pnl_account_counts", "v_monthly_pnl", "monthly_executive_summary", "churn_labels", "churn_txn_features",
    "churn_account_features", "ml_churn_features", "churn_train", "churn_scores", "dim_customers",
]


def main() -> None:
    from ledgerline.checks.registry import queries
    from ledgerline.session import local_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    registered = queries()
    # start the JVM's code paths (scan, join, shuffle) before timing
    registered["star_transactions"](spark, sf_dir).groupBy("customer_id").count().write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        registered[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline queries, total wall-clock",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
