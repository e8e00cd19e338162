"""Time the headline queries and print one JSON line.

Each query is run once to warm up and then timed over a full evaluation (every output row is
produced, none is collected). ``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose data and cores.
"""

from __future__ import annotations

import json
import os
import time

from tillcast.plans import catalog
from tillcast.session import local_session

HEADLINE = [
    "agg_by_category",
    "agg_store_item",
    "agg_std_store_week",
    "agg_corr_region",
    "agg_describe",
    "win_share_store",
    "win_share_store_week",
    "win_cumulative",
    "win_moving_avg_7",
    "win_yoy_store",
    "win_top_n_per_group",
    "top_items_sum",
    "join_calendar",
    "join_prices",
    "rsh_melt_days",
    "ts_daily_series",
    "ts_refill_after_clean",
    "ts_cv_expanding",
    "st_elasticity",
    "st_decompose",
    "ev_metrics",
    "fc_cell_mean",
    "fc_decomposable",
    "fc_tune",
    "fc_seasonal_ar",
    "run_forecasts",
]


def main() -> None:
    root = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, shuffle_partitions=int(cores) if cores.isdigit() else 8)
    seconds: dict[str, float] = {}
    for name in HEADLINE:
        for _ in range(2):
            start = time.perf_counter()
            catalog.run(name, spark, root).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
    result = {
        "metric": "total time of the headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(root.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
