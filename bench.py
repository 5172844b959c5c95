"""Seconds per headline query. Prints one JSON line.

Each query runs to the end without returning rows to the driver; the better of two runs
counts, so that compilation of the first run is left out.
"""

from __future__ import annotations

import json
import os
import time

from tidemark.queries.registry import QUERIES
from tidemark.session import local_session

HEADLINE = [
    "flagship_over50_counts",
    "amount_metrics",
    "merchant_fraud_rate",
    "merchant_rate_listing",
    "distinct_merchants_30d",
    "last10_merchants_14d",
    "continuous_count_1h",
    "sliding_1h_by_5m",
    "asof_plain",
    "asof_card_issuer",
    "service_training",
    "service_variant",
    "on_demand_native",
    "on_demand_pandas",
    "on_demand_python",
    "from_source_parity",
    "latest_lookup",
    "stream_tiles_5m",
    "ingest_explode",
    "customer_spend_windows",
]


def seconds(spark, folder: str, name: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = local_session(cores)
    seconds(spark, folder, "flagship_over50_counts")
    taken = {n: round(min(seconds(spark, folder, n) for _ in range(2)), 3) for n in names}
    line = {
        "metric": "headline_queries_total",
        "value": round(sum(taken.values()), 3),
        "unit": "sec",
        "queries": taken,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
