"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from merkato.plans.catalog import QUERIES  # noqa: E402
from merkato.session import build_session  # noqa: E402
from merkato.sources.tpch import TpchWarehouse  # noqa: E402

HEADLINE = [
    "J1_star_current", "J2_star_as_recorded", "A1_market_month_metrics", "W1_previous_period", "P7_growth_rate",
    "A2_static_features", "A6_cluster_summary", "D7_recommendations", "Q_full_report", "S8_segment_upsert",
    "A19_quantiles_of_rows", "L1_versioned_merge", "M4_hybrid_vector", "M6_dbscan_wide", "M7_silhouette",
    "M13_principal_embedding",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cores}]", **{
        "spark.sql.shuffle.partitions": cores, "spark.ui.enabled": "false", "spark.driver.memory": "12g",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}

    def timed(name: str, work) -> None:
        start = time.time()
        work()
        seconds[name] = round(time.time() - start, 3)

    spark.range(1000).selectExpr("sum(id)").collect()
    timed("load_warehouse", lambda: TpchWarehouse.of(spark, folder).load())
    for name in HEADLINE:
        timed(name, lambda: QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save())
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"), "cores": int(cores),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
