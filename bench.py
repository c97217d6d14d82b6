"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR  test data folder (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 8)
BENCH_QUERIES comma-separated names, to time others than the headline ones
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tarn.plans.bindings import QUERIES  # noqa: E402
from tarn.session import build_session  # noqa: E402

HEADLINE = [
    "src1_directory_scan",
    "src4_response_unwrap",
    "snk1_bronze_append",
    "snk7_keyed_upsert",
    "val3_typed_rules",
    "val4_ingest_summary",
    "val7_deduplicate",
    "join1_dimension_lookup",
    "join4_rate_by_day",
    "join4_asof_exact",
    "join5_hourly_cost",
    "silver2_benchmark_efficiency",
    "silver3_instance_pricing",
    "gold1_ai_inference_cost",
    "agg2_latest_per_key",
    "agg3_weighted_mean",
    "agg6_metric",
    "agg13_quantiles_whole_table",
    "agg_sessions",
    "win4_event_study",
    "win5_below_quartile",
    "win10_spikes",
    "dq5_freshness",
    "dq8_check_suite",
    "txt1_detect_documents",
    "txt2_anonymise",
    "txt3_chunks",
    "vec1_top_k_cosine",
    "sql3_group_distinct",
    "sql14_subqueries",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    shared = tempfile.mkdtemp(prefix="run-")
    spark = build_session(
        f"local[{cpus}]",
        app="bench",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "12g",
            "spark.sql.warehouse.dir": f"{shared}/warehouse",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    # start the JVM's hot paths and the Python workers before the clock runs
    QUERIES["win5_below_quartile"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - started, 3)
    total = round(sum(times.values()), 3)
    print(
        json.dumps(
            {"metric": "headline_total", "value": total, "unit": "sec", "queries": times, "sf": Path(sf_dir).name}
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
