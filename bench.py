"""Time the headline queries at one scale factor and print one JSON line.

The inputs are first stored the way a deployment keeps them: core tables partitioned by date, landing
tables as files.  Each query then runs ``BENCH_RUNS`` times over the stored inputs, all its rows going to
a sink that discards them, and its best time counts.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from pyspark.sql import SparkSession  # noqa: E402

from fixtures import Inputs  # noqa: E402
from fixtures.registry import QUERIES  # noqa: E402
from fleetgauge.session import SETTINGS  # noqa: E402
from fleetgauge.sources import tables  # noqa: E402

HEADLINE = [
    "v1_latest_metrics", "v2_instance_health_summary", "v4_top_problem_queries", "v10_metric_latest",
    "v11_metric_trend", "v12_backup_compliance_current", "v13_collector_health", "v14_server_health_current",
    "v15_performance_health_current", "v18_data_freshness_current", "v19_server_health_scorecard",
    "v20_wait_pressure_current", "v21_agent_health_current", "c3_unit_and_sub_instance", "c5_cpu_metrics",
    "c6_session_summary", "c8_sessions_by_host", "c13_blocking_evidence", "c15_wait_metrics", "c19_file_evidence",
    "c21_request_summary", "c22_expensive_requests", "c24_requests_by_host", "c27_repeated_requests",
    "c36_without_monitor_statements", "c43_compliance_summary", "c47_compliance_evidence", "c51_outcome_summary",
    "c53_failed_runs", "c60_alert_summary", "c61_configuration_issues", "i1_register", "i5_run_lifecycle",
    "i8_collection_failures", "m3_purge_summary",
]
STORED = {"metric_snapshot": "MetricSnapshot", "metric_text_snapshot": "MetricTextSnapshot"}
LANDED = [
    "monitored_instances", "registrations", "run_events", "capture_roster", "landing_roster", "raw_counters",
    "raw_ring_buffer", "raw_sessions", "raw_requests", "raw_waits", "raw_file_io", "raw_io_databases",
    "raw_query_stats", "raw_query_text", "raw_databases", "raw_backupset", "raw_backupmedia", "raw_jobs",
    "raw_job_history", "raw_job_activity", "raw_agent_sessions", "raw_alerts", "raw_notifications", "raw_operators",
]


def store(inputs: Inputs) -> Inputs:
    """Write the derived inputs once and read them back from storage."""
    spark, root = inputs.spark, tempfile.mkdtemp(prefix="bench-")
    stored = Inputs(spark, inputs.sf_dir)
    for name, table in STORED.items():
        tables.append(getattr(inputs, name), f"{root}/{name}", "capture_date")
        stored._frames[name] = tables.read_table(spark, f"{root}/{name}", table)
    tables.write_runs(inputs.collection_run_history, f"{root}/runs")
    stored._frames["collection_run_history"] = tables.read_table(
        spark, f"{root}/runs", "CollectionRunHistory"
    ).drop("started_date")
    for name in LANDED:
        # Spread over the cores, as landed snapshots come in many files.
        frame = getattr(inputs, name).repartition(spark.sparkContext.defaultParallelism)
        frame.write.parquet(f"{root}/{name}")
        stored._frames[name] = spark.read.schema(frame.schema).parquet(f"{root}/{name}")
    return stored


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    repeats = int(os.environ.get("BENCH_RUNS", "3"))
    builder = SparkSession.builder.master(f"local[{cores}]").appName("bench")
    settings = {**SETTINGS, "spark.sql.shuffle.partitions": cores, "spark.ui.enabled": "false",
                "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "12g"}
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")

    started = time.perf_counter()
    inputs = store(Inputs(spark, sf_dir))
    setup = time.perf_counter() - started
    timings = {}
    for name in HEADLINE:
        runs = []
        for _ in range(repeats):
            started = time.perf_counter()
            QUERIES[name](inputs).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - started)
        timings[name] = round(min(runs), 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(timings.values()), 3), "unit": "sec",
        "queries": timings, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "setup_sec": round(setup, 3), "cores": int(cores),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
