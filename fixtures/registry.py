"""The registered queries: each operator of the library on the derived test inputs."""

from __future__ import annotations

import tempfile
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fixtures import EVENTS_AS_OF, ORDERS_AS_OF, Inputs
from fleetgauge.functions import text
from fleetgauge.functions.shaping import SNAPSHOT, to_metrics
from fleetgauge.operators import (
    agent_alerts, agent_jobs, backups, blocking, connections, counters, file_io, inventory, query_stats, requests,
    retention, runs, waits,
)
from fleetgauge.params import (
    AlertParams, BackupParams, JobParams, QueryStatsParams, RetentionParams,
)
from fleetgauge.plans import cycle, latest_state
from fleetgauge.plans import reporting_views as rv
from fleetgauge.plans import repository_views as pv
from fleetgauge.sources import tables

YEAR_HOURS = 24 * 365
QUERY_PARAMS = QueryStatsParams(lookback_minutes=YEAR_HOURS * 60, min_executions=2)
BACKUP_PARAMS = BackupParams(full_hours=YEAR_HOURS, diff_hours=YEAR_HOURS, log_hours=24 * 30)
JOB_PARAMS = JobParams(lookback_hours=YEAR_HOURS)
ALERT_PARAMS = AlertParams(lookback_hours=YEAR_HOURS)
PURGE_AS_OF = datetime(2024, 1, 29, 12)
PURGE_PARAMS = RetentionParams(metric_days=14, text_days=17, history_days=30)

QUERIES: dict[str, Callable[[Inputs], DataFrame]] = {}


def query(name: str):
    def register(build: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
        QUERIES[name] = build
        return build

    return register


def scratch(i: Inputs, purpose: str) -> str:
    """A new shared folder; a local session that names none gets a temporary one."""
    if not i.spark.conf.get("spark.checkpoint.dir", None) and i.spark.sparkContext.master.startswith("local["):
        return f"{tempfile.mkdtemp(prefix='scratch-')}/{purpose}"
    return tables.scratch_path(i.spark, purpose)


def put(**queries: Callable[[Inputs], DataFrame]) -> None:
    QUERIES.update(queries)


# --- Sources and sinks ---------------------------------------------------------------------------


@query("s3_landing_scan")
def _landing_scan(i: Inputs) -> DataFrame:
    path = scratch(i, "landing")
    i.raw_waits.write.parquet(path)
    return tables.read_landing(i.spark, path, "raw_waits")


@query("s3_quarantined_rows")
def _quarantined(i: Inputs) -> DataFrame:
    """JSON lines with values of another type, broken lines and lines without an instance among them."""
    path, line = scratch(i, "lines"), F.to_json(F.struct(*i.raw_waits.columns))
    tasks = F.col("waiting_tasks_count")
    spoiled = (
        F.when(tasks % 5 == 0, F.regexp_replace(line, '"wait_time_ms":-?[0-9]+', '"wait_time_ms":"n/a"'))
        .when(tasks % 7 == 0, F.regexp_replace(line, ".$", "")).when(tasks % 11 == 0, F.regexp_replace(line, "InstanceId", "Id"))
        .otherwise(line))
    i.raw_waits.select(spoiled.alias("value")).write.text(path)
    sound, bad = tables.read_checked(i.spark, path, "raw_waits", "json")
    kept = sound.groupBy("InstanceId").agg(F.count(F.lit(1)).alias("RowCount"))
    return kept.select("InstanceId", F.lit("sound").alias("Outcome"), "RowCount").unionByName(
        bad.groupBy("InstanceId", F.col("Reason").alias("Outcome")).agg(F.count(F.lit(1)).alias("RowCount")))


@query("s4_metric_sink")
def _metric_sink(i: Inputs) -> DataFrame:
    path = scratch(i, "metrics")
    tables.write_metrics(_wait_metrics(i), path)
    return tables.read_table(i.spark, path, "MetricSnapshot").drop("MetricSnapshotId")


@query("s5_evidence_sink")
def _evidence_sink(i: Inputs) -> DataFrame:
    path = scratch(i, "evidence")
    tables.write_evidence(file_io.file_evidence(_busy_files(i)), path)
    return tables.read_table(i.spark, path, "MetricTextSnapshot").drop("MetricTextSnapshotId")


@query("s7_evidence_rendering")
def _rendering(i: Inputs) -> DataFrame:
    body = text.details([
        ("Login", F.col("login_name"), text.UNKNOWN), ("Host", F.col("host_name"), text.UNKNOWN),
        ("Program", F.col("program_name"), text.NONE), ("Database", F.col("database_name")),
    ])
    return i.raw_sessions.select(*SNAPSHOT, "session_id", body.alias("Details"))


@query("s8_fan_out")
def _fan_out(i: Inputs) -> DataFrame:
    metrics, evidence = scratch(i, "fan-metrics"), scratch(i, "fan-evidence")
    collected = cycle.collect_requests(i.raw_requests, i.raw_sessions, i.capture_roster)
    collected.write(metrics, evidence, "fan-out")
    stored = tables.read_table(i.spark, metrics, "MetricSnapshot").select(F.col("ObjectName").alias("Output"))
    texts = tables.read_table(i.spark, evidence, "MetricTextSnapshot").select(F.col("DetailType").alias("Output"))
    return stored.union(texts).groupBy("Output").agg(F.count(F.lit(1)).alias("RowCount"))


put(
    s1_enabled_instances=lambda i: inventory.enabled_instances(i.monitored_instances),
    s2_enabled_profiles=lambda i: inventory.enabled_profiles(i.monitored_instances),
    s6_wide_to_long=lambda i: to_metrics(
        i.raw_waits, [("waiting_tasks_count", "count"), ("wait_time_ms", "ms"), ("signal_wait_time_ms", "ms"),
                      ("max_wait_time_ms", "ms")], collector="", category="", object_name="",
    ).select(*SNAPSHOT, "CounterName", "MetricValue", "Unit"),
)

# --- Inventory and runs --------------------------------------------------------------------------

_HISTORY = "CollectionRunHistory"


def _core(i: Inputs) -> dict[str, DataFrame]:
    return {"MetricSnapshot": i.metric_snapshot, "MetricTextSnapshot": i.metric_text_snapshot,
            _HISTORY: i.collection_run_history}


def _isolated(i: Inputs) -> tuple[DataFrame, DataFrame]:
    return runs.isolate_failures(i.raw_counters, {"counter value is missing": "cntr_value IS NOT NULL"})


put(
    i1_register=lambda i: inventory.register(i.monitored_instances, i.registrations, EVENTS_AS_OF),
    i1_seed=lambda i: inventory.seed(i.monitored_instances, i.registrations, EVENTS_AS_OF),
    i2_set_state=lambda i: inventory.set_state(i.monitored_instances, i.state_changes, EVENTS_AS_OF),
    i2_unknown_names=lambda i: inventory.unknown_names(i.monitored_instances, i.registrations),
    i3_list_instances=lambda i: inventory.list_instances(i.monitored_instances, "Disabled"),
    i4_additive_column=lambda i: inventory.with_default_column(
        i.monitored_instances.select("InstanceId", "InstanceName", "EnvironmentName"), "ComplianceProfile", "V1_SIMPLE"),
    i5_run_lifecycle=lambda i: runs.fold_runs(i.run_events),
    i6_failure_isolation=lambda i: _isolated(i)[1],
    i6_sound_rows=lambda i: _isolated(i)[0],
    i7_cycle_summary=lambda i: runs.cycle_summary(i.collection_run_history, datetime(2001, 8, 1), ORDERS_AS_OF),
    i8_collection_failures=lambda i: runs.collection_failures(
        i.collection_run_history, i.monitored_instances, ORDERS_AS_OF),
    i8_stale_failures=lambda i: runs.collection_failures(
        i.collection_run_history, i.monitored_instances, ORDERS_AS_OF, collector="Collector3", stale_only=True),
    i9_recent_history=lambda i: runs.recent_history(i.collection_run_history, i.monitored_instances),
    i10_row_counts=lambda i: runs.row_counts({**_core(i), "MonitoredInstances": i.monitored_instances}),
    m1_shortest_retention=lambda i: retention.retained(
        i.collection_run_history, _HISTORY, datetime(2001, 8, 31, 12), RetentionParams(7, 7, 30)),
    m2_retained_metrics=lambda i: retention.retained(i.metric_snapshot, "MetricSnapshot", PURGE_AS_OF, PURGE_PARAMS),
    m3_purge_summary=lambda i: retention.purge_summary(_core(i), PURGE_AS_OF, PURGE_PARAMS),
)


@query("i1_stored_register")
def _stored_register(i: Inputs) -> DataFrame:
    path = scratch(i, "inventory")
    tables.open_table(i.spark, path, "MonitoredInstances").append(i.monitored_instances)
    inventory.store_registration(i.spark, path, i.registrations, EVENTS_AS_OF)
    return inventory.stored_instances(i.spark, path)


@query("i2_stored_state")
def _stored_state(i: Inputs) -> DataFrame:
    path = scratch(i, "inventory")
    tables.open_table(i.spark, path, "MonitoredInstances").append(i.monitored_instances)
    inventory.store_state(i.spark, path, i.state_changes, EVENTS_AS_OF)
    return inventory.stored_instances(i.spark, path)


def _stored_runs(i: Inputs) -> str:
    """Runs folded from events that came in two portions, finishes of half the runs in the second."""
    events, path = scratch(i, "events"), scratch(i, "runs")
    first = (F.col("EventType") == "start") | (F.col("CollectionRunId") % 2 == 0)
    for portion in (i.run_events.filter(first), i.run_events.filter(~first)):
        tables.write_run_events(portion, events)
        runs.refresh_runs(i.spark, events, path)
    return path


put(i5_incremental_runs=lambda i: runs.read_runs(i.spark, _stored_runs(i)))


def _stored_history(i: Inputs) -> str:
    path = scratch(i, "history")
    tables.open_table(i.spark, path, _HISTORY).append(i.collection_run_history.withColumn(
        "started_date", F.when(F.col("FinishedAt").isNotNull(), F.col("StartedAt").cast("date"))))
    return path


put(
    i8_stored_failures=lambda i: runs.stored_failures(i.spark, _stored_history(i), i.monitored_instances, ORDERS_AS_OF),
    i9_stored_history=lambda i: runs.stored_history(i.spark, _stored_history(i), i.monitored_instances),
)


@query("m2_purged_table")
def _purged(i: Inputs) -> DataFrame:
    path = scratch(i, "evidence")
    tables.append(i.metric_text_snapshot, path, "capture_date")
    retention.purge(i.spark, path, "MetricTextSnapshot", PURGE_AS_OF, RetentionParams(text_days=14))
    return tables.read_table(i.spark, path, "MetricTextSnapshot").select("CaptureTime", "InstanceId", "Details")


# --- Counters, connections, blocking, waits, file I/O --------------------------------------------


def _groups(i: Inputs) -> DataFrame:
    return connections.session_groups(i.raw_sessions)


def _blocked(i: Inputs) -> DataFrame:
    return blocking.blocked_requests(i.raw_requests, i.raw_sessions)


def _wait_metrics(i: Inputs) -> DataFrame:
    return waits.wait_metrics(waits.waits(i.raw_waits))


def _busy_files(i: Inputs) -> DataFrame:
    return file_io.busiest_files(file_io.file_stats(i.raw_file_io, i.raw_io_databases))


put(
    c1_counter_whitelist=lambda i: counters.captured(i.raw_counters),
    c2_metric_type=lambda i: counters.counter_metrics(i.raw_counters).select(
        *SNAPSHOT, "CounterName", "MetricValue", "MetricType"),
    c3_unit_and_sub_instance=lambda i: counters.counter_metrics(i.raw_counters).select(
        *SNAPSHOT, "CounterName", "InstanceName", "Unit"),
    c4_cpu_sample=lambda i: counters.cpu_samples(i.raw_ring_buffer),
    c5_cpu_metrics=lambda i: counters.cpu_metrics(counters.cpu_samples(i.raw_ring_buffer)),
    c6_session_summary=lambda i: connections.session_summary(_groups(i), i.capture_roster),
    c7_sessions_by_login=lambda i: connections.session_breakdown(_groups(i), ("Login",)),
    c8_sessions_by_host=lambda i: connections.session_breakdown(_groups(i), ("Host",)),
    c9_sessions_by_application=lambda i: connections.session_breakdown(_groups(i), ("Application",)),
    c10_sessions_by_database=lambda i: connections.session_breakdown(_groups(i), ("Database",)),
    c11_blocked_requests=_blocked,
    c12_blocking_summary=lambda i: blocking.blocking_summary(
        blocking.all_blocked(i.raw_requests, i.raw_sessions), i.capture_roster),
    c13_blocking_evidence=lambda i: blocking.blocking_evidence(_blocked(i)),
    c14_wait_snapshot=lambda i: waits.wait_snapshot(i.raw_waits),
    c15_wait_metrics=_wait_metrics,
    c16_file_stats=lambda i: file_io.file_stats(i.raw_file_io, i.raw_io_databases),
    c17_busiest_files=_busy_files,
    c18_file_metrics=lambda i: file_io.file_metrics(_busy_files(i)),
    c19_file_evidence=lambda i: file_io.file_evidence(_busy_files(i)),
)

# --- Active requests -----------------------------------------------------------------------------


def _base(i: Inputs) -> DataFrame:
    return requests.active_requests(i.raw_requests, i.raw_sessions)


def _narrow(i: Inputs) -> DataFrame:
    return requests.active_requests(i.raw_requests, i.raw_sessions, statements=False)


def _expensive(i: Inputs) -> DataFrame:
    return requests.expensive_requests(_narrow(i), requests=i.raw_requests)


def _repeated(i: Inputs) -> DataFrame:
    return requests.repeated_requests(_narrow(i), i.raw_requests)


put(
    c20_request_base=_base,
    c21_request_summary=lambda i: requests.request_summary(_narrow(i), i.capture_roster),
    c22_expensive_requests=_expensive,
    c23_requests_by_database=lambda i: requests.request_attribution(_narrow(i), ("Database",)),
    c24_requests_by_host=lambda i: requests.request_attribution(_narrow(i), ("Host",)),
    c25_requests_by_program=lambda i: requests.request_attribution(_narrow(i), ("Program",)),
    c26_requests_by_login=lambda i: requests.request_attribution(_narrow(i), ("Login",)),
    c27_repeated_requests=_repeated,
    c28_expensive_evidence=lambda i: requests.expensive_evidence(_expensive(i)),
    c28_attribution_evidence=lambda i: requests.attribution_evidence(requests.request_attribution(_narrow(i))),
    c28_repeated_evidence=lambda i: requests.repeated_evidence(_repeated(i)),
)

# --- Query statistics and backups ----------------------------------------------------------------


def _candidates(i: Inputs, *categories: str) -> DataFrame:
    return query_stats.candidates(i.raw_query_stats, categories or tuple(query_stats.RANKINGS), params=QUERY_PARAMS)


def _enriched(i: Inputs) -> DataFrame:
    return query_stats.enrich(query_stats.deduplicate(_candidates(i)), i.raw_query_text)


def _kept(i: Inputs) -> DataFrame:
    return query_stats.query_details(i.raw_query_stats, i.raw_query_text, params=QUERY_PARAMS)


def _last(i: Inputs) -> DataFrame:
    return backups.last_backups(i.raw_backupset, i.raw_backupmedia)


def _compliance(i: Inputs) -> DataFrame:
    policy = backups.backup_policy(inventory.enabled_profiles(i.monitored_instances))
    return backups.compliance_base(i.raw_databases, i.raw_backupset, i.raw_backupmedia, policy)


def _issues(i: Inputs) -> DataFrame:
    return backups.compliance_issues(_compliance(i), BACKUP_PARAMS)


put(
    c29_candidates_by_cpu=lambda i: _candidates(i, "CPU"),
    c30_candidates_by_duration=lambda i: _candidates(i, "Duration"),
    c31_candidates_by_logicalreads=lambda i: _candidates(i, "LogicalReads"),
    c32_candidates_by_executions=lambda i: _candidates(i, "Executions"),
    c33_all_candidates=_candidates,
    c34_deduplicated=lambda i: query_stats.deduplicate(_candidates(i)),
    c35_enriched=_enriched,
    c36_without_monitor_statements=_kept,
    c37_query_summary=lambda i: query_stats.query_summary(_kept(i), i.landing_roster),
    c38_detail_order=lambda i: query_stats.detail_order(_kept(i)),
    c38_query_evidence=lambda i: query_stats.query_evidence(_kept(i)),
    c39_last_backups=_last,
    c40_backup_status=lambda i: backups.backup_status(i.raw_databases, _last(i)),
    c41_backup_ages=lambda i: backups.with_ages(backups.backup_status(i.raw_databases, _last(i))),
    c42_backup_policy=lambda i: backups.backup_policy(inventory.enabled_profiles(i.monitored_instances)),
    c43_compliance_summary=lambda i: backups.compliance_summary(_compliance(i), i.landing_roster, BACKUP_PARAMS),
    c44_issue_type=lambda i: _compliance(i).select(
        *SNAPSHOT, "DatabaseName", backups.issue_type(BACKUP_PARAMS).alias("IssueType")),
    c45_issue_severity=lambda i: _compliance(i).select(
        *SNAPSHOT, "DatabaseName", backups.issue_severity(BACKUP_PARAMS).alias("Severity")),
    c46_compliance_issues=_issues,
    c47_compliance_evidence=lambda i: backups.compliance_evidence(_issues(i)),
)

# --- Agent jobs and alerts -----------------------------------------------------------------------


def _recent(i: Inputs) -> DataFrame:
    return agent_jobs.recent_runs(i.raw_job_history, i.raw_jobs, params=JOB_PARAMS)


def _running(i: Inputs) -> DataFrame:
    return agent_jobs.running_jobs(i.raw_job_activity, i.raw_jobs, i.raw_agent_sessions)


def _flagged(i: Inputs) -> DataFrame:
    return agent_alerts.flagged_alerts(i.raw_alerts, i.raw_notifications, params=ALERT_PARAMS)


def _alerts(i: Inputs) -> DataFrame:
    return agent_alerts.with_notification_lists(_flagged(i), i.raw_notifications, i.raw_operators)


def _config_issues(i: Inputs) -> DataFrame:
    return agent_alerts.configuration_issues(_flagged(i), i.raw_notifications, i.raw_operators)


def _triggered(i: Inputs) -> DataFrame:
    return agent_alerts.triggered_alerts(_flagged(i), i.raw_notifications, i.raw_operators)


put(
    c48_recent_runs=_recent,
    c49_running_jobs=_running,
    c50_job_inventory=lambda i: agent_jobs.job_inventory(i.raw_jobs, i.landing_roster),
    c51_outcome_summary=lambda i: agent_jobs.outcome_summary(_recent(i), i.landing_roster),
    c52_running_summary=lambda i: agent_jobs.running_summary(_running(i), i.landing_roster),
    c53_failed_runs=lambda i: agent_jobs.failed_runs(_recent(i)),
    c53_failure_evidence=lambda i: agent_jobs.failure_evidence(agent_jobs.failed_runs(_recent(i))),
    c54_longest_running=lambda i: agent_jobs.longest_running(_running(i)),
    c54_running_evidence=lambda i: agent_jobs.running_evidence(agent_jobs.longest_running(_running(i))),
    c55_decoded_alerts=lambda i: agent_alerts.decoded_alerts(i.raw_alerts),
    c56_has_notification=lambda i: _flagged(i).select(*SNAPSHOT, "AlertId", "HasNotification"),
    c57_operator_names=lambda i: _alerts(i).select(*SNAPSHOT, "AlertId", "OperatorNames"),
    c58_notification_methods=lambda i: _alerts(i).select(*SNAPSHOT, "AlertId", "NotificationMethods"),
    c59_alert_flags=_alerts,
    c60_alert_summary=lambda i: agent_alerts.alert_summary(_flagged(i), i.landing_roster),
    c61_configuration_issues=_config_issues,
    c62_triggered_alerts=_triggered,
    c63_issue_evidence=lambda i: agent_alerts.alert_evidence(_config_issues(i)),
    c63_trigger_evidence=lambda i: agent_alerts.alert_evidence(_triggered(i)),
)

# --- Views ---------------------------------------------------------------------------------------


def _health(i: Inputs) -> DataFrame:
    return pv.instance_health_summary(i.metric_snapshot, i.monitored_instances)


def _view(build) -> Callable[[Inputs], DataFrame]:
    return lambda i: build(i.metric_snapshot, i.monitored_instances)


def _text_view(build) -> Callable[[Inputs], DataFrame]:
    return lambda i: build(i.metric_text_snapshot, i.monitored_instances)


put(
    v1_latest_metrics=lambda i: pv.latest_metrics(i.metric_snapshot),
    v2_instance_health_summary=_health,
    v3_backup_compliance=_text_view(pv.backup_compliance),
    v4_top_problem_queries=_text_view(pv.top_problem_queries),
    v5_operations_summary=lambda i: pv.operations_summary(_health(i)),
    v6_wait_stats_summary=_text_view(pv.wait_stats_summary),
    v7_database_io_summary=_view(pv.database_io_summary),
    v8_repository_row_counts=lambda i: pv.repository_row_counts(
        i.metric_snapshot, i.metric_text_snapshot, i.collection_run_history, i.monitored_instances),
    v9_instance_inventory=lambda i: rv.instance_inventory(i.monitored_instances),
    v10_metric_latest=_view(rv.metric_latest),
    v11_metric_trend=_view(rv.metric_trend),
    v12_backup_compliance_current=_view(rv.backup_compliance_current),
    v13_collector_health=lambda i: rv.collector_health(i.collection_run_history, i.monitored_instances, ORDERS_AS_OF),
    v14_server_health_current=lambda i: rv.server_health_current(
        i.metric_snapshot, i.collection_run_history, i.monitored_instances, ORDERS_AS_OF),
    v15_performance_health_current=_view(rv.performance_health_current),
    v16_blocking_health_current=_view(rv.blocking_health_current),
    v17_query_pressure_current=_view(rv.query_pressure_current),
    v18_data_freshness_current=lambda i: rv.data_freshness_current(
        i.collection_run_history, i.monitored_instances, ORDERS_AS_OF),
    v19_server_health_scorecard=lambda i: rv.server_health_scorecard(
        i.metric_snapshot, i.collection_run_history, i.monitored_instances, ORDERS_AS_OF),
    v20_wait_pressure_current=_view(rv.wait_pressure_current),
    v21_agent_health_current=_view(rv.agent_health_current),
)


def _state(i: Inputs) -> DataFrame:
    """The maintained state after three cycles' worth of captures, the last of them late."""
    history, state = scratch(i, "history"), scratch(i, "state")
    portions = (lambda d: d.day < 10, lambda d: d.day >= 20, lambda d: 10 <= d.day < 20)
    for _ in tables.append_in_turn(i.metric_snapshot, history, "capture_date", portions):
        latest_state.refresh(i.spark, history, state)
    return latest_state.state_rows(i.spark, state)


def _problem_queries(i: Inputs) -> DataFrame:
    path = scratch(i, "evidence")
    tables.append(i.metric_text_snapshot, path, "capture_date")
    return pv.stored_problem_queries(i.spark, path, i.monitored_instances)


put(
    v1_from_state=lambda i: pv.latest_metrics(_state(i)),
    v4_newest_first=_problem_queries,
    v10_from_state=lambda i: rv.metric_latest(_state(i), i.monitored_instances),
    v19_from_state=lambda i: rv.server_health_scorecard(
        _state(i), i.collection_run_history, i.monitored_instances, ORDERS_AS_OF),
    v20_from_state=lambda i: rv.wait_pressure_current(_state(i), i.monitored_instances),
)
