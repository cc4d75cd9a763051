from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from fleetgauge.operators import (
    agent_alerts, agent_jobs, backups, blocking, connections, counters, file_io, query_stats, requests, waits,
)
from fleetgauge.params import (
    BackupParams, BlockingParams, ConnectionParams, JobParams, MonitorIdentity, QueryStatsParams, RequestParams, WaitParams,
)
from tests.helpers import DAY, by, landing, roster


# --- counters ---


def test_counter_types_units_and_blank_sub_instances(spark):
    rows = [{"object_name": "o", "counter_name": c, "instance_name": s, "cntr_value": 5} for c, s in (
        ("Target Server Memory (KB)", " "), ("Page life expectancy", "node"), ("Batch Requests/sec", ""), ("Other", "x"))]
    found = by(counters.counter_metrics(landing(spark, "raw_counters", rows, CaptureTime=DAY + timedelta(microseconds=7))), "CounterName")
    assert {k: (r.MetricType, r.Unit, r.InstanceName) for k, r in found.items()} == {
        "Target Server Memory (KB)": ("Gauge", "KB", None), "Page life expectancy": ("Gauge", "sec", "node"),
        "Batch Requests/sec": ("Cumulative", "count", None)}
    assert {r.CaptureTime for r in found.values()} == {DAY}


def test_cpu_sample_takes_the_newest_marked_record_and_missing_nodes_are_null(spark):
    record = "<Record><SchedulerMonitorEvent>{}</SchedulerMonitorEvent></Record>"
    health = "<SystemHealth>{}</SystemHealth>"
    kind = "RING_BUFFER_SCHEDULER_MONITOR"
    both = health.format("<ProcessUtilization>7</ProcessUtilization><SystemIdle>60</SystemIdle>")
    raw = landing(spark, "raw_ring_buffer", [
        {"ring_buffer_type": kind, "ts": 1, "record": record.format(both)},
        {"ring_buffer_type": kind, "ts": 3, "record": record.format("")},
        {"ring_buffer_type": "OTHER", "ts": 4, "record": record.format(both)},
        {"InstanceId": 2, "ring_buffer_type": kind, "ts": 1, "record": record.format(health.format("<SystemIdle>1</SystemIdle>"))},
    ])
    found = by(counters.cpu_samples(raw))
    assert tuple(found[1])[2:] == (7, 60, 40)
    assert (found[2].SqlProcessCpuPercent, found[2].SystemCpuPercent) == (None, 99)
    assert counters.cpu_metrics(counters.cpu_samples(raw)).count() == 5


# --- connections ---


def test_session_summary_and_breakdown(spark):
    rows = [{"session_id": n, "login_name": l, "host_name": "h", "program_name": "", "database_id": d, "database_name": name,
             "is_user_process": True} for n, (l, d, name) in enumerate(
        [("a", 1, "x"), ("a", 1, "x"), ("", 2, None), ("", 2, None), (None, 3, None), (None, 3, None), ("b", 1, "x")])]
    rows.append({"session_id": 99, "login_name": "z", "is_user_process": False})
    groups = connections.session_groups(landing(spark, "raw_sessions", rows))
    summary = by(connections.session_summary(groups, roster(spark, 1, 2)))
    assert tuple(summary[1])[2:] == (7, 2, 1, 0)
    assert tuple(summary[2])[2:] == (0, 0, 0, 0)
    labels = [(r.BreakdownType, r.BreakdownValue, r.SessionCount) for r in connections.session_breakdown(groups).collect()]
    # NULL and empty logins are two groups with one label; the single session of b is below the minimum.
    assert sorted(x for x in labels if x[0] == "Login") == [("Login", "(blank)", 2), ("Login", "(blank)", 2), ("Login", "a", 2)]
    assert sorted(x for x in labels if x[0] == "Database") == [("Database", "(unknown)", 2), ("Database", "(unknown)", 2), ("Database", "x", 3)]
    assert connections.session_breakdown(groups, ("Login",), ConnectionParams(max_breakdown_rows=1)).count() == 1


# --- requests and blocking ---

SESSION = {"login_name": "u", "host_name": "h", "program_name": "app", "is_user_process": True}


def sessions(spark, *ids, **columns):
    return landing(spark, "raw_sessions", [{**SESSION, "session_id": i, **columns} for i in ids])


@pytest.mark.parametrize("columns, kept", [
    ({}, True), ({"program_name": None, "login_name": None}, True), ({"program_name": "dbatools PowerShell module"}, False),
    ({"program_name": "my PowerShell"}, False), ({"program_name": "powershell"}, False), ({"program_name": "power shell"}, True), ({"login_name": "watcher"}, False),
    ({"is_user_process": False}, False),
])
def test_the_monitoring_leaves_itself_out(spark, columns, kept):
    found = requests.foreign_sessions(sessions(spark, 1, **columns), MonitorIdentity(login="watcher"))
    assert found.count() == int(kept)


def test_blocking_keeps_the_longest_waits_and_summarises_all(spark):
    rows = [{"session_id": s, "blocking_session_id": b, "wait_time": w, "sql_text": "q" * 5000}
            for s, b, w in ((1, 9, 10), (2, 9, 30), (3, 8, 20), (4, 0, 99), (5, None, 99), (6, 7, None))]
    every = blocking.all_blocked(landing(spark, "raw_requests", rows), sessions(spark, 1, 2, 3, 4, 5, 6))
    blocked = blocking.longest_blocked(every, BlockingParams(max_rows=3))
    assert [(r.BlockedSessionId, r.rn) for r in blocked.orderBy("rn").collect()] == [(2, 1), (3, 2), (1, 3)]
    summary = by(blocking.blocking_summary(every, roster(spark, 1, 2)))
    assert tuple(summary[1])[2:] == (4, 3, Decimal("0.03000000"), Decimal("0.06000000"))
    assert tuple(summary[2])[2:] == (0, 0, 0, 0)
    evidence = blocking.blocking_evidence(blocked).filter("NumericValue2 = 8").first()
    assert evidence.Details.startswith("BlockedSessionId: 3\nBlockingSessionId: 8\nDatabaseName: (unknown)\n")
    assert evidence.Details.endswith("SQL text: " + "q" * 5000)
    assert blocking.blocking_metrics(blocking.blocking_summary(every, roster(spark, 1, 2))).count() == 8


LIMITS = {"total_elapsed_time": 30000, "cpu_time": 10000, "logical_reads": 100000, "reads": 10000, "writes": 10000, "wait_time": 10000}


@pytest.mark.parametrize("measure", LIMITS)
def test_each_threshold_is_inclusive(spark, measure):
    limit = LIMITS[measure]
    raw = landing(spark, "raw_requests", [{"session_id": 1, measure: limit - 1}, {"session_id": 2, measure: limit}])
    base = requests.active_requests(raw, sessions(spark, 1, 2))
    assert [r.session_id for r in requests.expensive_requests(base).collect()] == [2]
    summary = requests.request_summary(base, roster(spark, 1)).first().asDict()
    counted = {"total_elapsed_time": "LongRunningRequestCount", "cpu_time": "HighCpuRequestCount",
               "logical_reads": "HighLogicalReadRequestCount", "reads": "HighPhysicalReadRequestCount",
               "writes": "HighWriteRequestCount", "wait_time": "WaitingRequestCount"}
    assert {k for k, v in summary.items() if k in counted.values() and v} == {counted[measure]}


def test_requests_without_rows_give_zeros_for_the_roster(spark):
    raw = landing(spark, "raw_requests", [])
    summary = requests.request_summary(requests.active_requests(raw, sessions(spark)), roster(spark, 1, 2))
    assert all(v == 0 for row in summary.collect() for k, v in row.asDict().items() if k not in ("InstanceId", "CaptureTime"))
    assert requests.request_metrics(summary).count() == 26


def test_repeated_statements_group_on_the_stored_text(spark):
    texts = ["a\nb", "a b", "c", None, None]
    raw = landing(spark, "raw_requests", [{"session_id": n, "request_id": 0, "sql_text": t, "cpu_time": n} for n, t in enumerate(texts)])
    base = requests.active_requests(raw, sessions(spark, *range(5)))
    [row] = requests.repeated_requests(base, raw).collect()
    assert (row.ActiveRequestCount, row.SampleSqlText, row.TotalCpuMs) == (2, "a b", 1)
    assert row.QuerySignature == base.filter("session_id = 1").first().QuerySignature


def test_statements_equal_in_their_first_characters_stay_apart(spark):
    raw = landing(spark, "raw_requests", [{"session_id": n, "request_id": 0, "sql_text": "x" * 4000 + str(n % 2)} for n in (1, 2, 3)])
    for params in (RequestParams(), RequestParams(max_text_length=10)):
        base = requests.active_requests(raw, sessions(spark, 1, 2, 3), params)
        [row] = requests.repeated_requests(base, raw, params).collect()
        assert (row.ActiveRequestCount, len(row.SampleSqlText)) == (2, params.max_text_length or 4001)


def test_requests_of_one_session_are_not_mixed(spark):
    rows = [{"session_id": 1, "request_id": r, "cpu_time": 10000 + r, "sql_text": f"text {r // 2}"} for r in range(4)]
    raw = landing(spark, "raw_requests", rows)
    base = requests.active_requests(raw, sessions(spark, 1))
    expensive = requests.expensive_requests(base).orderBy("rn").collect()
    assert [(r.request_id, r.SqlText) for r in expensive] == [(3, "text 1"), (2, "text 1"), (1, "text 0"), (0, "text 0")]
    repeated = requests.repeated_requests(base, raw).orderBy("rn").collect()
    assert [(r.SampleSqlText, r.ActiveRequestCount) for r in repeated] == [("text 1", 2), ("text 0", 2)]
    blocked = blocking.all_blocked(raw.withColumn("blocking_session_id", F.lit(9).cast("bigint")), sessions(spark, 1))
    assert blocking.longest_blocked(blocked).count() == blocking.blocking_summary(blocked, roster(spark, 1)).first()[2] == 4


def test_statements_are_fetched_for_chosen_requests_only(spark):
    """Rows that share a key keep their own statement each, rows without a request id or a statement stay."""
    asked = [{"session_id": s, "request_id": r, "cpu_time": cpu, "sql_text": t} for s, r, cpu, t in (
        (1, 0, 90_000, "a\nb"), (1, 0, 90_000, "a\nb"), (1, 0, 70_000, "c"), (2, None, 60_000, "d"), (3, 0, 50_000, None), (4, 0, 1, "a b"))]
    raw, seen = landing(spark, "raw_requests", asked), sessions(spark, 1, 2, 3, 4)
    for params in (requests.RequestParams(), requests.RequestParams(max_text_length=2)):
        base, narrow = requests.active_requests(raw, seen, params), requests.active_requests(raw, seen, params, statements=False)
        assert "SqlText" not in narrow.columns and sorted(map(str, base.drop("SqlText").collect())) == sorted(map(str, narrow.collect()))
        assert {(r.session_id, r.cpu_time, r.SqlText) for r in base.collect()} == {
            (x["session_id"], x["cpu_time"], x["sql_text"] and x["sql_text"].replace("\n", " ")[:params.max_text_length]) for x in asked}
        late, early = requests.expensive_requests(narrow, params, raw), requests.expensive_requests(base, params)
        assert late.columns == early.columns and late.orderBy("rn").collect() == early.orderBy("rn").collect()
        assert late.count() == 5


def test_texts_of_repeated_requests_are_not_shuffled(spark):
    asked = [{"session_id": s, "request_id": 0, "sql_text": "x"} for s in (1, 2)]
    raw = landing(spark, "raw_requests", asked)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        base = requests.active_requests(raw, sessions(spark, 1, 2), statements=False)
        found = requests.repeated_requests(base, raw)
        assert "BroadcastHashJoin" in found._jdf.queryExecution().executedPlan().toString()
        assert [(r.ActiveRequestCount, r.SampleSqlText) for r in found.collect()] == [(2, "x")]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_attribution_has_one_row_per_label_and_kind(spark):
    raw = landing(spark, "raw_requests", [{"session_id": n, "database_name": d, "cpu_time": 5, "blocking_session_id": n}
                                          for n, d in enumerate(["x", "x", "", None])])
    rows = requests.request_attribution(requests.active_requests(raw, sessions(spark, 0, 1, 2, 3))).collect()
    found = {(r.DetailType, r.GroupValue): (r.ActiveRequestCount, r.TotalCpuMs, r.BlockedRequestCount) for r in rows}
    assert found[("ActiveRequestByDatabase", "(unknown)")] == (2, 10, 2)
    assert found[("ActiveRequestByDatabase", "x")] == (2, 10, 1)
    assert found[("ActiveRequestByLogin", "u")] == (4, 20, 3)
    assert len(found) == 5


# --- waits and files ---


def test_waits_leave_out_idle_types_and_keep_the_largest(spark):
    rows = [{"wait_type": w, "wait_time_ms": t, "signal_wait_time_ms": 1, "waiting_tasks_count": 1, "max_wait_time_ms": 1}
            for w, t in (("A", 5), ("B", 5), ("C", 9), ("WAITFOR", 100), ("CHKPT", 100), ("D", 0))]
    found = waits.wait_snapshot(landing(spark, "raw_waits", rows), WaitParams(max_types=2)).orderBy("rn").collect()
    assert [(r.WaitType, r.ResourceWaitTimeMs) for r in found] == [("C", 8), ("A", 4)]


def io(spark, reads, read_ms, writes, write_ms, database=7):
    raw = landing(spark, "raw_file_io", [{
        "database_id": database, "file_id": 1, "num_of_reads": reads, "num_of_writes": writes, "io_stall_read_ms": read_ms,
        "io_stall_write_ms": write_ms, "io_stall": read_ms + write_ms}])
    names = landing(spark, "raw_databases", [
        {"database_id": i, "name": f"db{i}", "state_desc": "OFFLINE" if i == 8 else "ONLINE",
         "source_database_id": 1 if i == 9 else None} for i in range(1, 10)])
    return file_io.busiest_files(file_io.file_stats(raw, names))


@pytest.mark.parametrize("read_ms, write_ms, severity", [
    (1999, 0, "Warning"), (2000, 0, "Critical"), (0, 2000, "Critical"), (999, 999, "Info"), (1000, 0, "Warning"), (0, 1000, "Warning"),
])
def test_latency_severity(spark, read_ms, write_ms, severity):
    assert file_io.file_evidence(io(spark, 100, read_ms, 100, write_ms)).first().Severity == severity


def test_file_latency_without_operations_and_rounding(spark):
    row = io(spark, 0, 50, 200, 1).first()
    assert (row.AvgReadLatencyMs, row.AvgWriteLatencyMs) == (Decimal("0.00"), Decimal("0.01"))
    assert io(spark, 0, 0, 0, 0).count() == 0
    assert file_io.file_metrics(io(spark, 1, 1, 1, 1)).count() == 13


@pytest.mark.parametrize("database", [4, 8, 9, 10])
def test_files_of_system_offline_snapshot_and_unknown_databases_are_left_out(spark, database):
    assert io(spark, 1, 1, 1, 1, database).count() == 0


# --- query statistics ---


def stats(spark, rows):
    base = {"execution_count": 1, "total_worker_time": 0, "total_elapsed_time": 0, "total_logical_reads": 0,
            "total_physical_reads": 0, "total_logical_writes": 0, "creation_time": DAY, "last_execution_time": DAY, "sql_handle": 1}
    return landing(spark, "raw_query_stats", [{**base, "plan_handle": n, **r} for n, r in enumerate(rows)])


def texts(spark, *pairs):
    return spark.createDataFrame(pairs, "sql_handle bigint, sql_text string")


def test_candidates_respect_lookback_executions_and_limit(spark):
    raw = stats(spark, [{"last_execution_time": DAY - timedelta(minutes=60), "total_worker_time": 5},
                        {"last_execution_time": DAY - timedelta(minutes=60, seconds=1), "total_worker_time": 9},
                        {"execution_count": 0, "total_worker_time": 9}, {"total_worker_time": 7}, {"total_worker_time": 1}])
    found = query_stats.candidates(raw, ("CPU",), params=QueryStatsParams(top_n=2)).orderBy("rn").collect()
    assert [r.plan_handle for r in found] == [3, 0]


def test_one_statement_per_hash_pair_and_missing_hash_equals_zero(spark):
    raw = stats(spark, [{"query_hash": None, "total_worker_time": 5}, {"query_hash": query_stats.ZERO_HASH, "total_worker_time": 6},
                        {"query_hash": "0x01", "total_worker_time": 1}])
    kept = query_stats.deduplicate(query_stats.candidates(raw, ("CPU",)))
    assert sorted(r.total_worker_time for r in kept.collect()) == [1, 6]


def test_enrichment_averages_and_own_statements(spark):
    raw = stats(spark, [{"sql_handle": 1, "query_hash": "0x01", "execution_count": 3, "total_worker_time": 10_000},
                        {"sql_handle": 2, "query_hash": "0x02"}, {"sql_handle": 3, "query_hash": "0x03"}, {"sql_handle": 4, "query_hash": "0x04"}])
    source = texts(spark, (1, "select\r\n1"), (2, "x" * 5000 + " MetricSnapshot"), (3, None))
    details = query_stats.query_details(raw, source)
    # 2 is the monitoring's own, which only the end of its text tells; 3 has no text and 4 no entry.
    assert {r.QueryHash for r in details.collect()} == {"0x01"}
    row = details.filter("RankingCategory = 'CPU'").first()
    assert (row.SqlText, row.TotalCpuMs, row.AvgCpuMs) == ("select  1", Decimal("10.00"), Decimal("3.33"))
    summary = by(query_stats.query_summary(details, roster(spark, 1, 2)))
    assert tuple(summary[1])[2:] == (1, 1, 1, 1, 1) and tuple(summary[2])[2:] == (0, 0, 0, 0, 0)
    ordered = query_stats.detail_order(details).orderBy("rn").collect()
    assert [r.RankingCategory for r in ordered] == ["CPU", "Duration", "LogicalReads", "Executions"]


@pytest.mark.parametrize("wrong", [{"top_n": 0}, {"lookback_minutes": 0}, {"max_text_length": 0}, {"min_executions": 0}])
def test_query_parameters_are_checked_and_never_changed(wrong):
    with pytest.raises(ValueError):
        QueryStatsParams(**wrong)
    params = QueryStatsParams(999, 5, 99999, 2)
    assert (params.top_n, params.max_text_length) == (999, 99999)


# --- backups ---


def backup(name, kind, age, media=1, start=None):
    finish = DAY - age
    return {"database_name": name, "type": kind, "backup_finish_date": finish, "backup_start_date": start or finish,
            "backup_size": 1536 * 1024, "compressed_backup_size": 0, "media_set_id": media}


def compliance(spark, recovery, profile, *rows):
    databases = landing(spark, "raw_databases", [{"name": "a", "state_desc": "ONLINE", "recovery_model_desc": recovery}])
    policy = backups.backup_policy(spark.createDataFrame([(1, profile)], "InstanceId int, ComplianceProfile string"))
    return backups.compliance_base(databases, landing(spark, "raw_backupset", list(rows)), landing(spark, "raw_backupmedia", []), policy)


H = timedelta(hours=1)


@pytest.mark.parametrize("recovery, profile, rows, issue, severity", [
    ("FULL", "V1_SIMPLE", [], "RecoveryModelMismatch", "Critical"),
    ("SIMPLE", "V2_FULL", [backup("a", "D", H)], "RecoveryModelMismatch", "Critical"),
    ("SIMPLE", "V1_SIMPLE", [], "MissingFullBackup", "Critical"),
    ("SIMPLE", "V1_SIMPLE", [backup("a", "D", 24 * H)], "OK", "Info"),
    ("SIMPLE", "V1_SIMPLE", [backup("a", "D", 24 * H + timedelta(seconds=1))], "OldFullBackup", "Warning"),
    ("FULL", "V2_FULL", [backup("a", "D", 30 * H)], "OldFullBackup", "Warning"),
    ("FULL", "V2_FULL", [backup("a", "D", H)], "MissingLogBackup", "Critical"),
    ("FULL", "V2_FULL", [backup("a", "D", H), backup("a", "L", 3 * H)], "OldLogBackup", "Critical"),
    ("FULL", "V2_FULL", [backup("a", "D", H), backup("a", "L", 2 * H)], "OK", "Info"),
    ("FULL", "V2_FULL", [backup("a", "D", H), backup("a", "X", H)], "MissingLogBackup", "Critical"),
])
def test_backup_issue_and_severity(spark, recovery, profile, rows, issue, severity):
    row = compliance(spark, recovery, profile, *rows).select(
        backups.issue_type().alias("i"), backups.issue_severity().alias("s")).first()
    assert (row.i, row.s) == (issue, severity)


def test_old_differentials_count_for_every_profile_but_are_no_issue(spark):
    base = compliance(spark, "SIMPLE", "V1_SIMPLE", backup("a", "D", H), backup("a", "I", 30 * H))
    row = backups.compliance_summary(base, roster(spark, 1)).first()
    assert (row.DatabasesWithOldDiffBackup, row.NonCompliantDatabaseCount) == (1, 0)
    assert (row.MaxFullBackupAgeHours, row.MaxLogBackupAgeHours) == (1, 0)


def test_old_full_backups_come_last_in_the_report(spark):
    names = {"old": [backup("old", "D", 30 * H), backup("old", "L", H)], "log": [backup("log", "D", H)], "none": [], "zlog": [backup("zlog", "D", H), backup("zlog", "L", 9 * H)]}
    databases = landing(spark, "raw_databases", [
        {"name": n, "state_desc": "ONLINE", "recovery_model_desc": "FULL"} for n in names] + [
        {"name": "simple", "state_desc": "ONLINE", "recovery_model_desc": "SIMPLE"},
        {"name": "off", "state_desc": "OFFLINE", "recovery_model_desc": "SIMPLE"},
        {"name": "tempdb", "state_desc": "ONLINE", "recovery_model_desc": "SIMPLE"}])
    policy = backups.backup_policy(spark.createDataFrame([(1, "V2_FULL")], "InstanceId int, ComplianceProfile string"))
    base = backups.compliance_base(databases, landing(spark, "raw_backupset", sum(names.values(), [])), landing(spark, "raw_backupmedia", []), policy)
    issues = backups.compliance_issues(base).orderBy("rn").collect()
    assert [r.DatabaseName for r in issues] == ["simple", "none", "log", "zlog", "old"]
    assert backups.compliance_issues(base, BackupParams(max_rows=2)).count() == 2


def test_last_backup_and_its_device(spark):
    rows = [backup("a", "D", 5 * H, 1), backup("a", "D", H, 2, DAY - H - timedelta(seconds=90)), backup("a", "I", H, 3)]
    media = landing(spark, "raw_backupmedia", [{"media_set_id": 2, "physical_device_name": d} for d in ("y", "x")])
    found = by(backups.last_backups(landing(spark, "raw_backupset", rows), media), "type")
    assert (found["D"].PhysicalDeviceName, found["D"].DurationSeconds, found["D"].BackupSizeMB) == ("x", 90, Decimal("1.50"))
    assert found["I"].PhysicalDeviceName is None


# --- jobs and alerts ---


def history(spark, rows):
    base = {"job_id": 1, "step_id": 0, "run_status": 1, "run_date": 20240309, "run_time": 120000, "run_duration": 10}
    return landing(spark, "raw_job_history", [{**base, "instance_id": n, **r} for n, r in enumerate(rows)])


def test_recent_runs_are_decoded_and_bounded(spark):
    jobs = landing(spark, "raw_jobs", [{"job_id": 1, "name": "j", "enabled": 1}])
    raw = history(spark, [{"run_time": 0}, {"run_date": 20240308, "run_time": 235959}, {"step_id": 1}, {"run_date": 20240230},
                          {"job_id": 2}, {"run_status": 9, "run_duration": 10203}])
    found = by(agent_jobs.recent_runs(raw, jobs), "instance_id")
    assert set(found) == {0, 5}
    assert (found[5].RunStatusDescription, found[5].RunDurationSeconds) == ("Unknown", 3723)


def test_outcomes_with_average_cut_off(spark):
    jobs = landing(spark, "raw_jobs", [{"job_id": 1, "name": "j", "enabled": 1}, {"job_id": 2, "name": "k", "enabled": 0}])
    recent = agent_jobs.recent_runs(history(spark, [{"run_duration": d, "run_status": s} for d, s in ((1, 0), (2, 2), (2, 3))]), jobs)
    row = by(agent_jobs.outcome_summary(recent, roster(spark, 1, 2)))
    assert row[1].AvgRunDurationSeconds == Decimal("1.666666") and row[1].MaxRunDurationSeconds == 2
    assert (row[1].RecentCompletedJobs, row[1].RecentFailedJobs, row[1].RecentRetryJobs, row[1].RecentCanceledJobs) == (3, 1, 1, 1)
    assert row[2].AvgRunDurationSeconds == 0 and row[2].RecentCompletedJobs == 0
    assert [r.rn for r in agent_jobs.failed_runs(recent, JobParams(max_rows=2)).orderBy("rn").collect()] == [1, 2]
    inventory = by(agent_jobs.job_inventory(jobs, roster(spark, 1, 2)))
    assert tuple(inventory[1])[2:] == (1, 1) and tuple(inventory[2])[2:] == (0, 0)
    running = agent_jobs.running_jobs(landing(spark, "raw_job_activity", []), jobs, landing(spark, "raw_agent_sessions", []))
    summary = agent_jobs.job_metrics(
        agent_jobs.job_inventory(jobs, roster(spark, 1, 2)), agent_jobs.outcome_summary(recent, roster(spark, 1, 2)),
        agent_jobs.running_summary(running, roster(spark, 1, 2)))
    assert summary.count() == 22


@pytest.mark.parametrize("seconds, severity", [(3599, "Info"), (3600, "Warning")])
def test_long_running_jobs(spark, seconds, severity):
    jobs = landing(spark, "raw_jobs", [{"job_id": 1, "name": "j", "enabled": 1}])
    activity = landing(spark, "raw_job_activity", [
        {"job_id": 1, "session_id": 5, "start_execution_date": DAY - timedelta(seconds=seconds)},
        {"job_id": 1, "session_id": 4, "start_execution_date": DAY - timedelta(days=1)},
        {"job_id": 1, "session_id": 5, "start_execution_date": DAY, "stop_execution_date": DAY}, {"job_id": 1, "session_id": 5}])
    agent = landing(spark, "raw_agent_sessions", [{"session_id": 4}, {"session_id": 5}])
    [row] = agent_jobs.longest_running(agent_jobs.running_jobs(activity, jobs, agent)).collect()
    assert (row.RunningSeconds, row.Severity) == (seconds, severity)


@pytest.mark.parametrize("severity, message, expected", [
    (20, 0, "Critical"), (19, 0, "Warning"), (16, 0, "Warning"), (15, 0, "Info"), (0, 823, "Critical"), (0, 9001, "Critical"),
    (0, 1205, "Warning"), (0, 0, "Info"), (16, 825, "Critical"), (None, None, "Info"),
])
def test_alert_severity(spark, severity, message, expected):
    raw = landing(spark, "raw_alerts", [{"id": 1, "severity": severity, "message_id": message}])
    row = agent_alerts.flagged_alerts(raw, landing(spark, "raw_notifications", [])).first()
    assert row.AlertSeverity == expected


def test_alert_lists_issues_and_triggers(spark):
    fired = {"last_occurrence_date": 20240309, "last_occurrence_time": 0, "occurrence_count": 2, "severity": 20, "message_id": 0}
    raw = landing(spark, "raw_alerts", [
        {"id": 1, "name": "a", "enabled": 1, **fired}, {"id": 2, "name": "b", "enabled": 0, **fired},
        {"id": 3, "name": "c", "enabled": 1, **fired, "last_occurrence_date": 0},
        {"id": 4, "name": "d", "enabled": 1, **fired, "last_occurrence_date": 20240308, "last_occurrence_time": 235959}])
    notes = landing(spark, "raw_notifications", [
        {"alert_id": 1, "operator_id": o, "notification_method": m} for o, m in ((1, 4), (2, 1), (9, 3), (1, None), (2, 7))])
    operators = landing(spark, "raw_operators", [{"id": 1, "name": "zoe"}, {"id": 2, "name": "amy"}])
    flagged = agent_alerts.flagged_alerts(raw, notes)
    [row] = agent_alerts.triggered_alerts(flagged, notes, operators).collect()
    assert (row.AlertId, row.OperatorNames) == (1, "(none), amy, zoe")
    assert row.NotificationMethods == "(none), Email, Email/Pager/NetSend, NetSend, Other"
    issues = agent_alerts.configuration_issues(flagged, notes, operators).orderBy("rn").collect()
    assert [(r.AlertId, r.IssueReason, r.OperatorNames) for r in issues] == [
        (2, "Alert disabled", "(none)"), (3, "Alert has no notification", "(none)"), (4, "Alert has no notification", "(none)")]
    summary = by(agent_alerts.alert_summary(flagged, roster(spark, 1, 2)))
    assert (summary[1].TotalAlerts, summary[1].AlertsTriggeredRecently, summary[1].AlertsWithNotifications) == (4, 2, 1)
    assert summary[2].TotalAlerts == 0 and summary[2].MaxOccurrenceCount == 0


def test_names_are_one_whatever_their_case_and_blanks_at_the_end(spark):
    names = ["App", "app  ", "APP", " app", "", "  ", None, None]
    rows = [{"session_id": n, "login_name": name, "host_name": name, "program_name": name, "database_id": 1, "database_name": "d",
             "is_user_process": True} for n, name in enumerate(names)]
    groups = connections.session_groups(landing(spark, "raw_sessions", rows))
    summary = by(connections.session_summary(groups, roster(spark, 1)))[1]
    assert (summary.TotalUserSessions, summary.DistinctLogins, summary.DistinctHosts, summary.DistinctApplications) == (8, 2, 2, 2)
    for kind in ("Login", "Host", "Application"):
        large = connections.session_breakdown(groups, (kind,)).collect()
        assert sorted((r.BreakdownValue, r.SessionCount) for r in large) == [("(blank)", 2), ("(blank)", 2), ("APP", 3)]


def test_attribution_and_the_own_sessions_do_not_depend_on_spelling(spark):
    names = ["Big", "BIG ", "big", " ", None]
    asked = [{"session_id": n, "request_id": 0, "database_name": name, "cpu_time": 1} for n, name in enumerate(names)]
    who = [{"session_id": n, "is_user_process": True, "login_name": name, "host_name": name, "program_name": name} for n, name in enumerate(names)]
    own = [{"session_id": 10, "is_user_process": True, "login_name": "WATCHER "}, {"session_id": 11, "is_user_process": True, "program_name": "powershell 7"}]
    seen = landing(spark, "raw_sessions", who + own)
    assert {r.session_id for r in requests.foreign_sessions(seen, MonitorIdentity(login="watcher")).collect()} == set(range(5))
    base = requests.active_requests(landing(spark, "raw_requests", asked), seen)
    found = requests.request_attribution(base).collect()
    assert len(found) == 8
    for kind in ("Database", "Host", "Program", "Login"):
        mine = {r.GroupValue: r.ActiveRequestCount for r in found if r.DetailType == f"ActiveRequestBy{kind}"}
        assert mine == {"BIG ": 3, "(unknown)": 2}
