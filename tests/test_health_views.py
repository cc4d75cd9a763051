from datetime import datetime, timedelta
from decimal import Decimal

import pytest

from fleetgauge.plans import reporting_views as rv
from fleetgauge.plans import repository_views as pv
from tests.helpers import DAY, by, core, instances, metrics

NOW = datetime(2024, 3, 10, 12)
PERFORMANCE = {"SourceCollector": "Collect-PerformanceCounters"}


def run(spark, rows):
    return core(spark, "collection_run_history", [
        {"CollectionRunId": n, "CollectorName": c, "InstanceId": i, "StartedAt": s, "FinishedAt": f, "Status": st}
        for n, (i, c, s, f, st) in enumerate(rows)
    ])


@pytest.mark.parametrize("system, process, health", [
    (89, 84, "Warning"), (90, 0, "Critical"), (0, 85, "Critical"), (79, 69, "Healthy"), (80, 0, "Warning"),
    (0, 70, "Warning"), (None, 100, "Unknown"), (91, None, "Critical"), (50, None, "Healthy"),
])
def test_cpu_levels(spark, system, process, health):
    rows = [(1, DAY, name, v) for name, v in (("SystemCpuPercent", system), ("SqlProcessCpuPercent", process)) if v is not None]
    view = rv.performance_health_current(metrics(spark, rows, **PERFORMANCE), instances(spark, 1))
    assert view.first().CpuHealth == health


@pytest.mark.parametrize("pending, health", [(0, "Healthy"), (1, "Warning"), (4, "Warning"), (5, "Critical")])
def test_memory_levels(spark, pending, health):
    rows = metrics(spark, [(1, DAY, "Memory Grants Pending", pending)], **PERFORMANCE)
    assert rv.performance_health_current(rows, instances(spark, 1)).first().MemoryHealth == health


@pytest.mark.parametrize("values, delta, health", [
    ([7], None, "Unknown"), ([7, 7], 0, "Healthy"), ([7, 8], 1, "Warning"), ([7, 11], 4, "Warning"),
    ([7, 12], 5, "Critical"), ([7, 3], None, "Unknown"), ([1, 9, 9], 0, "Healthy"),
])
def test_deadlock_delta_uses_the_two_newest_samples(spark, values, delta, health):
    rows = [(1, DAY + timedelta(minutes=n), "Number of Deadlocks/sec", v) for n, v in enumerate(values)]
    row = rv.performance_health_current(metrics(spark, rows, **PERFORMANCE), instances(spark, 1)).first()
    assert row.DeadlocksSincePreviousSample == (None if delta is None else Decimal(delta))
    assert row.DeadlockHealth == health


def test_instances_without_metrics_are_unknown_and_disabled_ones_left_out(spark):
    known = instances(spark, 1, 2).unionByName(instances(spark, 3, IsEnabled=False))
    view = by(rv.performance_health_current(metrics(spark, [(1, DAY, "SystemCpuPercent", 1), (3, DAY, "SystemCpuPercent", 1)], **PERFORMANCE), known))
    assert set(view) == {1, 2}
    assert (view[2].CpuHealth, view[2].MemoryHealth, view[2].DeadlockHealth) == ("Unknown",) * 3


@pytest.mark.parametrize("blocked, wait, health", [
    (0, 0, "Healthy"), (1, 59, "Warning"), (0, 60, "Critical"), (4, 0, "Warning"), (5, 0, "Critical"),
])
def test_blocking_levels(spark, blocked, wait, health):
    rows = metrics(spark, [(1, DAY, "BlockedSessionCount", blocked), (1, DAY, "MaxWaitSeconds", wait)],
                   SourceCollector="Collect-Blocking", ObjectName="BlockingSummary")
    assert rv.blocking_health_current(rows, instances(spark, 1)).first().BlockingHealth == health


def test_newest_value_wins_and_ties_go_to_the_higher_id(spark):
    rows = [(1, DAY, "BlockedSessionCount", 9), (1, DAY, "BlockedSessionCount", 2), (1, DAY - timedelta(days=1), "BlockedSessionCount", 7)]
    view = rv.blocking_health_current(
        metrics(spark, rows, SourceCollector="Collect-Blocking", ObjectName="BlockingSummary"), instances(spark, 1))
    assert view.first().BlockedSessionCount == 2


def test_backup_summary_uses_one_capture_only(spark):
    common = {"SourceCollector": "Collect-Backups", "MetricCategory": "BackupCompliance", "ObjectName": "BackupComplianceSummary"}
    rows = [(1, DAY - timedelta(days=1), "DatabasesWithOldDiffBackup", 3), (1, DAY, "DatabaseCount", 4),
            (1, DAY, "RecoveryModelViolations", 1), (2, DAY, "DatabasesWithOldDiffBackup", 1)]
    view = by(rv.backup_compliance_current(metrics(spark, rows, **common), instances(spark, 1, 2, 3)))
    assert (view[1].DatabasesWithOldDiffBackup, view[1].BackupHealth, view[1].ConfigurationHealth) == (None, "Healthy", "Warning")
    assert (view[2].BackupHealth, view[2].BackupProtectionIssueCount) == ("Critical", 1)
    assert (view[3].BackupHealth, view[3].ConfigurationHealth) == ("Unknown", "Unknown")


@pytest.mark.parametrize("age, status, health", [
    (timedelta(minutes=1), "Failed", "Critical"), (timedelta(days=9), "Error", "Critical"),
    (timedelta(minutes=30), "Running", "Warning"), (timedelta(minutes=30, seconds=1), "Running", "Warning"),
    (timedelta(hours=24), "Success", "Healthy"), (timedelta(hours=24, seconds=1), "Success", "Warning"),
    (timedelta(minutes=1), "Completed", "Healthy"), (timedelta(minutes=1), "Odd", "Warning"),
])
def test_collector_levels(spark, age, status, health):
    row = rv.collector_health(run(spark, [(1, "c", NOW - age, None, status)]), instances(spark, 1), NOW).first()
    assert row.CollectorHealth == health


def test_collector_without_runs_and_hours_cut_off(spark):
    runs = run(spark, [(1, "c", NOW - timedelta(minutes=100), None, "Success"), (1, "c", NOW - timedelta(days=3), None, "Failed")])
    view = by(rv.collector_health(runs, instances(spark, 1, 2), NOW))
    assert view[1].HoursSinceLastRun == Decimal("1.666666") and view[1].CollectorHealth == "Healthy"
    assert view[2].CollectorHealth == "Unknown" and view[2].CollectorName is None


@pytest.mark.parametrize("finished, health, never", [
    ([NOW - timedelta(hours=24)], "Healthy", 0), ([NOW - timedelta(hours=24, seconds=1)], "Warning", 0),
    ([NOW, None], "Warning", 1), ([], "Unknown", 0),
])
def test_freshness(spark, finished, health, never):
    rows = [(1, f"c{n}", NOW - timedelta(days=2), f, "Success" if f else "Failed") for n, f in enumerate(finished)]
    rows.append((9, "c", NOW, NOW, "Success"))
    row = rv.data_freshness_current(run(spark, rows), instances(spark, 1), NOW).first()
    assert (row.FreshnessHealth, row.CollectorsNeverSuccessful) == (health, never)


def test_scorecard_of_an_unknown_and_a_healthy_server(spark):
    rows = metrics(spark, [(2, NOW, "SystemCpuPercent", 5)], **PERFORMANCE)
    card = by(rv.server_health_scorecard(
        rows, run(spark, [(2, "c", NOW, NOW, "Success")]), instances(spark, 1, 2), NOW))
    # 100 - cpu 5 - memory 5 - blocking 5 - backup 5 - configuration 3 - freshness 10.
    assert card[1].HealthScore == 67 and card[1].CollectorUnknownCount == 1
    # 100 - blocking 5 - backup 5 - configuration 3.
    assert card[2].HealthScore == 87 and card[2].CollectorUnknownCount == 0
    assert card[1].OverallHealth == card[2].OverallHealth == "Warning"


def test_score_never_falls_below_zero(spark):
    everything = (
        [(1, NOW, "SystemCpuPercent", 99), (1, NOW, "Memory Grants Pending", 9),
         (1, NOW - timedelta(hours=1), "Number of Deadlocks/sec", 0), (1, NOW, "Number of Deadlocks/sec", 9)])
    bad = metrics(spark, everything, **PERFORMANCE).unionByName(
        metrics(spark, [(1, NOW, "MaxWaitSeconds", 99)], SourceCollector="Collect-Blocking", ObjectName="BlockingSummary")
    ).unionByName(metrics(
        spark, [(1, NOW, "DatabasesWithoutFullBackup", 1), (1, NOW, "RecoveryModelViolations", 1)],
        SourceCollector="Collect-Backups", MetricCategory="BackupCompliance", ObjectName="BackupComplianceSummary"))
    row = rv.server_health_scorecard(bad, run(spark, [(1, "c", NOW, None, "Failed")]), instances(spark, 1), NOW).first()
    assert (row.HealthScore, row.OverallHealth) == (0, "Critical")


def test_every_health_branch_occurs_in_the_inputs(spark):
    from fixtures import ORDERS_AS_OF, Inputs

    i = Inputs(spark, "/root/testdata/sf0.01")
    card = rv.server_health_scorecard(i.metric_snapshot, i.collection_run_history, i.monitored_instances, ORDERS_AS_OF).toPandas()
    assert card.HealthScore.between(0, 100).all()
    for column in ("CpuHealth", "BlockingHealth", "DeadlockHealth"):
        assert set(card[column]) == {"Critical", "Warning", "Healthy", "Unknown"}, column
    assert {"Critical", "Healthy", "Unknown"} == set(card.BackupHealth)


WAITS = {"SourceCollector": "Collect-WaitStats", "ObjectName": "SQLWaitStats"}


def waits(spark, rows):
    frames = [metrics(spark, [(i, t, "WaitTimeMs", v)], **WAITS, InstanceName=w) for i, t, w, v in rows]
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


def test_wait_growth_reset_and_missing_baseline(spark):
    before = DAY - timedelta(seconds=10)
    view = by(rv.wait_pressure_current(waits(spark, [
        (1, before, "LCK_M_X", 1000), (1, DAY, "LCK_M_X", 3000),            # 200 per second
        (1, before, "WRITELOG", 9000), (1, DAY, "WRITELOG", 10),            # reset
        (1, DAY, "CXPACKET", 5), (1, DAY - timedelta(days=1), "CXPACKET", 1),  # absent from the capture before
        (2, DAY, "LCK_M_X", 50),                                            # one capture only
    ]), instances(spark, 1, 2, 3)))
    assert view[1].TotalWaitDeltaMs == view[1].LockWaitDeltaMs == 2000
    assert view[1].LockWaitMsPerSecond == Decimal("200.00") and view[1].WaitTypesWithoutBaseline == 2
    assert (view[1].DominantWaitCategory, view[1].WaitHealth) == ("Locking", "Critical")
    assert (view[2].SampleIntervalSeconds, view[2].DominantWaitCategory, view[2].WaitHealth) == (None, "None", "Unknown")
    assert (view[3].DominantWaitCategory, view[3].WaitHealth) == ("Unknown", "Unknown")


@pytest.mark.parametrize("wait, per_second, health", [
    ("LCK_M_S", 19, "Healthy"), ("LCK_M_S", 20, "Warning"), ("LCK_M_S", 100, "Critical"),
    ("RESOURCE_SEMAPHORE", 100, "Critical"), ("THREADPOOL", 99, "Healthy"), ("THREADPOOL", 100, "Warning"),
    ("IO_COMPLETION", 500, "Critical"), ("WRITELOG_X", 499, "Warning"), ("CXCONSUMER", 499, "Healthy"),
    ("CXCONSUMER", 5000, "Warning"), ("LCKX", 9999, "Healthy"), ("SOMETHING", 99999, "Healthy"),
])
def test_wait_levels(spark, wait, per_second, health):
    rows = [(1, DAY - timedelta(seconds=100), wait, 0), (1, DAY, wait, per_second * 100)]
    assert rv.wait_pressure_current(waits(spark, rows), instances(spark, 1)).first().WaitHealth == health


def test_earlier_wait_class_wins_a_tie_and_other_never_dominates(spark):
    before = DAY - timedelta(seconds=1)
    rows = [(1, t, w, v) for w in ("WRITELOG", "CMEMTHREAD") for t, v in ((before, 0), (DAY, 5))]
    rows += [(1, before, "ODD", 0), (1, DAY, "ODD", 500)]
    row = rv.wait_pressure_current(waits(spark, rows), instances(spark, 1)).first()
    assert row.DominantWaitCategory == "Memory" and row.TotalWaitDeltaMs == 510


@pytest.mark.parametrize("failed, canceled, retry, health", [
    (1, 0, 0, "Critical"), (0, 1, 0, "Warning"), (0, 0, 1, "Warning"), (0, 0, 0, "Healthy"), (None, 5, 0, "Unknown"),
])
def test_agent_levels(spark, failed, canceled, retry, health):
    rows = [(1, DAY, n, v) for n, v in (("RecentFailedJobs", failed), ("RecentCanceledJobs", canceled), ("RecentRetryJobs", retry)) if v is not None]
    common = {"SourceCollector": "Collect-SqlAgentJobs", "MetricCategory": "SqlAgentJob", "ObjectName": "SqlAgentJobSummary"}
    assert rv.agent_health_current(metrics(spark, rows, **common), instances(spark, 1)).first().SQLAgentHealth == health


def test_null_and_empty_names_are_one_series(spark):
    first = metrics(spark, [(1, DAY, "c", 1)], InstanceName="", ObjectName="o")
    second = metrics(spark, [(1, DAY + timedelta(hours=1), "c", 2)], InstanceName=None, ObjectName="o")
    assert [r.MetricValue for r in pv.latest_metrics(first.unionByName(second)).collect()] == [2]


def test_series_are_ranked_with_each_name_once(spark):
    rows = metrics(spark, [(1, DAY, "c", 1)], DatabaseName="", ObjectName=None, InstanceName=None).unionByName(
        metrics(spark, [(1, DAY + timedelta(hours=1), "c", 2)], DatabaseName=None, ObjectName="", InstanceName="")).unionByName(
        metrics(spark, [(1, DAY, "c", 3)], DatabaseName="db", ObjectName="", InstanceName=None))
    latest = rv.metric_latest(rows, instances(spark, 1))
    assert {(r.DatabaseName, r.ObjectName, r.CounterInstanceName, r.MetricValue) for r in latest.collect()} == {
        (None, "", "", 2), ("db", "", None, 3)}
    stored = pv.latest_metrics(rows)
    assert {(r.DatabaseName, r.ObjectName, r.InstanceName, r.MetricValue) for r in stored.collect()} == {
        ("", None, None, 1), (None, "", "", 2), ("db", "", None, 3)}
    # A key made of a name would be carried beside it as _w0, _w1 and so on.
    for view in (latest, stored):
        assert "_w0" not in view._jdf.queryExecution().optimizedPlan().toString()


def test_health_summary_without_metrics_is_healthy(spark):
    row = pv.operations_summary(pv.instance_health_summary(metrics(spark, [(7, DAY, "c", 1)]), instances(spark, 1))).first()
    assert (row.HealthStatus, row.FailedJobs, row.LastMetricCaptureTime) == ("Healthy", 0, None)


def test_time_bounds_prune_date_partitions(spark, tmp_path):
    from fleetgauge.functions.timing import rows_before, rows_from
    from fleetgauge.operators import retention
    from fleetgauge.params import RetentionParams
    from fleetgauge.sources import tables

    rows = metrics(spark, [(1, DAY - timedelta(days=d), "c", d) for d in range(5)], SourceCollector="s")
    tables.append(rows, str(tmp_path / "m"), "capture_date")
    stored = tables.read_table(spark, str(tmp_path / "m"), "MetricSnapshot")
    recent = tables.read_table(spark, str(tmp_path / "m"), "MetricSnapshot", since=(DAY - timedelta(days=1)).date())
    half = DAY - timedelta(days=2, hours=12)
    older = rows_before(stored, "CaptureTime", half)
    for count, df in ((2, recent), (3, rows_from(stored, "CaptureTime", half)), (2, older)):
        assert df.count() == count
        assert "PartitionFilters: [isnotnull(capture_date" in df._jdf.queryExecution().executedPlan().toString()
    kept = retention.retained(stored, "MetricSnapshot", DAY + timedelta(days=5, hours=12), RetentionParams(metric_days=8))
    assert kept.count() == 3
