"""Repository and reporting views."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

_LATEST = """latest AS (
  SELECT unnest(arg_max(m, row(m.CaptureTime, m.MetricSnapshotId))) FROM {metric_snapshot} m
  GROUP BY m.InstanceId, m.MetricCategory, m.ObjectName, m.CounterName, ifnull(m.DatabaseName, ''), ifnull(m.InstanceName, ''))
"""
ORACLES["v1_latest_metrics"] = "WITH " + _LATEST + "SELECT * EXCLUDE (capture_date) FROM latest"


def _of(category: str, *counters: str) -> str:
    names = ", ".join(f"'{c}'" for c in counters)
    return f"max(MetricValue) FILTER (MetricCategory = '{category}' AND CounterName IN ({names}))"


_HEALTH = "WITH " + _LATEST + f""", health AS (
  SELECT i.InstanceId, i.InstanceName, i.EnvironmentName, i.CollectionProfile,
         {_of('PerformanceCounter', 'User Connections')} AS UserConnections,
         {_of('ActiveRequest', 'ActiveRequestCount')} AS ActiveRequestCount,
         {_of('Blocking', 'BlockedSessionCount')} AS BlockedSessionCount,
         {_of('Blocking', 'MaxWaitSeconds')} AS MaxBlockingWaitSeconds,
         {_of('SqlAgentJob', 'RecentFailedJobs')} AS FailedJobs, {_of('SqlAgentJob', 'RunningJobCount')} AS RunningJobs,
         {_of('Backup', 'DatabasesWithoutFullBackup', 'DatabasesWithOldFullBackup',
              'FullRecoveryDatabasesWithoutLogBackup', 'FullRecoveryDatabasesWithOldLogBackup')} AS BackupIssues,
         {_of('SqlAgentAlert', 'AlertsTriggeredRecently')} AS TriggeredAlerts,
         if(coalesce(greatest(BlockedSessionCount, FailedJobs, BackupIssues, TriggeredAlerts), 0) > 0, 'Warning', 'Healthy') AS HealthStatus,
         max(l.CaptureTime) AS LastMetricCaptureTime
  FROM {{monitored_instances}} i LEFT JOIN latest l ON l.InstanceId = i.InstanceId
  WHERE i.IsEnabled GROUP BY i.InstanceId, i.InstanceName, i.EnvironmentName, i.CollectionProfile)
"""
ORACLES["v2_instance_health_summary"] = _HEALTH + "SELECT * FROM health"
ORACLES["v5_operations_summary"] = _HEALTH + """
SELECT InstanceId, InstanceName, EnvironmentName, coalesce(FailedJobs, 0)::DECIMAL(28,6) AS FailedJobs,
       coalesce(RunningJobs, 0)::DECIMAL(28,6) AS RunningJobs, coalesce(BackupIssues, 0)::DECIMAL(28,6) AS BackupIssues,
       coalesce(TriggeredAlerts, 0)::DECIMAL(28,6) AS TriggeredAlerts,
       coalesce(BlockedSessionCount, 0)::DECIMAL(28,6) AS BlockedSessions, HealthStatus, LastMetricCaptureTime FROM health"""
ORACLES["v3_backup_compliance"] = """
SELECT t.MetricTextSnapshotId, i.InstanceName, i.EnvironmentName, t.InstanceId, t.CaptureTime, t.DatabaseName,
       t.DetailType AS BackupIssueType, t.Severity, t.Details,
       if(t.DetailType LIKE 'Missing%', 'Critical', if(t.DetailType LIKE 'Old%', 'Warning', 'Healthy')) AS Status
FROM {metric_text_snapshot} t JOIN {monitored_instances} i USING (InstanceId) WHERE t.SourceCollector = 'Collect-Backups'"""
ORACLES["v4_top_problem_queries"] = """
SELECT t.MetricTextSnapshotId, i.InstanceName, i.EnvironmentName, t.InstanceId, t.CaptureTime, t.DatabaseName, t.DetailType,
       t.Severity, t.NumericValue1 AS AvgCpuMs, t.NumericValue2 AS AvgElapsedMs, t.Details, t.SourceCollector
FROM {metric_text_snapshot} t JOIN {monitored_instances} i USING (InstanceId) WHERE t.SourceCollector = 'Collect-QueryStats'
ORDER BY t.CaptureTime DESC, t.NumericValue1 DESC, t.NumericValue2 DESC, t.MetricTextSnapshotId LIMIT 500"""
ORACLES["v6_wait_stats_summary"] = """
SELECT t.MetricTextSnapshotId, i.InstanceName, i.EnvironmentName, t.InstanceId, t.CaptureTime, t.DetailType, t.Severity,
       t.NumericValue1, t.NumericValue2, t.Details, t.SourceCollector
FROM {metric_text_snapshot} t JOIN {monitored_instances} i USING (InstanceId) WHERE t.SourceCollector = 'Collect-WaitStats'"""
ORACLES["v7_database_io_summary"] = "WITH " + _LATEST + """
SELECT i.InstanceName, i.EnvironmentName, l.InstanceId, l.CaptureTime, l.DatabaseName, l.ObjectName, l.CounterName,
       l.MetricValue, l.Unit, l.SourceCollector
FROM latest l JOIN {monitored_instances} i ON i.InstanceId = l.InstanceId WHERE l.MetricCategory = 'DatabaseIO'"""
ORACLES["v8_repository_row_counts"] = """
SELECT (SELECT count(*) FROM {metric_snapshot}) AS MetricSnapshotRows,
       (SELECT count(*) FROM {metric_text_snapshot}) AS MetricTextSnapshotRows,
       (SELECT count(*) FROM {collection_run_history}) AS CollectionRunHistoryRows,
       (SELECT count(*) FROM {monitored_instances} WHERE IsEnabled) AS MonitoredInstances"""
ORACLES["v9_instance_inventory"] = "SELECT * FROM {monitored_instances}"
_TREND = """SELECT m.InstanceId, i.InstanceName, i.EnvironmentName, i.CollectionProfile, i.ComplianceProfile, m.CaptureTime,
       m.DatabaseName, m.ObjectName, m.CounterName, m.InstanceName AS CounterInstanceName, m.MetricCategory, m.MetricValue,
       m.MetricType, m.Unit, m.SourceCollector FROM """
ORACLES["v10_metric_latest"] = """WITH newest AS (
  SELECT unnest(arg_max(m, row(m.CaptureTime, m.MetricSnapshotId))) FROM {metric_snapshot} m
  GROUP BY m.InstanceId, ifnull(m.DatabaseName, ''), ifnull(m.ObjectName, ''), ifnull(m.CounterName, ''),
           ifnull(m.InstanceName, ''), ifnull(m.MetricCategory, ''), ifnull(m.SourceCollector, ''))
""" + _TREND + "newest m JOIN {monitored_instances} i ON i.InstanceId = m.InstanceId"
ORACLES["v11_metric_trend"] = _TREND + "{metric_snapshot} m JOIN {monitored_instances} i ON i.InstanceId = m.InstanceId"

# --- signals -------------------------------------------------------------------------------------

_BACKUP_COUNTERS = ["DatabaseCount", "DatabasesWithoutFullBackup", "DatabasesWithOldFullBackup", "DatabasesWithOldDiffBackup",
                    "RecoveryModelViolations", "DatabasesWithoutRequiredLogBackup", "DatabasesWithOldRequiredLogBackup",
                    "NonCompliantDatabaseCount", "MaxFullBackupAgeHours", "MaxLogBackupAgeHours"]
_BACKUP = """backup_rows AS (
  SELECT * FROM {metric_snapshot} WHERE SourceCollector = 'Collect-Backups' AND MetricCategory = 'BackupCompliance'
    AND ObjectName = 'BackupComplianceSummary'
  QUALIFY CaptureTime = max(CaptureTime) OVER (PARTITION BY InstanceId)),
backup_wide AS (SELECT InstanceId, CaptureTime, """ + ", ".join(
    f"max(MetricValue) FILTER (CounterName = '{c}') AS {c}" for c in _BACKUP_COUNTERS) + """ FROM backup_rows GROUP BY 1, 2),
backup AS (
  SELECT i.InstanceId, i.InstanceName, i.EnvironmentName, i.ComplianceProfile, b.* EXCLUDE (InstanceId),
         (ifnull(DatabasesWithoutFullBackup, 0) + ifnull(DatabasesWithOldFullBackup, 0) + ifnull(DatabasesWithOldDiffBackup, 0)
          + ifnull(DatabasesWithoutRequiredLogBackup, 0) + ifnull(DatabasesWithOldRequiredLogBackup, 0))::DECIMAL(33,6) AS BackupProtectionIssueCount,
         ifnull(RecoveryModelViolations, 0)::DECIMAL(28,6) AS ConfigurationViolationCount,
         CASE WHEN b.InstanceId IS NULL THEN 'Unknown' WHEN BackupProtectionIssueCount > 0 THEN 'Critical' ELSE 'Healthy' END AS BackupHealth,
         CASE WHEN b.InstanceId IS NULL THEN 'Unknown' WHEN RecoveryModelViolations > 0 THEN 'Warning' ELSE 'Healthy' END AS ConfigurationHealth
  FROM {monitored_instances} i LEFT JOIN backup_wide b ON b.InstanceId = i.InstanceId WHERE i.IsEnabled)"""
ORACLES["v12_backup_compliance_current"] = "WITH " + _BACKUP + " SELECT * FROM backup"

_PERF = {
    "MemoryGrantsPending": "Memory Grants Pending", "TargetServerMemoryKB": "Target Server Memory (KB)",
    "TotalServerMemoryKB": "Total Server Memory (KB)", "PageLifeExpectancySeconds": "Page life expectancy",
    "SqlProcessCpuPercent": "SqlProcessCpuPercent", "SystemCpuPercent": "SystemCpuPercent",
    "SystemIdlePercent": "SystemIdlePercent",
}


def _newest(counter: str) -> str:
    return f"arg_max(MetricValue, row(CaptureTime, MetricSnapshotId)) FILTER (CounterName = '{counter}')"


_PERFORMANCE = """perf_wide AS (
  SELECT InstanceId, max(CaptureTime) AS CaptureTime, """ + ", ".join(f"{_newest(c)} AS {n}" for n, c in _PERF.items()) + """,
         list(MetricValue ORDER BY CaptureTime DESC, MetricSnapshotId DESC) FILTER (CounterName = 'Number of Deadlocks/sec') AS locks
  FROM {metric_snapshot} WHERE SourceCollector = 'Collect-PerformanceCounters' AND CounterName IN ('Number of Deadlocks/sec', """ + (
    ", ".join(f"'{c}'" for c in _PERF.values())) + """) GROUP BY 1),
perf AS (
  SELECT i.InstanceId, i.InstanceName, i.EnvironmentName, p.* EXCLUDE (InstanceId, locks), p.locks[1] AS DeadlockCounter,
         if(p.locks[1] >= p.locks[2], (p.locks[1] - p.locks[2])::DECIMAL(29,6), NULL) AS DeadlocksSincePreviousSample,
         CASE WHEN SystemCpuPercent IS NULL THEN 'Unknown'
              WHEN SystemCpuPercent >= 90 OR SqlProcessCpuPercent >= 85 THEN 'Critical'
              WHEN SystemCpuPercent >= 80 OR SqlProcessCpuPercent >= 70 THEN 'Warning' ELSE 'Healthy' END AS CpuHealth,
         CASE WHEN p.InstanceId IS NULL THEN 'Unknown' WHEN MemoryGrantsPending >= 5 THEN 'Critical'
              WHEN MemoryGrantsPending > 0 THEN 'Warning' ELSE 'Healthy' END AS MemoryHealth,
         CASE WHEN DeadlocksSincePreviousSample IS NULL THEN 'Unknown' WHEN DeadlocksSincePreviousSample >= 5 THEN 'Critical'
              WHEN DeadlocksSincePreviousSample > 0 THEN 'Warning' ELSE 'Healthy' END AS DeadlockHealth
  FROM {monitored_instances} i LEFT JOIN perf_wide p ON p.InstanceId = i.InstanceId WHERE i.IsEnabled)"""
ORACLES["v15_performance_health_current"] = "WITH " + _PERFORMANCE + " SELECT * FROM perf"


def _wide(name: str, collector: str, obj: str, counters: list[str], health: str, column: str) -> str:
    return (f"{name}_wide AS (SELECT InstanceId, max(CaptureTime) AS CaptureTime, "
            + ", ".join(f"{_newest(c)} AS {c}" for c in counters)
            + f" FROM {{metric_snapshot}} WHERE SourceCollector = '{collector}' AND ObjectName = '{obj}' GROUP BY 1),\n"
            f"{name} AS (SELECT i.InstanceId, i.InstanceName, i.EnvironmentName, w.* EXCLUDE (InstanceId), {health} AS {column}"
            f" FROM {{monitored_instances}} i LEFT JOIN {name}_wide w ON w.InstanceId = i.InstanceId WHERE i.IsEnabled)")


_BLOCKING = _wide(
    "blocking", "Collect-Blocking", "BlockingSummary",
    ["BlockedSessionCount", "DistinctBlockingSessionCount", "MaxWaitSeconds", "TotalWaitSeconds"],
    """CASE WHEN w.InstanceId IS NULL THEN 'Unknown' WHEN MaxWaitSeconds >= 60 THEN 'Critical'
       WHEN BlockedSessionCount >= 5 THEN 'Critical' WHEN BlockedSessionCount > 0 THEN 'Warning' ELSE 'Healthy' END""",
    "BlockingHealth")
_QUERY = _wide(
    "query_pressure", "Collect-QueryStats", "QueryStatsSummary",
    ["TopCpuQueryCount", "TopDurationQueryCount", "TopLogicalReadQueryCount", "TopExecutionQueryCount", "DistinctQueriesCaptured"],
    "if(w.InstanceId IS NULL, 'Unknown', 'Available')", "QueryDataHealth")
_AGENT = _wide(
    "agent", "Collect-SqlAgentJobs", "SqlAgentJobSummary",
    ["RecentFailedJobs", "RecentCanceledJobs", "RecentRetryJobs", "RecentSucceededJobs", "RecentCompletedJobs", "TotalEnabledJobs",
     "TotalDisabledJobs", "RunningJobCount", "MaxRunningSeconds", "MaxRunDurationSeconds", "AvgRunDurationSeconds"],
    """CASE WHEN RecentFailedJobs IS NULL THEN 'Unknown' WHEN RecentFailedJobs > 0 THEN 'Critical'
       WHEN RecentCanceledJobs > 0 OR RecentRetryJobs > 0 THEN 'Warning' ELSE 'Healthy' END""", "SQLAgentHealth")
ORACLES["v16_blocking_health_current"] = "WITH " + _BLOCKING + " SELECT * FROM blocking"
ORACLES["v17_query_pressure_current"] = "WITH " + _QUERY + " SELECT * FROM query_pressure"
ORACLES["v21_agent_health_current"] = "WITH " + _AGENT + " SELECT * FROM agent"

# --- collector runs ------------------------------------------------------------------------------

_COLLECTORS = """collectors AS (
  SELECT i.InstanceId, i.InstanceName, i.EnvironmentName, r.CollectorName, r.StartedAt AS LastStartedAt,
         r.FinishedAt AS LastFinishedAt, r.Status AS LastStatus, r.RowsCollected, r.DurationMs, r.ErrorMessage,
         (date_diff('minute', r.StartedAt, TIMESTAMP '2001-08-02 00:00:00') * 1000000 // 60 * 0.000001::DECIMAL(7,6))::DECIMAL(17,6) AS HoursSinceLastRun,
         CASE WHEN r.Status IS NULL THEN 'Unknown' WHEN r.Status IN ('Failed', 'Error') THEN 'Critical'
              WHEN r.StartedAt < if(r.Status = 'Running', TIMESTAMP '2001-08-01 23:30:00', TIMESTAMP '2001-08-01 00:00:00') THEN 'Warning'
              WHEN r.Status IN ('Success', 'Succeeded', 'Completed') THEN 'Healthy' ELSE 'Warning' END AS CollectorHealth
  FROM {monitored_instances} i LEFT JOIN (
    SELECT unnest(arg_max(h, row(h.StartedAt, h.CollectionRunId))) FROM {collection_run_history} h GROUP BY h.InstanceId, h.CollectorName
  ) r ON r.InstanceId = i.InstanceId WHERE i.IsEnabled)"""
ORACLES["v13_collector_health"] = "WITH " + _COLLECTORS + " SELECT * FROM collectors"
_COUNTED = """counted AS (
  SELECT InstanceId, count(*) FILTER (CollectorHealth = 'Critical') AS CollectorCriticalCount,
         count(*) FILTER (CollectorHealth = 'Warning') AS CollectorWarningCount,
         count(*) FILTER (CollectorHealth = 'Unknown') AS CollectorUnknownCount, max(LastStartedAt) AS LastCollectionTime
  FROM collectors GROUP BY 1)"""
ORACLES["v14_server_health_current"] = "WITH " + ",\n".join([_COLLECTORS, _COUNTED, _BACKUP]) + """
SELECT i.InstanceId, i.InstanceName, i.EnvironmentName, i.CollectionProfile, i.ComplianceProfile, i.SqlVersion, i.Edition,
       b.CaptureTime AS BackupCaptureTime, b.DatabaseCount, b.BackupProtectionIssueCount, b.ConfigurationViolationCount,
       b.NonCompliantDatabaseCount, b.BackupHealth, b.ConfigurationHealth, c.LastCollectionTime,
       c.CollectorCriticalCount, c.CollectorWarningCount,
       CASE WHEN c.CollectorCriticalCount > 0 OR b.BackupHealth = 'Critical' THEN 'Critical'
            WHEN c.CollectorWarningCount = 0 AND b.BackupHealth = 'Healthy' AND b.ConfigurationHealth = 'Healthy' THEN 'Healthy'
            ELSE 'Warning' END AS OverallHealth
FROM {monitored_instances} i JOIN backup b USING (InstanceId) JOIN counted c USING (InstanceId)"""
_FRESH = """fresh AS (
  SELECT i.InstanceId, i.InstanceName, i.EnvironmentName, max(s.started) AS LastCollectionAttempt,
         min(s.ok) AS OldestCollectorSuccess, max(s.ok) AS LatestCollectorSuccess,
         count(s.InstanceId) - count(s.ok) AS CollectorsNeverSuccessful,
         CASE WHEN count(s.InstanceId) = 0 THEN 'Unknown'
              WHEN CollectorsNeverSuccessful = 0 AND OldestCollectorSuccess >= TIMESTAMP '2001-08-01 00:00:00' THEN 'Healthy'
              ELSE 'Warning' END AS FreshnessHealth
  FROM {monitored_instances} i LEFT JOIN (
    SELECT InstanceId, CollectorName, max(StartedAt) AS started,
           max(FinishedAt) FILTER (Status IN ('Success', 'Succeeded', 'Completed')) AS ok
    FROM {collection_run_history} GROUP BY 1, 2) s ON s.InstanceId = i.InstanceId
  WHERE i.IsEnabled GROUP BY 1, 2, 3)"""
ORACLES["v18_data_freshness_current"] = "WITH " + _FRESH + " SELECT * FROM fresh"


def _points(column: str, critical: int, warning: int, unknown: int) -> str:
    return f"coalesce([{critical}, {warning}, {unknown}][list_position(['Critical', 'Warning', 'Unknown'], {column})], 0)"


_LOST = " + ".join([
    _points("CpuHealth", 20, 10, 5), _points("MemoryHealth", 20, 10, 5), _points("BlockingHealth", 20, 10, 5),
    _points("DeadlockHealth", 15, 8, 0), _points("BackupHealth", 25, 10, 5), _points("ConfigurationHealth", 10, 5, 3),
    _points("FreshnessHealth", 25, 15, 10),
    "if(CollectorCriticalCount > 0, 25, if(CollectorWarningCount > 0, 10, 0))",
])
ORACLES["v19_server_health_scorecard"] = "WITH " + ",\n".join(
    [_PERFORMANCE, _BLOCKING, _QUERY, _BACKUP, _FRESH, _COLLECTORS, _COUNTED]) + f""",
base AS (
  SELECT i.InstanceId, i.InstanceName, i.EnvironmentName, i.CollectionProfile, i.ComplianceProfile, i.SqlVersion, i.Edition,
         p.CaptureTime AS PerformanceCaptureTime, p.SqlProcessCpuPercent, p.SystemCpuPercent, p.MemoryGrantsPending,
         p.PageLifeExpectancySeconds, p.DeadlocksSincePreviousSample, p.CpuHealth, p.MemoryHealth, p.DeadlockHealth,
         k.CaptureTime AS BlockingCaptureTime, k.BlockedSessionCount, k.DistinctBlockingSessionCount, k.MaxWaitSeconds, k.BlockingHealth,
         b.CaptureTime AS BackupCaptureTime, b.DatabaseCount, b.BackupProtectionIssueCount, b.ConfigurationViolationCount,
         b.BackupHealth, b.ConfigurationHealth, q.CaptureTime AS QueryStatsCaptureTime, q.DistinctQueriesCaptured, q.QueryDataHealth,
         f.LastCollectionAttempt, f.LatestCollectorSuccess, f.CollectorsNeverSuccessful, f.FreshnessHealth,
         c.CollectorCriticalCount, c.CollectorWarningCount, c.CollectorUnknownCount, c.LastCollectionTime
  FROM {{monitored_instances}} i JOIN perf p USING (InstanceId) JOIN blocking k USING (InstanceId)
  JOIN backup b USING (InstanceId) JOIN query_pressure q USING (InstanceId) JOIN fresh f USING (InstanceId)
  JOIN counted c USING (InstanceId))
SELECT *, greatest(100 - ({_LOST}), 0)::INT AS HealthScore,
       CASE WHEN CollectorCriticalCount > 0 OR list_contains([FreshnessHealth, CpuHealth, MemoryHealth, BlockingHealth,
                 DeadlockHealth, BackupHealth], 'Critical') THEN 'Critical'
            WHEN CollectorWarningCount > 0 OR DeadlockHealth = 'Warning' OR list_has_any(['Warning', 'Unknown'],
                 [FreshnessHealth, CpuHealth, MemoryHealth, BlockingHealth, BackupHealth, ConfigurationHealth]) THEN 'Warning'
            ELSE 'Healthy' END AS OverallHealth
FROM base"""

# --- waits ---------------------------------------------------------------------------------------

_CLASSES = ["Lock", "IO", "Parallelism", "Memory", "CPU", "LogIO"]


def _rate(name: str) -> str:
    # Half up to two digits in integer arithmetic over millionths.
    scaled = f"({name}WaitDeltaMs * 1000000)::HUGEINT"
    return (f"(if(SampleIntervalSeconds = 0, NULL, (200 * {scaled} + 1000000 * SampleIntervalSeconds::HUGEINT) "
            f"// (2000000 * SampleIntervalSeconds::HUGEINT)) * 0.01::DECIMAL(3,2))::DECIMAL(19,2) AS {name}WaitMsPerSecond")


ORACLES["v20_wait_pressure_current"] = """WITH waits AS (
  SELECT * FROM {metric_snapshot} WHERE SourceCollector = 'Collect-WaitStats' AND ObjectName = 'SQLWaitStats'),
captures AS (
  SELECT InstanceId, t[1] AS cur, t[2] AS prev FROM (
    SELECT InstanceId, list_reverse_sort(list_distinct(list(CaptureTime))) AS t FROM waits GROUP BY 1)),
deltas AS (
  SELECT c.InstanceId, c.cur, c.prev, n.InstanceName AS wait,
         CASE WHEN n.MetricValue >= p.MetricValue THEN (n.MetricValue - p.MetricValue)::DECIMAL(29,6) END AS d
  FROM captures c JOIN waits n ON n.InstanceId = c.InstanceId AND n.CaptureTime = c.cur AND n.CounterName = 'WaitTimeMs'
  LEFT JOIN waits p ON p.InstanceId = c.InstanceId AND p.CaptureTime = c.prev AND p.CounterName = n.CounterName
                   AND p.InstanceName = n.InstanceName),
summed AS (
  SELECT InstanceId, cur AS CaptureTime, date_diff('second', prev, cur)::INT AS SampleIntervalSeconds,
         coalesce(sum(d), 0)::DECIMAL(38,6) AS TotalWaitDeltaMs,
         coalesce(sum(d) FILTER (starts_with(wait, 'LCK_')), 0)::DECIMAL(38,6) AS LockWaitDeltaMs,
         coalesce(sum(d) FILTER (wait IN ('PAGEIOLATCH_SH', 'PAGEIOLATCH_EX', 'PAGEIOLATCH_UP', 'IO_COMPLETION', 'ASYNC_IO_COMPLETION')), 0)::DECIMAL(38,6) AS IOWaitDeltaMs,
         coalesce(sum(d) FILTER (wait IN ('CXPACKET', 'CXCONSUMER')), 0)::DECIMAL(38,6) AS ParallelismWaitDeltaMs,
         coalesce(sum(d) FILTER (wait IN ('RESOURCE_SEMAPHORE', 'CMEMTHREAD')), 0)::DECIMAL(38,6) AS MemoryWaitDeltaMs,
         coalesce(sum(d) FILTER (wait IN ('SOS_SCHEDULER_YIELD', 'THREADPOOL')), 0)::DECIMAL(38,6) AS CPUWaitDeltaMs,
         coalesce(sum(d) FILTER (starts_with(wait, 'WRITELOG')), 0)::DECIMAL(38,6) AS LogIOWaitDeltaMs,
         count(*) - count(d) AS WaitTypesWithoutBaseline
  FROM deltas GROUP BY InstanceId, cur, prev),
rates AS (SELECT *, """ + ", ".join(_rate(n) for n in ["Total", *_CLASSES]) + """ FROM summed)
SELECT i.InstanceId, i.InstanceName, i.EnvironmentName, r.* EXCLUDE (InstanceId),
       CASE WHEN r.InstanceId IS NULL THEN 'Unknown'
            WHEN greatest(LockWaitDeltaMs, IOWaitDeltaMs, ParallelismWaitDeltaMs, MemoryWaitDeltaMs, CPUWaitDeltaMs, LogIOWaitDeltaMs) = 0 THEN 'None'
            ELSE list_extract(['Locking', 'IO', 'Parallelism', 'Memory', 'CPU', 'LogIO'],
              list_position([LockWaitDeltaMs, IOWaitDeltaMs, ParallelismWaitDeltaMs, MemoryWaitDeltaMs, CPUWaitDeltaMs, LogIOWaitDeltaMs],
                greatest(LockWaitDeltaMs, IOWaitDeltaMs, ParallelismWaitDeltaMs, MemoryWaitDeltaMs, CPUWaitDeltaMs, LogIOWaitDeltaMs)))
       END AS DominantWaitCategory,
       CASE WHEN coalesce(SampleIntervalSeconds, 0) <= 0 THEN 'Unknown'
            WHEN WaitTypesWithoutBaseline > 0 AND TotalWaitDeltaMs = 0 THEN 'Unknown'
            WHEN greatest(LockWaitMsPerSecond, MemoryWaitMsPerSecond) >= 100
              OR greatest(CPUWaitMsPerSecond, IOWaitMsPerSecond, LogIOWaitMsPerSecond) >= 500 THEN 'Critical'
            WHEN greatest(LockWaitMsPerSecond, MemoryWaitMsPerSecond) >= 20 OR ParallelismWaitMsPerSecond >= 500
              OR greatest(CPUWaitMsPerSecond, IOWaitMsPerSecond, LogIOWaitMsPerSecond) >= 100 THEN 'Warning'
            ELSE 'Healthy' END AS WaitHealth
FROM {monitored_instances} i LEFT JOIN rates r ON r.InstanceId = i.InstanceId WHERE i.IsEnabled"""

# --- the same from the maintained state and from stored tables ------------------------------------

for stored, plain in (("v1_from_state", "v1_latest_metrics"), ("v4_newest_first", "v4_top_problem_queries"), ("v10_from_state", "v10_metric_latest"),
                      ("v19_from_state", "v19_server_health_scorecard"), ("v20_from_state", "v20_wait_pressure_current")):
    ORACLES[stored] = ORACLES[plain]
