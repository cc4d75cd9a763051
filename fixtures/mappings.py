"""SQL mappings from the given tables to the core and landing tables (see FIXTURES.md)."""

from __future__ import annotations

from fleetgauge import fixed_values as fv

_DAY = "cast(date_trunc('day', ts) AS {TS})"
_MONTH = "cast(date_trunc('month', ts) AS {TS})"
_SECOND = "cast(date_trunc('second', ts) AS {TS})"
_LANDED = "{TS} '2001-08-02 00:00:00' AS CaptureTime"

# Families of summary counters: name -> (collector, category, object, modulus, counters).
_SUMMARIES = {
    "metric_blocking": ("Collect-Blocking", "Blocking", "BlockingSummary", 90,
        ["BlockedSessionCount", "DistinctBlockingSessionCount", "MaxWaitSeconds", "TotalWaitSeconds"]),
    "metric_backup": ("Collect-Backups", "BackupCompliance", "BackupComplianceSummary", 2,
        ["DatabaseCount", "DatabasesWithoutFullBackup", "DatabasesWithOldFullBackup",
         "DatabasesWithOldDiffBackup", "RecoveryModelViolations", "DatabasesWithoutRequiredLogBackup",
         "DatabasesWithOldRequiredLogBackup", "NonCompliantDatabaseCount", "MaxFullBackupAgeHours",
         "MaxLogBackupAgeHours"]),
    "metric_legacy_backup": ("Collect-Backups", "Backup", "BackupSummary", 3,
        ["DatabasesWithoutFullBackup", "DatabasesWithOldFullBackup",
         "FullRecoveryDatabasesWithoutLogBackup", "FullRecoveryDatabasesWithOldLogBackup"]),
    "metric_query_stats": ("Collect-QueryStats", "QueryStats", "QueryStatsSummary", 26,
        ["TopCpuQueryCount", "TopDurationQueryCount", "TopLogicalReadQueryCount",
         "TopExecutionQueryCount", "DistinctQueriesCaptured"]),
    "metric_agent_jobs": ("Collect-SqlAgentJobs", "SqlAgentJob", "SqlAgentJobSummary", 2,
        ["RecentFailedJobs", "RecentCanceledJobs", "RecentRetryJobs", "RecentSucceededJobs",
         "RecentCompletedJobs", "TotalEnabledJobs", "TotalDisabledJobs", "RunningJobCount",
         "MaxRunningSeconds", "MaxRunDurationSeconds", "AvgRunDurationSeconds"]),
    "metric_agent_alerts": ("Collect-SqlAgentAlerts", "SqlAgentAlert", "SqlAgentAlertSummary", 2,
        ["TotalAlerts", "AlertsTriggeredRecently", "AlertsWithoutNotifications"]),
    "metric_requests": ("Collect-ActiveRequests", "ActiveRequest", "ActiveRequestSummary", 40,
        ["ActiveRequestCount", "BlockedRequestCount", "WaitingRequestCount"]),
}


def _summary(collector: str, category: str, obj: str, modulus: int, counters: list[str]) -> str:
    k = len(counters)
    names = " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(counters))
    small = 7 if modulus > 7 else modulus
    return f"""
SELECT max(event_id) AS MetricSnapshotId, cast(user_id + 2 AS int) AS InstanceId,
       {_DAY} AS CaptureTime, cast(NULL AS string) AS DatabaseName, '{obj}' AS ObjectName,
       CASE event_id % {k} {names} END AS CounterName, cast(NULL AS string) AS InstanceName,
       '{category}' AS MetricCategory,
       cast(max(CASE WHEN event_id % {k} < 2 THEN floor(value) % {small}
                     ELSE floor(value) % {modulus} END) AS decimal(28,6)) AS MetricValue,
       'Gauge' AS MetricType, 'count' AS Unit, '{collector}' AS SourceCollector
FROM {{events}} GROUP BY 2, 3, 6"""


_METRIC_COLUMNS = (
    "MetricSnapshotId, InstanceId, CaptureTime, DatabaseName, ObjectName, CounterName, InstanceName, "
    "MetricCategory, MetricValue, MetricType, Unit, SourceCollector"
)
_FAMILIES = ["metric_performance", *_SUMMARIES, "metric_waits", "metric_file_io"]

# Every member of every wait class, and two locks.
_CLASSED_WAITS = ["LCK_M_X", "LCK_M_S", *(w for _, exact, _ in fv.WAIT_CLASSES for w in exact), "WRITELOG"]


def _one_of(number: str, names: list[str]) -> str:
    """The name at the number, counted around."""
    cases = " ".join(f"WHEN {i} THEN '{name}'" for i, name in enumerate(names))
    return f"CASE {number} % {len(names)} {cases} END"


MAPPINGS: dict[str, str] = {name: _summary(*spec) for name, spec in _SUMMARIES.items()}

MAPPINGS["monitored_instances"] = """
SELECT cast(s.s_suppkey AS int) AS InstanceId, s.s_name AS InstanceName, r.r_name AS EnvironmentName,
       s.s_suppkey % 10 <> 9 AS IsEnabled, 'Standard' AS CollectionProfile,
       CASE WHEN s.s_suppkey % 3 = 0 THEN 'V2_FULL' WHEN s.s_suppkey % 7 = 1 THEN ''
            WHEN s.s_suppkey % 11 = 2 THEN NULL ELSE 'V1_SIMPLE' END AS ComplianceProfile,
       concat('16.0.', cast(s.s_suppkey % 5 AS string)) AS SqlVersion, 'Standard Edition' AS Edition,
       CASE s.s_suppkey % 4 WHEN 0 THEN 'primary' WHEN 1 THEN '' ELSE NULL END AS Notes,
       {TS} '2001-01-01 00:00:00' AS CreatedAt, cast(NULL AS {TS}) AS ModifiedAt
FROM {supplier} s JOIN {nation} n ON n.n_nationkey = s.s_nationkey
JOIN {region} r ON r.r_regionkey = n.n_regionkey"""

MAPPINGS["metric_performance"] = f"""
SELECT event_id AS MetricSnapshotId, cast(user_id + 2 AS int) AS InstanceId, {_SECOND} AS CaptureTime,
       cast(NULL AS string) AS DatabaseName,
       CASE WHEN event_id % 9 BETWEEN 5 AND 7 THEN 'CPU' ELSE 'SQLServer:General' END AS ObjectName,
       CASE event_id % 9 WHEN 0 THEN 'Memory Grants Pending' WHEN 1 THEN 'Target Server Memory (KB)'
            WHEN 2 THEN 'Total Server Memory (KB)' WHEN 3 THEN 'Page life expectancy'
            WHEN 4 THEN 'Number of Deadlocks/sec' WHEN 5 THEN 'SqlProcessCpuPercent'
            WHEN 6 THEN 'SystemCpuPercent' WHEN 7 THEN 'SystemIdlePercent'
            ELSE 'User Connections' END AS CounterName,
       CASE WHEN event_id % 9 = 4 THEN '_Total' WHEN event_id % 9 = 3 THEN '' END AS InstanceName,
       'PerformanceCounter' AS MetricCategory,
       cast(CASE WHEN event_id % 9 IN (0, 4) THEN floor(value) % 8
                 ELSE floor(value * 7) % 101 END AS decimal(28,6)) AS MetricValue,
       CASE WHEN event_id % 9 = 4 THEN 'Cumulative' ELSE 'Gauge' END AS MetricType, 'count' AS Unit,
       'Collect-PerformanceCounters' AS SourceCollector
FROM {{events}}"""

MAPPINGS["metric_waits"] = f"""
SELECT MetricSnapshotId, InstanceId, CaptureTime, cast(NULL AS string) AS DatabaseName,
       'SQLWaitStats' AS ObjectName, 'WaitTimeMs' AS CounterName, WaitType AS InstanceName,
       'WaitStats' AS MetricCategory,
       cast(sum(v) OVER (PARTITION BY InstanceId, WaitType,
            CASE WHEN InstanceId % 2 = 1 AND CaptureTime >= {{TS}} '2024-01-25 00:00:00' THEN 1 ELSE 0 END
            ORDER BY CaptureTime) * 100000 AS decimal(28,6)) AS MetricValue,
       'Cumulative' AS MetricType, 'ms' AS Unit, 'Collect-WaitStats' AS SourceCollector
FROM (SELECT max(event_id) AS MetricSnapshotId, cast(user_id + 2 AS int) AS InstanceId, {_DAY} AS CaptureTime,
         {_one_of("event_id", [*_CLASSED_WAITS, "OTHER_WAIT"])} AS WaitType,
         sum(cast(value AS decimal(16,6))) AS v
      FROM {{events}} GROUP BY 2, 3, 4) d"""

MAPPINGS["metric_file_io"] = f"""
SELECT max(event_id) AS MetricSnapshotId, cast(user_id + 2 AS int) AS InstanceId, {_DAY} AS CaptureTime,
       concat('db', cast(event_id % 4 AS string)) AS DatabaseName, 'DatabaseFileIO' AS ObjectName,
       CASE event_id % 3 WHEN 0 THEN 'NumReads' WHEN 1 THEN 'NumWrites' ELSE 'IoStallTotalMs' END AS CounterName,
       concat('file_id_', cast(event_id % 2 AS string)) AS InstanceName, 'DatabaseIO' AS MetricCategory,
       cast(max(floor(value * 10)) AS decimal(28,6)) AS MetricValue, 'Cumulative' AS MetricType,
       CASE event_id % 3 WHEN 2 THEN 'ms' ELSE 'count' END AS Unit, 'Collect-DatabaseIO' AS SourceCollector
FROM {{events}} GROUP BY 2, 3, 4, 6, 7, 11"""

MAPPINGS["metric_snapshot"] = (
    f"SELECT {_METRIC_COLUMNS}, CaptureTime AS CreatedAt, cast(CaptureTime AS date) AS capture_date FROM (\n"
    + "\nUNION ALL\n".join(f"SELECT {_METRIC_COLUMNS} FROM {{{f}}}" for f in _FAMILIES)
    + "\n) f"
)

MAPPINGS["metric_text_snapshot"] = """
SELECT MetricTextSnapshotId, InstanceId, CaptureTime, DatabaseName, MetricCategory, DetailType, Severity,
       NumericValue1, NumericValue2, Details, cast(NULL AS string) AS XmlDetails, SourceCollector,
       CaptureTime AS CreatedAt, cast(CaptureTime AS date) AS capture_date
FROM (SELECT doc_id AS MetricTextSnapshotId, cast(doc_id % 12 AS int) AS InstanceId,
       {TS} '2024-01-01 00:00:00' + (doc_id % 700) * interval '1' hour AS CaptureTime,
       concat('db', cast(doc_id % 5 AS string)) AS DatabaseName,
       CASE doc_id % 3 WHEN 0 THEN 'BackupCompliance' WHEN 1 THEN 'QueryStats' ELSE 'WaitStats' END AS MetricCategory,
       CASE doc_id % 3 WHEN 0 THEN 'Collect-Backups' WHEN 1 THEN 'Collect-QueryStats'
            ELSE 'Collect-WaitStats' END AS SourceCollector,
       CASE floor(doc_id / 3) % 6 WHEN 0 THEN 'MissingFullBackup' WHEN 1 THEN 'MissingLogBackup'
            WHEN 2 THEN 'OldFullBackup' WHEN 3 THEN 'OldLogBackup' WHEN 4 THEN 'RecoveryModelMismatch'
            ELSE 'OK' END AS DetailType,
       CASE doc_id % 4 WHEN 0 THEN 'Critical' WHEN 1 THEN 'Warning' ELSE 'Info' END AS Severity,
       cast(n_chars % 977 AS decimal(28,6)) AS NumericValue1, cast(n_chars % 89 AS decimal(28,6)) AS NumericValue2,
       text AS Details
FROM {documents}) d"""

MAPPINGS["collection_run_history"] = """
SELECT o_orderkey AS CollectionRunId, concat('Collector', cast(o_orderkey % 10 AS string)) AS CollectorName,
       cast(o_custkey % 10 AS int) AS InstanceId, StartedAt, FinishedAt, Status,
       CASE WHEN Status = 'Running' THEN NULL ELSE cast(o_orderkey % 500 AS int) END AS RowsCollected,
       CASE WHEN Status = 'Running' THEN NULL ELSE cast(o_orderkey % 300 * 1000 AS int) END AS DurationMs,
       CASE WHEN Status IN ('Failed', 'Error') THEN concat('timeout ', cast(o_orderkey % 7 AS string)) END AS ErrorMessage,
       StartedAt AS CreatedAt
FROM (SELECT o_orderkey, o_custkey, StartedAt,
             CASE WHEN k % 7 = 5 THEN NULL ELSE StartedAt + (o_orderkey % 300) * interval '1' second END AS FinishedAt,
             CASE WHEN o_custkey % 10 = 4 AND o_orderkey % 10 = 3 AND k % 7 <> 5 THEN 'Failed'
                  ELSE CASE k % 7 WHEN 2 THEN 'Failed' WHEN 3 THEN 'Error' WHEN 4 THEN 'Completed'
                                  WHEN 5 THEN 'Running' ELSE 'Success' END END AS Status
      FROM (SELECT o_orderkey, o_custkey, cast(floor(o_orderkey / 10) AS bigint) AS k,
                   {TS} '2001-08-02 00:00:00' - ((o_orderkey % 10) * (o_custkey % 10) * 3000
                        + (o_orderkey * 37) % 5000 + 1) * interval '1' second AS StartedAt
            FROM {orders}) r) s"""

MAPPINGS["run_events"] = """
SELECT CollectionRunId, 'start' AS EventType, StartedAt AS EventTime, CollectorName, InstanceId,
       'Running' AS Status, cast(NULL AS int) AS RowsCollected, cast(NULL AS string) AS ErrorMessage
FROM {collection_run_history}
UNION ALL
SELECT CollectionRunId, 'finish' AS EventType, FinishedAt AS EventTime, cast(NULL AS string) AS CollectorName,
       cast(NULL AS int) AS InstanceId, CASE WHEN ErrorMessage IS NULL THEN 'Success' ELSE 'Failed' END AS Status,
       RowsCollected, ErrorMessage
FROM {collection_run_history} WHERE FinishedAt IS NOT NULL"""

MAPPINGS["registrations"] = """
SELECT concat('Supplier#', lpad(cast(c_custkey * 2 AS string), 9, '0')) AS InstanceName,
       c_mktsegment AS EnvironmentName, 'Standard' AS CollectionProfile,
       CASE WHEN c_nationkey % 2 = 0 THEN 'V2_FULL' ELSE 'V1_SIMPLE' END AS ComplianceProfile,
       '17.0' AS SqlVersion, 'Enterprise Edition' AS Edition, c_name AS Notes
FROM {customer}"""

MAPPINGS["state_changes"] = """
SELECT s.s_name AS InstanceName, CASE WHEN n.n_regionkey = 1 THEN NULL WHEN s.s_acctbal < 0 THEN 'Disable' ELSE 'Enable' END AS State,
       CASE WHEN n.n_regionkey = 2 THEN '' ELSE 'patch window' END AS Reason
FROM {supplier} s JOIN {nation} n ON n.n_nationkey = s.s_nationkey"""

MAPPINGS["capture_roster"] = f"""
SELECT InstanceId, {{TS}} '2024-01-31 00:00:00' AS CaptureTime FROM {{monitored_instances}} WHERE IsEnabled
UNION
SELECT cast(user_id % 10 AS int) AS InstanceId, {_MONTH} AS CaptureTime FROM {{events}}"""

MAPPINGS["landing_roster"] = f"SELECT InstanceId, {_LANDED} FROM {{monitored_instances}} WHERE IsEnabled"

MAPPINGS["raw_counters"] = f"""
SELECT cast(user_id % 10 AS int) AS InstanceId, {_SECOND} AS CaptureTime, 'SQLServer:Counters' AS object_name,
       CASE event_id % 19 WHEN 0 THEN 'Batch Requests/sec' WHEN 1 THEN 'SQL Compilations/sec'
            WHEN 2 THEN 'SQL Re-Compilations/sec' WHEN 3 THEN 'User Connections' WHEN 4 THEN 'Logins/sec'
            WHEN 5 THEN 'Logouts/sec' WHEN 6 THEN 'Lock Waits/sec' WHEN 7 THEN 'Number of Deadlocks/sec'
            WHEN 8 THEN 'Page reads/sec' WHEN 9 THEN 'Page writes/sec' WHEN 10 THEN 'Lazy Writes/sec'
            WHEN 11 THEN 'Checkpoint pages/sec' WHEN 12 THEN 'Memory Grants Pending'
            WHEN 13 THEN 'Target Server Memory (KB)' WHEN 14 THEN 'Total Server Memory (KB)'
            WHEN 15 THEN 'Page life expectancy' WHEN 16 THEN 'Page Splits/sec'
            WHEN 17 THEN 'Buffer cache hit ratio' ELSE 'Cache Object Counts' END AS counter_name,
       CASE event_id % 4 WHEN 0 THEN '' WHEN 1 THEN '   ' WHEN 2 THEN '_Total' ELSE NULL END AS instance_name,
       CASE WHEN user_id = 17 AND event_type = 'error' THEN NULL ELSE cast(floor(value * 100) AS bigint) END AS cntr_value,
       65792 AS cntr_type
FROM {{events}}"""

MAPPINGS["raw_ring_buffer"] = f"""
SELECT cast(user_id % 10 AS int) AS InstanceId, {_MONTH} AS CaptureTime,
       CASE WHEN event_id % 4 = 3 THEN 'RING_BUFFER_RESOURCE_MONITOR'
            ELSE 'RING_BUFFER_SCHEDULER_MONITOR' END AS ring_buffer_type, event_id AS ts,
       CASE WHEN event_id % 5 = 0 THEN '<Record><SchedulerMonitorEvent></SchedulerMonitorEvent></Record>'
            WHEN event_id % 7 = 0 THEN concat('<Record><SchedulerMonitorEvent><SystemHealth><SystemIdle>',
                 cast(cast(floor(value) AS bigint) % 101 AS string), '</SystemIdle></SystemHealth></SchedulerMonitorEvent></Record>')
            ELSE concat('<Record><SchedulerMonitorEvent><SystemHealth><ProcessUtilization>',
                 cast(cast(floor(value * 3) AS bigint) % 101 AS string), '</ProcessUtilization><SystemIdle>',
                 cast(cast(floor(value) AS bigint) % 101 AS string),
                 '</SystemIdle></SystemHealth></SchedulerMonitorEvent></Record>') END AS record
FROM {{events}}"""

MAPPINGS["raw_sessions"] = f"""
SELECT cast(user_id % 10 AS int) AS InstanceId, {_MONTH} AS CaptureTime, event_id AS session_id,
       CASE WHEN event_id % 41 = 0 THEN NULL WHEN event_id % 4 = 1 THEN upper(event_type) WHEN event_id % 7 = 2 THEN concat(event_type, ' ')
            ELSE event_type END AS login_name,
       CASE WHEN event_id % 137 = 0 THEN '' WHEN event_id % 139 = 0 THEN '  '
            ELSE concat(CASE WHEN event_id % 3 = 0 THEN 'HOST' ELSE 'host' END, cast(event_id % 137 AS string)) END AS host_name,
       CASE event_id % 6 WHEN 0 THEN CASE WHEN event_id % 4 = 0 THEN 'DbaTools Module' ELSE 'dbatools module' END
            WHEN 1 THEN 'PowerShell' WHEN 2 THEN '' WHEN 3 THEN NULL
            ELSE concat('app', cast(event_id % 11 AS string), CASE WHEN event_id % 5 = 2 THEN '  ' ELSE '' END) END AS program_name,
       cast(event_id % 12 AS int) AS database_id,
       CASE WHEN event_id % 12 > 9 THEN NULL ELSE concat('db', cast(event_id % 12 AS string)) END AS database_name,
       event_id % 9 <> 0 AS is_user_process
FROM {{events}}"""

def _requests(request: int, extra: str) -> str:
    return f"""
SELECT cast(e.user_id % 10 AS int) AS InstanceId, {_MONTH} AS CaptureTime,
       CASE WHEN e.event_id % 50 = 7 THEN e.event_id + 1000000000 ELSE e.event_id END AS session_id,
       {request} AS request_id,
       CASE WHEN e.event_id % 8 = 3 THEN e.event_id - 1 - e.event_id % 3
            WHEN e.event_id % 8 = 5 THEN NULL ELSE 0 END AS blocking_session_id,
       CASE WHEN e.event_id % 12 > 9 THEN NULL
            ELSE concat(CASE WHEN e.event_id % 7 = 3 THEN 'DB' ELSE 'db' END, cast(e.event_id % 12 AS string)) END AS database_name,
       CASE WHEN e.event_id % 3 = 0 THEN 'suspended' ELSE 'running' END AS status,
       CASE WHEN e.event_id % 13 = 0 THEN NULL ELSE 'SELECT' END AS command,
       CASE WHEN e.event_id % 5 < 3 THEN NULL ELSE 'LCK_M_S' END AS wait_type,
       CASE WHEN e.event_id % 5 = 0 THEN NULL ELSE cast(floor(e.value * {977 + request}) AS bigint) % 20000 END AS wait_time,
       cast(floor(e.value * {613 + request}) AS bigint) % 15000 AS cpu_time,
       cast(floor(e.value * {1999 + request}) AS bigint) % 60000 AS total_elapsed_time,
       cast(floor(e.value * 7919) AS bigint) % 200000 AS logical_reads,
       cast(floor(e.value * 331) AS bigint) % 15000 AS reads, cast(floor(e.value * 107) AS bigint) % 12000 AS writes,
       cast(e.event_id % 400 AS double) / 4 AS percent_complete, d.text AS sql_text
FROM {{events}} e LEFT JOIN {{documents}} d ON d.doc_id = cast(floor(e.event_id / 9) AS bigint) + {request}{extra}"""


# Every tenth session runs a second request, with another statement.
MAPPINGS["raw_requests"] = _requests(0, "") + "\nUNION ALL" + _requests(1, "\nWHERE e.event_id % 10 = 1")

MAPPINGS["raw_waits"] = f"""
SELECT cast(user_id % 10 AS int) AS InstanceId, {_MONTH} AS CaptureTime,
       CASE WHEN event_id % 3 = 0 THEN {_one_of("cast(floor(event_id / 3) AS bigint)", fv.BENIGN_WAITS)}
            WHEN event_id % 3 = 1 THEN {_one_of("cast(floor(event_id / 3) AS bigint)", _CLASSED_WAITS)}
            ELSE concat('WT_', cast(event_id % 61 AS string)) END AS wait_type,
       cast(count(*) AS bigint) AS waiting_tasks_count,
       cast(sum(CASE WHEN value < 2 THEN 0 ELSE cast(floor(value * 100) AS bigint) END) AS bigint) AS wait_time_ms,
       cast(sum(CASE WHEN value < 2 THEN 0 ELSE cast(floor(value * 31) AS bigint) END) AS bigint) AS signal_wait_time_ms,
       cast(max(cast(floor(value * 100) AS bigint)) AS bigint) AS max_wait_time_ms
FROM {{events}} GROUP BY 1, 2, 3"""

MAPPINGS["raw_file_io"] = f"""
SELECT InstanceId, CaptureTime, database_id, file_id, num_of_reads, num_of_writes,
       num_of_reads * 8192 AS num_of_bytes_read, num_of_writes * 4096 AS num_of_bytes_written,
       io_stall_read_ms, io_stall_write_ms, io_stall_read_ms + io_stall_write_ms AS io_stall
FROM (SELECT cast(l_suppkey AS int) AS InstanceId, {_LANDED}, cast(l_partkey % 40 AS int) AS database_id,
       l_linenumber AS file_id,
       cast(sum(CASE WHEN l_returnflag = 'A' THEN cast(floor(l_quantity) AS bigint) ELSE 0 END) AS bigint) AS num_of_reads,
       cast(sum(CASE WHEN l_returnflag = 'R' THEN cast(floor(l_quantity) AS bigint) ELSE 0 END) AS bigint) AS num_of_writes,
       cast(sum(CASE WHEN l_returnflag = 'A' THEN cast(floor(l_extendedprice / 100) AS bigint) ELSE 0 END) AS bigint) AS io_stall_read_ms,
       cast(sum(CASE WHEN l_returnflag = 'R' THEN cast(floor(l_extendedprice / 100) AS bigint) ELSE 0 END) AS bigint) AS io_stall_write_ms
      FROM {{lineitem}} GROUP BY 1, 3, 4) f"""

MAPPINGS["raw_io_databases"] = f"""
SELECT DISTINCT cast(l_suppkey AS int) AS InstanceId, {_LANDED}, cast(l_partkey % 40 AS int) AS database_id,
       concat('db', cast(l_partkey % 40 AS string)) AS name,
       CASE WHEN l_partkey % 40 = 18 THEN 'OFFLINE' ELSE 'ONLINE' END AS state_desc,
       CASE WHEN l_partkey % 40 = 21 THEN 1 END AS source_database_id
FROM {{lineitem}}"""

MAPPINGS["raw_query_stats"] = f"""
SELECT cast(l_suppkey % 10 AS int) AS InstanceId, {_LANDED}, cast(floor(l_partkey / 2) AS bigint) AS sql_handle,
       l_partkey * 100000 + l_suppkey AS plan_handle,
       CASE WHEN l_partkey % 29 = 0 THEN NULL ELSE concat('0x', lpad(hex(l_partkey % 1500), 16, '0')) END AS query_hash,
       concat('0x', lpad(hex(l_suppkey % 50), 16, '0')) AS query_plan_hash,
       CASE WHEN l_partkey % 7 = 0 THEN NULL ELSE concat('db', cast(l_partkey % 7 AS string)) END AS database_name,
       cast(sum(cast(floor(l_quantity) AS bigint)) AS bigint) AS execution_count,
       cast(sum(cast(floor(l_extendedprice * 10) AS bigint)) AS bigint) AS total_worker_time,
       cast(sum(cast(floor(l_extendedprice * 17) AS bigint)) AS bigint) AS total_elapsed_time,
       cast(sum(cast(l_linenumber AS bigint) * 1000) AS bigint) AS total_logical_reads,
       cast(sum(cast(l_linenumber AS bigint) * 10) AS bigint) AS total_physical_reads,
       cast(sum(cast(l_linenumber AS bigint) * 7) AS bigint) AS total_logical_writes,
       min(l_shipdate) AS creation_time, max(l_shipdate) AS last_execution_time
FROM {{lineitem}} GROUP BY l_partkey, l_suppkey"""

MAPPINGS["raw_query_text"] = """
SELECT doc_id AS sql_handle,
       CASE WHEN doc_id % 23 = 0 THEN concat('INSERT INTO dbo.MetricSnapshot ', text) ELSE text END AS sql_text
FROM {documents}"""

MAPPINGS["raw_databases"] = f"""
SELECT c_nationkey AS InstanceId, {_LANDED}, cast(c_custkey AS int) AS database_id,
       CASE WHEN c_custkey % 400 = 2 THEN 'tempdb' ELSE c_name END AS name,
       CASE WHEN c_custkey % 20 = 7 THEN 'OFFLINE' ELSE 'ONLINE' END AS state_desc,
       CASE c_mktsegment WHEN 'MACHINERY' THEN 'FULL' WHEN 'HOUSEHOLD' THEN 'FULL'
            WHEN 'FURNITURE' THEN 'BULK_LOGGED' ELSE 'SIMPLE' END AS recovery_model_desc
FROM {{customer}}"""

MAPPINGS["raw_backupset"] = f"""
SELECT c.c_nationkey AS InstanceId, {_LANDED}, c.c_name AS database_name,
       CASE o_orderstatus WHEN 'F' THEN 'D' WHEN 'O' THEN 'I' ELSE CASE o_orderkey % 9 WHEN 0 THEN 'F' ELSE 'L' END END AS type,
       o_orderdate + (o_orderkey % 40000) * interval '1' second AS backup_start_date,
       o_orderdate + (o_orderkey % 40000 + o_orderkey % 3600) * interval '1' second AS backup_finish_date,
       cast(floor(o_totalprice * 1024) AS bigint) AS backup_size,
       cast(floor(o_totalprice * 512) AS bigint) AS compressed_backup_size, o_orderkey AS media_set_id
FROM {{orders}} JOIN {{customer}} c ON c.c_custkey = o_custkey"""

MAPPINGS["raw_backupmedia"] = f"""
SELECT c.c_nationkey AS InstanceId, {_LANDED},
       CASE WHEN o_orderkey % 5 = 0 THEN -1 - o_orderkey ELSE o_orderkey END AS media_set_id,
       concat('dev', cast(o_orderkey % 7 AS string)) AS physical_device_name
FROM {{orders}} JOIN {{customer}} c ON c.c_custkey = o_custkey"""

MAPPINGS["raw_jobs"] = f"""
SELECT cast(c_custkey % 10 AS int) AS InstanceId, {_LANDED}, c_custkey AS job_id, c_name AS name,
       CASE WHEN c_mktsegment = 'BUILDING' THEN 0 ELSE 1 END AS enabled
FROM {{customer}}"""

MAPPINGS["raw_job_history"] = f"""
SELECT cast(o_custkey % 10 AS int) AS InstanceId, {_LANDED}, o_orderkey AS instance_id, o_custkey AS job_id,
       CASE WHEN o_orderkey % 5 = 0 THEN 1 ELSE 0 END AS step_id, 'step' AS step_name, cast(o_orderkey % 6 AS int) AS run_status,
       cast(CASE WHEN o_orderkey % 97 = 0 THEN 20010230
            ELSE year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) END AS int) AS run_date,
       cast((o_orderkey * 7919) % 24 * 10000 + (o_orderkey % 60) * 100 + (o_orderkey * 13) % 60 AS int) AS run_time,
       cast((o_orderkey % 3) * 10000 + (o_orderkey % 60) * 100 + o_orderkey % 59 AS int) AS run_duration,
       CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE concat('The job ran with priority ', o_orderpriority) END AS message
FROM {{orders}}"""

MAPPINGS["raw_job_activity"] = f"""
SELECT cast(o_custkey % 10 AS int) AS InstanceId, {_LANDED}, o_custkey AS job_id, o_orderkey % 3 AS session_id,
       CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderdate + (o_orderkey % 86400) * interval '1' second END AS start_execution_date,
       CASE WHEN o_orderstatus = 'O' THEN NULL ELSE o_orderdate + (o_orderkey % 86400 + 60) * interval '1' second END AS stop_execution_date
FROM {{orders}}"""

MAPPINGS["raw_agent_sessions"] = f"""
SELECT DISTINCT cast(o_custkey % 10 AS int) AS InstanceId, {_LANDED}, o_orderkey % 3 AS session_id FROM {{orders}}"""

MAPPINGS["raw_alerts"] = f"""
SELECT cast(o_orderkey % 10 AS int) AS InstanceId, {_LANDED}, o_orderkey AS id,
       concat(o_orderpriority, ' ', cast(o_custkey AS string)) AS name,
       CASE WHEN o_orderstatus = 'P' THEN 0 ELSE 1 END AS enabled,
       CASE o_custkey % 11 WHEN 0 THEN 823 WHEN 1 THEN 9001 WHEN 2 THEN 1205 ELSE 0 END AS message_id,
       cast(cast(floor(o_totalprice) AS bigint) % 26 AS int) AS severity,
       CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE concat('db', cast(o_orderkey % 4 AS string)) END AS database_name,
       CASE WHEN o_orderkey % 6 = 0 THEN 'disk' END AS event_description_keyword, 60 AS delay_between_responses,
       CASE WHEN o_orderkey % 9 = 0 THEN 0 ELSE
            cast(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) AS int) END AS last_occurrence_date,
       cast((o_orderkey * 37) % 24 * 10000 + (o_orderkey % 60) * 100 AS int) AS last_occurrence_time,
       CASE WHEN o_orderkey % 8 = 1 THEN NULL WHEN o_orderkey % 8 = 2 THEN 20010231 ELSE
            cast(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) AS int) END AS last_response_date,
       cast((o_orderkey * 11) % 24 * 10000 + (o_orderkey % 60) AS int) AS last_response_time,
       CASE WHEN o_orderkey % 10 = 5 THEN NULL ELSE cast(o_custkey % 4 AS int) END AS occurrence_count,
       0 AS count_reset_date, 0 AS count_reset_time
FROM {{orders}}"""

MAPPINGS["raw_notifications"] = f"""
SELECT DISTINCT cast(l_orderkey % 10 AS int) AS InstanceId, {_LANDED}, l_orderkey AS alert_id, l_suppkey AS operator_id,
       CASE WHEN l_linenumber = 6 THEN NULL ELSE l_linenumber END AS notification_method
FROM {{lineitem}}"""

MAPPINGS["raw_operators"] = f"""
SELECT DISTINCT cast(l.l_orderkey % 10 AS int) AS InstanceId, {_LANDED},
       CASE WHEN s.s_suppkey % 10 = 3 THEN -1 - s.s_suppkey ELSE s.s_suppkey END AS id, s.s_name AS name
FROM {{lineitem}} l JOIN {{supplier}} s ON s.s_suppkey = l.l_suppkey"""
