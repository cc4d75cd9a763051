"""Counters, connections, blocking, waits, file I/O and active requests."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

# --- counters ------------------------------------------------------------------------------------

_WHITELIST = """('Batch Requests/sec','SQL Compilations/sec','SQL Re-Compilations/sec','User Connections',
 'Logins/sec','Logouts/sec','Lock Waits/sec','Number of Deadlocks/sec','Page reads/sec','Page writes/sec',
 'Lazy Writes/sec','Checkpoint pages/sec','Memory Grants Pending','Target Server Memory (KB)',
 'Total Server Memory (KB)','Page life expectancy')"""

ORACLES["c1_counter_whitelist"] = "SELECT * FROM {raw_counters} WHERE counter_name IN " + _WHITELIST

ORACLES["c2_metric_type"] = """
SELECT InstanceId, CaptureTime, counter_name AS CounterName, cntr_value::DECIMAL(28,6) AS MetricValue,
       if(list_contains(['User Connections','Memory Grants Pending','Target Server Memory (KB)',
          'Total Server Memory (KB)','Page life expectancy'], counter_name), 'Gauge', 'Cumulative') AS MetricType
FROM {raw_counters} WHERE cntr_value IS NOT NULL AND counter_name IN """ + _WHITELIST

ORACLES["c3_unit_and_sub_instance"] = """
SELECT InstanceId, CaptureTime, counter_name AS CounterName,
       if(instance_name IS NULL OR trim(instance_name) = '', NULL, instance_name) AS InstanceName,
       CASE counter_name WHEN 'Page life expectancy' THEN 'sec' WHEN 'Target Server Memory (KB)' THEN 'KB'
            WHEN 'Total Server Memory (KB)' THEN 'KB' ELSE 'count' END AS Unit
FROM {raw_counters} WHERE cntr_value IS NOT NULL AND counter_name IN """ + _WHITELIST

_CPU = """WITH newest AS (
  SELECT InstanceId, CaptureTime, arg_max(record, ts) AS record FROM {raw_ring_buffer}
  WHERE ring_buffer_type = 'RING_BUFFER_SCHEDULER_MONITOR' AND contains(record, '<SystemHealth>') GROUP BY ALL),
sample AS (
  SELECT InstanceId, CaptureTime,
         nullif(regexp_extract(record, '<ProcessUtilization>(\\d+)<', 1), '')::INT AS p,
         nullif(regexp_extract(record, '<SystemIdle>(\\d+)<', 1), '')::INT AS i FROM newest)
"""
ORACLES["c4_cpu_sample"] = _CPU + """
SELECT InstanceId, CaptureTime, p AS SqlProcessCpuPercent, i AS SystemIdlePercent, 100 - i AS SystemCpuPercent FROM sample"""
ORACLES["c5_cpu_metrics"] = _CPU + """
SELECT InstanceId, CaptureTime, NULL::VARCHAR AS DatabaseName, 'CPU' AS ObjectName, CounterName,
       NULL::VARCHAR AS InstanceName, 'PerformanceCounter' AS MetricCategory, v::DECIMAL(28,6) AS MetricValue,
       'Gauge' AS MetricType, 'percent' AS Unit, 'Collect-PerformanceCounters' AS SourceCollector
FROM (SELECT InstanceId, CaptureTime, p AS SqlProcessCpuPercent, 100 - i AS SystemCpuPercent, i AS SystemIdlePercent FROM sample)
UNPIVOT (v FOR CounterName IN (SqlProcessCpuPercent, SystemCpuPercent, SystemIdlePercent))"""

# --- connections ---------------------------------------------------------------------------------

ORACLES["c6_session_summary"] = """
WITH s AS (SELECT InstanceId, CaptureTime, count(*) AS n, count(DISTINCT nullif(lower(rtrim(login_name)), '')) AS l,
                  count(DISTINCT nullif(lower(rtrim(host_name)), '')) AS h, count(DISTINCT nullif(lower(rtrim(program_name)), '')) AS a
           FROM {raw_sessions} WHERE is_user_process GROUP BY ALL)
SELECT InstanceId, CaptureTime, coalesce(n, 0)::BIGINT AS TotalUserSessions, coalesce(l, 0)::BIGINT AS DistinctLogins,
       coalesce(h, 0)::BIGINT AS DistinctHosts, coalesce(a, 0)::BIGINT AS DistinctApplications
FROM {capture_roster} LEFT JOIN s USING (InstanceId, CaptureTime)"""


def _breakdown(kind: str, key: str, label: str) -> str:
    return f"""
SELECT InstanceId, CaptureTime, '{kind}' AS BreakdownType, {label} AS BreakdownValue, n::BIGINT AS SessionCount,
       (row_number() OVER (PARTITION BY InstanceId, CaptureTime ORDER BY n DESC, k::VARCHAR NULLS FIRST))::INT AS rn
FROM (SELECT InstanceId, CaptureTime, lower(rtrim({key}::VARCHAR)) AS k, min({key}::VARCHAR) AS s, max(database_name) AS d,
             count(*) AS n FROM {{raw_sessions}}
      WHERE is_user_process GROUP BY 1, 2, 3 HAVING count(*) > 1) g
QUALIFY rn <= 100"""


ORACLES["c7_sessions_by_login"] = _breakdown("Login", "login_name", "if(k <> '', s, '(blank)')")
ORACLES["c8_sessions_by_host"] = _breakdown("Host", "host_name", "if(k <> '', s, '(blank)')")
ORACLES["c9_sessions_by_application"] = _breakdown("Application", "program_name", "if(k <> '', s, '(blank)')")
ORACLES["c10_sessions_by_database"] = _breakdown("Database", "database_id", "coalesce(d, '(unknown)')")

# --- blocking ------------------------------------------------------------------------------------

_FOREIGN = """foreign_sessions AS (
  SELECT InstanceId, CaptureTime, session_id, login_name, host_name, program_name FROM {raw_sessions}
  WHERE is_user_process AND NOT regexp_matches(lower(coalesce(program_name, '')), 'dbatools|powershell'))"""

_BLOCKED = "WITH " + _FOREIGN + """,
all_blocked AS (
  SELECT *, (coalesce(wait_time, 0)::DECIMAL(18,2) * 0.001::DECIMAL(4,3))::DECIMAL(25,8) AS sec,
         (row_number() OVER (PARTITION BY InstanceId, CaptureTime ORDER BY wait_time DESC NULLS LAST, session_id, request_id))::INT AS rn
  FROM {raw_requests} JOIN foreign_sessions USING (InstanceId, CaptureTime, session_id)
  WHERE blocking_session_id <> 0),
blocked AS (SELECT * FROM all_blocked WHERE rn <= 50)
"""
ORACLES["c11_blocked_requests"] = _BLOCKED + """
SELECT InstanceId, CaptureTime, session_id AS BlockedSessionId, blocking_session_id AS BlockingSessionId,
       database_name AS DatabaseName, wait_type AS WaitType, coalesce(wait_time, 0) AS WaitTimeMs, sec AS WaitSeconds,
       status AS Status, command AS Command, sql_text AS SqlText, login_name AS LoginName,
       host_name AS HostName, program_name AS ProgramName, rn FROM blocked"""
ORACLES["c12_blocking_summary"] = _BLOCKED + """
SELECT r.InstanceId, r.CaptureTime, count(b.session_id) AS BlockedSessionCount,
       count(DISTINCT b.blocking_session_id) AS DistinctBlockingSessionCount,
       coalesce(max(b.sec), 0)::DECIMAL(28,8) AS MaxWaitSeconds, coalesce(sum(b.sec), 0)::DECIMAL(28,8) AS TotalWaitSeconds
FROM {capture_roster} r LEFT JOIN all_blocked b ON b.InstanceId = r.InstanceId AND b.CaptureTime = r.CaptureTime GROUP BY ALL"""
ORACLES["c13_blocking_evidence"] = _BLOCKED + """
SELECT InstanceId, CaptureTime, coalesce(database_name, '(unknown)') AS DatabaseName, 'Blocking' AS MetricCategory,
       'BlockingDetail' AS DetailType, 'Warning' AS Severity, sec::DECIMAL(28,6) AS NumericValue1,
       blocking_session_id::DECIMAL(28,6) AS NumericValue2,
       concat_ws(chr(10), 'BlockedSessionId: ' || session_id, 'BlockingSessionId: ' || blocking_session_id,
         'DatabaseName: ' || coalesce(database_name, '(unknown)'), 'WaitType: ' || coalesce(wait_type, '(unknown)'),
         'WaitTimeMs: ' || coalesce(wait_time, 0), 'WaitSeconds: ' || sec, 'Status: ' || status,
         'Command: ' || coalesce(command, '(unknown)'), 'LoginName: ' || coalesce(login_name, '(unknown)'),
         'HostName: ' || if(regexp_matches(host_name, '\\S'), host_name, '(unknown)'),
         'ProgramName: ' || if(regexp_matches(program_name, '\\S'), program_name, '(unknown)'),
         'SQL text: ' || if(regexp_matches(sql_text, '\\S'), sql_text, '(unavailable)')) AS Details,
       'Collect-Blocking' AS SourceCollector FROM blocked"""

# --- waits ---------------------------------------------------------------------------------------

_WAITS = """WITH ranked AS (
  SELECT InstanceId, CaptureTime, wait_type AS WaitType, waiting_tasks_count AS WaitingTasksCount,
         wait_time_ms AS WaitTimeMs, signal_wait_time_ms AS SignalWaitTimeMs,
         wait_time_ms - signal_wait_time_ms AS ResourceWaitTimeMs, max_wait_time_ms AS MaxWaitTimeMs,
         (row_number() OVER (PARTITION BY InstanceId, CaptureTime ORDER BY wait_time_ms DESC, wait_type))::INT AS rn
  FROM {raw_waits} WHERE wait_time_ms > 0 AND wait_type NOT IN (
    'BROKER_EVENTHANDLER', 'BROKER_RECEIVE_WAITFOR', 'BROKER_TASK_STOP', 'BROKER_TO_FLUSH', 'BROKER_TRANSMITTER',
    'CHECKPOINT_QUEUE', 'CHKPT', 'CLR_AUTO_EVENT', 'CLR_MANUAL_EVENT', 'CLR_SEMAPHORE', 'DBMIRROR_DBM_EVENT',
    'DBMIRROR_EVENTS_QUEUE', 'DBMIRROR_WORKER_QUEUE', 'DIRTY_PAGE_POLL', 'DISPATCHER_QUEUE_SEMAPHORE', 'EXECSYNC',
    'FSAGENT', 'FT_IFTS_SCHEDULER_IDLE_WAIT', 'FT_IFTSHC_MUTEX', 'HADR_CLUSAPI_CALL',
    'HADR_FILESTREAM_IOMGR_IOCOMPLETION', 'HADR_LOGCAPTURE_WAIT', 'HADR_NOTIFICATION_DEQUEUE', 'HADR_TIMER_TASK',
    'HADR_WORK_QUEUE', 'KSOURCE_WAKEUP', 'LAZYWRITER_SLEEP', 'LOGMGR_QUEUE', 'MEMORY_ALLOCATION_EXT',
    'ONDEMAND_TASK_QUEUE', 'PARALLEL_REDO_DRAIN_WORKER', 'PARALLEL_REDO_LOG_CACHE', 'PARALLEL_REDO_TRAN_LIST',
    'PARALLEL_REDO_WORKER_SYNC', 'PARALLEL_REDO_WORKER_WAIT_WORK', 'PREEMPTIVE_OS_FLUSHFILEBUFFERS',
    'PREEMPTIVE_XE_GETTARGETSTATE', 'PWAIT_ALL_COMPONENTS_INITIALIZED', 'PWAIT_DIRECTLOGCONSUMER_GETNEXT',
    'QDS_PERSIST_TASK_MAIN_LOOP_SLEEP', 'QDS_ASYNC_QUEUE', 'QDS_CLEANUP_STALE_QUERIES_TASK_MAIN_LOOP_SLEEP',
    'REQUEST_FOR_DEADLOCK_SEARCH', 'RESOURCE_QUEUE', 'SERVER_IDLE_CHECK', 'SLEEP_BPOOL_FLUSH', 'SLEEP_DBSTARTUP',
    'SLEEP_DCOMSTARTUP', 'SLEEP_MASTERDBREADY', 'SLEEP_MASTERMDREADY', 'SLEEP_MASTERUPGRADED', 'SLEEP_MSDBSTARTUP',
    'SLEEP_SYSTEMTASK', 'SLEEP_TASK', 'SLEEP_TEMPDBSTARTUP', 'SNI_HTTP_ACCEPT', 'SP_SERVER_DIAGNOSTICS_SLEEP',
    'SQLTRACE_BUFFER_FLUSH', 'SQLTRACE_INCREMENTAL_FLUSH_SLEEP', 'SQLTRACE_WAIT_ENTRIES', 'WAIT_FOR_RESULTS',
    'WAITFOR', 'WAITFOR_TASKSHUTDOWN', 'XE_DISPATCHER_JOIN', 'XE_DISPATCHER_WAIT', 'XE_TIMER_EVENT'))
"""
ORACLES["c14_wait_snapshot"] = _WAITS + "SELECT * FROM ranked WHERE rn <= 20"
_WAIT_LONG = _WAITS + """
SELECT InstanceId, CaptureTime, NULL::VARCHAR AS DatabaseName, 'SQLWaitStats' AS ObjectName, CounterName,
       WaitType AS InstanceName, 'WaitStats' AS MetricCategory, v::DECIMAL(28,6) AS MetricValue,
       'Cumulative' AS MetricType, if(CounterName = 'WaitingTasksCount', 'count', 'ms') AS Unit,
       'Collect-WaitStats' AS SourceCollector
FROM ranked UNPIVOT (v FOR CounterName IN (WaitingTasksCount, WaitTimeMs, SignalWaitTimeMs, ResourceWaitTimeMs, MaxWaitTimeMs))"""
ORACLES["c15_wait_metrics"] = _WAIT_LONG
ORACLES["s6_wide_to_long"] = """
SELECT InstanceId, CaptureTime, CounterName, v::DECIMAL(28,6) AS MetricValue,
       if(CounterName = 'waiting_tasks_count', 'count', 'ms') AS Unit
FROM {raw_waits} UNPIVOT (v FOR CounterName IN (waiting_tasks_count, wait_time_ms, signal_wait_time_ms, max_wait_time_ms))"""
ORACLES["s4_metric_sink"] = "SELECT *, CaptureTime AS CreatedAt, CaptureTime::DATE AS capture_date FROM (" + _WAIT_LONG + ")"

# --- file I/O ------------------------------------------------------------------------------------


def _latency(stall: str, operations: str) -> str:
    # Half up to two digits in integer arithmetic.
    return (f"CASE WHEN {operations} = 0 THEN 0 ELSE "
            f"((200 * {stall}::HUGEINT + {operations}) // (2 * {operations})) * 0.01::DECIMAL(3,2) END::DECIMAL(19,2)")


_FILES = """WITH io AS (SELECT *, num_of_reads + num_of_writes AS ops FROM {raw_file_io}),
files AS (
  SELECT io.InstanceId, io.CaptureTime, io.database_id, io.file_id, d.name AS DatabaseName,
         'file_id_' || io.file_id AS LogicalFileName, '(unavailable)' AS PhysicalName, '(unknown)' AS DriveLetter,
         'UNKNOWN' AS FileType, 0::DECIMAL(19,2) AS FileSizeMB, 0::DECIMAL(19,2) AS FileSizeGB,
         num_of_reads::DECIMAL(19,2) AS NumReads, num_of_writes::DECIMAL(19,2) AS NumWrites, ops::DECIMAL(19,2) AS TotalIO,
         num_of_bytes_read::DECIMAL(19,2) AS BytesRead, num_of_bytes_written::DECIMAL(19,2) AS BytesWritten,
         io_stall_read_ms::DECIMAL(19,2) AS IoStallReadMs, io_stall_write_ms::DECIMAL(19,2) AS IoStallWriteMs,
         io_stall::DECIMAL(19,2) AS IoStallTotalMs, """ + f"""
         {_latency('io_stall_read_ms', 'num_of_reads')} AS AvgReadLatencyMs,
         {_latency('io_stall_write_ms', 'num_of_writes')} AS AvgWriteLatencyMs,
         {_latency('io_stall', 'ops')} AS AvgIoLatencyMs""" + """
  FROM io JOIN {raw_io_databases} d USING (InstanceId, CaptureTime, database_id)
  WHERE io.database_id >= 5 AND d.state_desc = 'ONLINE' AND d.source_database_id IS NULL)
"""
_BUSY = _FILES + """, busy AS (
  SELECT *, (row_number() OVER (PARTITION BY InstanceId, CaptureTime
     ORDER BY TotalIO DESC, IoStallTotalMs DESC, AvgIoLatencyMs DESC, database_id, file_id))::INT AS rn
  FROM files WHERE TotalIO > 0 QUALIFY rn <= 25)
"""
_SEVERITY = """if(AvgReadLatencyMs >= 20 OR AvgWriteLatencyMs >= 20, 'Critical',
       if(AvgReadLatencyMs >= 10 OR AvgWriteLatencyMs >= 10, 'Warning', 'Info'))"""
ORACLES["c16_file_stats"] = _FILES + "SELECT * FROM files"
ORACLES["c17_busiest_files"] = _BUSY + "SELECT * FROM busy"
ORACLES["c18_file_metrics"] = _BUSY + """
SELECT InstanceId, CaptureTime, DatabaseName, 'DatabaseFileIO' AS ObjectName, CounterName, LogicalFileName AS InstanceName,
       'DatabaseIO' AS MetricCategory, v::DECIMAL(28,6) AS MetricValue, 'Cumulative' AS MetricType,
       CASE WHEN CounterName = 'FileSizeMB' THEN 'MB' WHEN CounterName = 'FileSizeGB' THEN 'GB'
            WHEN starts_with(CounterName, 'Bytes') THEN 'bytes' WHEN ends_with(CounterName, 'Ms') THEN 'ms' ELSE 'count' END AS Unit,
       'Collect-DatabaseIO' AS SourceCollector
FROM busy UNPIVOT (v FOR CounterName IN (FileSizeMB, FileSizeGB, NumReads, NumWrites, TotalIO, BytesRead, BytesWritten,
     IoStallReadMs, IoStallWriteMs, IoStallTotalMs, AvgReadLatencyMs, AvgWriteLatencyMs, AvgIoLatencyMs))"""
_FILE_EVIDENCE = _BUSY + f"""
SELECT InstanceId, CaptureTime, DatabaseName, 'DatabaseIO' AS MetricCategory, 'DatabaseFileIODetail' AS DetailType,
       {_SEVERITY} AS Severity, AvgIoLatencyMs::DECIMAL(28,6) AS NumericValue1, TotalIO::DECIMAL(28,6) AS NumericValue2,
       array_to_string(['DatabaseName: ' || DatabaseName, 'LogicalFileName: ' || LogicalFileName,
         'PhysicalName: (unavailable)', 'DriveLetter: (unknown)', 'FileType: UNKNOWN', 'FileSizeGB: 0.00',
         'TotalIO: ' || TotalIO, 'AvgReadLatencyMs: ' || AvgReadLatencyMs, 'AvgWriteLatencyMs: ' || AvgWriteLatencyMs,
         'AvgIoLatencyMs: ' || AvgIoLatencyMs], chr(10)) AS Details,
       'Collect-DatabaseIO' AS SourceCollector FROM busy"""
ORACLES["c19_file_evidence"] = _FILE_EVIDENCE
ORACLES["s5_evidence_sink"] = (
    "SELECT *, CaptureTime AS CreatedAt, CaptureTime::DATE AS capture_date, NULL::VARCHAR AS XmlDetails FROM ("
    + _FILE_EVIDENCE + ")"
)

# --- active requests -----------------------------------------------------------------------------

_FLAT = "WITH " + _FOREIGN + """,
texts AS (SELECT DISTINCT sql_text FROM {raw_requests} WHERE sql_text IS NOT NULL),
flat AS (SELECT sql_text, replace(replace(sql_text, chr(13), ' '), chr(10), ' ') AS t FROM texts),
"""
# The signature is SHA-1 over UTF-16LE; where only equality matters, the text stands for itself.
_HASHED = """signed AS (
  SELECT sql_text, t AS SqlText, upper(sha1(unhex(array_to_string(list_transform(
      regexp_extract_all(t, '(?s).'), lambda c: printf('%02X%02X', ord(c) & 255, ord(c) // 256)), '')))) AS QuerySignature
  FROM flat),
"""
_UNHASHED = "signed AS (SELECT sql_text, t AS SqlText, t AS QuerySignature FROM flat),\n"
_BASE = """active AS (
  SELECT r.InstanceId, r.CaptureTime, r.session_id, r.request_id, r.database_name AS DatabaseName, s.login_name AS LoginName,
         s.host_name AS HostName, s.program_name AS ProgramName, r.status, r.command, r.wait_type,
         coalesce(r.wait_time, 0) AS wait_time, coalesce(r.blocking_session_id, 0) AS blocking_session_id,
         r.cpu_time, r.total_elapsed_time, r.logical_reads, r.reads, r.writes, r.percent_complete,
         r.sql_text IS NOT NULL AS HasStatement, g.QuerySignature, g.SqlText
  FROM {raw_requests} r JOIN foreign_sessions s USING (InstanceId, CaptureTime, session_id)
  LEFT JOIN signed g ON g.sql_text = r.sql_text)
"""
_ACTIVE = _FLAT + _HASHED + _BASE
_PLAIN = _FLAT + _UNHASHED + _BASE
ORACLES["c20_request_base"] = _ACTIVE + "SELECT * FROM active"

_SUMMED = _PLAIN + """, summed AS (
  SELECT r.InstanceId, r.CaptureTime, count(a.session_id) AS ActiveRequestCount,
         count(*) FILTER (total_elapsed_time >= 30000) AS LongRunningRequestCount,
         count(*) FILTER (cpu_time >= 10000) AS HighCpuRequestCount,
         count(*) FILTER (logical_reads >= 100000) AS HighLogicalReadRequestCount,
         count(*) FILTER (reads >= 10000) AS HighPhysicalReadRequestCount,
         count(*) FILTER (writes >= 10000) AS HighWriteRequestCount,
         count(*) FILTER (a.session_id IS NOT NULL AND (wait_time >= 10000 OR wait_type IS NOT NULL)) AS WaitingRequestCount,
         count(*) FILTER (blocking_session_id <> 0) AS BlockedRequestCount,
         (coalesce(max(total_elapsed_time), 0) * 0.001::DECIMAL(4,3))::DECIMAL(25,8) AS MaxElapsedSeconds,
         coalesce(sum(cpu_time), 0)::BIGINT AS TotalCpuMs, coalesce(sum(logical_reads), 0)::BIGINT AS TotalLogicalReads,
         coalesce(sum(reads), 0)::BIGINT AS TotalPhysicalReads, coalesce(sum(writes), 0)::BIGINT AS TotalWrites
  FROM {capture_roster} r LEFT JOIN active a ON (a.InstanceId, a.CaptureTime) = (r.InstanceId, r.CaptureTime) GROUP BY ALL)
"""
ORACLES["c21_request_summary"] = _SUMMED + "SELECT * FROM summed"

_EXPENSIVE = _ACTIVE + """, expensive AS (
  SELECT * EXCLUDE (HasStatement), (row_number() OVER (PARTITION BY InstanceId, CaptureTime
     ORDER BY cpu_time DESC, total_elapsed_time DESC, logical_reads DESC, wait_time DESC, session_id, request_id))::INT AS rn
  FROM active WHERE greatest(total_elapsed_time / 30000, cpu_time / 10000, logical_reads / 100000, reads / 10000,
                             writes / 10000, wait_time / 10000, abs(blocking_session_id)) >= 1
  QUALIFY rn <= 50)
"""
ORACLES["c22_expensive_requests"] = _EXPENSIVE + "SELECT * FROM expensive"


def _attribution(kind: str, column: str) -> str:
    shown = f"if(rtrim({column}) <> '', {column}, '(unknown)')"
    return f"""
  SELECT InstanceId, CaptureTime, 'ActiveRequestBy{kind}' AS DetailType, min({shown}) AS GroupValue,
         count(*) AS ActiveRequestCount, sum(cpu_time)::BIGINT AS TotalCpuMs, sum(total_elapsed_time)::BIGINT AS TotalElapsedMs,
         sum(logical_reads)::BIGINT AS TotalLogicalReads, sum(reads)::BIGINT AS TotalReads, sum(writes)::BIGINT AS TotalWrites,
         count(*) FILTER (blocking_session_id <> 0) AS BlockedRequestCount, max(wait_type) AS SampleWaitType,
         max(DatabaseName) AS SampleDatabaseName, max(HostName) AS SampleHostName, max(ProgramName) AS SampleProgramName,
         (row_number() OVER (PARTITION BY InstanceId, CaptureTime ORDER BY sum(cpu_time) DESC, sum(total_elapsed_time) DESC,
            sum(logical_reads) DESC, lower(rtrim({shown}))))::INT AS rn
  FROM active GROUP BY InstanceId, CaptureTime, lower(rtrim({shown})) QUALIFY rn <= 25"""


_KEYS = {"Database": "DatabaseName", "Host": "HostName", "Program": "ProgramName", "Login": "LoginName"}
for _i, (_kind, _column) in enumerate(_KEYS.items(), 23):
    ORACLES[f"c{_i}_requests_by_{_kind.lower()}"] = _PLAIN + _attribution(_kind, _column)

_REPEATED = _ACTIVE + """, repeated AS (
  SELECT InstanceId, CaptureTime, QuerySignature, count(*) AS ActiveRequestCount, sum(cpu_time)::BIGINT AS TotalCpuMs,
         sum(total_elapsed_time)::BIGINT AS TotalElapsedMs, sum(logical_reads)::BIGINT AS TotalLogicalReads,
         sum(reads)::BIGINT AS TotalReads, sum(writes)::BIGINT AS TotalWrites, max(DatabaseName) AS SampleDatabaseName,
         max(LoginName) AS SampleLoginName, max(HostName) AS SampleHostName, max(ProgramName) AS SampleProgramName,
         max(SqlText) AS SampleSqlText,
         (row_number() OVER (PARTITION BY InstanceId, CaptureTime
            ORDER BY count(*) DESC, sum(cpu_time) DESC, sum(total_elapsed_time) DESC, QuerySignature))::INT AS rn
  FROM active WHERE QuerySignature IS NOT NULL GROUP BY InstanceId, CaptureTime, QuerySignature HAVING count(*) > 1
  QUALIFY rn <= 25)
"""
ORACLES["c27_repeated_requests"] = _REPEATED + "SELECT * FROM repeated"

_EVIDENCE = """SELECT InstanceId, CaptureTime, {0} AS DatabaseName, 'ActiveRequest' AS MetricCategory, {1} AS DetailType,
       {2} AS Severity, ({3})::DECIMAL(28,6) AS NumericValue1, ({4})::DECIMAL(28,6) AS NumericValue2,
       array_to_string([{5}], chr(10)) AS Details, 'Collect-ActiveRequests' AS SourceCollector FROM {6}"""


def _number(value: str) -> str:
    return f"rtrim(rtrim(printf('%.3f', {value}), '0'), '.')"


def _text(value: str, default: str) -> str:
    return f"CASE WHEN regexp_matches({value}, '\\S') THEN {value} ELSE '{default}' END"


def _lines(*pairs: tuple[str, str]) -> str:
    return ", ".join(f"'{label}: ' || {value}" for label, value in pairs)


_PEOPLE = [(c, _text(c, "(unknown)")) for c in ("DatabaseName", "LoginName", "HostName", "ProgramName")]
_TOTALS = [(c, c) for c in ("ActiveRequestCount", "TotalCpuMs", "TotalElapsedMs", "TotalLogicalReads", "TotalReads", "TotalWrites")]
_DETAIL = _EVIDENCE.format(
    _text("DatabaseName", "(unknown)"), "'ActiveRequestDetail'", "'Warning'",
    "total_elapsed_time * 0.001::DECIMAL(4,3)", "cpu_time",
    _lines(("DetailType", "'ActiveRequestDetail'"), ("SessionId", "session_id"), *_PEOPLE, ("Status", "status"),
           ("Command", _text("command", "(unknown)")), ("WaitType", _text("wait_type", "(none)")),
           ("WaitSeconds", _number("wait_time / 1000")), ("BlockingSessionId", "blocking_session_id"),
           ("CpuTimeMs", "cpu_time"), ("ElapsedTimeMs", "total_elapsed_time"), ("LogicalReads", "logical_reads"),
           ("Reads", "reads"), ("Writes", "writes"), ("PercentComplete", _number("percent_complete")),
           ("QuerySignature", "coalesce(QuerySignature, '(none)')"), ("SQL text", _text("SqlText", "(unavailable)"))),
    "expensive",
)
ORACLES["c28_expensive_evidence"] = _EXPENSIVE + _DETAIL
_GROUPED = _EVIDENCE.format(
    "NULL::VARCHAR", "DetailType", "'Info'", "TotalCpuMs", "TotalElapsedMs",
    _lines(("DetailType", "DetailType"), ("GroupValue", "GroupValue"), *_TOTALS,
           ("BlockedRequestCount", "BlockedRequestCount"), ("SampleWaitType", _text("SampleWaitType", "(none)")),
           *((f"Sample{c}", _text(f"Sample{c}", "(unknown)")) for c in ("DatabaseName", "HostName", "ProgramName"))),
    "attributed",
)
_ATTRIBUTED = _PLAIN + ", attributed AS (" + "\nUNION ALL\n".join(
    f"({_attribution(k, c)})" for k, c in _KEYS.items()) + ")\n"
ORACLES["c28_attribution_evidence"] = _ATTRIBUTED + _GROUPED
_TWICE = _EVIDENCE.format(
    _text("SampleDatabaseName", "(unknown)"), "'RepeatedActiveQuery'", "'Warning'", "TotalCpuMs", "ActiveRequestCount",
    _lines(("DetailType", "'RepeatedActiveQuery'"), ("QuerySignature", "QuerySignature"), *_TOTALS,
           *((f"Sample{c}", _text(f"Sample{c}", "(unknown)")) for c in ("DatabaseName", "LoginName", "HostName", "ProgramName")),
           ("SQL text", _text("SampleSqlText", "(unavailable)"))),
    "repeated",
)
ORACLES["c28_repeated_evidence"] = _REPEATED + _TWICE
ORACLES["s7_evidence_rendering"] = """
SELECT InstanceId, CaptureTime, session_id,
       'Login: ' || if(trim(login_name) <> '', login_name, '(unknown)') || chr(10) ||
       'Host: ' || if(trim(host_name) <> '', host_name, '(unknown)') || chr(10) ||
       'Program: ' || if(trim(program_name) <> '', program_name, '(none)') || chr(10) ||
       'Database: ' || coalesce(database_name, '') AS Details
FROM {raw_sessions}"""
ORACLES["s8_fan_out"] = _ATTRIBUTED.rstrip() + _SUMMED[len(_PLAIN):].rstrip() + _EXPENSIVE[len(_ACTIVE):].rstrip() + (
    _REPEATED[len(_ACTIVE):]) + """
SELECT 'ActiveRequestSummary' AS Output, 13 * count(*) AS RowCount FROM summed
UNION ALL SELECT 'ActiveRequestDetail', count(*) FROM expensive
UNION ALL SELECT DetailType, count(*) FROM attributed GROUP BY 1
UNION ALL SELECT 'RepeatedActiveQuery', count(*) FROM repeated"""
