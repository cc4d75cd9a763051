"""Query statistics and backup compliance."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

# --- query statistics ----------------------------------------------------------------------------

_RANKINGS = {"CPU": "total_worker_time", "Duration": "total_elapsed_time", "LogicalReads": "total_logical_reads",
             "Executions": "execution_count"}


def _ranking(name: str) -> str:
    return f"""
  SELECT *, '{name}' AS RankingCategory, (row_number() OVER (PARTITION BY InstanceId, CaptureTime
     ORDER BY {_RANKINGS[name]} DESC, plan_handle, sql_handle))::INT AS rn
  FROM {{raw_query_stats}} WHERE last_execution_time >= TIMESTAMP '2000-08-02 00:00:00' AND execution_count >= 2
  QUALIFY rn <= 25"""


for _n, _name in enumerate(_RANKINGS, 29):
    ORACLES[f"c{_n}_candidates_by_{_name.lower()}"] = _ranking(_name)

_CANDIDATES = "WITH candidates AS (" + " UNION ALL ".join(f"({_ranking(n)})" for n in _RANKINGS) + ")"
ORACLES["c33_all_candidates"] = _CANDIDATES + "SELECT * FROM candidates"
_DEDUPED = _CANDIDATES + """, deduped AS (
  SELECT * EXCLUDE (rn) FROM candidates
  QUALIFY row_number() OVER (PARTITION BY InstanceId, CaptureTime, RankingCategory,
     ifnull(query_hash, '0x' || repeat('0', 16)), ifnull(query_plan_hash, '0x' || repeat('0', 16))
     ORDER BY total_worker_time DESC, total_elapsed_time DESC, last_execution_time DESC, plan_handle, sql_handle) = 1)
"""
ORACLES["c34_deduplicated"] = _DEDUPED + "SELECT * FROM deduped"


def _half_up(numerator: str, denominator: str) -> str:
    return f"(((200 * {numerator}::HUGEINT + {denominator}) // (2 * {denominator})) * 0.01::DECIMAL(3,2))::DECIMAL(19,2)"


_MEASURES = [
    ("TotalCpuMs", _half_up("total_worker_time", "1000")),
    ("AvgCpuMs", _half_up("total_worker_time", "(1000 * execution_count)")),
    ("TotalElapsedMs", _half_up("total_elapsed_time", "1000")),
    ("AvgElapsedMs", _half_up("total_elapsed_time", "(1000 * execution_count)")),
    ("TotalLogicalReads", "total_logical_reads::DECIMAL(19,2)"),
    ("AvgLogicalReads", _half_up("total_logical_reads", "execution_count")),
    ("TotalPhysicalReads", "total_physical_reads::DECIMAL(19,2)"),
    ("AvgPhysicalReads", _half_up("total_physical_reads", "execution_count")),
    ("TotalWrites", "total_logical_writes::DECIMAL(19,2)"),
    ("AvgWrites", _half_up("total_logical_writes", "execution_count")),
]
_ENRICHED = _DEDUPED + """, enriched AS (
  SELECT InstanceId, CaptureTime, RankingCategory, database_name AS DatabaseName, query_hash AS QueryHash,
         query_plan_hash AS QueryPlanHash, execution_count, creation_time, last_execution_time, """ + ", ".join(
    f"{expression} AS {name}" for name, expression in _MEASURES) + """, plan_handle, sql_text AS RawSqlText
  FROM deduped JOIN {raw_query_text} USING (sql_handle))
"""
ORACLES["c35_enriched"] = _ENRICHED + "SELECT * FROM enriched"
_KEPT = _ENRICHED + """, kept AS (
  SELECT * EXCLUDE (RawSqlText), translate(RawSqlText, chr(13) || chr(10), '  ') AS SqlText FROM enriched
  WHERE NOT regexp_matches(RawSqlText, 'MetricSnapshot|MetricTextSnapshot|CollectionRunHistory|sys[.]dm_exec_query_stats'))
"""
ORACLES["c36_without_monitor_statements"] = _KEPT + "SELECT * FROM kept"
ORACLES["c37_query_summary"] = _KEPT + """
SELECT r.InstanceId, r.CaptureTime, count(*) FILTER (RankingCategory = 'CPU') AS TopCpuQueryCount,
       count(*) FILTER (RankingCategory = 'Duration') AS TopDurationQueryCount,
       count(*) FILTER (RankingCategory = 'LogicalReads') AS TopLogicalReadQueryCount,
       count(*) FILTER (RankingCategory = 'Executions') AS TopExecutionQueryCount,
       count(DISTINCT CASE WHEN RankingCategory IS NOT NULL THEN concat(QueryHash, ':', QueryPlanHash) END) AS DistinctQueriesCaptured
FROM {landing_roster} r LEFT JOIN kept k ON (k.InstanceId, k.CaptureTime) = (r.InstanceId, r.CaptureTime) GROUP BY ALL"""
ORACLES["c38_detail_order"] = _KEPT + """
SELECT *, (row_number() OVER (PARTITION BY InstanceId, CaptureTime
   ORDER BY list_position(['CPU', 'Duration', 'LogicalReads', 'Executions'], RankingCategory),
     TotalCpuMs DESC, TotalElapsedMs DESC, TotalLogicalReads DESC, plan_handle))::INT AS rn FROM kept"""
ORACLES["c38_query_evidence"] = _KEPT + """
SELECT InstanceId, CaptureTime, coalesce(DatabaseName, '(unknown)') AS DatabaseName, 'QueryStats' AS MetricCategory,
       'QueryStatsDetail' AS DetailType, 'Info' AS Severity, AvgCpuMs::DECIMAL(28,6) AS NumericValue1,
       AvgElapsedMs::DECIMAL(28,6) AS NumericValue2,
       array_to_string(['RankingCategory: ' || RankingCategory, 'DatabaseName: ' || coalesce(DatabaseName, '(unknown)'),
         'QueryHash: ' || coalesce(QueryHash, ''), 'QueryPlanHash: ' || coalesce(QueryPlanHash, ''),
         'CreationTime: ' || strftime(creation_time, '%m/%d/%Y %H:%M:%S'),
         'LastExecutionTime: ' || strftime(last_execution_time, '%m/%d/%Y %H:%M:%S'),
         'ExecutionCount: ' || execution_count, """ + ", ".join(f"'{n}: ' || {n}" for n, _ in _MEASURES) + """,
         'SQL text: ' || CASE WHEN regexp_matches(SqlText, '\\S') THEN SqlText ELSE '(unavailable)' END], chr(10)) AS Details,
       'Collect-QueryStats' AS SourceCollector FROM kept"""

# --- backups -------------------------------------------------------------------------------------

_LAST = """WITH last_backups AS (
  SELECT b.InstanceId, b.CaptureTime, b.database_name, b.type, b.backup_finish_date,
         (((200 * b.backup_size::HUGEINT + 1048576) // 2097152) * 0.01::DECIMAL(3,2))::DECIMAL(19,2) AS BackupSizeMB,
         (((200 * b.compressed_backup_size::HUGEINT + 1048576) // 2097152) * 0.01::DECIMAL(3,2))::DECIMAL(19,2) AS CompressedBackupSizeMB,
         date_diff('second', b.backup_start_date, b.backup_finish_date)::INT AS DurationSeconds,
         m.physical_device_name AS PhysicalDeviceName
  FROM {raw_backupset} b LEFT JOIN {raw_backupmedia} m USING (InstanceId, CaptureTime, media_set_id)
  WHERE b.type IN ('D', 'I', 'L')
  QUALIFY row_number() OVER (PARTITION BY b.InstanceId, b.CaptureTime, b.database_name, b.type
     ORDER BY b.backup_finish_date DESC, b.media_set_id DESC, m.physical_device_name) = 1)
"""
ORACLES["c39_last_backups"] = _LAST + "SELECT * FROM last_backups"
_PARTS = ", ".join(
    f"b_{kind}.{source} AS Last{kind}Backup{part}" if part in ("Time", "Device")
    else f"coalesce(b_{kind}.{source}, 0)::{cast} AS Last{kind}Backup{part}"
    for part, source, cast in (("Time", "backup_finish_date", ""), ("SizeMB", "BackupSizeMB", "DECIMAL(19,2)"),
                               ("DurationSeconds", "DurationSeconds", "INT"), ("Device", "PhysicalDeviceName", ""))
    for kind in ("Full", "Diff", "Log")
)
_STATUS = _LAST + """, status AS (
  SELECT d.InstanceId, d.CaptureTime, d.name AS DatabaseName, d.recovery_model_desc, d.state_desc, """ + _PARTS + """
  FROM {raw_databases} d """ + " ".join(
    f"LEFT JOIN last_backups b_{kind} ON b_{kind}.type = '{code}' AND b_{kind}.InstanceId = d.InstanceId "
    f"AND b_{kind}.database_name = d.name" for kind, code in (("Full", "D"), ("Diff", "I"), ("Log", "L"))) + """
  WHERE d.name <> 'tempdb' AND d.state_desc = 'ONLINE')
"""
ORACLES["c40_backup_status"] = _STATUS + "SELECT * FROM status"
_AGED = _STATUS + ", aged AS (SELECT *, " + ", ".join(
    f"date_diff('hour', Last{k}BackupTime, CaptureTime)::INT AS Last{k}BackupAgeHours" for k in ("Full", "Diff", "Log")
) + " FROM status)\n"
ORACLES["c41_backup_ages"] = _AGED + "SELECT * FROM aged"
_PROFILE = "coalesce(nullif(trim(ComplianceProfile), ''), 'V1_SIMPLE')"
_POLICY = f"""SELECT InstanceId, {_PROFILE} AS ComplianceProfile,
  if({_PROFILE} = 'V2_FULL', 'FULL', 'SIMPLE') AS ExpectedRecoveryModel, {_PROFILE} = 'V2_FULL' AS RequiresLogBackups
  FROM {{monitored_instances}} WHERE IsEnabled"""
ORACLES["c42_backup_policy"] = _POLICY
_JUDGED = _AGED + ", policy AS (" + _POLICY + """), judged AS (
  SELECT *, recovery_model_desc <> ExpectedRecoveryModel AS mismatch, LastFullBackupTime IS NULL AS no_full,
         coalesce(LastFullBackupAgeHours > 8760, false) AS old_full,
         RequiresLogBackups AND recovery_model_desc <> 'SIMPLE' AND LastLogBackupTime IS NULL AS no_log,
         coalesce(RequiresLogBackups AND recovery_model_desc <> 'SIMPLE' AND LastLogBackupAgeHours > 720, false) AS old_log
  FROM aged JOIN policy USING (InstanceId)),
issues AS (
  SELECT *, CASE WHEN mismatch THEN 'RecoveryModelMismatch' WHEN no_full THEN 'MissingFullBackup' WHEN old_full THEN 'OldFullBackup'
                 WHEN no_log THEN 'MissingLogBackup' WHEN old_log THEN 'OldLogBackup' ELSE 'OK' END AS IssueType FROM judged),
rated AS (SELECT *, CASE IssueType WHEN 'OK' THEN 'Info' WHEN 'OldFullBackup' THEN 'Warning' ELSE 'Critical' END AS Severity FROM issues)
"""
ORACLES["c43_compliance_summary"] = _JUDGED + """
SELECT r.InstanceId, r.CaptureTime, count(DatabaseName) AS DatabaseCount,
       count(*) FILTER (no_full) AS DatabasesWithoutFullBackup, count(*) FILTER (old_full) AS DatabasesWithOldFullBackup,
       count(*) FILTER (LastDiffBackupAgeHours > 8760) AS DatabasesWithOldDiffBackup,
       count(*) FILTER (mismatch) AS RecoveryModelViolations, count(*) FILTER (no_log) AS DatabasesWithoutRequiredLogBackup,
       count(*) FILTER (old_log) AS DatabasesWithOldRequiredLogBackup,
       count(*) FILTER (IssueType <> 'OK') AS NonCompliantDatabaseCount,
       coalesce(max(coalesce(LastFullBackupAgeHours, 0)), 0)::INT AS MaxFullBackupAgeHours,
       coalesce(max(coalesce(LastLogBackupAgeHours, 0)), 0)::INT AS MaxLogBackupAgeHours
FROM {landing_roster} r LEFT JOIN issues i ON (i.InstanceId, i.CaptureTime) = (r.InstanceId, r.CaptureTime) GROUP BY ALL"""
ORACLES["c44_issue_type"] = _JUDGED + "SELECT InstanceId, CaptureTime, DatabaseName, IssueType FROM issues"
ORACLES["c45_issue_severity"] = _JUDGED + "SELECT InstanceId, CaptureTime, DatabaseName, Severity FROM rated"
_TOP_ISSUES = _JUDGED + """, top_issues AS (
  SELECT * EXCLUDE (mismatch, no_full, old_full, no_log, old_log), (row_number() OVER (PARTITION BY InstanceId, CaptureTime
     ORDER BY list_position([mismatch, no_full, no_log, old_log, old_full], true), DatabaseName))::INT AS rn
  FROM rated WHERE mismatch OR no_full OR old_full OR no_log OR old_log QUALIFY rn <= 200)
"""
ORACLES["c46_compliance_issues"] = _TOP_ISSUES + "SELECT * FROM top_issues"
_SHOWN = ", ".join(
    [f"'Last{k}BackupTime: ' || coalesce(strftime(Last{k}BackupTime, '%m/%d/%Y %H:%M:%S'), '')" for k in ("Full", "Diff", "Log")]
    + [f"'Last{k}Backup{p}: ' || coalesce(Last{k}Backup{p}::VARCHAR, '')"
       for p in ("AgeHours", "SizeMB", "DurationSeconds", "Device") for k in ("Full", "Diff", "Log")])
ORACLES["c47_compliance_evidence"] = _TOP_ISSUES + """
SELECT InstanceId, CaptureTime, DatabaseName, 'BackupCompliance' AS MetricCategory, IssueType AS DetailType, Severity,
       coalesce(LastFullBackupAgeHours, 0)::DECIMAL(28,6) AS NumericValue1, NULL::DECIMAL(28,6) AS NumericValue2,
       array_to_string(['DatabaseName: ' || DatabaseName, 'IssueType: ' || IssueType, 'Severity: ' || Severity,
         'ComplianceProfile: ' || ComplianceProfile, 'ExpectedRecoveryModel: ' || ExpectedRecoveryModel,
         'ActualRecoveryModel: ' || recovery_model_desc, 'RequiresLogBackups: ' || if(RequiresLogBackups, 'True', 'False'),
         """ + _SHOWN + """], chr(10)) AS Details, 'Collect-Backups' AS SourceCollector FROM top_issues"""
