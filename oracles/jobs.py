"""Inventory, runs, retention, agent jobs and agent alerts."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

# --- sources and inventory -----------------------------------------------------------------------

ORACLES["s1_enabled_instances"] = "SELECT InstanceId, InstanceName FROM {monitored_instances} WHERE IsEnabled"
_EFFECTIVE = "coalesce(nullif(trim(ComplianceProfile), ''), 'V1_SIMPLE')"
ORACLES["s2_enabled_profiles"] = (
    f"SELECT InstanceId, InstanceName, {_EFFECTIVE} AS ComplianceProfile FROM {{monitored_instances}} WHERE IsEnabled"
)
ORACLES["s3_landing_scan"] = "SELECT * FROM {raw_waits}"
ORACLES["s3_quarantined_rows"] = """
WITH landed AS (
  SELECT InstanceId, CASE WHEN waiting_tasks_count % 5 = 0 THEN 1 WHEN waiting_tasks_count % 7 = 0 THEN 2
                          WHEN waiting_tasks_count % 11 = 0 THEN 3 ELSE 0 END AS spoiled FROM {raw_waits})
SELECT if(spoiled > 1, NULL, InstanceId) AS InstanceId, count(*) AS RowCount,
       CASE spoiled WHEN 0 THEN 'sound' WHEN 3 THEN 'instance or capture time is missing' ELSE 'row cannot be read' END AS Outcome
FROM landed GROUP BY ALL"""
ORACLES["i1_register"] = """
WITH r AS (SELECT * FROM {registrations}), m AS (SELECT * FROM {monitored_instances}),
added AS (
  SELECT *, (SELECT max(InstanceId) FROM m)
         + row_number() OVER (ORDER BY left(md5(InstanceName), 2), InstanceName) AS id
  FROM r ANTI JOIN m USING (InstanceName))
SELECT m.InstanceId, InstanceName, if(r.Notes IS NULL, m.EnvironmentName, r.EnvironmentName) AS EnvironmentName,
       m.IsEnabled OR r.Notes IS NOT NULL AS IsEnabled, m.CollectionProfile,
       if(r.Notes IS NULL, m.ComplianceProfile, r.ComplianceProfile) AS ComplianceProfile,
       coalesce(r.SqlVersion, m.SqlVersion) AS SqlVersion, coalesce(r.Edition, m.Edition) AS Edition,
       coalesce(r.Notes, m.Notes) AS Notes, m.CreatedAt,
       if(r.Notes IS NULL, m.ModifiedAt, TIMESTAMP '2024-01-31 00:00:00') AS ModifiedAt
FROM m LEFT JOIN r USING (InstanceName)
UNION ALL
SELECT id::INT, InstanceName, EnvironmentName, true, CollectionProfile, ComplianceProfile, SqlVersion, Edition, Notes,
       TIMESTAMP '2024-01-31 00:00:00', TIMESTAMP '2024-01-31 00:00:00' FROM added"""
ORACLES["i1_seed"] = """
WITH m AS (SELECT * FROM {monitored_instances}),
added AS (SELECT * FROM {registrations} ANTI JOIN m USING (InstanceName))
SELECT * FROM m
UNION ALL BY NAME
SELECT ((SELECT max(InstanceId) FROM m) + row_number() OVER (ORDER BY left(md5(InstanceName), 2), InstanceName))::INT AS InstanceId,
       *, true AS IsEnabled, TIMESTAMP '2024-01-31 00:00:00' AS CreatedAt FROM added"""
ORACLES["i2_set_state"] = """
SELECT m.* REPLACE (
  if(c.State IS NULL, m.IsEnabled, c.State = 'Enable') AS IsEnabled,
  if(c.State IS NULL, m.ModifiedAt, TIMESTAMP '2024-01-31 00:00:00') AS ModifiedAt,
  CASE WHEN c.State IS NULL THEN m.Notes
       ELSE nullif(array_to_string(list_filter([m.Notes, c.Reason], lambda x: x <> ''), ' | '),
                   if(m.Notes IS NULL AND c.Reason = '', '', '<never>')) END AS Notes)
FROM {monitored_instances} m LEFT JOIN {state_changes} c USING (InstanceName)"""
ORACLES["i2_unknown_names"] = "SELECT InstanceName FROM {registrations} EXCEPT SELECT InstanceName FROM {monitored_instances}"
ORACLES["i3_list_instances"] = "SELECT * FROM {monitored_instances} WHERE NOT IsEnabled"
ORACLES["i4_additive_column"] = """
SELECT InstanceId, InstanceName, EnvironmentName, 'V1_SIMPLE' AS ComplianceProfile FROM {monitored_instances}"""

# --- runs ----------------------------------------------------------------------------------------

ORACLES["i5_run_lifecycle"] = """
SELECT s.CollectionRunId, s.CollectorName, s.InstanceId, s.EventTime AS StartedAt, f.EventTime AS FinishedAt,
       coalesce(f.Status, 'Running') AS Status, f.RowsCollected,
       date_diff('millisecond', s.EventTime, f.EventTime)::INT AS DurationMs, f.ErrorMessage, s.EventTime AS CreatedAt
FROM {run_events} s LEFT JOIN {run_events} f ON f.CollectionRunId = s.CollectionRunId AND f.EventType = 'finish'
WHERE s.EventType = 'start'"""
ORACLES["i6_failure_isolation"] = """
WITH failed AS (SELECT DISTINCT InstanceId FROM {raw_counters} WHERE cntr_value IS NULL),
counted AS (SELECT InstanceId, count(*) AS n FROM {raw_counters} GROUP BY 1)
SELECT InstanceId, if(failed.InstanceId IS NULL, n, 0) AS RowsCollected,
       if(failed.InstanceId IS NULL, NULL, 'counter value is missing') AS ErrorMessage
FROM counted LEFT JOIN failed USING (InstanceId)"""
ORACLES["i6_sound_rows"] = """
SELECT * FROM {raw_counters} WHERE InstanceId NOT IN (SELECT InstanceId FROM {raw_counters} WHERE cntr_value IS NULL)"""
ORACLES["i7_cycle_summary"] = """
SELECT CollectorName, count(*) FILTER (Status IN ('Success', 'Succeeded', 'Completed')) AS Succeeded,
       count(*) FILTER (Status IN ('Failed', 'Error')) AS Failed
FROM {collection_run_history}
WHERE StartedAt >= TIMESTAMP '2001-08-01 00:00:00' AND StartedAt < TIMESTAMP '2001-08-02 00:00:00' GROUP BY 1"""
_RUN = "CollectionRunId, InstanceName, CollectorName, StartedAt, FinishedAt, Status, RowsCollected, DurationMs, ErrorMessage"


def _failures(condition: str) -> str:
    return f"""
SELECT {_RUN} FROM {{collection_run_history}} JOIN {{monitored_instances}} USING (InstanceId)
WHERE StartedAt >= TIMESTAMP '2001-08-01 00:00:00' AND Status NOT IN ('Completed', 'Success', 'Succeeded') {condition}
ORDER BY StartedAt DESC, CollectionRunId LIMIT 100"""


ORACLES["i8_collection_failures"] = _failures("")
ORACLES["i8_stale_failures"] = _failures(
    "AND (Status <> 'Running' OR StartedAt < TIMESTAMP '2001-08-01 23:45:00') AND CollectorName = 'Collector3'")
ORACLES["i9_recent_history"] = f"""
SELECT {_RUN} FROM {{collection_run_history}} JOIN {{monitored_instances}} USING (InstanceId)
ORDER BY StartedAt DESC, CollectionRunId LIMIT 100"""
ORACLES["i10_row_counts"] = """
SELECT 'CollectionRunHistory' AS TableName, count(*) AS RowCount FROM {collection_run_history}
UNION ALL SELECT 'MetricSnapshot', count(*) FROM {metric_snapshot}
UNION ALL SELECT 'MetricTextSnapshot', count(*) FROM {metric_text_snapshot}
UNION ALL SELECT 'MonitoredInstances', count(*) FROM {monitored_instances}"""

# --- retention -----------------------------------------------------------------------------------

ORACLES["m1_shortest_retention"] = "SELECT * FROM {collection_run_history} WHERE StartedAt >= TIMESTAMP '2001-08-01 12:00:00'"
ORACLES["m2_retained_metrics"] = "SELECT * FROM {metric_snapshot} WHERE CaptureTime >= TIMESTAMP '2024-01-15 12:00:00'"
ORACLES["m2_purged_table"] = """
SELECT CaptureTime, InstanceId, Details FROM {metric_text_snapshot} WHERE CaptureTime >= TIMESTAMP '2024-01-15 12:00:00'"""
ORACLES["m3_purge_summary"] = """
SELECT 'MetricSnapshot' AS TableName, count(*) FILTER (CaptureTime < TIMESTAMP '2024-01-15 12:00:00') AS RowsDeleted,
       TIMESTAMP '2024-01-15 12:00:00' AS CutoffDate FROM {metric_snapshot}
UNION ALL SELECT 'MetricTextSnapshot', count(*) FILTER (CaptureTime < TIMESTAMP '2024-01-12 12:00:00'),
       TIMESTAMP '2024-01-12 12:00:00' FROM {metric_text_snapshot}
UNION ALL SELECT 'CollectionRunHistory', count(*) FILTER (StartedAt < TIMESTAMP '2023-12-30 12:00:00'),
       TIMESTAMP '2023-12-30 12:00:00' FROM {collection_run_history}"""

# --- agent jobs ----------------------------------------------------------------------------------

_RECENT = """WITH decoded AS (
  SELECT InstanceId, CaptureTime, job_id, instance_id, step_id, step_name, run_status,
         coalesce(['Failed', 'Succeeded', 'Retry', 'Canceled', 'In Progress'][run_status + 1], 'Unknown') AS RunStatusDescription,
         try_strptime(run_date || lpad(run_time::VARCHAR, 6, '0'), '%Y%m%d%H%M%S') AS RunDateTime,
         (run_duration // 10000 * 3600 + run_duration // 100 % 100 * 60 + run_duration % 100)::INT AS RunDurationSeconds,
         message AS Message
  FROM {raw_job_history} WHERE step_id = 0),
recent AS (
  SELECT d.*, j.name AS JobName, j.enabled FROM decoded d JOIN {raw_jobs} j USING (InstanceId, CaptureTime, job_id)
  WHERE RunDateTime >= CaptureTime - INTERVAL 8760 HOUR)
"""
_RUNNING = """WITH running AS (
  SELECT a.InstanceId, a.CaptureTime, a.job_id, j.name AS JobName, a.start_execution_date AS StartExecutionDate,
         date_diff('second', a.start_execution_date, a.CaptureTime) AS RunningSeconds
  FROM {raw_job_activity} a JOIN {raw_jobs} j USING (InstanceId, CaptureTime, job_id)
  WHERE a.start_execution_date IS NOT NULL AND a.stop_execution_date IS NULL
    AND a.session_id = (SELECT max(s.session_id) FROM {raw_agent_sessions} s WHERE s.InstanceId = a.InstanceId))
"""
ORACLES["c48_recent_runs"] = _RECENT + "SELECT * FROM recent"
ORACLES["c49_running_jobs"] = _RUNNING + "SELECT * FROM running"
ORACLES["c50_job_inventory"] = """
SELECT r.InstanceId, r.CaptureTime, count(*) FILTER (enabled = 1) AS TotalEnabledJobs,
       count(*) FILTER (enabled = 0) AS TotalDisabledJobs
FROM {landing_roster} r LEFT JOIN {raw_jobs} j ON j.InstanceId = r.InstanceId GROUP BY ALL"""
ORACLES["c51_outcome_summary"] = _RECENT + """
SELECT r.InstanceId, r.CaptureTime, count(job_id) AS RecentCompletedJobs,
       count(*) FILTER (run_status = 1) AS RecentSucceededJobs, count(*) FILTER (run_status = 0) AS RecentFailedJobs,
       count(*) FILTER (run_status = 3) AS RecentCanceledJobs, count(*) FILTER (run_status = 2) AS RecentRetryJobs,
       coalesce(max(RunDurationSeconds), 0)::INT AS MaxRunDurationSeconds,
       (coalesce(sum(RunDurationSeconds)::HUGEINT * 1000000 // nullif(count(job_id), 0), 0) * 0.000001::DECIMAL(7,6))::DECIMAL(25,6) AS AvgRunDurationSeconds
FROM {landing_roster} r LEFT JOIN recent j ON j.InstanceId = r.InstanceId GROUP BY ALL"""
ORACLES["c52_running_summary"] = _RUNNING + """
SELECT r.InstanceId, r.CaptureTime, count(job_id) AS RunningJobCount, coalesce(max(RunningSeconds), 0) AS MaxRunningSeconds
FROM {landing_roster} r LEFT JOIN running j ON j.InstanceId = r.InstanceId GROUP BY ALL"""
_FAILED = _RECENT + """, failed AS (
  SELECT *, (row_number() OVER (PARTITION BY InstanceId, CaptureTime ORDER BY RunDateTime DESC, instance_id))::INT AS rn
  FROM recent WHERE run_status IN (0, 2, 3) QUALIFY rn <= 100)
"""
ORACLES["c53_failed_runs"] = _FAILED + "SELECT * FROM failed"
ORACLES["c53_failure_evidence"] = _FAILED + """
SELECT InstanceId, CaptureTime, NULL::VARCHAR AS DatabaseName, 'SqlAgentJob' AS MetricCategory, 'JobFailure' AS DetailType,
       'Warning' AS Severity, RunDurationSeconds::DECIMAL(28,6) AS NumericValue1, NULL::DECIMAL(28,6) AS NumericValue2,
       concat('JobName: ', JobName, chr(10), 'RunDateTime: ', strftime(RunDateTime, '%m/%d/%Y %H:%M:%S'), chr(10),
              'RunDurationSeconds: ', RunDurationSeconds, chr(10), 'RunStatus: ', RunStatusDescription, chr(10),
              'Message: ', coalesce(Message, '(none)')) AS Details, 'Collect-SqlAgentJobs' AS SourceCollector FROM failed"""
_LONGEST = _RUNNING + """, longest AS (
  SELECT *, (row_number() OVER (PARTITION BY InstanceId, CaptureTime ORDER BY RunningSeconds DESC, job_id, StartExecutionDate))::INT AS rn,
         if(RunningSeconds < 3600, 'Info', 'Warning') AS Severity FROM running QUALIFY rn <= 100)
"""
ORACLES["c54_longest_running"] = _LONGEST + "SELECT * FROM longest"
ORACLES["c54_running_evidence"] = _LONGEST + """
SELECT InstanceId, CaptureTime, NULL::VARCHAR AS DatabaseName, 'SqlAgentJob' AS MetricCategory, 'RunningJob' AS DetailType,
       Severity, RunningSeconds::DECIMAL(28,6) AS NumericValue1, NULL::DECIMAL(28,6) AS NumericValue2,
       concat('JobName: ', JobName, chr(10), 'StartExecutionDate: ', strftime(StartExecutionDate, '%m/%d/%Y %H:%M:%S'), chr(10),
              'RunningSeconds: ', RunningSeconds) AS Details, 'Collect-SqlAgentJobs' AS SourceCollector FROM longest"""

# --- agent alerts --------------------------------------------------------------------------------


def _moment(name: str) -> str:
    return (f"CASE WHEN {name}_date > 0 THEN try_strptime({name}_date || lpad({name}_time::VARCHAR, 6, '0'), '%Y%m%d%H%M%S') END")


_DECODED = f"""WITH decoded AS (
  SELECT InstanceId, CaptureTime, id AS AlertId, name AS AlertName, enabled AS IsEnabled, message_id AS MessageId,
         severity AS SeverityNumber, database_name AS DatabaseName, event_description_keyword AS EventDescriptionKeyword,
         delay_between_responses AS DelayBetweenResponsesSeconds, coalesce(occurrence_count, 0) AS OccurrenceCount,
         last_occurrence_date AS LastOccurrenceDate, last_occurrence_time AS LastOccurrenceTime,
         {_moment('last_occurrence')} AS LastOccurrenceDateTime,
         last_response_date AS LastResponseDate, last_response_time AS LastResponseTime,
         {_moment('last_response')} AS LastResponseDateTime,
         count_reset_date AS CountResetDate, count_reset_time AS CountResetTime, {_moment('count_reset')} AS CountResetDateTime
  FROM {{raw_alerts}})
"""
ORACLES["c55_decoded_alerts"] = _DECODED + "SELECT * FROM decoded"
ORACLES["c56_has_notification"] = """
SELECT InstanceId, CaptureTime, id AS AlertId,
       (EXISTS (SELECT 1 FROM {raw_notifications} n WHERE n.alert_id = a.id AND n.InstanceId = a.InstanceId))::INT AS HasNotification
FROM {raw_alerts} a"""
_NAMES = """(SELECT n.InstanceId, n.alert_id, string_agg(DISTINCT coalesce(o.name, '(none)'), ', ' ORDER BY coalesce(o.name, '(none)')) AS names
   FROM {raw_notifications} n LEFT JOIN {raw_operators} o ON o.id = n.operator_id AND o.InstanceId = n.InstanceId GROUP BY 1, 2)"""
_METHODS = """(SELECT InstanceId, alert_id, string_agg(DISTINCT m, ', ' ORDER BY m) AS methods FROM (
   SELECT *, CASE notification_method WHEN 1 THEN 'Email' WHEN 2 THEN 'Pager' WHEN 4 THEN 'NetSend' WHEN 7 THEN 'Email/Pager/NetSend'
             ELSE if(notification_method IS NULL, '(none)', 'Other') END AS m FROM {raw_notifications}) GROUP BY 1, 2)"""
ORACLES["c57_operator_names"] = f"""
SELECT a.InstanceId, a.CaptureTime, a.id AS AlertId, coalesce(n.names, '(none)') AS OperatorNames
FROM {{raw_alerts}} a LEFT JOIN {_NAMES} n ON n.alert_id = a.id AND n.InstanceId = a.InstanceId"""
ORACLES["c58_notification_methods"] = f"""
SELECT a.InstanceId, a.CaptureTime, a.id AS AlertId, coalesce(n.methods, '(none)') AS NotificationMethods
FROM {{raw_alerts}} a LEFT JOIN {_METHODS} n ON n.alert_id = a.id AND n.InstanceId = a.InstanceId"""
_ALERTS = _DECODED.rstrip() + f""", alerts AS (
  SELECT d.*, (n.names IS NOT NULL)::INT AS HasNotification, coalesce(n.names, '(none)') AS OperatorNames,
         coalesce(m.methods, '(none)') AS NotificationMethods,
         coalesce(date_diff('microsecond', LastOccurrenceDateTime, CaptureTime) <= 31536000000000, false)::INT AS WasTriggeredRecently,
         coalesce(date_diff('microsecond', LastResponseDateTime, CaptureTime) <= 31536000000000, false)::INT AS RespondedRecently,
         CASE WHEN SeverityNumber > 19 OR MessageId IN (823, 824, 825, 9001, 17053) THEN 'Critical'
              WHEN SeverityNumber > 15 OR MessageId > 0 THEN 'Warning' ELSE 'Info' END AS AlertSeverity
  FROM decoded d LEFT JOIN {_NAMES} n ON n.alert_id = d.AlertId AND n.InstanceId = d.InstanceId
  LEFT JOIN {_METHODS} m ON m.alert_id = d.AlertId AND m.InstanceId = d.InstanceId)
"""
ORACLES["c59_alert_flags"] = _ALERTS + "SELECT * FROM alerts"
ORACLES["c60_alert_summary"] = _ALERTS + """
SELECT r.InstanceId, r.CaptureTime, count(AlertId) AS TotalAlerts, count(*) FILTER (IsEnabled = 1) AS EnabledAlerts,
       count(*) FILTER (IsEnabled = 0) AS DisabledAlerts, count(*) FILTER (SeverityNumber > 0) AS SeverityAlerts,
       count(*) FILTER (MessageId > 0) AS ErrorNumberAlerts, count(*) FILTER (HasNotification = 1) AS AlertsWithNotifications,
       count(*) FILTER (HasNotification = 0) AS AlertsWithoutNotifications,
       count(*) FILTER (OccurrenceCount > 0) AS AlertsWithOccurrences,
       count(*) FILTER (WasTriggeredRecently = 1) AS AlertsTriggeredRecently,
       count(*) FILTER (RespondedRecently = 1) AS AlertsRespondedRecently, coalesce(max(OccurrenceCount), 0)::INT AS MaxOccurrenceCount
FROM {landing_roster} r LEFT JOIN alerts a ON a.InstanceId = r.InstanceId GROUP BY ALL"""
_ISSUES = _ALERTS + """, reported AS (
  SELECT *, 'AlertConfigIssue' AS DetailType, if(IsEnabled = 0, 'Alert disabled', 'Alert has no notification') AS IssueReason,
         (row_number() OVER (PARTITION BY InstanceId, CaptureTime ORDER BY IsEnabled, HasNotification, AlertName, AlertId))::INT AS rn
  FROM alerts WHERE least(IsEnabled, HasNotification) = 0 QUALIFY rn <= 200)
"""
_FIRED = _ALERTS + """, reported AS (
  SELECT *, 'AlertTriggered' AS DetailType, 'Alert triggered recently' AS IssueReason,
         (row_number() OVER (PARTITION BY InstanceId, CaptureTime ORDER BY list_position(['Critical', 'Warning', 'Info'], AlertSeverity),
            LastOccurrenceDateTime DESC, OccurrenceCount DESC, AlertName, AlertId))::INT AS rn
  FROM alerts WHERE IsEnabled = 1 AND OccurrenceCount > 0 AND WasTriggeredRecently = 1 QUALIFY rn <= 200)
"""
ORACLES["c61_configuration_issues"] = _ISSUES + "SELECT * FROM reported"
ORACLES["c62_triggered_alerts"] = _FIRED + "SELECT * FROM reported"
_MOMENTS = ", ".join(
    f"'{m}Date: ' || coalesce({m}Date::VARCHAR, ''), '{m}Time: ' || coalesce({m}Time::VARCHAR, ''), "
    f"'{m}DateTime: ' || coalesce(strftime({m}DateTime, '%m/%d/%Y %H:%M:%S'), '')"
    for m in ("LastOccurrence", "LastResponse", "CountReset"))
_ALERT_EVIDENCE = """
SELECT InstanceId, CaptureTime, NULL::VARCHAR AS DatabaseName, 'SqlAgentAlert' AS MetricCategory, DetailType,
       if(DetailType = 'AlertTriggered', AlertSeverity, 'Warning') AS Severity, OccurrenceCount::DECIMAL(28,6) AS NumericValue1,
       WasTriggeredRecently::DECIMAL(28,6) AS NumericValue2,
       array_to_string(['AlertId: ' || AlertId, 'AlertName: ' || AlertName, 'DetailType: ' || DetailType, 'IssueReason: ' || IssueReason,
         'IsEnabled: ' || IsEnabled, 'MessageId: ' || MessageId, 'SeverityNumber: ' || SeverityNumber,
         'DatabaseName: ' || coalesce(DatabaseName, '(none)'), 'EventDescriptionKeyword: ' || coalesce(EventDescriptionKeyword, '(none)'),
         'DelayBetweenResponsesSeconds: ' || DelayBetweenResponsesSeconds, 'OccurrenceCount: ' || OccurrenceCount, """ + _MOMENTS + """,
         'WasTriggeredRecently: ' || WasTriggeredRecently, 'HasNotification: ' || HasNotification,
         'OperatorNames: ' || OperatorNames, 'NotificationMethods: ' || NotificationMethods], chr(10)) AS Details,
       'Collect-SqlAgentAlerts' AS SourceCollector FROM reported"""
ORACLES["c63_issue_evidence"] = _ISSUES + _ALERT_EVIDENCE
ORACLES["c63_trigger_evidence"] = _FIRED + _ALERT_EVIDENCE

# --- the same from stored tables -----------------------------------------------------------------

for stored, plain in (("i1_stored_register", "i1_register"), ("i2_stored_state", "i2_set_state"), ("i5_incremental_runs", "i5_run_lifecycle"),
                      ("i8_stored_failures", "i8_collection_failures"), ("i9_stored_history", "i9_recent_history")):
    ORACLES[stored] = ORACLES[plain]
