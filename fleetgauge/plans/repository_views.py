"""Views over the stored tables: latest series, health summary, evidence lists and row counts."""

from __future__ import annotations

from datetime import date
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetgauge import fixed_values as fv
from fleetgauge.functions.ranking import newest_of_series, top_overall
from fleetgauge.operators.runs import row_counts
from fleetgauge.sources import tables
from fleetgauge.sources.tables import since
from fleetgauge.sources.versions import newest_first

_NEWEST = ["CaptureTime", "MetricSnapshotId"]
_NAMES = ["InstanceId", "InstanceName", "EnvironmentName"]

# Health summary: output column -> (category, counters).
_SUMMARY = {
    "UserConnections": ("PerformanceCounter", ["User Connections"]),
    "ActiveRequestCount": ("ActiveRequest", ["ActiveRequestCount"]),
    "BlockedSessionCount": ("Blocking", ["BlockedSessionCount"]),
    "MaxBlockingWaitSeconds": ("Blocking", ["MaxWaitSeconds"]),
    "FailedJobs": ("SqlAgentJob", ["RecentFailedJobs"]),
    "RunningJobs": ("SqlAgentJob", ["RunningJobCount"]),
    "BackupIssues": ("Backup", [
        "DatabasesWithoutFullBackup", "DatabasesWithOldFullBackup", "FullRecoveryDatabasesWithoutLogBackup",
        "FullRecoveryDatabasesWithOldLogBackup",
    ]),
    "TriggeredAlerts": ("SqlAgentAlert", ["AlertsTriggeredRecently"]),
}
_WARNING_SIGNS = ["BlockedSessionCount", "FailedJobs", "BackupIssues", "TriggeredAlerts"]


def latest_metrics(metrics: DataFrame, first_day: date | None = None) -> DataFrame:
    """The newest row of each series; a NULL and an empty database or sub-instance are the same series."""
    keys = ["InstanceId", "MetricCategory", "ObjectName", "CounterName"]
    newest = [F.col(c).desc() for c in _NEWEST]
    return newest_of_series(since(metrics, first_day), keys, ["DatabaseName", "InstanceName"], newest).drop("capture_date")


def instance_health_summary(
    metrics: DataFrame, instances: DataFrame, backup_category: str = "Backup", first_day: date | None = None,
) -> DataFrame:
    """Eight latest metrics per enabled instance and an overall status.

    Only the series of those metrics are ranked; the last capture time is a plain maximum over all rows.
    """
    metrics = since(metrics, first_day)
    summary = {**_SUMMARY, "BackupIssues": (backup_category, _SUMMARY["BackupIssues"][1])}

    def matches(category: str, counters: list[str]) -> Column:
        return (F.col("MetricCategory") == category) & F.col("CounterName").isin(counters)

    wanted = metrics.filter(reduce(or_, (matches(*spec) for spec in summary.values())))
    values = latest_metrics(wanted).groupBy("InstanceId").agg(
        *(F.max(F.when(matches(*spec), F.col("MetricValue"))).alias(name) for name, spec in summary.items())
    )
    captured = metrics.groupBy("InstanceId").agg(F.max("CaptureTime").alias("LastMetricCaptureTime"))
    alarming = reduce(or_, (F.coalesce(F.col(c) > 0, F.lit(False)) for c in _WARNING_SIGNS))
    return (
        instances.filter("IsEnabled").select(*_NAMES, "CollectionProfile")
        .join(values, "InstanceId", "left").join(captured, "InstanceId", "left")
        .select(
            *_NAMES, "CollectionProfile", *summary,
            F.when(alarming, "Warning").otherwise("Healthy").alias("HealthStatus"), "LastMetricCaptureTime",
        )
    )


def operations_summary(health: DataFrame) -> DataFrame:
    """The health summary with zeros for missing numbers."""
    shown = {"FailedJobs": "FailedJobs", "RunningJobs": "RunningJobs", "BackupIssues": "BackupIssues",
             "TriggeredAlerts": "TriggeredAlerts", "BlockedSessions": "BlockedSessionCount"}
    numbers = [F.coalesce(F.col(source), F.lit(0).cast("decimal(28,6)")).alias(name) for name, source in shown.items()]
    return health.select(*_NAMES, *numbers, "HealthStatus", "LastMetricCaptureTime")


def _evidence_of(collector: str, evidence: DataFrame, instances: DataFrame) -> DataFrame:
    return evidence.filter(F.col("SourceCollector") == collector).join(instances.select(*_NAMES), "InstanceId")


def backup_compliance(evidence: DataFrame, instances: DataFrame) -> DataFrame:
    issue = F.col("DetailType")
    status = (
        F.when(issue.isin("MissingFullBackup", "MissingLogBackup"), "Critical")
        .when(issue.isin("OldFullBackup", "OldLogBackup"), "Warning")
        .otherwise("Healthy")
    )
    return _evidence_of(fv.BACKUPS, evidence, instances).select(
        "MetricTextSnapshotId", *_NAMES, "CaptureTime", "DatabaseName", issue.alias("BackupIssueType"), "Severity",
        "Details", status.alias("Status"),
    )


def top_problem_queries(evidence: DataFrame, instances: DataFrame, top: int = 500) -> DataFrame:
    """The newest and most expensive statements of the fleet.

    Chosen on narrow rows; the wide text is then fetched for the chosen ids only, which are
    at most ``top`` rows and so always small enough to broadcast.  A row that is stored twice counts once.
    """
    if top > 100_000:
        raise ValueError("top must be at most 100000")
    # Joining on the partition date too lets the scan for the texts skip all other dates.
    key = ["capture_date", "InstanceId", "CaptureTime", "MetricTextSnapshotId"]
    order = ["CaptureTime", "NumericValue1", "NumericValue2"]
    narrow = _evidence_of(fv.QUERY_STATS, evidence, instances).select(*_NAMES, *order, key[0], key[-1])
    chosen = top_overall(narrow, [F.col(c).desc() for c in order], [key[-1]], top)
    texts = evidence.filter(F.col("SourceCollector") == fv.QUERY_STATS).select(
        *key, "DatabaseName", "DetailType", "Severity", "Details", "SourceCollector",
    )
    return texts.join(F.broadcast(chosen), key).dropDuplicates(key).select(
        "MetricTextSnapshotId", *_NAMES, "CaptureTime", "DatabaseName", "DetailType", "Severity",
        F.col("NumericValue1").alias("AvgCpuMs"), F.col("NumericValue2").alias("AvgElapsedMs"), "Details",
        "SourceCollector",
    ).orderBy(F.col("CaptureTime").desc(), F.col("AvgCpuMs").desc(), F.col("AvgElapsedMs").desc(), key[-1])


def stored_problem_queries(spark: SparkSession, evidence_path: str, instances: DataFrame, top: int = 500) -> DataFrame:
    """``top_problem_queries`` of the stored evidence.  The order starts with the capture time, so dates are added from the
    newest on until they hold enough statements; older dates are neither listed nor opened."""
    evidence = tables.open_table(spark, evidence_path, "MetricTextSnapshot").latest()

    def matching(rows: DataFrame) -> DataFrame:
        return _evidence_of(fv.QUERY_STATS, rows, instances).select("MetricTextSnapshotId").distinct()

    newest = newest_first(evidence, tables.schema_of("MetricTextSnapshot"), top, matching)
    return top_problem_queries(newest, instances, top)


def wait_stats_summary(evidence: DataFrame, instances: DataFrame) -> DataFrame:
    return _evidence_of(fv.WAIT_STATS, evidence, instances).select(
        "MetricTextSnapshotId", *_NAMES, "CaptureTime", "DetailType", "Severity", "NumericValue1", "NumericValue2",
        "Details", "SourceCollector",
    )


def database_io_summary(metrics: DataFrame, instances: DataFrame) -> DataFrame:
    # The category is part of the series key, so filtering before ranking gives the same rows.
    latest = latest_metrics(metrics.filter("MetricCategory = 'DatabaseIO'")).drop("InstanceName")
    return latest.join(instances.select(*_NAMES), "InstanceId").select(
        *_NAMES, "CaptureTime", "DatabaseName", "ObjectName", "CounterName", "MetricValue", "Unit", "SourceCollector",
    )


def repository_row_counts(
    metrics: DataFrame, evidence: DataFrame, runs: DataFrame, instances: DataFrame,
) -> DataFrame:
    """One row with the size of each table."""
    counted = {
        "MetricSnapshotRows": metrics, "MetricTextSnapshotRows": evidence, "CollectionRunHistoryRows": runs,
        "MonitoredInstances": instances.filter("IsEnabled"),
    }
    return row_counts(counted).agg(
        *(F.max(F.when(F.col("TableName") == name, F.col("RowCount"))).alias(name) for name in counted)
    )
