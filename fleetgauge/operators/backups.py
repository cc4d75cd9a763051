"""Backup compliance: newest backups per database, their ages and the issues they raise."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetgauge import fixed_values as fv
from fleetgauge.functions import text
from fleetgauge.functions.ranking import newest_per, top_per
from fleetgauge.functions.shaping import SNAPSHOT, to_evidence, to_metrics
from fleetgauge.functions.timing import hours_crossed, now_or, seconds_crossed
from fleetgauge.params import BackupParams

CATEGORY = "BackupCompliance"
# Backup type codes.
KINDS = {"D": "Full", "I": "Diff", "L": "Log"}
SUMMARY = [
    ("DatabaseCount", "count"), ("DatabasesWithoutFullBackup", "count"), ("DatabasesWithOldFullBackup", "count"),
    ("DatabasesWithOldDiffBackup", "count"), ("RecoveryModelViolations", "count"),
    ("DatabasesWithoutRequiredLogBackup", "count"), ("DatabasesWithOldRequiredLogBackup", "count"),
    ("NonCompliantDatabaseCount", "count"), ("MaxFullBackupAgeHours", "hours"), ("MaxLogBackupAgeHours", "hours"),
]


def last_backups(backupset: DataFrame, media: DataFrame) -> DataFrame:
    """The newest backup per database and type, with its device; media are joined to the chosen ones only."""
    c = F.col
    newest = newest_per(
        backupset.filter(c("type").isin(*KINDS)), [*SNAPSHOT, "database_name", "type"],
        [c("backup_finish_date").desc(), c("media_set_id").desc()],
    ).drop("rn")
    devices = media.select(*SNAPSHOT, "media_set_id", "physical_device_name")
    size = {"BackupSizeMB": "backup_size", "CompressedBackupSizeMB": "compressed_backup_size"}
    return newest.join(devices, [*SNAPSHOT, "media_set_id"], "left").groupBy(
        *SNAPSHOT, "database_name", "type", "backup_finish_date", "backup_start_date", *size.values(),
    ).agg(F.min("physical_device_name").alias("PhysicalDeviceName")).select(
        *SNAPSHOT, "database_name", "type", "backup_finish_date",
        *((c(s).cast("decimal(20,0)") / 1048576).cast("decimal(19,2)").alias(n) for n, s in size.items()),
        seconds_crossed(c("backup_start_date"), c("backup_finish_date")).cast("int").alias("DurationSeconds"),
        "PhysicalDeviceName",
    )


def backup_policy(instances: DataFrame) -> DataFrame:
    """What each instance's profile asks for; see ``inventory.enabled_profiles``."""
    full = F.col("ComplianceProfile") == fv.FULL_PROFILE
    return instances.select(
        "InstanceId", "ComplianceProfile",
        F.when(full, "FULL").otherwise("SIMPLE").alias("ExpectedRecoveryModel"),
        full.alias("RequiresLogBackups"),
    )


def backup_status(databases: DataFrame, backups: DataFrame) -> DataFrame:
    """One row per online database with its last full, differential and log backup, if any."""
    columns = {
        "Last{}BackupTime": "backup_finish_date", "Last{}BackupSizeMB": "BackupSizeMB",
        "Last{}BackupDurationSeconds": "DurationSeconds", "Last{}BackupDevice": "PhysicalDeviceName",
    }
    last = backups.groupBy(*SNAPSHOT, F.col("database_name").alias("DatabaseName")).agg(*[
        F.max(F.when(F.col("type") == code, F.col(source))).alias(name.format(kind))
        for name, source in columns.items() for code, kind in KINDS.items()
    ])
    online = databases.filter((F.col("name") != "tempdb") & (F.col("state_desc") == "ONLINE")).select(
        *SNAPSHOT, F.col("name").alias("DatabaseName"), "recovery_model_desc", "state_desc",
    )
    numbers = [n.format(k) for n in columns if n.endswith(("SizeMB", "Seconds")) for k in KINDS.values()]
    return online.join(last, [*SNAPSHOT, "DatabaseName"], "left").fillna(0, numbers)


def with_ages(status: DataFrame, as_of: datetime | None = None) -> DataFrame:
    return status.withColumns({
        f"Last{kind}BackupAgeHours": hours_crossed(F.col(f"Last{kind}BackupTime"), now_or(as_of))
        for kind in KINDS.values()
    })


def compliance_base(
    databases: DataFrame, backupset: DataFrame, media: DataFrame, policy: DataFrame, as_of: datetime | None = None,
) -> DataFrame:
    """The whole chain from databases and backups to ages and policy per database."""
    return with_ages(backup_status(databases, last_backups(backupset, media)), as_of).join(policy, "InstanceId")


def _rules(params: BackupParams) -> dict[str, Column]:
    c = F.col
    logged = c("RequiresLogBackups") & c("recovery_model_desc").isin("FULL", "BULK_LOGGED")
    return {
        "RecoveryModelMismatch": c("recovery_model_desc") != c("ExpectedRecoveryModel"),
        "MissingFullBackup": c("LastFullBackupTime").isNull(),
        "OldFullBackup": c("LastFullBackupAgeHours") > params.full_hours,
        "MissingLogBackup": logged & c("LastLogBackupTime").isNull(),
        "OldLogBackup": logged & (c("LastLogBackupAgeHours") > params.log_hours),
    }


def _first(rules: dict[str, Column], values: dict[str, object], default: object) -> Column:
    chosen = F.lit(default)
    for name in reversed(list(values)):
        chosen = F.when(rules[name], F.lit(values[name])).otherwise(chosen)
    return chosen


def issue_type(params: BackupParams = BackupParams()) -> Column:
    rules = _rules(params)
    return _first(rules, {name: name for name in rules}, "OK")


def issue_severity(params: BackupParams = BackupParams()) -> Column:
    rules = _rules(params)
    return _first(rules, {n: "Warning" if n == "OldFullBackup" else "Critical" for n in rules}, "Info")


def compliance_summary(base: DataFrame, roster: DataFrame, params: BackupParams = BackupParams()) -> DataFrame:
    rules = _rules(params)
    totals = base.groupBy(*SNAPSHOT).agg(
        F.count(F.lit(1)).alias("DatabaseCount"),
        F.count_if(rules["MissingFullBackup"]).alias("DatabasesWithoutFullBackup"),
        F.count_if(rules["OldFullBackup"]).alias("DatabasesWithOldFullBackup"),
        F.count_if(F.col("LastDiffBackupAgeHours") > params.diff_hours).alias("DatabasesWithOldDiffBackup"),
        F.count_if(rules["RecoveryModelMismatch"]).alias("RecoveryModelViolations"),
        F.count_if(rules["MissingLogBackup"]).alias("DatabasesWithoutRequiredLogBackup"),
        F.count_if(rules["OldLogBackup"]).alias("DatabasesWithOldRequiredLogBackup"),
        F.count_if(issue_type(params) != "OK").alias("NonCompliantDatabaseCount"),
        F.max("LastFullBackupAgeHours").alias("MaxFullBackupAgeHours"),
        F.max("LastLogBackupAgeHours").alias("MaxLogBackupAgeHours"),
    )
    # A database without a backup counts as age 0, so the maximum is never below 0.
    ages = {c: F.greatest(F.col(c), F.lit(0)) for c, unit in SUMMARY if unit == "hours"}
    return roster.join(totals, SNAPSHOT, "left").fillna(0).withColumns(ages)


def compliance_issues(base: DataFrame, params: BackupParams = BackupParams()) -> DataFrame:
    """The non-compliant databases of each snapshot in order of urgency."""
    rules = _rules(params)
    urgency = ["RecoveryModelMismatch", "MissingFullBackup", "MissingLogBackup", "OldLogBackup", "OldFullBackup"]
    issues = base.withColumns({
        "IssueType": issue_type(params), "Severity": issue_severity(params),
        "_urgency": _first(rules, {name: i for i, name in enumerate(urgency, 1)}, 99),
    }).filter("IssueType <> 'OK'")
    return top_per(issues, SNAPSHOT, [F.col("_urgency").asc()], ["DatabaseName"], params.max_rows).drop("_urgency")


def compliance_metrics(summary: DataFrame) -> DataFrame:
    return to_metrics(
        summary, SUMMARY, collector=fv.BACKUPS, category=CATEGORY, object_name="BackupComplianceSummary",
    )


def compliance_evidence(issues: DataFrame) -> DataFrame:
    c = F.col
    kinds = list(KINDS.values())
    body = text.details([
        ("DatabaseName", c("DatabaseName"), text.UNKNOWN), ("IssueType", c("IssueType")), ("Severity", c("Severity")),
        ("ComplianceProfile", c("ComplianceProfile")), ("ExpectedRecoveryModel", c("ExpectedRecoveryModel")),
        ("ActualRecoveryModel", c("recovery_model_desc")),
        ("RequiresLogBackups", F.when(c("RequiresLogBackups"), "True").otherwise("False")),
        *((f"Last{k}BackupTime", text.moment_text(c(f"Last{k}BackupTime"))) for k in kinds),
        *((f"Last{k}Backup{part}", c(f"Last{k}Backup{part}"))
          for part in ("AgeHours", "SizeMB", "DurationSeconds", "Device") for k in kinds),
    ])
    return to_evidence(
        issues, collector=fv.BACKUPS, category=CATEGORY, detail_type=c("IssueType"), severity=c("Severity"),
        body=body, value1=F.coalesce("LastFullBackupAgeHours", F.lit(0)),
        database=text.or_default(c("DatabaseName"), text.UNKNOWN),
    )
