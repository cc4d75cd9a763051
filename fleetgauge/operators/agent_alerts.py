"""Agent alerts: decoded times, notification lists, severity, configuration issues and recent triggers."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetgauge import fixed_values as fv
from fleetgauge.functions import text
from fleetgauge.functions.ranking import top_per
from fleetgauge.functions.shaping import SNAPSHOT, to_evidence, to_metrics
from fleetgauge.functions.timing import decode_date_time, now_or
from fleetgauge.params import AlertParams

CATEGORY = "SqlAgentAlert"
# Notification method codes.
METHODS = {1: "Email", 2: "Pager", 4: "NetSend", 7: "Email/Pager/NetSend"}
SUMMARY = [
    "TotalAlerts", "EnabledAlerts", "DisabledAlerts", "SeverityAlerts", "ErrorNumberAlerts",
    "AlertsWithNotifications", "AlertsWithoutNotifications", "AlertsWithOccurrences", "AlertsTriggeredRecently",
    "AlertsRespondedRecently", "MaxOccurrenceCount",
]
_MOMENTS = {"LastOccurrence": "last_occurrence", "LastResponse": "last_response", "CountReset": "count_reset"}


def decoded_alerts(alerts: DataFrame) -> DataFrame:
    """Alerts under report names, the three integer date and time pairs also as moments; date 0 means never."""
    c = F.col
    moments = []
    for name, source in _MOMENTS.items():
        date, time = c(f"{source}_date"), c(f"{source}_time")
        moments += [date.alias(f"{name}Date"), time.alias(f"{name}Time"),
                    F.when(date != 0, decode_date_time(date, time)).alias(f"{name}DateTime")]
    return alerts.select(
        *SNAPSHOT, c("id").alias("AlertId"), c("name").alias("AlertName"), c("enabled").alias("IsEnabled"),
        c("message_id").alias("MessageId"), c("severity").alias("SeverityNumber"),
        c("database_name").alias("DatabaseName"), c("event_description_keyword").alias("EventDescriptionKeyword"),
        c("delay_between_responses").alias("DelayBetweenResponsesSeconds"),
        F.coalesce("occurrence_count", F.lit(0)).alias("OccurrenceCount"), *moments,
    )


def _sorted_list(values: Column) -> Column:
    return F.array_join(F.array_sort(F.collect_set(values)), ", ")


def notification_lists(notifications: DataFrame, operators: DataFrame) -> DataFrame:
    """Per alert the distinct operator names and methods, comma separated; only alerts with notifications."""
    named = operators.select(*SNAPSHOT, F.col("id").alias("operator_id"), F.col("name").alias("_operator"))
    method = F.when(F.col("notification_method").isNull(), text.NONE)
    for code, label in METHODS.items():
        method = method.when(F.col("notification_method") == code, label)
    return (
        notifications.join(named, [*SNAPSHOT, "operator_id"], "left")
        .groupBy(*SNAPSHOT, F.col("alert_id").alias("AlertId"))
        .agg(
            _sorted_list(F.coalesce("_operator", F.lit(text.NONE))).alias("OperatorNames"),
            _sorted_list(method.otherwise("Other")).alias("NotificationMethods"),
        )
    )


def alert_severity() -> Column:
    severity, message = F.col("SeverityNumber"), F.col("MessageId")
    return (
        F.when((severity >= 20) | message.isin(fv.CRITICAL_MESSAGES), "Critical")
        .when(severity.between(16, 19) | (message > 0), "Warning")
        .otherwise("Info")
    )


def flagged_alerts(
    alerts: DataFrame, notifications: DataFrame, as_of: datetime | None = None, params: AlertParams = AlertParams(),
) -> DataFrame:
    """Decoded alerts with severity and flags, without the notification lists most results do not show."""
    earliest = now_or(as_of) - F.expr(f"INTERVAL '{params.lookback_hours}' HOUR")

    def flag(condition: Column) -> Column:
        return F.when(condition, 1).otherwise(0)

    notified = notifications.groupBy(*SNAPSHOT, F.col("alert_id").alias("AlertId")).agg(
        F.count(F.lit(1)).alias("_notifications")
    )
    joined = decoded_alerts(alerts).join(notified, [*SNAPSHOT, "AlertId"], "left")
    return joined.withColumns({
        "HasNotification": flag(F.col("_notifications") > 0),
        "WasTriggeredRecently": flag(F.col("LastOccurrenceDateTime") >= earliest),
        "RespondedRecently": flag(F.col("LastResponseDateTime") >= earliest),
        "AlertSeverity": alert_severity(),
    }).drop("_notifications")


def with_notification_lists(flagged: DataFrame, notifications: DataFrame, operators: DataFrame) -> DataFrame:
    """Add operator names and methods, '(none)' where an alert notifies nobody."""
    joined = flagged.join(notification_lists(notifications, operators), [*SNAPSHOT, "AlertId"], "left")
    return joined.withColumns({
        name: F.coalesce(name, F.lit(text.NONE)) for name in ("OperatorNames", "NotificationMethods")
    })


def _with_own_lists(chosen: DataFrame, notifications: DataFrame, operators: DataFrame) -> DataFrame:
    """The lists of few chosen alerts, from the notifications of those alerts only."""
    keys = chosen.select(*SNAPSHOT, F.col("AlertId").alias("alert_id"))
    related = notifications.join(keys, [*SNAPSHOT, "alert_id"], "left_semi")
    return with_notification_lists(chosen, related, operators)


def alert_summary(flagged: DataFrame, roster: DataFrame) -> DataFrame:
    c = F.col
    counted = {
        "EnabledAlerts": c("IsEnabled") == 1, "DisabledAlerts": c("IsEnabled") == 0,
        "SeverityAlerts": c("SeverityNumber") > 0, "ErrorNumberAlerts": c("MessageId") > 0,
        "AlertsWithNotifications": c("HasNotification") == 1, "AlertsWithoutNotifications": c("HasNotification") == 0,
        "AlertsWithOccurrences": c("OccurrenceCount") > 0, "AlertsTriggeredRecently": c("WasTriggeredRecently") == 1,
        "AlertsRespondedRecently": c("RespondedRecently") == 1,
    }
    totals = flagged.groupBy(*SNAPSHOT).agg(
        F.count(F.lit(1)).alias("TotalAlerts"),
        *(F.count_if(condition).alias(name) for name, condition in counted.items()),
        F.max("OccurrenceCount").alias("MaxOccurrenceCount"),
    )
    return roster.join(totals, SNAPSHOT, "left").fillna(0)


def configuration_issues(
    flagged: DataFrame, notifications: DataFrame, operators: DataFrame, params: AlertParams = AlertParams(),
) -> DataFrame:
    """Alerts that are disabled or notify nobody."""
    issues = flagged.filter("IsEnabled = 0 OR HasNotification = 0").withColumns({
        "DetailType": F.lit("AlertConfigIssue"),
        "IssueReason": F.when(F.col("IsEnabled") == 0, "Alert disabled").otherwise("Alert has no notification"),
    })
    order = [F.col(c).asc() for c in ("IsEnabled", "HasNotification", "AlertName")]
    chosen = top_per(issues, SNAPSHOT, order, ["AlertId"], params.max_rows)
    return _with_own_lists(chosen, notifications, operators)


def triggered_alerts(
    flagged: DataFrame, notifications: DataFrame, operators: DataFrame, params: AlertParams = AlertParams(),
) -> DataFrame:
    """Enabled alerts that fired within the lookback, the most severe first."""
    c = F.col
    fired = flagged.filter("IsEnabled = 1 AND OccurrenceCount > 0 AND WasTriggeredRecently = 1").withColumns({
        "DetailType": F.lit("AlertTriggered"), "IssueReason": F.lit("Alert triggered recently"),
    })
    rank = F.when(c("AlertSeverity") == "Critical", 1).when(c("AlertSeverity") == "Warning", 2).otherwise(3)
    order = [rank.asc(), c("LastOccurrenceDateTime").desc(), c("OccurrenceCount").desc(), c("AlertName").asc()]
    chosen = top_per(fired, SNAPSHOT, order, ["AlertId"], params.max_rows)
    return _with_own_lists(chosen, notifications, operators)


def alert_metrics(summary: DataFrame) -> DataFrame:
    return to_metrics(
        summary, [(c, "count") for c in SUMMARY], collector=fv.AGENT_ALERTS, category=CATEGORY,
        object_name="SqlAgentAlertSummary",
    )


def alert_evidence(reported: DataFrame) -> DataFrame:
    """Evidence for issues and triggers; only triggers carry the alert's own severity."""
    c = F.col
    moments = [
        (f"{m}{part}", text.moment_text(c(f"{m}{part}")) if part == "DateTime" else c(f"{m}{part}"))
        for m in _MOMENTS for part in ("Date", "Time", "DateTime")
    ]
    body = text.details([
        ("AlertId", c("AlertId")), ("AlertName", c("AlertName"), text.UNKNOWN), ("DetailType", c("DetailType")),
        ("IssueReason", c("IssueReason")), ("IsEnabled", c("IsEnabled")), ("MessageId", c("MessageId")),
        ("SeverityNumber", c("SeverityNumber")), ("DatabaseName", c("DatabaseName"), text.NONE),
        ("EventDescriptionKeyword", c("EventDescriptionKeyword"), text.NONE),
        ("DelayBetweenResponsesSeconds", c("DelayBetweenResponsesSeconds")),
        ("OccurrenceCount", c("OccurrenceCount")), *moments, ("WasTriggeredRecently", c("WasTriggeredRecently")),
        ("HasNotification", c("HasNotification")), ("OperatorNames", c("OperatorNames"), text.NONE),
        ("NotificationMethods", c("NotificationMethods"), text.NONE),
    ])
    severity = F.when(c("DetailType") == "AlertTriggered", c("AlertSeverity")).otherwise("Warning")
    return to_evidence(
        reported, collector=fv.AGENT_ALERTS, category=CATEGORY, detail_type=c("DetailType"), severity=severity,
        body=body, value1=c("OccurrenceCount"), value2=c("WasTriggeredRecently"),
    )
