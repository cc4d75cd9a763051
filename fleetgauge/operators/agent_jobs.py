"""Scheduled jobs: decoded run history, running jobs, their summary and evidence."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetgauge import fixed_values as fv
from fleetgauge.functions import text
from fleetgauge.functions.ranking import top_per
from fleetgauge.functions.shaping import SNAPSHOT, to_evidence, to_metrics
from fleetgauge.functions.timing import decode_date_time, decode_duration, now_or, seconds_crossed
from fleetgauge.params import JobParams

CATEGORY = "SqlAgentJob"
# Run status codes.
RUN_STATES = {0: "Failed", 1: "Succeeded", 2: "Retry", 3: "Canceled", 4: "In Progress"}
REPORTED_STATES = [0, 2, 3]
INVENTORY = ["TotalEnabledJobs", "TotalDisabledJobs"]
OUTCOMES = {"RecentSucceededJobs": 1, "RecentFailedJobs": 0, "RecentCanceledJobs": 3, "RecentRetryJobs": 2}
SUMMARY = [
    *((c, "count") for c in INVENTORY), ("RecentCompletedJobs", "count"), *((c, "count") for c in OUTCOMES),
    ("MaxRunDurationSeconds", "sec"), ("AvgRunDurationSeconds", "sec"), ("RunningJobCount", "count"),
    ("MaxRunningSeconds", "sec"),
]


def _named(jobs: DataFrame) -> DataFrame:
    return jobs.select(*SNAPSHOT, "job_id", F.col("name").alias("JobName"), "enabled")


def _state(code: Column) -> Column:
    label = F.lit("Unknown")
    for value, name in RUN_STATES.items():
        label = F.when(code == value, name).otherwise(label)
    return label


def recent_runs(
    history: DataFrame, jobs: DataFrame, as_of: datetime | None = None, params: JobParams = JobParams(),
) -> DataFrame:
    """Whole-job outcomes within the lookback, codes and integer times decoded."""
    c = F.col
    earliest = now_or(as_of) - F.expr(f"INTERVAL '{params.lookback_hours}' HOUR")
    decoded = history.filter("step_id = 0").select(
        *SNAPSHOT, "job_id", "instance_id", "step_id", "step_name", "run_status",
        _state(c("run_status")).alias("RunStatusDescription"),
        decode_date_time(c("run_date"), c("run_time")).alias("RunDateTime"),
        decode_duration(c("run_duration")).alias("RunDurationSeconds"), c("message").alias("Message"),
    )
    return decoded.filter(c("RunDateTime") >= earliest).join(_named(jobs), [*SNAPSHOT, "job_id"])


def running_jobs(
    activity: DataFrame, jobs: DataFrame, agent_sessions: DataFrame, as_of: datetime | None = None,
) -> DataFrame:
    """Jobs started and not stopped in the newest agent session of their snapshot."""
    newest = agent_sessions.groupBy(*SNAPSHOT).agg(F.max("session_id").alias("session_id"))
    open_runs = activity.filter("start_execution_date IS NOT NULL AND stop_execution_date IS NULL")
    return (
        open_runs.join(newest, [*SNAPSHOT, "session_id"]).join(_named(jobs), [*SNAPSHOT, "job_id"])
        .select(
            *SNAPSHOT, "job_id", "JobName", F.col("start_execution_date").alias("StartExecutionDate"),
            seconds_crossed(F.col("start_execution_date"), now_or(as_of)).alias("RunningSeconds"),
        )
    )


def job_inventory(jobs: DataFrame, roster: DataFrame) -> DataFrame:
    totals = jobs.groupBy(*SNAPSHOT).agg(
        F.count_if(F.col("enabled") == 1).alias("TotalEnabledJobs"),
        F.count_if(F.col("enabled") == 0).alias("TotalDisabledJobs"),
    )
    return roster.join(totals, SNAPSHOT, "left").fillna(0)


def outcome_summary(recent: DataFrame, roster: DataFrame) -> DataFrame:
    """Runs by outcome, longest and average duration; the average keeps six digits, cut off."""
    totals = recent.groupBy(*SNAPSHOT).agg(
        F.count(F.lit(1)).alias("RecentCompletedJobs"),
        *(F.count_if(F.col("run_status") == code).alias(name) for name, code in OUTCOMES.items()),
        F.max("RunDurationSeconds").alias("MaxRunDurationSeconds"),
        F.sum("RunDurationSeconds").alias("_seconds"),
    )
    micro = F.expr("(_seconds * 1000000) div RecentCompletedJobs")
    average = (micro.cast("decimal(25,0)") / 1000000).cast("decimal(25,6)")
    filled = roster.join(totals, SNAPSHOT, "left").withColumn("AvgRunDurationSeconds", average).drop("_seconds")
    return filled.withColumns({
        c: F.coalesce(c, F.lit(0).cast(t)) for c, t in filled.dtypes if c not in SNAPSHOT
    })


def running_summary(running: DataFrame, roster: DataFrame) -> DataFrame:
    totals = running.groupBy(*SNAPSHOT).agg(
        F.count(F.lit(1)).alias("RunningJobCount"), F.max("RunningSeconds").alias("MaxRunningSeconds"),
    )
    return roster.join(totals, SNAPSHOT, "left").fillna(0)


def failed_runs(recent: DataFrame, params: JobParams = JobParams()) -> DataFrame:
    """Failed, retried and canceled runs of each snapshot, newest first."""
    reported = recent.filter(F.col("run_status").isin(REPORTED_STATES))
    return top_per(reported, SNAPSHOT, [F.col("RunDateTime").desc()], ["instance_id"], params.max_rows)


def longest_running(running: DataFrame, params: JobParams = JobParams()) -> DataFrame:
    severity = F.when(F.col("RunningSeconds") >= params.long_running_seconds, "Warning").otherwise("Info")
    order = [F.col("RunningSeconds").desc()]
    return top_per(
        running, SNAPSHOT, order, ["job_id", "StartExecutionDate"], params.max_rows,
    ).withColumn("Severity", severity)


def job_metrics(inventory: DataFrame, outcomes: DataFrame, running: DataFrame) -> DataFrame:
    summary = inventory.join(outcomes, SNAPSHOT).join(running, SNAPSHOT)
    return to_metrics(summary, SUMMARY, collector=fv.AGENT_JOBS, category=CATEGORY, object_name="SqlAgentJobSummary")


def failure_evidence(failed: DataFrame) -> DataFrame:
    c = F.col
    body = text.details([
        ("JobName", c("JobName"), text.UNKNOWN), ("RunDateTime", text.moment_text(c("RunDateTime"))),
        ("RunDurationSeconds", c("RunDurationSeconds")), ("RunStatus", c("RunStatusDescription")),
        ("Message", c("Message"), text.NONE),
    ])
    return to_evidence(
        failed, collector=fv.AGENT_JOBS, category=CATEGORY, detail_type=F.lit("JobFailure"),
        severity=F.lit("Warning"), body=body, value1=c("RunDurationSeconds"),
    )


def running_evidence(running: DataFrame) -> DataFrame:
    c = F.col
    body = text.details([
        ("JobName", c("JobName"), text.UNKNOWN), ("StartExecutionDate", text.moment_text(c("StartExecutionDate"))),
        ("RunningSeconds", c("RunningSeconds")),
    ])
    return to_evidence(
        running, collector=fv.AGENT_JOBS, category=CATEGORY, detail_type=F.lit("RunningJob"),
        severity=c("Severity"), body=body, value1=c("RunningSeconds"),
    )
