"""Blocked requests: their summary, and the longest waits per snapshot with their evidence."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetgauge import fixed_values as fv
from fleetgauge.functions import text
from fleetgauge.functions.ranking import top_per
from fleetgauge.functions.shaping import SNAPSHOT, to_evidence, to_metrics
from fleetgauge.operators.requests import foreign_sessions
from fleetgauge.params import BlockingParams

CATEGORY = "Blocking"
SUMMARY = [
    ("BlockedSessionCount", "count"), ("DistinctBlockingSessionCount", "count"),
    ("MaxWaitSeconds", "sec"), ("TotalWaitSeconds", "sec"),
]


def all_blocked(requests: DataFrame, sessions: DataFrame, params: BlockingParams = BlockingParams()) -> DataFrame:
    """Every blocked request of a foreign user session."""
    statement = F.col("sql_text")
    if params.max_text_length is not None:
        statement = F.substring(statement, 1, params.max_text_length)
    wait = F.coalesce("wait_time", F.lit(0))
    blocked = requests.filter(F.col("blocking_session_id") != 0).select(
        *SNAPSHOT, F.col("session_id").alias("BlockedSessionId"), "request_id",
        F.col("blocking_session_id").alias("BlockingSessionId"), F.col("database_name").alias("DatabaseName"),
        F.col("wait_type").alias("WaitType"), wait.alias("WaitTimeMs"), F.col("wait_time").alias("_wait"),
        (wait.cast("decimal(18,2)") / 1000).cast("decimal(25,8)").alias("WaitSeconds"),
        F.col("status").alias("Status"), F.col("command").alias("Command"), statement.alias("SqlText"),
    )
    others = foreign_sessions(sessions, params.monitor).withColumnRenamed("session_id", "BlockedSessionId")
    return blocked.join(others, [*SNAPSHOT, "BlockedSessionId"])


def longest_blocked(blocked: DataFrame, params: BlockingParams = BlockingParams()) -> DataFrame:
    """The requests of each snapshot with the longest waits."""
    top = top_per(blocked, SNAPSHOT, [F.col("_wait").desc()], ["BlockedSessionId", "request_id"], params.max_rows)
    return top.drop("_wait", "request_id")


def blocked_requests(
    requests: DataFrame, sessions: DataFrame, params: BlockingParams = BlockingParams(),
) -> DataFrame:
    """The blocked user requests of each snapshot with the longest waits."""
    return longest_blocked(all_blocked(requests, sessions, params), params)


def blocking_summary(blocked: DataFrame, roster: DataFrame) -> DataFrame:
    """Counts over all blocked requests; every snapshot of the roster has a row."""
    totals = blocked.groupBy(*SNAPSHOT).agg(
        F.count(F.lit(1)).alias("BlockedSessionCount"),
        F.countDistinct("BlockingSessionId").alias("DistinctBlockingSessionCount"),
        F.max("WaitSeconds").alias("MaxWaitSeconds"),
        F.sum("WaitSeconds").alias("TotalWaitSeconds"),
    )
    return roster.join(totals, SNAPSHOT, "left").select(
        *SNAPSHOT,
        *(F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c, u in SUMMARY if u == "count"),
        *(F.coalesce(c, F.lit(0)).cast("decimal(28,8)").alias(c) for c, u in SUMMARY if u == "sec"),
    )


def blocking_metrics(summary: DataFrame) -> DataFrame:
    return to_metrics(summary, SUMMARY, collector=fv.BLOCKING, category=CATEGORY, object_name="BlockingSummary")


def blocking_evidence(blocked: DataFrame) -> DataFrame:
    c = F.col
    body = text.details([
        ("BlockedSessionId", c("BlockedSessionId")), ("BlockingSessionId", c("BlockingSessionId")),
        ("DatabaseName", c("DatabaseName"), text.UNKNOWN), ("WaitType", c("WaitType"), text.UNKNOWN),
        ("WaitTimeMs", c("WaitTimeMs")), ("WaitSeconds", c("WaitSeconds")),
        ("Status", c("Status"), text.UNKNOWN), ("Command", c("Command"), text.UNKNOWN),
        ("LoginName", c("LoginName"), text.UNKNOWN), ("HostName", c("HostName"), text.UNKNOWN),
        ("ProgramName", c("ProgramName"), text.UNKNOWN), ("SQL text", c("SqlText"), text.UNAVAILABLE),
    ])
    return to_evidence(
        blocked, collector=fv.BLOCKING, category=CATEGORY, detail_type=F.lit("BlockingDetail"),
        severity=F.lit("Warning"), body=body, value1=c("WaitSeconds"), value2=c("BlockingSessionId"),
        database=text.or_default(c("DatabaseName"), text.UNKNOWN),
    )
