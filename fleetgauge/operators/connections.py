"""Session counts: a summary per snapshot and breakdowns by login, host, application and database."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetgauge import fixed_values as fv
from fleetgauge.functions.ranking import top_per
from fleetgauge.functions.shaping import SNAPSHOT, metric_rows, to_metrics
from fleetgauge.functions.text import UNKNOWN, name_key
from fleetgauge.params import ConnectionParams

CATEGORY = "Connection"
BREAKDOWNS = ("Login", "Host", "Application", "Database")


def session_groups(sessions: DataFrame) -> DataFrame:
    """Session count per snapshot, breakdown type and key, which all results share.

    Names are one key whatever their case and blanks at the end; the label is the first of their spellings.  Sessions are
    counted by spelling first, in a hash aggregation; only the spellings are then brought together.
    """
    keys = [
        ("Login", F.col("login_name"), F.col("login_name")),
        ("Host", F.col("host_name"), F.col("host_name")),
        ("Application", F.col("program_name"), F.col("program_name")),
        ("Database", F.col("database_id").cast("string"), F.col("database_name")),
    ]
    long = F.inline(F.array(*[
        F.struct(F.lit(kind).alias("BreakdownType"), key.alias("GroupKey"), label.alias("Label"))
        for kind, key, label in keys
    ]))
    spelled = (
        sessions.filter("is_user_process")
        .select(*SNAPSHOT, long)
        .groupBy(*SNAPSHOT, "BreakdownType", "GroupKey", "Label")
        .agg(F.count(F.lit(1)).alias("SessionCount"))
    )
    return spelled.groupBy(*SNAPSHOT, "BreakdownType", name_key(F.col("GroupKey")).alias("GroupKey")).agg(
        F.min("Label").alias("Label"), F.sum("SessionCount").alias("SessionCount"))


def session_summary(groups: DataFrame, roster: DataFrame) -> DataFrame:
    """Total sessions and distinct non-blank keys; every snapshot of the roster has a row."""

    def distinct(kind: str):
        return F.count_if((F.col("BreakdownType") == kind) & (F.col("GroupKey") != ""))

    totals = groups.groupBy(*SNAPSHOT).agg(
        F.sum(F.when(F.col("BreakdownType") == "Login", F.col("SessionCount"))).alias("TotalUserSessions"),
        distinct("Login").alias("DistinctLogins"),
        distinct("Host").alias("DistinctHosts"),
        distinct("Application").alias("DistinctApplications"),
    )
    return roster.join(totals, SNAPSHOT, "left").fillna(0)


def session_breakdown(
    groups: DataFrame, kinds: tuple[str, ...] = BREAKDOWNS, params: ConnectionParams = ConnectionParams(),
) -> DataFrame:
    """The largest groups of each kind, blanks labelled after grouping."""
    large = groups.filter(F.col("BreakdownType").isin(*kinds) & (F.col("SessionCount") >= params.min_sessions))
    label = F.when(F.col("BreakdownType") == "Database", F.coalesce("Label", F.lit(UNKNOWN))).otherwise(
        F.when(F.col("GroupKey") != "", F.col("Label")).otherwise("(blank)")
    )
    top = top_per(
        large, [*SNAPSHOT, "BreakdownType"], [F.col("SessionCount").desc()], ["GroupKey"], params.max_breakdown_rows,
    )
    return top.select(*SNAPSHOT, "BreakdownType", label.alias("BreakdownValue"), "SessionCount", "rn")


def connection_metrics(summary: DataFrame, breakdown: DataFrame) -> DataFrame:
    counters = [(c, "count") for c in ("TotalUserSessions", "DistinctLogins", "DistinctHosts", "DistinctApplications")]
    totals = to_metrics(
        summary, counters, collector=fv.CONNECTIONS, category=CATEGORY, object_name="ConnectionSummary",
    )
    groups = metric_rows(
        breakdown.withColumnsRenamed({"BreakdownType": "CounterName", "SessionCount": "MetricValue"}),
        object_name=F.lit("ConnectionBreakdown"), category=CATEGORY, collector=fv.CONNECTIONS,
        metric_type=F.lit("Gauge"), unit=F.lit("count"), sub_instance=F.col("BreakdownValue"),
    )
    return totals.unionByName(groups)
