"""Health signals: the newest counters per instance, gathered for several signals in one scan."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetgauge import fixed_values as fv
from fleetgauge.functions.ranking import newest_per


def _same(*names: str) -> dict[str, str]:
    return {n: n for n in names}


@dataclass(frozen=True)
class Signal:
    """Which metric rows feed a signal, and the columns its counters become."""

    time: str
    collector: str
    counters: Mapping[str, str]
    category: str | None = None
    object_name: str | None = None
    # Take only counters of the instance's newest capture, instead of each counter's newest value.
    one_capture: bool = False
    # Counters whose value before the newest one is wanted too.
    previous: Mapping[str, str] = field(default_factory=dict)

    def rows(self) -> Column:
        conditions = [F.col("SourceCollector") == self.collector]
        if self.category:
            conditions.append(F.col("MetricCategory") == self.category)
        if self.object_name:
            conditions.append(F.col("ObjectName") == self.object_name)
        if not self.one_capture and not self.object_name:
            conditions.append(F.col("CounterName").isin(list(self.counters)))
        return reduce(and_, conditions)


PERFORMANCE = Signal(
    "PerformanceCaptureTime", fv.PERFORMANCE_COUNTERS,
    {
        "Memory Grants Pending": "MemoryGrantsPending", "Target Server Memory (KB)": "TargetServerMemoryKB",
        "Total Server Memory (KB)": "TotalServerMemoryKB", "Page life expectancy": "PageLifeExpectancySeconds",
        "Number of Deadlocks/sec": "DeadlockCounter",
        **_same("SqlProcessCpuPercent", "SystemCpuPercent", "SystemIdlePercent"),
    },
    previous={"Number of Deadlocks/sec": "PreviousDeadlockCounter"},
)
BLOCKING = Signal(
    "BlockingCaptureTime", fv.BLOCKING,
    _same("BlockedSessionCount", "DistinctBlockingSessionCount", "MaxWaitSeconds", "TotalWaitSeconds"),
    object_name="BlockingSummary",
)
QUERY_PRESSURE = Signal(
    "QueryStatsCaptureTime", fv.QUERY_STATS,
    _same("TopCpuQueryCount", "TopDurationQueryCount", "TopLogicalReadQueryCount", "TopExecutionQueryCount",
          "DistinctQueriesCaptured"),
    object_name="QueryStatsSummary",
)
BACKUP = Signal(
    "BackupCaptureTime", fv.BACKUPS,
    _same("DatabaseCount", "DatabasesWithoutFullBackup", "DatabasesWithOldFullBackup", "DatabasesWithOldDiffBackup",
          "RecoveryModelViolations", "DatabasesWithoutRequiredLogBackup", "DatabasesWithOldRequiredLogBackup",
          "NonCompliantDatabaseCount", "MaxFullBackupAgeHours", "MaxLogBackupAgeHours"),
    category="BackupCompliance", object_name="BackupComplianceSummary", one_capture=True,
)
AGENT_JOBS = Signal(
    "AgentCaptureTime", fv.AGENT_JOBS,
    _same("RecentFailedJobs", "RecentCanceledJobs", "RecentRetryJobs", "RecentSucceededJobs", "RecentCompletedJobs",
          "TotalEnabledJobs", "TotalDisabledJobs", "RunningJobCount", "MaxRunningSeconds", "MaxRunDurationSeconds",
          "AvgRunDurationSeconds"),
    category="SqlAgentJob", object_name="SqlAgentJobSummary",
)


def latest_signals(metrics: DataFrame, *signals: Signal) -> DataFrame:
    """One row per instance with the newest values of all given signals.

    A counter's newest row is the one with the latest capture time, then the highest id.  The scan is
    filtered to the signals' collectors, and each task keeps at most two rows per counter before the shuffle.
    """
    tag = F.lit(None).cast("string")
    for s in signals:
        tag = F.when(s.rows(), s.time).otherwise(tag)
    depth = 2 if any(s.previous for s in signals) else 1
    whole_captures = [s.time for s in signals if s.one_capture]
    rows = (
        metrics.filter(F.col("SourceCollector").isin([s.collector for s in signals]))
        .select("InstanceId", "CaptureTime", "CounterName", "MetricValue", "MetricSnapshotId", tag.alias("_signal"))
        .filter(F.col("_signal").isNotNull())
    )
    # Among rows of one capture, a one-capture signal takes the highest value of a counter.
    order = [
        F.col("CaptureTime").desc(), F.when(F.col("_signal").isin(whole_captures), F.col("MetricValue")).desc(),
        F.col("MetricSnapshotId").desc(),
    ]
    newest = newest_per(rows, ["InstanceId", "_signal", "CounterName"], order, depth)
    return _pivot(newest, signals)


def _pivot(newest: DataFrame, signals: tuple[Signal, ...]) -> DataFrame:
    def pick(s: Signal, counter: str | None, source: Column, rank: int = 1) -> Column:
        found = (F.col("_signal") == s.time) & (F.col("rn") == rank)
        if counter is not None:
            found &= F.col("CounterName") == counter
        return F.max(F.when(found, source))

    value, timed = F.col("MetricValue"), F.struct("CaptureTime", "MetricValue")
    wanted, shown = [], ["InstanceId"]
    for s in signals:
        wanted.append(pick(s, None, F.col("CaptureTime")).alias(s.time))
        shown.append(s.time)
        for counter, name in s.counters.items():
            wanted.append(pick(s, counter, timed if s.one_capture else value).alias(name))
            current = F.when(F.col(f"{name}.CaptureTime") == F.col(s.time), F.col(f"{name}.MetricValue"))
            shown.append(current.alias(name) if s.one_capture else name)
        for counter, name in s.previous.items():
            wanted.append(pick(s, counter, value, 2).alias(name))
            shown.append(name)
    return newest.groupBy("InstanceId").agg(*wanted).select(*shown)
