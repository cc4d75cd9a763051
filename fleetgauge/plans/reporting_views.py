"""Reporting views: inventory, latest and trend metrics, health per signal and the scorecard."""

from __future__ import annotations

from datetime import date, datetime, timedelta
from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetgauge import fixed_values as fv
from fleetgauge.functions.ranking import SLICES, newest_of_series, newest_per
from fleetgauge.functions.timing import minutes_crossed, ntz, seconds_crossed
from fleetgauge.plans import signals
from fleetgauge.plans.signals import Signal, latest_signals
from fleetgauge.sources.tables import since

_NAMES = ["InstanceId", "InstanceName", "EnvironmentName"]
_PROFILES = [*_NAMES, "CollectionProfile", "ComplianceProfile"]
_SERIES = ["CaptureTime", "DatabaseName", "ObjectName", "CounterName", "CounterInstanceName", "MetricCategory",
           "MetricValue", "MetricType", "Unit", "SourceCollector"]


def _zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0).cast("decimal(28,6)"))


def _enabled(instances: DataFrame, *columns: str) -> DataFrame:
    return instances.filter("IsEnabled").select(*columns)


# --- Inventory and series ------------------------------------------------------------------------


def instance_inventory(instances: DataFrame) -> DataFrame:
    return instances.select(*_NAMES, "IsEnabled", "CollectionProfile", "ComplianceProfile", "SqlVersion", "Edition",
                            "CreatedAt", "ModifiedAt", "Notes")


def _with_inventory(metrics: DataFrame, instances: DataFrame) -> DataFrame:
    named = metrics.withColumnRenamed("InstanceName", "CounterInstanceName")
    return named.join(instances.select(*_PROFILES), "InstanceId").select(*_PROFILES, *_SERIES)


def metric_latest(metrics: DataFrame, instances: DataFrame, first_day: date | None = None) -> DataFrame:
    """The newest row of each series, NULL and empty names being the same, with its instance."""
    names = ["DatabaseName", "ObjectName", "CounterName", "InstanceName", "MetricCategory", "SourceCollector"]
    order = [F.col("CaptureTime").desc(), F.col("MetricSnapshotId").desc()]
    return _with_inventory(newest_of_series(since(metrics, first_day), ["InstanceId"], names, order), instances)


def metric_trend(metrics: DataFrame, instances: DataFrame, first_day: date | None = None) -> DataFrame:
    return _with_inventory(since(metrics, first_day), instances)


# --- Health of single signals --------------------------------------------------------------------


def _signal_view(metrics: DataFrame, instances: DataFrame, signal: Signal, *columns: str) -> DataFrame:
    found = latest_signals(metrics, signal)
    return _enabled(instances, *_NAMES, *columns).join(found, "InstanceId", "left")


def _levels(levels: dict[str, Column], otherwise: str = "Healthy") -> Column:
    """The first level whose condition holds; a NULL condition does not hold."""
    chosen = F.lit(otherwise)
    for name, condition in reversed(list(levels.items())):
        chosen = F.when(condition, name).otherwise(chosen)
    return chosen


def cpu_health() -> Column:
    system, process = F.col("SystemCpuPercent"), F.col("SqlProcessCpuPercent")
    return _levels({
        "Unknown": system.isNull(), "Critical": (system >= 90) | (process >= 85),
        "Warning": (system >= 80) | (process >= 70),
    })


def memory_health() -> Column:
    pending = _zero("MemoryGrantsPending")
    return _levels({
        "Unknown": F.col("PerformanceCaptureTime").isNull(), "Critical": pending >= 5, "Warning": pending > 0,
    })


def deadlock_delta() -> Column:
    """Deadlocks since the sample before; NULL without one or after a counter reset."""
    counter, before = F.col("DeadlockCounter"), F.col("PreviousDeadlockCounter")
    return F.when(counter >= before, (counter - before).cast("decimal(29,6)"))


def deadlock_health() -> Column:
    delta = deadlock_delta()
    return _levels({"Unknown": delta.isNull(), "Critical": delta >= 5, "Warning": delta > 0})


def blocking_health() -> Column:
    blocked = _zero("BlockedSessionCount")
    return _levels({
        "Unknown": F.col("BlockingCaptureTime").isNull(), "Critical": (_zero("MaxWaitSeconds") >= 60) | (blocked >= 5),
        "Warning": blocked > 0,
    })


_PROTECTION = ["DatabasesWithoutFullBackup", "DatabasesWithOldFullBackup", "DatabasesWithOldDiffBackup",
               "DatabasesWithoutRequiredLogBackup", "DatabasesWithOldRequiredLogBackup"]


def backup_columns() -> dict[str, Column]:
    missing = F.col("BackupCaptureTime").isNull()
    return {
        "BackupProtectionIssueCount": reduce(add, map(_zero, _PROTECTION)).cast("decimal(33,6)"),
        "ConfigurationViolationCount": _zero("RecoveryModelViolations"),
        "BackupHealth": _levels({
            "Unknown": missing, "Critical": reduce(or_, (_zero(c) > 0 for c in _PROTECTION)),
        }),
        "ConfigurationHealth": _levels({"Unknown": missing, "Warning": _zero("RecoveryModelViolations") > 0}),
    }


def query_data_health() -> Column:
    return _levels({"Unknown": F.col("QueryStatsCaptureTime").isNull()}, "Available")


def backup_compliance_current(metrics: DataFrame, instances: DataFrame) -> DataFrame:
    joined = _signal_view(metrics, instances, signals.BACKUP, "ComplianceProfile").withColumns(backup_columns())
    return joined.withColumnRenamed("BackupCaptureTime", "CaptureTime")


def performance_health_current(metrics: DataFrame, instances: DataFrame) -> DataFrame:
    return (
        _signal_view(metrics, instances, signals.PERFORMANCE)
        .withColumns({
            "DeadlocksSincePreviousSample": deadlock_delta(), "CpuHealth": cpu_health(),
            "MemoryHealth": memory_health(), "DeadlockHealth": deadlock_health(),
        })
        .drop("PreviousDeadlockCounter").withColumnRenamed("PerformanceCaptureTime", "CaptureTime")
    )


def blocking_health_current(metrics: DataFrame, instances: DataFrame) -> DataFrame:
    joined = _signal_view(metrics, instances, signals.BLOCKING).withColumn("BlockingHealth", blocking_health())
    return joined.withColumnRenamed("BlockingCaptureTime", "CaptureTime")


def query_pressure_current(metrics: DataFrame, instances: DataFrame) -> DataFrame:
    joined = _signal_view(metrics, instances, signals.QUERY_PRESSURE).withColumn("QueryDataHealth", query_data_health())
    return joined.withColumnRenamed("QueryStatsCaptureTime", "CaptureTime")


def agent_health_current(metrics: DataFrame, instances: DataFrame) -> DataFrame:
    health = _levels({
        "Unknown": F.col("RecentFailedJobs").isNull(), "Critical": F.col("RecentFailedJobs") > 0,
        "Warning": (_zero("RecentCanceledJobs") > 0) | (_zero("RecentRetryJobs") > 0),
    })
    joined = _signal_view(metrics, instances, signals.AGENT_JOBS).withColumn("SQLAgentHealth", health)
    return joined.withColumnRenamed("AgentCaptureTime", "CaptureTime")


# --- Collector runs ------------------------------------------------------------------------------


def _run_health(status: Column, started: Column, as_of: datetime) -> Column:
    return (
        F.when(status.isNull(), "Unknown")
        .when(status.isin(fv.FAILURE_STATES), "Critical")
        .when((status == "Running") & (started < ntz(as_of - timedelta(minutes=30))), "Warning")
        .when(started < ntz(as_of - timedelta(hours=24)), "Warning")
        .when(status.isin(fv.SUCCESS_STATES), "Healthy")
        .otherwise("Warning")
    )


def collector_health(runs: DataFrame, instances: DataFrame, as_of: datetime) -> DataFrame:
    """The last run of each collector on each enabled instance, and how it stands."""
    last = newest_per(
        runs, ["InstanceId", "CollectorName"], [F.col("StartedAt").desc(), F.col("CollectionRunId").desc()],
    ).select("InstanceId", "CollectorName", "StartedAt", "FinishedAt", "Status", "RowsCollected", "DurationMs",
             "ErrorMessage")
    started, status = F.col("LastStartedAt"), F.col("LastStatus")
    named = last.withColumnsRenamed(
        {"StartedAt": "LastStartedAt", "FinishedAt": "LastFinishedAt", "Status": "LastStatus"}
    )
    # Minutes over 60 with six digits, the rest cut off.
    hours = F.expr("cast(cast((_minutes * 1000000) div 60 AS decimal(17,0)) / 1000000 AS decimal(17,6))")
    joined = _enabled(instances, *_NAMES).join(named, "InstanceId", "left")
    return joined.withColumn("_minutes", minutes_crossed(started, ntz(as_of))).withColumns({
        "HoursSinceLastRun": hours, "CollectorHealth": _run_health(status, started, as_of),
    }).drop("_minutes")


def collector_states(runs: DataFrame) -> DataFrame:
    """Per instance and collector: last start, its status and the last success.

    The last run is ranked on narrow rows, of which each task sends one per key; the last success is a hash aggregate.
    """
    key = ["InstanceId", "CollectorName"]
    last = newest_per(
        runs.select(*key, "StartedAt", "CollectionRunId", "Status"), key,
        [F.col("StartedAt").desc(), F.col("CollectionRunId").desc()],
    ).select(*key, F.col("StartedAt").alias("LastStartedAt"), F.col("Status").alias("LastStatus"))
    succeeded = F.max(F.when(F.col("Status").isin(fv.SUCCESS_STATES), F.col("FinishedAt"))).alias("LastSuccessfulAt")
    success = runs.groupBy(*key).agg(succeeded).withColumnsRenamed({c: f"_{c}" for c in key})
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in key]
    return last.join(success, same).drop(*(f"_{c}" for c in key))


def run_signals(runs: DataFrame, as_of: datetime) -> DataFrame:
    """One row per instance: freshness of its collectors and how many stand in which health."""
    states = collector_states(runs).withColumn(
        "_health", _run_health(F.col("LastStatus"), F.col("LastStartedAt"), as_of)
    )
    return states.groupBy("InstanceId").agg(
        F.max("LastStartedAt").alias("LastCollectionAttempt"),
        F.min("LastSuccessfulAt").alias("OldestCollectorSuccess"),
        F.max("LastSuccessfulAt").alias("LatestCollectorSuccess"),
        F.count_if(F.col("LastSuccessfulAt").isNull()).alias("CollectorsNeverSuccessful"),
        *(F.count_if(F.col("_health") == h).alias(f"Collector{h}Count") for h in ("Critical", "Warning", "Unknown")),
    )


def freshness_health(as_of: datetime) -> Column:
    never = F.coalesce("CollectorsNeverSuccessful", F.lit(0))
    stale = F.col("OldestCollectorSuccess") < ntz(as_of - timedelta(hours=24))
    return _levels({"Unknown": F.col("LastCollectionAttempt").isNull(), "Warning": (never > 0) | stale})


def data_freshness_current(runs: DataFrame, instances: DataFrame, as_of: datetime) -> DataFrame:
    joined = _enabled(instances, *_NAMES).join(run_signals(runs, as_of), "InstanceId", "left")
    return joined.select(
        *_NAMES, "LastCollectionAttempt", "OldestCollectorSuccess", "LatestCollectorSuccess",
        F.coalesce("CollectorsNeverSuccessful", F.lit(0)).alias("CollectorsNeverSuccessful"),
        freshness_health(as_of).alias("FreshnessHealth"),
    )


# --- Whole-server views --------------------------------------------------------------------------


def _servers(metrics: DataFrame, runs: DataFrame, instances: DataFrame, as_of: datetime, *used: Signal) -> DataFrame:
    """Enabled instances with the given signals and their run signals: two joins whatever the number of signals."""
    joined = (
        _enabled(instances, *_PROFILES, "SqlVersion", "Edition")
        .join(latest_signals(metrics, *used), "InstanceId", "left")
        .join(run_signals(runs, as_of), "InstanceId", "left")
    )
    # An instance without any run counts as one collector in unknown state.
    no_runs = {"CollectorsNeverSuccessful": 0, "CollectorCriticalCount": 0, "CollectorWarningCount": 0,
               "CollectorUnknownCount": 1}
    return joined.withColumns({
        "FreshnessHealth": freshness_health(as_of), "LastCollectionTime": F.col("LastCollectionAttempt"),
        **{c: F.coalesce(c, F.lit(n)) for c, n in no_runs.items()}, **backup_columns(),
    })


def server_health_current(
    metrics: DataFrame, runs: DataFrame, instances: DataFrame, as_of: datetime, first_day: date | None = None,
) -> DataFrame:
    """Backup and collector health of each enabled instance, and the worse of them."""
    backup, configuration = F.col("BackupHealth"), F.col("ConfigurationHealth")
    overall = _levels({
        "Critical": (F.col("CollectorCriticalCount") > 0) | (backup == "Critical"),
        "Warning": (F.col("CollectorWarningCount") > 0) | (backup == "Unknown")
        | configuration.isin("Warning", "Unknown"),
    })
    return _servers(since(metrics, first_day), runs, instances, as_of, signals.BACKUP).select(
        *_PROFILES, "SqlVersion", "Edition", "BackupCaptureTime", "DatabaseCount", "BackupProtectionIssueCount",
        "ConfigurationViolationCount", "NonCompliantDatabaseCount", "BackupHealth", "ConfigurationHealth",
        "LastCollectionTime", "CollectorCriticalCount", "CollectorWarningCount", overall.alias("OverallHealth"),
    )


# Points a signal takes off the score when it is critical, warning or unknown.
SCORE_WEIGHTS = {
    "CpuHealth": (20, 10, 5), "MemoryHealth": (20, 10, 5), "BlockingHealth": (20, 10, 5), "DeadlockHealth": (15, 8, 0),
    "BackupHealth": (25, 10, 5), "ConfigurationHealth": (10, 5, 3), "FreshnessHealth": (25, 15, 10),
}
COLLECTOR_WEIGHTS = (25, 10)


def health_score() -> Column:
    """100 minus the points of all signals, not below 0."""
    lost = F.when(F.col("CollectorCriticalCount") > 0, COLLECTOR_WEIGHTS[0]).when(
        F.col("CollectorWarningCount") > 0, COLLECTOR_WEIGHTS[1]
    ).otherwise(0)
    for name, (critical, warning, unknown) in SCORE_WEIGHTS.items():
        state = F.col(name)
        lost += F.when(state == "Critical", critical).when(state == "Warning", warning).when(
            state == "Unknown", unknown
        ).otherwise(0)
    return F.greatest(F.lit(0), 100 - lost).cast("int")


def scorecard_health() -> Column:
    """Critical if any signal but configuration is; else warning if any warns or, deadlocks aside, is unknown."""
    critical = [F.col(s) == "Critical" for s in SCORE_WEIGHTS if s != "ConfigurationHealth"]
    warning = [
        F.col(s) == "Warning" if s == "DeadlockHealth" else F.col(s).isin("Warning", "Unknown") for s in SCORE_WEIGHTS
    ]
    return _levels({
        "Critical": reduce(or_, critical, F.col("CollectorCriticalCount") > 0),
        "Warning": reduce(or_, warning, F.col("CollectorWarningCount") > 0),
    })


def server_health_scorecard(
    metrics: DataFrame, runs: DataFrame, instances: DataFrame, as_of: datetime, first_day: date | None = None,
) -> DataFrame:
    """All signals of each enabled instance with a 0 to 100 score: one scan of metrics, one of runs."""
    used = (signals.PERFORMANCE, signals.BLOCKING, signals.BACKUP, signals.QUERY_PRESSURE)
    rated = _servers(since(metrics, first_day), runs, instances, as_of, *used).withColumns({
        "DeadlocksSincePreviousSample": deadlock_delta(), "CpuHealth": cpu_health(), "MemoryHealth": memory_health(),
        "DeadlockHealth": deadlock_health(), "BlockingHealth": blocking_health(),
        "QueryDataHealth": query_data_health(),
    })
    return rated.select(
        *_PROFILES, "SqlVersion", "Edition", "PerformanceCaptureTime", "SqlProcessCpuPercent", "SystemCpuPercent",
        "MemoryGrantsPending", "PageLifeExpectancySeconds", "DeadlocksSincePreviousSample", "CpuHealth",
        "MemoryHealth", "DeadlockHealth", "BlockingCaptureTime", "BlockedSessionCount",
        "DistinctBlockingSessionCount", "MaxWaitSeconds", "BlockingHealth", "BackupCaptureTime", "DatabaseCount",
        "BackupProtectionIssueCount", "ConfigurationViolationCount", "BackupHealth", "ConfigurationHealth",
        "QueryStatsCaptureTime", "DistinctQueriesCaptured", "QueryDataHealth", "LastCollectionAttempt",
        "LatestCollectorSuccess", "CollectorsNeverSuccessful", "FreshnessHealth", "CollectorCriticalCount",
        "CollectorWarningCount", "CollectorUnknownCount", "LastCollectionTime", health_score().alias("HealthScore"),
        scorecard_health().alias("OverallHealth"),
    )


# --- Waits ---------------------------------------------------------------------------------------

_PREFIXES = {"Locking": "Lock", "IO": "IO", "Parallelism": "Parallelism", "Memory": "Memory", "CPU": "CPU",
             "LogIO": "LogIO"}
# Milliseconds of wait per second that make a class critical, or a warning.
WAIT_LIMITS = {
    "Critical": {"Lock": 100, "Memory": 100, "CPU": 500, "IO": 500, "LogIO": 500},
    "Warning": {"Lock": 20, "Memory": 20, "CPU": 100, "IO": 100, "LogIO": 100, "Parallelism": 500},
}


def wait_class(wait_type: Column) -> Column:
    chosen = F.lit("Other")
    for name, exact, prefix in reversed(fv.WAIT_CLASSES):
        chosen = F.when(wait_type.startswith(prefix) if prefix else wait_type.isin(exact), name).otherwise(chosen)
    return chosen


def wait_deltas(metrics: DataFrame) -> DataFrame:
    """Per instance and wait type, the growth between its two newest captures; NULL without baseline or on reset.

    One scan: each task keeps only the rows of the two newest captures it sees.  Captures are ranked per
    slice of wait types first: a row of the instance's two newest captures is also in its slice's, so
    nothing is lost and the rows of one large instance are shared by many tasks.
    """
    waits = metrics.filter(
        (F.col("SourceCollector") == fv.WAIT_STATS) & (F.col("ObjectName") == "SQLWaitStats")
    ).select("InstanceId", "CaptureTime", F.col("InstanceName").alias("WaitType"), "CounterName", "MetricValue")

    def two_newest(rows: DataFrame, *keys: str) -> DataFrame:
        newest_first = Window.partitionBy(*keys).orderBy(F.col("CaptureTime").desc())
        return rows.withColumn("_capture", F.dense_rank().over(newest_first)).filter("_capture <= 2")

    sliced = waits.withColumn("_slice", F.pmod(F.xxhash64("WaitType"), F.lit(SLICES)))
    two = two_newest(two_newest(sliced, "InstanceId", "_slice").drop("_slice", "_capture"), "InstanceId")
    current, before = F.col("_capture") == 1, F.col("_capture") == 2
    timed = F.col("CounterName") == "WaitTimeMs"
    per_type = two.groupBy("InstanceId", "WaitType").agg(
        F.max(F.when(current & timed, F.col("MetricValue"))).alias("_now"),
        F.max(F.when(before & timed, F.col("MetricValue"))).alias("_before"),
        F.max(F.when(current, F.col("CaptureTime"))).alias("_current"),
        F.max(F.when(before, F.col("CaptureTime"))).alias("_previous"),
    )
    return per_type.select(
        "InstanceId", "WaitType", F.col("_now").isNotNull().alias("Captured"),
        F.when(F.col("_now") >= F.col("_before"), F.col("_now") - F.col("_before")).alias("WaitTimeDeltaMs"),
        F.col("_current").alias("CurrentCapture"), F.col("_previous").alias("PreviousCapture"),
    )


def _per_second(amount: str) -> Column:
    """Amount over the sample interval, half up to two digits in exact integer arithmetic."""
    quotient = F.expr(
        f"(cast({amount} AS decimal(34,6)) * 200 + SampleIntervalSeconds) div (2 * SampleIntervalSeconds)"
    )
    rate = (quotient.cast("decimal(19,0)") / 100).cast("decimal(19,2)")
    return F.when(F.col("SampleIntervalSeconds") != 0, rate)


def wait_pressure_current(metrics: DataFrame, instances: DataFrame) -> DataFrame:
    """Wait growth per class and second between the two newest captures of each enabled instance."""
    delta = F.when(F.col("Captured"), F.coalesce("WaitTimeDeltaMs", F.lit(0).cast("decimal(29,6)")))
    classed = wait_deltas(metrics).withColumn("_class", wait_class(F.col("WaitType")))
    totals = classed.groupBy("InstanceId").agg(
        F.max("CurrentCapture").alias("CaptureTime"), F.max("PreviousCapture").alias("_previous"),
        F.count_if("Captured").alias("_types"),
        F.sum(delta).cast("decimal(38,6)").alias("TotalWaitDeltaMs"),
        *(F.sum(F.when(F.col("_class") == c, delta).otherwise(0)).cast("decimal(38,6)").alias(f"{p}WaitDeltaMs")
          for c, p in _PREFIXES.items()),
        F.count_if(F.col("Captured") & F.col("WaitTimeDeltaMs").isNull()).alias("WaitTypesWithoutBaseline"),
    ).filter("_types > 0").drop("_types")
    timed = totals.withColumn(
        "SampleIntervalSeconds", seconds_crossed(F.col("_previous"), F.col("CaptureTime")).cast("int")
    )
    kinds = ["Total", *_PREFIXES.values()]
    rated = timed.withColumns({f"{k}WaitMsPerSecond": _per_second(f"{k}WaitDeltaMs") for k in kinds})
    joined = _enabled(instances, *_NAMES).join(rated, "InstanceId", "left")

    interval, missing = F.col("SampleIntervalSeconds"), F.col("CaptureTime").isNull()

    def over(limits: dict[str, int]) -> Column:
        return reduce(or_, (F.col(f"{k}WaitMsPerSecond") >= limit for k, limit in limits.items()))

    unmeasured = (F.col("WaitTypesWithoutBaseline") > 0) & (F.col("TotalWaitDeltaMs") == 0)
    return joined.select(
        *_NAMES, "CaptureTime", "SampleIntervalSeconds", *(f"{k}WaitDeltaMs" for k in kinds),
        *(f"{k}WaitMsPerSecond" for k in kinds), "WaitTypesWithoutBaseline",
        F.when(missing, "Unknown").otherwise(_dominant()).alias("DominantWaitCategory"),
        _levels({
            "Unknown": missing | interval.isNull() | (interval <= 0) | unmeasured,
            **{level: over(limits) for level, limits in WAIT_LIMITS.items()},
        }).alias("WaitHealth"),
    )


def _dominant() -> Column:
    """The class with the largest growth; the earlier class wins a tie, no growth at all is 'None'."""
    largest = F.greatest(*(f"{p}WaitDeltaMs" for p in _PREFIXES.values()))
    chosen = F.lit("None")
    for name, prefix in reversed(_PREFIXES.items()):
        chosen = F.when(F.col(f"{prefix}WaitDeltaMs") == largest, name).otherwise(chosen)
    return F.when(largest > 0, chosen).otherwise("None")
