"""One collection cycle: every collector over all enabled instances, as one job per output.

A collector turns landed snapshots into metric and evidence rows.  Its base set is cached while the
outputs are written; a cached block lost with an executor is computed again from the landing tables.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import date, datetime, timezone

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetgauge import fixed_values as fv
from fleetgauge import schemas
from fleetgauge.functions.shaping import SNAPSHOT, stored_evidence, stored_metrics
from fleetgauge.operators import (
    agent_alerts, agent_jobs, backups, blocking, connections, counters, file_io, inventory, query_stats, requests,
    runs, waits,
)
from fleetgauge.params import (
    AlertParams, BackupParams, BlockingParams, ConnectionParams, CycleParams, FileIoParams, JobParams, QueryStatsParams,
    RequestParams,
)
from fleetgauge.sources import tables


@dataclass
class Collection:
    """The outputs of one collector, and the frames more than one of them is built from."""

    collector: str
    metrics: DataFrame
    evidence: DataFrame | None = None
    shared: tuple[DataFrame, ...] = ()

    def write(self, metrics_path: str, evidence_path: str, key: str, days: list[date] | None = None) -> None:
        """Store the rows of the captures of these days that this commit key has not stored yet."""
        for frame in self.shared:
            frame.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            tables.append_once(stored_metrics(self.metrics), metrics_path, "MetricSnapshot", key, days)
            if self.evidence is not None:
                tables.append_once(stored_evidence(self.evidence), evidence_path, "MetricTextSnapshot", key, days)
        finally:
            for frame in self.shared:
                frame.unpersist()


def collect_counters(raw: DataFrame, ring: DataFrame) -> Collection:
    cpu = counters.cpu_metrics(counters.cpu_samples(ring))
    return Collection(fv.PERFORMANCE_COUNTERS, counters.counter_metrics(raw).unionByName(cpu))


def collect_connections(
    sessions: DataFrame, roster: DataFrame, params: ConnectionParams = ConnectionParams(),
) -> Collection:
    groups = connections.session_groups(sessions)
    summary, large = connections.session_summary(groups, roster), connections.session_breakdown(groups, params=params)
    return Collection(fv.CONNECTIONS, connections.connection_metrics(summary, large), None, (groups,))


def collect_blocking(
    active: DataFrame, sessions: DataFrame, roster: DataFrame, params: BlockingParams = BlockingParams(),
) -> Collection:
    blocked = blocking.all_blocked(active, sessions, params)
    evidence = blocking.blocking_evidence(blocking.longest_blocked(blocked, params))
    return Collection(fv.BLOCKING, blocking.blocking_metrics(blocking.blocking_summary(blocked, roster)), evidence)


def collect_waits(raw: DataFrame) -> Collection:
    return Collection(fv.WAIT_STATS, waits.wait_metrics(waits.waits(raw)))


def collect_file_io(raw: DataFrame, databases: DataFrame, params: FileIoParams = FileIoParams()) -> Collection:
    files = file_io.busiest_files(file_io.file_stats(raw, databases), params)
    return Collection(fv.DATABASE_IO, file_io.file_metrics(files), file_io.file_evidence(files, params), (files,))


def collect_requests(
    active: DataFrame, sessions: DataFrame, roster: DataFrame, params: RequestParams = RequestParams(),
) -> Collection:
    # Without the statements, which few rows need, the cached base is narrow.
    narrow = requests.active_requests(active, sessions, params, statements=False)
    evidence = (
        requests.expensive_evidence(requests.expensive_requests(narrow, params, active))
        .unionByName(requests.attribution_evidence(requests.request_attribution(narrow, params=params)))
        .unionByName(requests.repeated_evidence(requests.repeated_requests(narrow, active, params)))
    )
    summary = requests.request_summary(narrow, roster, params)
    return Collection(fv.ACTIVE_REQUESTS, requests.request_metrics(summary), evidence, (narrow,))


def collect_query_stats(
    stats: DataFrame, texts: DataFrame, roster: DataFrame, params: QueryStatsParams = QueryStatsParams(),
) -> Collection:
    kept = query_stats.query_details(stats, texts, params=params)
    summary = query_stats.query_summary(kept, roster)
    return Collection(fv.QUERY_STATS, query_stats.query_metrics(summary), query_stats.query_evidence(kept), (kept,))


def collect_backups(
    databases: DataFrame, backupset: DataFrame, media: DataFrame, instances: DataFrame, roster: DataFrame,
    params: BackupParams = BackupParams(),
) -> Collection:
    policy = backups.backup_policy(inventory.enabled_profiles(instances))
    base = backups.compliance_base(databases, backupset, media, policy)
    return Collection(
        fv.BACKUPS,
        backups.compliance_metrics(backups.compliance_summary(base, roster, params)),
        backups.compliance_evidence(backups.compliance_issues(base, params)), (base,),
    )


def collect_jobs(
    history: DataFrame, jobs: DataFrame, activity: DataFrame, agent_sessions: DataFrame, roster: DataFrame,
    params: JobParams = JobParams(),
) -> Collection:
    recent = agent_jobs.recent_runs(history, jobs, params=params)
    running = agent_jobs.running_jobs(activity, jobs, agent_sessions)
    metrics = agent_jobs.job_metrics(
        agent_jobs.job_inventory(jobs, roster), agent_jobs.outcome_summary(recent, roster),
        agent_jobs.running_summary(running, roster),
    )
    evidence = agent_jobs.failure_evidence(agent_jobs.failed_runs(recent, params)).unionByName(
        agent_jobs.running_evidence(agent_jobs.longest_running(running, params))
    )
    return Collection(fv.AGENT_JOBS, metrics, evidence, (recent, running))


def collect_alerts(
    alerts: DataFrame, notifications: DataFrame, operators: DataFrame, roster: DataFrame,
    params: AlertParams = AlertParams(),
) -> Collection:
    flagged = agent_alerts.flagged_alerts(alerts, notifications, params=params)
    issues = agent_alerts.configuration_issues(flagged, notifications, operators, params)
    triggered = agent_alerts.triggered_alerts(flagged, notifications, operators, params)
    evidence = agent_alerts.alert_evidence(issues).unionByName(agent_alerts.alert_evidence(triggered))
    return Collection(fv.AGENT_ALERTS, agent_alerts.alert_metrics(agent_alerts.alert_summary(flagged, roster)), evidence, (flagged,))


# The narrowest number a collector computes with has 16 digits before the point.
_LARGEST = 10**16 - 1


def rules(table: str) -> dict[str, str]:
    """What every row of a landing table must meet (message -> condition), so that no computation on it can fail: its
    large numbers fit the stored types.  An instance with another row fails its run and leaves the others alone."""
    found = {
        f"{name} is out of range": f"{name} IS NULL OR {name} BETWEEN -{_LARGEST} AND {_LARGEST}"
        for name in re.findall(r"(\w+) (?:bigint|double)\b", schemas.LANDING_TABLES[table])
    }
    return {"counter value is missing": "cntr_value IS NOT NULL", **found} if table == "raw_counters" else found


def collectors(
    landed: Mapping[str, DataFrame], instances: DataFrame, roster: DataFrame, params: CycleParams = CycleParams(),
) -> dict[str, tuple[str, Callable[[DataFrame], Collection]]]:
    """Every collector with the landing table its rows are checked in, in the order they run."""
    at = landed.__getitem__
    return {
        fv.PERFORMANCE_COUNTERS: ("raw_counters", lambda raw: collect_counters(raw, at("raw_ring_buffer"))),
        fv.WAIT_STATS: ("raw_waits", collect_waits),
        fv.DATABASE_IO: ("raw_file_io", lambda raw: collect_file_io(raw, at("raw_databases"), params.file_io)),
        fv.ACTIVE_REQUESTS: ("raw_requests", lambda raw: collect_requests(raw, at("raw_sessions"), roster, params.requests)),
        fv.BLOCKING: ("raw_requests", lambda raw: collect_blocking(raw, at("raw_sessions"), roster, params.blocking)),
        fv.CONNECTIONS: ("raw_sessions", lambda raw: collect_connections(raw, roster, params.connections)),
        fv.BACKUPS: ("raw_backupset", lambda raw: collect_backups(
            at("raw_databases"), raw, at("raw_backupmedia"), instances, roster, params.backups)),
        fv.QUERY_STATS: ("raw_query_stats", lambda raw: collect_query_stats(
            raw, at("raw_query_text"), roster, params.query_stats)),
        fv.AGENT_JOBS: ("raw_job_history", lambda raw: collect_jobs(
            raw, at("raw_jobs"), at("raw_job_activity"), at("raw_agent_sessions"), roster, params.jobs)),
        fv.AGENT_ALERTS: ("raw_alerts", lambda raw: collect_alerts(
            raw, at("raw_notifications"), at("raw_operators"), roster, params.alerts)),
    }


def run_cycle(
    spark: SparkSession, landed: Mapping[str, DataFrame], instances: DataFrame, captured_at: datetime,
    metrics_path: str, evidence_path: str, events_path: str, params: CycleParams = CycleParams(),
    clock: Callable[[], datetime] = lambda: datetime.now(timezone.utc).replace(tzinfo=None),
    quarantined: Mapping[str, DataFrame] | None = None,
) -> None:
    """Run all collectors for the snapshots landed at ``captured_at``; every run's start and finish are stored as events.

    The start is stored before a collector works, so a run that never ends is seen as running.  An instance that
    fails its checks is recorded and leaves the others alone, and a collector that fails is recorded for all its
    instances and leaves the other collectors alone.  Repeating a cycle stores no row twice.  ``clock`` is the
    zone-free time that finishes are stamped with; ``runs.stored_runs`` reads the runs back.  ``quarantined`` has the rows
    of landing tables that ``tables.read_checked`` could not read: their instances fail, with the number of such rows.
    """
    roster = inventory.capture_roster(instances, captured_at)
    current = {
        name: df.join(roster, SNAPSHOT, "left_semi") if set(SNAPSHOT) <= set(df.columns) else df
        for name, df in landed.items()
    }
    for collector, (source, build) in collectors(current, instances, roster, params).items():
        tables.write_run_events(runs.start_events(roster, collector), events_path)
        outcomes = roster.select(*SNAPSHOT, F.lit(None).cast("string").alias("ErrorMessage"))
        try:
            sound, checked = runs.isolate_failures(current[source], rules(source), SNAPSHOT, (quarantined or {}).get(source))
            outcomes = roster.join(checked.drop("RowsCollected"), SNAPSHOT, "left")
            build(sound).write(metrics_path, evidence_path, commit_key(collector, captured_at), [captured_at.date()])
        except Exception as error:  # noqa: BLE001 - one collector must not stop the others
            outcomes = outcomes.withColumn("ErrorMessage", F.lit(str(error)))
        rows = _rows_written(spark, collector, captured_at, metrics_path, evidence_path)
        finished = outcomes.join(rows, SNAPSHOT, "left").fillna(0, ["RowsCollected"])
        tables.write_run_events(runs.finish_events(finished, collector, max(clock(), captured_at)), events_path)


def _rows_written(
    spark: SparkSession, collector: str, captured_at: datetime, metrics_path: str, evidence_path: str,
) -> DataFrame:
    """Stored rows per instance of one collector and cycle; only what its commit key stored is read."""
    key, day = commit_key(collector, captured_at), [captured_at.date()]
    stored = tables.read_commit(spark, metrics_path, "MetricSnapshot", key, day).select(*SNAPSHOT).unionByName(
        tables.read_commit(spark, evidence_path, "MetricTextSnapshot", key, day).select(*SNAPSHOT))
    return stored.groupBy(*SNAPSHOT).agg(F.count(F.lit(1)).alias("RowsCollected"))


def commit_key(collector: str, captured_at: datetime) -> str:
    """What one collector stores for one capture time goes under this key, once however often the cycle is repeated."""
    return f"{collector}@{captured_at.isoformat()}"
