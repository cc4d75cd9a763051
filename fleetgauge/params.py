"""Defaults and limits of the snapshot transforms.

A text length cuts what is shown; None, the default, shows the whole text.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from fleetgauge import fixed_values as fv


@dataclass(frozen=True)
class MonitorIdentity:
    """How the monitoring recognises its own work; a deployment adds its login and product name.

    Programs are parts of a program name; statements are parts of a text in the sense of LIKE.
    """

    login: str | None = None
    programs: tuple[str, ...] = tuple(fv.MONITOR_PROGRAMS)
    statements: tuple[str, ...] = tuple(fv.MONITOR_STATEMENTS)


@dataclass(frozen=True)
class ConnectionParams:
    max_breakdown_rows: int = 100
    min_sessions: int = 2


@dataclass(frozen=True)
class BlockingParams:
    max_rows: int = 50
    max_text_length: int | None = None
    monitor: MonitorIdentity = field(default_factory=MonitorIdentity)


@dataclass(frozen=True)
class WaitParams:
    max_types: int = 20


@dataclass(frozen=True)
class FileIoParams:
    max_files: int = 25
    warning_ms: int = 10
    critical_ms: int = 20


@dataclass(frozen=True)
class RequestParams:
    elapsed_ms: int = 30000
    cpu_ms: int = 10000
    logical_reads: int = 100000
    physical_reads: int = 10000
    writes: int = 10000
    wait_ms: int = 10000
    max_requests: int = 50
    max_attribution_rows: int = 25
    max_repeated_rows: int = 25
    max_text_length: int | None = None
    monitor: MonitorIdentity = field(default_factory=MonitorIdentity)


@dataclass(frozen=True)
class QueryStatsParams:
    top_n: int = 25
    lookback_minutes: int = 60
    max_text_length: int | None = None
    min_executions: int = 1
    monitor: MonitorIdentity = field(default_factory=MonitorIdentity)

    def __post_init__(self) -> None:
        for name in ("top_n", "lookback_minutes", "min_executions", "max_text_length"):
            value = getattr(self, name)
            if value is not None and value < 1:
                raise ValueError(f"{name} must be at least 1")


@dataclass(frozen=True)
class BackupParams:
    full_hours: int = 24
    diff_hours: int = 24
    log_hours: int = 2
    max_rows: int = 200


@dataclass(frozen=True)
class JobParams:
    lookback_hours: int = 24
    max_rows: int = 100
    long_running_seconds: int = 3600


@dataclass(frozen=True)
class AlertParams:
    lookback_hours: int = 24
    max_rows: int = 200


@dataclass(frozen=True)
class RetentionParams:
    metric_days: int = 90
    text_days: int = 90
    history_days: int = 365

    def __post_init__(self) -> None:
        if self.metric_days < 7 or self.text_days < 7 or self.history_days < 30:
            raise ValueError("retention is below the safety minimum of 7, 7 and 30 days")


@dataclass(frozen=True)
class CycleParams:
    """The params of every collector of a cycle."""

    connections: ConnectionParams = field(default_factory=ConnectionParams)
    blocking: BlockingParams = field(default_factory=BlockingParams)
    file_io: FileIoParams = field(default_factory=FileIoParams)
    requests: RequestParams = field(default_factory=RequestParams)
    query_stats: QueryStatsParams = field(default_factory=QueryStatsParams)
    backups: BackupParams = field(default_factory=BackupParams)
    jobs: JobParams = field(default_factory=JobParams)
    alerts: AlertParams = field(default_factory=AlertParams)

    def watched_by(self, monitor: MonitorIdentity) -> CycleParams:
        """The same params, with the monitoring's own work left out of every collector that sees it."""
        return replace(self, blocking=replace(self.blocking, monitor=monitor), requests=replace(self.requests, monitor=monitor),
                       query_stats=replace(self.query_stats, monitor=monitor))
