"""Stored tables: reading with explicit schemas, appending partitioned by date, scratch space.

Every stored table is kept in versions (``sources.versions``): readers see whole writes, and writers that repeat, break off
or meet leave nothing twice and nothing out.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from datetime import date, datetime
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fleetgauge import schemas
from fleetgauge.functions.shaping import stored_evidence, stored_metrics
from fleetgauge.sources.versions import Snapshot, VersionedTable

# Table name -> (schema, date partition column).
_STORED = {
    "MonitoredInstances": (schemas.MONITORED_INSTANCES, None),
    "CollectionRunHistory": (schemas.COLLECTION_RUN_HISTORY + ", started_date date", "started_date"),
    "MetricSnapshot": (schemas.METRIC_SNAPSHOT, "capture_date"),
    "MetricTextSnapshot": (schemas.METRIC_TEXT_SNAPSHOT, "capture_date"),
    "CollectionRunEvent": (schemas.COLLECTION_RUN_EVENT + ", event_date date", "event_date"),
    "AnomalyEvents": (schemas.ANOMALY_EVENTS, None),
}
PARTITIONS = {name: partition for name, (_, partition) in _STORED.items() if partition}


def open_table(spark: SparkSession, path: str, table: str) -> VersionedTable:
    return _clustered_table(spark, path, _STORED[table][1])


def _clustered_table(spark: SparkSession, path: str, partition: str | None) -> VersionedTable:
    return VersionedTable(spark, path, partition, (lambda rows: clustered(rows, partition)) if partition else (lambda rows: rows))


def schema_of(table: str) -> str:
    return _STORED[table][0]


def read_table(spark: SparkSession, path: str, table: str, since: date | None = None) -> DataFrame:
    """The newest version of a stored core table; ``since`` leaves out whole date partitions."""
    schema, partition = _STORED[table]
    rows = open_table(spark, path, table).latest().read(schema)
    return rows.filter(F.col(partition) >= F.lit(since)) if since and partition else rows


def read_commit(spark: SparkSession, path: str, table: str, key: str, days: list[date]) -> DataFrame:
    """The rows stored under a commit key, of which nothing else is read."""
    latest, names = open_table(spark, path, table).latest(), [d.isoformat() for d in days]
    return latest.read(_STORED[table][0], batches=[(d, b) for d in names for b in latest.part(d).keys.get(key, ())])


def since(rows: DataFrame, first_day: date | None) -> DataFrame:
    """Bound a view over a history to recent date partitions."""
    return rows if first_day is None else rows.filter(F.col("capture_date") >= F.lit(first_day))


def read_landing(spark: SparkSession, path: str, table: str, file_format: str = "parquet") -> DataFrame:
    """A landed snapshot table, from Parquet, JSON lines or CSV, always with its declared schema."""
    reader = spark.read.schema(schemas.LANDING_TABLES[table])
    if file_format == "csv":
        reader = reader.option("header", True)
    return reader.format(file_format).load(path)


_UNREADABLE = "_unreadable"


def read_checked(spark: SparkSession, path: str, table: str, file_format: str = "parquet") -> tuple[DataFrame, DataFrame]:
    """A landed snapshot table as (sound rows, quarantined rows).

    Quarantined are JSON lines and CSV rows that are malformed or hold a value of another type, and rows of any format
    without instance or capture time: LandingTable, InstanceId and CaptureTime as far as they could be read, Reason, and the
    row as it came.  A quarantined row is never among the sound ones, not even in part.
    """
    schema = schemas.LANDING_TABLES[table]
    checked, options = f"{schema}, {_UNREADABLE} string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _UNREADABLE}
    # Every field is parsed, whichever are asked for: readers that leave fields out do not see what is wrong with them.
    if file_format == "json":
        lines = spark.read.text(path).filter(F.trim("value") != "")
        rows = lines.select(F.from_json("value", checked, options).alias("row")).select("row.*")
    elif file_format == "csv":
        fields = StructType.fromDDL(schema).fields
        texts = ", ".join(f"{f.name} string" for f in fields)
        read = spark.read.schema(f"{texts}, {_UNREADABLE} string").options(**options, header=True, enforceSchema=False).csv(path)
        typed = {f.name: F.col(f.name).try_cast(f.dataType) for f in fields}
        wrong = reduce(or_, (F.col(n).isNotNull() & value.isNull() for n, value in typed.items()))
        row = F.coalesce(_UNREADABLE, F.when(wrong, F.to_json(F.struct(*typed))))
        rows = read.select(*(value.alias(n) for n, value in typed.items()), row.alias(_UNREADABLE))
    else:
        rows = spark.read.schema(schema).format(file_format).load(path).withColumn(_UNREADABLE, F.lit(None).cast("string"))
    names = [c for c in rows.columns if c != _UNREADABLE]
    unnamed = F.col("InstanceId").isNull() | F.col("CaptureTime").isNull()
    reason = F.when(F.col(_UNREADABLE).isNotNull(), "row cannot be read").when(unnamed, "instance or capture time is missing")
    quarantined = rows.filter(F.col(_UNREADABLE).isNotNull() | unnamed).select(
        F.lit(table).alias("LandingTable"), "InstanceId", "CaptureTime", reason.alias("Reason"),
        F.coalesce(_UNREADABLE, F.to_json(F.struct(*names))).alias("Row"))
    return rows.filter(F.col(_UNREADABLE).isNull() & ~unnamed).select(*names), quarantined


def land(rows: DataFrame, path: str) -> None:
    """Land snapshot rows by capture date, so that collecting reads only the dates it needs."""
    rows.withColumn("capture_date", F.col("CaptureTime").cast("date")).write.mode("append").partitionBy("capture_date").parquet(path)


# Rows of a file are sorted by what readers filter and rank by, so that row groups can be skipped.
_SORTED_BY = ["SourceCollector", "CollectorName", "InstanceId", "CounterName", "DetailType", "DatabaseName",
              "InstanceName", "CaptureTime", "StartedAt"]


def clustered(df: DataFrame, partition: str) -> DataFrame:
    """Rows as they are stored: by date and sorted within files.

    The rebalance lets adaptive execution split a date that holds most rows and merge small ones,
    so neither one task nor many tiny files result.
    """
    order = [partition, *(c for c in _SORTED_BY if c in df.columns)]
    return df.hint("rebalance", partition).sortWithinPartitions(*order)


def append(df: DataFrame, path: str, partition: str) -> None:
    _clustered_table(df.sparkSession, path, partition).append(df)


def append_in_turn(df: DataFrame, path: str, partition: str, turns: Sequence[Callable[[date], bool]]) -> Iterator[Snapshot]:
    """Append rows as one version after another, each with the days of one turn; rows whose day is of no turn are left out.

    The rows are derived, clustered and written once, before the first turn; a turn adds what was written for its days.
    """
    dated = df.filter(F.col(partition).isNotNull())
    table = _clustered_table(df.sparkSession, path, partition)
    staged = table.stage(dated)
    for of_turn in turns:
        yield table.publish({day: batch for day, batch in staged.items() if of_turn(date.fromisoformat(day))})


def write_metrics(metrics: DataFrame, path: str, created_at: datetime | None = None) -> None:
    append(stored_metrics(metrics, created_at), path, "capture_date")


def write_evidence(evidence: DataFrame, path: str, created_at: datetime | None = None) -> None:
    append(stored_evidence(evidence, created_at), path, "capture_date")


def write_runs(runs: DataFrame, path: str) -> None:
    append(runs.withColumn("started_date", F.col("StartedAt").cast("date")), path, "started_date")


def append_once(rows: DataFrame, path: str, table: str, key: str, days: list[date] | None = None) -> None:
    """Append the rows that have not been stored under this commit key, which may be of the given days.

    Ids are hashes of the rows' keys, so a repeated row is found again.  The first time nothing is read; a repetition is
    compared with what its own key stored, not with the day.
    """
    schema, partition = _STORED[table]
    names = None if days is None else [d.isoformat() for d in days]
    open_table(rows.sparkSession, path, table).append_once(
        rows, key, [partition, f"{table}Id"], schema, names)


def write_run_events(events: DataFrame, path: str) -> None:
    """Append run events by date.  Folding takes the last of repeated events, so nothing has to be looked up."""
    days = events.withColumn("event_date", F.col("EventTime").cast("date"))
    VersionedTable(events.sparkSession, path, "event_date").append(days)


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A new folder under the shared directory that ``spark.checkpoint.dir`` names."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def date_folders(spark: SparkSession, path: str, partition: str) -> Iterator[tuple[date, str]]:
    """The dates of a stored table and the folders they are kept in, newest first; no file is opened."""
    latest = VersionedTable(spark, path, partition).latest()
    for day in latest.days():
        if day[:4].isdigit():
            yield from ((date.fromisoformat(day), f"{path.rstrip('/')}/data/batch={b}/{partition}={day}") for b in latest.part(day).batches)


def exists(spark: SparkSession, path: str) -> bool:
    return VersionedTable(spark, path).exists()
