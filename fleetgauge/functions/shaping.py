"""Reshaping between wide rows and the long metric and evidence layouts."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetgauge.functions.timing import now_or, to_second

SNAPSHOT = ["InstanceId", "CaptureTime"]

METRIC_COLUMNS = [
    "InstanceId", "CaptureTime", "DatabaseName", "ObjectName", "CounterName", "InstanceName",
    "MetricCategory", "MetricValue", "MetricType", "Unit", "SourceCollector",
]
EVIDENCE_COLUMNS = [
    "InstanceId", "CaptureTime", "DatabaseName", "MetricCategory", "DetailType", "Severity",
    "NumericValue1", "NumericValue2", "Details", "SourceCollector",
]


def value(column: Column) -> Column:
    return column.cast("decimal(28,6)")


def to_metrics(
    df: DataFrame,
    counters: Sequence[tuple[str, str]],
    *,
    collector: str,
    category: str,
    object_name: str,
    metric_type: str = "Gauge",
    database: str | None = None,
    sub_instance: str | None = None,
) -> DataFrame:
    """Each wide row becomes one metric row per (counter column, unit)."""
    long = F.inline(F.array(*[
        F.struct(F.lit(c).alias("CounterName"), value(F.col(c)).alias("MetricValue"), F.lit(u).alias("Unit"))
        for c, u in counters
    ]))
    keep = [c for c in (database, sub_instance) if c]
    return metric_rows(
        df.select(*SNAPSHOT, *keep, long),
        object_name=F.lit(object_name), category=category, collector=collector,
        metric_type=F.lit(metric_type), unit=F.col("Unit"),
        database=F.col(database) if database else None,
        sub_instance=F.col(sub_instance) if sub_instance else None,
    )


def metric_rows(
    df: DataFrame, *, object_name: Column, category: str, collector: str, metric_type: Column, unit: Column,
    database: Column | None = None, sub_instance: Column | None = None,
) -> DataFrame:
    """Metric layout for rows that already hold ``CounterName`` and ``MetricValue``."""
    return df.select(
        "InstanceId",
        to_second(F.col("CaptureTime")).alias("CaptureTime"),
        _text(database).alias("DatabaseName"),
        object_name.alias("ObjectName"),
        "CounterName",
        _text(sub_instance).alias("InstanceName"),
        F.lit(category).alias("MetricCategory"),
        value(F.col("MetricValue")).alias("MetricValue"),
        metric_type.alias("MetricType"),
        unit.alias("Unit"),
        F.lit(collector).alias("SourceCollector"),
    )


def to_evidence(
    df: DataFrame, *, collector: str, category: str, detail_type: Column, severity: Column, body: Column,
    value1: Column, value2: Column | None = None, database: Column | None = None,
) -> DataFrame:
    """Each row becomes one text-evidence row."""
    return df.select(
        "InstanceId",
        to_second(F.col("CaptureTime")).alias("CaptureTime"),
        _text(database).alias("DatabaseName"),
        F.lit(category).alias("MetricCategory"),
        detail_type.alias("DetailType"),
        severity.alias("Severity"),
        value(value1).alias("NumericValue1"),
        value(F.lit(None) if value2 is None else value2).alias("NumericValue2"),
        body.alias("Details"),
        F.lit(collector).alias("SourceCollector"),
    )


def _text(column: Column | None) -> Column:
    return F.lit(None).cast("string") if column is None else column


def stored_metrics(metrics: DataFrame, created_at: datetime | None = None) -> DataFrame:
    """Add id, creation time and partition date.

    The id is a hash of the row's natural key, so a repeated task or run gives the same id.
    """
    key = ["InstanceId", "CaptureTime", "SourceCollector", "MetricCategory", "ObjectName", "CounterName",
           "DatabaseName", "InstanceName"]
    return _stored(metrics, "MetricSnapshotId", key, METRIC_COLUMNS, created_at)


def stored_evidence(evidence: DataFrame, created_at: datetime | None = None) -> DataFrame:
    key = ["InstanceId", "CaptureTime", "SourceCollector", "DetailType", "DatabaseName", "Details"]
    rows = _stored(evidence, "MetricTextSnapshotId", key, EVIDENCE_COLUMNS, created_at)
    return rows.withColumn("XmlDetails", F.lit(None).cast("string"))


def _stored(df: DataFrame, id_name: str, key: list[str], columns: list[str], created_at: datetime | None) -> DataFrame:
    return df.select(
        F.xxhash64(*(F.coalesce(F.col(k).cast("string"), F.lit("")) for k in key)).alias(id_name),
        *columns,
        now_or(created_at).alias("CreatedAt"),
        F.col("CaptureTime").cast("date").alias("capture_date"),
    )
