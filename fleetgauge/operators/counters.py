"""Performance counters and processor samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetgauge import fixed_values as fv
from fleetgauge.functions.ranking import newest_per
from fleetgauge.functions.shaping import SNAPSHOT, metric_rows, to_metrics

CATEGORY = "PerformanceCounter"

_RECORD = "SchedulerMonitorEvent struct<SystemHealth: struct<ProcessUtilization: int, SystemIdle: int>>"


def captured(raw: DataFrame) -> DataFrame:
    return raw.filter(F.col("counter_name").isin(fv.CAPTURED_COUNTERS))


def metric_type(counter: Column) -> Column:
    return F.when(counter.isin(fv.GAUGE_COUNTERS), "Gauge").otherwise("Cumulative")


def unit(counter: Column) -> Column:
    return (
        F.when(counter.like("%Memory%KB%"), "KB")
        .when(counter == "Page life expectancy", "sec")
        .otherwise("count")
    )


def counter_metrics(raw: DataFrame) -> DataFrame:
    """One metric row per captured counter value; a missing value has no row."""
    counter = F.col("counter_name")
    rows = captured(raw).filter(F.col("cntr_value").isNotNull()).select(
        *SNAPSHOT, "object_name", "instance_name",
        counter.alias("CounterName"), F.col("cntr_value").alias("MetricValue"),
    )
    name = F.col("CounterName")
    return metric_rows(
        rows, object_name=F.col("object_name"), category=CATEGORY, collector=fv.PERFORMANCE_COUNTERS,
        metric_type=metric_type(name), unit=unit(name),
        sub_instance=F.when(F.trim("instance_name") != "", F.col("instance_name")),
    )


def cpu_samples(ring: DataFrame) -> DataFrame:
    """The newest processor sample of each snapshot; only the chosen record is parsed."""
    samples = ring.filter(
        (F.col("ring_buffer_type") == "RING_BUFFER_SCHEDULER_MONITOR")
        & F.col("record").contains("<SystemHealth>")
    )
    newest = newest_per(samples, SNAPSHOT, [F.col("ts").desc(), F.col("record").desc()])
    health = F.col("parsed.SchedulerMonitorEvent.SystemHealth")
    return newest.withColumn("parsed", F.from_xml("record", _RECORD)).select(
        *SNAPSHOT,
        health["ProcessUtilization"].alias("SqlProcessCpuPercent"),
        health["SystemIdle"].alias("SystemIdlePercent"),
        (100 - health["SystemIdle"]).alias("SystemCpuPercent"),
    )


def cpu_metrics(samples: DataFrame) -> DataFrame:
    percents = [(c, "percent") for c in ("SqlProcessCpuPercent", "SystemCpuPercent", "SystemIdlePercent")]
    rows = to_metrics(
        samples, percents, collector=fv.PERFORMANCE_COUNTERS, category=CATEGORY, object_name="CPU",
    )
    return rows.filter(F.col("MetricValue").isNotNull())
