"""Hand-written rows for the core and landing tables; columns not named are NULL."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from fleetgauge import schemas

DAY = datetime(2024, 3, 10)


def _frame(spark: SparkSession, ddl: str, rows: list[dict]) -> DataFrame:
    names = [part.split()[0] for part in _split(ddl)]
    return spark.createDataFrame([tuple(row.get(n) for n in names) for row in rows], ddl)


def _split(ddl: str) -> list[str]:
    parts, depth, current = [], 0, ""
    for ch in ddl:
        depth += (ch == "(") - (ch == ")")
        if ch == "," and depth == 0:
            parts.append(current)
            current = ""
        else:
            current += ch
    return [p.strip() for p in [*parts, current]]


def core(spark: SparkSession, table: str, rows: list[dict]) -> DataFrame:
    return _frame(spark, schemas.CORE_TABLES[table], rows)


def landing(spark: SparkSession, table: str, rows: list[dict], **common) -> DataFrame:
    base = {"InstanceId": 1, "CaptureTime": DAY, **common}
    return _frame(spark, schemas.LANDING_TABLES[table], [{**base, **row} for row in rows])


def instances(spark: SparkSession, *ids: int, **columns) -> DataFrame:
    return core(spark, "monitored_instances", [
        {"InstanceId": i, "InstanceName": f"srv{i}", "EnvironmentName": "prod", "IsEnabled": True,
         "CollectionProfile": "Standard", **columns} for i in ids
    ])


def metrics(spark: SparkSession, rows: list[tuple], **common) -> DataFrame:
    """Rows of (instance, capture time, counter, value)."""
    return core(spark, "metric_snapshot", [
        {"MetricSnapshotId": n, "InstanceId": i, "CaptureTime": t, "CounterName": c, "MetricValue": Decimal(str(v)),
         "capture_date": t.date(), "MetricCategory": "x", **common}
        for n, (i, t, c, v) in enumerate(rows)
    ])


def roster(spark: SparkSession, *ids: int) -> DataFrame:
    return spark.createDataFrame([(i, DAY) for i in ids], "InstanceId int, CaptureTime timestamp_ntz")


def by(df: DataFrame, key: str = "InstanceId") -> dict:
    return {row[key]: row for row in df.collect()}
