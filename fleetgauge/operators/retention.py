"""Retention: cutoffs, what a purge removes, and the purge of a stored table."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetgauge.functions.timing import ntz, rows_before, rows_from
from fleetgauge.operators.runs import row_counts
from fleetgauge.params import RetentionParams
from fleetgauge.sources import tables
from fleetgauge.sources.versions import Part, Snapshot

TIME_COLUMNS = {
    "MetricSnapshot": "CaptureTime", "MetricTextSnapshot": "CaptureTime", "CollectionRunHistory": "StartedAt",
}


def cutoffs(as_of: datetime, params: RetentionParams = RetentionParams()) -> dict[str, datetime]:
    """The oldest moment each table keeps."""
    days = {
        "MetricSnapshot": params.metric_days, "MetricTextSnapshot": params.text_days,
        "CollectionRunHistory": params.history_days,
    }
    return {table: as_of - timedelta(days=d) for table, d in days.items()}


def retained(
    df: DataFrame, table: str, as_of: datetime, params: RetentionParams = RetentionParams(),
) -> DataFrame:
    return rows_from(df, TIME_COLUMNS[table], cutoffs(as_of, params)[table])


def purge_summary(
    frames: Mapping[str, DataFrame], as_of: datetime, params: RetentionParams = RetentionParams(),
) -> DataFrame:
    """Rows each table loses and its cutoff."""
    limits = cutoffs(as_of, params)
    lost = row_counts({t: rows_before(df, TIME_COLUMNS[t], limits[t]) for t, df in frames.items()})
    limit = F.lit(None).cast("timestamp_ntz")
    for table, moment in limits.items():
        limit = F.when(F.col("TableName") == table, ntz(moment)).otherwise(limit)
    return lost.select(
        "TableName", F.col("RowCount").alias("RowsDeleted"), limit.alias("CutoffDate"),
    ).orderBy("TableName")


def purge(
    spark: SparkSession, path: str, table: str, as_of: datetime, params: RetentionParams = RetentionParams(),
) -> None:
    """Drop the expired rows of a stored table, all at one moment: a purge that breaks off has dropped nothing.

    Whole expired dates leave the table without being read; of the date the cutoff falls into, only batches with expired
    rows are rewritten.  The files go with ``VersionedTable.vacuum``.
    """
    cutoff, schema = cutoffs(as_of, params)[table], tables.schema_of(table)
    stored, boundary = tables.open_table(spark, path, table), cutoff.date().isoformat()
    expired = F.col(TIME_COLUMNS[table]) < ntz(cutoff)
    rewritten: dict[str | None, Part] = {}

    def edit(base: Snapshot) -> dict[str, Part | None]:
        out: dict[str, Part | None] = {day: None for day in base.days(last=cutoff.date()) if day < boundary}
        state = base.files.get(boundary)
        if state not in rewritten:
            rows = base.read(schema, [boundary] if state else [], with_batch=True)
            old = [r["batch"] for r in rows.filter(expired).select("batch").distinct().collect()]  # batches of one day
            kept = base.read(schema, batches=[(boundary, b) for b in old]).filter(~F.coalesce(expired, F.lit(False)))
            staged = stored.stage(kept) if old else {}
            rewritten[state] = base.part(boundary).replaced(old, staged.values())
        if rewritten[state] != base.part(boundary):
            out[boundary] = rewritten[state]
        return out

    stored.change(edit)
