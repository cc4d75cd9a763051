"""Continuous collection: each batch of newly landed snapshots goes through a collector once."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fleetgauge import schemas
from fleetgauge.functions.shaping import SNAPSHOT, stored_evidence, stored_metrics
from fleetgauge.plans.cycle import Collection
from fleetgauge.sources import tables
from fleetgauge.sources.versions import Part, Snapshot


def collect_landed(
    spark: SparkSession, table: str, landing_path: str, build: Callable[[DataFrame], Collection],
    metrics_path: str, evidence_path: str, checkpoint: str, by_date: bool = False,
) -> StreamingQuery:
    """Process all files landed since the last call, then stop.

    A snapshot's rankings and totals need all its rows.  So each snapshot that a batch touches is computed from all
    its rows landed so far, and replaces what was stored for it: one that lands in several batches ends up as if it
    had landed at once, and a batch that is repeated after a failure changes nothing.  ``by_date`` says that the folder
    was landed by ``tables.land``: then only the dates a batch touches are read again.  The checkpoint belongs in
    shared storage.
    """
    schema = schemas.LANDING_TABLES[table] + (", capture_date date" if by_date else "")
    landed = spark.readStream.schema(schema).parquet(landing_path)

    def process(batch: DataFrame, _: int) -> None:
        captured = F.col("CaptureTime").cast("date")
        touched = batch.select(*SNAPSHOT).distinct()
        days = batch.agg(F.min(captured), F.max(captured)).first()
        if days[0] is None:
            return
        whole = spark.read.schema(schema).parquet(landing_path).filter((F.col("capture_date") if by_date else captured).between(*days))
        collection = build(whole.drop("capture_date").join(touched, SNAPSHOT, "left_semi"))
        touched = touched.withColumn("SourceCollector", F.lit(collection.collector))
        replace_snapshots(stored_metrics(collection.metrics), touched, metrics_path, "MetricSnapshot", *days)
        if collection.evidence is not None:
            replace_snapshots(stored_evidence(collection.evidence), touched, evidence_path, "MetricTextSnapshot", *days)

    return (
        landed.writeStream.foreachBatch(process)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def replace_snapshots(rows: DataFrame, touched: DataFrame, path: str, table: str, first: date, last: date) -> None:
    """Store the rows of the touched snapshots (InstanceId, CaptureTime, SourceCollector) in place of their older rows, at one
    moment.  Only the dates ``first`` to ``last`` are read, and only batches that hold older rows are rewritten."""
    stored, schema = tables.open_table(rows.sparkSession, path, table), tables.schema_of(table)
    added, keys = stored.stage(rows), touched.columns
    kept: dict[tuple, dict[str, str]] = {}

    def edit(base: Snapshot) -> dict[str, Part | None]:
        days = base.days(first, last)
        here = base.read(schema, days, with_batch=True).join(touched, keys, "left_semi")
        # One row per batch of these days.
        old = tuple(sorted((str(r["capture_date"]), r["batch"]) for r in here.select("capture_date", "batch").distinct().collect()))
        if old and old not in kept:
            kept[old] = stored.stage(base.read(schema, batches=old).join(touched, keys, "left_anti"))
        out = {}
        for day in {day for day, _ in old} | set(added):
            gone, new = [b for d, b in old if d == day], [kept[old][day]] if old and day in kept[old] else []
            part = base.part(day).replaced(gone, new) if gone else base.part(day)
            out[day] = part.added(added[day]) if day in added else part
        return out

    stored.change(edit)
