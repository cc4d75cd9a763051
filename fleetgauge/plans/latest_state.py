"""The maintained latest state: what the current views need of the history, kept up to date instead of searched for.

The state is a stored table with the rows of each series' two newest capture times, and with the batch of the history each
row came from.  ``refresh`` compares the version of the history the state was made from with the newest one.  Added
batches are merged in; rows whose batch is gone (replaced, purged or compacted) are taken out.  A series that lost rows
may need older ones than the state had: only if its two newest captures now reach below what the state knew, the history
is searched for that series, newest days first and no further than needed.

The rows of the two newest captures per series are among the state's, and a view that ranks coarser groups by capture time
takes its first two captures from them.  So every current view gives the same on ``state_rows`` as on the whole history.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetgauge import schemas
from fleetgauge.sources import tables
from fleetgauge.sources.versions import WHOLE, Part, Snapshot, VersionedTable

_SERIES = ["InstanceId", "SourceCollector", "MetricCategory", "ObjectName", "CounterName", "DatabaseName", "InstanceName"]
_SCHEMA = schemas.METRIC_SNAPSHOT + ", origin string"
_CAPTURES = 2


def _newest(rows: DataFrame) -> DataFrame:
    """The rows of the newest captures of each series; each task sends on only those of the captures it sees."""
    place = F.dense_rank().over(Window.partitionBy(*_SERIES).orderBy(F.col("CaptureTime").desc()))
    return rows.withColumn("_place", place).filter(F.col("_place") <= _CAPTURES).drop("_place")


def _in_series(rows: DataFrame, series: DataFrame, how: str) -> DataFrame:
    named = series.withColumnsRenamed({c: f"_{c}" for c in _SERIES})
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in _SERIES]
    return rows.join(named, same, how).drop(*(f"_{c}" for c in _SERIES))


def _day(rows: DataFrame) -> DataFrame:
    return rows.withColumn("_day", F.coalesce(F.col("capture_date").cast("string"), F.lit("")))


def _history(source: Snapshot, **what) -> DataFrame:
    return source.read(schemas.METRIC_SNAPSHOT, with_batch=True, **what).withColumnRenamed("batch", "origin")


def _difference(old: Snapshot, new: Snapshot) -> tuple[list[tuple[str, str]], list[tuple[str, str]]]:
    """The (day, batch) pairs that were added and removed; days with an unchanged part are not looked at."""
    added, removed = [], []
    for day in {*old.files, *new.files}:
        if old.files.get(day) != new.files.get(day):
            before, now = set(old.part(day).batches), set(new.part(day).batches)
            added += [(day, b) for b in sorted(now - before)]
            removed += [(day, b) for b in sorted(before - now)]
    return added, removed


def refresh(spark: SparkSession, metrics_path: str, state_path: str) -> Snapshot:
    """Bring the state up to the newest version of the history; returns the state's version.

    Reads the state and the added batches; after replaced or removed batches also the days that must be searched for
    the series concerned.  Without a state, or if the version it was made from is no longer kept, the state is made from
    the whole history.  Of refreshes that meet, the one that knows more of the history stays.
    """
    history, state = tables.open_table(spark, metrics_path, "MetricSnapshot"), VersionedTable(spark, state_path)
    source = history.latest()

    def edit(base: Snapshot) -> dict[str, Part | None] | None:
        known = base.notes.get("history")
        if known is not None and known >= source.number:
            return None
        if known is None or not history.kept(known):
            rows = _newest(_history(source))
        else:
            rows = _merged(base.read(_SCHEMA), source, *_difference(history.at(known) if known else Snapshot(history, 0, {}, {}), source))
        staged = state.stage(rows.select(*(column.split()[0] for column in _SCHEMA.split(", "))))
        return {WHOLE: Part((staged[WHOLE],))}

    return state.change(edit, {"history": source.number})


def _merged(state: DataFrame, source: Snapshot, added: list[tuple[str, str]], removed: list[tuple[str, str]]) -> DataFrame:
    fresh = _history(source, batches=added)
    if not removed:
        return _newest(state.unionByName(fresh))
    spark, at = state.sparkSession, ["_day", "origin"]
    gone = spark.createDataFrame([(d if d[:4].isdigit() else "", b) for d, b in removed], "_day string, origin string")
    dated = _day(state)
    newest = _newest(dated.join(gone, at, "left_anti").drop("_day").unionByName(fresh))

    # Series that lost rows, with the oldest capture the state had of them: the history has no other row from there on.
    lost = dated.join(gone, at, "left_semi").select(*_SERIES).distinct()
    floors = _in_series(state, lost, "left_semi").groupBy(*_SERIES).agg(
        F.min("CaptureTime").alias("_floor"), F.countDistinct("CaptureTime").alias("_captures"))
    # Of a series with fewer captures the state had all rows, so there is nothing older to search for.
    floors = floors.filter(F.col("_captures") == _CAPTURES).drop("_captures")
    wanted = _unsettled(newest, floors).persist()
    try:
        reach = wanted.agg(F.max("_floor")).first()[0]
        if reach is None:
            return newest
        # Of the wanted series, what the state and the added batches tell about the time from the floor on stays.
        known = _in_series(newest, wanted, "left").filter(F.col("_floor").isNull() | (F.col("CaptureTime") >= F.col("_floor")))
        known, days, upto = known.drop("_floor"), source.days(last=reach.date()), 0
        while True:
            upto = min(len(days), 2 * upto or 1)
            older = _in_series(_history(source, days=days[:upto]), wanted, "inner").filter(F.col("CaptureTime") < F.col("_floor"))
            rows = _newest(known.unionByName(older.drop("_floor")))
            # Days not searched hold only older captures than those searched.
            if upto == len(days) or _unsettled(rows, wanted.withColumn("_floor", F.lit(None).cast("timestamp_ntz"))).isEmpty():
                return rows
    finally:
        wanted.unpersist()


def _unsettled(rows: DataFrame, floors: DataFrame) -> DataFrame:
    """The series of ``floors`` without two captures from their floor on (a null floor takes any capture)."""
    seen = _in_series(rows.select(*_SERIES, "CaptureTime"), floors, "inner").filter(
        F.col("_floor").isNull() | (F.col("CaptureTime") >= F.col("_floor")))
    settled = seen.groupBy(*_SERIES).agg(F.countDistinct("CaptureTime").alias("_captures")).filter(
        F.col("_captures") >= _CAPTURES).select(*_SERIES)
    return _in_series(floors, settled, "left_anti")


def state_rows(spark: SparkSession, state_path: str) -> DataFrame:
    """The state in the layout of the history: give it to a current view in place of the history."""
    return VersionedTable(spark, state_path).latest().read(_SCHEMA).drop("origin")
