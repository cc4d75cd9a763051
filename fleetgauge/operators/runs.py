"""Collection runs: lifecycle, failure isolation, cycle summary, failure triage and row counts."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetgauge import fixed_values as fv
from fleetgauge.functions.ranking import newest_per, top_overall
from fleetgauge.functions.timing import millis_crossed, ntz, rows_before, rows_from
from fleetgauge.sources import tables
from fleetgauge.sources.versions import Part, Snapshot, newest_first

EVENT_COLUMNS = ["CollectionRunId", "EventType", "EventTime", "CollectorName", "InstanceId", "Status",
                 "RowsCollected", "ErrorMessage"]
_REPORT = ["CollectionRunId", "InstanceName", "CollectorName", "StartedAt", "FinishedAt", "Status", "RowsCollected",
           "DurationMs", "ErrorMessage"]


def start_events(roster: DataFrame, collector: str) -> DataFrame:
    """One running event per snapshot; the id is a hash of what identifies the run, so retries repeat it."""
    return roster.select(
        run_id(collector).alias("CollectionRunId"), F.lit("start").alias("EventType"),
        F.col("CaptureTime").alias("EventTime"), F.lit(collector).alias("CollectorName"), "InstanceId",
        F.lit("Running").alias("Status"), F.lit(None).cast("int").alias("RowsCollected"),
        F.lit(None).cast("string").alias("ErrorMessage"),
    )


def run_id(collector: str) -> Column:
    return F.xxhash64(F.lit(collector), F.col("InstanceId"), F.col("CaptureTime").cast("string"))


def finish_events(outcomes: DataFrame, collector: str, finished_at: datetime) -> DataFrame:
    """One finishing event per snapshot of ``outcomes`` (RowsCollected, ErrorMessage; NULL means success)."""
    return outcomes.select(
        run_id(collector).alias("CollectionRunId"), F.lit("finish").alias("EventType"),
        ntz(finished_at).alias("EventTime"), F.lit(None).cast("string").alias("CollectorName"),
        F.lit(None).cast("int").alias("InstanceId"),
        F.when(F.col("ErrorMessage").isNull(), "Success").otherwise("Failed").alias("Status"),
        F.col("RowsCollected").cast("int").alias("RowsCollected"), "ErrorMessage",
    )


def fold_runs(events: DataFrame) -> DataFrame:
    """The current state of each run from its start and finish events, in one shuffle.

    Each run has a handful of events, so ranking them is narrow; of repeated events the last one counts.
    """
    order = [F.col(c).desc() for c in ("EventTime", "Status", "RowsCollected", "ErrorMessage")]
    latest = newest_per(events, ["CollectionRunId", "EventType"], order).drop("rn")
    started = latest.filter("EventType = 'start'").select(
        "CollectionRunId", "CollectorName", "InstanceId", F.col("EventTime").alias("StartedAt"))
    finished = latest.filter("EventType = 'finish'").select(
        "CollectionRunId", F.col("EventTime").alias("FinishedAt"), "Status", "RowsCollected", "ErrorMessage")
    return started.join(finished, "CollectionRunId", "full").select(
        "CollectionRunId", "CollectorName", "InstanceId", "StartedAt", "FinishedAt",
        F.coalesce("Status", F.lit("Running")).alias("Status"), "RowsCollected",
        millis_crossed(F.col("StartedAt"), F.col("FinishedAt")).cast("int").alias("DurationMs"),
        "ErrorMessage", F.col("StartedAt").alias("CreatedAt"),
    )


def stored_runs(spark: SparkSession, path: str) -> DataFrame:
    """The runs whose events a cycle has stored below a path, folded from all of them."""
    return fold_runs(tables.read_table(spark, path, "CollectionRunEvent"))


_EVENTS, _HISTORY = "CollectionRunEvent", "CollectionRunHistory"
# The day of rows without a date in a stored table: runs that are not finished, or whose start is not known yet.
_OPEN = "__HIVE_DEFAULT_PARTITION__"


def _as_events(stored: DataFrame) -> DataFrame:
    """The start and finish events a folded run tells of; folding them again gives the run."""
    nothing = {c: F.lit(None).cast(t) for c, t in (("int", "int"), ("text", "string"))}
    start = F.struct(
        F.lit("start").alias("EventType"), F.col("StartedAt").alias("EventTime"), F.col("CollectorName"), F.col("InstanceId"),
        F.lit("Running").alias("Status"), nothing["int"].alias("RowsCollected"), nothing["text"].alias("ErrorMessage"))
    finish = F.struct(
        F.lit("finish").alias("EventType"), F.col("FinishedAt").alias("EventTime"), nothing["text"].alias("CollectorName"),
        nothing["int"].alias("InstanceId"), "Status", "RowsCollected", "ErrorMessage")
    return stored.select("CollectionRunId", F.inline(F.array(start, finish))).filter(F.col("EventTime").isNotNull())


def refresh_runs(spark: SparkSession, events_path: str, runs_path: str) -> Snapshot:
    """Fold the events stored since the last call into the stored runs; returns the runs' version.

    Finished runs are kept by the date they started and are not touched again.  Runs that are not finished, or of which only
    the finish has come, are carried in a part of their own and folded with the new events.  An event that repeats for a
    finished run (a repeated cycle) takes that run's batch up again: the dates of repeated starts are looked at, and
    only for a finish without any known start the other dates up to it.  Equal to ``fold_runs`` over all events.  Events are
    only ever added: if batches went, the runs are folded anew.
    """
    events, stored = tables.open_table(spark, events_path, _EVENTS), tables.open_table(spark, runs_path, _HISTORY)
    source, schema = events.latest(), tables.schema_of(_HISTORY)
    event_schema = tables.schema_of(_EVENTS)

    def edit(base: Snapshot) -> dict[str, Part | None] | None:
        known = base.notes.get("events")
        if known is not None and known >= source.number:
            return None
        old = events.at(known) if known and events.kept(known) else None
        pairs = {(day, b) for day in source.files for b in source.part(day).batches}
        before = {(day, b) for day in old.files for b in old.part(day).batches} if old else set()
        if known is None or old is None or before - pairs:
            return _dated(base, dict.fromkeys(base.files), stored.stage(_with_start_day(fold_runs(source.read(event_schema)))))
        fresh = source.read(event_schema, batches=sorted(pairs - before)).select(*EVENT_COLUMNS)
        carried = base.read(schema, [_OPEN]) if _OPEN in base.files else base.read(schema, [])
        again = _finished_before(base, schema, fresh, carried)
        runs = fold_runs(fresh.unionByName(_as_events(carried)).unionByName(_as_events(base.read(schema, batches=again).join(
            fresh.select("CollectionRunId"), "CollectionRunId", "left_semi"))))
        out: dict[str, Part | None] = {_OPEN: None}
        others = stored.stage(base.read(schema, batches=again).join(
            fresh.select("CollectionRunId"), "CollectionRunId", "left_anti")) if again else {}
        for day in {day for day, _ in again}:
            out[day] = base.part(day).replaced([b for d, b in again if d == day], [others[day]] if day in others else [])
        return _dated(base, out, stored.stage(_with_start_day(runs)))

    return stored.change(edit, {"events": source.number})


def _dated(base: Snapshot, out: dict[str, Part | None], staged: Mapping[str, str]) -> dict[str, Part | None]:
    """Changed days with a new batch added to each it has rows of."""
    return out | {day: ((out[day] or Part()) if day in out else base.part(day)).added(b) for day, b in staged.items()}


def _with_start_day(runs: DataFrame) -> DataFrame:
    finished = F.col("StartedAt").isNotNull() & F.col("FinishedAt").isNotNull()
    return runs.withColumn("started_date", F.when(finished, F.col("StartedAt").cast("date")))


def _finished_before(base: Snapshot, schema: str, fresh: DataFrame, carried: DataFrame) -> list[tuple[str, str]]:
    """The (day, batch) pairs with finished runs that new events tell of again."""
    starts = fresh.filter("EventType = 'start'")
    # The dates of new starts: one row per date of a cycle.
    dates = {r[0].isoformat() for r in starts.select(F.col("EventTime").cast("date")).distinct().collect() if r[0] is not None}
    alone = fresh.filter("EventType = 'finish'").join(starts, "CollectionRunId", "left_anti").join(
        carried.filter("StartedAt IS NOT NULL"), "CollectionRunId", "left_anti")
    last = alone.agg(F.max(F.col("EventTime").cast("date"))).first()[0]
    if last is not None:
        dates |= set(base.days(last=last))
    days = [day for day in base.days() if day in dates]
    found = base.read(schema, days, with_batch=True).join(fresh.select("CollectionRunId"), "CollectionRunId", "left_semi")
    # One row per batch of these dates.
    return sorted((str(r[0]), r[1]) for r in found.select("started_date", "batch").distinct().collect())


def read_runs(spark: SparkSession, runs_path: str, first_day: date | None = None) -> DataFrame:
    """The folded runs that ``refresh_runs`` keeps: those started from a day on, and all that are not finished."""
    base = tables.open_table(spark, runs_path, _HISTORY).latest()
    days = base.days(first_day) if first_day else base.days()
    rows = base.read(tables.schema_of(_HISTORY), [*days, *([_OPEN] if first_day and _OPEN in base.files else [])])
    return rows.drop("started_date")


def isolate_failures(
    raw: DataFrame, rules: Mapping[str, str], keys: list[str] = ["InstanceId"], quarantined: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Split off the keys with a row that breaks a rule (name -> SQL condition every row must meet), or with a
    ``quarantined`` row.

    Returns the rows of the sound keys and one outcome row per key: rows collected, and for
    a failed key the first broken rule, or how many of its rows could not be read.
    """
    names = list(rules)
    # The position of the first broken rule, not its name: numbers keep this a hash aggregation.
    broken = reduce(
        lambda later, at: F.when(~F.coalesce(F.expr(rules[names[at]]), F.lit(False)), at).otherwise(later),
        reversed(range(len(names))), F.lit(None).cast("int"),
    )
    outcomes = raw.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"), F.min(broken).alias("_broken")).select(
        *keys, F.when(F.col("_broken").isNull(), F.col("_rows")).otherwise(0).alias("RowsCollected"),
        F.get(F.array(*map(F.lit, names)), F.col("_broken")).alias("ErrorMessage"),
    )
    if quarantined is not None:
        # Quarantined rows are counted, never gathered; those without a key fail nobody and stay in the quarantine.
        bad = quarantined.groupBy(*keys).agg(F.count(F.lit(1)).alias("_bad")).dropna(subset=keys)
        unread = F.concat(F.col("_bad").cast("string"), F.lit(" rows could not be read"))
        outcomes = outcomes.join(bad, keys, "full").select(
            *keys, F.when(F.col("_bad").isNull(), F.col("RowsCollected")).otherwise(0).alias("RowsCollected"),
            F.coalesce("ErrorMessage", unread).alias("ErrorMessage"))
    failed = outcomes.filter(F.col("ErrorMessage").isNotNull()).select(*keys)
    return raw.join(failed, keys, "left_anti"), outcomes


def cycle_summary(runs: DataFrame, cycle_start: datetime, cycle_end: datetime) -> DataFrame:
    """Succeeded and failed runs per collector of one cycle."""
    cycle = rows_before(rows_from(runs, "StartedAt", cycle_start), "StartedAt", cycle_end)
    return cycle.groupBy("CollectorName").agg(
        F.count_if(F.col("Status").isin(fv.SUCCESS_STATES)).alias("Succeeded"),
        F.count_if(F.col("Status").isin(fv.FAILURE_STATES)).alias("Failed"),
    )


def collection_failures(
    runs: DataFrame, instances: DataFrame, as_of: datetime, hours: int = 24, top: int = 100,
    instance_name: str | None = None, collector: str | None = None, stale_only: bool = False,
    running_older_than_minutes: int = 15,
) -> DataFrame:
    """The newest runs within the window that did not succeed.

    Running ones are included whatever their age, unless ``stale_only`` asks for the old ones.
    """
    for name, given, low, high in (("hours", hours, 1, 720), ("top", top, 1, 1000),
                                   ("running_older_than_minutes", running_older_than_minutes, 1, 1440)):
        if not low <= given <= high:
            raise ValueError(f"{name} must be between {low} and {high}")
    found = rows_from(runs, "StartedAt", as_of - timedelta(hours=hours)).filter(
        ~F.col("Status").isin(fv.SUCCESS_STATES)
    )
    if stale_only:
        stale = F.col("StartedAt") < ntz(as_of - timedelta(minutes=running_older_than_minutes))
        found = found.filter((F.col("Status") != "Running") | stale)
    if collector:
        found = found.filter(F.col("CollectorName") == collector)
    named = instances.select("InstanceId", "InstanceName")
    if instance_name:
        named = named.filter(F.col("InstanceName") == instance_name)
    joined = found.join(named, "InstanceId").select(*_REPORT)
    return top_overall(joined, [F.col("StartedAt").desc()], ["CollectionRunId"], top)


def recent_history(runs: DataFrame, instances: DataFrame, top: int = 100) -> DataFrame:
    joined = runs.join(instances.select("InstanceId", "InstanceName"), "InstanceId").select(*_REPORT)
    return top_overall(joined, [F.col("StartedAt").desc()], ["CollectionRunId"], top)


def stored_history(spark: SparkSession, runs_path: str, instances: DataFrame, top: int = 100) -> DataFrame:
    """``recent_history`` of the stored runs, read from the newest start dates only as far back as the report reaches."""
    def known(runs: DataFrame) -> DataFrame:
        return runs.join(instances.select("InstanceId"), "InstanceId", "left_semi").select("CollectionRunId").distinct()

    return recent_history(_newest_runs(spark, runs_path, top, known), instances, top)


def stored_failures(
    spark: SparkSession, runs_path: str, instances: DataFrame, as_of: datetime, hours: int = 24, top: int = 100, **only,
) -> DataFrame:
    """``collection_failures`` of the stored runs, read likewise and never beyond the window."""
    def failed(runs: DataFrame) -> DataFrame:
        return collection_failures(runs, instances, as_of, hours, top, **only)

    first = (as_of - timedelta(hours=hours)).date()
    return failed(_newest_runs(spark, runs_path, top, failed, first))


def _newest_runs(spark: SparkSession, runs_path: str, top: int, wanted: Callable[[DataFrame], DataFrame],
                 first: date | None = None) -> DataFrame:
    """Runs among which the ``top`` newest wanted ones are: all open ones and enough of the newest dates."""
    base, schema = tables.open_table(spark, runs_path, _HISTORY).latest(), tables.schema_of(_HISTORY)
    dated = Snapshot(base.table, base.number, {d: f for d, f in base.files.items() if d != _OPEN}, base.notes)
    newest = newest_first(dated, schema, top, lambda rows: wanted(rows.drop("started_date")), first)
    return newest.unionByName(base.read(schema, [_OPEN] if _OPEN in base.files else [])).drop("started_date")


def row_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table with its row count."""
    counts = [df.agg(F.count(F.lit(1)).alias("RowCount")).select(F.lit(name).alias("TableName"), "RowCount")
              for name, df in frames.items()]
    return reduce(DataFrame.unionByName, counts).orderBy("TableName")
