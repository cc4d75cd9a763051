from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

from fleetgauge.operators import inventory, retention, runs
from fleetgauge.params import (
    AlertParams, BackupParams, BlockingParams, ConnectionParams, CycleParams, FileIoParams, JobParams, MonitorIdentity,
    QueryStatsParams, RequestParams, RetentionParams,
)
from fleetgauge.plans import cycle
from fleetgauge.plans import reporting_views as rv
from fleetgauge.plans import repository_views as pv
from fleetgauge.sources import tables
from fleetgauge.streaming import landing as stream
from tests.helpers import DAY, by, core, instances, landing, metrics, roster

NOW = datetime(2024, 3, 10, 12)


def registration(spark, *names, profile="V2_FULL"):
    return spark.createDataFrame(
        [(n, "test", "Standard", profile, "17", "Dev", f"note {n}") for n in names],
        "InstanceName string, EnvironmentName string, CollectionProfile string, ComplianceProfile string, SqlVersion string, Edition string, Notes string")


def test_registration_updates_known_and_numbers_new_names(spark):
    known = instances(spark, 3, 7, IsEnabled=False, CreatedAt=DAY)
    names = ["srv7", *(f"new{i}" for i in range(600))]
    after = by(inventory.register(known, registration(spark, *names), NOW), "InstanceName")
    assert (after["srv7"].InstanceId, after["srv7"].IsEnabled, after["srv7"].CreatedAt, after["srv7"].ModifiedAt) == (7, True, DAY, NOW)
    assert (after["srv3"].IsEnabled, after["srv3"].ModifiedAt, after["srv3"].EnvironmentName) == (False, None, "prod")
    assert sorted(r.InstanceId for n, r in after.items() if n.startswith("new")) == list(range(8, 608))
    assert after["new5"].CreatedAt == after["new5"].ModifiedAt == NOW


def test_registering_twice_changes_nothing_but_the_stamp(spark):
    first = inventory.register(instances(spark, 1), registration(spark, "srv1", "x", "y"), NOW)
    second = inventory.register(first, registration(spark, "srv1", "x", "y"), NOW + timedelta(days=1))
    assert sorted(first.drop("ModifiedAt").collect()) == sorted(second.drop("ModifiedAt").collect())


def test_first_registration_starts_at_one(spark):
    assert [r.InstanceId for r in inventory.register(instances(spark), registration(spark, "a"), NOW).collect()] == [1]


def test_unknown_profile_is_refused(spark):
    with pytest.raises(PySparkException, match="not a compliance profile"):
        inventory.register(instances(spark, 1), registration(spark, "a", profile="V9"), NOW).collect()


def test_seed_keeps_known_instances(spark):
    after = by(inventory.seed(instances(spark, 1), registration(spark, "srv1", "b"), NOW), "InstanceName")
    assert after["srv1"].EnvironmentName == "prod" and (after["b"].InstanceId, after["b"].ModifiedAt) == (2, None)


def changes(spark, *rows):
    return spark.createDataFrame(rows, "InstanceName string, State string, Reason string")


@pytest.mark.parametrize("notes, reason, expected", [
    (None, "", None), (None, "r", "r"), ("", "r", "r"), ("n", "r", "n | r"), ("n", "", "n"), ("n", None, "n"),
])
def test_state_change_appends_the_reason(spark, notes, reason, expected):
    row = inventory.set_state(instances(spark, 1, Notes=notes), changes(spark, ("srv1", "Disable", reason)), NOW).first()
    assert (row.Notes, row.IsEnabled, row.ModifiedAt) == (expected, False, NOW)


def test_state_change_of_an_unknown_name_is_an_error(spark):
    known, unknown = instances(spark, 1), changes(spark, ("other", "Enable", ""))
    assert [r.InstanceName for r in inventory.unknown_names(known, unknown).collect()] == ["other"]
    with pytest.raises(PySparkException, match="not registered: other"):
        inventory.set_state(known, unknown, NOW).collect()


def test_profiles_default_to_simple(spark):
    known = instances(spark, 1, ComplianceProfile=None).unionByName(instances(spark, 2, ComplianceProfile=" ")).unionByName(
        instances(spark, 3, ComplianceProfile="V2_FULL"))
    assert {i: r.ComplianceProfile for i, r in by(inventory.enabled_profiles(known)).items()} == {1: "V1_SIMPLE", 2: "V1_SIMPLE", 3: "V2_FULL"}
    old = inventory.with_default_column(known.drop("ComplianceProfile"), "ComplianceProfile", "V1_SIMPLE")
    assert {r.ComplianceProfile for r in old.collect()} == {"V1_SIMPLE"}


def test_run_events_fold_to_the_latest_state(spark):
    who = roster(spark, 1, 2, 3)
    outcomes = spark.createDataFrame([(1, DAY, 5, None), (2, DAY, 0, "boom")], "InstanceId int, CaptureTime timestamp_ntz, RowsCollected int, ErrorMessage string")
    events = runs.start_events(who, "c").unionByName(runs.finish_events(outcomes, "c", DAY + timedelta(seconds=2, milliseconds=7)))
    folded = by(runs.fold_runs(events.unionByName(events)))
    assert (folded[1].Status, folded[1].RowsCollected, folded[1].DurationMs) == ("Success", 5, 2007)
    assert (folded[2].Status, folded[2].ErrorMessage) == ("Failed", "boom")
    assert (folded[3].Status, folded[3].FinishedAt, folded[3].DurationMs) == ("Running", None, None)


def test_one_bad_instance_does_not_stop_the_others(spark):
    raw = landing(spark, "raw_counters", [{"InstanceId": i, "counter_name": "x", "cntr_value": v} for i, v in ((1, 1), (1, None), (2, 3))])
    sound, outcomes = runs.isolate_failures(raw, {"value missing": "cntr_value IS NOT NULL", "negative": "cntr_value >= 0"})
    assert {r.InstanceId for r in sound.collect()} == {2}
    assert {i: (r.RowsCollected, r.ErrorMessage) for i, r in by(outcomes).items()} == {1: (0, "value missing"), 2: (1, None)}


def history(spark, *rows):
    return core(spark, "collection_run_history", [
        {"CollectionRunId": n, "InstanceId": 1, "CollectorName": "c", "StartedAt": NOW - age, "Status": status}
        for n, (age, status) in enumerate(rows)])


def test_failures_include_young_running_runs_unless_stale_only(spark):
    rows = history(spark, (timedelta(minutes=1), "Running"), (timedelta(minutes=15, seconds=1), "Running"), (timedelta(hours=24), "Failed"),
                   (timedelta(hours=24, seconds=1), "Failed"), (timedelta(minutes=2), "Success"), (timedelta(minutes=3), "Odd"))
    found = runs.collection_failures(rows, instances(spark, 1), NOW).collect()
    assert [r.CollectionRunId for r in found] == [0, 5, 1, 2]
    stale = runs.collection_failures(rows, instances(spark, 1), NOW, stale_only=True).collect()
    assert [r.CollectionRunId for r in stale] == [5, 1, 2]
    assert runs.collection_failures(rows, instances(spark, 1), NOW, instance_name="other").count() == 0


@pytest.mark.parametrize("arguments", [{"hours": 0}, {"hours": 721}, {"top": 0}, {"top": 1001}, {"running_older_than_minutes": 0}])
def test_failure_report_checks_its_arguments(spark, arguments):
    with pytest.raises(ValueError):
        runs.collection_failures(history(spark), instances(spark, 1), NOW, **arguments)


@pytest.mark.parametrize("days", [(6, 90, 365), (90, 6, 365), (90, 90, 29)])
def test_retention_below_the_minimum_is_refused(days):
    with pytest.raises(ValueError):
        RetentionParams(*days)
    RetentionParams(7, 7, 30)


def test_purge_drops_expired_dates_and_rewrites_only_the_boundary(spark, tmp_path):
    path = str(tmp_path / "metrics")
    rows = metrics(spark, [(i, NOW - timedelta(days=d), "c", d) for d in range(12) for i in (1, 2)], SourceCollector="s")
    late = metrics(spark, [(9, NOW - timedelta(days=8, seconds=-1), "c", 1)], SourceCollector="s")
    tables.append(rows.unionByName(late), path, "capture_date")
    stored = tables.read_table(spark, path, "MetricSnapshot")
    params, before = RetentionParams(metric_days=8), stored.count()
    frames = {"MetricSnapshot": stored, "MetricTextSnapshot": core(spark, "metric_text_snapshot", []), "CollectionRunHistory": history(spark)}
    summary = by(retention.purge_summary(frames, NOW, params), "TableName")
    untouched = {f for f in stored.inputFiles() if "capture_date=2024-03-0" in f and f.split("capture_date=")[1][:10] > "2024-03-02"}
    retention.purge(spark, path, "MetricSnapshot", NOW, params)
    left = tables.read_table(spark, path, "MetricSnapshot")
    assert left.count() == before - summary["MetricSnapshot"].RowsDeleted == 19
    assert summary["MetricSnapshot"].CutoffDate == NOW - timedelta(days=8)
    assert untouched <= set(left.inputFiles())
    assert min(d for d, _ in tables.date_folders(spark, path, "capture_date")).isoformat() == "2024-03-02"
    retention.purge(spark, path, "MetricSnapshot", NOW, params)
    assert tables.read_table(spark, path, "MetricSnapshot").count() == 19


def test_purge_drops_a_boundary_date_that_is_wholly_expired(spark, tmp_path):
    path = str(tmp_path / "metrics")
    rows = metrics(spark, [(1, NOW - timedelta(days=8, hours=1), "c", 1), (1, NOW, "c", 1)], SourceCollector="s")
    tables.append(rows, path, "capture_date")
    retention.purge(spark, path, "MetricSnapshot", NOW, RetentionParams(metric_days=8))
    assert [d.isoformat() for d, _ in tables.date_folders(spark, path, "capture_date")] == ["2024-03-10"]


@pytest.mark.parametrize("file_format", ["parquet", "json", "csv"])
def test_landing_formats_read_with_the_declared_schema(spark, tmp_path, file_format):
    rows = landing(spark, "raw_waits", [{"wait_type": "A", "wait_time_ms": 5}, {"wait_type": "B"}])
    path = str(tmp_path / file_format)
    rows.write.format(file_format).option("header", True).save(path)
    assert sorted(tables.read_landing(spark, path, "raw_waits", file_format).collect(), key=str) == sorted(rows.collect(), key=str)


CAPTURED = datetime(2001, 8, 2)


@pytest.fixture(scope="module")
def finished_cycle(spark, inputs, tmp_path_factory):
    """One whole cycle over the derived landing tables, all captured at one moment."""
    root = str(tmp_path_factory.mktemp("cycle"))
    from pyspark.sql import functions as F
    from fleetgauge.functions.timing import ntz

    names = ["raw_counters", "raw_ring_buffer", "raw_sessions", "raw_requests", "raw_waits", "raw_file_io", "raw_query_stats",
             "raw_query_text", "raw_backupset", "raw_backupmedia", "raw_jobs", "raw_job_history", "raw_job_activity",
             "raw_agent_sessions", "raw_alerts", "raw_notifications", "raw_operators"]
    landed = {n: getattr(inputs, n) for n in names}
    landed["raw_databases"] = inputs.raw_databases.withColumn("source_database_id", F.lit(None).cast("int"))
    landed = {n: df.withColumn("CaptureTime", ntz(CAPTURED)) if "CaptureTime" in df.columns else df for n, df in landed.items()}
    # One collector cannot run at all, one instance has a bad row.
    landed["raw_operators"] = landed["raw_operators"].drop("name")
    bad = landed["raw_waits"].limit(0).unionByName(landing(spark, "raw_waits", [
        {"InstanceId": 2, "CaptureTime": CAPTURED, "wait_type": "X", "wait_time_ms": 10**18, "signal_wait_time_ms": 2}]))
    landed["raw_waits"] = landed["raw_waits"].unionByName(bad)
    cycle.run_cycle(spark, landed, inputs.monitored_instances, CAPTURED, f"{root}/m", f"{root}/t", f"{root}/r",
                    clock=lambda: CAPTURED + timedelta(seconds=7))
    return {
        "metrics": tables.read_table(spark, f"{root}/m", "MetricSnapshot"),
        "evidence": tables.read_table(spark, f"{root}/t", "MetricTextSnapshot"),
        "runs": runs.stored_runs(spark, f"{root}/r"),
    }


def test_cycle_records_one_run_per_instance_and_collector(finished_cycle, inputs):
    rows = finished_cycle["runs"].collect()
    enabled = inputs.monitored_instances.filter("IsEnabled").count()
    assert len(rows) == len({r.CollectionRunId for r in rows}) == 10 * enabled
    failed = {(r.CollectorName, r.InstanceId) for r in rows if r.Status == "Failed"}
    assert {c for c, _ in failed} == {"Collect-SqlAgentAlerts", "Collect-WaitStats"}
    assert [i for c, i in failed if c == "Collect-WaitStats"] == [2]
    assert {r.DurationMs for r in rows} == {7000}
    written = finished_cycle["metrics"].count() + finished_cycle["evidence"].count()
    assert sum(r.RowsCollected for r in rows) == written


def test_cycle_leaves_out_disabled_instances_and_failed_ones(finished_cycle):
    seen = {(r.SourceCollector, r.InstanceId) for r in finished_cycle["metrics"].select("SourceCollector", "InstanceId").distinct().collect()}
    assert not any(i == 9 for _, i in seen)
    assert ("Collect-WaitStats", 2) not in seen and ("Collect-WaitStats", 1) in seen
    assert not any(c == "Collect-SqlAgentAlerts" for c, _ in seen)


def test_views_read_what_the_cycle_wrote(finished_cycle, inputs):
    m, r, i = finished_cycle["metrics"], finished_cycle["runs"], inputs.monitored_instances
    card = rv.server_health_scorecard(m, r, i, CAPTURED).toPandas()
    assert len(card) == 9 and (card.BlockingHealth != "Unknown").all() and (card.QueryDataHealth == "Available").all()
    assert (card.CollectorCriticalCount >= 1).all()
    summary = by(rv.backup_compliance_current(m, i))
    assert all(row.DatabaseCount is not None for row in summary.values())
    assert pv.backup_compliance(finished_cycle["evidence"], i).count() > 0
    # The wait view reads text rows of a collector that writes only numbers.
    assert pv.wait_stats_summary(finished_cycle["evidence"], i).count() == 0
    assert pv.database_io_summary(m, i).count() == m.filter("MetricCategory = 'DatabaseIO'").count()


LANDED = ["raw_counters", "raw_ring_buffer", "raw_sessions", "raw_requests", "raw_waits", "raw_file_io", "raw_databases",
          "raw_query_stats", "raw_query_text", "raw_backupset", "raw_backupmedia", "raw_jobs", "raw_job_history",
          "raw_job_activity", "raw_agent_sessions", "raw_alerts", "raw_notifications", "raw_operators"]


def small_landing(spark):
    rows = {
        "raw_sessions": [{"session_id": s, "is_user_process": True, "login_name": "me"} for s in (1, 2)],
        "raw_requests": [{"session_id": s, "request_id": r, "cpu_time": 20000, "blocking_session_id": 2, "wait_time": 5,
                          "sql_text": "select 1"} for s, r in ((1, 0), (1, 1), (2, 0))],
        "raw_waits": [{"wait_type": "A", "wait_time_ms": 5, "signal_wait_time_ms": 9, "waiting_tasks_count": 1, "max_wait_time_ms": 1}],
    }
    return {name: landing(spark, name, rows.get(name, [])) for name in LANDED}


def test_a_repeated_cycle_stores_nothing_twice(spark, tmp_path):
    paths, landed = [str(tmp_path / n) for n in "mtr"], small_landing(spark)

    def state():
        history = runs.stored_runs(spark, paths[2])
        return [sorted(df.collect(), key=str) for df in (
            tables.read_table(spark, paths[0], "MetricSnapshot"), tables.read_table(spark, paths[1], "MetricTextSnapshot"),
            history.drop("FinishedAt", "DurationMs"))]

    def run(after):
        cycle.run_cycle(spark, landed, instances(spark, 1), DAY, *paths, clock=lambda: DAY + timedelta(seconds=after))

    run(1)
    once = state()
    # Three requests, two of them of one session, and a wait whose signal part is longer than the wait itself.
    assert len(once[2]) == 10 and {r.Status for r in once[2]} == {"Success"}
    assert len([r for r in once[1] if r.DetailType == "ActiveRequestDetail"]) == 3
    assert len([r for r in once[0] if r.SourceCollector == "Collect-WaitStats"]) == 5
    run(2)
    assert state() == once
    assert {r.DurationMs for r in runs.stored_runs(spark, paths[2]).collect()} == {2000}


def test_a_cycle_that_breaks_off_leaves_a_running_run(spark, tmp_path):
    paths = [str(tmp_path / n) for n in "mtr"]

    def clock():
        raise KeyboardInterrupt

    with pytest.raises(KeyboardInterrupt):
        cycle.run_cycle(spark, small_landing(spark), instances(spark, 1), DAY, *paths, clock=clock)
    [row] = runs.stored_runs(spark, paths[2]).collect()
    assert (row.Status, row.FinishedAt, row.StartedAt) == ("Running", None, DAY)


@pytest.mark.parametrize("table", ["raw_counters", "raw_waits", "raw_file_io", "raw_requests", "raw_sessions", "raw_backupset",
                                   "raw_query_stats", "raw_job_history", "raw_alerts"])
def test_every_collector_leaves_out_an_instance_with_impossible_numbers(spark, table):
    large = [n for n, t in landing(spark, table, []).dtypes if t == "bigint"]
    if not large:  # nothing in it can be out of range
        assert cycle.rules(table) == {}
        return
    good = dict.fromkeys(large, 1)
    raw = landing(spark, table, [{"InstanceId": 1, **good}, {"InstanceId": 2, **good, large[-1]: 10**17}, {"InstanceId": 3, **good}])
    sound, outcomes = runs.isolate_failures(raw, cycle.rules(table))
    assert {r.InstanceId for r in sound.collect()} == {1, 3}
    assert {i: r.ErrorMessage for i, r in by(outcomes).items()} == {1: None, 2: f"{large[-1]} is out of range", 3: None}


CHANGED = {
    "Collect-Connections": ("metrics", {"connections": ConnectionParams(max_breakdown_rows=1)}),
    "Collect-Blocking": ("evidence", {"blocking": BlockingParams(max_rows=1)}),
    "Collect-DatabaseIO": ("evidence", {"file_io": FileIoParams(max_files=1)}),
    "Collect-ActiveRequests": ("evidence", {"requests": RequestParams(max_requests=1)}),
    "Collect-QueryStats": ("evidence", {"query_stats": QueryStatsParams(top_n=1, lookback_minutes=10**7)}),
    "Collect-Backups": ("evidence", {"backups": BackupParams(full_hours=10**6, log_hours=10**6)}),
    "Collect-SqlAgentJobs": ("evidence", {"jobs": JobParams(lookback_hours=10**5, max_rows=1)}),
    "Collect-SqlAgentAlerts": ("evidence", {"alerts": AlertParams(lookback_hours=10**5, max_rows=1)}),
}


@pytest.mark.parametrize("collector", CHANGED)
def test_params_reach_the_collectors(spark, inputs, collector):
    output, changed = CHANGED[collector]
    landed = {n: getattr(inputs, n) for n in LANDED}
    landed["raw_databases"] = landed["raw_databases"].selectExpr("*", "cast(null as int) AS source_database_id")

    def rows(params):
        source, build = cycle.collectors(landed, inputs.monitored_instances, inputs.landing_roster, params)[collector]
        return getattr(build(landed[source]), output).count()

    assert rows(CycleParams(**changed)) != rows(CycleParams())


def test_own_login_is_left_out_by_every_collector_that_sees_it(spark):
    landed, params = small_landing(spark), CycleParams().watched_by(MonitorIdentity(login="me"))
    for collector in ("Collect-ActiveRequests", "Collect-Blocking"):
        source, build = cycle.collectors(landed, instances(spark, 1), roster(spark, 1), params)[collector]
        assert build(landed[source]).evidence.count() == 0
    assert params.query_stats.monitor.login == "me"


def test_repeated_rows_count_once_among_the_problem_queries(spark):
    rows = core(spark, "metric_text_snapshot", [
        {"MetricTextSnapshotId": n % 7, "InstanceId": 1, "CaptureTime": DAY, "capture_date": DAY.date(), "NumericValue1": Decimal(n % 7),
         "MetricCategory": "QueryStats", "DetailType": "QueryStatsDetail", "SourceCollector": "Collect-QueryStats", "Details": "x"}
        for n in range(21)])
    found = pv.top_problem_queries(rows, instances(spark, 1), top=5).collect()
    assert [r.MetricTextSnapshotId for r in found] == [6, 5, 4, 3, 2]


def test_names_are_compared_without_case_and_blanks_and_given_once(spark):
    after = inventory.register(instances(spark, 1), registration(spark, "SRV1 ", "new"), NOW).collect()
    assert sorted((r.InstanceId, r.InstanceName) for r in after) == [(1, "srv1"), (2, "new")]
    off = inventory.set_state(instances(spark, 1), changes(spark, ("Srv1  ", "Disable", "")), NOW).collect()
    assert [(r.InstanceName, r.IsEnabled) for r in off] == [("srv1", False)]
    for wrong in (lambda: inventory.register(instances(spark, 1), registration(spark, "a", "A "), NOW),
                  lambda: inventory.seed(instances(spark, 1), registration(spark, "a", "a"), NOW),
                  lambda: inventory.set_state(instances(spark, 1), changes(spark, ("srv1", "Enable", ""), ("SRV1", "Enable", "")), NOW)):
        # Two stages read the batch; if both fail, Spark reports them together, as another class.
        with pytest.raises((PySparkException, Py4JJavaError), match="more than once"):
            wrong().collect()


def test_a_purge_leaves_no_copies(spark, tmp_path):
    path = str(tmp_path / "metrics")
    tables.append(metrics(spark, [(i, NOW - timedelta(days=8, hours=h), "c", 1) for i in (1, 2) for h in (-1, 1)], SourceCollector="s"), path, "capture_date")
    retention.purge(spark, path, "MetricSnapshot", NOW, RetentionParams(metric_days=8))
    assert tables.read_table(spark, path, "MetricSnapshot").count() == 2
    assert not [p for p in (tmp_path / "metrics").iterdir() if p.name.startswith("_staged")]


def test_scratch_needs_a_shared_folder(spark):
    class Unset:
        class conf:
            get = staticmethod(lambda key, default: default)

    assert tables.scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    with pytest.raises(RuntimeError):
        tables.scratch_path(Unset(), "x")


def test_a_snapshot_that_lands_in_parts_ends_up_whole(spark, tmp_path):
    sessions = landing(spark, "raw_sessions", [{"session_id": n, "is_user_process": True, "login_name": "me"} for n in range(10)])

    def collect(root, parts):
        paths = [str(tmp_path / root / n) for n in ("in", "m", "t", "cp")]
        for part in parts:
            part.write.mode("append").parquet(paths[0])
            stream.collect_landed(spark, "raw_sessions", paths[0], lambda raw: cycle.collect_connections(raw, roster(spark, 1)),
                                  *paths[1:]).awaitTermination()
        return sorted(tables.read_table(spark, paths[1], "MetricSnapshot").drop("CreatedAt").collect(), key=str)

    whole = collect("whole", [sessions])
    assert collect("parts", [sessions.filter("session_id < 3"), sessions.filter("session_id >= 3")]) == whole
    assert {int(r.MetricValue) for r in whole} >= {10}


def test_stream_adds_each_landed_file_once(spark, tmp_path):
    landed, metrics_path, evidence_path, checkpoint = (str(tmp_path / n) for n in ("in", "m", "t", "cp"))

    def wait(day):
        return landing(spark, "raw_waits", [
            {"wait_type": w, "wait_time_ms": 9, "signal_wait_time_ms": 1, "waiting_tasks_count": 1, "max_wait_time_ms": 1} for w in "ABC"
        ], CaptureTime=DAY + timedelta(days=day))

    def collect(checkpoint_path=checkpoint):
        stream.collect_landed(spark, "raw_waits", landed, cycle.collect_waits, metrics_path, evidence_path, checkpoint_path).awaitTermination()
        return tables.read_table(spark, metrics_path, "MetricSnapshot").count()

    wait(0).write.mode("append").parquet(landed)
    assert collect() == 15
    assert collect() == 15
    wait(1).write.mode("append").parquet(landed)
    assert collect() == 30
    # A lost checkpoint replays everything, and nothing is stored twice.
    assert collect(str(tmp_path / "fresh")) == 30
