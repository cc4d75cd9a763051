"""Versioned tables, and what is built on them: a writer that stops anywhere or meets another leaves whole versions."""

import random
from datetime import datetime, timedelta
from decimal import Decimal
from threading import Barrier, Thread
from types import SimpleNamespace

import pytest
from pyspark.errors import PySparkException

from fixtures import registry
from fleetgauge import schemas
from fleetgauge.operators import inventory, retention, runs
from fleetgauge.params import RetentionParams
from fleetgauge.plans import cycle, latest_state
from fleetgauge.plans import reporting_views as rv
from fleetgauge.plans import repository_views as pv
from fleetgauge.sources import tables, versions
from fleetgauge.sources.versions import VersionedTable
from fleetgauge.streaming import landing as stream
from tests.helpers import DAY, core, instances, landing, metrics, roster

PLAIN = "n int, capture_date date"


class Killed(BaseException):
    """Stands for a driver that dies: nothing catches it."""


def plain(spark, *numbers):
    return spark.createDataFrame([(n, (DAY + timedelta(days=n % 3)).date()) for n in numbers], PLAIN)


def held(table):
    return sorted(r.n for r in table.latest().read(PLAIN).collect())


def at_once(*work):
    barrier, errors = Barrier(len(work)), []

    def run(step):
        barrier.wait()
        try:
            step()
        except Exception as error:  # noqa: BLE001
            errors.append(error)

    threads = [Thread(target=run, args=(w,)) for w in work]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    return errors


def test_appends_that_meet_lose_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    assert at_once(*(lambda n=n: VersionedTable(spark, path, "capture_date").append(plain(spark, n)) for n in range(6))) == []
    table = VersionedTable(spark, path, "capture_date")
    assert held(table) == list(range(6)) and table.latest().number == 6
    assert held(table) == sorted(r.n for r in tables.VersionedTable(spark, f"file:{path}", "capture_date").latest().read(PLAIN).collect())


def test_one_number_is_taken_once(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path), None)
    for name in "ab":
        table.files.write(f"_waiting/{name}.json", {"from": name})
    assert table.files.publish("_waiting/a.json", "_waiting/x.json") and not table.files.publish("_waiting/b.json", "_waiting/x.json")
    assert table.files.rename("_waiting/b.json", "_waiting/y.json") and not table.files.rename("_waiting/a.json", "_waiting/y.json")
    assert (table.files.read("_waiting/x.json"), table.files.read("_waiting/y.json")) == ({"from": "a"}, {"from": "b"})


def test_keys_store_once_and_read_only_their_own_batches(spark, tmp_path):
    table, once = VersionedTable(spark, str(tmp_path / "t"), "capture_date"), dict(row_id=["capture_date", "n"], schema=PLAIN)
    table.append_once(plain(spark, 1, 2, 3), "first", **once)
    table.append_once(plain(spark, 2, 3, 4), "first", **once)
    assert held(table) == [1, 2, 3, 4]
    number = table.latest().number
    table.append_once(plain(spark, 1, 4), "first", **once)
    assert table.latest().number == number
    table.append_once(plain(spark, 1), "second", **once)
    assert held(table) == [1, 1, 2, 3, 4]
    # Compacted or not, a key is known.
    table.compact(table.latest().days(), PLAIN)
    assert all(len(table.latest().part(d).batches) == 1 for d in table.latest().days())
    table.append_once(plain(spark, 1, 2, 3, 4), "first", **once)
    assert held(table) == [1, 1, 2, 3, 4]


def test_one_key_from_two_writers_at_once_is_stored_once(spark, tmp_path):
    path, once = str(tmp_path / "t"), dict(key="k", row_id=["capture_date", "n"], schema=PLAIN)
    assert at_once(*(lambda: VersionedTable(spark, path, "capture_date").append_once(plain(spark, 1, 2, 3), **once) for _ in range(4))) == []
    assert held(VersionedTable(spark, path, "capture_date")) == [1, 2, 3]


def test_a_first_append_under_a_key_reads_nothing(spark, tmp_path, monkeypatch):
    table, once = VersionedTable(spark, str(tmp_path / "t"), "capture_date"), dict(row_id=["capture_date", "n"], schema=PLAIN)
    table.append_once(plain(spark, 1, 2, 3), "first", **once)
    monkeypatch.setattr(versions.Snapshot, "read", lambda *a, **b: pytest.fail("the day was read"))
    table.append_once(plain(spark, 1, 2, 3), "second", **once)


def test_old_versions_stay_readable_until_vacuum(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), "capture_date")
    first = table.append(plain(spark, 1, 2))
    table.replace_all(lambda base: base.read(PLAIN).filter("n > 1"))
    assert sorted(r.n for r in first.read(PLAIN).collect()) == [1, 2] and held(table) == [2]
    table.stage(plain(spark, 9))  # a writer that never came to its commit
    table.vacuum(keep=1)
    assert len(table.files.names("data")) == 3  # young files stay
    table.vacuum(keep=1, grace_seconds=-1)
    assert len(table.files.names("data")) == 1 and held(table) == [2] and not table.kept(first.number)


STEPS = ["stage", "write", "publish"]


@pytest.mark.parametrize("step", STEPS)
@pytest.mark.parametrize("after", [False, True])
def test_a_purge_killed_anywhere_leaves_the_old_rows_or_the_new(spark, tmp_path, monkeypatch, step, after):
    path, now = str(tmp_path / "m"), DAY + timedelta(hours=12)
    rows = metrics(spark, [(i, now - timedelta(days=d, hours=h), "c", d) for d in (0, 8, 9) for h in (-1, 1) for i in (1, 2)], SourceCollector="s")
    tables.append(rows, path, "capture_date")

    def state():
        return sorted((r.InstanceId, r.CaptureTime) for r in tables.read_table(spark, path, "MetricSnapshot").collect())

    old = state()
    new = [(i, t) for i, t in old if t >= now - timedelta(days=8)]
    owner = VersionedTable if step == "stage" else versions.Files
    real = getattr(owner, step)

    def killing(self, *args):
        if after:
            real(self, *args)
        raise Killed

    with monkeypatch.context() as patch:
        patch.setattr(owner, step, killing)
        with pytest.raises(Killed):
            retention.purge(spark, path, "MetricSnapshot", now, RetentionParams(metric_days=8))
    assert state() == (new if step == "publish" and after else old)
    # What is left behind stands in nobody's way.
    retention.purge(spark, path, "MetricSnapshot", now, RetentionParams(metric_days=8))
    assert state() == new and len(new) == 6


# --- Inventory -----------------------------------------------------------------------------------


def registration(spark, *names):
    return spark.createDataFrame(
        [(n, "test", "Standard", "V2_FULL", "17", "Dev", f"note {n}") for n in names],
        "InstanceName string, EnvironmentName string, CollectionProfile string, ComplianceProfile string, SqlVersion string, Edition string, Notes string")


def test_two_registrations_at_once_lose_no_name_and_number_none_twice(spark, tmp_path):
    path = str(tmp_path / "i")
    tables.open_table(spark, path, "MonitoredInstances").append(instances(spark, 1))
    names = [[f"w{w}n{n}" for n in range(3)] for w in range(3)]
    assert at_once(*(lambda mine=mine: inventory.store_registration(spark, path, registration(spark, *mine), DAY) for mine in names)) == []
    rows = inventory.stored_instances(spark, path).collect()
    assert sorted(r.InstanceId for r in rows) == list(range(1, 11))
    assert {r.InstanceName for r in rows} == {"srv1", *(n for mine in names for n in mine)}


def test_the_stored_inventory_changes_wholly_or_not_at_all(spark, tmp_path):
    path = str(tmp_path / "i")
    inventory.store_registration(spark, path, registration(spark, "a", "b"), DAY)
    inventory.store_seeds(spark, path, registration(spark, "A ", "c"), DAY)
    change = spark.createDataFrame([("B", "Disable", "moved")], "InstanceName string, State string, Reason string")
    inventory.store_state(spark, path, change, DAY)
    before = sorted(inventory.stored_instances(spark, path).collect())
    assert [(r.InstanceId, r.InstanceName, r.IsEnabled, r.Notes) for r in before] == [
        (1, "a", True, "note a"), (2, "b", False, "note b | moved"), (3, "c", True, "note c")]
    for wrong in (lambda: inventory.store_state(spark, path, change.union(change.selectExpr("'nobody'", "State", "Reason")), DAY),
                  lambda: inventory.store_registration(spark, path, registration(spark, "x", "X"), DAY)):
        with pytest.raises(PySparkException):
            wrong()
    assert sorted(inventory.stored_instances(spark, path).collect()) == before


# --- The maintained state ------------------------------------------------------------------------


def captures(spark, rows):
    """Rows of (instance, hour, wait type or counter, value)."""
    return core(spark, "metric_snapshot", [
        {"MetricSnapshotId": hash((i, h, c)) % 10**9, "InstanceId": i, "CaptureTime": DAY + timedelta(hours=h), "MetricValue": Decimal(v),
         "CounterName": "WaitTimeMs" if c.startswith("W") else c, "InstanceName": c if c.startswith("W") else None,
         "ObjectName": "SQLWaitStats" if c.startswith("W") else "o", "MetricCategory": "x", "MetricType": "Gauge",
         "SourceCollector": "Collect-WaitStats" if c.startswith("W") else "Collect-PerformanceCounters",
         "capture_date": (DAY + timedelta(hours=h)).date()} for i, h, c, v in rows])


def same_views(spark, history, state, known):
    whole, kept = tables.read_table(spark, history, "MetricSnapshot"), latest_state.state_rows(spark, state)
    for view in (lambda m: pv.latest_metrics(m), lambda m: rv.metric_latest(m, known), lambda m: rv.wait_pressure_current(m, known),
                 lambda m: rv.performance_health_current(m, known)):
        assert sorted(view(kept).collect(), key=str) == sorted(view(whole).collect(), key=str)


@pytest.mark.parametrize("seed", range(3))
def test_state_equals_the_history_after_any_order_of_changes(spark, tmp_path, seed):
    rng, history, state, known = random.Random(seed), str(tmp_path / "h"), str(tmp_path / "s"), instances(spark, 1, 2)
    counters = ["WA", "LCK_W", "WB", "Number of Deadlocks/sec", "SystemCpuPercent"]

    def some(hours):
        return [(i, h, c, rng.randrange(100)) for h in hours for i in (1, 2) for c in counters if rng.random() < 0.6]

    tables.append(captures(spark, some(range(0, 96, 8))), history, "capture_date")
    latest_state.refresh(spark, history, state)
    for step in rng.sample(["new", "late", "replace newest", "replace", "purge", "compact", "empty"], 5):
        if step in ("new", "late"):
            tables.append(captures(spark, some([100 + seed] if step == "new" else [5, 13, 50])), history, "capture_date")
        elif step.startswith("replace") or step == "empty":
            # Whole captures are replaced, by other rows or by none.
            hours = [h for h in range(0, 104, 8)][-3:] if step != "replace" else [8, 24, 64]
            rows = captures(spark, some(hours) if step != "empty" else [])
            touched = spark.createDataFrame([(i, DAY + timedelta(hours=h), s) for h in hours for i in (1, 2) for s in (
                "Collect-WaitStats", "Collect-PerformanceCounters")], "InstanceId int, CaptureTime timestamp_ntz, SourceCollector string")
            stream.replace_snapshots(rows, touched, history, "MetricSnapshot", DAY.date(), (DAY + timedelta(days=6)).date())
        elif step == "purge":
            retention.purge(spark, history, "MetricSnapshot", DAY + timedelta(days=9, hours=4), RetentionParams(metric_days=7))
        else:
            table = tables.open_table(spark, history, "MetricSnapshot")
            table.compact(table.latest().days(), schemas.METRIC_SNAPSHOT)
        if rng.random() < 0.7:
            latest_state.refresh(spark, history, state)
    latest_state.refresh(spark, history, state)
    same_views(spark, history, state, known)


def test_a_refresh_reads_only_what_is_new(spark, tmp_path):
    history, state = str(tmp_path / "h"), str(tmp_path / "s")
    table = tables.open_table(spark, history, "MetricSnapshot")
    first = table.append(captures(spark, [(1, h, "c", h) for h in range(0, 72, 12)]))
    latest_state.refresh(spark, history, state)
    want = latest_state.state_rows(spark, state).filter("CaptureTime > '2024-03-12 06:00'").count()
    for day in first.days():  # the old files are gone, and nobody misses them
        for batch in first.part(day).batches:
            table.files.delete(f"data/batch={batch}")
    table.append(captures(spark, [(1, 80, "c", 5), (2, 3, "c", 5)]))
    version = latest_state.refresh(spark, history, state)
    rows = latest_state.state_rows(spark, state).collect()
    assert want == 1 and sorted((r.InstanceId, r.MetricValue) for r in rows) == [(1, 5), (1, 60), (2, 5)]
    assert latest_state.refresh(spark, history, state).number == version.number


def test_rows_are_written_once_and_their_days_appear_in_turn(spark, tmp_path):
    path, rows = str(tmp_path / "t"), plain(spark, 0, 1, 2, 3, 4).union(spark.createDataFrame([(9, None)], PLAIN))
    turns = [lambda d: d.day > 11, lambda d: d.day > 20, lambda d: d.day == 10]
    seen = [held(VersionedTable(spark, path, "capture_date")) for _ in tables.append_in_turn(rows, path, "capture_date", turns)]
    assert seen == [[2], [2], [0, 2, 3]]
    table = VersionedTable(spark, path, "capture_date")
    assert len(table.files.names("data")) == 1
    table.vacuum(grace_seconds=-1)
    assert held(table) == [0, 2, 3]


def test_the_maintained_state_derives_its_captures_once(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(registry, "scratch", lambda i, purpose: str(tmp_path / purpose))
    rows = captures(spark, [(i, 24 * d + 5, "c", 100 * i + d) for i in (1, 2) for d in (-9, -5, 3, 12, 15) if i + d != 17])
    state = registry._state(SimpleNamespace(spark=spark, metric_snapshot=rows))
    history = tables.open_table(spark, str(tmp_path / "history"), "MetricSnapshot")
    assert sorted(r.MetricValue for r in state.collect()) == [112, 115, 203, 212]
    assert history.latest().number == 3 and len(history.files.names("data")) == 1
    assert history.latest().read(schemas.METRIC_SNAPSHOT).count() == 9
    same_views(spark, history.path, str(tmp_path / "state"), instances(spark, 1, 2))


def test_two_refreshes_at_once_leave_the_state_right(spark, tmp_path):
    history, state = str(tmp_path / "h"), str(tmp_path / "s")
    tables.append(captures(spark, [(1, h, "c", h) for h in (1, 2, 3)]), history, "capture_date")
    assert at_once(*(lambda: latest_state.refresh(spark, history, state) for _ in range(3))) == []
    assert sorted(r.MetricValue for r in latest_state.state_rows(spark, state).collect()) == [2, 3]


# --- Runs ----------------------------------------------------------------------------------------


@pytest.mark.parametrize("seed", range(2))
def test_incremental_runs_equal_the_fold_of_all_events(spark, tmp_path, seed):
    rng, events, path = random.Random(seed), str(tmp_path / "e"), str(tmp_path / "r")

    def start(n):
        return (n, "start", DAY + timedelta(hours=5 * n), "c", n % 3, "Running", None, None)

    def finish(n, status="Success", minutes=3):
        return (n, "finish", DAY + timedelta(hours=5 * n, minutes=minutes), None, None, status, n, None if status == "Success" else "boom")

    portions = [
        [start(n) for n in range(8)] + [finish(n) for n in range(4)],
        [finish(4), finish(5, "Failed"), finish(20), start(9)],                 # 20: finished before its start is known
        [start(20), start(2), finish(2, "Failed", 9), finish(1, "Failed", 8)],  # repeated, with and without the start
        [finish(3, "Success", 1), start(3), finish(9), finish(6, "Failed")],    # an older finish changes nothing
    ]
    rng.shuffle(portions)
    for portion in portions:
        tables.write_run_events(spark.createDataFrame(portion, schemas.COLLECTION_RUN_EVENT), events)
        if rng.random() < 0.8:
            runs.refresh_runs(spark, events, path)
    version = runs.refresh_runs(spark, events, path)
    assert sorted(runs.read_runs(spark, path).collect(), key=str) == sorted(runs.stored_runs(spark, events).collect(), key=str)
    assert runs.refresh_runs(spark, events, path).number == version.number
    recent = runs.read_runs(spark, path, (DAY + timedelta(days=1)).date()).collect()
    assert {r.CollectionRunId for r in recent} == {5, 6, 7, 9, 20}


def test_folding_new_events_leaves_finished_dates_alone(spark, tmp_path):
    events, path = str(tmp_path / "e"), str(tmp_path / "r")

    def portion(day):
        who = roster(spark, 1, 2).selectExpr("InstanceId", f"CaptureTime + make_dt_interval({day}) AS CaptureTime")
        done = who.selectExpr("*", "1 AS RowsCollected", "cast(null as string) AS ErrorMessage")
        for e in (runs.start_events(who, "c"), runs.finish_events(done, "c", DAY + timedelta(days=day, seconds=4))):
            tables.write_run_events(e, events)

    portion(0)
    before = runs.refresh_runs(spark, events, path)
    table = tables.open_table(spark, events, "CollectionRunEvent")
    for name in table.files.names("data"):
        table.files.delete(f"data/{name}")
    portion(1)
    after = runs.refresh_runs(spark, events, path)
    assert before.files.items() <= after.files.items() and runs.read_runs(spark, path).count() == 4


# --- Newest first --------------------------------------------------------------------------------


def test_reports_read_no_older_dates_than_they_need(spark, tmp_path):
    path, known = str(tmp_path / "e"), instances(spark, 1)
    rows = core(spark, "metric_text_snapshot", [
        {"MetricTextSnapshotId": 10 * d + n, "InstanceId": 1 if n < 3 else 8, "CaptureTime": DAY - timedelta(days=d), "MetricCategory": "QueryStats",
         "NumericValue1": Decimal(n), "NumericValue2": Decimal(1), "DetailType": "t", "Details": "x", "SourceCollector": "Collect-QueryStats",
         "capture_date": (DAY - timedelta(days=d)).date()} for d in range(30) for n in range(5)])
    tables.append(rows, path, "capture_date")
    for top in (1, 3, 4, 10, 500):
        got = pv.stored_problem_queries(spark, path, known, top)
        assert got.collect() == pv.top_problem_queries(rows, known, top).collect()
    few = pv.stored_problem_queries(spark, path, known, 4)
    assert {f.split("capture_date=")[1][:10] for f in few.inputFiles()} == {"2024-03-10", "2024-03-09"}


def test_run_reports_of_stored_runs_equal_those_of_all_runs(spark, tmp_path):
    rng, path, known = random.Random(4), str(tmp_path / "r"), instances(spark, 1, 2)
    rows = core(spark, "collection_run_history", [
        {"CollectionRunId": n, "InstanceId": rng.randrange(1, 4), "CollectorName": f"c{n % 2}", "StartedAt": DAY - timedelta(hours=n),
         "FinishedAt": None if n % 11 == 0 else DAY, "Status": "Running" if n % 11 == 0 else rng.choice(["Failed", "Success"])} for n in range(200)])
    tables.open_table(spark, path, "CollectionRunHistory").append(rows.selectExpr(
        "*", "case when FinishedAt is not null then cast(StartedAt as date) end AS started_date"))
    for top in (1, 7, 1000):
        assert runs.stored_history(spark, path, known, top).collect() == runs.recent_history(rows, known, top).collect()
        for hours, only in ((24, {}), (100, {"collector": "c1"}), (720, {"stale_only": True, "instance_name": "srv2"})):
            got = runs.stored_failures(spark, path, known, DAY, hours, top, **only)
            assert got.collect() == runs.collection_failures(rows, known, DAY, hours, top, **only).collect()


# --- Landing -------------------------------------------------------------------------------------


def test_rows_that_cannot_be_read_are_set_apart_with_their_reason(spark, tmp_path):
    good = '{"InstanceId":1,"CaptureTime":"2024-03-10T00:00:00","wait_type":"A","wait_time_ms":5}'
    lines = {"json": [good, good.replace(":5", ':"oops"'), "not json", good.replace('"InstanceId":1,', ""), good.replace('":1', '":2'), ""],
             "csv": ["InstanceId,CaptureTime,wait_type,waiting_tasks_count,wait_time_ms,signal_wait_time_ms,max_wait_time_ms",
                     "1,2024-03-10T00:00:00,A,1,5,1,1", "1,2024-03-10T00:00:00,A,1,oops,1,1", "what", ",2024-03-10T00:00:00,A,1,5,1,1",
                     "2,2024-03-10T00:00:00,B,1,5,1,1"]}
    for file_format, text in lines.items():
        path = str(tmp_path / file_format)
        spark.createDataFrame([(line,) for line in text], "value string").coalesce(1).write.text(path)
        sound, bad = tables.read_checked(spark, path, "raw_waits", file_format)
        assert sorted((r.InstanceId, r.wait_time_ms) for r in sound.collect()) == [(1, 5), (2, 5)]
        reasons = sorted((r.Reason, r.InstanceId) for r in bad.filter("InstanceId IS NOT NULL").collect())
        assert reasons == [("row cannot be read", 1)] and bad.count() == 3
        assert {r.Reason for r in bad.collect()} == {"row cannot be read", "instance or capture time is missing"}
        assert any("oops" in r.Row for r in bad.collect())
        # Counting alone finds them too.
        assert (sound.select("InstanceId").count(), sound.count()) == (2, 2)


def test_a_quarantined_row_fails_its_instance_alone(spark, tmp_path):
    from tests.test_jobs import small_landing

    paths, landed = [str(tmp_path / n) for n in "mtr"], small_landing(spark)
    more = landing(spark, "raw_waits", [{"wait_type": "A", "wait_time_ms": 5, "signal_wait_time_ms": 1, "waiting_tasks_count": 1,
                                         "max_wait_time_ms": 1, "InstanceId": 2}])
    landed["raw_waits"] = landed["raw_waits"].unionByName(more)
    bad = spark.createDataFrame([("raw_waits", i, DAY, "row cannot be read", "x") for i in (2, 2, None)],
                                "LandingTable string, InstanceId int, CaptureTime timestamp_ntz, Reason string, Row string")
    cycle.run_cycle(spark, landed, instances(spark, 1, 2), DAY, *paths, clock=lambda: DAY, quarantined={"raw_waits": bad})
    failed = [(r.CollectorName, r.InstanceId, r.ErrorMessage) for r in runs.stored_runs(spark, paths[2]).filter("Status = 'Failed'").collect()]
    assert failed == [("Collect-WaitStats", 2, "2 rows could not be read")]
    waits = tables.read_table(spark, paths[0], "MetricSnapshot").filter("SourceCollector = 'Collect-WaitStats'")
    assert {r.InstanceId for r in waits.collect()} == {1}


def test_a_snapshot_landed_by_date_reads_only_its_dates(spark, tmp_path):
    paths = [str(tmp_path / n) for n in ("in", "m", "t", "cp")]

    def wait(day, *types):
        return landing(spark, "raw_waits", [{"wait_type": w, "wait_time_ms": 9, "signal_wait_time_ms": 1, "waiting_tasks_count": 1,
                                             "max_wait_time_ms": 1} for w in types], CaptureTime=DAY + timedelta(days=day))

    def collect():
        stream.collect_landed(spark, "raw_waits", paths[0], cycle.collect_waits, *paths[1:], by_date=True).awaitTermination()
        return tables.read_table(spark, paths[1], "MetricSnapshot").count()

    tables.land(wait(0, "A", "B"), paths[0])
    assert collect() == 10
    table = tables.open_table(spark, paths[1], "MetricSnapshot")
    before = dict(table.latest().files)
    tables.land(wait(1, "A"), paths[0])
    tables.land(wait(1, "C"), paths[0])
    assert collect() == 20 and before.items() <= table.latest().files.items()


def test_a_snapshot_that_now_has_no_rows_loses_its_old_ones(spark, tmp_path):
    path = str(tmp_path / "m")
    rows = metrics(spark, [(1, DAY, "c", 1), (2, DAY, "c", 1)], SourceCollector="s").unionByName(metrics(spark, [(1, DAY, "c", 1)], SourceCollector="other"))
    tables.append(rows, path, "capture_date")
    touched = spark.createDataFrame([(1, DAY, "s")], "InstanceId int, CaptureTime timestamp_ntz, SourceCollector string")
    for _ in range(2):
        stream.replace_snapshots(rows.limit(0), touched, path, "MetricSnapshot", DAY.date(), DAY.date())
        left = tables.read_table(spark, path, "MetricSnapshot").collect()
        assert sorted((r.InstanceId, r.SourceCollector) for r in left) == [(1, "other"), (2, "s")]


def test_datetimes_are_compared_by_day():
    snapshot = versions.Snapshot(None, 1, {"2024-03-09": "a", "2024-03-10": "b", "__HIVE_DEFAULT_PARTITION__": "c"}, {})
    day = datetime(2024, 3, 10).date()
    assert snapshot.days() == ["2024-03-10", "2024-03-09", "__HIVE_DEFAULT_PARTITION__"]
    assert snapshot.days(first=day) == ["2024-03-10"] and snapshot.days(last=day - timedelta(days=1)) == ["2024-03-09"]
