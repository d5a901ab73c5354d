"""Changes that are there as a whole or not at all: killed anywhere, by two writers, and what rollups hear of them."""

import json
import os
import threading
import time

import pytest
from pyspark.sql import functions as F

from mapmeter.operators.ingest import append_if_absent
from mapmeter.operators.maintenance import compact, drop_before
from mapmeter.plans import rollups
from mapmeter.plans.ingestion import drain_telemetry
from mapmeter.schemas import OTEL_SCHEMA
from mapmeter.session import fresh_path
from mapmeter.settings import CLF_PATTERN, Settings
from mapmeter.sources import changes, logs
from mapmeter.sources.tables import read_access_logs, write_access_logs
from tests.test_jobs import _facts, _otel


class Killed(BaseException):
    """Stands for a process that ends: no handler of errors sees it."""


@pytest.fixture
def killer(monkeypatch):
    """Ends the process at its n-th step; tells how many steps there were."""

    def at(n):
        seen = []

        def step(name):
            seen.append(name)
            if len(seen) == n:
                raise Killed(name)

        monkeypatch.setattr(changes, "_step", step)
        return seen

    return at


def every_kill(killer, setup, work, look):
    """Killed at each step and called again, ``work`` gives what it gives unkilled; seen in between is old or new."""
    path = setup()
    old = look(path)
    steps = len(killed_never(killer, work, path))
    new = look(path)
    assert steps > 5 and old != new
    for n in range(1, steps + 1):
        path = setup()
        seen = killer(n)
        with pytest.raises(Killed):
            work(path)
        killer(0)
        changes.recover(work.spark, path)
        between = look(path)
        assert between == (new if decided(seen) else old), seen
        work(path)
        assert look(path) == new, seen
        assert not [f for f in os.listdir(path) if f in ("_lock", "_journal", "_staged", "_replaced")]


def decided(steps):
    """Whether the last step came after the journal was put in place."""
    return "put the journal in place" in steps[:-1]


def killed_never(killer, work, path):
    seen = killer(0)
    work(path)
    return seen


class Work:
    def __init__(self, spark, call):
        self.spark, self.call = spark, call

    def __call__(self, path):
        self.call(path)


def ids(spark, path):
    return sorted((r.id or "", str(r.ts_date)) for r in read_access_logs(spark, path).select("id", "ts_date").collect())


def small(spark, n=120):
    """Facts of two days, in one file a day."""
    return _facts(spark, 2000).where("ts < '2024-01-03'").limit(n).coalesce(1)


def test_append_killed_anywhere(spark, killer, tmp_path):
    base, n = fresh_path(spark, "base"), iter(range(1000))
    small(spark).write.parquet(base)
    df = spark.read.schema(small(spark).schema).parquet(base)

    def setup():
        path = str(tmp_path / f"t{next(n)}")
        append_if_absent(spark, df.where("id LIKE '%1'"), path)
        return path

    every_kill(killer, setup, Work(spark, lambda p: append_if_absent(spark, df, p)), lambda p: (ids(spark, p), changes.notes_since(spark, p, 1)[0]))


def test_retention_killed_anywhere(spark, killer, tmp_path):
    n = iter(range(1000))
    source = str(tmp_path / "source")
    append_if_absent(spark, small(spark), source)
    import shutil

    def setup():
        path = str(tmp_path / f"t{next(n)}")
        shutil.copytree(source, path)
        return path

    every_kill(killer, setup, Work(spark, lambda p: drop_before(spark, p, "ts", "2024-01-02 12:00:00", "ts_date")), lambda p: ids(spark, p))


def test_two_writers(spark, tmp_path):
    path, df = str(tmp_path / "t"), small(spark)
    with changes.change(spark, path):
        with pytest.raises(changes.TableBusy):
            append_if_absent(spark, df, path)
    failed = []

    def work(part):
        try:
            append_if_absent(spark, part, path, wait=120)
        except Exception as e:  # noqa: BLE001
            failed.append(e)

    threads = [threading.Thread(target=work, args=(df.where(f"id NOT LIKE '%{d}'"),)) for d in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not failed
    assert [i for i, _ in ids(spark, path)] == sorted(r.id for r in df.collect())
    assert changes.last_note(spark, path) <= 4


def test_a_lock_that_was_lost_decides_nothing(spark, tmp_path):
    path, df = str(tmp_path / "t"), small(spark)
    append_if_absent(spark, df.limit(5), path)
    before = ids(spark, path)
    with pytest.raises(changes.TableBusy):
        with changes.change(spark, path, lease=-1) as slow:  # its lease is over at once
            slow.add(df, "ts_date")
            with changes.change(spark, path) as quick:
                quick.note(["x"])
    assert ids(spark, path) == before and not os.path.exists(f"{path}/_journal")


def test_a_living_writer_is_left_alone_and_a_dead_one_is_not(spark, tmp_path):
    path = str(tmp_path / "t")
    os.makedirs(path)
    import socket
    import subprocess
    import sys

    gone = subprocess.Popen([sys.executable, "-c", "pass"])
    gone.wait()
    for pid, dead in ((os.getppid(), False), (gone.pid, True)):
        with open(f"{path}/_lock", "w") as f:
            json.dump({"token": "other", "host": socket.gethostname(), "pid": pid, "until": time.time() + 3600}, f)
        if dead:
            changes.recover(spark, path)
        else:
            with pytest.raises(changes.TableBusy):
                changes.recover(spark, path)
    with open(f"{path}/_lock", "w") as f:  # of another host: only the lease tells
        json.dump({"token": "other", "host": "elsewhere", "pid": 1, "until": time.time() + 3600}, f)
    with pytest.raises(changes.TableBusy):
        changes.recover(spark, path)
    assert os.path.exists(f"{path}/_lock")


def test_an_error_leaves_the_table_and_no_lock(spark, tmp_path):
    path, df = str(tmp_path / "t"), small(spark)
    append_if_absent(spark, df.limit(9), path)
    before = ids(spark, path)
    with pytest.raises(Exception, match="no such thing"):
        append_if_absent(spark, df.withColumn("message", F.raise_error(F.lit("no such thing")).cast("string")), path)
    with pytest.raises(ZeroDivisionError):
        with changes.change(spark, path) as asked:
            asked.add(df, "ts_date")
            1 / 0  # noqa: B018
    assert ids(spark, path) == before and set(os.listdir(path)) >= {"_changes"} and "_lock" not in os.listdir(path) and "_staged" not in os.listdir(path)


def _files(path):
    return {f"{d}/{f}": os.stat(f"{path}/{d}/{f}").st_mtime_ns for d in os.listdir(path) if d[0] != "_" for f in os.listdir(f"{path}/{d}") if f[0] != "."}


def _levels(spark, folder, spec):
    return {g: sorted(map(repr, (r.asDict() for r in df.collect()))) for g, df in rollups.stored_levels(spark, folder, spec).items()}


@pytest.mark.parametrize("zone", ["Europe/Paris", "Asia/Kolkata"])
def test_a_late_record_rewrites_one_partition_of_each_level(spark, tmp_path, zone):
    spec, facts = rollups.ogc_spec(zone), _facts(spark, 600)
    path, folder, full = (str(tmp_path / n) for n in ("facts", "rollups", "full"))
    late = facts.where("id = 'i100'")  # 2024-01-03
    append_if_absent(spark, facts.where("id <> 'i100'"), path)
    first = rollups.refresh_changed_levels(spark, path, folder, spec)
    assert len(first["hour"]) == len(first["day"]) > 10 and len(first["month"]) <= 2
    assert rollups.refresh_changed_levels(spark, path, folder, spec) == {"hour": [], "day": [], "month": []}
    before = {g: _files(f"{folder}/ogc_{g}") for g in rollups.GRAINS}
    append_if_absent(spark, late, path)
    touched = rollups.refresh_changed_levels(spark, path, folder, spec)
    # an hour of UTC may lie in two local days only where the offset is no whole hour
    assert all(len(v) == 1 for v in touched.values())
    for g in rollups.GRAINS:
        after = _files(f"{folder}/ogc_{g}")
        assert {f.split("/")[0] for f in before[g].items() ^ after.items() for f in [f[0]]} == set(touched[g])
    rollups.refresh_levels(spark, facts, full, spec, "2023-12-01", "2024-04-01")
    assert _levels(spark, folder, spec) == _levels(spark, full, spec)
    # appending the same again changes no rollup
    append_if_absent(spark, late, path)
    assert rollups.refresh_changed_levels(spark, path, folder, spec)["hour"] == []


def test_refresh_killed_anywhere(spark, killer, tmp_path):
    spec, facts = rollups.ogc_spec("UTC"), small(spark, 60)
    path, folder, full = (str(tmp_path / n) for n in ("facts", "rollups", "full"))
    append_if_absent(spark, facts.where("id NOT LIKE '%3'"), path)
    rollups.refresh_changed_levels(spark, path, folder, spec)
    append_if_absent(spark, facts, path)
    n = 0
    while True:  # each kill one step further than the last, on the same tables
        n += 1
        seen = killer(n)
        try:
            rollups.refresh_changed_levels(spark, path, folder, spec)
            break
        except Killed:
            killer(0)
    assert n > 3 and seen
    killer(0)
    rollups.refresh_levels(spark, facts, full, spec, "2023-12-01", "2024-04-01")
    assert _levels(spark, folder, spec) == _levels(spark, full, spec)


def test_changed_days_older_than_the_source_stay(spark, tmp_path):
    spec, facts = rollups.ogc_spec("UTC"), _facts(spark, 600)
    path, folder = str(tmp_path / "facts"), str(tmp_path / "rollups")
    append_if_absent(spark, facts, path)
    rollups.refresh_changed_levels(spark, path, folder, spec)
    total = rollups.read_rollup(spark, f"{folder}/ogc_hour").agg(F.sum("nb_req")).first()[0]
    drop_before(spark, path, "ts", "2024-01-05 06:00:00", "ts_date")
    assert rollups.refresh_changed(spark, path, f"{folder}/ogc_hour", spec, "hour") == []
    append_if_absent(spark, facts.where("ts < '2024-01-03'"), path)  # old records come once more, after retention
    assert rollups.refresh_changed(spark, path, f"{folder}/ogc_hour", spec, "hour", source_since="2024-01-05 06:00:00") == []
    assert rollups.read_rollup(spark, f"{folder}/ogc_hour").agg(F.sum("nb_req")).first()[0] == total


def test_notes_that_all_have_read_can_go(spark, tmp_path):
    path, df = str(tmp_path / "t"), small(spark)
    for d in "123":
        append_if_absent(spark, df.where(f"id LIKE '%{d}'"), path)
    last = changes.last_note(spark, path)
    changes.forget_notes(spark, path, last)
    assert changes.last_note(spark, path) == last == 3 and changes.notes_since(spark, path, last) == (set(), last)
    append_if_absent(spark, df, path)
    assert changes.last_note(spark, path) == 4


def test_compaction_keeps_rows_and_tells_nobody(spark, tmp_path):
    path, df = str(tmp_path / "t"), _facts(spark, 900)
    for d in range(4):
        append_if_absent(spark, df.where(f"id LIKE '%{d}'").repartition(3), path)
    rows, notes, files = ids(spark, path), changes.last_note(spark, path), changes.data_files(spark, path)
    done = compact(spark, path, "ts_date", "2024-01-10")
    assert done == [f"ts_date=2024-01-0{d}" for d in range(1, 10)]
    left = changes.data_files(spark, path)
    assert len(left) < len(files) and all(sum(f.startswith(name) for f in left) == 1 for name in done)
    assert ids(spark, path) == rows and changes.last_note(spark, path) == notes
    assert compact(spark, path, "ts_date", "2024-01-10") == []


def _records(spark, r, n=40):
    return _otel(spark, [(r(i), f"s{i}", "") for i in range(n)], "org.gw.accesslog").withColumn(
        "attributes", F.create_map(F.lit("http.request.path"), F.lit("/geoserver/ows"), F.lit("http.request.query-string"), F.concat(F.lit("service=WMS&request=GetMap&layers="), "span_id"))
    )


def test_drain_takes_what_was_read_and_nothing_else(spark, tmp_path):
    buffer, table, rejects = (str(tmp_path / n) for n in ("buffer", "table", "rejects"))
    hour = 3_600_000
    here = _records(spark, lambda i: i * hour)  # 1 and 2 January
    timeless = here.limit(4).withColumns({"timestamp": F.lit(None).cast("timestamp"), "span_id": F.concat(F.lit("x"), "span_id")})
    logs.write_otel_buffer(here.unionByName(timeless), buffer)
    settings, cutoff = Settings(text_pattern=CLF_PATTERN, keys_blacklist=()), "2024-01-02 06:00:00"
    files = logs.pending_files(spark, buffer, cutoff)
    # while the run reads, old and timeless records land
    landed = timeless.unionByName(here).withColumn("span_id", F.concat(F.lit("late"), "span_id"))
    logs.write_otel_buffer(landed, buffer)
    assert logs.read_pending(spark, buffer, files, cutoff).count() == 30 + 4
    logs.drain_stored(spark, buffer, cutoff, files)
    left = sorted(r.span_id for r in spark.read.schema(OTEL_SCHEMA).parquet(buffer).collect())
    assert left == sorted([f"s{i}" for i in range(30, 40)] + [r.span_id for r in landed.collect()])
    logs.drain_stored(spark, buffer, cutoff, files)  # called again, it takes nothing more
    assert sorted(r.span_id for r in spark.read.schema(OTEL_SCHEMA).parquet(buffer).collect()) == left
    # the next run takes the rest; records without time are counted, and written before anything is removed
    counts = drain_telemetry(spark, buffer, table, settings, "2024-02-01", rejects)
    assert counts["rejected"] == 4 and spark.read.parquet(rejects).count() == 4
    assert read_access_logs(spark, table).count() == 10 + 40 == counts["records"] - 4
    assert spark.read.schema(OTEL_SCHEMA).parquet(buffer).count() == 0
    assert drain_telemetry(spark, buffer, table, settings, "2024-02-01", rejects) == {"records": 0, "rejected": 0}


def test_drain_killed_anywhere(spark, killer, tmp_path):
    import shutil

    source, n = str(tmp_path / "source"), iter(range(1000))
    logs.write_otel_buffer(_records(spark, lambda i: i * 3_600_000).coalesce(1), source)
    cutoff = "2024-01-02 06:00:00"

    def setup():
        path = str(tmp_path / f"b{next(n)}")
        shutil.copytree(source, path)
        return path

    def work(path):
        logs.drain_stored(spark, path, cutoff, logs.pending_files(spark, path, cutoff) or ["none"])

    def look(path):
        return sorted(r.span_id for r in spark.read.schema(OTEL_SCHEMA).parquet(path).collect())

    every_kill(killer, setup, Work(spark, work), look)


def test_plain_writes_still_read(spark, tmp_path):
    path = str(tmp_path / "t")
    write_access_logs(_facts(spark, 50), path)
    append_if_absent(spark, _facts(spark, 80), path)
    assert read_access_logs(spark, path).count() == 80
