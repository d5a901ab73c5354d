"""Ingestion, rollups and streams: idempotence, equality with full recomputes, skew."""

import random
import statistics
from collections import Counter
from contextlib import nullcontext
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from mapmeter.operators import ingest
from mapmeter.operators.ingest import append_if_absent, dedupe_keep_first, find_duplicates
from mapmeter.operators.lookups import app_name, lookup_app
from mapmeter.operators.maintenance import drop_before, expire, purge
from mapmeter.operators.reconcile import reconcile
from mapmeter.operators.telemetry import merge_message, parse_telemetry
from mapmeter.plans import rollups
from mapmeter.plans.ingestion import ingest_text
from mapmeter.schemas import ACCESS_LOG_SCHEMA, OTEL_SCHEMA
from mapmeter.session import fresh_path, shared_dir, spread, state_on_disk
from mapmeter.settings import CLF_PATTERN, NETTY_SCOPE, Settings
from mapmeter.sources.logs import stream_text_logs
from mapmeter.sources.tables import date_folders, read_access_logs, write_access_logs
from mapmeter.streaming import jobs


def _facts(spark, n=2000, hot=0):
    """Facts over 40 days; the first ``hot`` rows share all dimensions and one hour."""
    df = spark.range(n).selectExpr(
        "concat('i', id) AS id",
        f"CASE WHEN id < {hot} THEN timestamp'2024-01-02 10:00:00' + make_interval(0,0,0,0,0,0,id % 3000)"
        " ELSE timestamp'2024-01-01 00:00:00' + make_interval(0,0,0,0,0,id * 29 % 57600,0) END AS ts",
        f"CASE WHEN id < {hot} THEN 'hot' ELSE concat('u', id % 5) END AS user_name",
        "'geoserver' AS app_name",
        f"CASE WHEN id % 7 = 0 AND id >= {hot} THEN NULL ELSE CAST(id * 31 % 997 AS INT) END AS response_time",
        "concat('m', id) AS message",
    )
    details = ACCESS_LOG_SCHEMA["request_details"].dataType
    df = df.withColumns(
        {
            "request_details": F.from_json(F.lit('{"service":"WMS","layers":"a,b","tags":["ogc"]}'), details),
            "ts_date": F.to_date("ts"),
        }
    )
    return df.select(
        *[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in ACCESS_LOG_SCHEMA]
    )


def test_append_twice_changes_nothing(spark):
    path, df = fresh_path(spark, "t"), _facts(spark, 500)
    append_if_absent(spark, df.limit(200), path)
    append_if_absent(spark, df, path)
    append_if_absent(spark, df.unionByName(df), path)
    table = read_access_logs(spark, path)
    assert table.count() == 500
    assert table.select("id").distinct().count() == 500


def test_rows_without_id_are_never_duplicates(spark):
    path = fresh_path(spark, "t")
    df = _facts(spark, 50).withColumn("id", F.lit(None).cast("string")).withColumn("ts", F.lit("2024-01-01").cast("timestamp")).withColumn("ts_date", F.to_date("ts"))
    append_if_absent(spark, df, path)
    append_if_absent(spark, df, path)
    assert read_access_logs(spark, path).count() == 100


def test_dedupe_keeps_the_first_of_a_hot_key(spark):
    df = spark.range(9000).selectExpr(
        "timestamp'2024-01-01 00:00:00' AS ts", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('i', id) END AS id", "id + 5 AS oid"
    )
    out = dedupe_keep_first(df)
    assert out.count() == 6001
    assert out.filter("id = 'hot'").first().oid == 5
    assert [(r.id, r.nb) for r in find_duplicates(df).collect()] == [("hot", 3000)]
    assert "WindowGroupLimit" in out._jdf.queryExecution().executedPlan().toString()


def test_time_bounds_prune_days(spark):
    path = fresh_path(spark, "t")
    append_if_absent(spark, _facts(spark, 500), path)
    df = read_access_logs(spark, path, "2024-01-05 00:00:00", "2024-01-07 00:00:00")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ts_date" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert df.count() == _facts(spark, 500).filter("ts >= '2024-01-05' AND ts < '2024-01-07'").count()


def test_rollup_reads_only_the_fields_it_groups_by(spark):
    path = fresh_path(spark, "t")
    append_if_absent(spark, _facts(spark, 50), path)
    hour = rollups.facts_rollup(read_access_logs(spark, path), rollups.ogc_spec())
    schema = hour._jdf.queryExecution().executedPlan().toString().split("ReadSchema: ")[1]
    for field in ("message", "roles", "params", "bbox", "user_agent_string"):
        assert f"{field}:" not in schema.split("\n")[0]


def test_medians_by_brute_force(spark):
    df = _facts(spark, 4000, hot=1300)
    levels = rollups.all_levels(df, rollups.ogc_spec("UTC"))
    by_hour = {}
    for r in df.select("ts", "user_name", "response_time").collect():
        key = (r.ts.replace(minute=0, second=0, microsecond=0), r.user_name)
        by_hour.setdefault(key, []).append(r.response_time)

    def median(xs):
        xs = [x for x in xs if x is not None]
        return statistics.median(xs) if xs else None

    hours = {k: median(v) for k, v in by_hour.items()}
    got = {(r.bucket, r.user_name): r for r in levels["hour"].collect()}
    assert {k: r.response_time_median for k, r in got.items()} == hours
    assert {k: r.nb_req for k, r in got.items()} == {k: len(v) for k, v in by_hour.items()}

    days = {}
    for (hour, user), m in hours.items():
        days.setdefault((hour.replace(hour=0), user), []).append(m)
    got = {(r.bucket, r.user_name): r.response_time_median for r in levels["day"].collect()}
    assert got == {k: median(v) for k, v in days.items()}


def test_summary_needs_no_distinct(spark):
    out = rollups.summary(*rollups.all_levels(_facts(spark), rollups.ogc_spec()).values())
    assert out.count() == out.distinct().count()


def test_refresh_equals_full_recompute(spark):
    spec, df = rollups.ogc_spec("Europe/Paris"), _facts(spark)
    old = df.filter("id NOT LIKE '%7'")
    incremental, full = fresh_path(spark, "r"), fresh_path(spark, "r")
    rollups.refresh_levels(spark, old, incremental, spec, "2023-12-01", "2024-04-01")
    a = rollups.refresh_levels(spark, df, incremental, spec, "2024-01-01 05:30:00", "2024-02-20 11:00:00")
    b = rollups.refresh_levels(spark, df, full, spec, "2023-12-01", "2024-04-01")
    for grain in rollups.GRAINS:
        assert a[grain].exceptAll(b[grain]).count() == 0
        assert b[grain].exceptAll(a[grain]).count() == 0


def test_medians_of_groups_of_every_kind(spark):
    """Groups without values, of one row, of equal values, of even and odd numbers: one row each, as in the statistics."""
    r, rows = random.Random(11), []
    for g in range(60):
        rows += [(g, r.choice([None, -3, 0, 5, r.randrange(1000)]) if g % 4 else [None, 7][g % 8 // 4]) for _ in range(1 + g % 9)]
    values = {}
    for g, x in [*rows, *[(None, x) for x in (4, None, 9)]]:
        values.setdefault(g, []).append(x)
    df = spark.createDataFrame([(g, x) for g, xs in values.items() for x in xs], "g int, x int").repartition(5)
    want = {g: statistics.median(v) if (v := [x for x in xs if x is not None]) else None for g, xs in values.items()}
    got = rollups.exact_medians(df, ["g"], "x").collect()
    assert len(got) == len(want) and {row.g: row["median"] for row in got} == want


def test_ranked_rows_are_not_aggregated_again(spark):
    """The sorted rows give a group's row; hashing all keys of every row after that took a third of a level's time."""
    spec = rollups.ogc_spec("Europe/Paris")
    path = fresh_path(spark, "hour")
    rollups.facts_rollup(_facts(spark), spec).write.parquet(path)
    plan = rollups.next_rollup(rollups.read_rollup(spark, path), spec, "day")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window [") == 1 and plan.count("Exchange") == 1
    assert "Aggregate" not in plan


def test_a_month_is_written_by_several_tasks(spark):
    spec, folder, name = rollups.ogc_spec("UTC"), fresh_path(spark, "r"), "spark.sql.adaptive.coalescePartitions.enabled"
    df = _facts(spark).withColumn("user_name", F.concat(F.lit("u"), "id"))
    spark.conf.set(name, "false")  # as for months too large to be pooled
    try:
        levels = rollups.refresh_levels(spark, df.filter("ts < '2024-02-01'"), folder, spec, "2024-01-01", "2024-02-01")
    finally:
        spark.conf.unset(name)
    counts = [r[1] for r in levels["month"].groupBy(F.input_file_name()).count().collect()]
    assert len(counts) > 1 and max(counts) < 0.8 * sum(counts)
    assert levels["month"].count() == sum(counts) == df.filter("ts < '2024-02-01'").count()


def test_refresh_leaves_days_older_than_the_source(spark):
    spec, df, path = rollups.ogc_spec("UTC"), _facts(spark), fresh_path(spark, "r") + "/day"
    hour = rollups.facts_rollup(df, spec)
    rollups.refresh_rollup(spark, hour, path, spec, "day", "2024-01-01", "2024-03-01")
    total = rollups.read_rollup(spark, path).agg(F.sum("nb_req")).first()[0]
    kept = hour.filter("bucket >= '2024-01-20 06:00:00'")
    rollups.refresh_rollup(spark, kept, path, spec, "day", "2024-01-01", "2024-03-01", source_since="2024-01-20 06:00:00")
    assert rollups.read_rollup(spark, path).agg(F.sum("nb_req")).first()[0] == total == 2000


def test_state_rollups_keep_the_weighted_mean(spark):
    df = _facts(spark).withColumn("app_name", F.lit("dataapi"))
    month = rollups.all_levels(df, rollups.dataapi_spec("UTC"))["month"]
    want = df.agg(F.sum("response_time"), F.count("response_time"), F.count("id")).first()
    got = month.agg(F.sum("rt_sum"), F.sum("rt_cnt"), F.sum("nb_req")).first()
    assert tuple(got) == (float(want[0]), want[1], want[2])


def test_lookup_by_table_is_lookup_by_option(spark):
    df = spark.createDataFrame([("/a/",), ("/b/",), ("host/x/",), ("c",)], "app_id string").withColumn("app_name", F.lit(""))
    mapping = spark.createDataFrame([("a", "one"), ("/a/", "two"), ("/c", "three")], "app_id string, app_name string")
    rows = lookup_app(df, mapping).collect()
    assert sorted(r.app_name for r in rows) == ["b", "host/x", "one", "three"]
    by_option = df.select(app_name(F.col("app_id"), {"a": "one", "/c": "three"})).collect()
    assert sorted(r[0] for r in by_option) == sorted(r.app_name for r in rows)


def test_purge_and_expire(spark):
    df = spark.sql("SELECT * FROM VALUES (1, true), (2, false), (3, NULL) AS t(i, p)")
    assert sorted(r.i for r in purge(df, F.col("p")).collect()) == [2, 3]
    facts = _facts(spark, 300)
    assert expire(facts, "ts", "10 days", "2024-01-20 00:00:00", "ts_date").count() == facts.filter("ts >= '2024-01-10'").count()


def _otel(spark, rows, scope):
    base = datetime(2024, 1, 1)
    data = [
        (base + timedelta(milliseconds=ms), span, None, msg, {"a": msg or ""}, "{}", (scope,), "otel", "INFO", 9, base, 1, 0)
        for ms, span, msg in rows
    ]
    return spark.createDataFrame(data, OTEL_SCHEMA)


def test_reconcile(spark):
    netty = _otel(spark, [(100, "s1", "n1"), (100, "s2", "n2"), (9000, "s1", "late"), (1, None, "x"), (1, None, "y"), (1, "0000", "z")], NETTY_SCOPE)
    gateway = _otel(spark, [(0, "s1", "g1"), (0, "s3", "g3"), (1, None, "w")], "gw.accesslog")
    out = reconcile(netty, gateway)
    assert out.columns == gateway.columns
    got = sorted((r.span_id or "", r.message or "", r.scope.name, r.timestamp is not None) for r in out.collect())
    assert got == sorted(
        [
            ("s1", "n1", NETTY_SCOPE + "gw.accesslog", True), ("s1", "late", NETTY_SCOPE, True),
            ("s2", "n2", NETTY_SCOPE, True), ("s3", "", "gw.accesslog", True),
            ("", "x", NETTY_SCOPE, True), ("", "y", NETTY_SCOPE, True), ("0000", "z", NETTY_SCOPE, True),
            ("", "", "gw.accesslog", True),
        ]
    )


def _pairs(rows):
    return sorted((r.span_id or "", r.message or "", (r.attributes or {}).get("a", ""), r.scope.name) for r in rows)


def _reconciled_stream(spark, netty, gateway):
    """All records of a stream whose watermark is moved past them by a last, far record of each side."""
    paths = []
    for rows, scope in ((netty, NETTY_SCOPE), (gateway, "gw.accesslog")):
        path = fresh_path(spark, "in")
        rows.unionByName(_otel(spark, [(7_200_000, f"end-{scope}", "end")], scope)).coalesce(1).write.parquet(path)
        paths.append(path)
    streams = [spark.readStream.schema(OTEL_SCHEMA).parquet(p) for p in paths]
    out, merged = fresh_path(spark, "out"), jobs.reconcile_stream(*streams).withColumn("task", F.spark_partition_id())
    merged.writeStream.format("parquet").option("path", out).option("checkpointLocation", fresh_path(spark, "c")).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(merged.schema).parquet(out).filter("span_id IS NULL OR span_id NOT LIKE 'end-%'")


def test_reconcile_loses_nothing_and_streams_alike(spark):
    r = random.Random(5)
    sides = []
    for side in "ng":  # one hot span, some with repeats, some alone; times close to and far from one another
        rows = [(r.randrange(40_000), r.choice(["hot", "hot", f"s{r.randrange(20)}", None, "000"]), f"{side}{i}") for i in range(150)]
        sides.append(rows + [(200 * i, "chain", f"{side}c{i}") for i in range(40)])
    netty = _otel(spark, sides[0], NETTY_SCOPE)
    gateway = _otel(spark, sides[1], "gw.accesslog")
    for name, df in (("n", netty), ("g", gateway)):  # records without time
        timeless = df.limit(3).withColumn("timestamp", F.lit(None).cast("timestamp"))
        netty, gateway = (netty.unionByName(timeless), gateway) if name == "n" else (netty, gateway.unionByName(timeless))
    batch = reconcile(netty, gateway).collect()
    both = sum(x.scope.name == NETTY_SCOPE + "gw.accesslog" for x in batch)
    assert both > 50 and len(batch) + both == netty.count() + gateway.count()
    assert all(max((x.message or "").count("n"), 0) <= 1 for x in batch)
    by_time = {(d, s[2]): s[0] for d, rows in enumerate(sides) for s in rows}
    for x in batch:
        if x.scope.name == NETTY_SCOPE + "gw.accesslog":
            assert abs(by_time[0, x.message] - by_time[1, x.attributes["a"]]) <= 500
    assert _pairs(_reconciled_stream(spark, netty, gateway).collect()) == _pairs(batch)


def test_what_a_side_gives_up_is_neither_read_nor_moved(spark):
    path = fresh_path(spark, "netty")
    _otel(spark, [(0, "s1", "n1"), (9000, "s2", "n2")], NETTY_SCOPE).write.parquet(path)
    plan = reconcile(spark.read.schema(OTEL_SCHEMA).parquet(path), _otel(spark, [(0, "s1", "g1")], "gw.accesslog"))
    scans = [line for line in plan._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan parquet" in line]
    assert scans and all("attributes" not in line and "span_id" in line for line in scans)
    assert sorted((r.message, r.attributes is None, r.timestamp is None) for r in plan.collect()) == [("n1", False, False), ("n2", True, False)]


def test_a_constant_span_spreads_over_all_tasks(spark):
    """An hour of one span, records on the borders of cells among them, and records that differ in their text only."""
    r = random.Random(8)
    netty = [(2_500 * i + 500 * r.randrange(3), "hot", f"n{i}") for i in range(1_440)]
    gateway = [(t + r.choice([0, 200, 500, 501]), "hot", f"g{i}") for i, (t, _, _) in enumerate(netty)]
    sides = [_otel(spark, netty, NETTY_SCOPE), _otel(spark, gateway + gateway[:40] + [(t, s, m + "b") for t, s, m in gateway[:40]], "gw.accesslog")]
    rows = _reconciled_stream(spark, *sides).collect()
    times = lambda found: sorted((x.timestamp, x.message or "") for x in found)
    assert times(rows) == times(reconcile(*sides).collect())
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    share = Counter(x.task for x in rows)
    assert len(share) == tasks and max(share.values()) < 1.5 * len(rows) / tasks


def test_sparse_spans_share_their_state(spark):
    """Two hours of a span every three seconds: far fewer states, and calls of Python, than spans."""
    netty = _otel(spark, [(3_000 * i, f"s{i}", f"n{i}") for i in range(2_400)], NETTY_SCOPE)
    gateway = _otel(spark, [(3_000 * i + 200, f"s{i}", f"g{i}") for i in range(2_400)], "gw.accesslog")
    paths = [fresh_path(spark, "in") for _ in range(2)]
    for df, path in zip((netty, gateway), paths):
        df.write.parquet(path)
    merged = jobs.reconcile_stream(*[spark.readStream.schema(OTEL_SCHEMA).parquet(p) for p in paths])
    query = merged.writeStream.format("noop").option("checkpointLocation", fresh_path(spark, "c")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert 0 < max(s["numRowsTotal"] for p in query.recentProgress for s in p["stateOperators"]) < 300


def test_a_stream_of_many_batches_equals_batch(spark, monkeypatch):
    """Time goes on by a second or two a micro-batch, so cells are settled one by one, and records on their borders wait;
    states are unpacked in several turns."""
    monkeypatch.setattr(jobs, "TURN", 500)
    monkeypatch.setattr(jobs, "ROWS", 5)
    r = random.Random(3)
    paths = [fresh_path(spark, "in") for _ in range(2)]
    whole = [[], []]
    for step in range(24):
        for side, path in enumerate(paths):
            rows = [(1_500 * step + 250 * r.randrange(6), r.choice(["hot", f"s{r.randrange(4)}"]), f"{side}-{step}-{i}") for i in range(12)]
            rows += [(40_000, f"end{side}", "end")] if step == 23 else []
            whole[side] += rows
            _otel(spark, rows, (NETTY_SCOPE, "gw.accesslog")[side]).coalesce(1).write.mode("append").parquet(path)
    streams = [spark.readStream.schema(OTEL_SCHEMA).option("maxFilesPerTrigger", 1).parquet(p) for p in paths]
    out, merged = fresh_path(spark, "out"), jobs.reconcile_stream(*streams, lateness="2 seconds")
    with state_on_disk(spark):
        query = merged.writeStream.format("parquet").option("path", out).option("checkpointLocation", fresh_path(spark, "c")).trigger(availableNow=True).start()
    query.awaitTermination()
    batch = reconcile(*[_otel(spark, rows, scope) for rows, scope in zip(whole, (NETTY_SCOPE, "gw.accesslog"))])
    kept = "span_id NOT LIKE 'end%'"
    key = lambda x: (x.timestamp, x.message or "", (x.attributes or {}).get("a", ""))
    assert sorted(map(key, spark.read.schema(merged.schema).parquet(out).filter(kept).collect())) == sorted(map(key, batch.filter(kept).collect()))
    assert sum(p["numInputRows"] > 0 for p in query.recentProgress) == 24


def test_the_state_of_a_backlog_is_small_and_may_lie_on_disk(spark):
    """4,000 records of a KB: a state holds them compressed and, but for borders, once; in RocksDB if asked to."""
    words = "GET /geoserver/ws/ows?service=WMS&layers=" * 24
    sides = [_otel(spark, [(2_000 * i + ms, f"s{i}", f"{words}{i}") for i in range(2_000)], scope) for ms, scope in ((200, NETTY_SCOPE), (0, "gw.accesslog"))]
    paths = [fresh_path(spark, "in") for _ in sides]
    for df, path in zip(sides, paths):
        df.write.parquet(path)
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    for store in (nullcontext(), state_on_disk(spark)):
        merged = jobs.reconcile_stream(*[spark.readStream.schema(OTEL_SCHEMA).parquet(p) for p in paths])
        with store:
            query = merged.writeStream.format("noop").option("checkpointLocation", fresh_path(spark, "c")).trigger(availableNow=True).start()
        query.awaitTermination()
        assert spark.conf.get(key) == before
        first = query.recentProgress[0]["stateOperators"][0]
        on_disk = any("rocksdb" in k for k in first["customMetrics"])
        assert on_disk == (type(store) is not nullcontext)
        assert on_disk or first["memoryUsedBytes"] < 1_000_000
        assert first["numRowsTotal"] > 0


def test_cells_settled_one_by_one_or_at_once():
    """However records are dealt to calls, what comes out is the same, each record once."""
    r = random.Random(4)
    # block, span, left over, time, side, tie, text; cells of a second, all in block 0
    rows = [(0, r.choice("ab"), False, r.randrange(0, 15_000_000, 250_000), r.randrange(2), i, str(i)) for i in range(120)]
    whole, waits = jobs._settled(rows, 16, 500_000)
    steps, held = [], []
    for passed in range(17):
        held += [x for x in rows if x[3] // 1_000_000 == passed - 1]
        out, later = jobs._settled(held, passed, 500_000)
        steps, held = steps + out, later
    assert sorted(map(str, steps)) == sorted(map(str, whole))
    assert len({x[3] for pair in whole for x in pair if x}) == sum(x is not None for pair in whole for x in pair) == 120 - len(waits)


def test_stream_equals_batch_and_replays_safely(spark):
    line = '10.0.0.{i} - u{i}|o|R [18/Oct/2023:17:{m:02d}:10 +0000] "GET /geoserver/sf/wms?service=WMS&layers=l{i} HTTP/1.1" 200 {i}'
    source = fresh_path(spark, "in")
    spark.createDataFrame([(line.format(i=i, m=i % 60),) for i in range(200)], "value string").write.text(source)
    settings = Settings(text_pattern=CLF_PATTERN, keys_blacklist=())
    batch, stream = fresh_path(spark, "t"), fresh_path(spark, "t")
    ingest_text(spark, source, batch, settings)
    for _ in range(2):  # the second run starts from an empty checkpoint: everything is replayed
        jobs.ingest_stream(stream_text_logs(spark, source), "text", stream, fresh_path(spark, "c"), settings).awaitTermination()
    a = read_access_logs(spark, batch).select("id", "ts", "request_details.layers")
    b = read_access_logs(spark, stream).select("id", "ts", "request_details.layers")
    assert a.count() == b.count() == 200
    assert a.exceptAll(b).count() == 0


def test_reconcile_stream_emits_lone_records(spark):
    netty = [(i * 1000, f"s{i}", f"n{i}") for i in range(0, 60)]
    gateway = [(i * 1000 + 200, f"s{i}", f"g{i}") for i in range(0, 60, 2)]
    paths = []
    for rows, scope in ((netty, NETTY_SCOPE), (gateway, "gw.accesslog")):
        path = fresh_path(spark, "in")
        _otel(spark, rows, scope).write.parquet(path)
        # a last record far ahead moves the watermark past all others
        _otel(spark, [(3_600_000, f"end-{scope}", "end")], scope).write.mode("append").parquet(path)
        paths.append(path)
    streams = [spark.readStream.schema(OTEL_SCHEMA).parquet(p) for p in paths]
    out = fresh_path(spark, "out")
    merged = jobs.reconcile_stream(*streams)
    merged.writeStream.format("parquet").option("path", out).option("checkpointLocation", fresh_path(spark, "c")).trigger(availableNow=True).start().awaitTermination()
    rows = spark.read.schema(merged.schema).parquet(out).filter("span_id LIKE 's%'").collect()
    assert sorted(r.span_id for r in rows) == sorted(f"s{i}" for i in range(60))
    assert sum(r.scope.name == NETTY_SCOPE for r in rows) == 30


def test_shared_dir_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert fresh_path(spark, "x").startswith(shared_dir(spark))


def test_one_row_group_is_spread_though_cut_into_splits(spark):
    path, key = fresh_path(spark, "one"), "spark.sql.files.maxPartitionBytes"
    spark.range(400_000).select(F.sha1(F.col("id").cast("string")).alias("x")).coalesce(1).write.parquet(path)
    old = spark.conf.get(key)
    try:
        spark.conf.set(key, "3m")
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        df = spark.read.parquet(path)
        assert df.rdd.getNumPartitions() >= 4
        shares = [r[1] for r in spread(df).groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set(key, old)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert sum(shares) == 400_000 and max(shares) < 200_000


@pytest.mark.parametrize("few", [0, 100_000])
def test_only_rows_of_repeated_keys_are_sorted(spark, monkeypatch, few):
    monkeypatch.setattr(ingest, "FEW_KEYS", few)
    rows = [(i, f"i{i}", f"m{n}") for i in range(50) for n in range(3 if i % 10 == 0 else 1)]
    df = spark.createDataFrame(rows, "ts int, id string, message string")
    got = ingest.keep_first_of_repeated(df, ("ts", "id"), ("message",)).select("ts", "id", "message")
    assert sorted(map(tuple, got.collect())) == [(i, f"i{i}", "m0") for i in range(50)]
    once = ingest.keep_first_of_repeated(df.where("ts % 10 > 0"), ("ts", "id"), ("message",))
    assert "Window" not in once._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("size", [0, 1])
def test_append_of_nothing(spark, size):
    path = fresh_path(spark, "t")
    append_if_absent(spark, _facts(spark, 10), path)
    append_if_absent(spark, _facts(spark, 10).limit(size), path)
    assert read_access_logs(spark, path).count() == 10


LINE = '10.0.0.1 - u1|o|R [18/Oct/2023:17:36:10 +0000] "GET /geoserver/sf/wms?service=WMS&layers=l HTTP/1.1" 200 5'


def test_equal_lines_stay_apart_and_replays_add_nothing(spark):
    source, more, table, rejects = (fresh_path(spark, n) for n in ("in", "more", "t", "r"))
    lines = [LINE] * 3 + ["no log line", LINE.replace("18/Oct", "99/Xyz"), LINE.replace("u1", "u2")]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(source)
    settings = Settings(text_pattern=CLF_PATTERN, keys_blacklist=())
    for _ in range(2):
        assert ingest_text(spark, source, table, settings, rejects=rejects) == {"lines": 6, "rejected": 2}
        rows = read_access_logs(spark, table).collect()
        assert len(rows) == 4 == len({r.id for r in rows})
    assert spark.read.parquet(rejects).count() == 4
    # another file with one of the same lines: the same access, told again
    spark.createDataFrame([(LINE,)], "value string").write.text(more)
    ingest_text(spark, [source, more], table, settings)
    assert read_access_logs(spark, table).count() == 4


def test_append_keeps_rows_without_time_or_id_whatever_their_neighbours(spark):
    df = _facts(spark, 40)
    timeless = df.limit(5).withColumns({"ts": F.lit(None).cast("timestamp"), "ts_date": F.lit(None).cast("date")})
    for batches in ([df, timeless], [timeless, df], [df.unionByName(timeless)]):
        path = fresh_path(spark, "t")
        for batch in batches:
            append_if_absent(spark, batch, path)
        assert read_access_logs(spark, path).count() == 45


def test_stray_date_opens_one_more_partition(spark):
    path = fresh_path(spark, "t")
    append_if_absent(spark, _facts(spark, 400), path)
    days = sorted(r[0] for r in read_access_logs(spark, path).select("ts_date").distinct().collect())
    assert len(days) > 4
    batch = read_access_logs(spark, path).filter(F.col("ts_date").isin([days[0], days[-1]]))
    dates = [r[0] for r in batch.select("ts_date").distinct().collect()]
    files = read_access_logs(spark, path).filter(F.col("ts_date").isin(dates)).inputFiles()
    assert {f.split("ts_date=")[1][:10] for f in files} >= {str(days[0]), str(days[-1])} and len(dates) == 2
    append_if_absent(spark, batch, path)
    assert read_access_logs(spark, path).count() == 400


def test_telemetry_messages_fill_what_attributes_leave_blank(spark):
    row = _otel(spark, [(0, None, "10.1.1.1 GET /geoserver/ows?service=WFS&request=GetFeature&typeName=a:b 200 u1|o1|R1,R2")], "x")
    pattern = r"^(?P<client_ip>\S+) (?P<method>[A-Z]+) (?P<path>\S+) (?P<status_code>\d+) (?P<user>\S+)$"
    settings = Settings(text_pattern=CLF_PATTERN, message_pattern=pattern, parse_message=True, keys_blacklist=())
    blank = row.withColumn("attributes", F.create_map(F.lit("http.status_code"), F.lit("404"), F.lit("enduser.id"), F.lit("")))
    (r,) = parse_telemetry(blank, settings).collect()
    assert (r.request_path, r.app_name, r.request_method, r.status_code, r.user_name, r.org_name, r.roles, r.client_ip) == (
        "/geoserver/ows", "geoserver", "GET", 404, "u1", "o1", ["R1", "R2"], "10.1.1.1",
    )
    assert (r.request_details.service, r.request_details.layers) == ("WFS", "b") or r.request_details.layers == "a:b"
    assert r.id and r.id == parse_telemetry(blank, settings).first().id  # without span: a digest of the content


def test_fills_from_a_message_are_made_once(spark):
    """Not again for each attribute of the record, which would run the pattern's groups through as often."""
    df = _otel(spark, [(0, None, "GET /geoserver/ows")], "x")
    filled = merge_message(df, Settings(message_pattern=r"^(?P<method>[A-Z]+) (?P<path>\S+)$", parse_message=True))
    assert filled._jdf.queryExecution().optimizedPlan().toString().count("key, http.request.url") == 1
    assert filled.first().attributes == {"a": "GET /geoserver/ows", "http.request.method": "GET", "http.request.url": "/geoserver/ows"}


def test_drop_before_leaves_other_days_unread(spark):
    path = fresh_path(spark, "t")
    write_access_logs(_facts(spark, 400), path)
    folders = date_folders(spark, path, "ts_date")
    border = list(folders)[2]
    drop_before(spark, path, "ts", f"{border} 12:00:00", "ts_date")
    left = date_folders(spark, path, "ts_date")
    assert set(left) <= set(list(folders)[2:]) and len(left) >= len(folders) - 3
    want = _facts(spark, 400).filter(F.col("ts") >= F.lit(f"{border} 12:00:00").cast("timestamp"))
    assert sorted(r.id for r in read_access_logs(spark, path).collect()) == sorted(r.id for r in want.collect())
