"""Daily summaries against the facts."""

import random
from collections import Counter
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from mapmeter.plans import summaries
from mapmeter.schemas import ACCESS_LOG_SCHEMA

START = datetime(2024, 1, 1)


def _table(spark, rows):
    """Facts of (day, user, app, workspaces, layers)."""
    raw = spark.createDataFrame(
        [(f"i{n}", START + timedelta(days=d, hours=n % 24), u, a, w, x) for n, (d, u, a, w, x) in enumerate(rows)],
        "id string, ts timestamp, user_name string, app_name string, w string, x string",
    )
    details = ACCESS_LOG_SCHEMA["request_details"].dataType
    made = F.struct(*[(F.col("w") if f.name == "workspaces" else F.col("x") if f.name == "layers" else F.lit(None)).cast(f.dataType).alias(f.name) for f in details])
    df = raw.withColumn("request_details", made).withColumn("ts_date", F.to_date("ts"))
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in ACCESS_LOG_SCHEMA])


def _rows(n, seed=1, layers=60):
    r = random.Random(seed)
    weights = [1 / (i + 1) for i in range(layers)]
    out = []
    for _ in range(n):
        chosen = r.choices(range(layers), weights, k=r.choice([1, 1, 2]))
        out.append((r.randrange(10), r.choice([None, *[f"u{i}" for i in range(40)]]), r.choice(["a", "b"]), r.choice([None, "w"]), ",".join(f"l{(c * 7) % layers}" for c in dict.fromkeys(chosen))))
    return out


def _brute(rows, first, last, n):
    count = Counter((w, x) for d, _, _, w, layers in rows if first <= d < last for x in layers.split(","))
    return sorted(((w, x, c) for (w, x), c in count.items()), key=lambda r: (-r[2], r[0] is None, r[0] or "", r[1]))[:n]


def _day(d):
    return date(2024, 1, 1) + timedelta(days=d)


@pytest.mark.parametrize("keep", [3, 12, 25, 500])
def test_top_layers_whatever_is_kept(spark, keep):
    rows = _rows(4_000)
    facts = _table(spark, rows).cache()
    days = summaries.daily_layers(facts, keep, "UTC").cache()
    assert days.groupBy("day").count().agg(F.max("count")).first()[0] <= keep
    for first, last in ((0, 10), (2, 7), (4, 5), (8, 8), (20, 30)):
        got = summaries.top_layers(spark, days, facts, 8, _day(first), _day(last), "UTC")
        assert [tuple(r) for r in got.collect()] == _brute(rows, first, last, 8)
    few = summaries.top_layers(spark, days, facts, 1_000, _day(0), _day(10), "UTC")
    assert [tuple(r) for r in few.collect()] == _brute(rows, 0, 10, 1_000)


def test_only_candidates_are_counted(spark, tmp_path):
    # a few layers lead every day; the others change from day to day
    rows = [(d, None, "a", "w", f"top{i}") for d in range(6) for i in range(5) for _ in range(60 - i - d % 2)]
    rows += [(d, None, "a", "w", f"low{d}-{i}") for d in range(6) for i in range(40) for _ in range(2)]
    path = str(tmp_path / "facts")
    _table(spark, rows).write.parquet(path)
    facts = spark.read.schema(ACCESS_LOG_SCHEMA).parquet(path)
    summaries.daily_layers(facts, 8, "UTC").write.parquet(str(tmp_path / "days"))
    days = spark.read.parquet(str(tmp_path / "days"))
    got = summaries.top_layers(spark, days, facts, 5, _day(0), _day(6), "UTC")
    assert [tuple(r) for r in got.collect()] == _brute(rows, 0, 6, 5)
    # every day names the leaders, so their counts are whole and the facts are not read at all
    assert path not in got._jdf.queryExecution().executedPlan().toString()


def test_users_of_periods(spark):
    rows = _rows(1_500, seed=4)
    days = summaries.daily_users(_table(spark, rows), tz="UTC").cache()

    def users(app, first, last):
        return {u for d, u, a, _, _ in rows if a == app and first <= d < last and u is not None}

    for before, after in (((0, 1), (1, 2)), ((0, 5), (5, 10)), ((0, 10), (20, 30)), ((20, 22), (3, 4))):
        got = {r.app_name: (r.lapsed, r.retained, r.gained) for r in summaries.compare_users(days, tuple(map(_day, before)), tuple(map(_day, after))).collect()}
        want = {}
        for app in "ab":
            x, y = users(app, *before), users(app, *after)
            want[app] = (len(x - y), len(x & y), len(y - x))
        assert got == want
    got = {r.app_name: r.users for r in summaries.active_users(days, _day(2), _day(6)).collect()}
    assert got == {a: len(users(a, 2, 6)) for a in "ab"}


def test_many_users_are_within_the_bound(spark):
    df = spark.range(60_000).select(F.concat(F.lit("u"), F.col("id") % 30_000).alias("user_name"), F.lit("a").alias("app_name"), (F.lit(START) + F.make_interval(days=(F.col("id") / 30_000).cast("int"))).alias("ts"))
    days = summaries.daily_users(df.where("ts < '2024-01-02' OR substr(user_name, -1) IN ('1', '2', '3')"), tz="UTC")
    (r,) = summaries.compare_users(days, (_day(0), _day(1)), (_day(1), _day(2))).collect()
    assert abs(r.lapsed - 21_000) < 21_000 * 0.06 and abs(r.retained - 9_000) < 9_000 * 0.1 and r.gained < 400


def test_users_of_periods_are_exact_at_any_number(spark):
    ids = spark.range(60_000).select(F.concat(F.lit("u"), F.col("id") % 30_000).alias("user_name"), (F.col("id") >= 30_000).alias("second"))
    df = ids.select("user_name", F.lit("a").alias("app_name"), (F.lit(START) + F.make_interval(days=F.col("second").cast("int"))).alias("ts"))
    nobody = spark.createDataFrame([(None, "a", START), ("u1", "b", START + timedelta(days=1))], "user_name string, app_name string, ts timestamp")
    days = summaries.user_days(df.where("ts < '2024-01-02' OR substr(user_name, -1) IN ('1', '2', '3')").unionByName(nobody), tz="UTC")
    got = {r.app_name: tuple(r)[1:] for r in summaries.changed_users(days, (_day(0), _day(1)), (_day(1), _day(2))).collect()}
    assert got == {"a": (21_000, 9_000, 0, 30_000), "b": (0, 0, 1, 0)}
