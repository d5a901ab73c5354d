"""Rollup states that merge exactly: quantiles bounded in value, and counts of distinct times."""

import math
import random
import statistics
from collections import Counter

import pytest
from pyspark.sql import functions as F

from mapmeter.functions import relative
from mapmeter.plans import rollups
from tests.test_jobs import _facts


def _plain(df, keys):
    return {tuple(r[k] for k in keys): (r.quantiles.level, r.quantiles.zeros, r.quantiles.buckets) for r in df.collect()}


def _built(spark, rows, keys=("g",)):
    df = spark.createDataFrame(rows, "g int, part int, x double").repartition(3)
    return df, relative.close_states(relative.count_buckets(df, list(keys), F.col("x")), list(keys))


def _rows():
    r = random.Random(1)
    out = [(0, i % 4, float(r.randrange(1, 5000))) for i in range(800)]
    out += [(1, i % 4, r.choice([0.0, -3.0, None, 7.0])) for i in range(60)]
    out += [(2, i % 3, 10 ** r.uniform(-9, 12)) for i in range(900)]  # a span that needs merging
    out += [(3, 0, None), (3, 1, None), (4, 0, 0.0), (5, 2, 12.5)]
    return out


def test_values_are_near_whatever_their_rank(spark):
    rows = _rows()
    _, states = _built(spark, rows)
    fractions = (0.0, 0.01, 0.5, 0.95, 0.99, 1.0)
    got = {r.g: r for r in states.select("g", F.col("quantiles.level").alias("level"), *[relative.quantile(f).alias(f"q{i}") for i, f in enumerate(fractions)]).collect()}
    for g in range(6):
        values = sorted(max(x, 0.0) for k, _, x in rows if k == g and x is not None)
        error = relative.ERROR * 2 ** got[g].level * 1.01
        for i, f in enumerate(fractions):
            if not values:
                assert got[g][f"q{i}"] is None
                continue
            place = f * (len(values) - 1)
            low, high = values[math.floor(place)], values[math.ceil(place)]
            want = low + (high - low) * (place - math.floor(place))
            assert abs(got[g][f"q{i}"] - want) <= error * max(high, want) + 1e-9, (g, f)
    assert got[0].level == 0 and got[2].level >= 1


@pytest.mark.parametrize("most", [2_048, 40, 5])
def test_a_rollup_of_rollups_is_a_rollup(spark, monkeypatch, most):
    monkeypatch.setattr(relative, "MOST", most)
    rows = _rows()
    _, direct = _built(spark, rows)
    _, finer = _built(spark, rows, ("g", "part"))
    merged = relative.close_states(relative.open_states(finer.drop("part")), ["g"])
    assert _plain(merged, ["g"]) == _plain(direct, ["g"])
    assert all(len(b) <= most for _, _, b in _plain(direct, ["g"]).values())
    # in two steps, through halves of the parts
    halves = relative.close_states(relative.open_states(finer.withColumn("half", F.col("part") % 2).drop("part")), ["g", "half"])
    assert _plain(relative.close_states(relative.open_states(halves.drop("half")), ["g"]), ["g"]) == _plain(direct, ["g"])


def test_buckets_bound_the_error():
    for x in (1e-9, 0.3, 1, 2, 7, 99.5, 12_345, 1e12):
        gamma = (1 + relative.ERROR) / (1 - relative.ERROR)
        b = math.ceil(math.log(x) / math.log(gamma))
        assert abs(2 * gamma**b / (gamma + 1) - x) <= relative.ERROR * x * (1 + 1e-9)


def test_levels_of_quantiles_equal_those_of_the_facts(spark):
    df = _facts(spark, 3000, hot=1500).withColumn("app_name", F.lit("dataapi"))
    spec = rollups.dataapi_quantiles_spec("UTC")
    levels = rollups.all_levels(df, spec)
    for grain in rollups.GRAINS:
        direct = rollups.facts_rollup(df, spec, grain)
        as_row = lambda d: sorted(repr(r.asDict(recursive=True)) for r in d.collect())
        assert as_row(levels[grain]) == as_row(direct)
    total = levels["month"].agg(F.sum("nb_req"), F.sum("rt_cnt"), F.sum("rt_sum")).first()
    want = df.agg(F.count("id"), F.count("response_time"), F.sum("response_time")).first()
    assert tuple(total) == (want[0], want[1], float(want[2]))


def test_hot_groups_send_a_row_per_bucket(spark):
    df = spark.range(60_000).select(F.lit(1).alias("g"), (F.col("id") % 900 + 1).cast("double").alias("x")).repartition(4)
    counted = relative.count_buckets(df, ["g"], F.col("x"))
    assert counted.count() < 750
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") >= 2


def test_true_medians_at_every_level(spark):
    df = _facts(spark, 4000, hot=1300)
    spec = rollups.ogc_spec("UTC")
    level = rollups.distinct_times(df, spec)
    groups = {"hour": {}, "day": {}, "month": {}}
    for r in df.select("ts", "user_name", "response_time").collect():
        hour = r.ts.replace(minute=0, second=0, microsecond=0)
        for grain, bucket in (("hour", hour), ("day", hour.replace(hour=0)), ("month", hour.replace(day=1, hour=0))):
            groups[grain].setdefault((bucket, r.user_name), []).append(r.response_time)
    for grain in rollups.GRAINS:
        if grain != "hour":
            level = rollups.merge_times(level, spec, grain)
        got = {(r.bucket, r.user_name): (r.nb_req, r.response_time_median, r.response_time_min, r.response_time_max) for r in rollups.true_medians(level, spec).collect()}
        assert set(got) == set(groups[grain])
        for key, values in groups[grain].items():
            known = [v for v in values if v is not None]
            want = (statistics.median(known), min(known), max(known)) if known else (None, None, None)
            assert got[key] == (len(values), *want)
    counts = Counter(groups["month"][next(iter(groups["month"]))])
    assert max(counts.values()) > 1
