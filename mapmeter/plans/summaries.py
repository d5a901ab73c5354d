"""Daily summaries that answer questions over any period without the facts: distinct users, and the most used layers."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mapmeter.functions import times
from mapmeter.operators.layers import unnest_layers

LG_ENTRIES = 12  # a sketch is exact up to some 4,000 users; beyond, off by 3 % at two standard deviations


def _period(day: Column, start: date | str, end: date | str) -> Column:
    return (day >= F.lit(start).cast("date")) & (day < F.lit(end).cast("date"))


# --- users ------------------------------------------------------------------------------------


def daily_users(facts: DataFrame, by: Sequence[str] = ("app_name",), tz: str = "Europe/Paris", lg_entries: int = LG_ENTRIES) -> DataFrame:
    """``day, by, users``: a Theta sketch of the users of each local day and key. Accesses without user count for none.

    Unlike counts of users, sketches can be joined, and subtracted from one another.
    """
    rows = facts.where(F.col("user_name").isNotNull()).select(times.local_date(F.col("ts"), tz).alias("day"), *by, "user_name")
    return rows.groupBy("day", *by).agg(F.theta_sketch_agg("user_name", lg_entries).alias("users"))


def _users_of(days: DataFrame, by: Sequence[str], start: date | str, end: date | str, name: str, lg_entries: int) -> DataFrame:
    return days.where(_period(F.col("day"), start, end)).groupBy(*by).agg(F.theta_union_agg("users", lg_entries).alias(name))


def active_users(days: DataFrame, start: date | str, end: date | str, by: Sequence[str] = ("app_name",), lg_entries: int = LG_ENTRIES) -> DataFrame:
    """``by, users``: distinct users of the days ``[start, end)``."""
    return _users_of(days, by, start, end, "_users", lg_entries).select(*by, F.theta_sketch_estimate("_users").alias("users"))


def compare_users(
    days: DataFrame, before: tuple[date | str, date | str], after: tuple[date | str, date | str], by: Sequence[str] = ("app_name",), lg_entries: int = LG_ENTRIES
) -> DataFrame:
    """``by, lapsed, retained, gained``: users of the first period only, of both, and of the second only.

    Keys seen in one period only have nulls in neither: the other period's users are none.
    """
    a, b = (_users_of(days, by, *p, n, lg_entries) for p, n in ((before, "_a"), (after, "_b")))
    both = a.unionByName(b, allowMissingColumns=True).groupBy(*by).agg(F.first("_a", ignorenulls=True).alias("_a"), F.first("_b", ignorenulls=True).alias("_b"))
    size, zero = F.theta_sketch_estimate, F.lit(0).cast("long")

    def only(x: str, y: str) -> Column:
        return F.when(F.col(x).isNull(), zero).when(F.col(y).isNull(), size(x)).otherwise(size(F.theta_difference(x, y)))

    kept = F.when(F.col("_a").isNull() | F.col("_b").isNull(), zero).otherwise(size(F.theta_intersection("_a", "_b")))
    return both.select(*by, only("_a", "_b").alias("lapsed"), kept.alias("retained"), only("_b", "_a").alias("gained"))


def user_days(facts: DataFrame, by: Sequence[str] = ("app_name",), tz: str = "Europe/Paris") -> DataFrame:
    """``day, by, user_name``: the users of each local day and key, as rows. Accesses without user count for none.

    For exact answers at any number of users; sketches are smaller, but exact up to some 4,000 only.
    """
    rows = facts.where(F.col("user_name").isNotNull())
    return rows.select(times.local_date(F.col("ts"), tz).alias("day"), *by, "user_name").distinct()


def changed_users(
    days: DataFrame, before: tuple[date | str, date | str], after: tuple[date | str, date | str], by: Sequence[str] = ("app_name",)
) -> DataFrame:
    """``by, lapsed, retained, gained, active`` of :func:`user_days`, exactly: users of the first period only, of both, of
    the second only, and all of the first."""
    seen = [_period(F.col("day"), *p) for p in (before, after)]
    users = days.where(seen[0] | seen[1]).groupBy(*by, "user_name").agg(F.bool_or(seen[0]).alias("_a"), F.bool_or(seen[1]).alias("_b"))
    a, b = F.col("_a"), F.col("_b")
    kinds = {"lapsed": a & ~b, "retained": a & b, "gained": b & ~a, "active": a}
    return users.groupBy(*by).agg(*[F.count_if(c).alias(n) for n, c in kinds.items()])


# --- layers -----------------------------------------------------------------------------------


def _layer_counts(facts: DataFrame, *more: Column) -> DataFrame:
    return unnest_layers(facts).groupBy(*more, F.col("request_details.workspaces").alias("workspaces"), "layer").agg(F.count("id").alias("nb_req"))


def daily_layers(facts: DataFrame, keep: int = 1_000, tz: str = "Europe/Paris") -> DataFrame:
    """``day, workspaces, layer, nb_req, bound``: each local day's ``keep`` most requested layers.

    ``bound`` is the count of the day's most requested layer that is left out, 0 if none is: no layer that a day does
    not name was requested more often on it.
    """
    counted = _layer_counts(facts, times.local_date(F.col("ts"), tz).alias("day"))
    order = Window.partitionBy("day").orderBy(F.desc("nb_req"), F.asc_nulls_last("workspaces"), "layer")
    ranked = counted.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= keep + 1)
    left_out = F.max(F.when(F.col("_rank") == keep + 1, F.col("nb_req"))).over(Window.partitionBy("day"))
    return ranked.withColumn("bound", F.coalesce(left_out, F.lit(0).cast("long"))).where(F.col("_rank") <= keep).drop("_rank")


def top_layers(spark: SparkSession, days: DataFrame, facts: DataFrame, n: int, start: date | str, end: date | str, tz: str = "Europe/Paris") -> DataFrame:
    """The ``n`` most requested layers of the local days ``[start, end)``, exactly; ties in layer order.

    A layer was requested at least as often as its days name it, and at most by the other days' bounds more. Only
    layers whose most reaches the n-th best least can be among the first; where days left any of them out, exactly
    these are counted on the facts of the period, else the summaries tell. If even a layer no day names could be among
    the first (summaries too short for the period) all layers are counted.
    """
    rows = days.where(_period(F.col("day"), start, end))
    bound = rows.groupBy("day").agg(F.max("bound").alias("b")).agg(F.coalesce(F.sum("b"), F.lit(0)).alias("b")).first()["b"]
    layer = ["workspaces", "layer"]
    least = rows.groupBy(*layer).agg(F.sum("nb_req").alias("nb_req"), (F.lit(bound) - F.sum("bound")).alias("more"))
    order = [F.desc("nb_req"), F.asc_nulls_last("workspaces"), "layer"]
    if bound == 0:
        return least.select(*layer, "nb_req").orderBy(*order).limit(n)
    best = [r.nb_req for r in least.orderBy(F.desc("nb_req")).limit(n).select("nb_req").collect()]
    bar = best[-1] if len(best) == n else -1
    day = times.local_date(F.col("ts"), tz)
    wanted = facts.where(_period(day, start, end))
    if "ts_date" in facts.columns:  # a local day lies in two days of UTC at most
        near = (F.date_sub(F.lit(start).cast("date"), 1), F.date_add(F.lit(end).cast("date"), 1))
        wanted = wanted.where(F.col("ts_date").between(*near))
    if bound >= bar:
        return _layer_counts(wanted).orderBy(*order).limit(n)
    candidates = least.where(F.col("nb_req") + F.col("more") >= bar).select(*layer)
    open_ = least.where((F.col("nb_req") + F.col("more") >= bar) & (F.col("more") > 0))
    if not open_.limit(1).count():  # what the days name of these is all there is
        return least.select(*layer, "nb_req").orderBy(*order).limit(n)
    split = unnest_layers(wanted.select("id", "request_details", F.col("request_details.workspaces").alias("_w")))
    hit = split.alias("f").join(candidates.alias("c"), [F.col("f._w").eqNullSafe(F.col("c.workspaces")), F.col("f.layer") == F.col("c.layer")], "left_semi")
    return hit.groupBy(F.col("_w").alias("workspaces"), "layer").agg(F.count("id").alias("nb_req")).orderBy(*order).limit(n)
