"""Hourly, daily and monthly rollups, and their incremental refresh."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from mapmeter.functions import relative, times
from mapmeter.functions.jsons import has_tag
from mapmeter.functions.quantiles import STATE, build_state, merge_state, state_mean
from mapmeter.sources.changes import Change, change, cursor, data_files, notes_since
from mapmeter.sources.tables import date_folders, read_access_logs, table_exists

OGC_COLUMNS = ("app_id", "app_name", "user_name", "org_name", "request_method", "status_code", "server_address")
OGC_DETAILS = (
    "workspaces", "layers", "service", "request", "tiled", "is_download", "download_format",
    "user_agent_family", "referrer",
)
DATAAPI_COLUMNS = ("user_name", "org_name", "request_method", "status_code")
DATAAPI_DETAILS = ("layers", "request", "is_download", "download_format", "full_download", "user_agent_family")

GRAINS = ("hour", "day", "month")
# How far back a scheduled refresh of each level looks.
LOOKBACK = {"hour": "7 days", "day": "21 days", "month": "6 months"}
# So many tasks write a month, and so many files it has, until it is large enough to be split by size.
PARTS_OF_MONTH = 8


@dataclass(frozen=True)
class RollupSpec:
    """One family of rollups: which facts, which dimensions, which measures, in which zone.

    ``measures`` is ``median`` (exact medians, min, max), ``state`` (mean and mergeable quantiles, bounded in rank) or
    ``relative`` (mean and mergeable quantiles, bounded in value).
    """

    name: str
    columns: tuple[str, ...]
    details: tuple[str, ...]
    measures: str = "median"
    timezone: str = "Europe/Paris"
    where: Column | None = None

    @property
    def dims(self) -> tuple[str, ...]:
        return self.columns + self.details


def ogc_spec(timezone: str = "Europe/Paris") -> RollupSpec:
    return RollupSpec(
        "ogc", OGC_COLUMNS, OGC_DETAILS, "median", timezone, has_tag(F.col("request_details"), "ogc")
    )


def dataapi_spec(timezone: str = "Europe/Paris") -> RollupSpec:
    return RollupSpec(
        "dataapi", DATAAPI_COLUMNS, DATAAPI_DETAILS, "state", timezone, F.col("app_name") == "dataapi"
    )


def dataapi_quantiles_spec(timezone: str = "Europe/Paris") -> RollupSpec:
    return RollupSpec(
        "dataapi_quantiles", DATAAPI_COLUMNS, DATAAPI_DETAILS, "relative", timezone, F.col("app_name") == "dataapi"
    )


def _group_medians(rows: DataFrame, keys: list[str], value: str, weight: Column, name: str, **measures: Column) -> DataFrame:
    """One row per group: ``measures`` (aggregates) and the median of ``value``, NULLs left out.

    ``weight`` tells how often a row's value counts. Each group is the row in which the lower of its two middle places
    lies (its first one if nothing counts), the upper one lies there or in the next row. So rows are sorted once and not
    aggregated after that, which costs most where nearly every row is a group of its own. A window of many rows goes to
    disk, unlike the buffers of ``percentile``, which hold a map per group.
    """
    ordered = W.partitionBy(*keys).orderBy(value)
    whole = ordered.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    ranked = rows.withColumn("_weight", weight).select(
        *keys,
        F.col(value).cast("double").alias("_low"),
        F.lead(value).over(ordered).cast("double").alias("_next"),
        F.row_number().over(ordered).alias("_row"),
        F.col("_weight"),
        F.sum("_weight").over(ordered.rowsBetween(W.unboundedPreceding, W.currentRow)).alias("_upto"),
        F.sum("_weight").over(whole).alias("_total"),
        *[measure.over(whole).alias(n) for n, measure in measures.items()],
    )
    first, last = F.col("_upto") - F.col("_weight"), F.col("_upto") - 1
    low, high = F.expr("(_total - 1) div 2"), F.expr("_total div 2")
    picked = ranked.filter(F.when(F.col("_total") == 0, F.col("_row") == 1).otherwise((first <= low) & (low <= last)))
    median = (F.col("_low") + F.when(high <= last, F.col("_low")).otherwise(F.col("_next"))) / 2
    return picked.select(*keys, F.when(F.col("_total") > 0, median).alias(name), *measures)


def exact_medians(df: DataFrame, keys: list[str], value: str, name: str = "median") -> DataFrame:
    """Exact median of ``value`` per key group (NULLs left out, linear between the middle two).

    Equal values are counted first, with map-side combining, so that a group with very many rows reaches
    its final task as one row per distinct value.
    """
    counted = df.groupBy(*keys, value).agg(F.count(value).alias("_n"))
    return _group_medians(counted, keys, value, F.col("_n"), name)


_MEDIAN = ("nb_req", "response_time_median", "response_time_min", "response_time_max")
_RELATIVE_SUMS = ("nb_req", "rt_sum", "rt_cnt")


def _relative_measures(buckets: DataFrame, keys: list[str]) -> DataFrame:
    closed = relative.close_states(buckets, keys, sums=_RELATIVE_SUMS)
    return closed.withColumn("avg_time", state_mean()).select(*keys, "nb_req", "avg_time", "quantiles", "rt_sum", "rt_cnt")


def facts_rollup(facts: DataFrame, spec: RollupSpec, grain: str = "hour") -> DataFrame:
    """Rollup straight from the facts, normally by hour."""
    if spec.where is not None:
        facts = facts.filter(spec.where)
    rows = facts.select(
        times.bucket(grain, F.col("ts"), spec.timezone).alias("bucket"),
        *spec.columns,
        *[F.col(f"request_details.{d}").cast("string").alias(d) for d in spec.details],
        "id",
        F.col("response_time").alias("_rt"),
    )
    keys = ["bucket", *spec.dims]
    if spec.measures == "state":
        return (
            rows.groupBy(*keys)
            .agg(F.count("id").alias("nb_req"), *build_state(F.col("_rt")))
            .withColumn("avg_time", state_mean())
            .select(*keys, "nb_req", "avg_time", *STATE)
        )
    if spec.measures == "relative":
        counted = relative.count_buckets(rows, keys, F.col("_rt"), {"nb_req": F.col("id").isNotNull().cast("long"), "rt_sum": F.col("_rt").cast("double"), "rt_cnt": F.col("_rt").isNotNull().cast("long")})
        return _relative_measures(counted, keys)
    # first by value, so that a hot group is combined map-side and spread over the shuffle
    counted = rows.groupBy(*keys, "_rt").agg(F.count("id").alias("_ids"), F.count("_rt").alias("_n"))
    number = F.col("_rt").cast("double")
    return _group_medians(
        counted, keys, "_rt", F.col("_n"), "response_time_median",
        nb_req=F.sum("_ids"), response_time_min=F.min(number), response_time_max=F.max(number),
    ).select(*keys, *_MEDIAN)


def next_rollup(finer: DataFrame, spec: RollupSpec, grain: str) -> DataFrame:
    """Rollup of the next finer rollup. Medians become the unweighted median of the finer medians."""
    keys = ["bucket", *spec.dims]
    rows = finer.withColumn("bucket", times.bucket(grain, F.col("bucket"), spec.timezone))
    if spec.measures == "state":
        return (
            rows.groupBy(*keys)
            .agg(F.sum("nb_req").alias("nb_req"), *merge_state())
            .withColumn("avg_time", state_mean())
            .select(*keys, "nb_req", "avg_time", *STATE)
        )
    if spec.measures == "relative":
        opened = relative.open_states(rows)
        once = {c: F.when(F.col("_at") == 0, F.col(c)) for c in _RELATIVE_SUMS}
        return _relative_measures(opened.withColumns(once), keys)
    # at most one row per finer bucket reaches a group, which bounds it
    counts = F.when(F.col("response_time_median").isNotNull(), F.lit(1)).otherwise(F.lit(0))
    return _group_medians(
        rows, keys, "response_time_median", counts, "response_time_median",
        nb_req=F.sum("nb_req"), response_time_min=F.min("response_time_min"), response_time_max=F.max("response_time_max"),
    ).select(*keys, *_MEDIAN)


def distinct_times(facts: DataFrame, spec: RollupSpec, grain: str = "hour") -> DataFrame:
    """``bucket, dims, response_time, n``: how often a group has each response time, as rows.

    Unlike medians, such counts can be added up: :func:`merge_times` makes days and months of them, and
    :func:`true_medians` reads the exact median of all accesses off any level. A group is as many rows as it has
    distinct times, so none has to fit into one value.
    """
    if spec.where is not None:
        facts = facts.filter(spec.where)
    rows = facts.select(
        times.bucket(grain, F.col("ts"), spec.timezone).alias("bucket"), *spec.columns,
        *[F.col(f"request_details.{d}").cast("string").alias(d) for d in spec.details], "response_time", "id",
    )
    return rows.groupBy("bucket", *spec.dims, "response_time").agg(F.count(F.lit(1)).alias("n"), F.count("id").alias("nb_req"))


def merge_times(finer: DataFrame, spec: RollupSpec, grain: str) -> DataFrame:
    """The counts of a coarser level from those of a finer one."""
    rows = finer.withColumn("bucket", times.bucket(grain, F.col("bucket"), spec.timezone))
    return rows.groupBy("bucket", *spec.dims, "response_time").agg(F.sum("n").alias("n"), F.sum("nb_req").alias("nb_req"))


def true_medians(counted: DataFrame, spec: RollupSpec) -> DataFrame:
    """Exact median, minimum and maximum of all accesses of each group, from a level of counts."""
    keys = ["bucket", *spec.dims]
    weight = F.when(F.col("response_time").isNotNull(), F.col("n")).otherwise(F.lit(0))
    number = F.col("response_time").cast("double")
    return _group_medians(
        counted, keys, "response_time", weight, "response_time_median",
        nb_req=F.sum("nb_req"), response_time_min=F.min(number), response_time_max=F.max(number),
    ).select(*keys, *_MEDIAN)


def all_levels(facts: DataFrame, spec: RollupSpec) -> dict[str, DataFrame]:
    hour = facts_rollup(facts, spec, "hour")
    day = next_rollup(hour, spec, "day")
    return {"hour": hour, "day": day, "month": next_rollup(day, spec, "month")}


def summary(hour: DataFrame, day: DataFrame, month: DataFrame) -> DataFrame:
    """The three levels as one view. Literal periods and grouped keys make all rows distinct already."""
    levels = [df.withColumn("period", F.lit(p)) for p, df in zip(GRAINS, (hour, day, month))]
    out = levels[0].unionByName(levels[1]).unionByName(levels[2])
    return out.select("period", *[c for c in out.columns if c != "period"])


def global_views(hour: DataFrame, day: DataFrame, facts: DataFrame, timezone: str = "Europe/Paris") -> dict[str, DataFrame]:
    """Small views for overview pages; the facts are counted by day, and months from the days."""

    def ogc_count(df: DataFrame, *keys: str) -> DataFrame:
        return df.groupBy("bucket", *keys).agg(F.sum("nb_req").alias("nb_req"))

    layers = day.filter(F.col("layers").isNotNull()).withColumn("layer", F.explode(F.split("layers", ",")))
    months = day.withColumn("bucket", times.bucket_month(F.col("bucket"), timezone))

    every_day = facts.groupBy(times.bucket("day", F.col("ts"), timezone).alias("bucket"), "app_name").agg(F.count("id").alias("nb_req"))
    every_month = every_day.groupBy(times.bucket_month(F.col("bucket"), timezone).alias("bucket"), "app_name").agg(F.sum("nb_req").alias("nb_req"))

    return {
        "ogc_daily_global": ogc_count(day),
        "ogc_daily_per_layer": ogc_count(layers, "layer"),
        "ogc_monthly": ogc_count(months),
        "all_daily": every_day,
        "all_monthly": every_month,
    }


def _partition(grain: str, tz: str) -> Column:
    """Hours and days are stored by local day, months by local month."""
    local = times.local_date(F.col("bucket"), tz)
    return F.trunc(local, "month") if grain == "month" else local


def whole_partitions(grain: str, start: Column, end: Column, tz: str) -> tuple[Column, Column]:
    """The window widened to whole partitions, as dynamic overwrite replaces these as a whole."""
    cut = times.bucket_month if grain == "month" else times.bucket_day
    step = F.expr("INTERVAL 1 month") if grain == "month" else F.expr("INTERVAL 1 day")
    low = cut(start, tz)
    last = cut(end, tz)
    high = F.when(last == end, last).otherwise(
        F.to_utc_timestamp(F.from_utc_timestamp(last, tz) + step, tz)
    )
    return low, high


def _replace_partitions(asked: Change, rolled: DataFrame | None, dates: Iterable[date], spec: RollupSpec, grain: str) -> list[str]:
    """The partitions of these dates become ``rolled``; those without rows go. Noted are those that had or have rows."""
    names = {f"bucket_date={d.isoformat()}" for d in dates}
    files = data_files(asked.spark, asked.path)
    asked.replace(names, files)
    if rolled is not None:
        # a month's rows would else meet in one task
        deal = F.pmod(F.hash(*spec.dims), F.lit(PARTS_OF_MONTH)) if grain == "month" else None
        asked.add(rolled.withColumn("bucket_date", _partition(grain, spec.timezone)), "bucket_date", deal=deal)
    touched = {f.split("/")[0] for f in asked.goes} | {target.split("/")[0] for _, target in asked.comes}
    asked.note(name.split("=")[1] for name in touched)
    return sorted(touched)


def refresh_rollup(
    spark: SparkSession,
    source: DataFrame,
    path: str,
    spec: RollupSpec,
    grain: str,
    start: datetime | str,
    end: datetime | str,
    source_since: datetime | str | None = None,
    wait: float = 0.0,
) -> None:
    """Recompute the buckets of ``[start, end)`` and replace their partitions, all at once; those left without rows go.

    ``source`` is the fact table for hours and the next finer rollup above. ``source_since`` tells from
    when on the source is complete (its own retention); partitions that begin earlier are left alone, so
    that an old day is never rebuilt from a part of its hours.
    """
    tz = spec.timezone
    low, high = whole_partitions(
        grain, F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp"), tz
    )
    time = "ts" if grain == "hour" else "bucket"
    if source_since is not None:
        since = F.lit(source_since).cast("timestamp")
        _, whole_since = whole_partitions(grain, since, since, tz)
        low = F.greatest(low, whole_since)
    window = source.filter((F.col(time) >= low) & (F.col(time) < high))
    if "ts_date" in source.columns:
        window = window.filter((F.col("ts_date") >= F.to_date(low)) & (F.col("ts_date") <= F.to_date(high)))
    elif "bucket_date" in source.columns:
        window = window.filter(
            (F.col("bucket_date") >= F.trunc(times.local_date(low, tz), "month"))
            & (F.col("bucket_date") <= times.local_date(high, tz))
        ).drop("bucket_date")
    rolled = facts_rollup(window, spec) if grain == "hour" else next_rollup(window, spec, grain)
    first, last = spark.range(1).select(*[times.local_date(x, tz).alias(n) for n, x in (("a", low), ("b", high))]).first()
    with change(spark, path, wait=wait) as asked:
        stored = date_folders(spark, path, "bucket_date")
        _replace_partitions(asked, rolled, [d for d in stored if first <= d < last], spec, grain)


def _dates_of(notes: set[str], spec: RollupSpec, grain: str, spark: SparkSession) -> set[date]:
    """Partitions of a level that notes of its source speak of: hours as seconds for the facts, dates for rollups."""
    if grain == "hour":
        if not notes:
            return set()
        # an hour may lie in two local days where the zone's offset is no whole hour
        ends = spark.createDataFrame([(int(n) + more,) for n in notes for more in (0, 3599)], "s long")
        local = times.local_date(F.timestamp_seconds("s"), spec.timezone)
        return {r[0] for r in ends.select(local).distinct().collect()}
    dates = {date.fromisoformat(n) for n in notes}
    return dates if grain == "day" else {d.replace(day=1) for d in dates}


def refresh_changed(
    spark: SparkSession, source_path: str, path: str, spec: RollupSpec, grain: str, source_since: datetime | str | None = None, wait: float = 0.0
) -> list[str]:
    """Recompute exactly the partitions whose source rows have changed since the last call; returns their names.

    The source's notes tell which (the fact table notes the hours of what is appended, rollups the partitions they
    rewrite), so a late record of any age costs one day of hours, one day and one month. How far the notes were read is
    part of the same change as the rows: a call that was killed is as if it had not been, or is finished by the next.
    Rows are read after the notes, so what lands in between is at worst counted again.
    """
    tz = spec.timezone
    with change(spark, path, wait=wait) as asked:
        number = cursor(spark, path, spec.name)
        notes, last = notes_since(spark, source_path, number)
        if last == number:
            return []
        dates = _dates_of(notes, spec, grain, spark)
        if source_since is not None:
            since = F.lit(source_since).cast("timestamp")
            _, whole_since = whole_partitions(grain, since, since, tz)
            first = spark.range(1).select(times.local_date(whole_since, tz)).first()[0]
            dates = {d for d in dates if d >= first}
        asked.come_to(spec.name, last)
        if not dates:
            return []
        if grain == "hour":
            near = sorted({d + timedelta(days=n) for d in dates for n in (-1, 0, 1)})
            window = read_access_logs(spark, source_path).filter(F.col("ts_date").isin(near) & times.local_date(F.col("ts"), tz).isin(sorted(dates)))
            rolled = facts_rollup(window, spec)
        elif not table_exists(spark, source_path):  # all of it has gone
            return _replace_partitions(asked, None, dates, spec, grain)
        else:
            source = read_rollup(spark, source_path)
            in_date = F.col("bucket_date") if grain == "day" else F.trunc("bucket_date", "month")
            rolled = next_rollup(source.filter(in_date.isin(sorted(dates))).drop("bucket_date"), spec, grain)
        return _replace_partitions(asked, rolled, dates, spec, grain)


def refresh_changed_levels(
    spark: SparkSession, facts_path: str, folder: str, spec: RollupSpec, source_since: datetime | str | None = None, wait: float = 0.0
) -> dict[str, list[str]]:
    """:func:`refresh_changed` for hour, day and month, each fed by the one before; the partitions rewritten at each.

    A level that another one was killed before reading keeps its notes, so nothing is missed. Notes that all rollups of
    a table have read can be dropped with ``changes.forget_notes``.
    """
    source, out = facts_path, {}
    for grain in GRAINS:
        path = f"{folder.rstrip('/')}/{spec.name}_{grain}"
        out[grain] = refresh_changed(spark, source, path, spec, grain, source_since, wait)
        source = path
    return out


def read_rollup(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def stored_levels(spark: SparkSession, folder: str, spec: RollupSpec) -> dict[str, DataFrame]:
    """The refreshed levels, for :func:`summary`, :func:`global_views` and reports: no fact is read."""
    return {g: read_rollup(spark, f"{folder.rstrip('/')}/{spec.name}_{g}").drop("bucket_date") for g in GRAINS}


def refresh_levels(
    spark: SparkSession,
    facts: DataFrame,
    folder: str,
    spec: RollupSpec,
    start: datetime | str,
    end: datetime | str,
    source_since: datetime | str | None = None,
) -> dict[str, DataFrame]:
    """Refresh hour, day and month one after the other, each from the one before."""
    source, out = facts, {}
    for grain in GRAINS:
        path = f"{folder.rstrip('/')}/{spec.name}_{grain}"
        refresh_rollup(spark, source, path, spec, grain, start, end, source_since)
        if table_exists(spark, path):
            out[grain] = source = read_rollup(spark, path)
    return out
