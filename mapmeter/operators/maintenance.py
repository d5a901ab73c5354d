"""Upkeep of stored data: purge, backfill, tags, retention; and the oldest line classes."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mapmeter.sources.changes import change, data_files
from mapmeter.sources.tables import date_folders, table_exists

# Retention of each table; monthly rollups are kept.
RETENTION = {"facts": "3 years", "hour": "21 days", "day": "2 years"}


def purge(df: DataFrame, predicate: Column) -> DataFrame:
    """Delete the rows for which ``predicate`` is true; where it is unknown, rows stay."""
    return df.filter(~F.coalesce(predicate, F.lit(False)))


def backfill(df: DataFrame, column: str, value: object, where: Column | None = None) -> DataFrame:
    """Set ``column`` (added if missing) where the condition holds, everywhere without one."""
    new = value if isinstance(value, Column) else F.lit(value)
    if where is None:
        return df.withColumn(column, new)
    old = F.col(column) if column in df.columns else F.lit(None)
    return df.withColumn(column, F.when(where, new).otherwise(old))


def set_tag(df: DataFrame, apps: Iterable[str], tag: str = "ogc") -> DataFrame:
    details = F.col("request_details")
    tagged = details.withField("tags", F.array(F.lit(tag)))
    return df.withColumn("request_details", F.when(F.col("app_name").isin(*apps), tagged).otherwise(details))


def filter_app(df: DataFrame, *names: str) -> DataFrame:
    return df.filter(F.col("app_name").isin(*names))


def expire(df: DataFrame, time: str, age: str, now: datetime | str, partition: str | None = None) -> DataFrame:
    """Rows not older than ``age``; with the partition date given, old partitions are not even read."""
    limit = F.lit(now).cast("timestamp") - F.expr(f"INTERVAL {age}")
    kept = df.filter(F.col(time) >= limit)
    return kept.filter(F.col(partition) >= F.to_date(limit)) if partition else kept


def drop_before(spark: SparkSession, path: str, time: str, limit: datetime | str, partition: str, wait: float = 0.0) -> None:
    """Remove the rows of a stored table that are older than ``limit``, all at once or not at all.

    ``partition`` is the date of ``time`` by which the table is laid out. Files of earlier dates go as a whole, unread;
    only the border date is written anew, beside the table. Rows without time stay. Rollups are not told: they outlive
    the facts.
    """
    if not table_exists(spark, path):
        return
    instant = F.lit(limit).cast("timestamp")
    border = spark.range(1).select(F.to_date(instant)).first()[0]
    with change(spark, path, wait=wait) as asked:
        folders = date_folders(spark, path, partition)
        files = data_files(spark, path)
        asked.replace([f"{partition}={d}" for d in folders if d <= border], files)
        if border in folders:
            day = spark.read.parquet(folders[border]).withColumn(partition, F.lit(border))
            asked.add(day.filter(F.col(time).isNull() | (F.col(time) >= instant)), partition, compression="zstd")


def expire_stored(spark: SparkSession, path: str, time: str, age: str, now: datetime | str, partition: str) -> None:
    """Retention on storage: :func:`drop_before` at ``now`` less ``age``."""
    limit = spark.range(1).select(F.lit(now).cast("timestamp") - F.expr(f"INTERVAL {age}")).first()[0]
    drop_before(spark, path, time, limit, partition)


def compact(spark: SparkSession, path: str, partition: str, before: datetime | str, sort: Sequence[str] = ("app_name", "ts"), most_files: int = 1, wait: float = 0.0) -> list[str]:
    """Write the days before ``before`` anew that have come to more than ``most_files`` files; returns their names.

    Hourly appends leave many small files a day. The rows stay the same; they are sorted and compressed as a whole, and
    a large day is still split by size. Readers and rollups see no change.
    """
    limit = spark.range(1).select(F.to_date(F.lit(before).cast("timestamp"))).first()[0]
    with change(spark, path, wait=wait) as asked:
        files = data_files(spark, path)
        count = Counter(f.split("/")[0] for f in files)
        old = [f"{partition}={d}" for d in date_folders(spark, path, partition) if d < limit]
        loose = [name for name in old if count[name] > most_files]
        if loose:
            asked.replace(loose, files)
            rows = spark.read.option("basePath", path).parquet(*[f"{path.rstrip('/')}/{name}" for name in loose])
            asked.add(rows, partition, [c for c in sort if c in rows.columns], compression="zstd")
    return loose


def classify_line(line: Column) -> Column:
    """First of three URL shapes a raw line shows, NULL for other lines."""
    return (
        F.when(line.rlike("https?://.*/geoserver"), F.lit("geoserver"))
        .when(line.rlike("https?://.*/geowebcache"), F.lit("geowebcache"))
        .when(line.rlike("https?://.*/cadastrapp"), F.lit("cadastrapp"))
    )


def lines_per_app(df: DataFrame, line: str = "value") -> DataFrame:
    return (
        df.withColumn("app", classify_line(F.col(line)))
        .filter(F.col("app").isNotNull())
        .groupBy("app")
        .agg(F.count(F.lit(1)).alias("nb_lines"))
    )
