"""The fact table: Parquet, one partition per UTC day."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mapmeter.schemas import ACCESS_LOG_SCHEMA


def write_access_logs(df: DataFrame, path: str, mode: str = "append") -> None:
    """Write records by day, sorted for compression and pruning inside each file.

    The rebalance hint lets adaptive execution split large days and pool small ones, so that a hot day is
    not one task and a quiet one not many files.
    """
    (
        df.hint("rebalance", "ts_date")
        .sortWithinPartitions("ts_date", "app_name", "ts")
        .write.mode(mode)
        .option("compression", "zstd")
        .partitionBy("ts_date")
        .parquet(path)
    )


def read_access_logs(
    spark: SparkSession, path: str, start: datetime | str | None = None, end: datetime | str | None = None
) -> DataFrame:
    """Records with ``start <= ts < end``; the same bounds on the partition date skip whole days."""
    df = spark.read.schema(ACCESS_LOG_SCHEMA).parquet(path)
    if start is not None:
        first = F.lit(start).cast("timestamp")
        df = df.filter((F.col("ts") >= first) & (F.col("ts_date") >= F.to_date(first)))
    if end is not None:
        last = F.lit(end).cast("timestamp")
        df = df.filter((F.col("ts") < last) & (F.col("ts_date") <= F.to_date(last)))
    return df


def _at(spark: SparkSession, path: str):
    """The file system of a path, and the path there."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is anything but locks, notes and the like."""
    files, target = _at(spark, path)
    return files.exists(target) and any(s.getPath().getName()[0] not in "_." for s in files.listStatus(target))


def delete(spark: SparkSession, path: str) -> None:
    files, target = _at(spark, path)
    files.delete(target, True)


def date_folders(spark: SparkSession, path: str, partition: str) -> dict[date, str]:
    """The date partitions of a stored table, by date; rows without date are in none of them."""
    files, target = _at(spark, path)
    found = {}
    for status in files.listStatus(target):
        name = status.getPath().getName()
        if name.startswith(f"{partition}=") and not name.endswith("__HIVE_DEFAULT_PARTITION__"):
            found[date.fromisoformat(name.split("=", 1)[1])] = status.getPath().toString()
    return dict(sorted(found.items()))
