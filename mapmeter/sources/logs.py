"""Landing data: text log files and telemetry records, batch or stream."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mapmeter.schemas import OTEL_SCHEMA
from mapmeter.sources.changes import change, data_files

_DAY, _NO_DAY = "buffer_date", "__HIVE_DEFAULT_PARTITION__"


def _with_source(df: DataFrame) -> DataFrame:
    return df.select("value", F.col("_metadata.file_path").alias("source"))


def read_text_logs(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per line, with the file it came from; gzip is read as is."""
    return _with_source(spark.read.text(path))


def stream_text_logs(spark: SparkSession, path: str, **options: str) -> DataFrame:
    return _with_source(spark.readStream.options(**options).text(path))


def read_otel_buffer(
    spark: SparkSession, path: str, cutoff: datetime | str | None = None, fmt: str = "parquet"
) -> DataFrame:
    """Telemetry records older than ``cutoff`` (the start of the run)."""
    df = spark.read.schema(OTEL_SCHEMA).format(fmt).load(path)
    return df if cutoff is None else before(df, cutoff)


def stream_otel_buffer(spark: SparkSession, path: str, fmt: str = "parquet", **options: str) -> DataFrame:
    return spark.readStream.schema(OTEL_SCHEMA).format(fmt).options(**options).load(path)


def before(df: DataFrame, cutoff: datetime | str) -> DataFrame:
    """Records older than ``cutoff``, and those without time, which no later run would read otherwise."""
    return df.filter(F.col("timestamp").isNull() | (F.col("timestamp") < F.lit(cutoff).cast("timestamp")))


def rows_to_process(df: DataFrame, cutoff: datetime | str) -> DataFrame:
    """Number of pending records; those without span id are not counted."""
    return before(df, cutoff).agg(F.count("span_id").alias("nb_rows"))


def write_otel_buffer(df: DataFrame, path: str) -> None:
    """Add records to a buffer laid out by date, from which :func:`drain_stored` can drop whole files."""
    dated = df.select(*OTEL_SCHEMA.names, F.to_date("timestamp").alias("buffer_date"))
    dated.hint("rebalance", "buffer_date").write.mode("append").partitionBy("buffer_date").parquet(path)


def pending_files(spark: SparkSession, path: str, cutoff: datetime | str) -> list[str]:
    """The files of a buffer laid out by date that hold records older than ``cutoff``, or without time, as of now.

    A run reads these (:func:`read_pending`) and drains these (:func:`drain_stored`): what lands later, whatever its
    time, is neither read nor deleted.
    """
    border = spark.range(1).select(F.to_date(F.lit(cutoff).cast("timestamp"))).first()[0]
    last = f"{_DAY}={border.isoformat()}"
    return [f for f in data_files(spark, path) if f.startswith(f"{_DAY}={_NO_DAY}/") or f.split("/")[0] <= last]


def read_pending(spark: SparkSession, path: str, files: list[str], cutoff: datetime | str) -> DataFrame:
    """The records of these files older than ``cutoff``, and those without time."""
    if not files:
        return spark.createDataFrame([], OTEL_SCHEMA)
    root = path.rstrip("/")
    return before(spark.read.schema(OTEL_SCHEMA).parquet(*[f"{root}/{f}" for f in files]), cutoff)


def drain_stored(spark: SparkSession, path: str, cutoff: datetime | str, files: list[str], wait: float = 0.0) -> None:
    """Remove from a buffer what a run with this ``cutoff`` has read of ``files``, all at once or not at all.

    Files of the cutoff's own day may hold newer records, which stay, in files of their own; all other files go unread.
    """
    border = spark.range(1).select(F.to_date(F.lit(cutoff).cast("timestamp"))).first()[0]
    with change(spark, path, wait=wait) as asked:
        there = set(data_files(spark, path))
        read = [f for f in files if f in there]  # a call that is repeated finds them gone
        asked.remove(read)
        mixed = [f"{path.rstrip('/')}/{f}" for f in read if f.startswith(f"{_DAY}={border.isoformat()}/")]
        if mixed:
            newer = spark.read.schema(OTEL_SCHEMA).parquet(*mixed).filter(F.col("timestamp") >= F.lit(cutoff).cast("timestamp"))
            asked.add(newer.withColumn(_DAY, F.lit(border)), _DAY)


def drain_buffer(df: DataFrame, cutoff: datetime | str) -> DataFrame:
    """What stays in the buffer after everything older than ``cutoff`` was processed."""
    return df.filter(F.col("timestamp") >= F.lit(cutoff).cast("timestamp"))


def union_sources(*frames: DataFrame) -> DataFrame:
    """Several log sources as one; columns a source lacks are NULL."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out
