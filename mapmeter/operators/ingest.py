"""Idempotent append to the fact table, and duplicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from mapmeter.session import fresh_path
from mapmeter.sources.changes import change
from mapmeter.sources.tables import delete, read_access_logs

KEYS = ("ts", "id")
FEW_KEYS = 100_000  # repeated keys, some 10 MB, that go to every executor


def dedupe_keep_first(
    df: DataFrame, keys: Sequence[str] = KEYS, order: Sequence[str | Column] = ("oid",)
) -> DataFrame:
    """Keep the first row of each key; rows with a NULL key part never are duplicates.

    ``row_number() = 1`` is also applied before the shuffle (window group limit), so a key with very many
    copies sends one row per task. Rows without key get a group of their own and stay spread out.
    """
    nullable = F.lit(False)
    for k in keys:
        nullable = nullable | F.col(k).isNull()
    spread = df.withColumn("_alone", F.when(nullable, F.monotonically_increasing_id()))
    window = W.partitionBy(*keys, "_alone").orderBy(*order)
    return (
        spread.withColumn("_rank", F.row_number().over(window))
        .filter(F.col("_rank") == 1)
        .drop("_rank", "_alone")
    )


def keep_first_of_repeated(df: DataFrame, keys: Sequence[str] = KEYS, order: Sequence[str | Column] = ("oid",)) -> DataFrame:
    """:func:`dedupe_keep_first` of a table without null keys that may be read more than once.

    Keys are counted on their own, and only the rows of those found twice or more, normally few, are sorted: a task
    never sorts all rows of the files it reads.
    """
    again = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(*keys)
    many = again.limit(FEW_KEYS + 1).count()
    if not many:
        return df
    again = F.broadcast(again) if many <= FEW_KEYS else again
    once, repeated = (df.join(again, list(keys), how) for how in ("left_anti", "left_semi"))
    return once.unionByName(dedupe_keep_first(repeated, keys, order))


def find_duplicates(df: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Keys that occur more than once, in order."""
    return (
        df.groupBy(*keys)
        .agg(F.count(keys[-1]).alias("nb"))
        .filter(F.col("nb") > 1)
        .orderBy(*[F.asc_nulls_last(k) for k in keys])
    )


def absent_rows(new: DataFrame, existing: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Rows of ``new`` whose key is not in ``existing``; a NULL key part never matches."""
    return new.join(existing.select(*keys), list(keys), "left_anti")


def append_if_absent(
    spark: SparkSession,
    new: DataFrame,
    path: str,
    keys: Sequence[str] = KEYS,
    order: Sequence[str | Column] = ("message",),
    wait: float = 0.0,
) -> None:
    """Append the rows whose key is not yet in the table; running it twice changes nothing for rows with a key.

    A row with a NULL key part conflicts with nothing, in the table or in the batch, and is appended each time. Of
    equal keys in the batch the first by ``order`` is kept. The batch is computed once, to a table in the shared
    folder; its dates (one column, a few values) prune the stored table to its own partitions, so a stray old row opens
    one more day and not all between. Keys of the batch are counted first, so only rows with repeated keys are sorted.

    The rows show all at once or not at all, and only one writer appends at a time: another one waits up to ``wait``
    seconds for it and fails with ``TableBusy`` then. The hours with new rows are noted for the rollups, as seconds of
    their start.
    """
    landed = fresh_path(spark, "batch")
    new.write.parquet(landed)
    append_stored(spark, spark.read.schema(new.schema).parquet(landed), path, keys, order, wait)
    delete(spark, landed)


def append_stored(
    spark: SparkSession,
    batch: DataFrame,
    path: str,
    keys: Sequence[str] = KEYS,
    order: Sequence[str | Column] = ("message",),
    wait: float = 0.0,
) -> None:
    """:func:`append_if_absent` for a batch that is a table already and may be read more than once."""
    full = ["ts_date", *keys]
    missing = F.lit(False)
    for k in full:
        missing = missing | F.col(k).isNull()
    with change(spark, path, wait=wait) as asked:
        dates = [r[0] for r in batch.select("ts_date").where("ts_date IS NOT NULL").distinct().collect()]
        present = read_access_logs(spark, path).filter(F.col("ts_date").isin(dates)).select(*full)
        fresh = absent_rows(keep_first_of_repeated(batch.filter(~missing), full, order), present, full)
        fresh = fresh.unionByName(batch.filter(missing)).select(*batch.columns)
        added = asked.add(fresh, "ts_date", ("app_name", "ts"), compression="zstd")
        hours = added.select((F.floor(F.unix_seconds("ts") / 3600) * 3600).alias("h")).where("h IS NOT NULL").distinct()
        asked.note(r.h for r in hours.collect())


def split_unreadable(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Records with a time, and those without: the latter belong to no day and no bucket."""
    return records.filter(F.col("ts").isNotNull()), records.filter(F.col("ts").isNull())


def page(df: DataFrame, offset: int, limit: int, time: str = "timestamp", tie: str = "span_id") -> DataFrame:
    """One page, newest first. For looking at data; ingestion reads everything at once."""
    return df.orderBy(F.desc_nulls_first(time), F.asc_nulls_last(tie)).offset(offset).limit(limit)


def order_result(df: DataFrame, *columns: str) -> DataFrame:
    """Ascending order with NULLs last."""
    return df.orderBy(*[F.asc_nulls_last(c) for c in columns])
