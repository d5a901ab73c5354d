"""Session needs of the library: UTC instants and a shared folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# where a local session keeps its intermediate tables if no shared folder is named
OWN_DIR = "mapmeter.local.dir"


def use_utc(spark: SparkSession) -> SparkSession:
    """Instants are read and written in UTC; local time appears only in named-zone buckets."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Streams started within keep their state in RocksDB, on the disks of the executors, and not in their memory.

    Later streams are as the session has them. A stream goes on with the store it was first started with.
    """
    key = "spark.sql.streaming.stateStore.providerClass"
    old = spark.conf.get(key)
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(key, old)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session without that setting (tests) gets a temporary folder, and only once; the setting itself is
    left alone.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(OWN_DIR, None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="mapmeter-")
    spark.conf.set(OWN_DIR, folder)
    return folder


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path nobody has written to yet, below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def persist_table(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: short lineage that outlives executors."""
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Use all cores on an input of few splits (one small file, a gzip), as parsing costs more than the
    shuffle. An input with many more splits than cores, the normal case, is left as it is.

    Splits of about the number of cores say little: Spark cuts any file into so many, but a row group of Parquet is
    read by one task as a whole, and the others get nothing.
    """
    wanted = 4 * df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(wanted) if df.rdd.getNumPartitions() < wanted else df
