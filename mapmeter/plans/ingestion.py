"""The batch intakes: buffered telemetry, the two sides of a reconciled set-up, and text files."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mapmeter.operators.apps import BUILT_IN, Processor
from mapmeter.operators.ingest import append_stored, split_unreadable
from mapmeter.operators.reconcile import reconcile
from mapmeter.operators.telemetry import filter_scope, parse_telemetry
from mapmeter.operators.text import number_repeats, parse_text_logs
from mapmeter.session import fresh_path, spread, use_utc
from mapmeter.settings import ACCESS_SCOPE_REGEX, NETTY_SCOPE, Settings
from mapmeter.sources.logs import before, drain_stored, pending_files, read_otel_buffer, read_pending, read_text_logs
from mapmeter.sources.tables import delete


def ingest_text(
    spark: SparkSession,
    source: str | list[str],
    table: str,
    settings: Settings,
    registry: tuple[Processor, ...] = BUILT_IN,
    mapping: DataFrame | None = None,
    rejects: str | None = None,
    wait: float = 0.0,
) -> dict[str, int]:
    """Append text files; returns how many ``lines`` there were and how many were ``rejected``.

    Rejected are lines that do not match, name no application, or have no readable time. With ``rejects`` given they
    are also written there, as they came. Lines are parsed once, to a table in the shared folder from which counts,
    rejects and new rows are taken.
    """
    lines = spread(number_repeats(read_text_logs(use_utc(spark), source)))
    landed = fresh_path(spark, "parsed")
    parsed = parse_text_logs(lines, settings, registry, mapping=mapping, rejects=True)
    parsed.write.parquet(landed)
    records = spark.read.schema(parsed.schema).parquet(landed)
    good, bad = split_unreadable(records)
    n_lines, n_bad = records.agg(F.count(F.lit(1)), F.count_if(F.col("ts").isNull())).first()
    append_stored(spark, good.drop("rejected_line"), table, wait=wait)
    if rejects is not None and n_bad:
        bad.select(F.col("rejected_line").alias("value"), F.col("context_data.source").alias("source")).write.mode("append").parquet(rejects)
    delete(spark, landed)
    return {"lines": n_lines, "rejected": n_bad}


def _append_records(spark: SparkSession, records: DataFrame, table: str, rejects: str | None, wait: float) -> dict[str, int]:
    landed = fresh_path(spark, "parsed")
    records.write.parquet(landed)
    stored = spark.read.schema(records.schema).parquet(landed)
    good, bad = split_unreadable(stored)
    n_records, n_bad = stored.agg(F.count(F.lit(1)), F.count_if(F.col("ts").isNull())).first()
    append_stored(spark, good, table, wait=wait)
    if rejects is not None and n_bad:
        bad.drop("ts_date").write.mode("append").parquet(rejects)
    delete(spark, landed)
    return {"records": n_records, "rejected": n_bad}


def ingest_telemetry(
    spark: SparkSession,
    source: str,
    table: str,
    settings: Settings,
    cutoff: datetime | str,
    registry: tuple[Processor, ...] = BUILT_IN,
    fmt: str = "parquet",
    scope: str | None = ACCESS_SCOPE_REGEX,
    mapping: DataFrame | None = None,
    rejects: str | None = None,
    files: list[str] | None = None,
    wait: float = 0.0,
) -> dict[str, int]:
    """Append buffered telemetry; returns how many ``records`` there were and how many, without time, were
    ``rejected`` (and written to ``rejects``, if given).

    A buffer of already merged records is read with ``scope=None``. ``files`` names those of a buffer laid out by date
    that are to be read.
    """
    use_utc(spark)
    records = read_otel_buffer(spark, source, cutoff, fmt) if files is None else read_pending(spark, source, files, cutoff)
    if scope is not None:
        records = filter_scope(records, regex=scope)
    return _append_records(spark, parse_telemetry(spread(records), settings, registry, mapping=mapping), table, rejects, wait)


def drain_telemetry(
    spark: SparkSession, buffer: str, table: str, settings: Settings, cutoff: datetime | str, rejects: str, wait: float = 0.0, **more: object
) -> dict[str, int]:
    """Append what a buffer laid out by date holds, then remove exactly that from it.

    The files are listed once: records that land during the run wait for the next one, whatever their time. Records
    without time go to ``rejects`` before anything is removed. A run that is killed before the buffer is drained reads
    the same records again, which adds nothing to the table.
    """
    files = pending_files(use_utc(spark), buffer, cutoff)
    counts = ingest_telemetry(spark, buffer, table, settings, cutoff, rejects=rejects, files=files, wait=wait, **more)
    drain_stored(spark, buffer, cutoff, files, wait)
    return counts


def ingest_reconciled(
    spark: SparkSession,
    netty: str,
    gateway: str,
    table: str,
    settings: Settings,
    cutoff: datetime | str,
    registry: tuple[Processor, ...] = BUILT_IN,
    fmt: str = "parquet",
    scope: str = ACCESS_SCOPE_REGEX,
    mapping: DataFrame | None = None,
    rejects: str | None = None,
    unsupported: str = "drop",
    wait: float = 0.0,
) -> dict[str, int]:
    """Append the accesses of a Netty and a gateway buffer: each is filtered by its scope, then they are merged.

    The cutoff holds for merged records, so that it never parts the two of one access.
    """
    use_utc(spark)
    sides = filter_scope(read_otel_buffer(spark, netty, None, fmt), [NETTY_SCOPE]), filter_scope(read_otel_buffer(spark, gateway, None, fmt), regex=scope)
    merged = before(reconcile(*sides), cutoff)
    return _append_records(spark, parse_telemetry(merged, settings, registry, unsupported, mapping), table, rejects, wait)
