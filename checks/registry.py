"""Collects the checks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mapmeter.session import use_utc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _plain(df: DataFrame) -> DataFrame:
    """Instants as UTC wall time, which is how SQL timestamps without zone read them."""
    return df.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, T.TimestampType) else F.col(f.name)
            for f in df.schema
        ]
    )


def check(name: str, sql: str | None = None):
    """Register a query, and the SQL it must agree with."""

    def add(build: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf: str) -> DataFrame:
            return _plain(build(use_utc(spark), sf))

        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return build

    return add
