"""Access records: fixed columns, privacy, merging."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mapmeter.schemas import ACCESS_LOG_SCHEMA
from mapmeter.settings import Settings


def apply_privacy(df: DataFrame, keys_blacklist: Iterable[str]) -> DataFrame:
    """Blank the listed columns; the schema stays as it is."""
    types = {f.name: f.dataType for f in df.schema}
    gone = {k: F.lit(None).cast(types[k]) for k in keys_blacklist if k in types}
    return df.withColumns(gone) if gone else df


def as_access_records(df: DataFrame, settings: Settings, more: Iterable[str] = ()) -> DataFrame:
    """Apply the privacy list and bring columns to fact-table order, with the partition date; ``more`` follow as they are."""
    df = apply_privacy(df.withColumn("ts_date", F.to_date("ts")), settings.keys_blacklist)
    # a cast copies nested values, so only what really differs is cast
    have = {f.name: f.dataType.simpleString() for f in df.schema}

    def fit(field: T.StructField) -> Column:
        if have.get(field.name) == field.dataType.simpleString():
            return F.col(field.name)
        value = F.col(field.name) if field.name in have else F.lit(None)
        return value.cast(field.dataType).alias(field.name)

    return df.select(*[fit(f) for f in ACCESS_LOG_SCHEMA], *more)


def prefer(*choices: Column) -> Column:
    """First non-blank choice."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in choices])


def merge_maps(left: Column, right: Column) -> Column:
    """Union of two maps; the right side wins."""
    rest = F.map_filter(left, lambda k, v: ~F.map_contains_key(right, k))
    return F.when(left.isNull(), right).when(right.isNull(), left).otherwise(F.map_concat(rest, right))
