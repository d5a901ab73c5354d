"""Mergeable quantile state: a KLL sketch beside exact sum and count."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

STATE = ("sketch", "rt_sum", "rt_cnt")


def build_state(value: Column) -> list[Column]:
    number = value.cast("double")
    return [
        F.kll_sketch_agg_double(number).alias("sketch"),
        F.sum(number).alias("rt_sum"),
        F.count(number).alias("rt_cnt"),
    ]


def merge_state() -> list[Column]:
    return [
        F.kll_merge_agg_double(F.col("sketch")).alias("sketch"),
        F.sum("rt_sum").alias("rt_sum"),
        F.sum("rt_cnt").alias("rt_cnt"),
    ]


def state_mean(total: str = "rt_sum", count: str = "rt_cnt") -> Column:
    return F.col(total) / F.nullif(F.col(count), F.lit(0))


def state_quantile(fraction: float, sketch: str = "sketch", count: str = "rt_cnt") -> Column:
    return F.when(F.col(count) > 0, F.kll_sketch_get_quantile_double(F.col(sketch), F.lit(fraction)))
