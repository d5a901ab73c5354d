"""Quantiles with a bound on the error of the value: logarithmic buckets that merge exactly.

A positive value falls into bucket ``ceil(log(value) / log(gamma))``; taking the bucket's middle for it is wrong by at
most ``ERROR`` of the value, whatever its rank. Where a group's buckets would span more than ``MOST``, they are merged
in pairs, all of them and as often as needed, which doubles the error each time (a span of 10^8 stays unmerged). How
often follows from the smallest and largest bucket alone, and merging in pairs twice is merging in fours, so a rollup
of rollups holds the same buckets as one made of the facts.

A state is a struct: ``level`` (how often buckets were merged), ``zeros`` (values that are not positive, taken for 0)
and ``buckets`` (number to count).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ERROR = 0.005
MOST = 2_048
_GAMMA = (1 + ERROR) / (1 - ERROR)


def bucket_of(value: Column) -> Column:
    """Bucket of a value, null for values that are not positive (and for null)."""
    number = value.cast("double")
    return F.when(number > 0, F.ceil(F.ln(number) / F.ln(F.lit(_GAMMA))).cast("int"))


def middle(bucket: Column, level: Column) -> Column:
    """The value taken for a bucket: off by at most ``ERROR`` at level 0."""
    gamma = F.pow(F.lit(_GAMMA), F.pow(F.lit(2.0), level))
    return 2 * F.pow(gamma, bucket.cast("double")) / (gamma + 1)


def _merged(bucket: Column, times: Column) -> Column:
    return F.ceil(bucket / F.pow(F.lit(2.0), times)).cast("int")


def count_buckets(df: DataFrame, keys: Sequence[str], value: Column, more: dict[str, Column] | None = None) -> DataFrame:
    """Rows to ``keys, _bucket, _n`` and sums of ``more``: what a group sends to its task is a row per bucket."""
    rows = df.withColumn("_value", value.cast("double")).withColumn("_bucket", bucket_of(F.col("_value")))
    rows = rows.withColumn("_zero", (F.col("_value") <= 0).cast("long"))
    sums = [F.sum(v).alias(name) for name, v in (more or {}).items()]
    counted = rows.groupBy(*keys, "_bucket").agg(F.count("_value").alias("_n"), F.sum("_zero").alias("_zeros"), *sums)
    return counted.withColumn("_level", F.lit(0))


def open_states(df: DataFrame, state: str = "quantiles") -> DataFrame:
    """Stored states to rows of buckets; other columns stay on one row of each state, and are null on the others."""
    entries = F.map_entries(f"{state}.buckets")
    none = F.array(F.lit(None).cast("struct<key:int,value:bigint>"))
    return df.select("*", F.posexplode(F.when(F.size(entries) > 0, entries).otherwise(none)).alias("_at", "_entry")).select(
        *[c for c in df.columns if c != state], "_at",
        F.col("_entry.key").alias("_bucket"), F.coalesce("_entry.value", F.lit(0).cast("long")).alias("_n"),
        F.col(f"{state}.level").alias("_level"), F.when(F.col("_at") == 0, F.col(f"{state}.zeros")).alias("_zeros"),
    )


def close_states(rows: DataFrame, keys: Sequence[str], state: str = "quantiles", sums: Sequence[str] = ()) -> DataFrame:
    """Rows of buckets to a state per group, and the ``sums``."""
    group = Window.partitionBy(*keys)
    rows = rows.withColumn("_top", F.max("_level").over(group))
    rows = rows.withColumn("_bucket", _merged(F.col("_bucket"), F.col("_top") - F.col("_level")))
    rows = rows.withColumns({"_low": F.min("_bucket").over(group), "_high": F.max("_bucket").over(group)})
    # as often as the range needs it, known without counting
    fits = F.filter(F.sequence(F.lit(0), F.lit(24)), lambda k: _merged(F.col("_high"), k) - _merged(F.col("_low"), k) < MOST)
    rows = rows.withColumn("_more", F.coalesce(F.get(fits, F.lit(0)), F.lit(0)))
    rows = rows.withColumn("_bucket", _merged(F.col("_bucket"), F.col("_more")))
    counted = rows.groupBy(*keys, "_bucket").agg(
        F.sum("_n").alias("_n"), F.sum("_zeros").alias("_zeros"), F.max(F.col("_top") + F.col("_more")).alias("_level"), *[F.sum(s).alias(s) for s in sums]
    )
    entries = F.array_sort(F.collect_list(F.when(F.col("_bucket").isNotNull(), F.struct(F.col("_bucket").alias("key"), F.col("_n").alias("value")))))
    made = F.struct(F.max("_level").alias("level"), F.coalesce(F.sum("_zeros"), F.lit(0).cast("long")).alias("zeros"), F.map_from_entries(entries).alias("buckets"))
    return counted.groupBy(*keys).agg(made.alias(state), *[F.sum(s).alias(s) for s in sums])


def quantile(fraction: float, state: str = "quantiles") -> Column:
    """The quantile between the two values next to it, each off by at most ``ERROR`` (times 2 for each level); null
    where nothing was counted."""
    s = F.col(state)
    zero = F.filter(F.array(F.struct(F.lit(0.0).alias("value"), s["zeros"].alias("n"))), lambda e: e["n"] > 0)
    entries = F.transform(F.map_entries(s["buckets"]), lambda e: F.struct(middle(e["key"], s["level"]).alias("value"), e["value"].alias("n")))
    steps = F.concat(zero, F.array_sort(entries))
    total = F.aggregate(steps, F.lit(0).cast("long"), lambda a, e: a + e["n"])
    place = F.lit(fraction) * (total - 1)

    def at(position: Column) -> Column:
        start = F.struct(F.lit(-1).cast("long").alias("upto"), F.lit(None).cast("double").alias("value"))
        walked = F.aggregate(
            steps, start, lambda a, e: F.struct((a["upto"] + e["n"]).alias("upto"), F.when(a["upto"] >= position, a["value"]).otherwise(e["value"]).alias("value"))
        )
        return walked["value"]

    low, high = at(F.floor(place)), at(F.ceil(place))
    return F.when(total > 0, low + (high - low) * (place - F.floor(place)))
