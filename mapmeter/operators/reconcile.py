"""Merge of the two telemetry records of one access, by span id.

The rule, in batch and in streams: of one span, a Netty and a gateway record that follow one another in time, no more
than ``expire`` apart, are one access. Times are cut into cells of twice that length; what finds no partner in its cell
tries once more in cells moved by half a length, so that no pair is lost at a border. A record has one partner at
most, so a repeated or constant span id never gathers rows. Records without span or time have no partner.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# What each side gives up before the merge.
NETTY_DROPS = (
    "attributes", "dropped_attributes_count", "flags", "observed_timestamp", "resources",
    "severity_number", "severity_text", "source_type", "timestamp", "trace_id",
)
GATEWAY_DROPS = ("message",)
SIDES = {"netty": NETTY_DROPS, "gateway": GATEWAY_DROPS}
EXPIRE_MS = 500


def prune_fields(df: DataFrame, side: str) -> DataFrame:
    return df.drop(*SIDES[side])


def has_span(span: Column) -> Column:
    """Records without a span, or with the all-zero one that means the same, have no partner."""
    return F.coalesce(~span.rlike("^0*$"), F.lit(False))


def both_sides(netty: DataFrame, gateway: DataFrame) -> DataFrame:
    """All records: ``_span`` and ``_time`` (null where there can be no partner), ``_side``, ``_tie`` (an order of equal
    times) and the ``_record``, without what its side gives up, so that this is neither read nor moved."""
    names = gateway.columns
    types = {f.name: f.dataType for f in gateway.schema}

    def side(df: DataFrame, number: int) -> DataFrame:
        all_ = {c: (F.col(c) if c in df.columns else F.lit(None)).cast(types[c]) for c in names}
        given_up = set((NETTY_DROPS, GATEWAY_DROPS)[number]) - {"timestamp"}  # a lone Netty record keeps its time
        record = F.struct(*[(F.lit(None).cast(types[c]) if c in given_up else value).alias(c) for c, value in all_.items()])
        tie = F.hash(all_["message"], all_["scope"]["name"], *[all_[c] for c in ("trace_id",) if c in all_])
        usable = has_span(F.col("span_id")) & F.col("timestamp").isNotNull()
        return df.select(F.when(usable, F.col("span_id")).alias("_span"), F.col("timestamp").alias("_time"), F.lit(number).alias("_side"), tie.alias("_tie"), record.alias("_record"))

    return side(netty, 0).unionByName(side(gateway, 1))


def merged(pairs: DataFrame, names: Sequence[str]) -> DataFrame:
    """``(_n, _g)`` records, one of which may be null, as one record.

    Messages come from Netty, scope names run together, Netty first; every other field comes from the side that has
    it. The time is the gateway's, or Netty's where there is no gateway record.
    """
    n, g = F.col("_n"), F.col("_g")

    def field(name: str) -> Column:
        if name == "scope":
            return F.struct(F.concat_ws("", n["scope"]["name"], g["scope"]["name"]).alias("name"))
        if name == "timestamp":
            return F.coalesce(g[name], n[name])
        if name in NETTY_DROPS:
            return g[name]
        return n[name] if name in GATEWAY_DROPS else F.coalesce(g[name], n[name])

    return pairs.select(*[field(c).alias(c) for c in names])


def _pair_up(rows: DataFrame, expire_us: int, shift: int) -> DataFrame:
    """Adds ``_partner`` to the later record of a pair, and ``_taken`` to the earlier one.

    Within a run of records of changing sides, each close to the one before, the second, fourth and so on take
    their predecessor. All windows share one shuffle, by span and cell.
    """
    micros = F.unix_micros("_time")
    rows = rows.withColumn("_cell", F.floor((micros + shift) / (2 * expire_us)))
    w = W.partitionBy("_span", "_cell").orderBy("_time", "_side", "_tie")
    close = (F.lag("_side").over(w) != F.col("_side")) & (micros - F.lag(micros).over(w) <= expire_us)
    rows = rows.withColumns({"_close": F.coalesce(close, F.lit(False)), "_no": F.row_number().over(w)})
    begin = F.max(F.when(~F.col("_close"), F.col("_no"))).over(w.rowsBetween(W.unboundedPreceding, W.currentRow))
    rows = rows.withColumn("_second", (F.col("_no") - begin) % 2 == 1)
    return rows.withColumns(
        {
            "_partner": F.when(F.col("_second"), F.lag("_record").over(w)),
            "_taken": ~F.col("_second") & F.coalesce(F.lead("_second").over(w), F.lit(False)),
        }
    )


def _as_pair(partner: Column) -> list[Column]:
    """``_n`` and ``_g`` of a row and its partner (null if alone)."""
    own_netty = F.col("_side") == 0
    return [F.when(own_netty, F.col("_record")).otherwise(partner).alias("_n"), F.when(own_netty, partner).otherwise(F.col("_record")).alias("_g")]


def reconcile(netty: DataFrame, gateway: DataFrame, expire_ms: int = EXPIRE_MS) -> DataFrame:
    """One record per access; whatever has no partner is passed on alone, none is lost."""
    both = both_sides(netty, gateway)
    nobody = F.lit(None).cast(both.schema["_record"].dataType)
    timed = both.where("_span IS NOT NULL")
    kept = ["_span", "_time", "_side", "_record", "_tie"]

    first = _pair_up(timed, expire_ms * 1000, 0)
    second = _pair_up(first.where("NOT _second AND NOT _taken").select(*kept), expire_ms * 1000, expire_ms * 1000)
    parts = [
        both.where("_span IS NULL").select(*_as_pair(nobody)),
        first.where("_second").select(*_as_pair(F.col("_partner"))),
        second.where("NOT _taken").select(*_as_pair(F.col("_partner"))),
    ]
    return merged(parts[0].unionByName(parts[1]).unionByName(parts[2]), gateway.columns)


def pair_in_order(rows: list[tuple], expire_us: int) -> tuple[list[tuple], list[tuple]]:
    """The rule within one cell, for streams: pairs (earlier, later) and those left, of (time, side, …) in order."""
    pairs, left = [], []
    i = 0
    while i < len(rows):
        if i + 1 < len(rows) and rows[i + 1][1] != rows[i][1] and rows[i + 1][0] - rows[i][0] <= expire_us:
            pairs.append((rows[i], rows[i + 1]))
            i += 2
        else:
            left.append(rows[i])
            i += 1
    return pairs, left
