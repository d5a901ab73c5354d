"""Streams over the same column logic as the batch jobs."""

from __future__ import annotations

import pickle
from collections import defaultdict
from collections.abc import Callable, Iterator, Sequence
from itertools import repeat

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from mapmeter.operators.apps import BUILT_IN, Processor
from mapmeter.operators.ingest import append_if_absent, append_stored, split_unreadable
from mapmeter.operators.reconcile import EXPIRE_MS, both_sides, merged, pair_in_order
from mapmeter.operators.telemetry import filter_scope, parse_telemetry
from mapmeter.operators.text import number_repeats, parse_text_logs
from mapmeter.plans.rollups import LOOKBACK, RollupSpec, refresh_changed_levels
from mapmeter.session import fresh_path
from mapmeter.settings import ACCESS_SCOPE_REGEX, Settings
from mapmeter.sources import changes
from mapmeter.sources.tables import delete


def records_stream(
    lines: DataFrame, kind: str, settings: Settings, registry: tuple[Processor, ...] = BUILT_IN, scope: str | None = ACCESS_SCOPE_REGEX
) -> DataFrame:
    """Access records of ``text`` lines or ``telemetry`` records; of merged records with ``scope=None``."""
    if kind == "text":
        return parse_text_logs(lines, settings, registry)
    return parse_telemetry(lines if scope is None else filter_scope(lines, regex=scope), settings, registry)


def bounded_late(df: DataFrame, time: str = "ts", lateness: str = LOOKBACK["hour"]) -> DataFrame:
    """Rows later than the look-back no longer reach rollups."""
    return df.withWatermark(time, lateness)


def dedupe_stream(df: DataFrame, lateness: str = LOOKBACK["hour"]) -> DataFrame:
    """Drop repeated ``(ts, id)`` with state bounded by the watermark; rows without id are all kept."""
    return (
        bounded_late(df, "ts", lateness)
        .withColumn("_key", F.coalesce("id", F.concat(F.lit("~"), F.uuid())))
        .dropDuplicatesWithinWatermark(["ts", "_key"])
        .drop("_key")
    )


def ingest_stream(
    lines: DataFrame,
    kind: str,
    table: str,
    checkpoint: str,
    settings: Settings,
    registry: tuple[Processor, ...] = BUILT_IN,
    scope: str | None = ACCESS_SCOPE_REGEX,
    rejects: str | None = None,
    **trigger: object,
) -> StreamingQuery:
    """Append a stream to the fact table; each micro-batch is appended only where absent, so a batch that
    is replayed after a failure changes nothing. By default everything available is taken, then it ends.

    A file is read in one micro-batch, so equal lines get the same numbers as in batch. Records without readable time
    go to ``rejects``, a folder per micro-batch, if that is given.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        lines_ = number_repeats(batch) if kind == "text" else batch
        good, bad = split_unreadable(records_stream(lines_, kind, settings, registry, scope))
        append_if_absent(batch.sparkSession, good, table)
        if rejects is not None:
            bad.drop("ts_date").write.mode("overwrite").parquet(f"{rejects}/epoch={epoch}")

    return (
        lines.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


# A state holds one of so many lots of the blocks, of so many cells each, in so many blocks' time. Of a dense one, about so
# many bytes are unpacked at once, and so many rows given out.
LOTS, BLOCK, STRETCH, TURN, ROWS = 32, 16, 1024, 64 << 20, 10_000


def _packed(rows: list[tuple], expire_us: int) -> tuple[int, int, bytes]:
    """Records of a state, after the first cell that one of them waits for."""
    text = pickle.dumps(rows)
    return min(r[3] + r[2] * expire_us for r in rows) // (2 * expire_us), len(text), pa.compress(text, codec="zstd", asbytes=True)


def _unpacked(_: int, size: int, held: bytes) -> list[tuple]:
    return pickle.loads(pa.decompress(held, size, codec="zstd", asbytes=True))


def _settled(rows: list[tuple], passed: int, expire_us: int) -> tuple[list[tuple], list[tuple]]:
    """What comes to an end as all cells before ``passed`` are whole, as (earlier, later or None) of (time, side, tie, text);
    and the other records. ``rows`` are (block, span, left over of their cell, time, side, tie, text)."""
    width = 2 * expire_us
    cells, across, out, waits = defaultdict(list), defaultdict(list), [], []
    for r in rows:
        cell = r[3] // width
        (cells[r[0], r[1], cell] if cell < passed else waits).append(r)
    for (block, span, cell), of_cell in cells.items():
        alone = [r[3:] for r in of_cell]
        if not of_cell[0][2]:
            # by text at last: both blocks that hold a record must see the same order
            pairs, alone = pair_in_order(sorted(alone), expire_us)
            out += pairs if cell // BLOCK == block else []
        for r in alone:
            moved = (r[0] + expire_us) // width
            if moved // BLOCK != block:
                continue
            if moved < passed:
                across[block, span, moved].append(r)
            else:
                waits.append((block, span, True, *r))
    for of_moved in across.values():
        pairs, alone = pair_in_order(sorted(of_moved), expire_us)
        out += pairs + [(r, None) for r in alone]
    return out, waits


def reconcile_stream(netty: DataFrame, gateway: DataFrame, expire_ms: int = EXPIRE_MS, lateness: str = "10 seconds") -> DataFrame:
    """The merge of :func:`mapmeter.operators.reconcile.reconcile`, as a stream.

    What a moved cell comes to hangs on the records of the two cells it lies across and on nothing else. Moved cells come
    in blocks, and a record goes to the block of the two that touch its own cell, or at a border to both blocks. Blocks of
    spans are dealt to lots by span *and* block, so a constant span spreads over all tasks; a state with its timer is a
    lot's stretch of time, as a call of Python for each span would cost far more than its records. Once the watermark has
    passed a cell, its pairs are emitted, and what is left of it and of the cell before and lies in the moved cell between
    them; what lies behind its middle waits for the next cell. Records without span or time go around.

    A state holds its records compressed, and a dense one is settled by some of its blocks after the other, so that it is
    never unpacked as a whole. States lie in the memory of the executors, unless the stream is started within
    :func:`mapmeter.session.state_on_disk`.
    """
    names, expire_us = gateway.columns, expire_ms * 1000
    width = 2 * expire_us
    both = both_sides(netty, gateway)
    kind = both.schema["_record"].dataType
    # records travel as text; times keep their microseconds
    options = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "ignoreNullFields": "false"}
    cell = F.floor(F.col("_us") / width)
    lot = F.pmod(F.hash("_span", "_block"), F.lit(LOTS))
    waiting = (
        both.where("_span IS NOT NULL")
        .select("_span", "_time", "_side", F.to_json("_record", options).alias("_text"), "_tie")
        .withWatermark("_time", lateness)
        .withColumn("_us", F.unix_micros("_time"))
        .withColumn("_block", F.explode(F.array_distinct(F.array(F.floor(cell / BLOCK), F.floor((cell + 1) / BLOCK)))))
        .withColumn("_state", F.floor(F.col("_block") / STRETCH) * LOTS + lot)
    )

    def settle(_: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = pickle.loads(state.get[0]) if state.exists else []
        for frame in frames:
            block, span, *record = (frame[c].tolist() for c in ("_block", "_span", "_us", "_side", "_tie", "_text"))
            if block:
                held.append(_packed(list(zip(block, span, repeat(False), *record)), expire_us))
        passed = state.getCurrentWatermarkMs() * 1000 // width  # cells before this one are whole
        texts = []
        if held and min(due for due, *_ in held) < passed:
            chunks, held = held, []
            turns = 1 + sum(size for _, size, _ in chunks) // TURN
            for turn in range(turns):
                pairs, waits = _settled([r for c in chunks for r in _unpacked(*c) if r[0] % turns == turn], passed, expire_us)
                held += [_packed(waits, expire_us)] if waits else []
                texts += [(a[3], b and b[3]) if a[1] == 0 else (b and b[3], a[3]) for a, b in pairs]
                if len(texts) >= ROWS:
                    yield pd.DataFrame(texts, columns=["n", "g"], dtype=object)
                    texts = []
        if held:
            kept = pickle.dumps(held)
            state.update((kept,))
            state.setTimeoutTimestamp(-(-(min(due for due, *_ in held) + 1) * width // 1000))
            # Python gives states back with so many rows, and else keeps all states of a task: an empty row for each KB
            texts += [(None, None)] * (1 + len(kept) // 1000)
        elif state.exists:
            state.remove()
        if texts:
            yield pd.DataFrame(texts, columns=["n", "g"], dtype=object)

    paired = waiting.groupBy("_state").applyInPandasWithState(settle, "n string, g string", "held binary", "append", GroupStateTimeout.EventTimeTimeout)
    pairs = paired.where("n IS NOT NULL OR g IS NOT NULL").select(*[F.from_json(c, kind, options).alias(f"_{c}") for c in ("n", "g")])
    nobody = F.lit(None).cast(kind)
    netty_side = F.col("_side") == 0
    alone = both.where("_span IS NULL").select(
        F.when(netty_side, F.col("_record")).otherwise(nobody).alias("_n"), F.when(~netty_side, F.col("_record")).otherwise(nobody).alias("_g")
    )
    return merged(pairs.unionByName(alone), names)


def _watermark(spark: SparkSession, path: str, epoch: int) -> int | None:
    """Microseconds up to which rows count as late in a micro-batch, from the batches before it."""
    held = changes.read_json(spark, f"{path}/{epoch - 1}") if epoch else None
    return held["passed"] if held else None


def split_late(
    df: DataFrame,
    on_time: str,
    late: str,
    checkpoint: str,
    time: str = "ts",
    lateness: str = LOOKBACK["hour"],
    then: Callable[[DataFrame, DataFrame, int], None] | None = None,
    **trigger: object,
) -> StreamingQuery:
    """Write a stream's rows to two tables: those that come in time, and those the watermark had already passed.

    Windowed counts of a stream leave late rows out without a trace. Here each micro-batch is compared with the
    watermark that holds in it, the latest time of all batches before less ``lateness``, as windows do; it is kept by
    micro-batch beside the checkpoint, so a batch that is replayed is split in the same way. Each batch writes a folder
    of its own (``epoch=N``) in both tables, over what a failed attempt has left. Rows without time are in time.
    ``then(on_time, late, epoch)`` is called with the batch's two parts as stored.
    """
    marks = f"{checkpoint.rstrip('/')}-watermarks"
    schema = df.schema

    def write(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        passed = _watermark(spark, marks, epoch)
        staged = fresh_path(spark, "micro-batch")
        batch.write.parquet(staged)
        rows = spark.read.schema(schema).parquet(staged)
        behind = F.lit(False) if passed is None else F.coalesce(F.unix_micros(time) <= F.lit(passed), F.lit(False))
        parts = []
        for path, part in ((on_time, rows.filter(~behind)), (late, rows.filter(behind))):
            folder = f"{path.rstrip('/')}/epoch={epoch}"
            part.write.mode("overwrite").parquet(folder)
            parts.append(spark.read.schema(schema).parquet(folder))
        if then is not None:
            then(*parts, epoch)
        latest = rows.agg(F.max(F.unix_micros(F.col(time) - F.expr(f"INTERVAL {lateness}")))).first()[0]
        known = [x for x in (passed, latest) if x is not None]
        changes.write_json(spark, f"{marks}/{epoch}", {"passed": max(known) if known else None})
        delete(spark, staged)

    return (
        df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True})).start()
    )


def metered_stream(
    records: DataFrame, table: str, folder: str, late: str, checkpoint: str, specs: Sequence[RollupSpec], lateness: str = LOOKBACK["hour"], **trigger: object
) -> StreamingQuery:
    """Append a stream of access records to the fact table and keep its rollups up to date, late rows included.

    Rows in time and late ones are both appended, where absent; the appends note the hours they change, and the rollups
    recompute exactly the partitions of these. What comes late is kept in ``late`` besides, a folder per micro-batch.
    The stored rollups equal a full recompute after each batch.
    """

    def then(in_time: DataFrame, behind: DataFrame, _: int) -> None:
        spark = in_time.sparkSession
        for part in (in_time, behind):
            append_stored(spark, part, table)
        for spec in specs:
            refresh_changed_levels(spark, table, folder, spec)

    return split_late(records, f"{checkpoint.rstrip('/')}-on-time", late, checkpoint, "ts", lateness, then, **trigger)


def hourly_stream(df: DataFrame, *dims: str, lateness: str = LOOKBACK["hour"]) -> DataFrame:
    """Counts, min, max and a quantile sketch by hour. An exact median is not incremental: for that,
    refresh the hourly rollup after each micro-batch."""
    number = F.col("response_time").cast("double")
    return (
        bounded_late(df, "ts", lateness)
        .groupBy(F.window("ts", "1 hour"), *dims)
        .agg(
            F.count("id").alias("nb_req"),
            F.min(number).alias("response_time_min"),
            F.max(number).alias("response_time_max"),
            F.kll_sketch_agg_double(number).alias("sketch"),
        )
        .withColumn("bucket", F.col("window.start"))
        .drop("window")
    )
