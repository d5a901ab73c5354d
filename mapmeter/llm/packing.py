"""Best-fit packing by hierarchical residuals.

Each partition packs its items best-fit, longest first, in windows of bounded size, and emits the bins that are
(nearly) full. Underfull bins become items: groups of partitions are merged, tree-wise, and packed again, until what
is left fits one window or merging no longer helps. No task holds more than a window, however much is left.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mapmeter.llm.common import settle, text_batches

WINDOW = 100_000  # items a task packs at a time
FAN_IN = 8  # partitions that meet in one task of the next round

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


# --- token ids --------------------------------------------------------------------------------


class Encoder:
    """Ids of whole texts as little-endian unsigned 32-bit numbers, by a byte-level BPE file of ``tokenizers``.

    The file's vocabulary (ids in order of merging) and its pattern are run by ``tiktoken``, which gives the same ids
    several times faster, on what stands between the file's added tokens; these have ids of their own. ``exact`` is the
    file's own tokenizer as it is.
    """

    # --- fixed value: the pattern by which byte-level BPE of this family cuts texts before merging
    PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

    def __init__(self, path: str):
        import tiktoken

        self.path = path
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        # the longest first, as the file's tokenizer takes them
        self.added = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
        # tokens that take white space with them, or stand as words only, are left to the file's tokenizer
        self.simple = not any(t[k] for t in spec["added_tokens"] for k in ("lstrip", "rstrip", "single_word"))
        # printable bytes stand for themselves in such files, the others for what follows code point 255
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        letters = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(sorted({*range(256)} - {*plain}))}
        ranks = {bytes(letters[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in added}
        self.ids = {token: [i] for token, i in added.items()}
        self.fast = tiktoken.Encoding("file", pat_str=self.PATTERN, mergeable_ranks=ranks, special_tokens=added)

    @cached_property
    def exact(self):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(self.path)
        return lambda text: np.asarray(tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def __call__(self, text: str) -> bytes:
        if self.added is None or not self.added.search(text):
            return np.asarray(self.fast.encode_ordinary(text), dtype="<u4").tobytes()
        if not self.simple:
            return self.exact(text)
        ids: list[int] = []
        for i, part in enumerate(self.added.split(text)):
            ids += self.ids[part] if i % 2 else self.fast.encode_ordinary(part)
        return np.asarray(ids, dtype="<u4").tobytes()

    def decode(self, ids) -> str:
        """The text of ``ids``, which end at a character's end."""
        return self.fast.decode_bytes([int(i) for i in ids]).decode("utf-8")


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def token_pieces(docs: DataFrame, doc_id: str, text: str, tokenizer: str, size: int = 1024, end_id: int = 2, ids: bool = False) -> DataFrame:
    """One row per piece of each document: ``doc_id, piece, start, length, ids_crc32`` (and ``ids``, binary, if asked).

    A document is its ids and then ``end_id``; null texts count as empty, so they are ``end_id`` alone. Only documents
    of more than ``size`` ids are cut; their first piece takes what does not fill one. Repeated rows stay, other
    columns go.
    """
    text_batches(docs.sparkSession)
    end = np.asarray([end_id], dtype="<u4").tobytes()

    schema = PIECES + (", ids binary" if ids else "")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        for batch in batches:
            rows, source = [], []
            for at, text_ in enumerate(batch.column(1).to_pylist()):
                data = encode(text_ or "") + end
                total = len(data) // 4
                start, no = 0, 0
                while start < total:
                    length = (total % size or size) if no == 0 else size
                    part = data[4 * start : 4 * (start + length)]
                    rows.append((no, start, length, zlib.crc32(part), part))
                    source.append(at)
                    start, no = start + length, no + 1
            columns = [[r[i] for r in rows] for i in range(5)]
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()][: 5 if ids else 4]
            arrays = [batch.column(0).take(pa.array(source, pa.int32()))] + [pa.array(c, k) for c, k in zip(columns, kinds, strict=False)]
            yield pa.RecordBatch.from_arrays(arrays, [f.split()[0] for f in schema.split(", ")])

    source = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return source.mapInArrow(cut, schema)


# --- packing ----------------------------------------------------------------------------------


def best_fit(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each item, and the fill of each bin: longest first, each into the fullest bin with room."""
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    room: list[list[int]] = [[] for _ in range(size + 1)]  # open bins by what they have left
    mask = 0  # bit r is set if a bin has r left
    fills: list[int] = []
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        fitting = mask >> n
        if fitting:
            left = (fitting & -fitting).bit_length() - 1 + n
            b = room[left].pop()
            if not room[left]:
                mask &= ~(1 << left)
        else:
            left, b = size, len(fills)
            fills.append(0)
        bins[i], offsets[i] = b, fills[b]
        fills[b] += n
        left -= n
        if left:
            room[left].append(b)
            mask |= 1 << left
    return bins, offsets, np.asarray(fills, np.int64)


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of at most ``WINDOW`` rows (and one batch), never cutting a bin: rows come sorted by bin."""
    held: list[pa.Table] = []
    count = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(pa.Table.from_batches([batch]))
        count += batch.num_rows
        if count >= WINDOW:
            table = pa.concat_tables(held)
            bins = table["sequence_id"].to_numpy()
            cut = int(np.argmax(bins == bins[-1]))  # where the last bin begins
            if cut:
                yield table.slice(0, cut)
                table = table.slice(cut)
            held, count = [table], table.num_rows
    if count:
        yield pa.concat_tables(held)


def _round(rows: DataFrame, size: int, number: int, slack: int) -> DataFrame:
    """Packs the bins of each partition as items; ``_open`` marks bins with more than ``slack`` left."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        made = 0
        for table in _windows(batches):
            old, index = np.unique(table["sequence_id"].to_numpy(), return_inverse=True)
            lengths = np.bincount(index, weights=table["_size"].to_numpy(), minlength=len(old)).astype(np.int64)
            bins, offsets, fills = best_fit(lengths, size)
            new = {
                "sequence_id": pa.array((number << 56) + (task << 36) + made + bins[index]),
                "offset": pa.array(table["offset"].to_numpy() + offsets[index]),
                "_open": pa.array((size - fills[bins[index]]) > slack),
                "_task": pa.array(np.full(table.num_rows, task, np.int32)),
            }
            for name, column in new.items():
                table = table.set_column(table.schema.get_field_index(name), name, column)
            made += len(fills)
            yield from table.combine_chunks().to_batches()

    return rows.mapInArrow(pack, rows.schema)


def pack(items: DataFrame, length: str, size: int = 1024, slack: int | None = None) -> DataFrame:
    """All rows and columns of ``items`` plus ``sequence_id`` and ``offset`` (both long).

    Items of one sequence lie one after the other from 0 and take at most ``size``. ``length`` must be 1 to ``size``
    (null and shorter ones count as 0 and lie where the next item does; longer ones raise). Repeated rows are items
    of their own. Bins with at most ``slack`` left (default: size / 128) are not opened again. Columns named
    ``sequence_id``, ``offset``, ``_size``, ``_open`` or ``_task`` are replaced.
    """
    slack = size // 128 if slack is None else slack
    work = ["sequence_id", "offset", "_size", "_open", "_task"]
    n = F.greatest(F.coalesce(F.col(f"`{length}`").cast("long"), F.lit(0)), F.lit(0).cast("long"))
    rows = items.select(
        *[F.col(f"`{c}`") for c in items.columns if c not in work],
        F.monotonically_increasing_id().alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
        F.when(n <= size, n).otherwise(F.raise_error(F.lit("an item is longer than a sequence"))).cast("long").alias("_size"),
        F.lit(True).alias("_open"), F.lit(0).alias("_task"),
    )
    number, parts, done = 1, None, []
    table = settle(_round(rows, size, number, slack), "packed")
    while True:
        left, tasks = table.where("_open").agg(F.count_distinct("sequence_id"), F.count_distinct("_task")).first()
        merged = max(-(-tasks // FAN_IN), -(-left // WINDOW), 1)
        if left < 2 or (parts is not None and merged >= parts):
            done.append(table)
            break
        done.append(table.where("NOT _open"))
        number, parts = number + 1, merged
        spread = table.where("_open").repartition(merged, F.col("sequence_id") if left > WINDOW else F.floor(F.col("_task") / FAN_IN))
        table = settle(_round(spread.sortWithinPartitions("sequence_id"), size, number, slack), "packed")
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.drop("_size", "_open", "_task")
