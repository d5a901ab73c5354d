"""Chat formatting as a prefix tree.

Conversations that share their first turns share nodes: a node is a turn after a given history, named by a digest of
that history. Each node's tokens are emitted once, depth-first, with position ids that count from the conversation's
start, and with the intervals of the emitted stream that the node may attend to besides itself: its ancestors'.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mapmeter.llm.common import settle, text_batches
from mapmeter.llm.packing import encoder

# --- fixed values: the template's marks, and control strings of common templates that texts must not contain
OPEN, MIDDLE, CLOSE = "<|turn|>", "<|text|>", "<|end|>"
CONTROLS = (OPEN, MIDDLE, CLOSE, "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|endoftext|>", "<|im_start|>", "<|im_end|>")

RANGE_TURNS = 64  # turns of a conversation by which ranges of sorted conversations are drawn

_CONTROL = re.compile("(?=" + "|".join(map(re.escape, CONTROLS)) + ")(.)", re.S)
_ESCAPED = re.compile(r"\\(.)", re.S)
_TURN = re.compile(f"{re.escape(OPEN)}(.*?){re.escape(MIDDLE)}(.*?){re.escape(CLOSE)}", re.S)


def escape(text: str) -> str:
    """Backslashes doubled, and one put behind the first character of each control string."""
    return _CONTROL.sub(r"\1\\", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def format_turn(role: str, text: str) -> tuple[str, str, str]:
    """What stands before, in, and behind a turn's text."""
    return OPEN + escape(role) + MIDDLE, escape(text), CLOSE


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a formatted conversation."""
    return [(unescape(r), unescape(t)) for r, t in _TURN.findall(formatted)]


# --- the tree ---------------------------------------------------------------------------------


def conversations(rows: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """One row per conversation: ``conv_id, path`` (nodes from the first turn on) and ``turns``.

    A conversation is the unit of training, so its turns come together. Ties of ``turn`` go by role, then text; null
    roles and texts count as empty. A row without conversation id is a conversation of its own.
    """
    empty = F.lit("")
    turns = rows.select(
        F.col(f"`{conv_id}`").alias("conv_id"),
        F.struct(F.col(f"`{turn}`").alias("turn"), F.coalesce(F.col(f"`{role}`"), empty).alias("role"), F.coalesce(F.col(f"`{text}`"), empty).alias("text")).alias("t"),
    ).withColumn("alone", F.when(F.col("conv_id").isNull(), F.monotonically_increasing_id()))
    grouped = turns.groupBy("conv_id", "alone").agg(F.array_sort(F.collect_list("t")).alias("turns")).drop("alone")
    own = F.transform("turns", lambda t: F.sha2(F.concat_ws("|", F.length(t["role"]), t["role"], t["text"]), 256))
    return grouped.select("conv_id", _histories(own).alias("path"), "turns")


@F.pandas_udf(T.ArrayType(T.StringType()))
def _histories(turns: pd.Series) -> pd.Series:
    """Digests of turns to digests of what was said up to and with each of them."""

    def chain(digests: np.ndarray) -> list[str]:
        path, before = [], ""
        for digest in digests:
            before = hashlib.sha256((before + digest).encode()).hexdigest()
            path.append(before)
        return path

    return turns.map(chain)


def _tokens(nodes: DataFrame, tokenizer: str, loss_role: str) -> DataFrame:
    """Adds ``ids``, ``length`` and the masked range ``loss_start`` to ``loss_end`` of each node."""
    text_batches(nodes.sparkSession)

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids = encoder(tokenizer)
        for batch in batches:
            rows = []
            for role, text in zip(batch["role"], batch["text"], strict=True):
                head, body, tail = (np.frombuffer(ids(s), dtype="<u4") for s in format_turn(role, text))
                at = len(head)
                end = at + len(body) if role == loss_role else at
                rows.append((np.concatenate([head, body, tail]).astype(np.int32), at, end))
            yield pd.DataFrame({
                "node": batch["node"], "parent": batch["parent"], "depth": batch["depth"], "ids": [r[0] for r in rows],
                "length": [len(r[0]) for r in rows], "loss_start": [r[1] for r in rows], "loss_end": [r[2] for r in rows],
            })

    return nodes.mapInPandas(encode, "node string, parent string, depth int, ids array<int>, length long, loss_start int, loss_end int")


def prefix_tree(convs: DataFrame, tokenizer: str, loss_role: str = "assistant") -> DataFrame:
    """One row per node: ``node, parent, depth, ids, length, loss_start, loss_end, start, position, intervals``.

    ``start`` is the node's place in the emitted stream, ``position`` the position id of its first token,
    ``intervals`` the (start, end) parts of the stream it may attend to before itself, in order, neighbours merged.
    Conversations as :func:`conversations` gives them; without any there are no nodes.

    Distinct conversations are sorted by their paths, which puts those with a common beginning side by side. A node
    comes in with the first of them that has it, so conversation and depth are its place depth-first, and neither work
    nor keys grow with the square of a conversation's length.
    """
    leaves = convs.where(F.size("path") > 0).groupBy(F.element_at("path", -1).alias("leaf")).agg(F.first("path").alias("path"))
    # ranges are drawn by a beginning of bounded length, of which the driver sees a sample; inside a range paths decide
    beginning = F.array_join(F.transform(F.slice("path", 1, RANGE_TURNS), lambda p: F.substring(p, 1, 16)), "")
    ranged = leaves.withColumn("beginning", beginning).repartitionByRange("beginning").sortWithinPartitions("beginning", "path")
    leaves = settle(ranged.select("leaf", "path", F.monotonically_increasing_id().alias("rank")), "leaves")
    ranks = leaves.select("rank", F.explode("path").alias("node")).groupBy("node").agg(F.min("rank").alias("rank"))

    turn = lambda t, i: F.struct(
        F.get("path", i).alias("node"), F.get("path", i - 1).alias("parent"), i.alias("depth"),
        t["role"].alias("role"), t["text"].alias("text"),
    )
    places = convs.select(F.explode(F.transform("turns", turn)).alias("n")).select("n.*")
    nodes = places.groupBy("node").agg(*[F.first(c).alias(c) for c in ("parent", "depth", "role", "text")])
    tokens = settle(_tokens(nodes, tokenizer, loss_role), "tokens")

    # a running sum over the stream: within parts of the sorted nodes, and over the parts' sums (one row each)
    ordered = tokens.select("node", "depth", "length").join(ranks, "node").repartitionByRange("rank", "depth")
    ordered = settle(ordered.withColumn("part", F.spark_partition_id()), "ordered")
    sums = ordered.groupBy("part").agg(F.sum("length").alias("total"))
    before = sums.select("part", F.coalesce(F.sum("total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    inner = Window.partitionBy("part").orderBy("rank", "depth").rowsBetween(Window.unboundedPreceding, -1)
    placed = ordered.join(F.broadcast(before), "part").withColumn("start", F.col("before") + F.coalesce(F.sum("length").over(inner), F.lit(0)))
    placed = settle(placed.select("node", "start", "length"), "placed")

    # each distinct conversation looks once at its own turns, whose ancestors are the turns before
    along = leaves.select("leaf", F.posexplode("path").alias("at", "node")).join(placed.select("node", "start", "length"), "node")
    lines = along.groupBy("leaf").agg(F.array_sort(F.collect_list(F.struct("at", "node", "start", "length"))).alias("line"))
    seen = lines.select("line.node", "line.start", "line.length").mapInPandas(_ancestors, "node string, position long, intervals array<struct<start:bigint,end:bigint>>")
    around = placed.select("node", "start").join(seen.dropDuplicates(["node"]), "node")
    return tokens.join(around, "node")


def _ancestors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """From a conversation's nodes to what each of them has before it: tokens, and intervals of the stream."""
    for batch in batches:
        rows = []
        for nodes, starts, lengths in zip(batch["node"], batch["start"], batch["length"], strict=True):
            position, intervals = 0, []
            for node, start, length in zip(nodes, starts.tolist(), lengths.tolist(), strict=True):
                rows.append((node, position, [{"start": s, "end": e} for s, e in intervals]))
                position += length
                if intervals and intervals[-1][1] == start:
                    intervals[-1] = (intervals[-1][0], start + length)
                else:
                    intervals.append((start, start + length))
        yield pd.DataFrame(rows, columns=["node", "position", "intervals"])


def read_back(tree: DataFrame, convs: DataFrame, tokenizer: str) -> DataFrame:
    """Conversations as the emitted tokens tell them: ``conv_id, turns`` of (role, text, loss, chars), in order.

    ``loss`` is the unescaped text under the loss mask, ``chars`` the formatted turn's code points.
    """

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids = encoder(tokenizer)
        for batch in batches:
            rows = []
            for node, tokens, at, end in zip(batch["node"], batch["ids"], batch["loss_start"], batch["loss_end"], strict=True):
                formatted = ids.decode(tokens)
                ((role, text),) = parse(formatted)
                rows.append((node, role, text, unescape(ids.decode(tokens[at:end])), len(formatted)))
            yield pd.DataFrame(rows, columns=["node", "role", "text", "loss", "chars"])

    turns = tree.select("node", "ids", "loss_start", "loss_end").mapInPandas(decode, "node string, role string, text string, loss string, chars long")
    paths = convs.select("conv_id", "path", F.monotonically_increasing_id().alias("row")).select("conv_id", "row", F.posexplode("path").alias("at", "node"))
    fields = ["role", "text", "loss", "chars"]
    joined = paths.join(turns, "node").groupBy("conv_id", "row").agg(F.array_sort(F.collect_list(F.struct("at", *fields))).alias("turns"))
    return joined.select("conv_id", "turns")
