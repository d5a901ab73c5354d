"""Exact hard-negative mining with Kronecker-packed products.

Components of several candidates, biased so that none is negative, stand in separated fields of one 64-bit integer.
Multiplying an anchor's component with such an integer multiplies it with all these candidates' at once; the sum over
the components holds their scores, each in its field, from which they are read exactly. How many fields fit follows
from the data: no sum of one field can reach the next one. Arithmetic is modulo 2**64, so a single field is exact for
any score that fits a long.

Anchors meet all rows in blocks, twice: for their positives, then for the negatives in each positive's band of scores.
Only the best few of a block are passed on.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mapmeter.llm.common import settle
from mapmeter.llm.knn import scaled

BLOCK = 6_144  # candidates to a block, about
ANCHOR_BLOCK = 1_024  # anchors to a block, about
WORD = 64

_COLUMNS = {"ids": "id", "groups": "grp", "keys": "key"}
_BLOCK = "ids binary, groups binary, keys binary, numbers binary"


# --- packed products --------------------------------------------------------------------------


def fields(spread: int, reach: int) -> tuple[int, int]:
    """How many fields a word has, and their width: ``spread`` is the largest biased component, ``reach`` the largest
    sum of an anchor's absolute components. A width of 0 stands for one field, modulo 2**64."""
    width = max(1, (spread * reach).bit_length())
    return (WORD // width, width) if width < WORD else (1, 0)


def pack(vectors: np.ndarray, low: int, count: int, width: int) -> np.ndarray:
    """Candidates (rows of whole numbers) as words: component ``d`` of words ``j`` at ``[j, d]``."""
    rows = -(-len(vectors) // count)
    biased = np.zeros((rows * count, vectors.shape[1]), np.uint64)
    biased[: len(vectors)] = (vectors - np.int64(low)).view(np.uint64)
    words = np.zeros((rows, vectors.shape[1]), np.uint64)
    for field in range(count):
        words |= biased[field::count] << np.uint64(field * width)
    return words


def products(anchors: np.ndarray, words: np.ndarray, n: int, low: int, spread: int, count: int, width: int) -> np.ndarray:
    """Inner products of anchors with the ``n`` candidates of ``words``: one multiplication per component and word."""
    sums = np.einsum("ad,wd->aw", anchors.view(np.uint64), words)
    bias = anchors.sum(1) * np.int64(low)
    if not width:
        return sums.view(np.int64)[:, :n] + bias[:, None]
    # where an anchor's components are negative, so may a field be: all are lifted by the most that one can lack
    lift = np.where(anchors < 0, -anchors, 0).sum(1) * np.int64(spread)
    sums += lift.view(np.uint64)[:, None] * np.uint64(sum(1 << (field * width) for field in range(count)))
    out = np.empty((len(anchors), len(words), count), np.int64)
    for field in range(count):
        out[:, :, field] = (sums >> np.uint64(field * width) & np.uint64((1 << width) - 1)).view(np.int64)
    return out.reshape(len(anchors), -1)[:, :n] + (bias - lift)[:, None]


# --- blocks -----------------------------------------------------------------------------------


def _matrix(column, dims: int) -> np.ndarray:
    """Rows as whole numbers, shorter vectors filled up with zeros."""
    out = np.zeros((len(column), dims), np.int64)
    for i, v in enumerate(column):
        out[i, : len(v)] = v
    return out


def _best(scores: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` of the ascending places ``at`` with the highest scores, ties to the earlier one."""
    if len(at) > k:
        s = scores[at]
        kth = np.partition(s, len(s) - k)[len(s) - k]
        at = at[s >= kth]
    return at[np.argsort(-scores[at], kind="stable")][:k]


def mine(
    vectors: DataFrame, vec_id: str, vector: str, group: str, is_anchor: Column, factor: float = 256.0,
    positives: int = 5, negatives: int = 3, least: int = 50, most: int = 95,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``: for each anchor and each of its
    ``positives`` best rows of the same group, the ``negatives`` best rows of other groups whose score is between
    ``least`` and ``most`` per cent of the positive's.

    Scores are integer inner products of ``floor(factor * x)``, each exact if it fits a long (and below 2**56 for the
    percentages to be). Higher scores come first, ties by smaller id; ``rank`` counts from 1. ``is_anchor`` is a
    condition on the columns of ``vectors``.

    Null ids, null groups, null vectors and vectors with a null or non-finite component take no part. Repeated rows
    (same id, group and vector) count once; an id with several vectors or groups is an anchor and a candidate with
    each, but never a positive or negative of its own id. Vectors of different lengths are compared as if filled up
    with zeros. Anchors without positives, and positives without negatives in their band, have no rows. An empty table
    gives none. Other columns are left out.
    """
    spark = vectors.sparkSession
    rows = vectors.select(
        F.col(f"`{vec_id}`").cast("long").alias("id"), F.col(f"`{group}`").cast("string").alias("g"),
        scaled(F.col(f"`{vector}`"), factor).alias("v"), F.coalesce(is_anchor, F.lit(False)).alias("a"),
    )
    rows = rows.where("id IS NOT NULL AND g IS NOT NULL AND v IS NOT NULL").distinct()
    # groups and rows are told apart by 64-bit hashes, which travel as numbers
    rows = settle(rows.select("id", F.xxhash64("g").alias("grp"), F.xxhash64("id", "g", "v").alias("key"), "v", "a"), "vectors")
    absolute = F.aggregate("v", F.lit(0).cast("decimal(38,0)"), lambda s, x: (s + F.abs(x.cast("decimal(20,0)"))).cast("decimal(38,0)"))
    seen = rows.agg(
        F.max(F.size("v")), F.min(F.array_min("v")), F.max(F.array_max("v")), F.max(F.when(F.col("a"), absolute)), F.count_if("a"), F.count(F.lit(1))
    ).first()
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not seen[4]:
        return spark.createDataFrame([], schema)
    dims = max(1, seen[0])
    low, high = min(0, seen[1] or 0), max(0, seen[2] or 0)  # shorter vectors hold zeros
    count, width = fields(high - low, int(seen[3] or 0))

    def side(part: pd.DataFrame) -> dict[str, list[bytes]]:
        return {name: [part[c].to_numpy(np.int64).tobytes()] for name, c in _COLUMNS.items()}

    def packed(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["id", "key"], kind="stable")
        words = pack(_matrix(part["v"], dims), low, count, width)
        return pd.DataFrame({"block": [part["block"].iloc[0]], **side(part), "numbers": [words.tobytes()]})

    def together(part: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"part": [part["part"].iloc[0]], **side(part), "numbers": [_matrix(part["v"], dims).tobytes()]})

    def read(frame: pd.DataFrame):
        """Ids, groups, keys and numbers of the one block in ``frame``."""
        row = frame.iloc[0]
        return [np.frombuffer(row[c], np.int64) for c in _COLUMNS], np.frombuffer(row["numbers"], np.int64).reshape(-1, dims)

    def scored(left: pd.DataFrame, right: pd.DataFrame):
        """A few anchors at a time: their place, ids, groups and keys, and their scores with all candidates."""
        (ids, groups, keys), words = read(right)
        asking, anchors = read(left)
        for at in range(0, len(anchors), 128):
            here = slice(at, at + 128)
            yield at, [c[here] for c in asking], (ids, groups, keys), products(anchors[here], words.view(np.uint64), len(ids), low, high - low, count, width)

    def framed(names: list[str], parts: list[tuple]) -> pd.DataFrame:
        columns = map(np.concatenate, zip(*parts, strict=True)) if parts else [[]] * len(names)
        return pd.DataFrame(dict(zip(names, columns, strict=True)))

    # a grid: each block of anchors meets each block of candidates, one pair to a task's group
    n_blocks, n_parts = -(-seen[5] // BLOCK), -(-seen[4] // ANCHOR_BLOCK)
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("key"), F.lit(n_blocks)).cast("int"))
    blocks = settle(dealt.groupBy("block").applyInPandas(packed, "block int, " + _BLOCK), "packed")
    candidates = blocks.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(n_parts - 1))))
    anchors = rows.where("a").withColumn("part", F.pmod(F.xxhash64("key"), F.lit(n_parts)).cast("int"))
    grid = ["block", "part"]

    def meet(asked: DataFrame, solve, result: str) -> DataFrame:
        asking = settle(asked, "anchors").withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
        return asking.groupBy(*grid).cogroup(candidates.groupBy(*grid)).applyInPandas(solve, result)

    def nearest(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            for _, asking, (ids, groups, keys), scores in scored(left, right):
                for i, (own, group_, key) in enumerate(zip(*asking, strict=True)):
                    best = _best(scores[i], np.flatnonzero((groups == group_) & (ids != own)), positives)
                    out.append((np.full(len(best), own), np.full(len(best), key), ids[best], keys[best], scores[i][best]))
        return framed(["anchor_id", "key", "positive_id", "positive_key", "positive_score"], out)

    found = meet(anchors.groupBy("part").applyInPandas(together, "part int, " + _BLOCK), nearest, "anchor_id long, key long, positive_id long, positive_key long, positive_score long")
    order = Window.partitionBy("key").orderBy(F.desc("positive_score"), "positive_id", "positive_key")
    # no band of a negative score holds a number
    top = settle(found.withColumn("p", F.row_number().over(order)).where((F.col("p") <= positives) & (F.col("positive_score") >= 0)), "positives")
    bars = top.groupBy("key").agg(F.map_from_entries(F.collect_list(F.struct("p", "positive_score"))).alias("bars"))

    def banded(part: pd.DataFrame) -> pd.DataFrame:
        limits = np.asarray([[bars.get(p + 1, -1) for p in range(positives)] for bars in map(dict, part["bars"])], np.int64)
        return together(part).assign(bars=[limits.tobytes()])

    def hardest(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            limits = np.frombuffer(left["bars"].iloc[0], np.int64).reshape(-1, positives)
            for at, asking, (ids, groups, keys), scores in scored(left, right):
                for i, (own, group_, key) in enumerate(zip(*asking, strict=True)):
                    own_bars = [(p + 1, bar) for p, bar in enumerate(limits[at + i].tolist()) if bar >= 0]
                    s = scores[i]
                    lowest = min(-(-least * bar // 100) for _, bar in own_bars)
                    ahead = np.flatnonzero((s >= lowest) & (groups != group_) & (ids != own))
                    for p, bar in own_bars:
                        inside = ahead[(s[ahead] >= -(-least * bar // 100)) & (s[ahead] <= most * bar // 100)]
                        best = _best(s, inside, negatives)
                        out.append((np.full(len(best), key), np.full(len(best), p), ids[best], keys[best], s[best]))
        return framed(["key", "p", "negative_id", "negative_key", "negative_score"], out)

    bounded = anchors.join(bars, "key").groupBy("part").applyInPandas(banded, "part int, " + _BLOCK + ", bars binary")
    hard = meet(bounded, hardest, "key long, p int, negative_id long, negative_key long, negative_score long")
    order = Window.partitionBy("key", "p").orderBy(F.desc("negative_score"), "negative_id", "negative_key")
    ranked = hard.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    return ranked.join(top.select("key", "p", "anchor_id", "positive_id", "positive_score"), ["key", "p"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
