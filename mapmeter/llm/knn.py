"""Exact top-k search by inner product: a Voronoi kNN join.

Vectors are lifted onto a sphere (one more component makes all norms equal), where the largest inner product is the
smallest distance. Pivots cut queries and data into cells. From a summary of the cells (radii and the ``k`` smallest
distances to each pivot) follows, for each query cell, a distance within which ``k`` neighbours must lie, so a data
vector goes to that cell only if the triangle inequality does not rule it out. Cells are solved locally, large ones
in blocks of rows, and the blocks' best are merged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mapmeter.llm.common import settle

PIVOTS = 24  # cells; summaries of PIVOTS * (k + 2) numbers reach the driver
BLOCK = 16_384  # data rows that one task holds at a time
QUERY_BLOCK = 4_096  # queries that one task holds at a time
EXACT = float(1 << 53)  # sums below are exact in double precision


def scaled(vector: Column, factor: float) -> Column:
    """``floor(factor * x)`` of each component, or null if the vector or a component is null or not finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(vector.isNotNull() & ~bad, F.transform(vector, lambda x: F.floor(F.lit(factor) * x.cast("double"))))


def _matrix(column, dims: int) -> np.ndarray:
    """Rows as doubles, shorter vectors filled up with zeros."""
    out = np.zeros((len(column), dims))
    for i, v in enumerate(column):
        out[i, : len(v)] = v
    return out


def products(queries: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Integer inner products; in double precision where that is exact."""
    bound = (np.abs(queries).max(initial=0) * np.abs(data).max(initial=0)) * max(1, queries.shape[1])
    if bound < EXACT:
        return np.rint(queries @ data.T).astype(np.int64)
    return queries.astype(np.int64) @ data.astype(np.int64).T


def _lift(vectors: np.ndarray, top: float) -> np.ndarray:
    """Data vectors on the sphere of radius ``top``."""
    rest = np.sqrt(np.maximum(top**2 - (vectors**2).sum(1), 0))
    return np.hstack([vectors, rest[:, None]])


def _aim(vectors: np.ndarray, top: float) -> np.ndarray:
    """Query vectors on the same sphere: a query's length does not change which data are nearest."""
    norms = np.sqrt((vectors**2).sum(1))[:, None]
    return np.hstack([np.divide(vectors * top, norms, out=np.zeros_like(vectors), where=norms > 0), np.zeros((len(vectors), 1))])


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((a**2).sum(1)[:, None] + (b**2).sum(1)[None] - 2 * a @ b.T, 0))


def _to_cells(rows: DataFrame, pivots: np.ndarray, place, dims: int) -> DataFrame:
    """Adds the nearest pivot (``cell``) and the distance to it."""

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                d = _distances(place(_matrix(batch["v"], dims)), pivots)
                batch["cell"] = d.argmin(1).astype(np.int32)
                batch["distance"] = d.min(1)
                yield batch

    return rows.mapInPandas(assign, "id long, v array<bigint>, cell int, distance double")


def knn_join(vectors: DataFrame, vec_id: str, vector: str, is_query: Column, k: int, factor: float = 64.0, pivots: int = PIVOTS) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's ``k`` best rows by integer inner product of scaled vectors.

    ``is_query`` is a condition on ``vec_id``. A row of the query's own id is no candidate; ties go to the smaller id;
    with fewer than ``k`` candidates all are returned. Null ids, null vectors and vectors with a null or non-finite
    component take no part. Repeated rows (same id and vector) count once; an id with several vectors is a query and a
    candidate with each. Vectors of different lengths are compared as if filled up with zeros; empty ones score 0.
    Other columns are left out.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("id"), scaled(F.col(f"`{vector}`"), factor).alias("v"), is_query.alias("q"))
    rows = settle(rows.where("id IS NOT NULL AND v IS NOT NULL").distinct(), "vectors")
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    dims, top2 = rows.agg(F.max(F.size("v")), F.max(square)).first()
    schema = "query_id long, rank int, vec_id long, score long"
    if dims is None or not rows.where("q").limit(1).count():
        return spark.createDataFrame([], schema)
    dims, top = max(dims, 1), float(np.sqrt(top2)) or 1.0
    chosen = [r.v for r in rows.orderBy(F.xxhash64("id", "v"), "id").limit(pivots).select("v").collect()]
    centres = _lift(_matrix(chosen, dims), top)

    data = settle(_to_cells(rows.select("id", "v"), centres, lambda m: _lift(m, top), dims), "cells")
    queries = settle(_to_cells(rows.where("q").select("id", "v"), centres, lambda m: _aim(m, top), dims), "query-cells")

    # the summaries: a bounded number of rows per cell; of each query's neighbours, those of its own id do not count
    reserve = k + (rows.groupBy("id").count().agg(F.max("count")).first()[0] if rows.count() > rows.select("id").distinct().count() else 1)
    nearest = Window.partitionBy("cell").orderBy("distance", "id")
    near = data.select("cell", "distance", "id", F.row_number().over(nearest).alias("n")).where(F.col("n") <= reserve)
    closest: dict[int, list[float]] = {}
    for r in near.select("cell", "distance").collect():
        closest.setdefault(r.cell, []).append(r.distance)
    extent = {r.cell: (r.far, r.rows) for r in data.groupBy("cell").agg(F.max("distance").alias("far"), F.count(F.lit(1)).alias("rows")).collect()}
    reach = {r.cell: (r.far, r.rows) for r in queries.groupBy("cell").agg(F.max("distance").alias("far"), F.count(F.lit(1)).alias("rows")).collect()}

    between = _distances(centres, centres)
    slack = 1e-6 * top  # rounding must not rule out a neighbour
    plan = []
    for qc, (radius, n_queries) in reach.items():
        # this many vectors lie no farther than theta from any query of the cell
        bounds = np.sort(np.concatenate([radius + between[qc, dc] + np.asarray(ds) for dc, ds in closest.items()]))
        theta = bounds[reserve - 1] if len(bounds) >= reserve else np.inf
        need = {dc: between[qc, dc] - radius - theta - slack for dc in extent}
        need = {dc: low for dc, low in need.items() if low <= extent[dc][0]}
        total = sum(extent[dc][1] for dc in need)
        plan += [(qc, dc, float(low), max(1, -(-total // BLOCK)), max(1, -(-n_queries // QUERY_BLOCK))) for dc, low in need.items()]
    # at most pivots x pivots rows
    routes = F.broadcast(spark.createDataFrame(plan, "query_cell int, cell int, low double, blocks int, query_blocks int"))
    split = F.broadcast(spark.createDataFrame(sorted({(q, b, n) for q, _, _, b, n in plan}), "cell int, blocks int, query_blocks int"))

    sent = (
        data.join(routes, "cell").where(F.col("distance") >= F.col("low"))
        .select("query_cell", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("block"), F.explode(F.sequence(F.lit(0), F.col("query_blocks") - 1)).alias("query_block"), "id", "v")
    )
    asked = (
        queries.join(split, "cell")
        .select(F.col("cell").alias("query_cell"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.pmod(F.xxhash64("id"), F.col("query_blocks")).cast("int").alias("query_block"), "id", "v", F.xxhash64("v").alias("key"))
    )

    def solve(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            right = right.sort_values("id", kind="stable")
            ids, d = right["id"].to_numpy(), _matrix(right["v"], dims)
            for at in range(0, len(left), 256):
                part = left.iloc[at : at + 256]
                own = part["id"].to_numpy()
                scores = products(_matrix(part["v"], dims), d)
                for i, q in enumerate(own):
                    s = np.where(ids == q, np.iinfo(np.int64).min, scores[i])
                    kth = np.partition(s, len(s) - k)[len(s) - k] if len(s) > k else s.min()
                    best = np.flatnonzero((s >= kth) & (ids != q))
                    best = best[np.argsort(-s[best], kind="stable")][:k]  # ids ascend, so ties keep the smaller
                    out.append((np.full(len(best), q), np.full(len(best), part["key"].iloc[i]), ids[best], s[best]))
        columns = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [[], [], [], []]
        return pd.DataFrame(dict(zip(["query_id", "key", "vec_id", "score"], columns, strict=True)))

    keys = ["query_cell", "block", "query_block"]
    solved = asked.groupBy(*keys).cogroup(sent.groupBy(*keys)).applyInPandas(solve, "query_id long, key long, vec_id long, score long")
    order = Window.partitionBy("query_id", "key").orderBy(F.desc("score"), "vec_id")
    return solved.select("query_id", F.row_number().over(order).alias("rank"), "vec_id", "score").where(F.col("rank") <= k)
