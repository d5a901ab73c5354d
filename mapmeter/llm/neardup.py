"""Near-duplicate groups: MinHash bands for candidates, sequential Bayesian tests, exact confirmation.

Texts with equal shingle sets are one node from the start, so copies cost nothing more. Nodes that share a band are
candidates. Their signatures are compared batch by batch; a candidate whose posterior chance of reaching the threshold
falls below ``MISS`` is dropped, and survivors are confirmed on the full sets.

Candidates of a band's bucket are not expanded into all pairs. First each node meets the bucket's smallest node; that
joins most of a large group. Then, only in buckets that still hold several components, blocks of bounded size are
compared in memory: signatures tell which nodes have a possible partner in another component, and the full sets of
these are compared in place, pair by pair, until a block's components are joined or have no link. Only links that
join two components are emitted, so a block of n nodes gives n - 1 at most; pairs within one component need none.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mapmeter.llm.common import fits, settle, text_batches, text_key

BANDS, ROWS = 32, 5  # a pair at similarity 0.85 shares no band once in 10^8, at 0.8 once in 10^5
HASHES = BANDS * ROWS
BATCH = 32  # signature places compared at a time
MISS = 1e-6  # posterior chance of a link below which a pair is dropped
BLOCK, BLOCK_BYTES = 1_024, 8 << 20  # nodes of one bucket that meet in memory, on each side, and their sets
BROADCAST_NODES = 500_000  # rows of ids that a broadcast may hold

# --- shingle sets and signatures --------------------------------------------------------------


class _Hashes(dict):
    """64-bit hash of a word; forgets when it has grown large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 200_000:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


_hashes = _Hashes()


@lru_cache(maxsize=8)
def _odd(count: int, seed: int, kind: str) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, np.iinfo(kind).max, count, dtype=kind, endpoint=True) | np.asarray(1, kind)


def shingles(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of ``size`` words; of the whole sequence if it is shorter.

    Words stand between ASCII white space; A-Z count as lower case.
    """
    listed = (text or "").encode().lower().split()
    if not listed:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(_hashes.__getitem__, listed), np.uint64, len(listed))
    size_here = min(size, len(h))
    factors = _odd(size, 11, "uint64")
    runs = len(h) - size_here + 1
    out = np.full(runs, size_here, np.uint64)
    for i in range(size_here):
        out += h[i : i + runs] * factors[i]
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(32)
    return np.unique(out)


def signature(hashes: np.ndarray) -> np.ndarray:
    """``HASHES`` minima of linear permutations of the lower 32 bits."""
    low = hashes.astype(np.uint32)
    factors, offsets = _odd(HASHES, 5, "uint32")[:, None], _odd(HASHES, 6, "uint32")[:, None]
    out = np.full(HASHES, np.iinfo(np.uint32).max, np.uint32)
    for at in range(0, len(low), 2_048):
        np.minimum(out, (factors * low[None, at : at + 2_048] + offsets).min(1), out=out)
    return out


def _signed(docs: DataFrame, doc_id: str, text: str, size: int) -> DataFrame:
    """``id, key, n, digest, signature (16 bits a place), bands`` of each row."""
    text_batches(docs.sparkSession)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for value in batch.column(2).to_pylist():
                found = shingles(value, size)
                if not len(found):
                    rows.append((0, None, None, None))
                    continue
                minima = (signature(found) & 0xFFFF).astype("<u2")
                bands = [xxhash.xxh3_64_intdigest(part.tobytes(), i) - (1 << 63) for i, part in enumerate(minima.reshape(BANDS, ROWS))]
                rows.append((len(found), hashlib.blake2b(found.tobytes(), digest_size=16).digest(), minima.tobytes(), bands))
            kinds = (pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64()))
            made = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *made], ["id", "key", "n", "digest", "signature", "bands"])

    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("id"), text_key(F.col(f"`{text}`")).alias("key"), F.col(f"`{text}`").alias("text"))
    return rows.mapInArrow(sign, "id long, key long, n long, digest binary, signature binary, bands array<bigint>")


# --- the sequential test ----------------------------------------------------------------------


@lru_cache(maxsize=8)
def least_matches(threshold: float, miss: float = MISS) -> tuple[int, ...]:
    """For each batch, the matches so far below which the posterior of ``similarity >= threshold`` is under ``miss``.

    With a uniform prior the posterior after ``m`` matches of ``n`` is Beta(m + 1, n - m + 1), whose upper tail is a
    binomial sum.
    """
    out = []
    for n in range(BATCH, HASHES + 1, BATCH):
        total, m = 0.0, 0
        while True:
            total += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if total >= miss:
                break
            m += 1
        out.append(m)
    return tuple(out)


def survivors(a: np.ndarray, b: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows of two signature arrays that pass the test, and their matches."""
    alive, matches = np.arange(len(a)), np.zeros(len(a), np.int64)
    for step, least in enumerate(least_matches(threshold)):
        part = slice(step * BATCH, (step + 1) * BATCH)
        matches = matches + (a[alive, part] == b[alive, part]).sum(1)
        keep = matches >= least
        alive, matches = alive[keep], matches[keep]
    return alive, matches


# --- pairs ------------------------------------------------------------------------------------


def _sizes_fit(a, b, num: int, den: int):
    return (F.least(a, b) * den) >= (F.greatest(a, b) * num)


def _tested(pairs: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) that pass the sequential test."""

    def test(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                left, right = (np.frombuffer(b"".join(batch[c]), "<u2").reshape(-1, HASHES) for c in ("sa", "sb"))
                yield batch.iloc[survivors(left, right, threshold)[0]][["a", "b"]]

    signed = pairs.join(nodes.select(F.col("node").alias("b"), F.col("signature").alias("sb")), "b").join(nodes.select(F.col("node").alias("a"), F.col("signature").alias("sa")), "a")
    return signed.mapInPandas(test, "a long, b long")


def _sets(wanted: DataFrame, nodes: DataFrame, docs: DataFrame, doc_id: str, text: str, size: int) -> DataFrame:
    """``node, hashes`` of the wanted nodes, made again from one text of each."""
    named = settle(wanted.distinct().join(nodes.select("node", F.col("id").alias("_id"), F.col("key").alias("_key")), "node"), "wanted")
    if fits(named, BROADCAST_NODES):
        named = F.broadcast(named)
    texts = docs.select(F.col(f"`{doc_id}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text")).withColumn("key", text_key(F.col("text")))
    found = texts.join(named, F.col("id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key"))).select("node", "text")

    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"node": batch["node"], "hashes": [shingles(t, size).tobytes() for t in batch["text"]]})

    # repeated rows of one document give its set more than once
    return settle(found.mapInPandas(make, "node long, hashes binary").dropDuplicates(["node"]), "sets")


def linked(x: np.ndarray, y: np.ndarray, num: int, den: int) -> bool:
    """Whether two sorted sets reach the threshold."""
    if len(x) < len(y):
        x, y = y, x
    both = int((x[np.minimum(np.searchsorted(x, y), len(x) - 1)] == y).sum())
    return den * both >= num * (len(x) + len(y) - both)


def _confirmed(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs whose full sets reach the threshold."""

    def confirm(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keep = [linked(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), num, den) for x, y in zip(batch["ha"], batch["hb"], strict=True)]
            yield batch[np.asarray(keep, bool)][["a", "b"]]

    full = pairs.join(sets.select(F.col("node").alias("b"), F.col("hashes").alias("hb")), "b").join(sets.select(F.col("node").alias("a"), F.col("hashes").alias("ha")), "a")
    return full.mapInPandas(confirm, "a long, b long")


def _near(table: np.ndarray, comp: np.ndarray, n: np.ndarray, i: int, band: int, threshold: float, num: int, den: int) -> np.ndarray:
    """Later rows of a block that may link with row ``i``: of another component, of fitting size, passing the
    sequential test, and sharing no band before this bucket's (else they meet there)."""
    rest = np.arange(i + 1, len(comp))
    rest = rest[(comp[rest] != comp[i]) & (np.minimum(n[rest], n[i]) * den >= np.maximum(n[rest], n[i]) * num)]
    if not len(rest):
        return rest
    rest = rest[survivors(np.broadcast_to(table[i], (len(rest), HASHES)), table[rest], threshold)[0]]
    shared = (table[rest] == table[i]).reshape(len(rest), BANDS, ROWS).all(2)
    return rest[shared.argmax(1) == band]


def _blocks(rows: DataFrame, *fields: str) -> DataFrame:
    """Nodes of each block (bucket, i, j) as parallel arrays; a block of one component has nothing to compare."""
    return (
        rows.groupBy("bucket", "i", "j")
        .agg(F.first("band").alias("band"), F.collect_list(F.struct("node", "component", "n", "signature", *fields)).alias("g"), F.min("component").alias("low"), F.max("component").alias("high"))
        .where("low <> high")
        .select("bucket", "i", "j", "band", "g.node", "g.component", "g.n", "g.signature", *[f"g.{f}" for f in fields])
    )


def _close_nodes(mixed: DataFrame, threshold: float, num: int, den: int) -> DataFrame:
    """``bucket, i, j, band, node``: the nodes of each block that may link across components."""
    chunks = F.greatest(F.ceil(F.col("many") / BLOCK), F.ceil(F.col("shingles") * 8 / BLOCK_BYTES)).cast("int")
    own = F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")
    dealt = mixed.withColumn("chunks", chunks).withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    groups = _blocks(dealt.withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")}))

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                table = np.frombuffer(b"".join(row.signature), "<u2").reshape(-1, HASHES)
                hit = np.zeros(len(table), bool)
                for i in range(len(table) - 1):
                    rest = _near(table, row.component, row.n, i, row.band, threshold, num, den)
                    if len(rest):
                        hit[i] = True
                        hit[rest] = True
                out += [(row.bucket, row.i, row.j, row.band, node) for node in row.node[hit]]
            yield pd.DataFrame(out, columns=["bucket", "i", "j", "band", "node"])

    return groups.mapInPandas(compare, "bucket long, i int, j int, band int, node long")


def _block_links(close: DataFrame, threshold: float, num: int, den: int) -> DataFrame:
    """Links (a, b) that join the components of each block, confirmed on full sets."""

    def confirm(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                table = np.frombuffer(b"".join(row.signature), "<u2").reshape(-1, HASHES)
                sets = [np.frombuffer(h, np.uint64) for h in row.hashes]
                comp = np.asarray(row.component).copy()  # as this block's links join them
                for i in range(len(table) - 1):
                    for k in _near(table, comp, row.n, i, row.band, threshold, num, den):
                        if comp[k] != comp[i] and linked(sets[i], sets[k], num, den):
                            out.append((min(row.node[i], row.node[k]), max(row.node[i], row.node[k])))
                            comp[comp == comp[k]] = comp[i]
            yield pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return _blocks(close, "hashes").mapInPandas(confirm, "a long, b long")


# --- components -------------------------------------------------------------------------------


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (its smallest node) of all nodes with an edge (a, b).

    Each round takes the smallest label among the neighbours and then follows labels one step (so that long chains
    shrink by halves); every round is written to the shared folder.
    """
    both = settle(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    labels = settle(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("component")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), F.col("component").alias("c")), "b").groupBy(F.col("a").alias("node")).agg(F.min("c").alias("c"))
        lower = labels.join(near, "node").select("node", F.least("component", "c").alias("step"), F.col("component").alias("old"))
        lower = settle(lower, "lower")
        ahead = lower.select(F.col("node").alias("step"), F.col("step").alias("next"))
        jumped = settle(lower.join(ahead, "step", "left").select("node", F.least("step", F.coalesce("next", "step")).alias("component"), "old"), "labels")
        if not jumped.where("component <> old").limit(1).count():
            return jumped.select("node", "component")
        labels = jumped.select("node", "component")


# --- the operator -----------------------------------------------------------------------------


def near_duplicates(docs: DataFrame, doc_id: str, text: str, size: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """``doc_id, text_key, n_shingles, component_id, kept, stays`` of each row.

    Two texts are linked if ``den`` x intersection >= ``num`` x union of their sets of ``size``-word shingles;
    ``component_id`` is the smallest id reachable over links, ``kept`` whether it is the row's own. Null and empty texts
    have no shingles and no links. Null ids are never the smallest; in groups of null ids alone the component is null
    and all are kept. Repeated rows stay and share a result; an id with several texts has a row, and a component, for
    each. ``stays`` is true for one id and text of each component, also where ids are null. Other columns are left out.
    """
    threshold = num / den
    rows = settle(_signed(docs, doc_id, text, size), "signed")
    first = rows.where("n > 0").groupBy("digest").agg(F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "key")).alias("r"), F.first("n").alias("n"), F.first("signature").alias("signature"), F.first("bands").alias("bands"))
    nodes = settle(first.select(F.monotonically_increasing_id().alias("node"), "digest", "r.id", "r.key", "n", "signature", "bands"), "nodes")

    entries = nodes.select(F.posexplode("bands").alias("band", "bucket"), "node", "n")
    heads = entries.groupBy("bucket").agg(F.min("node").alias("head"), F.count(F.lit(1)).alias("many"), F.sum("n").alias("shingles")).where("many > 1")
    shared = settle(entries.join(heads, "bucket"), "shared")

    # each node with its bucket's smallest
    sized = nodes.select(F.col("node").alias("head"), F.col("n").alias("nh"))
    pairs = shared.where("node <> head").select("head", "node", "n").distinct().join(sized, "head").where(_sizes_fit(F.col("n"), F.col("nh"), num, den))
    tested = settle(_tested(pairs.select(F.col("head").alias("a"), F.col("node").alias("b")), nodes, threshold), "survivors")
    wanted = tested.select(F.col("a").alias("node")).union(tested.select(F.col("b").alias("node")))
    links = settle(_confirmed(tested, _sets(wanted, nodes, docs, doc_id, text, size), num, den), "links")
    labels = components(links)

    # then what is left between components
    labelled = shared.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    split = labelled.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("bucket")
    mixed = labelled.join(split, "bucket").join(nodes.select("node", "signature"), "node")
    close = settle(_close_nodes(mixed, threshold, num, den), "close")
    if close.limit(1).count():
        sets = _sets(close.select("node"), nodes, docs, doc_id, text, size)
        whole = close.join(nodes.select("node", "n", "signature"), "node").join(labels, "node", "left").withColumn("component", F.coalesce("component", "node")).join(sets, "node")
        labels = components(links.unionByName(settle(_block_links(whole, threshold, num, den), "links")))

    grouped = nodes.select("node", "digest", "id", "key").join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    lowest = grouped.groupBy("component").agg(F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "key")).alias("r"))
    result = grouped.join(lowest, "component").select("digest", "r")
    out = rows.select("id", "key", "n", "digest").join(result, "digest", "left")
    lonely = F.col("digest").isNull()
    group = F.when(lonely, F.col("id")).otherwise(F.col("r.id"))
    return out.select(
        F.col("id").alias("doc_id"), F.col("key").alias("text_key"), F.col("n").alias("n_shingles"), group.alias("component_id"),
        group.eqNullSafe(F.col("id")).alias("kept"), (lonely | (F.col("id").eqNullSafe(F.col("r.id")) & (F.col("key") == F.col("r.key")))).alias("stays"),
    )


def without_duplicates(docs: DataFrame, doc_id: str, text: str, size: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The rows of ``docs``, with their columns, that stay: one of each component, repeated rows once."""
    found = near_duplicates(docs, doc_id, text, size, num, den).where("stays").groupBy("doc_id", "text_key").agg(F.count(F.lit(1)).alias("_many"))
    found = found.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), "_many")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    keyed = docs.select(row, F.col(f"`{doc_id}`").cast("long").alias("_id2"), text_key(F.col(f"`{text}`")).alias("_key2"))
    kept = keyed.join(found, F.col("_id").eqNullSafe(F.col("_id2")) & (F.col("_key") == F.col("_key2")))
    once = kept.where("_many > 1").groupBy("_id2", "_key2").agg(F.first("_row").alias("_row"))
    return kept.where("_many = 1").select("_row.*").unionByName(once.select("_row.*"))
