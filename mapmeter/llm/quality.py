"""Quality classifier: random-indexing word vectors, pooled per document, and a small calibrated network.

Every token has a sparse random index vector that follows from its hash. A token's vector is its own index vector
plus the direction of the sum of its neighbours' over the whole corpus; the sums are integers, so their order does not
matter. A document is the mean of its tokens' vectors. A two-layer network, fitted on a bounded sample of labelled
rows, gives a logit, which a temperature fitted on rows kept out of the training turns into a probability.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mapmeter.llm.common import one_each, text_batches

BUCKETS = 8_192  # tokens fall into these; the first SHAPES of them belong to what words look like
SHAPES = 512
DIMS = 48
NONZERO = 4  # components of an index vector that are not 0
REACH = 2  # neighbours on each side
CHUNK = 1 << 16  # tokens worked on at a time
TASKS = 64  # whose sums are added first
TRAIN_ROWS = 20_000  # labelled rows a model is fitted on, at most
HIDDEN = 16
LONG_PIECE = 64  # pieces of more characters are cut into chunks
REPEAT = 0  # the bucket of "the same piece again"

# --- tokens -----------------------------------------------------------------------------------

# scripts without spaces between words: Thai to Myanmar, Khmer, Japanese, Chinese
_UNSPACED = r"\u0e00-\u109f\u1780-\u17ff\u3005-\u3007\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff"
# a chunk of a long piece: what is of one kind, of bounded length; each character belongs to one
_CHUNK = re.compile(rf"[{_UNSPACED}]{{1,2}}|(?:(?![{_UNSPACED}])[^\W\d_]){{1,32}}|(?:(?![{_UNSPACED}])\d){{1,32}}|(?:(?![{_UNSPACED}])[\W_]){{1,32}}")
_PLAIN = re.compile(r"^[^\W\d_]?[^\W\d_A-Z]*[.,]?$")
_RUN = re.compile(r"(.)\1+")


def _shape(piece: str) -> str:
    """Kind of each character, runs shortened: ``A`` capital, ``a`` other letter, ``0`` digit, else the character."""
    kinds = "".join("A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c for c in piece)
    return _RUN.sub(r"\1\1", kinds)


class _Codes(dict):
    """Piece of text -> word bucket, shape bucket (0: none) and a hash of the piece, in one number; forgets when it
    has grown large."""

    def __missing__(self, piece: str) -> int:
        if len(self) > 200_000:
            self.clear()
        raw = piece.encode()
        stem = piece[:-1] if piece[-1] in ".," else piece
        if stem.isalpha() and stem[1:].islower():  # what most pieces are
            word, shape = SHAPES + zlib.crc32(stem.lower().encode()) % (BUCKETS - SHAPES), 0
        else:
            core = re.sub(r"[\W_]+", "", piece).lower()
            word = SHAPES + zlib.crc32(core.encode()) % (BUCKETS - SHAPES) if core else 0
            plain = _PLAIN.match(piece) and not (len(piece) > 2 and piece.isupper())
            shape = 0 if plain else 1 + zlib.crc32(_shape(piece).encode()) % (SHAPES - 1)
        self[piece] = out = word | shape << 16 | (zlib.crc32(raw) & 0x3FFFFFFF) << 32
        return out


_codes = _Codes()


def tokens(text: str | None) -> np.ndarray:
    """Buckets of a text in order; words, then what is unusual in their shape, and ``REPEAT`` for a repeated piece.

    A piece is what stands between white space; longer ones than ``LONG_PIECE`` (prose without spaces, encoded data)
    are cut into chunks that count as pieces, so that every character of a text does.
    """
    pieces = (text or "").split()
    if max(map(len, pieces), default=0) > LONG_PIECE:
        pieces = [c for p in pieces for c in (_CHUNK.findall(p) if len(p) > LONG_PIECE else (p,))]
    code = np.fromiter(map(_codes.__getitem__, pieces), np.int64, len(pieces))
    word, shape = code & 0xFFFF, code >> 16 & 0xFFFF
    table = np.empty((len(code), 3), np.int64)
    table[:, 0] = np.where(word > 0, word, -1)
    table[:, 1] = np.where(shape > 0, shape, -1)
    table[:, 2] = -1
    table[1:, 2][code[1:] == code[:-1]] = REPEAT
    flat = table.ravel()
    return flat[flat >= 0]


def index_vectors(dims: int = DIMS) -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of each bucket's non-zero components."""
    rng = np.random.default_rng(20_240_501)
    places = np.argsort(rng.random((BUCKETS, dims)), axis=1)[:, :NONZERO]
    return places.astype(np.int64), rng.choice(np.asarray([-1, 1], np.int64), (BUCKETS, NONZERO))


# --- word vectors over the corpus -------------------------------------------------------------


def word_vectors(docs: DataFrame, text: str) -> np.ndarray:
    """Unit vector of each bucket, from all rows. ``BUCKETS * DIMS`` numbers reach the driver, whatever the corpus."""
    text_batches(docs.sparkSession)
    block = 128  # buckets to a row of partial sums

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        places, signs = index_vectors()
        sums = np.zeros(BUCKETS * DIMS, np.int64)

        def add(ids: np.ndarray, doc: np.ndarray) -> None:
            for step in range(1, REACH + 1):
                same = doc[step:] == doc[:-step]
                left, right = ids[:-step][same], ids[step:][same]
                for a, b in ((left, right), (right, left)):
                    for k in range(NONZERO):
                        flat = a * DIMS + places[b, k]
                        sums[:] += np.bincount(flat, weights=signs[b, k], minlength=len(sums)).astype(np.int64)

        for batch in batches:
            held, size = [], 0
            for value in batch["text"]:
                held.append(tokens(value))
                size += len(held[-1])
                if size >= 4 * CHUNK:
                    add(np.concatenate(held), np.repeat(np.arange(len(held)), [len(h) for h in held]))
                    held, size = [], 0
            if held:
                add(np.concatenate(held), np.repeat(np.arange(len(held)), [len(h) for h in held]))
        table = sums.reshape(-1, block * DIMS)
        part = TaskContext.get().partitionId() // TASKS
        yield pd.DataFrame({"block": np.arange(len(table)), "part": part, "sums": [row.tobytes() for row in table]})

    def total(rows: pd.DataFrame) -> pd.DataFrame:
        out = sum((np.frombuffer(b, np.int64) for b in rows["sums"]), np.zeros(block * DIMS, np.int64))
        return pd.DataFrame({"block": [rows["block"].iloc[0]], "part": [rows["part"].iloc[0]], "sums": [out.tobytes()]})

    # tasks' sums are added in two steps, so that no group holds a row of every task
    schema = "block int, part int, sums binary"
    counted = docs.select(F.col(f"`{text}`").alias("text")).mapInPandas(count, schema)
    counted = counted.groupBy("block", "part").applyInPandas(total, schema)
    context = np.zeros((BUCKETS // block, block * DIMS))
    for row in counted.groupBy("block").applyInPandas(total, schema).collect():
        context[row.block] = np.frombuffer(row.sums, np.int64)
    context = context.reshape(BUCKETS, DIMS)
    places, signs = index_vectors()
    own = np.zeros((BUCKETS, DIMS))
    np.put_along_axis(own, places, signs / np.sqrt(NONZERO), axis=1)
    vectors = own + _unit(context)
    return _unit(vectors).astype(np.float32)


def _unit(rows: np.ndarray) -> np.ndarray:
    norms = np.sqrt((rows**2).sum(1, keepdims=True))
    return np.divide(rows, norms, out=np.zeros_like(rows, dtype=np.float64), where=norms > 0)


def pool(texts, vectors: np.ndarray) -> np.ndarray:
    """Mean vector of each text; texts without tokens are at 0."""
    out = np.zeros((len(texts), vectors.shape[1]))
    for i, value in enumerate(texts):
        ids = tokens(value)
        for at in range(0, len(ids), CHUNK):
            out[i] += vectors[ids[at : at + CHUNK]].sum(0, dtype=np.float64)
        if len(ids):
            out[i] /= len(ids)
    return out


# --- the network ------------------------------------------------------------------------------


@dataclass
class Network:
    """``tanh`` layer and a linear one; the logit is divided by ``temperature``."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -60, 60)))


def fit_network(x: np.ndarray, y: np.ndarray, epochs: int = 60, rate: float = 0.01, decay: float = 1e-4, seed: int = 7) -> Network:
    """Adam on the log loss in batches of 64. With no rows, or one class only, the network tells the smoothed rate."""
    rng = np.random.default_rng(seed)
    dims = x.shape[1]
    mean, scale = (x.mean(0), x.std(0) + 1e-6) if len(x) else (np.zeros(dims), np.ones(dims))
    prior = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1))) if len(y) else 0.0
    net = Network(mean, scale, rng.normal(0, dims**-0.5, (dims, HIDDEN)), np.zeros(HIDDEN), np.zeros(HIDDEN), prior)
    if len(np.unique(y)) < 2:
        return net
    z = (x - mean) / scale
    net.w2 = rng.normal(0, HIDDEN**-0.5, HIDDEN)
    params = [net.w1, net.b1, net.w2, np.asarray([net.b2])]
    m, v, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for _ in range(epochs):
        order = rng.permutation(len(z))
        for at in range(0, len(order), 64):
            part = order[at : at + 64]
            h = np.tanh(z[part] @ params[0] + params[1])
            p = 1 / (1 + np.exp(-np.clip(h @ params[2] + params[3], -60, 60)))
            g = (p - y[part]) / len(part)
            back = np.outer(g, params[2]) * (1 - h**2)
            grads = [z[part].T @ back + decay * params[0], back.sum(0), h.T @ g + decay * params[2], np.asarray([g.sum()])]
            step += 1
            for i, grad in enumerate(grads):
                m[i] = 0.9 * m[i] + 0.1 * grad
                v[i] = 0.999 * v[i] + 0.001 * grad**2
                params[i] -= rate * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
    net.w1, net.b1, net.w2, net.b2 = params[0], params[1], params[2], float(params[3][0])
    return net


def calibrate(net: Network, x: np.ndarray, y: np.ndarray) -> Network:
    """The temperature with the smallest log loss on rows the network has not seen (1 without such rows)."""
    if len(x):
        logits = net.logits(x)
        grid = np.exp(np.linspace(np.log(0.25), np.log(8), 61))
        losses = [np.mean(np.logaddexp(0, np.where(y == 1, -1, 1) * logits / t)) for t in grid]
        net.temperature = float(grid[int(np.argmin(losses))])
    return net


def train(docs: DataFrame, doc_id: str, text: str, labels: DataFrame, label_id: str, label: str, vectors: np.ndarray, max_rows: int = TRAIN_ROWS) -> Network:
    """Fits on at most ``max_rows`` labelled rows (by hash of the id): nine tenths train, a tenth sets the temperature.

    Null ids and labels other than 0 and 1 are left out. Repeated labels of an id count once, the larger one,
    and so do its rows: the one whose text has the smallest key.
    """
    known = (
        labels.select(F.col(f"`{label_id}`").alias("id"), F.col(f"`{label}`").cast("int").alias("y"))
        .where("id IS NOT NULL AND y IN (0, 1)").groupBy("id").agg(F.max("y").alias("y"))
        .orderBy(F.xxhash64("id"), "id").limit(max_rows)
    )

    def pooled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = pool(batch["text"], vectors).astype(np.float32)
            yield pd.DataFrame({"id": batch["id"], "y": batch["y"], "x": [row.tobytes() for row in x]})

    rows = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text")).join(F.broadcast(known), "id")
    rows = one_each(rows)
    got = sorted(rows.mapInPandas(pooled, "id long, y int, x binary").collect(), key=lambda r: (r.id, r.x))
    x = np.stack([np.frombuffer(r.x, np.float32) for r in got]).astype(np.float64) if got else np.zeros((0, vectors.shape[1]))
    y = np.asarray([r.y for r in got], dtype=np.float64)
    kept = np.asarray([zlib.crc32(b"%d" % r.id) % 10 == 7 for r in got], dtype=bool)
    return calibrate(fit_network(x[~kept], y[~kept]), x[kept], y[kept])


def score(docs: DataFrame, text: str, vectors: np.ndarray, net: Network, into: str = "quality") -> DataFrame:
    """All rows and columns of ``docs`` plus the probability of label 1 as ``into`` (replaced if there).

    Null and empty texts are scored at the origin; repeated rows stay and score alike.
    """
    text_batches(docs.sparkSession)

    @F.pandas_udf("double")
    def probability(column: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for values in column:
            yield pd.Series(net.probabilities(pool(values, vectors)))

    return docs.withColumn(into, probability(F.col(f"`{text}`")))


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """Whether the row is kept from training: CRC-32 of the id as text, modulo ``folds``, is 0. Null ids are."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(True))
