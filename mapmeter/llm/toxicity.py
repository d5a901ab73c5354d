"""Toxicity by a classifier chain.

Linear models predict the categories one after the other; each sees the text's features and the probabilities of the
categories before it. In training those probabilities are out-of-fold predictions, so a model learns from what its
predecessors will tell about texts they have not seen: the features, too, are chosen anew without each fold.

Features are words and beginnings of words that labelled rows show to tell the first category apart, found by counting
them over the labelled sample in Spark.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mapmeter.llm.common import one_each, settle, text_batches, words

TRAIN_ROWS = 20_000  # labelled rows a chain is fitted on, at most
FEATURES = 2_048
LEAST = 3  # labelled documents a feature must stand in
PREFIXES = (4, 5, 6, 7)
FOLDS = 3
CATEGORIES = ("toxic", "severe", "pervasive")


# --- labels -----------------------------------------------------------------------------------


def sample(docs: DataFrame, doc_id: str, text: str, labels: DataFrame, label_id: str, label: str, max_rows: int = TRAIN_ROWS) -> DataFrame:
    """``id, y, text`` of at most ``max_rows`` labelled ids (by hash).

    Null ids and labels other than 0 and 1 are left out; repeated labels of an id count once, the larger one,
    and so do its rows: the one whose text has the smallest key.
    """
    known = (
        labels.select(F.col(f"`{label_id}`").alias("id"), F.col(f"`{label}`").cast("int").alias("y"))
        .where("id IS NOT NULL AND y IN (0, 1)").groupBy("id").agg(F.max("y").alias("y"))
        .orderBy(F.xxhash64("id"), "id").limit(max_rows)
    )
    rows = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text")).join(F.broadcast(known), "id")
    return settle(one_each(rows), "labelled")


def fold_of(row_id: Column) -> Column:
    """In which fold a row's prediction is made: by the CRC-32 of its id, so all rows of an id are in one."""
    return (F.crc32(F.concat(F.lit("fold"), row_id.cast("string")).cast("binary")) % FOLDS).cast("int")


def telling_features(labelled: DataFrame, limit: int = FEATURES) -> list[dict[str, float]]:
    """The ``limit`` features whose log-odds stand out most from chance, with those log-odds: of all rows first, then of
    all rows but those of each fold, so that a fold's predictions know nothing of its labels.

    Features are ``=word`` and ``^beginning``. Without rows of both labels there are none. Each feature's documents are
    counted once, by label and fold.
    """
    labelled = labelled.withColumn("fold", fold_of(F.col("id")))
    totals = {(r.y, r.fold): r.n for r in labelled.groupBy("y", "fold").agg(F.count(F.lit(1)).alias("n")).collect()}
    w = F.array_distinct(words(F.col("text")))
    marks = F.concat(F.transform(w, lambda x: F.concat(F.lit("="), x)), *[F.transform(F.filter(w, lambda x, n=n: F.length(x) > n), lambda x, n=n: F.concat(F.lit("^"), F.substring(x, 1, n))) for n in PREFIXES])
    counts = [F.count_if((F.col("y") == y) & (F.col("fold") == f)).alias(f"c{y}{f}") for y in (0, 1) for f in range(FOLDS)]
    counted = labelled.select("y", "fold", F.explode(F.array_distinct(marks)).alias("mark")).groupBy("mark").agg(*counts)
    counted = settle(counted.where(sum((F.col(f"c{y}{f}") for y in (0, 1) for f in range(FOLDS)), F.lit(0)) >= LEAST), "features")
    out = []
    for left_out in (None, *range(FOLDS)):
        used = [f for f in range(FOLDS) if f != left_out]
        rows = [sum(totals.get((y, f), 0) for f in used) for y in (0, 1)]
        if not all(rows):
            out.append({})
            continue
        n, t = (sum((F.col(f"c{y}{f}") for f in used), F.lit(0)) for y in (0, 1))
        odds = F.log((t + 0.5) / (rows[1] + 1)) - F.log((n + 0.5) / (rows[0] + 1))
        z = odds / F.sqrt(1 / (t + 0.5) + 1 / (n + 0.5))
        kept = counted.where(t + n >= LEAST).select("mark", odds.alias("odds"), z.alias("z"))
        out.append({r.mark: r.odds for r in kept.orderBy(F.desc(F.abs("z")), "mark").limit(limit).collect()})
    return out


# --- features of a text -----------------------------------------------------------------------

_GAP = str.maketrans({chr(i): " " for i in range(128) if not chr(i).isalnum()})
_LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


class Reader:
    """Counts of the chosen features in a text."""

    def __init__(self, features: dict[str, float]):
        self.index = {mark: i for i, mark in enumerate(features)}
        self.odds = np.asarray(list(features.values()))
        self.known: dict[str, tuple[int, ...]] = {}

    def _find(self, word: str) -> tuple[int, ...]:
        if len(self.known) > 200_000:
            self.known.clear()
        marks = ["=" + word] + ["^" + word[:n] for n in PREFIXES if len(word) > n]
        self.known[word] = out = tuple(self.index[m] for m in marks if m in self.index)
        return out

    def __call__(self, text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Features (ascending), their weights ((1 + log of the count) x log-odds), and where strongly toxic words are.

        The last place is the number of words. Log-odds as a scale let a few telling words outweigh many dull ones.
        """
        counts: dict[int, int] = {}
        places = []
        listed = (text or "").translate(_GAP).translate(_LOWER).split(" ")
        known = self.known
        at = 0
        for word in listed:
            if not word:
                continue
            found = known.get(word)
            if found is None:
                found = self._find(word)
            if found:
                for f in found:
                    counts[f] = counts.get(f, 0) + 1
                if max(self.odds[f] for f in found) > 3:
                    places.append(at)
            at += 1
        index = np.asarray(sorted(counts), np.int64)
        return index, (1 + np.log(np.asarray([counts[i] for i in index.tolist()], float))) * self.odds[index], np.asarray([*places, at])


def _derived(y: int, places: np.ndarray) -> tuple[float, int]:
    """Rate of strongly toxic words of a toxic text, and the number of its quarters that hold one."""
    if not y or len(places) < 2:
        return 0.0, 0
    hits, count = places[:-1], max(1, int(places[-1]))
    return len(hits) / count, len(np.unique(4 * hits // count))


# --- the chain --------------------------------------------------------------------------------


@dataclass
class Rows:
    """Sparse rows, one behind the other."""

    starts: np.ndarray
    index: np.ndarray
    value: np.ndarray
    dims: int

    def times(self, w: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0.0], np.cumsum(self.value * w[self.index])])
        return sums[self.starts[1:]] - sums[self.starts[:-1]]

    def back(self, r: np.ndarray) -> np.ndarray:
        each = np.repeat(r, np.diff(self.starts))
        return np.bincount(self.index, weights=self.value * each, minlength=self.dims)

    def take(self, which: np.ndarray) -> Rows:
        sizes = np.diff(self.starts)[which]
        at = np.concatenate([np.arange(self.starts[i], self.starts[i + 1]) for i in which]) if len(which) else np.zeros(0, int)
        return Rows(np.concatenate([[0], np.cumsum(sizes)]), self.index[at], self.value[at], self.dims)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


@dataclass
class Linear:
    """Weights of the text's features, of earlier categories' probabilities, and a constant."""

    text: np.ndarray
    earlier: np.ndarray
    bias: float

    def probabilities(self, rows: Rows, earlier: np.ndarray) -> np.ndarray:
        return _sigmoid(rows.times(self.text) + earlier @ self.earlier + self.bias)


def fit_linear(rows: Rows, earlier: np.ndarray, y: np.ndarray, steps: int = 120, decay: float = 1e-4) -> Linear:
    """Logistic regression by accelerated gradient steps. With one class only, the smoothed rate."""
    n = len(y)
    bias = float(np.log((y.sum() + 1) / (n - y.sum() + 1)))
    model = Linear(np.zeros(rows.dims), np.zeros(earlier.shape[1]), bias)
    if len(np.unique(y)) < 2:
        return model
    # a step that the curvature of the log loss allows
    norms = np.asarray([1.0 + s for s in np.bincount(np.repeat(np.arange(n), np.diff(rows.starts)), weights=rows.value**2, minlength=n)]) + (earlier**2).sum(1)
    rate = 4.0 / max(1e-9, float(np.mean(norms)) + float(np.max(norms)) / 20)
    params = [model.text, model.earlier, np.asarray([bias])]
    ahead, last = [p.copy() for p in params], [p.copy() for p in params]
    for step in range(1, steps + 1):
        r = (_sigmoid(rows.times(ahead[0]) + earlier @ ahead[1] + ahead[2]) - y) / n
        grads = [rows.back(r) + decay * ahead[0], earlier.T @ r, np.asarray([r.sum()])]
        params = [a - rate * g for a, g in zip(ahead, grads, strict=True)]
        ahead = [p + (step - 1) / (step + 2) * (p - q) for p, q in zip(params, last, strict=True)]
        last = params
    return Linear(params[0], params[1], float(params[2][0]))


@dataclass
class Chain:
    features: dict[str, float]
    categories: tuple[str, ...]
    models: list[Linear] = field(default_factory=list)
    thresholds: list[float] = field(default_factory=list)  # of each category, best on out-of-fold predictions

    def probabilities(self, rows: Rows) -> np.ndarray:
        """One column per category, in order."""
        out = np.zeros((len(rows.starts) - 1, 0))
        for model in self.models:
            out = np.column_stack([out, model.probabilities(rows, out)])
        return out


def fit_chain(
    rows: Rows, targets: np.ndarray, folds: np.ndarray, features: dict[str, float], categories: Sequence[str], without: Sequence[Rows] | None = None
) -> Chain:
    """``targets`` has a column per category; ``folds`` says in which fold each row's prediction is made. ``without``
    holds all rows as the features see them that were chosen without each fold (else they are the same for all)."""
    chain = Chain(features, tuple(categories))
    earlier = np.zeros((len(targets), 0))
    for c in range(targets.shape[1]):
        y = targets[:, c]
        chain.models.append(fit_linear(rows, earlier, y))
        unseen = np.zeros(len(y))
        for fold in range(FOLDS):
            other, own = np.flatnonzero(folds != fold), np.flatnonzero(folds == fold)
            if len(own):
                blind = without[fold] if without is not None else rows
                model = fit_linear(blind.take(other), earlier[other], y[other]) if len(other) else Linear(np.zeros(blind.dims), np.zeros(earlier.shape[1]), 0.0)
                unseen[own] = model.probabilities(blind.take(own), earlier[own])
        earlier = np.column_stack([earlier, unseen])
        chain.thresholds.append(best_threshold(unseen, y))
    return chain


def best_threshold(probability: np.ndarray, y: np.ndarray) -> float:
    """The middle of the range of thresholds with the best F1 (0.5 without rows of both kinds)."""
    if len(np.unique(y)) < 2:
        return 0.5
    grid = np.linspace(0.05, 0.95, 91)
    hits = np.asarray([((probability >= t) & (y == 1)).sum() for t in grid])
    f1 = 2 * hits / (np.asarray([(probability >= t).sum() for t in grid]) + y.sum())
    return float(np.median(grid[f1 == f1.max()]))


def _rows(parts: list[tuple[np.ndarray, np.ndarray]], dims: int) -> Rows:
    starts = np.concatenate([[0], np.cumsum([len(i) for i, _ in parts])]).astype(np.int64)
    empty = np.zeros(0)
    index = np.concatenate([i for i, _ in parts]) if parts else empty
    value = np.concatenate([v for _, v in parts]) if parts else empty
    return Rows(starts, index.astype(np.int64), value, dims)


def train(docs: DataFrame, doc_id: str, text: str, labels: DataFrame, label_id: str, label: str, max_rows: int = TRAIN_ROWS) -> Chain:
    """A chain for :data:`CATEGORIES`, from a binary label.

    ``toxic`` is the label; ``severe`` marks toxic rows whose rate of strongly toxic words is above the toxic rows'
    median, ``pervasive`` those with such words in at least three quarters of the text. These two are made of the label
    and the text, as the tables hold one label only: they tell how a text is toxic, not a second opinion on it. Without
    labelled rows of both kinds the chain tells the smoothed rates. Ids may be of any type; null ones are left out.

    Out-of-fold predictions, which later models and the thresholds are fitted on, are made with features that were
    chosen and weighed without the fold.
    """
    text_batches(docs.sparkSession)
    labelled = sample(docs, doc_id, text, labels, label_id, label, max_rows)
    choices = telling_features(labelled)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        readers = [Reader(features) for features in choices]
        for batch in batches:
            rows = []
            for key, fold, y, value in zip(batch["id"], batch["fold"], batch["y"], batch["text"], strict=True):
                seen = [reader(value) for reader in readers]
                rate, quarters = _derived(y, seen[0][2])
                packed = [np.asarray([len(i) for i, _, _ in seen], np.int32)]
                packed += [part for index, weights, _ in seen for part in (index.astype(np.int32), weights.astype(np.float32))]
                rows.append((key, fold, y, b"".join(p.tobytes() for p in packed), rate, quarters))
            yield pd.DataFrame(rows, columns=["id", "fold", "y", "seen", "rate", "quarters"])

    rows = labelled.select(F.col("id").cast("string").alias("id"), fold_of(F.col("id")).alias("fold"), "y", "text")
    got = rows.mapInPandas(read, "id string, fold int, y int, seen binary, rate double, quarters int").collect()
    got.sort(key=lambda r: (r.id, r.seen))
    views: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in choices]
    for r in got:
        sizes, at = np.frombuffer(r.seen, np.int32, len(choices)).tolist(), 4 * len(choices)
        for view, n in zip(views, sizes, strict=True):
            index = np.frombuffer(r.seen, np.int32, n, at).astype(np.int64)
            view.append((index, np.frombuffer(r.seen, np.float32, n, at + 4 * n).astype(float)))
            at += 8 * n
    whole, *without = [_rows(view, max(1, len(features))) for view, features in zip(views, choices, strict=True)]
    y = np.asarray([r.y for r in got], float)
    rates = np.asarray([r.rate for r in got], float)
    middle = float(np.median(rates[y == 1])) if (y == 1).any() else 0.0
    severe = ((y == 1) & (rates > middle)).astype(float)
    pervasive = ((y == 1) & (np.asarray([r.quarters for r in got], float) >= 3)).astype(float)
    folds = np.asarray([r.fold for r in got], dtype=np.int64)
    return fit_chain(whole, np.column_stack([y, severe, pervasive]), folds, choices[0], CATEGORIES, without)


def score(docs: DataFrame, text: str, chain: Chain, into: str = "toxicity") -> DataFrame:
    """All rows and columns of ``docs`` plus a struct ``into`` (replaced if there) with a probability per category.

    Null and empty texts have no features; repeated rows stay and score alike; whole texts are read, however long.
    """
    text_batches(docs.sparkSession)

    @F.pandas_udf(", ".join(f"{c} double" for c in chain.categories))
    def predict(column: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        reader = Reader(chain.features)
        for values in column:
            rows = _rows([reader(v)[:2] for v in values], max(1, len(chain.features)))
            yield pd.DataFrame(chain.probabilities(rows), columns=list(chain.categories))

    return docs.withColumn(into, predict(F.col(f"`{text}`")))
