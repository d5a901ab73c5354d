"""Quality rules learned as a decision list over a text's statistics.

Every text is read once for its statistics. On those of a bounded sample of labelled rows, sequential covering learns
an ordered list of conjunctions of thresholds: a rule grows on one part of the rows, by the threshold with the largest
information gain, until it covers bad rows only; it is pruned on the other part, from the end, to the conjunction that
does best there; what it covers is taken out and the next rule is learned from the rest. Rules stop where the next one
would not be right often enough on rows that it has not seen. The list comes out as one Spark expression, ``CASE WHEN``
in the order of the rules.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mapmeter.llm.common import one_each, settle

TRAIN_ROWS = 20_000  # labelled rows a list is learned from, at most
MAX_RULES = 24
MAX_TERMS = 4
CUTS = 64  # thresholds tried for a statistic: quantiles of the rows that a rule covers so far
LEAST_RIGHT = 0.9  # of the rows a rule covers among those it was not grown on
LEAST_ROWS = 4  # bad rows that a rule must cover in all

# --- fixed values, given by the result contract
SPACE = " \t\n\v\f\r"
SYMBOLS = "#*$%&|<>"
LEAST_WORDS = 50
MOST_REPEATED = 50  # per cent of the words

# counts of a text
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_letters", "n_capitals", "n_digits", "n_distinct", "n_next_same", "n_marked", "longest_word")
# what rules are made of: counts, and shares that do not depend on a text's length
SHARES = {
    "chars_per_word": ("word_chars", "n_words"),
    "symbols_per_word": ("n_symbols", "n_words"),
    "dup_lines_share": ("n_dup_lines", "n_lines"),
    "repeat_share": ("n_repeat_words", "n_words"),
    "words_per_line": ("n_words", "n_lines"),
    "letter_share": ("n_letters", "word_chars"),
    "capital_share": ("n_capitals", "n_letters"),
    "digit_share": ("n_digits", "word_chars"),
    "distinct_share": ("n_distinct", "n_words"),
    "next_same_share": ("n_next_same", "n_words"),
    "marked_share": ("n_marked", "n_words"),
}
STATISTICS = (*SHARES, "longest_word", "n_symbols", "n_dup_lines", "n_next_same", "n_words")  # of equal gains the first


# --- statistics of a text ---------------------------------------------------------------------

_LETTER_KIND = np.frombuffer(bytes(1 if chr(c).isdigit() else 2 if chr(c).isupper() else 3 if chr(c).isalpha() else 0 for c in range(128)), np.uint8)


class _Kinds(dict):
    """Code point -> 1 digit, 2 capital, 3 other letter, 0 none of these."""

    def __missing__(self, code: int) -> int:
        c = chr(code)
        self[code] = kind = 1 if c.isdigit() else 2 if c.isupper() else 3 if c.isalpha() else 0
        return kind


_kinds = _Kinds()


def _characters(text: str) -> tuple[int, int, int]:
    """Letters, capitals and digits."""
    counts = np.zeros(4, np.int64)
    step = 1 << 20
    for at in range(0, len(text), step):
        codes = np.frombuffer(text[at : at + step].encode("utf-32-le", "surrogatepass"), "<u4")
        plain = codes < 128
        counts += np.bincount(_LETTER_KIND[codes[plain]], minlength=4)
        for code, n in zip(*np.unique(codes[~plain], return_counts=True), strict=True):
            counts[_kinds[int(code)]] += n
    return int(counts[2] + counts[3]), int(counts[2]), int(counts[1])


def repeat_words(words: np.ndarray, size: int = 3) -> int:
    """Words that stand in a window of ``size`` words found twice or more, the first one included."""
    if len(words) <= size:
        return 0
    # a window's number is its place in the order of all windows, built up word by word
    windows = words
    for step in range(1, size):
        pairs = windows[:-1] * np.int64(len(words) + 1) + words[step:]
        windows = np.unique(pairs, return_inverse=True)[1].astype(np.int64)
    again = np.bincount(windows)[windows] > 1
    covered = np.zeros(len(words), bool)
    for step in range(size):
        covered[step : step + len(again)] |= again
    return int(covered.sum())


def statistics(text: str | None) -> tuple[int, ...]:
    """``COUNTS`` of a whole text; null and empty texts have none of anything."""
    if not text:
        return (0,) * len(COUNTS)
    listed = text.encode("utf-8", "surrogatepass").split()  # bytes split at the six ASCII white spaces, nothing else
    n_words = len(listed)
    word_chars = len(text) - sum(map(text.count, SPACE))
    seen: dict[bytes, int] = {}
    words = np.fromiter((seen.setdefault(w, len(seen)) for w in listed), np.int64, n_words)
    lines: set[str] = set()
    n_lines = n_dup = 0
    for line in text.split("\n"):
        if line.strip(SPACE):
            n_lines += 1
            if line in lines:
                n_dup += 1
            else:
                lines.add(line)
    # words that end in two marks or more, as in "of%%%" or "WAS!!"
    marked_ids = np.fromiter((len(w) > 2 and w[-1] < 128 and w[-2] < 128 and not (w[-1:].isalnum() or w[-2:-1].isalnum()) for w in seen), bool, len(seen))
    return (
        n_words, word_chars, sum(map(text.count, SYMBOLS)), n_dup, repeat_words(words), n_lines, *_characters(text), len(seen),
        int((words[1:] == words[:-1]).sum()), int(marked_ids[words].sum()) if n_words else 0, max(map(len, seen), default=0),
    )


def with_statistics(docs: DataFrame, text: str, into: str = "stats") -> DataFrame:
    """All rows and columns of ``docs`` plus a struct of ``COUNTS`` (long) as ``into`` (replaced if there)."""

    @F.pandas_udf(", ".join(f"{c} long" for c in COUNTS))
    def count(column: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for values in column:
            yield pd.DataFrame([statistics(v) for v in values], columns=list(COUNTS), dtype=np.int64)

    return docs.withColumn(into, count(F.col(f"`{text}`")))


def measures(counts: dict[str, np.ndarray]) -> np.ndarray:
    """``STATISTICS`` from ``COUNTS``, a column each; shares of nothing are 0."""
    columns = []
    for name in STATISTICS:
        if name in SHARES:
            part, whole = (counts[c].astype(float) for c in SHARES[name])
            columns.append(np.divide(part, whole, out=np.zeros(len(part)), where=whole > 0))
        else:
            columns.append(counts[name].astype(float))
    return np.stack(columns, 1) if columns[0].size else np.zeros((0, len(STATISTICS)))


def measure(name: str, stats: str = "stats") -> Column:
    """One of ``STATISTICS`` as a column, equal to :func:`measures`."""
    if name not in SHARES:
        return F.col(f"{stats}.{name}").cast("double")
    part, whole = (F.col(f"{stats}.{c}").cast("double") for c in SHARES[name])
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


# --- the list ---------------------------------------------------------------------------------


@dataclass(frozen=True)
class Term:
    """``statistic >= cut`` or, with ``above`` false, ``statistic < cut``."""

    statistic: str
    above: bool
    cut: float

    def holds(self, x: np.ndarray) -> np.ndarray:
        values = x[:, STATISTICS.index(self.statistic)]
        return values >= self.cut if self.above else values < self.cut

    def column(self, stats: str = "stats") -> Column:
        value = measure(self.statistic, stats)
        return value >= F.lit(self.cut) if self.above else value < F.lit(self.cut)

    def __str__(self) -> str:
        return f"{self.statistic} {'>=' if self.above else '<'} {self.cut:.6g}"


Rule = tuple[Term, ...]


def covers(rule: Rule, x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for term in rule:
        out &= term.holds(x)
    return out


def _information(bad: np.ndarray, good: np.ndarray) -> np.ndarray:
    return np.log2((bad + 1e-9) / (bad + good + 1e-9))


def _best_term(x: np.ndarray, bad: np.ndarray) -> Term | None:
    """The threshold with the largest information gain over the rows at hand: gain in purity times bad rows kept."""
    n_bad, n_good = int(bad.sum()), int((~bad).sum())
    base, best, found = float(_information(np.asarray(n_bad), np.asarray(n_good))), 1e-6, None
    for i, name in enumerate(STATISTICS):
        values = np.sort(np.unique(x[:, i]))
        if len(values) < 2:
            continue
        between = (values[1:] + values[:-1]) / 2
        if len(between) > CUTS:
            # most of them where bad rows end and good ones begin
            wanted = np.quantile(x[bad, i], np.linspace(0, 1, CUTS // 2)).tolist() + np.quantile(x[:, i], np.linspace(0, 1, CUTS // 2)).tolist()
            between = np.unique(between[np.clip(np.searchsorted(between, wanted), 0, len(between) - 1)])
        order = np.argsort(x[:, i], kind="stable")
        at = np.searchsorted(x[order, i], between, "left")  # rows below each cut
        bad_below = np.concatenate([[0], np.cumsum(bad[order])])[at]
        good_below = at - bad_below
        for above, b, g in ((False, bad_below, good_below), (True, n_bad - bad_below, n_good - good_below)):
            gain = np.where(b > 0, b * (_information(b, g) - base), -1)
            top = np.flatnonzero(gain >= gain.max() - 1e-9)
            j = int(top[len(top) // 2])  # the middle of equal cuts, so that neither side is hugged
            if gain[j] > best + 1e-9:
                best, found = float(gain[j]), Term(name, above, float(between[j]))
    return found


def grow(x: np.ndarray, bad: np.ndarray) -> Rule:
    """Terms are added until no good row is covered, nothing is gained, or the rule is long."""
    rule: Rule = ()
    held = np.ones(len(x), bool)
    while len(rule) < MAX_TERMS and (~bad[held]).any() and bad[held].any():
        term = _best_term(x[held], bad[held])
        if term is None:
            break
        rule += (term,)
        held &= term.holds(x)
    return rule


def _worth(rule: Rule, x: np.ndarray, bad: np.ndarray) -> tuple[float, int]:
    held = covers(rule, x)
    b, g = int(bad[held].sum()), int((~bad[held]).sum())
    return ((b - g) / (b + g) if b + g else -1.0), b


def prune(rule: Rule, x: np.ndarray, bad: np.ndarray) -> Rule:
    """The beginning of the rule with the best (bad - good) / (bad + good) on rows it was not grown on; the shortest."""
    return max((rule[:n] for n in range(1, len(rule) + 1)), key=lambda r: (*_worth(r, x, bad), -len(r)), default=())


def learn(x: np.ndarray, bad: np.ndarray, seed: int = 11) -> list[Rule]:
    """Sequential covering: rules for bad rows, in the order in which they are to be tried.

    Before each rule the rows left are dealt anew, two thirds to grow it and a third to prune it. A rule is taken if
    it covers ``LEAST_ROWS`` bad rows and is right for ``LEAST_RIGHT`` of the rows it was not grown on (and of all
    rows left); three in a row that are not end the list. Without rows of both kinds the list is empty.
    """
    rng = np.random.default_rng(seed)
    rules: list[Rule] = []
    left = np.ones(len(x), bool)
    misses = 0
    while len(rules) < MAX_RULES and misses < 3:
        xs, bads = x[left], bad[left]
        if bads.sum() < LEAST_ROWS or bads.all():
            break
        growing = np.zeros(len(xs), bool)
        for kind in (True, False):  # both kinds in the same proportion
            growing[rng.permutation(np.flatnonzero(bads == kind))[: -(-2 * int((bads == kind).sum()) // 3)]] = True
        rule = prune(grow(xs[growing], bads[growing]), xs[~growing], bads[~growing])
        held = covers(rule, xs)
        unseen = held & ~growing
        right = [bads[h].mean() if h.any() else 0.0 for h in (held, unseen)]
        if not rule or bads[held].sum() < LEAST_ROWS or min(right) < LEAST_RIGHT:
            misses += 1  # another deal may do better
            continue
        misses = 0
        rules.append(rule)
        left[np.flatnonzero(left)[held]] = False
    return rules


def verdict(rules: Sequence[Rule], stats: str = "stats") -> Column:
    """Number (from 1) of the first rule that covers a row, null where none does: one ``CASE WHEN``."""
    out = None
    for number, rule in enumerate(rules, 1):
        condition = rule[0].column(stats)
        for term in rule[1:]:
            condition = condition & term.column(stats)
        out = F.when(condition, F.lit(number)) if out is None else out.when(condition, F.lit(number))
    return F.lit(None).cast("int") if out is None else out


def describe(rules: Sequence[Rule]) -> list[str]:
    return [" AND ".join(map(str, rule)) for rule in rules]


# --- over tables ------------------------------------------------------------------------------


def base_failed(stats: str = "stats") -> Column:
    """The fixed rules: too few words, or too many of them in repeated windows."""
    return (F.col(f"{stats}.n_words") < LEAST_WORDS) | (100 * F.col(f"{stats}.n_repeat_words") > MOST_REPEATED * F.col(f"{stats}.n_words"))


def train(docs: DataFrame, doc_id: str, text: str, labels: DataFrame, label_id: str, label: str, max_rows: int = TRAIN_ROWS) -> list[Rule]:
    """Learns from at most ``max_rows`` labelled rows (by hash of the id) that pass the fixed rules; label 0 is bad.

    Null ids and labels other than 0 and 1 are left out. Repeated labels of an id count once, the larger one, and so
    do its rows: the one whose text has the smallest key. Ids may be of any type. Statistics are counted in Spark;
    ``max_rows`` rows of a few numbers reach the driver. No labelled rows give an empty list.
    """
    known = (
        labels.select(F.col(f"`{label_id}`").alias("id"), F.col(f"`{label}`").cast("int").alias("y"))
        .where("id IS NOT NULL AND y IN (0, 1)").groupBy("id").agg(F.max("y").alias("y"))
        .orderBy(F.xxhash64("id"), "id").limit(max_rows)
    )
    rows = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text")).join(F.broadcast(known), "id")
    counted = with_statistics(settle(one_each(rows), "labelled"), "text").where(~base_failed())
    got = counted.select("y", F.col("id").cast("string").alias("id"), "stats.*").toPandas()
    got = got.sort_values("id", key=lambda ids: ids.map(lambda i: zlib.crc32(i.encode())), kind="stable") if len(got) else got
    x = measures({c: got[c].to_numpy(np.int64) for c in COUNTS})
    return learn(x, got["y"].to_numpy() == 0)


def judge(docs: DataFrame, text: str, rules: Sequence[Rule], into: str = "rules") -> DataFrame:
    """All rows and columns of ``docs`` plus a struct ``into`` (replaced if there): ``COUNTS``, ``base_failed``,
    ``rule`` (number of the first learned rule that rejects, null: none) and ``kept``.

    Texts are read whole. Null and empty texts have no words and fail the fixed rules; repeated rows stay and are
    judged alike; an empty table gives none.
    """
    stats = with_statistics(docs, text, into)
    failed = base_failed(into)
    first = verdict(rules, into)
    return stats.withColumn(into, F.struct(f"{into}.*", failed.alias("base_failed"), first.alias("rule"), (~failed & first.isNull()).alias("kept")))
