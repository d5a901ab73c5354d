import os
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from mapmeter.llm import rules
from tests.llm.conftest import LONG

SF = "/root/testdata/sf0.01"


def brute(text):
    """The base counts, each as it is worded."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    repeated = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    earlier, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in earlier
            earlier.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(repeated)


def kinds(text):
    return sum(c.isalpha() and not c.isdigit() for c in text), sum(c.isupper() for c in text), sum(c.isdigit() for c in text)


def random_texts(n):
    r = random.Random(4)
    pool = ["a", "b", "c", "dd", "É", "日本", "x&&&", "|", "\x1f", "\x85", " ", "9", "A<>", "🙂"]
    gaps = [" ", " ", "\n", "\t", "\r\n", "\x0b", "\x0c", "  ", "\n\n"]
    return ["".join(r.choice(pool) + r.choice(gaps) for _ in range(r.randrange(40))) for _ in range(n)]


def test_counts_of_any_text():
    named = ["", None, " ", "\n \n", "a", "a a a a", "a b c a b c", "a b c d a b c", "x\nx\n x\nx", "a\n\na\n", "one two", "ünï çödé ünï çödé ünï"]
    for text in named + random_texts(400):
        got = dict(zip(rules.COUNTS, rules.statistics(text)))
        assert (got["n_words"], got["word_chars"], got["n_symbols"], got["n_dup_lines"], got["n_repeat_words"]) == brute(text), text
        assert (got["n_letters"], got["n_capitals"], got["n_digits"]) == kinds(text or ""), text
    assert brute("a a a a")[4] == 4 and brute("a b c d a b c")[4] == 6


def test_long_texts_take_their_time_once():
    import time

    def took(n):
        start = time.perf_counter()
        got = dict(zip(rules.COUNTS, rules.statistics("thing of the word " * n)))
        assert got["n_words"] == got["n_repeat_words"] == 4 * n
        return time.perf_counter() - start

    took(1_000)
    assert took(400_000) < 60 * took(20_000) + 0.5  # 20 times the words


def rows_of(rng, n, bad, f):
    """Texts of which the bad ones have marks, or shout."""
    out = []
    for _ in range(n):
        words = ["".join(rng.choice(list("abcdefg"), rng.integers(2, 8))) for _ in range(rng.integers(60, 200))]
        if bad:
            words = [f(w) if rng.random() < 0.6 else w for w in words]
        out.append(" ".join(words))
    return out


def sample(seed):
    rng = np.random.default_rng(seed)
    texts = rows_of(rng, 300, False, None) + rows_of(rng, 60, True, lambda w: w + "&&&") + rows_of(rng, 60, True, str.upper)
    bad = np.arange(len(texts)) >= 300
    counted = np.asarray([rules.statistics(t) for t in texts])
    return texts, rules.measures({c: counted[:, i] for i, c in enumerate(rules.COUNTS)}), bad


def test_lists_are_short_and_right_on_rows_not_seen():
    _, x, bad = sample(1)
    learned = rules.learn(x, bad)
    assert 2 <= len(learned) <= 4 and all(1 <= len(r) <= rules.MAX_TERMS for r in learned)
    _, new, truth = sample(2)
    rejected = np.any([rules.covers(r, new) for r in learned], axis=0)
    assert (rejected == truth).mean() > 0.99 and not rejected[~truth].any()


def test_noise_teaches_nothing():
    rng = np.random.default_rng(0)
    x = rng.random((900, len(rules.STATISTICS)))
    learned = rules.learn(x, rng.random(900) < 0.3)
    new = rng.random((900, len(rules.STATISTICS)))
    assert not learned or np.any([rules.covers(r, new) for r in learned], axis=0).mean() < 0.05
    assert rules.learn(x, np.zeros(900, bool)) == [] and rules.learn(x, np.ones(900, bool)) == []
    assert rules.learn(x[:0], np.zeros(0, bool)) == []


def test_pruning_drops_terms_that_only_the_growing_rows_need():
    lengths = []
    for seed in range(30):
        rng = np.random.default_rng(seed)
        x = rng.random((600, len(rules.STATISTICS)))
        noisy = (x[:, 0] > 0.7) ^ (rng.random(600) < 0.03)
        grown = rules.grow(x[:400], noisy[:400])
        pruned = rules.prune(grown, x[400:], noisy[400:])
        worth = [rules._worth(grown[:n], x[400:], noisy[400:])[0] for n in range(1, len(grown) + 1)]
        assert pruned == grown[: len(pruned)] and worth[len(pruned) - 1] == max(worth)
        assert pruned[0].statistic == rules.STATISTICS[0] and abs(pruned[0].cut - 0.7) < 0.05
        lengths.append((len(grown), len(pruned)))
    assert np.mean([g for g, _ in lengths]) > np.mean([p for _, p in lengths]) + 0.5


def test_terms_mean_the_same_in_spark_and_numpy(frame):
    texts, x, _ = sample(5)
    texts = [*texts[::7], "", None, " ", "a", "&"]
    d = rules.with_statistics(frame([(i, t) for i, t in enumerate(texts)], "id int, text string"), "text")
    got = {r.id: r for r in d.select("id", *[rules.measure(s).alias(s) for s in rules.STATISTICS]).collect()}
    counted = np.asarray([rules.statistics(t) for t in texts])
    want = rules.measures({c: counted[:, i] for i, c in enumerate(rules.COUNTS)})
    assert all([got[i][s] for s in rules.STATISTICS] == want[i].tolist() for i in range(len(texts)))
    terms = [rules.Term("symbols_per_word", True, 0.5), rules.Term("capital_share", False, 0.5)]
    listed = [(terms[0], terms[1]), (terms[0],)]
    first = {r.id: r.n for r in d.select("id", rules.verdict(listed).alias("n")).collect()}
    for i in range(len(texts)):
        numbers = [n for n, rule in enumerate(listed, 1) if rules.covers(rule, want[i : i + 1])[0]]
        assert first[i] == (numbers[0] if numbers else None)


def test_learned_and_applied(frame):
    texts, _, bad = sample(6)
    rows = [(f"d{i}", t, None, "x") for i, t in enumerate(texts)] + [("d0", texts[0], "again", "x"), (None, texts[1], None, None), ("e", "", None, None), ("n", None, None, None), ("long", LONG, None, None)]
    docs = frame(rows, "name string, body string, rules string, stats string")
    labels = frame([(f"d{i}", int(not b), i) for i, b in enumerate(bad)] + [("d0", 0, 1), ("d1", None, 2), (None, 0, 3), ("nowhere", 0, 4), ("d2", 7, 5)], "key string, quality int, text int")
    learned = rules.train(docs, "name", "body", labels, "key", "quality")
    assert learned == rules.train(docs.repartition(1), "name", "body", labels, "key", "quality") and learned
    out = rules.judge(docs, "body", learned)
    assert out.columns == docs.columns  # the struct replaces the column of its name
    got = out.select("name", "body", "rules.*").collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute(r.body)
        failed = r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words
        assert r.base_failed == failed and r.kept == (not failed and r.rule is None)
    judged = {r.name: r.kept for r in got}
    assert not judged["e"] and not judged["n"] and not judged["long"]
    assert np.mean([judged[f"d{i}"] == (not b) for i, b in enumerate(bad)]) > 0.98


def test_no_rows(frame):
    docs = frame([], "id long, text string")
    labels = frame([], "id long, quality int")
    assert rules.train(docs, "id", "text", labels, "id", "quality") == []
    assert rules.judge(docs, "text", []).count() == 0
    one = frame([(1, "word " * 60), (2, " ".join(f"w{i}" for i in range(60)))], "id long, text string")
    assert [r.k for r in rules.judge(one, "text", rules.train(one, "id", "text", labels, "id", "quality")).orderBy("id").select(F.col("rules.kept").alias("k")).collect()] == [False, True]


@pytest.mark.skipif(not os.path.isdir(SF), reason="given tables not here")
def test_given_documents(spark):
    from mapmeter.llm.queries import QUERIES

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    got = QUERIES["op13_quality_rules"](spark, SF).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute(texts[r.doc_id])
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) and not (r.base_failed and r.kept)
    told = [(r.kept, labels[r.doc_id]) for r in got if r.doc_id in labels and not r.base_failed]
    assert np.mean([k == (q == 1) for k, q in told]) > 0.95


def test_rules_learned_on_some_documents_hold_on_others(spark):
    if not os.path.isdir(SF):
        pytest.skip("given tables not here")
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    unseen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    learned = rules.train(docs, "doc_id", "text", labels.where(~unseen), "doc_id", "quality")
    got = rules.judge(docs.where(unseen), "text", learned).join(labels, "doc_id").where("NOT rules.base_failed").select("quality", "rules.kept").collect()
    assert len(got) > 20 and np.mean([r.kept == (r.quality == 1) for r in got]) > 0.9
