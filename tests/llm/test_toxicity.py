import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from mapmeter.llm import toxicity
from tests.llm.conftest import LONG

R = random.Random(9)
BAD = ["blargh", "vexo", "vexima", "vexuno", "grumf"]


def text(toxic):
    words = ["".join(R.choice("abcdefg") for _ in range(4)) for _ in range(R.randint(15, 60))]
    if toxic:
        for _ in range(R.randint(2, 4)):
            words[R.randrange(len(words))] = R.choice(BAD)
    return " ".join(words)


@pytest.fixture(scope="module")
def corpus(frame):
    rows = [(i, text(i % 5 == 0)) for i in range(700)]
    rows += [(2_000, None), (2_001, ""), (2_002, LONG), (2_003, LONG + "Vexo grumf blargh"), (None, text(True)), (5, rows[5][1])]
    docs = frame([(*r, 1, 2.0, "x") for r in rows], "doc_id long, text string, y int, toxic double, marks string")
    labels = frame([(i, int(i % 5 == 0)) for i in range(500)] + [(None, 1), (2, None), (3, 7), (10, 0), (9_999, 1)], "doc_id long, toxic int")
    return docs, labels


def test_held_out_accuracy(corpus):
    docs, labels = corpus
    chain = toxicity.train(docs, "doc_id", "text", labels, "doc_id", "toxic")
    out = toxicity.score(docs, "text", chain)
    assert out.columns == [*docs.columns, "toxicity"]
    rows = out.select("doc_id", "toxicity.*").collect()
    assert len(rows) == docs.count() and all(0 <= r[c] <= 1 for r in rows for c in toxicity.CATEGORIES)
    cut = chain.thresholds[0]
    unseen = [r for r in rows if r.doc_id is not None and 500 <= r.doc_id < 700]
    assert np.mean([(r.toxic >= cut) == (r.doc_id % 5 == 0) for r in unseen]) > 0.97
    by = {r.doc_id: r for r in rows}
    assert by[2_003].toxic > by[2_002].toxic and by[2_001].toxic < cut and by[2_000].toxic == by[2_001].toxic
    assert len({r.toxic for r in rows if r.doc_id == 5}) == 1


def test_later_models_use_earlier_probabilities():
    rng = np.random.default_rng(1)
    n = 900
    sign = rng.integers(0, 2, n)
    rows = toxicity.Rows(np.arange(n + 1), sign, np.ones(n), 2)
    first = sign.astype(float)
    second = first * (rng.random(n) < 0.9)
    chain = toxicity.fit_chain(rows, np.column_stack([first, second]), np.arange(n) % toxicity.FOLDS, {"=a": 1.0, "=b": 1.0}, ("one", "two"))
    p = chain.probabilities(rows)
    assert p.shape == (n, 2) and chain.models[1].earlier[0] > 0.1 and len(chain.models[0].earlier) == 0
    assert p[first == 1].min() > p[first == 0].max()


def test_out_of_fold_models_do_not_see_their_rows(monkeypatch):
    seen = []
    real = toxicity.fit_linear

    def spy(rows, earlier, y, **more):
        seen.append(len(y))
        return real(rows, earlier, y, **more)

    monkeypatch.setattr(toxicity, "fit_linear", spy)
    rows = toxicity.Rows(np.arange(31), np.zeros(30, int), np.ones(30), 1)
    toxicity.fit_chain(rows, np.column_stack([np.arange(30) % 2.0] * 2), np.arange(30) % 3, {"=a": 1.0}, ("one", "two"))
    assert seen == [30, 20, 20, 20] * 2


def test_sparse_rows_and_fit():
    rng = np.random.default_rng(2)
    dense = (rng.random((200, 6)) < 0.4) * rng.random((200, 6))
    at = [np.flatnonzero(r) for r in dense]
    rows = toxicity.Rows(np.concatenate([[0], np.cumsum([len(a) for a in at])]), np.concatenate(at), dense[dense != 0], 6)
    w, r = rng.random(6), rng.random(200)
    assert np.allclose(rows.times(w), dense @ w) and np.allclose(rows.back(r), dense.T @ r)
    part = np.asarray([5, 3, 77])
    assert np.allclose(rows.take(part).times(w), dense[part] @ w)
    y = (dense[:, 0] > 0.2).astype(float)
    model = toxicity.fit_linear(rows, np.zeros((200, 0)), y, steps=400)
    assert np.mean((model.probabilities(rows, np.zeros((200, 0))) > 0.5) == y) > 0.9


def test_nothing_to_learn_from(frame):
    docs = frame([(1, "a b"), (2, "c d")], "doc_id long, text string")
    for labels in (frame([], "doc_id long, toxic int"), frame([(1, 0)], "doc_id long, toxic int")):
        chain = toxicity.train(docs, "doc_id", "text", labels, "doc_id", "toxic")
        assert chain.features == {} and chain.thresholds[0] == 0.5
        assert toxicity.score(docs, "text", chain).where(F.col("toxicity.toxic") <= 0.5).count() == 2
    assert toxicity.score(frame([], docs.schema), "text", chain).count() == 0


def test_an_id_is_sampled_once(frame):
    docs = frame([(1, "b text"), (1, "a text"), (1, "b text"), (2, None), (2, None), (3, "c")], "doc_id long, text string")
    labels = frame([(1, 1), (2, 0)], "doc_id long, toxic int")
    rows = toxicity.sample(docs, "doc_id", "text", labels, "doc_id", "toxic").collect()
    assert sorted((r.id, r.y) for r in rows) == [(1, 1), (2, 0)]
    again = toxicity.sample(docs.repartition(5), "doc_id", "text", labels, "doc_id", "toxic").collect()
    assert sorted(rows) == sorted(again)


def test_words_of_one_fold_do_not_reach_its_predictions(frame):
    rows = [(i, f"common words here mark{i % 2}x " + ("secret" if i % 2 else "other")) for i in range(120)]
    docs = frame(rows, "id long, text string")
    fold = {r.id: r.f for r in docs.select("id", toxicity.fold_of(F.col("id")).alias("f")).collect()}
    assert set(fold.values()) == set(range(toxicity.FOLDS))
    only = [(i, t + (" blargh" if fold[i] == 1 and i % 2 else ""), i % 2) for i, t in rows]
    whole, *without = toxicity.telling_features(frame(only, "id long, text string, y int"))
    assert "=blargh" in whole and "=blargh" in without[0] and "=blargh" not in without[1] and "=blargh" in without[2]
    # counted by hand, without fold 0
    kept = [(t, y) for i, t, y in only if fold[i] != 0]
    toxic = sum(y for _, y in kept)
    t, n = sum(y for x, y in kept if "secret" in x), sum(1 - y for x, y in kept if "secret" in x)
    assert without[0]["=secret"] == pytest.approx(np.log((t + 0.5) / (toxic + 1)) - np.log((n + 0.5) / (len(kept) - toxic + 1)))


def test_out_of_fold_accuracy_tells_the_truth(frame):
    """Random words with coin-toss labels: nothing to learn, and the predictions that thresholds are chosen on say so."""
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice("abcdefgh") + rng.choice("abcdefgh") + rng.choice("abcd") for _ in range(30)), rng.randrange(2)) for i in range(900)]
    docs = frame([(str(i), t) for i, t, _ in rows], "id string, text string")
    labels = frame([(str(i), y) for i, _, y in rows], "id string, toxic int")
    seen = []
    real = toxicity.best_threshold
    toxicity.best_threshold = lambda p, y: seen.append((p, y)) or real(p, y)
    try:
        toxicity.train(docs, "id", "text", labels, "id", "toxic")
    finally:
        toxicity.best_threshold = real
    p, y = seen[0]
    assert len(p) == 900 and abs(np.mean((p > 0.5) == (y == 1)) - 0.5) < 0.08
