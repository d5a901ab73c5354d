import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from mapmeter.llm import quality
from tests.llm.conftest import LONG

R = random.Random(3)
WORDS = [R.choice("bcdfgl") + R.choice("aeiou") + R.choice("mnrst") + R.choice("aeiou") for _ in range(80)]


def good():
    return " ".join(R.choice(WORDS) for _ in range(R.randint(5, 60))).capitalize() + "."


def junk():
    kind = R.randrange(3)
    if kind == 0:
        return " ".join(w.upper() + "!!" for w in good().split())
    if kind == 1:
        return " ".join(w + "%%%" for w in good().split())
    return " ".join(w for w in good().split() for _ in range(6))


@pytest.fixture(scope="module")
def corpus(frame):
    rows = [(i, good() if i % 4 else junk()) for i in range(900)]
    rows += [(2_000, None), (2_001, ""), (2_002, LONG), (None, good()), (7, rows[7][1])]
    docs = frame([(*r, "en", 1.0, 2) for r in rows], "doc_id long, text string, lang string, score double, y int")
    labels = frame([(i, int(i % 4 > 0)) for i in range(900)] + [(None, 1), (3, None), (5, 9), (6, 1), (6, 0), (8, 0), (9_999, 1)], "doc_id long, quality int")
    return docs, labels


def test_held_out_accuracy(corpus):
    docs, labels = corpus
    vectors = quality.word_vectors(docs, "text")
    learn = labels.where(~quality.held_out(F.col("doc_id")))
    net = quality.train(docs, "doc_id", "text", learn, "doc_id", "quality", vectors)
    out = quality.score(docs, "text", vectors, net, "score")
    assert sorted(out.columns) == sorted(docs.columns) and out.count() == docs.count()
    rows = out.select("doc_id", "score", quality.held_out(F.col("doc_id")).alias("h")).collect()
    assert all(0 <= r.score <= 1 for r in rows)
    unseen = [r for r in rows if r.h and r.doc_id is not None and r.doc_id < 900]
    assert len(unseen) > 100
    assert np.mean([(r.score >= 0.3) == bool(r.doc_id % 4) for r in unseen]) > 0.95
    assert len({r.score for r in rows if r.doc_id == 7}) == 1  # repeated rows score alike


def test_word_vectors_against_a_plain_count(frame, monkeypatch):
    texts = ["a b c a", "b b, c!!", None, "", "x"]
    places, signs = quality.index_vectors()
    sums = np.zeros((quality.BUCKETS, quality.DIMS))
    for t in texts:
        ids = quality.tokens(t)
        for i in range(len(ids)):
            for j in range(max(0, i - quality.REACH), min(len(ids), i + quality.REACH + 1)):
                if i != j:
                    sums[ids[i], places[ids[j]]] += signs[ids[j]]
    own = np.zeros_like(sums)
    np.put_along_axis(own, places, signs / np.sqrt(quality.NONZERO), axis=1)
    want = quality._unit(own + quality._unit(sums))
    got = quality.word_vectors(frame([(t,) for t in texts], "text string"), "text")
    assert np.allclose(got, want, atol=1e-6)


@pytest.mark.parametrize("start", ["天地玄黃宇宙洪荒" * 40, "QUJDREVGRw0K+/" * 30, "ภาษาไทยไม่มีวรรค" * 30, "f(a){b+=c_1;}" * 40, "x" * 400])
def test_texts_without_spaces_count_to_their_end(start):
    tokens = [quality.tokens(start + end).tolist() for end in ("", "海鹹河淡", "0123", "%%$$", "junkjunk")]
    assert len({*map(tuple, tokens)}) == len(tokens)
    more = quality.tokens(start + "海鹹河淡鱗潛羽翔" * 5_000)
    assert len(more) > 15_000 > 3 * len(tokens[0])
    assert "".join(quality._CHUNK.findall(start + "é_²٣ก्\u0301")) == start + "é_²٣ก्\u0301"
    vectors = np.random.default_rng(1).normal(size=(quality.BUCKETS, 3))
    one, other = quality.pool([start + "海" * 2_000, start + "鹹" * 2_000], vectors)
    assert not np.allclose(one, other)


def test_an_id_is_fitted_once(frame, monkeypatch):
    docs = frame([(i % 3, f"text {i}") for i in range(30)], "doc_id long, text string")
    labels = frame([(i, i % 2) for i in range(3)], "doc_id long, quality int")
    sizes, fit, tune = [], quality.fit_network, quality.calibrate
    monkeypatch.setattr(quality, "fit_network", lambda x, y: sizes.append(len(x)) or fit(x, y))
    monkeypatch.setattr(quality, "calibrate", lambda net, x, y: sizes.append(len(x)) or tune(net, x, y))
    quality.train(docs, "doc_id", "text", labels, "doc_id", "quality", np.ones((quality.BUCKETS, 2), np.float32))
    assert sum(sizes) == 3


def test_nothing_to_learn_from(frame):
    docs = frame([(1, "some words")], "doc_id long, text string")
    none = frame([], "doc_id long, quality int")
    vectors = quality.word_vectors(frame([], "doc_id long, text string"), "text")
    for labels, want in ((none, 0.5), (frame([(1, 1)], "doc_id long, quality int"), 2 / 3)):
        net = quality.train(docs, "doc_id", "text", labels, "doc_id", "quality", vectors)
        assert quality.score(docs, "text", vectors, net).first().quality == pytest.approx(want)
    assert quality.score(frame([], docs.schema), "text", vectors, net).count() == 0


def test_gradients_and_temperature():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, 4))
    y = ((x[:, 0] * x[:, 1] > 0) ^ (rng.random(600) < 0.15)).astype(float)  # not linear, with noise
    net = quality.fit_network(x[:400], y[:400], epochs=150)
    assert np.mean((net.logits(x[:400]) > 0) == (y[:400] == 1)) > 0.8
    before = np.mean(np.logaddexp(0, np.where(y[400:] == 1, -1, 1) * net.logits(x[400:])))
    quality.calibrate(net, x[400:], y[400:])
    p = net.probabilities(x[400:])
    assert -np.mean(np.log(np.where(y[400:] == 1, p, 1 - p))) <= before
