import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from mapmeter.llm import negatives

SCHEMA = "vec_id long, e array<double>, label int, key long, part string"


def brute(rows, every, factor=256, n_pos=5, n_neg=3):
    ok = {
        (i, g, tuple(math.floor(factor * x) for x in v))
        for i, v, g in rows
        if i is not None and g is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    }
    out = []
    for a, g, v in ok:
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, h) for i, h, w in ok if i != a)
        for p_score, p, _ in [s for s in scored if s[2] == g][:n_pos]:
            fits = [s for s in scored if s[2] != g and 50 * -p_score <= 100 * -s[0] <= 95 * -p_score][:n_neg]
            out += [(a, p, n + 1, i, -p_score, -s) for n, (s, i, _) in enumerate(fits)]
    return sorted(out)


def run(frame, rows, every, **more):
    d = frame([(*r, 7, "x") for r in rows], SCHEMA)
    return sorted(tuple(r) for r in negatives.mine(d, "vec_id", "e", "label", F.col("vec_id") % every == 0, **more).collect())


def clouds(r, n, dims=6, groups=4):
    return [(i, [r.gauss(0.3 * (d == i % groups) + 0.3, 0.15) for d in range(dims)], r.randrange(groups)) for i in range(n)]


@pytest.mark.parametrize("block, anchors", [(6_144, 1_024), (40, 7)])
def test_against_brute_force(frame, monkeypatch, block, anchors):
    monkeypatch.setattr(negatives, "BLOCK", block)
    monkeypatch.setattr(negatives, "ANCHOR_BLOCK", anchors)
    r = random.Random(5)
    rows = clouds(r, 300)
    rows += [(1_000 + i, list(rows[0][1]), i % 2) for i in range(120)]  # one very common vector: ties
    rows += [(900, None, 1), (901, [0.1, None, 0.2, 0.1, 0.1, 0.2], 1), (902, [float("nan")] * 6, 1), (903, [-float("inf")] * 6, 2), (905, [0.5] * 6, None), (None, [0.5] * 6, 1), rows[3], (910, [], 0), (920, [-0.4] * 6, 2)]
    want = brute(rows, 10)
    assert run(frame, rows, 10) == want and len(want) > 200


def test_few_and_none(frame):
    assert run(frame, [], 1) == []
    assert run(frame, [(1, [1.0], 0), (2, [1.0], 1)], 5) == []  # no anchor
    assert run(frame, [(0, [1.0], 0)], 5) == []  # no positive
    assert run(frame, [(0, [1.0], 0), (1, [1.0], 0)], 5) == []  # no negative
    rows = [(0, [1.0, 0.0], 0), (1, [1.0, 0.0], 0), (2, [0.9, 0.0], 1), (3, [0.96, 0.0], 1), (4, [0.4, 0.0], 1)]
    assert run(frame, rows, 5) == brute(rows, 5) == [(0, 1, 1, 2, 65536, 58880)]
    below = [(0, [1.0], 0), (1, [-1.0], 0), (2, [-0.8], 1)]  # a negative score has no band
    assert run(frame, below, 5) == brute(below, 5) == []
    zero = [(0, [1.0, 0.0], 0), (1, [0.0, 1.0], 0), (2, [0.0, 1.0], 1)]  # that of 0 holds 0
    assert run(frame, zero, 5) == brute(zero, 5) == [(0, 1, 1, 2, 0, 0)]


def test_bounds_are_met_exactly(frame):
    rows = [(0, [1.0], 0), (1, [100.0], 0), (2, [50.0], 1), (3, [95.0], 1), (4, [49.0], 1), (5, [96.0], 1)]
    assert [r[3] for r in run(frame, rows, 10, factor=1.0)] == [3, 2]


def test_an_id_of_two_groups(frame):
    rows = [(0, [1.0, 0.0], 0), (0, [0.0, 1.0], 1), (1, [1.0, 0.1], 0), (2, [0.2, 1.0], 1), (3, [0.8, 0.8], 2)]
    assert run(frame, rows, 10) == brute(rows, 10)


def test_large_components_use_one_field(frame):
    r = random.Random(1)
    rows = [(i, [float(r.randrange(-(2**21), 2**21)) for _ in range(3)], i % 3) for i in range(60)]
    assert run(frame, rows, 5) == brute(rows, 5)


def test_fields_of_a_word():
    r = np.random.default_rng(3)
    for low, high in ((-120, 130), (0, 1), (-1, 0), (0, 0), (-5_000, 9_000), (7, 9), (-(2**40), 2**21)):
        anchors, data = r.integers(low, high + 1, (5, 16)), r.integers(low, high + 1, (23, 16))
        bottom, spread = min(low, 0), max(high, 0) - min(low, 0)
        count, width = negatives.fields(spread, int(np.abs(anchors).sum(1).max()))
        words = negatives.pack(data, bottom, count, width)
        assert len(words) == -(-23 // count) and count * max(width, 1) <= 64
        got = negatives.products(anchors, words, 23, bottom, spread, count, width)
        exact = np.asarray([[sum(int(x) * int(y) for x, y in zip(a, d)) for d in data] for a in anchors], dtype=object)
        assert all(int(g) == (int(e) + 2**63) % 2**64 - 2**63 for g, e in zip(got.ravel(), exact.ravel()))
    assert negatives.fields(280, 1_700)[0] == 3  # unit vectors of 64 components times 256
