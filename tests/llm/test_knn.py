import math
import random

import pytest
from pyspark.sql import functions as F

from mapmeter.llm import knn


def brute(rows, k, every):
    ok = {(i, tuple(math.floor(64 * x) for x in v)) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for q, v in ok:
        if q % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in ok if i != q)[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored)]
    return sorted(out)


def run(frame, rows, k, every, **more):
    d = frame([(*r, 1.0, 3) for r in rows], "vec_id long, e array<double>, distance double, cell int")
    return sorted(tuple(r) for r in knn.knn_join(d, "vec_id", "e", F.col("vec_id") % every == 0, k, **more).collect())


@pytest.mark.parametrize("block", [16_384, 50])
def test_against_brute_force(frame, monkeypatch, block):
    monkeypatch.setattr(knn, "BLOCK", block)
    monkeypatch.setattr(knn, "QUERY_BLOCK", block)
    r = random.Random(1)
    rows = [(i, [r.gauss(r.choice([0, 3]), 0.4) for _ in range(5)]) for i in range(400)]
    rows += [(400 + i, list(rows[0][1])) for i in range(150)]  # one very common vector: ties
    rows += [(900, None), (901, [1.0, None, 1.0, 1.0, 1.0]), (902, [float("nan")] * 5), (903, [float("inf")] * 5), (None, [1.0] * 5), (0, list(rows[0][1])), (905, [0.0] * 5), (910, [])]
    assert run(frame, rows, 7, 5, pivots=6) == brute(rows, 7, 5)


def test_few_and_no_candidates(frame):
    rows = [(0, [1.0, 2.0]), (1, [0.5, 0.5]), (20, [1.0, 2.0])]
    assert run(frame, rows, 20, 20) == brute(rows, 20, 20)
    assert run(frame, [], 3, 1) == []
    assert run(frame, [(0, [1.0])], 3, 1) == []
    assert run(frame, [(1, [1.0]), (2, [1.0])], 3, 20) == []


def test_an_id_with_two_vectors(frame):
    rows = [(0, [1.0, 0.0]), (0, [0.0, 1.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [0.5, 0.5])]
    got = run(frame, rows, 1, 10)
    assert got == [(0, 1, 1, 4096), (0, 1, 2, 4096)]


def test_large_components_stay_exact(frame):
    rows = [(i, [float(2**24 + i), float(2**20 - i)]) for i in range(30)]
    assert run(frame, rows, 5, 10) == brute(rows, 5, 10)
