import random
from collections import defaultdict

import numpy as np
import pytest

from mapmeter.llm import neardup
from tests.llm.conftest import LONG


def brute(docs, size, num, den):
    """(id, text, n, component, kept) of distinct (id, text) rows, by all pairs."""
    rows = sorted(set(docs), key=str)
    sets = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        sets.append({tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set())
    group = list(range(len(rows)))

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and den * both >= num * (len(sets[i]) + len(sets[j]) - both):
                group[find(i)] = find(j)
    members = defaultdict(list)
    for i in range(len(rows)):
        members[find(i)].append(rows[i][0])
    out = {}
    for i, (doc, text) in enumerate(rows):
        known = [d for d in members[find(i)] if d is not None]
        low = min(known) if known else None
        out[doc, text] = (len(sets[i]), low, low == doc)
    return out


def run(frame, docs, size=3, num=85, den=100):
    from mapmeter.llm.common import text_key

    d = frame([(*r, 1, b"x", 2) for r in docs], "doc_id long, text string, node int, digest binary, key int")
    found = neardup.near_duplicates(d, "doc_id", "text", size, num, den)
    keyed = d.select("doc_id", "text", text_key(d["text"]).alias("k")).distinct()
    joined = found.join(keyed, found["doc_id"].eqNullSafe(keyed["doc_id"]) & (found["text_key"] == keyed["k"]))
    return [(r[0], r[1], r[2:]) for r in joined.select(keyed["doc_id"], "text", "n_shingles", "component_id", "kept", "stays").collect()]


def vary(r, words, changes):
    out = list(words)
    for _ in range(changes):
        out[r.randrange(len(out))] = f"n{r.randrange(10**6)}"
    return " ".join(out)


def test_against_all_pairs(frame):
    r = random.Random(4)
    docs = []
    for base in range(6):  # groups around the threshold, among them chains and near misses
        words = [f"w{base}x{i}" for i in range(r.choice([12, 40, 90]))]
        docs += [(len(docs) + i, vary(r, words, r.randint(0, 4))) for i in range(25)]
    docs += [(500, "One two"), (501, "one  TWO\n"), (502, "two one"), (503, "É x y"), (504, "é x y"), (505, None), (506, ""), (507, " \t "), (508, "One two")]
    docs += [(None, docs[0][1]), (None, "alone here now"), (None, "alone here now"), (3, docs[3][1]), (3, "other text of this id"), (600, LONG), (601, LONG + "x")]
    want = brute(docs, 3, 85, 100)
    got = run(frame, docs)
    assert len(got) == len(docs)
    for doc, text, (n, component, kept, _) in got:
        assert (n, component, kept) == want[doc, text], (doc, str(text)[:40])
    stay = {(d, t) for d, t, x in got if x[3]}
    by_group = defaultdict(set)
    for d, t in stay:
        by_group[want[d, t][1] if want[d, t][0] else ("empty", d)].add((d, t))
    assert all(len(v) == 1 for k, v in by_group.items() if k not in (None, 3))  # 3 names two components


def test_large_group_and_shared_passage(frame, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 16)  # many blocks in one bucket
    r = random.Random(8)
    base = [f"b{i}" for i in range(60)]
    docs = [(i, vary(r, base, r.randint(1, 3))) for i in range(150)]
    passage = " ".join(f"p{i}" for i in range(60))  # in common, but too little for a link
    docs += [(1_000 + i, passage + " " + " ".join(f"q{i}_{j}" for j in range(12))) for i in range(80)]
    want = brute(docs, 3, 85, 100)
    assert {d: x[:3] for d, _, x in run(frame, docs)} == {d: v for (d, _), v in want.items()}


def test_without_duplicates(frame):
    docs = [(5, "a b c d e f g"), (2, "a b c d e f g"), (2, "a b c d e f g"), (7, None), (None, "x y z u v w"), (None, "x y z u v w"), (9, "else")]
    d = frame([(*r, i, "z") for i, r in enumerate(docs)], "doc_id long, text string, row int, _row string")
    out = neardup.without_duplicates(d, "doc_id", "text")
    assert out.columns == d.columns
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=str) == sorted([(2, "a b c d e f g"), (7, None), (None, "x y z u v w"), (9, "else")], key=str)
    assert neardup.without_duplicates(frame([], d.schema), "doc_id", "text").count() == 0


def test_components_of_a_long_chain(spark):
    edges = spark.range(300).selectExpr("id AS a", "id + 1 AS b").union(spark.range(1_000, 1_005).selectExpr("id AS a", "1000 AS b"))
    got = {r.node: r.component for r in neardup.components(edges.where("a <> b")).collect()}
    assert got == {i: 0 for i in range(301)} | {i: 1_000 for i in range(1_000, 1_005)}


def test_sequential_test_keeps_what_reaches_the_threshold():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 16, (4_000, neardup.HASHES), dtype=np.uint16)
    for similarity, least, most in ((0.85, 0.9995, 1), (0.5, 0, 0.01)):
        b = np.where(rng.random(a.shape) < similarity, a, a ^ 1).astype(np.uint16)
        part = len(neardup.survivors(a, b, 0.85)[0]) / len(a)
        assert least <= part <= most
    assert neardup.least_matches(0.85) == tuple(sorted(neardup.least_matches(0.85)))


def test_signatures_estimate_similarity():
    words = [f"w{i}" for i in range(4_000)]
    a, b = neardup.shingles(" ".join(words[:3_000]), 1), neardup.shingles(" ".join(words[1_000:]), 1)
    assert len(a) == 3_000
    assert np.mean(neardup.signature(a) == neardup.signature(b)) == pytest.approx(0.5, abs=0.12)
