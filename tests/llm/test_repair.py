import hashlib
import heapq
import itertools
import os
import random
import re
import time
import zlib
from collections import defaultdict

import pytest

from mapmeter.llm import repair
from mapmeter.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
COLUMNS = ("conv_id", "turn", "role", "text")
SCHEMA = "conv_id long, turn long, role string, text string, conv string, place long, extra int"


def cheapest(rows):
    """Uniform-cost search over whole outputs, which a regular expression judges: (cost, audit, new roles)."""
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, out, roles = heapq.heappop(heap)
        key = (i, out)  # as the contract words it: what comes out, and how much is read
        if key in done:
            continue
        done.add(key)
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", out):
            return cost, audit, roles
        for to, name in (("u", "user"), ("a", "assistant")):
            if re.fullmatch("(s?(ua)*u?)?", out + to) and len(out) <= 2 * len(rows) + 2:
                heapq.heappush(heap, (cost + 2, audit + "I", i, out + to, (*roles, name)))
        if i < len(rows):
            initial, fault = rows[i]
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, out, roles))
            if fault not in (1, 2):
                for edit, more, to, name in (("K", 0, initial, None), ("R", 2, "u", "user"), ("R", 2, "a", "assistant")):
                    if to and re.fullmatch("(s?(ua)*u?)?", out + to):
                        heapq.heappush(heap, (cost + more + (fault == 3), audit + edit, i + 1, out + to, (*roles, name) if name else roles))


def fast(rows):
    """The same by a table over the automaton of the regular expression, for longer conversations."""
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "U", ("u", "a"): "p", ("U", "a"): "p", ("p", "u"): "u"}
    tops = {"": (0, "")}

    def put(into, state, cost, audit):
        if state not in into or (cost, audit) < into[state]:
            into[state] = (cost, audit)

    def grown(tops):
        for _ in range(4):
            for state, (cost, audit) in list(tops.items()):
                for to in "ua":
                    if (state, to) in step:
                        put(tops, step[state, to], cost + 2, audit + "I")
        return tops

    tops = grown(tops)
    for initial, fault in rows:
        new = {}
        for state, (cost, audit) in tops.items():
            put(new, state, cost + 3, audit + "D")
            if fault not in (1, 2):
                for edit, more, to in (("K", 0, initial), ("R", 2, "u"), ("R", 2, "a")):
                    if (state, to) in step:
                        put(new, step[state, to], cost + more + (fault == 3), audit + edit)
        tops = grown(new)
    return min(tops[s] for s in ("", "p") if s in tops)


def brute(rows, damaged):
    """Each conversation's result as the contract words it."""
    original = {r[0] for r in rows}
    convs = defaultdict(list)
    for c, t, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20 if damaged else 9
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        convs[c] += [(t, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    out = {}
    for c in original:
        came = sorted(convs[c], key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, found = set(), []
        for _, role, text in came:
            last = re.findall(r"[^\x20\x09-\x0D]", text)[-1:]
            found.append(1 if not last else 2 if (role, text) in seen else 3 if last[0] not in ".!?" else 0)
            seen.add((role, text))
        initials = [r[1][:1] for r in came]
        cost, audit = fast(list(zip(initials, found)))
        turns = [t for t, _, _ in came if t is not None]
        total = sum(e != "D" for e in audit)
        repaired, rest = [], iter(came)
        for e in audit:
            _, role, text = (None, "", "") if e == "I" else next(rest)
            if e != "D":
                new = ("user", "assistant")[(len(repaired) - total % 2) % 2]
                repaired.append(f"{role if e == 'K' else new}:{text}")
        out[c] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, found.count(1), found.count(2), found.count(3),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit, hashlib.sha256("\n".join(repaired).encode()).hexdigest(),
        )
    return out


def result(rows, frame=None, damaged=True):
    found = repair.repair(repair.damage(rows, *COLUMNS) if damaged else rows, *COLUMNS)
    every = repair.with_every(found, repair.originals(rows, "conv_id"))
    got = every.select("conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "sha256").collect()
    assert len({r.conv for r in got}) == len(got)
    return {r[0]: tuple(r)[1:] for r in got}


def test_stacks():
    a = repair.AUTOMATON
    assert len(a.stops) == 6 and sum(a.accepting[s] for s in a.stops) == 2
    with pytest.raises(ValueError):
        repair.Automaton((("x", ()), ("x", ("u", "x", "a"))))
    other = repair.Automaton((("x", ("u", "a")),))
    assert repair._finish(repair.parse([("a", 0)], automaton=other), other) == (2, "IK")


def test_parse_against_search():
    kinds = [("s", 0), ("u", 0), ("a", 0), ("a", 3), ("u", 1), ("", 0), ("t", 3)]
    for n in range(4):
        for rows in itertools.product(kinds, repeat=n):
            want = cheapest(rows)
            assert repair._finish(repair.parse(rows)) == want[:2] == fast(rows), rows


def test_parse_against_table():
    r = random.Random(2)
    for n in (0, 1, 2, 5, 9, 30, 300, 900):
        for _ in range(60 if n < 100 else 4):
            shape = r.choice(["", "ua", "au", "uua", "sua"])
            rows = [(shape[i % len(shape)] if shape and r.random() < 0.9 else r.choice("suat"), r.choice([0, 0, 0, 1, 2, 3])) for i in range(n)]
            assert repair._finish(repair.parse(rows)) == fast(rows)


def test_stretches_make_the_whole():
    r = random.Random(6)
    for _ in range(60):
        rows = [(r.choice("suuaaat"), r.choice([0, 0, 0, 1, 3])) for _ in range(r.randrange(1, 40))]
        cuts = sorted(r.sample(range(len(rows) + 1), min(len(rows), r.randrange(4))))
        tops = {0: (0, "")}
        for a, b in zip([0, *cuts], [*cuts, len(rows)]):
            reached = {}
            for entry, (cost, audit) in tops.items():
                for stack, (c, x) in repair.parse(rows[a:b], entry).items():
                    repair._add(reached, stack, cost + c, audit + x)
            tops = reached
        assert repair._finish(tops) == fast(rows)


def test_time_grows_with_the_rows():
    def took(rows):
        start = time.perf_counter()
        repair.parse(rows)
        return time.perf_counter() - start

    for rows in ([("u", 0), ("a", 0)], [("a", 1)], [("u", 0)], [("a", 3), ("t", 0), ("s", 0)]):
        took(rows * 100)
        assert took(rows * 10_000) < 20 * took(rows * 1_000) + 0.2


def test_long_conversations_are_cut(frame, monkeypatch):
    import pyarrow as pa

    from pyspark.sql.types import LongType

    class Context:
        partitionId = staticmethod(lambda: 3)

    monkeypatch.setattr(repair, "SEGMENT", 50)
    monkeypatch.setattr(repair.TaskContext, "get", staticmethod(lambda: Context))
    r = random.Random(3)
    rows = [(c, t, r.choice("ssuuaat"), r.choice([0, 0, 1, 3]), c * 1000 + t) for c, n in ((1, 120), (2, 50), (3, 7), (4, 400), (5, 3)) for t in range(n)]
    batch = pa.RecordBatch.from_pylist([dict(zip(("conv", "turn", "initial", "fault", "place"), x)) for x in rows])
    got = [x for b in repair._parse_partition(repair._arrow(repair._SEGMENT, LongType()))(iter([batch])) for x in b.to_pylist()]
    assert [(x["conv"], x["seg"], len(x["places"]), x["whole"]) for x in got if x["conv"] != 4] == [(1, 0, 50, False), (1, 1, 50, False), (1, 2, 20, False), (2, 0, 50, True), (3, 0, 7, True), (5, 0, 3, False)]
    assert [p for x in got for p in x["places"]] == [x[4] for x in rows]


def conversations(r, n, longest=9):
    texts = ["Yes.", "No.", "why", "Well!", "", " \t", "ok?", "a ", "é.", "x.\n ", None]
    rows = []
    for c in range(n):
        for t in range(r.randrange(1, longest)):
            role = ("user", "assistant")[t % 2] if r.random() < 0.7 else r.choice(["system", "tool", "", None, "user", "assistant"])
            for _ in range(r.choice([1, 1, 1, 1, 2])):
                rows.append((c, t if r.random() < 0.9 else r.choice([None, 0, t + 3]), role, r.choice(texts) if r.random() < 0.5 else f"Text {r.randrange(40)}."))
    return rows + [(None, 0, "user", "Hi."), (None, None, "assistant", "Ho."), (None, 2, None, None), (-4, None, "user", "a.")]


@pytest.mark.parametrize("damaged, parts", [(True, 4), (False, 23)])
def test_against_brute_force(spark, frame, damaged, parts):
    rows = conversations(random.Random(parts), 150)
    d = frame([(*r, "c", 5, None) for r in rows], SCHEMA, 5)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        assert result(d, damaged=damaged) == brute(rows, damaged)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_a_conversation_over_many_partitions(spark, frame, monkeypatch):
    r = random.Random(8)
    rows = [(7, t, r.choice(["user", "assistant"]) if r.random() < 0.2 else ("user", "assistant")[t % 2], r.choice(["Same.", f"Text {t}.", f"cut {t}", ""])) for t in range(4_000)]
    rows += [(7, 5, "user", "Same.")] * 400 + conversations(r, 30)
    d = frame([(*x, "c", 5, None) for x in rows], SCHEMA, 5)
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", 9)
    spark.conf.set("spark.sql.adaptive.enabled", False)
    try:
        found = repair.repair(d, *COLUMNS)
        want = brute(rows, False)
        got = {x.conv: (x.cost, x.audit) for x in found.results.collect()}
        assert got == {c: v[5:7] for c, v in want.items()}
        assert result(d, damaged=False) == want
        # rows that come out are numbered without gaps, and edits name each row once
        numbers = sorted(x.no for x in found.repaired.where("conv = 7").collect())
        assert numbers == list(range(len(numbers)))
        assert found.edits.where("place IS NOT NULL").count() == len(rows)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_none_and_one(frame):
    assert result(frame([], SCHEMA)) == {}
    one = frame([(1, 0, "user", "Hi.", "", 1, 2)], SCHEMA, 1)
    assert result(one, damaged=False) == brute([(1, 0, "user", "Hi.")], False)
    assert result(one, damaged=False)[1][5:7] == (2, "KI")


def test_long_texts_and_text_ids(frame):
    from tests.llm.conftest import LONG

    rows = [("x", 0, "user", LONG + "?"), ("x", 1, "assistant", LONG), ("x", 2, "assistant", LONG), ("", 0, "assistant", " " * 300_000)]
    d = frame(rows, "conv_id string, turn int, role string, text string", 2)
    assert result(d, damaged=False) == brute(rows, False)


@pytest.mark.skipif(not os.path.isdir(SF), reason="given tables not here")
def test_given_conversations(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select(*COLUMNS).collect()]
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    df = QUERIES["op12_conversation_repair"](spark, SF)
    assert set(df.columns) == {"conv_id", *names}
    assert {r.conv_id: tuple(r[n] for n in names) for r in df.collect()} == brute(rows, True)
