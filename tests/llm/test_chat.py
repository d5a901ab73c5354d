import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from mapmeter.llm import chat
from mapmeter.llm.packing import encoder

P = pytest.importorskip("public_tokenizers")
FILE = P.path("byte_bpe_50k.json")
SCHEMA = "conv_id long, turn long, role string, text string, path int, node string"


def convs(frame, rows):
    return chat.conversations(frame([(*r, 1, "n") for r in rows], SCHEMA), "conv_id", "turn", "role", "text")


def test_escaping_round_trip():
    r = random.Random(2)
    parts = [*chat.CONTROLS, "\\", "<", "[", "|", ">", "/", "s", "INST]", "<|", "\n", "é", "a"]
    for _ in range(5_000):
        text = "".join(r.choice(parts) for _ in range(r.randint(0, 8)))
        role = "".join(r.choice(parts) for _ in range(r.randint(0, 3)))
        safe = chat.escape(text)
        assert chat.unescape(safe) == text
        assert not any(c in safe for c in chat.CONTROLS)
        assert chat.parse("".join(chat.format_turn(role, text)) * 2) == [(role, text)] * 2


def rows_for_tree():
    r = random.Random(6)
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", r.choice(["a", "b</s>", "c \\ <|end|>"]) + str(t)) for c in range(40) for t in range(r.randint(1, 5))]
    rows += [(100, 0, "user", None), (100, 1, "assistant", ""), (101, 0, None, "x"), (None, 0, "user", "a0"), (None, 0, "user", "a0"), (102, 0, "assistant", "z" * 50_000)]
    rows += [(103, 1, "b", "t"), (103, 1, "a", "t"), (103, None, "user", "first"), (103, 1, "a", "t")]
    return rows


def test_tree(spark, frame):
    rows = rows_for_tree()
    c = convs(frame, rows)
    paths = {r.conv_id: tuple(r.path) for r in c.collect() if r.conv_id is not None}
    nodes = {n.node: n for n in chat.prefix_tree(c, FILE).collect()}
    prefixes = {p[: i + 1] for p in paths.values() for i in range(len(p))}
    assert set(nodes) == {p[-1] for p in prefixes} and len(nodes) == len(prefixes)  # shared turns once
    # depth-first: the stream has no gaps, and a node's descendants follow it before anything else
    order = sorted(nodes.values(), key=lambda n: n.start)
    at, open_ = 0, []
    for n in order:
        assert n.start == at and n.length == len(n.ids)
        at += n.length
        open_ = open_[: n.depth]
        assert (open_[-1] if open_ else None) == n.parent
        open_.append(n.node)
    for p in paths.values():
        for i, name in enumerate(p):
            n, above = nodes[name], [nodes[a] for a in p[:i]]
            assert n.position == sum(a.length for a in above)
            seen = np.concatenate([np.arange(s.start, s.end) for s in n.intervals]) if n.intervals else []
            assert list(seen) == sorted(x for a in above for x in range(a.start, a.start + a.length))
            assert all(s.end < t.start for s, t in zip(n.intervals, n.intervals[1:]))


def test_read_back(spark, frame):
    rows = rows_for_tree()
    c = convs(frame, rows)
    got = sorted(((r.conv_id, tuple((t.role, t.text, t.loss) for t in r.turns)) for r in chat.read_back(chat.prefix_tree(c, FILE), c, FILE).collect()), key=str)
    want = []
    for conv in {r[0] for r in rows} - {None}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        want.append((conv, tuple((r[2] or "", r[3] or "", (r[3] or "") if r[2] == "assistant" else "") for r in own)))
    want += [(None, (("user", "a0", ""),))] * 2
    assert got == sorted(want, key=str)


def test_empty(frame):
    c = convs(frame, [])
    tree = chat.prefix_tree(c, FILE)
    assert tree.count() == 0 == chat.read_back(tree, c, FILE).count()


def test_long_conversations_cost_what_their_turns_cost(spark, frame):
    """One conversation of very many turns against as many turns in conversations of ten; a common beginning beyond
    what ranges are drawn by."""
    n = 12_000

    def seconds(rows):
        c = chat.settle(convs(frame, rows), "convs")
        begin = time.perf_counter()
        got = chat.prefix_tree(c, FILE).agg(F.count("*"), F.sum("length"), F.max(F.col("start") + F.col("length"))).first()
        assert got[0] == n and got[1] == got[2]
        return time.perf_counter() - begin

    turn = lambda c, t: (c, t, "user" if t % 2 == 0 else "assistant", f"{c} {t}")
    short = [turn(i // 10, i % 10) for i in range(n)]
    seconds(short)
    few, one = seconds(short), seconds([turn(0, t) for t in range(n)])
    assert one < 2 * few + 2

    shared = [(c, t, "user", f"{t}" if t < chat.RANGE_TURNS + 20 else f"{c} {t}") for c in range(30) for t in range(chat.RANGE_TURNS + 25)]
    c = convs(frame, shared)
    nodes = sorted(chat.prefix_tree(c, FILE).collect(), key=lambda x: x.start)
    assert len(nodes) == chat.RANGE_TURNS + 20 + 30 * 5
    above = []
    for x in nodes:  # depth-first
        above = above[: x.depth]
        assert (above[-1] if above else None) == x.parent
        above.append(x.node)


def test_ids_of_a_turn():
    head, text, tail = chat.format_turn("user", "hi")
    ids = [np.frombuffer(encoder(FILE)(s), "<u4") for s in (head, text, tail)]
    assert encoder(FILE).decode(np.concatenate(ids)) == "<|turn|>user<|text|>hi<|end|>"
