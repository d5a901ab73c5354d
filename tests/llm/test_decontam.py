import random
import re
import time

from pyspark.sql import functions as F

from mapmeter.llm import decontam
from mapmeter.session import shared_dir
from tests.llm.conftest import LONG

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute(docs, items, n):
    grams = {}
    for item, text in items:
        w = WORD.findall(low(text))
        size = min(n, len(w))
        for i in range(len(w) - size + 1 if size else 0):
            grams.setdefault(tuple(w[i : i + size]), set()).add(item)
    out = []
    for doc, text in docs:
        w = WORD.findall(low(text))
        hit, found = set(), set()
        for size in {len(g) for g in grams}:
            for i in range(len(w) - size + 1):
                if tuple(w[i : i + size]) in grams:
                    hit |= set(range(i, i + size))
                    found |= grams[tuple(w[i : i + size])] - {None}
        out.append((doc, len(w), len(hit), tuple(sorted(found))))
    return sorted(out, key=str)


def run(frame, docs, items, n):
    d = frame([(*r, "x", 1, 2) for r in docs], "doc_id long, text string, w string, _key int, leak int")
    b = frame([(*r, "y") for r in items], "item_id long, text string, hash string")
    out = decontam.decontaminate(d, "doc_id", "text", b, "item_id", "text", n)
    return sorted(((r.doc_id, r.leak.n_words, r.leak.n_hit, tuple(sorted(r.leak["items"]))) for r in out.collect()), key=str)


def test_against_brute_force(frame):
    r = random.Random(3)
    text = lambda n: " ".join(r.choice(["a", "B", "c", "É", "é", "9"]) + r.choice(["", ",", "!", "\n"]) for _ in range(n))
    items = [(i, text(r.randint(0, 9))) for i in range(12)] + [(None, text(6)), (3, None), (4, "")]
    docs = [(i, text(r.randint(0, 60))) for i in range(60)]
    docs += [(1, docs[1][1]), (None, text(30)), (None, text(30)), (70, None), (71, ""), (72, LONG), (73, "--- !!")]
    assert run(frame, docs, items, 4) == brute(docs, items, 4)


def test_empty_tables(frame):
    assert run(frame, [], [(1, "a b")], 3) == []
    assert run(frame, [(1, "a b c d")], [], 3) == [(1, 4, 0, ())]
    assert run(frame, [(1, "a b c d")], [(1, None)], 3) == [(1, 4, 0, ())]


def test_shuffled_beyond_the_broadcast_bound(frame, monkeypatch):
    monkeypatch.setattr(decontam, "BROADCAST_BYTES", 0)
    assert run(frame, [(1, "x a b c y")], [(5, "A b, c")], 3) == [(1, 5, 3, (5,))]


def test_stretches_of_a_text_meet(frame, monkeypatch):
    r = random.Random(9)
    text = lambda n: " ".join(r.choice("abc") for _ in range(n))
    docs, items = [(i, text(r.randint(0, 70))) for i in range(40)], [(i, text(r.choice([1, 2, 5, 5, 9, 30]))) for i in range(10)]
    for step in (1, 4, 7):
        monkeypatch.setattr(decontam, "STRETCH", step)
        assert run(frame, docs, items, 5) == brute(docs, items, 5)


def test_cost_of_a_word_does_not_grow_with_its_text(spark):
    items = spark.createDataFrame([(i, " ".join(f"w{i + j}" for j in range(12))) for i in range(50)], "item_id long, text string")

    def took(texts, words):
        word = F.transform(F.sequence(F.lit(1), F.lit(words)), lambda i: F.concat(F.lit("w"), ((i.cast("long") * 7919 + F.col("doc_id") * 31) % 5003).cast("string")))
        path = f"{shared_dir(spark)}/words-{texts}-{words}-{time.time_ns()}"
        spark.range(texts).select(F.col("id").alias("doc_id")).select("doc_id", F.array_join(word, " ").alias("text")).repartition(1).write.parquet(path)
        docs = spark.read.parquet(path)
        start = time.perf_counter()
        decontam.decontaminate(docs, "doc_id", "text", items, "item_id", "text", 10).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    took(10, 1_000)
    assert took(1, 1_000_000) < 3 * took(1_000, 1_000) + 3


def test_a_window_of_many_items(frame):
    items = [(i, "one two three") for i in range(3_000)]
    assert run(frame, [(1, "x one two three y"), (2, "one two")], items, 3) == [(1, 5, 3, tuple(range(3_000))), (2, 2, 0, ())]


def test_spans_are_cut_out(frame):
    docs = frame([("One two. Three, four five!",), ("all stays",), (None,)], "t string")
    spans = F.when(F.col("t").startswith("One"), F.array(F.struct(F.lit(1).alias("start"), F.lit(3).alias("end")))).otherwise(F.array().cast("array<struct<start:int,end:int>>"))
    got = {r[0] for r in docs.select(decontam.without_spans(F.col("t"), spans)).collect()}
    assert got == {"One, four five!", "all stays", None}
