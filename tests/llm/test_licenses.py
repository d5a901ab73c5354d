import random
import re
import time

from pyspark.sql import functions as F

from mapmeter.llm import licenses
from mapmeter.session import shared_dir
from tests.llm.conftest import LONG
from tests.llm.test_decontam import WORD, low


def run(spark, frame, docs):
    d = frame([(*r, 1, 2) for r in docs], "doc_id long, text string, pos int, license int")
    return licenses.with_licenses(d, "doc_id", "text", licenses.templates(spark)).collect()


def brute(text):
    w = WORD.findall(low(text))
    places = []
    for phrase, label in licenses.PHRASES.items():
        p = phrase.split()
        places += [(i, label) for i in range(len(w) - len(p) + 1) if w[i : i + len(p)] == p]
    return len(w), sorted(places)


def test_phrases_against_brute_force(spark, frame):
    r = random.Random(5)
    text = lambda n: " ".join(r.choice(["MIT", "license", "general", "public", "Apache", "x"]) + r.choice(["", ".", "-"]) for _ in range(n))
    docs = [(i, text(r.randint(0, 40))) for i in range(60)] + [(100, None), (101, ""), (102, LONG + " MIT License"), (None, "mit license"), (7, "mit license"), (7, "mit license")]
    got = sorted(((x.doc_id, x.license.n_words, tuple((s.start, s.label) for s in x.license.spans if s.phrase)) for x in run(spark, frame, docs)), key=str)
    assert got == sorted(((d, n, tuple(p)) for d, t in docs for n, p in [brute(t)]), key=str)


def test_notices_with_changes(spark, frame):
    mit = licenses.NOTICES["mit"]
    changed = re.sub(r"without limitation", "with no limitation whatsoever", mit).upper()
    docs = [(1, f"My words. {mit}. More words."), (2, changed), (3, "of the software and to permit persons"), (4, " ".join(reversed(mit.split())))]
    got = {x.doc_id: x.license for x in run(spark, frame, docs)}
    assert got[1].labels == ["mit"] and got[1].score == 1.0
    assert got[2].labels == ["mit"] and 0.6 < got[2].score < 1
    (span,) = got[1].spans
    assert (span.start, span.end) == (2, 1 + span.length)
    assert got[3].labels == [] == got[4].labels


def test_votes_are_confirmed_in_order_and_once(spark, frame):
    mit = licenses.NOTICES["mit"]
    w = mit.split()
    docs = [
        (1, "the software " * 40), (2, "to the software and to permit persons to whom the " * 300), (3, " ".join(w[33:] + w[:33])),
        (4, "the software " * 40 + mit + " the software" * 40), (5, f"{mit} " * 3), (6, " ".join(x + (" oh" if i % 5 == 4 else "") for i, x in enumerate(w))),
        (7, "x " * 143 + mit),
    ]
    got = {x.doc_id: x.license for x in run(spark, frame, docs)}
    for junk in (1, 2, 3):
        assert got[junk].labels == [] and got[junk].score == 0, junk
    for doc, start, count in ((4, 80, 1), (5, 0, 3), (7, 143, 1)):
        spans, n = got[doc].spans, len(brute(mit)[1]) + len(WORD.findall(mit))
        assert got[doc].labels == ["mit"] and got[doc].score == 1.0 and len(spans) == count
        assert [(s.start, s.end, s.matched) for s in spans] == [(start + i * n, start + (i + 1) * n - 1, n - 1) for i in range(count)]
    assert all(s.matched <= s.length - 1 for x in got.values() for s in x.spans)


def test_empty(spark, frame):
    assert run(spark, frame, []) == []
    known = licenses.templates(spark, {}, {})
    out = licenses.with_licenses(frame([(1, "mit license")], "doc_id long, text string"), "doc_id", "text", known)
    assert out.select(F.size("license.labels")).first()[0] == 0


def test_stretches_of_a_text_meet(spark, frame, monkeypatch):
    r = random.Random(6)
    text = lambda n: " ".join(r.choice(["MIT", "license", "general", "public", "x"]) for _ in range(n))
    docs = [(i, text(r.randint(0, 40))) for i in range(30)] + [(90, f"so {licenses.NOTICES['mit']} it is")]
    for step in (1, 2, 5):
        monkeypatch.setattr(licenses, "STRETCH", step)
        got = {x.doc_id: x.license for x in run(spark, frame, docs)}
        assert {d: tuple((s.start, s.label) for s in v.spans if s.phrase) for d, v in got.items() if d < 90} == {d: tuple(brute(t)[1]) for d, t in docs if d < 90}
        assert got[90].labels == ["mit"] and got[90].score == 1.0


def test_cost_of_a_word_does_not_grow_with_its_text(spark):
    def took(texts, words):
        word = F.transform(F.sequence(F.lit(1), F.lit(words)), lambda i: F.concat(F.lit("w"), ((i.cast("long") * 7919 + F.col("doc_id") * 31) % 5003).cast("string")))
        path = f"{shared_dir(spark)}/words-{texts}-{words}-{time.time_ns()}"
        spark.range(texts).select(F.col("id").alias("doc_id")).select("doc_id", F.array_join(word, " ").alias("text")).repartition(1).write.parquet(path)
        start = time.perf_counter()
        licenses.with_licenses(spark.read.parquet(path), "doc_id", "text", licenses.templates(spark)).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    took(10, 1_000)
    assert took(1, 1_000_000) < 3 * took(1_000, 1_000) + 3
