"""Agent rules: the index gives what looking for one rule after the other gives, at a cost that does not follow their number."""

import random
import re
import time

from pyspark.sql import functions as F

from checks.intake import AGENTS
from mapmeter.functions import agents
from mapmeter.functions.agents import AGENT_RULES, DEVICE_RULES, OS_RULES, AgentRule


def plain(text, rules=AGENT_RULES, systems=OS_RULES):
    """(family, version, os family, os version, model) by a scan of all rules."""
    first = lambda known: next((r for r in known if r.token in text), None)

    def version(rule, digits):
        if rule is None or not rule.version or rule.version not in text:
            return None
        m = re.match(digits, text.split(rule.version, 1)[1])
        return m and m[0]

    agent, system = first(rules), first(systems)
    family = None if text == "" else agent.family if agent else agents.OTHER
    model = next((d[3] for d in DEVICE_RULES if d[0] in text), None)
    return family, version(agent, r"\d+(?:\.\d+)?"), system and system.family, version(system, r"\d+"), model


def fields(spark, texts, *rules):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = df.select("i", agents.user_agent_fields(F.col("t"), *rules).alias("a")).orderBy("i").collect()
    return [(r.a.user_agent_family, r.a.user_agent_version, r.a.os_family, r.a.os_version, r.a.device_model) for r in rows]


def test_index_equals_scan(spark):
    r = random.Random(4)
    parts = [x.token for x in (*AGENT_RULES, *OS_RULES)] + [d[0] for d in DEVICE_RULES]
    parts += [p for a in AGENTS for p in a[0].split(" ")] + ["lib", "1.2", "é", "x", "/", "\n", ""]
    texts = [a[0] for a in AGENTS] + ["".join(r.choice(parts) + r.choice([" ", "", "3."]) for _ in range(r.randint(0, 7))) for _ in range(3_000)]
    assert fields(spark, texts) == [plain(t) for t in texts]
    assert fields(spark, [None]) == [(None,) * 5]


def test_tokens_of_any_kind(spark):
    """Short tokens, tokens without letters, of other scripts, repeated, one within another, and no rules at all."""
    rules = tuple(AgentRule(f"f{i}", t, t) for i, t in enumerate(["ab", "9/", "абв", "abcd", "bcd", "abcd", "Zz/", "", "never"]))
    r = random.Random(5)
    texts = ["".join(r.choice("abcdZz9/абв ") for _ in range(r.randint(0, 9))) for _ in range(2_000)]
    assert fields(spark, texts, rules[:7]) == [plain(t, rules[:7]) for t in texts]
    assert [f[0] for f in fields(spark, texts, rules)] == [plain(t, rules)[0] for t in texts]
    assert fields(spark, texts[:50], (), ()) == [plain(t, (), ()) for t in texts[:50]]


def test_cost_does_not_follow_the_rules(spark, tmp_path):
    r = random.Random(6)
    letters = "abcdefghijklmnopqrstuvwxyz"
    more = tuple(AgentRule(f"m{i}", t, t) for i, t in enumerate("".join(r.choice(letters) for _ in range(7)).title() + "/" for _ in range(540)))
    texts = F.array(*[F.lit(a[0]) for a in AGENTS])
    sizes = (100, 600_000)
    for n in sizes:
        agent = F.concat(F.get(texts, (F.col("id") % len(AGENTS)).cast("int")), F.lit(" "), "id")
        spark.range(n).select(agent.alias("t")).write.parquet(f"{tmp_path}/{n}")

    def seconds(rules, n):
        df = spark.read.parquet(f"{tmp_path}/{n}").select(F.hash(agents.user_agent_fields(F.col("t"), rules)).alias("h")).agg(F.sum("h"))
        best = 1e9
        for _ in range(3):
            begin = time.perf_counter()
            df.collect()
            best = min(best, time.perf_counter() - begin)
        return best

    few, many = ([seconds(rules, n) for n in sizes] for rules in (AGENT_RULES, (*AGENT_RULES, *more)))
    assert many[1] - many[0] < 2.5 * (few[1] - few[0])  # what rows cost, without planning
