"""User-agent families from an ordered rule list."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from mapmeter.functions.base import let


@dataclass(frozen=True)
class AgentRule:
    """``family`` when the agent contains ``token``; its version follows ``version``."""

    family: str
    token: str
    version: str = ""


# --- fixed values: families by token, first match wins; the more specific token stands first ----
AGENT_RULES: tuple[AgentRule, ...] = (
    # crawlers, which name a browser as well
    AgentRule("Googlebot", "Googlebot", "Googlebot/"),
    AgentRule("bingbot", "bingbot", "bingbot/"),
    AgentRule("YandexBot", "YandexBot", "YandexBot/"),
    AgentRule("Baiduspider", "Baiduspider", "Baiduspider/"),
    AgentRule("DuckDuckBot", "DuckDuckBot", "DuckDuckBot/"),
    AgentRule("Applebot", "Applebot", "Applebot/"),
    AgentRule("AhrefsBot", "AhrefsBot", "AhrefsBot/"),
    AgentRule("SemrushBot", "SemrushBot", "SemrushBot/"),
    AgentRule("MJ12bot", "MJ12bot", "MJ12bot/v"),
    AgentRule("FacebookBot", "facebookexternalhit", "facebookexternalhit/"),
    AgentRule("Twitterbot", "Twitterbot", "Twitterbot/"),
    # map software
    AgentRule("QGIS", "QGIS/", "QGIS/"),
    AgentRule("ArcGIS Pro", "ArcGIS Pro", "ArcGIS Pro "),
    AgentRule("ArcGIS Pro", "ArcGISPro", "ArcGISPro/"),
    AgentRule("ArcMap", "ArcMap", "ArcMap "),
    AgentRule("ArcGIS", "ArcGIS", "ArcGIS/"),
    AgentRule("MapProxy", "MapProxy-", "MapProxy-"),
    AgentRule("MapProxy", "MapProxy", "MapProxy/"),
    AgentRule("MapServer", "MapServer", "MapServer/"),
    AgentRule("GeoServer", "GeoServer", "GeoServer/"),
    AgentRule("GeoWebCache", "GeoWebCache", "GeoWebCache "),
    AgentRule("GDAL", "GDAL/", "GDAL/"),
    AgentRule("GDAL", "GDAL", "GDAL "),
    AgentRule("JOSM", "JOSM/", "JOSM/"),
    AgentRule("FME", "FME/", "FME/"),
    AgentRule("OWSLib", "OWSLib", "OWSLib/"),
    AgentRule("MapInfo", "MapInfo", "MapInfo "),
    # browsers, which name those that they descend from
    AgentRule("Electron", "Electron/", "Electron/"),
    AgentRule("Edge", "EdgiOS/", "EdgiOS/"),
    AgentRule("Edge", "EdgA/", "EdgA/"),
    AgentRule("Edge", "Edg/", "Edg/"),
    AgentRule("Edge", "Edge/", "Edge/"),
    AgentRule("Opera", "OPR/", "OPR/"),
    AgentRule("Opera", "OPiOS/", "OPiOS/"),
    AgentRule("Opera", "Opera", "Version/"),
    AgentRule("Vivaldi", "Vivaldi/", "Vivaldi/"),
    AgentRule("Yandex Browser", "YaBrowser/", "YaBrowser/"),
    AgentRule("Samsung Internet", "SamsungBrowser/", "SamsungBrowser/"),
    AgentRule("Chrome", "CriOS/", "CriOS/"),
    AgentRule("Firefox", "FxiOS/", "FxiOS/"),
    AgentRule("SeaMonkey", "SeaMonkey/", "SeaMonkey/"),
    AgentRule("Firefox", "Firefox/", "Firefox/"),
    AgentRule("HeadlessChrome", "HeadlessChrome/", "HeadlessChrome/"),
    AgentRule("Chromium", "Chromium/", "Chromium/"),
    AgentRule("Chrome", "Chrome/", "Chrome/"),
    AgentRule("IE", "Trident/", "rv:"),
    AgentRule("IE", "MSIE ", "MSIE "),
    AgentRule("Android", "Android", "Version/"),
    AgentRule("Safari", "Safari/", "Version/"),
    # programs and libraries
    AgentRule("curl", "curl/", "curl/"),
    AgentRule("Wget", "Wget/", "Wget/"),
    AgentRule("Python Requests", "python-requests/", "python-requests/"),
    AgentRule("Python aiohttp", "aiohttp/", "aiohttp/"),
    AgentRule("Python-urllib", "Python-urllib/", "Python-urllib/"),
    AgentRule("python-httpx", "python-httpx/", "python-httpx/"),
    AgentRule("Apache-HttpClient", "Apache-HttpClient/", "Apache-HttpClient/"),
    AgentRule("okhttp", "okhttp/", "okhttp/"),
    AgentRule("Go-http-client", "Go-http-client/", "Go-http-client/"),
    AgentRule("axios", "axios/", "axios/"),
    AgentRule("node-fetch", "node-fetch", "node-fetch/"),
    AgentRule("PostmanRuntime", "PostmanRuntime/", "PostmanRuntime/"),
    AgentRule("Java", "Java/", "Java/"),
)
OTHER = "Other"  # the family of agents that no rule knows
OS_RULES: tuple[AgentRule, ...] = (
    AgentRule("Windows", "Windows NT", "Windows NT "),
    AgentRule("Windows", "Windows"),
    AgentRule("Android", "Android", "Android "),
    AgentRule("iOS", "like Mac OS X", "OS "),
    AgentRule("Mac OS X", "Mac OS X", "Mac OS X "),
    AgentRule("Chrome OS", "CrOS", "CrOS x86_64 "),
    AgentRule("Linux", "Linux"),
    AgentRule("Linux", "linux"),
)
# token, family, brand, model
DEVICE_RULES: tuple[tuple[str, str, str, str], ...] = (
    ("Googlebot", "Spider", "Spider", "Desktop"),
    ("bingbot", "Spider", "Spider", "Desktop"),
    ("YandexBot", "Spider", "Spider", "Desktop"),
    ("iPhone", "iPhone", "Apple", "iPhone"),
    ("iPad", "iPad", "Apple", "iPad"),
    ("Macintosh", "Mac", "Apple", "Mac"),
)
# --- end of fixed values --------------------------------------------------------------------------


_GRAM = "(?=([A-Za-z]{3}))"  # three letters in a row, at every place of a text


def _anchors(tokens: Sequence[str]) -> dict[str, list[int]]:
    """Numbers of tokens by one of their grams: one that starts with a capital if there is any, shared by few."""
    grams = [set(re.findall(_GRAM, t)) for t in tokens]
    shared = Counter(g for own in grams for g in own)
    anchors: dict[str, list[int]] = {}
    for number, own in enumerate(grams):
        if own:
            anchors.setdefault(min(own, key=lambda g: (g[0].islower(), shared[g], g)), []).append(number)
    return anchors


def _contained(agent: Column, tokens: Sequence[str]) -> Column:
    """The numbers of the tokens an agent contains, in any order.

    The agent's grams are looked up in a constant table; only tokens found there, and the few without a gram, are
    compared with the agent. So the work hangs on the agent's length and hardly on the number of tokens.
    """
    anchors = _anchors(tokens)
    slots: list[list[int]] = [[] for _ in range(max(64, 16 * len(tokens)))]
    for gram, numbers in anchors.items():
        slots[zlib.crc32(gram.encode()) % len(slots)] += numbers
    loose = sorted(set(range(len(tokens))) - {n for numbers in anchors.values() for n in numbers})
    candidates = F.array(*map(F.lit, loose)).cast("array<int>")
    if anchors:
        known = "".join(f"[{''.join(sorted({g[i] for g in anchors}))}]" for i in range(3))  # letters that anchors have there
        rows = ", ".join(f"array({', '.join(map(str, own))})" if own else "NULL" for own in slots)
        table = F.expr(f"CAST(array({rows}) AS array<array<int>>)")
        found = F.transform(
            F.regexp_extract_all(agent, F.lit(f"(?=({known}))"), F.lit(1)),
            lambda g: F.get(table, F.pmod(F.crc32(g), F.lit(len(slots))).cast("int")),
        )
        candidates = F.array_distinct(F.concat(candidates, F.flatten(F.filter(found, lambda own: own.isNotNull()))))
    texts = F.array(*map(F.lit, tokens))
    return F.filter(candidates, lambda number: agent.contains(F.get(texts, number)))


def _rule(found: Column, rules: Sequence[tuple[str, ...]], names: Sequence[str], before: int) -> Column:
    """The first of ``rules`` among the numbers found, where ``before`` other rules are numbered ahead of them."""
    if not rules:
        return F.struct(*[F.lit(None).cast("string").alias(n) for n in names])
    table = F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(names, rule, strict=True)]) for rule in rules])
    own = F.filter(found, lambda number: (number >= before) & (number < before + len(rules)))
    return F.get(table, F.array_min(own) - before)


def _version(agent: Column, token: Column, digits: str) -> Column:
    rest = F.substr(agent, F.instr(agent, token) + F.length(token))
    return F.when((F.length(token) > 0) & agent.contains(token), F.get(F.regexp_extract_all(rest, F.lit(f"^({digits})")), F.lit(0)))


def user_agent_fields(
    agent: Column,
    agents: Sequence[AgentRule] = AGENT_RULES,
    systems: Sequence[AgentRule] = OS_RULES,
) -> Column:
    """The eight user-agent details; an agent that no rule knows has the family ``OTHER`` and its text."""
    named = ("family", "token", "version")
    browsers = [(r.family, r.token, r.version) for r in agents]
    hosts = [(r.family, r.token, r.version) for r in systems]
    tokens = [*(r[1] for r in browsers), *(r[1] for r in hosts), *(r[0] for r in DEVICE_RULES)]

    def rules(matched: Column) -> Column:
        return F.struct(
            matched["text"].alias("text"),
            _rule(matched["found"], browsers, named, 0).alias("agent"),
            _rule(matched["found"], hosts, named, len(browsers)).alias("system"),
            _rule(matched["found"], DEVICE_RULES, ("token", "family", "brand", "model"), len(browsers) + len(hosts)).alias("device"),
        )

    matched = let(agent, lambda a: F.struct(a.alias("text"), _contained(a, tokens).alias("found")))
    return let(
        let(matched, rules),
        lambda f: F.struct(
            F.nullif(f["text"], F.lit("")).alias("user_agent_string"),
            F.when(f["text"] != "", F.coalesce(f["agent"]["family"], F.lit(OTHER))).alias("user_agent_family"),
            _version(f["text"], f["agent"]["version"], r"\d+(?:\.\d+)?").alias("user_agent_version"),
            f["system"]["family"].alias("os_family"),
            _version(f["text"], f["system"]["version"], r"\d+").alias("os_version"),
            f["device"]["family"].alias("device_family"),
            f["device"]["brand"].alias("device_brand"),
            f["device"]["model"].alias("device_model"),
        ),
    )
