"""URL filter: rules of host and path, then a list of canonical URLs behind a blocked Bloom filter.

The list may be as long as the crawl. A blocked Bloom filter over it has at most ``MAX_BLOCKS`` blocks of 512
bits, one row each, so its broadcast is bounded whatever the list's length; URLs it passes go to an exact join
with the list, which removes the false positives. More list entries than the filter has room for only mean more
rows in that join.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mapmeter.llm.common import ascii_lower

LANES = 8  # 64-bit words of a block; one bit is set in each
BITS_PER_URL = 16
MAX_BLOCKS = 1 << 17  # 8 MiB of bits
# --- fixed values: query parameters that tell where a visitor came from, not what the page is
TRACKING = r"^(utm_[^=]*|ref|gclid|fbclid)(=.*)?$"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host(url: Column) -> Column:
    """From behind the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path(url: Column) -> Column:
    """From behind the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def canonical(url: Column) -> Column:
    """Host without ``www.`` and ``m.``, path without slashes at its end, parameters sorted and freed of
    tracking; no scheme, no fragment. Null and texts without ``://`` have none (null)."""
    query = F.regexp_extract(url, r"(?s)^.*?://[^?#]*\?([^#]*)", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING)))
    tail = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")
    name = F.regexp_replace(host(url), r"^(www|m)\.", "")
    return F.when(F.contains(url, F.lit("://")), F.concat(name, F.regexp_replace(path(url), r"/+$", ""), tail))


def matched_rule(host_: Column, path_: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits (ties: alphabetical), or nulls."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.text), r.text)):
        hit = ((host_ == r.host) | host_.endswith("." + r.host)) & path_.startswith(r.path)
        text, verdict = F.when(hit, r.text).otherwise(text), F.when(hit, r.verdict).otherwise(verdict)
    return text, verdict


def _block(key: Column, blocks: int) -> Column:
    return F.xxhash64(key).bitwiseAND(F.lit(blocks - 1).cast("long"))


def _masks(key: Column) -> list[Column]:
    """One bit per lane: six bits each of a second hash."""
    h = F.xxhash64(key, F.lit(1))
    return [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(h, 6 * i).bitwiseAND(F.lit(63)).cast("int")) for i in range(LANES)]


def block_count(urls: int) -> int:
    """A power of two with room for ``urls`` entries, never above ``MAX_BLOCKS``."""
    need = max(1, urls * BITS_PER_URL // (64 * LANES))
    return min(MAX_BLOCKS, 1 << math.ceil(math.log2(need)) if need > 1 else 1)


def blocked_bloom(listed: DataFrame, key: str, blocks: int) -> DataFrame:
    """``block`` and the lanes ``lane_0`` to ``lane_7``; blocks without entries have no row."""
    masks = _masks(F.col(key))
    return (
        listed.select(_block(F.col(key), blocks).alias("block"), *[m.alias(f"m{i}") for i, m in enumerate(masks)])
        .groupBy("block")
        .agg(*[F.bit_or(f"m{i}").alias(f"lane_{i}") for i in range(LANES)])
    )


def filter_urls(pages: DataFrame, url: str, rules: Sequence[Rule], listed: DataFrame, listed_url: str) -> DataFrame:
    """All rows and columns of ``pages`` plus one struct ``filter`` (host, path, canonical, rule, listed, verdict).

    ``listed`` holds blocked URLs, in any spelling, with repeats and nulls; an empty list blocks nothing. A rule's
    verdict goes first, else a listed URL is blocked and any other allowed. Null URLs and those without ``://``
    have an empty host and path and are never listed. Repeated rows stay. Columns of ``pages`` never clash, as
    the result is one struct (a column named ``filter`` there is replaced).
    """
    blocked = listed.select(canonical(F.col(listed_url)).alias("_listed")).where("_listed IS NOT NULL").distinct()
    blocks = block_count(blocked.count())
    bloom = F.broadcast(blocked_bloom(blocked, "_listed", blocks))

    columns = [c for c in pages.columns if c != "filter"]
    h, p = host(F.col(f"`{url}`")), path(F.col(f"`{url}`"))
    rule, verdict = matched_rule(F.col("_h"), F.col("_p"), rules)
    rows = (
        pages.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("_row"), h.alias("_h"), p.alias("_p"), canonical(F.col(f"`{url}`")).alias("_url"))
        .withColumn("_rule", rule)
        .withColumn("_verdict", verdict)
        .withColumn("_block", _block(F.coalesce("_url", F.lit("")), blocks))
    )
    possible = F.lit(True)
    for i, mask in enumerate(_masks(F.col("_url"))):
        possible = possible & (F.col(f"lane_{i}").bitwiseAND(mask) == mask)
    probed = rows.join(bloom, rows["_block"] == bloom["block"], "left").withColumn("_maybe", F.coalesce(possible & F.col("_url").isNotNull(), F.lit(False)))
    fields = ["_row", "_h", "_p", "_url", "_rule", "_verdict"]
    misses = probed.where(~F.col("_maybe")).select(*fields, F.lit(False).alias("_hit"))
    hits = (
        probed.where("_maybe").select(*fields)
        .join(blocked.withColumn("_found", F.lit(True)), F.col("_url") == F.col("_listed"), "left")
        .select(*fields, F.coalesce("_found", F.lit(False)).alias("_hit"))
    )
    own = F.when(F.col("_hit"), "block").otherwise("allow")
    return misses.unionByName(hits).select(
        "_row.*",
        F.struct(
            F.col("_h").alias("host"), F.col("_p").alias("path"), F.col("_url").alias("canonical"), F.col("_rule").alias("rule"),
            F.col("_hit").alias("listed"), F.coalesce("_verdict", own).alias("verdict"),
        ).alias("filter"),
    )
