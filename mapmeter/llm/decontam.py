"""Benchmark decontamination: n-grams of test items as a broadcast hash set, scanned by every text's windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mapmeter.llm.common import count_words, settle, stretches, text_key, words

# The set is broadcast while its words take no more than this; beyond, windows meet it by shuffle.
BROADCAST_BYTES = 64 << 20
STRETCH = 256  # words of a text whose windows are made at a time


def item_windows(items: DataFrame, item_id: str, text: str, n: int) -> DataFrame:
    """``item, gram``: each window of ``n`` consecutive words of each item; one of fewer words, but not none, is one."""
    rows = items.select(F.col(f"`{item_id}`").alias("item"), words(F.col(f"`{text}`")).alias("w")).where(F.size("w") > 0)
    rows = rows.select("item", F.least(F.size("w"), F.lit(n)).alias("size"), F.explode(stretches(F.col("w"), STRETCH, n - 1)).alias("s"), F.size("w").alias("words"))
    last = F.least(F.size("s.c") - F.col("size"), F.lit(STRETCH - 1))
    grams = F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(F.col("s.c"), i + 1, F.col("size")))
    return rows.where(F.size("s.c") >= F.col("size")).select("item", F.explode(grams).alias("gram"))


def _windows(size: int) -> Column:
    """(start, length, hash, gram) of each run of ``size`` words that begins in the stretch."""
    last = F.least(F.size("c") - size, F.lit(STRETCH - 1))
    return F.when(
        last >= 0,
        F.transform(
            F.sequence(F.lit(0), last),
            lambda i: F.struct((F.col("base") + i).alias("start"), F.lit(size).alias("length"), F.xxhash64(F.slice("hashes", i + 1, size)).alias("hash"), F.slice("c", i + 1, size).alias("gram")),
        ),
    ).otherwise(F.array().cast("array<struct<start:int,length:int,hash:bigint,gram:array<string>>>"))


def _merged(spans: DataFrame) -> DataFrame:
    """Overlapping and touching intervals of each text put together, in order: ``_id, _key, spans``."""
    text = Window.partitionBy("_id", "_key").orderBy("start", "end")
    before = F.max("end").over(text.rowsBetween(Window.unboundedPreceding, -1))
    rows = spans.withColumn("_new", F.when(before >= F.col("start"), 0).otherwise(1))
    rows = rows.withColumn("_part", F.sum("_new").over(text.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    parts = rows.groupBy("_id", "_key", "_part").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return parts.groupBy("_id", "_key").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"))


def find_contamination(docs: DataFrame, doc_id: str, text: str, items: DataFrame, item_id: str, item_text: str, n: int = 10) -> DataFrame:
    """Documents with hits: ``_id, _key`` (of the text), ``spans`` (merged word intervals) and ``items`` (ids).

    Words are compared after A-Z became lower case. The set holds each distinct window once, without its items, which
    hits get by the window's number; it is broadcast as long as its size is proved to be at most ``BROADCAST_BYTES``.
    Windows carry their own words, by which hits are verified, so the cost of a word does not grow with its text.
    """
    found = settle(item_windows(items, item_id, item_text, n), "item-windows")
    grams = found.select("gram").distinct().select(
        F.monotonically_increasing_id().alias("gid"), F.size("gram").alias("_length"), F.xxhash64(F.transform("gram", lambda w: F.xxhash64(w))).alias("_hash"), F.col("gram").alias("_gram")
    )
    grams = settle(grams, "grams")
    links = settle(found.where("item IS NOT NULL").join(grams, F.col("gram") == F.col("_gram")).select("gid", "item").distinct(), "links")
    sizes = sorted(r[0] for r in grams.select("_length").distinct().collect())  # at most n values
    word_bytes = F.aggregate("_gram", F.lit(0).cast("long"), lambda a, w: a + F.octet_length(w) + 16)
    held = grams.agg(F.sum(word_bytes + 64)).first()[0] or 0

    rows = docs.select(F.col(f"`{doc_id}`").alias("_id"), text_key(F.col(f"`{text}`")).alias("_key"), words(F.col(f"`{text}`")).alias("w"))
    pieces = rows.select("_id", "_key", F.inline(stretches(F.col("w"), STRETCH, (sizes or [1])[-1] - 1)))
    pieces = pieces.withColumn("hashes", F.transform("c", lambda x: F.xxhash64(x)))
    scanned = pieces.select("_id", "_key", F.inline(F.concat(*[_windows(s) for s in sizes or [n]])))
    known = F.broadcast(grams) if held <= BROADCAST_BYTES else grams
    hits = scanned.join(known, (F.col("hash") == F.col("_hash")) & (F.col("length") == F.col("_length")) & (F.col("gram") == F.col("_gram")))
    hits = settle(hits.select("_id", "_key", "start", (F.col("start") + F.col("length")).alias("end"), "gid").distinct(), "hits")
    spans = _merged(hits.select("_id", "_key", "start", "end").distinct())
    named = hits.select("_id", "_key", "gid").distinct().join(links, "gid").groupBy("_id", "_key").agg(F.collect_set("item").alias("items"))
    same = [F.col("s._id").eqNullSafe(F.col("i._id")), F.col("s._key") == F.col("i._key")]
    none = F.array().cast(named.schema["items"].dataType)
    return spans.alias("s").join(named.alias("i"), same, "left").select("s._id", "s._key", "s.spans", F.coalesce("i.items", none).alias("items"))


def decontaminate(docs: DataFrame, doc_id: str, text: str, items: DataFrame, item_id: str, item_text: str, n: int = 10) -> DataFrame:
    """All rows and columns of ``docs`` plus a struct ``leak``: ``n_words, spans, n_hit, items``.

    Rows without hits have no spans. Null and empty texts have no words. Repeated rows each keep their result. Items
    without words match nothing; with no items at all nothing is hit. A column named ``leak`` is replaced.
    """
    columns = [c for c in docs.columns if c != "leak"]
    found = find_contamination(docs, doc_id, text, items, item_id, item_text, n)
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in columns]).alias("_row"), F.col(f"`{doc_id}`").alias("_id2"),
        text_key(F.col(f"`{text}`")).alias("_key2"), count_words(F.col(f"`{text}`")).cast("long").alias("_n"),
    )
    spans = F.coalesce("spans", F.array().cast("array<struct<start:int,end:int>>"))
    return rows.join(found, F.col("_id").eqNullSafe(F.col("_id2")) & (F.col("_key") == F.col("_key2")), "left").select(
        "_row.*",
        F.struct(
            F.col("_n").alias("n_words"), spans.alias("spans"),
            F.aggregate(spans, F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"]).alias("n_hit"),
            F.coalesce("items", F.array().cast(found.schema["items"].dataType)).alias("items"),
        ).alias("leak"),
    )


def without_spans(text: Column, spans: Column) -> Column:
    """``text`` (as it was) without the words of ``spans`` and what stands before each of them; the rest is as it was."""
    pieces = F.regexp_extract_all(text, F.lit(r"[^0-9A-Za-z\x{80}-\x{10FFFF}]*[0-9A-Za-z\x{80}-\x{10FFFF}]+"), F.lit(0))
    tail = F.regexp_extract(text, r"[^0-9A-Za-z\x{80}-\x{10FFFF}]*$", 0)
    kept = F.filter(pieces, lambda _, i: ~F.exists(spans, lambda s: (i >= s["start"]) & (i < s["end"])))
    return F.when(F.size(spans) > 0, F.concat(F.array_join(kept, ""), tail)).otherwise(text)
