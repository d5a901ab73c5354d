"""License scan by diagonal voting.

All rolling word k-grams of the texts meet the k-grams of the templates by hash. A hit at word ``i`` of a text and
word ``j`` of a template votes for the diagonal ``i - j``; votes are summed per text, template and diagonal before
any shuffle. Neighbouring diagonals (words added or left out) are merged into spans. Votes only propose a span: its
template positions, each once and in the order of the text, within a text span of bounded length, confirm it.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mapmeter.llm.common import count_words, settle, stretches, text_key, words

K = 2  # words of a gram; the shortest phrase has two
DRIFT = 3  # diagonals this close belong to one span
REACH = 1.5  # words of a text that a span may take, as a multiple of its template's: windows of this length, by twos
STRETCH = 256  # words of a text whose grams are made at a time
BITS = 62  # template positions to a number
COVER = 0.6  # part of a template's words that a span must hold to give its label

# --- fixed values: phrases that name a license, by contract
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
# --- fixed values: public notices, as their licenses ask to reproduce them
NOTICES = {
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions",
    "apache": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "gpl": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "mpl": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/",
    "cc": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
}

TEMPLATE = T.StructType(
    [T.StructField("template", T.IntegerType()), T.StructField("label", T.StringType()), T.StructField("phrase", T.BooleanType()), T.StructField("text", T.StringType())]
)


def templates(spark: SparkSession, phrases: Mapping[str, str] = PHRASES, notices: Mapping[str, str] = NOTICES) -> DataFrame:
    """``template, label, phrase, words``. Templates are arguments of the scan, so few; each needs ``K`` words."""
    rows = [(label, True, text) for text, label in sorted(phrases.items())] + [(label, False, text) for label, text in sorted(notices.items())]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], TEMPLATE)
    return df.select("template", "label", "phrase", words(F.col("text")).alias("words")).where(F.size("words") >= K)


def _grams(array: Column, base: Column, count: Column) -> Column:
    """(pos, hash, gram) of the first ``count`` runs of ``K`` words of a stretch; ``pos`` is the place in the text."""
    return F.transform(
        F.sequence(F.lit(0), count - 1),
        lambda i: F.struct((base + i).alias("pos"), F.xxhash64(*[F.element_at(array, i + j + 1) for j in range(K)]).alias("hash"), F.slice(array, i + 1, K).alias("gram")),
    )


def _votes(docs: DataFrame, doc_id: str, text: str, known: DataFrame) -> DataFrame:
    """Hits, summed per text, template and diagonal: ``votes`` and ``met``, the template positions hit as bits.

    Phrases and notices are few and fixed by the caller, so their grams are broadcast.
    """
    longest = known.agg(F.max(F.size("words"))).first()[0] or K
    parts = F.inline(_grams(F.col("words"), F.lit(0), F.size("words") - K + 1)).alias("at", "gram_hash", "known_gram")
    grams = known.select("template", "phrase", F.size("words").alias("length"), parts)
    rows = docs.select(F.col(f"`{doc_id}`").alias("_id"), text_key(F.col(f"`{text}`")).alias("_key"), words(F.col(f"`{text}`")).alias("w"))
    # repeated rows must not add up their votes
    rows = rows.withColumn("_no", F.monotonically_increasing_id()).where(F.size("w") >= K)
    pieces = rows.select("_id", "_key", "_no", F.inline(stretches(F.col("w"), STRETCH, K - 1))).where(F.size("c") >= K)
    scanned = pieces.select("_id", "_key", "_no", F.inline(_grams(F.col("c"), F.col("base"), F.least(F.size("c") - K + 1, F.lit(STRETCH)))))
    hits = scanned.join(F.broadcast(grams), (F.col("hash") == F.col("gram_hash")) & (F.col("gram") == F.col("known_gram")))
    bit = F.expr(f"shiftleft(1L, at % {BITS})")
    met = [F.bit_or(F.when(F.floor(F.col("at") / BITS) == i, bit).otherwise(F.lit(0).cast("long"))).alias(f"m{i}") for i in range(-(-longest // BITS))]
    summed = hits.groupBy("_id", "_key", "_no", "template", "phrase", "length", (F.col("pos") - F.col("at")).alias("diagonal")).agg(F.count(F.lit(1)).alias("votes"), *met)
    return summed.select("_id", "_key", "_no", "template", "phrase", "length", "diagonal", "votes", F.array(*[f"m{i}" for i in range(len(met))]).alias("met"))


def _chain(hits: Column) -> Column:
    """The longest run of hits with ascending template and text positions, as ``at, start, end`` of its beginnings.

    ``hits`` come by text position, of one position the later template position first. The k-th entry is the chain of
    k hits that ends at the earliest template position; of those that end alike, the one on fewest words of the text.
    """

    def meet(chains: Column, hit: Column) -> Column:
        at, pos = -hit["back"], hit["pos"]

        def put(k: Column) -> Column:  # behind the k chains that end before
            old, start = F.get(chains, k), F.coalesce(F.get(chains, k - 1)["start"], pos)
            keep = F.coalesce((old["at"] == at) & (pos - start > old["end"] - old["start"]), F.lit(False))
            new = F.struct(at.alias("at"), start.alias("start"), pos.alias("end"))
            return F.concat(F.slice(chains, F.lit(1), k), F.array(F.when(keep, old).otherwise(new)), F.slice(chains, k + 2, F.size(chains)))

        return F.get(F.transform(F.array(F.size(F.filter(chains, lambda c: c["at"] < at))), put), F.lit(0))

    return F.aggregate(hits, F.array().cast("array<struct<at:int,start:int,end:int>>"), meet)


def _confirmed(runs: DataFrame) -> DataFrame:
    """Spans of runs of diagonals that hold at least ``COVER`` of their template's grams, each once and in order.

    A window of the text takes up two steps of ``REACH`` times the template, so any span of one step lies in one.
    """
    grams = F.col("length") - K + 1
    keys = ["_id", "_key", "_no", "template", "phrase", "length", "run"]
    hit = F.filter(F.sequence(F.lit(0), F.col("length") - K), lambda j: F.getbit(F.get("met", F.floor(j / BITS).cast("int")), j % BITS) == 1)
    step = F.floor(F.col("pos") / F.ceil(F.col("length") * REACH))
    hits = runs.select(*keys, "diagonal", F.explode(hit).alias("at")).withColumn("pos", F.col("diagonal") + F.col("at"))
    windows = hits.withColumn("window", F.explode(F.array(step - 1, step))).groupBy(*keys, "window").agg(
        F.array_sort(F.collect_set(F.struct("pos", (-F.col("at")).alias("back")))).alias("hits")
    )
    chains = windows.where(F.size(F.array_distinct("hits.back")) >= COVER * grams).withColumn("chain", _chain(F.col("hits")))
    spans = chains.where(F.size("chain") >= COVER * grams).select(
        *keys, "window", F.element_at("chain", -1)["start"].alias("start"), (F.element_at("chain", -1)["end"] + K - 1).alias("end"),
        F.size("chain").cast("long").alias("matched"),
    )
    # of windows that share words of a span the better one tells it
    w = Window.partitionBy("_no", "template", "run").orderBy("window")
    before, after = F.lag(F.struct("window", "end", "matched")).over(w), F.lead(F.struct("window", "start", "matched")).over(w)
    spans = spans.withColumns({"before": before, "after": after})
    worse = F.coalesce((F.col("before.window") == F.col("window") - 1) & (F.col("before.end") >= F.col("start")) & (F.col("before.matched") >= F.col("matched")), F.lit(False))
    worse = worse | F.coalesce((F.col("after.window") == F.col("window") + 1) & (F.col("after.start") <= F.col("end")) & (F.col("after.matched") > F.col("matched")), F.lit(False))
    return spans.where(~worse).drop("window", "run", "before", "after")


def scan_licenses(docs: DataFrame, doc_id: str, text: str, known: DataFrame) -> DataFrame:
    """Per text with matches: ``_id, _key, spans``; a span is ``(label, phrase, start, end, matched, length)``.

    A phrase's span is a diagonal with all its grams: its words stand there one after the other. A notice's span lies in
    a run of diagonals at most ``DRIFT`` apart and holds at least ``COVER`` of its grams, each counted once, in the
    notice's order, within a bounded stretch of the text (``REACH``).
    """
    votes = settle(_votes(docs, doc_id, text, known), "votes")
    exact = votes.where(F.col("phrase") & (F.col("votes") == F.col("length") - K + 1)).select(
        "_id", "_key", "_no", "template", "phrase", "length", F.col("diagonal").alias("start"), (F.col("diagonal") + F.col("length") - 1).alias("end"), F.col("votes").alias("matched")
    )
    # a diagonal with next to no votes is chance; it neither starts nor carries a span
    w = Window.partitionBy("_no", "template").orderBy("diagonal")
    loose = votes.where(~F.col("phrase") & (F.col("votes") >= 2)).withColumn(
        "cut", F.coalesce((F.col("diagonal") - F.lag("diagonal").over(w) > DRIFT).cast("int"), F.lit(1))
    )
    runs = loose.withColumn("run", F.sum("cut").over(w)).withColumn("all", F.sum("votes").over(Window.partitionBy("_no", "template", "run")))
    merged = _confirmed(runs.where(F.col("all") >= COVER * (F.col("length") - K + 1)))
    labels = F.broadcast(known.select("template", "label"))
    return (
        exact.unionByName(merged)
        .join(labels, "template")
        .groupBy("_id", "_key")
        .agg(F.array_sort(F.collect_set(F.struct("start", "end", "label", "phrase", "matched", "length"))).alias("spans"))
    )


def with_licenses(docs: DataFrame, doc_id: str, text: str, known: DataFrame) -> DataFrame:
    """All rows and columns of ``docs`` plus a struct ``license``: ``n_words, spans, labels, score``.

    ``score`` is the largest part of a template found, 1 for a phrase. Null and empty texts have no words and score 0;
    repeated rows each keep their result; a column named ``license`` is replaced.
    """
    columns = [c for c in docs.columns if c != "license"]
    found = scan_licenses(docs, doc_id, text, known)
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in columns]).alias("_row"), F.col(f"`{doc_id}`").alias("_id2"),
        text_key(F.col(f"`{text}`")).alias("_key2"), count_words(F.col(f"`{text}`")).cast("long").alias("_n"),
    )
    spans = F.coalesce("spans", F.array().cast(found.schema["spans"].dataType))
    parts = F.transform(spans, lambda s: F.least(F.lit(1.0), s["matched"] / (s["length"] - K + 1)))
    return rows.join(found, F.col("_id").eqNullSafe(F.col("_id2")) & (F.col("_key") == F.col("_key2")), "left").select(
        "_row.*",
        F.struct(
            F.col("_n").alias("n_words"), spans.alias("spans"),
            F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))).alias("labels"),
            F.coalesce(F.array_max(parts), F.lit(0.0)).alias("score"),
        ).alias("license"),
    )
