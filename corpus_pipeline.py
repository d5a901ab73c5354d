"""From raw documents to packed training sequences, in stages that are each written and read again.

A stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept. All but the last return the columns of
``documents``; the last returns a row per piece: where it lies in which training sequence.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mapmeter.llm import decontam, neardup, packing
from mapmeter.llm.common import table
from mapmeter.llm.queries import ACCEPT, quality_scored, tokenizer_file, toxicity_scored
from mapmeter.session import fresh_path


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a quality score of at least ``ACCEPT``."""
    return quality_scored(docs, table(spark, sf_dir, "labels")).where(F.col("score") >= ACCEPT).select(*docs.columns)


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the chain's threshold for toxic."""
    return toxicity_scored(docs, table(spark, sf_dir, "labels")).where(~F.col("toxic_rejected")).select(*docs.columns)


def unique(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8)."""
    return neardup.without_duplicates(docs, "doc_id", "text", size=5, num=80, den=100)


def not_leaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without ten consecutive words of a benchmark item."""
    found = decontam.decontaminate(docs, "doc_id", "text", table(spark, sf_dir, "benchmark"), "item_id", "text", 10)
    return found.where(F.col("leak.n_hit") == 0).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces in sequences of at most 1024 ids."""
    return packing.pack(packing.token_pieces(docs, "doc_id", "text", tokenizer_file(), size=1024, end_id=2), "length", size=1024)


STAGES = [
    ("quality_classifier", good_quality),
    ("toxicity", not_toxic),
    ("near_dedup", unique),
    ("decontamination", not_leaked),
    ("packing", packed),
]
ORACLE_SQL = None  # learned models and token ids; tests hold the stages against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, over the whole table ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = fresh_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
