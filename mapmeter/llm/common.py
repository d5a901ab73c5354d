"""What several operators share: words as columns, tables of a data folder, written intermediates."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mapmeter.session import persist_table

# --- fixed values: what stands between words, given by the result contracts
WORD_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD_ANY_CASE = r"[0-9A-Za-z\x{80}-\x{10FFFF}]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other character as it is (``lower`` would change letters beyond ASCII too)."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def words(text: Column) -> Column:
    """Words of a text in order; null and empty texts have none."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), WORD_GAP), "")


def count_words(text: Column) -> Column:
    """``size(words(text))`` without building the array."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD_ANY_CASE))


def stretches(array: Column, step: int, more: int) -> Column:
    """``(base, c)``: an array cut every ``step`` elements, each piece with the ``more`` elements that follow it.

    Windows are exploded piece by piece: a row that is exploded is copied into each of the rows it becomes, so what it
    holds must not grow with the text.
    """
    base = F.transform(F.sequence(F.lit(0), F.floor((F.greatest(F.size(array), F.lit(1)) - 1) / step).cast("int")), lambda i: i * step)
    return F.transform(base, lambda i: F.struct(i.alias("base"), F.slice(array, i + 1, step + more).alias("c")))


def text_key(text: Column) -> Column:
    """Tells rows of one id with different texts apart."""
    return F.xxhash64(F.coalesce(text, F.lit("")), F.length(F.coalesce(text, F.lit(""))))


def one_each(rows: DataFrame) -> DataFrame:
    """``id, y, text`` with one row for each id, that of the smallest text key, kept before the shuffle."""
    best = F.min_by(F.struct("text"), F.struct(text_key(F.col("text")), "text"))
    return rows.groupBy("id").agg(F.first("y").alias("y"), best.alias("best")).select("id", "y", "best.text")


def settle(df: DataFrame, label: str) -> DataFrame:
    """Cut the plan: write to the shared folder and read back, so that lost executors cost no recomputation."""
    return persist_table(df, f"llm-{label}")


def fits(df: DataFrame, rows: int) -> bool:
    """Whether ``df`` has at most ``rows`` rows; reads no more than it needs to know."""
    return df.select(F.lit(1)).limit(rows + 1).count() <= rows


def text_batches(spark: SparkSession, rows: int = 1_000) -> None:
    """Whole texts go to Python in batches of few rows, so that long ones don't add up. A user's setting stays."""
    key, default = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000"
    if spark.conf.get(key, default) == default:
        spark.conf.set(key, rows)
