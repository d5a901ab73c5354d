"""Exchange of log records as semicolon-separated CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mapmeter.functions.jsons import details_to_json
from mapmeter.schemas import LEGACY_SCHEMA

# quotes inside a field are doubled
_OPTIONS = {"sep": ";", "header": "true", "quote": '"', "escape": '"'}


def flat_for_csv(df: DataFrame) -> DataFrame:
    """Nested columns as text: details as one JSON object, arrays and structs as JSON."""
    columns = []
    for f in df.schema:
        if f.name == "request_details":
            columns.append(details_to_json(F.col(f.name)).alias(f.name))
        elif isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)):
            columns.append(F.to_json(f.name).alias(f.name))
        else:
            columns.append(F.col(f.name))
    return df.select(*columns)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    flat_for_csv(df).write.mode(mode).options(**_OPTIONS).csv(path)


def load_csv(spark: SparkSession, path: str | list[str], schema: T.StructType | str) -> DataFrame:
    """Read files written by :func:`write_csv`; ``path`` may be a glob or a list."""
    return spark.read.schema(schema).options(**_OPTIONS).csv(path)


def append_csv(spark: SparkSession, path: str | list[str], table: str, schema: T.StructType = LEGACY_SCHEMA) -> None:
    """Load files and append their rows to a stored table of the same columns."""
    load_csv(spark, path, schema).write.mode("append").parquet(table)
