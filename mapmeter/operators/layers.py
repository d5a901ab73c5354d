"""Layer lists as rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unnest_layers(df: DataFrame, details: str = "request_details") -> DataFrame:
    """One row per requested layer; requests without layers disappear."""
    return df.withColumn("layer", F.explode(F.split(F.col(details)["layers"], ",")))


def unnest_json_array(df: DataFrame, column: str, name: str = "element") -> DataFrame:
    """One row per element of a JSON array held as text; other texts give none."""
    from mapmeter.functions.jsons import json_array

    return df.withColumn(name, F.explode(json_array(F.col(column))))


def layer_usage(df: DataFrame, *keys: str | Column) -> DataFrame:
    """Requests and mean response time per user, organisation, layer and kind of request."""
    dims = keys or (
        "user_name",
        "org_name",
        "request_method",
        "status_code",
        "layer",
        F.col("request_details.service").alias("service"),
        F.col("request_details.request").alias("request"),
        F.col("request_details.tiled").alias("tiled"),
    )
    return unnest_layers(df).groupBy(*dims).agg(
        F.count("id").alias("nb_req"), F.avg("response_time").alias("avg_time")
    )
