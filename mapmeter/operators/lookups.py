"""Lookups against small dimensions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mapmeter.functions.agents import AGENT_RULES, OS_RULES, AgentRule, user_agent_fields
from mapmeter.functions.base import literal_map
from mapmeter.functions.values import trim_slashes
from mapmeter.settings import Settings


def app_name(app_id: Column, mapping: Mapping[str, str], multi_domain: bool = False) -> Column:
    """Software behind ``app_id``: the mapped name, or else the id without its slashes.

    The mapping becomes part of the expression; one that has grown large belongs in a table (:func:`lookup_app`).
    """
    bare = trim_slashes(app_id)
    if multi_domain:
        return F.coalesce(literal_map(mapping)[app_id], bare)
    return F.coalesce(literal_map({k.strip("/"): v for k, v in mapping.items()})[bare], bare)


def lookup_app(df: DataFrame, mapping: DataFrame, multi_domain: bool = False) -> DataFrame:
    """As :func:`app_name`, from a table ``(app_id, app_name)``. Of repeated ids the smallest name counts, so no row
    of ``df`` is multiplied."""
    key = (lambda c: c) if multi_domain else trim_slashes
    names = mapping.select(key(F.col("app_id")).alias("_key"), F.col("app_name").alias("_name")).groupBy("_key").agg(F.min("_name").alias("_mapped"))
    joined = df.drop("app_name").withColumn("_own", key(F.col("app_id"))).join(names, F.col("_own") == F.col("_key"), "left")
    return joined.withColumn("app_name", F.coalesce("_mapped", trim_slashes(F.col("app_id")))).drop("_mapped", "_own", "_key")


def formats_table(df: DataFrame, settings: Settings) -> DataFrame:
    """The configured download formats as ``(app_name, kind, format, label)`` rows."""
    rows = [
        (app, kind, name, label)
        for app in sorted({*settings.apps, "dataapi"} - {"datapi"})
        for kind, formats in (
            ("vector", settings.app_options(app).vector_formats),
            ("raster", settings.app_options(app).raster_formats),
        )
        for name, label in formats.items()
    ]
    return df.sparkSession.createDataFrame(rows, "app_name string, kind string, format string, label string")


def lookup_format(df: DataFrame, formats: DataFrame) -> DataFrame:
    """Left join on ``(app_name, kind, format)``: adds ``label`` and ``known_format``."""
    joined = df.join(formats, ["app_name", "kind", "format"], "left")
    return joined.withColumn("known_format", F.col("label").isNotNull())


def lookup_user_agent(
    df: DataFrame,
    agent: str,
    agents: Sequence[AgentRule] = AGENT_RULES,
    systems: Sequence[AgentRule] = OS_RULES,
) -> DataFrame:
    """Add the details of each row's user agent, in one pass: the rules are a few constants."""
    return df.withColumn("_fields", user_agent_fields(F.col(agent), agents, systems)).select(*df.columns, "_fields.*")
