"""Records of the older log format."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mapmeter.functions import legacy, ogc, urls, values
from mapmeter.functions.base import settle
from mapmeter.operators.text import parse_line
from mapmeter.schemas import LEGACY_SCHEMA
from mapmeter.settings import LEGACY_COMBINED_PATTERN


def legacy_line_record(
    df: DataFrame, pattern: str = LEGACY_COMBINED_PATTERN, use_generic: bool = False
) -> DataFrame:
    """Lines to the twelve-column record of ``LEGACY_SCHEMA``, all text, with details as JSON; irrelevant lines are
    dropped.

    Applications without rules are dropped too, or kept with all their parameters if ``use_generic``.
    """
    df = parse_line(df, pattern).filter("_parsed")
    path, app = F.col("path"), F.lower("app")
    known = {
        "geoserver": ogc.is_relevant_geoserver_legacy(path),
        "geonetwork": ogc.is_relevant_geonetwork(path),
        "datahub": ogc.is_relevant_datahub(path),
        "mviewer": ogc.is_relevant_mviewer(path),
        "mapstore": F.lit(False),
        "generic": F.lit(True),
    }
    keep = F.lit(use_generic)
    for name, rule in reversed(known.items()):
        keep = F.when(app == name, rule).otherwise(keep)
    df = settle(df.filter(keep), {"_url": urls.url_parts(path)})
    df = urls.settle_query_map(df, "_params", urls.url_query(F.col("_url")))
    url_path, params = urls.url_path(F.col("_url")), F.col("_params")

    def view(name: str):
        found = legacy.metadata_view(url_path, name)
        return F.create_map(
            F.lit("query_type"), found["query_type"], F.lit("uuid"), found["uuid"]
        )

    details = (
        F.when(app == "geoserver", legacy.geoserver_details_legacy(url_path, params))
        .when(app == "geonetwork", view("geonetwork"))
        .when(app == "datahub", view("datahub"))
        .when(app == "mviewer", F.map_filter(F.create_map(F.lit("map"), params["config"]), lambda k, v: v.isNotNull()))
        .otherwise(params)
    )
    user = F.split(F.col("user"), r"\|")

    def group(name: str):
        return F.col(name) if name in df.columns else F.lit("")

    return df.select(
        F.date_format(values.clf_timestamp(F.col("timestamp")), "yyyy-MM-dd'T'HH:mm:ssxxx").alias("timestamptz"),
        F.get(user, F.lit(0)).alias("username"),
        F.get(user, F.lit(1)).alias("org"),
        F.get(user, F.lit(2)).alias("roles"),
        path.alias("request_path"),
        F.col("method").alias("request_type"),
        group("user_agent").alias("user_agent"),
        F.col("app").alias("app_name"),
        F.to_json(details).alias("app_details"),
        # a number or nothing, as text
        values.int_or_none(group("response_time")).cast("string").alias("response_time"),
        values.int_or_none(F.col("response_size")).cast("string").alias("response_size"),
        values.int_or_none(F.col("status_code")).cast("string").alias("status_code"),
    ).select(*[F.col(f.name).cast(f.dataType) for f in LEGACY_SCHEMA])
