"""Reports platform administrators ask for, over facts or rollups."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mapmeter.functions import times
from mapmeter.operators.layers import unnest_layers


def between(df: DataFrame, start: datetime | str, end: datetime | str, time: str = "ts") -> DataFrame:
    out = df.filter((F.col(time) >= F.lit(start).cast("timestamp")) & (F.col(time) < F.lit(end).cast("timestamp")))
    if "ts_date" in df.columns:
        out = out.filter(F.col("ts_date").between(F.to_date(F.lit(start)), F.to_date(F.lit(end))))
    return out


def top_layers(
    df: DataFrame,
    n: int,
    start: datetime | str,
    end: datetime | str,
    workspace: str | None = None,
    org: str | None = None,
    without_tiles: bool = True,
) -> DataFrame:
    """The ``n`` most requested layers of a period; ties in layer order."""
    details = F.col("request_details")
    rows = between(df, start, end)
    if without_tiles:
        tiled = F.coalesce(details["tiled"], F.lit(False)) | F.coalesce(details["service"].isin("WMTS", "TMS"), F.lit(False))
        rows = rows.filter(~tiled)
    if workspace is not None:
        rows = rows.filter(F.array_contains(F.split(details["workspaces"], ","), workspace))
    if org is not None:
        rows = rows.filter(F.col("org_name") == org)
    return (
        unnest_layers(rows)
        .groupBy(details["workspaces"].alias("workspaces"), "layer")
        .agg(F.count("id").alias("nb_req"))
        .orderBy(F.desc("nb_req"), F.asc_nulls_last("workspaces"), "layer")
        .limit(n)
    )


def usage_over_time(
    df: DataFrame, where: Column, grain: str = "day", tz: str = "Europe/Paris", by: Iterable[str] = ()
) -> DataFrame:
    """Evolution of whatever ``where`` selects, overall or split ``by`` columns."""
    return (
        df.filter(where)
        .groupBy(times.bucket(grain, F.col("ts"), tz).alias("bucket"), *by)
        .agg(F.count("id").alias("nb_req"))
    )


def user_layers(
    df: DataFrame, user: str, layers: Iterable[str], grain: str = "day", tz: str = "Europe/Paris"
) -> DataFrame:
    """One user's use of some layers over time."""
    rows = unnest_layers(df.filter(F.col("user_name") == user)).filter(F.col("layer").isin(*layers))
    return usage_over_time(rows, F.lit(True), grain, tz, ["layer"])


def user_context(
    df: DataFrame, user: str, context: Column, start: datetime | str, end: datetime | str, tz: str = "Europe/Paris"
) -> DataFrame:
    """One user's use of one map context by month of a period."""
    return usage_over_time(between(df, start, end), (F.col("user_name") == user) & context, "month", tz)


def downloads_per_resource(df: DataFrame) -> DataFrame:
    return (
        df.filter(F.col("request_details.is_download"))
        .groupBy("request_path")
        .agg(F.count("id").alias("nb_downloads"))
    )


def metadata_view_shares(df: DataFrame, is_html: Column, start: datetime | str, end: datetime | str) -> DataFrame:
    """How many metadata views of a period came as HTML page, how many as XML, and the HTML share."""
    return between(df, start, end).agg(
        F.count_if(is_html).alias("nb_html"),
        F.count_if(~is_html).alias("nb_xml"),
        (F.count_if(is_html) / F.nullif(F.count(F.lit(1)), F.lit(0))).alias("html_share"),
    )


def user_activity(df: DataFrame) -> DataFrame:
    return df.groupBy("user_name").agg(F.count("id").alias("nb_req"), F.max("ts").alias("last_seen"))


def inactive_users(df: DataFrame, now: datetime | str, months: int) -> DataFrame:
    """Users not seen during the last ``months`` months."""
    limit = F.lit(now).cast("timestamp") - F.expr(f"INTERVAL {int(months)} months")
    return user_activity(df).filter(F.col("last_seen") < limit)


def agents_and_referrers(rollup: DataFrame) -> DataFrame:
    return rollup.groupBy("user_agent_family", "referrer").agg(F.sum("nb_req").alias("nb_req"))


def requests_by_service(df: DataFrame, app: str = "geoserver") -> DataFrame:
    """Requests of one application by service, request and layers."""
    details = F.col("request_details")
    return (
        df.filter(F.col("app_name") == app)
        .groupBy(*[details[k].alias(k) for k in ("service", "request", "layers")])
        .agg(F.count("app_path").alias("nb_requests"))
    )


def ogc_daily_legacy(df: DataFrame, app: str = "geoserver") -> DataFrame:
    """Requests by UTC day, service, layers and request, in order."""
    details = F.col("request_details")
    return (
        df.filter(F.col("app_name") == app)
        .groupBy(
            times.bucket_day(F.col("ts")).alias("bucket"),
            details["service"].alias("ogc_service"),
            details["layers"].alias("ogc_layer"),
            details["request"].alias("ogc_request"),
        )
        .agg(F.count(F.lit(1)).alias("nb_req"))
        .orderBy(*[F.asc_nulls_last(c) for c in ("bucket", "ogc_layer", "ogc_service", "ogc_request")])
    )


def app_summary(df: DataFrame, grain: str = "hour", sketch: bool = False) -> DataFrame:
    """Counts and mean response time over all applications, by UTC bucket and request details."""
    from mapmeter.functions.quantiles import build_state

    details = F.col("request_details")
    keys = ("layers", "service", "request", "tiled", "is_download", "download_format")
    measures = [F.count("id").alias("nb_req"), F.avg("response_time").alias("avg_time")]
    if sketch:
        measures += build_state(F.col("response_time"))
    return df.groupBy(
        times.bucket(grain, F.col("ts")).alias("bucket"),
        "user_name", "org_name", "request_method", "status_code",
        *[details[k].alias(k) for k in keys],
    ).agg(*measures)
