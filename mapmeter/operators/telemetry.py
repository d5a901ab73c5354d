"""Telemetry log records to access records."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mapmeter.functions import urls, values
from mapmeter.functions.base import last_wins, let, settle
from mapmeter.operators.apps import BUILT_IN, Processor, with_details
from mapmeter.operators.lookups import app_name, lookup_app
from mapmeter.operators.reconcile import has_span
from mapmeter.operators.records import as_access_records, prefer
from mapmeter.operators.text import parse_line
from mapmeter.settings import ACCESS_SCOPE_REGEX, Settings

PARAMETER_PREFIX = "http.request.parameter."


def filter_scope(
    df: DataFrame, names: Iterable[str] | None = None, regex: str = ACCESS_SCOPE_REGEX
) -> DataFrame:
    """Keep the records of access loggers, by exact names or by regex.

    For records of one source. Merged records carry the names of both loggers: filter each side before the merge.
    """
    scope = F.col("scope.name")
    return df.filter(scope.isin(*names) if names else scope.rlike(regex))


def params_from_attributes(attributes: Column) -> Column:
    """Request parameters sent as attributes: last dot segment, lower case; the last of equal keys is kept."""
    entries = F.filter(F.map_entries(attributes), lambda e: e["key"].startswith(PARAMETER_PREFIX))
    return last_wins(
        F.transform(
            entries,
            lambda e: F.struct(
                F.lower(F.substring_index(e["key"], ".", -1)).alias("key"), e["value"].alias("value")
            ),
        )
    )


def with_params_fallback(params: Column, parsed: Column) -> Column:
    """The parameters of the query string where none came as attribute."""
    return F.when(F.size(params) > 0, params).otherwise(parsed)


def otel_generics(df: DataFrame) -> DataFrame:
    """Add time, id, message and context of each record; message and span stay as they are.

    The id is the span's; a record without one gets a digest of its content, so that reading it again adds nothing.
    """
    content = F.concat_ws(
        "\x1f", F.col("timestamp").cast("string"), "trace_id", "message", "scope.name",
        F.array_join(F.array_sort(F.transform(F.map_entries("attributes"), lambda e: F.concat_ws("=", e["key"], e["value"]))), "\x1e"),
    )
    return df.withColumns(
        {
            "ts": F.col("timestamp"),
            "id": F.when(has_span(F.col("span_id")), F.col("span_id")).otherwise(values.request_id(content)),
            "context_data": F.struct(
                F.col("source_type").alias("source_type"),
                F.col("span_id").alias("span_id"),
                F.col("trace_id").alias("trace_id"),
                F.coalesce(F.col("scope.name"), F.lit("")).alias("logger"),
                F.lit(None).cast("string").alias("source"),
            ),
        }
    )


def otel_mdc(df: DataFrame, settings: Settings) -> DataFrame:
    """Add who, where, what and how long from the record's attributes.

    Host, path and query fall back to the full URL, parameters to the query.
    """

    def attribute(key: str, default: str | None = "") -> Column:
        value = F.col("attributes")[key]
        return value if default is None else F.coalesce(value, F.lit(default))

    df = settle(df, {"_url": urls.url_parts(attribute("http.request.url"))})
    query = urls.url_query(F.col("_url"))
    sent = params_from_attributes(F.col("attributes"))
    df = df.withColumns(
        {
            "request_path": prefer(F.lower(attribute("http.request.path")), urls.url_path(F.col("_url"))),
            "server_address": prefer(F.lower(attribute("server.address")), urls.url_host(F.col("_url"))),
            "request_query_string": F.coalesce(
                prefer(F.lower(attribute("http.request.query-string")), query), F.lit("")
            ),
        }
    )
    df = settle(df, {"_sent": sent})
    df = urls.settle_query_map(df, "_parsed", F.when(F.coalesce(F.size("_sent"), F.lit(0)) <= 0, query))
    df = df.withColumn("_params", with_params_fallback(F.col("_sent"), F.col("_parsed"))).drop("_parsed")
    root = F.coalesce(attribute("app_path_is_root", None) != "", F.lit(False))
    df = df.withColumn("app_path", values.app_path(F.col("request_path"), root))
    df = df.withColumn(
        "app_id", values.app_id(F.col("server_address"), F.col("app_path"), settings.multi_domain)
    )
    return df.withColumns(
        {
            "app_name": app_name(F.col("app_id"), settings.apps_mapping, settings.multi_domain),
            "user_id": attribute("enduser.uuid"),
            "user_name": attribute("enduser.id"),
            "org_id": attribute("enduser.org.uuid"),
            "org_name": attribute("enduser.org.id"),
            "roles": values.split_roles(attribute("enduser.roles")),
            "auth_method": attribute("enduser.auth-method"),
            "request_method": F.upper(attribute("http.request.method")),
            "response_time": values.int_or_none(attribute("http.response.duration_ms")),
            "response_size": values.int_or_none(attribute("http.response.body.size_bytes")),
            "status_code": values.int_or_none(attribute("http.status_code")),
            "client_ip": attribute("client.address"),
            "_agent": attribute("http.request.header.User-Agent"),
            "_referrer": attribute("http.request.header.Referer"),
        }
    ).drop("_url", "_sent")


# groups of a message pattern, and the attributes they stand in for
MESSAGE_ATTRIBUTES = {
    "method": ("http.request.method",),
    "status_code": ("http.status_code",),
    "response_size": ("http.response.body.size_bytes",),
    "client_ip": ("client.address",),
    "server_address": ("server.address",),
    "user_agent": ("http.request.header.User-Agent",),
    "referrer": ("http.request.header.Referer",),
}


def merge_message(df: DataFrame, settings: Settings) -> DataFrame:
    """Fill the attributes that are missing or blank from the text message, where its pattern matches.

    Path and query string are only taken where no attribute tells where the request went. Attributes win; a message
    that does not match leaves the record as it is.
    """
    pattern = settings.message_pattern or settings.text_pattern
    parsed = parse_line(df.select(F.col("message").alias("_text"), F.struct("*").alias("_record")), pattern, "_text")
    have = parsed.columns
    told: list[tuple[str, Column]] = [(key, F.col(group)) for group, keys in MESSAGE_ATTRIBUTES.items() if group in have for key in keys]
    sent = F.coalesce(F.col("_record.attributes"), F.create_map().cast("map<string,string>"))
    if "path" in have:
        there = prefer(sent["http.request.url"], sent["http.request.path"]).isNotNull()
        told.append(("http.request.url", F.when(~there, F.col("path"))))
    if "response_time" in have:
        told.append(("http.response.duration_ms", values.response_time_ms(F.col("response_time"), settings.response_time_unit).cast("string")))
    if "user" in have:
        user = values.split_user(F.col("user"))
        told += [("enduser.uuid", user["name"]), ("enduser.id", user["name"]), ("enduser.org.uuid", user["org"]), ("enduser.org.id", user["org"])]
        told.append(("enduser.roles", F.array_join(user["roles"], ",")))
    if not told:
        return df
    fills = F.filter(
        F.array(*[F.struct(F.lit(k).alias("key"), v.cast("string").alias("value")) for k, v in told]),
        lambda e: e["value"].isNotNull() & (e["value"] != "") & (F.coalesce(sent[e["key"]], F.lit("")) == ""),
    )

    def filled(fills: Column) -> Column:
        kept = F.map_filter(sent, lambda k, _: ~F.exists(fills, lambda e: e["key"] == k))
        return F.when(F.size(fills) > 0, F.map_concat(kept, F.map_from_entries(fills))).otherwise(F.col("_record.attributes"))

    # bound, as it would otherwise be made again for each attribute of the record
    attributes = let(fills, filled)
    return parsed.select(*[(attributes if c == "attributes" else F.col(f"_record.{c}")).alias(c) for c in df.columns])


def parse_telemetry(
    df: DataFrame,
    settings: Settings,
    registry: tuple[Processor, ...] = BUILT_IN,
    unsupported: str = "drop",
    mapping: DataFrame | None = None,
) -> DataFrame:
    """Telemetry records to access records; requests without processor are dropped by default.

    ``mapping(app_id, app_name)`` stands in for ``settings.apps_mapping`` where that is a table.
    """
    df = otel_generics(df)
    if settings.parse_message:
        df = merge_message(df, settings)
    df = otel_mdc(df, settings)
    if mapping is not None:
        df = lookup_app(df, mapping, settings.multi_domain)
    return as_access_records(with_details(df, settings, registry, unsupported), settings)
