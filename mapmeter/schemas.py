"""Schemas of the landing data, the fact table and the rollups."""

from __future__ import annotations

from pyspark.sql import types as T

OTEL_SCHEMA = T.StructType(
    [
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("span_id", T.StringType()),
        T.StructField("trace_id", T.StringType()),
        T.StructField("message", T.StringType()),
        T.StructField("attributes", T.MapType(T.StringType(), T.StringType())),
        T.StructField("resources", T.StringType()),
        T.StructField("scope", T.StructType([T.StructField("name", T.StringType())])),
        T.StructField("source_type", T.StringType()),
        T.StructField("severity_text", T.StringType()),
        T.StructField("severity_number", T.IntegerType()),
        T.StructField("observed_timestamp", T.TimestampType()),
        T.StructField("flags", T.IntegerType()),
        T.StructField("dropped_attributes_count", T.IntegerType()),
    ]
)

# Request details that reports group by or filter on get a typed field of their own, so that Parquet can
# prune the rest; every other request parameter stays in the ``params`` map.
DETAIL_TYPES: dict[str, T.DataType] = {
    "service": T.StringType(),
    "request": T.StringType(),
    "version": T.StringType(),
    "format": T.StringType(),
    "layers": T.StringType(),
    "workspaces": T.StringType(),
    "crs": T.StringType(),
    "size": T.StringType(),
    "width": T.StringType(),
    "height": T.StringType(),
    "tiled": T.BooleanType(),
    "is_download": T.BooleanType(),
    "download_format": T.StringType(),
    "full_download": T.BooleanType(),
    "limit": T.StringType(),
    "bbox": T.StringType(),
    "styles": T.StringType(),
    "tags": T.ArrayType(T.StringType()),
    "user_agent_string": T.StringType(),
    "user_agent_family": T.StringType(),
    "user_agent_version": T.StringType(),
    "os_family": T.StringType(),
    "os_version": T.StringType(),
    "device_family": T.StringType(),
    "device_brand": T.StringType(),
    "device_model": T.StringType(),
    "referrer": T.StringType(),
}
USER_AGENT_FIELDS = (
    "user_agent_string",
    "user_agent_family",
    "user_agent_version",
    "os_family",
    "os_version",
    "device_family",
    "device_brand",
    "device_model",
)

DETAILS_SCHEMA = T.StructType(
    [T.StructField(name, kind) for name, kind in DETAIL_TYPES.items()]
    + [T.StructField("params", T.MapType(T.StringType(), T.StringType()))]
)

CONTEXT_SCHEMA = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("source_type", "span_id", "trace_id", "logger", "source")]
)

ACCESS_LOG_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("message", T.StringType()),
        T.StructField("app_id", T.StringType()),
        T.StructField("app_path", T.StringType()),
        T.StructField("app_name", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("user_name", T.StringType()),
        T.StructField("org_id", T.StringType()),
        T.StructField("org_name", T.StringType()),
        T.StructField("roles", T.ArrayType(T.StringType())),
        T.StructField("auth_method", T.StringType()),
        T.StructField("request_method", T.StringType()),
        T.StructField("request_path", T.StringType()),
        T.StructField("request_query_string", T.StringType()),
        T.StructField("request_details", DETAILS_SCHEMA),
        T.StructField("response_time", T.IntegerType()),
        T.StructField("response_size", T.IntegerType()),
        T.StructField("status_code", T.IntegerType()),
        T.StructField("client_ip", T.StringType()),
        T.StructField("server_address", T.StringType()),
        T.StructField("context_data", CONTEXT_SCHEMA),
        T.StructField("ts_date", T.DateType()),
    ]
)

LEGACY_SCHEMA = T.StructType(
    [
        T.StructField("timestamptz", T.StringType()),
        T.StructField("username", T.StringType()),
        T.StructField("org", T.StringType()),
        T.StructField("roles", T.StringType()),
        T.StructField("request_path", T.StringType()),
        T.StructField("request_type", T.StringType()),
        T.StructField("user_agent", T.StringType()),
        T.StructField("app_name", T.StringType()),
        T.StructField("app_details", T.StringType()),
        T.StructField("response_time", T.StringType()),
        T.StructField("response_size", T.StringType()),
        T.StructField("status_code", T.StringType()),
    ]
)
