"""Scalars read from log text: numbers, times, identifiers, users."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CLF_TIME_FORMAT = "dd/MMM/yyyy:HH:mm:ss xx"


def dash_to_null(value: Column) -> Column:
    return F.nullif(value, F.lit("-"))


def blank_to_null(value: Column) -> Column:
    return F.nullif(value, F.lit(""))


def int_or_none(value: Column) -> Column:
    # a cast that fails throws and catches an error in each row, which costs more than the rest of a record
    return F.when(value.rlike(r"^[\x00-\x20\x7f]*[-+]?[0-9]+[\x00-\x20\x7f]*$"), value.try_cast("int"))


def float_or_none(value: Column) -> Column:
    # Java also reads "1.5d" and "1.5f" as numbers
    suffixed = value.rlike(r"^\s*[-+]?[0-9.]+(?:[eE][-+]?[0-9]+)?[dDfF]\s*$")
    return F.when(~suffixed, value.try_cast("double"))


def response_time_ms(value: Column, unit: str = "ms") -> Column:
    """Whole milliseconds; zero and unreadable values count as not measured."""
    number = F.nullif(float_or_none(value.cast("string")), F.lit(0.0))
    return (number * 1000 if unit == "s" else number).try_cast("int")


def clf_timestamp(value: Column) -> Column:
    """``18/Oct/2023:17:36:10 +0000`` to an instant; ISO text and a missing offset (UTC) are read too."""
    return F.coalesce(
        F.try_to_timestamp(value, F.lit(CLF_TIME_FORMAT)),
        F.try_to_timestamp(value, F.lit("dd/MMM/yyyy:HH:mm:ss")),
        value.try_cast("timestamp"),
    )


def request_id(message: Column) -> Column:
    return F.substring(F.md5(message), 1, 12)


def split_user(user: Column) -> Column:
    """``name|org|role,role`` to a struct; missing parts are NULL."""
    parts = F.split(blank_to_null(user), r"\|")
    return F.struct(
        F.get(parts, F.lit(0)).alias("name"),
        F.get(parts, F.lit(1)).alias("org"),
        F.split(F.get(parts, F.lit(2)), ",").alias("roles"),
    )


def split_roles(roles: Column) -> Column:
    """Comma list to array; no roles at all give one empty role."""
    return F.split(F.coalesce(roles, F.lit("")), ",")


def app_path(path: Column, is_root: Column | None = None) -> Column:
    """``/first-segment/`` of the request path, or ``/`` for an application at the root."""
    first = F.concat(F.lit("/"), F.lower(F.get(F.split(path, "/"), F.lit(1))), F.lit("/"))
    return first if is_root is None else F.when(is_root, F.lit("/")).otherwise(first)


def app_id(server_address: Column, path: Column, multi_domain: bool = False) -> Column:
    """Application key: its path, preceded by the host where several domains are served."""
    return F.concat_ws("", server_address, path) if multi_domain else F.concat_ws("", path)


def trim_slashes(value: Column) -> Column:
    return F.btrim(value, F.lit("/"))


def request_line(line: Column) -> Column:
    """Method, path and application of ``GET /app/x HTTP/1.1``; empty strings when it is something else."""
    pattern = (
        r"(GET|POST|HEAD|OPTION|PUT|PATCH|DELETE|TRACE|CONNECT) "
        r"(?:https?://[_:a-zA-Z0-9.-]+)?(/([_a-zA-Z0-9-]+)(?:/.*)) HTTP.*"
    )
    return F.struct(
        F.regexp_extract(line, pattern, 1).alias("method"),
        F.regexp_extract(line, pattern, 2).alias("path"),
        F.regexp_extract(line, pattern, 3).alias("app"),
    )
