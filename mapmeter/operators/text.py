"""Text log lines to access records."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from mapmeter.functions import urls, values
from mapmeter.functions.base import settle, settle_groups
from mapmeter.operators.apps import BUILT_IN, Processor, with_details
from mapmeter.operators.lookups import app_name, lookup_app
from mapmeter.operators.records import as_access_records
from mapmeter.settings import Settings

PIPE_FIELDS = (
    "ip", "timestamp", "user", "org", "roles", "method", "path", "status_code",
    "response_time", "response_size", "user_agent",
)


def parse_line(df: DataFrame, pattern: str, line: str = "value") -> DataFrame:
    """Add one column per named group of ``pattern``, and ``_parsed`` for lines that match.

    ``-`` in a group means that nothing was logged and becomes NULL.
    """
    names = re.compile(pattern).groupindex
    df = settle_groups(df, "_groups", line, pattern)
    groups = {
        name: values.dash_to_null(F.get(F.col("_groups"), F.lit(index - 1)))
        for name, index in names.items()
    }
    return df.withColumns({**groups, "_parsed": F.col("_groups").isNotNull()}).drop("_groups")


def with_constants(df: DataFrame, extra_info: Mapping[str, str]) -> DataFrame:
    """Constant columns for what the lines do not tell; they override parsed columns."""
    return df.withColumns({k: F.lit(v) for k, v in extra_info.items()}) if extra_info else df


def drop_unparsed(df: DataFrame) -> DataFrame:
    """Keep lines that matched and name an application by path or id."""
    return df.filter(readable(df)).drop("_parsed")


def readable(df: DataFrame) -> Column:
    """Whether a line matched the pattern and names an application."""
    known = F.lit(False)
    for name in ("app_path", "app_id"):
        if name in df.columns:
            known = known | (F.coalesce(F.col(name), F.lit("")) != "")
    return F.coalesce(F.col("_parsed") & known, F.lit(False))


def number_repeats(df: DataFrame) -> DataFrame:
    """Lines with ``repeat``, the number (from 0) of each among the equal lines of its file.

    Times in logs are whole seconds, so equal lines are different accesses; with its number each gets an id of its
    own, and the same one when the file is read again. Lines of different files stay equal: a copied file adds nothing.

    Only 16 bytes of each line are shuffled, counted map-side; the lines found twice or more, normally few, are looked
    up among all and laid out again from their count, however often they stand there.
    """
    keys = [c for c in ("value", "source") if c in df.columns]
    digest = F.unhex(F.md5(F.concat_ws("\n", *reversed(keys)).cast("binary")))
    lines = df.select(*keys, digest.alias("_digest"))
    again = lines.groupBy("_digest").agg(F.count(F.lit(1)).cast("int").alias("_many")).where("_many > 1")
    marked = lines.join(again, "_digest", "left")
    once = marked.where("_many IS NULL").select(*keys, F.lit(0).alias("repeat"))
    counted = marked.where("_many IS NOT NULL").groupBy(*keys).agg(F.max("_many").alias("_many"))
    return once.unionByName(counted.select(*keys, F.explode(F.sequence(F.lit(0), F.col("_many") - 1)).alias("repeat")))


def _or_null(df: DataFrame, name: str):
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


def parse_text_logs(
    df: DataFrame,
    settings: Settings,
    registry: tuple[Processor, ...] = BUILT_IN,
    unsupported: str = "keep",
    mapping: DataFrame | None = None,
    observation: Observation | None = None,
    rejects: bool = False,
) -> DataFrame:
    """Lines (``value``, optionally ``source`` and ``repeat``) to access records.

    Requests without processor are kept with raw parameters unless ``unsupported`` is ``drop``. ``mapping`` stands in
    for ``settings.apps_mapping`` where that is a table. ``observation`` counts the lines, and those that do not
    match the pattern or name no application. With ``rejects`` such lines stay, as records without time, and the line
    of each record without time is in ``rejected_line``, whatever the privacy list says of messages.
    """
    df = with_constants(parse_line(df, settings.text_pattern), settings.extra_info)
    if observation is not None:
        df = df.observe(observation, F.count(F.lit(1)).alias("lines"), F.count_if(~readable(df)).alias("rejected"))
    time = values.clf_timestamp(F.col("timestamp"))
    if rejects:
        time = F.when(readable(df), time)
    else:
        df = drop_unparsed(df)
    df = settle(
        df,
        {
            "_ts": time,
            "_url": urls.url_parts(F.col("path")),
        },
    )
    df = urls.settle_query_map(df, "_params", urls.url_query(F.col("_url")))
    path = F.nullif(F.lower(_or_null(df, "app_path")), F.lit(""))
    identity = (
        F.col("app_id")
        if "app_id" in df.columns
        else values.app_id(_or_null(df, "server_address"), path, settings.multi_domain)
    )
    df = df.withColumns({"app_path": path, "app_id": identity})
    user = values.split_user(_or_null(df, "user"))
    # the first of equal lines keeps the plain digest
    numbered = F.col("value")
    if "repeat" in df.columns:
        numbered = F.when(F.col("repeat") > 0, F.concat("value", F.lit("\n"), F.col("repeat").cast("string"))).otherwise(F.col("value"))
    records = df.select(
        values.request_id(numbered).alias("id"),
        F.col("_ts").alias("ts"),
        F.col("value").alias("message"),
        "app_id",
        "app_path",
        app_name(F.col("app_id"), settings.apps_mapping, settings.multi_domain).alias("app_name"),
        user["name"].alias("user_id"),
        user["name"].alias("user_name"),
        user["org"].alias("org_id"),
        user["org"].alias("org_name"),
        user["roles"].alias("roles"),
        F.col("method").alias("request_method"),
        urls.url_path(F.col("_url")).alias("request_path"),
        urls.url_query(F.col("_url")).alias("request_query_string"),
        "_params",
        _or_null(df, "user_agent").alias("_agent"),
        _or_null(df, "referrer").alias("_referrer"),
        values.response_time_ms(_or_null(df, "response_time"), settings.response_time_unit).alias(
            "response_time"
        ),
        values.int_or_none(_or_null(df, "response_size")).alias("response_size"),
        values.int_or_none(_or_null(df, "status_code")).alias("status_code"),
        (F.col("client_ip") if "client_ip" in df.columns else F.lit("")).alias("client_ip"),
        (F.col("server_address") if "server_address" in df.columns else F.lit("")).alias("server_address"),
        F.struct(
            F.lit("access_log_file").alias("source_type"),
            F.lit(None).cast("string").alias("span_id"),
            F.lit(None).cast("string").alias("trace_id"),
            F.lit(None).cast("string").alias("logger"),
            _or_null(df, "source").alias("source"),
        ).alias("context_data"),
        *([F.when(F.col("_ts").isNull(), F.col("value")).alias("rejected_line")] if rejects else []),
    )
    if mapping is not None:
        records = lookup_app(records, mapping, settings.multi_domain)
    return as_access_records(with_details(records, settings, registry, unsupported), settings, ("rejected_line",) if rejects else ())


def parse_pipe_lines(df: DataFrame, line: str = "value") -> DataFrame:
    """Pipe-delimited lines to columns; the response size may be missing. Duration comes in seconds."""
    parts = F.split(F.col(line), r"\|")
    count = F.size(parts)
    full = len(PIPE_FIELDS)

    def at(i: int):
        # from the size on, the fields of the short form sit one place further left
        if i < full - 2:
            return F.get(parts, F.lit(i))
        if i == full - 2:
            return F.when(count >= full, F.get(parts, F.lit(i)))
        return F.when(count >= full, F.array_join(F.slice(parts, full, count), "|")).otherwise(
            F.get(parts, F.lit(full - 2))
        )

    out = df.filter(F.size(F.split(F.col(line), r"\|")) >= full - 1).withColumns(
        {f"_{name}": values.dash_to_null(F.btrim(at(i))) for i, name in enumerate(PIPE_FIELDS)}
    )
    return out.select(
        F.col("_ip").alias("ip"),
        values.clf_timestamp(F.col("_timestamp")).alias("ts"),
        F.col("_user").alias("user_name"),
        F.col("_org").alias("org_name"),
        F.split("_roles", ",").alias("roles"),
        F.col("_method").alias("request_method"),
        F.col("_path").alias("request_url"),
        values.int_or_none(F.col("_status_code")).alias("status_code"),
        values.response_time_ms(F.col("_response_time"), "s").alias("response_time"),
        values.int_or_none(F.col("_response_size")).alias("response_size"),
        F.col("_user_agent").alias("user_agent"),
    )
