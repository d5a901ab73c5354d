"""Checks of sources, parsing, lookups and ingestion (S…, P…, J…, U2, X…)."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from checks.fixtures import (
    JSON_TEXT, SCOPE_SQL, SCOPES, SETTINGS, base, facts, flat, lines, otel, with_base, with_facts, with_lines,
)
from checks.registry import check
from mapmeter.functions import jsons, ogc, values
from mapmeter.operators import apps, archive, ingest, layers, lookups, maintenance, reconcile, records, telemetry, text
from mapmeter.plans import ingestion
from mapmeter.schemas import LEGACY_SCHEMA, OTEL_SCHEMA
from mapmeter.session import fresh_path
from mapmeter.settings import COMBINED_PATTERN, NETTY_SCOPE, Settings
from mapmeter.sources import changes, csvs, logs, tables

CUTOFF = "2024-01-20 12:00:00"
NETTY_MESSAGE = r"^netty (?P<path>/\S*)$"

# agent text, and by hand: family, version, system
_MOZ, _KIT = "Mozilla/5.0 ", "AppleWebKit/537.36 (KHTML, like Gecko) "
_WIN, _MAC, _LIN = "(Windows NT 10.0; Win64; x64) ", "(Macintosh; Intel Mac OS X 10_15_7) ", "(X11; Linux x86_64) "
_PHONE, _DROID = "(iPhone; CPU iPhone OS 17_2 like Mac OS X) ", "(Linux; Android 13; SM-G991B) "
AGENTS = (
    (f"{_MOZ}{_WIN}{_KIT}Chrome/120.0.0.0 Safari/537.36", "Chrome", "120.0", "Windows"),
    (f"{_MOZ}{_WIN}{_KIT}Chrome/120.0.0.0 Safari/537.36 Edg/120.0.2210.91", "Edge", "120.0", "Windows"),
    (f"{_MOZ}{_WIN}{_KIT}Chrome/52.0.2743.116 Safari/537.36 Edge/15.15063", "Edge", "15.15063", "Windows"),
    (f"{_MOZ}{_WIN}{_KIT}Chrome/119.0.0.0 Safari/537.36 OPR/105.0.0.0", "Opera", "105.0", "Windows"),
    (f"{_MOZ}{_WIN}{_KIT}Chrome/119.0.0.0 Safari/537.36 Vivaldi/6.5", "Vivaldi", "6.5", "Windows"),
    (f"{_MOZ}{_WIN}{_KIT}Chrome/116.0.0.0 YaBrowser/23.9.0 Safari/537.36", "Yandex Browser", "23.9", "Windows"),
    (f"{_MOZ}(Windows NT 10.0; WOW64; Trident/7.0; rv:11.0) like Gecko", "IE", "11.0", "Windows"),
    ("Mozilla/4.0 (compatible; MSIE 8.0; Windows NT 6.1)", "IE", "8.0", "Windows"),
    (f"{_MOZ}(Windows NT 10.0; rv:121.0) Gecko/20100101 Firefox/121.0", "Firefox", "121.0", "Windows"),
    (f"{_MOZ}(X11; Ubuntu; Linux x86_64; rv:109.0) Gecko/20100101 Firefox/118.0", "Firefox", "118.0", "Linux"),
    (f"{_MOZ}(X11; Linux x86_64; rv:91.0) Gecko/20100101 Firefox/91.0 SeaMonkey/2.53.18", "SeaMonkey", "2.53", "Linux"),
    (f"{_MOZ}{_MAC}AppleWebKit/605.1.15 (KHTML, like Gecko) Version/17.2 Safari/605.1.15", "Safari", "17.2", "Mac OS X"),
    (f"{_MOZ}{_MAC}{_KIT}Chrome/120.0.0.0 Safari/537.36", "Chrome", "120.0", "Mac OS X"),
    (f"{_MOZ}{_PHONE}AppleWebKit/605.1.15 (KHTML, like Gecko) Version/17.2 Mobile/15E148 Safari/604.1", "Safari", "17.2", "iOS"),
    (f"{_MOZ}{_PHONE}AppleWebKit/605.1.15 (KHTML, like Gecko) CriOS/120.0.6099.119 Mobile/15E148 Safari/604.1", "Chrome", "120.0", "iOS"),
    (f"{_MOZ}{_PHONE}AppleWebKit/605.1.15 (KHTML, like Gecko) FxiOS/121.0 Mobile/15E148 Safari/605.1.15", "Firefox", "121.0", "iOS"),
    (f"{_MOZ}{_PHONE}AppleWebKit/605.1.15 (KHTML, like Gecko) EdgiOS/120.0.2210.116 Version/17.0 Mobile/15E148 Safari/604.1", "Edge", "120.0", "iOS"),
    (f"{_MOZ}{_DROID}{_KIT}Chrome/120.0.0.0 Mobile Safari/537.36", "Chrome", "120.0", "Android"),
    (f"{_MOZ}{_DROID}{_KIT}SamsungBrowser/23.0 Chrome/115.0.0.0 Mobile Safari/537.36", "Samsung Internet", "23.0", "Android"),
    (f"{_MOZ}{_DROID}{_KIT}Chrome/120.0.0.0 Mobile Safari/537.36 EdgA/120.0.2210.84", "Edge", "120.0", "Android"),
    (f"{_MOZ}(Android 13; Mobile; rv:121.0) Gecko/121.0 Firefox/121.0", "Firefox", "121.0", "Android"),
    (f"{_MOZ}{_LIN}{_KIT}HeadlessChrome/119.0.6045.9 Safari/537.36", "HeadlessChrome", "119.0", "Linux"),
    (f"{_MOZ}{_LIN}{_KIT}Ubuntu Chromium/65.0.3325.181 Chrome/65.0.3325.181 Safari/537.36", "Chromium", "65.0", "Linux"),
    (f"{_MOZ}{_WIN}{_KIT}app/1.0 Chrome/118.0.0.0 Electron/27.1.2 Safari/537.36", "Electron", "27.1", "Windows"),
    (f"{_MOZ}(compatible; Googlebot/2.1; +http://www.google.com/bot.html)", "Googlebot", "2.1", None),
    (f"{_MOZ}(compatible; bingbot/2.0; +http://www.bing.com/bingbot.htm) Chrome/116.0.1938.76 Safari/537.36", "bingbot", "2.0", None),
    (f"{_MOZ}(compatible; YandexBot/3.0; +http://yandex.com/bots)", "YandexBot", "3.0", None),
    (f"{_MOZ}(compatible; AhrefsBot/7.0; +http://ahrefs.com/robot/)", "AhrefsBot", "7.0", None),
    (f"{_MOZ}(compatible; SemrushBot/7~bl; +http://www.semrush.com/bot.html)", "SemrushBot", "7", None),
    (f"{_MOZ}QGIS/32815/Windows 10 Version 2009", "QGIS", "32815", "Windows"),
    (f"{_MOZ}QGIS/3.28 Windows NT 10.0", "QGIS", "3.28", "Windows"),
    ("ArcGIS Pro 3.1.0 (00000000000) - ArcGISPro", "ArcGIS Pro", "3.1", None),
    ("MapProxy-1.15.1", "MapProxy", "1.15", None),
    ("GDAL/3.6.2", "GDAL", "3.6", None),
    ("JOSM/1.5 (18822 fr) Linux Debian GNU/Linux 12 Java/17", "JOSM", "1.5", "Linux"),
    ("FME/2023.7.43 libcurl/7.79.1 (OpenSSL/1.1.1s)", "FME", "2023.7", None),
    ("Apache-HttpClient/4.5.13 (Java/11.0.20)", "Apache-HttpClient", "4.5", None),
    ("Java/17.0.9", "Java", "17.0", None),
    ("okhttp/4.12.0", "okhttp", "4.12", None),
    ("Go-http-client/1.1", "Go-http-client", "1.1", None),
    ("curl/7.88.1", "curl", "7.88", None),
    ("Wget/1.21.3", "Wget", "1.21", None),
    ("python-requests/2.31.0", "Python Requests", "2.31", None),
    ("Python/3.11 aiohttp/3.9.1", "Python aiohttp", "3.9", None),
    ("PostmanRuntime/7.36.0", "PostmanRuntime", "7.36", None),
    ("MyOwnTool 1.0", "Other", None, None),
    ("", None, None, None),
)
AGENTS_SQL = ", ".join("(" + ", ".join("NULL" if v is None else f"'{v}'" for v in row) + ")" for row in AGENTS)

# the two sides of each access, and what becomes of them; see _two_sides
RECONCILED_SQL = with_lines(
    ", placed AS (SELECT *, CASE WHEN k % 13 <> 7 THEN TIMESTAMP '2024-01-01 00:00:00' + to_seconds(event_id * 3) END AS at0,"
    " CASE WHEN k % 9 = 4 THEN NULL WHEN k % 8 = 0 THEN 'hot' ELSE id END AS span FROM lines),"
    " every AS (SELECT *, at0 AS t FROM placed UNION ALL SELECT *, at0 + INTERVAL 2 SECOND FROM placed WHERE k % 10 = 5),"
    " n AS (SELECT span, event_id, t + INTERVAL 200 MILLISECOND AS t, t AS t0, concat('netty ', url) AS message FROM every WHERE k % 3 < 2),"
    " g AS (SELECT span, event_id, t, user_name FROM every WHERE k % 3 > 0),"
    " merged AS (SELECT coalesce(n.span, g.span) AS span_id, n.message AS message,"
    f" concat(CASE WHEN n.message IS NOT NULL THEN '{NETTY_SCOPE}' ELSE '' END, CASE WHEN g.event_id IS NOT NULL THEN '{SCOPES[0]}' ELSE '' END) AS scope,"
    " coalesce(g.t, n.t) AS timestamp, g.user_name AS user_name FROM n FULL OUTER JOIN g ON n.span = g.span AND n.t0 = g.t)"
)


def _line_files(spark, sf):
    path = fresh_path(spark, "lines")
    lines(spark, sf).select("line").write.text(path)
    return path


def _otel_files(spark, sf):
    path = fresh_path(spark, "otel")
    otel(spark, sf).select(*OTEL_SCHEMA.names).write.parquet(path)
    return path


# --- sources -----------------------------------------------------------------------------------


@check("read_text_logs_s1", with_lines("SELECT line AS value, TRUE AS has_source FROM lines"))
def read_text_logs(spark, sf):
    df = logs.read_text_logs(spark, _line_files(spark, sf))
    return df.select("value", F.col("source").contains("/lines-").alias("has_source"))


@check("read_otel_buffer_s2", with_facts(f"SELECT id AS span_id, ts AS timestamp FROM facts WHERE ts < TIMESTAMP '{CUTOFF}'"))
def read_otel_buffer(spark, sf):
    return logs.read_otel_buffer(spark, _otel_files(spark, sf), CUTOFF).select("span_id", "timestamp")


@check("filter_scope_s3", with_base("SELECT concat('e', event_id) AS span_id, CASE WHEN k % 3 = 0 THEN 'names' ELSE 'regex' END AS by FROM base WHERE k % 3 = 0"
                                    " UNION ALL SELECT concat('e', event_id), 'regex' FROM base WHERE k % 3 = 1 UNION ALL SELECT concat('e', event_id), 'regex' FROM base WHERE k % 3 = 0"))
def filter_scope(spark, sf):
    df = otel(spark, sf)
    by_name = telemetry.filter_scope(df, names=[SCOPES[0]]).select("span_id", F.lit("names").alias("by"))
    return by_name.unionByName(telemetry.filter_scope(df).select("span_id", F.lit("regex").alias("by")))


def _twice(spark, sf):
    df = facts(spark, sf, "event_id", "k")
    return df.unionByName(df.filter("event_id % 10 = 0"))


_NULL_IDS = "CASE WHEN k % 9 = 0 THEN NULL ELSE id END"


@check(
    "append_if_absent_s4",
    with_facts(
        f"SELECT id, count(*) AS nb FROM (SELECT {_NULL_IDS} AS id, event_id, k FROM facts"
        # the rows without id never conflict: once per copy, twice for those in both batches
        " UNION ALL SELECT NULL, event_id, k FROM facts WHERE k % 9 = 0 AND event_id % 10 = 0"
        " UNION ALL SELECT NULL, event_id, k FROM facts WHERE k % 9 = 0 AND event_id % 2 = 0"
        " UNION ALL SELECT NULL, event_id, k FROM facts WHERE k % 9 = 0 AND event_id % 2 = 0 AND event_id % 10 = 0) GROUP BY id"
    ),
)
def append_if_absent(spark, sf):
    df = _twice(spark, sf).withColumn("id", F.expr(_NULL_IDS))
    path = fresh_path(spark, "access_logs")
    ingest.append_if_absent(spark, df.filter("event_id % 2 = 0").drop("event_id", "k"), path)
    ingest.append_if_absent(spark, df.drop("event_id", "k"), path)
    return tables.read_access_logs(spark, path).groupBy("id").agg(F.count(F.lit(1)).alias("nb"))


class _Killed(BaseException):
    """Stands for a process that ends."""


@check(
    "append_after_crash_s4",
    with_facts("SELECT id, ts, CAST(ts AS DATE) AS ts_date, (SELECT count(DISTINCT date_trunc('hour', ts)) FROM facts) AS hours_noted FROM facts"),
)
def append_after_crash(spark, sf):
    """Two batches appended by writers that are killed, one before its change is decided and one amid it, and called
    again: every row once, and every hour noted."""
    df, path = facts(spark, sf, "event_id"), fresh_path(spark, "access_logs")
    step = changes._step
    for rows, stop in ((df.filter("event_id % 3 = 0"), "write the journal"), (df, "move ")):
        seen = []

        def stopping(name, seen=seen, stop=stop):
            seen.append(name)
            if name.startswith(stop) and (stop != "move " or sum(s.startswith(stop) for s in seen) > 3):
                raise _Killed

        changes._step = stopping
        try:
            ingest.append_if_absent(spark, rows.drop("event_id"), path)
        except _Killed:
            pass
        finally:
            changes._step = step
        ingest.append_if_absent(spark, rows.drop("event_id"), path)
    hours, _ = changes.notes_since(spark, path, 0)
    return tables.read_access_logs(spark, path).select("id", "ts", "ts_date", F.lit(len(hours)).cast("bigint").alias("hours_noted"))


@check(
    "text_intake_x2",
    with_lines(
        ", many AS (SELECT *, unnest(range(CASE WHEN k % 11 = 0 THEN 3 ELSE 1 END)) AS repeat FROM lines)"
        " SELECT substr(md5(CASE WHEN repeat > 0 THEN concat(line, chr(10), repeat) ELSE line END), 1, 12) AS id, sec AS ts, app_name, layers, response_size,"
        " (SELECT count(*) FROM many) + (SELECT count(*) FROM lines WHERE k % 7 = 0) AS n_lines, (SELECT count(*) FROM lines WHERE k % 7 = 0) AS n_rejected FROM many"
    ),
)
def text_intake(spark, sf):
    """From text files to facts, done twice: lines that stand three times in their file are three accesses, broken ones
    are counted and kept, and nothing comes twice."""
    source, table, rejects = (fresh_path(spark, n) for n in ("in", "access_logs", "rejects"))
    rows = lines(spark, sf)
    thrice = rows.withColumn("n", F.when(F.col("k") % 11 == 0, 3).otherwise(1)).select("line", F.explode(F.sequence(F.lit(1), "n")))
    broken = rows.filter("k % 7 = 0").select(F.concat(F.lit("?"), "line").alias("line"))
    thrice.select("line").coalesce(1).write.text(source)  # equal lines of one file
    broken.write.mode("append").text(source)
    for _ in range(2):
        counts = ingestion.ingest_text(spark, source, table, SETTINGS, rejects=rejects)
    if spark.read.parquet(rejects).filter(F.col("value").startswith("?")).count() != 2 * counts["rejected"]:
        raise AssertionError("rejected lines are lost")
    return tables.read_access_logs(spark, table).select(
        "id", "ts", "app_name", F.col("request_details.layers").alias("layers"), "response_size",
        F.lit(counts["lines"]).cast("bigint").alias("n_lines"), F.lit(counts["rejected"]).cast("bigint").alias("n_rejected"),
    )


@check(
    "compact_s9",
    with_facts("SELECT id, CAST(ts AS DATE) AS ts_date, CASE WHEN ts < TIMESTAMP '2024-01-20 00:00:00' THEN 1 ELSE 2 END AS files FROM facts"),
)
def compact(spark, sf):
    """Two appends leave two files a day; the days before the 20th are written anew as one."""
    df, path = facts(spark, sf, "event_id").drop("event_id"), fresh_path(spark, "access_logs")
    half = F.xxhash64("id") % 2 == 0
    for part in (df.filter(half), df.filter(~half)):
        ingest.append_if_absent(spark, part, path)
    maintenance.compact(spark, path, "ts_date", "2024-01-20 00:00:00")
    stored = tables.read_access_logs(spark, path).withColumn("file", F.col("_metadata.file_path"))
    files = stored.groupBy("ts_date").agg(F.count_distinct("file").cast("int").alias("files"))
    return stored.join(files, "ts_date").select("id", "ts_date", "files")


@check(
    "csv_round_trip_s5_s6",
    with_facts("SELECT id, layers, CASE WHEN k % 2 = 0 THEN concat('a;\"', k, '\"') ELSE 'plain' END AS message, response_time FROM facts"),
)
def csv_round_trip(spark, sf):
    df = facts(spark, sf, "k").withColumn(
        "message", F.expr("CASE WHEN k % 2 = 0 THEN concat('a;\"', k, '\"') ELSE 'plain' END")
    )
    path = fresh_path(spark, "csv")
    wanted = df.select("id", "message", "request_details", "response_time")
    csvs.write_csv(wanted, path)
    back = csvs.load_csv(spark, path, "id string, message string, request_details string, response_time int")
    return back.select("id", F.get_json_object("request_details", "$.layers").alias("layers"), "message", "response_time")


@check(
    "load_csv_s6",
    with_lines("SELECT strftime(ts, '%Y-%m-%dT%H:%M:%S+00:00') AS timestamptz, url AS request_path, agent AS user_agent, CAST(status_code AS VARCHAR) AS status_code, CAST(response_size AS VARCHAR) AS response_size"
               " FROM lines WHERE app_name = 'geoserver'"),
)
def load_csv(spark, sf):
    """Old records as files of two runs, appended to one stored table."""
    df = archive.legacy_line_record(lines(spark, sf).select(F.col("line").alias("value")))
    table, even = fresh_path(spark, "legacy"), F.hash("request_path") % 2 == 0
    for part in (df.filter(even), df.filter(~even)):
        path = fresh_path(spark, "csv")
        csvs.write_csv(part, path)
        csvs.append_csv(spark, [path], table)
    return spark.read.schema(LEGACY_SCHEMA).parquet(table).select("timestamptz", "request_path", "user_agent", "status_code", "response_size")


@check(
    "read_pipe_logs_s7",
    with_base(
        "SELECT concat('10.0.0.', k) AS ip, date_trunc('second', ts) AS ts, concat('u', user_id) AS user_name, 2 AS n_roles, concat('/a?b=', k) AS request_url,"
        " k * 10 AS response_time_plus, CASE WHEN k % 2 = 0 THEN k END AS response_size, concat('Agent|', k) AS user_agent FROM base WHERE k % 2 = 0"
        " UNION ALL SELECT concat('10.0.0.', k), date_trunc('second', ts), concat('u', user_id), 2, concat('/a?b=', k), k * 10, NULL, 'Agent' FROM base WHERE k % 2 = 1"
    ),
)
def read_pipe_logs(spark, sf):
    line = F.expr(
        "concat('10.0.0.', k, '|', date_format(ts, 'dd/MMM/yyyy:HH:mm:ss'), ' +0000|u', user_id, '|org|R1,R2|GET|/a?b=', k, '|200|', k / 100.0,"
        " CASE WHEN k % 2 = 0 THEN concat('|', k, '|Agent|', k) ELSE '|Agent' END)"
    )
    out = text.parse_pipe_lines(base(spark, sf).select(line.alias("value")))
    return out.select(
        "ip", "ts", "user_name", F.size("roles").alias("n_roles"), "request_url",
        F.coalesce("response_time", F.lit(0)).alias("response_time_plus"), "response_size", "user_agent",
    )


@check(
    "drain_buffer_s8",
    with_facts(
        f"SELECT id AS span_id, CAST(ts AS DATE) AS buffer_date, (SELECT count(DISTINCT CAST(ts AS DATE)) FROM facts WHERE ts >= TIMESTAMP '{CUTOFF}') AS days"
        f" FROM facts WHERE ts >= TIMESTAMP '{CUTOFF}' AND k % 9 > 0"
        f" UNION ALL SELECT concat('landed-', id), CASE WHEN k % 9 = 1 THEN CAST(ts AS DATE) END, (SELECT count(DISTINCT CAST(ts AS DATE)) FROM facts WHERE ts >= TIMESTAMP '{CUTOFF}')"
        f" FROM facts WHERE k % 9 = 0 OR (k % 9 = 1 AND ts < TIMESTAMP '{CUTOFF}')"
    ),
)
def drain_buffer(spark, sf):
    """A stored buffer after it was drained: what is left of it, and how many of its days. Records that land while the
    run reads, old ones and some without time, are left."""
    df, path = otel(spark, sf), fresh_path(spark, "buffer")
    timeless = df.filter("k % 9 = 0").withColumn("timestamp", F.lit(None).cast("timestamp"))
    logs.write_otel_buffer(df.filter("k % 9 > 0").unionByName(timeless), path)
    files = logs.pending_files(spark, path, CUTOFF)
    landed = timeless.unionByName(df.filter(f"k % 9 = 1 AND timestamp < '{CUTOFF}'")).withColumn("span_id", F.concat(F.lit("landed-"), "span_id"))
    logs.write_otel_buffer(landed, path)
    logs.drain_stored(spark, path, CUTOFF, files)
    left = spark.read.parquet(path)
    days = left.filter(~F.col("span_id").startswith("landed-")).select("buffer_date").distinct().count()
    return left.select("span_id", "buffer_date", F.lit(days).cast("bigint").alias("days"))


@check(
    "write_access_logs_s9",
    with_facts("SELECT CAST(ts AS DATE) AS ts_date, app_name, count(*) AS nb, CAST(sum(status_code) AS BIGINT) AS codes FROM facts"
               " WHERE ts >= TIMESTAMP '2024-01-05 06:00:00' AND ts < TIMESTAMP '2024-01-12 18:00:00' GROUP BY ALL"),
)
def write_access_logs(spark, sf):
    path = fresh_path(spark, "access_logs")
    tables.write_access_logs(facts(spark, sf), path)
    df = tables.read_access_logs(spark, path, "2024-01-05 06:00:00", "2024-01-12 18:00:00")
    return df.groupBy("ts_date", "app_name").agg(F.count(F.lit(1)).alias("nb"), F.sum("status_code").alias("codes"))


@check("rows_to_process_s10", with_facts(f"SELECT count({_NULL_IDS}) AS nb_rows FROM facts WHERE ts < TIMESTAMP '{CUTOFF}'"))
def rows_to_process(spark, sf):
    df = otel(spark, sf).withColumn("span_id", F.expr("CASE WHEN k % 9 = 0 THEN NULL ELSE span_id END"))
    return logs.rows_to_process(df, CUTOFF)


@check("union_sources_u2", with_facts("SELECT event_id, CASE WHEN k % 2 = 0 THEN app_name END AS app_name FROM facts"))
def union_sources(spark, sf):
    df = flat(spark, sf)
    return logs.union_sources(
        df.filter("k % 2 = 0").select("event_id", "app_name"), df.filter("k % 2 = 1").select("event_id")
    )


# --- parsing -----------------------------------------------------------------------------------


@check(
    "parse_line_p1",
    with_lines(
        "SELECT event_id, client_ip AS ip, CASE WHEN k % 13 = 0 THEN NULL ELSE line_user END AS user, request_method AS method, url AS path, app_name AS app_path,"
        " CAST(status_code AS VARCHAR) AS status_code, CAST(response_size AS VARCHAR) AS response_size, agent AS user_agent, CAST(coalesce(response_time, 0) AS VARCHAR) AS response_time FROM lines"
    ),
)
def parse_line(spark, sf):
    df = text.parse_line(lines(spark, sf).select("event_id", "line"), COMBINED_PATTERN, "line")
    names = ("ip", "user", "method", "path", "app_path", "status_code", "response_size", "user_agent", "response_time")
    return df.select("event_id", *names)


@check("dash_to_null_p2", with_base("SELECT event_id, CASE WHEN k % 2 = 1 THEN concat('-', k) END AS v FROM base"))
def dash_to_null(spark, sf):
    return base(spark, sf).select(
        "event_id", values.dash_to_null(F.expr("CASE WHEN k % 2 = 0 THEN '-' ELSE concat('-', k) END")).alias("v")
    )


@check("with_constants_p3", with_facts("SELECT event_id, 'maps.example.org' AS server_address, '/' AS app_path, app_name FROM facts"))
def with_constants(spark, sf):
    df = flat(spark, sf).select("event_id", "server_address", "app_path", "app_name")
    return text.with_constants(df, {"server_address": "maps.example.org", "app_path": "/"})


@check("drop_unparsed_p4", with_lines("SELECT event_id FROM lines WHERE k % 4 <> 1"))
def drop_unparsed(spark, sf):
    df = lines(spark, sf).select(
        "event_id",
        F.expr("CASE k % 4 WHEN 1 THEN concat('not a log line ', k) ELSE line END").alias("value"),
    )
    return text.drop_unparsed(text.parse_line(df, COMBINED_PATTERN)).select("event_id")


@check("apply_privacy_p5", with_facts("SELECT id, CAST(NULL AS VARCHAR) AS user_id, CAST(NULL AS VARCHAR) AS user_name, CAST(NULL AS VARCHAR) AS client_ip, org_name FROM facts"))
def apply_privacy(spark, sf):
    df = records.apply_privacy(facts(spark, sf), Settings().keys_blacklist)
    return df.select("id", "user_id", "user_name", "client_ip", "org_name")


@check(
    "otel_generics_p6",
    with_base(f"SELECT concat('e', event_id) AS id, ts, 'opentelemetry' AS source_type, concat('t', event_id) AS trace_id, {SCOPE_SQL} AS logger FROM base"),
)
def otel_generics(spark, sf):
    c = F.col("context_data")
    return telemetry.otel_generics(otel(spark, sf)).select(
        "id", "ts", c["source_type"].alias("source_type"), c["trace_id"].alias("trace_id"), c["logger"].alias("logger")
    )


@check(
    "otel_mdc_p7",
    with_lines(
        "SELECT event_id, user_name, org_name, 'ROLE_A;ROLE_B' AS roles, request_method, request_path, lower(query) AS request_query_string, response_time,"
        " status_code, client_ip, 'maps.example.org' AS server_address, app_id, app_name FROM lines"
    ),
)
def otel_mdc(spark, sf):
    df = telemetry.otel_mdc(telemetry.otel_generics(otel(spark, sf)), SETTINGS)
    return df.select(
        "event_id", "user_name", "org_name", F.array_join("roles", ";").alias("roles"), "request_method", "request_path",
        "request_query_string", "response_time", "status_code", "client_ip", "server_address", "app_id", "app_name",
    )


@check(
    "params_from_attributes_p8",
    with_lines("SELECT event_id, CASE WHEN k % 2 = 0 AND app_name <> 'dataapi' THEN upper(service) END AS service, CASE WHEN k % 6 = 0 AND app_name <> 'dataapi' THEN '1.3.0' END AS version_of_maps,"
               " CASE WHEN app_name = 'dataapi' AND k % 16 = 0 THEN '-1' WHEN app_name = 'dataapi' AND k % 4 = 0 THEN '50' END AS items FROM lines"),
)
def params_from_attributes(spark, sf):
    m = F.col("m")
    df = otel(spark, sf).select("event_id", "k", telemetry.params_from_attributes(F.col("attributes")).alias("m"))
    return df.select(
        "event_id", m["service"].alias("service"), F.when(F.col("k") % 3 == 0, m["version"]).alias("version_of_maps"), m["limit"].alias("items")
    )


@check("params_fallback_p9", with_lines("SELECT event_id, CASE WHEN app_name <> 'dataapi' THEN lower(service) END AS service, layers IS NOT NULL AND app_name <> 'dataapi' AS has_layers FROM lines"))
def params_fallback(spark, sf):
    df = telemetry.otel_mdc(telemetry.otel_generics(otel(spark, sf)), SETTINGS)
    p = F.col("_params")
    named = F.coalesce(p["layers"], p["typename"], p["layer"]).isNotNull()
    return df.select("event_id", F.lower(p["service"]).alias("service"), named.alias("has_layers"))


@check(
    "merge_records_p10",
    with_base("SELECT event_id, CASE WHEN k % 2 = 0 THEN 'left' ELSE concat('right', k) END AS a, 'left' AS b, concat('right', k) AS e, CASE WHEN k % 3 = 0 THEN 'text' ELSE 'mdc' END AS best FROM base"),
)
def merge_records(spark, sf):
    left = F.create_map(F.lit("a"), F.lit("left"), F.lit("b"), F.lit("left"))
    value = F.concat(F.lit("right"), F.col("k"))
    right = F.when(F.col("k") % 2 == 0, F.create_map(F.lit("e"), value)).otherwise(
        F.create_map(F.lit("a"), value, F.lit("e"), value)
    )
    m = records.merge_maps(left, right)
    mdc = F.when(F.col("k") % 3 == 0, F.lit("")).otherwise(F.lit("mdc"))
    return base(spark, sf).select(
        "event_id", m["a"].alias("a"), m["b"].alias("b"), m["e"].alias("e"), records.prefer(mdc, F.lit("text")).alias("best")
    )


_PATHS = "CASE k % 4 WHEN 0 THEN '/geoserver/ows' WHEN 1 THEN '/geoserver/web/demo' WHEN 2 THEN '/geoserver/ogc/features/Collections/x' ELSE '/data/ogcapi/collections/x' END"


@check("is_relevant_ogc_p11", with_base("SELECT event_id, k % 4 IN (2, 3) OR k % 3 = 0 AS keep FROM base"))
def is_relevant_ogc(spark, sf):
    query = F.when(F.col("k") % 3 == 0, F.lit("a=1&Service=WMS")).when(F.col("k") % 3 == 1, F.lit("a=1"))
    return base(spark, sf).select(
        "event_id", ogc.is_relevant_ogc(F.expr(_PATHS), query, F.lit("geoserver")).alias("keep")
    )


@check("is_relevant_dataapi_p12", with_base("SELECT event_id, k % 4 = 3 AS keep FROM base"))
def is_relevant_dataapi(spark, sf):
    return base(spark, sf).select("event_id", ogc.is_relevant_dataapi(F.expr(_PATHS)).alias("keep"))


@check("is_relevant_generic_p13", with_base("SELECT event_id FROM base"))
def is_relevant_generic(spark, sf):
    settings = Settings(apps={}, fallback_on_generic=True)
    df = _routable(spark, sf, "'unknown'")
    return apps.route(df, settings).filter("_kind = 'generic'").select("event_id")


def _routable(spark, sf, app: str):
    return base(spark, sf).selectExpr(
        "event_id", "k", f"{app} AS app_name", "CASE WHEN k % 10 = 0 THEN '' ELSE 'id' END AS app_id",
        "'/x/' AS app_path", "'/x/ows' AS request_path", "'service=wms' AS request_query_string",
        "CAST(map() AS map<string,string>) AS _params",
    ).withColumn("app_id", F.when(F.lit(app == "'unknown'"), F.lit("id")).otherwise(F.col("app_id")))


_UUID_PATH = (
    "concat(CASE k % 4 WHEN 0 THEN '/srv/api/records/' WHEN 1 THEN '/catalog.search#/metadata/' WHEN 2 THEN '/dataset/' ELSE '/other/' END,"
    " 'da165110-88fd-11da-a88f-', lpad(CAST(event_id % 100000 AS VARCHAR(9)), CASE WHEN k % 5 = 0 THEN 11 ELSE 12 END, '0'))"
)


@check("is_relevant_metadata_p14", with_base("SELECT event_id, k % 4 < 2 AND k % 5 > 0 AS catalogue, k % 4 = 2 AND k % 5 > 0 AS hub FROM base"))
def is_relevant_metadata(spark, sf):
    path = F.expr(_UUID_PATH)
    return base(spark, sf).select(
        "event_id", ogc.is_relevant_geonetwork(path).alias("catalogue"), ogc.is_relevant_datahub(path).alias("hub")
    )


@check("is_relevant_legacy_p15", with_base("SELECT event_id, k % 2 = 0 AS mviewer, k % 3 = 0 AS geoserver FROM base"))
def is_relevant_legacy(spark, sf):
    path = F.expr("concat('/x?', CASE WHEN k % 2 = 0 THEN 'Config=a&' ELSE '' END, CASE WHEN k % 3 = 0 THEN 'SERVICE=WMS' ELSE '' END)")
    return base(spark, sf).select(
        "event_id", ogc.is_relevant_mviewer(path).alias("mviewer"), ogc.is_relevant_geoserver_legacy(path).alias("geoserver")
    )


@check("require_app_p16", with_base("SELECT event_id FROM base WHERE k % 10 <> 0"))
def require_app(spark, sf):
    df = apps.route(_routable(spark, sf, "'GeoServer'"), SETTINGS)
    return df.filter("_kind IS NOT NULL").select("event_id")


@check(
    "route_or_drop_p17",
    with_base("SELECT event_id, CASE WHEN k % 10 = 0 THEN NULL WHEN k % 3 = 0 THEN 'geoserver' WHEN k % 3 = 1 THEN 'mapproxy' END AS strict,"
              " CASE WHEN k % 10 = 0 THEN NULL WHEN k % 3 = 0 THEN 'geoserver' WHEN k % 3 = 1 THEN 'mapproxy' ELSE 'generic' END AS lenient FROM base"),
)
def route_or_drop(spark, sf):
    df = _routable(spark, sf, "CASE k % 3 WHEN 0 THEN 'geoserver' WHEN 1 THEN 'mapproxy' ELSE 'strange' END")
    strict = apps.route(df, SETTINGS).withColumnRenamed("_kind", "strict")
    lenient = apps.route(strict, Settings(fallback_on_generic=True))
    return lenient.select("event_id", "strict", F.col("_kind").alias("lenient"))


@check("has_tag_p18", with_facts("SELECT event_id, app_name <> 'dataapi' AS typed, k % 6 = 0 AS by_json FROM facts"))
def has_tag(spark, sf):
    df = facts(spark, sf, "event_id", "k")
    typed = F.coalesce(jsons.has_tag(F.col("request_details"), "ogc"), F.lit(False))
    return df.select("event_id", typed.alias("typed"), jsons.json_has_tag(F.expr(JSON_TEXT), "ogc").alias("by_json"))


@check("filter_app_p19", with_facts("SELECT id, app_name FROM facts WHERE app_name IN ('geoserver', 'dataapi')"))
def filter_app(spark, sf):
    return maintenance.filter_app(facts(spark, sf), "geoserver", "dataapi").select("id", "app_name")


@check("filter_json_value_p20", with_facts("SELECT id FROM facts WHERE is_download"))
def filter_json_value(spark, sf):
    js = jsons.details_to_json(F.col("request_details"))
    return facts(spark, sf).filter(jsons.json_get(js, "is_download") == "true").select("id")


@check("json_kind_p21", with_base("SELECT event_id, CASE k % 6 WHEN 0 THEN 'object' WHEN 1 THEN 'array' WHEN 2 THEN 'scalar' WHEN 4 THEN 'object' END AS kind FROM base"))
def json_kind(spark, sf):
    return base(spark, sf).select("event_id", jsons.json_kind(F.expr(JSON_TEXT)).alias("kind"))


@check("purge_p22", with_base("SELECT event_id FROM base WHERE NOT (k % 5 = 0 OR k % 9 = 0)"))
def purge(spark, sf):
    df = base(spark, sf).selectExpr(
        "event_id", "CASE WHEN k % 5 = 0 THEN '' WHEN k % 7 = 0 THEN NULL ELSE 'm' END AS message",
        "CASE WHEN k % 9 = 0 THEN NULL ELSE 's' END AS span_id",
    )
    return maintenance.purge(df, (F.col("message") == "") | F.col("span_id").isNull()).select("event_id")


@check(
    "backfill_p23",
    with_facts("SELECT id, 'maps.example.org' AS server_address, CASE WHEN app_name = 'geoserver' THEN '/catalogue/' ELSE app_id END AS app_id, CASE WHEN app_name = 'geoserver' THEN 'x' END AS extra FROM facts"),
)
def backfill(spark, sf):
    df = maintenance.backfill(facts(spark, sf), "server_address", "maps.example.org")
    df = maintenance.backfill(df, "app_id", "/catalogue/", F.col("app_name") == "geoserver")
    df = maintenance.backfill(df, "extra", "x", F.col("app_name") == "geoserver")
    return df.select("id", "server_address", "app_id", "extra")


@check("set_tag_p24", with_facts("SELECT id, CASE WHEN app_name IN ('dataapi', 'mapproxy') THEN 'all' ELSE 'ogc' END AS tag, layers FROM facts"))
def set_tag(spark, sf):
    df = maintenance.set_tag(facts(spark, sf), ["dataapi", "mapproxy"], "all")
    d = F.col("request_details")
    return df.select("id", F.array_join(d["tags"], ",").alias("tag"), d["layers"].alias("layers"))


_RAW = "concat('x http://h', k, '/', CASE k % 4 WHEN 0 THEN 'geoserver' WHEN 1 THEN 'geowebcache' WHEN 2 THEN 'cadastrapp' ELSE 'other' END, '/a')"


@check("classify_line_p25", with_base("SELECT event_id, CASE k % 4 WHEN 0 THEN 'geoserver' WHEN 1 THEN 'geowebcache' WHEN 2 THEN 'cadastrapp' END AS app FROM base"))
def classify_line(spark, sf):
    return base(spark, sf).select("event_id", maintenance.classify_line(F.expr(_RAW)).alias("app"))


@check("prune_fields_p26", with_base("SELECT event_id, 'event_id,k,message,scope,span_id' AS netty, 'attributes,dropped_attributes_count,event_id,flags,k,observed_timestamp,resources,scope,severity_number,severity_text,source_type,span_id,timestamp,trace_id' AS gateway FROM base"))
def prune_fields(spark, sf):
    """The names of the fields that each record still has, read off the records themselves."""
    df = otel(spark, sf)

    def names(side):
        pruned = reconcile.prune_fields(df, side)
        record = F.from_json(F.to_json(F.struct(*pruned.columns), {"ignoreNullFields": "false"}), "map<string,string>")
        return pruned.select("event_id", F.array_join(F.array_sort(F.map_keys(record)), ",").alias(side))

    return names("netty").join(names("gateway"), "event_id")


@check(
    "text_logs_to_records_x2",
    with_lines(
        "SELECT substr(md5(line), 1, 12) AS id, sec AS ts, CASE WHEN k % 13 > 0 THEN user_name END AS user_name, app_name, request_path, CASE WHEN response_time > 0 THEN response_time END AS response_time, response_size,"
        " service, request, layers, workspaces, tiled, is_download, download_format, full_download, user_agent_family FROM lines WHERE app_name <> 'dataapi'"
        " UNION ALL SELECT substr(md5(line), 1, 12), sec, CASE WHEN k % 13 > 0 THEN user_name END, app_name, request_path, CASE WHEN response_time > 0 THEN response_time END, response_size,"
        " service, request, layers, workspaces, tiled, is_download, download_format, full_download, user_agent_family FROM lines WHERE app_name = 'dataapi'"
    ),
)
def text_logs_to_records(spark, sf):
    df = text.parse_text_logs(lines(spark, sf).select(F.col("line").alias("value")), SETTINGS)
    d = F.col("request_details")
    names = ("service", "request", "layers", "workspaces", "tiled", "is_download", "download_format", "full_download", "user_agent_family")
    return df.select("id", "ts", "user_name", "app_name", "request_path", "response_time", "response_size", *[d[n].alias(n) for n in names])


@check(
    "telemetry_to_records_x2",
    with_facts("SELECT id, ts, user_name, org_name, app_name, status_code, response_time, service, request, layers, workspaces, tiled, is_download, user_agent_family, referrer FROM facts WHERE k % 3 < 2"),
)
def telemetry_to_records(spark, sf):
    df = telemetry.parse_telemetry(telemetry.filter_scope(otel(spark, sf)), SETTINGS)
    d = F.col("request_details")
    names = ("service", "request", "layers", "workspaces", "tiled", "is_download", "user_agent_family", "referrer")
    return df.select("id", "ts", "user_name", "org_name", "app_name", "status_code", "response_time", *[d[n].alias(n) for n in names])


@check("custom_pattern_x3", with_base("SELECT event_id, concat('s', k) AS span_id, concat('hello ', k) AS message FROM base"))
def custom_pattern(spark, sf):
    df = base(spark, sf).select(
        "event_id", F.expr("concat(date_format(ts, 'yyyy-MM-dd HH:mm:ss'), ' s', k, ' t', k, ' hello ', k)").alias("value")
    )
    pattern = r"(?P<timestamp>\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}) (?P<span_id>\w+) (?P<trace_id>\w+) (?P<message>.*)"
    return text.parse_line(df, pattern).select("event_id", "span_id", "message")


@check("custom_processor_x1", with_facts("SELECT event_id, concat('tile-', k) AS layers, 'custom' AS tag FROM facts WHERE k % 2 = 0"))
def custom_processor(spark, sf):
    mine = apps.Processor(
        "tiler",
        lambda r: r.path.startswith("/tiler/x"),
        lambda r: {"layers": F.concat(F.lit("tile-"), F.regexp_extract(r.path, r"(\d+)$", 1)), "tags": F.array(F.lit("custom"))},
        base="empty",
    )
    df = base(spark, sf).selectExpr(
        "event_id", "'tiler' AS app_name", "'tiler' AS app_id", "'/tiler/' AS app_path",
        "concat('/tiler/', CASE WHEN k % 2 = 0 THEN 'x' ELSE 'y' END, k) AS request_path", "'' AS request_query_string",
        "CAST(map() AS map<string,string>) AS _params", "CAST(NULL AS STRING) AS _agent", "CAST(NULL AS STRING) AS _referrer",
    )
    out = apps.with_details(df, SETTINGS, apps.register(mine))
    d = F.col("request_details")
    return out.select("event_id", d["layers"].alias("layers"), F.array_join(d["tags"], ",").alias("tag"))


@check(
    "legacy_line_record_f35",
    with_lines(
        "SELECT strftime(ts, '%Y-%m-%dT%H:%M:%S+00:00') AS timestamptz, CASE WHEN k % 13 > 0 THEN user_name END AS username, url AS request_path, request_method AS request_type, app_name,"
        " CAST(coalesce(response_time, 0) AS VARCHAR) AS response_time, CAST(response_size AS VARCHAR) AS response_size, lower(service) AS service, CASE WHEN k % 3 = 0 THEN layers END AS layers,"
        " user_agent_family IS NOT NULL AS has_agent, CASE WHEN k % 13 > 0 THEN org_name END AS org FROM lines WHERE app_name = 'geoserver'"
    ),
)
def legacy_line_record(spark, sf):
    df = archive.legacy_line_record(lines(spark, sf).select(F.col("line").alias("value")))
    assert df.schema.names == LEGACY_SCHEMA.names
    return df.select(
        "timestamptz", "username", "request_path", "request_type", "app_name", "response_time", "response_size",
        F.get_json_object("app_details", "$.service").alias("service"), F.get_json_object("app_details", "$.layers").alias("layers"),
        (F.col("user_agent") != "").alias("has_agent"), "org",
    )


# --- joins -------------------------------------------------------------------------------------


@check("absent_rows_j1", with_facts("SELECT event_id FROM facts WHERE event_id % 3 <> 0 OR k % 9 = 0"))
def absent_rows(spark, sf):
    df = facts(spark, sf, "event_id", "k").withColumn("id", F.expr(_NULL_IDS))
    return ingest.absent_rows(df, df.filter("event_id % 3 = 0")).select("event_id")


@check("dedupe_keep_first_j2", with_facts(f"SELECT {_NULL_IDS} AS id, 1 AS copy FROM facts UNION ALL SELECT NULL, 2 FROM facts WHERE k % 9 = 0 AND event_id % 10 = 0"))
def dedupe_keep_first(spark, sf):
    df = facts(spark, sf, "event_id", "k").withColumn("id", F.expr(_NULL_IDS))
    both = df.withColumn("oid", F.lit(1)).unionByName(df.filter("event_id % 10 = 0").withColumn("oid", F.lit(2)))
    return ingest.dedupe_keep_first(both).select("id", F.col("oid").alias("copy"))


@check(
    "lookup_app_j3",
    with_facts("SELECT event_id, CASE app_id WHEN '/mapproxy/' THEN 'cache' WHEN '/dataapi/' THEN 'api' ELSE app_name END AS by_table,"
               " CASE app_id WHEN '/mapproxy/' THEN 'cache' WHEN '/dataapi/' THEN 'api' ELSE app_name END AS by_option FROM facts"),
)
def lookup_app(spark, sf):
    """A table of over 5,000 ids, one of them twice, against the few ids that matter as an option."""
    mapping = {"/mapproxy/": "cache", "/dataapi/": "api"}
    more = spark.range(5_000).selectExpr("concat('/unused', id, '/') AS app_id", "concat('u', id) AS app_name")
    again = [("dataapi", "api"), ("/dataapi", "zzz")]
    table = spark.createDataFrame([*mapping.items(), *again], "app_id string, app_name string").unionByName(more)
    df = lookups.lookup_app(flat(spark, sf).select("event_id", "app_id", "app_name"), table)
    return df.select(
        "event_id", F.col("app_name").alias("by_table"), lookups.app_name(F.col("app_id"), mapping).alias("by_option")
    )


@check(
    "lookup_format_j4",
    with_base("SELECT event_id, CASE WHEN k % 4 = 0 THEN 'CSV' WHEN k % 4 = 1 THEN 'Shapefile' END AS label, k % 4 < 2 AS known_format FROM base"),
)
def lookup_format(spark, sf):
    df = base(spark, sf).selectExpr(
        "event_id", "'geoserver' AS app_name", "'vector' AS kind",
        "CASE k % 4 WHEN 0 THEN 'csv' WHEN 1 THEN 'shape-zip' WHEN 2 THEN 'gml' END AS format",
    )
    out = lookups.lookup_format(df, lookups.formats_table(df, SETTINGS))
    return out.select("event_id", "label", "known_format")


@check(
    "unnest_layers_j5",
    with_facts("SELECT id, unnest(string_split(layers, ',')) AS layer, service, request, tiled FROM facts WHERE app_name = 'geoserver'"),
)
def unnest_layers(spark, sf):
    d = F.col("request_details")
    df = layers.unnest_layers(maintenance.filter_app(facts(spark, sf), "geoserver"))
    return df.select("id", "layer", d["service"].alias("service"), d["request"].alias("request"), d["tiled"].alias("tiled"))


@check(
    "reconcile_j6",
    RECONCILED_SQL + " SELECT * FROM merged",
)
def reconcile_batch(spark, sf):
    return _reconciled(reconcile.reconcile(*_two_sides(spark, sf)))


def _reconciled(df):
    return df.select(
        "span_id", "message", F.col("scope.name").alias("scope"), "timestamp", F.col("attributes")["enduser.id"].alias("user_name")
    )


def _two_sides(spark, sf):
    """Netty and gateway records of the requests: both (k % 3 = 1) or one; a hot span (k % 8 = 0) whose records
    lie far apart; spans repeated after a while (k % 10 = 5); no span (k % 9 = 4) and no time (k % 13 = 7)."""
    df = otel(spark, sf).withColumn("_url", F.substr("message", F.lit(5)))
    df = df.withColumns(
        {
            "timestamp": F.expr("CASE WHEN k % 13 <> 7 THEN timestamp_seconds(1704067200 + event_id * 3) END"),
            "span_id": F.expr("CASE WHEN k % 9 = 4 THEN NULL WHEN k % 8 = 0 THEN 'hot' ELSE span_id END"),
        }
    )
    again = df.filter("k % 10 = 5").withColumn("timestamp", F.expr("timestamp + INTERVAL 2 SECONDS"))
    df = df.unionByName(again)
    netty = df.filter("k % 3 < 2").withColumns(
        {
            "timestamp": F.expr("timestamp + INTERVAL 200 MILLISECONDS"),
            "message": F.concat(F.lit("netty "), F.col("_url")),
            "scope": F.struct(F.lit(NETTY_SCOPE).alias("name")),
        }
    )
    gateway = df.filter("k % 3 > 0").withColumn("scope", F.struct(F.lit(SCOPES[0]).alias("name")))
    names = OTEL_SCHEMA.names
    return netty.select(*names), gateway.select(*names)


@check(
    "reconciled_to_facts",
    RECONCILED_SQL
    + """ SELECT kind, count(*) AS nb, count(DISTINCT id) AS ids, CAST(sum(has_user) AS BIGINT) AS users, CAST(sum(has_path) AS BIGINT) AS paths FROM (
            SELECT CASE WHEN timestamp IS NULL THEN 'rejected' WHEN scope = {both} THEN 'merged' WHEN scope = {netty} THEN 'netty' ELSE 'gateway' END AS kind,
                   CASE WHEN span_id IS NULL OR timestamp IS NULL THEN concat('x', row_number() OVER ()) ELSE concat(span_id, timestamp) END AS id,
                   CASE WHEN user_name IS NOT NULL AND timestamp IS NOT NULL THEN 1 ELSE 0 END AS has_user, CASE WHEN timestamp IS NOT NULL THEN 1 ELSE 0 END AS has_path
            FROM merged) GROUP BY kind""".replace("{both}", f"'{NETTY_SCOPE}{SCOPES[0]}'").replace("{netty}", f"'{NETTY_SCOPE}'"),
)
def reconciled_to_facts(spark, sf):
    """From the two sides to facts: merged, lone and unreadable records, none lost. Done twice, with one result."""
    netty, gateway = fresh_path(spark, "netty"), fresh_path(spark, "gateway")
    for side, path in zip(_two_sides(spark, sf), (netty, gateway)):
        side.write.parquet(path)
    table, rejects = fresh_path(spark, "access_logs"), fresh_path(spark, "rejects")
    settings = replace(SETTINGS, parse_message=True, message_pattern=NETTY_MESSAGE)
    for _ in range(2):
        ingestion.ingest_reconciled(spark, netty, gateway, table, settings, "2030-01-01", rejects=rejects, unsupported="keep")
    df = tables.read_access_logs(spark, table)
    logger = F.col("context_data.logger")
    kind = F.when(logger == NETTY_SCOPE + SCOPES[0], "merged").when(logger == NETTY_SCOPE, "netty").otherwise("gateway")
    facts_ = df.select(kind.alias("kind"), F.concat("id", F.col("ts").cast("string")).alias("id"), "user_name", "request_path")
    # the second run rejects the same rows again
    lost = spark.read.parquet(rejects).select(F.lit("rejected").alias("kind"), "message").groupBy("kind").agg((F.count(F.lit(1)) / 2).cast("bigint").alias("nb"))
    lost = lost.select("kind", "nb", F.col("nb").alias("ids"), F.lit(0).cast("bigint").alias("users"), F.lit(0).cast("bigint").alias("paths"))
    return facts_.groupBy("kind").agg(
        F.count(F.lit(1)).alias("nb"), F.count_distinct("id").alias("ids"),
        F.sum((F.coalesce("user_name", F.lit("")) != "").cast("bigint")).alias("users"),
        F.sum((F.coalesce("request_path", F.lit("")) != "").cast("bigint")).alias("paths"),
    ).unionByName(lost)


@check(
    "lookup_user_agent_j7",
    with_base(
        f", a(text, user_agent_family, user_agent_version, os_family) AS (VALUES {AGENTS_SQL})"
        f" SELECT event_id, user_agent_family, user_agent_version, os_family FROM base JOIN (SELECT *, row_number() OVER () - 1 AS n FROM a) ON n = event_id % {len(AGENTS)}"
    ),
)
def lookup_user_agent(spark, sf):
    texts = F.array(*[F.lit(a[0]) for a in AGENTS])
    df = base(spark, sf).select("event_id", F.get(texts, (F.col("event_id") % len(AGENTS)).cast("int")).alias("agent"))
    return lookups.lookup_user_agent(df, "agent").select("event_id", "user_agent_family", "user_agent_version", "os_family")


# --- orders ------------------------------------------------------------------------------------


@check("page_o1", with_facts("SELECT id AS span_id, ts AS timestamp FROM facts ORDER BY ts DESC, id ASC LIMIT 100 OFFSET 100"))
def page(spark, sf):
    return ingest.page(otel(spark, sf), 100, 100).select("span_id", "timestamp")


@check("order_result_o2", with_facts("SELECT service, request, layers, count(*) AS nb FROM facts GROUP BY ALL ORDER BY service NULLS LAST, request NULLS LAST, layers NULLS LAST"))
def order_result(spark, sf):
    df = flat(spark, sf).groupBy("service", "request", "layers").agg(F.count(F.lit(1)).alias("nb"))
    return ingest.order_result(df, "service", "request", "layers")
