"""Access logs derived from ``events``: the same rules for Spark and for SQL.

The parsed result of a line can thus be compared with the columns the line was made of.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mapmeter.schemas import ACCESS_LOG_SCHEMA, DETAIL_TYPES
from mapmeter.session import spread
from mapmeter.settings import COMBINED_PATTERN, NETTY_SCOPE, Settings

# --- fixed values: options of a set-up with several domains and with coverages ---
MULTI_DOMAIN_PATTERN = r'^(?P<client_ip>[0-9\.]+) (?P<local_ip>[0-9\.]+) (?P<server_address>[-_\w\./:]+) (?P<user_identifier>[-_\w]+) \[(?P<timestamp>.*)\] \"(?P<method>GET|POST|HEAD|OPTION|PUT|PATCH|DELETE|TRACE|CONNECT) (https?:\/\/[_:a-zA-Z0-9\.-]+)?(?P<path>(\/.*)) HTTP\/[\.0-9]{3}\" (?P<status_code>[0-9]{3}) (?P<response_size>[-0-9]*) \"-\" \"(?P<user_agent>[-0-9a-zA-Z\/\.: ();_]*)\" (?P<response_time>[0-9\.]+)$'
OGC_RASTER_FORMATS = {
    "jpeg": "JPEG",
    "gif": "GIF",
    "png": "PNG",
    "tif": "Tiff",
    "geotiff": "GeoTiff",
    "application/gml+xml": "GML Coverage",
    "application/x-netcdf": "NetCDF",
}
# --- end of fixed values ---

SETTINGS = Settings(text_pattern=COMBINED_PATTERN, keys_blacklist=())

OGC = "event_type <> 'purchase'"
APP = (
    "CASE event_type WHEN 'click' THEN 'geoserver' WHEN 'view' THEN 'geoserver'"
    " WHEN 'purchase' THEN 'dataapi' WHEN 'signup' THEN 'mapproxy' ELSE 'mapserver' END"
)
GEO = "event_type IN ('click', 'view')"
SERVICE = "CASE k % 3 WHEN 0 THEN 'WMS' WHEN 1 THEN 'WFS' ELSE 'WMTS' END"
REQUEST = "CASE k % 3 WHEN 0 THEN 'getmap' WHEN 1 THEN 'getfeature' ELSE 'gettile' END"
LAYERS = "CASE WHEN k % 4 = 0 THEN concat('l', k % 10, ',l', (k + 3) % 10) ELSE concat('l', k % 10) END"
# the layer list as requested: prefixed on even k, with a foreign workspace in front now and then
RAW_LAYERS = (
    "CASE WHEN k % 20 = 0 THEN concat('other:l', k % 10, ',ws', k % 3, ':l', (k + 3) % 10)"
    " WHEN k % 4 = 0 THEN concat('ws', k % 3, ':l', k % 10, ',l', (k + 3) % 10)"
    " WHEN k % 2 = 0 THEN concat('ws', k % 3, ':l', k % 10)"
    " ELSE concat('l', k % 10) END"
)
PATH = (
    "CASE event_type WHEN 'signup' THEN concat('/mapproxy/mp', k % 3, '/service')"
    " WHEN 'error' THEN concat('/mapserver/ms', k % 3)"
    " WHEN 'purchase' THEN concat('/dataapi/ogcapi/collections/ds', k % 10, CASE WHEN k % 4 = 0 THEN '/items' ELSE '' END)"
    " ELSE concat('/geoserver/ws', k % 3, '/ows') END"
)

# name -> SQL both engines read the same way
FACTS = {
    "event_id": "event_id",
    "k": "k",
    "id": "concat('e', event_id)",
    "ts": "ts",
    "app_name": APP,
    "app_id": f"concat('/', {APP}, '/')",
    "app_path": f"concat('/', {APP}, '/')",
    "user_id": "concat('u', user_id)",
    "user_name": "concat('u', user_id)",
    "org_id": "concat('o', user_id % 7)",
    "org_name": "concat('o', user_id % 7)",
    "request_method": "CASE WHEN k % 5 = 0 THEN 'POST' ELSE 'GET' END",
    "request_path": PATH,
    "response_time": "CASE WHEN k % 11 = 0 THEN NULL ELSE CAST(floor(value * 10) AS INT) END",
    "response_size": "CASE WHEN k % 7 = 0 THEN NULL ELSE k * 100 END",
    "status_code": "CASE WHEN event_type = 'error' THEN 404 ELSE 200 END",
    "client_ip": "concat('10.0.0.', k)",
    "server_address": "concat('host', k % 2)",
    "service": f"CASE WHEN {OGC} THEN {SERVICE} END",
    "request": f"CASE WHEN {OGC} THEN {REQUEST} WHEN k % 4 = 0 THEN 'items' END",
    "layers": f"CASE WHEN {OGC} THEN {LAYERS} ELSE concat('ds', k % 10) END",
    "workspaces": (
        f"CASE WHEN {GEO} AND k % 20 = 0 THEN concat('other,ws', k % 3) WHEN {GEO} THEN concat('ws', k % 3)"
        " WHEN event_type = 'signup' THEN concat('/mapproxy/mp', k % 3)"
        " WHEN event_type = 'error' THEN concat('/ms', k % 3) END"
    ),
    "tiled": f"CASE WHEN {GEO} AND k % 3 = 0 AND k % 2 = 0 THEN TRUE END",
    "is_download": f"CASE WHEN {GEO} AND k % 3 = 1 AND k % 2 = 0 THEN TRUE WHEN NOT ({OGC}) AND k % 4 = 0 THEN TRUE END",
    "download_format": (
        f"CASE WHEN {GEO} AND k % 3 = 1 AND k % 2 = 0 THEN 'CSV'"
        f" WHEN NOT ({OGC}) AND k % 8 = 0 THEN 'Excel' WHEN NOT ({OGC}) AND k % 4 = 0 THEN 'GeoJSON' END"
    ),
    "full_download": f"CASE WHEN NOT ({OGC}) AND k % 4 = 0 THEN k % 16 = 0 END",
    "user_agent_family": "CASE k % 4 WHEN 0 THEN 'Firefox' WHEN 1 THEN 'QGIS' WHEN 2 THEN 'Chrome' ELSE 'MapProxy' END",
    "referrer": "CASE WHEN k % 6 = 0 THEN concat('https://ref', k % 4, '.example.org/') END",
}

AGENT = (
    "CASE k % 4 WHEN 0 THEN 'Mozilla/5.0 (X11; Linux x86_64; rv:102.0) Gecko/20100101 Firefox/102.0'"
    " WHEN 1 THEN 'Mozilla/5.0 QGIS/3.28 Windows NT 10.0'"
    " WHEN 2 THEN 'Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 Chrome/115.0.0.0 Safari/537.36'"
    " ELSE 'MapProxy-1.15.1' END"
)
ENCODED_LAYERS = "replace(replace({}, ':', '%3A'), ',', '%2C')"
QUERY = (
    f"CASE WHEN NOT ({OGC}) THEN CASE WHEN k % 8 = 0 THEN concat('f=ooxml&limit=', CASE WHEN k % 16 = 0 THEN '-1' ELSE '50' END)"
    " WHEN k % 4 = 0 THEN 'limit=50' ELSE '' END"
    f" ELSE concat('SERVICE=', {SERVICE}, '&VERSION=1.3.0&REQUEST=', CASE k % 3 WHEN 0 THEN 'GetMap' WHEN 1 THEN 'GetFeature' ELSE 'GetTile' END,"
    " CASE k % 3 WHEN 0 THEN '&LAYERS=' WHEN 1 THEN '&typeName=' ELSE '&layer=' END,"
    f" CASE WHEN {GEO} THEN {ENCODED_LAYERS.format(RAW_LAYERS)} ELSE {ENCODED_LAYERS.format(LAYERS)} END,"
    " CASE k % 3 WHEN 0 THEN concat('&CRS=EPSG%3A3857&STYLES=&WIDTH=', CASE WHEN k % 2 = 0 THEN '256' ELSE '769' END, '&HEIGHT=256&FORMAT=image%2Fpng')"
    " WHEN 1 THEN CASE WHEN k % 2 = 0 THEN '&outputFormat=csv' ELSE '' END ELSE '&TILEMATRIX=EPSG%3A3857%3A' END) END"
)
URL = f"concat({PATH}, CASE WHEN {QUERY} <> '' THEN concat('?', {QUERY}) ELSE '' END)"
USER = "CASE WHEN k % 13 = 0 THEN '-' ELSE concat('u', user_id, '|o', user_id % 7, '|ROLE_A,ROLE_', k % 3) END"

# columns of the lines; the time text differs by engine
LINES = {
    **FACTS,
    "line_user": USER,
    "query": QUERY,
    "url": URL,
    "agent": AGENT,
    "sec": "date_trunc('second', ts)",
    "line": (
        f"concat('10.0.0.', k, ' - ', {USER}, ' [', {{stamp}}, ' +0000] \"', CASE WHEN k % 5 = 0 THEN 'POST' ELSE 'GET' END, ' ', {URL},"
        " ' HTTP/1.1\" ', CASE WHEN event_type = 'error' THEN 404 ELSE 200 END, ' ', CASE WHEN k % 7 = 0 THEN '-' ELSE CAST(k * 100 AS VARCHAR(10)) END,"
        f" ' \"-\" \"', {AGENT}, '\" - \"app\" \"-\" ', CASE WHEN k % 11 = 0 THEN 0 ELSE CAST(floor(value * 10) AS INT) END, 'ms')"
    ),
}
SPARK_STAMP = "date_format(ts, 'dd/MMM/yyyy:HH:mm:ss')"
DUCK_STAMP = "strftime(ts, '%d/%b/%Y:%H:%M:%S')"

BASE_SQL = (
    "base AS (SELECT event_id, ts, user_id, event_type, value,"
    " CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events)"
)


def _select(rules: dict[str, str]) -> str:
    return ", ".join(f"{text} AS {name}" for name, text in rules.items())


FACTS_SQL = f"facts AS (SELECT {_select(FACTS)} FROM base)"
LINES_SQL = "lines AS (SELECT {} FROM base)".format(
    _select({n: t.replace("{stamp}", DUCK_STAMP) for n, t in LINES.items()})
)


def with_facts(body: str) -> str:
    return f"WITH {BASE_SQL}, {FACTS_SQL} {body}"


def with_lines(body: str) -> str:
    return f"WITH {BASE_SQL}, {LINES_SQL} {body}"


def with_base(body: str) -> str:
    return f"WITH {BASE_SQL} {body}"


def base(spark: SparkSession, sf: str) -> DataFrame:
    events = spread(spark.read.parquet(f"{sf}/events.parquet"))
    return events.select(
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        "user_id",
        "event_type",
        "value",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    )


def flat(spark: SparkSession, sf: str) -> DataFrame:
    """The facts with details as plain columns."""
    return base(spark, sf).selectExpr(*[f"{t} AS {n}" for n, t in FACTS.items()])


def lines(spark: SparkSession, sf: str) -> DataFrame:
    rules = {n: t.replace("{stamp}", SPARK_STAMP) for n, t in LINES.items()}
    return base(spark, sf).selectExpr(*[f"{t} AS {n}" for n, t in rules.items()])


def facts(spark: SparkSession, sf: str, *more: str) -> DataFrame:
    """The facts in the schema of the fact table, plus the columns named in ``more``."""
    df = flat(spark, sf)
    details = [
        (F.col(n) if n in df.columns else F.lit(None)).cast(t).alias(n)
        for n, t in DETAIL_TYPES.items()
        if n != "tags"
    ]
    tags = F.when(F.col("app_name") != "dataapi", F.array(F.lit("ogc"))).alias("tags")
    df = df.withColumns(
        {
            "request_details": F.struct(
                *details[: list(DETAIL_TYPES).index("tags")],
                tags,
                *details[list(DETAIL_TYPES).index("tags") :],
                F.create_map().cast("map<string,string>").alias("params"),
            ),
            "message": F.concat(F.lit("m"), F.col("event_id")),
            "ts_date": F.to_date("ts"),
        }
    )
    have = {f.name: f.dataType.simpleString() for f in df.schema}

    def fit(field):
        if have.get(field.name) == field.dataType.simpleString():
            return F.col(field.name)
        value = F.col(field.name) if field.name in have else F.lit(None)
        return value.cast(field.dataType).alias(field.name)

    return df.select(*[fit(f) for f in ACCESS_LOG_SCHEMA], *more)


SCOPES = ("org.demo.gateway.accesslog", "org.demo.security-proxy.accesslog", NETTY_SCOPE)
SCOPE_SQL = f"CASE k % 3 WHEN 0 THEN '{SCOPES[0]}' WHEN 1 THEN '{SCOPES[1]}' ELSE '{SCOPES[2]}' END"


def otel(spark: SparkSession, sf: str) -> DataFrame:
    """Telemetry records of the same requests; on even k the parameters come as attributes."""
    df = lines(spark, sf)
    pairs = F.split("query", "&")
    sent = F.transform(
        F.filter(pairs, lambda p: p.contains("=") & (F.lit(True))),
        lambda p: F.struct(
            F.concat(F.lit("http.request.parameter."), F.substring_index(p, "=", 1)).alias("key"),
            F.url_decode(F.substring_index(p, "=", -1)).alias("value"),
        ),
    )
    fixed = F.create_map(
        F.lit("http.request.url"), F.concat(F.lit("https://Maps.Example.org"), F.col("url")),
        F.lit("http.request.method"), F.lower("request_method"),
        F.lit("http.status_code"), F.col("status_code").cast("string"),
        F.lit("http.response.duration_ms"), F.coalesce(F.col("response_time").cast("string"), F.lit("")),
        F.lit("http.request.header.User-Agent"), F.col("agent"),
        F.lit("http.request.header.Referer"), F.coalesce("referrer", F.lit("")),
        F.lit("enduser.id"), F.col("user_name"),
        F.lit("enduser.org.id"), F.col("org_name"),
        F.lit("enduser.roles"), F.lit("ROLE_A,ROLE_B"),
        F.lit("client.address"), F.col("client_ip"),
    )
    attributes = F.when(
        (F.col("k") % 2 == 0) & (F.col("query") != ""), F.map_concat(fixed, F.map_from_entries(sent))
    ).otherwise(fixed)
    return df.select(
        "event_id",
        "k",
        F.col("ts").alias("timestamp"),
        F.col("id").alias("span_id"),
        F.concat(F.lit("t"), F.col("event_id")).alias("trace_id"),
        F.concat(F.lit("GET "), F.col("url")).alias("message"),
        attributes.alias("attributes"),
        F.lit("{}").alias("resources"),
        F.struct(F.expr(SCOPE_SQL).alias("name")).alias("scope"),
        F.lit("opentelemetry").alias("source_type"),
        F.lit("INFO").alias("severity_text"),
        F.lit(9).alias("severity_number"),
        F.col("ts").alias("observed_timestamp"),
        F.lit(1).alias("flags"),
        F.lit(0).alias("dropped_attributes_count"),
    )


# ``events`` has no clock change: spread the rows over the whole of 2024 instead.
YEAR_SPARK = "timestamp_seconds(1704067200 + (event_id * 3163) % 31622400)"
YEAR_SQL = "(TIMESTAMP '2024-01-01 00:00:00' + to_seconds((event_id * 3163) % 31622400))"

JSON_TEXT = (
    "CASE k % 6 WHEN 0 THEN concat('{\"tags\":[\"ogc\",\"t', k, '\"],\"a\":', k, ',\"b\":\"x', k, '\"}')"
    " WHEN 1 THEN concat('[\"l', k, '\",\"m', k, '\"]') WHEN 2 THEN CAST(k AS VARCHAR(10))"
    " WHEN 3 THEN concat('{bad', k) WHEN 4 THEN concat('{\"tags\":[\"other\"],\"b\":\"y\"}') END"
)
