"""Checks of the column functions (F…)."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.fixtures import (
    JSON_TEXT, SETTINGS, YEAR_SPARK, YEAR_SQL, base, flat, lines, with_base, with_facts, with_lines,
)
from checks.registry import check
from mapmeter.functions import jsons, legacy, ogc, times, urls, values
from mapmeter.functions.jsons import details_to_json
from mapmeter.operators import apps
from mapmeter.operators.layers import unnest_json_array

_SUMMER = "{0} >= TIMESTAMP '2024-03-31 01:00:00' AND {0} < TIMESTAMP '2024-10-27 01:00:00'"


@check(
    "bucket_tz_f1",
    with_base(
        f", t AS (SELECT event_id, {YEAR_SQL} AS ts FROM base), l AS (SELECT event_id, ts,"
        f" CASE WHEN {_SUMMER.format('ts')} THEN ts + INTERVAL 2 HOUR ELSE ts + INTERVAL 1 HOUR END AS loc FROM t),"
        " d AS (SELECT event_id, ts, date_trunc('day', loc) AS day, date_trunc('month', loc) AS mon FROM l)"
        " SELECT event_id, date_trunc('hour', ts) AS h,"
        " day - CASE WHEN day > TIMESTAMP '2024-03-31' AND day <= TIMESTAMP '2024-10-27' THEN INTERVAL 2 HOUR ELSE INTERVAL 1 HOUR END AS d,"
        " mon - CASE WHEN mon > TIMESTAMP '2024-03-31' AND mon <= TIMESTAMP '2024-10-27' THEN INTERVAL 2 HOUR ELSE INTERVAL 1 HOUR END AS m FROM d"
    ),
)
def bucket_tz(spark, sf):
    ts = F.expr(YEAR_SPARK)
    return base(spark, sf).select(
        "event_id", *[times.bucket(g, ts, "Europe/Paris").alias(g[0]) for g in ("hour", "day", "month")]
    )


@check(
    "split_url_f2",
    "SELECT page_id, split_part(regexp_extract(lower(url), '^[a-z]+://([^/?#]+)', 1), ':', 1) AS host,"
    " regexp_extract(lower(url), '^[a-z]+://[^/?#]+([^?#]*)', 1) AS path,"
    " regexp_extract(lower(url), '[?]([^#]*)', 1) AS query, regexp_extract(lower(url), '#(.*)$', 1) AS fragment FROM pages",
)
def split_url(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    return pages.select("page_id", urls.split_url(F.col("url")).alias("u")).select("page_id", "u.*")


@check(
    "query_map_f3",
    with_lines(
        ", p AS (SELECT event_id, string_split(lower(concat(query, '&layers=dup%2Bx&flag&blank=&x=a+b')), '&') AS parts FROM lines),"
        " e AS (SELECT event_id, unnest(parts) AS part, unnest(range(len(parts))) AS pos FROM p),"
        " kv AS (SELECT event_id, pos, split_part(part, '=', 1) AS key, lower(url_decode(replace(split_part(part, '=', 2), '+', ' '))) AS val FROM e WHERE part LIKE '%=_%')"
        " SELECT event_id, key, val FROM kv QUALIFY row_number() OVER (PARTITION BY event_id, key ORDER BY pos) = 1"
    ),
)
def query_map(spark, sf):
    df = lines(spark, sf).select(
        "event_id", F.concat("query", F.lit("&layers=dup%2Bx&flag&blank=&x=a+b")).alias("q")
    )
    out = urls.settle_query_map(df, "m", F.lower("q"))
    return out.select("event_id", F.explode("m").alias("key", "val"))


@check(
    "url_decode_f4",
    with_base("SELECT event_id, concat('a b', k, '%/', event_type, '=é') AS decoded FROM base"),
)
def url_decode(spark, sf):
    text = F.concat(F.lit("a+b"), F.col("k"), F.lit("%%2F"), F.col("event_type"), F.lit("%3d%C3%A9"))
    return base(spark, sf).select("event_id", urls.url_decode(text).alias("decoded"))


_NUMBER = "CASE k % 5 WHEN 0 THEN concat(k, 'x') WHEN 1 THEN concat(k, '.9') WHEN 2 THEN '99999999999' WHEN 3 THEN '' ELSE CAST(k AS VARCHAR(9)) END"


@check("int_or_none_f5", with_base("SELECT event_id, CASE WHEN k % 5 = 4 THEN k END AS n FROM base"))
def int_or_none(spark, sf):
    return base(spark, sf).select("event_id", values.int_or_none(F.expr(_NUMBER)).alias("n"))


@check(
    "float_or_none_f6",
    with_base("SELECT event_id, CASE k % 5 WHEN 1 THEN k + 0.9e0 WHEN 2 THEN 99999999999e0 WHEN 4 THEN CAST(k AS DOUBLE) END AS n FROM base"),
)
def float_or_none(spark, sf):
    return base(spark, sf).select("event_id", values.float_or_none(F.expr(_NUMBER)).alias("n"))


@check(
    "app_path_f7",
    with_facts("SELECT event_id, CASE WHEN k % 9 = 0 THEN '/' ELSE app_path END AS app_path FROM facts"),
)
def app_path(spark, sf):
    return flat(spark, sf).select(
        "event_id", values.app_path(F.initcap("request_path"), F.col("k") % 9 == 0).alias("app_path")
    )


@check(
    "app_id_f8",
    with_facts(
        "SELECT event_id, app_path AS one_domain, concat(CASE WHEN k % 2 = 0 THEN server_address ELSE '' END, app_path) AS many_domains FROM facts"
    ),
)
def app_id(spark, sf):
    host = F.when(F.col("k") % 2 == 0, F.col("server_address"))
    return flat(spark, sf).select(
        "event_id",
        values.app_id(host, F.col("app_path")).alias("one_domain"),
        values.app_id(host, F.col("app_path"), True).alias("many_domains"),
    )


@check(
    "split_user_f9",
    with_lines(
        "SELECT event_id, CASE WHEN k % 13 <> 0 THEN user_name END AS name, CASE WHEN k % 13 <> 0 THEN org_name END AS org,"
        " CASE WHEN k % 13 <> 0 THEN concat('ROLE_', k % 3, ';ROLE_A') END AS roles FROM lines"
    ),
)
def split_user(spark, sf):
    user = values.split_user(values.dash_to_null(F.col("line_user")))
    return lines(spark, sf).select(
        "event_id", user["name"].alias("name"), user["org"].alias("org"),
        F.array_join(F.reverse(user["roles"]), ";").alias("roles"),
    )


@check("request_id_f10", with_lines("SELECT event_id, substr(md5(line), 1, 12) AS rid FROM lines"))
def request_id(spark, sf):
    return lines(spark, sf).select("event_id", values.request_id(F.col("line")).alias("rid"))


@check(
    "response_time_f11",
    with_base("SELECT event_id, CASE WHEN k > 0 THEN k * 1000 + 500 END AS from_s, CASE WHEN k > 0 THEN k END AS from_ms FROM base"),
)
def response_time(spark, sf):
    text = F.when(F.col("k") == 0, F.lit("0")).otherwise(F.concat("k", F.lit(".5")))
    return base(spark, sf).select(
        "event_id",
        values.response_time_ms(text, "s").alias("from_s"),
        values.response_time_ms(text).alias("from_ms"),
    )


@check("clf_timestamp_f12", with_base("SELECT event_id, date_trunc('second', ts) - INTERVAL 90 MINUTE AS ts FROM base"))
def clf_timestamp(spark, sf):
    text = F.concat(F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss"), F.lit(" +0130"))
    return base(spark, sf).select("event_id", values.clf_timestamp(text).alias("ts"))


@check(
    "split_roles_f13",
    with_base("SELECT event_id, CASE WHEN k % 4 = 0 THEN 1 ELSE k % 4 END AS n, CASE WHEN k % 4 = 0 THEN '' ELSE 'R0' END AS first_role FROM base"),
)
def split_roles(spark, sf):
    text = F.expr("array_join(transform(sequence(0, k % 4), i -> concat('R', i)), ',')")
    roles = values.split_roles(F.when(F.col("k") % 4 == 0, F.lit("")).otherwise(F.regexp_replace(text, ",R[0-9]$", "")))
    return base(spark, sf).select("event_id", F.size(roles).alias("n"), roles[0].alias("first_role"))


@check(
    "strip_app_path_f14",
    with_facts("SELECT event_id, substr(request_path, length(app_name) + 2) AS stripped, request_path AS kept FROM facts"),
)
def strip_app_path(spark, sf):
    path = F.col("request_path")
    return flat(spark, sf).select(
        "event_id",
        ogc.strip_app_path(path, F.col("app_path")).alias("stripped"),
        ogc.strip_app_path(path, F.lit("absent")).alias("kept"),
    )


def _params(spark, sf):
    df = lines(spark, sf)
    return urls.settle_query_map(df, "params", F.lower("query"))


@check(
    "ogc_params_f15",
    with_lines(
        "SELECT event_id, service, request, CASE WHEN k % 20 = 0 AND app_name = 'geoserver' THEN concat('other:l', k % 10, ',ws', k % 3, ':l', (k + 3) % 10)"
        " WHEN k % 4 = 0 AND app_name = 'geoserver' THEN concat('ws', k % 3, ':l', k % 10, ',l', (k + 3) % 10)"
        " WHEN k % 2 = 0 AND app_name = 'geoserver' THEN concat('ws', k % 3, ':l', k % 10) ELSE layers END AS layers,"
        " CASE WHEN k % 3 = 0 THEN 'EPSG:3857' END AS crs FROM lines WHERE app_name <> 'dataapi'"
    ),
)
def ogc_params(spark, sf):
    m = F.col("params")
    return _params(spark, sf).filter("app_name <> 'dataapi'").select(
        "event_id",
        F.upper(m["service"]).alias("service"),
        F.lower(m["request"]).alias("request"),
        ogc.request_layers(m).alias("layers"),
        ogc.request_crs(m).alias("crs"),
    )


@check(
    "image_size_f16",
    with_lines("SELECT event_id, CASE WHEN app_name <> 'dataapi' AND k % 3 = 0 THEN CASE WHEN k % 2 = 0 THEN '256x256' ELSE '769x256' END END AS size FROM lines"),
)
def image_size(spark, sf):
    m = F.col("params")
    return _params(spark, sf).select("event_id", ogc.image_size(m["width"], m["height"]).alias("size"))


@check(
    "infer_tiled_f17",
    with_base(
        "SELECT event_id, CASE WHEN k % 2 = 0 AND k % 3 = 0 THEN TRUE WHEN k % 5 = 0 THEN TRUE WHEN k % 5 = 1 THEN FALSE END AS tiled FROM base"
    ),
)
def infer_tiled(spark, sf):
    k = F.col("k")
    size = F.when(k % 2 == 0, F.lit("512x512")).otherwise(F.lit("100x100"))
    param = F.when(k % 5 == 0, F.lit("TRUE")).when(k % 5 == 1, F.lit("no"))
    return base(spark, sf).select("event_id", ogc.infer_tiled(size, param, k % 3 == 0).alias("tiled"))


@check(
    "infer_download_f18",
    with_base(
        "SELECT event_id, CASE WHEN k % 4 IN (0, 1, 2) AND NOT (k % 4 = 1 AND k % 3 = 0) THEN TRUE END AS is_download,"
        " CASE k % 4 WHEN 0 THEN 'JSON' WHEN 1 THEN CASE WHEN k % 3 <> 0 THEN 'Shapefile' END WHEN 2 THEN CASE WHEN k % 3 = 0 THEN 'odd' ELSE 'GeoTiff' END END AS format FROM base"
    ),
)
def infer_download(spark, sf):
    from checks.fixtures import OGC_RASTER_FORMATS
    from mapmeter.settings import OGC_VECTOR_FORMATS, AppOptions, Settings

    settings = Settings(apps={"ogcserver": AppOptions(True, True, OGC_VECTOR_FORMATS, OGC_RASTER_FORMATS)})
    df = base(spark, sf).selectExpr(
        "event_id",
        "CASE WHEN k % 4 = 0 THEN '/ogc/features/v1/collections/x/items' ELSE '/ogc/ows' END AS path",
        "CASE k % 4 WHEN 1 THEN 'WFS' WHEN 2 THEN 'WCS' ELSE 'WMS' END AS service",
        "CASE k % 4 WHEN 1 THEN 'GetFeature' WHEN 2 THEN 'GetCoverage' ELSE 'GetMap' END AS request",
        "map('f', 'application/JSON', 'outputformat', CASE WHEN k % 3 = 0 THEN 'gml' ELSE 'SHAPE-ZIP' END, 'format', CASE WHEN k % 3 = 0 THEN 'Odd' ELSE 'geotiff' END) AS params",
    )
    found = ogc.infer_download(
        settings, F.lit("ogcserver"), F.col("path"), F.col("service"), F.col("request"), F.col("params")
    )
    return df.select("event_id", found["is_download"].alias("is_download"), found["format"].alias("format"))


@check(
    "ogc_api_features_f19",
    with_base(
        "SELECT event_id, CASE WHEN k % 2 = 0 THEN 'OGC API Features' END AS service, CASE WHEN k % 2 = 0 AND k % 3 > 0 THEN concat('ws:l', k) END AS layers,"
        " CASE WHEN k % 2 = 0 AND k % 3 = 1 THEN 'items' WHEN k % 2 = 0 AND k % 3 = 2 THEN 'layer' END AS request FROM base"
    ),
)
def ogc_api_features(spark, sf):
    path = F.expr(
        "concat(CASE WHEN k % 2 = 0 THEN '/geoserver/ogc/features/v1' ELSE '/other' END,"
        " CASE k % 3 WHEN 0 THEN '/collections' WHEN 1 THEN concat('/collections/ws:l', k, '/items') ELSE concat('/collections/ws:l', k) END)"
    )
    found = ogc.ogc_api_features(path)
    return base(spark, sf).select("event_id", *[found[c].alias(c) for c in ("service", "layers", "request")])


@check(
    "workspace_from_path_f20",
    with_base("SELECT event_id, CASE WHEN k % 5 = 3 THEN '' ELSE concat('ws', k % 7) END AS workspace FROM base"),
)
def workspace_from_path(spark, sf):
    path = F.expr(
        "CASE k % 5 WHEN 0 THEN concat('/ws', k % 7, '/gwc/service/wmts') WHEN 1 THEN concat('/a/ws', k % 7, '/wms')"
        " WHEN 2 THEN concat('/ogc/features/v1/collections/ws', k % 7, '/items') WHEN 3 THEN '/ows' ELSE concat('/ws', k % 7, '/ows') END"
    )
    return base(spark, sf).select("event_id", ogc.workspace_from_path(path).alias("workspace"))


@check(
    "normalise_layers_f21",
    with_facts("SELECT event_id, workspaces, layers FROM facts WHERE app_name = 'geoserver'"),
)
def normalise_layers(spark, sf):
    from checks.fixtures import RAW_LAYERS

    df = base(spark, sf).filter("event_type IN ('click', 'view')")
    found = ogc.normalise_layers(F.expr("concat('ws', k % 3)"), F.expr(RAW_LAYERS))
    return df.select("event_id", found["workspaces"].alias("workspaces"), found["layers"].alias("layers"))


@check(
    "mapproxy_endpoint_f22",
    with_facts("SELECT event_id, CASE WHEN app_name = 'mapproxy' THEN concat('/mapproxy/mp', k % 3) WHEN app_name = 'geoserver' THEN concat('/geoserver/ws', k % 3) ELSE '' END AS endpoint FROM facts"),
)
def mapproxy_endpoint(spark, sf):
    return flat(spark, sf).select("event_id", ogc.mapproxy_endpoint(F.col("request_path")).alias("endpoint"))


@check(
    "mapserver_endpoint_f23",
    with_facts("SELECT event_id, concat('/ms', k % 3) AS endpoint FROM facts WHERE app_name = 'mapserver'"),
)
def mapserver_endpoint(spark, sf):
    df = flat(spark, sf).filter("app_name = 'mapserver'")
    return df.select("event_id", ogc.mapserver_endpoint(F.col("request_path"), F.col("app_name")).alias("endpoint"))


def _details(spark, sf, *apps_wanted):
    df = lines(spark, sf).select("event_id", "k", "app_name", "app_path", "app_id", "request_path", "query")
    df = urls.settle_query_map(df, "_params", F.lower("query")).withColumns(
        {
            "request_query_string": F.lower("query"),
            "_agent": F.lit(None).cast("string"),
            "_referrer": F.lit(None).cast("string"),
        }
    )
    return apps.with_details(df.filter(F.col("app_name").isin(*apps_wanted)), SETTINGS)


@check(
    "dataapi_details_f24",
    with_facts("SELECT event_id, layers, request, is_download, download_format, full_download FROM facts WHERE app_name = 'dataapi'"),
)
def dataapi_details(spark, sf):
    d = F.col("request_details")
    names = ("layers", "request", "is_download", "download_format", "full_download")
    return _details(spark, sf, "dataapi").select("event_id", *[d[n].alias(n) for n in names])


@check(
    "ogc_details_f25",
    with_facts("SELECT event_id, app_name, service, request, layers, workspaces, tiled, is_download, download_format, 'ogc' AS tag FROM facts WHERE app_name <> 'dataapi'"),
)
def ogc_details(spark, sf):
    d = F.col("request_details")
    names = ("service", "request", "layers", "workspaces", "tiled", "is_download", "download_format")
    return _details(spark, sf, "geoserver", "mapproxy", "mapserver").select(
        "event_id", "app_name", *[d[n].alias(n) for n in names], F.array_join(d["tags"], ",").alias("tag")
    )


@check(
    "details_from_url_f26",
    with_facts("SELECT event_id, service, layers, workspaces, download_format FROM facts"),
)
def details_from_url(spark, sf):
    df = lines(spark, sf).select("event_id", "app_name", F.concat(F.lit("https://Maps.example.org:8443"), F.col("url")).alias("full"))
    d, out = F.col("request_details"), None
    for app in ("geoserver", "mapproxy", "mapserver", "dataapi"):
        found = apps.details_from_url(df.filter(F.col("app_name") == app), "full", app, SETTINGS)
        part = found.select("event_id", *[d[n].alias(n) for n in ("service", "layers", "workspaces", "download_format")])
        out = part if out is None else out.unionByName(part)
    return out


@check(
    "header_info_f27",
    with_facts("SELECT event_id, user_agent_family, referrer, CASE k % 4 WHEN 0 THEN '102.0' WHEN 1 THEN '3.28' WHEN 2 THEN '115.0' ELSE '1.15' END AS user_agent_version,"
               " CASE k % 4 WHEN 0 THEN 'Linux' WHEN 1 THEN 'Windows' WHEN 2 THEN 'Windows' END AS os_family, CASE WHEN k % 4 IN (1, 2) THEN '10' END AS os_version FROM facts"),
)
def header_info(spark, sf):
    df = lines(spark, sf).select(
        "event_id", "app_name", "app_path", "app_id", "request_path", F.col("agent").alias("_agent"),
        F.col("referrer").alias("_referrer"), F.lower("query").alias("request_query_string"),
        F.create_map().cast("map<string,string>").alias("_params"),
    )
    out = apps.with_details(df, SETTINGS)
    d = F.col("request_details")
    names = ("user_agent_family", "referrer", "user_agent_version", "os_family", "os_version")
    return out.select("event_id", *[d[n].alias(n) for n in names])


_UUID = "concat('da165110-88fd-11da-a88f-', lpad(CAST(event_id % 100000 AS VARCHAR(9)), 12, '0'))"


@check(
    "metadata_view_f28",
    with_base(f"SELECT event_id, 'metadata_view' AS query_type, CASE WHEN k % 4 < 3 THEN {_UUID} END AS uuid FROM base"),
)
def metadata_view(spark, sf):
    path = F.expr(
        f"concat(CASE k % 4 WHEN 0 THEN '/geonetwork/srv/api/records/' WHEN 1 THEN '/geonetwork/srv/fre/catalog.search#/metadata/' WHEN 2 THEN '/datahub/Dataset/' ELSE '/x/' END, upper({_UUID}), '/formatters')"
    )
    hub = legacy.metadata_view(path, "datahub")
    net = legacy.metadata_view(path, "geonetwork")
    return base(spark, sf).select(
        "event_id",
        net["query_type"].alias("query_type"),
        F.when(F.col("k") % 4 == 2, hub["uuid"]).otherwise(net["uuid"]).alias("uuid"),
    )


@check("mviewer_map_f29", with_base("SELECT event_id, CASE WHEN k % 3 > 0 THEN concat('apps/map', k, '.xml') END AS map FROM base"))
def mviewer_map(spark, sf):
    url = F.expr("concat('/mviewer/?lang=fr', CASE WHEN k % 3 > 0 THEN concat('&config=apps%2FMap', k, '.xml') ELSE '' END, '#x')")
    return base(spark, sf).select("event_id", legacy.mviewer_map(url).alias("map"))


@check(
    "request_line_f30",
    with_base(
        "SELECT event_id, CASE WHEN k % 3 = 0 THEN '' WHEN k % 3 = 1 THEN 'GET' ELSE 'POST' END AS method,"
        " CASE WHEN k % 3 = 0 THEN '' ELSE concat('/app_', k, '/a?b=', k) END AS path, CASE WHEN k % 3 = 0 THEN '' ELSE concat('app_', k) END AS app FROM base"
    ),
)
def request_line(spark, sf):
    text = F.expr(
        "CASE k % 3 WHEN 0 THEN concat('BREW /pot-', k) WHEN 1 THEN concat('GET /app_', k, '/a?b=', k, ' HTTP/1.1') ELSE concat('POST https://h.example.org/app_', k, '/a?b=', k, ' HTTP/2') END"
    )
    r = values.request_line(text)
    return base(spark, sf).select("event_id", *[r[c].alias(c) for c in ("method", "path", "app")])


@check(
    "geoserver_legacy_f31",
    with_lines(
        "SELECT event_id, lower(service) AS service, CASE WHEN k % 3 = 0 THEN CASE WHEN k % 20 = 0 THEN concat('other,ws', k % 3) WHEN k % 4 = 0 THEN concat('ws', k % 3, ',ws', k % 3) ELSE concat('ws', k % 3) END END AS workspace,"
        " CASE WHEN k % 3 = 0 THEN layers END AS layers, CASE WHEN k % 3 = 0 THEN CASE WHEN k % 2 = 0 THEN '256x256' ELSE '769x256' END END AS size,"
        " CASE WHEN k % 3 = 0 THEN 'epsg:3857' END AS crs FROM lines WHERE app_name = 'geoserver'"
    ),
)
def geoserver_legacy(spark, sf):
    df = _params(spark, sf).filter("app_name = 'geoserver'")
    d = df.withColumn("d", legacy.geoserver_details_legacy(F.col("request_path"), F.col("params")))
    return d.select("event_id", *[F.col("d")[c].alias(c) for c in ("service", "workspace", "layers", "size", "crs")])


@check(
    "generic_legacy_f32",
    with_lines("SELECT event_id, CASE WHEN app_name = 'dataapi' THEN CASE WHEN k % 8 = 0 THEN 2 WHEN k % 4 = 0 THEN 1 ELSE 0 END"
               " WHEN k % 3 = 0 THEN 8 WHEN k % 3 = 1 THEN 4 + CASE WHEN k % 2 = 0 THEN 1 ELSE 0 END ELSE 5 END AS n_params FROM lines"),
)
def generic_legacy(spark, sf):
    return lines(spark, sf).select("event_id", F.size(legacy.generic_details_legacy(F.col("url"))).alias("n_params"))


@check(
    "json_get_f33",
    with_base("SELECT event_id, CASE WHEN k % 6 = 0 THEN CAST(k AS VARCHAR) END AS a, CASE k % 6 WHEN 0 THEN concat('x', k) WHEN 4 THEN 'y' END AS b FROM base"),
)
def json_get(spark, sf):
    text = F.expr(JSON_TEXT)
    return base(spark, sf).select("event_id", jsons.json_get(text, "a").alias("a"), jsons.json_get(text, "b").alias("b"))


@check(
    "json_array_elements_f34",
    with_base("SELECT event_id, unnest([concat('l', k), concat('m', k)]) AS element FROM base WHERE k % 6 = 1"),
)
def json_array_elements(spark, sf):
    df = base(spark, sf).select("event_id", F.expr(JSON_TEXT).alias("js"))
    return unnest_json_array(df, "js").select("event_id", "element")


@check(
    "details_json_egress",
    with_facts("SELECT event_id, layers, service FROM facts"),
)
def details_json(spark, sf):
    df = _details(spark, sf, "geoserver", "mapproxy", "mapserver", "dataapi").withColumn(
        "js", details_to_json(F.col("request_details"))
    )
    return df.select(
        "event_id", F.get_json_object("js", "$.layers").alias("layers"), F.get_json_object("js", "$.service").alias("service")
    )
