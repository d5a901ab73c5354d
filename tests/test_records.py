"""Details and whole records against values worked out by hand."""

import hashlib
import json

from pyspark.sql import functions as F

from checks.fixtures import MULTI_DOMAIN_PATTERN, OGC_RASTER_FORMATS
from mapmeter.functions.jsons import details_to_json
from mapmeter.operators.apps import details_from_url, with_details
from mapmeter.operators.telemetry import parse_telemetry
from mapmeter.operators.text import parse_pipe_lines, parse_text_logs
from mapmeter.schemas import ACCESS_LOG_SCHEMA, OTEL_SCHEMA
from mapmeter.settings import (
    COMBINED_PATTERN, OGC_VECTOR_FORMATS, AppOptions, Settings,
)

ALL = AppOptions(True, True, OGC_VECTOR_FORMATS, OGC_RASTER_FORMATS)
SETTINGS = Settings(
    apps={**Settings().apps, "ogcserver": ALL, "mapproxy": ALL, "mapserver": ALL}, keys_blacklist=()
)


def _details(spark, app, url, settings=SETTINGS):
    df = spark.createDataFrame([(url,)], "u string")
    row = details_from_url(df, "u", app, settings).select(details_to_json(F.col("request_details")).alias("j")).first()
    return json.loads(row.j)


def test_geoserver_tile(spark):
    url = "/geoserver/topp/wms?SERVICE=WMS&VERSION=1.1.1&REQUEST=GetMap&FORMAT=image%2Fpng&STYLES&LAYERS=topp%3Aroads&WIDTH=256&HEIGHT=256&SRS=EPSG%3A4326&tilesOrigin=-1%2C2"
    assert _details(spark, "geoserver", url) == {
        "service": "WMS", "version": "1.1.1", "request": "getmap", "format": "image/png", "layers": "roads",
        "workspaces": "topp", "width": "256", "height": "256", "size": "256x256", "tiled": True, "crs": "EPSG:4326",
        "tilesorigin": "-1,2", "tags": ["ogc"],
    }


def test_tile_inference_beats_the_parameter(spark):
    url = "/geoserver/wms?service=wms&width=512&height=512&tiled=false"
    assert _details(spark, "geoserver", url)["tiled"] is True
    assert _details(spark, "geoserver", url, Settings(apps={}))["tiled"] is False


def test_downloads(spark):
    wfs = "/geoserver/topp/wfs?service=WFS&request=GetFeature&typename=topp:states"
    assert "is_download" not in _details(spark, "geoserver", wfs)
    got = _details(spark, "geoserver", wfs + "&outputformat=excel2007")
    assert (got["is_download"], got["download_format"], got["layers"]) == (True, "Excel", "states")
    wcs = "/ogc/ows?service=WCS&request=GetCoverage&format="
    assert _details(spark, "ogcserver", wcs + "geotiff")["download_format"] == "GeoTiff"
    assert _details(spark, "ogcserver", wcs + "unheard")["download_format"] == "unheard"
    api = "/geoserver/ogc/features/v1/collections/ws:lakes/items?f=application/json"
    got = _details(spark, "geoserver", api)
    assert (got["service"], got["layers"], got["workspaces"], got["request"], got["download_format"]) == (
        "OGC API Features", "lakes", "ws", "items", "JSON",
    )


def test_endpoints(spark):
    query = "?service=WMS&request=GetMap&layers=ortho"
    assert _details(spark, "mapproxy", "/ortho/service" + query)["workspaces"] == "/ortho"
    assert _details(spark, "mapserver", "/mapserver/ortho" + query)["workspaces"] == "/ortho"


def test_dataapi(spark):
    base = "/data/ogcapi/collections/ws:river"
    assert _details(spark, "dataapi", base) == {"layers": "ws:river"}
    assert _details(spark, "dataapi", base + "/items?limit=-1") == {
        "layers": "ws:river", "request": "items", "is_download": True, "download_format": "GeoJSON",
        "full_download": True, "limit": "-1",
    }
    assert _details(spark, "dataapi", base + "/items?f=csv&limit=50&x=y") == {
        "layers": "ws:river", "request": "items", "is_download": True, "download_format": "CSV",
        "full_download": False, "limit": "50", "x": "y",
    }


def test_misspelt_option_key_counts(spark):
    settings = Settings(apps={"datapi": AppOptions(vector_formats={"odd": "Odd"})})
    assert _details(spark, "dataapi", "/data/ogcapi/collections/a/items?f=odd", settings)["download_format"] == "Odd"


LINE = (
    '192.168.1.7 - jo|Map Team|ROLE_A,ROLE_B [18/Oct/2023:17:36:10 +0200] "GET /geoserver/sf/wms?service=WMS'
    '&request=GetMap&layers=sf%3Aroads&width=768&height=537&srs=EPSG%3A26713&styles= HTTP/1.1" 200 - "-" '
    '"Mozilla/5.0 (X11; Linux x86_64; rv:102.0) Gecko/20100101 Firefox/102.0" - "geoserver" "-" 18ms'
)


def test_text_line(spark):
    settings = Settings(text_pattern=COMBINED_PATTERN, response_time_unit="s", keys_blacklist=("user_id",))
    lines = [(LINE,), ("garbage",), (LINE.replace("/geoserver/sf/wms", "/unknown/x"),)]
    df = spark.createDataFrame(lines, "value string")
    rows = parse_text_logs(df, settings).orderBy("app_name").collect()
    assert parse_text_logs(df, settings).schema.simpleString() == ACCESS_LOG_SCHEMA.simpleString()
    assert len(rows) == 2
    row = rows[0]
    assert row.id == hashlib.md5(LINE.encode()).hexdigest()[:12]
    assert (row.app_id, row.app_path, row.app_name) == ("geoserver", "geoserver", "geoserver")
    assert (row.user_id, row.user_name, row.org_name, row.roles) == (None, "jo", "Map Team", ["ROLE_A", "ROLE_B"])
    assert str(row.ts) == "2023-10-18 15:36:10"
    assert (row.response_time, row.response_size, row.status_code) == (18000, None, 200)
    d = row.request_details
    assert (d.layers, d.workspaces, d.crs, d.size, d.tags, d.user_agent_family) == (
        "roads", "sf", "EPSG:26713", "768x537", ["ogc"], "Firefox",
    )
    # no processor: kept with raw parameters here, dropped on request
    assert rows[1].app_name == "unknown"
    assert rows[1].request_details.params["srs"] == "epsg:26713"
    assert rows[1].request_details.tags is None
    assert parse_text_logs(df, settings, unsupported="drop").count() == 1


def test_several_domains(spark):
    line = (
        '127.0.0.1 127.0.1.1 unix:/run/m.sock - [10/Dec/2025:05:39:15 +0100] "GET /ortho?layers=o_2022&service=WMS&request=GetMap'
        '&width=1300&height=1300 HTTP/1.1" 200 2560412 "-" "Tool-1.15" 0.626'
    )
    settings = Settings(
        text_pattern=MULTI_DOMAIN_PATTERN, multi_domain=True, response_time_unit="s", keys_blacklist=(),
        apps_mapping={"maps.example.org/": "mapserver"},
        extra_info={"server_address": "maps.example.org", "app_path": "/"},
    )
    row = parse_text_logs(spark.createDataFrame([(line,)], "value string"), settings).first()
    assert (row.app_id, row.app_path, row.app_name) == ("maps.example.org/", "/", "mapserver")
    assert (row.request_details.workspaces, row.response_time, row.client_ip) == ("/ortho", 626, "127.0.0.1")


def _record(**attributes):
    from datetime import datetime

    url = "https://Maps.example.org/geoserver/psc/wms?SERVICE=WMS&LAYERS=psc%3Ariver&STYLES"
    base = {
        "http.request.url": url, "http.request.method": "get", "http.status_code": "200",
        "http.request.parameter.SERVICE": "WMS", "http.request.parameter.LAYERS": "psc:river",
        "enduser.id": "jo", "enduser.roles": "R1,R2", "http.request.header.Referer": "https://x.example.org/",
    }
    base.update(attributes)
    at = datetime(2025, 12, 17, 13, 19, 38, 491768)
    return (at, "span1", "trace1", "msg", base, "{}", ("a.accesslog",), "otel", "INFO", 9, at, 1, 0)


def test_telemetry_record(spark):
    df = spark.createDataFrame([_record()], OTEL_SCHEMA)
    row = parse_telemetry(df, Settings(keys_blacklist=())).first()
    assert (row.id, row.app_id, row.app_name, row.request_path) == ("span1", "/geoserver/", "geoserver", "/geoserver/psc/wms")
    assert row.server_address == "maps.example.org"
    assert row.request_query_string == "service=wms&layers=psc%3ariver&styles"
    assert (row.user_name, row.org_name, row.roles, row.response_time) == ("jo", "", ["R1", "R2"], None)
    assert (row.request_details.layers, row.request_details.workspaces) == ("river", "psc")
    assert row.request_details.referrer == "https://x.example.org/"
    assert (row.context_data.trace_id, row.context_data.logger) == ("trace1", "a.accesslog")
    # privacy holds on this intake too, and irrelevant requests go
    assert parse_telemetry(df, Settings()).first().user_name is None
    other = spark.createDataFrame([_record(**{"http.request.url": "https://h/portal/index"})], OTEL_SCHEMA)
    assert parse_telemetry(other, Settings()).count() == 0


def test_root_application_and_roles(spark):
    df = spark.createDataFrame([_record(**{"app_path_is_root": "true", "enduser.roles": ""})], OTEL_SCHEMA)
    settings = Settings(multi_domain=True, apps_mapping={"maps.example.org/": "mapserver"}, keys_blacklist=())
    row = parse_telemetry(df, settings).first()
    assert (row.app_id, row.app_name, row.app_path, row.roles) == ("maps.example.org/", "mapserver", "/", [""])


def test_message_fills_what_attributes_lack(spark):
    settings = Settings(parse_message=True, keys_blacklist=())
    line = '10.0.0.9 - other|Org|R [17/Dec/2025:13:19:38 +0000] "GET /geoserver/x/y HTTP/1.1" 404 512'
    record = list(_record())
    record[3] = line
    row = parse_telemetry(spark.createDataFrame([tuple(record)], OTEL_SCHEMA), settings).first()
    assert (row.response_size, row.status_code, row.user_name, row.org_name) == (512, 200, "jo", "Org")
    record[3] = "no access line"
    row = parse_telemetry(spark.createDataFrame([tuple(record)], OTEL_SCHEMA), settings).first()
    assert (row.response_size, row.status_code, row.user_name) == (None, 200, "jo")


def test_fallback_on_generic_keeps_empty_details(spark):
    record = _record(**{"http.request.url": "https://h/portal/index"})
    df = spark.createDataFrame([record], OTEL_SCHEMA)
    row = parse_telemetry(df, Settings(fallback_on_generic=True)).first()
    assert row.app_name == "portal"
    assert row.request_details.params == {} and row.request_details.referrer is None


def test_pipe_lines_with_and_without_size(spark):
    lines = [
        "10.0.0.1|24/Jan/2021:06:25:21 +0100|jo|Org|R1,R2|GET|/a?b=1|200|0.254|3512|Agent | x",
        "10.0.0.1|24/Jan/2021:06:25:21 +0100|jo|Org|R1,R2|GET|/a?b=1|200|0.254|Agent",
        "too|short",
    ]
    rows = parse_pipe_lines(spark.createDataFrame([(x,) for x in lines], "value string")).collect()
    assert [(r.response_time, r.response_size, r.user_agent) for r in rows] == [(254, 3512, "Agent | x"), (254, None, "Agent")]
    assert str(rows[0].ts) == "2021-01-24 05:25:21"


def test_request_without_app_has_no_details(spark):
    df = spark.sql(
        "SELECT '' AS app_id, 'geoserver' AS app_name, '/geoserver/' AS app_path, '/geoserver/ows' AS request_path,"
        " 'service=wms' AS request_query_string, map('service', 'wms') AS _params, CAST(NULL AS STRING) AS _agent, CAST(NULL AS STRING) AS _referrer"
    )
    assert with_details(df, SETTINGS).count() == 0
