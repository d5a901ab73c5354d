"""Classification of map-service (OGC) and data-API requests."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from mapmeter.functions.base import last_wins, let, literal_map
from mapmeter.functions.values import trim_slashes
from mapmeter.settings import TILE_SIZES, Settings

OGC_API = "OGC API Features"
LAYER_KEYS = ("layer", "layers", "typename", "typenames")
CRS_KEYS = ("srs", "crs")

# --- fixed values: shapes of the requests that are metered, as the services define them ---------
_UUID = "[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}"
_OGC_REQUEST = r"(?i)^.*\?.*service=|^.*/collections/.+"
_DATAAPI_COLLECTION = r"^.*/ogcapi/collections/(.*)"
_RECORD = rf"^.*(?:#/metadata|/api/records)/{_UUID}"
_DATASET = rf"^.*/dataset/{_UUID}"
_FEATURES = r"(?i)^.*/ogc/features/.*/collections/([^/]+)/?(items)?"
_WORKSPACES = (
    r".*/(.*)/gwc/service/(?:ows|wms|wfs|wcs|wmts)",
    r".*/(.*)/(?:ows|wms|wfs|wcs|wmts)",
    r".*collections/([^/]*)",
)
_PROXY_ENDPOINT = r"(.*)/(?:service|ows|wms|wmts)"
# --- end of fixed values --------------------------------------------------------------------------


def strip_app_path(path: Column, app: Column) -> Column:
    """Remove the leading ``/app/`` once; ``app`` may come with or without slashes."""
    name = trim_slashes(F.coalesce(app, F.lit("")))
    prefix = F.concat(F.lit("/"), name, F.lit("/"))
    return F.when(path.startswith(prefix), F.substr(path, F.length(name) + 2)).otherwise(path)


def is_relevant_ogc(path: Column, query: Column, app: Column) -> Column:
    full = F.concat_ws("?", strip_app_path(path, app), F.coalesce(query, F.lit("")))
    return full.rlike(_OGC_REQUEST)


def is_relevant_dataapi(path: Column) -> Column:
    return path.rlike(_DATAAPI_COLLECTION)


def is_relevant_geonetwork(path: Column) -> Column:
    return path.rlike(_RECORD)


def is_relevant_datahub(path: Column) -> Column:
    return path.rlike(_DATASET)


def is_relevant_mviewer(path: Column) -> Column:
    return F.lower(path).contains("config=")


def is_relevant_geoserver_legacy(path: Column) -> Column:
    return F.lower(path).contains("service=")


def lower_keys(params: Column) -> Column:
    """Parameter names in lower case; the last of two names that fall together is kept."""
    entries = F.transform(
        F.map_entries(params), lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value"))
    )
    return last_wins(entries)


def last_of(params: Column, keys: Iterable[str]) -> Column:
    """Value of whichever of ``keys`` comes last in the request."""
    names = F.map_keys(params)
    place = F.greatest(*[F.array_position(names, k) for k in keys])
    return F.try_element_at(F.map_values(params), F.nullif(place, F.lit(0)).cast("int"))


def request_layers(params: Column) -> Column:
    return last_of(params, LAYER_KEYS)


def request_crs(params: Column) -> Column:
    return F.upper(last_of(params, CRS_KEYS))


def image_size(width: Column, height: Column) -> Column:
    return F.when(width.isNotNull() & (F.length(height) > 0), F.concat_ws("x", width, height))


def infer_tiled(size: Column, tiled: Column, enabled: Column) -> Column:
    """Square tile sizes mean a tiled request where inference is on; else the parameter decides."""
    return F.when(F.coalesce(enabled & size.isin(*TILE_SIZES), F.lit(False)), F.lit(True)).otherwise(
        F.lower(tiled) == "true"
    )


def is_ogc_api(path: Column) -> Column:
    return path.contains("/ogc/features/")


def ogc_api_features(path: Column) -> Column:
    """``struct<service,layers,request>`` of an OGC API Features path, NULL for other paths."""
    layer = F.nullif(F.regexp_extract(path, _FEATURES, 1), F.lit(""))
    what = F.when(F.regexp_extract(path, _FEATURES, 2) != "", F.lit("items")).otherwise(F.lit("layer"))
    return F.when(
        is_ogc_api(path),
        F.struct(
            F.lit(OGC_API).alias("service"),
            layer.alias("layers"),
            F.when(layer.isNotNull(), what).alias("request"),
        ),
    )


def workspace_from_path(path: Column) -> Column:
    """Workspace named in a (prefix-free) service path, or an empty string."""
    found = F.lit("")
    for rule in reversed(_WORKSPACES):
        found = F.when(path.rlike(rule), F.regexp_extract(path, rule, 1)).otherwise(found)
    return found


def split_layer(layer: Column, path_workspace: Column) -> Column:
    """``ws:name`` or ``name`` to ``struct<ws,layer>``; the path names the workspace of a bare layer."""
    return F.when(
        F.instr(layer, ":") > 0,
        F.struct(
            F.substring_index(layer, ":", 1).alias("ws"),
            F.substr(layer, F.instr(layer, ":") + 1).alias("layer"),
        ),
    ).otherwise(F.struct(path_workspace.alias("ws"), layer.alias("layer")))


def normalise_layers(path_workspace: Column, layers: Column) -> Column:
    """Layer list to ``struct<workspaces,layers>``; one workspace shared by all layers is named once."""

    def many(items: Column) -> Column:
        spaces = F.transform(items, lambda x: x["ws"])
        unique = F.array_distinct(spaces)
        return F.struct(
            F.array_join(F.when(F.size(unique) == 1, unique).otherwise(spaces), ",").alias("workspaces"),
            F.array_join(F.transform(items, lambda x: x["layer"]), ",").alias("layers"),
        )

    single = split_layer(layers, path_workspace)
    return (
        F.when(F.length(layers) == 0, F.lit(None))
        .when(
            ~layers.contains(","),
            F.struct(single["ws"].alias("workspaces"), single["layer"].alias("layers")),
        )
        .otherwise(
            let(F.transform(F.split(layers, ","), lambda x: split_layer(x, path_workspace)), many)
        )
    )


def mapproxy_endpoint(path: Column) -> Column:
    return F.regexp_extract(path, _PROXY_ENDPOINT, 1)


def mapserver_endpoint(path: Column, app: Column) -> Column:
    return strip_app_path(path, app)


def format_labels(settings: Settings) -> Column:
    """Constant map ``app|kind|format`` to label, from the options of every application."""
    flat: dict[str, str] = {}
    for app in {*settings.apps, "dataapi"} - {"datapi"}:
        options = settings.app_options(app)
        for kind, formats in (("vector", options.vector_formats), ("raster", options.raster_formats)):
            flat.update({f"{app}|{kind}|{name}": label for name, label in formats.items()})
    return literal_map(flat)


def format_label(settings: Settings, app: Column, kind: str, name: Column) -> Column:
    return format_labels(settings)[F.concat_ws("|", app, F.lit(kind), F.lower(name))]


def infer_download(
    settings: Settings,
    app: Column,
    path: Column,
    service: Column,
    request: Column,
    params: Column,
) -> Column:
    """``struct<is_download,format>`` when the request fetches data, NULL otherwise."""
    service, request = F.lower(service), F.lower(request)

    def wanted(key: str) -> Column:
        return F.lower(F.coalesce(params[key], F.lit("")))

    def download(label: Column) -> Column:
        return F.struct(F.lit(True).alias("is_download"), label.alias("format"))

    by_api = format_label(settings, app, "vector", wanted("f"))
    by_wfs = format_label(settings, app, "vector", wanted("outputformat"))
    by_wcs = F.coalesce(format_label(settings, app, "raster", wanted("format")), wanted("format"))
    return (
        F.when(is_ogc_api(path) & by_api.isNotNull(), download(by_api))
        .when((service == "wfs") & (request == "getfeature") & by_wfs.isNotNull(), download(by_wfs))
        .when((service == "wcs") & (request == "getcoverage"), download(by_wcs))
    )


def dataapi_request(settings: Settings, path: Column, params: Column) -> Column:
    """``struct<layers,items,download_format,full_download>`` of a data-API path, NULL for other paths."""
    rest = F.regexp_extract(path, _DATAAPI_COLLECTION, 1)
    steps = F.split(rest, "/")
    items = F.coalesce(F.get(steps, F.lit(1)) == "items", F.lit(False))
    label = format_labels(settings)[
        F.concat(F.lit("dataapi|vector|"), F.coalesce(params["f"], F.lit("geojson")))
    ]
    return F.when(
        is_relevant_dataapi(path),
        F.struct(
            F.get(steps, F.lit(0)).alias("layers"),
            items.alias("items"),
            F.when(items, label).alias("download_format"),
            F.when(items, F.coalesce(params["limit"] == "-1", F.lit(False))).alias("full_download"),
        ),
    )
