"""Detail rules of the older log format: metadata views, map contexts, flat parameter maps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from mapmeter.functions.ogc import _UUID
from mapmeter.functions.urls import query_map, split_url

# --- fixed value: where a service path names its workspace
_SERVICE_PATH = r"/[a-zA-Z0-9-_]*/(.*)/(?:ows|wms|wfs|wcs|wmts)"


def metadata_view(path: Column, app: str) -> Column:
    """``struct<query_type,uuid>`` of a metadata page; ``app`` is ``geonetwork`` or ``datahub``."""
    where = "/dataset" if app == "datahub" else "(?:#/metadata|/api/records)"
    uuid = F.regexp_extract(F.lower(path), rf"^.*{where}/({_UUID})", 1)
    return F.struct(F.lit("metadata_view").alias("query_type"), F.nullif(uuid, F.lit("")).alias("uuid"))


def mviewer_map(url: Column) -> Column:
    """Map context named by the ``config`` parameter."""
    return query_map(split_url(url)["query"])["config"]


def generic_details_legacy(url: Column) -> Column:
    """All query parameters as details."""
    return query_map(split_url(url)["query"])


def geoserver_workspaces_legacy(path: Column, layers: Column) -> Column:
    """One workspace per layer, from its prefix or else from the path; not squashed."""
    by_path = F.regexp_extract(path, _SERVICE_PATH, 1)
    return F.array_join(
        F.transform(
            F.split(layers, ","),
            lambda x: F.when(F.instr(x, ":") > 0, F.substring_index(x, ":", 1)).otherwise(by_path),
        ),
        ",",
    )


def geoserver_layers_legacy(layers: Column) -> Column:
    return F.array_join(F.transform(F.split(layers, ","), lambda x: F.substring_index(x, ":", -1)), ",")


def geoserver_details_legacy(path: Column, params: Column) -> Column:
    """Details under the older key names; parameters without a rule are copied."""
    layers = params["layers"]
    size = F.when(
        params["width"].isNotNull() & params["height"].isNotNull(),
        F.concat_ws("x", params["width"], params["height"]),
    )
    made = F.map_filter(
        F.create_map(
            F.lit("workspace"),
            F.when(layers.isNotNull(), geoserver_workspaces_legacy(path, layers)),
            F.lit("layers"),
            geoserver_layers_legacy(layers),
            F.lit("size"),
            size,
            F.lit("projection"),
            F.upper(params["srs"]),
        ),
        lambda k, v: v.isNotNull(),
    )
    copied = F.map_filter(
        params,
        lambda k, v: ~k.isin("layers", "height", "width", "srs") & ~F.map_contains_key(made, k),
    )
    return F.map_concat(made, copied)
