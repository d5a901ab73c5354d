"""Application processors: which requests count as usage, and what is kept of them.

A processor is a set of Column builders. All registered processors together become one projection, with
a ``when`` branch per application, so adding one adds no pass over the data.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mapmeter.functions import ogc
from mapmeter.functions.agents import user_agent_fields
from mapmeter.functions.base import let, settle
from mapmeter.functions.urls import settle_query_map, url_parts, url_path, url_query
from mapmeter.schemas import DETAIL_TYPES, USER_AGENT_FIELDS
from mapmeter.settings import Settings

RAW = "raw"
GENERIC = "generic"
_PLAIN = ("version", "format", "width", "height", "bbox", "styles", "limit")
_FLAGS = ("tiled", "is_download", "full_download")


@dataclass(frozen=True)
class Request:
    """The columns a processor may use."""

    path: Column
    query: Column
    params: Column
    app_path: Column


@dataclass(frozen=True)
class Processor:
    """``details`` overrides the fields of its ``base``: ``ogc``, ``raw`` parameters, or ``empty``."""

    name: str
    relevant: Callable[[Request], Column]
    details: Callable[[Request], Mapping[str, Column]] = field(default=lambda request: {})
    base: str = "ogc"


def _ogc_relevant(r: Request) -> Column:
    return ogc.is_relevant_ogc(r.path, r.query, r.app_path)


def _geoserver(r: Request) -> dict[str, Column]:
    split = F.col("_layers")
    return {
        "layers": F.coalesce(split["layers"], F.col("_ogc.layers")),
        "workspaces": F.coalesce(split["workspaces"], r.params["workspaces"]),
    }


def _dataapi(r: Request) -> dict[str, Column]:
    part = F.col("_dataapi")
    items = F.coalesce(part["items"], F.lit(False))
    return {
        "layers": F.coalesce(part["layers"], r.params["layers"]),
        "request": F.when(items, F.lit("items")).otherwise(r.params["request"]),
        "is_download": F.when(items, F.lit(True)).otherwise(r.params["is_download"] == "true"),
        "download_format": F.when(items, part["download_format"]).otherwise(r.params["download_format"]),
        "full_download": part["full_download"],
        "params": F.map_filter(r.params, lambda k, v: ~k.isin(*DETAIL_TYPES) & ~(items & (k == "f"))),
    }


BUILT_IN: tuple[Processor, ...] = (
    Processor("ogcserver", _ogc_relevant),
    Processor("geoserver", _ogc_relevant, _geoserver),
    Processor(
        "mapproxy", _ogc_relevant, lambda r: {"workspaces": ogc.mapproxy_endpoint(r.path)}
    ),
    Processor("mapserver", _ogc_relevant, lambda r: {"workspaces": F.col("_stripped")}),
    Processor("dataapi", lambda r: ogc.is_relevant_dataapi(r.path), _dataapi, base="raw"),
    Processor(GENERIC, lambda r: F.lit(True), base="empty"),
)


def register(processor: Processor, registry: tuple[Processor, ...] = BUILT_IN) -> tuple[Processor, ...]:
    """A registry with ``processor`` added, in place of one of the same name."""
    return (*[p for p in registry if p.name != processor.name], processor)


def _choose(kind: Column, branches: list[tuple[list[str], Column]], default: Column) -> Column:
    chain = default
    for names, value in reversed(branches):
        chain = F.when(kind.isin(*names), value).otherwise(chain)
    return chain


def _raw_fields(params: Column) -> dict[str, Column]:
    fields = {name: params[name] for name, kind in DETAIL_TYPES.items() if kind.typeName() == "string"}
    fields.update({name: F.lower(params[name]) == "true" for name in _FLAGS})
    fields["tags"] = F.lit(None).cast("array<string>")
    fields["params"] = F.map_filter(params, lambda k, v: ~k.isin(*DETAIL_TYPES))
    return fields


def _ogc_fields(params: Column) -> dict[str, Column]:
    made, download = F.col("_ogc"), F.col("_download")
    gone = (*DETAIL_TYPES, *ogc.LAYER_KEYS, *ogc.CRS_KEYS)
    fields = _raw_fields(params)
    fields.update(
        service=made["service"],
        request=made["request"],
        layers=made["layers"],
        crs=made["crs"],
        size=F.coalesce(made["size"], params["size"]),
        tiled=made["tiled"],
        is_download=F.coalesce(download["is_download"], fields["is_download"]),
        download_format=F.coalesce(download["format"], params["download_format"]),
        tags=F.array(F.lit("ogc")),
        params=F.map_filter(params, lambda k, v: ~k.isin(*gone)),
    )
    return fields


def _empty_fields() -> dict[str, Column]:
    fields = {name: F.lit(None).cast(kind) for name, kind in DETAIL_TYPES.items()}
    fields["params"] = F.create_map().cast("map<string,string>")
    return fields


def route(
    df: DataFrame, settings: Settings, registry: tuple[Processor, ...] = BUILT_IN
) -> DataFrame:
    """Add ``_kind``: the processor a request goes to, NULL when it has none or is not relevant.

    A request needs an application id, name and path; an application without processor goes to the
    generic one only if the settings say so.
    """
    routed, relevant = _routes(settings, registry)
    df = df.withColumn("_routed", routed)
    return settle(df, {"_kind": F.when(relevant, F.col("_routed"))}).drop("_routed")


def _routes(settings: Settings, registry: tuple[Processor, ...]) -> tuple[Column, Column]:
    app = F.lower("app_name")
    names = [p.name for p in registry]
    complete = (F.col("app_id") != "") & (F.col("app_name") != "") & (F.col("app_path") != "")
    routed = F.when(app.isin(*names), app)
    if settings.fallback_on_generic:
        routed = routed.otherwise(F.lit(GENERIC))
    request = _request()
    by_rule: dict[Callable, list[str]] = {}
    for p in registry:
        by_rule.setdefault(p.relevant, []).append(p.name)
    relevant = _choose(
        F.col("_routed"), [(names, rule(request)) for rule, names in by_rule.items()], F.lit(False)
    )
    return F.when(complete, routed), relevant


def _request() -> Request:
    return Request(
        F.col("request_path"), F.col("request_query_string"), F.col("_params"), F.col("app_path")
    )


def _stages(
    settings: Settings, registry: tuple[Processor, ...]
) -> tuple[list[dict[str, Column]], list[Column]]:
    """The projections that lead from a routed request to its details; they depend on the options only."""
    request = _request()
    kind, params = F.col("_kind"), request.params
    ogc_names = [p.name for p in registry if p.base == "ogc"] or ["ogcserver"]
    raw_names = [p.name for p in registry if p.base == "raw"] + [RAW]
    empty_names = [p.name for p in registry if p.base == "empty"] or [GENERIC]
    is_ogc = kind.isin(*ogc_names)

    def inferring(option: str) -> Column:
        names = [n for n in ogc_names if getattr(settings.app_options(n), option)]
        return kind.isin(*names) if names else F.lit(False)

    def made(b: Column) -> Column:
        return F.struct(
            F.coalesce(b["api"]["service"], F.upper(params["service"])).alias("service"),
            F.coalesce(b["api"]["request"], F.lower(params["request"])).alias("request"),
            F.coalesce(b["api"]["layers"], ogc.request_layers(params)).alias("layers"),
            ogc.request_crs(params).alias("crs"),
            b["size"].alias("size"),
            ogc.infer_tiled(b["size"], params["tiled"], inferring("infer_is_tiled")).alias("tiled"),
        )

    # The lambdas keep these projections out of whole-stage code, on purpose: fused with everything else
    # they make one method too long for the JIT compiler, while on their own they are cut into small ones.
    bound = F.struct(
        ogc.ogc_api_features(request.path).alias("api"),
        ogc.image_size(params["width"], params["height"]).alias("size"),
    )
    first = {
        "_stripped": ogc.strip_app_path(request.path, request.app_path),
        "_ogc": F.when(is_ogc, let(bound, made)),
        "_dataapi": F.when(kind == "dataapi", ogc.dataapi_request(settings, request.path, params)),
    }
    download = ogc.infer_download(
        settings, kind, request.path, F.col("_ogc.service"), F.col("_ogc.request"), params
    )
    second = {
        "_download": F.when(inferring("infer_is_download"), download),
        "_layers": F.when(
            (kind == "geoserver") & (F.length("_ogc.layers") > 0),
            let(
                ogc.workspace_from_path(F.col("_stripped")),
                lambda workspace: ogc.normalise_layers(workspace, F.col("_ogc.layers")),
            ),
        ),
        "_agent_fields": F.when(F.length("_agent") > 0, user_agent_fields(F.col("_agent"))),
    }

    raw, ogc_made, empty = _raw_fields(params), _ogc_fields(params), _empty_fields()
    overrides = {p.name: p.details(request) for p in registry}
    fields = []
    for name in (*DETAIL_TYPES, "params"):
        branches = [([n], o[name]) for n, o in overrides.items() if name in o]
        if name in USER_AGENT_FIELDS or name == "referrer":
            # headers sit beside the parameters and win over one of the same name
            header = F.col("_referrer") if name == "referrer" else F.col("_agent_fields")[name]
            branches.append((empty_names, empty[name]))
            default = F.coalesce(F.nullif(header, F.lit("")), params[name])
        elif name in _PLAIN:
            branches.append((empty_names, empty[name]))
            default = raw[name]
        else:
            branches += [(ogc_names, ogc_made[name]), (raw_names, raw[name])]
            default = empty[name]
        fields.append(_choose(kind, branches, default).alias(name))
    return [first, second], fields


_SCRATCH = (
    "_kind", "_stripped", "_dataapi", "_ogc", "_download", "_layers", "_agent_fields", "_params", "_agent",
    "_referrer",
)


def with_details(
    df: DataFrame,
    settings: Settings,
    registry: tuple[Processor, ...] = BUILT_IN,
    unsupported: str = "drop",
) -> DataFrame:
    """Replace ``_params``, ``_agent`` and ``_referrer`` by the typed ``request_details``.

    ``unsupported`` says what becomes of requests no processor takes: ``drop`` them, or ``keep`` them
    with their raw parameters.
    """
    df = route(df, settings, registry)
    if unsupported == "drop":
        df = df.filter(F.col("_kind").isNotNull())
    else:
        df = df.withColumn("_kind", F.coalesce("_kind", F.lit(RAW)))
    stages, fields = _stages(settings, registry)
    for stage in stages:
        df = df.withColumns(stage)
    return df.withColumn("request_details", F.struct(*fields)).drop(*_SCRATCH)


def details_from_url(
    df: DataFrame,
    url: str,
    app_name: str,
    settings: Settings,
    registry: tuple[Processor, ...] = BUILT_IN,
    app_path: str | None = None,
) -> DataFrame:
    """``request_details`` of full URLs of one application, relevant or not."""
    always = tuple(
        Processor(p.name, lambda r: F.lit(True), p.details, p.base) for p in registry if p.name == app_name
    )
    df = settle(df, {"_url": url_parts(F.col(url))})
    df = settle_query_map(df, "_params", url_query(F.col("_url"))).withColumns(
        {
            "app_id": F.lit(app_name),
            "app_name": F.lit(app_name),
            "app_path": F.lit(app_path or app_name),
            "request_path": url_path(F.col("_url")),
            "request_query_string": url_query(F.col("_url")),
            "_agent": F.lit(None).cast("string"),
            "_referrer": F.lit(None).cast("string"),
        }
    )
    out = with_details(df, settings, always, unsupported="drop")
    return out.drop("_url", "app_id", "app_name", "app_path", "request_path", "request_query_string")
