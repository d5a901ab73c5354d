"""Options of the library, and the fixed values its results depend on."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

# --- fixed values -----------------------------------------------------------------------------
# Line patterns users already have in their configuration (Python named groups).

CLF_PATTERN = r'^(?P<ip>[0-9a-fA-F:\.]+) (?P<user_identifier>[-_\w]+) (?P<user>[-_\|,@\. \w]+) \[(?P<timestamp>.*)\] \"(?P<method>GET|POST|HEAD|OPTIONS|PUT|PATCH|DELETE|TRACE|CONNECT) (https?:\/\/[_:a-zA-Z0-9\.-]+)?(?P<path>\/(?P<app_path>[_a-zA-Z0-9-]+)(\/.*)) HTTP\/[\.0-9]{3}\" (?P<status_code>[0-9]{3}) (?P<response_size>[-0-9]*)'

COMBINED_PATTERN = r'^(?P<ip>[0-9a-fA-F:\.]+) (?P<user_identifier>[-_\w]+) (?P<user>[-_\|, \w]+) \[(?P<timestamp>.*)\] \"(?P<method>GET|POST|HEAD|OPTION|PUT|PATCH|DELETE|TRACE|CONNECT) (https?:\/\/[_:a-zA-Z0-9\.-]+)?(?P<path>\/(?P<app_path>[_a-zA-Z0-9-]+)(\/.*)) HTTP\/[\.0-9]{3}\" (?P<status_code>[0-9]{3}) (?P<response_size>[-0-9]*) \"-\" \"(?P<user_agent>[-0-9a-zA-Z\/\.: ();_]*)\" (?P<misc>.*) (?P<response_time>[0-9]+)ms$'

LEGACY_COMMON_PATTERN = r'^(?P<ip>[0-9a-fA-F:\.]+) (?P<user_identifier>[-_\w]+) (?P<user>[-_\|, \w]+) \[(?P<timestamp>.*)\] \"(?P<method>GET|POST|HEAD|OPTION|PUT|PATCH|DELETE|TRACE|CONNECT) (https?:\/\/[_:a-zA-Z0-9\.-]+)?(?P<path>\/(?P<app>[_a-zA-Z0-9-]+)(\/.*)) HTTP\/[\.0-9]{3}\" (?P<status_code>[0-9]{3}) (?P<response_size>[-0-9]*)'

LEGACY_COMBINED_PATTERN = LEGACY_COMMON_PATTERN + r' "-" "(?P<user_agent>[-0-9a-zA-Z\/\.: ();_]*)" (?P<misc>.*) (?P<response_time>[0-9]+)ms$'

# Columns dropped by default for privacy.
DEFAULT_KEYS_BLACKLIST = ("user_id", "user_name", "client_ip")

# Loggers whose telemetry records are HTTP accesses.
ACCESS_SCOPE_REGEX = r"^org\..*\.accesslog"
NETTY_SCOPE = "reactor.netty.http.server.AccessLog"

# Requested format (lower case) -> label shown in reports.
OGC_VECTOR_FORMATS = {
    "shape-zip": "Shapefile",
    "application/json": "JSON",
    "csv": "CSV",
    "excel": "Excel",
    "excel2007": "Excel",
}
DATAAPI_FORMATS = {
    "shapefile": "Shapefile",
    "json": "JSON",
    "geojson": "GeoJSON",
    "csv": "CSV",
    "ooxml": "Excel",
}
TILE_SIZES = ("256x256", "512x512")
# --- end of fixed values ----------------------------------------------------------------------


@dataclass(frozen=True)
class AppOptions:
    """What to infer for one application, and how its download formats are labelled."""

    infer_is_tiled: bool = False
    infer_is_download: bool = False
    vector_formats: Mapping[str, str] = field(default_factory=dict)
    raster_formats: Mapping[str, str] = field(default_factory=dict)


def default_apps() -> dict[str, AppOptions]:
    return {
        "geoserver": AppOptions(True, True, OGC_VECTOR_FORMATS),
        "dataapi": AppOptions(vector_formats=DATAAPI_FORMATS),
    }


@dataclass(frozen=True, eq=False)
class Settings:
    """Everything a run can be tuned with; plain values only, so it travels with the driver program."""

    timezone: str = "Europe/Paris"
    multi_domain: bool = False
    apps_mapping: Mapping[str, str] = field(default_factory=dict)
    keys_blacklist: tuple[str, ...] = DEFAULT_KEYS_BLACKLIST
    text_pattern: str = CLF_PATTERN
    message_pattern: str | None = None  # of the text in telemetry messages; as text_pattern if not set
    response_time_unit: str = "ms"
    extra_info: Mapping[str, str] = field(default_factory=dict)
    fallback_on_generic: bool = False
    parse_message: bool = False
    apps: Mapping[str, AppOptions] = field(default_factory=default_apps)

    def app_options(self, app: str) -> AppOptions:
        """Options of ``app``; the misspelt key ``datapi`` found in existing configurations also counts."""
        if app == "dataapi" and app not in self.apps:
            return self.apps.get("datapi", AppOptions())
        return self.apps.get(app, AppOptions())
