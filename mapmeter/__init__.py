"""Usage metering for map services: HTTP access logs in, usage rollups out, all as Spark jobs."""

from mapmeter.settings import AppOptions, Settings

__all__ = ["AppOptions", "Settings"]
