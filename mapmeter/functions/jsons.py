"""JSON text: access, kinds, and request details as one JSON object."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from mapmeter.schemas import DETAIL_TYPES


def json_get(text: Column, key: str) -> Column:
    """``text ->> key``."""
    return F.get_json_object(text, f"$['{key}']")


def json_kind(text: Column) -> Column:
    """``object``, ``array``, ``scalar``, or NULL when the text is not JSON."""
    shape = F.schema_of_variant(F.try_parse_json(text))
    return (
        F.when(shape.startswith("OBJECT"), F.lit("object"))
        .when(shape.startswith("ARRAY"), F.lit("array"))
        .when(shape.isNotNull(), F.lit("scalar"))
    )


def json_array(text: Column) -> Column:
    """JSON array text to ``array<string>``; anything else to NULL."""
    return F.when(json_kind(text) == "array", F.from_json(text, "array<string>"))


def json_has_tag(text: Column, tag: str) -> Column:
    """Containment of ``tag`` in the ``tags`` array of a JSON object."""
    return F.coalesce(F.array_contains(json_array(json_get(text, "tags")), tag), F.lit(False))


def has_tag(details: Column, tag: str) -> Column:
    return F.array_contains(details["tags"], tag)


def details_to_json(details: Column) -> Column:
    """Typed details and the remaining parameters as one flat JSON object."""
    typed = F.to_json(F.struct(*[details[name].alias(name) for name in DETAIL_TYPES]))
    rest = F.coalesce(F.to_json(details["params"]), F.lit("{}"))
    return (
        F.when(rest == "{}", typed)
        .when(typed == "{}", rest)
        .otherwise(F.concat(F.substr(typed, F.lit(1), F.length(typed) - 1), F.lit(","), F.substr(rest, F.lit(2))))
    )
