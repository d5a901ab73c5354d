"""URL parts and query strings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mapmeter.functions.base import UNIT, first_wins, let, settle

# RFC 3986, appendix B, on lower-cased text: scheme, authority, path, query, fragment
_PARTS = r"(?s)^(?:[a-z][a-z0-9+.\-]*:)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"

_UNSAFE = r"[\t\r\n\x1f]"

# One pass over a query string: a parameter with a value becomes RECORD key UNIT value, a flag or a blank
# value RECORD UNIT.
_RECORD = "\x1e"
_PARAMETER = r"&(?:[^&=]*=?(?=&|$)|([^&=]*)=([^&]+))"


def url_parts(url: Column) -> Column:
    """Authority, path, query and fragment as an array, from one regex run."""
    low = F.ltrim(F.lower(url))
    clean = F.when(low.rlike(_UNSAFE), F.regexp_replace(low, _UNSAFE, "")).otherwise(low)
    return F.split(F.regexp_replace(clean, _PARTS, f"$1{UNIT}$2{UNIT}$3{UNIT}$4"), UNIT)


def url_host(parts: Column) -> Column:
    # no user info, no port, no brackets of an IPv6 address
    authority = F.get(parts, F.lit(0))
    return F.when(
        F.length(authority) > 0, F.regexp_replace(authority, r"^.*@|:[^\]]*$|[\[\]]", "")
    )


def url_path(parts: Column) -> Column:
    # parameters of the last segment (;jsessionid=…) are not part of the path
    path = F.get(parts, F.lit(1))
    return F.when(path.contains(";"), F.regexp_replace(path, r";[^/]*$", "")).otherwise(path)


def url_query(parts: Column) -> Column:
    return F.get(parts, F.lit(2))


def url_fragment(parts: Column) -> Column:
    return F.get(parts, F.lit(3))


def split_url(url: Column) -> Column:
    """``struct<host,path,query,fragment>``, all lower case; a URL without authority has a NULL host."""
    return let(
        url_parts(url),
        lambda parts: F.struct(
            url_host(parts).alias("host"),
            url_path(parts).alias("path"),
            url_query(parts).alias("query"),
            url_fragment(parts).alias("fragment"),
        ),
    )


def url_decode(text: Column) -> Column:
    """Percent and plus decoding that keeps stray percent signs instead of failing."""
    decoded = F.try_url_decode(F.regexp_replace(text, "%(?![0-9A-Fa-f]{2})", "%25"))
    return F.when(text.contains("%") | text.contains("+"), F.coalesce(decoded, text)).otherwise(text)


def _glued(low: Column) -> Column:
    """The query cut into ``RECORD key UNIT value`` pieces, NULL if it holds these characters itself."""
    risky = F.lit(False)
    for mark in (_RECORD, UNIT, "%1e", "%1f"):
        risky = risky | low.contains(mark)
    return F.when(~risky, F.regexp_replace(F.concat(F.lit("&"), low), _PARAMETER, f"{_RECORD}$1{UNIT}$2"))


def _pairs(glued: Column) -> Column:
    return F.array_remove(F.split(F.substr(F.lower(url_decode(glued)), F.lit(2)), _RECORD), UNIT)


def _first_wins(pairs: Column, keys: Column) -> Column:
    values = F.transform(pairs, lambda p: F.substring_index(p, UNIT, -1))
    return F.when(
        F.size(F.array_distinct(keys)) == F.size(keys), F.map_from_arrays(keys, values)
    ).otherwise(
        F.map_from_entries(
            F.filter(
                F.arrays_zip(keys.alias("key"), values.alias("value")),
                lambda e, i: F.array_position(keys, e["key"]) == i + 1,
            )
        )
    )


def settle_query_map(df: DataFrame, name: str, query: Column) -> DataFrame:
    """Add the (lower-case) query string as ``map<string,string>``: decoded, blanks and flags left out.

    The first value of a repeated key is kept. The text is cut and decoded as a whole, in stages that
    each run once per row; only a text that holds the cutting characters itself is taken apart parameter
    by parameter.
    """
    low = F.coalesce(query, F.lit(""))
    df = settle(df, {"_cut": _glued(low)})
    df = settle(df, {"_pairs": _pairs(F.col("_cut"))})
    keys = F.transform("_pairs", lambda p: F.substring_index(p, UNIT, 1))
    whole = F.when(F.col("_cut").isNull(), _query_map_by_parameter(low)).otherwise(
        let(keys, lambda k: _first_wins(F.col("_pairs"), k))
    )
    return df.withColumn(name, whole).drop("_cut", "_pairs")


def query_map(query: Column) -> Column:
    """:func:`settle_query_map` as one expression, for use on few rows or inside other expressions."""
    low = F.lower(F.coalesce(query, F.lit("")))
    return _query_map_by_parameter(low)


def _query_map_by_parameter(low: Column) -> Column:
    valued = F.filter(
        F.split(low, "&"),
        lambda p: (F.instr(p, "=") > 0) & (F.instr(p, "=") < F.length(p)),
    )
    return first_wins(
        F.transform(
            valued,
            lambda p: F.struct(
                F.lower(url_decode(F.substring_index(p, "=", 1))).alias("key"),
                F.lower(url_decode(F.substr(p, F.instr(p, "=") + 1))).alias("value"),
            ),
        )
    )
