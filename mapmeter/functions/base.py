"""Small helpers shared by the column builders."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Unit separator: glues regex groups together and does not occur in sane log lines.
UNIT = "\x1f"


def java_regex(pattern: str) -> str:
    """A Python pattern as Java reads it: unnamed groups, Unicode classes, ``\\n`` as only line end."""
    return "(?Ud)" + re.sub(r"\(\?P<\w+>", "(", pattern)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """Bind ``value`` to a lambda variable, so that an expression using it twice computes it once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def literal_map(mapping: Mapping[str, str]) -> Column:
    """A constant map; Catalyst folds it into one literal."""
    if not mapping:
        return F.lit(None).cast("map<string,string>")
    return F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])


def first_wins(entries: Column) -> Column:
    """Array of ``struct<key,value>`` to a map in which the first entry of a key is kept."""

    def build(items: Column) -> Column:
        return let(
            F.transform(items, lambda e: e["key"]),
            lambda keys: F.map_from_entries(
                F.when(F.size(F.array_distinct(keys)) == F.size(keys), items).otherwise(
                    F.filter(items, lambda e, i: F.array_position(keys, e["key"]) == i + 1)
                )
            ),
        )

    return let(entries, build)


def last_wins(entries: Column) -> Column:
    """Like :func:`first_wins`, but the last entry of a key is kept."""
    return first_wins(F.reverse(entries))


def settle(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Add columns that are computed once per row, whatever uses them afterwards.

    A plain projection may be merged into its consumers, which then repeat costly expressions (regexes
    above all), and a filter may be pushed below it together with them. A generator over a one-element
    array is left alone by the optimizer. Not for higher-order functions: these would keep the generator
    out of code generation.
    """
    if len(columns) == 1:
        ((name, value),) = columns.items()
        return df.select("*", F.explode(F.array(value)).alias(name))
    row = F.struct(*[value.alias(name) for name, value in columns.items()])
    return df.select("*", F.inline(F.array(row)))


def settle_groups(df: DataFrame, name: str, text: str, pattern: str) -> DataFrame:
    """Add the groups of ``pattern`` at the start of ``text`` as an array, NULL when it does not match.

    One regex run yields every group: the match is rewritten to the groups, each after a separator, and
    split again. In a text that already holds the separator, a longer one made of the text's own digest
    takes its place.
    """
    value = F.col(text)
    count = re.compile(pattern).groups
    flags, body = java_regex("")[:5], java_regex(pattern)[5:]
    glue = "".join(f"{UNIT}${i}" for i in range(1, count + 1))
    clean = ~value.contains(UNIT)
    separator = F.when(clean, F.lit(UNIT)).otherwise(F.concat(F.lit(UNIT), F.md5(value), F.lit(UNIT)))
    rewrite = F.when(clean, F.lit(glue)).otherwise(F.replace(F.lit(glue), F.lit(UNIT), separator))
    df = settle(df, {"_glued": F.regexp_replace(value, F.lit(f"{flags}^(?:{body})(?s:.*)$"), rewrite)})
    groups = F.when(
        F.col("_glued").startswith(separator), F.slice(F.split("_glued", separator), 2, count)
    )
    return settle(df, {name: groups}).drop("_glued")
