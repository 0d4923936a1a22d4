"""Reading fields of JSON text through ordered fallback chains.

JSON text is parsed once to a variant; the helpers look at a value's kind, as a
field of the wrong kind has to be told from a missing one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def parsed(text: Column) -> Column:
    """The text as a variant; NULL if it isn't valid JSON."""
    return F.try_parse_json(text)


def at(value: Column, path: str) -> Column:
    """The value at a path like $.a.b; NULL if it is missing or null."""
    found = F.try_variant_get(value, path, "variant")
    return F.when(~F.is_variant_null(found), found)


def kind(value: Column) -> Column:
    """STRING, BOOLEAN, OBJECT, ARRAY or NUMBER; NULL for no value."""
    schema = F.schema_of_variant(value)
    return (
        F.when(value.isNull(), F.lit(None).cast("string"))
        .when(schema.startswith("OBJECT"), "OBJECT")
        .when(schema.startswith("ARRAY"), "ARRAY")
        .when(schema.isin("STRING", "BOOLEAN"), schema)
        .otherwise("NUMBER")
    )


def pick(value: Column, *paths: str) -> Column:
    """The first value of paths that is there and not null."""
    return F.coalesce(*(at(value, p) for p in paths))


def string(value: Column) -> Column:
    """A variant's text if it is a string; else NULL."""
    return F.when(kind(value) == "STRING", F.try_variant_get(value, "$", "string"))


def pick_string(value: Column, *paths: str) -> Column:
    """pick, then NULL unless the picked value is a string; an empty string is kept."""
    return string(pick(value, *paths))


def pick_text(value: Column, *paths: str) -> Column:
    """The first non-empty string of paths; values of other kinds are passed over."""
    return reduce(lambda a, b: F.coalesce(a, b), [F.when(F.length(s) > 0, s) for s in (string(at(value, p)) for p in paths)])


def number(value: Column) -> Column:
    """A variant's number; NULL for other kinds and for what isn't finite."""
    n = F.when(kind(value) == "NUMBER", F.try_variant_get(value, "$", "double"))
    return F.when(~F.isnan(n) & (F.abs(n) < float("inf")), n)


def pick_time(value: Column) -> Column:
    """A number, or an object's start, else created, in milliseconds."""
    nested = F.coalesce(at(value, "$.start"), at(value, "$.created"))
    return F.coalesce(number(value), F.when(kind(value) == "OBJECT", number(nested))).cast("long")


def whole(value: Column) -> Column:
    return number(value).cast("long")


def usage(value: Column) -> Column:
    """Token counts of either naming as one struct; NULL if none is a number."""

    def first(*paths: str) -> Column:
        return F.coalesce(*(whole(at(value, p)) for p in paths))

    fields = {
        "cache_read": first("$.cache.read", "$.cacheReadTokens"),
        "cache_write": first("$.cache.write", "$.cacheWriteTokens"),
        "input": first("$.input", "$.inputTokens"),
        "output": first("$.output", "$.outputTokens"),
        "reasoning": first("$.reasoning", "$.reasoningTokens"),
    }
    some = F.coalesce(*fields.values()).isNotNull()
    return F.when(some, F.struct(*(c.alias(n) for n, c in fields.items())))


def iso_millis(text: Column) -> Column:
    """An ISO-8601 time in milliseconds; 0 if it can't be read."""
    return F.coalesce(F.unix_millis(F.try_to_timestamp(text)), F.lit(0).cast("long"))

