"""Helpers over variants and JSON text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with `value` evaluated once, also within a lambda, where Spark shares no subexpressions."""
    return F.transform(F.array(value), body)[0]


def items(v: Column) -> Column:
    """array<variant> of a JSON array, null for any other value."""
    return F.try_variant_get(v, "$", "array<variant>")


def members(v: Column) -> Column:
    """map<string,variant> of a JSON object, null for any other value."""
    return F.try_variant_get(v, "$", "map<string,variant>")


def unquoted(text: Column) -> Column:
    """JSON text out of a JSON string that holds it, as often as it is wrapped; other text as it is."""
    wraps = F.length(F.regexp_extract(text, r'^[\s"\\]+', 0))
    inner = F.aggregate(F.sequence(F.lit(1), F.greatest(wraps, F.lit(1))), text, lambda t, _: F.when(t.rlike(r'^\s*"'), F.coalesce(F.get_json_object(t, "$"), t)).otherwise(t))
    return F.when(text.rlike(r'^\s*"'), inner).otherwise(text)


def nesting(json: Column) -> Column:
    """Depth of objects and arrays in JSON text, what stands in strings left out; 0 for null."""
    marks = F.regexp_replace(F.regexp_replace(json, r'"(?:[^"\\]++|\\.)*+"', ""), r"[^\[\]{}]+", "")
    marks = F.translate(marks, "{}", "[]")
    deep = F.aggregate(
        F.split(marks, ""),
        F.struct(F.lit(0).alias("now"), F.lit(0).alias("most")),
        lambda s, c: F.struct((s["now"] + F.when(c == "[", 1).when(c == "]", -1).otherwise(0)).alias("now"), F.greatest(s["most"], s["now"] + F.when(c == "[", 1).otherwise(0)).alias("most")),
        lambda s: s["most"],
    )
    return F.coalesce(deep, F.lit(0))
