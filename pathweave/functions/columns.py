"""Small Column helpers shared by the operators."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Type of the ``error`` column every operator understands.
ERROR_TYPE = "struct<code:string,message:string>"

# A character that JSON text may only carry in escaped form.
_NEEDS_ESCAPE = r'["\\\x00-\x1f]'


def named(name: str) -> Column:
    """A column by its literal name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` mentions it.

    A fold hands its state on as it is, while a transform copies whatever its lambda returns.
    """
    return F.aggregate(F.array(F.lit(0)), value, lambda state, _: state, use)


def once(df: DataFrame, drop: Sequence[str] = (), **columns: Column) -> DataFrame:
    """Add columns that are computed exactly once per row.

    A plain projection may be inlined into later projections, into lambdas and into filters
    that are pushed below it, which repeats costly work such as a JSON parse.  Filters on the
    output of a generator stay above it, so a one-row generator keeps the value in place.
    """
    gone = set(drop) | set(columns)
    kept = [named(c) for c in df.columns if c not in gone]
    row = F.struct(*[value.alias(name) for name, value in columns.items()])
    return df.select(*kept, F.inline(F.array(row)))


def with_error(df: DataFrame, code: str, message: Column) -> DataFrame:
    """Record ``message`` (NULL = no error) unless the row already failed."""
    found = F.when(message.isNotNull(), F.struct(F.lit(code).alias("code"), message.alias("message")))
    earlier = F.col("error") if "error" in df.columns else F.lit(None).cast(ERROR_TYPE)
    return df.withColumn("error", F.coalesce(earlier, found))


def json_string(text: Column) -> Column:
    """``text`` as a quoted JSON string."""
    plain = F.concat(F.lit('"'), text, F.lit('"'))
    # to_json of a one-element array, without its brackets
    escaped = F.regexp_extract(F.to_json(F.array(text)), r"(?s)\A\[(.*)\]\z", 1)
    return F.when(text.rlike(_NEEDS_ESCAPE), escaped).otherwise(plain)


def json_name(name: str) -> str:
    """A field name known up front, as a quoted JSON string."""
    return json.dumps(name, ensure_ascii=False)


def plain_key(key: str) -> bool:
    """True when ``key`` can be written inside a Variant path."""
    return bool(key) and not any(c in key for c in "\"'?[]\\")


def variant_at(v: Column, keys: Sequence[str | int], as_type: str = "variant") -> Column:
    """The value below ``v`` at ``keys``; SQL NULL when there is none.

    Strings name object fields, integers array positions.  A JSON null is *not* SQL NULL when
    read as ``variant``.
    """
    path = "$"
    for key in keys:
        if isinstance(key, int):
            path += f"[{key}]"
        elif plain_key(key):
            path += f'["{key}"]'
        else:  # a key the path syntax cannot express
            v = F.try_element_at(F.try_variant_get(v, path, "map<string,variant>"), F.lit(key))
            path = "$"
    return F.try_variant_get(v, path, as_type)


def java_list(parts: Sequence[Column]) -> Column:
    """``[a, b]`` from the non-NULL parts; NULL when all are NULL."""
    joined = F.nullif(F.concat_ws(", ", *parts), F.lit(""))
    return F.concat(F.lit("["), joined, F.lit("]"))


def leaves_at(flat: Column, paths: Sequence[str]) -> Column:
    """Map from each of the ``paths`` that ``flat`` has to its leaf: one pass over the leaves, however many paths."""
    wanted = F.filter(flat, lambda e: e.getField("path").isin(*paths))
    return F.map_from_entries(F.transform(wanted, lambda e: F.struct(e.getField("path").alias("key"), e.alias("value"))))
