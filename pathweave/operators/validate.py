"""Presence rules on messages and on array items (V3, V4, V5)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import java_list, variant_at, with_error


def path_keys(path: str) -> list[str]:
    """Keys of a required path; trailing empty keys do not count."""
    keys = path.split(".")
    while len(keys) > 1 and keys[-1] == "":
        keys.pop()
    return keys


def missing(v: Column, path: str) -> Column:
    """True when the parent of ``path`` exists but the last key does not.

    A present JSON null satisfies the rule.  When the parent is absent the rule does not apply.
    """
    keys = path_keys(path)
    absent = variant_at(v, keys).isNull()
    if len(keys) == 1:
        return absent
    return variant_at(v, keys[:-1]).isNotNull() & absent


def validate_required(df: DataFrame, paths: Sequence[str]) -> DataFrame:
    """Mark rows whose ``v`` lacks a required path; all violations go into one message."""
    parts = [F.when(missing(F.col("v"), p), F.lit(f"missing required field '{p}'")) for p in paths]
    if not parts:
        return df
    return with_error(df, "REQUIRED", F.concat(F.lit("Input schema validation failed: "), _if_ok(df, parts)))


def item_violations(items: Column, first: Column, array: str, paths: Sequence[str]) -> Column:
    """``[…]`` text of all item violations, or NULL.  ``first`` is the position of the first item."""

    def check(item: Column, i: Column) -> Column:
        at = F.concat(F.lit(f" in {array}["), (first + i).cast("string"), F.lit("]"))
        found = [F.when(missing(item, p), F.concat(F.lit(f"missing required field '{p}'"), at)) for p in paths]
        return F.concat_ws(", ", *found)

    texts = F.filter(F.transform(items, check), lambda t: t != "")
    return F.concat(F.lit("["), F.nullif(F.array_join(texts, ", "), F.lit("")), F.lit("]"))


def item_message(violations: Column) -> Column:
    return F.concat(F.lit("Item validation failed: "), violations)


def validate_items(pages: DataFrame, array: str, page_size: int, paths: Sequence[str]) -> DataFrame:
    """Mark the pages that hold an incomplete item; other pages of the message are untouched.

    The pages must come from ``paginate(keep_value=True)``, so that a rejected page carries the
    original message; the others lose it here.  For large messages prefer
    ``paginate(item_required=…)``, which checks before the split and copies none.
    """
    if not paths:
        return pages
    first = F.col("page_index") * F.lit(page_size)
    checked = with_error(pages, "ITEM_REQUIRED", item_message(item_violations(F.col("items"), first, array, paths)))
    return checked.withColumn("value", F.when(F.col("error").isNotNull(), F.col("value")))


def validate_messages(
    df: DataFrame, array: str, top_level: Sequence[str], item_fields: Sequence[str]
) -> DataFrame:
    """Whole-message check: direct children only, any incomplete item rejects the message.

    ``value`` passes through unchanged.
    """
    v = F.col("v")
    parts = [
        F.when(variant_at(v, [f]).isNull(), F.lit(f"missing top-level field '{f}'")) for f in top_level
    ]
    if item_fields:

        def check(item: Column, i: Column) -> Column:
            at = F.concat(F.lit(f" in {array}["), i.cast("string"), F.lit("]"))
            return F.concat_ws(
                ", ",
                *[
                    F.when(variant_at(item, [f]).isNull(), F.concat(F.lit(f"missing field '{f}'"), at))
                    for f in item_fields
                ],
            )

        texts = F.filter(F.transform(variant_at(v, [array], "array<variant>"), check), lambda t: t != "")
        parts.append(F.nullif(F.array_join(texts, ", "), F.lit("")))
    if not parts:
        return df
    return with_error(df, "REQUIRED", F.concat(F.lit("Required field validation failed: "), _if_ok(df, parts)))


def _if_ok(df: DataFrame, parts: Sequence[Column]) -> Column:
    # a row that failed before has nothing to look at
    text = java_list(parts)
    return F.when(F.col("error").isNull(), text) if "error" in df.columns else text
