"""Split the array of a message into pages."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import ERROR_TYPE, bind, json_name, json_string, named, once, variant_at, with_error
from .parse import message_text
from .validate import item_message, item_violations


_STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
# The keys of a JSON text, each with a colon after it: a string is consumed whole, so none of its contents is taken for a key.
_KEYS = _STRING.replace('"', '"(', 1)[:-1] + r')"\s*+(:)|' + _STRING + r'|[^"]++'
# A key with a dot or an escape, or an empty one: only with such keys can fields share a path.
_DOTTED = r"[.\\]|(?:\A|:):"
# A key of digits reads as a position when a document is put together again.
_NUMBER = r"(?:\A|:)([0-9]++)(?=:)"


#: No string holds more bytes, so a path such as ``a.2000000000`` cannot be written: the nulls before it take five each.
LONGEST = 2**31 - 1
NULL_BYTES = len("null,")


@dataclass(frozen=True)
class PageNames:
    """Field names of an output page."""

    array: str
    index: str = "index"
    total: str = "total"
    count: str = "count"


_PAGE = "struct<page_index:int,total_pages:int,item_count:int,items:array<{item}>,item_texts:array<string>,value:binary,error:" + ERROR_TYPE + ">"

#: Adds ``_errors``, an error or NULL for each of ``_pages`` (``p, total, items, texts``; a NULL array where nothing can fail).
PageCheck = Callable[[DataFrame], DataFrame]


def paginate(
    df: DataFrame,
    array: str,
    page_size: int,
    item_required: Sequence[str] = (),
    on_non_array: str = "dlq",
    keep_value: bool = False,
    check: PageCheck | None = None,
) -> DataFrame:
    """One row per page: ``page_index, total_pages, item_count, items ARRAY<VARIANT>, item_texts``.

    Rows that failed before stay as one row with their ``error``.  An empty array gives no
    row.  With ``item_required`` a page with an incomplete item becomes an error row of its
    own and the other pages flow.

    ``value``, the whole message, stays on error rows only: beside each page it would grow with the square of
    the message.  ``check`` tells which pages fail later on (:func:`pathweave.plans.flow.page_check`); it is asked only
    about messages with keys that can do harm, and its errors take effect here, where the message is at hand.  ``keep_value``
    copies the message beside each page, for rules of one's own.  ``item_texts`` has the items as they are written where
    two fields may share a path, and is NULL elsewhere.

    Pages come out of one generator: neither the array nor the message is a column beside them.  Only where
    ``check`` is asked all pages of a message stand in its row.

    ``on_non_array='dlq'`` rejects a missing or non-array field.  ``'drop'`` drops it
    without a trace, except that a non-empty object is rejected.
    """
    _check_page_size(page_size)
    _check_policy(on_non_array)
    v, ok = F.col("v"), F.col("error").isNull()
    items = variant_at(v, [array], "array<variant>")
    texts = F.when(F.col("_keys").rlike(_DOTTED), _spelled(array))
    columns = df.columns
    df = once(df, _keys=F.when(ok, F.regexp_replace(message_text(F.col("value")), _KEYS, "$1$2")))
    if check is not None:
        asked = bind(F.struct(items.alias("items"), texts.alias("texts")), lambda head: _pages_of(head, page_size))
        df = check(once(df, _pages=F.when(_may_fail(F.col("_keys"), F.octet_length("value")), asked)))

    def page(head: Column, p: Column) -> Column:
        fields = _fields_of(head, page_size, p)
        part = fields.getField("items")
        error = F.lit(None).cast(ERROR_TYPE)
        if item_required:
            bad = item_message(item_violations(part, p * page_size, array, item_required))
            error = bind(bad, lambda b: F.when(b.isNotNull(), F.struct(F.lit("ITEM_REQUIRED").alias("code"), b.alias("message"))))
        if check is not None:
            error = F.coalesce(error, F.get("_errors", p))

        def judged(e: Column) -> Column:
            original = F.col("value") if keep_value else F.when(e.isNotNull(), F.col("value"))
            return F.struct(
                p.alias("page_index"),
                fields.getField("total").alias("total_pages"),
                F.least(F.lit(page_size), F.size(head.getField("items")) - p * page_size).alias("item_count"),
                F.when(e.isNull(), part).alias("items"),
                F.when(e.isNull(), fields.getField("texts")).alias("item_texts"),
                original.alias("value"),
                e.alias("error"),
            )

        return bind(error, judged)

    def pages(head: Column) -> Column:
        found = head.getField("items")
        error = _non_array(v, array, on_non_array)
        refused = F.when(error.isNotNull(), F.array(_failed_page(error, "variant")))
        return F.when(found.isNotNull(), F.transform(_page_numbers(found, page_size), lambda p: page(head, p))).otherwise(refused)

    earlier = F.array(_failed_page(F.col("error"), "variant"))
    rows = F.when(F.col("error").isNotNull(), earlier).otherwise(bind(F.struct(items.alias("items"), texts.alias("texts")), pages))
    kept = [named(c) for c in columns if c not in ("v", "value", "error")]
    return df.select(*kept, F.inline(rows.cast(f"array<{_PAGE.format(item='variant')}>")))


def _spelled(array: str) -> Column:
    """The items of the array as they are written."""
    raw = F.from_json(message_text(F.col("value")), f"struct<`{array.replace('`', '``')}`: array<string>>").getItem(array)
    return F.transform(raw, lambda t: F.coalesce(t, F.lit("null")))


def _may_fail(keys: Column, size: Column) -> Column:
    """Whether a document with these keys can fail to be put together again: fields may share a path, or positions lie so far
    apart that the nulls between them are longer than a string.  Arrays as they are written leave no wider gaps than their text."""
    numbers = F.regexp_extract_all(keys, F.lit(_NUMBER), F.lit(1))
    reach = F.aggregate(numbers, F.lit(0.0), lambda total, n: total + n.cast("double"))
    return keys.rlike(_DOTTED) | F.when(keys.rlike(_NUMBER), (reach + size) * NULL_BYTES > LONGEST).otherwise(False)


def _fields_of(head: Column, page_size: int, p: Column) -> Column:
    items, texts = head.getField("items"), head.getField("texts")
    return F.struct(
        p.alias("p"),
        _total_pages(items, page_size).alias("total"),
        _part(items, p, page_size).alias("items"),
        F.when(F.size(texts) == F.size(items), _part(texts, p, page_size)).alias("texts"),
    )


def _part(items: Column, p: Column, page_size: int) -> Column:
    # slice() reads its whole array, which for all pages together grows with the square of their number
    last = F.least((p + 1) * page_size, F.size(items)) - 1
    return F.transform(F.sequence(p * page_size, last), lambda i: F.get(items, i))


def _pages_of(head: Column, page_size: int) -> Column:
    return F.transform(_page_numbers(head.getField("items"), page_size), lambda p: _fields_of(head, page_size, p))


def split_to_json(
    df: DataFrame, array: str, page_size: int, names: PageNames, on_non_array: str = "dlq"
) -> DataFrame:
    """One row per page with the page as JSON bytes in ``value``: index, total, count, array.

    Numbers keep their kind, so ``1.0`` stays ``1.0``.
    """
    _check_page_size(page_size)
    _check_policy(on_non_array)
    v = F.col("v")
    ok = F.col("error").isNull()
    field = array.replace("`", "``")
    raw = F.from_json(message_text(F.col("value")), f"struct<`{field}`: array<string>>").getItem(array)
    df = once(
        df,
        drop=("v",),
        _parsed=F.when(ok, variant_at(v, [array], "array<variant>")),
        _raw=F.when(ok, raw),
        error=F.coalesce(F.col("error"), _non_array(v, array, on_non_array)),
    )
    # the spelling of the items comes from a second reading of the text, which must agree with the first
    differs = F.col("_parsed").isNotNull() & ~F.size("_parsed").eqNullSafe(F.size("_raw"))
    df = with_error(df, "PARSE", F.when(differs, F.lit(f"Items of '{array}' cannot be read one by one")))
    df = once(df, drop=("_parsed", "_raw"), items=F.when(F.col("error").isNull(), F.zip_with("_parsed", "_raw", _item_text)))
    items = F.col("items")
    total = _total_pages(items, page_size)

    def page(p: Column) -> Column:
        part = _part(items, p, page_size)
        count = F.least(F.lit(page_size), F.size(items) - p * page_size)
        body = F.concat(
            F.lit("{" + json_name(names.index) + ":"), p.cast("string"),
            F.lit("," + json_name(names.total) + ":"), total.cast("string"),
            F.lit("," + json_name(names.count) + ":"), count.cast("string"),
            F.lit("," + json_name(names.array) + ":["), F.array_join(part, ","), F.lit("]}"),
        )
        return F.struct(
            p.alias("page_index"),
            total.alias("total_pages"),
            count.alias("item_count"),
            F.lit(None).cast("array<string>").alias("items"),
            F.lit(None).cast("array<string>").alias("item_texts"),
            body.cast("binary").alias("value"),
            F.lit(None).cast(ERROR_TYPE).alias("error"),
        )

    pages = F.transform(_page_numbers(items, page_size), page)
    rows = F.when(F.col("error").isNotNull(), F.array(_failed_page(F.col("error"), "string"))).otherwise(pages)
    kept = [named(c) for c in df.columns if c not in ("value", "error", "items")]
    return df.select(*kept, F.inline(rows.cast(f"array<{_PAGE.format(item='string')}>"))).drop("items", "item_texts")


def without_originals(df: DataFrame) -> DataFrame:
    """Take ``value`` off the rows without an error, once no step that may fail follows."""
    return df.withColumn("value", F.when(F.col("error").isNotNull(), F.col("value")))


def _item_text(item: Column, raw: Column) -> Column:
    # raw is the item as written, but a string without its quotes and a null as SQL NULL
    is_string = F.schema_of_variant(item) == "STRING"
    return F.when(is_string, json_string(raw)).otherwise(F.coalesce(raw, F.lit("null")))


def _page_numbers(items: Column, page_size: int) -> Column:
    # sequence() counts down when its end lies before its start, hence the guard
    last = ((F.size(items) - 1) / page_size).cast("int")
    return F.when(F.size(items) > 0, F.sequence(F.lit(0), last))


def _total_pages(items: Column, page_size: int) -> Column:
    return F.ceil(F.size(items) / page_size).cast("int")


def _failed_page(error: Column, item_type: str) -> Column:
    none = F.lit(None)
    return F.struct(
        none.cast("int").alias("page_index"),
        none.cast("int").alias("total_pages"),
        none.cast("int").alias("item_count"),
        none.cast(f"array<{item_type}>").alias("items"),
        none.cast("array<string>").alias("item_texts"),
        F.col("value").alias("value"),
        error.alias("error"),
    )


def _non_array(v: Column, array: str, policy: str) -> Column:
    error = F.struct(
        F.lit("NOT_ARRAY").alias("code"),
        F.lit(f"Field '{array}' is missing or not a JSON array").alias("message"),
    )
    if policy == "dlq":
        return F.when(variant_at(v, [array], "array<variant>").isNull(), error)
    fields = F.map_keys(variant_at(v, [array], "map<string,variant>"))
    return F.when(F.size(fields) > 0, error)


def _check_page_size(page_size: int) -> None:
    if page_size <= 0:
        raise ValueError(f"page_size must be positive, got {page_size}")


def _check_policy(policy: str) -> None:
    if policy not in ("dlq", "drop"):
        raise ValueError(f"on_non_array must be 'dlq' or 'drop', got {policy!r}")
