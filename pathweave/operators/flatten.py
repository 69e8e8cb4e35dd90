"""Nested values to dotted-path leaves.

``flat`` is ``ARRAY<STRUCT<path, leaf_type, value>>``: the leaves of one row in order, each
with its type and its text.  Types are ``STRING BIGINT DOUBLE BOOLEAN VOID``, ``INT`` for page
counters and ``DECIMAL(p,0)`` for whole numbers wider than a long, which are kept exactly.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import bind, named, once, with_error
from .paginate import PageNames
from .parse import message_text
from .shapes import leaves_of

INCLUDE = "INCLUDE"
EXCLUDE = "EXCLUDE"
REPLACE_EMPTY_STRING = "REPLACE_EMPTY_STRING"
NULL_POLICIES = (INCLUDE, EXCLUDE, REPLACE_EMPTY_STRING)

# All strings of a JSON text, and everything else that opens or closes no container.
_NO_BRACKETS = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"|[^\[\]{}"]++'

# Reads what the lenient parser reads; texts that the strict one takes mean the same.
_ORDERED = {"allowComments": "true", "allowSingleQuotes": "true"}

FLAT_TYPE = "array<struct<path:string,leaf_type:string,value:string>>"
# Levels of containers that are opened without a fold.
_QUICK = 4
_NODES = "array<array<struct<path:string,v:variant,at:array<int>,kids:array<struct<key:string,value:variant>>>>>"


def flatten_json(df: DataFrame, nulls: str = INCLUDE) -> DataFrame:
    """Add ``flat`` with the leaves of ``v``; empty containers leave no trace.

    A ``value`` beside it is the text that ``v`` was parsed from.  Where several fields have one path (keys with dots), the later one
    in that text wins; without a ``value`` the order is unknown and the row gets the error ``CONFLICT``.
    """
    _check_policy(nulls)
    v = F.col("v")
    # most messages are done a batch at a time, the others by expressions
    plain = leaves_of(F.when(F.col("error").isNull(), _text_of(df)), nulls, NULL_POLICIES)
    roots = F.array(F.struct(F.lit("").alias("path"), v.alias("v"), _text_of(df).alias("text")))
    slow = document_leaves(roots, F.to_json(v), nulls)
    found = bind(_quick(F.lit(""), v, nulls), lambda found: F.when(_is_done(found), _bare(found)).otherwise(slow))
    df = once(df.withColumn("_plain", plain), drop=("v",), _found=F.when(F.col("error").isNull() & F.col("_plain").isNull(), found))
    return _marked(df.withColumn("flat", F.coalesce("_plain", "_found")).drop("_plain", "_found"))


def flatten_pages(pages: DataFrame, names: PageNames, nulls: str = INCLUDE) -> DataFrame:
    """Add ``flat`` to each page: counters, then items as ``<array>.<index in page>.…``.

    Where fields of an item have one path, the later one in the message wins; ``paginate`` hands over the
    ``item_texts`` for it.  Pages without them get the error ``CONFLICT``.
    """
    texts = F.col("item_texts") if "item_texts" in pages.columns else F.lit(None).cast("array<string>")
    found = F.flatten(F.transform("items", lambda x, i: _quick(_item_path(names, i), x, nulls)))
    pages = once(pages, _found=F.when(F.col("error").isNull(), found))
    slow = item_leaves(F.col("items"), texts, names, nulls)
    leaves = F.when(_is_done(F.col("_found")), _bare(F.col("_found"))).otherwise(slow)
    flat = with_counters(F.col("page_index"), F.col("total_pages"), F.col("item_count"), leaves, names)
    return _with_flat(pages, ("items", "_found", "item_texts"), flat)


def item_leaves(items: Column, texts: Column, names: PageNames, nulls: str = INCLUDE) -> Column:
    """The leaves of the items of a page; NULL where fields share a path and their order is unknown."""

    def root(item: Column, i: Column) -> Column:
        return F.struct(_item_path(names, i).alias("path"), item.alias("v"), F.get(texts, i).alias("text"))

    return document_leaves(F.transform(items, root), F.to_json(items), nulls)


def with_counters(index: Column, total: Column, count: Column, leaves: Column, names: PageNames) -> Column:
    """The leaves of a page, in name order like the keys of every object below."""
    parts = {
        names.index: _counter(names.index, index),
        names.total: _counter(names.total, total),
        names.count: _counter(names.count, count),
        names.array: leaves,
    }
    return F.concat(*[parts[name] for name in sorted(parts)])


def _item_path(names: PageNames, i: Column) -> Column:
    return F.concat(F.lit(names.array + "."), i.cast("string"))


def _counter(name: str, value: Column) -> Column:
    return F.array(_entry(F.lit(name), F.lit("INT"), value.cast("string")))


def _text_of(df: DataFrame) -> Column:
    return message_text(F.col("value")) if "value" in df.columns else F.lit(None).cast("string")


def _with_flat(df: DataFrame, sources: Sequence[str], flat: Column) -> DataFrame:
    return _marked(once(df, drop=sources, flat=F.when(F.col("error").isNull(), flat)))


def _marked(df: DataFrame) -> DataFrame:
    unknown = F.col("error").isNull() & F.col("flat").isNull()
    return with_error(df, "CONFLICT", F.when(unknown, F.lit("Several fields flatten to the same path")))


def explode_leaves(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Long form: one row ``(keep…, path, leaf_type, value)`` per leaf."""
    return df.select(*[named(c) for c in keep], F.inline("flat"))


def children(v: Column) -> Column:
    """Key/value pairs of an object or array Variant; NULL for a leaf."""
    fields = F.map_entries(F.try_variant_get(v, "$", "map<string,variant>"))
    elements = F.transform(
        F.try_variant_get(v, "$", "array<variant>"),
        lambda x, i: F.struct(i.cast("string").alias("key"), x.alias("value")),
    )
    return F.coalesce(fields, elements)


def nesting(text: Column) -> Column:
    """How many containers a JSON text nests, 0 for a scalar."""
    brackets = F.regexp_replace(text, _NO_BRACKETS, "")
    # without its innermost containers a text nests one level less, and is much shorter
    outer = F.regexp_replace(F.regexp_replace(brackets, r"\{\}|\[\]", ""), r"[\[{]", "(")

    def step(at: Column, bracket: Column) -> Column:
        now = at.getField("now") + F.when(bracket == "(", 1).otherwise(-1)
        return F.struct(now.alias("now"), F.greatest(at.getField("most"), now).alias("most"))

    start = F.struct(F.lit(0).alias("now"), F.lit(0).alias("most"))
    deepest = F.aggregate(F.filter(F.split(outer, ""), lambda c: c != ""), start, step, lambda at: at.getField("most"))
    return F.when(brackets == "", F.lit(0)).otherwise(1 + deepest)


def _quick(path: Column, v: Column, nulls: str, levels: int = _QUICK) -> Column:
    """Typed leaves below ``v`` in order, with what nests deeper than ``levels`` containers left in ``rest``.

    Lambdas inside each other, one for each level: nothing is touched twice, and no depth has to be known before.
    """
    no_rest = F.lit(None).cast("variant").alias("rest")
    if not levels:
        none = F.lit(None).cast("string")
        rest = F.struct(path.alias("path"), none.alias("leaf_type"), none.alias("value"), v.alias("rest"))
        opened = F.when(children(v).isNotNull(), F.array(rest))
    else:
        opened = F.flatten(
            F.transform(children(v), lambda c: _quick(_below(path, c.getField("key")), c.getField("value"), nulls, levels - 1))
        )

    def leaf(kind: Column) -> Column:
        return F.struct(path.alias("path"), *_typed(v, kind, nulls), no_rest)

    kinds = F.array(F.schema_of_variant(v))
    if nulls == EXCLUDE:
        kinds = F.filter(kinds, lambda k: k != "VOID")
    return F.coalesce(opened, F.transform(kinds, leaf))


def _is_done(found: Column) -> Column:
    """Whether nothing nests deeper and no two leaves have one path."""
    deeper = F.exists(found, lambda e: e.getField("rest").isNotNull())
    return ~deeper & (F.size(F.array_distinct(found.getField("path"))) == F.size(found))


def _bare(found: Column) -> Column:
    return F.transform(found, lambda e: _entry(e.getField("path"), e.getField("leaf_type"), e.getField("value")))


def document_leaves(roots: Column, json: Column, nulls: str = INCLUDE) -> Column:
    """Typed leaves below ``roots`` (``path, v, text``) of any depth, one for each path; ``json`` is the text of all of them.

    A parsed Variant has lost the order of its keys.  Only where paths are shared, which takes keys with dots
    or empty ones, the texts are walked to learn it; NULL if there are none.
    """
    _check_policy(nulls)
    reached = bind(_reached(roots, _brackets(json)), lambda found: _in_order(found, nulls))

    def settled(leaves: Column) -> Column:
        shared = F.size(F.array_distinct(leaves.getField("path"))) < F.size(leaves)
        walked = F.when(
            ~F.exists(roots, lambda r: r.getField("text").isNull()), _last_of_each(_kept(_leaves(_walked(roots, nesting(json)), nulls), nulls))
        )
        return F.when(shared, walked).otherwise(leaves)

    return bind(reached, settled)


def _brackets(json: Column) -> Column:
    """No text nests deeper than it has opening brackets."""
    return F.length(json) - F.length(F.translate(json, "{[", ""))


def _below(path: Column, key: Column) -> Column:
    # an empty first key adds nothing in front of the keys below it
    return F.when(path == "", key).otherwise(F.concat(path, F.lit("."), key))


def _steps(depth: Column, fold: Callable[[Column], Column]) -> Column:
    return bind(depth, lambda n: fold(F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))))


def _opened(path: Column, v: Column, at: Column) -> Column:
    return F.struct(path.alias("path"), v.alias("v"), at.alias("at"), children(v).alias("kids"))


def _reached(roots: Column, most: Column) -> Column:
    """Leaves below ``roots``, an array for each level; ``at`` is the place of a leaf in the tree.

    Each step opens the containers that the one before found, and sets its leaves aside: every node is touched once,
    whatever the depth of others.  Steps after the last level, of which ``most`` may have many, do nothing.
    """

    def is_leaf(node: Column) -> Column:
        return node.getField("kids").isNull()

    def below(node: Column) -> Column:
        path, at = node.getField("path"), node.getField("at")
        return F.transform(
            node.getField("kids"), lambda c, i: _opened(_below(path, c.getField("key")), c.getField("value"), F.concat(at, F.array(i)))
        )

    def step(state: Column, level: Column) -> Column:
        nodes, done = state.getField("nodes"), state.getField("done")
        leaves = F.filter(nodes, is_leaf)
        deeper = F.struct(
            F.when(F.size(leaves) > 0, F.concat(done, F.array(leaves))).otherwise(done).alias("done"),
            F.flatten(F.transform(F.filter(nodes, lambda n: ~is_leaf(n)), below)).alias("nodes"),
        )
        return F.when(F.size(nodes) > 0, deeper).otherwise(state)

    nodes = F.transform(roots, lambda r, i: _opened(r.getField("path"), r.getField("v"), F.array(i)))
    start = F.struct(F.array().cast(_NODES).alias("done"), nodes.alias("nodes"))
    return _steps(most + 1, lambda levels: F.aggregate(levels, start, step, lambda state: state.getField("done")))


def _in_order(levels: Column, nulls: str) -> Column:
    """Typed leaves in the order of the tree."""
    nodes = F.flatten(levels)
    placed = F.zip_with(nodes, _leaves(nodes, nulls), lambda n, e: F.struct(n.getField("at").alias("at"), e.alias("leaf")))
    return _kept(F.transform(F.sort_array(placed), lambda x: x.getField("leaf")), nulls)


def _walked(roots: Column, depth: Column) -> Column:
    """Leaves below ``roots`` in the order of their texts."""

    def kids(node: Column) -> Column:
        v, text = node.getField("v"), node.getField("text")
        fields = F.map_entries(F.from_json(text, "map<string,variant>", _ORDERED))
        texts = F.map_values(F.from_json(text, "map<string,string>", _ORDERED))
        is_object = F.try_variant_get(v, "$", "map<string,variant>").isNotNull()
        listed = F.transform(
            F.try_variant_get(v, "$", "array<variant>"), lambda x, i: F.struct(i.cast("string").alias("key"), x.alias("value"))
        )
        elements = bind(F.from_json(text, "array<string>", _ORDERED), lambda t: _beside(listed, t))
        return F.when(is_object, bind(_beside(fields, texts), _last_values)).otherwise(elements)

    def expand(found: Column, level: Column) -> Column:
        def one(node: Column) -> Column:
            path = node.getField("path")
            opened = F.transform(
                kids(node),
                lambda c: _step(_below(path, c.getField("key")), c.getField("value"), c.getField("text"), F.lit(False)),
            )
            closed = _step(path, node.getField("v"), node.getField("text"), F.lit(True))
            return F.when(node.getField("done"), F.array(node)).otherwise(F.coalesce(opened, F.array(closed)))

        return F.flatten(F.transform(found, one))

    start = F.transform(roots, lambda r: _step(r.getField("path"), r.getField("v"), r.getField("text"), F.lit(False)))
    return _steps(depth, lambda levels: F.aggregate(levels, start, expand))


def _step(path: Column, v: Column, text: Column, done: Column) -> Column:
    return F.struct(path.alias("path"), v.alias("v"), text.alias("text"), done.alias("done"))


def _beside(entries: Column, texts: Column) -> Column:
    return F.transform(
        entries,
        lambda e, i: F.struct(e.getField("key").alias("key"), e.getField("value").alias("value"), F.get(texts, i).alias("text")),
    )


def _last_values(fields: Column) -> Column:
    """Of fields with one key the last value, at the place of the first."""
    keys = fields.getField("key")
    backwards = F.reverse(keys)
    once_each = F.transform(F.array_distinct(keys), lambda k: F.get(fields, (F.size(keys) - F.array_position(backwards, k)).cast("int")))
    return F.when(F.size(F.array_distinct(keys)) < F.size(keys), once_each).otherwise(fields)


def _last_of_each(leaves: Column) -> Column:
    """Of leaves with one path the last."""
    placed = F.transform(
        leaves,
        lambda e, i: F.struct(
            e.getField("path").alias("path"), i.alias("i"), e.getField("leaf_type").alias("leaf_type"), e.getField("value").alias("value")
        ),
    )

    def last(ordered: Column) -> Column:
        kept = F.filter(ordered, lambda e, i: ~F.get(ordered, i + 1).getField("path").eqNullSafe(e.getField("path")))
        return F.transform(kept, lambda e: _entry(e.getField("path"), e.getField("leaf_type"), e.getField("value")))

    return bind(F.sort_array(placed), last)


def _leaves(nodes: Column, nulls: str) -> Column:
    def leaf(n: Column) -> Column:
        v = n.getField("v")
        return bind(F.schema_of_variant(v), lambda kind: F.struct(n.getField("path").alias("path"), *_typed(v, kind, nulls)))

    return F.transform(nodes, leaf)


def _kept(leaves: Column, nulls: str) -> Column:
    return F.filter(leaves, lambda e: e.getField("leaf_type") != "VOID") if nulls == EXCLUDE else leaves


def _typed(v: Column, kind: Column, nulls: str) -> tuple[Column, Column]:
    """``leaf_type`` and ``value`` of a leaf."""
    # Reading a Variant as its own type is far cheaper than converting it.  Fractions are
    # stored as decimals, and so are whole numbers too wide for a long.
    decimal = F.startswith(kind, F.lit("DECIMAL"))
    text = (
        F.when(kind == "STRING", F.try_variant_get(v, "$", "string"))
        .when(decimal, _decimal_text(kind, v))
        .when(kind == "VOID", F.lit("" if nulls == REPLACE_EMPTY_STRING else None).cast("string"))
        .otherwise(F.to_json(v))
    )
    leaf_type = F.when(decimal, _decimal_type(kind, v))
    if nulls == REPLACE_EMPTY_STRING:
        leaf_type = leaf_type.when(kind == "VOID", F.lit("STRING"))
    return leaf_type.otherwise(kind).alias("leaf_type"), text.alias("value")


def _decimal_type(kind: Column, v: Column) -> Column:
    return F.when(_wide_integer(kind, v), kind).otherwise(F.lit("DOUBLE"))


def _decimal_text(kind: Column, v: Column) -> Column:
    text = F.to_json(v)
    return F.when(_wide_integer(kind, v), text).otherwise(text.cast("double").cast("string"))


def _wide_integer(kind: Column, v: Column) -> Column:
    # a whole number that fits a long is stored as one, so a decimal that fits had a fraction
    return F.endswith(kind, F.lit(",0)")) & F.to_json(v).try_cast("bigint").isNull()


def _entry(path: Column, leaf_type: Column, value: Column) -> Column:
    return F.struct(path.alias("path"), leaf_type.alias("leaf_type"), value.alias("value"))


def _check_policy(nulls: str) -> None:
    if nulls not in NULL_POLICIES:
        raise ValueError(f"nulls must be one of {NULL_POLICIES}, got {nulls!r}")
