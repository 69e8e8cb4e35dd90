"""Dotted-path leaves back to nested JSON.

Leaves are sorted by their tokens, so that everything below one container is contiguous.  Each
leaf then contributes the text between its predecessor and itself: it closes the containers
the predecessor was in, opens its own, and writes its value.  The document is the
concatenation.  All of this is local to the row.

A numeric segment is an array position only directly after a key; a leading one is a key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import ERROR_TYPE, bind, json_string, named, once
from .paginate import LONGEST, NULL_BYTES
from .shapes import text_of

# Stands for every position that no string could reach.
_BEYOND = 2**40

# Level number no path reaches.
_SAME = 10**9

_MARK = "\x01"
# A key and the numeric segment directly after it, which therefore is an array position.
_KEY_POSITION = r"(^|\.)([^.]*)\.([0-9]+)(?=\.|\z)"

_TOKENS = "array<struct<i:bigint,k:string>>"


def unflatten(df: DataFrame, column: str = "json") -> DataFrame:
    """Add the JSON text of ``flat``.  NULL or empty ``flat`` gives ``{}``.

    Where paths disagree (a value and a container, or positions and keys, at one place) the
    later path in sort order wins.  A non-null value at an array position that a deeper path
    needs as a container cannot be resolved; such rows get the error ``CONFLICT``.  Rows whose
    array gaps would take more bytes than a string can have get ``GAP``.
    """
    def written(plan: Column) -> Column:
        def of(error: Column) -> Column:
            return F.struct(F.when(error.isNull(), _written(plan)).alias("text"), error.alias("error"))

        return bind(plan_error(plan), of)

    # most rows are done a batch at a time, the others by expressions
    df = df.withColumn("_plain", text_of(F.when(F.col("error").isNull(), F.col("flat"))))
    df = once(df, _done=F.when(F.col("error").isNull() & F.col("_plain").isNull(), bind(document_plan(F.col("flat")), written)))
    error = F.coalesce("error", "_done.error")
    kept = [named(c) for c in df.columns if c not in ("error", "_plain", "_done", column)]
    return df.select(*kept, error.alias("error"), F.coalesce("_plain", "_done.text").alias(column))


def document_plan(flat: Column) -> Column:
    """What :func:`unflatten` writes of these leaves, step by step; NULL if their paths cannot be combined."""
    leaves = F.coalesce(flat, F.array().cast("array<struct<path:string,leaf_type:string,value:string>>"))
    return bind(bind(F.sort_array(F.transform(leaves, _tokenised)), _planned), _agreed)


def plan_error(plan: Column) -> Column:
    """The error of a row with this plan, or NULL."""
    padding = F.aggregate(plan.getField("steps"), F.lit(0).cast("bigint"), lambda total, s: total + s.getField("gap"))

    def of(code: str, message: str) -> Column:
        return F.struct(F.lit(code).alias("code"), F.lit(message).alias("message"))

    return (
        F.when(plan.isNull(), of("CONFLICT", "Paths cannot be combined into one document"))
        .when(padding * NULL_BYTES > LONGEST, of("GAP", "Array gaps are longer than a document can be"))
        .otherwise(F.lit(None).cast(ERROR_TYPE))
    )


def path_tokens(path: Column) -> Column:
    """``ARRAY<STRUCT<i BIGINT, k STRING>>`` of a dotted path."""
    # the mark is doubled inside keys, so a single one only ever starts a position
    doubled = F.replace(path, F.lit(_MARK), F.lit(_MARK * 2))
    marked = F.regexp_replace(doubled, _KEY_POSITION, f"$1$2.{_MARK}$3")

    def token(segment: Column) -> Column:
        is_position = F.startswith(segment, F.lit(_MARK)) & ~F.startswith(segment, F.lit(_MARK * 2))
        position = F.coalesce(F.substring(segment, 2, LONGEST).try_cast("bigint"), F.lit(_BEYOND))
        key = F.replace(segment, F.lit(_MARK * 2), F.lit(_MARK))
        return F.struct(
            F.when(is_position, F.least(position, F.lit(_BEYOND))).alias("i"), F.when(~is_position, key).alias("k")
        )

    return F.transform(F.split(marked, r"\."), token)


def leaf_text(leaf_type: Column, value: Column) -> Column:
    """JSON text of a typed leaf."""
    quoted = (leaf_type == "STRING") | ((leaf_type == "DOUBLE") & value.isin("Infinity", "-Infinity"))
    return F.when(quoted, json_string(value)).otherwise(F.coalesce(value, F.lit("null")))


def _tokenised(e: Column, order: Column) -> Column:
    return F.struct(
        path_tokens(e.getField("path")).alias("tok"),
        order.alias("order"),
        e.getField("path").alias("path"),
        e.getField("leaf_type").alias("leaf_type"),
        e.getField("value").alias("value"),
    )


def _is_position(token: Column) -> Column:
    return token.getField("i").isNotNull()


def _planned(entries: Column) -> Column:
    """Sorted entries, and for each the step from its predecessor."""
    return F.struct(entries.alias("entries"), F.transform(entries, lambda e, i: _step(entries, e, i)).alias("steps"))


def _agreed(plan: Column) -> Column:
    """The plan, made anew from what survives where paths disagree; NULL if they cannot be combined."""
    broken = F.exists(plan.getField("steps"), lambda s: s.getField("broken"))
    again = bind(F.sort_array(_survivors(plan.getField("entries"))), lambda kept: F.when(kept.isNotNull(), _planned(kept)))
    return F.when(broken, again).otherwise(plan)


def _before(entries: Column, i: Column) -> Column:
    return F.coalesce(F.get(entries, i - 1).getField("tok"), F.array().cast(_TOKENS))


def _step(entries: Column, e: Column, i: Column) -> Column:
    """Level at which an entry parts from the one before, the nulls to write, and whether the two disagree."""
    tok = e.getField("tok")

    def parted(prev: Column) -> Column:
        return bind(_parting(prev, tok), lambda level: of(prev, level))

    def of(prev: Column, level: Column) -> Column:
        here, there = F.get(tok, level), F.get(prev, level)
        # once the paths part, deeper positions start a new array
        opened = F.aggregate(
            F.slice(tok, level + 1, F.size(tok)), F.lit(0).cast("bigint"),
            lambda total, t: total + F.coalesce(t.getField("i"), F.lit(0).cast("bigint")),
        )
        start = F.when(_is_position(here), F.coalesce(there.getField("i") + 1, F.lit(0).cast("bigint"))).otherwise(F.lit(0).cast("bigint"))
        # same path, one path inside the other, or positions and keys side by side
        broken = (level == _SAME) | ((i > 0) & ((level >= F.size(prev)) | (_is_position(here) != _is_position(there))))
        return F.struct(level.alias("level"), (opened - start).alias("gap"), broken.alias("broken"))

    return bind(_before(entries, i), parted)


def _written(plan: Column) -> Column:
    """Document of a plan in which nothing disagrees."""

    def write(p: Column) -> Column:
        entries, steps = p.getField("entries"), p.getField("steps")
        pieces = F.transform(entries, lambda e, i: _piece(_before(entries, i), e, i, F.get(steps, i).getField("level")))
        last = F.coalesce(F.try_element_at(entries, F.lit(-1)).getField("tok"), F.array().cast(_TOKENS))
        return F.concat(F.lit("{"), F.array_join(pieces, ""), _closings(last, F.lit(0)), F.lit("}"))

    return bind(plan, write)


def _piece(prev: Column, e: Column, i: Column, level: Column) -> Column:
    """Text between the entry before and this one, and the entry's value."""
    tok = e.getField("tok")
    here, there = F.get(tok, level), F.get(prev, level)
    gap = here.getField("i") - F.coalesce(there.getField("i") + 1, F.lit(0).cast("bigint"))
    first = F.when(_is_position(here), _nulls(gap)).otherwise(F.concat(json_string(here.getField("k")), F.lit(":")))
    opened = F.when(F.size(tok) <= level + 1, F.lit("")).otherwise(
        F.array_join(F.transform(F.slice(tok, level + 2, F.size(tok)), _opening), "")
    )
    comma = F.when(i > 0, F.lit(",")).otherwise(F.lit(""))
    return F.concat(_closings(prev, level), comma, first, opened, leaf_text(e.getField("leaf_type"), e.getField("value")))


def _nulls(gap: Column) -> Column:
    return F.repeat(F.lit("null,"), gap.cast("int"))


def _parting(prev: Column, tok: Column) -> Column:
    """Level of ``tok`` at which it parts from ``prev``; ``_SAME`` when it does not."""
    return F.array_min(
        F.transform(tok, lambda t, j: F.when(t.eqNullSafe(F.get(prev, j)), F.lit(_SAME)).otherwise(j))
    )


def _opening(token: Column) -> Column:
    return F.when(_is_position(token), F.concat(F.lit("["), _nulls(token.getField("i")))).otherwise(
        F.concat(F.lit("{"), json_string(token.getField("k")), F.lit(":"))
    )


def _closings(tok: Column, level: Column) -> Column:
    """Text that leaves the containers of ``tok`` below ``level``, innermost first."""
    inner = F.reverse(F.slice(tok, level + 2, F.size(tok)))
    text = F.array_join(F.transform(inner, lambda t: F.when(_is_position(t), F.lit("]")).otherwise(F.lit("}"))), "")
    return F.when(F.size(tok) <= level + 1, F.lit("")).otherwise(text)


def _survivors(entries: Column) -> Column:
    """Entries left after later paths replaced what disagrees with them; NULL if impossible.

    ``rank`` is the place in raw path order, the order in which paths take effect.  A *visit*
    says what an entry wants a node to be: a leaf, an array or an object.  Where two
    successive visits of a node differ, the later one replaces all that came before.
    """
    by_path = F.sort_array(
        F.transform(
            entries,
            lambda e: F.struct(
                e.getField("path").alias("path"),
                e.getField("order").alias("order"),
                e.getField("tok").alias("tok"),
                e.getField("leaf_type").alias("leaf_type"),
                e.getField("value").alias("value"),
            ),
        )
    )

    def visits_of(e: Column, rank: Column) -> Column:
        tok = e.getField("tok")

        def visit(d: Column) -> Column:
            below = F.get(tok, d + 1)
            return F.struct(
                F.slice(tok, F.lit(1), d + 1).alias("node"),
                rank.alias("rank"),
                F.when(d + 1 == F.size(tok), F.lit("leaf"))
                .when(_is_position(below), F.lit("array"))
                .otherwise(F.lit("object"))
                .alias("kind"),
                (_is_position(F.get(tok, d)) & (e.getField("leaf_type") != "VOID")).alias("fixed"),
            )

        return F.transform(F.sequence(F.lit(0), F.size(tok) - 1), visit)

    def cut(ranked: Column) -> Column:
        visits = F.sort_array(F.flatten(F.transform(ranked, visits_of)))
        return bind(bind(visits, _fallen), lambda fallen: keep(ranked, fallen))

    def keep(ranked: Column, fallen: Column) -> Column:
        left = F.transform(
            _without(ranked, fallen.getField("ranks")),
            lambda e: F.struct(
                e.getField("tok").alias("tok"),
                e.getField("order").alias("order"),
                e.getField("path").alias("path"),
                e.getField("leaf_type").alias("leaf_type"),
                e.getField("value").alias("value"),
            ),
        )
        return F.when(~fallen.getField("impossible"), left)

    return bind(by_path, cut)


def _without(ranked: Column, ranks: Column) -> Column:
    """Entries whose position is not among ``ranks``: after one sort each fallen rank stands right before its entry."""
    marks = F.transform(ranks, lambda r: F.struct(r.alias("rank"), F.lit(0).alias("is_entry")))
    entries = F.transform(ranked, lambda e, rank: F.struct(rank.alias("rank"), F.lit(1).alias("is_entry")))

    def alive(merged: Column) -> Column:
        kept = F.filter(
            merged, lambda m, i: (m.getField("is_entry") == 1) & ~F.get(merged, i - 1).getField("rank").eqNullSafe(m.getField("rank"))
        )
        return F.transform(kept, lambda m: F.get(ranked, m.getField("rank")))

    return bind(F.sort_array(F.concat(marks, entries)), alive)


def _fallen(visits: Column) -> Column:
    """Ranks of the entries that a later visit of one of their nodes replaces, and whether that is ``impossible`` somewhere.

    The visits of a node stand side by side, and all up to its last replaced one fall.
    """

    def same_node(v: Column, other: Column) -> Column:
        return other.getField("node").eqNullSafe(v.getField("node"))

    def is_hit(v: Column, after: Column) -> Column:
        is_leaf = v.getField("kind") == "leaf"
        return same_node(v, after) & (is_leaf | (after.getField("kind") != v.getField("kind")))

    def stuck(v: Column, after: Column) -> Column:
        # a value at an array position does not give way to a container
        return v.getField("fixed") & (v.getField("kind") == "leaf") & (after.getField("kind") != "leaf")

    def where(test) -> Column:
        return F.filter(F.transform(visits, lambda v, i: F.when(test(v, i), i)), lambda i: i.isNotNull())

    hits = where(lambda v, i: is_hit(v, F.get(visits, i + 1)))
    starts = where(lambda v, i: ~same_node(v, F.get(visits, i - 1)))

    def of(hits: Column) -> Column:
        last = F.filter(hits, lambda h, k: ~same_node(F.get(visits, h), F.get(visits, F.get(hits, k + 1))))
        impossible = F.exists(hits, lambda h: stuck(F.get(visits, h), F.get(visits, h + 1)))
        return F.struct(bind(_spans(starts, last), ranks).alias("ranks"), impossible.alias("impossible"))

    def ranks(spans: Column) -> Column:
        def of_span(span: Column) -> Column:
            return F.transform(F.sequence(span.getField("start"), span.getField("end")), lambda i: F.get(visits, i).getField("rank"))

        return F.array_distinct(F.flatten(F.transform(spans, of_span)))

    return bind(hits, of)


def _spans(starts: Column, ends: Column) -> Column:
    """``start, end`` for each end: after one sort its start stands right before it."""
    marks = F.concat(
        F.transform(starts, lambda i: F.struct(i.alias("i"), F.lit(0).alias("is_end"))),
        F.transform(ends, lambda i: F.struct(i.alias("i"), F.lit(1).alias("is_end"))),
    )

    def paired(marks: Column) -> Column:
        pairs = F.transform(marks, lambda m, k: F.struct(F.get(marks, k - 1).getField("i").alias("start"), m.getField("i").alias("end"), m.getField("is_end").alias("is_end")))
        return F.filter(pairs, lambda p: p.getField("is_end") == 1)

    return bind(F.sort_array(marks), paired)
