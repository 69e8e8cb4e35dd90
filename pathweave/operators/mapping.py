"""Declared field mappings and one-row-per-entry projections."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import bind, leaves_at, named, once, variant_at, with_error
from ..functions.paths import fill_wildcards, pattern_regex, wildcards

_FLAT = "array<struct<path:string,leaf_type:string,value:string>>"
_REF = re.compile(r"\$\{([^}]*)\}")


def map_fields(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Replace ``flat`` by the mapped leaves.

    ``target: source`` and ``target: "${source}"`` copy a leaf with its type,
    ``target: "${a} text ${b}"`` joins texts.  ``*`` in sources matches any one segment and its
    value is carried to the ``*`` of the target.  A target whose sources are absent is left out;
    in a joined text a null source counts as absent.
    """
    exact = sorted({r for source in mapping.values() for r in _REF.findall(source) or [source] if not wildcards(r)})

    def mapped(leaves: Column) -> Column:
        rules = [_rule(target, source, leaves) for target, source in mapping.items()]
        return F.concat(*rules) if rules else F.array().cast(_FLAT)

    found = bind(leaves_at(F.col("flat"), exact), mapped) if exact else mapped(F.lit(None))
    return once(df, flat=F.when(F.col("error").isNull(), found))


def _rule(target: str, source: str, leaves: Column) -> Column:
    refs = _REF.findall(source)
    if not refs:
        return _copy(target, source, leaves)
    if source == "${" + refs[0] + "}":
        return _copy(target, refs[0], leaves)
    return _join(target, source, refs, leaves)


def _same_wildcards(target: str, source: str) -> None:
    if wildcards(target) != wildcards(source):
        raise ValueError(f"'{target}' and '{source}' differ in the number of wildcards")


def _matching(source: str) -> Column:
    return F.filter("flat", lambda e: e.getField("path").rlike(pattern_regex(source)))


def _copy(target: str, source: str, leaves: Column) -> Column:
    """``leaves`` has the leaves with the exact names of all rules."""
    _same_wildcards(target, source)
    if not wildcards(source):
        leaf = F.try_element_at(leaves, F.lit(source))
        entry = F.struct(F.lit(target).alias("path"), leaf.getField("leaf_type").alias("leaf_type"), leaf.getField("value").alias("value"))
        return F.when(leaf.isNotNull(), F.array(entry)).otherwise(F.array().cast(_FLAT))
    regex, replacement = pattern_regex(source), fill_wildcards(target)

    def rename(e: Column) -> Column:
        path = F.regexp_replace(e.getField("path"), regex, replacement)
        return F.struct(path.alias("path"), e.getField("leaf_type").alias("leaf_type"), e.getField("value").alias("value"))

    return F.transform(_matching(source), rename)


def _join(target: str, template: str, refs: Sequence[str], leaves: Column) -> Column:
    pieces = _REF.split(template)  # text, ref, text, ref, …, text
    wild = list(dict.fromkeys(r for r in refs if wildcards(r)))
    for ref in wild:
        _same_wildcards(target, ref)
    if not wild and wildcards(target):
        raise ValueError(f"'{target}' has wildcards, its sources have none")

    def text(values: Mapping[str, Column]) -> Column:
        parts = [values[p] if i % 2 else F.lit(p) for i, p in enumerate(pieces)]
        return F.concat(*parts)  # NULL when any source is NULL

    single = {r: F.try_element_at(leaves, F.lit(r)).getField("value") for r in refs if not wildcards(r)}
    if not wild:
        entry = F.struct(F.lit(target).alias("path"), F.lit("STRING").alias("leaf_type"), text(single).alias("value"))
        return F.filter(F.array(entry), lambda e: e.getField("value").isNotNull())

    # Sources that share their wildcard values become neighbours after one sort on the target
    # path; a group is whole when it has one leaf per source.
    def candidates(k: int, ref: str) -> Column:
        regex, replacement = pattern_regex(ref), fill_wildcards(target)
        return F.transform(
            _matching(ref),
            lambda e: F.struct(
                F.regexp_replace(e.getField("path"), regex, replacement).alias("path"),
                F.lit(k).alias("k"),
                e.getField("value").alias("value"),
            ),
        )

    gathered = F.sort_array(F.concat(*[candidates(k, r) for k, r in enumerate(wild)]))

    def joined(head: Column) -> Column:
        sorted_, scalars = head.getField("sorted"), head.getField("scalars")

        def entry(e: Column, i: Column) -> Column:
            values = {r: scalars.getField(f"s{n}") for n, r in enumerate(single)}
            whole = e.getField("k") == 0
            for k, ref in enumerate(wild):
                other = F.get(sorted_, i + k)
                whole = whole & (other.getField("k") == k) & (other.getField("path") == e.getField("path"))
                values[ref] = other.getField("value")
            return F.struct(
                e.getField("path").alias("path"),
                F.lit("STRING").alias("leaf_type"),
                F.when(whole, text(values)).alias("value"),
            )

        return F.filter(F.transform(sorted_, entry), lambda e: e.getField("value").isNotNull())

    scalars = [value.alias(f"s{n}") for n, value in enumerate(single.values())] or [F.lit(None).alias("none")]
    head = F.struct(gathered.alias("sorted"), F.struct(*scalars).alias("scalars"))
    return F.transform(F.array(head), joined).getItem(0)


def project_entries(
    df: DataFrame,
    array: str,
    header: Mapping[str, tuple[str, str]],
    entry: Mapping[str, tuple[str, str]],
    index_name: str = "entry_index",
) -> DataFrame:
    """One flat record per array entry, header fields repeated; rejected rows have ``error`` and ``value``.

    ``header`` and ``entry`` map a column name to ``(dotted path, Spark type)``; numeric
    segments are array positions.  Absent values and JSON nulls are NULL.  A message that failed
    before, one whose field is missing or no array (``NOT_ARRAY``) and one whose header does not fit
    its type (``TYPE``) stay as one row without an entry; so does each entry that does not fit
    its types, beside its index.  An empty array gives no row.
    """
    v, ok = F.col("v"), F.col("error").isNull()
    items = variant_at(v, [array], "array<variant>")
    found = {name: variant_at(v, _keys(path), kind) for name, (path, kind) in header.items()}
    df = once(df, drop=("v",), _items=F.when(ok, items), _misfit=F.when(ok, _misfits(v, header)), **found)
    df = with_error(df, "NOT_ARRAY", F.when(F.col("_items").isNull(), F.lit(f"Field '{array}' is missing or not a JSON array")))
    df = with_error(df, "TYPE", F.col("_misfit"))
    none = F.lit(None)
    failed = F.array(F.struct(none.cast("int").alias("i"), none.cast("variant").alias("item")))
    listed = F.transform("_items", lambda x, i: F.struct(i.alias("i"), x.alias("item")))
    inner = ("_items", "_misfit", "_entry", "value", "error")
    kept = [named(c) for c in df.columns if c not in inner]
    rows = df.select(*kept, "value", "error", F.explode(F.when(F.col("error").isNull(), listed).otherwise(failed)).alias("_entry"))
    item = F.col("_entry.item")
    columns = {name: variant_at(item, _keys(path), kind) for name, (path, kind) in entry.items()}
    rows = once(rows, _misfit=_misfits(item, entry), **{index_name: F.col("_entry.i")}, **columns)
    rows = with_error(rows, "TYPE", F.col("_misfit"))
    return rows.withColumn("value", F.when(F.col("error").isNotNull(), F.col("value"))).drop("_entry", "_misfit")


def _misfits(v: Column, fields: Mapping[str, tuple[str, str]]) -> Column:
    """Text on the first present value that does not fit its type, or NULL."""
    found = []
    for path, kind in fields.values():
        raw = variant_at(v, _keys(path))
        bad = raw.isNotNull() & ~F.is_variant_null(raw) & variant_at(v, _keys(path), kind).isNull()
        found.append(F.when(bad, F.lit(f"Field '{path}' does not fit type {kind}")))
    return F.coalesce(*found, F.lit(None).cast("string"))


def _keys(path: str) -> list[str | int]:
    return [int(k) if k.isdecimal() else k for k in path.split(".")]
