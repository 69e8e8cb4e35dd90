"""One query per operator of the engine; each runs over its whole table."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pathweave import (
    EXCLUDE, INCLUDE, REPLACE_EMPTY_STRING, FlowConfig, PageNames, accepted, chained, dead_letters, decode_csv,
    encode_csv, encode_dlq, explode_leaves, flatten_json, flatten_pages, map_fields, outcomes, paginate,
    parse_messages, project_entries, run_flow, split_to_json, to_envelope, transform_fields, unflatten,
    validate_items, validate_messages, validate_required, validate_split_flatten,
)
from pathweave.operators.flatten import FLAT_TYPE
from pathweave.plans import rules

from . import messages as m

S, D = SparkSession, DataFrame
PAGE = 4
NAMES = PageNames("lines")
FLOW = FlowConfig(
    required=["document", "lines", "document.id"], array="lines", item_required=["text"], names=NAMES,
    page_size=PAGE, patterns=["lines.*.lang"],
)
EVENT_SCHEMA = {
    "type": "object",
    "required": ["id", "type"],
    "properties": {"user": {"type": "object", "required": ["id"]}, "props": {"type": "object", "required": ["k"]}},
    "allOf": [{"required": ["user"]}],
    "anyOf": [{"required": ["value", "type"]}, {"required": ["value"]}],
}


def code() -> Column:
    return F.col("error.code").alias("error_code")


def message() -> Column:
    return F.col("error.message").alias("error_message")


def envelope_headers(spark: S, d: str) -> D:
    def header(name: str, value: Column) -> Column:
        return F.struct(F.lit(name).alias("key"), value.cast("string").cast("binary").alias("value"))

    df = m.table(spark, d, "events").select(
        "event_id",
        F.col("props").cast("binary").alias("value"),
        F.array(header("type", F.lit("?")), header("user", F.col("user_id")), header("type", F.col("event_type"))).alias("headers"),
    )
    rows = to_envelope(df).select("event_id", F.explode("headers").alias("name", "content"))
    return rows.select("event_id", "name", F.col("content").cast("string").alias("content"))


def parse_guard(spark: S, d: str) -> D:
    return parse_messages(m.faulty_events(spark, d)).select("event_id", code())


def parse_lenient(spark: S, d: str) -> D:
    end = F.when(F.col("event_type") == "error", "'").otherwise("'}")
    body = F.concat(F.lit("{/* note */'id': "), F.col("event_id"), F.lit(", 'kind': '"), F.col("event_type"), end)
    df = m.table(spark, d, "events").select("event_id", body.cast("binary").alias("value"))
    parsed = parse_messages(to_envelope(df), lenient=True)
    return parsed.select("event_id", code(), F.try_variant_get("v", "$.kind", "string").alias("kind"))


def required_paths(spark: S, d: str) -> D:
    df = parse_messages(m.faulty_events(spark, d))
    return validate_required(df, ["id", "user", "user.id", "props.k", "trace.id", "trace"]).select("event_id", code(), message())


def required_by_schema(spark: S, d: str) -> D:
    cfg = FlowConfig.from_schemas(EVENT_SCHEMA)
    return validate_required(parse_messages(m.faulty_events(spark, d)), cfg.required).select("event_id", code(), message())


def items_by_page(spark: S, d: str) -> D:
    pages = paginate(parse_messages(m.documents(spark, d)), "lines", PAGE, keep_value=True)
    return validate_items(pages, "lines", PAGE, ["text"]).select("doc_id", "page_index", "total_pages", "item_count", code(), message())


def whole_messages(spark: S, d: str) -> D:
    df = validate_messages(parse_messages(m.documents(spark, d)), "lines", ["document", "author"], ["n", "text"])
    return df.select("doc_id", code(), message())


def page_slices(spark: S, d: str) -> D:
    pages = paginate(parse_messages(m.documents(spark, d)), "lines", PAGE)
    first = F.try_variant_get(F.get("items", F.lit(0)), "$.text", "string")
    return pages.select("doc_id", "page_index", "total_pages", "item_count", F.size("items").alias("n_items"), first.alias("first_text"))


def array_policy(spark: S, d: str) -> D:
    def under(policy: str) -> D:
        pages = paginate(parse_messages(m.shaped_events(spark, d)), "props", PAGE, on_non_array=policy)
        counts = (F.coalesce(c, F.lit(-1)).alias(c) for c in ("page_index", "item_count"))
        return pages.select("event_id", F.lit(policy).alias("policy"), *counts, code())

    return under("dlq").unionAll(under("drop"))


def message_account(spark: S, d: str) -> D:
    """Each message is a first page, a letter or an empty array."""
    pages = split_to_json(parse_messages(m.shaped_events(spark, d)), "props", 1, PageNames("props"))
    return pages.agg(
        F.count(F.when(F.col("page_index") == 0, 1)).alias("first_pages"), F.count("page_index").alias("pages"), F.count("error").alias("letters")
    )


def deep_leaves(spark: S, d: str) -> D:
    return explode_leaves(flatten_json(parse_messages(m.deep_events(spark, d))), ["event_id"])


def typed_leaves(spark: S, d: str) -> D:
    return explode_leaves(flatten_json(parse_messages(m.typed_events(spark, d))), ["event_id"])


def page_letters(spark: S, d: str) -> D:
    """Letters of pages that fail their items' rules or a later check; each holds the whole message."""
    done = outcomes(m.odd_documents(spark, d), FLOW).where("error IS NOT NULL")
    return done.select("doc_id", code(), (F.col("value") == F.col("body").cast("binary")).alias("whole"))


def later_fields(spark: S, d: str) -> D:
    """Where two fields have one path, the later one in the message."""
    return explode_leaves(flatten_json(parse_messages(m.shared_events(spark, d))), ["event_id"])


def odd_page_leaves(spark: S, d: str) -> D:
    return explode_leaves(validate_split_flatten(m.odd_documents(spark, d), FLOW), ["doc_id", "page_index"])


def entry_rejects(spark: S, d: str) -> D:
    rows = project_entries(parse_messages(m.shaped_events(spark, d)), "props", header={"no": ("id", "bigint")}, entry={"k": ("k", "bigint")})
    entry = (F.coalesce(c, F.lit(-1)).alias(c) for c in ("entry_index", "k"))
    return rows.select("event_id", "no", *entry, code())


def page_json(spark: S, d: str) -> D:
    pages = split_to_json(parse_messages(m.documents(spark, d)), "lines", PAGE, PageNames("rows", "page", "pages", "size"))
    return pages.select("doc_id", F.col("value").cast("string").alias("page_json"))


def event_leaves(spark: S, d: str) -> D:
    return explode_leaves(flatten_json(parse_messages(m.events(spark, d))), ["event_id"])


def line_leaves(spark: S, d: str) -> D:
    return explode_leaves(flatten_json(parse_messages(m.lines(spark, d))), ["l_orderkey", "l_linenumber", "l_partkey"])


def page_leaves(spark: S, d: str) -> D:
    pages = paginate(parse_messages(m.documents(spark, d)), "lines", PAGE)
    return explode_leaves(flatten_pages(pages, PageNames("rows")), ["doc_id", "page_index"])


def _turn_leaves(spark: S, d: str, nulls: str) -> D:
    return explode_leaves(flatten_json(parse_messages(m.turns(spark, d)), nulls), ["conv_id", "turn"])


def nulls_included(spark: S, d: str) -> D:
    return _turn_leaves(spark, d, INCLUDE)


def nulls_excluded(spark: S, d: str) -> D:
    return _turn_leaves(spark, d, EXCLUDE)


def nulls_as_text(spark: S, d: str) -> D:
    return _turn_leaves(spark, d, REPLACE_EMPTY_STRING)


def _document_pages(spark: S, d: str) -> D:
    return flatten_pages(paginate(parse_messages(m.documents(spark, d)), "lines", PAGE), NAMES)


def wildcard_upper(spark: S, d: str) -> D:
    changed = transform_fields(_document_pages(spark, d), ["lines.*.text", "lines.*.n"])
    return explode_leaves(changed, ["doc_id", "page_index"])


def exact_upper(spark: S, d: str) -> D:
    changed = transform_fields(flatten_json(parse_messages(m.events(spark, d))), ["type", "user", "user.ID"])
    return explode_leaves(changed, ["event_id"])


def udf_reverse(spark: S, d: str) -> D:
    def backwards(values: pa.Array) -> pa.Array:
        return pc.utf8_reverse(pc.binary_join_element_wise(values, "!", ""))

    flat = flatten_json(parse_messages(m.lines(spark, d)))
    changed = transform_fields(flat, ["line.flags.*"], batch=backwards)
    return explode_leaves(changed, ["l_orderkey", "l_linenumber", "l_partkey"])


def leaf_counters(spark: S, d: str) -> D:
    df = transform_fields(_document_pages(spark, d), ["lines.*.text"], count="changed")
    return df.agg(F.sum("changed").alias("fields_processed"), F.count(F.when(F.col("changed") == 0, 1)).alias("no_match"))


def mapped_fields(spark: S, d: str) -> D:
    mapping = {
        "index": "index",
        "rows.*.body": "lines.*.text",
        "rows.*.label": "${lines.*.lang}: ${lines.*.text} of ${total}",
        "gone.*": "lines.*",
    }
    return explode_leaves(map_fields(_document_pages(spark, d), mapping), ["doc_id", "page_index"])


def entry_rows(spark: S, d: str) -> D:
    rows = project_entries(
        parse_messages(m.documents(spark, d)), "lines",
        header={"doc_source": ("document.source", "string")},
        entry={"line_no": ("n", "bigint"), "line_text": ("text", "string")},
    )
    return rows.select("doc_id", "doc_source", "entry_index", "line_no", "line_text")


ENTRY_SCHEMA = {
    "type": "object",
    "properties": {"n": {"type": "integer"}, "length": {"type": "number"}, "text": {"type": ["string", "null"]}, "absent": {"type": ["null", "boolean"]}},
}


def entry_types(spark: S, d: str) -> D:
    """Entries as a declared flat schema has them."""
    rows = project_entries(
        parse_messages(m.documents(spark, d)), "lines", header={"doc_lang": ("document.lang", "string")},
        entry=rules.entry_fields(ENTRY_SCHEMA, {"length": "chars"}),
    )
    return rows.select("doc_id", "doc_lang", "entry_index", "n", "length", "text", "absent")


MAPPING = {"field-mapping": {"no": "index", "body.*.words": "lines.*.text", "body.*.head": "${lines.*.lang}#${index}", "of": "${total}"}}


def declared_mapping(spark: S, d: str) -> D:
    return explode_leaves(map_fields(_document_pages(spark, d), rules.field_mapping(MAPPING)), ["doc_id", "page_index"])


def rebuilt_events(spark: S, d: str) -> D:
    return unflatten(flatten_json(parse_messages(m.events(spark, d)))).select("event_id", "json", code())


def rebuilt_lines(spark: S, d: str) -> D:
    df = unflatten(flatten_json(parse_messages(m.lines(spark, d))))
    return df.select("l_orderkey", "l_linenumber", "l_partkey", "json", code())


def path_conflicts(spark: S, d: str) -> D:
    def leaf(path: str, kind: str, value: Column) -> Column:
        return F.struct(F.lit(path).alias("path"), F.lit(kind).alias("leaf_type"), value.cast("string").alias("value"))

    stuck = F.when(F.col("c_mktsegment") == "BUILDING", F.lit("list.0.x")).otherwise(F.lit("list.1.x"))
    flat = F.array(
        leaf("tags.2", "DOUBLE", F.col("c_acctbal")),
        leaf("name", "STRING", F.col("c_name")),
        leaf("name.nation", "BIGINT", F.col("c_nationkey")),
        leaf("seg.k", "STRING", F.col("c_mktsegment")),
        leaf("seg.0", "STRING", F.col("c_name")),
        leaf("list.0", "BIGINT", F.col("c_custkey")),
        F.struct(stuck.alias("path"), F.lit("BIGINT").alias("leaf_type"), F.lit("7").alias("value")),
    )
    df = m.table(spark, d, "customer").select(
        "c_custkey", flat.cast(FLAT_TYPE).alias("flat"), F.lit(None).cast("struct<code:string,message:string>").alias("error")
    )
    return unflatten(df).select("c_custkey", "json", code())


def round_trip(spark: S, d: str) -> D:
    first = flatten_json(parse_messages(m.lines(spark, d)))
    again = unflatten(first).withColumnRenamed("flat", "before").withColumn("value", F.col("json").cast("binary"))
    after = flatten_json(parse_messages(again.drop("error", "json")))
    differs = ~F.col("flat").eqNullSafe(F.col("before"))
    return after.agg(F.count(F.lit(1)).alias("messages"), F.count(F.when(differs, 1)).alias("different"))


CSV = ["id", "lang", "text", "absent"]


def _csv_lines(spark: S, d: str) -> D:
    def leaf(name: str, column: str) -> Column:
        return F.struct(F.lit(name).alias("path"), F.lit("STRING").alias("leaf_type"), F.col(column).cast("string").alias("value"))

    df = m.table(spark, d, "documents")
    flat = F.array(leaf("text", "text"), leaf("id", "doc_id"), leaf("lang", "lang"), leaf("extra", "source"))
    return encode_csv(df.select("doc_id", flat.alias("flat")), CSV)


def csv_encoded(spark: S, d: str) -> D:
    return _csv_lines(spark, d).select("doc_id", "csv")


def csv_decoded(spark: S, d: str) -> D:
    df = _csv_lines(spark, d).select("doc_id", F.col("csv").cast("binary").alias("value"))
    return explode_leaves(decode_csv(to_envelope(df), CSV), ["doc_id"])


def csv_rejected(spark: S, d: str) -> D:
    line = F.concat_ws(",", "c_name", F.when(F.col("c_nationkey") < 10, F.col("c_mktsegment")), "c_acctbal")
    df = m.table(spark, d, "customer").select("c_custkey", line.cast("binary").alias("value"))
    return decode_csv(to_envelope(df), ["name", "segment", "balance"]).select("c_custkey", code(), message())


def dead_letter_rows(spark: S, d: str) -> D:
    df = m.faulty_events(spark, d).withColumn("offset", F.col("event_id"))
    rows = dead_letters(validate_required(parse_messages(df), ["user"]))
    return rows.select(F.col("original").cast("string").alias("original"), "error_code", "error_message", "topic", "partition", "offset")


def dead_letter_json(spark: S, d: str) -> D:
    df = m.faulty_events(spark, d).withColumn("offset", F.col("event_id"))
    letters = dead_letters(validate_required(parse_messages(df), ["user"]))
    text = F.regexp_replace(F.col("value").cast("string"), r'"errorTimestampMs":\d+', '"errorTimestampMs":0')
    return encode_dlq(letters).select(text.alias("letter"))


def chained_leaves(spark: S, d: str) -> D:
    cfg = FlowConfig(required=["document"], array="lines", item_required=["text"], names=NAMES, page_size=PAGE)
    return explode_leaves(chained(m.documents(spark, d), cfg), ["doc_id", "page_index"])


def one_pass_leaves(spark: S, d: str) -> D:
    return explode_leaves(validate_split_flatten(m.documents(spark, d), FLOW), ["doc_id", "page_index"])


def flow_results(spark: S, d: str) -> D:
    return run_flow(m.documents(spark, d), FLOW)[0].select("doc_id", "page_index", "json")


def flow_rejects(spark: S, d: str) -> D:
    return outcomes(m.documents(spark, d), FLOW).where("error IS NOT NULL").select(
        "doc_id", F.length(F.col("value").cast("string")).alias("n_original"), code(), message()
    )


def flow_flat_messages(spark: S, d: str) -> D:
    cfg = FlowConfig.from_schemas(EVENT_SCHEMA, patterns=["type"])
    return accepted(outcomes(m.faulty_events(spark, d), cfg)).select("event_id", "json")


QUERIES = {
    f.__name__: f
    for f in (
        envelope_headers, parse_guard, parse_lenient, required_paths, required_by_schema, items_by_page,
        whole_messages, page_slices, array_policy, message_account, deep_leaves, typed_leaves, page_letters, later_fields, odd_page_leaves,
        entry_rejects, page_json, event_leaves, line_leaves, page_leaves,
        nulls_included, nulls_excluded, nulls_as_text, wildcard_upper, exact_upper, udf_reverse, leaf_counters,
        mapped_fields, declared_mapping, entry_rows, entry_types, rebuilt_events, rebuilt_lines, path_conflicts, round_trip, csv_encoded,
        csv_decoded, csv_rejected, dead_letter_rows, dead_letter_json, chained_leaves, one_pass_leaves,
        flow_results, flow_rejects, flow_flat_messages,
    )
}
