"""Whole scenarios on small documents, and the parts that only a job with sources and sinks uses."""

import json

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from pathweave import (
    EXCLUDE, FlowConfig, PageNames, chained, decode_csv, encode_csv, explode_leaves, flatten_json, flatten_pages, observe_fields,
    outcomes, paginate, parse_messages, project_entries, read_messages, run_flow, split_to_json, transform_fields, validate_items,
)
from pathweave.plans import rules
from pathweave.sinks.writers import write_files
from pathweave.sources.messages import KAFKA_DEFAULTS
from tests.test_operators import codes, flats, messages
from workload import messages as m
from workload.queries import QUERIES

SF = "/root/testdata/sf0.001"
LIBRARY = {
    "branch": {"name": "north", "id": "n-1"},
    "books": [
        {"title": f"book {i}", "tags": ["x", "y"][: i % 3], "loaned": i % 2 == 0, "copies": i, "shelf": {"row": i, "note": None} if i != 3 else {}}
        for i in range(5)
    ],
}
INPUT = {
    "required": ["branch", "books"],
    "properties": {
        "branch": {"type": "object", "required": ["name"]},
        "books": {"type": "array", "items": {"required": ["title", "copies"], "properties": {"shelf": {"type": "object"}}}},
    },
}
OUTPUT = {"properties": {
    "entries": {"type": "array"}, "part": {"type": "integer", "minimum": 0, "description": "0-based part"},
    "parts": {"type": "integer", "minimum": 1}, "size": {"type": "integer"},
}}


def test_pages_of_two_and_all_their_leaves(spark):
    cfg = FlowConfig.from_schemas(INPUT, OUTPUT, page_size=2, patterns=["entries.*.title"])
    assert cfg.names == PageNames("entries", "part", "parts", "size") and cfg.item_required == ["title", "copies"]
    done = {r.page_index: r for r in outcomes(messages(spark, [LIBRARY]), cfg).collect()}
    assert [done[p].item_count for p in range(3)] == [2, 2, 1] and all(r.value is None and r.error is None for r in done.values())
    for p, row in done.items():
        books = [dict(b, title=b["title"].upper()) for b in LIBRARY["books"][2 * p:2 * p + 2]]
        for b in books:
            if not b["tags"]:
                del b["tags"]
            if not b["shelf"]:
                del b["shelf"]
        assert json.loads(row.json) == {"part": p, "parts": 3, "size": len(books), "entries": books}
    pages = flatten_pages(paginate(parse_messages(messages(spark, [LIBRARY])), "books", 5), PageNames("books"), EXCLUDE)
    leaves = {r.path: (r.leaf_type, r.value) for r in explode_leaves(pages).collect()}
    assert len(leaves) == 3 + 5 * 3 + (0 + 1 + 2 + 0 + 1) + 4
    assert leaves["books.4.loaned"] == ("BOOLEAN", "true") and leaves["books.2.tags.1"] == ("STRING", "y") and "books.0.shelf.note" not in leaves


def test_nested_composition(spark):
    schema = {
        "allOf": [{"required": ["a"]}, {"anyOf": [{"required": ["b", "c"]}, {"allOf": [{"required": ["c"]}, {"required": ["d"]}]}]}],
        "oneOf": [{"properties": {"e": {"type": "object", "required": ["f", "g"]}}}, {"properties": {"e": {"type": "object", "required": ["g"]}}}],
    }
    assert rules.required_paths(schema) == ["a", "c", "e.g"]
    docs = [{"a": 1, "c": 1}, {"a": 1, "c": 1, "e": {}}, {"a": 1, "c": None, "e": {"g": 0}}, {"c": 1, "e": {"f": 1}}]
    got = {r.id: r.error and r.error.message for r in outcomes(messages(spark, docs), FlowConfig.from_schemas(schema)).collect()}
    head = "Input schema validation failed: "
    assert got == {0: None, 2: None, 1: head + "[missing required field 'e.g']", 3: head + "[missing required field 'a', missing required field 'e.g']"}


def test_references_that_lead_back_to_themselves():
    page = {"properties": OUTPUT["properties"], "allOf": [{"$ref": "#"}, {"$ref": "http://elsewhere"}, None]}
    assert rules.page_names(page) == PageNames("entries", "part", "parts", "size")


@pytest.mark.parametrize(("pattern", "hit"), [
    ("a", ["a"]), ("A", []), ("*", ["a", "d.e"]), ("b.*", ["b.0", "b.1"]), ("b.*.*", []), ("c.*.x", ["c.0.x"]), ("c.0.*", ["c.0.x", "c.0.y"]),
    ("*.*.x", ["c.0.x"]), ("*.0.*", ["c.0.x", "c.0.y"]), ("c.*", []), ("", []), ("a.", []), ("d.e", []),
])
def test_patterns(spark, pattern, hit):
    doc = {"a": "v", "b": ["v", "v"], "c": [{"x": "v", "y": "v"}], "n": 1}
    flat = flats(transform_fields(flatten_json(parse_messages(messages(spark, [doc]))), [pattern]))[0]
    assert sorted(p for p, (_, v) in flat.items() if v == "V") == [p for p in hit if p in flat]


def test_csv_there_and_back(spark):
    columns = ["id", "note", "place"]
    lines = ['1,"a, ""b""",x', '2,,"two\nlines"', '3," kept ",""""', ",,"]
    df = encode_csv(decode_csv(messages(spark, lines), columns), columns)
    assert [r.csv for r in df.orderBy("id").collect()] == ['1,"a, ""b""",x', '2,,"two\nlines"', '3, kept ,""""', ",,"]


def test_no_message_is_lost(spark):
    bom = "﻿" + json.dumps({"a": [1, 2, 3]})
    pages = split_to_json(parse_messages(messages(spark, [bom])), "a", 2, PageNames("a"))
    assert sorted(json.loads(bytes(r.value))["a"] for r in pages.collect()) == [[1, 2], [3]]
    cfg = FlowConfig(array="a", names=PageNames("a"), page_size=2)
    assert sorted(e.value for r in chained(messages(spark, [bom]), cfg).collect() for e in r.flat if e.path.startswith("a.")) == ["1", "2", "3"]
    docs = [{"a": [{"x.y": 1, "x": {"y": 2}}, {"k": 1}, {"k": 1}]}, {"a": [{"p": {"0": 1, "0.z": 2}}]}, {"a": [{}, {"k": 0}]}, '{"a":']
    rows = outcomes(messages(spark, docs), cfg).collect()
    assert sorted((r.id, r.page_index if r.page_index is not None else -1, r.error and r.error.code) for r in rows) == [
        (0, 0, None), (0, 1, None), (1, 0, "CONFLICT"), (2, 0, None), (3, -1, "PARSE")]
    for r in rows:
        text = docs[r.id] if isinstance(docs[r.id], str) else json.dumps(docs[r.id])
        assert (r.value and bytes(r.value).decode()) == (text if r.error else None)
    kept = paginate(parse_messages(messages(spark, docs[2:3])), "a", 1, keep_value=True)
    checked = validate_items(kept, "a", 1, ["k"]).orderBy("page_index").collect()
    assert [(r.error and r.error.code, r.value is not None) for r in checked] == [("ITEM_REQUIRED", True), (None, False)]
    results, letters = run_flow(messages(spark, docs), cfg)
    assert results.count() == 3 and sorted(r.error_code for r in letters.collect()) == ["CONFLICT", "PARSE"]


def test_entries_and_their_rejects(spark):
    docs = [{"h": 1, "a": [{"v": 1}, {"v": "x"}, {}, {"v": None}]}, {"h": "x", "a": [{"v": 1}]}, {"a": {}}, {}, {"a": []}, "{", {"a": [{"v": 2}]}]
    rows = project_entries(parse_messages(messages(spark, docs)), "a", {"h": ("h", "int")}, {"v": ("v", "int")}).collect()
    got = sorted((r.id, -1 if r.entry_index is None else r.entry_index, r.v, r.error and r.error.code) for r in rows)
    assert got == [(0, 0, 1, None), (0, 1, None, "TYPE"), (0, 2, None, None), (0, 3, None, None), (1, -1, None, "TYPE"), (2, -1, None, "NOT_ARRAY"),
                   (3, -1, None, "NOT_ARRAY"), (5, -1, None, "PARSE"), (6, 0, 2, None)]
    assert all((r.value is not None) == (r.error is not None) for r in rows)


def test_array_policies_on_every_kind(spark):
    docs = [{"a": None}, {"a": 1}, {"a": {}}, {"a": {"x": 1}}, {"a": []}, {"a": "t"}, {}]
    got = {p: codes(paginate(parse_messages(messages(spark, docs)), "a", 2, on_non_array=p)) for p in ("dlq", "drop")}
    assert got == {"dlq": {i: "NOT_ARRAY" for i in (0, 1, 2, 3, 5, 6)}, "drop": {3: "NOT_ARRAY"}}


def test_sources_and_file_sinks(spark, tmp_path):
    texts = ['{"a":1}', "{", '{"a":2}']
    (tmp_path / "text").mkdir()
    (tmp_path / "text" / "one.json").write_text("\n".join(texts))
    (tmp_path / "whole").mkdir()
    for i, t in enumerate(texts):
        (tmp_path / "whole" / f"{i}.json").write_text(t)
    messages(spark, texts).write.parquet(f"{tmp_path}/parquet")
    for name, fmt, more in (("parquet", "parquet", {}), ("text", "text", {}), ("whole", "text", {"wholetext": "true"})):
        options = {"path": f"{tmp_path}/{name}"} | more
        batch = read_messages(spark, options, format=fmt, stream=False)
        schema = "id int, key binary, value binary, headers map<string,binary>, topic string, partition int, offset bigint, timestamp timestamp"
        stream = read_messages(spark, options, format=fmt, schema=schema if fmt == "parquet" else "value string")
        assert stream.isStreaming and stream.schema.fieldNames() == batch.schema.fieldNames()
        assert sorted(bytes(r.value).decode() for r in batch.collect()) == sorted(texts)
        done = outcomes(batch, FlowConfig())
        write_files(done, f"{tmp_path}/out-{name}")
        back = spark.read.parquet(f"{tmp_path}/out-{name}")
        assert sorted((r.outcome, r.json) for r in back.select("outcome", "json").collect()) == [("dlq", None), ("ok", '{"a":1}'), ("ok", '{"a":2}')]


def test_counters_of_batch_and_stream(spark, tmp_path):
    messages(spark, [{"a": "x", "b": "y"}, {"a": 1}, "{", {"a": "z"}]).select("id", "value").write.parquet(f"{tmp_path}/in")

    def counted(df, to):
        return observe_fields(transform_fields(flatten_json(parse_messages(df)), ["*"], count="changed"), "changed", to)

    seen = Observation("fields")
    counted(read_messages(spark, {"path": f"{tmp_path}/in"}, format="parquet", stream=False), seen).write.format("noop").mode("overwrite").save()
    assert seen.get == {"fields_processed": 3, "no_match": 1}
    stream = read_messages(spark, {"path": f"{tmp_path}/in"}, format="parquet", schema="id int, value binary")
    query = counted(stream, "fields").select("id").writeStream.format("noop").option("checkpointLocation", f"{tmp_path}/check").trigger(availableNow=True).start()
    query.awaitTermination()
    row = query.lastProgress["observedMetrics"]["fields"]
    assert (row["fields_processed"], row["no_match"]) == (3, 1)


def test_kafka_options_are_defaults_only():
    merged = {**KAFKA_DEFAULTS, **{"startingOffsets": "latest"}}
    assert merged == {"startingOffsets": "latest", "includeHeaders": "true", "kafka.isolation.level": "read_committed"}


@pytest.mark.parametrize("name", ["flow_rejects", "page_letters"])
def test_faults_occur(spark, name):
    assert not QUERIES[name](spark, SF).isEmpty()


def test_faults_occur_beside_good_rows(spark):
    for name in ("items_by_page", "array_policy", "entry_rejects", "parse_guard", "parse_lenient", "csv_rejected"):
        kinds = {r[0] for r in QUERIES[name](spark, SF).select(F.col("error_code").isNull()).distinct().collect()}
        assert kinds == {True, False}, name
    nulls = [QUERIES[n](spark, SF) for n in ("nulls_included", "nulls_excluded", "nulls_as_text")]
    counts = [(df.count(), df.filter("value IS NULL").count()) for df in nulls]
    assert counts[0][0] > counts[1][0] and counts[0][0] == counts[2][0] and [c[1] > 0 for c in counts] == [True, False, False]
    assert m.SHAPES[-1] is None
