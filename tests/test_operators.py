"""Behaviour of single operators on small fixtures."""

import json

import pytest
from pyspark.sql import functions as F

from pathweave import (
    EXCLUDE, REPLACE_EMPTY_STRING, FlowConfig, PageNames, accepted, chained, dead_letters, decode_csv, encode_csv,
    flatten_json, flatten_pages, map_fields, outcomes, paginate, parse_messages, split_to_json, to_envelope, transform_fields,
    unflatten, validate_split_flatten,
)
from pathweave.operators.flatten import FLAT_TYPE
from pathweave.plans import rules

ERROR = "struct<code:string,message:string>"


def messages(spark, values):
    rows = [(i, v if v is None or isinstance(v, (bytes, bytearray)) else (v if isinstance(v, str) else json.dumps(v)).encode())
            for i, v in enumerate(values)]
    return to_envelope(spark.createDataFrame(rows, "id int, value binary"))


def flats(df):
    return {r.id: None if r.flat is None else {e.path: (e.leaf_type, e.value) for e in r.flat} for r in df.select("id", "flat").collect()}


def codes(df):
    return {r.id: r.error and r.error.code for r in df.select("id", "error").collect()}


def test_parse_guard(spark):
    bad = [None, b"", b'{"lot":', b"lot=7", b"  ", b'{"a":"\xff"}', b"{'a':1}", b"/* c */ {}"]
    good = [b'{"a":1}', b'{"a":1,"a":2} trailing', "﻿{}".encode(), b"5"]
    got = codes(parse_messages(messages(spark, bad + good)))
    assert [got[i] for i in range(12)] == ["EMPTY", "EMPTY"] + ["PARSE"] * 6 + [None] * 4
    lenient = codes(parse_messages(messages(spark, bad[6:]), lenient=True))
    assert lenient == {0: None, 1: None}


def test_leaves_and_types(spark):
    docs = [
        {"label": "crate", "mass": 30, "sealed": True, "none": None, "e": {}, "l": []},
        '{"int":42,"long":9999999999,"d":3.14,"whole":17.0,"exp":1e5,"wide":12345678901234567890}',
        {"rack": {"boxes": [{"mark": "A"}, {"mark": "B"}]}},
        [[1, 2], {"x": "y"}],
        {"": {"a": 1}, "b": {"": 2}},
    ]
    got = flats(flatten_json(parse_messages(messages(spark, docs))))
    assert got[0] == {"label": ("STRING", "crate"), "mass": ("BIGINT", "30"), "sealed": ("BOOLEAN", "true"), "none": ("VOID", None)}
    assert got[1] == {
        "int": ("BIGINT", "42"), "long": ("BIGINT", "9999999999"), "d": ("DOUBLE", "3.14"), "whole": ("DOUBLE", "17.0"),
        "exp": ("DOUBLE", "100000.0"), "wide": ("DECIMAL(20,0)", "12345678901234567890"),
    }
    assert got[2] == {"rack.boxes.0.mark": ("STRING", "A"), "rack.boxes.1.mark": ("STRING", "B")}
    assert got[3] == {"0.0": ("BIGINT", "1"), "0.1": ("BIGINT", "2"), "1.x": ("STRING", "y")}
    assert got[4] == {"a": ("BIGINT", "1"), "b.": ("BIGINT", "2")}


def test_null_policies(spark):
    df = parse_messages(messages(spark, [{"label": None, "x": 1}]))
    assert flats(flatten_json(df, EXCLUDE))[0] == {"x": ("BIGINT", "1")}
    assert flats(flatten_json(df, REPLACE_EMPTY_STRING))[0] == {"label": ("STRING", ""), "x": ("BIGINT", "1")}


def test_depth_width_and_shared_paths(spark):
    deep: dict = {"leaf": 1}
    for _ in range(299):
        deep = {"n": deep}
    wide = {"list": list(range(2000)), "text": "x" * 70000}
    odd = '{"a":[[[]],{"k":"}]{[\\"]"}],"b":{},"c":[[1,[2]]]} ]]] trailing'
    got = flatten_json(parse_messages(messages(spark, [deep, wide, '{"a.b":1,"a":{"b":2}}', odd, "7", "[]"])))
    assert codes(got) == {n: None for n in range(6)}
    flat = flats(got)
    assert flat[2] == {"a.b": ("BIGINT", "2")}
    assert flat[0] == {"n." * 299 + "leaf": ("BIGINT", "1")}
    assert len(flat[1]) == 2001
    assert flat[3] == {"a.1.k": ("STRING", '}]{["]'), "c.0.0": ("BIGINT", "1"), "c.0.1.0": ("BIGINT", "2")}
    assert flat[4] == {"": ("BIGINT", "7")} and flat[5] == {}
    pages = flatten_pages(paginate(parse_messages(messages(spark, [{"p": [deep, 1, wide]}])), "p", 2), PageNames("p"))
    first, second = sorted((r.flat for r in pages.collect()), key=lambda f: f[1].value)
    assert [e.path for e in first if e.path[0] == "p"] == ["p.0." + "n." * 299 + "leaf", "p.1"] and len(second) == 3 + 2001


def test_pages_and_item_rules(spark):
    crates = [{"mark": f"c{i}", "mass": i} for i in range(4)]
    del crates[3]["mark"]
    docs = [{"crates": crates}, {"crates": []}, {"crates": "x"}, {"crates": None}, {"crates": {"a": 1}}, {"crates": {}}, {}]
    df = parse_messages(messages(spark, docs))
    rows = paginate(df, "crates", 1, ["mark"]).collect()
    pages = [(r.page_index, r.total_pages, r.item_count, r.error and r.error.message, r.value is not None) for r in rows if r.id == 0]
    assert pages == [(0, 4, 1, None, False), (1, 4, 1, None, False), (2, 4, 1, None, False),
                     (3, 4, 1, "Item validation failed: [missing required field 'mark' in crates[3]]", True)]
    assert sorted((r.id, r.error.code) for r in rows if r.id) == [(i, "NOT_ARRAY") for i in (2, 3, 4, 5, 6)]
    quiet = paginate(df, "crates", 3, on_non_array="drop").collect()
    assert sorted((r.id, r.error and r.error.code, r.item_count) for r in quiet) == [(0, None, 1), (0, None, 3), (4, "NOT_ARRAY", None)]
    with pytest.raises(ValueError):
        paginate(df, "crates", 0)


def test_split_keeps_kinds_of_items(spark):
    value = '{"a":[1.0, "q\\"x", null, true, {"b":[2.0]}]}'
    rows = split_to_json(parse_messages(messages(spark, [value])), "a", 3, PageNames("items")).collect()
    assert [bytes(r.value).decode() for r in sorted(rows, key=lambda r: r.page_index)] == [
        '{"index":0,"total":2,"count":3,"items":[1.0,"q\\"x",null]}',
        '{"index":1,"total":2,"count":2,"items":[true,{"b":[2.0]}]}',
    ]


def test_required_rules(spark):
    schema = {
        "required": ["lot"], "anyOf": [{"required": ["rack"]}, {"required": ["shelf"]}],
        "properties": {"origin": {"type": "object", "required": ["port"], "oneOf": [{"required": ["quay"]}, {"required": ["berth"]}]}},
    }
    assert rules.required_paths(schema) == ["lot", "origin.port"]
    docs = [{"lot": None}, {"origin": {}}, {"lot": 1, "origin": None}, {"lot": 1, "origin": {"port": 2}, "extra": {}}]
    df = validate_split_flatten(messages(spark, docs), FlowConfig.from_schemas(schema))
    got = {r.id: r.error and r.error.message for r in df.collect()}
    head = "Input schema validation failed: "
    assert got == {
        0: None, 3: None, 2: head + "[missing required field 'origin.port']",
        1: head + "[missing required field 'lot', missing required field 'origin.port']",
    }


def test_page_names_and_csv_columns():
    page = {"$ref": "#/$defs/page", "$defs": {"page": {"allOf": [{"properties": {
        "crates": {"type": "array"}, "no": {"type": "integer", "minimum": 0, "description": "Current page"},
        "of": {"type": "integer", "minimum": 1}, "size": {"type": "integer", "minimum": 0}}}]}}}
    assert rules.page_names(page) == PageNames("crates", "no", "of", "size")
    for broken in ({}, {"properties": {"a": {"type": "array"}, "b": {"type": "array"}}}, {"properties": {"a": {"type": "array"}}}):
        with pytest.raises(ValueError):
            rules.page_names(broken)
    assert rules.csv_columns({"required": ["b", "a.c"]}) == ["b", "a.c"]
    for broken in ({}, {"required": []}, {"required": [" "]}, {"required": ["a"], "properties": {"b": {}}}):
        with pytest.raises(ValueError):
            rules.csv_columns(broken)


def test_declared_records_and_mappings():
    schema = {"properties": {"lot": {"type": "integer"}, "mark": {"type": ["string", "null"]}, "mass": {"type": "number"}, "sealed": {"type": ["null", "boolean"]}}}
    want = {"lot": ("lot", "bigint"), "mark": ("box.mark", "string"), "mass": ("mass", "double"), "sealed": ("sealed", "boolean")}
    assert rules.entry_fields(schema, {"mark": "box.mark"}) == want and rules.entry_fields({}) == {}
    for broken, paths in (({"properties": {"a": {"type": "object"}}}, {}), ({"properties": {"a": {}}}, {}), ({"properties": {"a": {"type": ["string", "integer"]}}}, {}), (schema, {"none": "x"})):
        with pytest.raises(ValueError):
            rules.entry_fields(broken, paths)
    yaml = pytest.importorskip("yaml")
    text = "# crates\nfield-mapping:\n  page: index\n  load.*.tag: \"${crates.*.mark}/${total}\"\n  load.*.kg: crates.*.mass\n"
    assert rules.field_mapping(yaml.safe_load(text)) == {"page": "index", "load.*.tag": "${crates.*.mark}/${total}", "load.*.kg": "crates.*.mass"}
    for broken in ({}, {"field-mapping": None}, {"field-mapping": {"a": 1}}, {"field-mapping": {"a": " "}}):
        with pytest.raises(ValueError):
            rules.field_mapping(broken)


def rebuild(spark, docs):
    def kind(v):
        return "VOID" if v is None else {str: "STRING", bool: "BOOLEAN", int: "BIGINT", float: "DOUBLE"}[type(v)]

    def text(v):
        return None if v is None else json.dumps(v) if isinstance(v, bool) else str(v)

    rows = [(i, None if d is None else [(p, kind(v), text(v)) for p, v in d]) for i, d in enumerate(docs)]
    df = spark.createDataFrame(rows, f"id int, flat {FLAT_TYPE}").withColumn("error", F.lit(None).cast(ERROR))
    return [(r.json and json.loads(r.json)) if r.error is None else r.error.code for r in unflatten(df).orderBy("id").collect()]


def test_rebuild(spark):
    cases = [
        (None, {}), ([], {}), ([("a", 1.0)], {"a": 1.0}), ([("a.b.c", True), ("a.b.d", None)], {"a": {"b": {"c": True, "d": None}}}),
        ([(f"t.{i}", i) for i in range(12)], {"t": list(range(12))}),
        ([("t.10", 1), ("t.2", 2)], {"t": [None, None, 2] + [None] * 7 + [1]}),
        ([("n.0.0", 5)], {"n": [{"0": 5}]}), ([("0.a", 1)], {"0": {"a": 1}}), ([("", 5)], {"": 5}), ([("a..0", 1)], {"a": {"": [1]}}),
        ([("z", 'q"\\\né'), ('k"', 2)], {"z": 'q"\\\né', 'k"': 2}),
        # later paths replace what disagrees with them
        ([("a", 1), ("a.b", 2)], {"a": {"b": 2}}), ([("a.0", 2), ("a.b", 1)], {"a": {"b": 1}}),
        ([("a.0", 1), ("a.0x", 2), ("a.1", 3)], {"a": [None, 3]}), ([("a.0", 1), ("a.00", 2)], {"a": [2]}),
        ([("a.0", None), ("a.0.x", 2)], {"a": [{"x": 2}]}), ([("x", 1), ("x", 2)], {"x": 2}),
        ([("a.0", 1), ("a.0.x", 2)], "CONFLICT"), ([("a.99999999999", 1)], "GAP"), ([("a.2000000000", 1)], "GAP"), ([("a.99999999999999999999", 1)], "GAP"),
        ([("a.0.5.9", 1), ("a.300000000.x", 2), ("b.300000000", 1)], "GAP"),
        ([("a.100.x", 1), ("b", 2)], {"a": [None] * 100 + [{"x": 1}], "b": 2}),
    ]
    assert rebuild(spark, [c[0] for c in cases]) == [c[1] for c in cases]


def test_a_wide_gap_is_written(spark):
    rows = spark.createDataFrame([([("a.20000000", "BIGINT", "1")],)], f"flat {FLAT_TYPE}").withColumn("error", F.lit(None).cast(ERROR))
    out = unflatten(rows).select(F.length("json").alias("n"), F.substring("json", 1, 11).alias("head"), F.expr("right(json, 8)").alias("tail")).first()
    assert tuple(out) == (5 * 20_000_000 + 9, '{"a":[null,', 'null,1]}')


def test_transforms(spark):
    doc = {"s": [{"d": "ab", "n": 1}, {"d": "straße"}], "d": "x", "s0": {"D": "k"}}
    flat = flatten_json(parse_messages(messages(spark, [doc])))
    got = flats(transform_fields(flat, ["s.*.d", "s.*.n", "*"]))[0]
    assert got["s.0.d"][1] == "AB" and got["s.1.d"][1] == "STRASSE" and got["d"][1] == "X"
    assert got["s.0.n"] == ("BIGINT", "1") and got["s0.D"][1] == "k"
    assert flats(transform_fields(flat, ["s.*"]))[0] == flats(flat)[0]
    mapped = flats(map_fields(flat, {"t.*.label": "${s.*.d}/${s.*.n}: ${d}", "one": "${d}", "t.*.no": "s.*.n", "gone": "missing"}))[0]
    assert mapped == {"t.0.label": ("STRING", "ab/1: x"), "one": ("STRING", "x"), "t.0.no": ("BIGINT", "1")}


def test_csv(spark):
    lines = ["a,b", 'a,"x ""q"", y"', ",", "a,b,c", "a", 'a,"b"junk,c', 'a,"open', " a , b ", 'a,"l1\nl2"', "a,b\n", 'x,"' + 'y""' * 50000 + '"']
    df = decode_csv(messages(spark, lines + [""]), ["c1", "c2"])
    got = {i: None if f is None else [f["c1"][1], f["c2"][1]] for i, f in flats(df).items()}
    assert got == {
        0: ["a", "b"], 1: ["a", 'x "q", y'], 2: [None, None], 3: None, 4: None, 5: ["a", "b"], 6: ["a", "open"], 7: [" a ", " b "],
        8: ["a", "l1\nl2"], 9: ["a", "b\n"], 10: ["x", 'y"' * 50000], 11: None,
    }
    assert codes(df)[3] == "CSV_COLUMNS" and codes(df)[11] == "EMPTY"
    encoded = {r.id: r.csv for r in encode_csv(accepted(df), ["c2", "none", "c1"]).collect()}
    assert encoded[0] == "b,,a" and encoded[1] == '"x ""q"", y",,a' and encoded[8] == '"l1\nl2",,a' and encoded[2] == ",,"


def test_headers_and_dead_letters(spark):
    rows = [(b"k", b"", [("h", b"1"), ("g", b"2"), ("h", b"3")], "in", 3, 17)]
    df = to_envelope(spark.createDataFrame(rows, "key binary, value binary, headers array<struct<key:string,value:binary>>, topic string, partition int, offset long"))
    assert {k: bytes(v) for k, v in df.first().headers.items()} == {"h": b"3", "g": b"2"}
    letter = dead_letters(parse_messages(df)).first()
    assert (letter.error_code, letter.topic, letter.partition, letter.offset) == ("EMPTY", "in", 3, 17)


def test_whole_message_rejection_differs_from_pages(spark):
    docs = [{"a": [{"x": 1}, {"y": 2}]}]
    cfg = FlowConfig(array="a", item_required=["x"], names=PageNames("a"), page_size=1)
    one_pass = outcomes(messages(spark, docs), cfg)
    assert sorted(r.error is None for r in one_pass.collect()) == [False, True]
    three_steps = chained(messages(spark, docs), cfg).collect()
    assert [r.error.message for r in three_steps] == ["Required field validation failed: [missing field 'x' in a[1]]"]
