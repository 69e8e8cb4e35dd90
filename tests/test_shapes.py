"""Rows done a batch at a time come out as the expressions make them."""

import json
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pathweave import EXCLUDE, INCLUDE, REPLACE_EMPTY_STRING, flatten_json, parse_messages, unflatten
from pathweave.operators import shapes
from pathweave.operators.flatten import FLAT_TYPE

ODD = [
    "{}", "[]", "7", '"x"', "null", "", None, "{", "[1,[],{\"a\":null}]", '{"a":{},"b":[[]],"c":""}', ' {"a":1}', '{"a": 1, "b" : [true, false ]}\n',
    '{"a":"x\\n\\u00e9"}', '{"a\\"b":1}', '{"a":"{[,:]}","b":"é \U0001f600"}', '{"é":1,"z":2}', '{"a":1,"a":2}', '{"a.b":1,"a":{"b":2}}', '{"":1,"b":2}',
    '{"a":1e5,"b":1E-3,"c":-0,"d":-0.0,"e":0.0,"f":0.00}', '{"a":12.500,"b":-3.0,"c":1.00,"d":0.001,"e":0.0009,"f":9999999.9,"g":10000000.5}',
    '{"a":999999999999999999,"b":1234567890123456789,"c":9223372036854775807,"d":9223372036854775808,"e":-5}',
    '{"a":123456789012345678901234567890123456789012,"b":0.1234567890123}', '{"b":[{"0":{"1":"x"}},[[5]]],"10":{"2":3},"9":1}', '{"B":1,"a":2,"_":3,"A b":4}',
    '{"a":{"b":{"c":{"d":{"e":{"f":[1,{"g":null}]}}}}}}', '{"t":"2024-01-01","u":"NaN"}', '{"k":"' + "y" * 20000 + '"}',
]


def rows(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, text string").repartition(1)
    return df.select("id", F.col("text").cast("binary").alias("value"))


@pytest.fixture
def by_expressions(monkeypatch):
    def set_up():
        monkeypatch.setattr(shapes, "MOST_BYTES", -1)
        monkeypatch.setattr(shapes, "MOST_LEAVES", -2)

    return set_up


@pytest.mark.parametrize("nulls", [INCLUDE, EXCLUDE, REPLACE_EMPTY_STRING])
def test_batches_agree_with_expressions(spark, by_expressions, nulls):
    def results():
        flat = flatten_json(parse_messages(rows(spark, ODD)), nulls)
        return unflatten(flat).select("id", "flat", "error", "json").orderBy("id").collect()

    quick = results()
    by_expressions()
    assert quick == results()


def test_leaves_of_any_kind_agree_with_expressions(spark, by_expressions):
    r = random.Random(5)
    names = ["a", "b", "0", "1", "2", "01", "", "é", 'q"', "a b", "\x01"]
    flats = [
        [
            (".".join(r.choice(names[: r.choice([3, 5, 11])]) for _ in range(r.randint(1, 4))), kind, value)
            for kind, value in r.choices([("STRING", "x"), ("STRING", 'a"\n'), ("STRING", None), ("BIGINT", "1"), ("VOID", None), ("DOUBLE", "Infinity"), ("DOUBLE", "NaN")], k=r.randint(0, 4))
        ]
        for _ in range(300)
    ]
    flats += [None, [None], [(None, "STRING", "x")], [("a.0", "BIGINT", "1"), ("a.1", "BIGINT", "2")], [("a.1", "BIGINT", "1")], [("a", None, "1")]]
    df = spark.createDataFrame([(i, f) for i, f in enumerate(flats)], f"id long, flat {FLAT_TYPE}").repartition(1)
    df = df.withColumn("error", F.lit(None).cast("struct<code:string,message:string>"))
    quick = unflatten(df).select("id", "error", "json").orderBy("id").collect()
    by_expressions()
    assert quick == unflatten(df).select("id", "error", "json").orderBy("id").collect()


def test_plain_messages_are_left_to_no_expression():
    """Order lines are the bulk of a job: all of a batch are flattened and rebuilt by array operations."""
    r = random.Random(3)
    docs = [
        {"order": {"id": r.randrange(10**9)}, "line": {"n": i % 7, "part": {"id": r.randrange(99)}, "qty": float(r.randrange(50)), "price": r.randrange(10**9) / 100, "flags": ["A", "F"][: i % 3]}}
        for i in range(500)
    ]
    texts = pa.array([json.dumps(d, separators=(",", ":")) for d in docs])
    flat = shapes.flat_batch(texts)
    again = shapes.text_batch(flat)
    assert flat.null_count == again.null_count == 0
    assert shapes.flat_batch(again).equals(flat)
    assert [json.loads(t) for t in again.to_pylist()] == [d if d["line"]["flags"] else {**d, "line": {k: v for k, v in d["line"].items() if k != "flags"}} for d in docs]


def test_parts_of_batches():
    texts = pa.array(["x", '{"a":1}', None, '{"b":[1,"c"]}', "{}"])
    flat = shapes.flat_batch(texts.slice(1, 3))
    assert [f and [leaf["path"] for leaf in f] for f in flat.to_pylist()] == [["a"], None, ["b.0", "b.1"]]
    assert shapes.text_batch(flat.slice(1)).to_pylist() == [None, '{"b":[1,"c"]}']
    assert len(shapes.flat_batch(texts.slice(0, 0))) == len(shapes.text_batch(flat.slice(0, 0))) == 0
