"""Order of shared paths, and messages of a size that anything quadratic would show."""

import json
import random
import time

import pytest
from pyspark.sql import functions as F

from pathweave import (
    EXCLUDE, FlowConfig, PageNames, flatten_json, flatten_pages, outcomes, paginate, parse_messages, to_envelope, unflatten,
)
from pathweave.operators.flatten import FLAT_TYPE

ERROR = "struct<code:string,message:string>"


def messages(spark, texts):
    return to_envelope(spark.createDataFrame([(i, t.encode()) for i, t in enumerate(texts)], "id int, value binary"))


def walk(pairs, path, out, nulls):
    """Leaves of nested (key, value) pairs by path, the later one winning."""
    if isinstance(pairs, dict) or isinstance(pairs, list):
        items = pairs.items() if isinstance(pairs, dict) else enumerate(pairs)
        for key, value in items:
            walk(value, f"{path}.{key}" if path else str(key), out, nulls)
    elif pairs is not None or nulls != EXCLUDE:
        out[path] = None if pairs is None else str(pairs)


def expected(text, nulls="INCLUDE"):
    out = {}
    walk(json.loads(text), "", out, nulls)
    return out


SHARED = [
    '{"a.b":1,"a":{"b":2}}', '{"a":{"b":2},"a.b":1}', '{"z":0,"a":{"b.c":1,"b":{"c":"x"}},"a.b":{"c":3}}',
    '{"a.0":1,"a":[2,3],"a.1":null}', '{"a":{"b":null},"a.b":1}', '{"a.b":1,"a":{"b":null}}',
    '{"a":1,"b.c":2,"a":3,"b":{"c":4},"b.c":5}', '{"":{"k":1},"k":2}', '{"k":2,"":{"k":1}}', '{"":{"":{"":1}},"":{"":{"x":1}}}',
    '{"a\\u002eb":1,"a":{"b":2}}', ' {"q.\\"r":[{"s":1}],"q":{"\\"r.0.s":"}{"}} trailing', '{"a.b":[],"a":{"b":1}}', '{"a.b":{"c":[1,{"d.e":1,"d":{"e":2}}]},"a":{"b.c.1.d":{"e":9}}}',
]


@pytest.mark.parametrize("nulls", ["INCLUDE", EXCLUDE])
def test_the_later_field_wins(spark, nulls):
    got = flatten_json(parse_messages(messages(spark, SHARED)), nulls).select("id", "error", "flat").collect()
    for r in got:
        text = SHARED[r.id].replace(" trailing", "")
        assert r.error is None
        assert len({e.path for e in r.flat}) == len(r.flat)
        assert {e.path: e.value for e in r.flat} == expected(text, nulls), text


def test_the_later_field_wins_in_pages(spark):
    texts = ['{"p":[' + ",".join([t.replace(" trailing", ""), "7", "null", '"x.y"']) + "]}" for t in SHARED]
    pages = paginate(parse_messages(messages(spark, texts)), "p", 3)
    got = flatten_pages(pages, PageNames("p")).select("id", "page_index", "error", "flat").collect()
    for r in got:
        items = json.loads(texts[r.id])["p"][3 * r.page_index:3 * r.page_index + 3]
        want = {}
        for i, item in enumerate(items):
            walk(item, f"p.{i}", want, "INCLUDE")
        assert r.error is None
        assert {e.path: e.value for e in r.flat if e.path.startswith("p.")} == want
    assert len(got) == 2 * len(texts)


def test_shared_paths_without_a_text_are_refused(spark):
    df = parse_messages(messages(spark, SHARED[:1]))
    assert flatten_json(df.drop("value")).first().error.code == "CONFLICT"
    pages = paginate(parse_messages(messages(spark, ['{"p":[{"a.b":1,"a":{"b":2}}]}'])), "p", 3).drop("item_texts")
    assert flatten_pages(pages, PageNames("p")).first().error.code == "CONFLICT"


def random_value(depth):
    kind = random.random()
    if depth and kind < 0.35:
        return {random.choice(["a", "b", "a.b", "", "0", "c", "b.0"]): random_value(depth - 1) for _ in range(random.randrange(4))}
    if depth and kind < 0.6:
        return [random_value(depth - 1) for _ in range(random.randrange(4))]
    return random.choice([None, 1, "t", "u.v"])


def test_random_documents(spark):
    random.seed(5)
    texts = [json.dumps({"a": random_value(9), "b": random_value(9), "a.b": random_value(3)}) for _ in range(400)]
    got = {r.id: r.flat for r in flatten_json(parse_messages(messages(spark, texts))).collect()}
    for i, text in enumerate(texts):
        assert {e.path: e.value for e in got[i]} == expected(text), text


def test_prose_dots_and_digits_leave_no_copies(spark):
    prose = [{"t": "A sentence. 1.5 \"2\": of it", "note": "\\ é", "2024": 1} for _ in range(400)]
    dotted = [{"kind.of/label": i, "m": {"x": 1}} for i in range(400)]
    texts = [json.dumps({"p": prose}), json.dumps({"p": dotted}), json.dumps({"p": prose + dotted})]
    cfg = FlowConfig(array="p", names=PageNames("p"), page_size=2)
    for pages in (paginate(parse_messages(messages(spark, texts)), "p", 2), outcomes(messages(spark, texts), cfg)):
        sizes = pages.groupBy("id").agg(F.count("*").alias("pages"), F.coalesce(F.sum(F.octet_length("value")), F.lit(0)).alias("bytes"))
        assert {r.id: (r.pages, r.bytes) for r in sizes.collect()} == {0: (200, 0), 1: (200, 0), 2: (400, 0)}


def test_pages_that_fail_later_hold_their_message(spark):
    bad = [{"k": 1}, {"x": [5], "x.0.y": 1}, {"k": 2}, {"n": {"4000000000": 1}}, {"a.b": 1, "a": {"b": 2}}]
    texts = [json.dumps({"p": bad})]
    cfg = FlowConfig(array="p", names=PageNames("p"), page_size=1)
    rows = sorted(outcomes(messages(spark, texts), cfg).collect(), key=lambda r: r.page_index)
    assert [r.error and r.error.code for r in rows] == [None, "CONFLICT", None, "GAP", None]
    assert [r.value and bytes(r.value).decode() for r in rows] == [None, texts[0], None, texts[0], None]
    assert json.loads(rows[4].json)["p"] == [{"a": {"b": 2}}]


def test_a_message_of_a_million_items(spark):
    n = 1_000_000
    text = F.concat(F.lit('{"p":['), F.array_join(F.transform(F.sequence(F.lit(1), F.lit(n)), lambda i: F.concat(F.lit('{"i":'), i.cast("string"), F.lit("}"))), ","), F.lit("]}"))
    df = to_envelope(spark.range(1).select("id", text.cast("binary").alias("value")))
    pages = paginate(parse_messages(df), "p", 100, ["i"])
    assert "Exchange" not in pages._jdf.queryExecution().executedPlan().toString()
    got = pages.agg(F.count("*").alias("pages"), F.sum("item_count").alias("items"), F.count("error").alias("errors"), F.count("value").alias("copies")).first()
    assert tuple(got) == (n // 100, n, 0, 0)


def seconds(action):
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def test_flat_and_deep_do_not_multiply(spark):
    deep: dict = {"leaf": 1}
    for _ in range(300):
        deep = {"n": deep}
    wide = {f"k{i}": i for i in range(2000)}
    frames = [parse_messages(messages(spark, [json.dumps(d)] * 20)).repartition(1) for d in (deep, wide, {**wide, "deep": deep})]
    runs = [flatten_json(f).select(F.size("flat").alias("n")) for f in frames]
    for r in runs:
        r.collect()
    apart = seconds(runs[0].collect) + seconds(runs[1].collect)
    assert seconds(runs[2].collect) < 4 * apart + 1  # a factor of 300 if each level touched each leaf
    assert {r.n for r in runs[2].collect()} == {2001}


def test_many_conflicts_in_one_row(spark):
    n = 10_000
    rows = [(1, [(f"a.k{i}", "BIGINT", str(i)) for i in range(n)] + [(f"a.k{i}.x", "BIGINT", str(i)) for i in range(n)])]
    df = spark.createDataFrame(rows, f"id int, flat {FLAT_TYPE}").withColumn("error", F.lit(None).cast(ERROR))
    found = []
    took = seconds(lambda: found.append(unflatten(df).first()))
    assert json.loads(found[0].json) == {"a": {f"k{i}": {"x": i} for i in range(n)}}
    assert took < 30
