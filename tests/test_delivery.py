"""Coordinates of stored messages, two sinks from one pass, repeats, and work per batch or row."""

import glob
import json
import os
import tempfile

import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from pathweave import FlowConfig, PageNames, dead_letters, encode_csv, flatten_json, map_fields, outcomes, parse_messages, read_messages, to_envelope, transform_fields
from pathweave.operators.flatten import FLAT_TYPE
from pathweave.sinks.writers import kafka_rows
from pathweave.streaming.jobs import folder_of_batch, start_sinks, write_batch
from pathweave.streaming.repeats import once_each, source_coordinates

CFG = FlowConfig(array="p", item_required=["k"], names=PageNames("p"), page_size=2)
TEXTS = ['{"p":[{"k":1},{"k":2},{"k":3}]}', '{"p":', '{"p":[{"k":4},{"x":5},{"k":6}]}', '{"q":1}']


def folder():
    return tempfile.mkdtemp(prefix="run-")


def stored(spark, format, root):
    """Two files of messages; the rows of each file in order."""
    for i, part in enumerate((TEXTS[:2], TEXTS[2:])):
        df = spark.createDataFrame([(t,) for t in part], "value string").coalesce(1)
        (df if format == "text" else df.select(F.col("value").cast("binary").alias("value"))).write.format(format).mode("append").save(f"{root}/{i}")
    return f"{root}/*"


@pytest.mark.parametrize("format", ["text", "parquet"])
def test_letters_name_their_file(spark, format):
    root = folder()
    path = stored(spark, format, f"{root}/in")
    schema = "value string" if format == "text" else "value binary"
    batch = dead_letters(outcomes(read_messages(spark, {"path": path}, format, stream=False), CFG))
    stream = read_messages(spark, {"path": path}, format, stream=True, schema=schema)
    query = dead_letters(outcomes(stream, CFG)).writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/check").trigger(availableNow=True).start()
    query.awaitTermination()
    for letters in (batch, spark.read.parquet(f"{root}/out")):
        rows = sorted((r.topic, r.partition, r.offset, r.error_code) for r in letters.collect())
        assert [(os.path.basename(os.path.dirname(t)), p, c) for t, p, _, c in rows] == [("0", -1, "PARSE"), ("1", -1, "ITEM_REQUIRED"), ("1", -1, "NOT_ARRAY")]
        assert [o for _, _, o, _ in rows] == ([1, 0, 1] if format == "parquet" else [0, 0, 0])


def test_own_coordinates_stay(spark):
    root = folder()
    spark.createDataFrame([(b"x", "in", 3, 9)], "value binary, topic string, partition int, offset long").write.parquet(f"{root}/in")
    letter = dead_letters(parse_messages(read_messages(spark, {"path": f"{root}/in"}, "parquet", stream=False))).first()
    assert (letter.topic, letter.partition, letter.offset) == ("in", 3, 9)


def test_two_sinks_from_one_pass(spark):
    root = folder()
    rows = spark.createDataFrame([(t.encode(),) for t in TEXTS], "value binary")
    rows.limit(2).write.parquet(f"{root}/in/a")

    def run():
        stream = to_envelope(spark.readStream.schema("value binary").parquet(f"{root}/in/*"))
        start_sinks(stream, CFG, folder_of_batch(f"{root}/results", "json"), folder_of_batch(f"{root}/letters"), f"{root}/check", once=True).awaitTermination()

    def held():
        results = sorted(r.json for r in spark.read.json(f"{root}/results").select("json").collect())
        return results, sorted(r.error_code for r in spark.read.parquet(f"{root}/letters").collect())

    run()
    rows.exceptAll(rows.limit(2)).write.parquet(f"{root}/in/b")
    run()
    done = outcomes(to_envelope(rows), CFG)
    want = sorted(r.json for r in done.filter("error is null").collect()), sorted(r.error.code for r in done.filter("error is not null").collect())
    assert held() == want and len(want[0]) == 3 and len(want[1]) == 3
    last = max(glob.glob(f"{root}/check/commits/[0-9]*"), key=lambda f: int(os.path.basename(f)))
    for file in (last, f"{root}/check/commits/.{os.path.basename(last)}.crc"):
        os.remove(file)  # as if the job had died after it wrote its batch
    run()
    assert held() == want


def test_a_micro_batch_parses_once(spark):
    plans = []
    rows = to_envelope(spark.createDataFrame([(t.encode(),) for t in TEXTS], "value binary"))

    def keep(df, batch):
        df.write.format("noop").mode("overwrite").save()
        plans.append(df._jdf.queryExecution().executedPlan().toString())

    write_batch(rows, 1, CFG, keep, keep)
    assert len(plans) == 2 and all("InMemoryTableScan" in p and "Exchange" not in p for p in plans)
    write_batch(rows, 1, CFG, folder_of_batch(f"{(root := folder())}/a"), folder_of_batch(f"{root}/b"))
    write_batch(rows, 1, CFG, folder_of_batch(f"{root}/a"), folder_of_batch(f"{root}/b"))
    assert (spark.read.parquet(f"{root}/a").count(), spark.read.parquet(f"{root}/b").count()) == (3, 3)


def test_repeated_pages_of_a_replayed_stream_come_once(spark):
    root = folder()
    rows = [(t.encode(), "in", 0, i, f"2024-01-01 00:0{i}:00") for i, t in enumerate(TEXTS)]
    df = spark.createDataFrame(rows, "value binary, topic string, partition int, offset long, timestamp string").withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    for part in (df, df.filter("offset < 3"), df.filter("offset > 1")):  # the second and third repeat what the first sent
        part.coalesce(1).write.mode("append").parquet(f"{root}/in")
    stream = to_envelope(spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in"))
    pages = once_each(outcomes(stream, CFG).select("topic", "partition", "offset", "page_index", "timestamp", "json", F.col("error.code").alias("code")))
    pages.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/check").trigger(availableNow=True).start().awaitTermination()
    columns = ["topic", "partition", "offset", "page_index", "json", "code"]
    got = sorted(map(str, spark.read.parquet(f"{root}/out").select(columns).collect()))
    want = sorted(map(str, outcomes(to_envelope(df), CFG).select(*columns[:-1], F.col("error.code").alias("code")).collect()))
    assert got == want
    again = once_each(outcomes(to_envelope(df.unionAll(df)), CFG).select(*columns[:-1], F.col("error.code").alias("code")))
    assert sorted(map(str, again.collect())) == want


def test_coordinates_travel_in_headers(spark):
    rows = [(TEXTS[0].encode(), {"h": b"v"}, "in", 2, 7), (TEXTS[0].encode(), None, "in", 2, 8)]
    df = to_envelope(spark.createDataFrame(rows, "value binary, headers map<string,binary>, topic string, partition int, offset long"))
    sent = kafka_rows(outcomes(df, CFG), "good", "bad", coordinates=True)
    twice = sent.unionAll(sent).withColumn("partition", F.lit(99)).withColumn("offset", F.lit(1).cast("long"))
    read = once_each(source_coordinates(to_envelope(twice)))
    got = sorted((r.topic, r.partition, r.offset, r.page_index, json.loads(bytes(r.value))["index"]) for r in read.collect())
    assert got == [("in", 2, 7, 0, 0), ("in", 2, 7, 1, 1), ("in", 2, 8, 0, 0), ("in", 2, 8, 1, 1)]
    assert {bytes(r.headers["h"]) for r in read.collect() if r.offset == 7} == {b"v"}


def test_one_call_for_the_values_of_a_batch(spark):
    docs = [{"a": [{"t": f"x{i}"}, {"t": "é"}], "n": 1} for i in range(50)] + [{"n": 2}, {"a": [{"t": ""}, {"t": None}]}]
    df = to_envelope(spark.createDataFrame([(i, json.dumps(d).encode()) for i, d in enumerate(docs)], "id int, value binary").coalesce(1))
    flat = flatten_json(parse_messages(df))

    def backwards(values: pa.Array) -> pa.Array:
        # a second call for the same batch would be seen as fewer values
        return pc.binary_join_element_wise(pc.utf8_reverse(values), pa.scalar(str(len(values))), "#")

    got = {r.id: {e.path: e.value for e in r.flat} for r in transform_fields(flat, ["a.*.t"], batch=backwards).collect()}
    assert got[3] == {"a.0.t": "3x#101", "a.1.t": "é#101", "n": "1"}
    assert got[50] == {"n": "2"} and got[51] == {"a.0.t": "#101", "a.1.t": None}
    with pytest.raises(Exception, match="values became"):
        transform_fields(flat, ["a.*.t"], batch=lambda values: values[1:]).collect()


def test_a_batch_of_values_is_put_back_without_sorting(spark):
    leaves = [("a.0", "STRING", "x"), ("a.1", "BIGINT", "1"), ("a.2", "STRING", None), ("b", "STRING", "y"), ("a.3", None, "z"), ("a.4", "STRING", "")]
    rows = [(leaves, 1), (None, 2), ([], 3), ([None, *leaves[::-1]], 4)]
    df = spark.createDataFrame(rows, f"flat {FLAT_TYPE}, id int").withColumn("error", F.lit(None).cast("struct<code:string,message:string>"))
    calls = {"a.*": lambda v: pc.binary_join_element_wise(v, pa.scalar("!"), ""), "none": lambda v: v}
    for pattern, fn in calls.items():
        done = transform_fields(df, [pattern], batch=fn)
        changed = lambda e: (e[0], e[1], e[2] + "!" if pattern == "a.*" and e[0] != "b" and e[1] == "STRING" and e[2] is not None else e[2])  # noqa: E731, B023
        got = {r.id: r.flat if r.flat is None else [tuple(e) if e else None for e in r.flat] for r in done.collect()}
        assert got == {1: [changed(e) for e in leaves], 2: None, 3: [], 4: [None, *(changed(e) for e in leaves[::-1])]}
    assert "sort_array" not in done._jdf.queryExecution().toString()


def test_many_columns_and_rules_take_one_look(spark):
    n = 60
    leaves = [(f"c{i}", "STRING", f"v{i}") for i in range(n)]
    df = spark.createDataFrame([(leaves,), ([("c1", "BIGINT", None)],), (None,)], f"flat {FLAT_TYPE}").withColumn("error", F.lit(None).cast("struct<code:string,message:string>"))
    lines = [r.csv for r in encode_csv(df, [f"c{i}" for i in range(n)] + ["none"]).collect()]
    assert lines == [",".join(f"v{i}" for i in range(n)) + ",", "," * n, "," * n]
    mapping = {f"t{i}": f"c{i}" for i in range(n)} | {"both": "${c1}-${c2}", "gone": "c99", "same": "${c1}"}
    got = [r.flat and {e.path: (e.leaf_type, e.value) for e in r.flat} for r in map_fields(df, mapping).collect()]
    assert got[0] == {f"t{i}": ("STRING", f"v{i}") for i in range(n)} | {"both": ("STRING", "v1-v2"), "same": ("STRING", "v1")}
    assert got[1] == {"t1": ("BIGINT", None), "same": ("BIGINT", None)} and not got[2]
