"""The composed job: plans without shuffles, and streams that equal batches."""

import tempfile

import pytest
from pyspark.sql import functions as F

from pathweave import FlowConfig, PageNames, outcomes, to_envelope
from pathweave.sinks.writers import kafka_rows
from pathweave.streaming.jobs import start_files
from workload import messages as m
from workload.queries import FLOW, QUERIES

SF = "/root/testdata/sf0.001"
CFG = FlowConfig(required=["document"], array="lines", item_required=["text"], names=PageNames("lines"), page_size=3, patterns=["lines.*.lang"])


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_shuffle_and_one_parse(spark):
    # enough splits for every core, as an input of cluster size has
    source = spark.read.parquet(f"{SF}/documents.parquet").coalesce(1)
    df = to_envelope(source.select("doc_id", m.document_body().cast("binary").alias("value")))
    text = plan(outcomes(df, FLOW).select("doc_id", "json", "error"))
    assert "Exchange" not in text
    assert text.count("parseJson") == 1


def test_stream_equals_batch_and_restarts(spark):
    root = tempfile.mkdtemp(prefix="run-")
    docs = m.documents(spark, SF).select("doc_id", "value")
    docs.where("doc_id % 2 = 0").write.parquet(f"{root}/in")

    def run():
        stream = to_envelope(spark.readStream.schema("doc_id long, value binary").parquet(f"{root}/in"))
        start_files(stream, CFG, f"{root}/out", f"{root}/check", once=True).awaitTermination()

    run()
    docs.where("doc_id % 2 = 1").write.mode("append").parquet(f"{root}/in")
    run()
    run()  # nothing new
    got = spark.read.parquet(f"{root}/out").select("doc_id", "page_index", "json", "error")
    want = outcomes(to_envelope(docs), CFG).select("doc_id", "page_index", "json", "error")
    assert got.count() == want.count() > 0
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_kafka_rows(spark):
    rows = [(b"k", b'{"a":1}', {"h": b"v"}, "in", 0, 5), (b"k", b"{", {"h": b"v"}, "in", 0, 6)]
    df = spark.createDataFrame(rows, "key binary, value binary, headers map<string,binary>, topic string, partition int, offset long")
    out = kafka_rows(outcomes(to_envelope(df), FlowConfig()), "good", "bad").orderBy("topic").collect()
    bad, good = out
    assert (bad.topic, bad.key, bad.headers) == ("bad", None, None) and b'"sourceOffset":6' in bytes(bad.value)
    assert (good.topic, bytes(good.key), bytes(good.value)) == ("good", b"k", b'{"a":1}')
    assert [(h.key, bytes(h.value)) for h in good.headers] == [("h", b"v")]


@pytest.mark.parametrize("name", ["page_slices", "items_by_page", "page_json", "mapped_fields", "flow_results", "dead_letter_json", "csv_decoded"])
def test_queries_match_their_sql(spark, name):
    from tests.check_oracles import compare, tables

    assert compare(spark, tables(SF), SF, name) == ""
    assert name in QUERIES
