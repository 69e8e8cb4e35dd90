"""Messages built from the test tables.

Every message comes from one row, so building it needs no shuffle and no key can become hot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pathweave.session import prepare
from pathweave.sources.messages import to_envelope


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table as it is stored.

    With the session setting ``pathweave.input.partitions`` its rows are dealt over so many partitions
    first; a bench on files of one row group sets it. Unset, there is no shuffle.
    """
    df = prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")
    parts = spark.conf.get("pathweave.input.partitions", None)
    return df if parts is None else df.repartition(int(parts))


def _messages(df: DataFrame, id_column: str, body: Column) -> DataFrame:
    return to_envelope(df.select(F.col(id_column), body.cast("binary").alias("value")))


def document_body() -> Column:
    """A document with one item per line; blank lines, and all whose length is a multiple of 7, have no ``text``."""
    lines = F.transform(
        F.split("text", "\n"),
        lambda t, i: F.struct(
            i.alias("n"), F.length(t).alias("chars"), F.col("lang").alias("lang"),
            F.when(F.length(t) % 7 != 0, t).alias("text"),
        ),
    )
    head = F.struct(F.col("doc_id").alias("id"), F.col("lang").alias("lang"), F.col("source").alias("source"))
    return F.to_json(F.struct(head.alias("document"), lines.alias("lines")))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _messages(table(spark, sf_dir, "documents"), "doc_id", document_body())


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A conversation turn with one item per line; the text is null where its length is a multiple of 3."""
    df = table(spark, sf_dir, "conversations")
    parts = F.transform(F.split("text", "\n"), lambda t, i: F.struct(i.alias("n"), F.when(F.length(t) % 3 != 0, t).alias("text")))
    head = F.struct(F.col("conv_id").alias("id"), F.col("turn").alias("turn"))
    body = F.to_json(F.struct(head.alias("conversation"), F.col("role").alias("role"), parts.alias("parts")), {"ignoreNullFields": "false"})
    return to_envelope(df.select("conv_id", "turn", body.cast("binary").alias("value")))


def event_body(user: Column | None = None) -> Column:
    """``{"id", "type", "user": {"id"}, "value", "props": {…}}``, with ``props`` as it is stored."""
    head = F.to_json(
        F.struct(
            F.col("event_id").alias("id"),
            F.col("event_type").alias("type"),
            (F.struct(F.col("user_id").alias("id")) if user is None else user).alias("user"),
            F.col("value").alias("value"),
        )
    )
    return F.concat(F.regexp_replace(head, r"\}\z", ',"props":'), F.col("props"), F.lit("}"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _messages(table(spark, sf_dir, "events"), "event_id", event_body())


def faulty_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events whose producers have faults: ``error`` is cut off, ``signup`` is empty, ``view``
    has no user."""
    kind = F.col("event_type")
    no_user = event_body(F.when(kind != "view", F.struct(F.col("user_id").alias("id"))))
    body = (
        F.when(kind == "error", F.regexp_replace(event_body(), r"\}\z", ""))
        .when(kind == "signup", F.lit(""))
        .otherwise(no_user)
    )
    return _messages(table(spark, sf_dir, "events"), "event_id", body)


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An order line: nested objects and an array of flags."""
    part = F.struct(F.col("l_partkey").alias("id"), F.col("l_suppkey").alias("supplier"))
    line = F.struct(
        F.col("l_linenumber").alias("n"),
        part.alias("part"),
        F.col("l_quantity").alias("qty"),
        F.col("l_extendedprice").alias("price"),
        F.array("l_returnflag", "l_linestatus").alias("flags"),
    )
    order = F.struct(F.col("l_orderkey").alias("id"))
    df = table(spark, sf_dir, "lineitem")
    body = F.to_json(F.struct(order.alias("order"), line.alias("line")))
    return to_envelope(df.select("l_orderkey", "l_linenumber", "l_partkey", body.cast("binary").alias("value")))


#: What ``props`` holds in a message of :func:`shaped_events`, by the remainder of its id; None: no such field.
SHAPES = ('[{"k":1},{"k":"x"}]', '{"k":1}', "{}", '"text"', "7", "null", "[]", None)


def shaped_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events whose ``props`` is an array only in some; every other kind of value occurs too."""
    shape = F.coalesce(*[F.when(F.col("event_id") % len(SHAPES) == n, F.lit("" if s is None else f',"props":{s}')) for n, s in enumerate(SHAPES)])
    body = F.concat(F.lit('{"id":'), F.col("event_id").cast("string"), shape, F.lit("}"))
    return _messages(table(spark, sf_dir, "events"), "event_id", body)


def deep_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events nested as deep as the remainder of their id by 40."""
    levels = (F.col("event_id") % 40).cast("int")
    body = F.concat(F.repeat(F.lit('{"n":'), levels), F.lit('{"leaf":'), F.col("event_id").cast("string"), F.repeat(F.lit("}"), levels + 1))
    return _messages(table(spark, sf_dir, "events"), "event_id", body)


def typed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with a boolean, a whole number wider than a long, a fraction and a null."""
    body = F.concat(
        F.lit('{"flag":'), (F.col("event_id") % 2 == 0).cast("string"), F.lit(',"wide":1234567890123456789'),
        F.lpad(F.col("event_id").cast("string"), 9, "0"), F.lit(',"part":0.5,"none":null,"empty":{"a":[],"b":{}}}'),
    )
    return _messages(table(spark, sf_dir, "events"), "event_id", body)


def shared_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of which every fifth has two fields for one path, in the one order or the other; the last key comes twice."""
    plain = F.concat(F.lit('"user.id":'), F.col("user_id").cast("string"))
    nested = F.concat(F.lit('"user":{"z":[{"y.x":1},2],"id":"'), F.col("event_type"), F.lit('"}'))
    even = F.col("event_id") % 2 == 0
    both = F.concat_ws(",", F.when(even, plain).otherwise(nested), F.when(even, nested).otherwise(plain))
    fields = F.when(F.col("event_id") % 5 == 0, both).otherwise(plain)
    body = F.concat(F.lit('{"id":0,'), fields, F.lit(',"id":'), F.col("event_id").cast("string"), F.lit("}"))
    return _messages(table(spark, sf_dir, "events"), "event_id", body)


def odd_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents; in the first line of every fifth two fields have the same dotted path, in that of every seventh a key is a
    number that no array can have as position.  ``body`` is the message again."""

    def with_field(text: str) -> Column:
        return F.regexp_replace(document_body(), r'"lines":\[\{"n":0,', '"lines":[{"n":0,' + text)

    body = (
        F.when(F.col("doc_id") % 7 == 3, with_field('"ids":{"2000000000":1},'))
        .when(F.col("doc_id") % 5 == 0, with_field('"a.b":1,"a":{"b":2},'))
        .otherwise(document_body())
    )
    df = table(spark, sf_dir, "documents").select("doc_id", body.alias("body"))
    return to_envelope(df.withColumn("value", F.col("body").cast("binary")))
