"""Results and dead letters to Kafka or files (K1, K5)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.dead_letters import dead_letter_json


#: Headers that carry the coordinates of a result's message, and its page.
COORDINATES = {"source-topic": "topic", "source-partition": "partition", "source-offset": "offset", "source-page": "page_index"}


def kafka_rows(done: DataFrame, output_topic: str, dlq_topic: str, column: str = "json", coordinates: bool = False) -> DataFrame:
    """``key, value, headers, topic`` for the Kafka sink; results and dead letters in one stream.

    Results keep key and headers of their message.  The sink is at-least-once and takes no
    timestamp.  With ``coordinates`` results also carry those of their message as headers (:data:`COORDINATES`), by which a
    consumer can drop repeats: see :func:`pathweave.streaming.repeats.once_each`.
    """
    ok = F.col("error").isNull()
    letter = dead_letter_json(
        F.col("value"), F.col("error.code"), F.col("error.message"), F.unix_millis(F.current_timestamp()),
        F.coalesce("topic", F.lit("unknown")), F.coalesce("partition", F.lit(-1)), F.coalesce("offset", F.lit(-1).cast("bigint")),
    )
    headers = F.transform(
        F.map_entries("headers"), lambda h: F.struct(h.getField("key").alias("key"), h.getField("value").alias("value"))
    )
    if coordinates:
        own = [
            F.struct(F.lit(name).alias("key"), F.col(c).cast("string").cast("binary").alias("value"))
            for name, c in COORDINATES.items() if c in done.columns
        ]
        headers = F.concat(F.coalesce(headers, F.array().cast("array<struct<key:string,value:binary>>")), F.array(*own))
    return done.select(
        F.when(ok, F.col("key")).alias("key"),
        F.when(ok, F.col(column).cast("binary")).otherwise(letter.cast("binary")).alias("value"),
        F.when(ok, headers).alias("headers"),
        F.when(ok, F.lit(output_topic)).otherwise(F.lit(dlq_topic)).alias("topic"),
    )


def by_outcome(done: DataFrame) -> DataFrame:
    """Add ``outcome`` (``ok`` or ``dlq``), the partition column of file output."""
    return done.withColumn("outcome", F.when(F.col("error").isNull(), "ok").otherwise("dlq"))


def write_files(done: DataFrame, path: str, format: str = "parquet", mode: str = "append") -> None:
    """Write a batch of outcomes, results and dead letters side by side, in one pass."""
    by_outcome(done).write.partitionBy("outcome").format(format).mode(mode).save(path)


def write_kafka(rows: DataFrame, options: Mapping[str, str]) -> None:
    """Write a batch of :func:`kafka_rows`; needs the connector on the class path."""
    rows.write.format("kafka").options(**options).save()
