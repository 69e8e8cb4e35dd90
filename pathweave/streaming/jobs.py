"""The job as a continuous query (J4).  Stateless: one stage per batch, no watermark."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..operators.dead_letters import accepted, dead_letters
from ..plans.flow import FlowConfig, outcomes
from ..sinks.writers import by_outcome, kafka_rows

#: Pause between batches, the checkpoint period of the job.
DEFAULT_INTERVAL = "60 seconds"


def start_files(
    stream: DataFrame, cfg: FlowConfig, path: str, checkpoint: str, interval: str = DEFAULT_INTERVAL, once: bool = False
) -> StreamingQuery:
    """Outcomes to parquet below ``outcome=ok`` and ``outcome=dlq``; exactly once per checkpoint."""
    writer = by_outcome(outcomes(stream, cfg)).writeStream.format("parquet").partitionBy("outcome")
    return _start(writer.option("path", path), checkpoint, interval, once)


def start_kafka(
    stream: DataFrame,
    cfg: FlowConfig,
    output_topic: str,
    dlq_topic: str,
    options: Mapping[str, str],
    checkpoint: str,
    interval: str = DEFAULT_INTERVAL,
    once: bool = False,
) -> StreamingQuery:
    """Results and dead letters to their topics from one query, so each message is parsed once."""
    rows = kafka_rows(outcomes(stream, cfg), output_topic, dlq_topic)
    return _start(rows.writeStream.format("kafka").options(**options), checkpoint, interval, once)


#: Takes the rows of a micro-batch and its number; called again with the same number it must replace what it wrote.
BatchWriter = Callable[[DataFrame, int], None]


def folder_of_batch(path: str, format: str = "parquet") -> BatchWriter:
    """Each micro-batch into a folder of its own below ``path``; a batch that runs again replaces its folder."""

    def write(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").format(format).save(f"{path}/batch={batch}")

    return write


def write_batch(messages: DataFrame, batch: int, cfg: FlowConfig, results: BatchWriter, letters: BatchWriter) -> None:
    """Results to one sink and dead letters to another, from one evaluation: each message is parsed once."""
    done = outcomes(messages, cfg).persist()
    try:
        results(accepted(done).drop("value"), batch)
        letters(dead_letters(done), batch)
    finally:
        done.unpersist()


def start_sinks(
    stream: DataFrame,
    cfg: FlowConfig,
    results: BatchWriter,
    letters: BatchWriter,
    checkpoint: str,
    interval: str = DEFAULT_INTERVAL,
    once: bool = False,
) -> StreamingQuery:
    """Results and dead letters to sinks of different kinds.

    The checkpoint fixes which messages a batch number has, so sinks that key what they write by it, as
    :func:`folder_of_batch` does, hold each row once even if a batch runs again after a failure.
    """
    writer = stream.writeStream.foreachBatch(lambda rows, batch: write_batch(rows, batch, cfg, results, letters))
    return _start(writer, checkpoint, interval, once)


def _start(writer, checkpoint: str, interval: str, once: bool) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint).outputMode("append")
    trigger = {"availableNow": True} if once else {"processingTime": interval}
    return writer.trigger(**trigger).start()
