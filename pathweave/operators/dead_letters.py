"""Rejected rows as dead letters (K3, K4)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def accepted(df: DataFrame) -> DataFrame:
    """Rows without an error."""
    return df.where(F.col("error").isNull()).drop("error")


def dead_letters(df: DataFrame) -> DataFrame:
    """Rows with an error, with the original bytes and the real source coordinates.

    A column the input does not have (``topic partition offset``) reads ``unknown``, -1, -1.
    """
    return df.where(F.col("error").isNotNull()).select(
        F.col("value").alias("original"),
        F.col("error.code").alias("error_code"),
        F.col("error.message").alias("error_message"),
        F.unix_millis(F.current_timestamp()).alias("error_ts_ms"),
        _source(df, "topic", "string", "unknown"),
        _source(df, "partition", "int", -1),
        _source(df, "offset", "bigint", -1),
    )


def dead_letter_json(original: Column, code: Column, message: Column, ts_ms: Column, topic: Column, partition: Column, offset: Column) -> Column:
    """Dead letter as JSON text; without bytes the last two fields are left out."""
    return F.to_json(
        F.struct(
            code.alias("errorClass"),
            message.alias("errorMessage"),
            ts_ms.alias("errorTimestampMs"),
            topic.alias("sourceTopic"),
            partition.alias("sourcePartition"),
            offset.alias("sourceOffset"),
            # base64() breaks long lines
            F.replace(F.base64(original), F.lit("\r\n"), F.lit("")).alias("originalBytes"),
            F.make_valid_utf8(original.cast("string")).alias("originalText"),
        )
    )


def encode_dlq(letters: DataFrame) -> DataFrame:
    """``value BINARY`` with the JSON of each row of :func:`dead_letters`; the key is NULL."""
    c = F.col
    text = dead_letter_json(
        c("original"), c("error_code"), c("error_message"), c("error_ts_ms"), c("topic"), c("partition"), c("offset")
    )
    return letters.select(F.lit(None).cast("binary").alias("key"), text.cast("binary").alias("value"))


def _source(df: DataFrame, name: str, kind: str, default: str | int) -> Column:
    known = F.col(name).cast(kind) if name in df.columns else F.lit(None).cast(kind)
    return F.coalesce(known, F.lit(default).cast(kind)).alias(name)
