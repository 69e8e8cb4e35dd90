"""Guard and parse raw message bytes (V1, V2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import ERROR_TYPE, once

EMPTY_MESSAGE = "Empty or null message"
PARSE_MESSAGE = "Malformed JSON message"

_LENIENT = {
    "singleVariantColumn": "v",
    "allowComments": "true",
    "allowSingleQuotes": "true",
    "columnNameOfCorruptRecord": "_corrupt",
}


def message_text(value: Column) -> Column:
    """UTF-8 text of the bytes without a byte-order mark; NULL for invalid UTF-8."""
    text = value.cast("string")
    bare = F.when(F.startswith(text, F.lit("﻿")), F.substring(text, 2, 2**31 - 1)).otherwise(text)
    return F.when(F.is_valid_utf8(text), bare)


def parse_messages(df: DataFrame, lenient: bool = False) -> DataFrame:
    """Parse ``value`` into ``v VARIANT``; rows that cannot be parsed get an ``error``.

    Strict by default.  ``lenient`` also accepts comments and single quotes.  The text is
    parsed once per row, whatever follows.  Repeated object keys keep the last value, which
    needs the session setting made by :func:`pathweave.session.prepare`.
    """
    text = message_text(F.col("value"))
    if lenient:
        parsed = F.from_json(text, "v variant, _corrupt string", _LENIENT).getField("v")
    else:
        parsed = F.try_parse_json(text)
    size = F.octet_length("value")
    df = once(df, v=parsed)
    error = (
        F.when(F.col("value").isNull() | (size == 0), _error("EMPTY", EMPTY_MESSAGE))
        .when(F.col("v").isNull(), _error("PARSE", PARSE_MESSAGE))
        .otherwise(F.lit(None).cast(ERROR_TYPE))
    )
    return df.withColumn("error", error)


def _error(code: str, message: str) -> Column:
    return F.struct(F.lit(code).alias("code"), F.lit(message).alias("message"))
