"""CSV messages: one line per message, columns by position (S3, K2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import bind, leaves_at, once

# One field after a comma: quoted (doubled quotes inside, closing quote optional at the end of
# the line), or anything up to the next comma.  \G makes matches adjoin, so text after a closing
# quote ends the line.  Possessive groups keep long quoted texts off the stack.
_FLAT = "array<struct<path:string,leaf_type:string,value:string>>"
_FIELD = r'\G,(?:"[^"]*+(?:""[^"]*+)*+(?:"|\z)|(?:[^",][^,]*+)?)'


def csv_fields(line: Column) -> Column:
    """``ARRAY<STRING>`` of the fields of a line, untrimmed."""

    def bare(match: Column) -> Column:
        return F.when(F.startswith(match, F.lit(',"')), bind(F.substring(match, 3, 2**31 - 1), inside)).otherwise(F.substring(match, 2, 2**31 - 1))

    def inside(body: Column) -> Column:
        # of the quotes at its end the last one closes the field, unless they are all doubled
        last = (F.length(body) - F.length(F.rtrim(body, F.lit('"')))) % 2
        return F.replace(F.substring(body, F.lit(1), F.length(body) - last), F.lit('""'), F.lit('"'))

    return F.transform(F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(_FIELD), F.lit(0)), bare)


def decode_csv(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add ``flat`` with one text leaf per column (empty = NULL); bad lines get an ``error``."""
    df = once(df, _fields=csv_fields(F.make_valid_utf8(F.col("value").cast("string"))))
    size = F.size("_fields")
    empty = F.col("value").isNull() | (F.octet_length("value") == 0)
    mismatch = F.concat(
        F.lit(f"CSV column count mismatch: expected {len(columns)} but got "), size.cast("string")
    )
    error = F.when(empty, _error("EMPTY", F.lit("Empty or null CSV message"))).when(
        size != len(columns), _error("CSV_COLUMNS", mismatch)
    )

    def leaf(text: Column, name: str) -> Column:
        value = F.nullif(text, F.lit(""))
        kind = F.when(text == "", F.lit("VOID")).otherwise(F.lit("STRING"))
        return F.struct(F.lit(name).alias("path"), kind.alias("leaf_type"), value.alias("value"))

    leaves = F.array(*[leaf(F.get("_fields", F.lit(i)), name) for i, name in enumerate(columns)])
    df = df.withColumn("error", error)
    return once(df, drop=("_fields",), flat=F.when(F.col("error").isNull(), leaves))


def encode_csv(df: DataFrame, columns: Sequence[str], column: str = "csv") -> DataFrame:
    """Add the CSV line of ``flat`` in the order of ``columns``; absent and NULL are empty."""
    wanted = list(columns)

    def line(leaves: Column) -> Column:
        return F.concat_ws(",", *[csv_field(F.try_element_at(leaves, F.lit(name)).getField("value")) for name in wanted])

    return once(df, **{column: bind(leaves_at(F.coalesce("flat", F.array().cast(_FLAT)), wanted), line)})


def csv_field(value: Column) -> Column:
    """One encoded field: quoted only if it holds a comma, a quote or a line break."""
    text = F.coalesce(value, F.lit(""))
    quoted = F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))
    return F.when(text.rlike(r'[,"\n\r]'), quoted).otherwise(text)


def _error(code: str, message: Column) -> Column:
    return F.struct(F.lit(code).alias("code"), message.alias("message"))
