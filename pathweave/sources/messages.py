"""Message envelopes from Kafka, files and tables, batch or stream."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import bind

#: Read policy of the Kafka source; user options override it.
KAFKA_DEFAULTS = {
    "startingOffsets": "earliest",
    "includeHeaders": "true",
    "kafka.isolation.level": "read_committed",
}

_FILE_FORMATS = ("parquet", "text", "json", "csv", "orc")

_DEFAULTS = {
    "key": "binary",
    "value": "binary",
    "headers": "map<string,binary>",
    "topic": "string",
    "partition": "int",
    "offset": "bigint",
    "timestamp": "timestamp",
}


def read_messages(
    spark: SparkSession, options: Mapping[str, str], format: str = "kafka", stream: bool = True, schema: str | None = None
) -> DataFrame:
    """Envelopes from a source.  Progress of a stream lives in the checkpoint of its query.

    ``format='kafka'`` needs the connector on the class path.  File formats take ``path``;
    ``text`` gives one message per line, or per file with ``wholetext=true``.  Files without coordinates of their own
    get those of :func:`file_coordinates`, so that a dead letter names its file.
    """
    reader = spark.readStream if stream else spark.read
    defaults = KAFKA_DEFAULTS if format == "kafka" else {}
    reader = reader.format(format).options(**{**defaults, **options})
    if schema is not None:
        reader = reader.schema(schema)
    loaded = reader.load()
    return to_envelope(file_coordinates(loaded, format) if format in _FILE_FORMATS else loaded)


def file_coordinates(df: DataFrame, format: str) -> DataFrame:
    """``topic`` (the file), ``partition`` (-1) and ``offset`` of rows read from files, where the rows have no such columns.

    The offset is the position of the row in its file where the format knows it (parquet), else the byte at which the
    part of the file begins that holds the row.
    """
    position = "_metadata.row_index" if format == "parquet" else "_metadata.file_block_start"
    place = {"topic": F.col("_metadata.file_path"), "partition": F.lit(-1), "offset": F.col(position)}
    missing = [c.cast(_DEFAULTS[name]).alias(name) for name, c in place.items() if name not in df.columns]
    return df.select("*", *missing)


def to_envelope(df: DataFrame) -> DataFrame:
    """Bring source columns into envelope form; columns beyond the envelope ride along.

    Only ``value`` is required.  Header arrays become maps in which the last duplicate wins.
    """
    types = dict(df.dtypes)
    columns = []
    for name, kind in _DEFAULTS.items():
        if name not in types:
            if name != "value":
                columns.append(F.lit(None).cast(kind).alias(name))
                continue
            raise ValueError("a message source needs a 'value' column")
        value = F.col(name)
        if name == "headers" and types[name].startswith("array"):
            value = headers_map(value)
        columns.append(value.cast(kind).alias(name))
    rest = [F.col(f"`{c}`") for c in df.columns if c not in _DEFAULTS]
    return df.select(*rest, *columns)


def headers_map(headers: Column) -> Column:
    """``array<struct<key,value>>`` to a map; of equal keys the last one wins."""
    placed = F.transform(
        headers, lambda h, i: F.struct(h.getField("key").alias("key"), i.alias("i"), h.getField("value").alias("value"))
    )

    def last_of_each(sorted_: Column) -> Column:
        def last(h: Column, i: Column) -> Column:
            return ~F.get(sorted_, i + 1).getField("key").eqNullSafe(h.getField("key"))

        return F.map_from_entries(
            F.transform(
                F.filter(sorted_, last),
                lambda h: F.struct(h.getField("key").alias("key"), h.getField("value").alias("value")),
            )
        )

    return bind(F.sort_array(placed), last_of_each)
