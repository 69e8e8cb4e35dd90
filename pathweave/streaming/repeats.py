"""The consumer's side of at-least-once delivery: each page once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sinks.writers import COORDINATES

#: What identifies a page: the coordinates of its message, and its number.
PAGE_KEYS = ("topic", "partition", "offset", "page_index")


def source_coordinates(results: DataFrame, headers: str = "headers") -> DataFrame:
    """Results read back from a topic, with the coordinates that ``kafka_rows(coordinates=True)`` put into their headers.

    ``headers`` is a map as :func:`pathweave.sources.messages.to_envelope` makes it; the topic's own coordinates give way to
    those of the source.
    """
    kinds = {"topic": "string", "partition": "int", "offset": "bigint", "page_index": "int"}
    columns = {c: F.col(headers)[name].cast("string").cast(kinds[c]) for name, c in COORDINATES.items()}
    return results.withColumns(columns)


def once_each(pages: DataFrame, keys: Sequence[str] = PAGE_KEYS, time: str = "timestamp", delay: str = "1 hour") -> DataFrame:
    """The first of all rows with one key; a key whose parts are NULL is a key like any other.

    On a stream a key is remembered until the watermark (``time`` less ``delay``) has passed it: repeats within
    ``delay`` go, and the state is bounded by what arrives in that span.  A row without ``time`` would never leave the state
    and is an error of the caller.  On a batch all repeats go, whatever their time.
    """
    if not pages.isStreaming:
        return pages.dropDuplicates(list(keys))
    return pages.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(keys))
