"""Exact deduplication against a minimal perfect hash over the digests of earlier texts.

The index is a table with a row for each bucket of about four digests: a seed that sends the bucket's digests
to its slots one to one (so all slots of all buckets are filled: a minimal perfect hash), and the slots, each
with the full digest, the winner's id and the number of rows. A lookup is one join on the bucket and one
comparison of all 32 bytes, so a text that is not in the index is never taken for one that is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pathweave.llm.scratch import texts, written

_PRIME = (1 << 31) - 1
_PER_BUCKET = 4


def normalised(text: Column) -> Column:
    """Each run of ASCII white space as one space."""
    return F.regexp_replace(text, r"[\x20\x09-\x0D]+", " ")


def digests(docs: DataFrame) -> DataFrame:
    """``doc_id, digest``: SHA-256 of every normalised text, as 32 bytes."""
    return texts(docs).select("doc_id", F.unhex(F.sha2(normalised(F.col("text")), 256)).alias("digest"))


def _number(digest: Column, first: int) -> Column:
    """Four bytes of the digest as a number below the prime."""
    return F.conv(F.hex(F.substring(digest, first, 4)), 16, 10).cast("long") % F.lit(_PRIME)


def _bucket(digest: Column, buckets: int) -> Column:
    return F.conv(F.hex(F.substring(digest, 1, 7)), 16, 10).cast("long") % F.lit(buckets)


def _seeded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Find each bucket's seed and put its slots in the order that the seed gives."""
    for batch in batches:
        seeds, ordered = [], []
        for slots in batch["slots"]:
            a = np.array([s["a"] for s in slots], dtype=np.int64)
            b = np.array([s["b"] for s in slots], dtype=np.int64)
            seed, place, step = -1, None, 256
            for start in range(0, 1 << 30, step):
                tries = np.arange(start, start + step, dtype=np.int64)[:, None]
                places = (a + tries * b) % _PRIME % len(a)
                good = np.flatnonzero((np.sort(places, axis=1) == np.arange(len(a))).all(axis=1))
                if len(good):
                    seed, place = start + int(good[0]), places[good[0]]
                    break
            if seed < 0:
                raise ValueError("two digests agree in 62 hashed bits; use another part of the digest")
            row: list = [None] * len(a)
            for at, slot in zip(place, slots, strict=True):
                row[at] = {"digest": slot["digest"], "winner": slot["winner"], "n": slot["n"]}
            seeds.append(seed)
            ordered.append(row)
        yield pd.DataFrame({"bucket": batch["bucket"], "seed": seeds, "slots": ordered})


def build_index(classes: DataFrame) -> tuple[DataFrame, int]:
    """Index over ``digest, winner, n`` (digests distinct) and its number of buckets, from the count of digests.

    Digests are uniform, so buckets stay as small at any size. An empty table gives an empty index of one bucket.
    """
    buckets = max(1, classes.count() // _PER_BUCKET)
    slot = F.struct("digest", "winner", "n", _number(F.col("digest"), 9).alias("a"), _number(F.col("digest"), 13).alias("b"))
    grouped = classes.groupBy(_bucket(F.col("digest"), buckets).alias("bucket")).agg(F.collect_list(slot).alias("slots"))
    kind = dict(classes.dtypes)["winner"]
    index = grouped.mapInPandas(_seeded, f"bucket long, seed long, slots array<struct<digest:binary,winner:{kind},n:long>>")
    return written(index, "perfect-hash"), buckets


def lookup(rows: DataFrame, index: DataFrame, buckets: int) -> DataFrame:
    """``rows`` (with ``digest``) and ``found``: the slot whose digest is the row's, or null for a nonmember."""
    keyed = rows.withColumn("bucket", _bucket(F.col("digest"), buckets))
    joined = keyed.join(index, "bucket", "left")
    place = (_number(F.col("digest"), 9) + F.col("seed") * _number(F.col("digest"), 13)) % F.lit(_PRIME) % F.size("slots")
    slot = F.get(F.col("slots"), place.cast("int"))
    return joined.withColumn("found", F.when(slot["digest"] == F.col("digest"), slot)).drop("bucket", "seed", "slots")


def _classes(rows: DataFrame) -> DataFrame:
    """One row for each digest; the count and the winner combine before the shuffle, so copies are no hot key."""
    return rows.groupBy("digest").agg(F.min("doc_id").alias("winner"), F.sum("copies").alias("n"))


def dedup(docs: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, keep_id, group_size, kept, text_sha256``.

    ``history`` is an earlier corpus; without one it is ``docs`` itself, so that every row is a member of the
    index. A member's ``keep_id`` is the winner of the history, and it is kept only if it is that row.
    Nonmembers are grouped among themselves, and the smallest ``doc_id`` stays.

    A null text counts as empty. A row that repeats both id and text is reported as often as it occurs and kept
    once. A null id comes after all others: it wins only where its group has no other, and then ``keep_id`` is
    null. Columns other than ``doc_id`` and ``text`` are ignored; an empty table gives no rows.
    """
    rows = written(digests(docs).groupBy("doc_id", "digest").agg(F.count("*").alias("copies")), "digests")
    old = rows if history is None else digests(history).groupBy("doc_id", "digest").agg(F.count("*").alias("copies"))
    index, buckets = build_index(written(_classes(old), "classes"))
    looked = lookup(rows, index, buckets)
    member = looked.filter("found is not null").select(
        "doc_id", "digest", "copies", F.col("found.winner").alias("keep_id"), F.col("found.n").alias("group_size")
    )
    if history is None:
        every = member
    else:
        rest = looked.filter("found is null").select("doc_id", "digest", "copies")
        fresh = _classes(rest).withColumnsRenamed({"winner": "keep_id", "n": "group_size"})
        every = member.unionByName(rest.join(fresh, "digest"))
    copy = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")
    out = every.select("doc_id", "keep_id", "group_size", "digest", copy)
    return out.select(
        "doc_id", "keep_id", "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
