"""Importance resampling: draw the documents that look most like a target, with seeded noise on the score.

Features are runs of words hashed to buckets. A document is written once as the array of its buckets; the counts of
all buckets give an array of gains, and each document's array is scored against it. The scores are persisted, and
the cutoff is found by narrowing a numeric interval: each step is one job that counts exactly how many
persisted scores lie within some points of it. Ties go on by ``doc_id`` and then by row. What is drawn is
partitioned by range, so that ranks follow from the sizes of the ranges.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pathweave.llm.batches import bounded
from pathweave.llm.scratch import written

BUCKETS = 10_000
#: Points of the interval that one counting job looks at.
_POINTS = 15
_CACHED_FEATURES = 1_000_000
_MOST_LONG = 2**63 - 1
#: Bytes between words: ASCII but for digits and lower-case letters.
_BREAKS = bytes(b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))


def words(text: bytes) -> list[bytes]:
    """Words of a UTF-8 text; only A-Z become lower case."""
    return text.lower().translate(_BREAKS).split()


class _Buckets(dict):
    """Bucket of each feature, computed when first asked for."""

    def __init__(self, buckets: int):
        self.buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        bucket = self[feature] = zlib.crc32(feature) % self.buckets
        return bucket


def _hashed(buckets: int, longest: int):
    """``n_words`` and the buckets of all features as packed 32-bit numbers, in rising order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Buckets(buckets)
        for batch in bounded(batches, "text"):
            if len(known) > _CACHED_FEATURES:
                known.clear()
            n_words, packed = [], []
            for x in batch.column("text"):
                found = words(x.as_buffer().to_pybytes())
                features = list(map(known.__getitem__, found))
                for run_of in range(2, longest + 1):
                    features += [known[b" ".join(found[i:i + run_of])] for i in range(len(found) - run_of + 1)]
                n_words.append(len(found))
                packed.append(np.sort(np.array(features, dtype="<u4")).tobytes())
            kept = [batch.column(c) for c in batch.schema.names if c != "text"]
            names = [c for c in batch.schema.names if c != "text"] + ["n_words", "features"]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(n_words, pa.int64()), pa.array(packed, pa.binary())], names)

    return run


def _counted(buckets: int):
    """Counts of the buckets that a task meets: at most one row for each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for x in batch.column("features"):
                counts += np.bincount(np.frombuffer(x.as_buffer(), dtype="<u4"), minlength=buckets)
        met = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(met, pa.int64()), pa.array(counts[met])], ["bucket", "n"])

    return run


def _counts(hashed: DataFrame, buckets: int) -> list[int]:
    """Count of each bucket over all rows; ``buckets`` bounds what comes to the driver."""
    rows = hashed.select("features").mapInArrow(_counted(buckets), "bucket long, n long")
    out = [0] * buckets
    for row in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row["bucket"]] = row["n"]
    return out


def gains(corpus: list[int], target: list[int]) -> list[int]:
    """Floor of 1000 times the log ratio of the smoothed shares of each bucket."""
    n, all_s, all_t = len(corpus), sum(corpus), sum(target)
    top, low = float(all_s + n), float(all_t + n)
    return [math.floor(1000 * math.log(float(t + 1) * top / (float(s + 1) * low))) for s, t in zip(corpus, target, strict=True)]


def _noise(seed: int, doc_id: object) -> int:
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def _scored(gain: list[int], seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        array = np.array(gain, dtype=np.int64)
        for batch in batches:
            n_features, weight = [], []
            for x in batch.column("features"):
                at = np.frombuffer(x.as_buffer(), dtype="<u4")
                n_features.append(len(at))
                weight.append(int(array[at].sum()) // len(at) if len(at) else 0)
            score = [w + _noise(seed, i) for w, i in zip(weight, batch.column("doc_id").to_pylist(), strict=True)]
            kept = [batch.column(c) for c in ("row", "doc_id", "n_words")]
            yield pa.RecordBatch.from_arrays(
                kept + [pa.array(c, pa.int64()) for c in (n_features, weight, score)],
                ["row", "doc_id", "n_words", "n_features", "weight", "score"],
            )

    return run


def cutoff(rows: DataFrame, key: Column, wanted: int) -> tuple[int, int]:
    """The least value of a whole-number key that ``wanted`` rows (1 or more, not above their count) do not exceed, and how many
    rows lie below it. Each job counts all rows at some points of an interval, which shrinks to one value."""
    low, high = rows.agg(F.min(key), F.max(key)).first()
    below = 0
    while low < high:
        points = sorted({low + (high - low) * i // (_POINTS + 1) for i in range(1, _POINTS + 1)})
        found = rows.agg(*[F.count(F.when(key <= F.lit(p), 1)) for p in points]).first()
        for point, count in zip(points, found, strict=True):
            if count >= wanted:
                high = point
                break
            low, below = point + 1, count
    return low, below


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The number of the range and the position in it, for rows in order."""
    part, at = TaskContext.get().partitionId(), 0
    for batch in batches:
        n = batch.num_rows
        yield batch.append_column("part", pa.array(np.full(n, part))).append_column("at", pa.array(np.arange(at, at + n)))
        at += n


def _ranked(drawn: DataFrame, order: list[Column]) -> DataFrame:
    """``rank`` from 1 in ``order``: sizes of the ranges (one number for each partition) give the first rank of each."""
    fields = ", ".join(f"{c} {kind}" for c, kind in drawn.dtypes)
    sorted_ = drawn.repartitionByRange(*order).sortWithinPartitions(*order)
    held = written(sorted_.mapInArrow(_placed, fields + ", part long, at long"), "drawn")
    first, starts = 1, []
    for row in sorted(held.groupBy("part").agg(F.count("*").alias("n")).collect()):
        starts.append((row["part"], first))
        first += row["n"]
    frame = held.sparkSession.createDataFrame(starts, "part long, first long")
    return held.join(F.broadcast(frame), "part").withColumn("rank", F.col("first") + F.col("at")).drop("part", "first", "at")


def resample(
    docs: DataFrame, target: DataFrame, share: tuple[int, int] = (10, 100), least_words: int = 20, longest: int = 1,
    buckets: int = BUCKETS, seed: int = 2024,
) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` of every row of ``docs``; ``rank`` is null where it is not drawn.

    Features are all runs of 1 to ``longest`` words. ``weight`` is the floored mean gain of a row's features, ``score`` the
    weight with noise seeded by ``doc_id``. Of the rows with ``least_words`` words or more, the share with the
    highest scores is drawn: floor(share[0] * rows / share[1]); ties go to the smaller ``doc_id``.

    A null text has no words: weight 0, never drawn unless ``least_words`` is 0. A null ``doc_id`` counts as an empty text in the
    seed and comes after all others in ties. Rows that repeat an id are rows of their own; if the draw ends among
    rows equal in score and id, as many of them as it needs are drawn. Other columns are ignored, whatever
    their names; ``target`` needs only ``text``. An empty table gives no rows; an empty target has count 0 everywhere.
    """
    def rows(df: DataFrame, *ids: Column) -> DataFrame:
        return df.select(*ids, F.coalesce("text", F.lit("")).cast("binary").alias("text"))

    kind = dict(docs.dtypes)["doc_id"]
    numbered = rows(docs, F.monotonically_increasing_id().alias("row"), F.col("doc_id"))
    held = written(numbered.mapInArrow(_hashed(buckets, longest), f"row long, doc_id {kind}, n_words long, features binary"), "features")
    aim = rows(target).mapInArrow(_hashed(buckets, longest), "n_words long, features binary")
    gain = gains(_counts(held, buckets), _counts(aim, buckets))
    schema = f"row long, doc_id {kind}, n_words long, n_features long, weight long, score long"
    scored = written(held.mapInArrow(_scored(gain, seed), schema), "scores")

    may = scored.filter(F.col("n_words") >= least_words)
    wanted = share[0] * may.count() // share[1]
    out = ["doc_id", "n_features", "weight", "score"]
    if not wanted:
        return scored.select(*out, F.lit(None).cast("long").alias("rank"))
    keys = [-F.col("score"), F.coalesce(F.col("doc_id").cast("long"), F.lit(_MOST_LONG)), F.col("row")]
    tied, inside = may, F.lit(False)
    same = F.col("n_words") >= least_words
    for key in keys:
        value, below = cutoff(tied, key, wanted)
        inside = inside | (same & (key < F.lit(value)))
        same = same & (key == F.lit(value))
        tied, wanted = tied.filter(key == F.lit(value)), wanted - below
    inside = inside | same
    rest = scored.filter(~inside).select(*out, F.lit(None).cast("long").alias("rank"))
    return _ranked(scored.filter(inside), keys).select(*out, "rank").union(rest)
