"""Bitmaps of the cells that are hit often enough, merged from sparse sketches of blocks of rows.

A block sends its cells as sorted gaps, a row for each chunk of the cell space; merging streams over them and
holds one small counter array per chunk. The merged bitmap is broadcast: its size follows the count of items up
to ``MOST_CELLS`` and no further. Beyond that it only separates less well; whoever asks it must stay right when
it answers "perhaps" for every item.
"""

from __future__ import annotations

import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from pathweave.llm.scratch import dropped, written

CHUNK = 1 << 20
#: Upper bound of one bitmap row: 2^30 cells, 128 MB.
MOST_CELLS = 1 << 30
PAYLOAD = "chunk long, width int, gaps binary"


def cells_for(items: int, each: float) -> int:
    """Count of cells for so many items: ``each`` per item, whole chunks, at most ``MOST_CELLS``."""
    return min(MOST_CELLS, max(1, -(-int(items * each) // CHUNK)) * CHUNK)


def cell(hashes: np.ndarray, cells: int, row: int = 0) -> np.ndarray:
    """Cell of each 64-bit hash; sketch row 0 uses the upper half of the hash, row 1 the lower."""
    half = hashes >> np.uint64(32) if row == 0 else hashes & np.uint64(0xFFFFFFFF)
    return (half * np.uint64(cells)) >> np.uint64(32)


def payload(hit: np.ndarray, first_chunk: int, least: int) -> list[tuple[int, int, bytes]]:
    """Rows of ``PAYLOAD`` for the cells that one block hits; a cell comes ``least`` times at most."""
    hit = np.sort(hit)
    if len(hit) > least:
        hit = hit[np.concatenate((np.ones(least, dtype=bool), hit[least:] != hit[:-least]))]
    chunks, starts = np.unique(hit // np.uint64(CHUNK), return_index=True)
    out = []
    for chunk, part in zip(chunks.tolist(), np.split(hit, starts[1:]), strict=True):
        gaps = np.diff(part - np.uint64(chunk * CHUNK), prepend=np.uint64(0))
        kind = np.min_scalar_type(int(gaps.max()))
        planes = gaps.astype(kind).view(np.uint8).reshape(-1, kind.itemsize).T  # the upper bytes are nearly all alike
        out.append((first_chunk + chunk, kind.itemsize, zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())))
    return out


def record(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    chunk, width, gaps = (list(x) for x in zip(*rows, strict=True)) if rows else ([], [], [])
    return pa.RecordBatch.from_arrays([pa.array(chunk, pa.int64()), pa.array(width, pa.int32()), pa.array(gaps, pa.binary())], ["chunk", "width", "gaps"])


def _merge(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, width, gaps in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(gaps), dtype=np.uint8).reshape(width, -1)
                at = np.cumsum(np.ascontiguousarray(planes.T).reshape(-1).view(f"u{width}"), dtype=np.int64)
                seen = counts.setdefault(chunk, np.zeros(CHUNK, dtype=np.uint8))
                for _ in range(least):  # a cell repeats up to ``least`` times in a row, so take runs apart
                    new = np.concatenate(([True], at[1:] != at[:-1])) if len(at) else np.zeros(0, dtype=bool)
                    seen[at[new]] = np.minimum(seen[at[new]] + 1, least)
                    at = at[~new]
        chunks = list(counts)
        bits = [np.packbits(counts[c] >= least).tobytes() for c in chunks]
        yield pa.RecordBatch.from_arrays([pa.array(chunks, pa.int64()), pa.array(bits, pa.binary())], ["chunk", "bits"])

    return run


class Bitmaps(list):
    """Packed bitmaps, one for each sketch row; they travel compressed, as a broadcast lies on the disks of the driver and all executors."""

    def __reduce__(self):
        return _unpacked, ([zstandard.ZstdCompressor(level=1).compress(x) for x in self],)


def _unpacked(packed: list[bytes]) -> Bitmaps:
    return Bitmaps(np.frombuffer(zstandard.ZstdDecompressor().decompress(x), dtype=np.uint8) for x in packed)


def merged(payloads: DataFrame, cells: int, rows: int, least: int) -> Bitmaps:
    """For each sketch row the packed bitmap of the cells hit ``least`` times or more (bounded by ``MOST_CELLS``)."""
    per_row = cells // CHUNK
    parts = max(1, min(rows * per_row, int(payloads.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    out = np.zeros((rows * per_row, CHUNK // 8), dtype=np.uint8)
    chunks = written(payloads.repartition(parts, "chunk").mapInArrow(_merge(least), "chunk long, bits binary"), "bitmap")
    for row in chunks.toLocalIterator(prefetchPartitions=True):
        out[row.chunk] = np.frombuffer(row.bits, dtype=np.uint8)
    dropped(chunks)
    # the sketches' shuffle is of no more use; Spark deletes its files once nothing refers to it
    spark = chunks.sparkSession
    del payloads, chunks
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    return Bitmaps(out[r * per_row:(r + 1) * per_row].reshape(-1) for r in range(rows))


def test(bitmaps: list[np.ndarray], hashes: np.ndarray, cells: int) -> np.ndarray:
    """Whether every sketch row has the hash's cell; never false for a hash that was counted ``least`` times."""
    out = np.ones(len(hashes), dtype=bool)
    for r, bits in enumerate(bitmaps):
        at = cell(hashes, cells, r)
        out &= (bits[(at >> np.uint64(3)).astype(np.int64)] >> (7 - (at & np.uint64(7)).astype(np.uint8)) & 1).astype(bool)
    return out
