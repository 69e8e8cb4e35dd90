"""Removal of repeated passages: windows of words, sifted by a count-min sketch, then grouped exactly.

A first pass makes sketches of the windows' hashes and merges them; the merged sketch never counts a window
too low. A second pass groups only the windows that it takes for repeated: by 128-bit hashes within a
block of documents, and the earliest of each block by 96 of these bits across the corpus. No key gathers more rows than there are blocks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pathweave.llm import sketch
from pathweave.llm.batches import bounded
from pathweave.llm.scratch import texts

WORDS = 20
#: Sketch cells per window and row; with two rows about one unrepeated window in seventy passes for repeated.
_CELLS_EACH = 8
_CHARS_A_WORD = 6
_NULL = np.iinfo(np.int64).min


def window_hashes(words: list[bytes], width: int) -> np.ndarray:
    """A row of two longs, the XXH3-128 of the words joined by one space, for each window."""
    if len(words) < width:
        return np.zeros((0, 2), dtype=np.uint64)
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    starts = np.cumsum(lengths + 1) - lengths - 1
    ends = (starts + lengths)[width - 1:]
    digest = xxhash.xxh3_128_digest
    made = b"".join([digest(joined[a:b]) for a, b in zip(starts[:len(ends)].tolist(), ends.tolist(), strict=True)])
    return np.frombuffer(made, dtype="<u8").reshape(-1, 2)


def _sketches(cells: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, "text"):
            found = [window_hashes(x.as_buffer().to_pybytes().split(), width)[:, 0] for x in batch.column("text")]
            hashes = np.concatenate(found)
            if len(hashes):
                for row in range(2):
                    yield sketch.record(sketch.payload(sketch.cell(hashes, cells, row), row * cells // sketch.CHUNK, 2))

    return run


def _candidates(bitmaps, cells: int, width: int):
    """Windows that the sketch takes for repeated.

    The earliest in the block goes on with its hash; those after it in the same block are repeats already, and go
    packed into one row per document (``known``).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, "text"):
            hashes, docs, starts = [], [], []
            for d, x in enumerate(batch.column("text")):
                h = window_hashes(x.as_buffer().to_pybytes().split(), width)
                at = np.flatnonzero(sketch.test(bitmaps.value, h[:, 0], cells))
                hashes.append(h[at])
                starts.append(at)
                docs.append(np.full(len(at), d))
            h, start, doc = np.concatenate(hashes), np.concatenate(starts), np.concatenate(docs)
            if not len(h):
                continue
            ids = batch.column("doc_id").fill_null(_NULL).to_numpy()
            tags = batch.column("tag").to_numpy().astype(np.int64)
            order = np.lexsort((start, ids[doc], h[:, 1], h[:, 0]))
            h, start, doc = h[order], start[order], doc[order]
            new = np.concatenate(([True], (h[1:] != h[:-1]).any(axis=1)))
            lead = np.maximum.accumulate(np.where(new, np.arange(len(h)), 0))
            early = (ids[doc] == ids[doc[lead]]) & (start == start[lead])
            go = np.flatnonzero(early)
            go = go[np.lexsort((start[go], doc[go]))]  # neighbours in a document share most bytes of their rows
            late = np.flatnonzero(~early)
            late = late[np.argsort(doc[late], kind="stable")]
            owners, at = np.unique(doc[late], return_index=True)
            packed = [start[x].astype("<u4").tobytes() for x in np.split(late, at[1:])] if len(late) else []
            who = np.concatenate((doc[go], owners)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.concatenate((h[go, 0].view(np.int64), ids[owners]))),
                pa.array(np.concatenate(((h[go, 1] >> np.uint64(32)).astype(np.int64), tags[owners]))),
                batch.column("doc_id").take(pa.array(who)),
                pa.array(tags[who] << 32 | np.concatenate((start[go], np.zeros(len(owners), dtype=np.int64)))),
                pa.array([None] * len(go) + packed, pa.binary()),
            ], ["hi", "lo", "doc_id", "place", "known"])

    return run


def _squeezed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts compressed one by one, for the one shuffle they go through."""
    pack = zstandard.ZstdCompressor(level=3).compress
    for batch in bounded(batches, "text"):
        data = pa.array([pack(x.as_buffer()) for x in batch.column("text")], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("tag"), data], ["doc_id", "tag", "packed"])


def _cleaned(width: int):
    """Drop the words that a removed window covers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, gone, kept_text = [], [], []
            columns = (batch.column(c) for c in ("packed", "starts", "known"))
            for packed, starts, known in zip(*columns, strict=True):
                words = zstandard.ZstdDecompressor().decompress(packed.as_buffer()).split()
                total.append(len(words))
                at = [np.asarray(starts.values, dtype=np.int64)] if starts.is_valid else []
                at += [np.frombuffer(x, dtype="<u4").astype(np.int64) for x in known.as_py() or ()]
                if at and (at := np.unique(np.concatenate(at))).size:
                    steps = np.zeros(len(words) + 1, dtype=np.int64)
                    np.add.at(steps, at, 1)
                    np.add.at(steps, np.minimum(at + width, len(words)), -1)
                    words = [w for w, c in zip(words, np.cumsum(steps[:-1]).tolist(), strict=True) if not c]
                gone.append(total[-1] - len(words))
                kept_text.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(total, pa.int64()), pa.array(gone, pa.int64()),
                pa.array([hashlib.sha256(t).hexdigest() for t in kept_text]), pa.array([t.decode() for t in kept_text]),
            ], ["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"])

    return run


def dedup(docs: DataFrame, width: int = WORDS) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256, kept_text`` for every row of ``docs``.

    Words are split at ASCII white space. A word goes if a window of ``width`` words covers it whose words also start
    earlier: in a document with a smaller id, or earlier in the same one. Windows are those of the input.

    A null text counts as empty. A null id is the smallest id. Rows that repeat an id are one document: a window
    at the same start of another row with this id isn't earlier. Ids are integers. Other columns are ignored;
    an empty table gives no rows. ``docs`` is read four times and must give the same rows each time.
    """
    context = docs.sparkSession.sparkContext
    rows = texts(docs).select("doc_id", F.col("text").cast("binary").alias("text"), F.hash("doc_id", "text").alias("tag"))
    size = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    cells = sketch.cells_for(size // _CHARS_A_WORD, _CELLS_EACH)
    twice = sketch.merged(rows.select("text").mapInArrow(_sketches(cells, width), sketch.PAYLOAD), cells, 2, 2)
    kind = dict(docs.dtypes)["doc_id"]
    found = rows.mapInArrow(_candidates(context.broadcast(twice), cells, width), f"hi long, lo long, doc_id {kind}, place long, known binary")
    start = F.col("place").bitwiseAND(F.lit(0xFFFFFFFF))
    order = Window.partitionBy("hi", "lo").orderBy(F.isnotnull("known"), "doc_id", start)
    late = found.withColumn("rank", F.rank().over(order)).filter("known is not null or rank > 1")
    by_doc = late.groupBy(F.col("doc_id").alias("_id"), F.shiftright("place", 32).cast("int").alias("_tag")).agg(
        F.collect_list(F.when(F.isnull("known"), start)).alias("starts"), F.collect_list("known").alias("known")
    )
    small = rows.mapInArrow(_squeezed, f"doc_id {kind}, tag int, packed binary")
    same = small["doc_id"].eqNullSafe(by_doc["_id"]) & (small["tag"] == by_doc["_tag"])
    joined = small.join(by_doc.hint("shuffle_hash"), same, "left").select("doc_id", "packed", "starts", "known")
    return joined.mapInArrow(_cleaned(width), f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string, kept_text string")
