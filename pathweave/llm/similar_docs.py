"""Near duplicates at a given similarity: SimHash fingerprints find candidates, exact Jaccard similarity decides.

The first keys are the pigeonhole blocks of ``simhash_dedup``: whatever pair differs in ``BITS`` bits of the first
fingerprint or fewer shares one of them for sure. That doesn't reach down to similarity 0.8, where about 10 of 64 bits
differ, and blocks that did would be a few bits long. So a document has ``SEEDS`` fingerprints, over its distinct
shingles, and further keys are fixed choices of the bits of all: a pair whose bits agree with probability p shares one of
m keys of b bits with probability 1 - (1 - p^b)^m. Keys are made longer as the corpus grows, and more of them, so that
chance hits stay rare and recall stays. What shares a key is checked by its differing bits, then by its shingles.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathweave.llm import sketch
from pathweave.llm.batches import bounded
from pathweave.llm.components import components
from pathweave.llm.line_dedup import _mixed, _times
from pathweave.llm.scratch import texts, written
from pathweave.llm.simhash_dedup import _LOWER, block_choices, block_count
from pathweave.llm.tiles import bucket_lists

#: Fingerprints of 64 bits that a document has.
SEEDS = 4
#: Differing bits of the first fingerprint up to which the blocks find every pair.
BITS = 4
#: Blocks that the first fingerprint is cut into at least: 70 keys of 32 bits, so that chance hits stay rare, as for other keys.
BLOCKS = 8
#: Share of pairs at the similarity itself that no key may find, taken at the mean count of differing bits.
MISSED = 0.001
#: Chosen keys that the first round takes beside the blocks; its links join large groups before all keys are looked at.
FIRST = 8
_STEP = 0x9E3779B97F4A7C15
_LIST = 4096
_AT_ONCE = 1 << 15


def _words(text: bytes) -> list[bytes]:
    return text.translate(_LOWER).split()


def shingles(words: list[bytes], width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles; a shorter text is one shingle, an empty one has none."""
    if not words:
        return np.zeros(0, dtype=np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    width = min(width, len(h))
    out = np.full(len(h) - width + 1, np.uint64(width))
    for i in range(width):
        out = _mixed(out * np.uint64(_STEP) + h[i:len(h) - width + 1 + i])
    return np.unique(out)


def _bits(hashes: np.ndarray) -> np.ndarray:
    """The bits of all seeded fingerprints: the majority of each bit over the shingles."""
    counts = np.zeros(64 * SEEDS, dtype=np.int64)
    for at in range(0, len(hashes), _AT_ONCE):
        part = hashes[at:at + _AT_ONCE]
        seeded = np.stack([_mixed(part + _times(_STEP, s + 1)) for s in range(SEEDS)], axis=1)
        counts += np.unpackbits(seeded.view(np.uint8), axis=1).sum(axis=0, dtype=np.uint32)
    return np.packbits(counts * 2 > len(hashes))


def _agree(similarity: float) -> float:
    """Probability that a bit agrees for two sets of one size at this Jaccard similarity."""
    return 1 - math.acos(2 * similarity / (1 + similarity)) / math.pi


def key_plan(count: int, similarity: float) -> tuple[int, int]:
    """Bits of a key and count of keys for so many distinct documents."""
    size = count.bit_length() + 4
    return size, max(FIRST, math.ceil(math.log(MISSED) / math.log1p(-_agree(similarity) ** size)))


def most_apart(similarity: float) -> int:
    """Differing bits beyond which a pair isn't looked at: five standard deviations above the mean."""
    apart, n = 1 - _agree(similarity), 64 * SEEDS
    return math.ceil(n * apart + 5 * math.sqrt(n * apart * (1 - apart)))


def _prints(kind: str, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, "text"):
            digests, prints = [], []
            for text in batch.column("text"):
                words = _words(text.as_buffer().to_pybytes())
                digests.append(hashlib.md5(b" ".join(words), usedforsecurity=False).digest())
                prints.append(_bits(shingles(words, width)).view(np.int64) if words else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(digests, pa.binary()), pa.array(prints, pa.list_(pa.int64()))],
                ["doc_id", "text_hash", "digest", "fp"],
            )

    return run, f"doc_id {kind}, text_hash long, digest binary, fp array<long>"


def bits_of_key(number: int, size: int, choices: list[list[int]]) -> np.ndarray:
    """The bits of a key: a choice of blocks of the first fingerprint, or after these ``size`` bits of all."""
    if number < len(choices):
        return np.array(choices[number])
    return np.random.default_rng(number - len(choices)).permutation(64 * SEEDS)[:size]


def _keys_of(prints: np.ndarray, first: int, count: int, size: int, blocks: int) -> np.ndarray:
    """Hashes of the keys ``first`` to ``first + count`` of each row of fingerprints."""
    bits = np.unpackbits(np.ascontiguousarray(prints).view(np.uint8).reshape(len(prints), -1), axis=1).astype(np.float64)
    choose, choices = np.zeros((bits.shape[1], count)), block_choices(blocks, BITS)
    for i in range(count):
        chosen = bits_of_key(first + i, size, choices)
        choose[chosen, i] = 2.0 ** np.arange(len(chosen))
    numbers = np.arange(first, first + count, dtype=np.uint64)
    return _mixed(_mixed((bits @ choose).astype(np.uint64)) + numbers * np.uint64(_STEP))  # exact: sizes are under 53


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("fp").flatten().to_numpy(zero_copy_only=False).reshape(-1, SEEDS)


def _key_sketch(first: int, count: int, size: int, blocks: int, cells: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 4096):
                hashes = _keys_of(_matrix(batch.slice(at, 4096)), first, count, size, blocks).reshape(-1)
                yield sketch.record(sketch.payload(sketch.cell(hashes, cells), 0, 2))

    return run


def _repeated_keys(bitmap, first: int, count: int, size: int, blocks: int, cells: int):
    """``key, node, component, fp`` for the keys that the sketch saw twice or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 4096):
                part = batch.slice(at, 4096)
                hashes = _keys_of(_matrix(part), first, count, size, blocks).reshape(-1)
                hit = np.flatnonzero(sketch.test(bitmap.value, hashes, cells))
                owner = pa.array(hit // count)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hashes[hit].view(np.int64)), *(part.column(c).take(owner) for c in ("node", "component", "fp"))],
                    ["key", "node", "component", "fp"],
                )

    return run


def close_pairs(nodes: np.ndarray, labels: np.ndarray, prints: np.ndarray, apart: int, every: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of a list of different components that differ in ``apart`` bits, or ``BITS`` of the first fingerprint, or fewer:
    all of them, or a spanning forest."""
    left, front = np.arange(len(nodes)), []
    while len(left):
        if not front:
            front, left = [int(left[0])], left[1:]
            continue
        i = front.pop()
        differing = np.bitwise_count(prints[left] ^ prints[i])
        near = left[(differing[:, 0] <= BITS) | (differing.sum(axis=1) <= apart)]
        pairs = near[labels[near] != labels[i]]
        yield np.full(len(pairs), nodes[i]), nodes[pairs]
        if not every:
            front += near.tolist()
            left = left[~np.isin(left, near, assume_unique=True)]


def _candidates(apart: int, every: bool):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for members in batch["members"]:
                nodes = np.array([m["node"] for m in members], dtype=np.int64)
                labels = np.array([m["component"] for m in members], dtype=np.int64)
                if (labels == labels[0]).all():
                    continue
                prints = np.array([m["fp"] for m in members], dtype=np.int64).view(np.uint64)
                for u, v in close_pairs(nodes, labels, prints, apart, every):
                    if len(u):
                        yield pd.DataFrame({"u": np.minimum(u, v), "v": np.maximum(u, v)})

    return run


def _node_sketch(cells: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = np.frombuffer(b"".join(x[:8] for x in batch.column(0).to_pylist()), dtype="<u8")
            yield sketch.record(sketch.payload(sketch.cell(hashes, cells), 0, 1))

    return run


def _wanted_sets(bitmap, cells: int, width: int):
    """``digest, shingles`` of the texts whose digest may be wanted, each once a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, "text"):
            found = {}
            for text in batch.column("text"):
                words = _words(text.as_buffer().to_pybytes())
                found[hashlib.md5(b" ".join(words), usedforsecurity=False).digest()] = words
            digests = list(found)
            hashes = np.frombuffer(b"".join(d[:8] for d in digests), dtype="<u8")
            chosen = [digests[i] for i in np.flatnonzero(sketch.test(bitmap.value, hashes, cells))] if digests else []
            sets = [shingles(found[d], width).view(np.int64) for d in chosen]
            yield pa.RecordBatch.from_arrays([pa.array(chosen, pa.binary()), pa.array(sets, pa.list_(pa.int64()))], ["digest", "shingles"])

    return run


def _similar(similarity: float):
    """Pairs whose sets have the Jaccard similarity, counted exactly."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stays = []
            for a, b in zip(batch.column("a"), batch.column("b"), strict=True):
                a, b = (x.values.to_numpy(zero_copy_only=False).view(np.uint64) for x in (a, b))
                places = np.minimum(np.searchsorted(a, b), len(a) - 1)
                both = int((a[places] == b).sum())
                stays.append(both >= similarity * (len(a) + len(b) - both))
            yield batch.filter(pa.array(stays, pa.bool_())).select(["u", "v"])

    return run


def _links(docs: DataFrame, nodes: DataFrame, count: int, plan: tuple[int, int, int, int], width: int, similarity: float, every: bool) -> DataFrame:
    """``u, v``: pairs of ``nodes`` of different components that share a key and have the similarity."""
    spark = docs.sparkSession
    first, stop, size, blocks = plan
    pairs = None
    at_once = max(1, sketch.MOST_CELLS // (8 * max(1, count)))  # as many keys at a time as the sketch can tell apart
    sure = min(stop, len(block_choices(blocks, BITS)))  # the blocks in passes of their own, so that no bitmap grows by them
    passes = [(at, min(at_once, end - at)) for start, end in ((first, sure), (sure, stop)) for at in range(start, end, at_once)]
    for start, many in passes:
        cells = sketch.cells_for(many * count, 8)
        prints = nodes.select("fp").mapInArrow(_key_sketch(start, many, size, blocks, cells), sketch.PAYLOAD)
        twice = spark.sparkContext.broadcast(sketch.merged(prints, cells, 1, 2))
        keyed = nodes.mapInArrow(_repeated_keys(twice, start, many, size, blocks, cells), "key long, node long, component long, fp array<long>")
        rows = keyed.select("key", F.struct("node", "component", "fp").alias("member"))
        lists = bucket_lists(rows, "key", "member", _LIST)
        new = written(lists.mapInPandas(_candidates(most_apart(similarity), every), "u long, v long").distinct(), "pairs")
        twice.unpersist()
        pairs = new if pairs is None else pairs.union(new)
    pairs = pairs.distinct()
    wanted = pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    wanted = written(wanted.join(nodes.select("node", "digest"), "node"), "wanted")
    cells = sketch.cells_for(wanted.count(), 16)
    bitmap = spark.sparkContext.broadcast(sketch.merged(wanted.select("digest").mapInArrow(_node_sketch(cells), sketch.PAYLOAD), cells, 1, 1))
    found = docs.select("text").mapInArrow(_wanted_sets(bitmap, cells, width), "digest binary, shingles array<long>").dropDuplicates(["digest"])
    sets = written(wanted.join(found, "digest").select("node", "shingles"), "shingles")
    bitmap.unpersist()
    a, b = sets.toDF("u", "a"), sets.toDF("v", "b")
    return written(pairs.join(a, "u").join(b, "v").select("u", "v", "a", "b").mapInArrow(_similar(similarity), "u long, v long"), "links")


def _labelled(nodes: DataFrame, links: DataFrame) -> DataFrame:
    found = components(links).toDF("_node", "_component")
    joined = nodes.drop("component").join(found, F.col("node") == F.col("_node"), "left")
    return joined.select("node", F.coalesce("_component", "node").alias("component"), "fp", "digest", "first")


def one_of_each(docs: DataFrame, width: int = 5, similarity: float = 0.8) -> DataFrame:
    """The row of ``docs`` with the smallest id (then text hash) of each component of near duplicates.

    Two texts are linked if the Jaccard similarity of their sets of ``width``-word shingles is ``similarity`` or more;
    words are those of ``simhash_dedup``. Texts of equal words are one node; those without words are copies of each
    other. A pair that is linked has the similarity; that each such pair is found is sure where the first fingerprints differ in
    ``BITS`` bits or fewer, and likely elsewhere (see the README).
    A null id sorts first. Rows that repeat id and text stay once. All columns pass through.
    """
    base = texts(docs).select("doc_id", F.col("text").cast("binary").alias("text"), F.xxhash64("doc_id", "text").alias("text_hash"))
    run, schema = _prints(dict(docs.dtypes)["doc_id"], width)
    rows = base.mapInArrow(run, schema)
    place = F.struct(F.col("doc_id").alias("id"), F.col("text_hash").alias("of"))
    classes = rows.groupBy("digest").agg(F.min(place).alias("first"), F.first("fp").alias("fp"))
    nodes = written(classes.select(F.monotonically_increasing_id().alias("node"), "digest", "first", "fp"), "nodes")
    nodes = nodes.select("node", F.col("node").alias("component"), "fp", "digest", "first")
    worded = nodes.filter("fp is not null")
    count = worded.count()
    size, keys = key_plan(count, similarity)
    blocks = max(BLOCKS, block_count(count, BITS))
    sure = len(block_choices(blocks, BITS))
    links = _links(base, worded, count, (0, sure + FIRST, size, blocks), width, similarity, every=False)
    joined = written(_labelled(worded, links), "joined")
    more = _links(base, joined, count, (0, sure + keys, size, blocks), width, similarity, every=True)
    final = _labelled(nodes, links.union(more))
    stays = final.groupBy("component").agg(F.min("first").alias("at")).select(F.col("at.id").alias("_id"), F.col("at.of").alias("_of"))
    hashed = docs.withColumn("_hash", F.xxhash64("doc_id", F.coalesce("text", F.lit(""))))
    same = hashed["doc_id"].eqNullSafe(stays["_id"]) & (hashed["_hash"] == stays["_of"])
    return hashed.join(stays, same, "left_semi").dropDuplicates(["doc_id", "_hash"]).drop("_hash")
