"""Near duplicates by SimHash: fingerprints that differ in few bits are linked through shared blocks."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pathweave.llm.components import components
from pathweave.llm.scratch import texts, written
from pathweave.llm.tiles import bucket_lists

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_AT_ONCE = 1 << 18
_LIST = 16384


def _fingerprint(text: bytes, width: int) -> int:
    words = text.translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    starts = np.concatenate(([0], np.cumsum(lengths[:-1] + 1)))
    last = max(0, len(words) - width)
    ends = (starts + lengths)[min(width, len(words)) - 1:]
    digest, counts = xxhash.xxh64_intdigest, np.zeros(64, dtype=np.int64)
    for at in range(0, last + 1, _AT_ONCE):
        pairs = zip(starts[at:min(at + _AT_ONCE, last + 1)].tolist(), ends[at:at + _AT_ONCE].tolist(), strict=True)
        hashes = np.fromiter((digest(joined[a:b], 42) for a, b in pairs), dtype=">u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    bits = np.packbits(counts * 2 > last + 1)
    return int.from_bytes(bits.tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, width: int = 4) -> DataFrame:
    """``doc_id, fp``: the 64 bits as a signed long; zero where a text has no words."""
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_fingerprint(x.as_buffer().to_pybytes(), width) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int64())], ["doc_id", "fp"])

    rows = texts(docs).select("doc_id", F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, fp long")


def block_count(distinct: int, bits: int) -> int:
    """Blocks to cut a fingerprint into, so that a join key has at least two bits more than the count of fingerprints.

    With ``bits`` differing bits at most, some ``blocks - bits`` blocks of a linked pair are equal, whatever the
    count; more blocks only make longer keys, and more of them.
    """
    blocks = bits + 2
    while blocks < bits + 5 and 64 * (blocks - bits) // blocks < distinct.bit_length() + 2:
        blocks += 1
    return blocks


def block_choices(blocks: int, bits: int) -> list[list[int]]:
    """The bits of each choice of ``blocks - bits`` blocks: fingerprints that differ in ``bits`` bits or fewer agree in one of them."""
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    return [[b for c in chosen for b in range(edges[c], edges[c + 1])] for chosen in combinations(range(blocks), blocks - bits)]


def _keys(fp: Column, blocks: int, bits: int) -> Column:
    """Array of keys: each choice of ``blocks - bits`` blocks of the fingerprint, the others masked out."""
    keys = []
    for n, chosen in enumerate(block_choices(blocks, bits)):
        mask = sum(1 << b for b in chosen)
        signed = mask - (1 << 64) if mask >> 63 else mask
        keys.append(F.struct(F.lit(n).alias("n"), fp.bitwiseAND(F.lit(signed)).alias("bits")))
    return F.array(*keys)


def _forest(bits: int):
    """A spanning forest of the links within each list, so that a list gives fewer edges than it has members."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            first, second = [], []
            for members in batch["members"]:
                left = np.asarray(members, dtype=np.int64)
                front = left[:0]
                while len(left):
                    if not len(front):
                        front, left = left[:1], left[1:]
                    at, front = front[0], front[1:]
                    near = np.bitwise_count((left ^ at).view(np.uint64)) <= bits
                    found = left[near]
                    first.extend([at] * len(found))
                    second.extend(found)
                    front, left = np.concatenate((front, found)), left[~near]
            yield pd.DataFrame({"u": np.array(first, dtype=np.int64), "v": np.array(second, dtype=np.int64)})

    return run


def links(distinct: DataFrame, bits: int = 4) -> DataFrame:
    """``u, v``: links among the distinct fingerprints in ``fp`` that span the same components as all links do."""
    blocks = block_count(distinct.count(), bits)
    keyed = distinct.select("fp", F.explode(_keys(F.col("fp"), blocks, bits)).alias("key"))
    lists = bucket_lists(keyed, "key", "fp", _LIST)
    return lists.mapInPandas(_forest(bits), "u long, v long")


def near_duplicates(docs: DataFrame, width: int = 4, bits: int = 4) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, fingerprint, component_id``.

    Texts are lower-cased in A-Z and cut into words at ASCII white space; shingles of ``width`` words, repeats
    included, vote on 64 bits. Fingerprints that differ in ``bits`` bits or fewer are linked; the component is
    the smallest ``doc_id`` that can be reached. Copies share a fingerprint and are linked once, as one node.

    A null or empty text has no words and the fingerprint zero, linked like any other. Repeated rows are
    reported as often as they occur. A null id is never a component's id unless nothing else is in it, and then
    the id is null. Other columns are ignored; an empty table gives no rows.
    """
    rows = written(fingerprints(docs, width), "fingerprints")
    classes = rows.groupBy("fp").agg(F.min("doc_id").alias("first"))
    found = components(links(classes.select("fp"), bits))
    labelled = classes.join(found, classes["fp"] == found["node"], "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("component")
    )
    least = labelled.groupBy("component").agg(F.min("first").alias("component_id"))
    by_print = written(labelled.join(least, "component").select("fp", "component_id"), "simhash-classes")
    return rows.join(by_print, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
