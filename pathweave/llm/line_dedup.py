"""Fuzzy deduplication of lines: MinHash over character shingles, exact check, one line per component.

Lines are compared as keys first (equal normalised lines are one key), then as sets of character shingles. The
first pass writes a signature for each line; a merged sketch tells which bands occur twice or more, so that only
those rows are shuffled. Keys that share a band are compared by exact Jaccard similarity, and the links
that hold are joined by distributed union-find.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathweave.functions.columns import named
from pathweave.llm import sketch
from pathweave.llm.batches import bounded
from pathweave.llm.components import components
from pathweave.llm.scratch import written
from pathweave.llm.tiles import bucket_lists

SHINGLE = 8
SIMILARITY = 0.8
#: 8 bands of 4 rows find a pair at similarity 0.8 with probability 0.985, at 0.9 with 0.9998.
BANDS, ROWS = 8, 4
#: The signature's values come from so many hash functions, each split into bins; an empty bin borrows from the next.
FUNCTIONS = 2
#: Bins are a power of two, so that a bin is the upper bits of a hash.
_BIN_BITS = (BANDS * ROWS // FUNCTIONS).bit_length() - 1
_LIST = 4096
#: Lists of so many lines at most are compared as sets of Python, many lists at a time.
_SHORT = 16
#: Characters compared at a time, and signed at a time: few enough that the work arrays stay in a core's cache.
_AT_ONCE = 1 << 17
_SIGNED = 1 << 15
#: All white space other than blanks and line feeds.
_ODD_SPACES = "".join(c for c in map(chr, range(0x110000)) if c.isspace() and c not in " \n")
_ODD_ASCII = "".join(c for c in _ODD_SPACES if c.isascii())
_STEP = 0x9E3779B97F4A7C15
_MIX = (np.uint64(_STEP), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def normalised(line: str) -> str:
    return " ".join(line.split()).lower()


def normalised_lines(text: str) -> list[str]:
    """``normalised`` of every line of the text."""
    if any(c in text for c in (_ODD_ASCII if text.isascii() else _ODD_SPACES)):
        return [normalised(line) for line in text.split("\n")]
    # only blanks can be too many here; few lines have two in a row
    return [" ".join(line.split()) if "  " in line else line.strip(" ") for line in text.lower().split("\n")]


def line_key(line: str) -> bytes:
    return hashlib.md5(line.encode("utf-8", "surrogatepass"), usedforsecurity=False).digest()


def _times(factor: int, n: int) -> np.uint64:
    return np.uint64(factor * n & 0xFFFFFFFFFFFFFFFF)


def _mixed(x: np.ndarray) -> np.ndarray:
    y = x >> np.uint64(30)
    y ^= x
    y *= _MIX[1]
    shifted = y >> np.uint64(27)
    y ^= shifted
    y *= _MIX[2]
    np.right_shift(y, np.uint64(31), out=shifted)
    y ^= shifted
    return y


def shingle_hashes(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all shingles of the lines, one after the other, and the line that each is of.

    A line shorter than a shingle is padded to one, so every line has at least one.
    """
    counts = np.maximum(np.array([len(x) for x in lines], dtype=np.int64), SHINGLE)
    padded = "".join(x if len(x) >= SHINGLE else x.ljust(SHINGLE, "\0") for x in lines)
    if padded.isascii():
        h = np.frombuffer(padded.encode("ascii"), dtype=np.uint8).astype(np.uint64)
    else:
        h = np.frombuffer(padded.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    factor, span = _STEP, 1
    while span < SHINGLE:  # hash of 2, 4, 8 characters from each place
        h = h[:-span] * np.uint64(factor) + h[span:]
        factor, span = int(_times(factor, factor)), 2 * span
    ends = np.cumsum(counts) - SHINGLE
    inside = np.ones(len(h), dtype=bool)
    for back in range(1, SHINGLE):  # places whose shingle would reach into the next line
        inside[ends[:-1] + back] = False
    return _mixed(h[inside]), np.repeat(np.arange(len(lines)), counts - SHINGLE + 1)


def signatures(lines: list[str], most: int = _SIGNED) -> np.ndarray:
    """A row of ``BANDS`` 64-bit band hashes for each normalised, non-empty line.

    The work arrays hold about ``most`` characters at a time, or those of one longer line.
    """
    out, start, size = [np.zeros((0, BANDS), dtype=np.uint64)], 0, 0
    for i, line in enumerate(lines):
        if i > start and size + len(line) > most:
            out.append(_signatures(lines[start:i]))
            start, size = i, 0
        size += len(line)
    if start < len(lines):
        out.append(_signatures(lines[start:]))
    return np.concatenate(out)


def _signatures(lines: list[str]) -> np.ndarray:
    h, owner = shingle_hashes(lines)
    bins = BANDS * ROWS // FUNCTIONS
    base, out = owner * bins, []
    for f in range(FUNCTIONS):
        mixed = _mixed(h + _times(_STEP, f + 1)) if f else h
        place = base + (mixed >> np.uint64(64 - _BIN_BITS)).view(np.int64)
        least = np.full(len(lines) * bins, np.uint64(0xFFFFFFFFFFFFFFFF))
        np.minimum.at(least, place, mixed * _MIX[2])
        least = least.reshape(-1, bins)
        empty = least == np.uint64(0xFFFFFFFFFFFFFFFF)
        for step in range(1, bins):
            if not empty.any():
                break
            other = np.roll(least, -step, axis=1)
            use = empty & (other != np.uint64(0xFFFFFFFFFFFFFFFF)) & ~np.roll(empty, -step, axis=1)
            least = np.where(use, other + np.uint64(step), least)
            empty = empty & ~use
        out.append(least)
    values = np.concatenate(out, axis=1)  # a band takes its values from all functions in turn
    bands = np.tile(np.array([_times(_STEP, b + 1) for b in range(BANDS)]), (len(lines), 1))
    for r in range(ROWS):
        bands = _mixed(bands ^ values[:, (r * bins + r // FUNCTIONS * BANDS + np.arange(BANDS)) % values.shape[1]]) + _MIX[0]
    return bands


def _lines_pass(kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, "text"):
            docs, numbers, keys, old, first = [], [], [], [], {}
            for d, text in enumerate(batch.column("text").to_pylist()):
                for n, line in enumerate(normalised_lines(text)):
                    if line:
                        key = line_key(line)
                        docs.append(d)
                        numbers.append(n)
                        keys.append(key)
                        old.append(key in first)
                        first.setdefault(key, line)
            bands = signatures(list(first.values())).view(np.int64) if first else None
            old = np.array(old, dtype=bool)  # the others take their bands in order
            offsets = np.concatenate(([0], np.cumsum(~old) * BANDS)).astype(np.int32)
            flat = pa.array(bands.reshape(-1) if first else [], pa.int64())
            rows = pa.ListArray.from_arrays(pa.array(offsets), flat, mask=pa.array(old))
            take = pa.array(docs, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(take), batch.column("text_hash").take(take), pa.array(numbers, pa.int32()),
                 pa.array(keys, pa.binary()), rows],
                ["doc_id", "text_hash", "line", "key", "bands"],
            )

    return run, f"doc_id {kind}, text_hash long, line int, key binary, bands array<long>"


def _band_sketch(cells: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = batch.column(0).flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            yield sketch.record(sketch.payload(sketch.cell(hashes, cells), 0, 2))

    return run


def _key_sketch(cells: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = np.frombuffer(b"".join(x[:8] for x in batch.column(0).to_pylist()), dtype="<u8")
            yield sketch.record(sketch.payload(sketch.cell(hashes, cells), 0, 1))

    return run


def _repeated_bands(bitmap, cells: int):
    """``band, key`` for the bands that the sketch saw twice or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("bands")
            hashes = lists.flatten().to_numpy(zero_copy_only=False)
            hit = np.flatnonzero(sketch.test(bitmap.value, hashes.view(np.uint64), cells))
            owner = np.repeat(np.arange(len(lists)), BANDS)[hit]
            yield pa.RecordBatch.from_arrays([pa.array(hashes[hit]), batch.column("key").take(pa.array(owner))], ["band", "key"])

    return run


def _wanted_lines(bitmap, cells: int):
    """``key, content`` of the lines whose key may be wanted, each once a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, "text"):
            found = {}
            for text in batch.column("text").to_pylist():
                for line in normalised_lines(text):
                    if line:
                        found[line_key(line)] = line
            keys = list(found)
            hashes = np.frombuffer(b"".join(k[:8] for k in keys), dtype="<u8")
            hit = np.flatnonzero(sketch.test(bitmap.value, hashes, cells)) if keys else []
            chosen = [keys[i] for i in hit]
            yield pa.RecordBatch.from_arrays([pa.array(chosen, pa.binary()), pa.array([found[k] for k in chosen], pa.string())], ["key", "content"])

    return run


def similar_edges(lines: list[str]) -> tuple[list[int], list[int]]:
    """A spanning forest of the links among a list's lines: exact Jaccard similarity of their sets of shingle hashes.

    From each line that is reached the lines not reached yet are compared at once; a line that is reached needs no
    further comparison with those reached before, since only components count.
    """
    hashes, owner = shingle_hashes(lines)
    sets = [np.unique(x) for x in np.split(hashes, np.flatnonzero(np.diff(owner)) + 1)]
    flat = np.concatenate(sets)
    sizes = np.array([len(x) for x in sets], dtype=np.int64)
    left, front, u, v = np.arange(len(lines)), [], [], []
    while len(left):
        if not front:
            front, flat, left = [int(left[0])], flat[sizes[left[0]]:], left[1:]
            continue
        i = front.pop()
        own = sets[i]
        hit = own[np.minimum(np.searchsorted(own, flat), len(own) - 1)] == flat
        both = np.add.reduceat(hit, np.cumsum(sizes[left]) - sizes[left], dtype=np.int64)
        near = both >= SIMILARITY * (len(own) + sizes[left] - both)
        if near.any():
            found = left[near].tolist()
            front += found
            u += [i] * len(found)
            v += found
            flat, left = flat[np.repeat(~near, sizes[left])], left[~near]
    return u, v


def short_edges(lists: list[list[str]]) -> Iterator[tuple[list[int], list[int]]]:
    """What ``similar_edges`` gives for each list, with the shingles of all lists hashed at once."""
    lines = [line for contents in lists for line in contents]
    hashes, owner = shingle_hashes(lines)
    stops = np.cumsum(np.bincount(owner, minlength=len(lines))).tolist()
    values = hashes.tolist()
    sets = (set(values[a:b]) for a, b in zip([0, *stops[:-1]], stops, strict=True))
    for contents in lists:
        own = [next(sets) for _ in contents]
        left, front, u, v = list(range(len(own))), [], [], []
        while left:
            i = front.pop() if front else left.pop(0)
            found = []
            for j in left:
                both = len(own[i] & own[j])
                if both >= SIMILARITY * (len(own[i]) + len(own[j]) - both):
                    found.append(j)
            front += found
            u += [i] * len(found)
            v += found
            left = [j for j in left if j not in found]
        yield u, v


def _edges(lists: Iterable[list[str]]) -> Iterator[tuple[list[int], list[int]]]:
    """The links of each list, in order."""
    waiting, size = [], 0
    for contents in lists:
        chars = sum(map(len, contents))
        short = len(contents) <= _SHORT and chars <= _AT_ONCE
        if waiting and not (short and size + chars <= _AT_ONCE):
            yield from short_edges(waiting)
            waiting, size = [], 0
        if short:
            waiting.append(contents)
            size += chars
        else:
            yield similar_edges(contents)
    if waiting:
        yield from short_edges(waiting)


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        u, v = [], []
        for keys, (first, second) in zip(batch.column("keys").to_pylist(), _edges(batch.column("contents").to_pylist()), strict=True):
            u += [keys[i] for i in first]
            v += [keys[i] for i in second]
        yield pa.RecordBatch.from_arrays([pa.array(u, pa.binary()), pa.array(v, pa.binary())], ["u", "v"])


def links(docs: DataFrame, lines: DataFrame) -> DataFrame:
    """``u, v``: pairs of line keys whose shingle sets have a Jaccard similarity of ``SIMILARITY`` or more."""
    context = docs.sparkSession.sparkContext
    signed = lines.filter("bands is not null")
    cells = sketch.cells_for(BANDS * signed.count(), 8)
    twice = sketch.merged(signed.select("bands").mapInArrow(_band_sketch(cells), sketch.PAYLOAD), cells, 1, 2)
    rows = signed.select("bands", "key").mapInArrow(_repeated_bands(context.broadcast(twice), cells), "band long, key binary").distinct()
    lists = written(bucket_lists(rows, "band", "key", _LIST).withColumn("list", F.monotonically_increasing_id()), "lists")
    wanted = lists.select("list", F.explode("members").alias("key"))
    cells = sketch.cells_for(wanted.count(), 16)
    keys = sketch.merged(wanted.select("key").mapInArrow(_key_sketch(cells), sketch.PAYLOAD), cells, 1, 1)
    found = docs.select("text").mapInArrow(_wanted_lines(context.broadcast(keys), cells), "key binary, content string")
    joined = wanted.join(found.dropDuplicates(["key"]), "key")
    grouped = joined.groupBy("list").agg(F.collect_list(F.struct("key", "content")).alias("lines"))
    return grouped.select(F.col("lines.key").alias("keys"), F.col("lines.content").alias("contents")).mapInArrow(_verified, "u binary, v binary")


def _rebuilt(names: list[str]):
    """Put the kept lines in place of the text; blank lines stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, totals, removed = [], [], []
            for text, kept in zip(batch.column("text").to_pylist(), batch.column("_kept").to_pylist(), strict=True):
                stays, total, gone, out = set(kept or ()), 0, 0, []
                for n, line in enumerate(text.split("\n")):
                    full = line != "" and not line.isspace()
                    total += full
                    if not full or n in stays:
                        out.append(line)
                    else:
                        gone += 1
                texts.append("\n".join(out) if gone else text)
                totals.append(total)
                removed.append(gone)
            new = {"text": pa.array(texts, pa.string()), "n_chars": pa.array([len(t) for t in texts], pa.int64()),
                   "n_lines": pa.array(totals, pa.int64()), "n_removed": pa.array(removed, pa.int64())}
            yield pa.RecordBatch.from_arrays([new[c] if c in new else batch.column(c) for c in names], names)

    return run


def dedup(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated lines removed from ``text``, and with ``n_chars, n_lines, n_removed``.

    Lines are split at line feeds and compared in lower case with white space runs as one space; of equal lines
    and of lines linked by similarity, the one at the smallest (doc_id, text hash, line number) stays, everywhere else
    it is removed. Blank lines always stay and are not counted. A document may become empty but is never dropped.

    A null text counts as empty and becomes an empty text. A null id sorts first. Rows that repeat id and text
    are one document: they get the same decisions. Extra columns pass through; those named like the four
    that are set here are replaced. An empty table gives no rows.
    """
    base = docs.select(
        *[named(c) for c in docs.columns if c not in ("text", "n_chars", "n_lines", "n_removed", "_kept", "_hash")],
        F.coalesce("text", F.lit("")).alias("text"),
    )
    hashed = base.withColumn("_hash", F.xxhash64("doc_id", "text"))
    run, schema = _lines_pass(dict(docs.dtypes)["doc_id"])
    lines = written(hashed.select("doc_id", "text", F.col("_hash").alias("text_hash")).mapInArrow(run, schema), "lines")
    place = F.struct("doc_id", "text_hash", "line")
    first = lines.groupBy("key").agg(F.min(place).alias("at"))
    found = components(links(base, lines))
    winners = (
        first.join(found, first["key"] == found["node"], "left")
        .groupBy(F.coalesce("component", "key").alias("component")).agg(F.min("at").alias("at"))
        .groupBy("at.doc_id", "at.text_hash").agg(F.collect_list("at.line").alias("_kept"))
        .select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_of"), "_kept")
    )
    same = hashed["doc_id"].eqNullSafe(winners["_id"]) & (hashed["_hash"] == winners["_of"])
    joined = hashed.join(winners.hint("shuffle_hash"), same, "left").drop("_id", "_of", "_hash")
    names = [c for c in joined.columns if c != "_kept"] + ["n_chars", "n_lines", "n_removed"]
    kinds = dict(joined.dtypes) | {"n_chars": "long", "n_lines": "long", "n_removed": "long"}
    return joined.mapInArrow(_rebuilt(names), ", ".join(f"`{c}` {kinds[c]}" for c in names))
