"""Flattening and rebuilding of plain rows, an Arrow batch at a time.

Messages of one producer differ in their values, hardly in their keys.  What a row's keys and brackets (its shape) mean is worked
out once for each shape; values are then cut out of, or put between, the texts of a batch by array operations.

Only rows that need no closer look are done: a row gets NULL where a text has escapes, keys are empty, repeated, dotted or not
ASCII, numbers are not written as usual, or paths disagree or leave gaps.  The operators settle those by their own expressions.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Longer texts, and rows of more leaves, are left to the expressions: batches stay small, and so do kept shapes.
MOST_BYTES = 1 << 14
MOST_LEAVES = 1 << 10
_SHAPES = 512

# The place of a value in a shape; no JSON text has it outside of strings, and none unescaped in them.
_PLACE = "\0"
_STRUCTURE = np.zeros(256, dtype=bool)
_STRUCTURE[list(b"{}[],: \t\r\n")] = True

_TYPES = ("STRING", "BIGINT", "DOUBLE", "BOOLEAN", "VOID")
_STRING, _BIGINT, _DOUBLE, _BOOLEAN, _VOID = range(5)
_WHOLE = r"^(?:0|-?[1-9][0-9]{0,17})$"
# Of so few digits, and between these numbers, every decimal is the shortest text of its double.
_FRACTION = r"^-?[0-9]{1,7}\.[0-9]{1,8}$"
_LEAST, _MOST = 1e-3, 1e7

_LEAF = pa.struct([("path", pa.string()), ("leaf_type", pa.string()), ("value", pa.string())])
# A character that JSON text may only carry in escaped form.
_NEEDS_ESCAPE = "[\"\\\\\\x00-\\x1f]"


def leaves_of(text: Column, nulls: str, policies: Sequence[str]) -> Column:
    """The leaves of valid JSON texts as ``flat`` has them; NULL for those not done here."""

    @F.arrow_udf("array<struct<path:string,leaf_type:string,value:string>>")
    def call(texts: pa.Array) -> pa.Array:
        return flat_batch(texts, include=nulls == policies[0], exclude=nulls == policies[1])

    return call(F.when(F.octet_length(text) <= MOST_BYTES, text))


def text_of(flat: Column) -> Column:
    """The JSON texts of leaves; NULL for those not done here."""

    @F.arrow_udf("string")
    def call(flats: pa.Array) -> pa.Array:
        return text_batch(flats)

    return call(F.when(F.size(flat) <= MOST_LEAVES, flat))


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, and where each begins and the last ends."""
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    data = np.zeros(0, dtype=np.uint8) if data is None else np.frombuffer(data, dtype=np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def _from_bytes(kind: pa.DataType, data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    buffers = [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))]
    return pa.Array.from_buffers(kind, len(offsets) - 1, buffers)


def _between(starts: np.ndarray, ends: np.ndarray, size: int) -> np.ndarray:
    """Whether a byte is in one of the spans, which do not overlap."""
    edge = np.zeros(size + 1, dtype=np.int8)
    edge[starts] += 1
    edge[ends] -= 1
    return np.cumsum(edge[:-1], dtype=np.int8).view(bool)


def _starts(counts: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(counts)))


def _ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``start, start + 1, …``, so many for each row, one row after the other."""
    begins = _starts(counts)
    return np.arange(begins[-1]) + np.repeat(starts - begins[:-1], counts)


def _np(mask: pa.Array) -> np.ndarray:
    return pc.fill_null(mask, False).to_numpy(zero_copy_only=False)


@lru_cache(_SHAPES)
def flat_shape(shape: bytes) -> tuple[tuple[str, ...], tuple[int, ...]] | None:
    """Paths of a shape in order, and which value each has; None if it needs a closer look."""
    pieces = shape.decode().split(_PLACE)
    text = "".join(f"{piece}{i}" for i, piece in enumerate(pieces[:-1])) + pieces[-1]
    try:
        found = list(_paths("", json.loads(text, object_pairs_hook=_object)))
    except (ValueError, RecursionError):
        return None
    return tuple(path for path, _ in found), tuple(i for _, i in found)


def _object(pairs: list[tuple[str, object]]) -> dict[str, object]:
    keys = dict(pairs)
    if len(keys) < len(pairs) or not all(k and k.isascii() and "." not in k for k in keys):
        raise ValueError("keys need a closer look")
    return keys


def _paths(path: str, node) -> Iterator[tuple[str, int]]:
    if not isinstance(node, (dict, list)):
        yield path, node
        return
    for key, child in sorted(node.items()) if isinstance(node, dict) else enumerate(node):
        yield from _paths(f"{path}.{key}" if path else str(key), child)


def flat_batch(texts: pa.Array, include: bool = True, exclude: bool = False) -> pa.Array:
    """``flat`` of each text, or NULL."""
    opens = pc.or_(pc.starts_with(texts, "{"), pc.starts_with(texts, "["))
    even = pc.equal(pc.bit_wise_and(pc.count_substring(texts, '"'), 1), 0)
    plain = _np(pc.and_(pc.and_(opens, even), pc.invert(pc.match_substring(texts, "\\"))))
    data, offsets = _bytes(texts.filter(pa.array(plain)))
    inside = np.bitwise_xor.accumulate((data == ord('"')).view(np.uint8)).view(bool)
    marks = np.flatnonzero(np.take(_STRUCTURE, data) & ~inside)
    # what stands between two marks is a key or a value; every row begins with a mark
    starts, ends = marks + 1, np.append(marks[1:], len(data))[: len(marks)]
    followed = np.append(data[marks[1:]], 0)[: len(marks)]
    value = (ends > starts) & (followed != ord(":"))
    starts, ends = starts[value], ends[value]
    first = np.searchsorted(starts, offsets)
    counts = np.diff(first)

    masked = data.copy()
    masked[starts] = 0
    rest = _between(starts + 1, ends, len(data))  # values without their first byte
    shapes = masked[~rest]
    removed = _starts(ends - starts - 1)
    encoded = _from_bytes(pa.binary(), shapes, offsets - removed[first]).dictionary_encode()
    of_row = encoded.indices.to_numpy()
    plans = [flat_shape(shape) for shape in encoded.dictionary.to_pylist()]

    kinds, values = _typed_values(data, starts, ends, rest, include)
    odd = _starts((kinds < 0) | (kinds == _VOID) & exclude)
    known = [((), ()) if plan is None else plan for plan in plans]
    length = np.array([-1 if plan is None else len(plan[0]) for plan in plans], dtype=np.int64)
    done = (length[of_row] == counts) & (odd[first[1:]] == odd[first[:-1]])

    rows, leaves = of_row[done], counts[done]
    at = _ragged(_starts([len(paths) for paths, _ in known])[:-1][rows] if len(rows) else rows, leaves)
    order = np.array([i for _, numbers in known for i in numbers], dtype=np.int64)
    paths = pa.array([path for paths, _ in known for path in paths], pa.string())
    source = np.repeat(first[:-1][done], leaves) + order[at]
    kind = kinds[source]
    types = pa.array(_TYPES if include or exclude else (*_TYPES[:_VOID], "STRING"), pa.string())
    flat = pa.StructArray.from_arrays([paths.take(pa.array(at)), types.take(pa.array(kind)), values.take(pa.array(source))], fields=list(_LEAF))

    sizes = np.zeros(len(texts), dtype=np.int64)
    filled = np.zeros(len(texts), dtype=bool)
    filled[np.flatnonzero(plain)[done]] = True
    sizes[filled] = leaves
    return pa.ListArray.from_arrays(pa.array(_starts(sizes), pa.int32()), flat, mask=pa.array(~filled))


def _typed_values(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, rest: np.ndarray, include: bool) -> tuple[np.ndarray, pa.Array]:
    """Type (negative: not known here) and text of the values between these places; ``rest`` is where they have further bytes."""
    quoted = (data[starts] == ord('"')) & (data[ends - 1] == ord('"')) & (ends - starts > 1)
    written = rest.copy()
    written[starts[~quoted]] = True
    written[ends[quoted] - 1] = False
    texts = _from_bytes(pa.string(), data[written], _starts(ends - starts - 2 * quoted))
    kinds = np.where(quoted, _STRING, -1).astype(np.int8)
    bare = np.flatnonzero(~quoted)
    words = texts.take(pa.array(bare))
    whole = _np(pc.match_substring_regex(words, _WHOLE))
    kinds[bare[whole]] = _BIGINT
    bare, words = bare[~whole], words.filter(pa.array(~whole))
    fraction = _np(pc.match_substring_regex(words, _FRACTION))
    numbers = words.filter(pa.array(fraction))
    size = np.abs(pc.cast(numbers, pa.float64()).to_numpy(zero_copy_only=False))
    usual = ((size >= _LEAST) & (size < _MOST)) | ((size == 0) & ~_np(pc.starts_with(numbers, "-")))
    kinds[bare[fraction]] = np.where(usual, _DOUBLE, -1)
    kinds[bare[_np(pc.is_in(words, pa.array(["true", "false"])))]] = _BOOLEAN
    kinds[bare[_np(pc.equal(words, "null"))]] = _VOID
    # fractions without the zeros at their end, and a place for what nulls become
    pool = pa.concat_arrays([texts, pc.replace_substring_regex(numbers, r"(\.[0-9]+?)0+$", r"\1"), pa.array([None if include else ""], pa.string())])
    source = np.arange(len(texts))
    source[bare[fraction]] = len(texts) + np.arange(len(numbers))
    source[kinds == _VOID] = len(pool) - 1
    return kinds, pool.take(pa.array(source))


@lru_cache(_SHAPES)
def text_shape(paths: tuple[str | None, ...]) -> tuple[tuple[int, ...], tuple[str, ...]] | None:
    """Which leaf comes when, and the texts before, between and after them; None if the paths need a closer look."""
    if any(path is None or not path.isprintable() or '"' in path or "\\" in path for path in paths):
        return None
    leaves = sorted((_tokens(path), i) for i, path in enumerate(paths))
    pieces, before = [], []
    for tokens, _ in leaves:
        level = next((j for j, t in enumerate(tokens) if j >= len(before) or t != before[j]), None)
        if level is None or (before and (level >= len(before) or tokens[level][0] != before[level][0])):
            return None
        expected = before[level][1] + 1 if before else 0
        if any(is_position and at != (expected if j == 0 else 0) for j, (is_position, at, _) in enumerate(tokens[level:])):
            return None
        here, *deeper = tokens[level:]
        pieces.append(
            (_closed(before[level + 1 :]) + "," if before else "{") + ("" if here[0] else f'"{here[2]}":')
            + "".join("[" if is_position else '{"' + key + '":' for is_position, _, key in deeper)
        )
        before = tokens
    return tuple(i for _, i in leaves), (*pieces, _closed(before[1:]) + "}" if before else "{}")


def _tokens(path: str) -> list[tuple[bool, int, str]]:
    """Whether a segment is an array position, which one, and its key: keys sort first, like those of ``path_tokens``."""
    tokens: list[tuple[bool, int, str]] = []
    for segment in path.split("."):
        is_position = bool(tokens) and not tokens[-1][0] and segment.isascii() and segment.isdigit()
        tokens.append((True, int(segment[:10]) if len(segment) < 10 else 2**40, "") if is_position else (False, 0, segment))
    return tokens


def _closed(tokens: list[tuple[bool, int, str]]) -> str:
    return "".join("]" if is_position else "}" for is_position, _, _ in reversed(tokens))


def text_batch(flats: pa.Array) -> pa.Array:
    """The document of each ``flat``, or NULL."""
    lists = flats.filter(flats.is_valid())
    leaves = lists.flatten()
    begins = _starts(pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    path, kind, value = (pc.struct_field(leaves, name) for name in ("path", "leaf_type", "value"))
    encoded = path.dictionary_encode(null_encoding="encode")
    names = encoded.dictionary.to_pylist()
    codes = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int32)
    rows = _from_bytes(pa.binary(), codes.view(np.uint8), begins * 4).dictionary_encode()
    of_row = rows.indices.to_numpy(zero_copy_only=False)
    plans = [text_shape(tuple(names[c] for c in np.frombuffer(row, dtype=np.int32))) for row in rows.dictionary.to_pylist()]

    quoted = pc.fill_null(pc.equal(kind, "STRING"), False)
    odd = pc.or_(pc.match_substring_regex(value, _NEEDS_ESCAPE), pc.is_in(value, pa.array(["Infinity", "-Infinity"])))
    odd = _starts(_np(pc.or_(pc.fill_null(odd, False), pc.and_(quoted, pc.is_null(value)))))
    texts = pc.if_else(quoted, pc.binary_join_element_wise('"', value, '"', ""), pc.fill_null(value, "null"))
    done = np.array([plan is not None for plan in plans], dtype=bool)[of_row] & (odd[begins[1:]] == odd[begins[:-1]])

    # pieces and values by turns; put one after the other they are the documents
    known = [((), ("",)) if plan is None else plan for plan in plans]
    pieces = pa.array([piece for _, made in known for piece in made], pa.string())
    order = np.array([i for numbers, _ in known for i in numbers], dtype=np.int64)
    shape, counts = of_row[done], np.diff(begins)[done]
    orders = _starts([len(numbers) for numbers, _ in known])
    at = _ragged(orders[shape] if len(shape) else shape, counts)
    ends = _starts(counts * 2 + 1)
    turns = np.zeros(ends[-1], dtype=np.int64)
    places = np.repeat(np.arange(len(counts)), counts)
    behind = np.arange(len(at)) * 2 + places  # a document has one piece more than values
    turns[behind] = at + np.repeat(shape, counts)
    turns[behind + 1] = len(pieces) + np.repeat(begins[:-1][done], counts) + order[at]
    turns[ends[1:] - 1] = orders[1:][shape] + shape if len(shape) else shape
    data, offsets = _bytes(pa.concat_arrays([pieces, texts]).take(pa.array(turns)))
    made = _from_bytes(pa.string(), data, offsets[ends])
    nth = np.full(len(flats), -1)
    nth[np.flatnonzero(_np(flats.is_valid()))[done]] = np.arange(len(made))
    return made.take(pa.array(nth, mask=nth < 0))
