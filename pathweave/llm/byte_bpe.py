"""Byte-level BPE over a corpus: each distinct word is encoded once, wherever it occurs.

A block of documents is dictionary-coded: its distinct pre-tokens, and for each document the places of its
pre-tokens among them. Only the dictionaries travel: dealt by the word's hash to the task that encodes this word for
all blocks. The answers are joined to the blocks' places, and the ids are put together by position.
"""

from __future__ import annotations

import base64
import hashlib
import string
import zlib
from array import array
from collections.abc import Callable, Iterable, Iterator
from itertools import chain, pairwise

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
import tiktoken
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathweave.llm.batches import bounded
from pathweave.llm.scratch import texts

#: What a byte of UTF-8 says of its character: Latin letter, digit, mark, white space; nothing certain.
_ODD, _LETTER, _DIGIT, _MARK, _WHITE = range(5)
#: Latin letters beyond ASCII are two bytes, 0xC3 and one of 0x80 to 0xBF, without the two signs between them.
_LATIN = 0xC3
_SIGNS = (0x97, 0xB7)
#: Stretches of a block whose places are put together at a time, or places whose values are.
_AT_ONCE = 1 << 16
#: Bytes of text in a block.
_BLOCK = 4 << 20
_MEMO = 500_000
#: Requested words that are looked up at a time.
_REQUESTED = 1 << 17
_state: dict = {}


def ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ids of a rank file: a few ten thousand, whatever the corpus."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


def _pattern() -> regex.Pattern:
    """The public pattern, with white space as the tokenizer library has it."""
    space = r"\p{White_Space}"
    own = public_tokenizers.PATTERN.replace(r"[^\s\p{L}\p{N}]", rf"[^{space}\p{{L}}\p{{N}}]")
    return regex.compile(own.replace(r"(?!\S)", rf"(?!\P{{White_Space}})").replace(r"\s", space))


def _kind_of_byte() -> np.ndarray:
    kinds = np.full(256, _ODD, dtype=np.uint8)
    for kind, chars in ((_LETTER, string.ascii_letters), (_DIGIT, string.digits), (_MARK, string.punctuation.replace("'", "")), (_WHITE, " \t\n\x0b\x0c\r")):
        kinds[list(chars.encode())] = kind
    kinds[_LATIN] = _LETTER
    return kinds


_KIND = _kind_of_byte()


def _kinds(data: np.ndarray) -> np.ndarray:
    """Kind of each byte; both bytes of a Latin letter beyond ASCII are letters."""
    kinds = _KIND[data]
    after = np.flatnonzero(data[:-1] == _LATIN) + 1
    kinds[after[~np.isin(data[after], _SIGNS)]] = _LETTER
    return kinds


def _buffers(values: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """Offsets, from 0, and bytes of an array without nulls."""
    _, offsets, data = values.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[values.offset:values.offset + len(values) + 1] if len(values) else np.zeros(1, dtype=np.int64)
    return at - at[0], np.frombuffer(data or b"", dtype=np.uint8)[at[0]:at[-1]]


def _values(offsets: np.ndarray, data: np.ndarray) -> pa.LargeBinaryArray:
    own = np.ascontiguousarray(offsets, dtype=np.int64)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(own) - 1, [None, pa.py_buffer(own), pa.py_buffer(data)])


def _items(values: pa.LargeBinaryArray) -> list[bytes]:
    """The values, without a scalar for each."""
    offsets, data = _buffers(values)
    raw = data.tobytes()
    return [raw[a:b] for a, b in pairwise(offsets.tolist())]


def _texts(values: pa.LargeBinaryArray) -> list[str]:
    return [x.decode("utf-8", "surrogatepass") for x in _items(values)]


def _pre_tokens(stretches: pa.LargeBinaryArray, pattern: regex.Pattern) -> tuple[pa.LargeBinaryArray, np.ndarray, np.ndarray]:
    """What the pattern finds in the stretches, where each one's begin there, and how many they are.

    Latin letters, digits, marks without the apostrophe and white space are cut where the kind changes; of white space
    before something else the last character is parted from the others, and a space goes with what follows: as the
    pattern does. All other stretches go to the pattern; what they were cut into is still among the values, but belongs to none.
    """
    offsets, data = _buffers(stretches)
    kinds, odd = _kinds(data), np.zeros(len(stretches), dtype=bool)
    odd[np.searchsorted(offsets, np.flatnonzero(kinds == _ODD), side="right") - 1] = True
    begins = np.zeros(len(data) + 1, dtype=bool)
    begins[offsets] = True
    last_white = np.flatnonzero((kinds[:-1] == _WHITE) & (kinds[1:] != _WHITE) & ~begins[1:-1])
    begins[1:-1] |= kinds[1:] != kinds[:-1]
    begins[last_white] = True
    begins[last_white[data[last_white] == ord(" ")] + 1] = False
    cuts = np.flatnonzero(begins)
    starts = np.searchsorted(cuts, offsets)
    found, sizes, starts = _values(cuts, data), np.diff(starts), starts[:-1]
    if odd.any():
        own = [[w.encode("utf-8", "surrogatepass") for w in pattern.findall(t)] for t in _texts(stretches.filter(pa.array(odd)))]
        sizes[odd] = [len(x) for x in own]
        starts[odd] = len(found) + np.cumsum(sizes[odd]) - sizes[odd]
        found = pa.concat_arrays([found, pa.array([*chain.from_iterable(own)], pa.large_binary())])
    return found, starts, sizes


def _expanded(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places of the pre-tokens of some stretches, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1]) + np.repeat(starts - ends + sizes, sizes)


def _split_after_space(parts: Iterable[str], pattern: regex.Pattern) -> tuple[list[str], list[int]]:
    """What the pattern finds in each part with a space before it, one after the other, and how many in each."""
    found, starts, sizes = _pre_tokens(pa.array([(" " + part).encode() for part in parts], pa.large_binary()), pattern)
    return _texts(found.take(pa.array(_expanded(starts, sizes)))), sizes.tolist()


class _Block:
    """Distinct pre-tokens of some texts, in order of their first place, and the places of each text's pre-tokens among them.

    Texts are cut at single spaces between two characters that are no white space: the pattern always splits before
    these. A stretch between two cuts is split once a block.
    """

    def __init__(self, texts_: pa.Array | list[str], pattern: regex.Pattern) -> None:
        stretches = self._cut(texts_ if isinstance(texts_, pa.Array) else pa.array(texts_, pa.string()))
        found, starts, self._sizes = _pre_tokens(stretches, pattern)
        distinct = found.take(pa.array(_expanded(starts, self._sizes))).dictionary_encode()
        self._words = distinct.indices.to_numpy()
        self._starts = np.cumsum(self._sizes) - self._sizes
        self.encoded: pa.LargeBinaryArray = distinct.dictionary

    def _cut(self, column: pa.Array) -> pa.LargeBinaryArray:
        """The distinct stretches; those that don't begin a text have their space before them."""
        lists = pc.split_pattern(column, " ")
        parts = lists.flatten().dictionary_encode()
        at, distinct, n = parts.indices.to_numpy(), parts.dictionary, len(parts.dictionary)
        counts = pc.list_value_length(lists).to_numpy().astype(np.int64)
        first = np.zeros(len(at), dtype=bool)
        first[np.cumsum(counts) - counts] = True
        white_left, white_right = self._white_ends(distinct)
        begins = first.copy()
        begins[1:] |= ~(white_right[at[:-1]] | white_left[at[1:]])
        begin = np.flatnonzero(begins)
        code = at[begin] + np.where(first[begin], 0, n)
        size = np.diff(np.append(begin, len(at)))
        several = np.flatnonzero(size > 1)
        own = distinct.take(pa.array(at[_expanded(begin[several], size[several])]) if len(several) else pa.array([], pa.int64())).cast(pa.large_string())
        joined = pc.binary_join(pa.LargeListArray.from_arrays(np.append(0, np.cumsum(size[several])), own), pa.scalar(" ", pa.large_string()))
        space = pa.array(["", " "], pa.large_string()).take(pa.array((~first[begin[several]]).astype(np.int8)))
        longer = pc.binary_join_element_wise(space, joined, pa.scalar("", pa.large_string())).dictionary_encode()
        code[several] = 2 * n + longer.indices.to_numpy()
        longer = longer.dictionary
        used = np.zeros(2 * n + len(longer), dtype=bool)
        used[code] = True
        self._at = (np.cumsum(used) - 1).astype(np.uint32)[code]
        self._counts = np.diff(np.append(np.flatnonzero(first[begin]), len(begin)))
        leading, following = (distinct.take(pa.array(np.flatnonzero(x))).cast(pa.large_string()) for x in (used[:n], used[n:2 * n]))
        after_space = pc.binary_join_element_wise(pa.scalar("", pa.large_string()), following, pa.scalar(" ", pa.large_string()))
        return pa.concat_arrays([leading, after_space, longer]).cast(pa.large_binary())

    @staticmethod
    def _white_ends(parts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Whether a part is empty or begins with white space, and whether it is empty or ends with it."""
        values = parts.cast(pa.large_string()).cast(pa.large_binary())
        offsets, data = _buffers(values)
        kinds, empty = _kinds(data), np.diff(offsets) == 0
        full = np.flatnonzero(~empty)

        def white(byte: np.ndarray, char: slice) -> np.ndarray:
            doubt = full[kinds[byte] == _ODD]
            out = empty.copy()
            out[full] = kinds[byte] == _WHITE
            out[doubt] = [part[char].isspace() for part in _texts(values.take(pa.array(doubt)))]
            return out

        return white(offsets[full], slice(None, 1)), white(offsets[full + 1] - 1, slice(-1, None))

    @property
    def words(self) -> list[str]:
        return _texts(self.encoded)

    def places(self, number: np.ndarray | None = None) -> list[np.ndarray]:
        """Of each text; ``number``: other numbers of the words."""
        words = (self._words if number is None else number[self._words]).astype("<u4")
        out = []
        for begin in range(0, len(self._at), _AT_ONCE):
            at = self._at[begin:begin + _AT_ONCE]
            out.append(words[_expanded(self._starts[at], self._sizes[at])])
        sizes = np.add.reduceat(self._sizes[self._at], np.cumsum(self._counts) - self._counts)
        return np.split(np.concatenate(out), np.cumsum(sizes)[:-1])


def _block_id(words: pa.LargeBinaryArray) -> bytes:
    """Name of a block by its dictionary, so that both passes over the documents give it the same one."""
    offsets, data = _buffers(words)
    out = hashlib.blake2b(np.diff(offsets).astype("<u4").tobytes(), digest_size=16)
    out.update(data)
    return out.digest()


def _squeezed(numbers: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers, compressed byte plane by byte plane."""
    planes = numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def _numbers(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view("<u4")


def _pack(items: pa.LargeBinaryArray) -> bytes:
    offsets, data = _buffers(items)
    return zstandard.ZstdCompressor(level=3).compress(np.diff(offsets).astype("<u4").tobytes() + data.tobytes())


def _unpack(data: bytes, count: int) -> pa.LargeBinaryArray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8)
    ends = np.cumsum(raw[:4 * count].view("<u4").astype(np.int64))
    return _values(np.concatenate(([0], ends)), raw[4 * count:])


def _dealt(words: pa.LargeBinaryArray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """The words' places in order of their shards, and how many words each shard gets."""
    of = np.fromiter(map(zlib.crc32, _items(words)), dtype=np.int64, count=len(words)) % shards
    return np.argsort(of, kind="stable"), np.bincount(of, minlength=shards)


def _requests(shards: int):
    """Each block's dictionary, dealt to shards by the word's hash: ``shard, block, count, words``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern = _pattern()
        for batch in bounded(batches, "text", _BLOCK):
            words = _Block(batch.column("text"), pattern).encoded
            if not len(words):
                continue
            order, counts = _dealt(words, shards)
            asked, dealt = np.flatnonzero(counts), words.take(pa.array(order))
            own = [dealt.slice(a, n) for a, n in zip((np.cumsum(counts) - counts)[asked].tolist(), counts[asked].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(asked, pa.int32()), pa.array([_block_id(words)] * len(own), pa.binary()),
                 pa.array(counts[asked], pa.int32()), pa.array([_pack(w) for w in own], pa.binary())],
                ["shard", "block", "count", "words"],
            )

    return run


def _encoding(path: str) -> tiktoken.Encoding:
    if _state.get("path") != path:
        _state.update(path=path, encoding=tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks(path), special_tokens={}))
    return _state["encoding"]


def _answers(path: str):
    """The ids of every requested word; a word that several blocks ask for is encoded once in its task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, known = _encoding(path), {}

        def ids(word: bytes) -> bytes:
            got = known.get(word)
            if got is None:
                got = known[word] = array("I", encoding.encode_ordinary(word.decode("utf-8", "surrogatepass"))).tobytes()
            return got

        for batch in batches:
            if not batch.num_rows:
                continue
            counts = batch.column("count").to_numpy().astype(np.int64)
            for rows in np.split(np.arange(len(counts)), np.flatnonzero(np.diff(np.cumsum(counts) // _REQUESTED)) + 1):
                if len(known) > _MEMO:
                    known.clear()
                own = batch.slice(rows[0], len(rows))
                asked = pa.concat_arrays([_unpack(*x) for x in zip(own.column("words").to_pylist(), counts[rows].tolist(), strict=True)]).dictionary_encode()
                given = pa.array([*map(ids, _items(asked.dictionary))], pa.large_binary()).take(asked.indices)
                ends = np.cumsum(counts[rows])
                answers = [_pack(given.slice(b - n, n)) for b, n in zip(ends.tolist(), counts[rows].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [own.column("shard"), own.column("block"), own.column("count"), pa.array(answers, pa.binary())], ["shard", "block", "count", "ids"]
                )

    return run


def _places(shards: int):
    """Each block's documents as places in its dictionary; the words are numbered in order of their shards."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern = _pattern()
        for batch in bounded(batches, "text", _BLOCK):
            block = _Block(batch.column("text"), pattern)
            order, _ = _dealt(block.encoded, shards)
            number = np.empty(len(order), dtype="<u4")
            number[order] = np.arange(len(order))
            places = block.places(number)
            yield pa.RecordBatch.from_arrays(
                [pa.array([_block_id(block.encoded)], pa.binary()),
                 pa.array([batch.column("doc_id").to_pylist()], pa.list_(batch.column("doc_id").type)),
                 pa.array([[len(p) for p in places]], pa.list_(pa.int64())),
                 pa.array([_squeezed(np.concatenate(places))], pa.binary()),
                 pa.array([len(order)], pa.int64())],
                ["block", "doc_ids", "sizes", "places", "words"],
            )

    return run


def _word_tables(left: pa.Table, right: pa.Table) -> Iterator[tuple[list, pa.LargeBinaryArray, np.ndarray, np.ndarray]]:
    """For each block its documents' ids, the answers by word, the places of the documents' words among them and how many each has."""
    of = {s: (data, n) for s, n, data in zip(*(right.column(c).to_pylist() for c in ("shard", "count", "ids")), strict=True)}
    table = pa.concat_arrays([_unpack(*of[s]) for s in sorted(of)] or [pa.array([], pa.large_binary())])
    columns = (left.column(c).to_pylist() for c in ("doc_ids", "sizes", "places", "words"))
    for doc_ids, sizes, packed, words in zip(*columns, strict=True):
        if words != len(table):
            raise ValueError("the documents changed between two reads; write them to a table first")
        yield doc_ids, table, _numbers(packed), np.array(sizes, dtype=np.int64)


def _pieces(table: pa.LargeBinaryArray, places: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[int, memoryview]]:
    """The words' values in the order of the documents' places: number of the document, next bytes of it."""
    ends = np.cumsum(sizes)
    starts = ends - sizes
    for begin in range(0, len(places), _AT_ONCE):
        stop = min(begin + _AT_ONCE, len(places))
        offsets, data = _buffers(table.take(pa.array(places[begin:stop])))
        a, b = np.searchsorted(ends, begin, side="right"), np.searchsorted(starts, stop, side="left")
        low, high = offsets[np.maximum(starts[a:b], begin) - begin], offsets[np.minimum(ends[a:b], stop) - begin]
        view = memoryview(data)
        for doc, x, y in zip(range(a, b), low.tolist(), high.tolist(), strict=True):
            yield doc, view[x:y]


def _assembled(left: pa.Table, right: pa.Table) -> pa.Table:
    """Ids of the documents of one block: the answers by word, taken in the order of each document's places."""
    docs, ids = [], []
    for doc_ids, table, places, sizes in _word_tables(left, right):
        own = [bytearray() for _ in doc_ids]
        for doc, piece in _pieces(table, places, sizes):
            own[doc] += piece
        docs += doc_ids
        ids += own
    return pa.table([pa.array(docs, left.schema.field("doc_ids").type.value_type), pa.array(ids, pa.binary())], ["doc_id", "ids"])


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, ids`` for every row of ``docs``; ids are little-endian unsigned 32-bit numbers in one binary value.

    A null or empty text has no ids. Repeated rows are encoded as often as they occur; a null id stays null. Other
    columns are ignored; an empty table gives no rows. ``docs`` is read twice; if a block isn't the same
    the second time, the job fails. There are as many shards as shuffle partitions, so set these by the size of the data.
    """
    return _in_blocks(docs, path, _assembled, f"doc_id {dict(docs.dtypes)['doc_id']}, ids binary")


def _in_blocks(docs: DataFrame, path: str | None, finish: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    """Join the answers to the blocks and let ``finish`` make the rows of each block's documents."""
    path = path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    spark, kind = docs.sparkSession, dict(docs.dtypes)["doc_id"]
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = texts(docs)
    # Both reads take the same columns: Spark ends a batch by its bytes, too, and blocks end with batches.
    asked = rows.mapInArrow(_requests(shards), "shard int, block binary, count int, words binary")
    given = asked.repartition(shards, "shard").mapInArrow(_answers(path), "shard int, block binary, count int, ids binary")
    blocks = rows.mapInArrow(_places(shards), f"block binary, doc_ids array<{kind}>, sizes array<long>, places binary, words long")
    return blocks.groupBy("block").cogroup(given.groupBy("block")).applyInArrow(finish, schema)


def _token_table(docs: DataFrame, path: str | None):
    """The token-byte table on every executor: as many entries as the vocabulary, some 50,000 or half a megabyte."""
    table = {i: token for token, i in ranks(path or public_tokenizers.path("byte_bpe_50k.tiktoken")).items()}
    return docs.sparkSession.sparkContext.broadcast(table)


def _decoded(table):
    """Look every id up in the token-byte table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = table.value
        for batch in bounded(batches, "ids"):
            data = [b"".join(map(token.__getitem__, np.frombuffer(x, dtype="<u4").tolist())) for x in batch.column("ids").to_pylist()]
            yield batch.append_column("bytes", pa.array(data, pa.binary()))

    return run


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """``encoded`` (``doc_id, ids``) with ``bytes``: a map-side join with the token-byte table.

    An id that isn't in the table fails the job; null ids count as none.
    """
    kind = dict(encoded.dtypes)["doc_id"]
    rows = encoded.select("doc_id", F.coalesce("ids", F.lit(b"")).alias("ids"))
    return rows.mapInArrow(_decoded(_token_table(encoded, path)), f"doc_id {kind}, ids binary, bytes binary")


def _by_word(vocabulary: pa.LargeBinaryArray, ids: np.ndarray, starts: np.ndarray) -> pa.LargeBinaryArray:
    """The vocabulary's values of each word's ids, joined; an id that has none fails."""
    taken = vocabulary.take(pa.array(ids))
    if taken.null_count:
        raise KeyError("an id isn't in the token table")
    offsets, data = _buffers(taken)
    return _values(offsets[starts], data)


def _digested(table):
    """Digests of one block's documents; the ids of a word are looked up in the token-byte table once a block."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        token = table.value
        if _state.get("token") is not token:
            every = range(max(token, default=-1) + 1)
            _state.update(token=token, bytes=pa.array(map(token.get, every), pa.large_binary()), digits=pa.array([b" %d" % i for i in every], pa.large_binary()))
        docs, counts, hashes, decoded = [], [], [], []
        for doc_ids, answers, places, sizes in _word_tables(left, right):
            offsets, data = _buffers(answers)
            ids, starts = data.view("<u4"), offsets // 4
            in_word = np.concatenate(([0], np.cumsum(np.diff(starts)[places])))
            ends = np.cumsum(sizes)
            said, read = [hashlib.sha256() for _ in doc_ids], [hashlib.sha256() for _ in doc_ids]
            begun = bytearray(len(doc_ids))
            for doc, piece in _pieces(_by_word(_state["digits"], ids, starts), places, sizes):
                said[doc].update(piece if begun[doc] else piece[1:])
                begun[doc] = begun[doc] or len(piece) > 0
            for doc, piece in _pieces(_by_word(_state["bytes"], ids, starts), places, sizes):
                read[doc].update(piece)
            docs += doc_ids
            counts += (in_word[ends] - in_word[ends - sizes]).tolist()
            hashes += [x.hexdigest() for x in said]
            decoded += [x.hexdigest() for x in read]
        return pa.table(
            [pa.array(docs, left.schema.field("doc_ids").type.value_type), pa.array(counts, pa.int64()), pa.array(hashes, pa.string()), pa.array(decoded, pa.string())],
            ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
        )

    return run


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: digests of the ids and of the bytes that they decode to.

    The same as the digests of ``decode(encode(docs))``, but a block is put together, decoded and digested in one Python step.
    """
    kind = dict(docs.dtypes)["doc_id"]
    finish = _digested(_token_table(docs, path))
    return _in_blocks(docs, path, finish, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
