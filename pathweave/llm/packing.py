"""Packing of documents into sequences of bounded length: cutting-stock column generation.

Documents become ids and are cut at multiples of the capacity; what is left over has a length class. The
histogram of classes has at most ``CLASSES`` entries at any size of the corpus, so the linear program over it is
solved on the driver: patterns are columns, priced by a knapsack. Rounded pattern counts say how many
sequences each pattern makes, and the ranked pieces of a class are dealt to them.
"""

from __future__ import annotations

import os
import string
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pathweave.llm.batches import bounded
from pathweave.llm.scratch import texts, written

CAPACITY = 4096
#: Length classes; a piece counts as the next multiple of CAPACITY / CLASSES tokens.
CLASSES = 256
END = 2
_CACHED_WORDS = 700_000
#: Words that are encoded as one text.
_TOGETHER = 2_000
#: How the vocabulary marks a piece that ends a word.
_WORD_END = "</w>"
_BUCKET_ROWS = 2_000
_state: dict = {}


def _state_of(path: str) -> dict:
    """Tokenizer, ids by word and ids by stem, kept while the Python worker lives; a full cache keeps what the texts at hand use.

    The tokenizer's pattern never matches across white space and its normalizers never act across it, so the ids of a
    text are those of its words in a row.
    """
    if _state.get("path") != path:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.encode_special_tokens = True  # names of special tokens in a text are ordinary text
        vocabulary = tokenizer.get_vocab()
        ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        ends[[i for piece, i in vocabulary.items() if piece.endswith(_WORD_END)]] = True
        _state.update(path=path, tokenizer=tokenizer, words={}, stems={}, ends=ends)
    return _state


def _stem(word: str) -> tuple[str, str]:
    """A word of letters and the ASCII punctuation after it, which the tokenizer's pattern always parts; else the word.

    The stem is in lower case, as the tokenizer makes it, but for the two letters whose lower case isn't one letter.
    """
    stem = word.rstrip(string.punctuation)
    if not stem.isalpha() or "\u03a3" in stem or "\u0130" in stem:
        return word, ""
    return stem.lower(), word[len(stem):]


def _encoded(words: list[str], state: dict) -> list[bytes]:
    """Ids of each word. Words of letters are encoded as one text, whose ids part after each that ends a word."""
    plain = [w for w in words if w.isalpha()]
    ids = np.array(state["tokenizer"].encode(" ".join(plain), add_special_tokens=False).ids, dtype="<u4")
    ends = (4 * np.flatnonzero(state["ends"][ids]) + 4).tolist()
    if len(ends) != len(plain):  # some word isn't one for the tokenizer
        plain, ends = [], []
    packed = ids.tobytes()
    known = dict(zip(plain, [packed[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)] if ends else [], strict=True))
    others = [w for w in words if w not in known]
    single = state["tokenizer"].encode_batch_fast(others, add_special_tokens=False)
    known.update((w, array("I", got.ids).tobytes()) for w, got in zip(others, single, strict=True))
    return [known[w] for w in words]


def encode(texts_: list[str], path: str) -> Iterator[bytes]:
    """Little-endian unsigned 32-bit ids of each text, with the closing id."""
    state = _state_of(path)
    split = [t.replace("\n", " ").split(" ") for t in texts_]
    seen = set().union(*split)
    if len(state["words"]) > _CACHED_WORDS:
        state["words"] = {w: state["words"][w] for w in seen if w in state["words"]}
    if len(state["stems"]) > _CACHED_WORDS:
        used = {x for w in seen for x in _stem(w)}
        state["stems"] = {x: state["stems"][x] for x in used if x in state["stems"]}
    words, stems = state["words"], state["stems"]
    new = [(w, *_stem(w)) for w in seen if w not in words]
    unseen = list({x for _, stem, rest in new for x in (stem, rest) if x not in stems})
    for at in range(0, len(unseen), _TOGETHER):
        part = unseen[at:at + _TOGETHER]
        stems.update(zip(part, _encoded(part, state), strict=True))
    for word, stem, rest in new:
        words[word] = stems[stem] + stems[rest]
    end = array("I", [END]).tobytes()
    for parts in split:
        yield b"".join(map(words.__getitem__, parts)) + end


def pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens`` and, if asked for, ``ids``: a row per piece of a document."""
    path = path or public_tokenizers.path("word_bpe_49k.json")
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, "text", 4 << 20):
            out: list[list] = [[] for _ in range(5 + with_ids)]
            for row, ids in enumerate(encode(batch.column("text").to_pylist(), path)):
                for at in range(0, len(ids), 4 * capacity):
                    part = ids[at:at + 4 * capacity]
                    values = [row, at // 4, len(part) // 4, zlib.crc32(part), len(ids) // 4]
                    values += [np.frombuffer(part, dtype="<i4")] * with_ids
                    for column, value in zip(out, values, strict=True):
                        column.append(value)
            arrays = [batch.column("doc_id").take(pa.array(out[0], pa.int64()))] + [pa.array(c, pa.int64()) for c in out[1:5]]
            arrays += [pa.array(c, pa.list_(pa.int32())) for c in out[5:]]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"][:5 + with_ids])

    schema = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<int>" * with_ids
    return texts(docs).mapInArrow(run, schema)


def _knapsack(values: np.ndarray, sizes: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """Best total value of items, each usable again, within the room; how often each is taken."""
    best, last = np.zeros(room + 1), np.full(room + 1, -1)
    fits = np.searchsorted(sizes, np.arange(room + 1), side="right")
    for r in range(1, room + 1):
        best[r] = best[r - 1]
        if fits[r]:
            got = best[r - sizes[:fits[r]]] + values[:fits[r]]
            i = int(got.argmax())
            if got[i] > best[r] + 1e-12:
                best[r], last[r] = got[i], i
    taken, r = np.zeros(len(sizes), dtype=np.int64), room
    while r > 0:
        if last[r] < 0:
            r -= 1
        else:
            taken[last[r]] += 1
            r -= sizes[last[r]]
    return float(best[room]), taken


def patterns(demand: dict[int, int], room: int = CLASSES, rounds: int = 4000) -> list[tuple[dict[int, int], int]]:
    """Patterns (how many pieces of each class) and how often each is used; together they hold the demand exactly.

    The linear program is solved by column generation. Whole parts of its solution are taken, and what
    remains is at most a few pieces per pattern: it is filled greedily, largest first.
    """
    sizes = np.array(sorted(demand), dtype=np.int64)
    if not len(sizes):
        return []
    need = np.array([demand[int(s)] for s in sizes], dtype=np.int64)
    columns = np.diag(room // sizes).astype(np.float64)
    for _ in range(rounds):
        prices = np.linalg.solve(columns.T, np.ones(len(sizes)))
        value, taken = _knapsack(prices, sizes, room)
        if value <= 1 + 1e-9:
            break
        amount, change = np.linalg.solve(columns, np.stack([need.astype(np.float64), taken.astype(np.float64)], axis=1)).T
        ratio = np.where(change > 1e-9, np.maximum(amount, 0) / np.where(change > 1e-9, change, 1), np.inf)
        columns[:, int(ratio.argmin())] = taken
    uses = np.floor(np.linalg.solve(columns, need.astype(np.float64)) + 1e-6).astype(np.int64)
    left, out = need.copy(), []
    for column, use in sorted(zip(columns.T.round().astype(np.int64).tolist(), uses.tolist(), strict=True), key=lambda x: -x[1]):
        taken = np.array(column)
        use = min(use, int((left[taken > 0] // taken[taken > 0]).min()))
        if use > 0:
            left -= use * taken
            out.append(({int(s): int(n) for s, n in zip(sizes, taken, strict=True) if n}, use))
    while left.any():
        taken, free = np.zeros(len(sizes), dtype=np.int64), room
        for i in range(len(sizes) - 1, -1, -1):
            taken[i] = min(left[i], free // sizes[i])
            free -= taken[i] * sizes[i]
        use = int((left[taken > 0] // taken[taken > 0]).min())
        left -= use * taken
        out.append(({int(s): int(n) for s, n in zip(sizes, taken, strict=True) if n}, use))
    return out


def _dealt(plan: list[tuple[dict[int, int], int]]):
    """Send the piece with a class and a rank in it to its sequence, by the plan (bounded by the count of classes)."""
    starts: dict[int, list] = {}
    filled: dict[int, int] = {}
    sequence = 0
    for pattern, use in plan:
        for size, n in pattern.items():
            starts.setdefault(size, []).append((filled.get(size, 0), n, sequence))
            filled[size] = filled.get(size, 0) + n * use
        sequence += use
    tables = {size: np.array(x, dtype=np.int64) for size, x in starts.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ranks, sizes = (batch.column(c).to_numpy() for c in ("rank", "size"))
            to = np.zeros(len(ranks), dtype=np.int64)
            for size in np.unique(sizes):
                of, table = sizes == size, tables[int(size)]
                row = table[np.searchsorted(table[:, 0], ranks[of], side="right") - 1]
                to[of] = row[:, 2] + (ranks[of] - row[:, 0]) // row[:, 1]
            yield batch.append_column("sequence_id", pa.array(to))

    return run


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``, then ``ids`` if asked for.

    Every document is cut at multiples of ``capacity``; the rest is one piece. Each id lies in one piece, each
    piece in one sequence of at most ``capacity`` ids, without gaps from offset 0. A null or empty text is the
    closing id alone. Repeated rows are packed as often as they occur; a null id stays null. Other columns
    are ignored; an empty table gives no rows.
    """
    unit = capacity // CLASSES
    cut = pieces(docs, path, capacity, with_ids).withColumn("size", F.ceil(F.col("length") / unit).cast("int"))
    held = written(cut, "pieces")
    demand = {r["size"]: r["n"] for r in held.groupBy("size").agg(F.count("*").alias("n")).collect()}
    buckets = max(1, -(-sum(demand.values()) // _BUCKET_ROWS))
    order = Window.partitionBy("size", "bucket").orderBy("doc_id", "start", "doc_tokens", "ids_crc32")
    ranked = held.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "start"), F.lit(buckets)).cast("int"))
    ranked = ranked.withColumn("rank", F.row_number().over(order).cast("long") - 1)
    before = ranked.groupBy("size", "bucket").agg(F.count("*").alias("n")).withColumn(
        "before", F.sum("n").over(Window.partitionBy("size").orderBy("bucket")) - F.col("n")
    ).drop("n")
    placed = ranked.join(before, ["size", "bucket"]).withColumn("rank", F.col("rank") + F.col("before")).drop("bucket", "before")
    fields = ", ".join(f"{c} {t}" for c, t in placed.dtypes)
    dealt = placed.mapInArrow(_dealt(patterns(demand)), fields + ", sequence_id long")
    place = Window.partitionBy("sequence_id").orderBy(F.col("size").desc(), "rank")
    out = dealt.withColumn("offset", F.sum("length").over(place) - F.col("length"))
    return out.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", *["ids"] * with_ids)
