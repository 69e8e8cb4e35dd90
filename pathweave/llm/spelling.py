"""Spelling variants: words one edit apart, found in a reduced alphabet.

Letters are hashed to a few symbols. Words one edit apart then have reduced words that are equal or one edit apart, and the
full one-edit neighbourhood of a reduced word is short. It is joined with the reduced vocabulary, and the words
behind each pair are compared as they are spelled. Each word points to its commonest neighbour, if that is common
enough; pointers are followed by doubling.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathweave.llm.batches import bounded
from pathweave.llm.scratch import dropped, texts, written

#: Letters of a word, lower case but for those beyond ASCII: code points below 256, so that Latin-1 has a byte for each.
LETTERS = [*range(0x61, 0x7B), *range(0xC0, 0x100)]
_BREAKS = bytes(b if b in LETTERS else 0x20 for b in range(256))
#: Symbols that letters are hashed to: more make fewer words equal, and neighbourhoods longer.
SYMBOLS = 8
#: One of so many runs of a document loses a letter.
ONE_IN = 97


def seeded(doc_id: object) -> int:
    """Checksum of ``<doc_id>:``, with which that of each of its runs goes on; a null id is an empty text."""
    return zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())


def altered(run: bytes, start: int, one_in: int) -> bytes:
    """The run in Latin-1, without one of its letters where the checksum of id and run says so."""
    h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), start)
    return run[:h % len(run)] + run[h % len(run) + 1:] if one_in and h % one_in == 0 else run


def _counted(one_in: int, least_letters: int):
    """Words of each batch with their counts, so that a common word is a row for each batch, not for each time it stands there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, "text"):
            counts: Counter[bytes] = Counter()
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                latin = text.as_py().encode("latin-1", "replace")  # what has no byte there is no letter
                start = seeded(doc_id)
                for found, n in Counter(latin.lower().translate(_BREAKS).split()).items():
                    word = altered(found, start, one_in)
                    if len(word) >= least_letters:
                        counts[word] += n
            words = [w.decode("latin-1") for w in counts]
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])

    return run


def vocabulary(docs: DataFrame, least_letters: int = 5, least_count: int = 3, one_in: int = ONE_IN) -> DataFrame:
    """``word, n`` of the words with enough letters that occur often enough in all texts together."""
    parts = texts(docs).mapInArrow(_counted(one_in, least_letters), "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


def alphabet(symbols: int) -> tuple[str, str]:
    """Letters, and the symbol of each: by their checksum, so that letters of one kind or frequency part."""
    letters = "".join(map(chr, LETTERS))
    return letters, "".join(chr(0x61 + zlib.crc32(c.encode()) % symbols) for c in letters)


def neighbourhood(word: str, symbols: str) -> set[str]:
    """The word and all words of the alphabet one edit from it."""
    cuts = [(word[:i], word[i:]) for i in range(len(word) + 1)]
    out = {word}
    out.update(a + b[1:] for a, b in cuts if b)
    out.update(a + s + b[1:] for a, b in cuts if b for s in symbols)
    out.update(a + s + b for a, b in cuts for s in symbols)
    return out


def _around(symbols: str):
    """Pairs of a reduced word with its neighbours that do not sort before it: the other half comes from their side."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2_000):
                own, near = [], []
                for word in batch.column("reduced").slice(at, 2_000).to_pylist():
                    found = [x for x in neighbourhood(word, symbols) if x >= word]
                    own += [word] * len(found)
                    near += found
                yield pa.RecordBatch.from_arrays([pa.array(own, pa.string()), pa.array(near, pa.string())], ["own", "near"])

    return run


def near_pairs(words: DataFrame, symbols: int = SYMBOLS) -> DataFrame:
    """``word, n, near, near_n`` for each two words of ``word, n`` that are exactly one edit apart, in both directions."""
    letters, symbol_of = alphabet(symbols)
    reduced = words.withColumn("reduced", F.translate("word", letters, symbol_of))
    own = reduced.select("reduced").distinct()
    around = own.mapInArrow(_around("".join(sorted(set(symbol_of)))), "own string, near string")
    met = around.join(own.withColumnRenamed("reduced", "near"), "near", "leftsemi")
    a = reduced.select(F.col("reduced").alias("own"), F.col("word").alias("a"), F.col("n").alias("a_n"))
    b = reduced.select(F.col("reduced").alias("near"), F.col("word").alias("b"), F.col("n").alias("b_n"))
    one_edit = F.levenshtein("a", "b", 1) == 1
    once = (F.col("own") != F.col("near")) | (F.col("a") < F.col("b"))
    pairs = met.join(a, "own").join(b, "near").filter(once & one_edit)
    sides = F.array(
        F.struct(F.col("a").alias("word"), F.col("a_n").alias("n"), F.col("b").alias("near"), F.col("b_n").alias("near_n")),
        F.struct(F.col("b").alias("word"), F.col("b_n").alias("n"), F.col("a").alias("near"), F.col("a_n").alias("near_n")),
    )
    return pairs.select(F.inline(sides))


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root`` for the words that have a form: pointers jump twice as far each round.

    Counts at least double along a chain, so there are at most six rounds for counts of 64 bits.
    """
    now = written(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        further = now.select(F.col("word").alias("_via"), F.col("root").alias("_to"))
        jumped = now.join(further, now["root"] == further["_via"], "left")
        if jumped.filter(F.col("_to").isNotNull()).isEmpty():
            return now
        new = written(jumped.select("word", F.coalesce("_to", "root").alias("root")), "forms")
        dropped(now)
        now = new


def variants(
    docs: DataFrame, least_letters: int = 5, least_count: int = 3, factor: int = 2, one_in: int = ONE_IN, symbols: int = SYMBOLS
) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every word of all texts with enough letters and occurrences.

    Words are runs of the letters A-Z, a-z and U+00C0 to U+00FF; only A-Z become lower case. One in ``one_in`` runs of a document
    (by the checksum of ``<doc_id>:<run>``; 0: none) first loses a letter. ``form`` is the commonest word one edit away (ties:
    the smallest in code-point order) if it is ``factor`` (2 or more) times as common, ``root`` the end of the chain of forms.

    A null text has no words, a null id counts as an empty text in the checksum. Each of several equal rows counts. Other
    columns are ignored, whatever their names. No words, or an empty table, give no rows.
    """
    if factor < 2:
        raise ValueError(f"factor must be 2 or more, got {factor}")
    words = written(vocabulary(docs, least_letters, least_count, one_in), "vocabulary")
    best = near_pairs(words, symbols).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("word"))).alias("best")
    )
    found = words.join(best, "word", "left")
    common = -F.col("best.n") >= F.lit(factor) * F.col("n")
    found = written(found.select(
        "word", F.when(common, F.col("best.word")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(common, -F.col("best.n")).alias("form_n"),
    ), "variants")
    roots = _roots(found.filter(F.col("form").isNotNull()))
    return found.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
