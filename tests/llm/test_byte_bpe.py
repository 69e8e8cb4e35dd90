import hashlib
import random

import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from pathweave.llm import byte_bpe
from tests.llm.helpers import docs, table


def want(texts):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoding = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.ranks(path), special_tokens={})
    out = []
    for doc, text in texts:
        ids = encoding.encode_ordinary(text or "")
        out.append((doc, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    return sorted(out, key=str)


def test_documents(spark):
    df = table(spark, "documents")
    assert sorted(map(tuple, byte_bpe.round_trip(df).collect()), key=str) == want([(r.doc_id, r.text) for r in df.collect()])


def test_odd_texts_repeats_and_clashing_columns(spark):
    random.seed(6)
    alphabet = "aB1'st ll've\t\n\r\x1c\x85  　.,é漢🙂é<|endoftext|>٣Ⅷ​"
    rows = [(i, "".join(random.choice(alphabet) for _ in range(random.randrange(50)))) for i in range(400)]
    rows += [(500, None), (501, ""), (502, "   "), (503, " x"), (504, "x  y   z \n\n q"), (505, "lang wort " * 50_000), (506, "z" * 3000), (506, "z" * 3000), (None, "no id")]
    df = docs(spark, [(*r, 1) for r in rows], "ids int")
    assert sorted(map(tuple, byte_bpe.round_trip(df).collect()), key=str) == want(rows)


def test_no_rows_and_only_empty_texts(spark):
    assert byte_bpe.round_trip(docs(spark, [])).collect() == []
    assert sorted(map(tuple, byte_bpe.round_trip(docs(spark, [(1, ""), (2, None)])).collect())) == want([(1, ""), (2, None)])


def test_encode_then_decode(spark):
    rows = [(1, "one two  three\n"), (2, None), (None, "é漢")]
    out = byte_bpe.decode(byte_bpe.encode(docs(spark, rows))).collect()
    assert sorted(((r.doc_id, bytes(r.bytes).decode()) for r in out), key=str) == sorted(((d, t or "") for d, t in rows), key=str)
    assert byte_bpe.decode(spark.createDataFrame([(5, None)], "doc_id long, ids binary")).first().bytes == b""


def test_plain_stretches_skip_the_pattern():
    pattern, calls = byte_bpe._pattern(), []

    class Counted:
        def findall(self, text):
            calls.append(text)
            return pattern.findall(text)

    random.seed(7)
    parts = ["".join(random.choice("aeé×÷Ÿß.,;:!?'s-1\n漢") for _ in range(random.randrange(1, 7))) for _ in range(20_000)] + ["Wort", "élan", "ende.", "so?!"]
    found, sizes = byte_bpe._split_after_space(parts, Counted())
    want_ = [pattern.findall(" " + p) for p in parts]
    assert found == [w for x in want_ for w in x] and sizes == [len(x) for x in want_]
    assert not {" Wort", " élan", " ende.", " so?!"} & set(calls)
    block = byte_bpe._Block(["so so, it is.", "", "so\u00a0 x", "it"], pattern)
    assert [[block.words[i] for i in p] for p in block.places()] == [pattern.findall(t) for t in ("so so, it is.", "", "so\u00a0 x", "it")]


def test_latin_stretches_are_cut_without_the_pattern():
    pattern, calls = byte_bpe._pattern(), []

    class Counted:
        def findall(self, text):
            calls.append(text)
            return pattern.findall(text)

    texts = ["Ende.\nDie Wörter%%% abc12.\tx9 (so?!)", "\nélan", "it's 3×4", "a\n\nb  c", "", " ", " \n", "漢字 ª", "so?! Ende.\nDie"]
    block = byte_bpe._Block(texts, Counted())
    assert [[block.words[i] for i in p] for p in block.places()] == [pattern.findall(t) for t in texts]
    assert sorted(calls) == sorted(["it's", " 3×4", "漢字", " ª"])


def test_blocks_of_odd_stretches_are_cut_as_the_pattern_does(monkeypatch):
    random.seed(8)
    pattern, alphabet = byte_bpe._pattern(), ["a", "É", "ß", "÷", "1", "٣", ".", "_", "'", "'s", "漢", "́", "\n", "\r", "\x1c", "\x85", " ", " ", " ", " "]
    for at_once in (1, 5, 1 << 16):
        monkeypatch.setattr(byte_bpe, "_AT_ONCE", at_once)
        texts = ["".join(random.choices(alphabet, k=random.randrange(30))) for _ in range(2_000)]
        block = byte_bpe._Block(texts, pattern)
        words = block.words
        assert len(set(words)) == len(words)
        assert [[words[i] for i in p] for p in block.places()] == [pattern.findall(t) for t in texts]


def test_steps_put_documents_together_piece_by_piece(monkeypatch):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    table = type("Table", (), {"value": {i: token for token, i in byte_bpe.ranks(path).items()}})
    monkeypatch.setattr(byte_bpe, "_AT_ONCE", 3)
    monkeypatch.setattr(byte_bpe, "_REQUESTED", 2)
    rows = [(1, ""), (2, "one two, three four five six seven"), (3, ""), (4, "x"), (5, "漢字 and two, more\n\nlines"), (6, ""), (None, "one")]
    batch = pa.RecordBatch.from_pydict({"doc_id": [d for d, _ in rows], "text": [t for _, t in rows]})
    asked = pa.Table.from_batches(byte_bpe._requests(4)(iter([batch]))).combine_chunks()
    given = pa.Table.from_batches(byte_bpe._answers(path)(iter([*asked.slice(0, 0).to_batches(), *asked.to_batches()])))
    blocks = pa.Table.from_batches(byte_bpe._places(4)(iter([batch])))
    out = byte_bpe._digested(table)(blocks, given).to_pylist()
    assert sorted((tuple(r.values()) for r in out), key=str) == want(rows)
    ids = byte_bpe._assembled(blocks, given).to_pylist()
    assert [len(r["ids"]) // 4 for r in ids] == [r["n_tokens"] for r in out]
    with pytest.raises(ValueError, match="changed between two reads"):
        byte_bpe._digested(table)(blocks, given.slice(1))


def test_batches_that_end_by_their_bytes(spark):
    rows = [(i, f"word{i} some more of it, " * (i % 40)) for i in range(600)]
    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "20000")
    try:
        assert sorted(map(tuple, byte_bpe.round_trip(docs(spark, rows).coalesce(1)).collect()), key=str) == want(rows)
    finally:
        spark.conf.set(limit, before)
