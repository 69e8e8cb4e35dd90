import zlib

import numpy as np
import public_tokenizers
from tests.llm.helpers import docs, table
from pathweave.llm import packing
from tokenizers import Tokenizer


def whole(text):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    tokenizer.encode_special_tokens = True
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [packing.END]


def check(rows, texts):
    """Pieces cover each document once, crc and counts are right, sequences are gapless; the share of padding."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(texts)
    for doc, parts in by_doc.items():
        ids, at = whole(texts[doc]), 0
        for r in sorted(parts, key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at:at + r.length], dtype="<u4").tobytes())
            at += r.length
        assert at == len(ids)
    for parts in by_sequence.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= packing.CAPACITY
    assert set(by_sequence) == set(range(len(by_sequence)))
    return 1 - sum(r.length for r in rows) / (len(by_sequence) * packing.CAPACITY)


def test_all_documents_packed_with_little_padding(spark):
    df = table(spark, "documents", "/root/testdata/sf0.01")
    texts = {r.doc_id: r.text for r in df.collect()}
    assert check(packing.pack(df).collect(), texts) < 0.02


def test_odd_texts_and_clashing_columns(spark):
    long = "Ünïcode wörds　and\x1cspaces  don't\t" * 4000
    rows = [(1, None, "a", 1), (2, "", "b", 2), (3, " \n ", "c", 3), (4, long, "d", 4), (5, "x<|endoftext|>y 'S ΣΑΣ é", "e", 5)]
    df = docs(spark, rows, "sequence_id string, length int")
    check(packing.pack(df).collect(), {r[0]: r[1] for r in rows})
    with_ids = {(r.doc_id, r.start): r.ids for r in packing.pack(df, with_ids=True).collect()}
    assert with_ids[5, 0] == whole(rows[4][1])


def test_repeated_rows_null_ids_and_no_rows(spark):
    df = docs(spark, [(7, "same text")] * 3 + [(None, "no id")])
    rows = packing.pack(df).collect()
    assert sorted((r.doc_id or 0, r.length) for r in rows) == [(0, 3), (7, 3), (7, 3), (7, 3)]
    assert sorted(r.offset for r in rows) == [0, 3, 6, 9]
    assert packing.pack(docs(spark, [])).collect() == []


def test_patterns_hold_the_demand_and_reach_the_bound():
    random = np.random.default_rng(1)
    demand = {int(s): int(n) for s, n in zip(random.permutation(256)[:120] + 1, random.integers(1, 900, 120))}
    plan = packing.patterns(demand)
    held = {}
    for pattern, use in plan:
        assert sum(s * n for s, n in pattern.items()) <= 256 and use > 0
        for s, n in pattern.items():
            held[s] = held.get(s, 0) + n * use
    assert held == demand
    least = sum(s * n for s, n in demand.items()) / 256
    assert sum(use for _, use in plan) <= 1.02 * least + 2
