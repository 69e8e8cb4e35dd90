import os
import random
import re
from collections import defaultdict

import numpy as np

import corpus_pipeline
from pathweave.llm import similar_docs, simhash_dedup
from tests.llm.helpers import SF, docs, table


def sets_of(rows, width=5):
    out = []
    for _, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        out.append({tuple(words[i:i + width]) for i in range(max(1, len(words) - width + 1))} if words else set())
    return out


def brute(rows, least=0.8):
    """Kept ids and the pairs at ``least`` or more: every pair that shares a shingle is compared."""
    sets, by, label = sets_of(rows), defaultdict(list), list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, s in enumerate(sets):
        for x in s or {()}:
            by[x].append(i)
    pairs = {(i, j) for group in by.values() for j in group for i in group if i < j}
    linked = [(i, j) for i, j in pairs if not sets[i] | sets[j] or len(sets[i] & sets[j]) >= least * len(sets[i] | sets[j])]
    for i, j in linked:
        label[max(root(i), root(j))] = min(root(i), root(j))
    kept = {}
    for i, (doc, _) in enumerate(rows):
        kept[root(i)] = min(doc, kept.get(root(i), doc))
    return sorted(kept.values()), linked


def near_copies():
    """Pairs from 0.6 to 0.99: a run of words at the end is new."""
    random.seed(7)
    word = lambda: f"w{random.randrange(10**6)}"
    rows = [(0, ""), (1, None), (2, "one two"), (3, "One  TWO"), (4, "a b c d e f")]
    for i in range(150):
        base = [word() for _ in range(300)]
        rows.append((10 + 2 * i, " ".join(base)))
        gone = random.randrange(1, 75)
        rows.append((11 + 2 * i, " ".join(base[gone:] + [word() for _ in range(gone)])))
    return rows


def test_stage_against_brute_force_jaccard(spark):
    rows = near_copies()
    want, linked = brute(rows)
    assert len(linked) > 60
    got = sorted(r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs(spark, rows), SF).collect())
    assert set(want) <= set(got)  # never more removed than the similarity allows
    assert len(set(got) - set(want)) <= 0.03 * len(linked)


def test_one_row_of_a_repeated_id_stays(spark):
    words = [f"w{i}" for i in range(50)]
    rows = [(1, " ".join(words)), (1, " ".join(words)), (2, " ".join(words)), (None, "x y"), (3, "X y"), (3, "other words")]
    got = corpus_pipeline.near_duplicates(spark, docs(spark, rows), SF).collect()
    assert sorted((r.doc_id or 0, r.text) for r in got) == sorted([(1, " ".join(words)), (0, "x y"), (3, "other words")])
    assert corpus_pipeline.near_duplicates(spark, docs(spark, []), SF).collect() == []


def test_documents_against_brute_force_jaccard(spark):
    df = table(spark, "documents", os.environ.get("TEST_JACCARD_DIR", SF))
    want, _ = brute([(r.doc_id, r.text) for r in df.collect()])
    got = [r.doc_id for r in corpus_pipeline.near_duplicates(spark, df, SF).collect()]
    print("kept", len(got), "brute force", len(want))
    assert set(want) <= set(got) and len(got) - len(want) <= 0.01 * len(want)


def test_blocks_find_all_that_differ_in_few_bits():
    rng = np.random.default_rng(3)
    for count in (100, 200_000, 15_000_000):
        blocks = max(similar_docs.BLOCKS, simhash_dedup.block_count(count, similar_docs.BITS))
        keys = len(simhash_dedup.block_choices(blocks, similar_docs.BITS))
        one = rng.integers(0, 2**63, (200, similar_docs.SEEDS), dtype=np.int64)
        other = rng.integers(0, 2**63, one.shape, dtype=np.int64)  # nothing in common but the first fingerprint
        other[:, 0] = one[:, 0]
        for row in other:
            row[0] ^= sum(1 << int(b) for b in rng.choice(63, similar_docs.BITS, replace=False))
        a, b = (similar_docs._keys_of(x, 0, keys, 20, blocks) for x in (one, other))
        assert (a == b).any(axis=1).all()
        pair = np.stack([one[0], other[0]]).view(np.uint64)
        assert sum(len(u) for u, _ in similar_docs.close_pairs(np.arange(2), np.arange(2), pair, 0, True)) == 1


def test_blocks_alone_link_copies_with_small_changes(spark, monkeypatch):
    monkeypatch.setattr(similar_docs, "FIRST", 0)
    monkeypatch.setattr(similar_docs, "key_plan", lambda count, similarity: (20, 0))
    random.seed(5)
    rows = []
    for i in range(40):
        words = [f"w{random.randrange(10**6)}" for _ in range(600)]
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(words[:-1] + ["changed"]))]
    prints = [similar_docs._bits(similar_docs.shingles(similar_docs._words(t.encode()), 5)).view(np.uint64)[0] for _, t in rows]
    few = {2 * i + 1 for i in range(40) if int(prints[2 * i] ^ prints[2 * i + 1]).bit_count() <= similar_docs.BITS}
    assert len(few) > 20
    got = {r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs(spark, rows), SF).collect()}
    assert got == set(range(80)) - few
