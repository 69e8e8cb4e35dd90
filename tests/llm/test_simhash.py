import random
import re

import pytest
import xxhash

from pathweave.llm import simhash_dedup, tiles
from tests.llm.helpers import docs, table


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + 4]).encode(), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute(rows, bits=4):
    prints = [fingerprint(t) for _, t in rows]
    label = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i in range(len(rows)):
            for j in range(i):
                if label[i] != label[j] and (prints[i] ^ prints[j]).bit_count() <= bits:
                    label[i] = label[j] = min(label[i], label[j])
                    changed = True
    least = {}
    for (doc, _), c in zip(rows, label):
        if doc is not None:
            least[c] = min(doc, least.get(c, doc))
    return sorted(((doc, f"{f:016x}", least.get(c)) for (doc, _), f, c in zip(rows, prints, label)), key=str)


def variants():
    random.seed(4)
    base = [f"w{random.randrange(4000)}" for _ in range(300)]
    rows = [(0, None), (1, ""), (2, " \n"), (3, "One"), (4, "one"), (5, "a b c"), (None, "A b C"), (7, "a b c d"), (7, "a b c d"), (8, "ÀB àb x y z"), (9, "k " * 70_000)]
    for i in range(40):
        words = list(base)
        for _ in range(i % 6):
            words[random.randrange(300)] = f"v{random.randrange(99)}"
        rows.append((100 + i, " ".join(words)))
    return rows


def test_against_brute_force(spark):
    rows = variants()
    df = docs(spark, [(*r, "x") for r in rows], "component_id string")
    assert sorted(map(tuple, simhash_dedup.near_duplicates(df).collect()), key=str) == brute(rows)
    assert simhash_dedup.near_duplicates(docs(spark, [])).collect() == []


def test_documents_against_brute_force(spark):
    df = table(spark, "documents")
    rows = [(r.doc_id, r.text) for r in df.collect()]
    assert sorted(map(tuple, simhash_dedup.near_duplicates(df).collect()), key=str) == brute(rows)


@pytest.mark.parametrize("distinct", [10, 10**6, 10**8, 10**12])
def test_blocks_find_every_close_pair(spark, distinct):
    blocks = simhash_dedup.block_count(distinct, 4)
    random.seed(distinct)
    pairs = []
    for _ in range(60):
        a = random.getrandbits(64)
        b = a
        for bit in random.sample(range(64), 4):
            b ^= 1 << bit
        pairs.append(tuple(x - (1 << 64) if x >> 63 else x for x in (a, b)))
    df = spark.createDataFrame(pairs, "a long, b long")
    keys = df.select(simhash_dedup._keys(df.a, blocks, 4).alias("a"), simhash_dedup._keys(df.b, blocks, 4).alias("b"))
    assert all(set(r.a) & set(r.b) for r in keys.collect())


def test_tiles_hold_every_pair_in_short_lists(spark):
    rows = spark.createDataFrame([(1, i) for i in range(90)] + [(2, 1), (2, 2), (3, 5)], "key int, member long")
    lists = [set(r.members) for r in tiles.bucket_lists(rows, "key", "member", 20).collect()]
    assert all(any({i, j} <= x for x in lists) for i in range(90) for j in range(i)) and max(map(len, lists)) < 50
    assert not any(5 in x and len(x) == 1 for x in lists)
