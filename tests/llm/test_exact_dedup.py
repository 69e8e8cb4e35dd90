import hashlib
import re

from pathweave.llm import exact_dedup
from tests.llm.helpers import docs, table


def brute(rows):
    """The contract, row by row; of rows that repeat id and text one is kept."""
    norm = {i: re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for i, (_, t) in enumerate(rows)}
    out = []
    for i, (doc, _) in enumerate(rows):
        group = [rows[j][0] for j in norm if norm[j] == norm[i]]
        ids = [d for d in group if d is not None]
        keep = min(ids) if ids else None
        first = next(j for j in norm if norm[j] == norm[i] and rows[j][0] == doc) == i
        out.append((doc, keep, len(group), doc == keep and first, hashlib.sha256(norm[i].encode()).hexdigest()))
    return sorted(out, key=str)


ODD = [(3, "a  b"), (1, "a\tb"), (2, "a\n\r b"), (2, "a b"), (2, "a b"), (5, None), (4, ""), (None, "x"), (None, "x"), (None, "a b"), (9, "a b"), (8, "y" * 300_000), (7, "y" * 300_000), (6, " ")]


def test_odd_rows_and_clashing_columns(spark):
    df = docs(spark, [(*r, 1, "z") for r in ODD], "keep_id int, kept string")
    assert sorted(map(tuple, exact_dedup.dedup(df).collect()), key=str) == brute(ODD)
    assert exact_dedup.dedup(docs(spark, [])).collect() == []


def test_history_members_and_nonmembers(spark):
    history = docs(spark, [(1, "old"), (2, "old"), (3, "other")])
    new = docs(spark, [(10, "old"), (11, "new"), (12, "new "), (13, "new"), (14, "other"), (3, "other")])
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact_dedup.dedup(new, history).collect()}
    assert got == {10: (1, 2, False), 11: (11, 2, True), 12: (12, 1, True), 13: (11, 2, False), 14: (3, 1, False), 3: (3, 1, True)}


def test_hash_is_minimal_and_perfect(spark):
    rows = exact_dedup.digests(table(spark, "documents")).distinct()
    classes = rows.groupBy("digest").agg({"doc_id": "min", "*": "count"}).toDF("digest", "winner", "n").cache()
    index, buckets = exact_dedup.build_index(classes)
    slots = [s for r in index.collect() for s in r.slots]
    assert None not in slots and len(slots) == classes.count() == len({bytes(s.digest) for s in slots})
    looked = exact_dedup.lookup(classes, index, buckets).collect()
    assert all(r.found.winner == r.winner and r.found.digest == r.digest for r in looked)
    strangers = exact_dedup.digests(docs(spark, [(i, f"not in it {i}") for i in range(200)]))
    assert all(r.found is None for r in exact_dedup.lookup(strangers, index, buckets).collect())
