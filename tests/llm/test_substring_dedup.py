import hashlib
import pickle
import random

import numpy as np

from pathweave.llm import sketch, substring_dedup
from tests.llm.helpers import docs, table


def brute(rows, width=20):
    """Every window against the least (id, start) of its words; a null id is the smallest."""
    order = lambda d: (d is not None, d or 0)
    words = [(t or "").encode().split() for _, t in rows]
    first = {}
    for (d, _), ws in zip(rows, words):
        for s in range(len(ws) - width + 1):
            w = tuple(ws[s:s + width])
            first[w] = min(first.get(w, (order(d), s)), (order(d), s))
    out = []
    for (d, _), ws in zip(rows, words):
        gone = set()
        for s in range(len(ws) - width + 1):
            if first[tuple(ws[s:s + width])] < (order(d), s):
                gone.update(range(s, s + width))
        kept = b" ".join(w for i, w in enumerate(ws) if i not in gone)
        out.append((d, len(ws), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def test_passages_repeats_and_odd_texts(spark):
    random.seed(3)
    word = lambda: f"w{random.randrange(3000)}"
    passage = [word() for _ in range(60)]
    rows = []
    for i in range(60):
        ws = [word() for _ in range(random.randrange(80))]
        if i % 2:
            cut = random.randrange(40)
            ws[len(ws) // 2:len(ws) // 2] = passage[cut:cut + random.randrange(15, 60)]
        rows.append((random.randrange(1000), "\t\n ".join(ws)))
    rows += [(2000, None), (2001, " "), (None, " ".join(passage)), (2002, "same " * 500), (2003, " ".join(passage)), (2003, " ".join(passage)), (2003, "x " + " ".join(passage))]
    rows += [(2004, " ".join(word() for _ in range(60_000)))]
    df = docs(spark, [(*r, "x") for r in rows], "kept_text string")
    assert sorted((tuple(r)[:4] for r in substring_dedup.dedup(df).collect()), key=str) == brute(rows)
    assert substring_dedup.dedup(docs(spark, [])).collect() == []


def test_documents(spark):
    df = table(spark, "documents")
    want = brute([(r.doc_id, r.text) for r in df.collect()])
    assert sorted((tuple(r)[:4] for r in substring_dedup.dedup(df).collect()), key=str) == want


def test_a_sketch_loses_no_repeated_hash_even_when_full(spark):
    random_ = np.random.default_rng(5)
    for n in (1000, 200_000, 3_000_000):
        cells = sketch.cells_for(1, 1)
        hashes = random_.integers(0, 2**63, n, dtype=np.uint64)
        twice = hashes[::7]
        blocks = [hashes[:n // 2], hashes[n // 2:], twice]
        records = [sketch.record(sketch.payload(sketch.cell(b, cells, r), r * cells // sketch.CHUNK, 2)) for b in blocks for r in range(2)]
        bits = {c: np.frombuffer(b, dtype=np.uint8) for out in sketch._merge(2)(iter(records)) for c, b in zip(*(out.column(i).to_pylist() for i in range(2)))}
        bitmaps = [bits[0], bits[1]]
        assert sketch.test(bitmaps, twice, cells).all()
        if n == 1000:
            assert sketch.test(bitmaps, hashes, cells).mean() < 0.2


def test_bitmaps_travel_compressed(spark):
    hashes = np.random.default_rng(7).integers(0, 2**63, 200_000, dtype=np.uint64)
    cells = sketch.cells_for(len(hashes), 8)
    rows = [tuple(x) for r in range(2) for x in sketch.payload(sketch.cell(hashes, cells, r), r * cells // sketch.CHUNK, 2)]
    bitmaps = sketch.merged(spark.createDataFrame([(c, w, bytearray(g)) for c, w, g in rows], sketch.PAYLOAD), cells, 2, 2)
    assert any(b.any() for b in bitmaps)
    sent = pickle.dumps(bitmaps)
    assert len(sent) < sum(b.nbytes for b in bitmaps) // 3
    assert all((a == b).all() for a, b in zip(pickle.loads(sent), bitmaps, strict=True))
