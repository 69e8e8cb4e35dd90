import hashlib
import math
import re
import zlib

import pytest
from pathweave.llm import importance
from pyspark.sql import functions as F
from tests.llm.helpers import docs, table

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text, longest=1):
    found = WORD.findall((text or "").translate(UPPER))
    return len(found), [" ".join(found[i:i + n]) for n in range(1, longest + 1) for i in range(len(found) - n + 1)]


def brute(rows, target, share=(10, 100), least_words=20, longest=1, buckets=10_000, seed=2024):
    def count(texts):
        out = [0] * buckets
        for t in texts:
            for f in features(t, longest)[1]:
                out[zlib.crc32(f.encode()) % buckets] += 1
        return out

    s, t = count([x for _, x in rows]), count(target)
    gain = [math.floor(1000 * math.log((b + 1) * (sum(s) + buckets) / ((a + 1) * (sum(t) + buckets)))) for a, b in zip(s, t, strict=True)]
    scored = []
    for i, text in rows:
        n_words, found = features(text, longest)
        weight = sum(gain[zlib.crc32(f.encode()) % buckets] for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        scored.append((i, n_words, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    may = sorted((r for r in scored if r[1] >= least_words), key=lambda r: (-r[4], 2**63 if r[0] is None else r[0]))
    drawn = may[:share[0] * len(may) // share[1]]
    rest = may[len(drawn):] + [r for r in scored if r[1] < least_words]
    return [(*r[:1], *r[2:], n + 1) for n, r in enumerate(drawn)] + [(*r[:1], *r[2:], None) for r in rest]


def key(row):
    return tuple((v is None, v or 0) for v in row)


def run(spark, rows, target, **more):
    return sorted(map(tuple, importance.resample(docs(spark, rows), docs(spark, [(1, t) for t in target]), **more).collect()), key=key)


def test_all_documents_against_brute_force(spark):
    d, b = table(spark, "documents"), table(spark, "benchmark")
    rows, target = [(r.doc_id, r.text) for r in d.collect()], [r.text for r in b.collect()]
    got = sorted(map(tuple, importance.resample(d, b).collect()), key=key)
    assert got == sorted(brute(rows, target), key=key)
    assert got == sorted(map(tuple, importance.resample(d.repartition(5), b).collect()), key=key)


def test_longer_runs_and_another_share(spark):
    rows = [(i, f"One two {i % 7} three-four Ünï {'x ' * (i % 5)}") for i in range(120)]
    more = {"share": (1, 3), "least_words": 6, "longest": 3, "buckets": 50, "seed": 7}
    assert run(spark, rows, ["two three", "x x x", None], **more) == sorted(brute(rows, ["two three", "x x x", None], **more), key=key)


def test_odd_rows(spark):
    long = "word " * 400_000
    rows = [(1, None), (2, ""), (3, "- . !"), (None, "a b c d"), (None, "a b c d"), (4, long), (4, long), (5, "É é K K"), (6, "a b c d")]
    more = {"share": (1, 2), "least_words": 0}
    assert run(spark, rows, ["a b"], **more) == sorted(brute(rows, ["a b"], **more), key=key)
    assert run(spark, [], ["a b"]) == []
    assert run(spark, rows, [], least_words=3) == sorted(brute(rows, [], least_words=3), key=key)


def test_draw_ends_among_equal_rows(spark):
    rows = [(7, "same words here")] * 9 + [(8, "other words")]
    got = run(spark, rows, ["same"], share=(1, 2), least_words=1)
    ranks = sorted(r[4] for r in got if r[4] is not None)
    assert ranks == [1, 2, 3, 4, 5]
    assert [r[:4] for r in got] == [r[:4] for r in sorted(brute(rows, ["same"], share=(1, 2), least_words=1), key=key)]


def test_other_columns_with_clashing_names(spark):
    names = "row long, n_words string, features string, score string, rank string, part long, at long, bucket long"
    rows = [(i, f"a b c {i}", 1, "x", "x", "x", "x", 1, 1, 1) for i in range(30)]
    d = docs(spark, rows, names)
    got = importance.resample(d, d, share=(1, 10), least_words=1)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert got.filter("rank is not null").count() == 3


@pytest.mark.parametrize("wanted", [1, 2, 499, 500, 501, 1000])
def test_cutoff(spark, wanted):
    values = [(i * 7919) % 613 - 300 for i in range(1000)] + [2**62, -(2**62)]
    frame = spark.createDataFrame([(v,) for v in values], "v long")
    value, below = importance.cutoff(frame, F.col("v"), wanted)
    assert (value, below) == (sorted(values)[wanted - 1], sum(v < value for v in values))
