import re

import numpy as np
import pytest
from pathweave.llm import mixing
from pyspark.sql import functions as F
from tests.llm.helpers import table

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, source string"


def frame(spark, rows, extra=""):
    return spark.createDataFrame(rows, SCHEMA + (", " + extra if extra else ""))


def by_hand(sizes, weights, share=1.0, most=3.0):
    """Filling by small steps: each source takes its weight's share of what is left until it is full."""
    out, left = [0.0] * len(sizes), share * sum(sizes)
    for _ in range(2_000):
        free = [i for i in range(len(sizes)) if weights[i] > 0 and out[i] < most * sizes[i] - 1e-12]
        if not free or left < 1e-9:
            break
        weight, spent = sum(weights[i] for i in free), 0.0
        for i in free:
            more = min(left * weights[i] / weight, most * sizes[i] - out[i])
            out[i] += more
            spent += more
        left -= spent
    return out


@pytest.mark.parametrize("sizes", [[10, 10, 10], [1, 1000, 5], [0, 7, 0, 3], [1, 2, 4, 8, 16, 1000], [], [0, 0], [5]])
def test_targets(sizes):
    weights = [(5, 2, 1)[i % 3] for i in range(len(sizes))]
    got = mixing.targets(sizes, weights)
    assert got == pytest.approx(by_hand(sizes, weights))
    assert sum(got) == pytest.approx(sum(sizes))
    assert all(t <= 3 * s for t, s in zip(got, sizes, strict=True))


@pytest.mark.parametrize("size", [1, 7, 64, 65, 640, 1000])
def test_quotas_hold_the_target(size):
    for words in {0, 1, size // 2, size - 1, size, size + 1, 2 * size, 3 * size - 1, 3 * size}:
        q = mixing.quota("s", 1, size, words, 64)
        taken = 0
        for draw in range(q.draws):
            whole = draw % q.per_pass < q.whole
            taken += q.last if draw == q.draws - 1 else 64 if whole else q.short
        assert taken == words, (size, words)


@pytest.mark.parametrize("n", [1, 2, 3, 17, 64, 1000])
def test_permutations(n):
    a, b = (mixing.permuted(np.arange(n), n, (1, 2, p)) for p in (0, 1))
    assert sorted(a) == sorted(b) == list(range(n))
    assert n < 17 or (list(a) != list(b) and list(a) != list(range(n)))
    assert list(a[n // 2:]) == list(mixing.permuted(np.arange(n // 2, n), n, (1, 2, 0)))  # the same however it is cut


@pytest.mark.parametrize("shards", [1, 2, 7, 1500, 3000])
def test_tree_keeps_all_quotas(spark, shards):
    draws = [5_000, 0, 123, 2_877]
    leaves = sorted(mixing.shards_of(spark, draws, shards, 3).collect())
    assert [(r.low, r.high) for r in leaves] == [(i, i + 1) for i in range(shards)]
    sizes = [sum(r.parts) for r in leaves]
    assert max(sizes) - min(sizes) <= 1
    for s, n in enumerate(draws):
        at = 0
        for r in leaves:
            assert r.first[s] == at
            at += r.parts[s]
        assert at == n
    if shards == 7:  # each shard is a random part of the mix: every share lies within six deviations of its mean
        for r in leaves:
            share = sum(r.parts) / sum(draws)
            assert all(abs(p - n * share) <= 6 * (n * share) ** 0.5 + 1 for p, n in zip(r.parts, draws, strict=True))


def check(docs, pieces, rows, block, per_shard):
    """What the pieces must hold: targets, whole passes, blocks and texts."""
    sizes, of = {}, {}
    for doc, text, source in rows:
        found = WORD.findall(text or "")
        sizes[source] = sizes.get(source, 0) + len(found)
        of[doc] = (found, source)
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    aim = dict(zip(order, mixing.targets([sizes[s] for s in order], [(5, 2, 1)[i % 3] for i in range(len(order))]), strict=True))
    taken, spans, blocks = {}, {}, {}
    for p in pieces:
        found, source = of[p.doc_id]
        assert p.source == source and p.length > 0
        assert p.text == " ".join(found[p.start:p.start + p.length])
        taken[source] = taken.get(source, 0) + p.length
        spans.setdefault((p.doc_id, p.epoch), []).append((p.start, p.length))
        blocks.setdefault((p.shard, p.place), []).append((p.at, p.length))
    for s in order:
        assert taken.get(s, 0) == int(aim[s] + 0.5)
    for (doc, _), found in spans.items():  # a pass holds no word twice
        found.sort()
        assert all(a + n <= b for (a, n), (b, _) in zip(found, found[1:], strict=False))
    assert all(e < 3 for _, e in spans)
    for found in blocks.values():  # a block is a run of words without gaps
        found.sort()
        assert found[0][0] == 0 and sum(n for _, n in found) <= block
        assert all(a + n == b for (a, n), (b, _) in zip(found, found[1:], strict=False))
    places = {}
    for shard, place in blocks:
        places.setdefault(shard, set()).add(place)
    assert all(p == set(range(len(p))) and len(p) <= per_shard for p in places.values())
    assert sorted(places) == list(range(len(places)))
    return aim, taken


def test_pieces_of_all_documents(spark):
    d = table(spark, "documents")
    rows = [(r.doc_id, r.text, r.source) for r in d.collect()]
    more = {"block": 300, "per_shard": 8}
    pieces = mixing.mix(d, (5, 2, 1), **more).collect()
    check(d, pieces, rows, **more)
    again = mixing.mix(d.repartition(7), (5, 2, 1), **more).collect()
    assert sorted(map(tuple, pieces)) == sorted(map(tuple, again))
    other = mixing.mix(d, (5, 2, 1), seed=1, **more).collect()
    assert sorted(map(tuple, pieces)) != sorted(map(tuple, other))


@pytest.mark.parametrize("block", [300, mixing.BLOCK])
def test_account_says_what_the_pieces_hold(spark, block):
    d = table(spark, "documents")
    got = mixing.account(d, (5, 2, 1), block=block)
    sums = {r.doc_id: r.n for r in mixing.mix(d, (5, 2, 1), block=block).groupBy("doc_id").agg(F.sum("length").alias("n")).collect()}
    rows = got.collect()
    assert got.columns == ["doc_id", "size", "source_size", "target", "taken"]
    assert len(rows) == d.count()
    for r in rows:
        assert r.taken == sums.get(r.doc_id, 0) <= 3 * r.size
    assert sorted(map(tuple, rows)) == sorted(map(tuple, mixing.account(d.repartition(3), (5, 2, 1), block=block).collect()))


def test_hot_source_is_ordered_by_many_tasks(spark):
    rows = [(i, "w " * (i % 9), "hot" if i % 3 else f"s{i % 5}") for i in range(9_000)]
    pieces = mixing.mix(frame(spark, rows), (5, 2, 1), block=50, per_shard=20).collect()
    check(None, pieces, rows, 50, 20)


def test_odd_rows(spark):
    long = "word " * 300_000
    rows = [(1, None, "a"), (2, "", "a"), (3, " \t\n", None), (4, "one two", None), (5, "three", "b"), (None, "four five", "b"), (6, long, "c")]
    rows += [(7, "x y z", ""), (8, "same", "d"), (9, "same", "d")]
    check(None, mixing.mix(frame(spark, rows), (5, 2, 1), block=1_000, per_shard=4).collect(), rows, 1_000, 4)
    got = {r.doc_id: r for r in mixing.account(frame(spark, rows), (5, 2, 1)).collect()}
    assert got[1].size == got[1].taken == got[2].size == got[3].size == 0
    assert got[4].source_size == 2 and got[7].size == 2 and None in got
    assert mixing.account(frame(spark, []), (5, 2, 1)).collect() == []
    assert mixing.mix(frame(spark, []), (5, 2, 1)).collect() == []
    assert [r.taken for r in mixing.account(frame(spark, [(1, None, None)]), (5, 2, 1)).collect()] == [0]


def test_repeated_rows(spark):
    rows = [(1, "a b c", "s")] * 6 + [(2, "d e", "t")] * 3 + [(1, "a b c d", "t")]
    got = mixing.account(frame(spark, rows), (5, 2, 1), block=4)
    assert got.count() == 10
    taken = {r.source_size: r.n for r in got.groupBy("source_size").agg(F.sum("taken").alias("n")).collect()}
    aims = mixing.targets([18, 10], [5, 2])
    assert taken == {18: int(aims[0] + 0.5), 10: int(aims[1] + 0.5)}
    assert all(r.taken <= 3 * r.size for r in got.collect())


def test_other_columns_with_clashing_names(spark):
    names = "row long, size long, number long, block long, _source string, _key long, taken long, shard long"
    rows = [(i, "a b c d", f"s{i % 2}", 1, 1, 1, 1, "x", 1, 1, 1) for i in range(20)]
    got = mixing.account(frame(spark, rows, names), (5, 2, 1))
    assert got.columns == ["doc_id", "size", "source_size", "target", "taken"]
    pieces = mixing.mix(frame(spark, rows, names), (5, 2, 1), block=8, per_shard=3)
    assert pieces.columns == ["shard", "place", "at", "doc_id", "source", "epoch", "start", "length", "text"]
    check(None, pieces.collect(), [r[:3] for r in rows], 8, 3)


def test_too_many_draws(spark, monkeypatch):
    monkeypatch.setattr(mixing, "_MOST_DRAWS", 5)
    with pytest.raises(ValueError):
        mixing.account(frame(spark, [(1, "a b c d e f g", "s")]), (5, 2, 1), block=1)
