import math
import random

from pathweave.llm import knn
from pyspark.sql import functions as F
from tests.llm.helpers import table

SCHEMA = "vec_id long, embedding array<float>, score string, cell int"


def brute(rows, asked, k=10):
    def ok(v):
        return v is not None and all(x is not None and math.isfinite(x) for x in v)

    held = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if i is not None and ok(v)]
    out = []
    for q, x in held:
        if asked(q):
            scores = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in held if i != q)
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])]
    return sorted(out)


def run(spark, rows, asked, where, **more):
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], SCHEMA)
    return sorted(map(tuple, knn.top_k(df, df.filter(where), **more).collect()))


def test_ties_hot_vector_and_bad_rows(spark):
    random.seed(2)
    f = [-1.0, -0.5, -0.25, 0.0, 0.25, 0.5, 0.75]
    rows = [(i, [random.choice(f) for _ in range(6)]) for i in range(150)] + [(i, [0.5] * 6) for i in range(150, 260)]
    rows += [(300, None), (301, [None] * 6), (302, [float("nan")] * 6), (303, [float("inf")] * 6), (304, []), (None, [1.0] * 6), (400, [1.0, 1.0])]
    asked = lambda q: q % 20 == 0
    assert run(spark, rows, asked, "vec_id % 20 = 0", data_block=40, query_block=3, pivots=5) == brute(rows, asked)


def test_few_rows_and_none(spark):
    rows = [(0, [1.0, 2.0]), (1, [0.5, -3.0]), (100, [2.0, 2.0])]
    assert run(spark, rows, lambda q: q % 100 == 0, "vec_id % 100 = 0") == brute(rows, lambda q: q % 100 == 0)
    assert run(spark, [], None, "true") == []
    assert run(spark, [(1, [1.0])], None, "vec_id = 2") == []


def test_large_components_stay_exact(spark):
    rows = [(i, [float(2**40 + i * 2**20), float(-(2**12)), float(i)]) for i in range(8)]
    asked = lambda q: q < 2
    want = [(q, r, i, max(-(2**63), min(2**63 - 1, s))) for q, r, i, s in brute(rows, asked)]
    assert [(q, s) for q, _, _, s in run(spark, rows, asked, "vec_id < 2")] == [(q, s) for q, _, _, s in want]


def test_embeddings_against_brute_force(spark):
    df = table(spark, "embeddings")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    got = sorted(map(tuple, knn.top_k(df, df.filter(F.col("vec_id") % 100 == 0)).collect()))
    assert got == brute(rows, lambda q: q % 100 == 0)


def test_repeated_ids_as_queries_and_as_data(spark):
    random.seed(3)
    vector = lambda: [random.choice([-1.0, -0.5, 0.25, 0.75]) for _ in range(4)]
    own = [9.0] * 4
    data = [(i, vector()) for i in range(60)] + [(7, own)] * 25 + [(8, vector()) for _ in range(20)]
    asked = [(7, own), (7, own), (7, [-1.0, 0.5, 0.5, 1.0]), (8, vector()), (100, own)]
    frame = lambda rows: spark.createDataFrame([(i, v, "x", 1) for i, v in rows], SCHEMA)
    want = []
    for q, x in {(q, tuple(v)) for q, v in asked}:
        scores = sorted((-sum(math.floor(1024 * a) * math.floor(1024 * b) for a, b in zip(x, y)), i) for i, y in data if i != q)
        want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:10])]
    got = knn.top_k(frame(data), frame(asked), data_block=16, query_block=2, pivots=6)
    assert sorted(map(tuple, got.collect())) == sorted(want)
