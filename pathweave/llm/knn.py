"""Exact top-k search by inner product: a Voronoi join with bounds from per-cell summaries."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pathweave.llm.scratch import written

_SCALE = 1024
_OUT = "query long, query_id long, vec_id long, score long"
_ASKED = "query long, vec_id long, v array<long>, cell int"


def integer_vectors(vectors: DataFrame) -> DataFrame:
    """``vec_id, v``: components as floor(1024 x), without vectors that are null or hold null or non-finite parts."""
    x = F.col("embedding")
    bad = F.exists(x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    kept = vectors.filter(F.col("vec_id").isNotNull() & x.isNotNull()).filter(~F.coalesce(bad, F.lit(True)))
    return kept.select("vec_id", F.transform(x, lambda e: F.floor(e.cast("double") * _SCALE).cast("long")).alias("v"))


def _matrix(vectors, width: int) -> np.ndarray:
    """Rows of one width; shorter vectors end in zeros, which add nothing to a product."""
    out = np.zeros((len(vectors), width), dtype=np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products: in doubles where no sum can leave 2^53, else in longs, else unbounded and clipped to a long."""
    size = a.shape[1] * float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0))
    if size < 2**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if size < 2**62:
        return a @ b.T
    exact = a.astype(object) @ b.astype(object).T
    return np.clip(exact, -(2**63), 2**63 - 1).astype(np.int64)


def _cells(pivots: np.ndarray):
    """Add to each vector its nearest pivot and the distance from it."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = _matrix(batch["v"], pivots.shape[1]).astype(np.float64)
            apart = (x * x).sum(1)[:, None] - 2 * x @ pivots.T + (pivots * pivots).sum(1)
            cell = apart.argmin(1)
            yield batch.assign(cell=cell.astype(np.int32), apart=np.sqrt(((x - pivots[cell]) ** 2).sum(1)))

    return run


def _needed(pivots: np.ndarray, count: np.ndarray, radius: np.ndarray, k: int):
    """Send each query to the cells that can hold one of its best.

    A cell's products with q lie within |q| times its radius of q's product with the pivot. The k rows
    of the best lower bounds, and as many more as have the query's own id, give a score that the k-th best can't be below.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            q = _matrix(batch["v"], pivots.shape[1]).astype(np.float64)
            middle = q @ pivots.T
            reach = np.sqrt((q * q).sum(1))[:, None] * radius * (1 + 1e-9) + 1 + 1e-9 * np.abs(middle)
            low, high = middle - reach, middle + reach
            order = np.argsort(-low, axis=1)
            enough = np.cumsum(count[order], axis=1) >= k + batch["own"].to_numpy()[:, None]
            at = np.where(enough.any(1), enough.argmax(1), len(count) - 1)
            floor = np.take_along_axis(low, np.take_along_axis(order, at[:, None], 1), 1)
            rows, cells = np.nonzero((high >= floor) & (count > 0))
            taken = {c: batch[c].to_numpy()[rows] for c in ("query", "vec_id", "v")}
            yield pd.DataFrame({**taken, "cell": cells.astype(np.int32)})

    return run


def _best(k: int, width: int):
    """The k best of one block of data for each query of one block of queries."""

    def run(queries: pd.DataFrame, data: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(queries) and len(data):
            data = data.sort_values("vec_id", kind="stable")
            ids, b = data["vec_id"].to_numpy(), _matrix(data["v"], width)
            for at in range(0, len(queries), 512):
                part = queries.iloc[at:at + 512]
                scores = _products(_matrix(part["v"], width), b)
                for query, own, row in zip(part["query"], part["vec_id"], scores, strict=True):
                    others = np.flatnonzero(ids != own)
                    row = row[others]
                    order = np.argsort(-row, kind="stable")[:k] if len(row) <= 4 * k else _top(row, k)
                    out.append(pd.DataFrame({"query": query, "query_id": own, "vec_id": ids[others[order]], "score": row[order]}))
        return pd.concat(out) if out else pd.DataFrame({"query": [], "query_id": [], "vec_id": [], "score": []}, dtype="int64")

    return run


def _top(row: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest, ties to the earlier place."""
    least = np.partition(row, len(row) - k)[len(row) - k]
    above = np.flatnonzero(row > least)
    equal = np.flatnonzero(row == least)[: k - len(above)]
    places = np.concatenate((above, equal))
    return places[np.lexsort((places, -row[places]))]


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, pivots: int = 32, data_block: int = 8192, query_block: int = 4096) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each distinct row of ``queries`` the ``k`` rows of ``vectors`` with the highest product.

    Both have ``vec_id`` and ``embedding``. Vectors become whole numbers, floor(1024 x). A query's own row (equal
    ``vec_id``) is no candidate; ties go to the smaller ``vec_id``; fewer than ``k`` candidates are all returned.
    Data fall into the cells of ``pivots`` of their own vectors; a cell's count and radius bound its products, and
    a query goes only to cells that can hold one of its best. Cells are dealt into blocks of about ``data_block``
    rows and the queries of a cell into blocks of about ``query_block``, so that no cell outgrows a task, even if
    most vectors or ids are equal; each pair of blocks gives ``k`` rows per query.

    Null ids, null vectors and vectors with null or non-finite parts take no part. Vectors of unequal length are
    compared as if the shorter ended in zeros; an empty vector scores zero. Rows that repeat an id are candidates
    each; queries of one id and different vectors have ranks of their own. Scores beyond a long are clipped to it. Other columns are ignored; no rows in, no rows out.
    """
    spark = vectors.sparkSession
    data = written(integer_vectors(vectors).withColumn("row", F.monotonically_increasing_id()), "vectors")
    asked = integer_vectors(queries).distinct().withColumn("query", F.monotonically_increasing_id())
    own = data.join(asked.select("vec_id").distinct(), "vec_id", "left_semi").groupBy("vec_id").agg(F.count("*").alias("own"))
    asked = written(asked.join(own, "vec_id", "left").select("query", "vec_id", "v", F.coalesce("own", F.lit(0)).alias("own")), "queries")
    seen = [r.v for r in data.select("v").distinct().orderBy(F.xxhash64("v"), "v").limit(pivots).collect()]
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if not seen:
        return empty
    width = max(data.agg(F.max(F.size("v"))).first()[0], asked.agg(F.coalesce(F.max(F.size("v")), F.lit(0))).first()[0], 1)
    centres = _matrix(seen, width).astype(np.float64)
    celled = written(data.mapInPandas(_cells(centres), "vec_id long, v array<long>, row long, cell int, apart double"), "cells")
    summary = celled.groupBy("cell").agg(F.count("*").alias("n"), F.max("apart").alias("radius")).collect()
    count, radius = np.zeros(len(seen), dtype=np.int64), np.zeros(len(seen))
    for row in summary:
        count[row.cell], radius[row.cell] = row.n, row.radius
    sent = written(asked.mapInPandas(_needed(centres, count, radius, k), _ASKED), "asked")
    many = {r.cell: -(-r["n"] // query_block) for r in sent.groupBy("cell").agg(F.count("*").alias("n")).collect()}
    cell = F.col("cell") + 1  # arrays of at most ``pivots`` counts, looked up by cell
    salts = F.element_at(F.array(*[F.lit(int(-(-n // data_block)) or 1) for n in count]), cell)
    parts = F.element_at(F.array(*[F.lit(many.get(c, 0)) for c in range(len(count))]), cell)
    blocks = celled.withColumn("salt", F.pmod(F.xxhash64("row"), salts).cast("int")).filter(parts > 0)
    blocks = blocks.withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))).select("vec_id", "v", "cell", "salt", "part")
    asks = sent.withColumn("part", F.pmod(F.xxhash64("query"), parts).cast("int"))
    asks = asks.withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1))).select("query", "vec_id", "v", "cell", "salt", "part")
    key = ("cell", "salt", "part")
    near = asks.groupBy(*key).cogroup(blocks.groupBy(*key)).applyInPandas(_best(k, width), _OUT)
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id")
    ranked = near.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
