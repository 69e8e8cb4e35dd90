"""Mixing of sources to target weights: a splitting tree deals exact block quotas of the sources to output shards.

The documents of a source stand in a keyed order, and their words form one stream that is cut into blocks. A source gives
as many draws of blocks as its target needs; whole passes over the stream come first, then a part of one. A tree
over the output shards parts the quotas: at each node the left half's share of each source is drawn from the
multivariate hypergeometric distribution, so that every shard looks like a random part of the whole mix while all quotas
hold exactly. Each shard owns a range of the draws of each source; a keyed permutation says which block a draw
is, so that ranges are disjoint sets of blocks. A shard shuffles its own draws.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pathweave.llm.scratch import written

#: Words in a block. Draws of a mix must stay below 10^9 (a bound of the sampler), which is 30 trillion words.
BLOCK = 32_768
#: Draws in an output shard.
SHARD = 64
_MOST_DRAWS = 10**9
#: Levels of the tree that one task splits: at most 1,024 nodes come from one.
_LEVELS = 10
#: Rows of a source whose order one task makes.
_BUCKET_ROWS = 2_000
_WORD = r"[^\x20\x09-\x0D]++"


@dataclass(frozen=True)
class Quota:
    """What a source gives: ``words`` in all, as ``draws`` of blocks, of which the last may be cut short."""

    source: str | None
    rows: int
    size: int
    target: float
    words: int
    whole: int
    short: int
    draws: int
    last: int

    @property
    def per_pass(self) -> int:
        return self.whole + (self.short > 0)


def targets(sizes: Sequence[int], weights: Sequence[float], share: float = 1.0, most: float = 3.0) -> list[float]:
    """Words that each source should give: ``share`` of all words by weight, at most ``most`` times its size.

    What goes beyond that is shared again by weight among the others, until none is above or all are full.
    """
    out = [0.0] * len(sizes)
    free, left = {i for i, w in enumerate(weights) if w > 0}, share * sum(sizes)
    while free:
        weight = sum(weights[i] for i in free)
        full = {i for i in free if left * weights[i] / weight > most * sizes[i]}
        for i in full or free:
            out[i] = most * sizes[i] if full else left * weights[i] / weight
        if not full:
            break
        free -= full
        left -= sum(out[i] for i in full)
    return out


def quota(source: str | None, rows: int, size: int, target: float, block: int) -> Quota:
    """Draws for the words nearest to the target. A pass takes whole blocks in permuted order, then the short one, if any."""
    words = int(target + 0.5)
    whole, short = divmod(size, block)
    passes, rest = divmod(words, size) if size else (0, 0)
    per_pass = whole + (short > 0)
    part = min(-(-rest // block), whole + (rest > whole * block))
    last = rest - (part - 1) * block if part else (short or block)
    return Quota(source, rows, size, target, words, whole, short, passes * per_pass + part, last)


def permuted(at: np.ndarray, n: int, key: Sequence[int]) -> np.ndarray:
    """A keyed permutation of 0 to n - 1: a Feistel network over the next even number of bits, walked until it is below n."""
    half = np.uint64(max(1, -(-int(n - 1).bit_length() // 2)))
    mask = np.uint64((1 << int(half)) - 1)
    keys = np.random.default_rng(list(key)).integers(0, 2**63, 6).astype(np.uint64)
    out = at.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> half, out[todo] & mask
        for k in keys:
            mixed = (right + k) * np.uint64(0x9E3779B97F4A7C15)
            mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ ((mixed >> np.uint64(32)) & mask)
        out[todo] = left << half | right
        todo = todo[out[todo] >= n]
    return out.astype(np.int64)


def _split(first: np.ndarray, parts: np.ndarray, low: int, high: int, starts, seed: int, levels: int) -> Iterator[tuple]:
    """Nodes ``levels`` below, or leaves: shards from ``low`` to ``high``, and the first draw and the count of each source."""
    if not levels or high - low == 1:
        yield low, high, first, parts
        return
    middle = (low + high) // 2
    drawn = np.random.default_rng([seed, low, high]).multivariate_hypergeometric(parts, starts(middle) - starts(low), method="marginals")
    yield from _split(first, drawn, low, middle, starts, seed, levels - 1)
    yield from _split(first + drawn, parts - drawn, middle, high, starts, seed, levels - 1)


def shards_of(spark, draws: Sequence[int], shards: int, seed: int) -> DataFrame:
    """``low, high, first, parts``: for each shard (``low``) the first draw and the count of draws of each source."""
    total = sum(draws)

    def starts(shard: int) -> int:
        return shard * total // shards

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                first, parts = (np.array(row[c], dtype=np.int64) for c in ("first", "parts"))
                nodes = list(_split(first, parts, row["low"], row["high"], starts, seed, _LEVELS))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([n[i] for n in nodes], pa.int64()) for i in (0, 1)]
                    + [pa.array([n[i].tolist() for n in nodes], pa.list_(pa.int64())) for i in (2, 3)],
                    ["low", "high", "first", "parts"],
                )

    schema = "low long, high long, first array<long>, parts array<long>"
    nodes = spark.createDataFrame([(0, shards, [0] * len(draws), [int(d) for d in draws])], schema)
    width = shards
    while width > 1:
        nodes = nodes.repartition("low").mapInArrow(run, schema)
        width = -(-width // 2**_LEVELS)
    return nodes


def _draws(quotas: list[Quota], block: int, seed: int):
    """The draws of each shard in shuffled order, with the block that each is and how many of its words count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                found: list[tuple] = []
                for number, (first, n) in enumerate(zip(row["first"], row["parts"], strict=True)):
                    q = quotas[number]
                    if not n:
                        continue
                    draw = np.arange(first, first + n)
                    passes, at = np.divmod(draw, q.per_pass)
                    is_whole = at < q.whole
                    for p in np.unique(passes):
                        of = is_whole & (passes == p)
                        at[of] = permuted(at[of], q.whole, (seed, number, int(p)))
                    keep = np.where(is_whole, block, q.short)
                    keep[draw == q.draws - 1] = q.last
                    found.append((np.full(n, number), passes, at, keep))
                if not found:
                    continue
                columns = [np.concatenate(c) for c in zip(*found, strict=True)]
                place = np.random.default_rng([seed, row["low"]]).permutation(len(columns[0]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c.astype(np.int64)) for c in (np.full(len(place), row["low"]), place, *columns)],
                    ["shard", "place", "number", "epoch", "block", "keep"],
                )

    return run


def _streamed(sized: DataFrame, quotas: list[Quota], seed: int) -> DataFrame:
    """``sized`` with the ``number`` of its source and ``before``, the words that precede it in the source's keyed order.

    Rows are dealt to buckets by key, so that the order of a hot source is made by many tasks; sums of buckets go before.
    """
    known = sized.sparkSession.createDataFrame(
        [(i, q.source, -(-q.rows // _BUCKET_ROWS)) for i, q in enumerate(quotas)], "number long, _source string, _buckets long"
    )
    rows = sized.filter("size > 0").join(F.broadcast(known), F.col("source").eqNullSafe(F.col("_source")))
    key = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col("doc_id")), 11)
    rows = rows.withColumn("_key", key).withColumn("_bucket", F.floor(F.col("_key") / F.lit(2.0**53) * F.col("_buckets")))
    sums = rows.groupBy("number", "_bucket").agg(F.sum("size").alias("_sum"))
    ahead = F.sum("_sum").over(Window.partitionBy("number").orderBy("_bucket")) - F.col("_sum")
    inside = F.sum("size").over(
        Window.partitionBy("number", "_bucket").orderBy("_key", "doc_id", "size", "row").rowsBetween(Window.unboundedPreceding, 0)
    )
    rows = rows.withColumn("_inside", inside - F.col("size"))
    sums = sums.select("number", "_bucket", ahead.alias("_ahead"))
    return rows.join(sums, ["number", "_bucket"]).withColumn("before", F.col("_inside") + F.col("_ahead"))


def _sized(docs: DataFrame, *texts: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", F.col("source").cast("string").alias("source"),
        F.regexp_count(text, F.lit(_WORD)).cast("long").alias("size"), *texts,
    )


def plan(sized: DataFrame, weights: Sequence[float], share: float, most: float, block: int) -> list[Quota]:
    """Quotas of all sources in order of code points, null last; ``weights`` repeat along that order.

    One row for each source comes to the driver: a mix names a weight for each, so they are few.
    """
    found = sized.groupBy("source").agg(F.count("*").alias("rows"), F.sum("size").alias("size")).collect()
    found.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    sizes = [r["size"] for r in found]
    aims = targets(sizes, [weights[i % len(weights)] for i in range(len(found))], share, most)
    out = [quota(r["source"], r["rows"], r["size"], t, block) for r, t in zip(found, aims, strict=True)]
    if sum(q.draws for q in out) >= _MOST_DRAWS:
        raise ValueError(f"{sum(q.draws for q in out)} draws of {block} words are more than the sampler takes: choose larger blocks")
    return out


def _pieces(sized: DataFrame, quotas: list[Quota], block: int, per_shard: int, seed: int) -> DataFrame:
    shards = max(1, -(-sum(q.draws for q in quotas) // per_shard))
    leaves = shards_of(sized.sparkSession, [q.draws for q in quotas], shards, seed)
    schema = "shard long, place long, number long, epoch long, block long, keep long"
    drawn = leaves.repartition("low").mapInArrow(_draws(quotas, block, seed), schema)
    rows = _streamed(sized.select("row", "doc_id", "source", "size"), quotas, seed)
    end = F.col("before") + F.col("size")
    blocks = F.sequence(F.floor(F.col("before") / block), F.floor((end - 1) / block))
    cut = rows.select("row", "doc_id", "source", "number", "before", "size", F.explode(blocks).alias("block"))
    opens = F.col("block") * F.lit(block)
    first, last = F.greatest("before", opens), F.least(end, opens + block)
    cut = cut.select("row", "doc_id", "source", "number", "block", (first - opens).alias("at"), (first - F.col("before")).alias("start"),
                     (last - first).alias("_length"))
    length = F.least(F.col("_length"), F.col("keep") - F.col("at"))
    met = drawn.join(cut, ["number", "block"]).withColumn("length", length).filter("length > 0")
    return met.select("shard", "place", "at", "row", "doc_id", "source", "epoch", "start", "length")


def mix(
    docs: DataFrame, weights: Sequence[float], share: float = 1.0, most: float = 3.0, block: int = BLOCK, per_shard: int = SHARD,
    seed: int = 42,
) -> DataFrame:
    """The mix as pieces of documents: ``shard, place, at, doc_id, source, epoch, start, length, text``.

    A shard holds its pieces in order of ``place`` (of a block in the shard) and ``at`` (words before it in the block). A piece is
    ``length`` words of a document from word ``start`` on, ``text`` these words joined by one space. Sources in order of code
    points, null last, weigh ``weights``, repeating; they share ``share`` of all words. A source gives at most ``most`` times its words,
    each document in a pass once, so that no document goes beyond that. A source's pieces come to its target, rounded.

    A null or empty text has no words and no piece; a null source is a source. Rows that repeat an id, or are
    equal, are rows of their own. Other columns are ignored, whatever their names; an empty table gives no rows.
    The same rows and seed give the same pieces (rows of one id and size may stand for each other).
    """
    sized = written(_sized(docs, "text"), "sized")
    pieces = _pieces(sized, plan(sized, weights, share, most, block), block, per_shard, seed)
    words = F.regexp_extract_all("text", F.lit(_WORD), F.lit(0))
    cut = F.array_join(F.slice(words, (F.col("start") + 1).cast("int"), F.col("length").cast("int")), " ")
    return pieces.join(sized.select("row", "text"), "row").withColumn("text", cut).drop("row")


def account(
    docs: DataFrame, weights: Sequence[float], share: float = 1.0, most: float = 3.0, block: int = BLOCK, per_shard: int = SHARD,
    seed: int = 42,
) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` for every row of ``docs``: what the mix of :func:`mix` takes of it.

    ``target`` is that of its source in words, ``taken`` counts words each time the mix holds them. Nulls, repeats and empty
    tables are treated as there.
    """
    sized = written(_sized(docs), "sized")
    quotas = plan(sized, weights, share, most, block)
    taken = _pieces(sized, quotas, block, per_shard, seed).groupBy("row").agg(F.sum("length").alias("taken"))
    known = sized.sparkSession.createDataFrame(
        [(q.source, q.size, q.target) for q in quotas], "_source string, source_size long, target double"
    )
    out = sized.join(F.broadcast(known), F.col("source").eqNullSafe(F.col("_source"))).join(taken, "row", "left")
    return out.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))
