"""Quality classifier: a sparse ensemble of rules over text statistics, compiled into Spark column expressions.

Small boosted trees are grown on a bounded sample of labelled documents; each of their paths is a conjunctive rule.
A lasso logistic regression over the rules keeps few of them, and the weighted rules become one column
expression, so that scoring a corpus is a projection without Python.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pathweave.functions.columns import bind, once

#: Most labelled documents that a model is fitted on; they are chosen by a hash of the id.
MOST_ROWS = 20_000
TREES, DEPTH, SHRINK, CUTS = 24, 3, 0.3, 24
PENALTY = 0.002
THRESHOLD = 0.3


def statistics(text: Column) -> dict[str, Column]:
    """Named statistics of a text; each is a finite double, for an empty text too."""
    n = F.greatest(F.length(text), F.lit(1))
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    lines = F.split(text, "\n")

    def share(pattern: str) -> Column:
        return F.regexp_count(text, F.lit(pattern)) / n

    def of_words(w: Column) -> Column:
        total = F.greatest(F.size(w), F.lit(1))
        same = F.filter(w, lambda x, i: (i > 0) & (x == F.get(w, i - 1)))
        return F.struct(
            F.size(w).cast("double").alias("n_words"),
            (F.size(F.array_distinct(w)) / total).alias("distinct_words"),
            (F.size(same) / total).alias("repeated_words"),
            (F.aggregate(w, F.lit(0), lambda a, x: a + F.length(x)) / total).alias("word_length"),
        )

    return {
        "n_chars": F.length(text).cast("double"),
        "upper": share(r"\p{Lu}"),
        "digits": share(r"\p{N}"),
        "symbols": share(r"[^\p{L}\p{N}\s.,;:!?'\"()-]"),
        "stops": share(r"[.!?]"),
        "commas": share(","),
        "words": bind(words, of_words),
        "line_length": n / F.size(lines),
        "distinct_lines": F.size(F.array_distinct(lines)) / F.size(lines),
    }


FEATURES = (
    "n_chars", "upper", "digits", "symbols", "stops", "commas", "line_length", "distinct_lines",
    "n_words", "distinct_words", "repeated_words", "word_length",
)


_OF_WORDS = FEATURES[-4:]


def with_statistics(rows: DataFrame) -> DataFrame:
    """``rows`` with the struct ``_stats`` in place of ``_text``, each statistic computed once per row."""
    held = once(rows, drop=["_text"], **{f"_{k}": v for k, v in statistics(F.col("_text")).items()})
    kept = [c for c in rows.columns if c != "_text"]
    fields = [F.col(f"_words.{c}" if c in _OF_WORDS else f"_{c}").alias(c) for c in FEATURES]
    return held.select(*kept, F.struct(*fields).alias("_stats"))


def _text() -> Column:
    return F.coalesce(F.col("text"), F.lit("")).alias("_text")


def held_out(doc_id: Column) -> Column:
    """The fifth of the ids that no model learns from; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 0


@dataclass(frozen=True)
class Rule:
    """All of the conditions (feature, is it above?, cut) must hold."""

    conditions: tuple[tuple[str, bool, float], ...]

    def column(self, stats: Column) -> Column:
        terms = [stats[f] > cut if above else stats[f] <= cut for f, above, cut in self.conditions]
        out = terms[0]
        for term in terms[1:]:
            out = out & term
        return out

    def values(self, x: np.ndarray) -> np.ndarray:
        out = np.ones(len(x), dtype=bool)
        for f, above, cut in self.conditions:
            values = x[:, FEATURES.index(f)]
            out &= values > cut if above else values <= cut
        return out


@dataclass(frozen=True)
class Model:
    """Weighted rules and an intercept; ``score`` is a column expression."""

    intercept: float
    rules: tuple[tuple[Rule, float], ...]

    def score(self, stats: Column) -> Column:
        total = F.lit(float(self.intercept))
        for rule, weight in self.rules:
            total = total + F.when(rule.column(stats), float(weight)).otherwise(0.0)
        return 1.0 / (1.0 + F.exp(-total))


def _grow(x: np.ndarray, cuts: list[np.ndarray], residual: np.ndarray, rows: np.ndarray, depth: int, path: tuple, out: list) -> None:
    """Split where the squared error falls most; ``out`` gets each node's path and each leaf's rows and mean."""
    best = (1e-9, None, None)
    total, n = residual[rows].sum(), len(rows)
    if depth and n >= 20:
        for f in range(x.shape[1]):
            above = x[rows, f][:, None] > cuts[f]
            many = above.sum(0)
            part = residual[rows] @ above
            gain = np.where((many >= 10) & (n - many >= 10), part**2 / np.maximum(many, 1) + (total - part) ** 2 / np.maximum(n - many, 1) - total**2 / n, 0)
            if len(gain) and gain.max() > best[0]:
                best = (gain.max(), f, cuts[f][int(gain.argmax())])
    if path:
        out.append((path, None, None))
    if best[1] is None:
        out.append((path, rows, total / max(n, 1)))
        return
    high = x[rows, best[1]] > best[2]
    for above in (False, True):
        _grow(x, cuts, residual, rows[high == above], depth - 1, (*path, (FEATURES[best[1]], above, float(best[2]))), out)


def _lasso(z: np.ndarray, y: np.ndarray, penalty: float, steps: int = 600) -> tuple[float, np.ndarray]:
    """Logistic weights with an L1 penalty, by accelerated proximal gradient; the intercept is free."""
    a = np.concatenate((np.ones((len(z), 1)), z), axis=1)
    rate = 4 * len(a) / (np.linalg.norm(a, 2) ** 2)
    w = v = np.zeros(a.shape[1])
    t = 1.0
    for _ in range(steps):
        gradient = a.T @ (1 / (1 + np.exp(-np.clip(a @ v, -30, 30))) - y) / len(a)
        new = v - rate * gradient
        new[1:] = np.sign(new[1:]) * np.maximum(np.abs(new[1:]) - rate * penalty, 0)
        after = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, w, t = new + (t - 1) / after * (new - w), new, after
    return float(w[0]), w[1:]


def fit(x: np.ndarray, y: np.ndarray, penalty: float = PENALTY) -> Model:
    """Model of the labels; without rows it always says one half, with one class only nearly that class."""
    if not len(y):
        return Model(0.0, ())
    prior = float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)))
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0.02, 0.98, CUTS))) for f in range(x.shape[1])]
    random = np.random.default_rng(7)
    margin, paths = np.full(len(y), prior), {}
    for _ in range(TREES):
        rows = np.sort(random.permutation(len(y))[: max(1, len(y) * 7 // 10)])
        residual = y - 1 / (1 + np.exp(-margin))
        out: list = []
        _grow(x, cuts, residual, rows, DEPTH, (), out)
        for path, at, mean in out:
            if at is None:
                paths[tuple(sorted(path))] = None
            else:
                margin = margin + SHRINK * 4 * mean * (Rule(path).values(x) if path else 1)
    rules = [Rule(p) for p in paths]
    columns = np.array([r.values(x) for r in rules], dtype=np.float64).T if rules else np.zeros((len(y), 0))
    intercept, weights = _lasso(columns, y, penalty)
    kept = tuple((r, float(w)) for r, w in zip(rules, weights, strict=True) if abs(w) > 1e-6)
    return Model(intercept, kept) if kept else Model(prior, ())


def learn(docs: DataFrame, labels: DataFrame, most: int = MOST_ROWS) -> Model:
    """Model of ``labels.quality`` from the statistics of at most ``most`` labelled documents that aren't held out.

    The sample is the ids with the smallest hashes, so it is the same however the rows are spread; only its
    statistics reach the driver. Labels other than 0 and 1 and null ids are left out.
    """
    usable = labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    chosen = usable.select(F.col("doc_id").alias("_of"), "quality").orderBy(F.xxhash64("_of"), "_of", "quality").limit(most)
    rows = docs.select("doc_id", _text()).join(F.broadcast(chosen), F.col("doc_id") == F.col("_of")).drop("doc_id")
    few = with_statistics(rows).select("_stats.*", "quality", "_of")
    sample = few.orderBy(F.xxhash64("_of"), *few.columns).limit(most).drop("_of").toPandas()
    return fit(sample[list(FEATURES)].to_numpy(dtype=np.float64), sample["quality"].to_numpy(dtype=np.float64))


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``."""
    rows = with_statistics(docs.select("doc_id", _text()))
    held = once(rows, drop=["_stats"], _held=held_out(F.col("doc_id")), _score=model.score(F.col("_stats")))
    return held.select("doc_id", F.col("_held").alias("held_out"), F.col("_score").alias("score"),
                       (F.col("_score") >= threshold).cast("int").alias("predicted"))


def classify(docs: DataFrame, labels: DataFrame, most: int = MOST_ROWS) -> DataFrame:
    """Learn from the labelled documents and score all: ``doc_id, held_out, score, predicted``.

    A null text counts as empty; repeated rows get equal scores; a null id counts as held out. Columns other than
    ``doc_id`` and ``text`` are never read. Without usable labels every score is one half. An empty table gives no rows.
    """
    return score(docs, learn(docs, labels, most))


def keep_good(docs: DataFrame, labels: DataFrame, most: int = MOST_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose score reaches the threshold."""
    model = learn(docs, labels, most)
    names = {f"_k{i}": c for i, c in enumerate(docs.columns)}
    # the row travels beside its statistics, so that no join by id is needed
    row = F.struct(*[F.col(f"`{c}`").alias(k) for k, c in names.items()])
    stats = with_statistics(docs.select(row.alias("_row"), _text()))
    scored = once(stats, drop=["_stats"], _score=model.score(F.col("_stats")))
    return scored.filter(F.col("_score") >= threshold).select(*[F.col(f"_row.{k}").alias(c) for k, c in names.items()])
