"""A corpus from raw documents to packed sequences: quality, lines, near duplicates, personal data, packing.

A null text counts as empty where a stage reads it; a null id is an id; repeated rows are one document where a stage looks for
duplicates, and rows of their own elsewhere. Columns beyond those of ``documents`` pass through all stages but the last,
whatever their names. An empty table gives empty tables.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pathweave.functions.columns import named
from pathweave.llm import line_dedup, packing, pii, rule_quality, similar_docs
from pathweave.llm.scratch import written

#: Key of the surrogates; a real run sets its own, from where it keeps its secrets.
KEY = os.environ.get("PATHWEAVE_SURROGATE_KEY", "test corpus")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules accept."""
    return rule_quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that stand elsewhere; each document stays, if need be with an empty text."""
    return _as_documents(line_dedup.dedup(_carried(docs)), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of five-word similarity 0.8 or more: the one with its smallest id."""
    out = similar_docs.one_of_each(_carried(docs), width=5, similarity=0.8)
    return _as_documents(out, docs, changed=False)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with surrogates for personal data."""
    return _as_documents(pii.pseudonymise(_carried(docs), KEY), docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place of every piece of every document in the packed sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality", quality), ("lines", lines), ("near duplicates", near_duplicates), ("personal data", personal_data), ("packing", packed),
]

#: Fitted models, similarity and tokenizers have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def _carried(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text``, and all other columns as one, so that none of their names meets one of an operator's own."""
    rest = [named(c) for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select("doc_id", "text", *([F.struct(*rest).alias("document")] if rest else []))


def _as_documents(out: DataFrame, docs: DataFrame, changed: bool = True) -> DataFrame:
    """The columns of ``docs``; ``n_chars`` is that of a changed text."""
    made = {"doc_id": F.col("doc_id"), "text": F.col("text")} | ({"n_chars": F.length("text")} if changed else {})
    return out.select(*[(made[c] if c in made else F.col("document").getField(c)).cast(kind).alias(c) for c, kind in docs.dtypes])


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each stage but the last is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
