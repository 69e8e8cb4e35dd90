"""Buckets of a join key as lists of bounded length that together hold every pair of a bucket."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bucket_lists(rows: DataFrame, key: str, member: str, most: int) -> DataFrame:
    """``members`` (sorted array) for the buckets of ``rows`` with two members or more; equal lists come once.

    A bucket of up to ``most`` members is one list. A larger one is dealt into tiles of about half as many by
    the member's hash, and each pair of tiles is a list of its own: every pair of members still shares a list,
    and no list outgrows a task. ``rows`` must hold distinct (key, member) pairs.
    """
    sizes = rows.groupBy(key).agg(F.count("*").alias("_n")).filter("_n > 1")
    tiles = F.when(F.col("_n") > most, F.ceil(2 * F.col("_n") / F.lit(most))).otherwise(F.lit(1)).cast("int")
    dealt = (
        rows.join(sizes, key).withColumn("_tiles", tiles)
        .withColumn("_tile", F.pmod(F.xxhash64(member), F.col("_tiles")).cast("int"))
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_tiles") - 1)))
        .select(key, member, F.least("_tile", "_other").alias("_i"), F.greatest("_tile", "_other").alias("_j"))
    )
    lists = dealt.groupBy(key, "_i", "_j").agg(F.sort_array(F.collect_list(member)).alias("members"))
    return lists.filter(F.size("members") > 1).select("members").distinct()
