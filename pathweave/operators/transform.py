"""Change the string leaves that match wildcard path patterns."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.columns import once
from ..functions.paths import path_matches


def transform_fields(
    df: DataFrame,
    patterns: Sequence[str],
    fn: Callable[[Column], Column] = F.upper,
    udf: Callable[[Column], Column] | None = None,
    count: str | None = None,
    batch: Callable[[pa.Array], pa.Array] | None = None,
) -> DataFrame:
    """Apply ``fn`` to every string leaf whose path matches a pattern; others stay as they are.

    ``fn`` maps a Column to a Column and runs in the JVM.  ``udf`` is for code that cannot be
    written as a Column: an Arrow or pandas UDF from ``ARRAY<STRING>`` to ``ARRAY<STRING>`` of
    equal length that receives the matching values of a row.  ``batch`` maps an Arrow string array to one of
    equal length: one call sees the matching values of a whole Arrow batch, without a Python loop over rows.  ``count`` names a column for the
    number of leaves processed.  An exception in ``fn``, ``udf`` or ``batch`` fails the job.
    """

    def hit(e: Column) -> Column:
        return (e.getField("leaf_type") == "STRING") & path_matches(e.getField("path"), patterns)

    if count is not None:
        df = df.withColumn(count, F.coalesce(F.size(F.filter("flat", hit)), F.lit(0)))
    if batch is not None:
        return _through_batch(df, hit, batch)
    if udf is None:
        changed = F.transform(
            "flat", lambda e: F.when(hit(e), e.withField("value", fn(e.getField("value")))).otherwise(e)
        )
        return once(df, flat=changed)
    return _through_udf(df, hit, udf)


def over_values(fn: Callable[[pa.Array], pa.Array]) -> Callable[[Column], Column]:
    """An Arrow UDF that hands the values of a batch of lists of ``hit, value`` to ``fn`` at once, those of hits only.

    It gives lists of equal lengths with what ``fn`` made of a hit at its place, and nulls at the others.
    """

    @F.arrow_udf("array<string>")
    def call(lists: pa.Array) -> pa.Array:
        leaves = lists.flatten()
        hits = leaves.field("hit")
        values = leaves.field("value").filter(hits)
        made = pc.cast(fn(values), pa.string())
        if len(made) != len(values):
            raise ValueError(f"{len(values)} values became {len(made)}")
        nth = pc.subtract(pc.cumulative_sum(pc.cast(hits, pa.int64())), 1)
        placed = made.take(pc.if_else(hits, nth, pa.scalar(None, pa.int64())))
        ends = pc.cumulative_sum(pc.cast(pc.list_value_length(lists), pa.int32()))
        return pa.ListArray.from_arrays(pa.concat_arrays([pa.array([0], pa.int32()), ends]), placed)

    return call


def _through_batch(df: DataFrame, hit: Callable[[Column], Column], batch: Callable[[pa.Array], pa.Array]) -> DataFrame:
    # a new value comes back at the place of its leaf, so nothing has to be looked up or merged
    columns = df.columns
    marked = F.transform("flat", lambda e: F.struct(F.coalesce(hit(e), F.lit(False)).alias("hit"), e.getField("value").alias("value")))
    df = once(df, _old=F.coalesce(marked, F.array().cast("array<struct<hit:boolean,value:string>>")))
    df = df.withColumn("_new", over_values(batch)(F.col("_old")))
    changed = F.zip_with(
        F.zip_with("flat", "_old", lambda e, o: F.struct(e.alias("e"), o.getField("hit").alias("hit"))), "_new",
        lambda z, new: F.when(z.getField("hit"), z.getField("e").withField("value", new)).otherwise(z.getField("e")),
    )
    return once(df, drop=("_old", "_new"), flat=F.when(F.col("flat").isNotNull(), changed)).select(*columns)


def _through_udf(df: DataFrame, hit: Callable[[Column], Column], udf: Callable[[Column], Column]) -> DataFrame:
    # Python cannot run inside a lambda: hand over the matching values of a row as one array
    # and put the results back by their position.
    columns = df.columns
    at = F.filter(F.transform("flat", lambda e, i: F.when(hit(e), i)), lambda i: i.isNotNull())
    df = once(df, _at=at)
    values = F.transform("_at", lambda i: F.get("flat", i).getField("value"))
    df = once(df, _old=F.coalesce(values, F.array().cast("array<string>")))
    df = df.withColumn("_new", udf(F.col("_old")))
    same = F.size("_new") == F.size("_old")
    df = df.withColumn(
        "_new", F.when(same, F.col("_new")).otherwise(F.raise_error(F.lit("UDF changed the number of values")))
    )
    # leaves and matches are both in order, so they merge by one sort on the position
    kept = F.transform("flat", lambda e, i: F.struct(i.alias("i"), F.lit(0).alias("k"), e.alias("e")))
    new = F.transform(
        F.arrays_zip("_at", "_new"),
        lambda z: F.struct(
            z.getField("_at").alias("i"),
            F.lit(1).alias("k"),
            F.get("flat", z.getField("_at")).withField("value", z.getField("_new")).alias("e"),
        ),
    )

    def last_of_each(merged: Column) -> Column:
        def newest(m: Column, i: Column) -> Column:
            return ~F.get(merged, i + 1).getField("i").eqNullSafe(m.getField("i"))

        latest = F.filter(merged, newest)
        return F.transform(latest, lambda m: m.getField("e"))

    merged = F.transform(F.array(F.sort_array(F.concat(kept, new))), last_of_each).getItem(0)
    return once(df, drop=("_at", "_old", "_new"), flat=merged).select(*columns)


def observe_fields(df: DataFrame, count: str, observation: Observation | str = "fields") -> DataFrame:
    """Publish leaf counters of ``transform_fields(count=…)``; no extra pass over the data.

    ``fields_processed`` leaves were changed, ``no_match`` rows had nothing to change.  With a
    name instead of an Observation the numbers appear in the streaming query progress.
    """
    ok = F.col("error").isNull()
    return df.observe(
        observation,
        F.coalesce(F.sum(F.when(ok, F.col(count))), F.lit(0)).alias("fields_processed"),
        F.count(F.when(ok & (F.col(count) == 0), F.lit(1))).alias("no_match"),
    )
