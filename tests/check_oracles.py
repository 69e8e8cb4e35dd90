"""Compare queries with their SQL: ``python tests/check_oracles.py [sf_dir] [query …]``."""

from __future__ import annotations

import os
import sys
import time

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402


def tables(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in (
        "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
        "pages", "benchmark", "labels", "conversations",
    ):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def rows(table) -> list[tuple]:
    """Rows of an Arrow table as texts, columns by name, sorted; integers stay whole beside nulls."""
    columns = [table.column(c).to_pylist() for c in sorted(table.column_names)]
    return sorted(tuple("" if v is None or v != v else str(v) for v in r) for r in zip(*columns, strict=True))


def compare(spark: SparkSession, con, sf_dir: str, name: str) -> str:
    if name not in entry.oracle_sql():  # no SQL says the same; the tests hold it against brute force
        entry.queries()[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return ""
    got = entry.queries()[name](spark, sf_dir).toArrow()
    want = con.execute(entry.oracle_sql()[name]).to_arrow_table()
    if sorted(got.column_names) != sorted(want.column_names):
        return f"columns {sorted(got.column_names)} vs {sorted(want.column_names)}"
    a, b = rows(got), rows(want)
    if a == b:
        return ""
    first = next((x for x in zip(a, b) if x[0] != x[1]), None)
    return f"{len(a)} vs {len(b)} rows, first difference {first}"


if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    session = (
        SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC").config("spark.sql.shuffle.partitions", "8").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    con = tables(sf)
    for name in sys.argv[2:] or entry.queries():
        start = time.time()
        try:
            problem = compare(session, con, sf, name)
        except Exception as e:  # report and go on
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        print(f"{'ok ' if not problem else 'BAD'} {name} {time.time() - start:.1f}s {problem[:900]}", flush=True)
