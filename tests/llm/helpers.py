"""Small tables for the tests of the corpus operators."""

import os

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def docs(spark, rows, extra=""):
    """``doc_id, text`` rows, with extra columns as given: values after the first two of each row."""
    return spark.createDataFrame(rows, "doc_id long, text string" + (", " + extra if extra else ""))


def table(spark, name, sf=SF):
    return spark.read.parquet(f"{sf}/{name}.parquet")
