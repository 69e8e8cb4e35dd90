"""Intermediate tables in the folder that all executors and the driver share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_own: dict[str, str] = {}


def folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; a folder of our own only where it is unset and one machine does all, as in tests."""
    context = spark.sparkContext
    given = context.getConf().get("spark.checkpoint.dir")
    if given:
        return given.rstrip("/")
    if context.master != "local" and not context.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if context.applicationId not in _own:
        _own[context.applicationId] = tempfile.mkdtemp(prefix="pathweave-")
    return "file://" + _own[context.applicationId]


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table written once: its lineage ends here, and a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = f"{folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dropped(df: DataFrame) -> None:
    """Delete a table made by ``written`` that nothing reads any more."""
    spark = df.sparkSession
    shared = folder(spark)
    jvm = spark.sparkContext._jvm
    for file in df.inputFiles()[:1]:
        parent = jvm.org.apache.hadoop.fs.Path(file).getParent()
        assert parent.toUri().getPath().startswith(jvm.org.apache.hadoop.fs.Path(shared).toUri().getPath())
        parent.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(parent, True)


def texts(docs: DataFrame, *others: str) -> DataFrame:
    """``doc_id``, ``text`` (null: empty) and the named columns; all other columns are left behind."""
    return docs.select(F.col("doc_id"), F.coalesce("text", F.lit("")).alias("text"), *others)
