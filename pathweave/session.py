"""Session settings the operators rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Repeated object keys keep the last value instead of failing the parse.
SETTINGS = {"spark.sql.variant.allowDuplicateKeys": "true"}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings to a running session; nothing else is touched."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark
