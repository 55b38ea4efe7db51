"""The strip list - one tag key per line, trimmed, united with the keys always removed."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from addrweave.operators.changes import strip_keys


def read_strip_list(spark: SparkSession, path: str) -> list[str]:
    """Read the key file with Spark and return the sorted key list.

    The list is a run parameter of bounded size (a handful of keys), so it is
    collected and used as a literal array.
    """
    keys = (
        spark.read.text(path)
        .select(F.regexp_replace("value", r"^\s+|\s+$", "").alias("k"))
        .where(F.col("k") != "")
        .distinct()
    )
    return strip_keys(r["k"] for r in keys.collect())
