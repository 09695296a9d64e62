"""The shared scratch folder, and tables that a query reads more than once."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch(spark: SparkSession) -> str:
    """A new folder in the shared place that the session names; a local master may do without one."""
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir", None)
    if base is None and not sc.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return f"{base or tempfile.mkdtemp(prefix='regwatch-')}/scratch-{uuid.uuid4().hex}"


def settled(df: DataFrame) -> DataFrame:
    """df written to the shared scratch folder and read again: plans that use it several times stay small, and a lost
    executor costs no more than a read."""
    path = scratch(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
