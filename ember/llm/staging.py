"""Intermediate tables in the shared folder the cluster names in ``spark.checkpoint.dir``."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ember.session import shared_dir


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and read it back: later passes neither recompute it nor lose it with an executor."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
