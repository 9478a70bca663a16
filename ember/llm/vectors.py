"""Shared shape of the vector searches: usable vectors, and ranking partial results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ember.llm.staging import staged

QUERY_STEP = 20


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, vec (array<double>) of rows whose vector has finite components only."""
    v = F.col("embedding").cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("vec")).filter(
        F.col("vec_id").isNotNull() & F.col("vec").isNotNull() & finite)


def is_query() -> Column:
    return F.col("vec_id") % QUERY_STEP == 0


def best_of(parts: DataFrame, k: int) -> DataFrame:
    """The k best rows of every query from per-block results; ties to the smaller vec_id."""
    order = Window.partitionBy("query_id", "query_row").orderBy(F.desc("score"), "vec_id")
    return parts.withColumn("rank", F.row_number().over(order).cast("int")).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def kept(df: DataFrame, name: str) -> DataFrame:
    return staged(df, name)
