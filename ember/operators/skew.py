"""Explicit split of hot join keys (beyond AQE's skew-join split).

AQE already splits an oversized shuffle partition of a sort-merge join at run
time.  ``hot_key_join`` is for plans where that is not enough or not on: keys
holding at least ``1 / max_hot`` of the rows are found with one aggregated
count (partial aggregation, so the hot key itself costs one row per task) and
salted: fact rows of a hot key are spread over ``salts`` values, and its
dimension rows are repeated once for each.  One join then serves all keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def hot_keys(fact: DataFrame, key: str, max_hot: int = 1000) -> DataFrame:
    """Keys with at least ``total / max_hot`` rows (so at most ``max_hot`` keys)."""
    counts = fact.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n")).scalar()
    return counts.where(F.col("_n") * F.lit(max_hot) >= total).select(key)


def hot_key_join(fact: DataFrame, dim: DataFrame, key: str, max_hot: int = 1000, salts: int = 64) -> DataFrame:
    """Inner equi-join ``fact JOIN dim USING (key)`` with hot keys spread over ``salts`` tasks.

    Same rows as the plain join, whatever the number of dimension rows a key
    has.  The hot keys are the only thing collected: at most ``max_hot``.
    The salt is a hash of the fact row, so a retried task deals rows alike.
    """
    keys = [r[0] for r in hot_keys(fact.select(key), key, max_hot).collect() if r[0] is not None]
    if not keys:
        return fact.join(dim, key)
    hot = F.col(key).isin(keys)
    rest = [c for c in fact.columns if c != key] or [key]
    dealt = fact.withColumn("_salt", F.when(hot, F.pmod(F.xxhash64(*rest), F.lit(salts)).cast("int")).otherwise(0))
    spread = dim.withColumn("_salt", F.explode(
        F.when(hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))))
    return dealt.join(spread, [key, "_salt"]).drop("_salt")
