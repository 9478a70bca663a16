"""Throughput and latency summaries (re-aimed from progress prints/benchmarks).

All are grouped aggregates with map-side partial aggregation; fixed-bound
histograms are conditional counts in one pass, not a sort.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ember.functions import epoch_millis, octets


def throughput_by(df: DataFrame, key: str, ts_col: str, out_key: str = "camera_id", ntz: bool = True,
                  digits: int = 6) -> DataFrame:
    """Frames, and frames per second between the first and last frame."""
    ms = epoch_millis(ts_col, ntz)
    g = df.groupBy(F.col(key).alias(out_key)).agg(
        F.count(F.lit(1)).alias("frames"), F.min(ms).alias("_t0"), F.max(ms).alias("_t1"))
    fps = F.try_divide(F.col("frames") * F.lit(1000.0), (F.col("_t1") - F.col("_t0")).cast("double"))
    return g.select(out_key, "frames", F.round(fps, digits).alias("fps"))


def _exact(value: str):
    """A latency with ten decimals, so that sums do not depend on the order of rows."""
    return F.col(value).cast("decimal(28,10)")


def latency_summary(df: DataFrame, stage: str, value: str, digits: int = 4) -> DataFrame:
    """Min / max / mean latency per stage (mean from an exact decimal sum)."""
    return df.groupBy(F.col(stage).alias("stage")).agg(
        F.min(value).alias("min_ms"),
        F.max(value).alias("max_ms"),
        F.round(F.sum(_exact(value)).cast("double") / F.count(F.lit(1)), digits).alias("avg_ms"),
    )


def total_latency(df: DataFrame, frame_key: str, value: str, digits: int = 4) -> DataFrame:
    """Mean over frames of the per-frame total of all stages."""
    per_frame = df.groupBy(frame_key).agg(F.sum(_exact(value)).alias("_t"))
    return per_frame.agg(
        F.round(F.sum("_t").cast("double") / F.count(F.lit(1)), digits).alias("avg_total_ms"))


def latency_histogram(df: DataFrame, stage: str, value: str, bounds: Sequence[float]) -> DataFrame:
    """Cumulative counts per fixed upper bound (``le_<b>``) plus ``le_inf``."""
    aggs = [F.count_if(F.col(value) <= b).alias(f"le_{_bound_name(b)}") for b in bounds]
    aggs.append(F.count(F.lit(1)).alias("le_inf"))
    return df.groupBy(F.col(stage).alias("stage")).agg(*aggs)


def _bound_name(b: float) -> str:
    return str(int(b)) if float(b).is_integer() else str(b).replace(".", "_")


def message_volume(df: DataFrame, payload: str, digits: int = 6, seconds: float | None = None) -> DataFrame:
    """Message count and MiB of payload (and rates when a duration is given)."""
    out = df.agg(F.count(F.lit(1)).alias("total_messages"), F.sum(octets(payload)).alias("_bytes"))
    out = out.select("total_messages", F.round(F.col("_bytes").cast("double") / 1048576, digits).alias("total_mb"))
    if seconds:
        out = out.withColumn("mb_per_sec", F.col("total_mb") / seconds).withColumn(
            "msgs_per_sec", F.col("total_messages") / seconds)
    return out


def batch_counts(df: DataFrame, batch_col: str = "batch_id", status_col: str | None = "status",
                 ok_value: str = "ok") -> DataFrame:
    """Successfully processed rows per micro-batch."""
    cond = F.col(status_col) == ok_value if status_col else F.lit(True)
    return df.groupBy(batch_col).agg(F.count_if(cond).alias("processed"))
