"""The driver's parquet tables and the logical tables derived from them.

The reference reads movie-ratings text files, retail CSV files and a frame
stream, none of which ship with it.  The generated TPC-H-like tables stand in
for them; every mapping below is a Spark projection/join over those tables,
so the work of each query grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Fixed values of the stand-in mapping (must equal the oracle's prelude).
# Market segments read as gender codes; every other segment is "U".
SEGMENT_GENDER = (("BUILDING", "M"), ("FURNITURE", "F"))
OTHER_GENDER = "U"
# The two rating "files" split at this line number (<= goes to the first).
RATING_FILE_SPLIT_LINE = 3
# Orders whose key is a multiple of this carry their status letter as a
# (dirty) review score; multiples of the second get a second review.
DIRTY_REVIEW_EVERY = 10
SECOND_REVIEW_EVERY = 7


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table; read anew at each call, so files added since are seen."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---------------------------------------------------------------- ratings --

def _rating_rows(spark: SparkSession, sf_dir: str, first_file: bool) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    cond = (F.col("l_linenumber") <= RATING_FILE_SPLIT_LINE) if first_file else (
        F.col("l_linenumber") > RATING_FILE_SPLIT_LINE)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return (
        li.where(cond)
        .select("l_orderkey", "l_partkey", "l_quantity", "l_shipdate")
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            F.col("o_custkey").alias("user_id"),
            F.col("l_partkey").alias("movie_id"),
            F.col("l_quantity").alias("rating"),
            F.col("l_shipdate").alias("ts"),
        )
    )


def rating_files(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The two rating files with the same layout (user, movie, rating, ts)."""
    return _rating_rows(spark, sf_dir, True), _rating_rows(spark, sf_dir, False)


def movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(movie_id, title); the words of the title play the genre list."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("movie_id"), F.col("p_name").alias("title"))


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user_id, gender, age, occ_id)."""
    c = table(spark, sf_dir, "customer")
    seg = F.col("c_mktsegment")
    gender = None
    for segment, code in SEGMENT_GENDER:
        gender = F.when(seg == segment, code) if gender is None else gender.when(seg == segment, code)
    gender = gender.otherwise(OTHER_GENDER)
    return c.select(
        F.col("c_custkey").alias("user_id"),
        gender.alias("gender"),
        (F.lit(10) + F.lit(2) * F.col("c_nationkey") + F.col("c_custkey") % 2).alias("age"),
        F.col("c_nationkey").alias("occ_id"),
    )


def occupations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("occ_id"), F.col("n_name").alias("occupation"))


# ----------------------------------------------------------------- retail --

def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(order_id, review_score) -- dirty text scores, some orders twice."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    prio = F.substring("o_orderpriority", 1, 1)
    first = o.select(
        F.col("o_orderkey").alias("order_id"),
        F.when(F.col("o_orderkey") % DIRTY_REVIEW_EVERY == 0, F.col("o_orderstatus"))
        .otherwise(prio).alias("review_score"),
    )
    second = o.where(F.col("o_orderkey") % SECOND_REVIEW_EVERY == 0).select(
        F.col("o_orderkey").alias("order_id"), prio.alias("review_score"))
    return first.unionByName(second)


# ----------------------------------------------------------------- frames --

def category_masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-pixel float scores (a segmenter's category mask) per embedding."""
    e = table(spark, sf_dir, "embeddings")
    return e.select(
        F.col("vec_id").alias("frame_id"),
        F.lit(8).alias("height"),
        F.lit(8).alias("width"),
        F.transform("embedding", lambda v: v.cast("double")).alias("scores"),
    )


def _quadrant(i):
    """Index of an 8 x 8 pixel's quadrant, 0 to 3."""
    return (i / F.lit(32)).cast("int") * 2 + (i % 8 / F.lit(4)).cast("int")


def quadrant_masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One 8 x 8 mask per embedding with areas that survive erosion.

    A pixel is 255 where its value, raised or lowered by 0.6 with the sign of
    its quadrant's value, is over 0.1.
    """
    px = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.when(
        F.get("embedding", i).cast("double")
        + F.when(F.get("embedding", _quadrant(i)) > 0, F.lit(0.6)).otherwise(F.lit(-0.6)) > F.lit(0.1), 255).otherwise(0))
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("frame_id"), F.lit(8).alias("height"), F.lit(8).alias("width"), ints_to_binary(px).alias("data"))


FRAME_SIDE = 8
GREEN_SHIFT = 80       # how far a quadrant's sign moves the green channel


def embedding_frames(spark: SparkSession, sf_dir: str, with_camera: bool = False) -> DataFrame:
    """One 8 x 8 BGR frame per embedding, its pixels made of the 64 values.

    With q(x) = floor((x + 0.5) * 256) limited to 0..255, pixel i has
    B = q(e[i + 21]), G = q(e[i]) moved by GREEN_SHIFT with the sign of its
    quadrant's value, R = q(e[i + 42]) (indexes modulo 64).  With
    ``with_camera`` the embedding's label names the camera (``cam<label>``).
    """
    def limited(x):
        return F.greatest(F.lit(0), F.least(F.lit(255), x)).cast("int")

    def level(i):
        return F.floor((F.get("embedding", i % 64).cast("double") + 0.5) * 256)

    def pixel(i):
        shift = F.when(F.get("embedding", _quadrant(i)) > 0, GREEN_SHIFT).otherwise(-GREEN_SHIFT)
        return F.array(limited(level(i + 21)), limited(level(i) + shift), limited(level(i + 42)))

    data = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(63)), pixel))
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("frame_id"),
        *([F.concat(F.lit("cam"), F.col("label").cast("string")).alias("camera_id")] if with_camera else []),
        F.lit(FRAME_SIDE).alias("height"), F.lit(FRAME_SIDE).alias("width"), F.lit(3).alias("nChannels"),
        ints_to_binary(data).alias("data"))


def tiled_frames(frames: DataFrame, height: int, width: int) -> DataFrame:
    """Frames of another size, tiled from the pixels of ``frames`` (for the benchmark)."""
    from ember.session import ship_package

    def make(batches):
        import numpy as np

        for pdf in batches:
            out = pdf[["frame_id"]].copy()
            out["height"], out["width"], out["nChannels"] = height, width, 3
            out["data"] = [np.tile(np.frombuffer(d, np.uint8).reshape(h, w, 3), (-(-height // h), -(-width // w), 1))
                           [:height, :width].tobytes() for d, h, w in zip(pdf["data"], pdf["height"], pdf["width"])]
            yield out

    ship_package(frames.sparkSession)
    return frames.mapInPandas(make, "frame_id long, height int, width int, nChannels int, data binary")


def ints_to_binary(values) -> "F.Column":
    """array<int> of 0..255 -> binary, JVM-side (hex text, then unhex)."""
    return F.unhex(F.array_join(
        F.transform(values, lambda v: F.lpad(F.hex(v.cast("int")), 2, "0")), ""))


def binary_to_ints(data) -> "F.Column":
    """binary -> array<int>, one element per byte, JVM-side."""
    return F.transform(
        F.sequence(F.lit(0), F.octet_length(data) - 1),
        lambda i: F.conv(F.hex(F.substring(data, i + 1, 1)), 16, 10).cast("int"))


def channel_sum(values, channel: int, channels: int = 4) -> "F.Column":
    """Sum of one channel's values of an interleaved frame (``binary_to_ints`` of its bytes)."""
    mine = F.filter(values, lambda _, i: i % channels == channel)
    return F.aggregate(mine, F.lit(0).cast("long"), lambda a, x: a + x)
