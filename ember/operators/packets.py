"""Frame packets: encode, decode, Kafka key/value, latest-per-key, file names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ember.functions import b64encode, iso_time, now_millis
from ember.schemas import PACKET_CONSUMER, PACKET_FULL
from ember.storage import written

# Spark's JSON reader stops at 20 million characters a string unless told otherwise.
ANY_LENGTH = {"maxStringLen": str((1 << 31) - 1)}

PACKET_ORDER = [f.name for f in PACKET_FULL.fields]


def packet_struct(df: DataFrame) -> Column:
    """The producer's packet as a struct, fields in producer order.

    Fields missing from ``df`` are left out; ``to_json`` also drops NULL
    fields, so a packet holds exactly what is known.
    """
    present = [c for c in PACKET_ORDER if c in df.columns]
    return F.struct(*[F.col(c) for c in present])


def encode_packets(df: DataFrame, key_col: str = "camera_id") -> DataFrame:
    """(key, value) rows, value = packet JSON, key = camera id.

    The key keeps one camera's frames in one Kafka partition (ordering per
    camera); the frame bytes, if given as binary ``frame_bytes``, are base64
    text without line breaks.
    """
    if "frame_bytes" in df.columns:
        df = df.withColumn("frame_data", b64encode("frame_bytes"))
    return df.select(F.col(key_col).cast("string").alias("key"), F.to_json(packet_struct(df)).alias("value"))


def decode_packets(
    df: DataFrame, value_col: str = "value", schema: T.StructType = PACKET_CONSUMER,
    keep: tuple[str, ...] = (), corrupt_col: str | None = None,
) -> DataFrame:
    """Message value (binary or text) -> packet columns.

    Shared by batch and stream; one parse, of any length (a raw frame is tens
    of millions of characters), and only the fields of ``schema`` (the
    consumer reads 4 of 9).  A value that is no JSON object gives an all-NULL
    row; with ``corrupt_col`` its raw text is kept there for dead-letter
    routing and ``<corrupt_col>_reason`` says why (NULL for a good packet):
    ``no value``, ``not an object`` or ``malformed``.  A field of another type
    is NULL in an otherwise good packet (T18).
    """
    text = F.col(value_col).cast("string")
    bad = T.StructType([*schema.fields, T.StructField("_bad", T.StringType())])
    parsed = df.select(*keep, text.alias("_raw"), F.from_json(
        text, bad, {**ANY_LENGTH, "columnNameOfCorruptRecord": "_bad"}).alias("_data"))
    out = parsed.select(*keep, "_raw", "_data.*")
    if corrupt_col:
        nothing = F.coalesce(*[F.col(f.name).cast("string") if not isinstance(f.dataType, T.StructType)
                               else F.to_json(f.name) for f in schema.fields]).isNull()
        reason = (F.when(F.col("_raw").isNull(), "no value")
                  .when(~F.col("_raw").rlike(r"^\s*\{"), "not an object")
                  .when(F.col("_bad").isNotNull() & nothing, "malformed"))
        out = out.withColumn(f"{corrupt_col}_reason", reason).withColumn(
            corrupt_col, F.when(F.col(f"{corrupt_col}_reason").isNotNull(), F.col("_raw")))
    return out.drop("_raw", "_bad")


def latest_frames(df: DataFrame, keys=("camera_id", "frame_number"), order=("ts", "event_id"),
                  value: str = "event_id") -> DataFrame:
    """Last write wins per key, as an aggregate (skew-safe).

    ``max_by`` is a partial aggregate: a replayed key with many copies is
    reduced map-side, never gathered into one group.
    """
    return df.groupBy(*keys).agg(F.max_by(F.col(value), F.struct(*[F.col(c) for c in order])).alias(value))


# Fixed values of the producer's packet.
PACKET_SOURCE = "camera_simulation"
DEFAULT_QUALITY = 85


def frames_to_packets(frames: DataFrame, *, encoding: str = "RAW", quality: int = DEFAULT_QUALITY,
                      source: str = PACKET_SOURCE, ts_col: str | None = None,
                      created_col: str | None = None) -> DataFrame:
    """C14: frame rows -> keyed packet messages (key = camera id, value = JSON).

    ``frames`` carries camera_id, frame_number, height, width and the pixel
    bytes ``data``; the bytes travel as base64 text.  ``timestamp_ms`` comes
    from ``ts_col`` when given, else from the query's current time (X19);
    ``metadata.created_at`` is ISO text (X20) of ``created_col`` or the current time.  No image codec is available to
    Spark, so ``encoding`` names the payload format (raw BGR by default).
    """
    ts = F.col(ts_col) if ts_col else now_millis()
    pk = frames.select(
        "camera_id",
        ts.alias("timestamp_ms"),
        F.col("frame_number").cast("int").alias("frame_number"),
        F.col("width").cast("int").alias("width"),
        F.col("height").cast("int").alias("height"),
        F.lit(encoding).alias("encoding"),
        b64encode("data").alias("frame_data"),
        F.lit(quality).alias("quality"),
        F.struct(F.lit(source).alias("source"), iso_time(created_col).alias("created_at")).alias("metadata"),
    )
    return encode_packets(pk, "camera_id")


def in_camera_order(df: DataFrame, camera_col: str = "camera_id", frame_col: str = "frame_number") -> DataFrame:
    """Each camera's frames in frame order over consecutive partitions.

    A range partitioning on (camera, frame) keeps the order a Kafka partition
    would give, and cuts a camera with a third of all frames over many tasks:
    reading the partitions in order gives every camera's frames in order.
    """
    return df.repartitionByRange(camera_col, frame_col).sortWithinPartitions(camera_col, frame_col)


def camera_positions(df: DataFrame, camera_col: str = "camera_id", frame_col: str = "frame_number") -> DataFrame:
    """W7 as a column: ``position`` (from 0) of every row in its camera's order by frame number.

    Rows are numbered inside their range partition; one row a partition and camera says how many came before.
    No camera is sorted in one task.  Equal (camera, frame) rows take neighbouring positions.
    """
    at = F.monotonically_increasing_id()
    ordered = written(in_camera_order(df, camera_col, frame_col).withColumn("_at", at), "camera-order")
    part = F.shiftright("_at", 33)
    here = ordered.groupBy(F.col(camera_col).alias("_camera"), part.alias("_part")).agg(
        F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("_camera").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    here = here.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    joined = ordered.join(here, ordered[camera_col].eqNullSafe(here["_camera"]) & (part == here["_part"]))
    return joined.withColumn("position", F.col("_before") + F.col("_at") - F.col("_first")).select(*df.columns, "position")
