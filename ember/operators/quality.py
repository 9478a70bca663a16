"""Data-quality operators: packet rules, image checks, missing outputs, counts."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ember.functions import is_valid_base64
from ember.images import png_header
from ember.operators.packets import ANY_LENGTH
from ember.schemas import REQUIRED_PACKET_FIELDS
from ember.session import ship_package
from ember.storage import written

# The validator's messages, as the reference words them.
MSG_MISSING = "Missing field: "
MSG_TIMESTAMP = "timestamp_ms must be integer"
MSG_QUALITY = "quality must be 0-100"
MSG_DIMENSIONS = "Invalid frame dimensions"
MSG_BASE64 = "frame_data is not valid base64"
MSG_VALID = "Valid packet"
MSG_NOT_FOUND = "File not found"
MSG_UNREADABLE = "Failed to read image"

_INTEGER_VARIANT = r"^(TINYINT|SMALLINT|INT|BIGINT|DECIMAL\(\d+,0\))$"
_NUMERIC_VARIANT = r"^(TINYINT|SMALLINT|INT|BIGINT|FLOAT|DOUBLE|DECIMAL\(\d+,\d+\))$"


def _packet_fields(value: Column) -> list[Column]:
    """Stage 2 of V1: the keys and the typed fields the rules read, from the parsed map."""

    def kind(name: str) -> Column:
        return F.schema_of_variant(F.element_at(value, F.lit(name)))

    def num(name: str) -> Column:
        """The field as a number; NULL for text, objects, booleans or null."""
        return F.when(kind(name).rlike(_NUMERIC_VARIANT), F.try_variant_get(F.element_at(value, F.lit(name)), "$", "double"))

    return [
        F.map_keys(value).alias("_keys"),
        kind("timestamp_ms").alias("_ts_kind"),
        num("quality").alias("_quality"),
        num("width").alias("_width"),
        num("height").alias("_height"),
        F.when(kind("frame_data") == "STRING",
               F.try_variant_get(F.element_at(value, F.lit("frame_data")), "$", "string")).alias("_frame"),
    ]


def _packet_rule_message() -> Column:
    """Stage 3 of V1: the first failing rule's message over the stage-1 columns."""
    keys = F.col("_keys")
    expr = F.when(keys.isNull(), F.lit(MSG_MISSING + REQUIRED_PACKET_FIELDS[0]))
    for name in REQUIRED_PACKET_FIELDS:
        expr = expr.when(~F.array_contains(keys, name), F.lit(MSG_MISSING + name))
    return (
        expr.when(~F.coalesce(F.col("_ts_kind").rlike(_INTEGER_VARIANT), F.lit(False)), MSG_TIMESTAMP)
        .when(~F.coalesce(F.col("_quality").between(0, 100), F.lit(False)), MSG_QUALITY)
        .when(~F.coalesce((F.col("_width") > 0) & (F.col("_height") > 0), F.lit(False)), MSG_DIMENSIONS)
        .when(~F.coalesce(is_valid_base64("_frame"), F.lit(False)), MSG_BASE64)
        .otherwise(MSG_VALID)
    )


def validate_packets(df: DataFrame, value_col: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """V1 on JSON text: ``message`` (first failing rule, else ``Valid packet``)
    and ``is_valid`` per packet.

    Rules in order: the 8 required fields (missing is decided on the JSON keys:
    a field present with a NULL value fails the rule that reads it), an
    integer ``timestamp_ms`` (told apart from "123" or 1.5 by the variant
    type), quality 0-100, positive width and height, and base64 text a lenient
    decoder accepts.  The JSON is parsed once, whatever its length, into a map
    of typed values in its own projection; the rules read that.
    """
    parsed = df.select(*keep, F.from_json(F.col(value_col).cast("string"), "map<string,variant>", ANY_LENGTH).alias("_map"))
    fields = parsed.select(*keep, *_packet_fields(F.col("_map")))
    return fields.select(*keep, _packet_rule_message().alias("message")).withColumn(
        "is_valid", F.col("message") == MSG_VALID)


def validate_images(images: DataFrame, width: int | None = None, height: int | None = None,
                    image_col: str = "image") -> DataFrame:
    """V2 over Spark's image source rows (``dropInvalid`` off).

    Message order: unreadable -> not 4 channels -> width -> height -> valid.
    """
    img = F.col(image_col)
    message = _image_message(img["nChannels"], img["width"], img["height"], img["height"] < 0, width, height)
    return images.select(img["origin"].alias("path"), message.alias("message")).withColumn(
        "is_valid", F.col("message").startswith("Valid image"))


def _image_message(ch: Column, w: Column, h: Column, unreadable: Column, width: int | None, height: int | None) -> Column:
    expr = F.when(unreadable, MSG_UNREADABLE).when(
        ch != 4, F.format_string("Expected BGRA (4 channels), got %d", ch))
    if width:
        expr = expr.when(w != width, F.format_string("Width mismatch: %d != %d", w, F.lit(width)))
    if height:
        expr = expr.when(h != height, F.format_string("Height mismatch: %d != %d", h, F.lit(height)))
    return expr.otherwise(F.format_string("Valid image: (%d, %d, %d)", h, w, ch))


def validate_image_headers(files: DataFrame, width: int | None = None, height: int | None = None) -> DataFrame:
    """V2 over ``binaryFile`` rows (path, content): the messages of ``validate_images`` from the PNG header.

    No pixel is decoded and nothing runs in Python.  A file without a PNG header, or cut off before its end chunk,
    is unreadable.
    """
    head = files.select("path", png_header(F.col("content")).alias("_head"))
    h = F.col("_head")
    message = _image_message(h["channels"], h["width"], h["height"], h.isNull(), width, height)
    return head.select("path", message.alias("message")).withColumn("is_valid", F.col("message").startswith("Valid image"))


def validate_output_files(expected: DataFrame, files: DataFrame, width: int | None = None, height: int | None = None,
                          name_col: str = "filename") -> DataFrame:
    """V2+V3 over ``binaryFile`` rows: one message per expected name, as ``validate_outputs``."""
    return _expected_messages(expected, validate_image_headers(files, width, height), name_col)


def validate_outputs(expected: DataFrame, images: DataFrame, width: int | None = None,
                     height: int | None = None, name_col: str = "filename") -> DataFrame:
    """V2+V3: one message per expected output file, keyed by file name.

    ``expected`` holds the names (``name_col``), ``images`` the image-source
    rows of the output folder.  A name with no file gets ``File not found:
    <name>``; a present file gets the image rules of ``validate_images``.
    """
    return _expected_messages(expected, validate_images(images, width, height), name_col)


def _expected_messages(expected: DataFrame, checked: DataFrame, name_col: str) -> DataFrame:
    checked = checked.withColumn(name_col, F.regexp_extract("path", r"([^/]+)$", 1))
    joined = expected.select(name_col).join(checked.select(name_col, "message"), name_col, "left")
    msg = F.coalesce(F.col("message"), F.concat(F.lit(MSG_NOT_FOUND + ": "), F.col(name_col)))
    return joined.select(name_col, msg.alias("message")).withColumn(
        "is_valid", F.col("message").startswith("Valid image"))


def missing_outputs(expected: DataFrame, actual: DataFrame, key: str, actual_key: str | None = None) -> DataFrame:
    """V3: expected keys with no output (left anti join).

    ``actual`` is first reduced to its distinct keys, aggregated map-side:
    AQE can split only the left side of an anti join, so a key holding a
    third of ``actual`` would otherwise fill one task of the right side.
    """
    a = actual.select(F.col(actual_key or key).alias("_k")).distinct()
    return expected.join(a, expected[key] == a["_k"], "left_anti")


def frame_count_check(df: DataFrame, key: str, expected: int, out_key: str | None = None) -> DataFrame:
    """V4: frames per source against ``duration x fps``."""
    return df.groupBy(F.col(key).alias(out_key or key)).agg(F.count(F.lit(1)).alias("frames")).withColumn(
        "ok", F.col("frames") == F.lit(expected).cast("bigint"))


# ----------------------------------------------------------- missing frames

def _sorted_gaps(batches):
    """Gaps and edges of one sorted range of (camera_id, frame) rows.

    A row with ``edge`` false is a gap (first and last missing frame) between two frames of the range; one with ``edge``
    true gives a camera's first and last frame in it.
    """
    camera, begin, last = None, None, None
    for batch in batches:
        names = batch.column("camera_id")
        frames = batch.column("frame").to_numpy(zero_copy_only=False)
        if not len(frames):
            continue
        runs = pa.compute.run_end_encode(names)
        ends = np.asarray(runs.run_ends)
        out = [], [], [], []
        for name, a, b in zip(runs.values.to_pylist(), np.r_[0, ends[:-1]], ends):
            mine = frames[a:b]
            if last is not None and name == camera:
                mine = np.r_[last, mine]
            else:
                if last is not None:
                    for held, v in zip(out, (camera, begin, last, True)):
                        held.append(v)
                camera, begin = name, int(mine[0])
            at = np.flatnonzero(np.diff(mine) > 1)
            for held, v in zip(out, ([name] * len(at), (mine[at] + 1).tolist(), (mine[at + 1] - 1).tolist(), [False] * len(at))):
                held.extend(v)
            last = int(mine[-1])
        yield _gap_batch(out)
    if last is not None:
        yield _gap_batch(([camera], [begin], [last], [True]))


def _gap_batch(columns) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.bool_())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["camera_id", "lo", "hi", "edge"])


def frame_gaps(frames: DataFrame, camera_col: str = "camera_id", frame_col: str = "frame_number", *,
               first: int | None = None, last: int | None = None) -> DataFrame:
    """V3/V4: (camera_id, first_missing, last_missing, length) of every stretch of missing frames.

    Frames are range-partitioned by (camera, frame), so a camera with a third of all rows is cut over many tasks; a
    task finds the gaps inside its range in one pass and passes on each camera's first and last frame there.  Gaps
    between ranges come from these edges alone, one row a task and camera.

    With ``first`` and ``last`` the expected numbers run from one to the other: what is missing before a camera's
    first and after its last frame is a gap too, and frames outside do not count.  Without them only gaps between a
    camera's frames are.  Frames seen twice are one; null frame numbers are dropped, null cameras are one camera.
    """
    ship_package(frames.sparkSession)
    rows = frames.select(F.col(camera_col).cast("string").alias("camera_id"), F.col(frame_col).cast("long").alias("frame"))
    rows = rows.filter("frame IS NOT NULL").distinct()
    if first is not None:
        rows = rows.filter(F.col("frame") >= first)
    if last is not None:
        rows = rows.filter(F.col("frame") <= last)
    ranges = rows.repartitionByRange("camera_id", "frame").sortWithinPartitions("camera_id", "frame")
    found = written(ranges.mapInArrow(_sorted_gaps, "camera_id string, lo long, hi long, edge boolean"), "frame-gaps")
    edges = found.filter("edge").select("camera_id", "lo", "hi")
    # The ends of the expected range are edges of their own, where asked for.
    bounds = [F.lit(v) for v in (first - 1 if first is not None else None, last + 1 if last is not None else None) if v is not None]
    if bounds:
        edges = edges.unionByName(edges.select("camera_id").distinct().select(
            "camera_id", F.explode(F.array(*[b.cast("long") for b in bounds])).alias("lo")).withColumn("hi", F.col("lo")))
    before = F.lag("hi").over(Window.partitionBy("camera_id").orderBy("lo"))
    between = edges.select("camera_id", (before + 1).alias("a"), (F.col("lo") - 1).alias("b"))
    inside = found.filter("NOT edge").select("camera_id", F.col("lo").alias("a"), F.col("hi").alias("b"))
    return inside.unionByName(between).filter("a <= b").select(
        "camera_id", F.col("a").alias("first_missing"), F.col("b").alias("last_missing"), (F.col("b") - F.col("a") + 1).alias("length"))
