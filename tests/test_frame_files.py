"""Frame files: PNG bytes, commit protocol, and the check of an output folder from headers."""

import numpy as np
import pytest

from ember.images import END_CHUNK, encode_png, png_header
from ember.operators import quality as Q
from ember.session import shared_dir
from ember.sources import frame_files as FF
from ember.storage import folders, names, opened, write_json
from pyspark.sql import functions as F

SCHEMA = "filename string, height int, width int, nChannels int, data binary"


def frame(name, h, w, c, seed=0):
    return name, h, w, c, np.random.default_rng(seed).integers(0, 256, h * w * c, dtype=np.uint8).tobytes()


def test_files_are_read_back_by_the_image_source(spark):
    rows = [frame("a_000001.png", 3, 5, 4), frame("a_000002.png", 2, 2, 3, 1), frame("b/1.png", 1, 7, 1, 2), ("none.png", 1, 1, 4, None)]
    path = f"{shared_dir(spark, 'png')}/out"
    FF.write_frame_files(spark.createDataFrame(rows, SCHEMA).repartition(3), path)
    assert names(path) == ["a_000001.png", "a_000002.png", "b%2F1.png"]
    assert folders(f"{path}/_staging") == [] and names(f"{path}/_commits") == []
    got = {r["origin"].rsplit("/", 1)[1]: r for r in spark.read.format("image").load(path).select("image.*").collect()}
    for name, h, w, c, data in rows[:2]:
        assert (got[name]["height"], got[name]["width"], got[name]["nChannels"]) == (h, w, c)
        assert bytes(got[name]["data"]) == data
    # The headers give the messages of the image source's rows.
    by_pixels = Q.validate_images(spark.read.format("image").load(path), 5, 3)
    by_header = Q.validate_image_headers(FF.read_output_files(spark, path), 5, 3)
    tail = F.regexp_extract("path", r"([^/]+)$", 1).alias("path")
    # The image source writes the path as a URI.
    want = [repr(r).replace("%25", "%") for r in by_pixels.select(tail, "message").collect()]
    assert sorted(map(repr, by_header.select(tail, "message").collect())) == sorted(want)
    again = [frame("a_000001.png", 1, 1, 4, 9)]
    FF.write_frame_files(spark.createDataFrame(again, SCHEMA), path)
    assert len(names(path)) == 3
    assert spark.read.format("image").load(f"{path}/a_000001.png").first()["image"]["height"] == 1


def test_a_failed_job_leaves_nothing(spark):
    path = f"{shared_dir(spark, 'png')}/out"
    good = frame("a.png", 2, 2, 4)
    bad = ("b.png", 2, 2, 4, b"short")
    with pytest.raises(Exception, match="reshape"):
        FF.write_frame_files(spark.createDataFrame([good, bad], SCHEMA).repartition(2), path)
    assert names(path) == [] and folders(f"{path}/_staging") == []


def test_a_killed_attempt_and_a_lost_driver(spark):
    root = f"{shared_dir(spark, 'png')}/out"
    writer = FF.FrameFileWriter(root)
    batch = spark.createDataFrame([frame("a.png", 2, 2, 4), frame("b.png", 2, 2, 4)], SCHEMA).toArrow().to_batches()
    dead = writer.write(iter(batch))                             # an attempt whose message never reaches the driver
    won = writer.write(iter(batch))
    assert names(root) == []
    write_json(f"{root}/_commits/{writer.job}.json", [won.folder])
    where, path = opened(won.folder)
    where.move(f"{path}/a.png", f"{opened(root)[1]}/a.png")      # the driver was lost after one move
    assert FF.finish_commits(root) == 1 and names(root) == ["a.png", "b.png"]
    assert FF.finish_commits(root) == 0 and folders(f"{root}/_staging") == [] and dead.files == 2


def test_headers_of_broken_files(spark):
    whole = encode_png(bytes(12), 2, 2, 3)
    rows = [("ok", whole), ("cut", whole[:-3]), ("none", b""), ("text", b"hello" * 20), ("null", None),
            ("palette", whole[:25] + b"\x03" + whole[26:]), ("strange", whole[:25] + b"\x05" + whole[26:]), ("head", whole[:20] + END_CHUNK)]
    df = spark.createDataFrame(rows, "path string, content binary").withColumn("h", png_header(F.col("content")))
    assert {r["path"]: tuple(r["h"]) if r["h"] else None for r in df.collect()} == {
        "ok": (2, 2, 3), "palette": (2, 2, 3), "cut": None, "none": None, "text": None, "null": None, "strange": None, "head": None}
