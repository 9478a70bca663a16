"""Readers: delimited text with quarantine (T1, T2), CSV (S10, T13), image frames."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from ember.sources import files as SRC
from tests.pngutil import write_png


def write(path, lines):
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")


def test_text_split_every_comma_and_quarantine(spark, tmp_dir):  # T1, T2
    p = os.path.join(tmp_dir, "movies.txt")
    write(p, ["1,Toy Story,Animation|Comedy", "2,Heat, The,Action", "3,Solo", "4,Extra,Drama,ignored,more", ",NoId,X"])
    good, bad = SRC.read_movies(spark, p)
    rows = {r["movie_id"]: r for r in good.collect()}
    assert rows["1"]["genres"] == "Animation|Comedy"
    assert rows["2"]["title"] == "Heat" and rows["2"]["genres"] == " The"   # comma shifts the genre
    assert rows["3"]["genres"] is None
    assert rows["4"]["genres"] == "Drama"
    assert rows[""]["title"] == "NoId"          # an empty id is a value, as str.split gives it
    assert bad.count() == 0


def test_ratings_bad_number_goes_to_quarantine(spark, tmp_dir):  # T2
    p = os.path.join(tmp_dir, "ratings.txt")
    write(p, ["1,10,4.5,978307200", "2,10,abc,978307200", "3,11", "4,12,3,notatime"])
    good, bad = SRC.read_ratings(spark, p)
    assert sorted(r["user_id"] for r in good.collect()) == ["1", "4"]
    assert sorted(r["reason"] for r in bad.collect()) == ["bad or missing field: rating"] * 2
    with pytest.raises(SRC.QuarantineError):
        SRC.read_ratings(spark, p, strict=True)


def test_quoted_option_honours_quotes(spark, tmp_dir):
    p = os.path.join(tmp_dir, "movies.txt")
    write(p, ['5,"Heat, The",Action'])
    good, _ = SRC.read_movies(spark, p, quoted=True)
    r = good.first()
    assert r["title"] == "Heat, The" and r["genres"] == "Action"


def test_csv_semicolon_header_and_string_options(spark, tmp_dir):  # S10, T13
    p = os.path.join(tmp_dir, "Order_Reviews.csv")
    write(p, ["Order_ID;Review_Score", "o1;5", "o2;1.0", "o3;x", "o4;", "o5;3"])
    df = SRC.read_csv(spark, p, "Order_ID string, Review_Score string")
    from ember.operators.retail import keep_valid

    assert sorted(r[0] for r in keep_valid(df, "Review_Score").collect()) == ["o1", "o5"]
    inferred = SRC.read_csv(spark, p, header="True", infer_schema="True")
    assert inferred.columns == ["Order_ID", "Review_Score"]


def test_csv_corrupt_records_kept(spark, tmp_dir):
    p = os.path.join(tmp_dir, "Orders.csv")
    write(p, ["Order_ID;Price", "o1;10.5", "o2;abc"])
    df = SRC.read_csv(spark, p, "Order_ID string, Price double", corrupt_col="_bad")
    rows = {r["Order_ID"]: r for r in df.collect()}
    assert rows["o1"]["Price"] == 10.5 and rows["o1"]["_bad"] is None
    assert rows["o2"]["Price"] is None and rows["o2"]["_bad"] == "o2;abc"


def test_read_frames_bgr_and_names(spark, tmp_dir):  # S12, S13, F4
    rgb = np.zeros((4, 5, 3), dtype=np.uint8)
    rgb[..., 0], rgb[..., 1], rgb[..., 2] = 10, 20, 30
    write_png(os.path.join(tmp_dir, "cam1_000002.png"), rgb)
    write_png(os.path.join(tmp_dir, "cam1_000001.png"), rgb)
    with open(os.path.join(tmp_dir, "cam2_000001.png"), "wb") as f:
        f.write(b"not an image")
    df = SRC.read_frames(spark, tmp_dir).orderBy("camera_id", "frame_number")
    rows = df.collect()
    assert [(r["camera_id"], r["frame_number"]) for r in rows] == [("cam1", 1), ("cam1", 2), ("cam2", 1)]
    good = rows[0]
    assert (good["height"], good["width"], good["nChannels"]) == (4, 5, 3)
    assert bytes(good["data"][:3]) == bytes([30, 20, 10])   # BGR order
    assert rows[2]["height"] == -1                          # undecodable kept, flagged
    assert SRC.read_frames(spark, tmp_dir).where(F.col("height") > 0).count() == 2


def test_validate_images(spark, tmp_dir):  # V2
    from ember.operators.quality import validate_images

    write_png(os.path.join(tmp_dir, "a_000001.png"), np.zeros((4, 5, 4), dtype=np.uint8))
    write_png(os.path.join(tmp_dir, "b_000001.png"), np.zeros((4, 5, 3), dtype=np.uint8))
    write_png(os.path.join(tmp_dir, "c_000001.png"), np.zeros((4, 6, 4), dtype=np.uint8))
    out = {os.path.basename(r["path"]): r["message"]
           for r in validate_images(SRC.image_rows(spark, tmp_dir), width=5, height=4).collect()}
    assert out["a_000001.png"] == "Valid image: (4, 5, 4)"
    assert out["b_000001.png"] == "Expected BGRA (4 channels), got 3"
    assert out["c_000001.png"] == "Width mismatch: 6 != 5"


def test_validate_outputs_not_found_and_present(spark, tmp_dir):  # V2 + V3
    from ember.operators.quality import validate_outputs

    write_png(os.path.join(tmp_dir, "cam_000001.png"), np.zeros((4, 5, 4), dtype=np.uint8))
    write_png(os.path.join(tmp_dir, "cam_000002.png"), np.zeros((4, 5, 3), dtype=np.uint8))
    expected = spark.createDataFrame([("cam_000001.png",), ("cam_000002.png",), ("cam_000003.png",)],
                                     "filename string")
    out = {r["filename"]: r["message"] for r in validate_outputs(expected, SRC.image_rows(spark, tmp_dir)).collect()}
    assert out == {"cam_000001.png": "Valid image: (4, 5, 4)",
                   "cam_000002.png": "Expected BGRA (4 channels), got 3",
                   "cam_000003.png": "File not found: cam_000003.png"}
