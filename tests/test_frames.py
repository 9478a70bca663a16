"""Frame kernels against slow per-pixel definitions, and the Spark frame operators."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ember.operators import frames as FR

RNG = np.random.default_rng(7)


def slow_morph(mask, reduce_max):
    h, w = mask.shape
    out = np.zeros_like(mask)
    for y in range(h):
        for x in range(w):
            vals = [mask[y + dy - 2, x + dx - 2] for dy in range(5) for dx in range(5)
                    if FR.ELLIPSE_5X5[dy, dx] and 0 <= y + dy - 2 < h and 0 <= x + dx - 2 < w]
            out[y, x] = max(vals) if reduce_max else min(vals)
    return out


def reflect101(i, n):
    while i < 0 or i >= n:
        i = -i if i < 0 else 2 * (n - 1) - i
    return i


def slow_blur(mask):
    k = [1, 4, 6, 4, 1]
    h, w = mask.shape
    out = np.zeros_like(mask)
    for y in range(h):
        for x in range(w):
            s = sum(k[a] * k[b] * int(mask[reflect101(y + a - 2, h), reflect101(x + b - 2, w)])
                    for a in range(5) for b in range(5))
            out[y, x] = (s + 128) >> 8
    return out


def slow_hsv(b, g, r):
    v = max(b, g, r)
    d = v - min(b, g, r)
    s = 0 if v == 0 else (d * round((255 << 12) / v) + (1 << 11)) >> 12
    if d == 0:
        h = 0
    else:
        num = g - b if v == r else (b - r + 2 * d if v == g else r - g + 4 * d)
        h = (num * round((180 << 12) / (6 * d)) + (1 << 11)) >> 12
        h = h + 180 if h < 0 else h
    return h, s, v


@pytest.mark.parametrize("shape", [(8, 8), (5, 9), (1, 1), (3, 2)])
def test_morphology_matches_definition(shape):  # I3, I4
    mask = (RNG.random(shape) > 0.6).astype(np.uint8) * 255
    assert np.array_equal(FR.dilate(mask), slow_morph(mask, True))
    assert np.array_equal(FR.erode(mask), slow_morph(mask, False))
    assert np.array_equal(FR.close(mask), slow_morph(slow_morph(mask, True), False))
    assert np.array_equal(FR.open_(mask), slow_morph(slow_morph(mask, False), True))


@pytest.mark.parametrize("shape", [(8, 8), (6, 11), (3, 3)])
def test_blur_matches_definition(shape):  # I5
    mask = RNG.integers(0, 256, size=shape).astype(np.uint8)
    assert np.array_equal(FR.gaussian_blur5(mask), slow_blur(mask))


def test_hsv_matches_definition():  # I1
    bgr = RNG.integers(0, 256, size=(16, 16, 3)).astype(np.uint8)
    bgr[0, 0] = (0, 0, 0)
    bgr[0, 1] = (255, 255, 255)
    bgr[0, 2] = (0, 255, 0)
    bgr[0, 3] = (255, 0, 0)
    hsv = FR.bgr_to_hsv(bgr)
    for y in range(16):
        for x in range(16):
            b, g, r = (int(c) for c in bgr[y, x])
            assert tuple(int(c) for c in hsv[y, x]) == slow_hsv(b, g, r)
    assert tuple(hsv[0, 2]) == (60, 255, 255)
    assert tuple(hsv[0, 3]) == (120, 255, 255)


def green_screen(side=32, block=(10, 22)):
    """Pure green frame with a white block in the middle (BGR)."""
    frame = np.zeros((side, side, 3), dtype=np.uint8)
    frame[..., 1] = 255
    a, b = block
    frame[a:b, a:b] = 255
    return frame


def test_chroma_key_green_screen():  # I7
    bgra = FR.chroma_key(green_screen())
    assert bgra.shape == (32, 32, 4)
    assert bgra[0:5, 0:5, 3].max() == 0            # background transparent
    assert bgra[13:19, 13:19, 3].min() == 255      # subject opaque
    assert np.array_equal(bgra[..., :3], green_screen())


def test_chroma_key_falls_back_to_opaque():
    bad = np.zeros((4, 4, 2), dtype=np.uint8)       # wrong channel count -> kernel error
    out = FR.chroma_key(np.dstack([bad, bad[..., :1]]))
    assert out[..., 3].min() == 255
    broken = np.zeros((4, 4, 3), dtype=np.uint8)
    assert FR.chroma_key(broken)[..., 3].shape == (4, 4)


def test_alpha_threshold_polarity():  # I8
    scores = np.array([[0.0, 0.1, 0.11, 1.0]])
    assert FR.alpha_from_scores(scores).tolist() == [[255, 255, 0, 0]]


def frames_df(spark, frames):
    rows = [(i, f.shape[0], f.shape[1], f.tobytes() if f is not None else b"xx") for i, f in enumerate(frames)]
    return spark.createDataFrame(rows, "frame_id long, height int, width int, data binary")


def test_chroma_key_frames_operator(spark):  # I7 in Spark, T20
    gs = green_screen()
    df = frames_df(spark, [gs, gs])
    df = df.union(spark.createDataFrame([(9, 32, 32, b"short")], df.schema))
    out = {r["frame_id"]: r for r in FR.chroma_key_frames(df).collect()}
    assert out[9]["status"] == "undecodable" and out[9]["data"] is None
    bgra = np.frombuffer(out[0]["data"], dtype=np.uint8).reshape(32, 32, 4)
    assert np.array_equal(bgra, FR.chroma_key(gs)) and out[0]["nChannels"] == 4


class Boom:
    def __call__(self, rgb):
        if rgb[0, 0, 0] == 1:
            raise RuntimeError("model failed")
        return np.where(rgb[..., 1] > 200, 1.0, 0.0)

    def close(self):
        pass


def test_segment_frames_plugin_and_fallback(spark):  # I9
    gs = green_screen()
    odd = gs.copy()
    odd[0, 0] = (0, 0, 1)   # R == 1 in RGB order -> segmenter raises -> chroma key
    df = frames_df(spark, [gs, odd])
    out = {r["frame_id"]: r for r in FR.segment_frames(df, Boom).collect()}
    assert out[0]["status"] == "segmented" and out[1]["status"] == "chroma_key"
    a0 = np.frombuffer(out[0]["data"], dtype=np.uint8).reshape(32, 32, 4)[..., 3]
    assert a0[0, 0] == 0 and a0[16, 16] == 0   # green channel > 200 everywhere -> all transparent
    nomodel = {r["frame_id"]: r["status"] for r in FR.segment_frames(df, None).collect()}
    assert set(nomodel.values()) == {"chroma_key"}

    def broken_factory():
        raise OSError("model file missing")

    assert {r["status"] for r in FR.segment_frames(df, broken_factory).collect()} == {"chroma_key"}


def test_map_masks_and_pixels(spark):
    mask = (RNG.random((8, 8)) > 0.5).astype(np.uint8) * 255
    df = spark.createDataFrame([(1, 8, 8, mask.tobytes())], "frame_id long, height int, width int, data binary")
    px = FR.pixels(FR.map_masks(df, FR.dilate)).orderBy("y", "x").collect()
    got = np.array([r["v"] for r in px]).reshape(8, 8)
    assert np.array_equal(got, slow_morph(mask, True))
    assert (px[9]["y"], px[9]["x"]) == (1, 1)


def test_frames_from_image_files_any_channel_count(spark, tmp_path):  # S12 -> I7
    import os

    from ember.sources.files import read_frames
    from tests.pngutil import write_png

    gs = green_screen()
    rgb = gs[..., ::-1]
    write_png(os.path.join(tmp_path, "cam_000001.png"), rgb)
    write_png(os.path.join(tmp_path, "cam_000002.png"), np.dstack([rgb, np.full((32, 32), 255, np.uint8)]))
    frames = read_frames(spark, str(tmp_path))
    out = {r["frame_number"]: r for r in FR.chroma_key_frames(frames, ("camera_id", "frame_number")).collect()}
    assert {r["status"] for r in out.values()} == {"ok"}
    for r in out.values():
        bgra = np.frombuffer(r["data"], dtype=np.uint8).reshape(32, 32, 4)
        assert np.array_equal(bgra, FR.chroma_key(gs))


class CountingSegmenter:
    """Records every build in a file (builds happen in worker processes)."""
    log = None

    def __init__(self):
        with open(CountingSegmenter.log, "a") as f:
            f.write("built\n")

    def __call__(self, rgb):
        return np.zeros(rgb.shape[:2])


def make_counting_segmenter(log):
    def make():
        CountingSegmenter.log = log
        return CountingSegmenter()
    return make


def test_segmenter_built_once_per_worker_when_reused(spark, tmp_path):  # I9
    gs = green_screen()
    df = frames_df(spark, [gs, gs]).coalesce(1)
    for reuse, runs in ((False, 3), (True, 24)):
        log = str(tmp_path / f"builds-{reuse}.txt")
        make = make_counting_segmenter(log)
        make.__qualname__ = f"counting_{reuse}_{tmp_path.name}"
        for _ in range(runs):
            assert {r["status"] for r in FR.segment_frames(df, make, reuse=reuse).collect()} == {"segmented"}
        builds = open(log).read().count("built")
        if reuse:
            # idle workers are handed out in turn; there are at most 2 Python
            # runners per task x 8 cores, so 24 jobs must reuse built segmenters
            assert builds <= 16
        else:
            assert builds == runs       # once per partition, every job


def constant_segmenter(score):
    def make():
        return lambda rgb: np.full(rgb.shape[:2], score)
    return make


def partial_segmenter(score):
    return lambda rgb: np.full(rgb.shape[:2], score)


def test_segmenters_over_other_values_are_other_models(spark):  # I9, Y5
    import functools

    df = frames_df(spark, [green_screen()]).coalesce(1)

    def alpha(make, **kw):
        out = FR.segment_frames(df, make, **kw).first()
        return set(np.frombuffer(out["data"], dtype=np.uint8).reshape(32, 32, 4)[..., 3].ravel().tolist())

    for _ in range(2):
        assert alpha(constant_segmenter(0.0)) == {255} and alpha(constant_segmenter(1.0)) == {0}
        assert alpha(functools.partial(partial_segmenter, 0.0)) == {255}
        assert alpha(functools.partial(partial_segmenter, 1.0)) == {0}
    assert FR._segmenter_key(functools.partial(partial_segmenter, 1.0), "a") == FR._segmenter_key(
        functools.partial(partial_segmenter, 1.0), "a") != FR._segmenter_key(functools.partial(partial_segmenter, 1.0), "b")


def test_the_segmenter_sees_rgb(spark):  # I10
    red = np.zeros((8, 8, 3), np.uint8)
    red[..., 2] = 255
    out = FR.segment_frames(frames_df(spark, [red]), lambda: lambda rgb: rgb[..., 0] / 255.0).first()
    assert set(bytes(out["data"])[3::4]) == {0}


def test_a_missing_size_leaves_the_other_frames(spark):  # T20
    gs = green_screen()
    df = frames_df(spark, [gs]).union(spark.createDataFrame([(7, None, 32, gs.tobytes())], frames_df(spark, [gs]).schema)).coalesce(1)
    out = {r["frame_id"]: r["status"] for r in FR.chroma_key_frames(df).collect()}
    assert out[7] == "undecodable" and sorted(out.values()) == ["ok", "undecodable"]
