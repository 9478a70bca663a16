"""Frame operators: chroma key, morphology, blur, alpha, pluggable segmenter.

A frame is one row: ``height``, ``width`` and ``data`` (row-major bytes,
B,G,R[,A] interleaved, as in Spark's ``image`` source).  Pixels never leave
the executors: every operator is a ``mapInPandas`` over Arrow batches of
frames with a small numpy kernel per frame, so it runs the same in batch and
in a streaming plan and scales with the number of partitions.

The kernels follow OpenCV's published 8-bit definitions (integer HSV with
fixed-point tables, morphology that ignores pixels outside the image,
5x5 Gaussian [1 4 6 4 1]/16 with reflect-101 border, round to nearest).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the reference's chroma key: inclusive HSV bounds of
# "green", the 5x5 ellipse structuring element, the segmenter threshold.
GREEN_LOWER = (35, 40, 40)
GREEN_UPPER = (90, 255, 255)
ELLIPSE_5X5 = np.array([
    [0, 0, 1, 0, 0],
    [1, 1, 1, 1, 1],
    [1, 1, 1, 1, 1],
    [1, 1, 1, 1, 1],
    [0, 0, 1, 0, 0],
], dtype=bool)
SEGMENT_THRESHOLD = 0.1
GAUSS_5 = np.array([1, 4, 6, 4, 1], dtype=np.int32)

# ----------------------------------------------------------- numpy kernels --


_HSV_SHIFT = 12
_HSV_HALF = 1 << (_HSV_SHIFT - 1)
# Fixed-point reciprocal tables of the 8-bit conversion, built from their rule:
# S divisor round(255 * 2^12 / v), H divisor round(180 * 2^12 / (6 d)); 0 for 0.
_IDX = np.arange(256, dtype=np.float64)
with np.errstate(divide="ignore"):
    _SDIV = np.where(_IDX == 0, 0, np.rint((255 << _HSV_SHIFT) / np.maximum(_IDX, 1))).astype(np.int32)
    _HDIV = np.where(_IDX == 0, 0, np.rint((180 << _HSV_SHIFT) / (6.0 * np.maximum(_IDX, 1)))).astype(np.int32)


def _hsv_planes(bgr: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """H (0..179), S, V planes of an 8-bit BGR image, int32, integer maths."""
    b = bgr[..., 0].astype(np.int32)
    g = bgr[..., 1].astype(np.int32)
    r = bgr[..., 2].astype(np.int32)
    v = np.maximum(np.maximum(b, g), r)
    d = v - np.minimum(np.minimum(b, g), r)
    s = (d * _SDIV[v] + _HSV_HALF) >> _HSV_SHIFT
    num = np.where(v == r, g - b, np.where(v == g, b - r + 2 * d, r - g + 4 * d))
    h = (num * _HDIV[d] + _HSV_HALF) >> _HSV_SHIFT
    h += 180 * (h < 0)
    return h, s, v


def bgr_to_hsv(bgr: np.ndarray) -> np.ndarray:
    """8-bit BGR -> HSV with H in 0..179, S and V in 0..255 (integer maths)."""
    return np.stack(_hsv_planes(bgr), axis=-1)


def in_range(hsv: np.ndarray, lower: Sequence[int], upper: Sequence[int]) -> np.ndarray:
    """255 where every channel lies within [lower, upper] (both inclusive)."""
    lo = np.asarray(lower).reshape(1, 1, -1)
    hi = np.asarray(upper).reshape(1, 1, -1)
    return np.where(np.all((hsv >= lo) & (hsv <= hi), axis=-1), 255, 0).astype(np.uint8)


def hsv_in_range(bgr: np.ndarray, lower: Sequence[int], upper: Sequence[int]) -> np.ndarray:
    """``in_range(bgr_to_hsv(bgr), ...)`` without building the HSV image."""
    keep = None
    for plane, lo, hi in zip(_hsv_planes(bgr), lower, upper):
        ok = (plane >= lo) & (plane <= hi)
        keep = ok if keep is None else keep & ok
    return keep.astype(np.uint8) * np.uint8(255)


def _morph(mask: np.ndarray, kernel: np.ndarray, reduce_max: bool) -> np.ndarray:
    kh, kw = kernel.shape
    ph, pw = kh // 2, kw // 2
    fill = 0 if reduce_max else 255  # neutral element: outside pixels never win
    padded = np.pad(mask, ((ph, ph), (pw, pw)), constant_values=fill)
    h, w = mask.shape
    out = np.full(mask.shape, fill, dtype=mask.dtype)
    for dy in range(kh):
        for dx in range(kw):
            if kernel[dy, dx]:
                win = padded[dy:dy + h, dx:dx + w]
                out = np.maximum(out, win) if reduce_max else np.minimum(out, win)
    return out


def dilate(mask: np.ndarray, kernel: np.ndarray = ELLIPSE_5X5) -> np.ndarray:
    return _morph(mask, kernel, True)


def erode(mask: np.ndarray, kernel: np.ndarray = ELLIPSE_5X5) -> np.ndarray:
    return _morph(mask, kernel, False)


def close(mask: np.ndarray, kernel: np.ndarray = ELLIPSE_5X5) -> np.ndarray:
    return erode(dilate(mask, kernel), kernel)


def open_(mask: np.ndarray, kernel: np.ndarray = ELLIPSE_5X5) -> np.ndarray:
    return dilate(erode(mask, kernel), kernel)


def gaussian_blur5(mask: np.ndarray) -> np.ndarray:
    """5x5 Gaussian of an 8-bit image, reflect-101 border, rounded."""
    padded = np.pad(mask.astype(np.int32), 2, mode="reflect")  # numpy "reflect" == reflect-101
    h, w = mask.shape
    rows = sum(GAUSS_5[i] * padded[:, i:i + w] for i in range(5))
    both = sum(GAUSS_5[i] * rows[i:i + h, :] for i in range(5))
    return ((both + 128) >> 8).astype(np.uint8)


def chroma_key(bgr: np.ndarray, lower=GREEN_LOWER, upper=GREEN_UPPER) -> np.ndarray:
    """BGR -> BGRA with green made transparent; on error the frame stays opaque."""
    try:
        mask = hsv_in_range(bgr, lower, upper)
        mask = gaussian_blur5(open_(close(mask)))
        alpha = np.uint8(255) - mask
    except Exception:  # noqa: BLE001 -- the reference's fall-back: opaque frame
        alpha = np.full(bgr.shape[:2], 255, dtype=np.uint8)
    return _with_alpha(bgr, alpha)


def _with_alpha(bgr: np.ndarray, alpha: np.ndarray) -> np.ndarray:
    out = np.empty((*bgr.shape[:2], 4), dtype=np.uint8)
    out[..., :3] = bgr
    out[..., 3] = alpha
    return out


def bgr_to_rgb(frame: np.ndarray) -> np.ndarray:
    """Swap the first and third channel (BGR <-> RGB; alpha kept)."""
    out = frame.copy()
    out[..., [0, 2]] = frame[..., [2, 0]]
    return out


def alpha_from_scores(scores: np.ndarray, threshold: float = SEGMENT_THRESHOLD) -> np.ndarray:
    """Segmenter scores -> alpha: above the threshold is transparent (0)."""
    return np.where(scores > threshold, 0, 255).astype(np.uint8)


# ---------------------------------------------------- Spark-side operators --

FRAME_OUT = "height int, width int, nChannels int, data binary, status string"


def _frame(data: bytes, h: int, w: int, c: int) -> np.ndarray | None:
    # One NULL size turns the whole pandas column into floats: sizes are read row by row.
    if data is None or pd.isna(h) or pd.isna(w):
        return None
    h, w = int(h), int(w)
    if h <= 0 or w <= 0 or len(data) != h * w * c:
        return None
    return np.frombuffer(data, dtype=np.uint8).reshape(h, w, c) if c > 1 else \
        np.frombuffer(data, dtype=np.uint8).reshape(h, w)


def _bgr_frames(pdf: pd.DataFrame):
    """Yield each row's frame as H x W x 3 BGR (None when it does not decode).

    Like a decoder asked for colour: a 4-channel BGRA image loses its alpha, a
    1-channel image is repeated to three; without ``nChannels`` the bytes are
    taken as BGR.
    """
    chans = pdf["nChannels"] if "nChannels" in pdf.columns else [3] * len(pdf)
    for h, w, c, data in zip(pdf["height"], pdf["width"], chans, pdf["data"]):
        c = 3 if c is None or pd.isna(c) else int(c)
        f = _frame(data, h, w, c) if c in (1, 3, 4) else None
        if f is None:
            yield None
        elif c == 1:
            yield np.repeat(f[..., None], 3, axis=2)
        else:
            yield f[..., :3]


def _sizes(pdf: pd.DataFrame) -> tuple[pd.Series, pd.Series]:
    """Frame sizes as nullable integers."""
    return pdf["height"].astype("Int32"), pdf["width"].astype("Int32")


def _map_frames(df: DataFrame, keys: Sequence[str], out_schema: str,
                per_partition: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]) -> DataFrame:
    from ember.session import ship_package

    ship_package(df.sparkSession)
    keys_ddl = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)
    schema = f"{keys_ddl}, {out_schema}" if keys_ddl else out_schema
    return df.mapInPandas(per_partition, schema)


def map_masks(df: DataFrame, fn: Callable[[np.ndarray], np.ndarray], keys: Sequence[str] = ("frame_id",)) -> DataFrame:
    """Apply a mask -> mask kernel (one byte per pixel) to every frame row."""
    keys = list(keys)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for h, w, data in zip(pdf["height"], pdf["width"], pdf["data"]):
                m = _frame(data, h, w, 1)
                out.append(None if m is None else fn(m).astype(np.uint8).tobytes())
            res = pdf[keys].copy()
            res["height"], res["width"] = _sizes(pdf)
            res["nChannels"] = 1
            res["data"] = out
            res["status"] = ["ok" if d is not None else "undecodable" for d in out]
            yield res

    return _map_frames(df, keys, FRAME_OUT, run)


def chroma_mask(df: DataFrame, keys: Sequence[str] = ("frame_id",), lower=GREEN_LOWER, upper=GREEN_UPPER) -> DataFrame:
    """I1+I2: one-byte mask per pixel, 255 inside the HSV range."""
    keys = list(keys)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for bgr in _bgr_frames(pdf):
                out.append(None if bgr is None else hsv_in_range(bgr, lower, upper).tobytes())
            res = pdf[keys].copy()
            (res["height"], res["width"]), res["nChannels"] = _sizes(pdf), 1
            res["data"] = out
            res["status"] = ["ok" if d is not None else "undecodable" for d in out]
            yield res

    return _map_frames(df, keys, FRAME_OUT, run)


def chroma_key_frames(df: DataFrame, keys: Sequence[str] = ("frame_id",)) -> DataFrame:
    """BGR frames -> BGRA frames, green background transparent.

    Undecodable frames are kept with ``status='undecodable'`` (T20) instead of
    vanishing, so they can be counted and routed.
    """
    keys = list(keys)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out, status = [], []
            for bgr in _bgr_frames(pdf):
                if bgr is None:
                    out.append(None)
                    status.append("undecodable")
                else:
                    out.append(chroma_key(bgr).tobytes())
                    status.append("ok")
            res = pdf[keys].copy()
            (res["height"], res["width"]), res["nChannels"] = _sizes(pdf), 4
            res["data"], res["status"] = out, status
            yield res

    return _map_frames(df, keys, FRAME_OUT, run)


# Segmenters kept per Python worker process (Spark reuses workers across tasks
# and micro-batches), keyed by the caller's model key and the pickled factory,
# so closures or partials over other values never share a model.
_SEGMENTERS: dict[tuple[str, str], object] = {}


def _segmenter_key(make_segmenter, model_key: str) -> tuple[str, str]:
    import hashlib

    from pyspark import cloudpickle

    return model_key, hashlib.sha256(cloudpickle.dumps(make_segmenter)).hexdigest()


def _segmenter(make_segmenter, key: tuple[str, str] | None):
    """(segmenter or None, owned): owned ones are closed by the caller."""
    if make_segmenter is None:
        return None, False
    if key is None:
        return make_segmenter(), True
    seg = _SEGMENTERS.get(key)
    if seg is None:
        import atexit

        seg = make_segmenter()  # a failure is not cached: the next partition tries again
        _SEGMENTERS[key] = seg
        closer = getattr(seg, "close", None)
        if callable(closer):
            atexit.register(closer)
    return seg, False


def segment_frames(
    df: DataFrame,
    make_segmenter: Callable[[], Callable[[np.ndarray], np.ndarray]] | None,
    keys: Sequence[str] = ("frame_id",),
    threshold: float = SEGMENT_THRESHOLD,
    reuse: bool = True,
    model_key: str = "",
) -> DataFrame:
    """Pluggable segmenter, used per frame.

    ``make_segmenter()`` returns ``fn(rgb) -> scores`` (H x W floats) and may
    carry a ``close()``.  With ``reuse`` (default) it is built once per Python
    worker process and kept for later partitions and micro-batches (closed at
    process exit), one for each ``model_key`` and pickled factory; with ``reuse=False`` once per partition and closed at its
    end, as the reference does.  If it cannot be built, or fails on a frame,
    that frame falls back to the chroma key; the status column says which
    path ran.  Output frames are BGRA with alpha 0 where the score > threshold.
    """
    keys = list(keys)
    key = _segmenter_key(make_segmenter, model_key) if reuse and make_segmenter is not None else None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seg, owned = None, False
        try:
            seg, owned = _segmenter(make_segmenter, key)
        except Exception:  # noqa: BLE001 -- no model: every frame takes the fall-back
            seg = None
        try:
            for pdf in batches:
                out, status = [], []
                for h, w, bgr in zip(pdf["height"], pdf["width"], _bgr_frames(pdf)):
                    if bgr is None:
                        out.append(None)
                        status.append("undecodable")
                        continue
                    try:
                        if seg is None:
                            raise RuntimeError("no segmenter")
                        scores = np.asarray(seg(bgr_to_rgb(bgr)), dtype=np.float64).reshape(int(h), int(w))
                        bgra = _with_alpha(bgr, alpha_from_scores(scores, threshold))
                        status.append("segmented")
                    except Exception:  # noqa: BLE001 -- per-frame fall-back
                        bgra = chroma_key(bgr)
                        status.append("chroma_key")
                    out.append(bgra.tobytes())
                res = pdf[keys].copy()
                (res["height"], res["width"]), res["nChannels"] = _sizes(pdf), 4
                res["data"], res["status"] = out, status
                yield res
        finally:
            closer = getattr(seg, "close", None)
            if owned and callable(closer):
                closer()

    return _map_frames(df, keys, FRAME_OUT, run)


def alpha_threshold(df: DataFrame, scores_col: str = "scores", threshold: float = SEGMENT_THRESHOLD,
                    out: str = "alpha") -> DataFrame:
    """I8 as a JVM expression on an array of scores: > threshold -> 0 else 255."""
    return df.withColumn(out, F.transform(F.col(scores_col), lambda s: F.when(s > threshold, 0).otherwise(255)))


def pixels(df: DataFrame, keys: Sequence[str] = ("frame_id",), data_col: str = "data",
           value: str = "v", channels: int = 1, channel: int = 0) -> DataFrame:
    """Explode one channel of frame bytes to (keys..., y, x, value) rows.

    For reports and checks on small frames; the frame operators themselves
    never go per pixel in Spark.
    """
    from ember.sources.testdata import binary_to_ints

    exploded = df.select(*keys, "width", F.posexplode(binary_to_ints(F.col(data_col))).alias("_i", value))
    if channels > 1:
        exploded = exploded.where(F.col("_i") % channels == channel)
    pix = (F.col("_i") / F.lit(channels)).cast("bigint")
    w = F.col("width").cast("bigint")
    return exploded.select(*keys, (pix / w).cast("bigint").alias("y"), (pix % w).alias("x"), value)
