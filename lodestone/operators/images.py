"""Images as grey pixels (id, width, height, grey: one byte a pixel, row by row): perceptual hashes and containment."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _weights(n: int, m: int, kernel: str) -> np.ndarray:
    """m x n matrix that resamples n pixels to m: by Lanczos of three lobes, by area, by triangles as wide as the scale, or by the line between two neighbours."""
    scale = n / m
    if kernel == "linear":
        at = np.clip((np.arange(m) + 0.5) * scale - 0.5, 0, n - 1)
        return np.clip(1 - np.abs(np.arange(n)[None, :] - at[:, None]), 0, None)
    wide = max(scale, 1.0)
    x = (np.arange(n)[None, :] + 0.5 - (np.arange(m)[:, None] + 0.5) * scale) / wide
    if kernel == "lanczos":
        w = np.where(np.abs(x) < 3, np.sinc(x) * np.sinc(x / 3), 0.0)
    else:
        w = np.clip(1 - np.abs(x), 0, None) if kernel == "triangle" else np.clip((0.5 + 0.5 / wide) - np.abs(x), 0.0, 1.0 / wide)
    return w / w.sum(axis=1, keepdims=True)


def resized(px: np.ndarray, width: int, height: int, kernel: str = "lanczos") -> np.ndarray:
    """Rows first, then columns, each rounded to bytes."""
    byte = lambda a: np.clip(np.floor(a + 0.5), 0, 255)
    out = px.astype(np.float64)
    if width != px.shape[1]:
        out = byte(out @ _weights(px.shape[1], width, kernel).T)
    return byte(_weights(px.shape[0], height, kernel) @ out) if height != px.shape[0] else out


def _pixels(width, height, grey) -> np.ndarray | None:
    ok = grey is not None and width is not None and height is not None and width > 0 and height > 0 and len(grey) == width * height
    return np.frombuffer(bytes(grey), np.uint8).reshape(int(height), int(width)) if ok else None


def _hash(px: np.ndarray, standard: int) -> int:
    if standard:
        px = resized(px, standard, standard)
    small = resized(px, 9, 8)
    return int(np.packbits(small[:, :-1] > small[:, 1:]).view(">i8")[0])


def difference_hashes(images: DataFrame, standard: int = 0) -> DataFrame:
    """id, h: 64 bits, each whether a pixel of the 9 x 8 thumbnail is brighter than the next, the top left one highest.

    With `standard` (256) images are first scaled to that square, so resolutions agree. Null where pixels are missing or don't fill the size.
    """

    @F.pandas_udf("long")
    def hashed(width: pd.Series, height: pd.Series, grey: pd.Series) -> pd.Series:
        pixels = (_pixels(w, h, g) for w, h, g in zip(width, height, grey))
        return pd.Series([None if p is None else _hash(p, standard) for p in pixels], dtype="Int64")

    return images.select("id", hashed("width", "height", "grey").alias("h"))


def _best_match(large: np.ndarray, small: np.ndarray) -> float:
    """Largest normalised cross-correlation of a template over all its places, by FFT; flat places count as 0."""
    (h, w), (th, tw) = large.shape, small.shape
    big, t = large - large.mean(), small - small.mean()
    norm = np.sqrt((t**2).sum())
    if th > h or tw > w or norm < 1e-9:
        return 0.0
    top = np.fft.irfft2(np.fft.rfft2(big) * np.conj(np.fft.rfft2(t, s=big.shape)), s=big.shape)[: h - th + 1, : w - tw + 1]

    def windows(a):
        s = np.pad(a.cumsum(0).cumsum(1), ((1, 0), (1, 0)))
        return s[th:, tw:] - s[:-th, tw:] - s[th:, :-tw] + s[:-th, :-tw]

    spread = windows(big**2) - windows(big) ** 2 / (th * tw)
    return float(np.where(spread > 1e-6 * th * tw, top / (norm * np.sqrt(np.maximum(spread, 1e-9))), 0.0).max())


def containment(a: np.ndarray, b: np.ndarray, scales=(0.5, 0.75, 1.0, 1.25, 1.5), most: int = 512) -> float:
    """How well the smaller image is found in the larger one at any of the scales, -1 to 1."""
    small, large = (b, a) if a.shape[0] > b.shape[0] or a.shape[1] > b.shape[1] else (a, b)
    if max(large.shape) > most:
        f = most / max(large.shape)
        large = resized(large, max(1, round(large.shape[1] * f)), max(1, round(large.shape[0] * f)), "area")
    best = 0.0
    for s in scales:
        w, h = int(small.shape[1] * s), int(small.shape[0] * s)
        if 0 < w <= large.shape[1] and 0 < h <= large.shape[0]:
            best = max(best, _best_match(np.asarray(large, np.float64), resized(small, w, h, "area")))
    return best


def sub_images(pages: DataFrame, recent: DataFrame, threshold: float = 0.85) -> DataFrame:
    """id, of, score: pages found inside one of the recent images (or the reverse). `recent` is the delivered window, of a size fixed by the lookback."""

    @F.pandas_udf("double")
    def score(aw: pd.Series, ah: pd.Series, ag: pd.Series, bw: pd.Series, bh: pd.Series, bg: pd.Series) -> pd.Series:
        pairs = ((_pixels(*x[:3]), _pixels(*x[3:])) for x in zip(aw, ah, ag, bw, bh, bg))
        return pd.Series([None if a is None or b is None else containment(a, b) for a, b in pairs], dtype="float64")

    other = recent.select(F.col("id").alias("of"), F.col("width").alias("_w"), F.col("height").alias("_h"), F.col("grey").alias("_g"))
    out = pages.crossJoin(other).where(F.col("id") != F.col("of"))
    return out.select("id", "of", score("width", "height", "grey", "_w", "_h", "_g").alias("score")).where(F.col("score") >= threshold)
