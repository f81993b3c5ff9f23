"""Tiles of microscope images: the view is found and pixels are cut inside Arrow functions."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from slidemill.operators import kernels as K

OUT = "file_name string, k int, r0 int, c0 int, fov_fraction double, name string, png binary, error string"


def view(gray: np.ndarray, closing: int = 15, hole: int = 1000, least: int = 50_000) -> tuple[float, float, float]:
    """Centre (x, y) and radius of the roundest large bright region: Otsu, closing, holes filled, equal-area circle."""
    mask = K.closing(gray > K.otsu(gray), K.disk(closing))
    names, n = K.label(~mask)
    sizes = np.bincount(names.ravel(), minlength=n + 1)
    mask |= np.isin(names, np.flatnonzero(sizes < hole)) & (names > 0)
    names, n = K.label(mask)
    best = None
    for i in range(1, n + 1):
        region = names == i
        area = int(region.sum())
        if area <= least:
            continue
        line = K.contour(region)
        steps = np.abs(np.diff(np.vstack([line, line[:1]]), axis=0)).sum(1)
        perimeter = float(np.where(steps == 2, np.sqrt(2), steps).sum())
        roundness = 4 * np.pi * area / (perimeter**2 + 1e-8)
        if best is None or roundness > best[0]:
            ys, xs = np.nonzero(region)
            best = (roundness, float(xs.mean()), float(ys.mean()), float(np.sqrt(area / np.pi)))
    if best is None:
        raise ValueError("no region is large enough for a field of view")
    return best[1:]


def cut(gray: np.ndarray, cx: float, cy: float, r: float, patch: int, stride: int, least: float, center: bool = True) -> Iterator[tuple[int, int, float, np.ndarray]]:
    """Kept windows in row-major order as (row, column, share inside, pixels)."""
    h, w = gray.shape
    if h < patch or w < patch:
        raise ValueError("the image is smaller than a tile")
    y, x = np.ogrid[:h, :w]
    inside = (x - cx) ** 2 + (y - cy) ** 2 <= r * r
    sums = np.pad(inside.cumsum(0, dtype=np.int64).cumsum(1), ((1, 0), (1, 0)))
    for r0 in range(0, h - patch + 1, stride):
        for c0 in range(0, w - patch + 1, stride):
            share = (sums[r0 + patch, c0 + patch] - sums[r0, c0 + patch] - sums[r0 + patch, c0] + sums[r0, c0]) / patch**2
            if share >= least and (not center or inside[r0 + patch // 2, c0 + patch // 2]):
                yield r0, c0, float(share), gray[r0 : r0 + patch, c0 : c0 + patch]


def stretched(tile: np.ndarray) -> np.ndarray:
    """A tile's values spread over all bytes; a flat tile is black."""
    low, high = float(tile.min()), float(tile.max())
    return np.floor((tile - low) / (high - low) * 255 + 0.5).astype(np.uint8) if high > low else np.zeros(tile.shape, np.uint8)


def tile_images(images: DataFrame, patch: int = 256, stride: int = 128, least: float = 0.9, center: bool = True) -> DataFrame:
    """Tiles of each image (``file_name, content`` as PNG) with their names and PNGs; a failing image is a row with its error."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in OUT.split(", ")]
        for frame in frames:
            for name, content in zip(frame.file_name, frame.content, strict=True):
                try:
                    img = K.decode_png(bytes(content))
                    gray = K.gray_of(K.unit(K.to_bgr(img)).astype(float)) if img.ndim == 3 else img.astype(float) / max(float(img.max()), 1e-12)
                    stem = name.rsplit(".", 1)[0]
                    rows = [(name, k, r0, c0, share, f"{stem}_{k:05d}_r{r0}_c{c0}.png", K.encode_png(stretched(t)), None) for k, (r0, c0, share, t) in enumerate(cut(gray, *view(gray), patch, stride, least, center))]
                except Exception as e:  # noqa: BLE001  reported for the image, others go on
                    rows = [(name, None, None, None, None, None, None, f"{type(e).__name__}: {e}"[:300])]
                out = pd.DataFrame(rows, columns=names)
                for c in ("k", "r0", "c0"):
                    out[c] = out[c].astype("Int64")
                yield out

    return images.select("file_name", "content").mapInPandas(run, OUT)
