"""Box proposals: pixel detectors inside Arrow functions, everything relational in the JVM."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slidemill.plans.lineage import cut
from slidemill.operators import boxes as B
from slidemill.operators import kernels as K

# Stain ranges in hue (0..179), saturation, value.
STAINS = (
    ("pink_stain", (140, 30, 50), (180, 255, 255)), ("red_stain", (0, 30, 50), (15, 255, 255)), ("purple_stain", (120, 30, 50), (145, 255, 255)),
    ("brown_stain", (10, 40, 30), (25, 255, 200)), ("blue_stain", (100, 40, 30), (125, 255, 200)),
)
CONTRAST = ((15, 0.5), (25, 0.6), (40, 0.7))
ANOMALY_WINDOWS, ANOMALY_LIMITS = (31, 61), ((2.0, 0.4), (3.0, 0.6))

RAW = "file_name string, width int, height int, cx int, cy int, r int, ord long, method string, confidence double, area double, x int, y int, w int, h int, error string"


def field_of_view(gray: np.ndarray) -> tuple[int, int, int] | None:
    """Centre and radius of the bright disc: the first of four thresholds whose largest region is round and of fitting size."""
    h, w = gray.shape
    for level in (20, 30, 40, 50):
        mask = K.opening(K.closing(gray > level, K.ellipse(5), 3), K.ellipse(5), 2)
        names, n = K.label(mask)
        if not n:
            continue
        shapes = [K.contour(names == i + 1) for i in range(n)]
        largest = max(shapes, key=K.polygon_area)
        cx, cy, r = K.enclosing_circle(largest)
        if r > 0 and K.polygon_area(largest) / (np.pi * r * r) > 0.85 and 0.2 * min(h, w) < r < 0.6 * max(h, w):
            return int(cx), int(cy), int(r)
    return None


def masks(norm: np.ndarray, inside: np.ndarray) -> Iterator[tuple[str, float, np.ndarray]]:
    """(method, confidence, mask) of every detector, in the order that breaks ties later."""
    small, mid, wide = K.ellipse(3), K.ellipse(5), K.ellipse(7)
    colour = K.hsv(norm)
    for method, low, high in STAINS:
        m = ((colour >= low) & (colour <= high)).all(-1) & inside
        yield method, 0.7, K.opening(K.closing(m, small, 2), small, 1)
    gray = K.gray_of(norm)
    dark = np.where(inside, gray, 0).astype(np.uint8)
    diff = np.where(inside, np.abs(dark.astype(float) - np.floor(K.gaussian(dark, 51) + 0.5)), 0)
    for level, sure in CONTRAST:
        yield f"contrast_t{level}", sure, K.opening(K.closing(diff > level, mid, 2), mid, 1)
    edges = K.canny(dark, 30, 100) & inside
    yield "edge_density", 0.4, K.closing(K.dilate(edges, wide, 3), wide, 2)
    mean = float(gray[inside].mean()) if inside.any() else 0.0
    if mean >= 30:
        m = (np.where(inside, gray, 255) <= int(max(30, mean * 0.6))) & inside
        yield "dark_object", 0.5, K.opening(K.closing(m, small, 2), small, 1)
    g = np.where(inside, gray, 0).astype(float)
    for size in ANOMALY_WINDOWS:
        mu = K.box_mean(g, size)
        z = np.abs(g - mu) / (np.sqrt(np.maximum(K.box_mean(g * g, size) - mu * mu, 0) + 1e-6) + 1e-6)
        for limit, sure in ANOMALY_LIMITS:
            yield f"anomaly_k{size}_z{limit}", sure, K.opening(K.closing((z > limit) & inside, small, 2), small, 1)


def raw_boxes(bgr: np.ndarray) -> tuple[tuple[int, int, int] | None, list[tuple]]:
    """The field of view and every region's ``(ord, method, confidence, polygon area, x, y, w, h)``."""
    h, w = bgr.shape[:2]
    fov = field_of_view(K.gray_of(bgr))
    inside = np.ones((h, w), bool)
    if fov:
        cx, cy, r = fov
        margin = max(10, int(r * 0.06))
        r = r - margin if r > 2 * margin else r
        y, x = np.ogrid[:h, :w]
        inside = (x - cx) ** 2 + (y - cy) ** 2 <= r * r
    norm = np.where(inside[..., None], K.equalize_lightness(bgr), 0).astype(np.uint8)
    out = []
    for method, sure, mask in masks(norm, inside):
        names, n = K.label(mask)
        for i in range(1, n + 1):
            region = names == i
            ys, xs = np.flatnonzero(region.any(1)), np.flatnonzero(region.any(0))
            cut = region[ys[0] : ys[-1] + 1, xs[0] : xs[-1] + 1]
            out.append((len(out), method, sure, K.polygon_area(K.contour(cut)), int(xs[0]), int(ys[0]), len(cut[0]), len(cut)))
    return fov, out


def scan(images: DataFrame) -> DataFrame:
    """Raw regions of each image (``file_name, content`` as PNG bytes): one row each, and one without a box for the image itself.

    An unreadable image gives a row with its ``error``; callers choose between failing and setting it aside.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in RAW.split(", ")]
        for frame in frames:
            for name, content in zip(frame.file_name, frame.content, strict=True):
                rows: list[tuple] = []
                try:
                    bgr = K.to_bgr(K.decode_png(bytes(content)))
                    if bgr.dtype == np.uint16:
                        bgr = (bgr >> 8).astype(np.uint8)
                    fov, found = raw_boxes(bgr)
                    head = (name, bgr.shape[1], bgr.shape[0], *(fov or (None,) * 3))
                    rows = [(*head, *f, None) for f in found] + [(*head, None, None, None, None, None, None, None, None, None)]
                except Exception as e:  # noqa: BLE001  any fault of one image is that image's row
                    rows = [(name, *(None,) * 13, f"{type(e).__name__}: {e}"[:300])]
                out = pd.DataFrame(rows, columns=names)
                for c in ("width", "height", "cx", "cy", "r", "ord", "x", "y", "w", "h"):
                    out[c] = out[c].astype("Int64")
                yield out

    return images.select("file_name", "content").mapInPandas(run, RAW)


def propose(images: DataFrame, min_frac: float = 0.0003, max_frac: float = 0.20, nms_num: int = 3, nms_den: int = 10, strict: bool = True) -> tuple[DataFrame, DataFrame]:
    """``(images, boxes)``: image rows with their field of view, and proposals after limits, padding, view and suppression."""
    raw = cut(scan(images))  # images and boxes both come from it: one pass over the pixels
    heads = raw.where("ord is null")
    if strict:
        heads = heads.withColumn("width", F.when(F.col("error").isNotNull(), F.raise_error(F.concat(F.lit("cannot read image: "), "file_name"))).otherwise(F.col("width")))
    view = F.coalesce(F.lit(np.pi) * F.col("r") * F.col("r"), F.col("width").cast("double") * F.col("height"))
    low, high = B.area_band(view, min_frac, max_frac)
    found = raw.where("ord is not null").withColumn("low", low).withColumn("high", high)
    padded = B.filter_and_pad(found, F.col("low"), F.col("high")).withColumn("r_full", F.col("r")).withColumn("r", B.shrunk_radius(F.col("r")))
    kept = B.inside_fov(padded, side_radius="r_full")
    boxes = kept.select(F.col("file_name").alias("image_id"), "file_name", "ord", "x", "y", "w", "h", "confidence", "method")
    return heads.select("file_name", "width", "height", "cx", "cy", "r", "error"), B.nms(boxes, nms_num, nms_den).drop("image_id")
