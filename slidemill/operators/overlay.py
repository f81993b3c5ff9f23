"""Rendered overlays: boxes in their method's colour and the field of view, drawn on each image inside an Arrow function."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slidemill.functions.scalars import method_color
from slidemill.operators import kernels as K

OUT = "file_name string, name string, png binary, captions array<string>"


def draw(bgr: np.ndarray, boxes: list[tuple], view: tuple | None) -> np.ndarray:
    """Rectangles two pixels wide, given as ``(x, y, w, h, (b, g, r))``, and the circle ``(cx, cy, r)``, cut at the edge."""
    out = bgr.copy()
    h, w = out.shape[:2]
    for x, y, bw, bh, color in boxes:
        for t in (0, 1):
            left, top, right, bottom = max(x - t, 0), max(y - t, 0), min(x + bw + t, w - 1), min(y + bh + t, h - 1)
            if left > right or top > bottom:
                continue
            for r in {top, bottom}:
                out[r, left : right + 1] = color
            for c in {left, right}:
                out[top : bottom + 1, c] = color
    if view:
        angle = np.linspace(0, 2 * np.pi, max(16, int(8 * view[2])))
        y, x = np.rint(view[1] + view[2] * np.sin(angle)).astype(int), np.rint(view[0] + view[2] * np.cos(angle)).astype(int)
        ok = (y >= 0) & (y < h) & (x >= 0) & (x < w)
        out[y[ok], x[ok]] = (255, 200, 0)
    return out


def render(contents: DataFrame, images: DataFrame, boxes: DataFrame) -> DataFrame:
    """``det_<file>`` PNGs of images (``file_name, content``) with their heads (``cx, cy, r``) and boxes.

    No font is drawn; each box's ``method confidence`` text is in ``captions``, in box order.
    """
    item = F.struct("ord", "x", "y", "w", "h", method_color(F.col("method")).alias("color"), F.concat_ws(" ", "method", F.format_number("confidence", 1)).alias("caption"))
    packed = boxes.groupBy("file_name").agg(F.array_sort(F.collect_list(item)).alias("boxes"))
    all_ = contents.select("file_name", "content").join(images.where("error is null").select("file_name", "cx", "cy", "r"), "file_name").join(packed, "file_name", "left")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for f in frame.itertuples():
                bgr = K.to_bgr(K.decode_png(bytes(f.content)))
                bgr = (bgr >> 8).astype(np.uint8) if bgr.dtype == np.uint16 else bgr
                found = list(f.boxes) if f.boxes is not None else []
                view = (f.cx, f.cy, f.r) if f.r is not None and not pd.isna(f.r) else None
                img = draw(bgr, [(b["x"], b["y"], b["w"], b["h"], tuple(b["color"])) for b in found], view)
                rows.append((f.file_name, f"det_{f.file_name}", K.encode_png(img[..., ::-1]), [b["caption"] for b in found]))
            yield pd.DataFrame(rows, columns=["file_name", "name", "png", "captions"])

    return all_.mapInPandas(run, OUT)
