"""Sharpness kernels on small rasters: row-major arrays of ``side * side`` doubles, a whole Arrow batch at a time.

Borders reflect without repeating the edge pixel. Null rasters and rasters of another size give null.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

LAPLACE = {(-1, -1): 2.0, (-1, 1): 2.0, (1, -1): 2.0, (1, 1): 2.0, (0, 0): -8.0}
SOBEL_X = {(r, c): float(w * c) for r, w in ((-1, 1), (0, 2), (1, 1)) for c in (-1, 1)}
SOBEL_Y = {(c, r): w for (r, c), w in SOBEL_X.items()}


def _batched(a: Column, side: int, of: Callable[[np.ndarray], np.ndarray], returns: str = "double") -> Column:
    """``of`` over all rasters of a batch, stacked to ``(n, side, side)``."""

    @F.pandas_udf(returns)
    def run(rows: pd.Series) -> pd.Series:
        ok = [i for i, v in enumerate(rows) if v is not None and len(v) == side * side]
        out = [None] * len(rows)
        if ok:
            found = of(np.stack([np.asarray(rows.iloc[i], float) for i in ok]).reshape(-1, side, side))
            for i, v in zip(ok, found, strict=True):
                out[i] = v
        return pd.Series(out, dtype=object)

    return run(a)


def _convolve(x: np.ndarray, kernel: dict[tuple[int, int], float]) -> np.ndarray:
    """Weighted sum of neighbours at (row, column) offsets, for every pixel of every raster."""
    reach = max(max(abs(r), abs(c)) for r, c in kernel)
    p, side = np.pad(x, ((0, 0), (reach, reach), (reach, reach)), mode="reflect"), x.shape[1]
    return sum(w * p[:, reach + r : reach + r + side, reach + c : reach + c + side] for (r, c), w in kernel.items())


def laplacian_variance(a: Column, side: int) -> Column:
    return _batched(a, side, lambda x: _convolve(x, LAPLACE).var(axis=(1, 2)))


def tenengrad(a: Column, side: int) -> Column:
    return _batched(a, side, lambda x: (_convolve(x, SOBEL_X) ** 2 + _convolve(x, SOBEL_Y) ** 2).mean(axis=(1, 2)))


def brenner(a: Column, side: int) -> Column:
    """Mean squared difference of pixels two columns apart; 0 for at most two columns."""
    return _batched(a, side, lambda x: ((x[:, :, 2:] - x[:, :, :-2]) ** 2).mean(axis=(1, 2))) if side > 2 else F.lit(0.0)


def high_frequency_ratio(a: Column, side: int, share: float = 0.15) -> Column:
    """Spectral power at a radius of at least ``share`` of the side from the centre, over all power."""
    at = np.arange(side) - side / 2
    far = np.hypot(at[:, None], at[None, :]) >= share * side

    def ratio(x: np.ndarray) -> np.ndarray:
        power = np.abs(np.fft.fftshift(np.fft.fft2(x), axes=(1, 2))) ** 2
        return power[:, far].sum(1) / (power.sum(axis=(1, 2)) + 1e-8)

    return _batched(a, side, ratio)


def z_scores(a: Column, side: int, reach: int = 1) -> Column:
    """|pixel - local mean| / local deviation with the anomaly kernel's floors, for a window of 2 reach + 1."""
    n = (2 * reach + 1) ** 2
    box = {(r, c): 1.0 / n for r in range(-reach, reach + 1) for c in range(-reach, reach + 1)}

    def z(x: np.ndarray) -> list:
        mu = _convolve(x, box)
        dev = np.sqrt(np.maximum(_convolve(x * x, box) - mu * mu, 0) + 1e-6) + 1e-6
        return list((np.abs(x - mu) / dev).reshape(len(x), -1))

    return _batched(a, side, z, "array<double>")
