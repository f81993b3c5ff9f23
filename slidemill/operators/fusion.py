"""Scene fusion: registration, warping, weighted mean and sharpening, one scene in a group."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from slidemill.operators import kernels as K

MOTIONS = ("translation", "euclidean", "affine")
OUT = "scene string, name string, role string, width int, height int, laplacian_variance double, tenengrad double, brenner double, high_frequency_ratio double, edge_density double, registration_ok boolean, registration_cc double, warp array<double>, fusion_weight double, png binary"


def cubic(t: np.ndarray) -> np.ndarray:
    """Cubic interpolation kernel with a = -0.75."""
    a, x = -0.75, np.abs(t)
    return np.where(x <= 1, (a + 2) * x**3 - (a + 3) * x**2 + 1, np.where(x < 2, a * x**3 - 5 * a * x**2 + 8 * a * x - 4 * a, 0))


def sample(img: np.ndarray, y: np.ndarray, x: np.ndarray, reflect: bool = True) -> np.ndarray:
    """Cubic samples of an image at real positions; outside it reflects (edge pixel repeated) or clamps."""
    h, w = img.shape[:2]
    y0, x0 = np.floor(y).astype(int), np.floor(x).astype(int)
    back = lambda i, n: np.where((m := np.mod(i, 2 * n)) < n, m, 2 * n - 1 - m) if reflect else np.clip(i, 0, n - 1)
    out = np.zeros((*y.shape, *img.shape[2:]))
    for i in range(-1, 3):
        for j in range(-1, 3):
            weight = cubic(y - y0 - i) * cubic(x - x0 - j)
            out += (weight[..., None] if img.ndim == 3 else weight) * img[back(y0 + i, h), back(x0 + j, w)]
    return out


def resize(img: np.ndarray, width: int, height: int) -> np.ndarray:
    if img.shape[:2] == (height, width):
        return img
    y, x = np.meshgrid((np.arange(height) + 0.5) * img.shape[0] / height - 0.5, (np.arange(width) + 0.5) * img.shape[1] / width - 0.5, indexing="ij")
    return sample(img, y, x, reflect=False)


def positions(warp: np.ndarray, width: int, height: int) -> tuple[np.ndarray, np.ndarray]:
    """Where each output pixel comes from: the warp maps output to input."""
    y, x = np.mgrid[:height, :width].astype(float)
    return warp[1, 0] * x + warp[1, 1] * y + warp[1, 2], warp[0, 0] * x + warp[0, 1] * y + warp[0, 2]


def register(moving: np.ndarray, fixed: np.ndarray, motion: str = "euclidean", iterations: int = 300, eps: float = 1e-5) -> tuple[np.ndarray, float | None, bool]:
    """Warp of ``moving`` onto ``fixed`` by maximising the enhanced correlation coefficient (Evangelidis and Psarakis, 2008).

    Forward-additive Gauss-Newton steps from the identity; a degenerate step or vanishing overlap gives the identity,
    no coefficient and False.
    """
    h, w = fixed.shape
    warp, last = np.eye(2, 3), -1.0
    gy, gx = np.gradient(moving)
    yy, xx = np.mgrid[:h, :w].astype(float)
    rho = None
    for _ in range(iterations):
        y, x = positions(warp, w, h)
        inside = (y >= 0) & (y <= moving.shape[0] - 1) & (x >= 0) & (x <= moving.shape[1] - 1)
        if inside.sum() < 16:
            return np.eye(2, 3), None, False
        at = lambda img: sample(img, y[inside], x[inside], reflect=False)
        image, ix, iy, px, py = at(moving), at(gx), at(gy), xx[inside], yy[inside]
        if motion == "translation":
            jac = np.stack([ix, iy], 1)
        elif motion == "euclidean":
            angle = np.arctan2(warp[1, 0], warp[0, 0])
            s, c = np.sin(angle), np.cos(angle)
            jac = np.stack([ix * (-px * s - py * c) + iy * (px * c - py * s), ix, iy], 1)
        else:
            jac = np.stack([ix * px, iy * px, ix * py, iy * py, ix, iy], 1)
        i, t = image - image.mean(), fixed[inside] - fixed[inside].mean()
        ni, nt = np.linalg.norm(i), np.linalg.norm(t)
        if ni < 1e-12 or nt < 1e-12:
            return np.eye(2, 3), None, False
        rho = float(i @ t / (ni * nt))
        if abs(rho - last) < eps:
            break
        last = rho
        jac = jac - jac.mean(0)
        try:
            inverse = np.linalg.inv(jac.T @ jac)
        except np.linalg.LinAlgError:
            return np.eye(2, 3), None, False
        pi, pt = jac.T @ i, jac.T @ t
        below = t @ i - pt @ inverse @ pi
        scale = (ni * ni - pi @ inverse @ pi) / below if below > 0 else 1.0
        step = inverse @ (jac.T @ (scale * t - i))
        if not np.isfinite(step).all():
            return np.eye(2, 3), None, False
        if motion == "translation":
            warp[:, 2] += step
        elif motion == "euclidean":
            angle += step[0]
            warp[:, :2] = [[np.cos(angle), -np.sin(angle)], [np.sin(angle), np.cos(angle)]]
            warp[:, 2] += step[1:]
        else:
            warp += step.reshape(3, 2).T
    return warp, rho, rho is not None


def unsharp(img: np.ndarray, sigma: float = 1.2, amount: float = 0.5) -> np.ndarray:
    if amount <= 0:
        return np.clip(img, 0, 1)
    blur = np.stack([K.gaussian(img[..., c], 0, sigma) for c in range(img.shape[2])], -1)
    return np.clip(img * (1 + amount) - blur * amount, 0, 1)


def prepared(gray: np.ndarray, width: int, height: int) -> np.ndarray:
    """Grey values at the reference's size, blurred 5 x 5 and stretched to 0..1."""
    g = K.gaussian(resize(gray.astype(float), width, height), 5)
    low, high = g.min(), g.max()
    return (g - low) / (high - low) if high > low else np.zeros_like(g)


def fuse_scene(scenes: DataFrame, scale: int = 2, motion: str = "euclidean", top_k: int | None = None, iterations: int = 300, eps: float = 1e-5, amount: float = 0.5, sigma: float = 1.2) -> DataFrame:
    """Fuse each scene's images (``scene, name, content`` as PNG): metric rows of the inputs used and of the output with its PNG.

    The sharpest image (ties by name) is the reference; the ``top_k`` sharpest take part. A scene is a handful of views of
    one field, which has to be in memory to be fused; scenes are spread over tasks. At least two readable images are
    needed, else the scene gives no rows.
    """
    if motion not in MOTIONS:
        raise ValueError(f"motion is one of {MOTIONS}")

    def run(key, frame: pd.DataFrame) -> pd.DataFrame:
        names = [c.split()[0] for c in OUT.split(", ")]
        views = []
        for name, content in sorted(zip(frame.name, frame.content, strict=True)):
            try:
                img = K.unit(K.to_bgr(K.decode_png(bytes(content)))).astype(float)
            except Exception:  # noqa: BLE001  an unreadable view is left out
                continue
            m = K.sharpness(img.astype(np.float32))
            quality = 0.45 * np.log1p(m["laplacian_variance"]) + 0.30 * np.log1p(m["tenengrad"]) + 0.15 * np.log1p(m["brenner"]) + 0.10 * m["high_frequency_ratio"]
            views.append([name, img, m, float(quality)])
        if len(views) < 2:
            return pd.DataFrame(columns=names)
        views.sort(key=lambda v: -v[3])
        views = views[:top_k] if top_k else views
        h, w = views[0][1].shape[:2]
        fixed = prepared(K.gray_of(views[0][1]), w, h)
        placed = []
        for n, (name, img, m, q) in enumerate(views):
            warp, cc, ok = (np.eye(2, 3), 1.0, True) if n == 0 else register(prepared(K.gray_of(img), w, h), fixed, motion, iterations, eps)
            placed.append((name, img, m, max(q, 1e-6) * (1 if ok else 0.25), warp, cc, ok))
        total = sum(p[3] for p in placed) or 1.0
        acc, weight = np.zeros((h * scale, w * scale, 3)), np.zeros((h * scale, w * scale, 1))
        rows = []
        for name, img, m, raw, warp, cc, ok in placed:
            large = resize(resize(img, w, h), w * scale, h * scale)
            big = warp.copy()
            big[:, 2] *= scale
            y, x = positions(big, w * scale, h * scale)
            mask = ((np.rint(y) >= 0) & (np.rint(y) < h * scale) & (np.rint(x) >= 0) & (np.rint(x) < w * scale))[..., None] * (raw / total)
            acc += sample(large, y, x) * mask
            weight += mask
            rows.append((key[0], name, "input", img.shape[1], img.shape[0], *m.values(), ok, cc, warp.ravel().tolist(), raw / total, None))
        fused = np.clip(unsharp(acc / np.maximum(weight, 1e-6), sigma, amount), 0, 1)
        m = K.sharpness(fused.astype(np.float32))
        png = K.encode_png(np.clip(fused[..., ::-1] * 255, 0, 255).astype(np.uint8))
        rows.append((key[0], "super_resolved_output", "output", w * scale, h * scale, *m.values(), True, 1.0, None, 1.0, png))
        return pd.DataFrame(rows, columns=names)

    return scenes.select("scene", "name", "content").groupBy("scene").applyInPandas(run, OUT)
