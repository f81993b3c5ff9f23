"""Pixel kernels in numpy, run inside Arrow functions: one image at a time, no image library.

Where an image library's exact rounding is not public arithmetic (blurs, edges, contours), the semantics are those
written here; tests hold them to plain loops.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

# ---- decoding ----


def decode_png(data: bytes) -> np.ndarray:
    """A PNG of 8 or 16 bits a sample, grey, RGB or with alpha, not interlaced: height x width (x channels)."""
    if data[:8] != b"\x89PNG\r\n\x1a\n":
        raise ValueError("not a PNG")
    at, head, body = 8, None, b""
    while at < len(data):
        size, kind = struct.unpack(">I4s", data[at : at + 8])
        chunk = data[at + 8 : at + 8 + size]
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", chunk)
        elif kind == b"IDAT":
            body += chunk
        at += size + 12
    w, h, bits, color, _, _, interlaced = head
    channels = {0: 1, 2: 3, 4: 2, 6: 4}.get(color)
    if channels is None or bits not in (8, 16) or interlaced:
        raise ValueError("unsupported PNG")
    step = channels * bits // 8
    raw = np.frombuffer(zlib.decompress(body), np.uint8).reshape(h, 1 + w * step)
    out = np.zeros((h, w * step), np.uint8)
    above = np.zeros(w * step, np.uint8)
    for r in range(h):
        line, kind = raw[r, 1:].copy(), raw[r, 0]
        if kind == 2:
            line += above
        elif kind in (1, 3, 4):
            px, up = line.reshape(w, step).astype(np.int32), above.reshape(w, step).astype(np.int32)
            left, corner = np.zeros(step, np.int32), np.zeros(step, np.int32)
            for c in range(w):
                if kind == 1:
                    guess = left
                elif kind == 3:
                    guess = (left + up[c]) // 2
                else:
                    p = left + up[c] - corner
                    a, b, d = abs(p - left), abs(p - up[c]), abs(p - corner)
                    guess = np.where((a <= b) & (a <= d), left, np.where(b <= d, up[c], corner))
                px[c] = (px[c] + guess) & 255
                left, corner = px[c], up[c]
            line = px.astype(np.uint8).reshape(-1)
        out[r] = above = line
    img = out.reshape(h, w, channels, bits // 8)
    img = img[..., 0] if bits == 8 else (img[..., 0].astype(np.uint16) << 8) | img[..., 1]
    return img[..., 0] if channels == 1 else img


def encode_png(img: np.ndarray) -> bytes:
    """An 8-bit grey or RGB image as a PNG."""
    h, w = img.shape[:2]
    color = 0 if img.ndim == 2 else 2
    rows = np.concatenate([np.zeros((h, 1), np.uint8), np.ascontiguousarray(img, np.uint8).reshape(h, -1)], 1).tobytes()
    part = lambda kind, body: struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))
    return b"\x89PNG\r\n\x1a\n" + part(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, color, 0, 0, 0)) + part(b"IDAT", zlib.compress(rows)) + part(b"IEND", b"")


def to_bgr(img: np.ndarray) -> np.ndarray:
    """Grey or RGB(A) samples as blue, green, red."""
    if img.ndim == 2:
        return np.stack([img] * 3, -1)
    return np.stack([img[..., 0]] * 3, -1) if img.shape[2] == 2 else img[..., 2::-1] if img.shape[2] >= 3 else img


def unit(img: np.ndarray) -> np.ndarray:
    """Samples in 0..1: by 255 or 65535 for integers, else by the maximum if that is above 1."""
    if img.dtype == np.uint8:
        return (img / np.float32(255)).astype(np.float32)
    if img.dtype == np.uint16:
        return (img / np.float32(65535)).astype(np.float32)
    img = img.astype(np.float32)
    top = float(img.max(initial=0))
    return np.clip(img / top if top > 1 else img, 0, 1)


def gray_of(bgr: np.ndarray) -> np.ndarray:
    """Luma 0.299 R + 0.587 G + 0.114 B; bytes stay bytes, rounded."""
    g = bgr[..., 0] * 0.114 + bgr[..., 1] * 0.587 + bgr[..., 2] * 0.299
    return np.floor(g + 0.5).astype(np.uint8) if bgr.dtype == np.uint8 else g.astype(np.float32)


# ---- neighbourhoods ----


def convolve1(img: np.ndarray, taps: np.ndarray, axis: int, mode: str = "reflect") -> np.ndarray:
    n = len(taps) // 2
    pad = [(0, 0)] * img.ndim
    pad[axis] = (n, n)
    p = np.pad(img.astype(np.float64), pad, mode=mode if img.shape[axis] > n or mode != "reflect" else "symmetric")
    out, size = np.zeros(img.shape), img.shape[axis]
    for i, t in enumerate(taps):
        out += t * np.take(p, range(i, i + size), axis)
    return out


def gaussian_taps(size: int, sigma: float) -> np.ndarray:
    """Normalised Gaussian; a sigma of 0 follows from the size, a size of 0 from the sigma."""
    size = size or 2 * int(np.floor(4 * sigma + 0.5)) + 1
    sigma = sigma or 0.3 * ((size - 1) * 0.5 - 1) + 0.8
    x = np.arange(size) - size // 2
    t = np.exp(-x * x / (2 * sigma * sigma))
    return t / t.sum()


def gaussian(img: np.ndarray, size: int = 0, sigma: float = 0.0) -> np.ndarray:
    t = gaussian_taps(size, sigma)
    return convolve1(convolve1(img, t, 0), t, 1)


def box_mean(img: np.ndarray, size: int) -> np.ndarray:
    """Mean over a size x size window with reflected borders, from running sums."""
    n = size // 2
    mode = "reflect" if min(img.shape) > n else "symmetric"
    p = np.pad(img.astype(np.float64), n, mode=mode)
    s = np.pad(p.cumsum(0).cumsum(1), ((1, 0), (1, 0)))
    return (s[size:, size:] - s[:-size, size:] - s[size:, :-size] + s[:-size, :-size]) / (size * size)


def correlate3(img: np.ndarray, kernel) -> np.ndarray:
    p = np.pad(img.astype(np.float64), 1, mode="reflect" if min(img.shape) > 1 else "edge")
    h, w = img.shape
    return sum(k * p[r : r + h, c : c + w] for r, row in enumerate(kernel) for c, k in enumerate(row) if k)


def sobel(img: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return correlate3(img, ((-1, 0, 1), (-2, 0, 2), (-1, 0, 1))), correlate3(img, ((-1, -2, -1), (0, 0, 0), (1, 2, 1)))


def ellipse(size: int) -> np.ndarray:
    """Inscribed ellipse of a square window, row by row."""
    r = size // 2
    y = np.arange(size) - r
    half = np.floor(r * np.sqrt(np.maximum(r * r - y * y, 0) / max(r * r, 1)) + 0.5).astype(int)
    return np.abs(np.arange(size) - r)[None, :] <= half[:, None]


def disk(radius: int) -> np.ndarray:
    y = np.arange(-radius, radius + 1)
    return y[:, None] ** 2 + y[None, :] ** 2 <= radius * radius


def dilate(mask: np.ndarray, shape: np.ndarray, times: int = 1) -> np.ndarray:
    h, w = mask.shape
    a, b = shape.shape[0] // 2, shape.shape[1] // 2
    for _ in range(times):
        p, out = np.pad(mask, ((a, a), (b, b))), np.zeros_like(mask)
        for r, c in np.argwhere(shape):
            out |= p[r : r + h, c : c + w]
        mask = out
    return mask


def erode(mask: np.ndarray, shape: np.ndarray, times: int = 1) -> np.ndarray:
    """Outside the image nothing erodes."""
    return ~dilate(~mask, shape[::-1, ::-1], times)


def closing(mask, shape, times=1):
    return erode(dilate(mask, shape, times), shape, times)


def opening(mask, shape, times=1):
    return dilate(erode(mask, shape, times), shape, times)


def label(mask: np.ndarray) -> tuple[np.ndarray, int]:
    """Connected regions (eight neighbours): runs of each row are joined to touching runs of the row above."""
    h, w = mask.shape
    up: list[int] = []

    def root(x: int) -> int:
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    runs, above = [], []
    for r in range(h):
        edge = np.flatnonzero(np.diff(mask[r].astype(np.int8), prepend=0, append=0))
        here, j = [], 0
        for s, e in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
            me = len(up)
            up.append(me)
            while j < len(above) and above[j][1] < s:
                j += 1
            k = j
            while k < len(above) and above[k][0] <= e:
                a, b = root(above[k][2]), root(me)
                up[max(a, b)] = min(a, b)
                k += 1
            here.append((s, e, me))
            runs.append((r, s, e, me))
        above = here
    out, names = np.zeros((h, w), np.int32), {}
    for r, s, e, me in runs:
        out[r, s:e] = names.setdefault(root(me), len(names) + 1)
    return out, len(names)


def contour(mask: np.ndarray) -> np.ndarray:
    """Outer boundary of one region as pixel centres (row, column), traced clockwise from its first pixel."""
    p = np.pad(mask, 1)
    r, c = np.argwhere(p)[0]
    ring = ((0, 1), (1, 1), (1, 0), (1, -1), (0, -1), (-1, -1), (-1, 0), (-1, 1))
    path, at, came = [(r, c)], (int(r), int(c)), 6
    first = None
    while True:
        for i in range(8):
            d = (came + i) % 8
            n = (at[0] + ring[d][0], at[1] + ring[d][1])
            if p[n]:
                break
        else:
            return np.array(path) - 1
        if first is None:
            first = (at, d)
        elif (at, d) == first:
            return np.array(path[:-1]) - 1
        at, came = n, (d + 6) % 8 if d % 2 == 0 else (d + 5) % 8
        path.append(at)


def polygon_area(points: np.ndarray) -> float:
    y, x = points[:, 0].astype(float), points[:, 1].astype(float)
    return abs(float((x * np.roll(y, -1) - y * np.roll(x, -1)).sum())) / 2


def enclosing_circle(points: np.ndarray) -> tuple[float, float, float]:
    """Smallest circle (x, y, r) round points, moving-point insertion in a fixed order."""
    pts = np.unique(points[:, ::-1].astype(float), axis=0)
    pts = pts[np.random.default_rng(0).permutation(len(pts))]

    def two(a, b):
        m = (a + b) / 2
        return m, float(np.hypot(*(a - m)))

    def three(a, b, c):
        d = 2 * (a[0] * (b[1] - c[1]) + b[0] * (c[1] - a[1]) + c[0] * (a[1] - b[1]))
        if abs(d) < 1e-12:
            return max((two(a, b), two(a, c), two(b, c)), key=lambda t: t[1])
        s = [float(v @ v) for v in (a, b, c)]
        m = np.array([s[0] * (b[1] - c[1]) + s[1] * (c[1] - a[1]) + s[2] * (a[1] - b[1]), s[0] * (c[0] - b[0]) + s[1] * (a[0] - c[0]) + s[2] * (b[0] - a[0])]) / d
        return m, float(np.hypot(*(a - m)))

    far = lambda m, r, q: np.flatnonzero(np.hypot(*(q - m).T) > r + 1e-7)
    m, r, i = pts[0], 0.0, 0
    while len(out := far(m, r, pts)):
        i = int(out[0])
        m, r = pts[i], 0.0
        while len(o2 := far(m, r, pts[:i])):
            j = int(o2[0])
            m, r = two(pts[i], pts[j])
            while len(o3 := far(m, r, pts[:j])):
                m, r = three(pts[i], pts[j], pts[int(o3[0])])
    return float(m[0]), float(m[1]), r


def canny(gray: np.ndarray, low: float, high: float) -> np.ndarray:
    """Edges: |gx| + |gy|, thinned along the rounded gradient direction, grown from strong through weak pixels."""
    gx, gy = sobel(gray)
    mag = np.abs(gx) + np.abs(gy)
    p = np.pad(mag, 1)
    h, w = mag.shape
    side = lambda r, c: p[1 + r : 1 + r + h, 1 + c : 1 + c + w]
    angle = np.abs(gy) / np.maximum(np.abs(gx), 1e-12)
    flat, steep, same = angle < 0.41421356, angle > 2.41421356, gx * gy > 0
    one = np.where(flat, side(0, -1), np.where(steep, side(-1, 0), np.where(same, side(-1, -1), side(-1, 1))))
    two = np.where(flat, side(0, 1), np.where(steep, side(1, 0), np.where(same, side(1, 1), side(1, -1))))
    thin = (mag > one) & (mag >= two)
    names, _ = label(thin & (mag > low))
    strong = np.unique(names[thin & (mag > high)])
    return np.isin(names, strong[strong > 0])


def otsu(gray: np.ndarray, bins: int = 256) -> float:
    """Threshold of largest between-class variance over a histogram's bin centres."""
    n, edges = np.histogram(gray.ravel(), bins)
    mid = (edges[:-1] + edges[1:]) / 2
    w1, w2 = np.cumsum(n), np.cumsum(n[::-1])[::-1]
    m1, m2 = np.cumsum(n * mid) / np.maximum(w1, 1), (np.cumsum((n * mid)[::-1]) / np.maximum(w2[::-1], 1))[::-1]
    return float(mid[np.argmax(w1[:-1] * w2[1:] * (m1[:-1] - m2[1:]) ** 2)])


# ---- colour ----


def hsv(bgr: np.ndarray) -> np.ndarray:
    """Hue in 0..179 (half degrees), saturation and value in 0..255."""
    b, g, r = (bgr[..., i].astype(np.float64) for i in range(3))
    v, low = np.maximum(np.maximum(b, g), r), np.minimum(np.minimum(b, g), r)
    d = v - low
    safe = np.where(d == 0, 1, d)
    hue = np.where(v == r, (g - b) / safe, np.where(v == g, 2 + (b - r) / safe, 4 + (r - g) / safe)) * 30
    hue = np.where(d == 0, 0, np.where(hue < 0, hue + 180, hue))
    sat = np.where(v == 0, 0, 255 * d / np.where(v == 0, 1, v))
    return np.stack([np.floor(hue + 0.5) % 180, np.floor(sat + 0.5), v], -1)


def clahe(channel: np.ndarray, clip: float = 3.0, grid: int = 8) -> np.ndarray:
    """Contrast-limited histogram equalisation of bytes: a clipped map for each cell, blended between cell centres."""
    h, w = channel.shape
    th, tw = -(-h // grid), -(-w // grid)
    p = np.pad(channel, ((0, th * grid - h), (0, tw * grid - w)), mode="symmetric" if min(h, w) < max(th, tw) * grid - min(h, w) + 1 else "reflect")
    limit = max(int(clip * th * tw / 256), 1)
    maps = np.zeros((grid, grid, 256))
    for i in range(grid):
        for j in range(grid):
            n = np.bincount(p[i * th : (i + 1) * th, j * tw : (j + 1) * tw].ravel(), minlength=256)
            over = int(np.maximum(n - limit, 0).sum())
            n = np.minimum(n, limit) + over // 256
            n[: over % 256] += 1
            maps[i, j] = np.clip(np.floor(np.cumsum(n) * 255 / (th * tw) + 0.5), 0, 255)
    y, x = (np.arange(h) + 0.5) / th - 0.5, (np.arange(w) + 0.5) / tw - 0.5
    y0, x0 = np.floor(y).astype(int), np.floor(x).astype(int)
    fy, fx = (y - y0)[:, None], (x - x0)[None, :]
    at = lambda a, b: maps[np.clip(a, 0, grid - 1)[:, None], np.clip(b, 0, grid - 1)[None, :], channel]
    out = (1 - fy) * ((1 - fx) * at(y0, x0) + fx * at(y0, x0 + 1)) + fy * ((1 - fx) * at(y0 + 1, x0) + fx * at(y0 + 1, x0 + 1))
    return np.floor(out + 0.5).astype(np.uint8)


_XYZ = np.array([[0.412453, 0.357580, 0.180423], [0.212671, 0.715160, 0.072169], [0.019334, 0.119193, 0.950227]])
_WHITE = _XYZ.sum(1)


def equalize_lightness(bgr: np.ndarray) -> np.ndarray:
    """CLAHE on CIE L* (scaled to bytes), a* and b* unchanged."""
    rgb = bgr[..., ::-1] / 255.0
    linear = np.where(rgb <= 0.04045, rgb / 12.92, ((rgb + 0.055) / 1.055) ** 2.4)
    t = linear @ _XYZ.T / _WHITE
    f = np.where(t > 0.008856, np.cbrt(t), 7.787 * t + 16 / 116)
    light = 116 * f[..., 1] - 16
    new = clahe(np.clip(np.floor(light * 2.55 + 0.5), 0, 255).astype(np.uint8)) / 2.55
    fy = (new + 16) / 116
    g = np.stack([fy + f[..., 0] - f[..., 1], fy, fy + f[..., 2] - f[..., 1]], -1)
    xyz = np.where(g > 0.206893, g**3, (g - 16 / 116) / 7.787) * _WHITE
    back = np.clip(xyz @ np.linalg.inv(_XYZ).T, 0, 1)
    out = np.where(back <= 0.0031308, 12.92 * back, 1.055 * back ** (1 / 2.4) - 0.055)
    return np.clip(np.floor(out[..., ::-1] * 255 + 0.5), 0, 255).astype(np.uint8)


# ---- sharpness ----


def high_frequency_ratio(gray: np.ndarray, share: float = 0.15) -> float:
    """Spectral power at a radius of at least ``share`` of the shorter side from the centre (h/2, w/2), over all power."""
    h, w = gray.shape
    power = np.abs(np.fft.fftshift(np.fft.fft2(gray))) ** 2
    y, x = np.ogrid[:h, :w]
    far = np.sqrt((y - h / 2) ** 2 + (x - w / 2) ** 2) >= share * min(h, w)
    return float(power[far].sum() / (power.sum() + 1e-8))


def sharpness(bgr: np.ndarray) -> dict[str, float]:
    """The five metrics of an image, with grey values in 0..1 (edges on bytes)."""
    u = unit(bgr)
    gray = gray_of(u).astype(np.float64)
    gx, gy = sobel(gray)
    wide = gray.shape[1] > 2
    return {
        "laplacian_variance": float(correlate3(gray, ((2, 0, 2), (0, -8, 0), (2, 0, 2))).var()),
        "tenengrad": float((gx * gx + gy * gy).mean()),
        "brenner": float(((gray[:, 2:] - gray[:, :-2]) ** 2).mean()) if wide else 0.0,
        "high_frequency_ratio": high_frequency_ratio(gray),
        "edge_density": float(canny(np.clip(gray * 255, 0, 255).astype(np.uint8), 100, 200).mean()),
    }
