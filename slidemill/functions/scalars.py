"""Scalar expressions, all built from Spark's own functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from slidemill.schemas import COLORS


def whole(c: Column) -> Column:
    """Largest integer not above a number."""
    return F.floor(c).cast("long")


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def suffix(name: Column) -> Column:
    """The lower-case ending with its dot; a name that only starts with a dot has none."""
    return F.lower(F.regexp_extract(name, r"^.+(\.[^.]+)$", 1))


def stem(name: Column) -> Column:
    return F.regexp_replace(name, r"^(.+)\.[^.]+$", "$1")


def has_extension(name: Column, endings: tuple[str, ...]) -> Column:
    return suffix(name).isin(*(f".{e}" for e in endings))


def safe_token(s: Column) -> Column:
    """Blank-stripped text with all but letters, digits and ``-_.`` turned to ``_``; empty becomes ``unknown``."""
    stripped = F.regexp_replace(s, r"(?U)^\s+|\s+$", "")
    return F.coalesce(F.nullif(F.regexp_replace(stripped, r"[^\p{L}\p{N}\-_.]", "_"), F.lit("")), F.lit("unknown"))


def canonical_name(microscope: Column, parasite: Column, user: Column, image_id: Column, ext: Column) -> Column:
    head = F.concat_ws("__", F.lower(safe_token(microscope)), F.lower(safe_token(parasite)), F.lower(safe_token(user)), F.substring(image_id, 1, 12))
    return F.concat(head, F.lower(ext))


def triplet(relative: Column, strict: bool = False) -> Column:
    """``(microscope, parasite, user)`` of a path below the raw root; too shallow ones fail or are null."""
    parts = F.split(relative, "/")
    bad = F.raise_error(F.concat(F.lit("path is not microscope/parasite/user/...: "), relative)) if strict else F.lit(None)
    names = F.struct(F.get(parts, F.lit(0)).alias("microscope"), F.get(parts, F.lit(1)).alias("parasite"), F.get(parts, F.lit(2)).alias("user"))
    return F.when(F.size(parts) >= 4, names).otherwise(bad.cast("struct<microscope:string,parasite:string,user:string>"))


def default_label(name: Column) -> Column:
    parts = F.split(name, "__")
    return F.when(F.size(parts) >= 2, F.lower(F.replace(F.get(parts, F.lit(1)), F.lit("_"), F.lit(" ")))).otherwise(F.lit("Noise"))


def box_id(name: Column, ord_: Column) -> Column:
    """A short id that is the same on every run."""
    return F.substring(F.sha2(F.concat_ws("|", name, ord_.cast("string")), 256), 1, 8)


def overlap_area(a: dict[str, Column], b: dict[str, Column]) -> Column:
    """Intersection of two boxes given as ``x, y, w, h`` columns; 0 if they only touch."""
    side = lambda p, s: F.greatest(F.lit(0), F.least(a[p] + a[s], b[p] + b[s]) - F.greatest(a[p], b[p]))
    return side("x", "w") * side("y", "h")


def iou(a: dict[str, Column], b: dict[str, Column]) -> Column:
    inter = overlap_area(a, b)
    return F.when(inter > 0, inter / (a["w"] * a["h"] + b["w"] * b["h"] - inter)).otherwise(F.lit(0.0))


def fields(s: Column) -> dict[str, Column]:
    return {k: s[k] for k in ("x", "y", "w", "h")}


def columns(prefix: str = "") -> dict[str, Column]:
    return {k: F.col(prefix + k) for k in ("x", "y", "w", "h")}


def yolo(x: Column, y: Column, w: Column, h: Column, width: Column, height: Column) -> list[Column]:
    return [((x + w / 2) / width).alias("xc"), ((y + h / 2) / height).alias("yc"), (w / width).alias("nw"), (h / height).alias("nh")]


def percent_delta(new: Column, baseline: Column) -> Column:
    return F.when(F.abs(baseline) > 1e-8, 100.0 * (new - baseline) / baseline)


def quality_score(lap: Column, ten: Column, bren: Column, hf: Column) -> Column:
    return 0.45 * F.log1p(lap) + 0.30 * F.log1p(ten) + 0.15 * F.log1p(bren) + 0.10 * hf


def scale_warp(warp: Column, scale: float) -> Column:
    """A 2x3 warp (row by row) for an image ``scale`` times as large: the shift column is multiplied."""
    return F.transform(warp, lambda v, i: F.when(i % 3 == 2, v * scale).otherwise(v))


def method_color(method: Column) -> Column:
    out = F.array(*map(F.lit, (0, 255, 0)))
    for part, bgr in reversed(COLORS):
        out = F.when(F.contains(method, F.lit(part)), F.array(*map(F.lit, bgr))).otherwise(out)
    return out


def maybe_label(base: Column) -> Column:
    return F.concat(base, F.lit("_maybe"))


def drawn_enough(w: Column, h: Column) -> Column:
    return (w >= 5) & (h >= 5)
