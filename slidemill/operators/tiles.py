"""Tile grids: window starts, keep rule on a circular field of view, running numbers and names."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from slidemill.operators.boxes import disk_pixels


def grid(images: DataFrame, patch: int = 1024, stride: int = 256) -> DataFrame:
    """Every full window of an image: its columns plus ``r0, c0``; images smaller than the patch give none."""
    starts = lambda c: F.sequence(F.lit(0), F.col(c).cast("int") - patch, F.lit(stride))
    fits = images.where((F.col("width") >= patch) & (F.col("height") >= patch))
    return fits.withColumn("r0", F.explode(starts("height"))).withColumn("c0", F.explode(starts("width")))


def keep_in_fov(tiles: DataFrame, patch: int, min_fraction: float, require_center: bool = True) -> DataFrame:
    """Tiles with enough of their pixels in the disk ``cx, cy, r`` (whole numbers) and, if asked, their centre pixel in it.

    A tile whose corners are all in the disk lies in it whole, one beyond it all has none; only the pixels of the
    others are counted.
    """
    side = F.lit(patch - 1)
    square = lambda c: c * c
    end = lambda p, s: (F.col(p) + side, F.col(s))
    (right, cx), (bottom, cy) = end("c0", "cx"), end("r0", "cy")
    widest = square(F.greatest(F.abs(F.col("c0") - cx), F.abs(right - cx)).cast("long")) + square(F.greatest(F.abs(F.col("r0") - cy), F.abs(bottom - cy)).cast("long"))
    gap = lambda low, high, c: F.greatest(F.lit(0), low - c, c - high).cast("long")
    nearest = square(gap(F.col("c0"), right, cx)) + square(gap(F.col("r0"), bottom, cy))
    reach = square(F.col("r").cast("long"))
    whole, none = (widest <= reach) & (right < F.col("width")) & (bottom < F.col("height")), nearest > reach
    x = F.when(~(whole | none), F.col("c0"))
    inside = F.coalesce(disk_pixels(x, F.col("r0"), side, side, F.col("cx"), F.col("cy"), F.col("r"), F.col("width"), F.col("height")), F.when(whole, patch * patch).when(none, 0))
    half = patch // 2
    center = (F.col("c0") + half - F.col("cx")) * (F.col("c0") + half - F.col("cx")) + (F.col("r0") + half - F.col("cy")) * (F.col("r0") + half - F.col("cy")) <= F.col("r") * F.col("r")
    near = tiles.where(center) if require_center else tiles
    return near.withColumn("fov_fraction", inside / F.lit(float(patch * patch))).where(F.col("fov_fraction") >= min_fraction)


def number(tiles: DataFrame, key: str = "image_id") -> DataFrame:
    """Row-major running number ``k`` of an image's kept tiles, from 0."""
    return tiles.withColumn("k", (F.row_number().over(Window.partitionBy(key).orderBy("r0", "c0")) - 1).cast("long"))


def tile_name(stem: str = "stem"):
    return F.format_string("%s_%05d_r%d_c%d.png", F.col(stem), F.col("k"), F.col("r0"), F.col("c0"))


def select_sources(files: DataFrame, microscope: str | None = None, parasite: str | None = None) -> DataFrame:
    """Files named ``microscope__parasite__...`` that fit the filters, before any content is touched."""
    from slidemill.functions.scalars import stem

    parts = F.split(stem(F.col("file_name")), "__")
    out = files.withColumns({"parts": parts}).where(F.size("parts") >= 2).withColumns({"microscope": F.get("parts", F.lit(0)), "parasite": F.get("parts", F.lit(1))}).drop("parts")
    for column, wanted in (("microscope", microscope), ("parasite", parasite)):
        if wanted:
            out = out.where(F.lower(column) == wanted.lower())
    return out
