"""Box algebra: limits, padding, field of view, IoU pairs, non-maximum suppression."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slidemill.functions.scalars import columns, fields, iou, whole
from slidemill.operators import crowds
from slidemill.plans.lineage import cut, few


def area_band(fov_area: Column, min_frac: float = 0.0003, max_frac: float = 0.20) -> tuple[Column, Column]:
    return whole(fov_area * min_frac), whole(fov_area * max_frac)


def filter_and_pad(boxes: DataFrame, low: Column, high: Column) -> DataFrame:
    """Boxes of an ``area`` inside the band and sides at most 8 to 1, padded by a tenth (5 at least); x and y stop at 0."""
    sides = F.greatest("w", "h") / (F.least("w", "h") + 1e-6)
    px, py = (F.greatest(F.lit(5), whole(F.col(s) * 0.1)) for s in ("w", "h"))
    return (
        boxes.where(F.col("area").between(low, high) & (sides <= 8))
        .withColumns({"_px": px, "_py": py})
        .withColumns({"x": F.greatest(F.lit(0), F.col("x") - F.col("_px")), "y": F.greatest(F.lit(0), F.col("y") - F.col("_py")), "w": F.col("w") + 2 * F.col("_px"), "h": F.col("h") + 2 * F.col("_py")})
        .drop("_px", "_py")
    )


def edge_margin(radius: Column, least: int = 10) -> Column:
    return F.greatest(F.lit(least), whole(radius * 0.06))


def shrunk_radius(radius: Column, least: int = 10) -> Column:
    """The radius less the margin where it exceeds twice the margin."""
    m = edge_margin(radius, least)
    return F.when(radius > 2 * m, radius - m).otherwise(radius)


def count_in_disk(x, y, w, h, cx, cy, r, width, height, rows: int = 1 << 20):
    """Pixels of rectangles (far edges included, cut at the image) in disks: chords of all their rows at once, in blocks."""
    top = np.maximum(np.maximum(y, np.ceil(cy - r)), 0).astype(np.int64)
    bottom = np.minimum(np.minimum(y + h, np.floor(cy + r)), height - 1).astype(np.int64)
    n = np.maximum(bottom - top + 1, 0)
    out, ends = np.zeros(len(n), np.int64), np.cumsum(n)
    at = 0
    while at < len(n):
        end = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + rows, side="right")))
        k = np.repeat(np.arange(at, end), n[at:end])
        if len(k):
            v = np.arange(len(k)) - np.repeat(np.cumsum(n[at:end]) - n[at:end], n[at:end]) + top[k]
            chord = np.sqrt(np.maximum(r[k] * r[k] - (v - cy[k]) ** 2, 0).astype(float))
            last = np.minimum(np.minimum(np.floor(cx[k] + chord), x[k] + w[k]), width[k] - 1)
            first = np.maximum(np.maximum(np.ceil(cx[k] - chord), x[k]), 0)
            out[at:end] = np.bincount(k - at, np.maximum(last - first + 1, 0), end - at).astype(np.int64)
        at = end
    return out


def disk_pixels(x: Column, y: Column, w: Column, h: Column, cx: Column, cy: Column, r: Column, width: Column, height: Column) -> Column:
    """Pixels of a rectangle that lie in a disk, null where any part is null."""

    @F.pandas_udf("bigint")
    def pixels(x: pd.Series, y: pd.Series, w: pd.Series, h: pd.Series, cx: pd.Series, cy: pd.Series, r: pd.Series, width: pd.Series, height: pd.Series) -> pd.Series:
        given = pd.concat([x, y, w, h, cx, cy, r, width, height], axis=1)
        ok = given.notna().all(axis=1).to_numpy()
        out = pd.Series(pd.array([None] * len(given), dtype="Int64"))
        if ok.any():
            out[ok] = count_in_disk(*(given.iloc[ok, i].to_numpy(float) for i in range(9)))
        return out

    return pixels(x, y, w, h, cx, cy, r, width, height)


def inside_fov(boxes: DataFrame, least: float = 0.85, side_radius: str = "r") -> DataFrame:
    """Boxes (with ``cx, cy, r, width, height``) over ``least`` of whose area is in the disk, at most 1.5 of ``side_radius`` a side."""
    part = disk_pixels(*(F.col(c) for c in ("x", "y", "w", "h", "cx", "cy", "r", "width", "height"))) / (F.col("w") * F.col("h"))
    fits = (F.col("w") <= 1.5 * F.col(side_radius)) & (F.col("h") <= 1.5 * F.col(side_radius)) & (F.col("w") * F.col("h") > 0)
    return boxes.where(F.col("r").isNull() | (fits & (part > least)))


def _in_cells(boxes: DataFrame, key: str, cell: int, mark: str) -> DataFrame:
    """A row for every grid cell that a box touches: key, cell, and its columns under the prefix ``mark``."""
    far = lambda p, s: F.floor((F.col(p) + F.col(s) - 1) / cell).cast("int")
    near = lambda p: F.floor(F.col(p) / cell).cast("int")
    g = boxes.withColumn("gx", F.explode(F.sequence(near("x"), F.greatest(near("x"), far("x", "w"))))).withColumn("gy", F.explode(F.sequence(near("y"), F.greatest(near("y"), far("y", "h")))))
    return g.select(key, "gx", "gy", *(F.col(c).alias(f"{mark}_{c}") for c in boxes.columns if c != key))


def touching(a: DataFrame, b: DataFrame, key: str, cell: int) -> DataFrame:
    """Pairs of ``a`` and ``b`` of one ``key`` that meet in a grid cell, once: in that of their intersection's first corner.

    All columns, with prefixes ``a_`` and ``b_``. A crowded key is so spread over its cells.
    """
    own = (F.floor(F.greatest("a_x", "b_x") / cell) == F.col("gx")) & (F.floor(F.greatest("a_y", "b_y") / cell) == F.col("gy"))
    return _in_cells(a, key, cell, "a").join(_in_cells(b, key, cell, "b"), [key, "gx", "gy"]).where(own).drop("gx", "gy")


def iou_pairs(boxes: DataFrame, cell: int = 128) -> DataFrame:
    """Overlapping pairs of an image, ``(image_id, a, b, iou)`` with a < b by ``ord``, found in grid cells."""
    g = boxes.select("image_id", "ord", *columns().values())
    met = touching(g, g, "image_id", cell).where("a_ord < b_ord").withColumn("iou", iou(columns("a_"), columns("b_")))
    return met.where("iou > 0").select("image_id", F.col("a_ord").alias("a"), F.col("b_ord").alias("b"), "iou")


def split_crowded(frames: list[DataFrame], key: str, crowd: int) -> tuple[list[DataFrame], list[DataFrame], bool]:
    """The rows of keys with at most ``crowd`` rows in every frame, the rows of the other keys, and whether there are such."""
    sizes = [f.groupBy(key).agg(F.count(F.lit(1)).alias("n")) for f in frames]
    sizes = cut(reduce(DataFrame.unionByName, sizes).groupBy(key).agg(F.max("n").alias("n")))
    many = (F.col("n") > crowd) & F.col(key).isNotNull()
    crowded = few(sizes.where(many).select(key))
    if not crowded.limit(1).count():
        return frames, frames, False
    if not sizes.where(~many).limit(1).count():
        return [f.limit(0) for f in frames], frames, True
    return [f.join(crowded, key, "left_anti") for f in frames], [f.join(crowded, key, "left_semi") for f in frames], True


def nms(boxes: DataFrame, num: int = 3, den: int = 10, crowd: int = 64, cell: int = 128) -> DataFrame:
    """Greedy suppression in each image: by falling confidence, then ``ord``, dropping what overlaps a kept box more than num/den.

    ``ord`` tells the boxes of an image apart. The threshold is compared in integers. A suppressed box never suppresses, so keeping a box exactly if no kept one
    overlaps it too much is the same as the loop over all pairs. Images of at most ``crowd`` boxes are folded each in its row; a
    crowded one is settled in rounds over its overlapping pairs, so it is no single task. Both give the same rows: the kept ones.
    """
    (small,), (large,), some = split_crowded([boxes], "image_id", crowd)
    folded = _nms_fold(small, num, den)
    return folded.unionByName(_nms_rounds(large, num, den, cell).select(folded.columns)) if some else folded


def _nms_fold(boxes: DataFrame, num: int, den: int) -> DataFrame:
    keep = [c for c in boxes.columns if c not in ("image_id",)]
    item = F.struct((-F.col("confidence")).alias("_c"), F.col("ord").alias("_o"), *keep)
    area = lambda s: s["w"] * s["h"]

    def too_close(q: Column, b: Column) -> Column:
        side = lambda p, s: F.greatest(F.lit(0), F.least(q[p] + q[s], b[p] + b[s]) - F.greatest(q[p], b[p]))
        inter = side("x", "w") * side("y", "h")
        return den * inter > num * (area(q) + area(b) - inter)

    folded = F.aggregate("_all", F.slice("_all", 1, 0), lambda k, b: F.when(F.exists(k, lambda q: too_close(q, b)), k).otherwise(F.concat(k, F.array(b))))
    grouped = boxes.groupBy("image_id").agg(F.array_sort(F.collect_list(item)).alias("_all"))
    return grouped.select("image_id", F.explode(folded).alias("b")).select("image_id", *(F.col(f"b.{c}") for c in keep))


def _nms_rounds(boxes: DataFrame, num: int, den: int, cell: int, rounds: int = 24) -> DataFrame:
    """Suppression in tiles (see ``crowds``), for the best boxes of an image first and then for longer and longer spans of its order.

    A box is kept once a tile holds it whole and no open better box there overlaps it too much; kept boxes drop their neighbours.
    What is open after ``rounds`` rounds (a chain of boxes that wait for one another across many tiles) is settled image by image, along its
    pairs, each looked at once.
    """
    boxes = cut(boxes)
    solid = F.coalesce(reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in "xywh")) & (F.col("w") > 0) & (F.col("h") > 0), F.lit(False))
    places, rank = ["image_id", "ord", *crowds.PLACE, "_c"], F.struct("_c", "ord")
    g = boxes.where(solid).withColumn("_c", F.coalesce(-F.col("confidence").cast("double"), F.lit(float("-inf")))).select(places)
    images = few(g.groupBy("image_id").agg(*crowds.extent(), crowds.tops(rank).alias("_tops")))
    side, last = crowds.tile_side(images, 8, 32, 1000), images.agg(F.max(F.size("_tops"))).first()[0] or 0
    spanned = g.join(images.select("image_id", "_tops"), "image_id").withColumn("_span", F.coalesce(F.size(F.filter("_tops", lambda t: t < rank)), F.lit(0)))
    schema, kept = f"{g.schema.simpleString()[7:-1]},_n:int,_keep:boolean", g.limit(0)
    settle = crowds.drop_close(num, den, [*places, "_n"])
    for span in range(max(last, 0) + 1):
        todo = spanned.where(F.col("_span") == span).select(places).withColumn("_keep", F.lit(False)).unionByName(kept.withColumn("_keep", F.lit(True)))
        for turn in range(rounds):
            out = cut(crowds.in_each(crowds.in_tiles(todo, "image_id", *crowds.grid(side, turn)), "image_id", settle, schema))
            kept = kept.unionByName(out.where("_keep").select(places))
            todo = out.where("not _keep").groupBy(places).agg(F.count(F.lit(1)).alias("tiles"), F.first("_n").alias("_n")).where("tiles = _n")  # dropped in none of its tiles
            todo = cut(todo.select(*places, F.lit(False).alias("_keep")))
            if not todo.limit(1).count():
                break
        else:
            kept = kept.unionByName(_nms_pairs(todo.select(places), num, den, cell))
    return boxes.where(~solid).unionByName(boxes.where(solid).join(kept.select("image_id", "ord"), ["image_id", "ord"], "left_semi").select(boxes.columns))


def _nms_pairs(boxes: DataFrame, num: int, den: int, cell: int) -> DataFrame:
    """The kept ones of a few boxes (with ``_c``, their order), image by image along their pairs."""
    g = boxes.withColumn("_rank", F.struct("_c", "ord"))
    side = lambda p, s: F.greatest(F.lit(0), F.least(F.col(f"a_{p}") + F.col(f"a_{s}"), F.col(f"b_{p}") + F.col(f"b_{s}")) - F.greatest(f"a_{p}", f"b_{p}"))
    inter = side("x", "w") * side("y", "h")
    close = den * F.col("i") > num * (F.col("a_w") * F.col("a_h") + F.col("b_w") * F.col("b_h") - F.col("i"))
    pairs = touching(g, g, "image_id", cell).where("a__rank < b__rank").withColumn("i", inter).where(close)
    ranked = pairs.select("image_id", F.col("b__rank").alias("r"), F.col("a_ord").alias("better"), F.col("b_ord").alias("worse"))
    rest = ranked.repartition("image_id").sortWithinPartitions("image_id", "r").select("image_id", "better", "worse")
    drop = rest.mapInPandas(_along_pairs, "image_id " + boxes.schema["image_id"].dataType.simpleString() + ", ord " + boxes.schema["ord"].dataType.simpleString())
    return cut(boxes.join(drop, ["image_id", "ord"], "left_anti").select(boxes.columns))


def _along_pairs(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Dropped boxes of pairs that come image by image, in the order of their worse box."""
    image, dropped = None, set()
    for frame in frames:
        out = []
        for i, better, worse in zip(frame.image_id, frame.better, frame.worse, strict=True):
            if i != image:
                image, dropped = i, set()
            if better not in dropped and worse not in dropped:
                dropped.add(worse)
                out.append((i, worse))
        yield pd.DataFrame(out, columns=["image_id", "ord"])


def best_iou_match(working: DataFrame, saved: DataFrame, least: float = 0.5, crowd: int = 64, cell: int = 128) -> DataFrame:
    """Greedy matching in each file: every working box, in order, takes the unused saved box of strictly largest IoU.

    ``working`` and ``saved`` have ``file_name, ord, x, y, w, h``. Returns ``file_name, ord, saved_ord`` of accepted
    matches (IoU above ``least``); the first saved box wins ties. Files of at most ``crowd`` boxes on either side are folded each in
    its row, crowded ones are matched in rounds over pairs from grid cells; both give the same rows.
    """
    sides = [d.select("file_name", "ord", "x", "y", "w", "h") for d in (working, saved)]
    small, large, some = split_crowded(sides, "file_name", crowd)
    folded = _match_fold(*small, least)
    return folded.unionByName(_match_rounds(*large, least, cell).select(folded.columns)) if some else folded


def _match_fold(working: DataFrame, saved: DataFrame, least: float) -> DataFrame:
    """Each working box's saved boxes above ``least``, best first; then, in order, the first that is not taken."""
    pack = lambda df, name: df.groupBy("file_name").agg(F.array_sort(F.collect_list(F.struct("ord", "x", "y", "w", "h"))).alias(name))
    both = pack(working, "ws").join(pack(saved, "ss"), "file_name")
    # pairs are scored and sorted once, all in one row of at most a crowd
    scored = lambda b: F.filter(F.transform("ss", lambda s: F.struct((-iou(fields(b), fields(s))).alias("v"), s["ord"].cast("long").alias("o"))), lambda t: t["v"] < -least)
    wants = F.filter(F.transform("ws", lambda b: F.struct(b["ord"].cast("long").alias("ord"), F.array_sort(scored(b)).alias("fits"))), lambda w: F.size(w["fits"]) > 0)
    both = both.select("file_name", wants.alias("wants")).where(F.size("wants") > 0)
    start = F.array().cast("array<struct<ord:bigint,saved_ord:bigint>>")
    free = lambda found, w: F.get(F.filter(w["fits"], lambda t: ~F.exists(found, lambda f: f["saved_ord"] == t["o"])), F.lit(0))["o"]

    def step(found: Column, w: Column) -> Column:
        take = lambda o: F.when(o.isNull(), found).otherwise(F.concat(found, F.array(F.struct(w["ord"].alias("ord"), o.alias("saved_ord")))))
        return F.get(F.transform(F.array(free(found, w)), take), F.lit(0))

    return both.select("file_name", F.explode(F.aggregate("wants", start, step)).alias("m")).select("file_name", "m.ord", "m.saved_ord")


def _match_rounds(working: DataFrame, saved: DataFrame, least: float, cell: int, rounds: int = 24) -> DataFrame:
    """Matching in tiles (see ``crowds``): a working box takes its best saved box once no earlier one still open could take it.

    Files with pairs left after ``rounds`` rounds are settled along their pairs, each looked at once. Where boxes may overlap by less than a half,
    pairs are found in grid cells and settled in rounds without tiles.
    """
    if least < 0.5:
        return _match_pairs(working, saved, least, cell, rounds)
    w, s = (d.where("w > 0 and h > 0 and x is not null and y is not null").withColumn("ord", F.col("ord").cast("long")) for d in (working, saved))
    side = crowds.tile_side(w.groupBy("file_name").agg(*crowds.extent()), 16, 32, 20_000)
    grid = crowds.grid(side, 0)
    saved_ones = crowds.in_tiles(s.withColumn("_saved", F.lit(True)), "file_name", *grid).drop("_n")
    middles = w.withColumns({"_saved": F.lit(False), "cx": F.col("x") + F.col("w") / 2, "cy": F.col("y") + F.col("h") / 2})
    middles = crowds.at_middles(middles, "file_name", *grid).drop("cx", "cy")
    schema = "file_name string, ord bigint, saved_ord bigint, v double, cx double, cy double, x double, y double, w double, h double, _done boolean"
    out = cut(crowds.in_each(middles.unionByName(saved_ones), "file_name", crowds.find_and_take(least, *grid), schema))
    found = out.where("_done").select("file_name", "ord", "saved_ord")
    for turn in range(1, rounds):
        pairs = out.where("not _done")
        if not pairs.limit(1).count():
            return found
        grid = crowds.grid(side, turn)
        out = cut(crowds.in_each(crowds.at_middles(pairs, "file_name", *grid), "file_name", crowds.take_turns(*grid), schema))
        found = found.unionByName(out.where("_done").select("file_name", "ord", "saved_ord"))
    return found.unionByName(_one_by_one(out.where("not _done")))


def _one_by_one(pairs: DataFrame) -> DataFrame:
    rest = pairs.repartition("file_name").sortWithinPartitions("file_name", "ord", F.desc("v"), "saved_ord").select("file_name", "ord", "saved_ord")
    return rest.mapInPandas(_in_turn, "file_name string, ord bigint, saved_ord bigint")


def _match_pairs(working: DataFrame, saved: DataFrame, least: float, cell: int, rounds: int) -> DataFrame:
    """Matching over stored pairs above ``least``: who takes its best saved box leaves all pairs with it, round by round."""
    met = touching(working, saved, "file_name", cell).withColumn("v", iou(columns("a_"), columns("b_"))).where(F.col("v") > least)
    pairs = cut(met.select("file_name", F.col("a_ord").cast("long").alias("ord"), F.col("b_ord").cast("long").alias("saved_ord"), "v"))
    found = pairs.select("file_name", "ord", "saved_ord").limit(0)
    for _ in range(rounds):
        if not pairs.limit(1).count():
            return found
        best = pairs.groupBy("file_name", "ord").agg(F.min(F.struct((-F.col("v")).alias("v"), F.col("saved_ord").alias("s")))["s"].alias("saved_ord"))
        first = pairs.groupBy("file_name", "saved_ord").agg(F.min("ord").alias("ord"))
        take = cut(best.join(first, ["file_name", "ord", "saved_ord"]).select("file_name", "ord", "saved_ord"))
        found = found.unionByName(take)
        for end in ("ord", "saved_ord"):
            pairs = pairs.join(take.select("file_name", end), ["file_name", end], "left_anti")
        pairs = cut(pairs)
    return found.unionByName(_one_by_one(pairs))


def _in_turn(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Matches of pairs that come file by file, in the order of the working boxes, best first."""
    file, taken, last = None, set(), None
    for frame in frames:
        out = []
        for f, o, s in zip(frame.file_name, frame.ord, frame.saved_ord, strict=True):
            if f != file:
                file, taken, last = f, set(), None
            if o != last and s not in taken:
                taken.add(s)
                last = o
                out.append((f, o, s))
        yield pd.DataFrame(out, columns=["file_name", "ord", "saved_ord"])
