"""Images with many boxes: suppression and matching in tiles, each settled as far as its own boxes tell.

A tile holds all boxes that touch it and settles, in their order, those that no box outside it can change; the others stay open and meet again in tiles
shifted by half a side, then in larger ones. Only boxes near an edge stay open, so little is left after a few rounds. No pairs are stored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PLACE = ["x", "y", "w", "h"]
PAIR = ["file_name", "ord", "saved_ord", "v", "cx", "cy", *PLACE]
#: About the boxes of an image in the first span of its order that is settled before the rest; each further span has sixteen times as many.
SPAN = 1 << 13


def extent() -> list[Column]:
    """Of an image its boxes, the sums of their sides and areas, and the area that their corners span."""
    return [
        F.count(F.lit(1)).alias("n"), F.sum("w").alias("ws"), F.sum("h").alias("hs"), F.sum(F.col("w").cast("double") * F.col("h")).alias("wh"),
        ((F.max("x") - F.min("x")).cast("double") * (F.max("y") - F.min("y"))).alias("spread"),
    ]


def tile_side(extents: DataFrame, least: int, most: int, boxes: int) -> int:
    """A tile that holds about so many boxes, with ``least`` to ``most`` mean sides of a box (so boxes lie in few tiles, whatever their sizes)."""
    s = extents.agg(F.sum("n"), F.sum("ws"), F.sum("hs"), F.sum("wh"), F.sum("spread")).first()
    if not s[0]:
        return 1
    mean = max(float(s[1]) / s[0], float(s[2]) / s[0], math.sqrt(s[3] / s[0]), 1.0)
    return math.ceil(min(max(math.sqrt(boxes * s[4] / s[0]), least * mean), most * mean))


def grid(side: int, turn: int) -> tuple[int, int, int]:
    """Side and shifts of a round's tiles: each round's are twice as wide, with edges where no earlier round had any."""
    side <<= turn
    return side, int(side * (turn * 0.618 % 1)), int(side * (turn * 0.382 % 1))


def _tile(c: Column, side: int, shift: int) -> Column:
    return F.floor((c + shift) / side).cast("long")


def in_tiles(boxes: DataFrame, key: str, side: int, sx: int, sy: int) -> DataFrame:
    """A row for every tile that a box touches, with the number of these tiles as ``_n``."""
    span = lambda p, s, d: F.sequence(_tile(F.col(p), side, d), _tile(F.col(p) + F.col(s), side, d))
    g = boxes.withColumns({"_tx": span("x", "w", sx), "_ty": span("y", "h", sy)}).withColumn("_n", F.size("_tx") * F.size("_ty"))
    return _keyed(g.withColumn("_tx", F.explode("_tx")).withColumn("_ty", F.explode("_ty")), key)


def at_middles(rows: DataFrame, key: str, side: int, sx: int, sy: int) -> DataFrame:
    """Each row in the tile of its ``cx, cy``."""
    return _keyed(rows.withColumns({"_tx": _tile(F.col("cx"), side, sx), "_ty": _tile(F.col("cy"), side, sy)}), key)


def _keyed(rows: DataFrame, key: str) -> DataFrame:
    """Rows dealt out by tile; ``_t`` sorts faster than the columns that it stands for. (Spark would join small parts, but a few boxes can be long work.)"""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.withColumn("_t", F.xxhash64(key, "_tx", "_ty")).repartition(parts, "_t")


def in_each(rows: DataFrame, key: str, settle, schema: str) -> DataFrame:
    return rows.groupBy("_t", key, "_tx", "_ty").applyInArrow(settle, schema)


def _numbers(rows: pa.Table, columns: list[str]) -> list[np.ndarray]:
    return [a if (a := rows[c].to_numpy()).dtype != object else a.astype(float) for c in columns]


def tops(rank: Column) -> Column:
    """Bounds that part the order of an image into growing spans: of the best boxes of four thin selections by hash the third.

    They need no sort, and lie near a place in the order, not at it; where does not matter to the result. What a span keeps drops most of the next,
    longer one at once.
    """
    best = lambda s, i: F.min(F.when(F.pmod(F.xxhash64("image_id", "ord"), F.lit(s)) == i, rank))
    bound = lambda s: F.when(F.count(F.lit(1)) >= 2 * s, F.get(F.array_sort(F.array(*(best(s, i) for i in range(4)))), F.lit(2)))
    return F.filter(F.array(*(bound(SPAN << 4 * k) for k in range(4))), lambda t: t.isNotNull())


def drop_close(num: int, den: int, names: list[str]):
    """A tile's boxes in their order: rows of those kept for good (``_keep``) and of those left open; a dropped box has no row.

    Boxes kept before come with ``_keep`` and have no row again; ``names`` are the columns of the rows.
    """

    def close(a, b):
        side = lambda p, q: np.maximum(np.minimum(a[q], b[q]) - np.maximum(a[p], b[p]), 0)
        inter = side(0, 2) * side(1, 3)
        return den * inter > num * (a[4] + b[4] - inter)

    def box(rows: pa.Table) -> np.ndarray:
        x, y, w, h = _numbers(rows, PLACE)
        return np.stack([x, y, x + w, y + h, w * h])

    def settle(rows: pa.Table) -> pa.Table:
        fixed = rows["_keep"]
        kept, rest = rows.filter(fixed), rows.filter(pc.invert(fixed)).select(names)
        b, kept = box(rest), box(kept)
        if kept.shape[1] and b.shape[1]:
            block, gone = max(1, (1 << 16) // kept.shape[1]), np.zeros(b.shape[1], bool)
            for i in range(0, b.shape[1], block):
                gone[i : i + block] = close(b[:, i : i + block, None], kept[:, None, :]).any(axis=1)
            rest, b = rest.filter(pa.array(~gone)), b[:, ~gone]
        order = pc.sort_indices(rest, [("_c", "ascending"), ("ord", "ascending")]).to_numpy()
        b, inner, n = np.ascontiguousarray(b[:, order]), (rest["_n"].to_numpy() == 1)[order], len(order)
        gone, waits, keep = np.zeros(n, bool), np.zeros(n, bool), np.zeros(n, bool)
        for i in range(n):
            if not gone[i]:
                keep[i] = inner[i] and not waits[i]
                (gone if keep[i] else waits)[i + 1 :] |= close(b[:, i], b[:, i + 1 :])
        return rest.take(order[~gone]).append_column("_keep", pa.array(keep[~gone]))

    return settle


def find_fits(working, saved, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of a tile whose overlap exceeds ``least`` (a half or more), ``(working, saved, iou)``: the middle of the one lies in the other then.

    Working boxes are taken by strips and, in these, block by block from top to bottom, each with the saved boxes that reach it.
    """
    (x, y, w, h), (u, v, p, q) = working, saved
    cx, cy, n = x + w / 2, y + h / 2, len(x)
    found: list[list[np.ndarray]] = [[], [], []]
    if n and len(u):
        strips = max(1, int(math.sqrt(n / 64)))
        strip = np.minimum(((cx - cx.min()) * strips / max(np.ptp(cx), 1e-9)).astype(int), strips - 1)
        order = np.lexsort((cy, strip))
        for s in np.split(order, np.searchsorted(strip[order], np.arange(1, strips))):
            if not len(s):
                continue
            near = np.flatnonzero((u < cx[s].max()) & (u + p > cx[s].min()))
            top, foot = v[near], v[near] + q[near]
            for at in range(0, len(s), 64):
                a = s[at : at + 64]
                b = near[(top < cy[a[-1]]) & (foot > cy[a[0]])]
                inter = np.maximum(np.minimum((x + w)[a, None], (u + p)[b]) - np.maximum(x[a, None], u[b]), 0) * np.maximum(np.minimum((y + h)[a, None], (v + q)[b]) - np.maximum(y[a, None], v[b]), 0)
                i, j = np.nonzero(inter > 0.4 * (w * h)[a, None])
                both = inter[i, j]
                iou = both / ((w * h)[a[i]] + (p * q)[b[j]] - both)
                ok = iou > least
                for out, part in zip(found, (a[i[ok]], b[j[ok]], iou[ok]), strict=True):
                    out.append(part)
    a, b, iou = (np.concatenate(f) if f else np.zeros(0, t) for f, t in zip(found, (np.int64, np.int64, float), strict=True))
    return a, b, iou


def find_and_take(least: float, side: int, sx: int, sy: int):
    """The first round of a matching: a tile's working boxes (middle in the tile) and all saved boxes that touch it, see ``take_turns``."""

    take = take_turns(side, sx, sy)

    def settle(rows: pa.Table) -> pa.Table:
        saved = rows["_saved"]
        w, s = rows.filter(pc.invert(saved)), rows.filter(saved)
        a, b = _numbers(w, PLACE), _numbers(s, PLACE)
        i, j, v = find_fits(a, b, least)
        places = {"cx": (a[0] + a[2] / 2)[i], "cy": (a[1] + a[3] / 2)[i], **{c: q[j].astype(float) for c, q in zip(PLACE, b, strict=True)}}
        return take(pa.table({"file_name": w["file_name"].take(i), "ord": w["ord"].take(i), "saved_ord": s["ord"].take(j), "v": v, **places}))

    return settle


def take_turns(side: int, sx: int, sy: int):
    """The pairs of a tile's working boxes: matches for good (``_done``), and the pairs that stay open.

    In their order, best first, working boxes take saved ones. A saved box across the tile's edge may go to a box outside, one that
    an open box may take is not sure either: who meets such a box stays open, and takes the first sure one at the latest, so no more of its pairs are kept.
    """

    def settle(pairs: pa.Table) -> pa.Table:
        pairs = pairs.take(pc.sort_indices(pairs, [("ord", "ascending"), ("v", "descending"), ("saved_ord", "ascending")]))
        x, y, w, h = _numbers(pairs, PLACE)
        crosses = (np.floor((x + sx) / side) != np.floor((x + w + sx) / side)) | (np.floor((y + sy) / side) != np.floor((y + h + sy) / side))
        taken, unsure, rows, done = set(), set(), [], []
        last, settled, sure = None, False, True
        for i, (o, s, across) in enumerate(zip(pairs["ord"].to_numpy().tolist(), pairs["saved_ord"].to_numpy().tolist(), crosses.tolist(), strict=True)):
            if o != last:
                last, settled, sure = o, False, True
            if settled or s in taken:
                continue
            if across or s in unsure:
                sure = False
            else:
                settled = True
                (taken if sure else unsure).add(s)
            rows.append(i)
            done.append(settled and sure)
        return pairs.select(PAIR).take(pa.array(rows, pa.int64())).append_column("_done", pa.array(done, pa.bool_()))

    return settle
