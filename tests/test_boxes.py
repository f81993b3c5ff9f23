import random

import pytest
from pyspark.sql import functions as F

from slidemill.operators import boxes as B

COLS = "image_id long, ord long, x long, y long, w long, h long, confidence double"


def iou(a, b):
    w = min(a[0] + a[2], b[0] + b[2]) - max(a[0], b[0])
    h = min(a[1] + a[3], b[1] + b[3]) - max(a[1], b[1])
    if w <= 0 or h <= 0:
        return 0.0
    return w * h / (a[2] * a[3] + b[2] * b[3] - w * h)


def some(n=120, seed=3):
    r = random.Random(seed)
    return [(i % 4, i, r.randrange(300), r.randrange(300), r.randrange(10, 90), r.randrange(10, 90), r.choice([0.4, 0.5, 0.7])) for i in range(n)]


def greedy(rows):
    want = set()
    for image in {r[0] for r in rows}:
        kept = []
        for b in sorted((r for r in rows if r[0] == image), key=lambda r: (-r[6], r[1])):
            if all(iou(b[2:6], k[2:6]) <= 0.3 for k in kept):
                kept.append(b)
        want |= {(k[0], k[1]) for k in kept}
    return want


@pytest.mark.parametrize("crowd", [0, 20, 64])
def test_nms_equals_the_loop(spark, crowd):
    rows = some() + [(9, i, 5 * i, 0, 60, 40, 0.5) for i in range(15)] + [(8, i, 10, 10, 20, 20, 0.1 * (i % 3)) for i in range(9)] + [(8, 20, 10, 10, 0, 5, 0.9), (8, 21, 10, 10, 0, 5, 0.9)]
    got = [(r.image_id, r.ord) for r in B.nms(spark.createDataFrame(rows, COLS), crowd=crowd).collect()]
    assert len(got) == len(set(got)) and set(got) == greedy(rows)


def test_a_chain_longer_than_the_rounds(spark):
    rows = [(11, i, 5 * i, 0, 10, 10, 0.9 - i / 1000) for i in range(120)] + some(60)
    got = {(r.image_id, r.ord) for r in B._nms_rounds(spark.createDataFrame(rows, COLS), 3, 10, 50, rounds=2).collect()}
    assert got == greedy(rows)


def test_a_crowded_image_is_no_single_task(spark):
    r = random.Random(8)
    rows = [(1, i, r.randrange(3000), r.randrange(3000), r.randrange(10, 60), r.randrange(10, 60), r.random()) for i in range(4000)]
    df = B._nms_rounds(spark.createDataFrame(rows, COLS), 3, 10, 128)
    assert {(x.image_id, x.ord) for x in df.collect()} == greedy(rows)


def test_touching_and_equal_to_threshold_are_kept(spark):
    touching = [(1, 1, 0, 0, 10, 10, 0.5), (1, 2, 10, 0, 10, 10, 0.5)]
    # 3 of 10 parts in common: intersection 60, union 200
    equal = [(2, 1, 0, 0, 13, 10, 0.5), (2, 2, 7, 0, 13, 10, 0.5)]
    assert B.nms(spark.createDataFrame(touching + equal, COLS)).count() == 4


def test_iou_pairs_equal_all_pairs(spark):
    rows = some()
    got = {(r.image_id, r.a, r.b): round(r.iou, 9) for r in B.iou_pairs(spark.createDataFrame(rows, COLS), cell=50).collect()}
    want = {(a[0], a[1], b[1]): round(iou(a[2:6], b[2:6]), 9) for a in rows for b in rows if a[0] == b[0] and a[1] < b[1] and iou(a[2:6], b[2:6]) > 0}
    assert got == want


def greedy_match(working, saved):
    want = set()
    for name in {w[0] for w in working}:
        used = set()
        for w in sorted(x for x in working if x[0] == name):
            best, at = 0.0, -1
            for s in sorted(x for x in saved if x[0] == name):
                if s[1] not in used and iou(w[2:], s[2:]) > best:
                    best, at = iou(w[2:], s[2:]), s[1]
            if best > 0.5:
                used.add(at)
                want.add((name, w[1], at))
    return want


@pytest.mark.parametrize(("crowd", "rounds"), [(64, 24), (0, 24), (0, 1)])
def test_greedy_match_equals_the_loop(spark, crowd, rounds, monkeypatch):
    monkeypatch.setattr(B._match_rounds, "__defaults__", (rounds,))
    r = random.Random(5)
    box = lambda: [r.randrange(30), r.randrange(30), r.randrange(20, 60), r.randrange(20, 60)]
    working = [(f, i, *box()) for f in "fgh" for i in range(45)] + [("only working", 1, 0, 0, 5, 5)]
    saved = [(f, i, *box()) for f in "fgh" for i in range(40)] + [("only saved", 1, 0, 0, 5, 5)]
    saved += [("f", 100 + i, *working[i][2:]) for i in range(5)] * 1
    cols = "file_name string, ord long, x long, y long, w long, h long"
    got = {tuple(x) for x in B.best_iou_match(spark.createDataFrame(working, cols), spark.createDataFrame(saved, cols), crowd=crowd).collect()}
    assert got == greedy_match(working, saved) and len(got) > 20


@pytest.mark.parametrize("rounds", [24, 2, 1])
def test_a_crowded_file_is_matched_in_tiles_without_stored_pairs(spark, monkeypatch, rounds):
    monkeypatch.setattr(B, "touching", None)
    monkeypatch.setattr(B.crowds, "tile_side", lambda *_: 90)
    r = random.Random(6)
    box = lambda: [r.randrange(-50, 400), r.randrange(-50, 400), r.randrange(20, 50), r.randrange(20, 50)]
    working = [(f, i, *box()) for f in "gh" for i in range(900)] + [("h", 1000 + i, 3 * i, 500, 20, 20) for i in range(150)]
    saved = [("gh"[i % 2], i, *box()) for i in range(1400)] + [("h", 2000 + i, 3 * i + 2, 500, 20, 20) for i in range(150)] + [("h", 3000, 5, 5, 0, 9), ("h", 3001, None, 5, 7, 9)]
    cols = "file_name string, ord long, x long, y long, w long, h long"
    got = {tuple(x) for x in B._match_rounds(spark.createDataFrame(working, cols), spark.createDataFrame(saved, cols), 0.5, 128, rounds).collect()}
    assert got == greedy_match(working, [s for s in saved if s[2] is not None]) and len(got) > 300


@pytest.mark.parametrize("least", [0.3, 0.7])
def test_other_limits_of_a_match(spark, least):
    r = random.Random(7)
    box = lambda: [r.randrange(60), r.randrange(60), r.randrange(20, 60), r.randrange(20, 60)]
    working, saved = ([("f", i, *box()) for i in range(70)] for _ in range(2))
    cols = "file_name string, ord long, x long, y long, w long, h long"
    both = [spark.createDataFrame(d, cols) for d in (working, saved)]
    few, many = ({tuple(x) for x in B.best_iou_match(*both, least, crowd=c).collect()} for c in (1000, 0))
    assert few == many and few


@pytest.mark.parametrize("rounds", [24, 2])
def test_a_crowded_image_is_settled_in_tiles_without_stored_pairs(spark, monkeypatch, rounds):
    if rounds == 24:
        monkeypatch.setattr(B, "touching", None)
    monkeypatch.setattr(B.crowds, "tile_side", lambda *_: 90)
    monkeypatch.setattr(B.crowds, "SPAN", 32)
    r = random.Random(9)
    rows = [(i % 2, i, r.randrange(-50, 400), r.randrange(-50, 400), r.randrange(10, 60), r.randrange(10, 60), r.choice([0.4, 0.5])) for i in range(4000)]
    rows += [(0, 5000 + i, 6 * i, 600, 10, 10, 0.3 - i / 1000) for i in range(150)] + [(0, 6000, 3, 3, 0, 5, 0.9), (1, 6001, 0, 0, 450, 400, 0.1), (1, 6002, -60, -60, 500, 500, 0.95)]
    got = [(x.image_id, x.ord) for x in B._nms_rounds(spark.createDataFrame(rows, COLS), 3, 10, 128, rounds).collect()]
    assert len(got) == len(set(got)) and set(got) == greedy(rows)
    lost = spark.createDataFrame([(2, 1, None, 1, 2, 3, 0.5)], COLS)
    assert B._nms_rounds(lost, 3, 10, 128).count() == 1


def test_limits_padding_and_aspect(spark):
    rows = [(1, 2, 50, 60, 500.0), (1, 0, 80, 10, 500.0), (1, 0, 81, 10, 500.0), (1, 0, 20, 20, 5.0)]
    df = spark.createDataFrame(rows, "x int, y int, w int, h int, area double")
    out = sorted((r.x, r.y, r.w, r.h) for r in B.filter_and_pad(df, F.lit(10), F.lit(1000)).collect())
    assert out == [(0, 0, 60, 72), (0, 0, 96, 20)]


def test_disk_pixels_by_counting(spark):
    rows = [(x, y, w, h, 40, 35, 30, 90, 80) for x, y, w, h in ((20, 20, 10, 12), (0, 0, 89, 79), (60, 50, 25, 25), (85, 2, 20, 4), (100, 100, 5, 5))]
    names = ("x", "y", "w", "h", "cx", "cy", "r", "width", "height")
    df = spark.createDataFrame(rows, ", ".join(f"{n} int" for n in names)).select("*", B.disk_pixels(*map(F.col, names)).alias("n"))
    for r in df.collect():
        want = sum((c - 40) ** 2 + (v - 35) ** 2 <= 900 for v in range(r.y, min(r.y + r.h, 79) + 1) for c in range(r.x, min(r.x + r.w, 89) + 1))
        assert r.n == want


def test_sides_are_held_against_the_full_radius(spark):
    row = spark.createDataFrame([(430, 430, 140, 140, 500, 500, 90, 100, 1000, 1000)], "x int, y int, w int, h int, cx int, cy int, r int, r_full int, width int, height int")
    assert B.inside_fov(row, 0.5).count() == 0 and B.inside_fov(row, 0.5, side_radius="r_full").count() == 1
