import json

import numpy as np
from pyspark.sql import functions as F

from slidemill.operators import detect, exports, fusion, tiling
from slidemill.operators import kernels as K
from slidemill.sources import files, sinks


def scene(h=160, w=180, shift=0):
    """A bright disc on black with two dark spots."""
    y, x = np.ogrid[:h, :w]
    img = np.zeros((h, w, 3), np.uint8)
    img[(x - w // 2) ** 2 + (y - h // 2) ** 2 <= 70**2] = 200
    for cx, cy in ((70, 70), (110, 95)):
        img[(x - cx - shift) ** 2 + (y - cy) ** 2 <= 49] = (60, 20, 90)
    return img


def test_png_round_trip_and_filters():
    img = np.random.default_rng(0).integers(0, 256, (17, 23, 3)).astype(np.uint8)
    assert (K.decode_png(K.encode_png(img)) == img).all()
    assert (K.decode_png(K.encode_png(img[..., 0])) == img[..., 0]).all()


def test_neighbourhood_kernels_equal_loops():
    rng = np.random.default_rng(1)
    img = rng.random((9, 11))
    p = np.pad(img, 1, mode="reflect")
    lap = np.array([[2 * (p[r, c] + p[r, c + 2] + p[r + 2, c] + p[r + 2, c + 2]) - 8 * p[r + 1, c + 1] for c in range(11)] for r in range(9)])
    assert np.allclose(K.correlate3(img, ((2, 0, 2), (0, -8, 0), (2, 0, 2))), lap)
    q = np.pad(img, 2, mode="reflect")
    assert np.allclose(K.box_mean(img, 5), [[q[r : r + 5, c : c + 5].mean() for c in range(11)] for r in range(9)])
    mask = rng.random((12, 12)) > 0.7
    grown = np.array([[any(0 <= r + a < 12 and 0 <= c + b < 12 and mask[r + a, c + b] for a in (-1, 0, 1) for b in (-1, 0, 1) if K.ellipse(3)[a + 1, b + 1]) for c in range(12)] for r in range(12)])
    assert (K.dilate(mask, K.ellipse(3)) == grown).all()


def test_labels_and_contours():
    mask = np.zeros((10, 12), bool)
    mask[1:4, 1:5] = mask[4, 5] = True
    mask[7:9, 8:11] = True
    names, n = K.label(mask)
    assert n == 2 and names[1, 1] == names[4, 5] != names[7, 8]
    square = np.zeros((6, 6), bool)
    square[1:5, 1:5] = True
    assert K.polygon_area(K.contour(square)) == 9.0
    x, y, r = K.enclosing_circle(np.array([[0, 0], [0, 4], [4, 0], [4, 4], [2, 2]]))
    assert (round(x, 6), round(y, 6), round(r, 6)) == (2, 2, round(8**0.5, 6))


def test_otsu_separates_two_levels():
    g = np.concatenate([np.full(100, 0.1), np.full(50, 0.9)])
    assert 0.1 < K.otsu(g.reshape(10, 15)) < 0.9


def test_detection_end_to_end(spark):
    rows = [("good.png", bytearray(K.encode_png(scene()))), ("bad.png", bytearray(b"nothing"))]
    images, boxes = detect.propose(spark.createDataFrame(rows, "file_name string, content binary"), strict=False)
    heads = {r.file_name: r for r in images.collect()}
    assert heads["bad.png"].error and heads["good.png"].error is None and abs(heads["good.png"].r - 70) <= 2
    found = boxes.collect()
    assert found and all(b.file_name == "good.png" for b in found)
    assert any(b.x <= 70 <= b.x + b.w and b.y <= 70 <= b.y + b.h for b in found)


def test_tiles_lie_in_the_view(spark):
    big = np.kron(scene(), np.ones((3, 3, 1), np.uint8)).astype(np.uint8)
    rows = [("m__p__u.png", bytearray(K.encode_png(big))), ("m__p__small.png", bytearray(K.encode_png(scene(20, 20))))]
    out = tiling.tile_images(spark.createDataFrame(rows, "file_name string, content binary"), 64, 32, 1.0).collect()
    good = [r for r in out if r.error is None]
    assert {r.file_name for r in out if r.error} == {"m__p__small.png"} and good
    assert [r.k for r in good] == list(range(len(good))) and good[0].name == f"m__p__u_00000_r{good[0].r0}_c{good[0].c0}.png"


def test_registration_and_fusion(spark):
    fixed = K.gray_of(scene()).astype(float) / 255
    warp, cc, ok = fusion.register(fusion.prepared(np.roll(fixed, 2, 1), 180, 160), fusion.prepared(fixed, 180, 160), "translation")
    assert ok and cc > 0.99 and abs(warp[0, 2] - 2) < 0.2 and abs(warp[1, 2]) < 0.2
    small = [("s", f"{i}.png", bytearray(K.encode_png(scene(60, 70, i)))) for i in range(2)] + [("lonely", "x.png", bytearray(K.encode_png(scene(30, 30))))]
    rows = fusion.fuse_scene(spark.createDataFrame(small, "scene string, name string, content binary"), iterations=20).collect()
    assert sorted(r.role for r in rows) == ["input", "input", "output"] and {r.scene for r in rows} == {"s"}
    assert abs(sum(r.fusion_weight for r in rows if r.role == "input") - 1) < 1e-9
    out = next(r for r in rows if r.role == "output")
    assert K.decode_png(bytes(out.png)).shape == (120, 140, 3)


def test_documents_of_both_versions(spark, tmp_path):
    two = {"images": [{"id": 1, "file_name": "a.png"}], "annotations": [{"image_id": 1, "bbox": [1, 2, 3, 4], "label": "egg", "status": "approved", "detection_method": "manual"}, {"image_id": 9, "bbox": [0, 0, 1, 1]}]}
    one = {"version": "1.0", "images": {"b.png": {"width": 5, "height": 6, "annotations": [{"bbox": [5, 6, 7, 8], "label": "x", "status": "rejected", "method": "m"}]}}}
    got = []
    for i, doc in enumerate((two, one)):
        (tmp_path / f"{i}.json").write_text(json.dumps(doc))
        got += [(r.file_name, r.x, r.h, r.label, r.status, r.method) for r in files.read_annotations(spark, str(tmp_path / f"{i}.json")).collect()]
    assert got == [("a.png", 1, 4, "egg", "approved", "manual"), ("b.png", 5, 8, "x", "rejected", "m")]
    (tmp_path / "corrupt.json").write_text("{")
    assert [d.count() for d in files.read_proposals(spark, str(tmp_path / "corrupt.json"))] == [0, 0]
    assert [d.count() for d in files.read_proposals(spark, str(tmp_path / "missing.json"))] == [0, 0]


def test_raw_tree_catalogue_csv_and_copies(spark, tmp_path):
    from slidemill.operators import catalog

    for path, body in (("m/p/u/a.png", b"1"), ("m/p/u/deep/b.PNG", b"1"), ("m/q/u/c.webp", b"2"), ("m/short.png", b"3"), ("m/p/u/notes.txt", b"4")):
        f = tmp_path / "data" / "raw" / path
        f.parent.mkdir(parents=True, exist_ok=True)
        f.write_bytes(body)
    assert files.find_root(str(tmp_path / "data" / "raw" / "m")) == tmp_path
    good, odd = files.raw_files(spark, str(tmp_path / "data" / "raw"))
    assert good.count() == 3 and odd.count() == 1
    prior = files.read_catalog(spark, str(tmp_path / "none.csv"))
    run = catalog.status_rows(good, prior, prior.select("canonical_name"))
    assert sorted(r.status for r in run.collect()) == ["duplicate", "new", "new"]
    assert sorted(r.copied for r in sinks.copy_new(run, str(tmp_path / "flat")).collect()) == [True, True]
    sinks.write_catalog(catalog.upsert(prior, run), str(tmp_path / "index"))
    stored = files.read_catalog(spark, str(tmp_path / "index"))
    again = catalog.status_rows(good, stored, stored.select("canonical_name"))
    assert {r.status for r in again.collect()} == {"skipped_unchanged"}


def text_of(doc):
    return "\n".join(r.value for r in doc.orderBy("section", "k").collect())


def test_coco_and_yolo_documents(spark):
    images = spark.createDataFrame([("a__egg__1.png", 100, 50), ("b.png", 100, 50)], "file_name string, width int, height int")
    cols = "file_name string, ord long, x long, y long, w long, h long, label string, status string, method string, confidence double"
    boxes = spark.createDataFrame([("a__egg__1.png", 0, 10, 10, 20, 10, "", "approved", "m", 0.5), ("a__egg__1.png", 1, 0, 0, 5, 5, "noise", "approved", "m", 0.5), ("b.png", 0, 0, 0, 5, 5, "Noise", "approved", "m", 0.5)], cols)
    ids = exports.coco_images(images)
    doc = json.loads(text_of(exports.coco_document(ids, exports.coco_annotations(ids, boxes), "d", "g")))
    assert [a["bbox"] for a in doc["annotations"]] == [[10, 10, 20, 10], [0, 0, 5, 5], [0, 0, 5, 5]] and [i["id"] for i in doc["images"]] == [1, 2]
    rows = exports.yolo_export(images, boxes)
    doc = json.loads(text_of(exports.yolo_document(exports.yolo_classes(boxes), exports.yolo_lines(images, rows))))
    assert doc == {"classes": ["Noise"], "labels": {"a__egg__1.txt": "0 0.200000 0.300000 0.200000 0.200000", "b.txt": "0 0.025000 0.050000 0.050000 0.100000"}}


def bmp(bgr):
    """A 24-bit bitmap file."""
    h, w = bgr.shape[:2]
    body = b"".join(r.tobytes() + b"\0" * (-3 * w % 4) for r in bgr[::-1])
    return b"BM" + (54 + len(body)).to_bytes(4, "little") + bytes(4) + (54).to_bytes(4, "little") + (40).to_bytes(4, "little") + w.to_bytes(4, "little") + h.to_bytes(4, "little") + b"\1\0\x18\0" + bytes(24) + body


def test_other_formats_reach_the_operators_as_png(spark, tmp_path):
    img = scene(20, 31)
    img[3, 4] = (9, 8, 7)
    (tmp_path / "a b.bmp").write_bytes(bmp(img))
    (tmp_path / "b.png").write_bytes(K.encode_png(img))
    (tmp_path / "broken.jpg").write_bytes(b"no image")
    (tmp_path / "notes.txt").write_text("x")
    got = {r.file_name: r.content for r in files.image_contents(spark, str(tmp_path), "detect").collect()}
    assert set(got) == {"a b.bmp", "b.png", "broken.jpg"} and got["broken.jpg"] is None
    assert (K.to_bgr(K.decode_png(bytes(got["a b.bmp"]))) == img).all()


def test_sixteen_bit_png_and_unit_scale():
    import struct
    import zlib

    px = np.array([[0, 65535, 256]], np.uint16)
    part = lambda kind, body: struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))
    data = b"\x89PNG\r\n\x1a\n" + part(b"IHDR", struct.pack(">IIBBBBB", 3, 1, 16, 0, 0, 0, 0)) + part(b"IDAT", zlib.compress(b"\0" + px.astype(">u2").tobytes())) + part(b"IEND", b"")
    out = K.decode_png(data)
    assert out.dtype == np.uint16 and (out == px).all() and np.allclose(K.unit(out), [[0, 1, 256 / 65535]])
