from pyspark.sql import functions as F

from slidemill.functions import scalars as S
from slidemill.operators import catalog, review
from slidemill.plans import proxies as P
from slidemill.schemas import CATALOG


def test_second_run_skips_everything(spark, sf):
    f = P.files(spark, sf)
    empty = spark.createDataFrame([], CATALOG)
    none = P.listing(f).limit(0)
    first = catalog.status_rows(f.drop("doc_id"), empty, none)
    assert set(r.status for r in first.select("status").distinct().collect()) == {"new", "duplicate"}
    stored = catalog.upsert(empty, first)
    again = catalog.run_summary(catalog.status_rows(f.drop("doc_id"), stored, none)).collect()
    assert [(r.status, r.files) for r in again] == [("skipped_unchanged", f.count())]
    rehashed = catalog.run_summary(catalog.status_rows(f.drop("doc_id"), stored, none, rehash_all=True)).collect()
    assert [r.status for r in rehashed] == ["duplicate"]


def test_keep_duplicates_meets_its_own_copy(spark):
    rows = [(f"/r/{i}", "m", "p", "u", f"{i}.png", ".png", 1, 1, "same") for i in range(3)]
    f = spark.createDataFrame(rows, "raw_path string, microscope string, parasite string, user string, raw_filename string, ext string, size_bytes long, mtime_epoch long, content string")
    run = catalog.status_rows(f, spark.createDataFrame([], CATALOG), f.select(F.lit("x").alias("canonical_name")), keep_duplicates=True)
    assert sorted(r.status for r in run.collect()) == ["copied_exists", "copied_exists", "new"]


def test_tokens_names_and_paths(spark):
    row = spark.range(1).select(
        S.safe_token(F.lit("  a b/é.-_ ")).alias("a"), S.safe_token(F.lit("   ")).alias("b"), S.suffix(F.lit("x.Y.TIFF")).alias("c"), S.suffix(F.lit(".png")).alias("d"),
        S.triplet(F.lit("m/p/u/deep/x.png")).alias("t"), S.triplet(F.lit("m/p/x.png")).alias("n"), S.default_label(F.lit("m__My_Egg__x")).alias("l"), S.default_label(F.lit("x.png")).alias("k"),
        S.percent_delta(F.lit(2.0), F.lit(0.0)).alias("p"), S.method_color(F.lit("contrast_t15")).alias("m"),
    ).first()
    assert (row.a, row.b, row.c, row.d) == ("a_b_é.-_", "unknown", ".tiff", "")
    assert tuple(row.t) == ("m", "p", "u") and row.n is None and (row.l, row.k) == ("my egg", "Noise") and row.p is None and list(row.m) == [0, 255, 0]


BOX = "file_name string, ord long, id string, x long, y long, w long, h long, label string, status string, method string, confidence double"


def test_replay_of_all_actions(spark):
    boxes = spark.createDataFrame([("f", i, f"b{i}", 1, 1, 5, 5, "egg", "pending", "m", 0.5) for i in range(5)] + [("g", 0, "b0", 1, 1, 5, 5, "egg", "pending", "m", 0.5)], BOX)
    e = [
        (1, "update", "f", "b0", "approved", None, None), (2, "bulk_update", "f", None, "rejected", None, None), (3, "revert", "f", "b0", None, None, None), (4, "update", "f", "b1", None, "cyst", [2, 2, 9, 9]),
        (5, "delete", "f", "b2", None, None, None), (6, "add", "h", "n1", None, "", [1, 2, 3, 4]), (7, "update", "f", "nobody", "approved", None, None), (8, "bulk_update", None, None, "approved", None, None), (9, "revert", "f", "b4", None, None, None),
    ]
    edits = spark.createDataFrame(e, "seq long, action string, file_name string, box_id string, status string, label string, bbox array<long>")
    got = {(r.file_name, r.id): (r.status, r.label, r.x) for r in review.replay(boxes, edits).collect()}
    assert got == {("f", "b0"): ("approved", "egg", 1), ("f", "b1"): ("rejected", "cyst", 2), ("f", "b3"): ("rejected", "egg", 1), ("f", "b4"): ("pending", "egg", 1), ("g", "b0"): ("approved", "egg", 1), ("h", "n1"): ("approved", "Noise", 1)}


def test_resume_keeps_manual_orphans_only(spark):
    boxes = spark.createDataFrame([("f", 0, "a", 0, 0, 10, 10, "egg", "pending", "m", 0.5)], BOX)
    saved = spark.createDataFrame(
        [("f", 0, 0, 0, 10, 10, "cyst", "approved", "m"), ("f", 1, 50, 50, 5, 5, "x", "approved", "manual"), ("f", 2, 70, 70, 5, 5, "y", "rejected", "m"), ("zz", 0, 0, 0, 5, 5, "", "approved", "manual")],
        "file_name string, ord long, x long, y long, w long, h long, label string, status string, method string",
    )
    got = sorted((r.file_name, r.label, r.status, r.method) for r in review.resume(boxes, saved).collect())
    assert got == [("f", "cyst", "approved", "m"), ("f", "x", "approved", "manual")]


def fold(boxes, edits):
    """All edits one by one, as a store with one list of boxes for each file would take them."""
    store = {}
    for b in boxes:
        store.setdefault(b[0], []).append({"id": b[2], "status": b[8], "label": b[7], "x": b[3]})
    for seq, action, file, box, status, label, bbox in sorted(edits):
        if action == "add":
            store.setdefault(file, []).append({"id": box, "status": "approved", "label": label or "Noise", "x": bbox[0]})
        elif action == "delete":
            store[file] = [b for b in store.get(file, []) if b["id"] != box]
        elif action == "bulk_update":
            for f in [file] if file else list(store):
                for b in store.get(f, []):
                    b["status"] = status if b["status"] == "pending" else b["status"]
        else:
            for b in store.get(file, []):
                if b["id"] == box:
                    b["status"] = "pending" if action == "revert" else status or b["status"]
                    b["label"] = label if label is not None else b["label"]
                    b["x"] = bbox[0] if bbox else b["x"]
    return sorted((f, b["id"], b["status"], b["label"], b["x"]) for f, bs in store.items() for b in bs)


def test_replay_equals_the_fold_of_random_logs(spark):
    import random

    r = random.Random(3)
    boxes = [(f, i, f"b{i}", i, 1, 5, 5, "egg", r.choice(["pending", "approved"]), "m", 0.5) for f in "fg" for i in range(6)]
    edits, alive = [], set()
    for seq in range(1, 260):
        action = r.choice(["update", "update", "revert", "delete", "add", "bulk_update"]) if seq % 3 == 0 else r.choice(["update", "revert"])
        file, box = r.choice("fgh"), f"b{r.randrange(9)}"
        if action == "bulk_update":
            edits.append((seq, action, r.choice([file, None]), None, r.choice(["pending", "approved", "rejected"]), None, None))
        elif action == "add":
            box = f"n{r.randrange(12)}"
            if (file, box) in alive:  # an id is given again only after its box is gone
                continue
            alive.add((file, box))
            edits.append((seq, action, file, box, None, r.choice(["", "cyst"]), [seq, 1, 2, 3]))
        else:
            box = r.choice([box, f"n{r.randrange(12)}"])
            if action == "delete":
                alive.discard((file, box))
            edits.append((seq, action, file, box, r.choice([None, "approved", "rejected"]) if action == "update" else None, r.choice([None, "worm"]) if action == "update" else None, [seq, 2, 3, 4] if action == "update" and seq % 7 == 0 else None))
    df = spark.createDataFrame(edits, "seq long, action string, file_name string, box_id string, status string, label string, bbox array<long>")
    got = sorted((x.file_name, x.id, x.status, x.label, x.x) for x in review.replay(spark.createDataFrame(boxes, BOX), df).collect())
    assert got == fold(boxes, edits)


def test_two_bulk_actions_and_edits_before_an_add(spark):
    boxes = spark.createDataFrame([("f", 0, "a", 0, 0, 5, 5, "egg", "pending", "m", 0.5)], BOX)
    e = [(1, "bulk_update", None, None, "pending", None, None), (2, "bulk_update", "f", None, "approved", None, None), (3, "update", "f", "n", "rejected", None, None), (4, "add", "f", "n", None, "", [1, 1, 5, 5])]
    edits = spark.createDataFrame(e, "seq long, action string, file_name string, box_id string, status string, label string, bbox array<long>")
    assert {r.id: r.status for r in review.replay(boxes, edits).collect()} == {"a": "approved", "n": "approved"}


def test_drawn_rectangles_become_adds(spark):
    rows = [(1, "m__My_Egg__1.png", 30.4, 40.0, 10.0, 52.6, True), (2, "x.png", 0.0, 0.0, 4.4, 90.0, False), (3, "x.png", 0.0, 0.0, 9.0, 9.0, False), (4, "x.png", 0.0, 0.0, 9.0, 9.0, True)]
    out = review.drawn(spark.createDataFrame(rows, "seq long, file_name string, x1 double, y1 double, x2 double, y2 double, maybe boolean")).orderBy("seq").collect()
    assert [(r.seq, r.label, r.bbox) for r in out] == [(1, "my egg_maybe", [10, 40, 20, 13]), (3, None, [0, 0, 9, 9]), (4, "noise_maybe", [0, 0, 9, 9])]


def test_unchanged_files_are_not_opened(spark, tmp_path, monkeypatch):
    from slidemill import api
    from slidemill.sources import files

    raw = tmp_path / "data" / "raw" / "Lab" / "Egg" / "me [1]"
    raw.mkdir(parents=True)
    for i in range(4):
        (raw / f"{i}.png").write_bytes(b"content %d" % i)
    opened, plain = [], files.hash_files
    monkeypatch.setattr(files, "hash_files", lambda paths: (opened.append(paths.count()), plain(paths))[1])
    api.build_catalog(spark, str(tmp_path / "data" / "raw"), str(tmp_path / "none"), str(tmp_path / "flat"), str(tmp_path / "index"))
    assert opened == [4]
    (raw / "2.png").write_bytes(b"other content")
    opened.clear()
    _, summary = api.build_catalog(spark, str(tmp_path / "data" / "raw"), str(tmp_path / "index"), str(tmp_path / "flat"))
    assert opened == [1] and {r.status: r.files for r in summary.collect()} == {"skipped_unchanged": 3, "updated": 1}


def test_documents_of_a_review(spark, tmp_path):
    import json

    from slidemill import api
    from slidemill.operators import exports
    from slidemill.sources import files, sinks

    boxes = spark.createDataFrame(
        [("b.png", 0, "p", 1, 2, 3, 4, "worm", "approved", "m", 0.5), ("a.png", 0, "q", 1, 2, 3, 4, "", "approved", "m", 0.4567), ("a.png", 1, "r", 1, 2, 3, 4, "noise", "approved", "m", 0.5), ("a.png", 2, "s", 1, 2, 3, 4, "egg", "pending", "m", 0.5)], BOX
    )
    images = spark.createDataFrame([("a.png", 10, 20), ("b.png", 30, 40), ("c.png", 50, 60)], "file_name string, width int, height int")
    coco = json.loads("".join(r.value for r in exports.coco_export_document(images, boxes).orderBy("section", "k").collect()))
    assert [i["file_name"] for i in coco["images"]] == ["a.png", "b.png", "c.png"] and coco["categories"] == [{"id": 1, "name": "parasite"}, {"id": 2, "name": "worm"}]
    assert [(a["id"], a["image_id"], a["category_id"], a["bbox"], a["area"]) for a in coco["annotations"]] == [(1, 1, 1, [1, 2, 3, 4], 12), (2, 2, 2, [1, 2, 3, 4], 12)]
    api.save_review(boxes, images, str(tmp_path / "out"))
    saved = files.read_annotations(spark, str(tmp_path / "out" / "annotations"))
    assert sorted((r.file_name, r.label, r.status) for r in saved.collect()) == sorted((r.file_name, r.label, r.status) for r in boxes.collect())
    assert (tmp_path / "out" / "yolo_labels" / "b.txt").read_text() == "0 0.083333 0.100000 0.100000 0.100000"
    assert (tmp_path / "out" / "yolo_labels" / "c.txt").read_text() == ""
    sinks.write_metrics(spark.createDataFrame([("v1", "input", 1.5)], "name string, role string, tenengrad double"), str(tmp_path / "metrics"))
    head = next((tmp_path / "metrics").glob("part-*.csv")).read_text().splitlines()
    assert head[0].startswith("name,role,width,height,laplacian_variance") and head[1].startswith("v1,input,")
    assert tuple(exports.proposal_totals(images, boxes, images.limit(1), boxes.limit(2)).first()) == (2, 1, 4, 3)


def test_a_changed_file_rewrites_its_parasite_only(spark, tmp_path):
    from slidemill.sources import tables

    cols = "raw_path string, microscope string, parasite string, user string, raw_filename string, ext string, size_bytes long, mtime_epoch long, content string"
    files = [(f"/r/{p}{i}", "m", p, "u", f"{p}{i}.png", ".png", 1, 1, f"{p}{i}") for p in ("1", "egg", "worm") for i in range(3)]
    none = spark.createDataFrame([], "canonical_name string")
    step = lambda rows: catalog.status_rows(spark.createDataFrame(rows, cols), tables.catalog_table(spark, store), none)
    store = str(tmp_path / "c")
    assert tables.update_catalog(spark, store, step(files)).count() == 9
    changed = [(*f[:6], 2, 2, "other") if f[0] == "/r/egg1" else f for f in files]
    # a run lost before its heads are written leaves the old version
    heads = tables.stored(spark, f"{store}/heads", tables.HEADS).count()
    tables.replace(spark.createDataFrame([("x", "m", "egg", "u", "/r/lost", "l", ".png", 1, 1, "c", "f", "new", 2)], tables.CATALOG_ROWS), f"{store}/rows", ["parasite", "version"])
    assert tables.catalog_table(spark, store).count() == 9
    out = {r.raw_path: (r.size_bytes, r.status) for r in tables.update_catalog(spark, store, step(changed)).collect()}
    assert len(out) == 9 and out["/r/egg1"] == (2, "updated") and out["/r/egg0"] == (1, "new")
    assert tables.stored(spark, f"{store}/heads", tables.HEADS).count() == heads + 1
    assert sorted(p.parent.name + "/" + p.name for p in (tmp_path / "c" / "rows").glob("parasite=*/version=*")) == ["parasite=1/version=1", "parasite=egg/version=1", "parasite=egg/version=2", "parasite=worm/version=1"]


def test_a_failed_task_leaves_no_file(spark, tmp_path):
    import pytest

    from slidemill.sources import sinks

    (tmp_path / "there").write_bytes(b"x" * 3_000_000)
    rows = [(str(tmp_path / "there"), "a.png", None), (str(tmp_path / "missing"), "b.png", None), ("text", "c.txt", bytearray(b"c"))]
    df = spark.createDataFrame(rows, "raw_path string, name string, content binary")
    with pytest.raises(Exception, match="missing"):
        sinks.put_files(df, str(tmp_path / "out"))
    assert not [p for p in (tmp_path / "out").rglob("*") if p.is_file()]
    assert sorted(r.copied for r in sinks.put_files(df.where("name <> 'b.png'"), str(tmp_path / "out")).collect()) == [True, True]
    assert sorted(r.copied for r in sinks.put_files(df.where("name <> 'b.png'"), str(tmp_path / "out")).collect()) == [False, False]
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == ["a.png", "c.txt"] and (tmp_path / "out" / "a.png").stat().st_size == 3_000_000


def test_table_functions_equal_the_operators(spark, sf):
    import pytest

    from slidemill.functions import tables
    from slidemill.operators import boxes as B
    from slidemill.operators import tiles

    tables.register(spark)
    b = P.boxes(spark, sf).select("image_id", "ord", "x", "y", "w", "h", "confidence")
    b.createOrReplaceTempView("some_boxes")
    got = spark.sql("SELECT image_id, ord FROM suppress(TABLE(some_boxes) PARTITION BY image_id ORDER BY (confidence DESC, ord), 3, 10)")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, B.nms(b).select("image_id", "ord").collect()))
    images = P.images(spark, sf)
    images.createOrReplaceTempView("some_images")
    got = spark.sql("SELECT image_id, t.r0, t.c0 FROM some_images, LATERAL tile_grid(CAST(width AS INT), CAST(height AS INT), 512, 256) t")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, tiles.grid(images, 512, 256).select("image_id", "r0", "c0").collect()))
    with pytest.raises(Exception, match="boxes lack"):
        spark.sql("SELECT * FROM suppress(TABLE(some_images) PARTITION BY image_id)").collect()


def test_rank_of_one_scene_of_all_rows(spark):
    from slidemill.operators import quality

    rows = [("s", f"n{i:03}", (i * 37 % 50) / 10) for i in range(300)] + [("t", "only", 1.0)]
    got = {(r.scene, r.name): r.rank for r in quality.rank(spark.createDataFrame(rows, "scene string, name string, resolution_score double").repartition(7)).collect()}
    want = {(s, n): i for i, (s, n, _) in enumerate(sorted((r for r in rows if r[0] == "s"), key=lambda r: (-r[2], r[1])), 1)}
    assert got == want | {("t", "only"): 1}


def test_hit_test_equals_all_pairs(spark):
    import random

    r = random.Random(4)
    boxes = [("f", i, f"b{i}", r.randrange(-50, 900), r.randrange(900), r.randrange(400), r.randrange(400), r.choice(["egg", "noise"]), "approved", "m", 0.5) for i in range(80)]
    points = [("f", r.randrange(1000) + r.choice([0.0, 0.5]), float(r.randrange(1000)), r.choice([None, "b7"])) for _ in range(60)] + [("g", 1.0, 1.0, None), ("f", float(boxes[3][3] + boxes[3][5]), float(boxes[3][4] + boxes[3][6]), None)]
    hidden = spark.createDataFrame([("f", "noise")], "file_name string, label string")
    got = {(x.px, x.py): x.id for x in review.hit_test(spark.createDataFrame(boxes, BOX), spark.createDataFrame(points, "file_name string, px double, py double, selected string").dropDuplicates(["px", "py"]), hidden, cell=100).collect()}
    seen = spark.createDataFrame(points, "file_name string, px double, py double, selected string").dropDuplicates(["px", "py"]).collect()
    want = {}
    for p in seen:
        held = [b for b in boxes if p.file_name == "f" and b[3] <= p.px <= b[3] + b[5] and b[4] <= p.py <= b[4] + b[6] and (b[7] != "noise" or b[2] == p.selected)]
        if held:
            want[p.px, p.py] = max(held, key=lambda b: b[1])[2]
    assert got == want and want


def test_a_missing_folder_has_no_images(spark, tmp_path):
    from slidemill.sources import files

    assert files.image_files(spark, str(tmp_path / "none"), "db").count() == 0
