import numpy as np
from test_images import scene

from slidemill import api
from slidemill.operators import exports, review
from slidemill.operators import kernels as K


def test_commands_over_folders(spark, tmp_path):
    raw = tmp_path / "data" / "raw" / "Lab" / "Egg" / "me"
    raw.mkdir(parents=True)
    for i in range(2):
        (raw / f"{i}.png").write_bytes(K.encode_png(scene(shift=i)))
    flat, index = tmp_path / "flat", tmp_path / "index"
    rows, summary = api.build_catalog(spark, str(tmp_path / "data" / "raw"), str(tmp_path / "none"), str(flat), str(index))
    assert [(r.status, r.files) for r in summary.collect()] == [("new", 2)] and len(list(flat.glob("*.png"))) == 2
    _, again = api.build_catalog(spark, str(tmp_path / "data" / "raw"), str(index), str(flat))
    assert [(r.status, r.files) for r in again.collect()] == [("skipped_unchanged", 2)]
    images, annotations = api.propose_boxes(spark, str(flat), target=str(tmp_path / "out"))
    assert images.count() == 2 and annotations.count() > 0 and len(list((tmp_path / "out" / "visualizations").glob("det_*.png"))) == 2
    proposals = tmp_path / "out" / "proposals"
    once, same = api.propose_boxes(spark, str(flat), prior_json=str(proposals))
    assert once.count() == 2 and same.count() == annotations.count()
    boxes = api.review_state(*api.files.read_proposals(spark, str(proposals)))
    assert {r.label for r in boxes.collect()} == {"egg"} and boxes.count() == annotations.count()
    one = boxes.first().file_name
    assert {r.id for r in api.review_state(*api.files.read_proposals(spark, str(proposals)), file_name=one).collect()} == {r.id for r in boxes.collect() if r.file_name == one}
    approved, _ = review.bulk_update(boxes, "approved")
    assert exports.coco_export(images, approved).count() == boxes.count()
    assert api.tile_images(spark, str(flat), parasite="nothing").count() == 0


def test_overlay_colours_and_edges():
    from slidemill.operators.overlay import draw

    out = draw(np.zeros((20, 20, 3), np.uint8), [(-3, 2, 10, 40, (1, 2, 3))], (10, 10, 5))
    assert tuple(out[2, 3]) == (1, 2, 3) and tuple(out[10, 15]) == (255, 200, 0)


def test_fused_folder_writes_metrics_and_summary(spark, tmp_path):
    import json

    views, out = tmp_path / "views", tmp_path / "out"
    views.mkdir()
    for i in range(2):
        (views / f"v{i}.png").write_bytes(K.encode_png(scene(shift=i)))
    rows = api.fuse_folder(spark, str(views), str(out), scale=1, iterations=5)
    assert rows.count() == 3 and (out / "super_resolved.png").exists()
    lines = [x for f in sorted((out / "metrics").glob("part-*.csv")) for x in f.read_text().splitlines() if not x.startswith("name,")]
    assert sorted(x.split(",")[1] for x in lines) == ["input", "input", "output"]
    summary = json.loads(next((out / "summary").glob("part-*")).read_text())
    assert summary["input_count"] == 2 and len(summary["ranking"]) == 3
