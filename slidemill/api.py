"""The commands as functions over folders: catalogue, tiles, detection, review, fusion.

Folders are ones that all executors see. Each function returns its DataFrames; writing happens only where a target
folder is given, always to a new one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slidemill.operators import catalog, detect, exports, fusion, overlay, quality, review, tiles, tiling
from slidemill.plans.lineage import cut
from slidemill.sources import files, sinks

#: Microscopes, parasites and the default parasite of the tile command.
MICROSCOPES = ("Carson_Microscope", "Foldscope", "Lab_Microscope", "Uhandy_Microscope")
PARASITES = (
    "Ascaris_Lumbricoides", "Balantidium_Coli", "Clonorchis_Sinensis", "Diphyllibothrium_Latum", "Dipylidium_Cannum", "Echinococcus_Gran", "Endolimax_Nana",
    "Entamoeba_Coli", "Entamoeba_Histolytica", "Enterobius_Vermicularis", "Fasciola_Hepatica", "Giardia", "Hymenolepis_Nana", "Necator_Americanus",
    "Schistosoma_Mansoni", "Taenia_Pisiformis", "Taenia_Saginata", "Taenia_Solium", "Trichuria_Trichuris",
)
DEFAULT_PARASITE = "Entamoeba_Coli"


def build_catalog(spark: SparkSession, raw_root: str, prior_csv: str, flat_folder: str, out_csv: str | None = None, rehash_all: bool = False, keep_duplicates: bool = False, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """``(catalogue, run summary)``. With ``out_csv`` the new catalogue is written and new files are copied.

    Contents are read only where size or time changed: the listing itself does not read them.
    """
    good, _ = files.raw_files(spark, raw_root, strict)
    prior = files.read_catalog(spark, prior_csv)
    there = files.image_files(spark, flat_folder, "db").select(F.col("file_name").alias("canonical_name"))
    listed = cut(good.drop("content"))
    run = cut(catalog.status_rows(listed, prior, there, rehash_all, keep_duplicates, flat_folder.rstrip("/"), files.hash_files))
    if out_csv:
        sinks.copy_new(run, flat_folder)
        sinks.write_catalog(catalog.upsert(prior, run), out_csv)
    return catalog.upsert(prior, run), catalog.run_summary(run)


def tile_images(spark: SparkSession, folder: str, target: str | None = None, microscope: str | None = None, parasite: str | None = DEFAULT_PARASITE, patch: int = 1024, stride: int = 256, min_fov_fraction: float = 1.0) -> DataFrame:
    """Tiles of the folder's images that fit the filters, written below ``target/<parasite>`` if that is given."""
    chosen = tiles.select_sources(files.image_contents(spark, folder, "tile"), microscope, parasite)
    out = tiling.tile_images(chosen, patch, stride, min_fov_fraction).withColumn("parasite", F.get(F.split("file_name", "__"), F.lit(1)))
    if target:
        sinks.write_pngs(out, target, "parasite").count()
    return out


def propose_boxes(spark: SparkSession, folder: str, prior_json: str | None = None, target: str | None = None, min_frac: float = 0.0003, max_frac: float = 0.20, nms: tuple[int, int] = (3, 10), force: bool = False, visual: bool = True, yolo: bool = True) -> tuple[DataFrame, DataFrame]:
    """COCO ``(images, annotations)`` of earlier proposals and of the images not processed yet.

    With ``target`` the COCO document, YOLO texts of the new images and overlays are written below it.
    """
    found = files.image_contents(spark, folder, "detect")
    old_images, old_annotations = files.read_proposals(spark, prior_json or f"{folder}/no-such-proposals.json")
    old_annotations = old_annotations.select("id", "image_id", "category_id", *(F.get("bbox", F.lit(i)).alias(c) for i, c in enumerate("xywh")), "area", "iscrowd", "score", "detection_method")
    if force:
        old_images, old_annotations = old_images.limit(0), old_annotations.limit(0)
    new = catalog.not_processed(found, old_images, force)
    heads, boxes = detect.propose(new, min_frac, max_frac, *nms)
    heads, boxes = cut(heads), cut(boxes)
    images, annotations = exports.coco_append(old_images, old_annotations, heads, boxes)
    if target:
        sinks.write_document(exports.coco_document(images, annotations, "Detection proposals", "slidemill"), f"{target}/proposals")
        if yolo:
            rows = heads.join(boxes, "file_name").withColumn("class", F.lit(0))
            lines = exports.yolo_lines(heads, rows.select("file_name", "ord", "class", *exports.yolo(*map(F.col, ("x", "y", "w", "h", "width", "height")))))
            sinks.write_texts(lines, f"{target}/yolo_labels").count()
        if visual:
            sinks.write_pngs(overlay.render(new, heads, boxes), f"{target}/visualizations").count()
    return images, annotations


def review_state(images: DataFrame, annotations: DataFrame, edits: DataFrame | None = None, saved: DataFrame | None = None, file_name: str | None = None) -> DataFrame:
    """Current boxes (of one file, if given): proposals, resumed from a saved review, with the edit log replayed."""
    boxes = review.initial_boxes(images, annotations)
    if saved is not None:
        boxes = review.resume(boxes, saved)
    boxes = boxes if edits is None else review.replay(boxes, edits)
    return boxes if file_name is None else review.boxes_of(boxes, file_name)


def save_review(boxes: DataFrame, images: DataFrame, target: str) -> None:
    """The state of a review as new documents below ``target``: the annotations, the COCO export, the YOLO export (classes and texts in one
    document, and each text as a file).

    The boxes of ``review_state`` so replace the log that made them: a later review starts from ``annotations``.
    """
    boxes = cut(boxes)
    sinks.write_document(exports.annotations_document(images, boxes, "slidemill"), f"{target}/annotations")
    sinks.write_document(exports.coco_export_document(images, boxes), f"{target}/coco")
    lines = cut(exports.yolo_lines(exports.held_files(images, boxes), exports.yolo_export(images, boxes)))
    sinks.write_document(exports.yolo_document(exports.yolo_classes(boxes), lines), f"{target}/yolo")
    sinks.write_texts(lines, f"{target}/yolo_labels").count()


def fuse_folder(spark: SparkSession, folder: str, target: str | None = None, **options) -> DataFrame:
    """Fuse the images of one folder as one scene; metric rows and the output.

    With ``target`` the fused image, the metric rows as CSV and the summary as JSON text are written below it.
    """
    views = files.image_contents(spark, folder, "fuse").select(F.lit("scene").alias("scene"), F.col("file_name").alias("name"), "content")
    out = fusion.fuse_scene(views, **options)
    if target:
        out = cut(out)
        sinks.write_pngs(out.select(F.lit("super_resolved.png").alias("name"), "png"), target).count()
        scored = quality.resolution_scores(out)
        sinks.write_metrics(scored, f"{target}/metrics")
        sinks.write_document(quality.summary(scored), f"{target}/summary")
    return out
