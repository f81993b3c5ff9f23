"""Every registered query of the library proper, with its SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from slidemill.functions import scalars as S
from slidemill.operators import boxes as B
from slidemill.operators import catalog, exports, quality, rasters, review, tiles
from slidemill.plans import proxies as P
from slidemill.plans.lineage import cut, shared_folder
from slidemill.sources import files, sinks, tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def put(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return put


# ---- catalogue ----


def _run(spark, sf_dir):
    f = P.files(spark, sf_dir)
    return catalog.status_rows(f.drop("doc_id"), P.prior(f), P.listing(f))


@query(f"WITH {P.FILE_SQL} SELECT raw_path, h AS image_id, row_number() OVER (PARTITION BY h ORDER BY raw_path) = 1 AS is_first FROM file")
def catalog_dedup(spark, sf_dir):
    f = P.files(spark, sf_dir).withColumn("image_id", F.sha2("content", 256))
    return catalog.first_of_hash(f).select("raw_path", "image_id", "is_first")


@query(P.STATUS_SQL + " SELECT raw_path, image_id, canonical_name, status FROM run")
def catalog_status(spark, sf_dir):
    return _run(spark, sf_dir).select("raw_path", "image_id", "canonical_name", "status")


@query(P.STATUS_SQL + " SELECT status, count(*) AS files FROM run GROUP BY status")
def catalog_run_summary(spark, sf_dir):
    return catalog.run_summary(_run(spark, sf_dir))


@query(
    P.STATUS_SQL
    + """ SELECT raw_path, image_id, size_bytes, mtime_epoch, canonical_name, 'new' AS status FROM prior WHERE raw_path NOT IN (SELECT raw_path FROM run WHERE status <> 'skipped_unchanged')
  UNION ALL SELECT raw_path, image_id, size_bytes, mtime_epoch, canonical_name, status FROM run WHERE status <> 'skipped_unchanged'"""
)
def catalog_upsert(spark, sf_dir):
    out = catalog.upsert(P.prior(P.files(spark, sf_dir)), _run(spark, sf_dir))
    return out.select("raw_path", "image_id", "size_bytes", "mtime_epoch", "canonical_name", "status")


@query(ORACLES["catalog_upsert"])
def catalog_in_place(spark, sf_dir):
    """The catalogue kept as a table: the earlier one, then the run, which writes the changed parasites again."""
    store = f"{shared_folder(spark)}/catalogue-{uuid.uuid4().hex}"
    tables.update_catalog(spark, store, P.prior(P.files(spark, sf_dir)))
    f = P.files(spark, sf_dir)
    out = tables.update_catalog(spark, store, catalog.status_rows(f.drop("doc_id"), tables.catalog_table(spark, store), P.listing(f)))
    return out.select("raw_path", "image_id", "size_bytes", "mtime_epoch", "canonical_name", "status")


@query(f"WITH {P.FILE_SQL} SELECT raw_path, {P.CANON('h')} AS canonical_name FROM file")
def canonical_names(spark, sf_dir):
    return P.files(spark, sf_dir).select("raw_path", S.canonical_name(F.col("microscope"), F.col("parasite"), F.col("user"), F.sha2("content", 256), F.col("ext")).alias("canonical_name"))


@query(f"""WITH {P.FILE_SQL}, n AS (SELECT microscope || '__' || parasite || '__' || doc_id || '.png' AS file_name, microscope, parasite FROM file)
SELECT file_name, microscope, parasite FROM n WHERE lower(parasite) = 'en' AND lower(microscope) = 'src0'""")
def filename_filter(spark, sf_dir):
    f = P.files(spark, sf_dir).select(F.concat(F.concat_ws("__", "microscope", "parasite", "doc_id"), F.lit(".png")).alias("file_name"))
    return tiles.select_sources(f, "SRC0", "EN")


@query(f"WITH {P.IMG_SQL} SELECT file_name, 'sp ' || (image_id % 5) AS default_label FROM img")
def default_label(spark, sf_dir):
    return P.images(spark, sf_dir).select("file_name", S.default_label(F.col("file_name")).alias("default_label"))


@query("""SELECT '/data/raw/' || source || '/' || lang || '/user_' || (doc_id % 7) || '/img_' || doc_id || '.PNG' AS raw_path FROM documents
WHERE 'img_' || doc_id || '.PNG' NOT IN (SELECT 'img_' || doc_id || '.PNG' FROM documents WHERE doc_id % 4 = 1)""")
def incremental_new(spark, sf_dir):
    f = P.files(spark, sf_dir).withColumnRenamed("raw_filename", "file_name")
    return catalog.not_processed(f, f.where(F.col("doc_id") % 4 == 1)).select("raw_path")


# ---- boxes ----

_CLOSE = "10 * greatest(0, least(q.x + q.w, c[1].x + c[1].w) - greatest(q.x, c[1].x)) * greatest(0, least(q.y + q.h, c[1].y + c[1].h) - greatest(q.y, c[1].y))"


@query(f"""WITH {P.BOX_SQL} SELECT image_id, ord, greatest(0, x - px) AS x, greatest(0, y - py) AS y, w + 2 * px AS w, h + 2 * py AS h FROM (
  SELECT *, greatest(5, CAST(floor(w * 0.1e0) AS BIGINT)) AS px, greatest(5, CAST(floor(h * 0.1e0) AS BIGINT)) AS py FROM box
  WHERE w * h BETWEEN 300 AND 2000 AND greatest(w, h) / (least(w, h) + 1e-6) <= 8)""")
def box_filter_pad(spark, sf_dir):
    b = P.boxes(spark, sf_dir).withColumn("area", F.col("w") * F.col("h"))
    low, high = B.area_band(F.lit(1_000_000.0), 0.0003, 0.002)
    return B.filter_and_pad(b, low, high).select("image_id", "ord", "x", "y", "w", "h")


@query(f"""WITH {P.BOX_SQL}, s AS (SELECT image_id, ord, x, y, w, h, unnest(range(greatest(y, 20, 0), least(y + h, 220, 1023) + 1)) AS v FROM box WHERE w <= 150 AND h <= 150),
c AS (SELECT image_id, ord, w, h, greatest(0, least(x + w, CAST(floor(120 + sqrt(CAST(10000 - (v - 120) * (v - 120) AS DOUBLE))) AS BIGINT)) - greatest(x, CAST(ceil(120 - sqrt(CAST(10000 - (v - 120) * (v - 120) AS DOUBLE))) AS BIGINT)) + 1) AS n FROM s)
SELECT image_id, ord FROM c GROUP BY image_id, ord, w, h HAVING sum(n) / (w * h) > 0.85""")
def fov_overlap(spark, sf_dir):
    b = P.boxes(spark, sf_dir).withColumns({"cx": F.lit(120), "cy": F.lit(120), "r": F.lit(100), "width": F.lit(1024), "height": F.lit(1024)})
    return B.inside_fov(b).select("image_id", "ord")


@query(f"""WITH {P.BOX_SQL}, p AS (SELECT a.image_id, a.ord AS a, b.ord AS b, greatest(0, least(a.x + a.w, b.x + b.w) - greatest(a.x, b.x)) * greatest(0, least(a.y + a.h, b.y + b.h) - greatest(a.y, b.y)) AS i, a.w * a.h + b.w * b.h AS s
  FROM box a JOIN box b ON a.image_id = b.image_id AND a.ord < b.ord) SELECT image_id, a, b, round(i / (s - i), 6) AS iou FROM p WHERE i > 0""")
def iou_pairs(spark, sf_dir):
    return B.iou_pairs(P.boxes(spark, sf_dir)).withColumn("iou", F.round("iou", 6))


@query(f"""WITH {P.BOX_SQL}, g AS (SELECT image_id, list([{{'x': x, 'y': y, 'w': w, 'h': h, 'ord': ord}}] ORDER BY confidence DESC, ord) AS bs FROM box GROUP BY image_id),
k AS (SELECT image_id, list_reduce(bs, lambda k, c: CASE WHEN len(list_filter(k, lambda q: {_CLOSE} * 1 > 3 * (q.w * q.h + c[1].w * c[1].h - {_CLOSE} // 10))) > 0 THEN k ELSE list_concat(k, c) END) AS kept FROM g)
SELECT image_id, b.ord AS ord FROM (SELECT image_id, unnest(kept) AS b FROM k)""")
def nms_kept(spark, sf_dir):
    b = P.boxes(spark, sf_dir).select("image_id", "ord", "x", "y", "w", "h", "confidence")
    return B.nms(b, 3, 10).select("image_id", "ord")


@query(f"""WITH {P.CROWD_SQL}, g AS (SELECT image_id, list([{{'x': x, 'y': y, 'w': w, 'h': h, 'ord': ord}}] ORDER BY confidence DESC, ord) AS bs FROM crowd GROUP BY image_id),
k AS (SELECT image_id, list_reduce(bs, lambda k, c: CASE WHEN len(list_filter(k, lambda q: {_CLOSE} * 1 > 3 * (q.w * q.h + c[1].w * c[1].h - {_CLOSE} // 10))) > 0 THEN k ELSE list_concat(k, c) END) AS kept FROM g)
SELECT image_id, b.ord AS ord FROM (SELECT image_id, unnest(kept) AS b FROM k)""")
def nms_crowded(spark, sf_dir):
    """A hundred images with all boxes: each is settled in rounds over its pairs."""
    return B.nms(P.crowded(spark, sf_dir).drop("file_name"), 3, 10).select("image_id", "ord")


# ---- tiles ----


_TILES = f"""WITH {P.IMG_SQL}, t AS (SELECT image_id, width, height, unnest(range(0, height - 1024 + 1, 256)) AS r0 FROM img),
g AS (SELECT *, unnest(range(0, width - 1024 + 1, 256)) AS c0 FROM t)"""


@query(_TILES + " SELECT image_id, CAST(r0 AS INTEGER) AS r0, CAST(c0 AS INTEGER) AS c0 FROM g")
def tile_grid(spark, sf_dir):
    return tiles.grid(P.images(spark, sf_dir)).select("image_id", "r0", "c0")


_CHORD = "sqrt(CAST(250000 - (v - height // 2) * (v - height // 2) AS DOUBLE))"


@query(f"""WITH {P.IMG_SQL}, t AS (SELECT *, unnest(range(0, height - 512 + 1, 512)) AS r0 FROM img), g AS (SELECT *, unnest(range(0, width - 512 + 1, 512)) AS c0 FROM t),
n AS (SELECT *, list_sum(list_transform(range(greatest(r0, height // 2 - 500, 0), least(r0 + 511, height // 2 + 500, height - 1) + 1), lambda v: greatest(0, least(c0 + 511, width - 1, CAST(floor(width // 2 + {_CHORD}) AS BIGINT)) - greatest(c0, 0, CAST(ceil(width // 2 - {_CHORD}) AS BIGINT)) + 1))) AS n FROM g),
k AS (SELECT * FROM n WHERE n / 262144.0e0 >= 0.6 AND (c0 + 256 - width // 2) * (c0 + 256 - width // 2) + (r0 + 256 - height // 2) * (r0 + 256 - height // 2) <= 250000)
SELECT image_id, CAST(r0 AS INTEGER) AS r0, CAST(c0 AS INTEGER) AS c0, row_number() OVER (PARTITION BY image_id ORDER BY r0, c0) - 1 AS k, round(n / 262144.0e0, 6) AS fov_fraction FROM k""")
def tile_keep(spark, sf_dir):
    i = P.images(spark, sf_dir).withColumns({"cx": F.expr("width div 2"), "cy": F.expr("height div 2"), "r": F.lit(500)})
    kept = tiles.keep_in_fov(tiles.grid(i, 512, 512), 512, 0.6)
    return tiles.number(kept).select("image_id", "r0", "c0", "k", F.round("fov_fraction", 6).alias("fov_fraction"))


# ---- exports ----


@query(f"WITH {P.IMG_SQL} SELECT row_number() OVER (ORDER BY file_name) AS id, file_name, width, height FROM img")
def coco_images(spark, sf_dir):
    return exports.coco_images(P.images(spark, sf_dir))


_COCO = f"""WITH {P.IMG_SQL}, {P.BOX_SQL}, ci AS (SELECT row_number() OVER (ORDER BY file_name) AS id, file_name, width, height FROM img)"""


@query(_COCO + " SELECT row_number() OVER (ORDER BY ci.id, ord) AS id, ci.id AS image_id, x, y, w, h, w * h AS area, round(confidence, 3) AS score, method AS detection_method FROM box JOIN ci USING (file_name)")
def coco_annotations(spark, sf_dir):
    out = exports.coco_annotations(exports.coco_images(P.images(spark, sf_dir)), P.boxes(spark, sf_dir))
    return out.select("id", "image_id", "x", "y", "w", "h", "area", "score", "detection_method")


@query(f"""WITH {P.IMG_SQL}, {P.BOX_SQL}, o AS (SELECT row_number() OVER (ORDER BY file_name) AS id, file_name FROM img WHERE image_id % 3 = 0),
n AS (SELECT (SELECT count(*) FROM o) + row_number() OVER (ORDER BY file_name) AS id, file_name FROM img WHERE image_id % 3 <> 0),
a AS (SELECT row_number() OVER (ORDER BY o.id, ord) AS id, o.id AS image_id, ord FROM box JOIN o USING (file_name))
SELECT * FROM a UNION ALL SELECT (SELECT count(*) FROM a) + row_number() OVER (ORDER BY n.id, ord), n.id, ord FROM box JOIN n USING (file_name)""")
def coco_append(spark, sf_dir):
    i, b = P.images(spark, sf_dir), P.boxes(spark, sf_dir)
    old = exports.coco_images(i.where("image_id % 3 = 0"))
    keep = lambda d: d.withColumn("label", F.col("ord").cast("string"))
    _, rows = exports.coco_append(old, exports.coco_annotations(old, keep(b)), i.where("image_id % 3 <> 0"), keep(b))
    return rows.select("id", "image_id", F.col("label").cast("long").alias("ord"))


@query(f"WITH {P.IMG_SQL}, {P.BOX_SQL} SELECT img.file_name, ord, round((x + w / 2) / width, 9) AS xc, round((y + h / 2) / height, 9) AS yc, round(w / width, 9) AS nw, round(h / height, 9) AS nh FROM img LEFT JOIN box USING (file_name)")
def yolo_rows(spark, sf_dir):
    j = P.images(spark, sf_dir).drop("image_id", "id").join(P.boxes(spark, sf_dir), "file_name", "left")
    out = j.select("file_name", "ord", *S.yolo(*map(F.col, ("x", "y", "w", "h", "width", "height"))))
    return out.select("file_name", "ord", *(F.round(c, 9).alias(c) for c in ("xc", "yc", "nw", "nh")))


_EXPORT = "e AS (SELECT file_name, ord, x, y, w, h, CASE WHEN label = '' THEN 'parasite' ELSE label END AS label FROM box WHERE status = 'approved' AND label <> 'noise')"


@query(f"""{_COCO}, {_EXPORT}, c AS (SELECT label, row_number() OVER (ORDER BY first_seen) AS category_id FROM (SELECT label, min((file_name, ord)) AS first_seen FROM e GROUP BY label))
SELECT row_number() OVER (ORDER BY ci.id, ord) AS id, ci.id AS image_id, category_id, x, y, w, h, w * h AS area FROM e JOIN c USING (label) JOIN ci USING (file_name)""")
def export_coco(spark, sf_dir):
    return exports.coco_export(P.images(spark, sf_dir), P.boxes(spark, sf_dir)).withColumn("category_id", F.col("category_id").cast("long")).drop("iscrowd")


@query(f"""WITH {P.IMG_SQL}, {P.BOX_SQL}, i AS (SELECT * FROM img WHERE image_id % 5 <> 0), b AS (SELECT * FROM box WHERE image_id % 7 <> 0),
f AS (SELECT row_number() OVER (ORDER BY file_name) AS image_id, file_name, width, height FROM (SELECT coalesce(i.file_name, n.file_name) AS file_name, coalesce(width, 0) AS width, coalesce(height, 0) AS height
  FROM i FULL JOIN (SELECT DISTINCT file_name FROM b) n ON n.file_name = i.file_name))
SELECT f.image_id AS image_id, f.file_name AS file_name, width, height, CASE WHEN ord IS NOT NULL THEN row_number() OVER (ORDER BY ord IS NULL, f.image_id, ord) END AS id, x, y, w, h, w * h AS area, round(confidence, 3) AS score, method AS detection_method, status, label
FROM f LEFT JOIN b ON b.file_name = f.file_name""")
def annotations_export(spark, sf_dir):
    """A whole review: images without boxes have their row, files that only boxes name have one of size 0."""
    images, rows = exports.annotations_export(P.images(spark, sf_dir).where("image_id % 5 <> 0"), P.boxes(spark, sf_dir).where("image_id % 7 <> 0"))
    out = images.withColumnRenamed("id", "image_id").join(rows, "image_id", "left")
    return out.select("image_id", "file_name", "width", "height", "id", "x", "y", "w", "h", "area", "score", "detection_method", "status", "label")


_CLASSES = "l AS (SELECT DISTINCT label FROM box WHERE status = 'approved' AND label NOT IN ('', 'noise')), k AS (SELECT CAST(row_number() OVER (ORDER BY label) - 1 AS INTEGER) AS class, label FROM l)"


@query(f"WITH {P.BOX_SQL}, {_CLASSES} SELECT class, label FROM k")
def export_yolo_classes(spark, sf_dir):
    return exports.yolo_classes(P.boxes(spark, sf_dir))


@query(f"""WITH {P.IMG_SQL}, {P.BOX_SQL}, {_EXPORT}, {_CLASSES} SELECT file_name, ord, coalesce(class, 0) AS class, round((x + w / 2) / width, 9) AS xc, round((y + h / 2) / height, 9) AS yc, round(w / width, 9) AS nw, round(h / height, 9) AS nh
FROM e LEFT JOIN k USING (label) LEFT JOIN img USING (file_name)""")
def export_yolo_rows(spark, sf_dir):
    out = exports.yolo_export(P.images(spark, sf_dir), P.boxes(spark, sf_dir))
    return out.select("file_name", "ord", "class", *(F.round(c, 9).alias(c) for c in ("xc", "yc", "nw", "nh")))


# ---- review ----


@query(f"WITH {P.IMG_SQL}, {P.BOX_SQL} SELECT img.file_name AS file_name, width, height, count(ord) AS total_boxes, count(CASE WHEN status = 'pending' THEN 1 END) AS pending FROM img LEFT JOIN box USING (file_name) GROUP BY ALL")
def review_image_list(spark, sf_dir):
    return review.image_list(P.images(spark, sf_dir), P.boxes(spark, sf_dir))


@query(f"""WITH {P.BOX_SQL} SELECT (SELECT count(*) FROM orders) AS total_images, count(*) AS total_boxes, count(CASE WHEN status = 'approved' THEN 1 END) AS approved, count(CASE WHEN status = 'rejected' THEN 1 END) AS rejected,
count(CASE WHEN status NOT IN ('approved', 'rejected') THEN 1 END) AS pending FROM box""")
def review_stats(spark, sf_dir):
    return review.stats(P.images(spark, sf_dir), P.boxes(spark, sf_dir))


@query("""WITH u AS (SELECT DISTINCT user_id FROM events), s AS (SELECT user_id, event_id, CASE event_type WHEN 'click' THEN 'approved' WHEN 'error' THEN 'rejected' ELSE 'pending' END AS status FROM events WHERE event_type IN ('click', 'error', 'view')),
l AS (SELECT user_id, max(event_id) AS at, max_by(status, event_id) AS status FROM s GROUP BY user_id),
p AS (SELECT user_id, max_by('k' || (props ->> '$.k'), event_id) AS label FROM events WHERE event_type = 'purchase' GROUP BY user_id)
SELECT CAST(u.user_id AS VARCHAR) AS id, CASE WHEN coalesce(l.status, 'pending') = 'pending' AND (SELECT max(event_id) FROM events WHERE event_type = 'signup') > coalesce(l.at, -1) THEN 'approved' ELSE coalesce(l.status, 'pending') END AS status, coalesce(p.label, 'Noise') AS label
FROM u LEFT JOIN l USING (user_id) LEFT JOIN p USING (user_id)""")
def review_replay(spark, sf_dir):
    return review.replay(P.edit_boxes(spark, sf_dir), P.edits(spark, sf_dir)).select("id", "status", "label")


@query(f"""WITH {P.ALL_EDITS_SQL},
b AS (SELECT DISTINCT CAST(user_id AS VARCHAR) AS id, -1 AS born, 'pending' AS status, 'Noise' AS label FROM events UNION ALL SELECT id, seq, 'approved', label FROM e WHERE action = 'add'),
o AS (SELECT b.id, b.born, max(CASE WHEN e.status IS NOT NULL THEN seq END) AS at, max_by(e.status, seq) FILTER (e.status IS NOT NULL) AS last, max_by(e.label, seq) FILTER (e.label IS NOT NULL) AS name, bool_or(action = 'delete') AS gone
  FROM b JOIN e ON e.id = b.id AND e.seq > b.born AND action IN ('update', 'revert', 'delete') GROUP BY b.id, b.born),
f AS (SELECT b.id, b.born, coalesce(o.last, b.status) AS status, coalesce(o.name, b.label) AS label, coalesce(o.at, b.born) AS at FROM b LEFT JOIN o ON o.id = b.id AND o.born = b.born WHERE NOT coalesce(gone, false)),
n AS (SELECT f.id, f.born, min_by(e.status, e.seq) AS next FROM f JOIN e ON action = 'bulk_update' AND e.status <> 'pending' AND e.seq > f.at WHERE f.status = 'pending' GROUP BY f.id, f.born)
SELECT f.id AS id, coalesce(next, status) AS status, label FROM f LEFT JOIN n ON n.id = f.id AND n.born = f.born""")
def review_replay_all(spark, sf_dir):
    return review.replay(P.edit_boxes(spark, sf_dir), P.all_edits(spark, sf_dir)).select("id", "status", "label")


@query(ORACLES["review_replay_all"])
def review_tail(spark, sf_dir):
    """A snapshot in the middle of the log, and the edits behind it."""
    edits = P.all_edits(spark, sf_dir)
    middle = edits.agg((F.min("seq") + F.max("seq")) / 2).first()[0] or 0
    snapshot = cut(review.replay(P.edit_boxes(spark, sf_dir), edits.where(F.col("seq") <= middle)))
    return review.replay(snapshot, edits.where(F.col("seq") > middle)).select("id", "status", "label")


@query(f"WITH {P.IMG_SQL}, {P.BOX_SQL} SELECT file_name, x, y, w, h, label, status, method FROM box")
def review_document(spark, sf_dir):
    """The review written as one document in parts, and read again."""
    path = f"{shared_folder(spark)}/review-{uuid.uuid4().hex}"
    sinks.write_document(exports.annotations_document(P.images(spark, sf_dir), P.boxes(spark, sf_dir), "slidemill"), path, "gzip", 50_000)
    return files.read_annotations(spark, path).select("file_name", *(F.col(c).cast("long").alias(c) for c in "xywh"), "label", "status", "method")


@query(f"WITH {P.BOX_SQL} SELECT file_name, ord, CASE WHEN status = 'pending' THEN 'approved' ELSE status END AS status FROM box")
def bulk_update(spark, sf_dir):
    return review.bulk_update(P.boxes(spark, sf_dir), "approved")[0].select("file_name", "ord", "status")


@query(f"WITH {P.BOX_SQL} SELECT file_name, ord, CASE WHEN ord % 2 = 0 THEN 'pending' ELSE status END AS status FROM box")
def bulk_revert(spark, sf_dir):
    b = P.boxes(spark, sf_dir)
    return review.bulk_revert(b, b.where("ord % 2 = 0")).select("file_name", "ord", "status")


def _saved(b: DataFrame) -> DataFrame:
    """A saved review: three of four boxes, shifted a little, with other decisions; every fifth is manual."""
    return b.where("ord % 4 <> 3").select(
        "file_name", "ord", (F.col("x") + F.col("ord") % 3 * 4).alias("x"), "y", "w", "h", F.concat(F.lit("saved_"), F.col("ord").cast("string")).alias("label"), F.lit("approved").alias("status"), F.when(F.col("ord") % 5 == 0, "manual").otherwise(F.col("method")).alias("method")
    )


_SIDE = lambda p, s: f"greatest(0, least(b.{p} + b.{s}, t.{p} + t.{s}) - greatest(b.{p}, t.{p}))"
_INTER = f"({_SIDE('x', 'w')} * {_SIDE('y', 'h')})"


@query(f"""WITH RECURSIVE {P.BOX_SQL}, saved AS (SELECT file_name, ord, x + ord % 3 * 4 AS x, y, w, h, 'saved_' || ord AS label, CASE WHEN ord % 5 = 0 THEN 'manual' ELSE method END AS method FROM box WHERE ord % 4 <> 3),
ss AS (SELECT file_name, list({{'o': ord, 'x': x, 'y': y, 'w': w, 'h': h}} ORDER BY ord) AS all_saved FROM saved GROUP BY file_name),
c AS (SELECT b.file_name, b.ord, list_sort(list_transform(list_filter(all_saved, lambda t: 2 * {_INTER} > b.w * b.h + t.w * t.h - {_INTER}),
  lambda t: {{'v': -({_INTER} / (b.w * b.h + t.w * t.h - {_INTER})), 'o': t.o}})) AS fits FROM box b JOIN ss ON ss.file_name = b.file_name),
r AS (SELECT file_name, CAST(0 AS BIGINT) AS ord, CAST([] AS BIGINT[]) AS used, CAST(NULL AS BIGINT) AS took FROM ss
  UNION ALL SELECT file_name, ord, CASE WHEN took IS NULL THEN used ELSE list_append(used, took) END, took FROM (
    SELECT c.file_name, c.ord, r.used, list_filter(c.fits, lambda t: NOT list_contains(r.used, t.o))[1].o AS took FROM r JOIN c ON c.file_name = r.file_name AND c.ord = r.ord + 1)),
m AS (SELECT file_name, ord, took FROM r WHERE took IS NOT NULL),
lost AS (SELECT s.file_name, s.ord, s.label FROM saved s LEFT JOIN m ON m.file_name = s.file_name AND m.took = s.ord WHERE s.method = 'manual' AND m.took IS NULL)
SELECT b.file_name AS file_name, b.ord AS ord, CASE WHEN m.took IS NULL THEN b.status ELSE 'approved' END AS status, coalesce(s.label, b.label) AS label, b.method AS method FROM box b LEFT JOIN m ON m.file_name = b.file_name AND m.ord = b.ord LEFT JOIN saved s ON s.file_name = m.file_name AND s.ord = m.took
UNION ALL SELECT l.file_name, t.top + row_number() OVER (PARTITION BY l.file_name ORDER BY l.ord), 'approved', l.label, 'manual' FROM lost l JOIN (SELECT file_name, max(ord) AS top FROM box GROUP BY file_name) t ON t.file_name = l.file_name""")
def resume_match(spark, sf_dir):
    b = P.boxes(spark, sf_dir).select(review.BOX_COLUMNS)
    return review.resume(b, _saved(b)).select("file_name", "ord", "status", "label", "method")


@query(f"""WITH RECURSIVE {P.CROWD_SQL}, saved AS (SELECT file_name, ord, x + ord % 3 * 4 AS x, y, w, h FROM crowd WHERE ord % 4 <> 3),
p AS (SELECT b.file_name, b.ord, t.ord AS o, {_INTER} AS i, b.w * b.h + t.w * t.h AS s FROM crowd b JOIN saved t ON t.file_name = b.file_name AND t.x < b.x + b.w AND b.x < t.x + t.w AND t.y < b.y + b.h AND b.y < t.y + t.h),
c AS (SELECT file_name, ord, row_number() OVER (PARTITION BY file_name ORDER BY ord) AS turn, list(o ORDER BY i / (s - i) DESC, o) AS fits FROM p WHERE 2 * i > s - i GROUP BY file_name, ord),
r AS (SELECT DISTINCT file_name, CAST(0 AS BIGINT) AS turn, CAST(0 AS BIGINT) AS ord, CAST([] AS BIGINT[]) AS used, CAST(NULL AS BIGINT) AS took FROM c
  UNION ALL SELECT file_name, turn, ord, CASE WHEN took IS NULL THEN used ELSE list_append(used, took) END, took FROM (
    SELECT c.file_name, c.turn, c.ord, r.used, list_filter(c.fits, lambda t: NOT list_contains(r.used, t))[1] AS took FROM r JOIN c ON c.file_name = r.file_name AND c.turn = r.turn + 1))
SELECT file_name, ord, took AS saved_ord FROM r WHERE took IS NOT NULL""")
def match_crowded(spark, sf_dir):
    """Greedy matching in a hundred files with all boxes, in rounds over pairs."""
    b = P.crowded(spark, sf_dir)
    return B.best_iou_match(b, b.where("ord % 4 <> 3").withColumn("x", F.col("x") + F.col("ord") % 3 * 4))


@query(f"WITH {P.BOX_SQL} SELECT file_name, array_to_string(list_sort(list_distinct(list(label))), '|') AS labels FROM box GROUP BY file_name")
def label_visibility(spark, sf_dir):
    return review.visible_labels(P.boxes(spark, sf_dir))


@query(f"WITH {P.BOX_SQL} SELECT file_name, CAST(100 AS INTEGER) AS px, CAST(100 AS INTEGER) AS py, max(ord) AS ord FROM box WHERE 100 BETWEEN x AND x + w AND 100 BETWEEN y AND y + h GROUP BY file_name")
def hit_test(spark, sf_dir):
    points = P.images(spark, sf_dir).select("file_name", F.lit(100).alias("px"), F.lit(100).alias("py"))
    return review.hit_test(P.boxes(spark, sf_dir), points).drop("id")


@query(f"""WITH {P.BOX_SQL}, n AS (SELECT file_name, status, ord - 1 AS pos, count(*) OVER (PARTITION BY file_name) AS n FROM box)
SELECT file_name, min_by(pos, (pos - 1 - 1 + 10 * n) % n) AS next_pos FROM n WHERE status = 'pending' GROUP BY file_name""")
def next_pending(spark, sf_dir):
    b = P.boxes(spark, sf_dir)
    return review.next_pending(b, b.select("file_name", F.lit(1).alias("cur")).distinct())


# ---- quality ----

_AT = lambda r, c: f"a[1 + (CASE WHEN {r} < 0 THEN -({r}) WHEN {r} > 7 THEN 14 - ({r}) ELSE {r} END) * 8 + (CASE WHEN {c} < 0 THEN -({c}) WHEN {c} > 7 THEN 14 - ({c}) ELSE {c} END)]"


def _conv(kernel: dict) -> str:
    return "list_transform(range(64), lambda i: " + " + ".join(f"({w}) * {_AT(f'(i // 8 + {dr})', f'(i % 8 + {dc})')}" for (dr, dc), w in kernel.items()) + ")"


@query(f"WITH {P.RASTER_SQL} SELECT vec_id, round(list_avg(list_transform(range(48), lambda i: power(a[1 + (i // 6) * 8 + i % 6 + 2] - a[1 + (i // 6) * 8 + i % 6], 2))), 6) AS brenner FROM raster")
def raster_brenner(spark, sf_dir):
    return P.rasters(spark, sf_dir).select("vec_id", F.round(rasters.brenner(F.col("a"), 8), 6).alias("brenner"))


@query(f"WITH {P.RASTER_SQL}, c AS (SELECT vec_id, {_conv(rasters.LAPLACE)} AS c FROM raster) SELECT vec_id, round(list_var_pop(c), 6) AS laplacian_variance FROM c")
def raster_laplacian(spark, sf_dir):
    return P.rasters(spark, sf_dir).select("vec_id", F.round(rasters.laplacian_variance(F.col("a"), 8), 6).alias("laplacian_variance"))


@query(f"WITH {P.RASTER_SQL}, c AS (SELECT vec_id, {_conv(rasters.SOBEL_X)} AS gx, {_conv(rasters.SOBEL_Y)} AS gy FROM raster) SELECT vec_id, round(list_avg(list_transform(range(1, 65), lambda i: gx[i] * gx[i] + gy[i] * gy[i])), 6) AS tenengrad FROM c")
def raster_tenengrad(spark, sf_dir):
    return P.rasters(spark, sf_dir).select("vec_id", F.round(rasters.tenengrad(F.col("a"), 8), 6).alias("tenengrad"))


_BOX3 = {(r, c): 1 for r in (-1, 0, 1) for c in (-1, 0, 1)}


@query(f"""WITH {P.RASTER_SQL}, m AS (SELECT vec_id, a, {_conv(_BOX3)} AS s FROM raster), q AS (SELECT vec_id, s, o, {_conv(_BOX3)} AS s2 FROM (SELECT vec_id, a AS o, s, list_transform(a, lambda v: v * v) AS a FROM m))
SELECT vec_id, round(list_max(list_transform(range(1, 65), lambda i: abs(o[i] - s[i] / 9) / (sqrt(greatest(s2[i] / 9 - (s[i] / 9) * (s[i] / 9), 0) + 1e-6) + 1e-6))), 6) AS z_max FROM q""")
def raster_zscore(spark, sf_dir):
    return P.rasters(spark, sf_dir).select("vec_id", F.round(F.array_max(rasters.z_scores(F.col("a"), 8)), 6).alias("z_max"))


_WAVE = lambda f: f"power(list_sum(list_transform(range(64), lambda i: a[i + 1] * {f}(2 * pi() * ((k // 8 - 4) * (i // 8) + (k % 8 - 4) * (i % 8)) / 8))), 2)"


@query(f"""WITH {P.RASTER_SQL}, p AS (SELECT vec_id, list_transform(range(64), lambda k: {_WAVE('cos')} + {_WAVE('sin')}) AS p FROM raster)
SELECT vec_id, round(list_sum(list_transform(list_filter(range(64), lambda k: (k // 8 - 4) * (k // 8 - 4) + (k % 8 - 4) * (k % 8 - 4) >= 1.44), lambda k: p[k + 1])) / (list_sum(p) + 1e-8), 6) AS high_frequency_ratio FROM p""")
def raster_hf_ratio(spark, sf_dir):
    return P.rasters(spark, sf_dir).select("vec_id", F.round(rasters.high_frequency_ratio(F.col("a"), 8), 6).alias("high_frequency_ratio"))


def _metrics(spark, sf_dir):
    """Rasters as the images of ten scenes (their label), with metrics; the first of each scene stands for the output."""
    r = P.rasters(spark, sf_dir)
    m = r.select(
        F.col("label").alias("scene"), F.col("vec_id").alias("name"), F.when(F.col("vec_id") == F.min("vec_id").over(Window.partitionBy("label")), "output").otherwise("input").alias("role"), "a",
        rasters.laplacian_variance(F.col("a"), 8).alias("laplacian_variance"), rasters.tenengrad(F.col("a"), 8).alias("tenengrad"), rasters.brenner(F.col("a"), 8).alias("brenner"),
        (F.array_max("a") - F.array_min("a")).alias("high_frequency_ratio"), (F.size(F.filter("a", lambda v: v > 0)) / 64).alias("edge_density"), (F.col("vec_id") % 3 != 0).alias("registration_ok"),
    )
    return cut(quality.initial_score(m))  # scenes' sums are joined back to the rows: they are worked out once


_METRICS = f"""WITH {P.RASTER_SQL}, c AS (SELECT *, {_conv(rasters.LAPLACE)} AS lc, {_conv(rasters.SOBEL_X)} AS gx, {_conv(rasters.SOBEL_Y)} AS gy FROM raster),
b AS (SELECT label AS scene, vec_id AS name, a, CASE WHEN vec_id = min(vec_id) OVER (PARTITION BY label) THEN 'output' ELSE 'input' END AS role, list_var_pop(lc) AS lap,
  list_avg(list_transform(range(1, 65), lambda i: gx[i] * gx[i] + gy[i] * gy[i])) AS ten, list_avg(list_transform(range(48), lambda i: power(a[1 + (i // 6) * 8 + i % 6 + 2] - a[1 + (i // 6) * 8 + i % 6], 2))) AS bren,
  list_max(a) - list_min(a) AS hf, len(list_filter(a, lambda v: v > 0)) / 64 AS ed, vec_id % 3 <> 0 AS ok FROM c),
m AS (SELECT *, 0.45e0 * ln(1 + lap) + 0.30e0 * ln(1 + ten) + 0.15e0 * ln(1 + bren) + 0.10e0 * hf AS quality FROM b)"""
_NORM = lambda v: f"CASE WHEN abs(max({v}) OVER s - min({v}) OVER s) <= 1e-8 + 1e-5 * abs(max({v}) OVER s) THEN 1.0e0 ELSE ({v} - min({v}) OVER s) / (max({v}) OVER s - min({v}) OVER s) END"
_SCORED = (
    _METRICS
    + f", r AS (SELECT *, 0.30e0 * {_NORM('ln(1 + greatest(lap, 0))')} + 0.30e0 * {_NORM('ln(1 + greatest(ten, 0))')} + 0.20e0 * {_NORM('ln(1 + greatest(bren, 0))')} + 0.10e0 * {_NORM('hf')} + 0.10e0 * {_NORM('ed')} AS score FROM m WINDOW s AS (PARTITION BY scene))"
)


@query(_METRICS + " SELECT name, round(quality, 6) AS quality FROM m")
def quality_score(spark, sf_dir):
    return _metrics(spark, sf_dir).select("name", F.round("quality", 6).alias("quality"))


@query(_SCORED + " SELECT scene, name, round(score, 6) AS resolution_score FROM r")
def minmax_score(spark, sf_dir):
    return quality.resolution_scores(_metrics(spark, sf_dir)).select("scene", "name", F.round("resolution_score", 6).alias("resolution_score"))


@query(_SCORED + " SELECT scene, name, CAST(row_number() OVER (PARTITION BY scene ORDER BY round(score, 9) DESC, name) AS INTEGER) AS rank FROM r")
def quality_rank(spark, sf_dir):
    scored = quality.resolution_scores(_metrics(spark, sf_dir)).withColumn("resolution_score", F.round("resolution_score", 9))
    return quality.rank(scored).select("scene", "name", "rank")


@query(_METRICS + " SELECT name, CAST(row_number() OVER (ORDER BY round(quality, 9) DESC, name) AS INTEGER) AS rank FROM m")
def quality_rank_all(spark, sf_dir):
    """All images as one scene."""
    m = _metrics(spark, sf_dir).withColumns({"resolution_score": F.round("quality", 9), "scene": F.lit("all")})
    return quality.rank(m).select("name", "rank")


@query(_METRICS + """, a AS (SELECT scene, avg(lap) AS lap, avg(ten) AS ten FROM m WHERE role = 'input' GROUP BY scene)
SELECT m.scene AS scene, round(CASE WHEN abs(a.lap) > 1e-8 THEN 100.0e0 * (m.lap - a.lap) / a.lap END, 6) AS pct_laplacian_variance, round(CASE WHEN abs(a.ten) > 1e-8 THEN 100.0e0 * (m.ten - a.ten) / a.ten END, 6) AS pct_tenengrad
FROM m JOIN a ON a.scene = m.scene WHERE role = 'output'""")
def percent_vs_mean(spark, sf_dir):
    out = quality.percent_vs_mean(_metrics(spark, sf_dir), ("laplacian_variance", "tenengrad")).drop("name")
    return out.select("scene", *(F.round(c, 6).alias(c) for c in out.columns if c != "scene"))


@query(_METRICS + " SELECT name, round(quality, 9) AS quality FROM m ORDER BY round(quality, 9) DESC, name LIMIT 25")
def top_k(spark, sf_dir):
    m = _metrics(spark, sf_dir).select("name", F.round("quality", 9).alias("quality"))
    return quality.top_k(m, 25)


_WEIGHTED = _METRICS + ", w AS (SELECT *, greatest(quality, 1e-6) * CASE WHEN ok THEN 1.0e0 ELSE 0.25e0 END AS raw FROM m), f AS (SELECT *, raw / sum(raw) OVER (PARTITION BY scene) AS weight FROM w)"


@query(_WEIGHTED + " SELECT scene, name, round(weight, 9) AS fusion_weight FROM f")
def fusion_weights(spark, sf_dir):
    return quality.fusion_weights(_metrics(spark, sf_dir)).select("scene", "name", F.round("fusion_weight", 9).alias("fusion_weight"))


@query(_WEIGHTED + ", p AS (SELECT scene, weight, unnest(a) AS v, unnest(range(64)) AS i FROM f) SELECT scene, CAST(i AS INTEGER) AS i, round(sum(v * weight) / greatest(sum(weight), 1e-6), 6) AS value FROM p GROUP BY scene, i")
def fusion_mean(spark, sf_dir):
    w = quality.fusion_weights(_metrics(spark, sf_dir))
    return quality.fuse_pixels(w, pixels="a").withColumn("value", F.round("value", 6))
