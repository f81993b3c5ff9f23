"""The annotation store: an immutable snapshot of boxes and a log of edits, folded box by box."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from slidemill.functions.scalars import box_id, default_label, drawn_enough, maybe_label
from slidemill.operators.boxes import best_iou_match
from slidemill.plans.lineage import cut

ACTION = "struct<seq:bigint,status:string>"
BOX_COLUMNS = ["file_name", "ord", "id", "x", "y", "w", "h", "label", "status", "method", "confidence"]


def initial_boxes(images: DataFrame, annotations: DataFrame) -> DataFrame:
    """Every proposal as a pending box with its file's default label; ``images`` (id, file_name), ``annotations`` COCO rows."""
    a = annotations.join(images.select(F.col("id").alias("image_id"), "file_name"), "image_id")
    nth = F.row_number().over(Window.partitionBy("file_name").orderBy("id"))
    at = lambda i: F.get("bbox", F.lit(i))
    return a.withColumn("ord", nth.cast("long")).select(
        "file_name", "ord", box_id(F.col("file_name"), F.col("ord")).alias("id"), at(0).alias("x"), at(1).alias("y"), at(2).alias("w"), at(3).alias("h"),
        default_label(F.col("file_name")).alias("label"), F.lit("pending").alias("status"), F.coalesce("detection_method", F.lit("unknown")).alias("method"), F.coalesce("score", F.lit(0.0)).alias("confidence"),
    )


def next_bulk(points: DataFrame, bulks: DataFrame, by: list[str], name: str) -> DataFrame:
    """``points`` (``by``, ``at``) with ``name``: the first bulk action (``seq, status``) of their group after ``at``, or null.

    Points and actions are dealt together to ranges of group and ``seq``, whose bounds Spark samples, so neither a hot group nor
    an outlying ``seq`` is one task. In a range each point takes the action behind it in one pass from the end; where the range has
    none left, that of a later range, from a table of one row for each group and range. Without ``by`` all are one group.
    """
    both = points.withColumns({"_seq": F.col("at"), "_set": F.lit(None).cast(ACTION), "_point": F.lit(True)}).unionByName(
        bulks.select(*by, F.col("seq").alias("_seq"), F.struct("seq", "status").cast(ACTION).alias("_set"), F.lit(False).alias("_point")), allowMissingColumns=True
    )
    both = cut(both.repartitionByRange(*by, "_seq", "_point").withColumn("_r", F.spark_partition_id()))
    # of an action and a point of one number the action comes first, so it is not after the point
    behind = Window.partitionBy(*by, "_r").orderBy(F.desc("_seq"), F.desc("_point")).rowsBetween(Window.unboundedPreceding, -1)
    ranges = both.groupBy(*by, "_r").agg(F.min("_set").alias("_first"))
    later = Window.partitionBy(*by or [F.lit(0)]).orderBy(F.desc("_r")).rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select(*by, "_r", F.last("_first", ignorenulls=True).over(later).alias("_after"))
    here = both.withColumn(name, F.last("_set", ignorenulls=True).over(behind)).where("_point").join(ranges, [*by, "_r"], "left")
    return here.withColumn(name, F.coalesce(name, "_after")).drop("_seq", "_set", "_point", "_r", "_after")


def last_edits(edits: DataFrame) -> DataFrame:
    """Of each box ``file_name, id`` the last edit of every field, each with its own ``seq``, and the last delete.

    The largest ``seq`` of a field wins whatever the order of arrival, so this is one grouped maximum: over a log, over any
    split of it into batches, and over a stream (update mode).
    """
    own = edits.where("action in ('update', 'revert', 'delete')").withColumn("status", F.when(F.col("action") == "revert", "pending").otherwise(F.col("status")))
    own = own.select("file_name", F.col("box_id").alias("id"), "seq", "action", F.col("status").alias("_status"), F.col("label").alias("_label"), "bbox")
    return own.groupBy("file_name", "id").agg(
        F.max(F.when(F.col("_status").isNotNull(), F.struct("seq", "_status"))).alias("s"),
        F.max(F.when(F.col("_label").isNotNull(), F.struct("seq", "_label"))).alias("l"),
        F.max(F.when(F.col("bbox").isNotNull(), F.struct("seq", "bbox"))).alias("b"),
        F.max(F.when(F.col("action") == "delete", F.col("seq"))).alias("gone"),
    )


def added_boxes(edits: DataFrame) -> DataFrame:
    """Boxes of ``add`` edits: approved, manual, with the default label if they name none; ``born`` is the edit's ``seq``."""
    return edits.where("action = 'add'").select(
        "file_name", (F.lit(1_000_000_000) + F.col("seq")).alias("ord"), F.coalesce("box_id", F.substring(F.sha2(F.concat_ws("|", "file_name", F.col("seq").cast("string")), 256), 1, 8)).alias("id"),
        *(F.get("bbox", F.lit(i)).alias(c) for i, c in enumerate("xywh")), F.coalesce(F.nullif("label", F.lit("")), default_label(F.col("file_name"))).alias("label"),
        F.lit("approved").alias("status"), F.lit("manual").alias("method"), F.lit(1.0).alias("confidence"), F.col("seq").alias("born"),
    )


def bulk_actions(edits: DataFrame) -> DataFrame:
    """``seq, file_name, status`` of the bulk actions that change something; one of all files has a null or empty file name."""
    return edits.where("action = 'bulk_update' and status <> 'pending'").select("seq", F.nullif("file_name", F.lit("")).alias("file_name"), "status")


def replay(boxes: DataFrame, edits: DataFrame) -> DataFrame:
    """Boxes after all edits (``seq, action, file_name, box_id, status, label, bbox``), folded by ``seq``.

    Actions: ``update`` (any of status, label, bbox), ``add`` (approved manual box, default label if none), ``delete``,
    ``bulk_update`` (pending boxes of a file, of all files if it is null or empty) and ``revert`` (to pending). An edit of a box
    that does not exist (yet, or any more) is ignored. Each status edit makes earlier ones irrelevant, so a box needs
    only its last one and, if that leaves it pending, the first later bulk action that sets another status; nothing is
    replayed across boxes.
    """
    return settle(boxes, added_boxes(edits), last_edits(edits), bulk_actions(edits))


def settle(boxes: DataFrame, added: DataFrame, last: DataFrame, bulks: DataFrame) -> DataFrame:
    """The boxes that ``replay`` gives, from a log taken apart by ``added_boxes``, ``last_edits`` and ``bulk_actions``."""
    every = boxes.withColumn("born", F.lit(-1).cast("long")).unionByName(added)
    f = every.join(last, ["file_name", "id"], "left").where("gone is null or gone <= born")
    later = lambda c: F.when(F.col(f"{c}.seq") > F.col("born"), F.col(c))
    f = f.withColumns({c: later(c) for c in "slb"})
    f = f.withColumn("at", F.coalesce("s.seq", "born")).withColumn("status", F.coalesce("s._status", "status"))
    f = f.select("file_name", "ord", "id", *(F.coalesce(F.get("b.bbox", F.lit(i)), F.col(c)).alias(c) for i, c in enumerate("xywh")), F.coalesce("l._label", "label").alias("label"), "status", "method", "confidence", "at")
    bulk = cut(bulks)
    if not bulk.limit(1).count():
        return f.drop("at")
    f = cut(f)
    pending = f.where("status = 'pending'")
    pending = next_bulk(pending, bulk.where("file_name is not null"), ["file_name"], "one")
    pending = next_bulk(pending, bulk.where("file_name is null").drop("file_name"), [], "all")
    first = F.array_min(F.filter(F.array("one", "all"), lambda e: e.isNotNull()))
    pending = pending.withColumn("status", F.coalesce(first["status"], F.col("status"))).drop("one", "all", "at")
    return f.where("status is null or status <> 'pending'").drop("at").unionByName(pending)


def drawn(rectangles: DataFrame) -> DataFrame:
    """``add`` edits of rectangles dragged on an image: ``seq, file_name, x1, y1, x2, y2, maybe`` (any two corners).

    Sides are rounded; one of less than five pixels makes no box. With ``maybe`` the default label gets its ending.
    """
    side = lambda a, b, f: F.floor(f(F.col(a), F.col(b)) + 0.5).cast("long")
    length = lambda a, b: F.floor(F.abs(F.col(b) - F.col(a)) + 0.5).cast("long")
    r = rectangles.select("seq", "file_name", "maybe", side("x1", "x2", F.least).alias("x"), side("y1", "y2", F.least).alias("y"), length("x1", "x2").alias("w"), length("y1", "y2").alias("h"))
    base = F.lower(default_label(F.col("file_name")))
    return r.where(drawn_enough(F.col("w"), F.col("h"))).select(
        "seq", F.lit("add").alias("action"), "file_name", F.lit(None).cast("string").alias("box_id"), F.lit(None).cast("string").alias("status"), F.when(F.col("maybe"), maybe_label(base)).alias("label"), F.array("x", "y", "w", "h").alias("bbox"),
    )


def bulk_update(boxes: DataFrame, status: str, file_name: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Boxes with pending ones (of one file or all) set to ``status``, and the changed ``(file_name, id)``."""
    hit = (F.col("status") == "pending") & (F.lit(True) if file_name is None else F.col("file_name") == file_name)
    return boxes.withColumn("status", F.when(hit, status).otherwise(F.col("status"))), boxes.where(hit).select("file_name", "id")


def bulk_revert(boxes: DataFrame, changed: DataFrame) -> DataFrame:
    """Listed boxes back to pending, whatever they are now."""
    listed = changed.select("file_name", "id").distinct().withColumn("_hit", F.lit(True))
    return boxes.join(listed, ["file_name", "id"], "left").withColumn("status", F.when(F.col("_hit"), "pending").otherwise(F.col("status"))).select(boxes.columns)


def resume(boxes: DataFrame, saved: DataFrame) -> DataFrame:
    """Boxes that take status and label of the saved box they match, and unmatched manual saved boxes.

    Files that the store doesn't know are dropped; a box's place and confidence do not come back, and unmatched saved
    boxes of another method are lost.
    """
    saved = saved.join(boxes.select("file_name").distinct(), "file_name", "left_semi")
    match = best_iou_match(boxes, saved)
    s = saved.select("file_name", F.col("ord").alias("saved_ord"), F.col("status").alias("_status"), F.coalesce("label", F.lit("")).alias("_label"))
    m = match.join(s, ["file_name", "saved_ord"]).drop("saved_ord")
    out = boxes.join(m, ["file_name", "ord"], "left").withColumns({"status": F.coalesce("_status", "status"), "label": F.coalesce("_label", "label")}).select(BOX_COLUMNS)
    manual = saved.where("method = 'manual'").join(match.select("file_name", F.col("saved_ord").alias("ord")), ["file_name", "ord"], "left_anti")
    tops = boxes.groupBy("file_name").agg(F.max("ord").alias("top"))
    nth = F.row_number().over(Window.partitionBy("file_name").orderBy("ord"))
    extra = manual.join(tops, "file_name").withColumn("ord", F.col("top") + nth).select(
        "file_name", "ord", box_id(F.col("file_name"), F.col("ord")).alias("id"), "x", "y", "w", "h", F.coalesce("label", F.lit("")).alias("label"), "status", F.lit("manual").alias("method"), F.lit(1.0).alias("confidence")
    )
    return out.unionByName(extra)


def image_list(images: DataFrame, boxes: DataFrame) -> DataFrame:
    """``file_name, width, height, total_boxes, pending`` of every image, boxless ones included."""
    n = boxes.groupBy("file_name").agg(F.count(F.lit(1)).alias("total_boxes"), F.count_if(F.col("status") == "pending").alias("pending"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return images.select("file_name", "width", "height").join(n, "file_name", "left").select("file_name", zero("width"), zero("height"), zero("total_boxes"), zero("pending"))


def stats(images: DataFrame, boxes: DataFrame) -> DataFrame:
    """One row: images, boxes, approved, rejected and (everything else) pending."""
    is_ = lambda s: F.coalesce(F.sum(F.when(F.col("status") == s, 1).otherwise(0)), F.lit(0)).cast("long")
    b = boxes.agg(F.count(F.lit(1)).alias("total_boxes"), is_("approved").alias("approved"), is_("rejected").alias("rejected"))
    n = images.agg(F.count(F.lit(1)).alias("total_images")).withColumn("one", F.lit(1))
    return n.join(b.withColumn("one", F.lit(1)), "one").select("total_images", "total_boxes", "approved", "rejected", (F.col("total_boxes") - F.col("approved") - F.col("rejected")).alias("pending"))


def boxes_of(boxes: DataFrame, file_name: str) -> DataFrame:
    return boxes.where(F.col("file_name") == file_name)


def visible_labels(boxes: DataFrame) -> DataFrame:
    """Distinct labels of each image, the empty one included, sorted and joined."""
    return boxes.groupBy("file_name").agg(F.array_join(F.array_sort(F.collect_set(F.coalesce("label", F.lit("")))), "|").alias("labels"))


def hit_test(boxes: DataFrame, points: DataFrame, hidden: DataFrame | None = None, cell: int = 256) -> DataFrame:
    """For each point ``(file_name, px, py[, selected])`` the last box that holds it; boxes of hidden labels only if selected.

    A box goes to every grid cell it touches, a point to its own, and only what shares a cell meets.
    """
    p = points if "selected" in points.columns else points.withColumn("selected", F.lit(None).cast("string"))
    b = boxes.withColumn("_hidden", F.lit(False))
    if hidden is not None:
        b = boxes.join(hidden.select("file_name", "label").distinct().withColumn("_h", F.lit(True)), ["file_name", "label"], "left").withColumn("_hidden", F.coalesce("_h", F.lit(False)))
    at = lambda c: F.floor(c / cell).cast("long")
    b = b.where("w >= 0 and h >= 0").select("file_name", "ord", "id", "x", "y", "w", "h", "_hidden", F.explode(F.sequence(at(F.col("x")), at(F.col("x") + F.col("w")))).alias("_gx"))
    b = b.withColumn("_gy", F.explode(F.sequence(at(F.col("y")), at(F.col("y") + F.col("h")))))
    p = p.withColumns({"_gx": at(F.col("px")), "_gy": at(F.col("py"))})
    inside = (F.col("px") >= F.col("x")) & (F.col("px") <= F.col("x") + F.col("w")) & (F.col("py") >= F.col("y")) & (F.col("py") <= F.col("y") + F.col("h"))
    seen = ~F.col("_hidden") | (F.col("id") == F.col("selected"))
    return p.join(b, ["file_name", "_gx", "_gy"]).where(inside & F.coalesce(seen, F.lit(False))).groupBy("file_name", "px", "py").agg(F.max_by("id", "ord").alias("id"), F.max("ord").alias("ord"))


def next_pending(boxes: DataFrame, current: DataFrame, wrap: bool = True) -> DataFrame:
    """The next pending box after ``current`` (file_name, cur: a position from 0), round the end if ``wrap``."""
    at = Window.partitionBy("file_name").orderBy("ord")
    b = boxes.withColumn("pos", (F.row_number().over(at) - 1).cast("long")).withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("file_name")))
    j = b.join(current, "file_name").where("status = 'pending'")
    j = j.withColumn("step", F.pmod(F.col("pos") - F.col("cur") - 1, F.col("n")))
    if not wrap:
        j = j.where(F.col("pos") > F.col("cur"))
    return j.groupBy("file_name").agg(F.min_by("pos", "step").alias("next_pos"))
