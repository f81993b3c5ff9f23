"""Live forms: files as they arrive, edits folded as they are made, catalogues and reviews kept in tables of batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from slidemill.functions.scalars import file_name, has_extension, suffix, triplet
from slidemill.operators import catalog, review
from slidemill.plans.lineage import cut
from slidemill.schemas import CATALOG, CATALOG_COLUMNS, EDIT, EXTENSIONS
from slidemill.sources.tables import replace, stored


def new_files(spark: SparkSession, folder: str, command: str = "db") -> DataFrame:
    """A stream of image files, each once; run with the trigger ``availableNow`` it is an incremental batch."""
    schema = "path string, modificationTime timestamp, length bigint, content binary"
    f = spark.readStream.format("binaryFile").schema(schema).option("recursiveFileLookup", "true").load(folder)
    return f.withColumn("file_name", file_name(F.col("path"))).where(has_extension(F.col("file_name"), EXTENSIONS[command]))


def edit_log(spark: SparkSession, folder: str) -> DataFrame:
    return spark.readStream.schema(EDIT).json(folder)


def fold_edits(edits: DataFrame) -> DataFrame:
    """The last edit of every field of each box so far (``review.last_edits``), a row whenever one changes (update mode).

    Fields keep their own ``seq``, so rows may come late and in any order; an edit made before its box was added is told by its
    ``seq`` when ``review.settle`` meets the added boxes.
    """
    return review.last_edits(edits)


# ---- a review as a table of batches ----


LOG = EDIT.replace("array<int>", "array<bigint>") + ", span bigint, batch bigint"
#: Edits of one folder of the log: a reader of the tail skips the folders before it.
SPAN = 1_000_000


def record(edits: DataFrame, store: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Keep a stream of edits below ``store/log``, by span of ``seq`` and batch; a batch that runs again replaces itself."""

    def keep(batch: DataFrame, number: int) -> None:
        rows = batch.withColumns({"bbox": F.col("bbox").cast("array<bigint>"), "span": F.expr(f"seq div {SPAN}"), "batch": F.lit(number).cast("long")})
        replace(rows, f"{store}/log", ["span", "batch"])

    return edits.writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint).trigger(**trigger or {"availableNow": True}).start()


def log_after(spark: SparkSession, store: str, seq: int, files: list[str] | None = None) -> DataFrame:
    """Recorded edits behind ``seq``; whole spans before it are not listed for reading. With ``files`` only theirs and bulk actions of all."""
    log = stored(spark, f"{store}/log", LOG).where((F.col("span") >= (seq // SPAN)) & (F.col("seq") > seq)).drop("span", "batch")
    return log if files is None else log.where(F.col("file_name").isin(files) | F.col("file_name").isNull() | (F.col("file_name") == ""))


SNAPSHOT = "file_name string, ord bigint, id string, x bigint, y bigint, w bigint, h bigint, label string, status string, method string, confidence double, upto bigint"


def _upto(spark: SparkSession, store: str) -> int | None:
    """The ``seq`` of the newest whole snapshot: its row in ``heads`` is written after its boxes."""
    return stored(spark, f"{store}/heads", "upto bigint").agg(F.max("upto")).first()[0]


def current(spark: SparkSession, boxes: DataFrame, store: str, files: list[str] | None = None) -> DataFrame:
    """The boxes of a recorded review: its newest snapshot (``boxes`` before the first) and the edits behind it.

    With ``files`` only those are read: snapshots are sorted by file, so the others are skipped by their statistics.
    """
    upto = _upto(spark, store)
    held = boxes.select(review.BOX_COLUMNS) if upto is None else stored(spark, f"{store}/snapshots", SNAPSHOT).where(F.col("upto") == upto).drop("upto")
    held = held if files is None else held.where(F.col("file_name").isin(files))
    return review.replay(held, log_after(spark, store, -1 if upto is None else upto, files))


def compact(spark: SparkSession, boxes: DataFrame, store: str, upto: int) -> DataFrame:
    """Fold the edits up to ``upto`` (which must all have been recorded) into a new snapshot; the log and older snapshots stay as they are.

    Edits behind ``upto`` meet the boxes that were alive at it, so snapshot and tail give what the whole log gives. A run that is
    lost leaves boxes that no head names, and the next one replaces them.
    """
    before = _upto(spark, store)
    if before is not None and before >= upto:
        return current(spark, boxes, store)
    held = boxes.select(review.BOX_COLUMNS) if before is None else stored(spark, f"{store}/snapshots", SNAPSHOT).where(F.col("upto") == before).drop("upto")
    now = review.replay(held, log_after(spark, store, -1 if before is None else before).where(F.col("seq") <= upto))
    rows = now.withColumns({c: F.col(c).cast("long") for c in ("ord", "x", "y", "w", "h")} | {"upto": F.lit(upto).cast("long")})
    replace(rows.repartitionByRange("file_name", "ord").sortWithinPartitions("file_name", "ord"), f"{store}/snapshots", ["upto"])
    spark.range(1).select(F.lit(upto).cast("long").alias("upto")).write.mode("append").parquet(f"{store}/heads")
    return current(spark, boxes, store)


# ---- a catalogue as a table of batches ----

CATALOG_LOG = CATALOG + ", batch bigint"


def catalogue(spark: SparkSession, store: str, before: int | None = None) -> DataFrame:
    """The catalogue of an ingested folder: of each path the row of its last batch (before ``before``, if given)."""
    rows = stored(spark, store, CATALOG_LOG)
    rows = rows if before is None else rows.where(F.col("batch") < before)
    newest = rows.groupBy("raw_path").agg(F.max_by(F.struct(*(c for c in CATALOG_COLUMNS if c != "raw_path")), "batch").alias("r"))
    return newest.select("raw_path", "r.*").select(CATALOG_COLUMNS)


def ingest(spark: SparkSession, raw_root: str, store: str, checkpoint: str, flat_root: str = "flat_images", **trigger) -> StreamingQuery:
    """Catalogue files as they arrive: each batch meets the catalogue of the batches before it and adds its changed rows.

    A batch writes its own partition only and looks at earlier ones only, so one that runs again leaves the same rows, and its work
    grows with the new files and the catalogue's hashes. A file that changes in place under its name counts as seen by the
    source; paths too shallow for microscope, parasite and user are left out.
    """
    root = F.lit(raw_root.rstrip("/").removeprefix("file:") + "/")

    def step(batch: DataFrame, number: int) -> None:
        f = batch.withColumn("raw_path", F.regexp_replace("path", r"^file:/+", "/")).withColumn("t", triplet(F.replace(F.col("raw_path"), root, F.lit("")), False)).where("t is not null")
        f = f.select("t.microscope", "t.parasite", "t.user", "raw_path", F.col("file_name").alias("raw_filename"), suffix(F.col("file_name")).alias("ext"), F.col("length").alias("size_bytes"), F.unix_timestamp("modificationTime").alias("mtime_epoch"), F.sha2("content", 256).alias("content"))
        f = cut(f)  # contents are hashed once and go no further
        prior = catalogue(spark, store, number)
        hashes = lambda paths: paths.join(f.select("raw_path", F.col("content").alias("image_id")), "raw_path")
        run = catalog.status_rows(f, prior, prior.select("canonical_name"), flat_root=flat_root, hashes=hashes)
        replace(run.where("status <> 'skipped_unchanged'").withColumn("batch", F.lit(number).cast("long")), store, ["batch"])

    return new_files(spark, raw_root).writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(**trigger or {"availableNow": True}).start()
