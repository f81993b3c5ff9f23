"""The file catalogue: incremental status, content-hash duplicates, upsert, run summary."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from slidemill.functions.scalars import canonical_name
from slidemill.schemas import CATALOG_COLUMNS


def first_of_hash(files: DataFrame) -> DataFrame:
    """Adds ``is_first``: whether a row is the first of its ``image_id`` by ``raw_path``."""
    nth = F.row_number().over(Window.partitionBy("image_id").orderBy("raw_path"))
    return files.withColumn("is_first", nth == 1)


def status_rows(
    files: DataFrame, prior: DataFrame, listing: DataFrame, rehash_all: bool = False, keep_duplicates: bool = False, flat_root: str = "flat_images", hashes: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """One catalogue row with its run status for each file.

    ``files`` has ``raw_path, microscope, parasite, user, raw_filename, ext, size_bytes, mtime_epoch, content``;
    ``prior`` is the earlier catalogue (last row of a path wins beforehand), ``listing`` the ``canonical_name`` values that
    the flat folder already holds. A file whose size and time are as recorded is ``skipped_unchanged`` without its
    content being hashed; a known hash is a ``duplicate`` (of the prior catalogue, or of an earlier path of this
    run); then ``updated`` if the path was known, ``copied_exists`` if the destination is there (or just written), else
    ``new``. What changed is found from the listing alone; ``hashes`` then gives ``raw_path, image_id`` of those rows (by
    default from ``content``). With ``rehash_all`` an unchanged file meets its own recorded hash and becomes a duplicate.
    Hashes are looked up by equi-join; only the window of one hash's new files meets in a task.
    """
    known = prior.where("image_id <> ''").select("image_id").distinct().withColumn("known", F.lit(True))
    old = prior.select("raw_path", *(F.col(c).alias(f"old_{c}") for c in ("image_id", "microscope", "parasite", "user", "size_bytes", "mtime_epoch", "canonical_name", "flat_path")), F.lit(True).alias("seen"))
    if hashes is None:
        files = files.withColumn("_hash", F.sha2("content", 256))
    f = files.drop("content").join(old, "raw_path", "left").withColumn("seen", F.coalesce("seen", F.lit(False)))
    same = F.lit(not rehash_all) & F.col("seen") & (F.col("old_size_bytes") == F.col("size_bytes")) & (F.col("old_mtime_epoch") == F.col("mtime_epoch"))
    f = f.withColumn("skipped", F.coalesce(same, F.lit(False)))
    skipped = f.where("skipped").select(
        F.col("old_image_id").alias("image_id"), *(F.coalesce(f"old_{c}", c).alias(c) for c in ("microscope", "parasite", "user")),
        "raw_path", "raw_filename", F.lower("ext").alias("ext"), "size_bytes", "mtime_epoch",
        F.col("old_canonical_name").alias("canonical_name"), F.col("old_flat_path").alias("flat_path"), F.lit("skipped_unchanged").alias("status"),
    )
    work = f.where("not skipped")
    work = work.withColumnRenamed("_hash", "image_id") if hashes is None else work.join(hashes(work.select("raw_path")), "raw_path")
    work = work.withColumn("canonical_name", canonical_name(*map(F.col, ("microscope", "parasite", "user", "image_id", "ext"))))
    work = work.join(known, "image_id", "left")
    nth = F.row_number().over(Window.partitionBy("image_id").orderBy("raw_path"))
    work = work.withColumn("duplicate", F.lit(False) if keep_duplicates else F.coalesce("known", F.lit(False)) | (nth > 1))
    work = work.join(listing.select("canonical_name").distinct().withColumn("there", F.lit(True)), "canonical_name", "left")
    copied = F.row_number().over(Window.partitionBy("canonical_name", "duplicate").orderBy("raw_path"))
    work = work.withColumn(
        "status",
        F.when(F.col("duplicate"), "duplicate").when(F.col("seen"), "updated").when(F.coalesce("there", F.lit(False)) | (copied > 1), "copied_exists").otherwise("new"),
    ).withColumn("flat_path", F.concat(F.lit(f"{flat_root}/"), "canonical_name")).withColumn("ext", F.lower("ext"))
    return skipped.select(CATALOG_COLUMNS).unionByName(work.select(CATALOG_COLUMNS))


def upsert(prior: DataFrame, run: DataFrame) -> DataFrame:
    """The catalogue after a run: rows of skipped and of vanished files stay as they were, others are replaced."""
    fresh = run.where("status <> 'skipped_unchanged'")
    return prior.select(CATALOG_COLUMNS).join(fresh.select("raw_path"), "raw_path", "left_anti").select(CATALOG_COLUMNS).unionByName(fresh.select(CATALOG_COLUMNS))


def run_summary(run: DataFrame) -> DataFrame:
    return run.groupBy("status").agg(F.count(F.lit(1)).alias("files"))


def not_processed(files: DataFrame, processed: DataFrame, force: bool = False) -> DataFrame:
    """Files whose base name no processed image has; all of them with ``force``."""
    return files if force else files.join(processed.select("file_name"), "file_name", "left_anti")
