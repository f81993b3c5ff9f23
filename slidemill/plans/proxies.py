"""Bindings of the operators to the driver's tables, in Spark and as SQL text of the same meaning."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from slidemill.functions.scalars import box_id, canonical_name, default_label


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as raw files."""
    user = F.concat(F.lit("user_"), (F.col("doc_id") % 7).cast("string"))
    name = F.concat(F.lit("img_"), F.col("doc_id").cast("string"), F.lit(".PNG"))
    return table(spark, sf_dir, "documents").select(
        F.col("source").alias("microscope"), F.col("lang").alias("parasite"), user.alias("user"), F.concat_ws("/", F.lit("/data/raw"), "source", "lang", user, name).alias("raw_path"),
        name.alias("raw_filename"), F.lit(".PNG").alias("ext"), F.length("text").cast("long").alias("size_bytes"), F.col("doc_id").alias("mtime_epoch"), F.col("text").alias("content"), "doc_id",
    )


def prior(f: DataFrame) -> DataFrame:
    """An earlier catalogue: two thirds of the files, some with another size or hash."""
    d = F.col("doc_id")
    image_id = F.when(d % 14 == 0, F.sha2(F.concat(F.lit("old"), "content"), 256)).otherwise(F.sha2("content", 256))
    p = f.where(d % 3 != 0).withColumn("image_id", image_id).withColumn("size_bytes", F.when(d % 7 == 0, F.col("size_bytes") + 1).otherwise(F.col("size_bytes")))
    p = p.withColumn("canonical_name", canonical_name(*map(F.col, ("microscope", "parasite", "user", "image_id", "ext"))))
    return p.select("image_id", "microscope", "parasite", "user", "raw_path", "raw_filename", F.lower("ext").alias("ext"), "size_bytes", "mtime_epoch", "canonical_name", F.concat(F.lit("flat_images/"), "canonical_name").alias("flat_path"), F.lit("new").alias("status"))


def listing(f: DataFrame) -> DataFrame:
    hashed = f.where(F.col("doc_id") % 5 == 0).withColumn("image_id", F.sha2("content", 256))
    return hashed.select(canonical_name(*map(F.col, ("microscope", "parasite", "user", "image_id", "ext"))).alias("canonical_name"))


LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
METHODS = ["pink_stain", "contrast_t25", "edge_density", "dark_object", "anomaly_k31_z2.0", "manual", "red_stain"]


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as boxes of their order's image."""
    nth = F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*LINE_ORDER))
    n, lab = F.col("l_linenumber"), F.col("l_returnflag")
    b = table(spark, sf_dir, "lineitem").withColumn("ord", nth.cast("long"))
    b = b.select(
        F.col("l_orderkey").alias("image_id"), "ord", (F.floor("l_extendedprice") % 200).cast("long").alias("x"), ((F.col("l_partkey") * 7) % 200).cast("long").alias("y"),
        (F.floor("l_quantity") + 10).cast("long").alias("w"), (F.col("l_suppkey") % 40 + 10).cast("long").alias("h"),
        F.when(n % 4 == 0, 0.7).when(n % 4 == 1, 0.6).when(n % 4 == 2, 0.5).otherwise(0.4).alias("confidence"), F.get(F.array(*map(F.lit, METHODS)), n - 1).alias("method"),
        F.when(n % 3 == 0, "approved").when(n % 3 == 1, "rejected").otherwise("pending").alias("status"),
        F.when(lab == "A", "ascaris").when(lab == "N", F.when(n % 2 == 0, "noise").otherwise("Noise")).otherwise("").alias("label"), file_of(F.col("l_orderkey")).alias("file_name"),
    )
    return b.withColumn("id", box_id(F.col("file_name"), F.col("ord")))


def crowded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The boxes as those of a hundred wide images."""
    key = F.col("image_id")
    return boxes(spark, sf_dir).select(
        (key % 100).alias("image_id"), F.concat(F.lit("crowd_"), (key % 100).cast("string"), F.lit(".png")).alias("file_name"), (key * 1000 + F.col("ord")).alias("ord"),
        (F.col("x") + key * 37 % 1800).alias("x"), (F.col("y") + key * 53 % 1900).alias("y"), "w", "h", "confidence",
    )


def file_of(key):
    return F.concat(F.lit("lab__sp_"), (key % 5).cast("string"), F.lit("__"), key.cast("string"), F.lit(".png"))


def images(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(o.alias("image_id"), file_of(o).alias("file_name"), (1024 + o % 900).alias("width"), (1024 + F.col("o_custkey") % 700).alias("height"), F.col("o_orderkey").alias("id"))


def rasters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select("vec_id", "label", F.transform("embedding", lambda v: v.cast("double")).alias("a"))


def edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as edits of one box for each user."""
    t, v = F.col("event_type"), F.get_json_object("props", "$.k")
    status = F.when(t == "click", "approved").when(t == "error", "rejected").when(t == "view", "pending").when(t == "signup", "approved")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("seq"), F.when(t == "signup", "bulk_update").otherwise("update").alias("action"), F.when(t != "signup", F.lit("store")).alias("file_name"),
        F.when(t != "signup", F.col("user_id").cast("string")).alias("box_id"), status.alias("status"), F.when(t == "purchase", F.concat(F.lit("k"), v)).alias("label"), F.lit(None).cast("array<bigint>").alias("bbox"),
    )


def all_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as edits of every kind: deleted and added boxes, edits of boxes not there yet, bulk actions of one file or all."""
    t, i, none = F.col("event_type"), F.col("event_id"), F.lit(None).cast("string")
    action = F.when(t == "signup", "bulk_update").when(t == "view", "revert").when((t == "click") & (i % 29 == 0), "delete").when((t == "purchase") & (i % 4 == 0), "add").otherwise("update")
    status = F.when(t == "signup", F.when(i % 3 == 0, "pending").when(i % 3 == 1, "approved").otherwise("rejected")).when((t == "click") & (i % 29 != 0), "approved").when(t == "error", "rejected")
    box = F.when(t == "purchase", F.concat(F.lit("n"), (i - i % 4 + F.when(i % 4 == 0, 0).otherwise(i % 8)).cast("string"))).when(t != "signup", F.col("user_id").cast("string"))
    return table(spark, sf_dir, "events").select(
        i.alias("seq"), action.alias("action"), F.when((t != "signup") | (i % 2 == 1), "store").alias("file_name"), box.alias("box_id"), status.alias("status"),
        F.when(t == "purchase", F.concat(F.lit("k"), F.get_json_object("props", "$.k"))).otherwise(none).alias("label"), F.when(action == "add", F.array(i, i, F.lit(5).cast("long"), F.lit(6).cast("long"))).alias("bbox"),
    )


def edit_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = table(spark, sf_dir, "events").select("user_id").distinct()
    zero = F.lit(0).cast("long")
    return users.select(
        F.lit("store").alias("file_name"), F.col("user_id").alias("ord"), F.col("user_id").cast("string").alias("id"), zero.alias("x"), zero.alias("y"), zero.alias("w"), zero.alias("h"),
        default_label(F.lit("store")).alias("label"), F.lit("pending").alias("status"), F.lit("pink_stain").alias("method"), F.lit(0.7).alias("confidence"),
    )


# The same bindings as SQL.
TOKEN = lambda c: f"lower(regexp_replace(trim({c}), '[^A-Za-z0-9_.-]', '_', 'g'))"
CANON = lambda h: f"{TOKEN('microscope')} || '__' || {TOKEN('parasite')} || '__' || {TOKEN(chr(34) + 'user' + chr(34))} || '__' || substr({h}, 1, 12) || '.png'"
FILE_SQL = """file AS (SELECT *, '/data/raw/' || microscope || '/' || parasite || '/' || "user" || '/' || raw_filename AS raw_path, sha256(content) AS h FROM (
  SELECT source AS microscope, lang AS parasite, 'user_' || (doc_id % 7) AS "user", 'img_' || doc_id || '.PNG' AS raw_filename, CAST(length(text) AS BIGINT) AS size_bytes, doc_id AS mtime_epoch, text AS content, doc_id FROM documents))"""
PRIOR_SQL = f"""prior AS (SELECT *, {CANON('image_id')} AS canonical_name FROM (
  SELECT microscope, parasite, "user", raw_path, raw_filename, mtime_epoch, CASE WHEN doc_id % 14 = 0 THEN sha256('old' || content) ELSE h END AS image_id, CASE WHEN doc_id % 7 = 0 THEN size_bytes + 1 ELSE size_bytes END AS size_bytes FROM file WHERE doc_id % 3 <> 0))"""
STATUS_SQL = f"""WITH {FILE_SQL}, {PRIOR_SQL},
listing AS (SELECT DISTINCT {CANON('h')} AS canonical_name FROM file WHERE doc_id % 5 = 0),
j AS (SELECT f.*, p.raw_path IS NOT NULL AS seen, coalesce(p.size_bytes = f.size_bytes AND p.mtime_epoch = f.mtime_epoch, false) AS skipped, p.image_id AS old_id, p.canonical_name AS old_name FROM file f LEFT JOIN prior p USING (raw_path)),
w AS (SELECT *, {CANON('h')} AS cn, h IN (SELECT image_id FROM prior) OR row_number() OVER (PARTITION BY h ORDER BY raw_path) > 1 AS dup FROM j WHERE NOT skipped),
v AS (SELECT *, row_number() OVER (PARTITION BY cn, dup ORDER BY raw_path) AS nth FROM w),
run AS (SELECT old_id AS image_id, microscope, parasite, "user", raw_path, raw_filename, size_bytes, mtime_epoch, old_name AS canonical_name, 'skipped_unchanged' AS status FROM j WHERE skipped
  UNION ALL SELECT h, microscope, parasite, "user", raw_path, raw_filename, size_bytes, mtime_epoch, cn, CASE WHEN dup THEN 'duplicate' WHEN seen THEN 'updated' WHEN cn IN (SELECT canonical_name FROM listing) OR nth > 1 THEN 'copied_exists' ELSE 'new' END FROM v)"""
_METHOD = "CASE l_linenumber " + " ".join(f"WHEN {i + 1} THEN '{m}'" for i, m in enumerate(METHODS)) + " END"
FILE_OF = lambda k: f"'lab__sp_' || ({k} % 5) || '__' || {k} || '.png'"
BOX_SQL = f"""box AS (SELECT *, substr(sha256(file_name || '|' || ord), 1, 8) AS id FROM (SELECT l_orderkey AS image_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY {', '.join(LINE_ORDER)}) AS ord,
  CAST(floor(l_extendedprice) AS BIGINT) % 200 AS x, (l_partkey * 7) % 200 AS y, CAST(floor(l_quantity) AS BIGINT) + 10 AS w, l_suppkey % 40 + 10 AS h,
  CASE l_linenumber % 4 WHEN 0 THEN 0.7e0 WHEN 1 THEN 0.6e0 WHEN 2 THEN 0.5e0 ELSE 0.4e0 END AS confidence, {_METHOD} AS method,
  CASE l_linenumber % 3 WHEN 0 THEN 'approved' WHEN 1 THEN 'rejected' ELSE 'pending' END AS status,
  CASE WHEN l_returnflag = 'A' THEN 'ascaris' WHEN l_returnflag = 'N' THEN CASE WHEN l_linenumber % 2 = 0 THEN 'noise' ELSE 'Noise' END ELSE '' END AS label, {FILE_OF('l_orderkey')} AS file_name FROM lineitem))"""
CROWD_SQL = f"{BOX_SQL}, crowd AS (SELECT image_id % 100 AS image_id, 'crowd_' || (image_id % 100) || '.png' AS file_name, image_id * 1000 + ord AS ord, x + image_id * 37 % 1800 AS x, y + image_id * 53 % 1900 AS y, w, h, confidence FROM box)"
IMG_SQL = f"img AS (SELECT o_orderkey AS image_id, {FILE_OF('o_orderkey')} AS file_name, 1024 + o_orderkey % 900 AS width, 1024 + o_custkey % 700 AS height FROM orders)"
ALL_EDITS_SQL = """e AS (SELECT event_id AS seq,
  CASE WHEN event_type = 'signup' THEN 'bulk_update' WHEN event_type = 'view' THEN 'revert' WHEN event_type = 'click' AND event_id % 29 = 0 THEN 'delete' WHEN event_type = 'purchase' AND event_id % 4 = 0 THEN 'add' ELSE 'update' END AS action,
  CASE WHEN event_type <> 'signup' OR event_id % 2 = 1 THEN 'store' END AS file_name,
  CASE WHEN event_type = 'purchase' THEN 'n' || (event_id - event_id % 4 + CASE WHEN event_id % 4 = 0 THEN 0 ELSE event_id % 8 END) WHEN event_type <> 'signup' THEN CAST(user_id AS VARCHAR) END AS id,
  CASE WHEN event_type = 'signup' THEN CASE event_id % 3 WHEN 0 THEN 'pending' WHEN 1 THEN 'approved' ELSE 'rejected' END WHEN event_type = 'view' THEN 'pending' WHEN event_type = 'click' AND event_id % 29 <> 0 THEN 'approved' WHEN event_type = 'error' THEN 'rejected' END AS status,
  CASE WHEN event_type = 'purchase' THEN 'k' || (props ->> '$.k') END AS label FROM events)"""
RASTER_SQL = "raster AS (SELECT vec_id, label, list_transform(embedding, lambda v: CAST(v AS DOUBLE)) AS a FROM embeddings)"
