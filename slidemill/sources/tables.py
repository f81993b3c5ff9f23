"""Tables whose partitions are replaced whole, and heads that name what is current."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slidemill.operators import catalog
from slidemill.plans.lineage import cut
from slidemill.schemas import CATALOG, CATALOG_COLUMNS


def stored(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table of Parquet files, empty before its first row."""
    try:
        df = spark.read.schema(schema).parquet(path)
        df.schema  # noqa: B018  resolves the path
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)
    return df


def replace(df: DataFrame, path: str, by: list[str]) -> None:
    """Write rows, overwriting just the partitions ``by`` that they have; files appear when the whole job commits."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


CATALOG_ROWS = CATALOG + ", version bigint"
HEADS = "parasite string, version bigint"


def catalog_table(spark: SparkSession, store: str) -> DataFrame:
    """The catalogue kept below ``store``: of each parasite the rows of the version that its newest head names."""
    current = stored(spark, f"{store}/heads", HEADS).groupBy("parasite").agg(F.max("version").alias("version"))
    return stored(spark, f"{store}/rows", CATALOG_ROWS).join(F.broadcast(current), ["parasite", "version"]).select(CATALOG_COLUMNS)  # a row for each parasite


def update_catalog(spark: SparkSession, store: str, run: DataFrame) -> DataFrame:
    """The catalogue after a run, in place: only parasites with changed files are read and written again, as a new version.

    Their heads are written last, in one file, so a run that is lost before leaves the old version current, and the next one replaces what it
    left. Rows of skipped and of vanished files stay; a path keeps its parasite, since that is a part of it.
    """
    fresh = cut(run.where("status <> 'skipped_unchanged'").select(CATALOG_COLUMNS))
    touched = fresh.select("parasite").distinct()
    version = (stored(spark, f"{store}/heads", HEADS).agg(F.max("version")).first()[0] or 0) + 1
    old = catalog_table(spark, store).join(F.broadcast(touched), "parasite", "left_semi")
    replace(catalog.upsert(old, fresh).withColumn("version", F.lit(version).cast("long")), f"{store}/rows", ["parasite", "version"])
    touched.select("parasite", F.lit(version).cast("long").alias("version")).coalesce(1).write.mode("append").parquet(f"{store}/heads")
    return catalog_table(spark, store)
