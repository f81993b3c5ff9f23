"""Sharpness scores: normalisation, ranking, summaries, fusion weights and weighted means."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slidemill.functions.scalars import percent_delta, quality_score
from slidemill.operators.exports import dense_ids
from slidemill.plans.lineage import few
from slidemill.schemas import METRICS

# Weight of each metric and whether its logarithm is taken.
WEIGHTS = {"laplacian_variance": (0.30, True), "tenengrad": (0.30, True), "brenner": (0.20, True), "high_frequency_ratio": (0.10, False), "edge_density": (0.10, False)}


def initial_score(df: DataFrame) -> DataFrame:
    return df.withColumn("quality", quality_score(F.col("laplacian_variance"), F.col("tenengrad"), F.col("brenner"), F.col("high_frequency_ratio")))


def min_max(value: Column, low: Column, high: Column) -> Column:
    """Place of a value between the least and the largest; 1 where those are (nearly) equal."""
    return F.when(F.abs(high - low) <= 1e-8 + 1e-5 * F.abs(high), F.lit(1.0)).otherwise((value - low) / (high - low))


def resolution_scores(rows: DataFrame, scene: str = "scene") -> DataFrame:
    """``resolution_score`` of each row within its scene: extremes are grouped first and joined back, so no scene is one task."""
    value = lambda m: F.log1p(F.greatest(F.col(m), F.lit(0.0))) if WEIGHTS[m][1] else F.col(m)
    ends = rows.groupBy(scene).agg(*(f(value(m)).alias(f"{n}_{m}") for m in METRICS for n, f in (("lo", F.min), ("hi", F.max))))
    out = rows.join(ends, scene)
    score = sum((w * min_max(value(m), F.col(f"lo_{m}"), F.col(f"hi_{m}")) for m, (w, _) in WEIGHTS.items()), F.lit(0.0))
    return out.withColumn("resolution_score", score).drop(*(f"{n}_{m}" for m in METRICS for n in ("lo", "hi")))


def rank(rows: DataFrame, by: str = "resolution_score", scene: str = "scene", tie: str = "name") -> DataFrame:
    """``rank`` in each scene, from 1. All rows are numbered in one order, range by range, and a scene's first number is taken off: no scene is one window."""
    numbered = dense_ids(rows, [scene, F.desc(by), tie], "_n")
    first = few(numbered.groupBy(scene).agg(F.min("_n").alias("_first")))
    return numbered.join(first, scene).withColumn("rank", (F.col("_n") - F.col("_first") + 1).cast("int")).drop("_n", "_first")


def top_k(rows: DataFrame, k: int | None, by: str = "quality", tie: str = "name") -> DataFrame:
    """The k best rows; all of them without a k."""
    return rows if k is None else rows.orderBy(F.desc(by), tie).limit(k)


def percent_vs_mean(rows: DataFrame, metrics=METRICS, scene: str = "scene") -> DataFrame:
    """Each output row's metrics as percent above the mean of its scene's inputs, null where that is about 0."""
    means = rows.where("role = 'input'").groupBy(scene).agg(*(F.avg(m).alias(f"mean_{m}") for m in metrics))
    out = rows.where("role = 'output'").join(means, scene)
    return out.select(scene, "name", *(percent_delta(F.col(m), F.col(f"mean_{m}")).alias(f"pct_{m}") for m in metrics))


def best_input(rows: DataFrame, scene: str = "scene") -> DataFrame:
    """The input of best score (then first name) of each scene, by a partial minimum."""
    order, row = F.struct((-F.col("resolution_score")).alias("s"), "name"), F.struct(*rows.columns)
    return rows.where("role = 'input'").groupBy(F.col(scene).alias("_scene")).agg(F.min_by(row, order).alias("r")).select("r.*")


def fusion_weights(rows: DataFrame, scene: str = "scene") -> DataFrame:
    """Weight of each image in its scene: score (1e-6 at least), a quarter of it if unregistered, over the scene's sum."""
    w = rows.withColumn("_w", F.greatest("quality", F.lit(1e-6)) * F.when(F.col("registration_ok"), 1.0).otherwise(0.25))
    total = w.groupBy(scene).agg(F.sum("_w").alias("_t"))
    return w.join(total, scene).withColumn("fusion_weight", F.col("_w") / F.when(F.col("_t") == 0, 1.0).otherwise(F.col("_t"))).drop("_w", "_t")


def fuse_pixels(rows: DataFrame, scene: str = "scene", pixels: str = "data") -> DataFrame:
    """Weighted mean of every pixel of a scene, for rasters already aligned: ``scene, i, value``."""
    px = rows.select(scene, "fusion_weight", F.posexplode(pixels).alias("i", "v"))
    total = px.groupBy(scene, "i").agg(F.sum(F.col("v").cast("double") * F.col("fusion_weight")).alias("s"), F.sum("fusion_weight").alias("w"))
    return total.select(scene, "i", (F.col("s") / F.greatest("w", F.lit(1e-6))).alias("value"))


def summary(rows: DataFrame, scene: str = "scene") -> DataFrame:
    """One JSON text for each scene: count, best input, mean input metrics, output gains, ranking."""
    inputs = rows.where("role = 'input'")
    best = best_input(rows, scene).select(scene, F.col("name").alias("best_input"))
    means = inputs.groupBy(scene).agg(F.count(F.lit(1)).alias("input_count"), *(F.avg(m).alias(f"mean_{m}") for m in (*METRICS, "resolution_score")))
    ranking = rank(rows, scene=scene).groupBy(scene).agg(F.array_sort(F.collect_list(F.struct("rank", "name", "role", "resolution_score"))).alias("ranking"))
    gains = percent_vs_mean(rows, (*METRICS, "resolution_score"), scene).drop("name")
    joined = means.join(best, scene, "left").join(gains, scene, "left").join(ranking, scene)
    return joined.select(scene, F.to_json(F.struct(*(c for c in joined.columns if c != scene))).alias("value"))
