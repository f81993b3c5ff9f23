"""Text quality by naive Bayes support vectors: log-count-ratio n-grams under a linear hinge loss."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slidemill.llm.common import fit_logistic, fold, labelled, slices, trimmed
from slidemill.llm.jaccard import _mix

BITS = 17  # hashed n-grams: 131,072, whatever the input
BINS = 40

# byte classes: 0 blank, 1 lower case, 2 upper case, 3 digit, 4 beyond ASCII, 5 sentence marks, 6 other signs
_CLASS = np.full(256, 6, np.uint8)
_CLASS[[9, 10, 11, 12, 13, 32]] = 0
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[128:] = 1, 2, 3, 4
_CLASS[[33, 39, 44, 45, 46, 58, 59, 63]] = 5


def _buckets(codes: np.ndarray, order: int, salt: int) -> np.ndarray:
    """Hashed n-grams of a code sequence."""
    if len(codes) < order:
        return np.empty(0, np.int64)
    h = np.full(len(codes) - order + 1, salt, np.uint64)
    for i in range(order):
        h = h * np.uint64(0x9E3779B97F4A7C15) + codes[i : len(codes) - order + 1 + i]
    return (_mix(h) >> np.uint64(64 - BITS)).astype(np.int64)


def ngrams(text: str | None, scratch: np.ndarray) -> np.ndarray:
    """Distinct hashed n-grams of a text: 2 and 3 characters, and 1 to 3 word shapes.

    A word's shape tells how it starts and ends, whether its letters are all upper case, whether it holds signs, its
    length class and whether it repeats one of the two words before it. ``scratch`` has a place for each bucket;
    what it holds before does not matter.
    """
    b = np.frombuffer((text or "").encode(), np.uint8)
    if not len(b):
        return np.empty(0, np.int64)
    wide = b.astype(np.uint64)
    kinds = _CLASS[b]
    solid = kinds > 0
    edge = np.flatnonzero(np.diff(solid, prepend=False, append=False))
    starts, ends = edge[::2], edge[1::2]
    found = [_buckets(wide, 2, 1), _buckets(wide, 3, 2)]
    if len(starts):
        at = np.arange(len(b))
        at[starts[0] :] -= np.repeat(starts, np.diff(starts, append=len(b)))
        body = np.add.reduceat(np.where(solid, _mix(wide + at.astype(np.uint64) * np.uint64(1024) + np.uint64(1)), 0), starts)
        same = np.zeros(len(starts), np.uint64)
        same[1:] |= body[1:] == body[:-1]
        same[2:] |= (body[2:] == body[:-2]).astype(np.uint64) << np.uint64(1)
        lower, sign = np.add.reduceat((kinds == 1).astype(np.int64), starts) > 0, np.add.reduceat((kinds == 6).astype(np.int64), starts) > 0
        length = np.minimum(np.log2(ends - starts + 1).astype(np.uint64), 7)
        shape = kinds[starts].astype(np.uint64) + 8 * kinds[ends - 1].astype(np.uint64) + 64 * lower.astype(np.uint64) + 128 * sign.astype(np.uint64) + 256 * same + 1024 * length
        found += [_buckets(shape, n, 2 + n) for n in (1, 2, 3)]
        size = np.array([min(int(np.log2(len(starts))), 15)], np.uint64)
        found.append(_buckets(size, 1, 9))
    ids = np.concatenate(found)
    nth = np.arange(len(ids))
    scratch[ids] = nth
    return ids[scratch[ids] == nth]


def dual_coordinate_descent(rows: list[np.ndarray], ratio: np.ndarray, y: np.ndarray, cost: float = 1.0, epochs: int = 12, seed: int = 5) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear support vector machine (hinge loss, box ``cost``) over scaled indicators.

    Each row's indicators are multiplied by ``ratio`` and brought to length one; dual variables are solved one by
    one in seeded order, with the weights kept up to date. Classes weigh as much as each other.
    """
    rng = np.random.default_rng(seed)
    w, bias = np.zeros(len(ratio)), 0.0
    norms = np.array([max(float(np.sqrt((ratio[r] ** 2).sum())), 1e-9) for r in rows])
    sign = np.where(y == 1, 1.0, -1.0)
    share = max((y == 1).mean(), 1e-9), max((y == 0).mean(), 1e-9)
    top = np.where(y == 1, cost / (2 * share[0]), cost / (2 * share[1]))
    alpha = np.zeros(len(rows))
    for _ in range(epochs):
        most = 0.0
        for i in rng.permutation(len(rows)):
            r = rows[i]
            x = ratio[r] / norms[i]
            gradient = sign[i] * (w[r] @ x + bias) - 1
            new = min(max(alpha[i] - gradient / 2, 0.0), top[i])  # x and the bias term have length one each
            if new != alpha[i]:
                step = (new - alpha[i]) * sign[i]
                w[r] += step * x
                bias += step
                most = max(most, abs(new - alpha[i]))
                alpha[i] = new
        if most < 1e-3:
            break
    return w, bias


def log_count_ratios(rows: DataFrame, alpha: float = 1.0) -> np.ndarray:
    """For each n-gram bucket, the log of its share of the rows' n-grams under label 1 over that under label 0, ``alpha`` added to counts."""
    size = 1 << BITS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, scratch = np.zeros((2, size), np.int64), np.zeros(size, np.int64)
        for batch in slices(batches):
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                seen[y, ngrams(text, scratch)] += 1
        y, b = np.nonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(y, pa.int32()), pa.array(b, pa.int32()), pa.array(seen[y, b], pa.int64())], ["y", "bucket", "n"])

    sums = rows.select("text", "y").mapInArrow(trimmed(count), "y int, bucket int, n long").groupBy("y", "bucket").agg(F.sum("n").alias("n")).toArrow()
    seen = np.full((2, size), alpha)
    seen[sums["y"].to_numpy(), sums["bucket"].to_numpy()] += sums["n"].to_numpy()
    seen /= seen.sum(1, keepdims=True)
    return np.log(seen[1]) - np.log(seen[0])


def sample(rows: DataFrame, most: int) -> DataFrame:
    """``doc_id, digest, y`` of at most ``most`` distinct rows of each label, those of smallest id digest. No text moves."""
    keys = rows.select("doc_id", F.xxhash64("text").alias("digest"), "y").distinct()
    first = lambda y: keys.where(F.col("y") == y).orderBy(F.xxhash64("doc_id", F.lit(17)), "doc_id", "digest").limit(most)
    return first(0).unionByName(first(1))


def quality(docs: DataFrame, labels: DataFrame, folds: int = 4, held: int = 2, threshold: float = 0.7, sample_rows: int = 4000, alpha: float = 1.0, calibration_rows: int = 20) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every whole text, one row for each input row.

    Labels are learnt from rows whose fold (crc32 of the id as text, modulo ``folds``) is not ``held``; every fifth of
    those only calibrates. Log-count ratios use all the others; the hinge-loss weights are fitted, in one task, on at
    most ``sample_rows`` distinct rows of each label, those of smallest digest, chosen by id before their texts meet. A logistic curve over the calibration rows turns
    the margin into the probability of label 1. Null or empty text has only the bias; null ids and repeated rows
    stay; without labels of both classes all scores are one half; with fewer than ``calibration_rows`` rows of a class among
    those that calibrate, the curve is fitted over all training rows; an empty table gives no rows; extra columns are not read.
    """
    size = 1 << BITS
    train = labelled(docs, labels, "quality").where(fold(folds) != held)
    part = F.pmod(F.xxhash64("doc_id", F.lit(13)), F.lit(5))

    fit_rows = train.where(part != 0)
    ratio = log_count_ratios(fit_rows, alpha)

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        scratch = np.zeros(size, np.int64)
        pdf = pdf.fillna({"text": ""}).sort_values(["doc_id", "text"])
        w, bias = dual_coordinate_descent([ngrams(t, scratch) for t in pdf.text], ratio, pdf.y.to_numpy())
        return pd.DataFrame({"w": [w.astype("<f8").tobytes()], "bias": [bias]})

    chosen = fit_rows.withColumn("digest", F.xxhash64("text")).join(F.broadcast(sample(fit_rows, sample_rows)), ["doc_id", "digest", "y"])
    chosen = chosen.dropDuplicates(["doc_id", "digest", "y"]).select("doc_id", "text", "y")
    model = chosen.groupBy(F.lit(0).alias("one")).applyInPandas(fit, "w binary, bias double").collect()
    w = np.frombuffer(model[0]["w"], "<f8") if model else np.zeros(size)
    bias = model[0]["bias"] if model else 0.0
    shared = docs.sparkSession.sparkContext.broadcast((ratio, ratio * w, bias))

    def margins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scratch = np.zeros(size, np.int64)
        ratios, weights, at = shared.value
        squares = ratios * ratios
        for batch in slices(batches):
            out = np.empty(batch.num_rows)
            for i, text in enumerate(batch.column(0).to_pylist()):
                ids = ngrams(text, scratch)
                out[i] = at + (weights[ids].sum() / max(np.sqrt(squares[ids].sum()), 1e-9) if len(ids) else 0.0)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(out)], [*batch.schema.names[1:], "margin"])

    def points(rows: DataFrame) -> list[tuple[float, int, int]]:
        seen = rows.select("text", "y").mapInArrow(trimmed(margins), "y int, margin double").groupBy("y", F.floor(F.col("margin") * BINS).alias("bin")).count().collect()
        return [((r["bin"] + 0.5) / BINS, r["y"], r["count"]) for r in seen]

    at = points(train.where(part == 0))
    if min(sum(n for _, y, n in at if y == k) for k in (0, 1)) < calibration_rows:
        at = points(train)
    slope, shift = fit_logistic(at)
    scored = docs.select(F.col("text").cast("string").alias("text"), F.col("doc_id").cast("long").alias("doc_id")).mapInArrow(trimmed(margins), "doc_id long, margin double")
    score = 1 / (1 + F.exp(-(F.lit(slope) * F.col("margin") + F.lit(shift))))
    return scored.withColumn("score", score).select("doc_id", (fold(folds) == held).alias("held_out"), "score", F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))
