"""Toxicity by class-conditional Kneser-Ney models with shared backoff counts."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slidemill.llm.common import bitmap, checkpoint, fold, labelled, marked, slices, trim, trimmed
from slidemill.llm.jaccard import WordHasher, _Known, _mix

WORD = re.compile(r"[^\W_]+")
BINS = 1000  # of the calibrated root, for each unit
WEAK_BINS = 200  # of the calibrated mean of small ratios, for each unit
LIMIT = 0.5  # beyond it values count as this
STEM = 4  # letters of the class that a longer word backs off to
EASE = 10  # words without evidence that every text is taken to hold besides its own


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def stem(word: str) -> str:
    """The word's class: its first letters and a sign that no word holds."""
    return word[:STEM] + "*" if len(word) > STEM else ""


class _KnownStems(_Known):
    """Hashes of the classes of words, 0 for a word without one."""

    def __missing__(self, word):
        s = stem(word)
        self[word] = h = self.one(s) if s else 0
        return h


class StemHasher(WordHasher):
    def __init__(self, limit: int = 200_000):
        super().__init__(limit)
        self.known = _KnownStems()


def pair_keys(before: np.ndarray, words: np.ndarray) -> np.ndarray:
    return _mix(before + words * np.uint64(0x9E3779B97F4A7C15))


def _before(h: np.ndarray) -> np.ndarray:
    return np.concatenate([np.zeros(1, np.uint64), h[:-1]])


def toxic_words(train: DataFrame, min_docs: int) -> DataFrame:
    """``key, class, is_class`` of all words and word classes that at least ``min_docs`` toxic training documents hold.

    Keys are 64-bit hashes; ``class`` is the key of a word's class, 0 if it has none.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, stems, seen = WordHasher(), StemHasher(), Counter()

        def flush() -> pa.RecordBatch:
            names = list(seen)
            is_class = np.array([n.endswith("*") for n in names], bool)
            cols = [hasher(names).view(np.int64), np.where(is_class, 0, stems(names).view(np.int64)), is_class, np.fromiter(seen.values(), np.int64, len(names))]
            seen.clear()
            return pa.RecordBatch.from_arrays(list(map(pa.array, cols)), ["key", "class", "is_class", "n"])

        for batch in slices(batches):
            for text in batch.column(0).to_pylist():
                words = set(words_of(text))
                seen.update(words)
                seen.update({stem(w) for w in words} - {""})
            if len(seen) > 300_000:
                yield flush()
        yield flush()

    found = train.where("y = 1").select("text").mapInArrow(trimmed(count), "key long, class long, is_class boolean, n long")
    return checkpoint(found.groupBy("key", "class", "is_class").agg(F.sum("n").alias("n")).where(F.col("n") >= min_docs).drop("n"))


def class_totals(train: DataFrame, words: DataFrame) -> tuple[DataFrame, list[int], list[int]]:
    """``words`` with the documents ``d0, d1`` of each class that hold them; the documents and the words of each class."""
    marks = train.sparkSession.sparkContext.broadcast(bitmap(words))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, stems = WordHasher(), StemHasher()
        for batch in slices(batches):
            keys, ys, totals = [], [], np.zeros((2, 2), np.int64)
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = words_of(text)
                totals[y] += 1, len(words)
                own = list(set(words))
                k = np.unique(np.concatenate([hasher(own), stems(own)]))
                k = k[marked(marks.value, k)]
                keys.append(k)
                ys.append(np.full(len(k), y, np.uint64))
            key = np.concatenate(keys) if keys else np.empty(0, np.uint64)
            y = np.concatenate(ys) if ys else key
            n = np.zeros((2, len(k := np.unique(key))), np.int64)
            for c in (0, 1):
                n[c] = np.bincount(np.searchsorted(k, key[y == c]), minlength=len(k))
            yield pa.RecordBatch.from_arrays([*map(pa.array, (np.append(k.view(np.int64), [0, 1]), np.append(np.full(len(k), 0, np.int8), [1, 1]).astype(np.int8), np.append(n[0], totals[:, 0]), np.append(n[1], totals[:, 1])))], ["key", "total", "d0", "d1"])

    sums = checkpoint(train.select("text", "y").mapInArrow(trimmed(count), "key long, total byte, d0 long, d1 long").groupBy("key", "total").agg(F.sum("d0").alias("d0"), F.sum("d1").alias("d1")))
    totals = {r["key"]: r for r in sums.where("total = 1").collect()}
    of = lambda c: [int(totals[y][c]) if y in totals else 0 for y in (0, 1)]
    return words.join(sums.where("total = 0").drop("total"), "key"), of("d0"), of("d1")


def own_words(train: DataFrame, discount: float) -> tuple[DataFrame, list[int]]:
    """``key, class, is_class, n`` of all words and classes that either class's texts hold more often than its discount; the words of each class.

    A word stands behind no more distinct words than it has places, so every other word has no count of its own left in
    either class, and both models give it the same backoff.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, stems = WordHasher(), StemHasher()
        for batch in slices(batches):
            cols: list[list] = [[], [], [], []]  # key, class, whether the key is one, y
            totals = np.zeros(2, np.int64)
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = words_of(text)
                totals[y] += len(words)
                if words:
                    h, s = hasher(words), stems(words)
                    of = s[s > 0]
                    for col, part in zip(cols, ((h, of), (s, np.zeros_like(of)), (np.zeros(len(h), np.int8), np.ones(len(of), np.int8)), (np.full(len(h) + len(of), y, np.int8),)), strict=True):
                        col.extend(part)
            key, above, kind, y = (np.concatenate(c) if c else np.empty(0, t) for c, t in zip(cols, (np.uint64, np.uint64, np.int8, np.int8), strict=True))
            key, first, inverse = np.unique(key, return_index=True, return_inverse=True)
            n = [np.append(np.bincount(inverse[y == c], minlength=len(key)), totals[c]) for c in (0, 1)]
            yield pa.RecordBatch.from_arrays(
                [*map(pa.array, (np.append(key.view(np.int64), 0), np.append(above[first].view(np.int64), 0), np.append(kind[first], np.int8(2)), *n))], ["key", "class", "kind", "n0", "n1"]
            )

    seen = train.select("text", "y").mapInArrow(trimmed(count), "key long, class long, kind byte, n0 long, n1 long")
    sums = seen.groupBy("key", "class", "kind").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    sums = checkpoint(sums.where((F.col("kind") == 2) | (F.greatest("n0", "n1") > discount)))  # no class's discount is smaller
    total = sums.where("kind = 2").first()
    tokens = [int(total[f"n{y}"]) if total else 0 for y in (0, 1)]
    beyond = [F.col(f"n{y}") > discount * tokens[y] / max(min(tokens), 1) for y in (0, 1)]
    return sums.where((F.col("kind") < 2) & (beyond[0] | beyond[1])).select("key", "class", (F.col("kind") == 1).alias("is_class"), (F.col("n0") + F.col("n1")).alias("n")), tokens


def hot_keys(counted: DataFrame, share: int = 4096) -> np.ndarray:
    """The keys, sorted, that have more than one in ``share`` of all counts ``n``, so fewer than ``share``."""
    total = counted.agg(F.sum("n")).first()[0] or 0
    return np.sort(counted.where(F.col("n") * share > total).select("key").toArrow()["key"].to_numpy().astype(np.int64)).view(np.uint64)


def _folded(parts: list[tuple]) -> tuple:
    """Distinct pairs ``key, prev, n0, n1`` of all parts, counts added up."""
    key, prev, n0, n1 = map(np.concatenate, zip(*parts, strict=True))
    pair = pair_keys(prev, key)
    order = np.argsort(pair)
    pair = pair[order]
    first = np.flatnonzero(np.append(True, pair[1:] != pair[:-1]))
    return key[order[first]], prev[order[first]], *(np.add.reduceat(n[order], first, dtype=np.int32) for n in (n0, n1))


def _by_key(pairs: tuple, hot: np.ndarray) -> pa.RecordBatch:
    """One row ``key, part, prev, n0, n1`` for each key, the last three lists; a hot key has up to 64 rows, by ``prev``.

    Pairs of equal counts stand together, so that a compressed shuffle hardly carries more than the words before.
    """
    key, prev, n0, n1 = pairs
    part = np.where(np.isin(key, hot), prev >> np.uint64(58), np.uint64(0))
    small = lambda n: np.minimum(n, 255).astype(np.uint64)
    order = np.argsort(pair_keys(part, key) & ~np.uint64(0xFFFF) | small(n0) << np.uint64(8) | small(n1))
    key, part = key[order], part[order]
    first = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (part[1:] != part[:-1])))
    ends = pa.array(np.append(first, len(key)), pa.int32())
    lists = [pa.ListArray.from_arrays(ends, pa.array(c[order])) for c in (prev.view(np.int64), n0, n1)]
    return pa.RecordBatch.from_arrays([pa.array(key[first].view(np.int64)), pa.array(part[first].astype(np.int8)), *lists], ["key", "part", "prev", "n0", "n1"])


def expressions(train: DataFrame, min_docs: int, min_pair: int, favour: float | None, discount: float, held: int = 1_500_000, share: int = 4096) -> DataFrame:
    """``key, ratio, n``: log P(expression | toxic) - log P(expression | ordinary) of words, word classes and word pairs.

    Both models know all words and pairs of both classes. A word's Kneser-Ney count is the number of distinct words
    before it. Each class keeps its count less a discount; discounts are the same share of both classes, so that
    neither knows rare words better for being larger. What is left goes to the word's class (its first letters) in the
    same way, and then to counts shared by both. A pair has its own discounted counts over its shared ones, less what
    the word before tells by itself. Expressions of which neither class keeps a count cancel and are not in the table.

    With a ``favour``, only words count that speak for toxic texts: those of ``min_docs`` toxic documents whose rate there is
    ``exp(favour)`` times that of ordinary documents or more, and pairs of ``min_pair`` toxic documents.

    Pairs are shuffled as lists of the words before a key, each key once for about ``held`` pairs of a task; keys of more
    than one in ``share`` of all counts are dealt over many tasks.
    """
    if favour is None:
        words, tokens = own_words(train, discount)
    else:
        words, docs, tokens = class_totals(train, toxic_words(train, min_docs))
        rate = F.ln((F.col("d1") / max(docs[1], 1)) / ((F.col("d0") + 0.5) / max(docs[0], 1)))
        words = checkpoint(words.where(rate > favour).select("key", "class", "is_class", (F.col("d0") + F.col("d1")).alias("n")))
    marks = train.sparkSession.sparkContext.broadcast((bitmap(words), hot_keys(words, share)))
    words = words.drop("n")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, stems, parts, size = WordHasher(), StemHasher(), [], 0
        known, hot = marks.value
        for batch in slices(batches):
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = words_of(text)
                if not words:
                    continue
                h = hasher(words)
                s, before = stems(words), _before(h)
                key, prev = np.concatenate([h, s]), np.concatenate([before, before])
                at = marked(known, key)
                key, prev = key[at], prev[at]
                _, first = np.unique(pair_keys(prev, key), return_index=True)  # once for each document
                parts.append((key[first], prev[first], np.full(len(first), 1 - y, np.int32), np.full(len(first), y, np.int32)))
                size += len(first)
                if size > held:
                    parts = [_folded(parts)]
                    size = len(parts[0][0])
                    if size > held // 2:
                        yield _by_key(parts[0], hot)
                        parts, size = [], 0
        if size:
            yield _by_key(_folded(parts), hot)

    seen = train.select("text", "y").mapInArrow(trimmed(count), "key long, part byte, prev array<long>, n0 array<int>, n1 array<int>")
    seen = seen.repartition("key", "part").select("key", "part", F.inline(F.arrays_zip("prev", "n0", "n1")))
    total, least = max(sum(tokens), 1), max(min(tokens), 1)
    kept = lambda y: F.greatest(F.col(f"n{y}") - discount * tokens[y] / least, F.lit(0.0)) / max(tokens[y], 1)
    has_own = F.col("n1") >= min_pair if favour is not None else (kept(0) > 0) | (kept(1) > 0)
    # most pairs only count as one word more before their second: they are folded where they are counted, before anything is written
    pairs = (
        seen.groupBy("key", "part", "prev").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
        .groupBy("key", "part", F.when(has_own, F.col("prev")).alias("prev"), has_own.alias("own"))
        .agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), F.count_if(F.col("n0") > 0).alias("c0"), F.count_if(F.col("n1") > 0).alias("c1"))
    )
    pairs = checkpoint(pairs)
    known = checkpoint(words.join(pairs.groupBy("key").agg(F.sum("c0").alias("n0"), F.sum("c1").alias("n1")), "key"))
    if favour is None:
        known = known.where((kept(0) > 0) | (kept(1) > 0))
    both = (F.col("n0") + F.col("n1")) / total
    spare = known.where("not is_class").agg(F.coalesce(F.sum(kept(0)), F.lit(0.0)) + F.coalesce(F.sum(kept(1)), F.lit(0.0))).first()[0]
    spare = min(max(1 - spare / 2, 1e-3), 1.0)
    full = lambda back: F.struct(*((kept(y) + back[y]).alias(f"p{y}") for y in (0, 1)), both.alias("both"))
    ratio = lambda p: F.ln(p["p1"]) - F.ln(p["p0"])
    classes = known.where("is_class").withColumn("c", full([spare * both] * 2)).select(F.col("key").alias("class"), "c", (F.col("n0") + F.col("n1")).alias("n"))
    own = known.where("not is_class").join(classes.select("class", "c"), "class", "left")
    share = F.least(F.lit(1.0), both / F.col("c.both"))
    own = own.withColumn("p", full([F.when(F.col("c").isNull(), spare * both).otherwise(F.col("c")[f"p{y}"] * share) for y in (0, 1)]))
    own = own.select("key", ratio(F.col("p")).alias("ratio"), (F.col("n0") + F.col("n1")).alias("n"))
    joint = [kept(y) + spare * both for y in (0, 1)]
    found = (
        pairs.where("own").join(own.select("key"), "key").join(own.select(F.col("key").alias("prev"), F.col("ratio").alias("told")), "prev", "left")
        .select("key", "prev", (F.ln(joint[1]) - F.ln(joint[0]) - F.coalesce("told", F.lit(0.0))).alias("ratio"), (F.col("n0") + F.col("n1")).alias("n"))
    )

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, prev = (batch.column(i).to_numpy().view(np.uint64) for i in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array(pair_keys(prev, key).view(np.int64)), *batch.columns[2:]], ["key", "ratio", "n"])

    found = found.mapInArrow(trimmed(named), "key long, ratio double, n long")
    return checkpoint(own.unionByName(classes.select(F.col("class").alias("key"), ratio(F.col("c")).alias("ratio"), "n")).unionByName(found))


def split(rows: DataFrame, limit: int) -> tuple[np.ndarray, np.ndarray, DataFrame | None]:
    """Keys and ratios, sorted by key, of the most frequent rows, at most ``limit``; the table of all others, None if there are none."""
    sizes, held, least = rows.groupBy("n").count().orderBy(F.desc("n")).collect(), 0, math.inf
    for r in sizes:
        if held + r["count"] > limit:
            break
        held, least = held + r["count"], r["n"]
    hot = rows.where(F.col("n") >= least).select("key", "ratio").toArrow() if held else None
    keys, ratios = (hot["key"].to_numpy().astype(np.int64), hot["ratio"].to_numpy()) if held else (np.zeros(0, np.int64), np.zeros(0))
    order = np.argsort(keys)
    rest = rows if not held else rows.where(F.col("n") < least)
    return keys[order], ratios[order], rest.select("key", "ratio") if sum(r["count"] for r in sizes) > held else None


class Scorer:
    """Values of texts from a table of expressions; ``more`` is a text's own part of the table that is not shared."""

    def __init__(self, keys: np.ndarray, ratios: np.ndarray, dead: float):
        self.table, self.dead = (keys, ratios), dead
        self.hasher, self.stems = WordHasher(), StemHasher()

    def look_up(self, k: np.ndarray, more: tuple | None) -> np.ndarray:
        """Ratios of the keys, not a number for those that no table holds."""
        out, k = np.full(len(k), np.nan), k.view(np.int64)
        for keys, ratios in (self.table, more or ((), ())):
            if len(keys):
                at = np.minimum(np.searchsorted(keys, k), len(keys) - 1)
                out = np.where(keys[at] == k, ratios[at], out)
        return out

    def keys(self, words: list[str]) -> np.ndarray:
        """All keys whose ratios the text's value can depend on."""
        h, s = self.hasher(words), self.stems(words)
        return np.unique(np.concatenate([h, s[s > 0], pair_keys(_before(h), h)]))

    def value(self, words: list[str], more: tuple | None = None) -> float:
        """The first of the text's ``parts``."""
        return self.parts(words, more)[0]

    def parts(self, words: list[str], more: tuple | None = None) -> tuple[float, float]:
        """Mean over all words of the log ratio (of the pair if known, else of the word, else of its class) in two parts: what goes beyond ``dead``, and the rest."""
        if not words:
            return 0.0, 0.0
        h = self.hasher(words)
        v = self.look_up(h, more)
        known = np.flatnonzero(~np.isnan(v))
        if len(known):
            pair = self.look_up(pair_keys(_before(h)[known], h[known]), more)
            v[known] = np.where(np.isnan(pair), v[known], pair)
        rest = np.flatnonzero(np.isnan(v))
        if len(rest):
            v[rest] = np.nan_to_num(self.look_up(self.stems([words[i] for i in rest.tolist()]), more), nan=0.0)
        beyond = np.sign(v) * np.maximum(np.abs(v) - self.dead, 0)
        return float(beyond.sum() / (len(words) + EASE)), float((v - beyond).sum() / (len(words) + EASE))


def fit_curve(points: list[tuple], ridge: float = 1e-3, rounds: int = 200) -> list[float]:
    """Slopes and intercept of a logistic curve over counted points ``(x, ..., y, rows)``, by damped Newton steps.

    The ridge is one for all rows together, so it fades as they grow: a share for each row keeps the curve too flat for
    the values of long texts, which lie close to those of ordinary ones.
    """
    *x, y, n = (np.array(c, float) for c in zip(*points, strict=True))
    x = np.array(x)
    mid = x @ n / n.sum()
    spread = np.sqrt((x - mid[:, None]) ** 2 @ n / n.sum())
    spread = np.where(spread > 1e-9, spread, np.inf)
    z = np.vstack([(x - mid[:, None]) / spread[:, None], np.ones(len(n))])
    w, prior = np.zeros(len(z)), np.append(np.full(len(x), ridge), 1e-6)
    loss = lambda w: float((n * (np.logaddexp(0, w @ z) - y * (w @ z))).sum() + (prior * w * w).sum() / 2)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(w @ z, -40, 40)))
        step = np.linalg.solve((z * (n * np.maximum(p * (1 - p), 1e-9))) @ z.T + np.diag(prior), z @ (n * (p - y)) + prior * w)
        size = 1.0
        while size > 1e-4 and loss(w - size * step) > loss(w):
            size /= 2
        w = w - size * step
        if abs(size * step).max() < 1e-9:
            break
    slopes = w[:-1] / spread
    return [*slopes.tolist(), float(w[-1] - slopes @ mid)]


def scorer(docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0, min_docs: int = 3, min_pair: int = 3, favour: float | None = None, discount: float = 8.0, dead: float = 1.0, shared: int = 2_000_000, calibration_rows: int = 20) -> Callable[[DataFrame, str], DataFrame]:
    """Fit on the labelled rows outside fold ``held``; the result adds the score of ``text`` to a table as a column."""
    spark = docs.sparkSession
    train = labelled(docs, labels, "toxic").where(fold(folds) != held)
    part = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(5))
    *table, rest = split(expressions(train.where(part != 0), min_docs, min_pair, favour, discount), shared)
    model = spark.sparkContext.broadcast((*table, dead))
    away = spark.sparkContext.broadcast(bitmap(rest)) if rest is not None else None

    two = "strong double, weak double"
    frame = lambda found: pd.DataFrame(found, columns=["strong", "weak"], dtype="float64")

    @F.pandas_udf(two)
    def value(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        s = Scorer(*model.value)
        for batch in texts:
            yield frame([s.parts(words_of(x)) for x in batch])
        s = None
        trim()

    @F.pandas_udf(two)
    def value_with(columns: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        s = Scorer(*model.value)
        for batch in columns:
            out = []
            for x, k, r in zip(*batch, strict=True):
                order = None if k is None else np.argsort(np.asarray(k, np.int64))
                out.append(s.parts(words_of(x), None if k is None else (np.asarray(k, np.int64)[order], np.asarray(r, np.float64)[order])))
            yield frame(out)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = Scorer(*model.value)
        for batch in slices(batches):
            ids, digests, keys = [], [], []
            for i, digest, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                k = s.keys(words_of(text)) if text else np.zeros(0, np.uint64)
                k = k[marked(away.value, k) & np.isnan(s.look_up(k, None))].view(np.int64)
                ids.append(np.full(len(k), i, np.int64))
                digests.append(np.full(len(k), digest, np.int64))
                keys.append(k)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c) if c else np.zeros(0, np.int64), pa.int64()) for c in (ids, digests, keys)], ["_id", "_digest", "key"])

    def add_value(rows: DataFrame, name: str) -> DataFrame:
        """A text's value depends on the text alone, so its other expressions come back by id and digest, once for each."""
        text = F.col("text").cast("string")
        if rest is None:
            return rows.withColumn(name, value(text))
        tag = "_" * (1 + max(map(len, rows.columns)))  # no column has a name that long
        i, digest = F.coalesce(F.col("doc_id").cast("long"), F.lit(0)), F.xxhash64(F.coalesce(text, F.lit("")))
        found = rows.select(i.alias("_id"), digest.alias("_digest"), text.alias("text")).mapInArrow(trimmed(ask), "_id long, _digest long, key long").join(rest, "key")
        found = found.groupBy(F.col("_id").alias(f"i{tag}"), F.col("_digest").alias(f"d{tag}")).agg(F.collect_set(F.struct("key", "ratio")).alias(f"p{tag}"))
        joined = rows.withColumns({f"i{tag}": i, f"d{tag}": digest}).join(found, [f"i{tag}", f"d{tag}"], "left")
        return joined.withColumn(name, value_with(text, F.col(f"p{tag}")["key"], F.col(f"p{tag}")["ratio"])).select(*rows.columns, name)

    limited = lambda c: F.greatest(F.lit(-LIMIT), F.least(F.lit(LIMIT), c))
    root = lambda c: F.signum(c) * F.sqrt(F.abs(limited(c)))

    def curve(rows: DataFrame) -> list[tuple[float, float, int, int]]:
        bins = F.floor(root(F.col("value.strong")) * BINS).alias("bin"), F.floor(limited(F.col("value.weak")) * WEAK_BINS).alias("weak")
        seen = add_value(rows, "value").groupBy("y", *bins).count().collect()
        return sorted(((r["bin"] + 0.5) / BINS, (r["weak"] + 0.5) / WEAK_BINS, r["y"], r["count"]) for r in seen)

    points = curve(train.where(part == 0))
    if sum(n for *_, y, n in points if y) < calibration_rows:
        points = curve(train)
    held_rows = [sum(n for *_, y, n in points if y == k) for k in (0, 1)]
    slope, weak, shift = fit_curve(points) if all(held_rows) else (1.0, 0.0, math.log((held_rows[1] + 0.5) / (held_rows[0] + 1.5)))
    return lambda rows, name: add_value(rows, name).withColumn(name, 1 / (1 + F.exp(-(F.lit(slope) * root(F.col(name)["strong"]) + F.lit(weak) * limited(F.col(name)["weak"]) + F.lit(shift)))))


def toxicity(docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0, threshold: float = 0.5, **model) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every whole text, one row for each input row.

    Labels are learnt from rows whose fold (crc32 of the id as text, modulo ``folds``) is not ``held``; every fifth of
    those (by another digest) only calibrates. A text's value is the difference of its two log-likelihoods over all its
    words, divided by their number (and ``EASE`` more). It is kept in two parts: what each word's log ratio exceeds
    ``dead`` by, and the rest, as small ratios tell language and topic as well. A logistic curve over the root of the
    first part and the second turns both into the score; its two slopes are fitted to the rows that calibrate.
    Expressions of which neither class keeps a count back off to shared counts in both and cancel.

    Every word, class and pair with more than ``discount`` counts in the class of fewer words (and as large a share in the
    other) keeps its own counts in both, however large the input. They form a table: its ``shared`` most frequent rows (16
    bytes each) go to all tasks, all others are joined to the texts' own expressions by shuffle, and the result is the same.

    Null or empty text has value 0 in both parts; null ids and repeated rows stay; without labels of both classes the curve has
    slope 1 and the one class's odds (ordinary without any label). With fewer than ``calibration_rows`` toxic rows among those
    that calibrate, the curve is fitted over all training rows; an empty table gives no rows; extra columns are not read.
    """
    add_score = scorer(docs, labels, folds, held, **model)
    scored = add_score(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), "score")
    return scored.select("doc_id", (fold(folds) == held).alias("held_out"), "score", F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, **model) -> DataFrame:
    """The documents whose score stays below ``threshold``, all columns as they are.

    Null and empty texts have the score of a text without evidence; null ids and repeated rows are judged by their
    text; an empty table gives none.
    """
    cols = docs.columns
    name = "_score" + "_" * max(map(len, cols))
    return scorer(docs, labels, **model)(docs, name).where(F.col(name) < threshold).select(cols)
