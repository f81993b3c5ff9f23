"""I-Match fingerprints with randomised lexicon subsets, and their likeness to an edited text and the next document."""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slidemill.llm.common import bitmap, checkpoint, marked, slices, trimmed
from slidemill.llm.jaccard import _mix, distinct, hashed, shingle_hashes, word_hashes

#: Randomised subsets of the lexicon: how many of those that keep one in so many terms (a power of two). Subsets of one line
#: are disjoint. The sparse ones are what a text of some hundred or thousand terms still shares after half of it is replaced.
SUBSETS = ((1, 1), (8, 16), (16, 64), (32, 256), (32, 1024))
#: A text with a smaller share of its terms in the lexicon is known by all its terms.
LEAST_SHARE = 0.1
PREFIX = 32  # characters that order the texts of one id


def terms(text: str) -> np.ndarray:
    """Sorted distinct hashes of the blank-separated words, A-Z lower-cased."""
    return distinct(word_hashes(text))


class Fingerprinter:
    """Hashes of a text's lexicon terms for each subset; 0 marks a subset that holds none of them."""

    def __init__(self, lexicon: np.ndarray):
        self.lexicon = lexicon
        self.salts = np.array([(i + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1 for i in range(len(SUBSETS))], np.uint64)[:, None]
        self.counts, self.keeps = (np.array(c, np.uint64)[:, None] for c in zip(*SUBSETS, strict=True))
        self.firsts = np.cumsum(self.counts, axis=0, dtype=np.uint64) - self.counts
        self.size = int(self.counts.sum())
        self.places = np.empty(0, np.uint64)

    def __call__(self, words: np.ndarray) -> np.ndarray:
        """The fingerprint of a text's word hashes."""
        t = distinct(words)
        if len(self.lexicon) and len(t):
            at = np.minimum(np.searchsorted(self.lexicon, t), len(self.lexicon) - 1)
            inside = t[self.lexicon[at] == t]
            t = inside if len(inside) >= LEAST_SHARE * len(t) else t
        out = np.zeros(self.size, np.uint32)
        if not len(t):
            return out
        subset = (_mix(t[None, :] ^ self.salts) >> np.uint64(40)) & (self.keeps - np.uint64(1))  # each keeps one in a power of two
        line, term = np.nonzero(subset < self.counts)
        subset = (subset + self.firsts)[line, term].astype(np.uint8)
        order = np.argsort(subset, kind="stable")  # the terms of a subset together, still sorted
        ranked = subset[order]
        if not len(order):
            return out
        fresh = np.ones(len(order), bool)
        np.not_equal(ranked[1:], ranked[:-1], out=fresh[1:])
        cuts = np.flatnonzero(fresh)
        place = np.arange(len(order)) - cuts[np.cumsum(fresh) - 1]
        if place.max() >= len(self.places):
            self.places = _mix(np.arange(2 * int(place.max()) + 2, dtype=np.uint64) + np.uint64(1))
        # terms and their places: a hash of the sorted list
        body = np.add.reduceat(_mix(t[term[order]] + self.places[place]), cuts)
        out[ranked[cuts]] = (_mix(body) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
        return out


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of the subsets used by either text in which both hold the same terms; 1 for two texts without terms."""
    used = (a > 0) | (b > 0)
    return float(((a == b) & used).sum() / used.sum()) if used.any() else 1.0


def code(f: np.ndarray) -> str:
    return f.astype(">u4").tobytes().hex()


def sketch(h: np.ndarray) -> int:
    """The least hash of a text's four-word shingles, which most near copies of it share; 0 without words."""
    return int(shingle_hashes(h, 4).min().view(np.int64)) if len(h) else 0


def by_sketch(docs: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """``text`` of those whose sketch no other has, ``sketch, text`` of all others, and the number of sketches.

    Digests of texts whose sketch several have are marked in a bitmap of fixed size. Only marked texts are sketched
    again; a mark set by another digest costs a text that detour and nothing else.
    """

    def sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays([pa.array([sketch(h) for h in hashed(batch.column(0).to_pylist())], pa.int64()), batch.column(1)], ["sketch", "key"])

    keyed = docs.select("text", F.xxhash64("text").alias("key"))
    seen = checkpoint(keyed.mapInArrow(trimmed(sketches), "sketch long, key long"))
    several = checkpoint(seen.groupBy("sketch").count().where("count > 1").select("sketch"))
    marks = docs.sparkSession.sparkContext.broadcast(bitmap(seen.join(several, "sketch").select("key")))

    def side(copied: bool):
        def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches):
                batch = batch.filter(pa.array(marked(marks.value, batch.column(1).to_numpy()) == copied))
                texts = batch.column(0)
                own = [sketch(h) for h in hashed(texts.to_pylist())] if copied else [0] * len(texts)
                yield pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), texts], ["sketch", "text"])

        return keyed.mapInArrow(trimmed(pick), "sketch long, text string")

    return side(False).select("text"), side(True), seen.select("sketch").distinct().count()


def lexicon(docs: DataFrame, low: float, high: float, min_docs: int, limit: int, every_copy: bool = False) -> np.ndarray:
    """Hashes of the terms whose share of all texts lies in the band, sorted.

    Near copies (texts of one sketch) count as one text. With ``every_copy`` that is one which holds the terms of all of
    them, so every text is counted; else it is the least of them.

    A band from share ``low`` holds at most (mean distinct terms of a text) / ``low`` terms, however many texts there
    are. The band is never moved: more than ``limit`` terms are an error.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = [], 0

        def flush() -> pa.RecordBatch:
            key, n = np.unique(np.concatenate(held) if held else np.empty(0, np.uint64), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(n.astype(np.int64))], ["term", "n"])

        for batch in slices(batches):
            for h in hashed(batch.column(0).to_pylist()):
                t = distinct(h)
                held.append(t)
                total += len(t)
                if total > 4_000_000:
                    yield flush()
                    held, total = [], 0
        if total:
            yield flush()

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [distinct(h) for h in hashed(batch.column(1).to_pylist())]
            term = np.concatenate(found) if found else np.empty(0, np.uint64)
            group = np.repeat(batch.column(0).to_numpy(), list(map(len, found)))
            _, first = np.unique(_mix(_mix(group.view(np.uint64)) + term), return_index=True)  # most copies in a slice bring nothing new
            yield pa.RecordBatch.from_arrays([pa.array(group[first]), pa.array(term[first].view(np.int64))], ["sketch", "term"])

    single, copied, n_docs = by_sketch(docs)
    if not every_copy:
        copied = copied.groupBy("sketch").agg(F.min("text").alias("text"))
    groups = copied.mapInArrow(trimmed(held), "sketch long, term long").distinct().groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    df = single.mapInArrow(trimmed(count), "term long, n long").unionByName(groups).groupBy("term").agg(F.sum("n").alias("n"))
    kept = checkpoint(df.where((F.col("n") >= max(min_docs, low * n_docs)) & (F.col("n") <= high * n_docs)))
    if kept.count() > limit:
        raise ValueError(f"more than {limit} terms in the band from {low}: raise low, or limit if the tasks can hold 8 bytes for each")
    return np.sort(kept.select("term").toArrow()["term"].to_numpy().astype(np.int64).view(np.uint64))


def once(docs: DataFrame) -> DataFrame:
    """``doc_id, text, times``: rows that repeat an id and its text as one, counted before they meet."""
    keyed = docs.withColumn("digest", F.xxhash64("text"))
    again = checkpoint(keyed.groupBy("doc_id", "digest").count().where("count > 1").select(F.coalesce("doc_id", F.lit(0)).alias("i"), F.col("doc_id").isNull().alias("no_id"), "digest"))
    if not again.limit(1).count():
        return docs.withColumn("times", F.lit(1).cast("long"))
    keyed = keyed.withColumns({"i": F.coalesce("doc_id", F.lit(0)), "no_id": F.col("doc_id").isNull()})
    on = ["i", "no_id", "digest"]
    alone = keyed.join(again, on, "left_anti").select("doc_id", "text", F.lit(1).cast("long").alias("times"))
    return alone.unionByName(keyed.join(again, on, "left_semi").groupBy("doc_id", "text").agg(F.count(F.lit(1)).alias("times")))


def order_key() -> tuple[Column, ...]:
    """Falling ids, null ids last; then the first characters, then a digest of the text."""
    return F.col("doc_id").isNull(), -F.coalesce(F.col("doc_id"), F.lit(0)).cast("decimal(20,0)"), F.substring("text", 1, PREFIX), F.xxhash64("text", F.lit(1))


def ranges(docs: DataFrame, rows_per_bucket: int, most: int = 20_000, samples: int = 20) -> tuple[list, list]:
    """Buckets of about ``rows_per_bucket`` rows along the order: the keys between them, each one's first key.

    Bounds come from a sample of keys, ``samples`` for each bucket; beyond ``most`` buckets these grow instead (they are
    streamed, not held). Where the bounds fall has no bearing on the result.
    """
    keyed = docs.select(F.struct(*(c.alias(f"k{i}") for i, c in enumerate(order_key()))).alias("k"))
    rows = docs.count()
    n = max(1, min(most, -(-rows // rows_per_bucket)))
    share = min(1.0, n * samples / max(rows, 1))
    seen = sorted(tuple(r["k"]) for r in keyed.where(F.pmod(F.xxhash64("k", F.lit(3)), F.lit(1 << 20)) <= int(share * (1 << 20))).collect()) if n > 1 else []
    bounds = sorted({seen[len(seen) * i // n] for i in range(1, n)}) if seen else []

    @F.pandas_udf("int")
    def bucket(no_id: pd.Series, i: pd.Series, prefix: pd.Series, digest: pd.Series) -> pd.Series:
        return pd.Series([bisect.bisect_right(bounds, k) for k in zip(no_id.tolist(), i.tolist(), prefix.tolist(), digest.tolist(), strict=True)], dtype="int32")

    firsts = {r["bucket"]: tuple(r["k"]) for r in keyed.select(bucket(*(F.col(f"k.k{i}") for i in range(4))).alias("bucket"), "k").groupBy("bucket").agg(F.min("k").alias("k")).collect()}
    return bounds, [firsts.get(b) for b in range(len(bounds) + 1)]


OUT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
ROWS = OUT + ", times long"


def fingerprints(docs: DataFrame, low: float = 0.0005, high: float = 0.05, min_docs: int = 2, limit: int = 16_000_000, rows_per_bucket: int = 5_000, every_copy: bool = False) -> DataFrame:
    """I-Match fingerprints of every whole text: ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next``, one row for each input row.

    Document frequencies are counted over all documents, near copies (texts of equal sketch) once: the least of them, with
    ``every_copy`` the terms of all of them; terms whose share of sketches lies in ``[low, high]`` (and in at least ``min_docs``) form the lexicon. A text with less than
    ``LEAST_SHARE`` of its terms in it is known by all its terms. A fingerprint hashes the text's sorted distinct lexicon terms
    once for the whole lexicon and once for each randomised subset; the sparse subsets survive partial edits. The edited
    text replaces the last ``n_chars // 2`` code points by the first as many of the next document in falling ``doc_id``
    (the first characters break ties, then a digest; null ids come last; after the last comes the first). Rows that
    repeat an id and its text follow each other.

    Texts are dealt once, to ranges of that order, with each range's first document also sent to the range before it,
    and stream through one Arrow function in order; no range has to fit in memory. Null text counts as empty; equal
    texts have equal fingerprints; an empty table gives no rows; other columns are not read. The lexicon sent to the
    tasks holds 8-byte hashes, at most (mean distinct terms of a text) / ``low``.
    """
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(lexicon(base, low, high, min_docs, limit, every_copy))
    rows = once(base)
    bounds, firsts = ranges(rows, rows_per_bucket)
    used = [b for b, k in enumerate(firsts) if k is not None]
    before = {b: used[i - 1] for i, b in enumerate(used)}

    @F.pandas_udf("array<struct<bucket:int,tail:int>>")
    def places(no_id: pd.Series, i: pd.Series, prefix: pd.Series, digest: pd.Series) -> pd.Series:
        out = []
        for k in zip(no_id.tolist(), i.tolist(), prefix.tolist(), digest.tolist(), strict=True):
            b = bisect.bisect_right(bounds, k)
            out.append([{"bucket": b, "tail": 0}] + ([{"bucket": before[b], "tail": 1}] if firsts[b] == k else []))
        return pd.Series(out)

    dealt = (
        rows.withColumn("to", F.explode(places(*order_key())))
        .select("to.bucket", "to.tail", "doc_id", "text", "times")
        .repartition(len(firsts), "bucket")
        .sortWithinPartitions("bucket", "tail", *order_key())
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fp = Fingerprinter(shared.value)
        last = None  # (bucket, doc_id, text, fingerprint) waiting for its next document
        for batch in slices(batches):
            # (doc_id, text, fingerprint, edited text, next fingerprint, times)
            rows: list[tuple] = []
            edited = lambda old, new: old[: len(old) - len(old) // 2] + new[: len(old) // 2]
            columns = [c.to_pylist() for c in batch.columns]
            for b, tail, d, text, times, h in zip(*columns, hashed(columns[3]), strict=True):
                f = fp(h)
                if last is not None and last[0] == b:
                    rows.append((*last[1:], edited(last[2], text), f, 1))
                if tail:
                    last = None
                    continue
                if times > 1:
                    rows.append((d, text, f, edited(text, text), f, times - 1))
                last = (b, d, text, f)
            found = [
                (d, len(old), hashlib.sha256(new.encode()).hexdigest(), code(own), code(e), likeness(own, e), likeness(own, f), times)
                for (d, old, own, new, f, times), e in zip(rows, map(fp, hashed([r[3] for r in rows])), strict=True)
            ]
            cols = list(zip(*found, strict=True)) or [[]] * 8
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], [x.split()[0] for x in ROWS.split(", ")])

    out = dealt.mapInArrow(trimmed(run), ROWS)
    return out.withColumn("times", F.explode(F.sequence(F.lit(1).cast("long"), "times"))).drop("times")
