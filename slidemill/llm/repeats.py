"""Periodic runs of words: aligned power-of-two blocks searched by an automaton of integer sequences, extended exactly."""

from __future__ import annotations

from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slidemill.llm.common import trimmed

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
LEAST, TIMES = 12, 2


def _agree(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the common beginning of two arrays, looked at in growing pieces."""
    n, at, step = min(len(a), len(b)), 0, 16
    while at < n:
        end = min(n, at + step)
        differ = a[at:end] != b[at:end]
        if (first := int(differ.argmax())) or differ[0]:
            return at + first
        at, step = end, step * 4
    return n


def _next_of_same(words: np.ndarray) -> np.ndarray:
    """Distance of every word to its next occurrence, the number of words where there is none."""
    order = np.argsort(words, kind="stable")
    gap = np.full(len(words), len(words), np.int64)
    same = words[order[1:]] == words[order[:-1]]
    gap[order[:-1][same]] = (order[1:] - order[:-1])[same]
    return gap


def find_runs(words: np.ndarray, least: int = LEAST) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of all runs of a sequence of integers, sorted by start, then period.

    A run of period q lasts at least 2q, so its first length - q words hold, for the largest power of two B with
    2B - 1 <= q, a whole block that begins at a multiple of B, and q <= 4B - 2. For each B the blocks go into one automaton, the
    document is searched for them, and an occurrence between 2B - 1 and 4B - 2 words behind its block is extended to both
    sides. Left out are only blocks and pairs that cannot show a new run: a block with a word that does not stand again
    within 4B - 2 words; a pair inside a stretch already extended at its distance; a pair inside a run whose period divides its
    distance, and a block inside a run of period at most B that reaches past all its pairs (what repeats there has that run's period).
    """
    n = len(words)
    if n < least:
        return []
    gap = _next_of_same(words)
    found: dict[tuple[int, int], int] = {}  # (start, end): smallest period
    size = 1
    while 2 * size - 1 <= n // TIMES:
        low, high = 2 * size - 1, min(4 * size - 2, n // TIMES)
        whole = n // size * size
        live = np.flatnonzero((gap[:whole] <= high).reshape(-1, size).all(axis=1))
        if len(live):
            _scale(words, live * size, size, low, high, least, found)
        size *= 2
    return sorted((s, e - s, q) for (s, e), q in found.items())


def _scale(words: np.ndarray, blocks: np.ndarray, size: int, low: int, high: int, least: int, found: dict) -> None:
    """Add the runs of period ``low`` to ``high`` that blocks of ``size`` words at ``blocks`` show."""
    n = len(words)
    cover = defaultdict(list)  # the runs around each block that could hold a pair of it
    for (s, e), q in found.items():
        if e - s >= low + size:
            for k in range(-(-s // size), (e - size) // size + 1):
                cover[k * size].append((e, q))
    at: dict[tuple, list[int]] = defaultdict(list)
    for p in blocks.tolist():
        if not any(q <= size and e >= min(n, p + high + size) for e, q in cover[p]):
            at[tuple(words[p : p + size].tolist())].append(p)
    if not at:
        return
    automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
    for key, places in at.items():
        automaton.add_word(key, places)
    automaton.make_automaton()
    begin, end = min(p[0] for p in at.values()), min(n, max(p[-1] for p in at.values()) + high + size)
    seen: dict[int, int] = {}  # distance: end of the last stretch extended at it
    for last, places in automaton.iter(tuple(words[begin:end].tolist())):
        here = begin + last - size + 1
        for i in range(bisect_left(places, here - high), len(places)):
            p = places[i]
            d = here - p
            if d < low:
                break
            if p < seen.get(d, -1) or any(d % q == 0 and e >= here + size for e, q in cover[p]):
                continue
            left = p - _agree(words[:p][::-1], words[:here][::-1])
            right = p + size + _agree(words[p + size :], words[here + size :])
            seen[d] = right
            if right + d - left >= max(least, TIMES * d):
                found[left, right + d] = min(d, found.get((left, right + d), d))


def keep_mask(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """False for the words that some run contains behind its first period."""
    change = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change)[:n] == 0


def periodic_runs(docs: DataFrame, least: int = LEAST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Runs of the words of every whole text: ``(doc_id, runs, collapsed)``.

    Words are what stands between blanks of ASCII. ``runs`` lists ``start, length, period`` (words, from 0) of each maximal
    stretch with a smallest period of at most half its length and at least ``least`` words, by start, then period;
    ``collapsed`` holds the words left when every run keeps its first period only, joined by one space. One row per input
    row, in a narrow Arrow map: no text meets another. Null and empty texts and texts of blanks have no runs and the empty
    text; null ids stay null; repeated rows repeat; other columns are not read; an empty table gives an empty result.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs, rest = [], []
            for value in pc.fill_null(batch.column(1), ""):
                words = value.as_py().encode().split()  # bytes split at ASCII blanks only
                codes: dict[bytes, int] = {}
                found = find_runs(np.fromiter((codes.setdefault(w, len(codes)) for w in words), np.int64, len(words)), least)
                if found:
                    words = [w for w, keep in zip(words, keep_mask(len(words), found).tolist(), strict=True) if keep]
                runs.append([dict(zip(("start", "length", "period"), r, strict=True)) for r in found])
                rest.append(b" ".join(words).decode())
            kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(runs, kind), pa.array(rest, pa.string())], ["doc_id", "runs", "collapsed"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(trimmed(work), f"doc_id long, runs {RUNS}, collapsed string")


def planted(doc_id: Column, text: Column) -> Column:
    """The text, for a tenth of the ids with a periodic end: from word a on, the p words from a over and over."""
    h = F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")))
    g = F.floor(h / 10)

    def moved(w: Column) -> Column:
        n = F.size(w).cast("long")
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        whole = lambda c: c.cast("int")
        again = F.flatten(F.array_repeat(F.slice(w, whole(a + 1), whole(p)), whole(F.ceil((n - a) / p))))
        return F.when(n > 0, F.array_join(F.concat(F.slice(w, F.lit(1), whole(a)), F.slice(again, F.lit(1), whole(n - a))), " ")).otherwise(text)

    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    return F.when((h % 10 == 0) & text.isNotNull(), F.get(F.transform(F.array(words), moved), F.lit(0))).otherwise(text)


def digests(found: DataFrame) -> DataFrame:
    """Count, longest run (ties: smallest start, then period) and digests of the runs and of the collapsed text."""
    longest = F.element_at(F.array_sort(F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period")))), 1)
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period"))), F.lit("\n"))), "")
    f = found.withColumn("m", F.when(F.size("runs") > 0, longest))
    return f.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("m.start").alias("start"), (-F.col("m.less")).alias("length"), F.col("m.period").alias("period"),
        F.floor(-1000 * F.col("m.less") / F.col("m.period")).cast("long").alias("exponent_milli"), F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
