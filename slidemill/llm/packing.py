"""Packing documents into token sequences: shortest-pack-first over the length histogram."""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from slidemill.llm.common import checkpoint, slices, trim, trimmed
from slidemill.llm.tokens import WordCoder

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def pieces(docs: DataFrame, tokenizer_path: str, size: int, end_id: int = 1, remembered: int = 300_000) -> DataFrame:
    """Tokenise whole texts, append ``end_id`` and cut behind every ``size`` ids: ``(doc_id, start, length, ids_crc32, doc_tokens)``."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = WordCoder(tokenizer_path, lengths_only=False, limit=remembered)
        trim()  # the file's text and its parsed form are no longer needed
        tail, step = end_id.to_bytes(4, "little"), 4 * size
        for batch in slices(batches):
            doc_ids = batch.column(0).to_pylist()
            rows: list[tuple] = []
            at, ids = -1, bytearray()

            def close() -> None:
                ids.extend(tail)
                total, view = len(ids) // 4, memoryview(ids)
                rows.extend((doc_ids[at], o // 4, len(view[o : o + step]) // 4, zlib.crc32(view[o : o + step]), total) for o in range(0, len(ids), step))

            for i, codes in coder.batches(pc.fill_null(batch.column(1), "").to_pylist()):
                if i != at:
                    if at >= 0:
                        close()
                    at, ids = i, bytearray()
                ids += b"".join(codes)
            if at >= 0:
                close()
            cols = list(zip(*rows, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(trimmed(cut), PIECES)


def shortest_pack_first(histogram: dict[int, int], size: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Patterns ``(count, [(length, repeats), ...])`` covering the histogram.

    Lengths go longest first. All pieces of a length are placed together: into the open patterns with most space
    left (the shortest packs), splitting a pattern's count when only a part of it is used, else into new packs
    holding as many of the length as fit. Each step closes a length or a pattern, so the patterns number at most
    about twice the distinct lengths, whatever the number of documents.
    """
    open_, done, order = [], [], 0  # heap of (-space, order, count, parts)
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        back = []
        while left and open_ and -open_[0][0] >= length:
            space, _, count, parts = heapq.heappop(open_)
            fit = -space // length
            times = min(fit, max(1, left // count))
            used = count if left >= count * times else left // times
            if used < count:
                order += 1
                back.append((space, order, count - used, parts))
            order += 1
            entry = (space + times * length, order, used, [*parts, (length, times)])
            left -= used * times
            (back if -entry[0] >= length else done if entry[0] == 0 else back).append(entry)
            for e in [e for e in back if -e[0] >= length and left]:
                back.remove(e)
                heapq.heappush(open_, e)
        if left:
            fit = size // length
            full, rest = divmod(left, fit)
            for count, times in ((full, fit), (1 if rest else 0, rest)):
                if count:
                    order += 1
                    entry = (-(size - times * length), order, count, [(length, times)])
                    (done if entry[0] == 0 else back).append(entry)
        for e in back:
            heapq.heappush(open_, e)
    return [(count, parts) for _, _, count, parts in [*done, *sorted(open_)]]


def pack(docs: DataFrame, tokenizer_path: str, size: int = 2048, end_id: int = 1, buckets: int = 64, remembered: int = 300_000) -> DataFrame:
    """Pack all documents into sequences of at most ``size`` tokens.

    Returns one row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``. A document is
    its ids and then ``end_id``; it is cut behind every ``size`` ids, so only its last piece can be short. Only the
    length histogram (at most ``size`` rows) reaches the driver. Pieces are ranked within their length by counting
    per hash bucket first, so a length that a third of all pieces share is never one window, and slots are joined
    back by length and rank range (a pattern's repeats of a length are one slot of consecutive ranks).
    Null or empty text is the single piece ``[end_id]``; null ids stay null; repeated rows are packed as often as
    they stand; an empty table gives no rows. Extra columns are not read. A task keeps the ids of about ``remembered`` words in
    memory: fewer cost time, not rows.
    """
    spark = docs.sparkSession
    cut = checkpoint(pieces(docs, tokenizer_path, size, end_id, remembered))
    parts = max(1, min(100_000, cut.rdd.getNumPartitions()))
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    slots, base = [], 0
    taken = dict.fromkeys(histogram, 0)
    for count, pattern in shortest_pack_first(histogram, size):
        offset = 0
        for length, times in pattern:
            slots.append((length, taken[length], taken[length] + count * times, times, base, offset))
            taken[length] += count * times
            offset += length * times
        base += count
    if taken != histogram:
        raise AssertionError("patterns and histogram differ")
    # repeated rows stand in many partitions of the checkpoint, so they too are spread
    bucketed = cut.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32", F.spark_partition_id()), F.lit(max(buckets, 4 * parts))))
    counts = bucketed.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    within = Window.partitionBy("length", "bucket").orderBy("doc_id", "start", "ids_crc32")
    ranked = bucketed.withColumn("nth", F.row_number().over(within)).join(first, ["length", "bucket"]).withColumn("rank", F.col("first") + F.col("nth") - 1)
    # the slot table is bounded by the sequence size alone: about 2 patterns per length, at most 63 distinct lengths in each
    slot_df = spark.createDataFrame(slots or [(0, 0, 0, 1, 0, 0)], "length long, lo long, hi long, times long, base long, at long")
    lengths = slot_df.groupBy("length").agg(F.sort_array(F.collect_list(F.struct("lo", "hi", "times", "base", "at"))).alias("slots"))
    found = ranked.join(F.broadcast(lengths), "length").withColumn("s", F.filter("slots", lambda s: (s["lo"] <= F.col("rank")) & (F.col("rank") < s["hi"]))[0])
    return found.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        (F.col("s.base") + F.expr("(rank - s.lo) div s.times")).alias("sequence_id"),
        (F.col("s.at") + F.expr("(rank - s.lo) % s.times") * F.col("length")).alias("offset"),
    )
