"""Shared helpers: table reading, lineage cutting and distributed connected components."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see, that of ``spark.checkpoint.dir``; a session without one must be given one."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named:
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(named)
    return sc.getCheckpointDir()


def slices(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The same rows in batches small enough that what is worked out for one stays small beside the executor."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def trim() -> None:
    """Give memory back that a finished task has freed: a worker process is kept, and its next task may belong to another operator."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only glibc has the call
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def trimmed(work):
    """An Arrow function that ends with ``trim``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(batches)
        finally:
            trim()

    return run


def trim_driver(spark: SparkSession) -> None:
    """``trim`` for the driver, its Python and its JVM: a session's next stage finds neither the broadcasts nor the freed memory of the last.

    The JVM's allocator keeps what compilers, threads and codecs have freed outside the heap until it is asked to trim.
    """
    trim()
    jvm, array = spark.sparkContext._jvm, spark.sparkContext._gateway.new_array
    jvm.System.gc()
    with contextlib.suppress(Py4JError):  # only newer JVMs on Linux have the command
        call, words, kinds = array(jvm.Object, 4), array(jvm.Object, 1), array(jvm.String, 1)
        words[0], kinds[0] = array(jvm.String, 0), "[Ljava.lang.String;"
        call[0], call[1], call[2], call[3] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap", words, kinds
        invoke = next(m for m in jvm.java.lang.Class.forName("javax.management.MBeanServer").getMethods() if m.getName() == "invoke")
        invoke.invoke(jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer(), call)


def bitmap(keys: DataFrame, bits: int = 1 << 26) -> np.ndarray:
    """Marks of the ``key`` values (long) in a table of fixed size, whatever their number; see ``marked``."""
    at = F.pmod(F.col("key"), F.lit(bits))
    rows = keys.groupBy(F.shiftright(at, 6).alias("at")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(key, {bits}) % 64 as int))")).alias("bits")).toArrow()
    words = np.zeros(bits // 64, np.int64)
    words[rows["at"].to_numpy().astype(np.int64)] = rows["bits"].to_numpy()
    return words


def marked(marks: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether a key's mark is set: always for keys of the bitmap, sometimes for others."""
    at = keys.astype(np.int64) % (len(marks) * 64)
    return (marks[at >> 6] >> (at & 63)) & 1 == 1


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def few(rows: DataFrame, most: int = 500_000) -> DataFrame:
    """Checkpointed rows of ids or counts, marked for broadcast if counted to be few (some 60 bytes each); else Spark shuffles."""
    rows = checkpoint(rows)
    return F.broadcast(rows) if rows.count() <= most else rows


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Smallest reachable id of every node of an undirected edge list.

    ``edges`` has two bigint columns ``u`` and ``v``. Returns ``(id, component)`` for each node with an edge to
    another node. Alternates large-star and small-star steps, all as grouped minima and equi-joins, so neither
    a component nor the edge list ever meets in one task; a hub's rows are joined to a single minimum, which
    AQE can split. Self loops and null ends are ignored.
    """
    cur = checkpoint(
        edges.where("u is not null and v is not null and u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )
    before = _signature(cur)
    for _ in range(max_rounds):
        if not before[0]:
            break
        # large star: every larger neighbour of u hangs on the smallest node around u
        both = cur.union(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = (
            both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        )
        # small star: u and its smaller neighbours hang on the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low, "u")
            .select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v")
            .where("u <> v")
            .distinct()
        )
        cur = checkpoint(small)
        after = _signature(cur)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    return cur.groupBy(F.col("u").alias("id")).agg(F.min("v").alias("component")).unionByName(
        cur.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    )


def labelled(docs: DataFrame, labels: DataFrame, column: str, broadcast_rows: int = 2_000_000) -> DataFrame:
    """``doc_id, text, y`` of the rows with a usable 0/1 label; an id labelled twice takes the larger one.

    The labels are broadcast only if counted to be few (16 bytes a row); beyond that Spark joins by shuffle.
    """
    y = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(column).cast("int").alias("y"))
        .where("doc_id is not null and y in (0, 1)")
        .groupBy("doc_id")
        .agg(F.max("y").alias("y"))
    )
    if labels.count() <= broadcast_rows:
        y = F.broadcast(y)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(y, "doc_id")


def fold(modulus: int):
    """The row's fold, from its id alone; null ids count as the empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % modulus


def fit_logistic(points: list[tuple[float, int, int]], l2: float = 1e-3, rounds: int = 100) -> tuple[float, float]:
    """Slope and intercept of P(y = 1 | x) over weighted points ``(x, y, rows)``, by damped Newton steps."""
    x, y, n = (np.array(c, float) for c in zip(*points, strict=True)) if points else (np.zeros(0),) * 3
    if not len(x) or not 0 < (y * n).sum() < n.sum():
        return 1.0, 0.0
    mid, spread = float((x * n).sum() / n.sum()), float(max(x.std(), 1e-9))
    z = (x - mid) / spread
    w = np.array([0.0, math.log((y * n).sum() / ((1 - y) * n).sum())])
    loss = lambda w: float((n * (np.logaddexp(0, w[0] * z + w[1]) - y * (w[0] * z + w[1]))).sum()) / n.sum() + l2 * w[0] ** 2 / 2
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(w[0] * z + w[1], -40, 40)))
        g = np.array([(n * (p - y) * z).sum(), (n * (p - y)).sum()]) / n.sum() + [l2 * w[0], 0]
        q = n * np.maximum(p * (1 - p), 1e-9) / n.sum()
        h = np.array([[(q * z * z).sum() + l2, (q * z).sum()], [(q * z).sum(), q.sum()]]) + 1e-9 * np.eye(2)
        step, size = np.linalg.solve(h, g), 1.0
        while size > 1e-4 and loss(w - size * step) > loss(w):
            size /= 2
        w = w - size * step
        if abs(size * step).max() < 1e-9:
            break
    return float(w[0] / spread), float(w[1] - w[0] * mid / spread)
