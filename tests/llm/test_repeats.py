"""Periodic runs against a loop over all periods."""

import hashlib
import random
import re
import zlib

import numpy as np

from slidemill.llm import queries, repeats


def runs(w, least=12):
    found = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            s = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            if i > s and i - s + q >= max(least, 2 * q):
                found.setdefault((s, i - s + q), q)
            i += 1
    return sorted((s, n, q) for (s, n), q in found.items())


def test_runs_equal_the_loop():
    r = random.Random(2)
    for _ in range(4000):
        n, k = r.randrange(130), r.choice([1, 2, 2, 3, 4, 30])
        w = [r.randrange(k) for _ in range(n)]
        for _ in range(r.randrange(4) if n else 0):
            a, p = r.randrange(n), 1 + r.randrange(n // 2 + 1)
            for i in range(a, min(n, a + r.randrange(2 * p, 6 * p + 1))):
                w[i] = w[a + (i - a) % p]
        least = r.choice([2, 12])
        assert repeats.find_runs(np.array(w, np.int64), least) == runs(w, least)


def test_long_texts_of_many_runs_end_soon():
    fib, b = [0], [0, 1]
    while len(b) < 3000:
        fib, b = b, b + fib
    for w in ([0] * 30000, [0] * 9000 + [1] + [0] * 9000, [i % 700 for i in range(30000)]):
        assert len(repeats.find_runs(np.array(w))) in (1, 2)
    assert repeats.find_runs(np.array(b)) == runs(b)


def want(rows):
    out = []
    for doc_id, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        n, h = len(words), zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
        found = runs(words)
        gone = {i for s, length, q in found for i in range(s + q, s + length)}
        top = min(((-length, s, q) for s, length, q in found), default=None)
        sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
        lines = "".join(f"{s},{length},{q}\n" for s, length, q in found)
        best = (top[1], -top[0], top[2], 1000 * -top[0] // top[2]) if top else (None,) * 4
        out.append((doc_id, len(found), *best, sha(lines), sha(" ".join(w for i, w in enumerate(words) if i not in gone))))
    return sorted(out, key=str)


def rows(df):
    return sorted(map(tuple, df.select("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256").collect()), key=str)


def test_query_on_the_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").where("length(text) < 20000").select("doc_id", "text").collect()
    got = rows(queries.op13_periodic_runs(spark, sf))
    held = {r.doc_id for r in docs}
    assert [r for r in got if r[0] in held] == want(map(tuple, docs))


def test_odd_rows_and_empty_table(spark, odd, empty):
    plain = want([(None, r.text) for r in odd.where("length(text) < 5000 or text is null").collect()])
    found = repeats.digests(repeats.periodic_runs(odd.where("length(text) < 5000 or text is null").withColumn("doc_id", odd.doc_id * 0)))
    # ids play no part in the operator; without one the query's planting follows the empty text's digest
    assert len(rows(found)) == len(plain)
    long = repeats.digests(repeats.periodic_runs(odd.where("doc_id = 6"))).first()
    assert (long.n_runs, long.start, long.length, long.period, long.exponent_milli) == (1, 0, 3000, 1, 3_000_000)
    assert long.collapsed_sha256 == hashlib.sha256(b"word").hexdigest()
    none = repeats.digests(repeats.periodic_runs(odd.where("doc_id in (1, 2, 3)"))).collect()
    assert len(none) == 3 and all(r.n_runs == 0 and r.start is None and r.runs_sha256 == r.collapsed_sha256 == hashlib.sha256(b"").hexdigest() for r in none)
    assert repeats.digests(repeats.periodic_runs(empty)).count() == 0
    signs = spark.createDataFrame([(1, "a b " * 6), (2, "a b " * 6)], "doc_id long, text string")
    assert rows(repeats.digests(repeats.periodic_runs(signs)))[0][1:6] == (1, 0, 12, 2, 6000)


def test_planting_equals_its_definition(spark):
    r = random.Random(1)
    ids = [(i, " \n".join(r.choice("abcdef") for _ in range(r.randrange(60)))) for i in range(600)] + [(None, "a b"), (None, None)]
    df = spark.createDataFrame(ids, "doc_id long, text string")
    from pyspark.sql import functions as F

    got = rows(repeats.digests(repeats.periodic_runs(df.select("doc_id", repeats.planted(F.col("doc_id"), F.col("text")).alias("text")))))
    assert got == want(ids)
