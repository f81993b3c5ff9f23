"""Licence scans by diagonal voting, in DataFrame functions only."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Base phrases and their labels.
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

# Well-known notice sentences and their labels.
NOTICES = (
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "mit"),
    ("licensed under the apache license version 2 0", "apache"),
    ("you may not use this file except in compliance with the license", "apache"),
    ("licensed under the gnu general public license version 3", "gpl"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "gpl"),
    ("under the terms of the gnu lesser general public license", "lgpl"),
    ("under the terms of the gnu affero general public license", "agpl"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that", "bsd"),
    ("this source code form is subject to the terms of the mozilla public license", "mpl"),
    ("licensed under a creative commons attribution", "cc"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "isc"),
    ("all rights reserved no part of this publication may be reproduced", "reserved"),
)

WORD_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
K = 2
_END = -7046029254386353131  # key of the row that every document sends along; words never reach it, see below


def ascii_lower(text: Column) -> Column:
    """A-Z to lower case only; plain ``lower`` where a text holds nothing beyond ASCII."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(text), WORD_GAP), "")


def templates(spark, base=BASE, notices=NOTICES) -> DataFrame:
    """One row for each word pair of each template; its size is that of the lists above, whatever the input."""
    rows = []
    for tpl, (text, label, is_base) in enumerate([*((t, n, True) for t, n in base), *((t, n, False) for t, n in notices)]):
        w = text.split()
        rows += [(tpl, label, is_base, len(w) - K + 1, at, w[at], w[at + 1]) for at in range(len(w) - K + 1)]
    grams = spark.createDataFrame(rows, "tpl int, label string, is_base boolean, grams int, at int, ta string, tb string")
    return grams.withColumn("h", F.xxhash64("ta", "tb")).unionByName(
        spark.createDataFrame([(-1, "", False, 1, 0, "", "", _END)], "tpl int, label string, is_base boolean, grams int, at int, ta string, tb string, h long")
    )


def scan(docs: DataFrame, min_cover: float = 0.6, slack: int = 3, stretch: int = 2) -> DataFrame:
    """Licence phrases of every whole text.

    Returns ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score`` and, for further use,
    ``spans``: an array of ``(label, start, end, cover)`` in words, end exclusive.

    Every rolling word pair is hashed and Spark-joined to the template positions (a table of fixed size, so
    broadcast); hits are counted by (document, template, offset diagonal); diagonals at most ``slack`` apart are
    merged; a merged span longer than ``stretch`` times its template gives way to its best single diagonal; a span stands
    if the words themselves agree and it covers ``min_cover`` of its template, a base phrase only if it is complete on
    one diagonal. One narrow pass over the texts; only hits and one row for each document
    are shuffled. ``score`` is the largest cover, 1 for a base phrase, 0 without any span.

    Null or empty text: no words, counts 0, first/last null, labels empty. Null ids and repeated rows stay, one
    result for each input row. Other columns are not read.
    """
    tpl = F.broadcast(templates(docs.sparkSession))
    rows = (
        docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), words(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("w"))
        .withColumn("n_words", F.size("w").cast("long"))
    )
    pair = lambda a, b: F.struct(F.xxhash64(a, b).alias("h"), a.alias("a"), b.alias("b"))
    # the last element has no partner word: it carries the document itself, under a key and two empty words that no pair of words has
    grams = F.zip_with("w", F.slice("w", 2, F.greatest(F.size("w"), F.lit(1))), pair)
    end = F.array(F.struct(F.lit(_END).alias("h"), F.lit("").alias("a"), F.lit("").alias("b")))
    hits = (
        rows.select("row", "doc_id", "n_words", F.posexplode(F.concat(grams, end)).alias("pos", "g"))
        .select("row", "doc_id", "n_words", "pos", "g.h", "g.a", "g.b")
        .join(tpl, "h")
        .where((F.col("a") == F.col("ta")) & (F.col("b") == F.col("tb")))
    )
    diagonals = hits.groupBy("row", "doc_id", "n_words", "tpl", "label", "is_base", "grams", (F.col("pos") - F.col("at")).alias("diag")).agg(
        F.collect_set("at").alias("ats"), F.min("pos").alias("lo"), F.max("pos").alias("hi")
    )
    by = Window.partitionBy("row", "tpl").orderBy("diag")
    fresh = F.col("is_base") | (F.col("diag") - F.lag("diag").over(by) > slack) | F.lag("diag").over(by).isNull()
    merged = (
        diagonals.withColumn("run", F.sum(F.when(fresh, 1).otherwise(0)).over(by))
        .groupBy("row", "doc_id", "n_words", "tpl", "label", "is_base", "grams", "run")
        .agg(
            F.struct(F.size(F.array_distinct(F.flatten(F.collect_list("ats")))).alias("voted"), F.min("lo").alias("lo"), F.max("hi").alias("hi")).alias("whole"),
            F.max(F.struct(F.size("ats").alias("voted"), (-F.col("lo")).alias("lo"), "hi")).alias("best"),
        )
        .withColumn("fits", F.col("whole.hi") + K - F.col("whole.lo") <= stretch * (F.col("grams") + K - 1))
        .withColumn("voted", F.when(F.col("fits"), F.col("whole.voted")).otherwise(F.col("best.voted")))
        .withColumn("start", F.when(F.col("fits"), F.col("whole.lo")).otherwise(-F.col("best.lo")).cast("long"))
        .withColumn("end", (F.when(F.col("fits"), F.col("whole.hi")).otherwise(F.col("best.hi")) + K).cast("long"))
        .withColumn("cover", F.col("voted") / F.col("grams"))
    )
    stands = (F.col("tpl") >= 0) & F.when(F.col("is_base"), F.col("voted") == F.col("grams")).otherwise(F.col("cover") >= min_cover)
    base = stands & F.col("is_base")
    joined = lambda c: F.array_join(F.array_sort(c), ",")
    return (
        merged.groupBy("row", "doc_id", "n_words")
        .agg(
            F.count(F.when(base, 1)).alias("n_base"),
            F.min(F.when(base, F.col("start"))).alias("first_word"),
            F.max(F.when(base, F.col("start"))).alias("last_word"),
            joined(F.collect_set(F.when(base, F.col("label")))).alias("base_labels"),
            joined(F.collect_set(F.when(stands, F.col("label")))).alias("labels"),
            F.coalesce(F.max(F.when(stands, F.col("cover"))), F.lit(0.0)).alias("score"),
            F.array_sort(F.collect_list(F.when(stands, F.struct("start", "end", "label", "cover")))).alias("spans"),
        )
        .drop("row")
    )


def oracle_sql(min_cover: float = 0.6, slack: int = 3, stretch: int = 2) -> str:
    """The same scan as DuckDB SQL, by plain pair joins."""
    values = ", ".join(
        f"({i}, '{n}', {str(b).lower()}, {len(t.split()) - 1}, {a}, '{t.split()[a]}', '{t.split()[a + 1]}')"
        for i, (t, n, b) in enumerate([*((t, n, True) for t, n in BASE), *((t, n, False) for t, n in NOTICES)])
        for a in range(len(t.split()) - 1)
    )
    return rf"""
WITH tpl(tpl, label, is_base, grams, tat, ta, tb) AS (VALUES {values}),
d AS (SELECT row_number() OVER () AS row, doc_id,
        regexp_extract_all(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
      FROM documents),
e AS (SELECT row, w, unnest(range(1, len(w))) AS i FROM d),
g AS (SELECT row, i - 1 AS pos, w[i] AS a, w[i + 1] AS b FROM e),
h AS (SELECT row, tpl, label, is_base, grams, pos - tat AS diag, min(pos) AS lo, max(pos) AS hi, list(tat) AS ats
      FROM g JOIN tpl ON a = ta AND b = tb GROUP BY ALL),
r AS (SELECT *, CASE WHEN is_base OR coalesce(diag - lag(diag) OVER (PARTITION BY row, tpl ORDER BY diag) > {slack}, true) THEN 1 ELSE 0 END AS fresh FROM h),
s AS (SELECT *, sum(fresh) OVER (PARTITION BY row, tpl ORDER BY diag) AS run FROM r),
p AS (SELECT row, tpl, label, is_base, grams, run, len(list_distinct(flatten(list(ats)))) AS v, min(lo) AS lo, max(hi) AS hi, max(struct_pack(v := len(ats), lo := -lo, hi := hi)) AS best FROM s GROUP BY ALL),
m AS (SELECT row, tpl, label, is_base, grams, CASE WHEN hi + {K} - lo <= {stretch} * (grams + {K - 1}) THEN v ELSE best.v END AS voted,
        CASE WHEN hi + {K} - lo <= {stretch} * (grams + {K - 1}) THEN lo ELSE -best.lo END AS start FROM p),
k AS (SELECT *, voted / grams AS cover FROM m WHERE CASE WHEN is_base THEN voted = grams ELSE voted / grams >= {min_cover} END)
SELECT d.doc_id AS doc_id, CAST(len(any_value(d.w)) AS BIGINT) AS n_words,
  count(CASE WHEN is_base THEN 1 END) AS n_base,
  CAST(min(CASE WHEN is_base THEN start END) AS BIGINT) AS first_word,
  CAST(max(CASE WHEN is_base THEN start END) AS BIGINT) AS last_word,
  coalesce(array_to_string(list_sort(list_distinct(list(label) FILTER (is_base))), ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list(label) FILTER (label IS NOT NULL))), ','), '') AS labels,
  coalesce(max(cover), 0.0) AS score
FROM d LEFT JOIN k USING (row) GROUP BY d.row, d.doc_id
"""
