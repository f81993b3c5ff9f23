"""One text with many spans: work grows with text and spans, not with their product."""

from pyspark.sql import functions as F

from slidemill.llm import pii


def test_a_text_of_a_hundred_thousand_spans(spark):
    text = "".join(f"word name{i}@host{i}.com and some more é\U0001F600 words here, " for i in range(100_000))
    df = spark.createDataFrame([(1, text), (2, None), (3, "clean " * 3000), (1, text)], "doc_id long, text string").withColumn("n_chars", F.length("text").cast("long"))
    got = sorted(map(tuple, pii.redact(df).collect()), key=str)
    want = "word [EMAIL] and some more é\U0001F600 words here, " * 100_000
    assert got == sorted([(1, want, len(want)), (1, want, len(want)), (2, None, None), (3, "clean " * 3000, 18000)], key=str)


def test_spans_at_the_edges_of_blocks(spark):
    texts = [("é" * lead + " a@" + "b" * size + ".com +1 (437) 555-0689" + tail) for lead in range(pii.BLOCK - 14, pii.BLOCK + 3) for size, tail in ((5, ""), (3 * pii.BLOCK, " end"))]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.text for r in pii.redact(df).collect()}
    assert got == {i: "é" * t.index(" ") + " [EMAIL] [PHONE]" + (" end" if t.endswith(" end") else "") for i, t in enumerate(texts)}
