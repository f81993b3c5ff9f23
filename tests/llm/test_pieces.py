"""SentencePiece against the library: ids, texts of ids, odd rows."""

import hashlib
import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from slidemill.llm import pieces, queries

MODEL = public_tokenizers.path(queries.PIECES)


@pytest.fixture(scope="module")
def library():
    return SentencePieceProcessor(model_file=MODEL)


def test_random_signs_equal_the_library(library):
    r = random.Random(4)
    signs = "abé日 ▁\n\t\x00 e t<s>0\U0001F600́ﬁ  "
    texts = ["".join(r.choice(signs) for _ in range(r.randrange(60))) for _ in range(4000)] + ["", " ", "   a", "a   ", "é" * 3000, "the" * 2000, "▁▁x", "</s><0x41>", "x" * 50000]
    coder = pieces.PieceCoder(MODEL, limit=500)
    theirs = library.encode(texts, add_eos=True)
    assert [memoryview(b).cast("i").tolist() if b else [] for b in coder.encode(texts)] == theirs
    assert [coder.decode(i) for i in theirs] == library.decode(theirs)


def test_any_ids_decode_as_the_library(library):
    r = random.Random(5)
    lists = [[r.choice([r.randrange(32000), r.randrange(260), r.randrange(4)]) for _ in range(r.randrange(9))] for _ in range(3000)]
    coder = pieces.PieceCoder(MODEL)
    assert [coder.decode(i) for i in lists] == library.decode(lists)


def test_query_on_the_table_and_on_odd_rows(spark, sf, odd, empty, library):
    def want(rows):
        out = []
        for r in rows:
            ids = library.encode(r.text or "", add_eos=True)
            sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
            out.append((r.doc_id, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids)), True))
        return sorted(out, key=str)

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert sorted(map(tuple, queries.op11_sentencepiece(spark, sf).collect()), key=str) == want(docs.collect())
    assert sorted(map(tuple, pieces.digests(pieces.encode(odd, MODEL, decoded=True)).collect()), key=str) == want(odd.collect())
    assert pieces.encode(empty, MODEL).count() == 0


def test_round_trip_of_the_two_operators(spark, odd, library):
    ids = pieces.encode(odd.where("doc_id is not null").dropDuplicates(["doc_id"]), MODEL, end=False)
    back = {r.doc_id: r.text for r in pieces.decode(ids, MODEL).collect()}
    assert back == {r.doc_id: library.decode(library.encode(r.text or "")) for r in odd.collect() if r.doc_id is not None}
    holes = spark.createDataFrame([(1, None), (2, []), (3, [28705, None, 28732])], "doc_id long, ids array<int>")
    assert {r.doc_id: r.text for r in pieces.decode(holes.withColumn("text", F.lit("x")), MODEL).collect()} == {1: "", 2: "", 3: library.decode([28705, 28732])}


def test_other_kinds_of_files_are_refused(tmp_path):
    with open(MODEL, "rb") as f:
        data = f.read()
    other = tmp_path / "other.model"
    # a later trainer message takes the place of the first: one of model type unigram
    other.write_bytes(data + b"\x12\x02\x18\x01")
    with pytest.raises(ValueError):
        pieces.PieceCoder(str(other))
