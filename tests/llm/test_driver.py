"""A stage of the pipeline begins with a driver that has given back the memory of the stages before it."""

import re
from pathlib import Path

import corpus_pipeline
import pytest


def resident(pid: int) -> float:
    """MB of a process without mapped files."""
    return sum(map(int, re.findall(r"\nPss_(?:Anon|Shmem):\s+(\d+)", Path(f"/proc/{pid}/smaps_rollup").read_text()))) / 1024


@pytest.mark.parametrize("stage", [name for name, _ in corpus_pipeline.STAGES])
def test_freed_native_memory_is_given_back(spark, sf, monkeypatch, stage):
    for name in ("drop_toxic", "keep_one", "redact", "keep_mixed", "pack"):
        monkeypatch.setattr(corpus_pipeline, name, lambda docs, *_, **__: docs)
    jvm = spark.sparkContext._jvm
    pid = int(jvm.java.lang.ProcessHandle.current().pid())
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    held = [jvm.java.util.zip.Deflater() for _ in range(600)]  # each has some 200 KB outside the heap
    for d in held[:-1]:
        d.end()
    for _ in range(2):
        jvm.System.gc()
    before = resident(pid)
    dict(corpus_pipeline.STAGES)[stage](spark, docs, sf)
    assert before - resident(pid) > 25
    held[-1].end()
