"""Streams in batches against the same rows at once."""

import json
import random

import pytest
from test_catalog import BOX

from slidemill.operators import catalog, review
from slidemill.schemas import CATALOG
from slidemill.streaming import live

EDIT = "seq long, action string, file_name string, box_id string, status string, label string, bbox array<long>"


def log(seed, n=220):
    r = random.Random(seed)
    edits, alive = [], set()
    for seq in range(n):
        file, box = r.choice("fgh"), f"b{r.randrange(9)}"
        action = r.choice(["update", "update", "update", "revert", "delete", "add", "bulk_update", "bulk_update"])
        if action == "bulk_update":
            edits.append((seq, action, r.choice([file, None, ""]), None, r.choice(["pending", "approved", "rejected"]), None, None))
        elif action == "add":
            box = f"n{r.randrange(12)}"
            if (file, box) not in alive:
                alive.add((file, box))
                edits.append((seq, action, file, box, None, r.choice([None, "", "cyst"]), [seq, 1, 2, 3]))
        else:
            box = r.choice([box, f"n{r.randrange(12)}"])
            alive -= {(file, box)} if action == "delete" else set()
            up = action == "update"
            edits.append((seq, action, file, box, r.choice([None, "approved", "pending"]) if up else None, r.choice([None, "worm"]) if up else None, [seq, 2, 3, 4] if up and seq % 5 == 0 else None))
    boxes = [(f, i, f"b{i}", i, 1, 5, 5, "egg", r.choice(["pending", "approved"]), "m", 0.5) for f in "fg" for i in range(6)]
    return boxes, edits


def rows(df):
    return sorted((r.file_name, r.id, r.status, r.label, r.x, r.method) for r in df.collect())


def write_batches(folder, edits, seed, n):
    """The edits in n files, dealt at random: late rows, rows of one box in several batches."""
    r = random.Random(seed)
    names = [c.split()[0] for c in EDIT.split(", ")]
    folder.mkdir()
    for i in range(n):
        (folder / f"{i}.json").write_text("\n".join(json.dumps({k: v for k, v in zip(names, e, strict=True) if v is not None}) for e in edits if r.randrange(n) == i or e[0] % n == i))


@pytest.mark.parametrize("seed", [1, 2])
def test_any_split_into_batches_gives_the_replay(spark, tmp_path, seed):
    boxes, edits = log(seed)
    base, df = spark.createDataFrame(boxes, BOX), spark.createDataFrame(edits, EDIT)
    want = rows(review.replay(base, df))
    write_batches(tmp_path / "log", edits, seed, 5)
    stream = live.edit_log(spark, str(tmp_path / "log")).dropDuplicates(["seq"])
    q = live.fold_edits(stream).writeStream.outputMode("complete").format("memory").queryName(f"folded{seed}").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    assert q.awaitTermination(180)
    last = spark.table(f"folded{seed}")
    assert rows(review.settle(base, review.added_boxes(df), last, review.bulk_actions(df))) == want


def test_fields_keep_their_own_order(spark):
    """A status of number 5 and a label of number 4 that comes a batch later."""
    base = spark.createDataFrame([("f", 0, "a", 0, 0, 5, 5, "egg", "pending", "m", 0.5)], BOX)
    e = spark.createDataFrame([(5, "update", "f", "a", "approved", None, None), (4, "update", "f", "a", None, "cyst", None), (1, "update", "f", "n", None, "early", None), (2, "add", "f", "n", None, None, [1, 1, 5, 5])], EDIT)
    assert rows(review.replay(base, e)) == [("f", "a", "approved", "cyst", 0, "m"), ("f", "n", "approved", "Noise", 1, "manual")]


def test_snapshot_and_tail_equal_the_log_at_every_cut(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(live, "SPAN", 64)
    boxes, edits = log(7, 180)
    base = spark.createDataFrame(boxes, BOX)
    want = rows(review.replay(base, spark.createDataFrame(edits, EDIT)))
    for cut in (0, 57, 128, 179):
        store = str(tmp_path / f"s{cut}")
        write_batches(tmp_path / f"log{cut}", edits, cut, 3)
        stream = live.edit_log(spark, str(tmp_path / f"log{cut}")).dropDuplicates(["seq"])
        assert live.record(stream, store, str(tmp_path / f"c{cut}")).awaitTermination(180)
        assert rows(live.current(spark, base, store)) == want
        assert rows(live.compact(spark, base, store, cut)) == want
        assert rows(live.compact(spark, base, store, cut)) == want  # a run again changes nothing
        assert rows(live.compact(spark, base, store, cut + 40)) == want
        assert rows(live.current(spark, base, store, ["f"])) == [r for r in want if r[0] == "f"]
    tail = live.log_after(spark, store, 150)
    assert min(r.seq for r in tail.collect()) > 150 and "span" in tail._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1][:80]


def test_ingest_batches_equal_the_batch_catalogue_and_repeat_nothing(spark, tmp_path):
    raw = tmp_path / "data" / "raw" / "Lab" / "Egg" / "me"
    raw.mkdir(parents=True)
    store, check = str(tmp_path / "catalogue"), str(tmp_path / "c")
    content = {"a": b"one", "b": b"two", "c": b"one", "d": b"three", "e": b"two"}
    for part in ("ab", "cd", "e"):
        for name in part:
            (raw / f"{name}.png").write_bytes(content[name])
        assert live.ingest(spark, str(tmp_path / "data" / "raw"), store, check).awaitTermination(180)
    got = {r.raw_filename: (r.status, r.image_id) for r in live.catalogue(spark, store).collect()}
    assert {k: v[0] for k, v in got.items()} == {"a.png": "new", "b.png": "new", "c.png": "duplicate", "d.png": "new", "e.png": "duplicate"}
    from slidemill.sources import files

    good, _ = files.raw_files(spark, str(tmp_path / "data" / "raw"))
    none = spark.createDataFrame([], CATALOG)
    assert got == {r.raw_filename: (r.status, r.image_id) for r in catalog.status_rows(good, none, none.select("canonical_name")).collect()}
    # the last batch once more, as after a lost commit: its partition is replaced, nothing is added
    import shutil

    for folder in ("commits",):
        last = max((tmp_path / "c" / folder).glob("[0-9]*"), key=lambda p: int(p.name))
        shutil.move(str(last), str(tmp_path / "gone"))
        (last.parent / f".{last.name}.crc").unlink(missing_ok=True)
    assert live.ingest(spark, str(tmp_path / "data" / "raw"), store, check).awaitTermination(180)
    assert {r.raw_filename: (r.status, r.image_id) for r in live.catalogue(spark, store).collect()} == got
    assert spark.read.parquet(store).count() == 5


def test_bulk_actions_with_an_outlying_number(spark):
    boxes = spark.createDataFrame([("f", i, f"b{i}", 0, 0, 5, 5, "egg", "pending", "m", 0.5) for i in range(50)], BOX)
    e = [(i, "revert", "f", f"b{i}", None, None, None) for i in range(50)] + [(25, "bulk_update", "f", None, "approved", None, None), (10**15, "bulk_update", None, None, "rejected", None, None)]
    got = {r.id: r.status for r in review.replay(boxes, spark.createDataFrame([x for x in e if x[0] != 25 or x[1] == "bulk_update"], EDIT)).collect()}
    assert got == {f"b{i}": "approved" if i <= 25 else "rejected" for i in range(50)}
