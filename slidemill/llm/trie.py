"""Prefix trie of conversations: nodes in preorder, subtrees as intervals, their sums as differences of prefix sums."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slidemill.llm.common import checkpoint, few

EMPTY = hashlib.sha256(b"").hexdigest()


def running(df: DataFrame, order: list, keep: list[str], by: str | None = None, sums: tuple[str, ...] = (), xors: tuple[str, ...] = ()) -> DataFrame:
    """The ``keep`` columns of rows in a total order, with ``at`` (from 0) and ``name_run``, sums and bit sums up to and with each row.

    With ``by``, a long column without nulls that leads the order, all of them begin anew at each of its values. Rows are
    dealt to ranges of the order and folded range by range, in batches; what a range starts with is worked out from one row for each
    range. A value of ``by`` may span any number of ranges.
    """
    spark = df.sparkSession
    folds = [(c, np.add, True) for c in sums] + [(c, np.bitwise_xor, False) for c in xors]
    names = ["at", *(f"{c}_run" for c, _, _ in folds)]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, carried = TaskContext.get().partitionId(), None, [0] * len(names)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            first = np.zeros(n, bool)
            if by:
                value = batch.column(by).to_numpy(zero_copy_only=False)
                first[1:] = value[1:] != value[:-1]
                first[0] = value[0] != last
                last = int(value[-1])
            start = np.maximum.accumulate(np.where(first, np.arange(n), -1))  # where the row's group begins in this batch
            outs = []
            for i, (c, op, adds) in enumerate([(None, np.add, True), *folds]):
                x = np.ones(n, np.int64) if c is None else batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64)
                total = op.accumulate(x)
                before = np.where(start > 0, total[start - 1], 0)
                inside = total - before if adds else total ^ before
                out = np.where(start < 0, op(inside, carried[i]), inside)
                carried[i] = int(out[-1])
                outs.append(out - 1 if c is None else out)
            cols = [batch.column(c) for c in keep] + [pa.array(o) for o in outs] + [pa.array(np.full(n, part, np.int32))]
            yield pa.RecordBatch.from_arrays(cols, [*keep, *names, "_p"])

    read = list(dict.fromkeys([*keep, *([by] if by else []), *sums, *xors]))
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).select(read)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in (ranged.schema[c] for c in keep)), *(f"`{c}` bigint" for c in names), "_p int"])
    local = checkpoint(ranged.mapInArrow(work, schema))
    place = F.col(by) if by else F.lit(0)
    ends = local.groupBy("_p").agg(F.min(place).alias("first"), F.max(place).alias("last"), F.max_by(F.struct(*names), F.struct(place, "at")).alias("end")).orderBy("_p").collect()
    starts, group, held = [], None, [0] * len(names)
    for r in ends:
        here = [r["end"][c] for c in names]
        here[0] += 1
        if r["first"] != group:
            held = [0] * len(names)
        starts.append((r["_p"], r["first"], *held))
        if r["first"] == r["last"]:
            here = [a ^ b if c in {f"{x}_run" for x in xors} else a + b for a, b, c in zip(held, here, names, strict=True)]
        group, held = r["last"], here
    table = spark.createDataFrame(starts, ", ".join(["_p int", "_first bigint", *(f"`_{c}` bigint" for c in names)]))  # a row for each range
    goes_on = place == F.col("_first")
    op = lambda c: F.col(c).bitwiseXOR(F.col(f"_{c}")) if c in {f"{x}_run" for x in xors} else F.col(c) + F.col(f"_{c}")
    return local.join(F.broadcast(table), "_p").select(*keep, *(F.when(goes_on, op(c)).otherwise(F.col(c)).alias(c) for c in names))


def turns_of(conversations: DataFrame) -> DataFrame:
    """``conv_id, nth, h1, h2, chars``: turns by number (null first), then role and text, from 1, and what tells them apart (128 bits)."""
    t = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")))
    t = t.where("conv_id is not null").withColumns({"h1": F.xxhash64("role", "text"), "h2": F.xxhash64(F.lit(7), "text", F.lit(1), "role"), "chars": F.length("text").cast("long")})
    out = running(t, ["conv_id", F.col("turn").asc_nulls_first(), "role", "text"], ["conv_id", "h1", "h2", "chars"], by="conv_id")
    return out.select("conv_id", (F.col("at") + 1).alias("nth"), "h1", "h2", "chars")


def rebuilt(turns: DataFrame, group: int = 100, heads: int = 6) -> tuple[DataFrame, DataFrame]:
    """Turns ``conv_id, depth, h1, h2, chars`` of the rebuilt conversations, and all conversations ``conv_id``.

    Conversation c begins with the first h = crc32(c) % ``heads`` turns of conversation c - c % ``group`` and goes on with its own turns
    after its first h; at most ``group`` conversations share a beginning of less than ``heads`` turns.
    """
    h = (F.crc32(F.col("conv_id").cast("string")) % heads).cast("long")
    base = (F.col("conv_id") - F.col("conv_id") % group).alias("base")
    convs = turns.where("nth = 1").select("conv_id")
    head = turns.where((F.col("nth") < heads) & (F.col("conv_id") % group == 0)).withColumnRenamed("conv_id", "base")
    users = convs.select("conv_id", base, h.alias("h")).where("h > 0")
    begun = users.join(head, "base").where("nth <= h").select("conv_id", F.col("nth").alias("depth"), "h1", "h2", "chars")
    known = few(head.groupBy("base").agg(F.count(F.lit(1)).alias("held")))
    own = turns.withColumn("h", h).where("nth > h").withColumn("base", F.col("conv_id") - F.col("conv_id") % group).join(known, "base", "left")
    own = own.select("conv_id", (F.col("nth") - F.col("h") + F.least("h", F.coalesce("held", F.lit(0)))).alias("depth"), "h1", "h2", "chars")
    return begun.unionByName(own), convs


def ranked(turns: DataFrame, convs: DataFrame, chunk: int = 256) -> DataFrame:
    """``conv_id, at, ends``: conversations in the lexicographic order of their turns (equal ones by id), and their numbers of turns.

    A key is a list of at most ``chunk`` turns. Longer conversations are cut into such lists; distinct lists are numbered in their
    order, numbers take the place of turns, and so on until one list is left, so no conversation meets in one row.
    """
    ends = turns.groupBy("conv_id").agg(F.max("depth").alias("ends"))
    pair = lambda s: F.array(s["h1"], s["h2"])
    level = turns.groupBy("conv_id", F.expr(f"(depth - 1) div {chunk}").alias("nth")).agg(F.array_sort(F.collect_list(F.struct("depth", "h1", "h2"))).alias("s"))
    level = level.select("conv_id", "nth", F.flatten(F.transform("s", pair)).alias("key"))
    longest = ends.agg(F.max("ends")).first()[0] or 0
    while longest > chunk:
        longest = -(-longest // chunk)
        level = checkpoint(level)
        names = running(level.select("key").distinct(), ["key"], ["key"])
        level = level.join(names, "key").groupBy("conv_id", F.expr(f"nth div {chunk}").alias("up")).agg(F.array_sort(F.collect_list(F.struct("nth", "at"))).alias("s"))
        level = level.select("conv_id", F.col("up").alias("nth"), F.transform("s", lambda s: s["at"]).alias("key"))
    keyed = convs.join(level.select("conv_id", "key"), "conv_id", "left").join(ends, "conv_id", "left")
    keyed = keyed.select("conv_id", F.coalesce("key", F.array().cast("array<bigint>")).alias("key"), F.coalesce("ends", F.lit(0)).alias("ends"))
    return running(keyed, ["key", "conv_id"], ["conv_id", "ends"])


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over the pieces of each node in order; one piece is in memory at a time."""
    names = ["depth", "p1", "p2", "ends_sha256"]
    node, sha, done = None, None, []

    def flush() -> pa.RecordBatch:
        cols = list(zip(*done, strict=True))
        done.clear()
        return pa.RecordBatch.from_arrays([pa.array(cols[i], pa.int64()) for i in range(3)] + [pa.array(cols[3], pa.string())], names)

    for batch in batches:
        for *key, ids in zip(*(batch.column(c).to_pylist() for c in ("depth", "p1", "p2", "ids")), strict=True):
            if key == node:
                sha.update(b"," + ids.encode())
                continue
            if node is not None:
                done.append((*node, sha.hexdigest()))
            node, sha = key, hashlib.sha256(ids.encode())
        if len(done) > 10_000:
            yield flush()
    if node is not None:
        done.append((*node, sha.hexdigest()))
    if done:
        yield flush()


def ends_of(convs: DataFrame, piece: int = 4096) -> DataFrame:
    """``depth, p1, p2, ends_sha256`` of the nodes at which conversations end.

    ``at`` numbers equal conversations by id, so a node's ids are joined in pieces of ``at``, spread over tasks; the digest of a list
    is sequential by its definition and reads the pieces as a stream.
    """
    joined = convs.groupBy("depth", "p1", "p2", F.expr(f"at div {piece}").alias("piece")).agg(F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids"))
    sorted_ = joined.repartition("depth", "p1", "p2").sortWithinPartitions("depth", "p1", "p2", "piece").select("depth", "p1", "p2", "ids")
    return sorted_.mapInArrow(_hashed, "depth bigint, p1 bigint, p2 bigint, ends_sha256 string")


def prefix_trie(conversations: DataFrame, group: int = 100, heads: int = 6, chunk: int = 256) -> DataFrame:
    """One row for each distinct beginning of a rebuilt conversation (see ``rebuilt``), the empty one included.

    Returns ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``,
    ``ends_sha256``, and the preorder interval ``preorder, subtree_end`` (end exclusive).

    Conversations are numbered in lexicographic order; the members of a node stand together there, from f on, and sorting nodes
    by (f, depth) is preorder. A subtree ends where the first node of the conversation behind its last member begins, so leaves and savings
    are differences of prefix sums at two places.

    Nulls: role and text become empty, null turns come first, rows of null ids are left out. Turns of one number are ordered by role and
    text; repeated rows are turns of their own. A conversation whose rebuilt form has no turn is a member of the root alone. An empty
    table has no nodes. Equality of beginnings is that of 128 bits; no text is shuffled more than once. Other columns are not read.
    """
    turns, convs = rebuilt(turns_of(conversations), group, heads)
    rows = turns.withColumns({"t1": F.xxhash64("depth", "h1", "h2"), "t2": F.xxhash64("h2", "depth", F.lit(3), "h1")})
    rows = running(rows, ["conv_id", "depth"], ["conv_id", "depth", "h1", "h2", "t1", "t2", "chars"], by="conv_id", xors=("t1", "t2")).drop("at")
    order = checkpoint(ranked(rows, convs, chunk))
    total = order.agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("c"), F.count_if(F.col("ends") == 0).alias("e")).first()
    members = rows.join(order, "conv_id").select("conv_id", "depth", "chars", "at", "ends", F.col("t1_run").alias("p1"), F.col("t2_run").alias("p2"), F.col("t1_run").bitwiseXOR(F.col("t1")).alias("up1"), F.col("t2_run").bitwiseXOR(F.col("t2")).alias("up2"))
    members = checkpoint(members)
    nodes = members.groupBy("depth", "p1", "p2").agg(
        F.min("conv_id").alias("conv_id"), F.min("at").alias("f"), F.count(F.lit(1)).alias("n_convs"), F.count_if(F.col("ends") == F.col("depth")).alias("ended"), F.max("chars").alias("chars"), F.min("up1").alias("up1"), F.min("up2").alias("up2")
    )
    spark, zero = conversations.sparkSession, F.lit(0).cast("long")
    root = spark.range(1 if total["n"] else 0).select(
        zero.alias("depth"), zero.alias("p1"), zero.alias("p2"), F.lit(total["c"]).cast("long").alias("conv_id"), zero.alias("f"), F.lit(total["n"]).cast("long").alias("n_convs"), F.lit(total["e"]).cast("long").alias("ended"), zero.alias("chars"),
        F.lit(None).cast("long").alias("up1"), F.lit(None).cast("long").alias("up2"),
    )
    nodes = checkpoint(nodes.unionByName(root))
    up = ["depth", "p1", "p2"]
    above = nodes.where("depth > 0").select((F.col("depth") - 1).alias("depth"), F.col("up1").alias("p1"), F.col("up2").alias("p2"))
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("p1").alias("up1"), F.col("p2").alias("up2"), F.col("conv_id").alias("parent_conv_id"), F.col("f").alias("_f"))
    last = members.where("ends = depth").select("conv_id", "at", *up).unionByName(order.where("ends = 0").select("conv_id", "at", *(zero.alias(c) for c in up)))
    full = nodes.join(above.groupBy(*up).agg(F.count(F.lit(1)).alias("n_children")), up, "left").join(parents, ["depth", "up1", "up2"], "left").join(ends_of(last), up, "left")
    full = full.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", zero).alias("n_children"), F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"), "f", F.coalesce(F.col("_f") != F.col("f"), F.lit(True)).alias("begins"),
        (F.col("ended") == F.col("n_convs")).cast("long").alias("leaf"), ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"),
    )
    placed = running(full, ["f", "depth"], full.columns, sums=("leaf", "saved"))
    before = placed.withColumns({"leaf_run": F.col("leaf_run") - F.col("leaf"), "saved_run": F.col("saved_run") - F.col("saved")})
    all_ = placed.agg(F.count(F.lit(1)).alias("n"), F.sum("leaf").alias("leaf"), F.sum("saved").alias("saved")).first()
    # the first node of the conversation behind a subtree's last member
    next_ = before.where("begins").select(F.col("f").alias("x"), F.col("at").alias("_at"), F.col("leaf_run").alias("_leaf"), F.col("saved_run").alias("_saved"))
    out = before.withColumn("x", F.col("f") + F.col("n_convs")).join(next_, "x", "left")
    end = lambda c, t: F.coalesce(F.col(c), F.lit(t or 0).cast("long"))
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", (end("_leaf", all_["leaf"]) - F.col("leaf_run")).alias("n_leaves"), (end("_saved", all_["saved"]) - F.col("saved_run")).alias("saved_tokens"), "ends_sha256",
        F.col("at").alias("preorder"), end("_at", all_["n"]).alias("subtree_end"),
    )
