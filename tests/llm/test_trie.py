"""The prefix trie against plain dictionaries of tuples."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from slidemill.llm import queries, trie

COLS = "conv_id long, turn long, role string, text string"


def brute(rows, group=100, heads=6):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v)] for c, v in convs.items()}
    full = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % heads
        full[c] = tuple(own.get(c - c % group, [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, turns in full.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    kids = defaultdict(list)
    for node in members:
        if node:
            kids[node[:-1]].append(node)

    def below(node):
        leaves, saved = int(not kids[node]), (len(members[node]) - 1) * (len(node[-1][1]) if node else 0)
        for k in kids[node]:
            a, b = below(k)
            leaves, saved = leaves + a, saved + b
        return leaves, saved

    out = set()
    for node, c in members.items():
        ends = ",".join(str(x) for x in sorted(x for x in c if full[x] == node))
        out.add((min(c), len(node), min(members[node[:-1]]) if node else None, len(c), len(kids[node]), *below(node), hashlib.sha256(ends.encode()).hexdigest()))
    return out


def got(df):
    rows = df.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect()
    assert len(rows) == len({tuple(r) for r in rows})
    return {tuple(r) for r in rows}


def some(seed, n):
    r = random.Random(seed)
    rows = []
    for c in r.sample(range(450), n):
        for t in range(r.choice([0, 1, 2, 3, 5, 8, 9])):
            rows.append((c, r.choice([t, t, t, None]), r.choice(["user", "user", None, ""]), r.choice(["a", "a", "b", "é\U0001F600 long", "", None])))
    return rows


@pytest.mark.parametrize("chunk", [2, 256])
def test_nodes_equal_the_dictionary(spark, chunk):
    rows = some(3, 250)
    assert got(trie.prefix_trie(spark.createDataFrame(rows, COLS).repartition(5), chunk=chunk)) == brute(rows)


def test_on_the_table(spark, sf):
    df = spark.read.parquet(f"{sf}/conversations.parquet")
    assert got(queries.op12_prefix_trie(spark, sf)) == brute([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])


def test_copies_hot_conversation_and_odd_rows(spark):
    rows = [(c, t, "user", "hello" if t == 0 else "same") for c in range(100, 180) for t in range(7)]
    rows += [(7, t, "user", str(t % 3)) for t in range(900)]  # one long conversation
    rows += [(7, 5, "user", "2"), (7, 5, "user", "2"), (None, 0, "user", "lost"), (None, None, None, None), (8, None, None, None), (200, 1, "user", "tie"), (200, 1, "tool", "tie")]
    df = spark.createDataFrame(rows, COLS).withColumns({c: F.lit("x") for c in ("at", "depth", "key", "base", "h1", "_p")})
    out = trie.prefix_trie(df, chunk=64)
    assert got(out) == brute(rows)
    # preorder: every subtree is an interval that lies within its parent's
    place = {(r.conv_id, r.depth): (r.preorder, r.subtree_end) for r in out.collect()}
    for r in out.collect():
        assert r.preorder < r.subtree_end
        if r.depth:
            a, b = place[r.parent_conv_id, r.depth - 1]
            assert a < r.preorder and r.subtree_end <= b
    assert sorted(p[0] for p in place.values()) == list(range(len(place)))


def test_empty_table(spark):
    assert trie.prefix_trie(spark.createDataFrame([], COLS)).count() == 0


def test_running_over_ranges(spark):
    r = random.Random(9)
    rows = [(r.choice([1, 1, 1, 1, 2, 3, 9]), i, r.randrange(100), r.getrandbits(63)) for i in range(2000)]
    df = spark.createDataFrame(rows, "g long, i long, v long, b long").repartition(6)
    for by in (None, "g"):
        want, n, s, x, last = set(), 0, 0, 0, None
        for g, i, v, b in sorted(rows):
            if by and g != last:
                n, s, x, last = 0, 0, 0, g
            s, x = s + v, x ^ b
            want.add((g, i, n, s, x))
            n += 1
        out = trie.running(df, ["g", "i"], ["g", "i"], by=by, sums=("v",), xors=("b",))
        assert {(q.g, q.i, q.at, q.v_run, q.b_run) for q in out.collect()} == want
