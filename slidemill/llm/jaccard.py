"""N-gram Jaccard join by T-occurrence search, giving the components of linked documents.

The plan, for sets of distinct word shingles and links where ``den * |A & B| >= num * |A | B|``:

1. A narrow pass makes the sets. A linked set shares all but ``n - ceil(num * n / den)`` of its shingles with its
   partner alone, so a set with more shingles that no other document holds links with nothing. That is counted over a
   fixed share of the universe of shingle hashes: each slice of a partition combines its own, sends one row for each
   shingle, and one shuffle counts them. Equal sets turn into an edge at once and go on as one.
2. The texts of the documents left are written once. Another pass turns each into signatures. The universe of shingle
   hashes is dealt into ``k`` parts; two linked sets differ in at most ``d`` shingles, so with ``k > d`` parts at least
   one part is the same in both. Parts of a single shingle are as good as empty, and parts are made of the uncommon
   shingles where those suffice, so that a shared passage alone makes no candidates. Which shingles are marked as
   common has no bearing on the result, only on the work.
3. Documents sharing a signature are candidates; components of the candidate graph are blocks. Each document of a block
   of two or more goes to its block once.
4. In a block, an inverted index of the sets answers a T-occurrence query for each document (DivideSkip): the lists of
   rare shingles are merged and counted, the long ones only probed for ids still able to reach the overlap.
   Pairs already in one component are not looked at again. A large block is cut into chunks, each with the same few
   anchor documents; afterwards the documents outside the block's main component query every chunk, in groups of
   bounded size, so no link is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from slidemill.llm.common import checkpoint, connected_components, few, slices, trimmed

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def _mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (splitmix)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Known(dict):
    """Hashes of words, worked out when first asked for."""

    def __init__(self):
        import xxhash

        super().__init__()
        self.one = xxhash.xxh3_64_intdigest

    def __missing__(self, word):
        self[word] = h = self.one(word)
        return h


class WordHasher:
    """Stable 64-bit hashes of words, remembered up to a limit."""

    def __init__(self, limit: int = 200_000):
        self.known, self.limit = _Known(), limit

    def __call__(self, words: list) -> np.ndarray:
        if len(self.known) > self.limit:
            self.known.clear()
        return np.fromiter(map(self.known.__getitem__, words), np.uint64, len(words))


#: Odd multipliers of a shingle's words.
_ODD = [np.uint64((2 * i + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1 | 1) for i in range(64)]


_SOLID = np.ones(256, bool)
_SOLID[[9, 10, 11, 12, 13, 32]] = False
#: A random number for each byte at each of 64 places of a word.
_PLACED = _mix(np.arange(1 << 14, dtype=np.uint64) + np.uint64(0x9E3779B97F4A7C15))


def _hash_words(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and starts of the words of lower-cased bytes: a word's hash mixes the sum of its bytes' random numbers."""
    b = np.frombuffer(data, np.uint8)
    solid = np.zeros(len(b) + 2, bool)
    solid[1:-1] = _SOLID[b]
    edge = np.flatnonzero(solid[1:] != solid[:-1])
    if not len(edge):
        return np.empty(0, np.uint64), edge
    sizes = edge[1::2] - edge[::2]
    first = np.cumsum(sizes) - sizes
    held = b[solid[1:-1]]
    place = np.arange(len(held), dtype=np.int32) - np.repeat(first.astype(np.int32), sizes)
    v = _PLACED[(place & 63) << 8 | held]
    if sizes.max() > 64:
        far = place > 63
        v[far] = _mix(v[far] + (place[far] >> 6).astype(np.uint64))
    return _mix(np.add.reduceat(v, first)), edge[::2]


def hashed(texts: list[str | None], block: int = 1 << 20) -> Iterator[np.ndarray]:
    """64-bit hashes of each text's words, in order: runs other than ``[\\x20\\x09-\\x0D]``, A-Z lower-cased.

    Short texts are worked off together, long ones in blocks that end at a blank; an array is the caller's to change.
    """
    held, size = [], 0

    def flush() -> Iterator[np.ndarray]:
        h, starts = _hash_words(b"\n".join(held).translate(_LOWER))
        ends = np.searchsorted(starts, np.cumsum([len(t) + 1 for t in held])) if held else []
        at = 0
        for end in ends:
            yield h[at:end]
            at = end

    for text in texts:
        data = (text or "").encode()
        if len(data) > block:
            yield from flush()
            held, size, at, parts = [], 0, 0, []
            while at < len(data):
                end = data.find(b" ", at + block)
                end = len(data) if end < 0 else end
                parts.append(_hash_words(data[at:end].translate(_LOWER))[0])
                at = end
            yield np.concatenate(parts)
            continue
        held.append(data)
        size += len(data)
        if size > block:
            yield from flush()
            held, size = [], 0
    yield from flush()


def word_hashes(text: str | None, block: int = 1 << 20) -> np.ndarray:
    return next(hashed([text], block))


def distinct(h: np.ndarray) -> np.ndarray:
    """Sorted distinct values; sorts ``h`` in place."""
    if len(h) < 2:
        return h
    h.sort()
    fresh = np.empty(len(h), bool)
    fresh[0] = True
    np.not_equal(h[1:], h[:-1], out=fresh[1:])
    return h[fresh]


def shingle_set(h: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a text's word hashes; fewer words are one shingle, no words none."""
    return distinct(shingle_hashes(h, size)) if len(h) else h


def shingle_hashes(h: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all shingles of a sequence of word hashes, in their order."""
    n, held = max(1, len(h) - size + 1), min(size, len(h))
    out = np.full(n, held, np.uint64)
    for i in range(held):
        out += h[i : i + n] * _ODD[i % 64]
    return _mix(out)


def levels_of(n: int, num: int, den: int) -> list[tuple[int, int]]:
    """``(level, largest size)`` of the size levels a set of ``n`` takes part in.

    A pair belongs to the level of its larger set, so a set also joins the next level if a partner there could link.
    """
    ratio = max(1.4, 1.05 * den / num)  # a partner is at most one level up
    level, top = 0, 1
    while top < n:
        level, top = level + 1, max(top + 1, int(top * ratio))
    out = [(level, top)]
    if den * n >= num * (top + 1):
        out.append((level + 1, max(top + 1, int(top * ratio))))
    return out


CELLS = 22  # bits of the table that counts shingles


def rounds(d: int) -> list[tuple[int, int]]:
    """``(parts, shingles that a part needs)`` of the rounds of a level whose linked sets differ in at most ``d``."""
    spare = 1 + d // 16
    return [(d + 1 + spare * times, least) for least in ((2, 1) if d >= 32 else (1,)) for times in (1, 2, 4, 8)]


def signatures(sets: np.ndarray, num: int, den: int, common: np.ndarray | None = None) -> np.ndarray:
    """Hashes of the parts of a set, for each level and round.

    A set of ``n`` differs from a linked one of size up to ``top`` in at most ``own = (n + top) (den - num) / (den +
    num)`` shingles. A round deals the shingles to ``k`` parts; parts of less than ``least`` shingles make no signature,
    as one frequent expression would join strangers. A set with more than ``own`` signatures closes there: any linked
    set has an equal part among them. It takes part in all rounds before that too. Shingles marked in ``common`` are
    left out; a set that closes no round without them adds the signatures of all its shingles, where a set that closes
    none at all ends with every part, empty ones too. So two linked sets share a signature in the first round that
    either of them closes, or else at the common end.
    """
    out = []
    basis = sets if common is None else sets[~common[(sets >> np.uint64(64 - CELLS)).astype(np.int64)]]
    for level, top in levels_of(len(sets), num, den):
        own = (len(sets) + top) * (den - num) // (den + num)
        for turn, (k, least) in enumerate(rounds(2 * top * (den - num) // (den + num))):
            salt = np.uint64((level * 32 + turn * 2 + (common is None)) * 0x9E3779B97F4A7C15 + 1 & (1 << 64) - 1)
            part = (_mix(basis ^ salt) >> np.uint64(32)) * np.uint64(k) >> np.uint64(32)
            order = np.argsort(part.astype(np.uint16) if k < 65536 else part, kind="stable")
            ranked = part[order]
            cuts = np.flatnonzero(np.diff(ranked, prepend=np.uint64(k)))
            body = np.add.reduceat(_mix(basis[order] + salt), cuts) if len(cuts) else np.empty(0, np.uint64)  # sets are distinct, so a sum is a fair set hash
            used = ranked[cuts]
            marks = _mix(body ^ _mix(used + salt))
            strong = np.diff(cuts, append=len(ranked)) >= least
            out.append(marks[strong])
            if strong.sum() > own:
                break
        else:
            if common is None:
                empty = np.setdiff1d(np.arange(k, dtype=np.uint64), used)
                out += [marks, _mix(_mix(empty + salt) ^ np.uint64(0xA5A5A5A5A5A5A5A5))]
            else:
                out.append(signatures(sets, num, den))
    return distinct(np.concatenate(out))


def common_shingles(docs: DataFrame, size: int, least: int = 24, above_mean: int = 4) -> np.ndarray:
    """Marks of the table cells whose shingles stand in many documents: at least ``least`` and ``above_mean`` times the mean."""
    cells = 1 << CELLS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(cells, np.uint32)
        for batch in slices(batches):
            for h in hashed(batch.column(0).to_pylist()):
                table[(shingle_set(h, size) >> np.uint64(64 - CELLS)).astype(np.int64)] += 1
        at = np.flatnonzero(table >= 4)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1), pa.int32()), pa.array(np.append(table[at], table.sum(dtype=np.int64)), pa.int64())], ["cell", "n"])

    sums = docs.select(F.col("text").cast("string")).mapInArrow(trimmed(count), "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    # one row for each cell at most, whatever the input; one of them holds the total
    found = sums.where(F.col("n") >= least).toArrow()
    cell, n = found["cell"].to_numpy(), found["n"].to_numpy()
    marks = np.zeros(cells, bool)
    marks[cell[(cell >= 0) & (n >= above_mean * n[cell < 0].sum() / cells)]] = True
    return marks


def linked(common: int, a: int, b: int, num: int, den: int) -> bool:
    return den * common >= num * (a + b - common)


class Forest:
    """Union-find over positions, smaller root first."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True


def divide_skip(sets: list[np.ndarray], asks: list[int], start: list[int], num: int, den: int, mu: float = 0.01) -> list[tuple[int, int]]:
    """Links that join components: T-occurrence searches of the sets ``asks`` over an index of all ``sets``.

    ``start`` gives each position's component so far; pairs inside one component are skipped, and a found pair is
    returned only if it joins two. For a query of n shingles every partner holds at least
    ``T = ceil(num * n / den)`` of them (a partner of size m holds at least ``num (n + m) / (num + den)``). The ``L``
    longest lists are set aside; ids met fewer than ``T - L`` times in the merged short lists cannot get there, the
    others are probed in the long lists by binary search.
    """
    forest = Forest(len(sets))
    by_label: dict[int, int] = {}
    for i, label in enumerate(start):
        if label in by_label:
            forest.join(by_label[label], i)
        else:
            by_label[label] = i
    sizes = np.array([len(s) for s in sets], np.int64)
    flat = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    owner = np.repeat(np.arange(len(sets), dtype=np.int64), sizes)
    keys, term = np.unique(flat, return_inverse=True)
    order = np.argsort(term, kind="stable")
    lists = owner[order]  # ids of one term together, rising
    place = term[order] * len(sets) + lists  # (term, id) as one rising number, for probes
    ends = np.cumsum(np.bincount(term, minlength=len(keys)))
    begins = ends - np.bincount(term, minlength=len(keys))
    first = np.cumsum(sizes) - sizes
    asked = np.zeros(len(sets), bool)
    asked[asks] = True
    edges = []
    roots = np.array([forest.root(i) for i in range(len(sets))])
    for q in asks:
        n = int(sizes[q])
        if not n:
            continue
        terms = term[first[q] : first[q] + n]
        lengths = ends[terms] - begins[terms]
        if (lengths > 1).sum() * den < num * n:
            continue
        by_length = terms[np.argsort(lengths, kind="stable")]
        need = -(-num * n // den)
        longest = int(lengths.max())
        n_long = min(int(need / (mu * np.log2(max(2, longest)) + 1)), need - 1, int((lengths > 8).sum()))
        short, long = by_length[: n - n_long], by_length[n - n_long :]
        sizes_short = ends[short] - begins[short]
        merged = lists[np.arange(sizes_short.sum()) + np.repeat(begins[short] - np.cumsum(sizes_short) + sizes_short, sizes_short)]
        hits = np.bincount(merged, minlength=len(sets)) if len(merged) * 4 > len(sets) else None
        if hits is None:
            ids, count = np.unique(merged, return_counts=True)
        else:
            ids = np.flatnonzero(hits)
            count = hits[ids]
        fits = (count >= need - n_long) & (den * np.minimum(sizes[ids], n) >= num * np.maximum(sizes[ids], n)) & (~asked[ids] | (ids > q)) & (ids != q)
        ids, count = ids[fits], count[fits]
        other = roots[ids] != roots[q]
        ids, count = ids[other], count[other]
        least = -(-num * (n + sizes[ids]) // (num + den))
        for at in range(0, n_long, 16):
            ok = count + (n_long - at) >= least
            ids, count, least = ids[ok], count[ok], least[ok]
            if not len(ids):
                break
            probe = long[at : at + 16, None] * len(sets) + ids[None, :]
            found = place[np.minimum(np.searchsorted(place, probe), len(place) - 1)] == probe
            count = count + found.sum(0)
        changed = False
        for i, c in zip(ids.tolist(), count.tolist(), strict=True):
            if linked(c, n, int(sizes[i]), num, den) and forest.join(q, i):
                edges.append((q, i))
                changed = True
        if changed:
            roots = np.array([forest.root(i) for i in range(len(sets))]) if len(edges) % 64 == 0 else _touch(roots, forest, q, ids)
    return edges


def _touch(roots: np.ndarray, forest: Forest, q: int, ids: np.ndarray) -> np.ndarray:
    """Give all members of the components just joined their common root."""
    old = np.unique(np.append(roots[ids], roots[q]))
    roots[np.isin(roots, [r for r in old if forest.root(int(r)) == forest.root(q)])] = forest.root(q)
    return roots


SCHEMA = "kind byte, key long, doc long, val long"
NODE, SET, SHARED, EQUAL, NEED = range(5)


class Rows:
    """Columns of ``(kind, key, doc, val)`` rows on their way out; a null document is given as None."""

    def __init__(self):
        self.parts: list[tuple] = []

    def put(self, kind: int, key, doc, val) -> None:
        n = max(len(x) for x in (key, doc, val) if isinstance(x, np.ndarray))
        full = lambda x: x.astype(np.int64) if isinstance(x, np.ndarray) else np.full(n, 0 if x is None else x, np.int64)
        self.parts.append((np.full(n, kind, np.int8), full(key), full(doc), full(val), np.full(n, doc is None)))

    def batch(self) -> pa.RecordBatch:
        columns = [np.concatenate(c) for c in zip(*self.parts, strict=True)] if self.parts else [np.empty(0, t) for t in (np.int8, np.int64, np.int64, np.int64, bool)]
        self.parts = []
        return pa.RecordBatch.from_arrays([*map(pa.array, columns[:2]), pa.array(columns[2], mask=columns[4]), pa.array(columns[3])], ["kind", "key", "doc", "val"])


def _sharing(docs: DataFrame, size: int, num: int, den: int, share: float) -> DataFrame:
    """Rows about every document: ``NODE`` its set size, ``SET`` its set's hash in ``key`` and ``val``, ``EQUAL`` an equal
    set met before, ``NEED`` how many more of its counted shingles must stand elsewhere, ``SHARED`` one of them."""
    below, slice_shingles = np.uint64(int(share * 2**64) - 1), 400_000

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        equal, rows = {}, Rows()
        row = TaskContext.get().partitionId() << 40
        held, owners, slacks = [], [], []

        def flush() -> pa.RecordBatch:
            if held:
                sizes = np.array([len(h) for h in held])
                keys, owner = np.concatenate(held), np.repeat(np.arange(len(held)), sizes)
                order = np.argsort(keys)
                ranked = keys[order]
                first = np.diff(ranked, prepend=~ranked[:1]) != 0
                cuts = np.flatnonzero(first)
                several = np.diff(cuts, append=len(ranked)) > 1
                here = np.bincount(owner[order[several[np.cumsum(first) - 1]]], minlength=len(held))
                ids = np.array(owners, np.int64)
                rows.put(NEED, ids, ids, sizes - here - np.array(slacks, np.int64))
                alone = cuts[~several]
                rows.put(SHARED, ranked[alone], ids[owner[order[alone]]], 0)
                if several.any():  # one row for all of them: it only shows the others that the shingle stands here
                    rows.put(SHARED, ranked[cuts[several]], None, 0)
                held.clear(), owners.clear(), slacks.clear()
            return rows.batch()

        total = 0
        for batch in slices(batches):
            for d, h in zip(batch.column(0).to_pylist(), hashed(batch.column(1).to_pylist()), strict=True):
                s = shingle_set(h, size)
                row += 1
                rows.put(NODE, row, d, np.array([len(s)]))
                if d is None or not len(s):
                    continue
                mark = (int(_mix(s).sum().view(np.int64)), int(np.bitwise_xor.reduce(_mix(s + np.uint64(7))).view(np.int64)))
                before = equal.setdefault(mark, d)
                if before != d:
                    rows.put(EQUAL, row, d, np.array([before]))
                    continue
                rows.put(SET, mark[0], d, np.array([mark[1]]))
                held.append(s[: np.searchsorted(s, below, "right")])
                owners.append(d)
                slacks.append(len(s) - -(-num * len(s) // den))
                total += len(held[-1])
                if total > slice_shingles:
                    yield flush()
                    total = 0
            if len(equal) > 200_000:  # bounded memory: equal sets then meet by their hash
                equal.clear()
        yield flush()

    return docs.mapInArrow(trimmed(run), SCHEMA)


def _candidates(docs: DataFrame, size: int, num: int, den: int) -> DataFrame:
    """Rows ``(key, doc, val)``: a signature, or with ``val`` an edge to a document of the same signature in the partition."""
    marks = docs.sparkSession.sparkContext.broadcast(np.packbits(common_shingles(docs, size)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, common = {}, np.unpackbits(marks.value).astype(bool)
        for batch in slices(batches):
            rows = Rows()
            for d, h in zip(batch.column(0).to_pylist(), hashed(batch.column(1).to_pylist()), strict=True):
                s = shingle_set(h, size)
                if not len(s):
                    continue
                sigs = signatures(s, num, den, common).view(np.int64)
                met = np.fromiter((seen.setdefault(x, d) for x in sigs.tolist()), np.int64, len(sigs))
                fresh = met == d
                if fresh.any():
                    rows.put(SHARED, sigs[fresh], d, 0)
                if not fresh.all():
                    rows.put(EQUAL, d, d, np.unique(met[~fresh]))
            yield rows.batch()
            if len(seen) > 300_000:  # bounded memory: forgetting only sends a signature along again
                seen.clear()

    return docs.mapInArrow(trimmed(run), SCHEMA)


LINKS = "u long, v long"


def _search(size: int, num: int, den: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["ask", "doc"]).drop_duplicates(["doc", "text"])
        sets = [shingle_set(h, size) for h in hashed(pdf.text.tolist())]
        asks = np.flatnonzero(pdf.ask.to_numpy()).tolist()
        ids = pdf.doc.to_numpy()
        found = divide_skip(sets, asks, pdf.label.tolist(), num, den)
        return pd.DataFrame([(ids[a], ids[b]) for a, b in found], columns=["u", "v"]).astype("int64")

    return run


def _survivors(docs: DataFrame, size: int, num: int, den: int, share: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(doc, n)`` of every row, the edges between equal sets, and ``(doc, n)`` of the documents that may have another link."""
    group = Window.partitionBy("kind", "key")
    scanned = _sharing(docs, size, num, den, share).withColumn("here", F.count(F.lit(1)).over(group))
    # shared shingles are only counted, for each document
    is_shared = F.col("kind") == SHARED
    kept = checkpoint(
        scanned.where(~is_shared | (F.col("here") > 1) & F.col("doc").isNotNull())
        .groupBy("kind", "doc", F.when(is_shared, 0).otherwise(F.col("key")).alias("key"), "val")
        .agg(F.count(F.lit(1)).alias("times"))
    )
    nodes = kept.where(F.col("kind") == NODE).select("doc", F.col("val").alias("n"))
    sets = kept.where(F.col("kind") == SET)
    same = sets.groupBy("key", "val").agg(F.min("doc").alias("least"), F.count(F.lit(1)).alias("rows")).where("rows > 1")
    far = sets.join(few(same.drop("rows")), ["key", "val"]).where("doc <> least").select(F.col("doc").alias("u"), F.col("least").alias("v"))
    near = kept.where(F.col("kind") == EQUAL).select(F.col("doc").alias("u"), F.col("val").alias("v"))
    equal = checkpoint(near.unionByName(far).distinct())
    has = lambda kind, what: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col(what))), F.lit(0))
    about = kept.unionByName(equal.select(F.lit(EQUAL).cast("byte").alias("kind"), F.col("u").alias("doc"), F.lit(0).cast("long").alias("key"), F.col("v").alias("val"), F.lit(0).cast("long").alias("times")))
    rows, n = F.count(F.when(F.col("kind") == NODE, 1)), F.max(F.when(F.col("kind") == NODE, F.col("val")))
    left = about.where("doc is not null").groupBy("doc").agg(
        rows.alias("rows"), n.alias("n"), F.count(F.when(F.col("kind") == EQUAL, 1)).alias("equals"), (has(SHARED, "times") - has(NEED, "val")).alias("over"),
    )
    # an id of one row: it hangs on an equal set, or holds enough shared shingles; ids of several rows always stay
    return nodes, equal, left.where("n > 0 and (rows > 1 or equals = 0 and over >= 0)").select("doc", "n", "rows")


def jaccard_components(docs: DataFrame, size: int = 4, num: int = 85, den: int = 100, chunk_shingles: int = 120_000, anchors: int = 48, share: float = 0.375) -> DataFrame:
    """``(doc_id, n_shingles, component_id)``, one row for each input row.

    Words are runs other than ``[\\x20\\x09-\\x0D]`` after lower-casing A-Z; a set holds the distinct ``size``-word
    shingles, with fewer words the whole sequence as one. Documents link when
    ``den * |A & B| >= num * |A | B|``; ``component_id`` is the smallest id reachable by links. Texts that are null or
    hold no word have 0 shingles and link with nothing, as does a row with a null id (component null). Rows that
    repeat an id are one node. An empty table gives no rows; other columns are not read. Sets are compared by 64-bit
    shingle hashes; equal sets are found by 128 bits.

    ``share`` is the part of the universe of shingles counted to find documents without a partner, ``chunk_shingles``
    bounds the index held by one task, ``anchors`` the documents shared by the chunks of a block (a quarter of a chunk at most). None of them has a
    bearing on the result.
    """
    base = docs.select(F.col("doc_id").cast("long").alias("doc"), F.col("text").cast("string").alias("text"))
    nodes, equal, left = _survivors(base, size, num, den, share)
    left = few(left)
    texts = base.join(left.select("doc", "rows"), "doc")
    if left.where("rows > 1").limit(1).count():
        texts = texts.where("rows = 1").select("doc", "text").unionByName(texts.where("rows > 1").select("doc", "text").distinct())
    texts = checkpoint(texts.select("doc", "text"))
    found = _candidates(texts, size, num, den)
    met = found.withColumn("val", F.when(F.col("kind") == SHARED, F.min("doc").over(Window.partitionBy("kind", "key"))).otherwise(F.col("val")))
    edges = met.where("doc <> val").select(F.col("doc").alias("u"), F.col("val").alias("v"))
    block = connected_components(edges).withColumnRenamed("component", "block")
    sized = checkpoint(left.join(block, F.col("doc") == F.col("id")).select("doc", "block", "n"))
    large_blocks = few(
        sized.groupBy("block").agg(F.sum("n").alias("s"), F.count(F.lit(1)).alias("docs")).where(F.col("s") > chunk_shingles)
        .select("block", F.ceil(F.col("s") / chunk_shingles).cast("int").alias("chunks"), "docs", F.least(F.lit(anchors), F.greatest(F.lit(2), F.floor(F.col("docs") * (chunk_shingles // 4) / F.col("s")))).alias("anchors"))
    )
    # members are placed once; those of one-chunk blocks ask themselves, those of larger ones also meet the anchors
    members = sized.join(large_blocks, "block", "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    home = F.pmod(F.xxhash64("doc", F.lit(3)), F.col("chunks")).cast("int")
    is_anchor = (F.col("chunks") > 1) & (F.pmod(F.xxhash64("doc", F.lit(5)), F.col("docs")) < F.col("anchors"))
    every = F.sequence(F.lit(0), F.col("chunks") - 1)
    placed = few(members.withColumn("chunk", F.explode(F.when(is_anchor, every).otherwise(F.array(home)))).select("block", "chunk", "doc"))
    placed = texts.join(placed, "doc").select("block", "chunk", "doc", "text", F.col("doc").alias("label"), F.lit(True).alias("ask"))
    search = _search(size, num, den)
    links = checkpoint(placed.groupBy("block", "chunk").applyInPandas(search, LINKS))
    large = members.where("chunks > 1")
    if large.limit(1).count():
        comp = connected_components(links.unionByName(equal))
        labelled = checkpoint(large.join(comp, F.col("doc") == F.col("id"), "left").withColumn("label", F.coalesce("component", "doc")).select("block", "doc", "n", "chunks", "label"))
        main = labelled.groupBy("block", "label").count().groupBy("block").agg(F.max(F.struct("count", "label"))["label"].alias("main"))
        rest = checkpoint(labelled.join(few(main), "block").where("label <> main"))
        ask_parts = few(rest.groupBy("block").agg(F.ceil(F.sum("n") / chunk_shingles).cast("int").alias("parts")))
        spread = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
        asks = (
            rest.join(ask_parts, "block")
            .withColumn("part", F.pmod(F.xxhash64("doc", F.lit(9)), F.col("parts")).cast("int"))
            .withColumn("chunk", spread("chunks"))
            .select("block", "chunk", "part", "doc", "label", F.lit(True).alias("ask"))
        )
        held = (
            labelled.join(ask_parts, "block")
            .withColumn("chunk", home)
            .withColumn("part", spread("parts"))
            .select("block", "chunk", "part", "doc", "label", F.lit(False).alias("ask"))
        )
        both = asks.unionByName(held).groupBy("block", "chunk", "part", "doc").agg(F.max("label").alias("label"), F.max("ask").alias("ask"))
        more = texts.join(few(both), "doc").groupBy("block", "chunk", "part").applyInPandas(search, LINKS)
        links = links.unionByName(checkpoint(more))
    component = connected_components(links.unionByName(equal))
    return nodes.join(component, F.col("doc") == F.col("id"), "left").select(
        F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("component", "doc").alias("component_id")
    )


def keep_one(docs: DataFrame, size: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """One document of each group: the smallest id of its component; all columns as they are.

    Of rows that repeat an id and its text, or a text under a null id, one stays: that of least digest over all
    columns. Rows that repeat an id with different texts stay or go together. Texts without words stay; an empty
    table gives none.
    """
    cols, tag = docs.columns, "_" * (1 + max(map(len, docs.columns)))  # no column has a name that long
    first, i, digest, nth = (f"{x}{tag}" for x in "fidn")
    gone = few(jaccard_components(docs, size, num, den).where("component_id <> doc_id").select(F.col("doc_id").alias(first)).distinct())
    kept = docs.join(gone, docs["doc_id"].cast("long") == F.col(first), "left_anti")
    keyed = kept.withColumns({i: F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit("")), digest: F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")), F.lit(1))})
    again = few(keyed.groupBy(i, digest).count().where("count > 1").select(i, digest))
    # only repeated rows are ordered; the others do not move
    best = Window.partitionBy(i, digest).orderBy(F.xxhash64(F.to_json(F.struct(*map(F.col, cols)))))
    one = keyed.join(again, [i, digest], "left_semi").withColumn(nth, F.row_number().over(best)).where(F.col(nth) == 1)
    return keyed.join(again, [i, digest], "left_anti").select(cols).unionByName(one.select(cols))


def oracle_sql(size: int = 4, num: int = 85, den: int = 100) -> str:
    """All pairs that share a shingle, counted, then components by recursion: for small tables."""
    return rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
i AS (SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - {size} + 2))) AS i FROM w WHERE len(w) > 0),
s AS (SELECT DISTINCT doc_id, hash(w[i : i + {size - 1}]) AS h FROM i),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM s a JOIN s b ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT u, v FROM p JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v WHERE {den} * c >= {num} * (x.n + y.n - c)),
e AS (SELECT u, v FROM l UNION SELECT v, u FROM l),
r AS (SELECT doc_id AS id, doc_id AS reach FROM w UNION SELECT r.id, e.v FROM r JOIN e ON e.u = r.reach),
c AS (SELECT id, min(reach) AS component_id FROM r GROUP BY id)
SELECT w.doc_id AS doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id AS component_id
FROM w LEFT JOIN n ON n.doc_id = w.doc_id JOIN c ON c.id = w.doc_id
"""
