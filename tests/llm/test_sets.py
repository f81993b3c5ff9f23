"""Operators on many rows, against brute force: Jaccard join, top-k, mixing, classifiers, pipeline."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from slidemill.llm import common, jaccard, mixing, quality, topk, toxicity


def test_components_equal_union_find(spark):
    r = random.Random(1)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1060)] + [(5, 5), (None, 3)]
    up = list(range(2000))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        if a is not None:
            x, y = sorted((root(a), root(b)))
            up[y] = x
    got = {x.id: x.component for x in common.connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {n: root(n) for a, b in edges if a is not None and a != b for n in (a, b)}
    assert common.connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def sets_of(text, size):
    w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [x for x in __import__("re").findall(r"[^\x20\x09-\x0D]+", w)]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def brute(rows, size, num, den):
    sets = [sets_of(t, size) for _, t in rows]
    up = {i: i for i, _ in rows if i is not None}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if rows[a][0] is None or rows[b][0] is None or not sets[a] or not sets[b]:
                continue
            if den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b]):
                x, y = sorted((root(rows[a][0]), root(rows[b][0])))
                up[y] = x
    return sorted((str(i), len(s), str(None if i is None else root(i))) for (i, _), s in zip(rows, sets, strict=True))


def near_copies(seed, groups=8, copies=12, words=90):
    """Groups of edited copies at mixed distances, a passage that all share, and short texts."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randint(2, 6)))
    passage = [word() for _ in range(55)]
    rows = []
    for g in range(groups):
        base = [word() for _ in range(r.choice((6, 9, 30, words)))] + (passage if g % 2 else [])
        for _ in range(copies):
            w = list(base)
            for _ in range(r.choice((0, 0, 1, 1, 2, 3, 8))):
                w[r.randrange(len(w))] = word()
            rows.append((len(rows), " ".join(w)))
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize(("size", "num", "den", "chunk"), [(4, 85, 100, 600_000), (5, 80, 100, 600_000), (4, 85, 100, 1200), (2, 1, 2, 700)])
def test_links_equal_all_pairs(spark, size, num, den, chunk):
    rows = near_copies(size + chunk)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    out = jaccard.jaccard_components(df, size, num, den, chunk_shingles=chunk, anchors=3).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in out) == brute(rows, size, num, den)


def test_links_of_odd_rows(spark, odd, empty):
    rows = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    out = jaccard.jaccard_components(odd).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in out) == brute(rows, 4, 85, 100)
    kept = jaccard.keep_one(odd)
    assert kept.columns == odd.columns and sorted(str(r.doc_id) for r in kept.collect()).count("8") == 0
    assert jaccard.jaccard_components(empty).count() == 0 and jaccard.keep_one(empty).count() == 0


def test_signatures_never_miss_a_link():
    rng = np.random.default_rng(2)
    for n in (7, 8, 12, 20, 41, 100, 333):
        for _ in range(30):
            a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
            most = int(2 * n * 15 / 185)
            while True:
                b = np.unique(np.concatenate([rng.permutation(a)[: n - int(rng.integers(0, most + 1))], rng.integers(0, 2**63, int(rng.integers(0, most + 1))).astype(np.uint64)]))
                if jaccard.linked(len(np.intersect1d(a, b)), len(a), len(b), 85, 100):
                    break
            for common_marks in (None, rng.random(1 << jaccard.CELLS) < 0.5, np.ones(1 << jaccard.CELLS, bool)):
                assert len(np.intersect1d(jaccard.signatures(a, 85, 100, common_marks), jaccard.signatures(b, 85, 100, common_marks)))


def test_divide_skip_equals_all_pairs():
    rng = np.random.default_rng(3)
    pool = np.unique(rng.integers(0, 2**63, 400).astype(np.uint64))
    base = [rng.choice(pool, 60, replace=False) for _ in range(4)]
    sets = []
    for i in range(120):
        s = base[i % 4].copy()
        n = int(rng.integers(0, 12))
        s[:n] = rng.choice(pool, n)
        sets.append(np.unique(np.concatenate([s, rng.choice(pool, rng.integers(0, 8))])))
    up = list(range(120))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(120):
        for b in range(a):
            if jaccard.linked(len(np.intersect1d(sets[a], sets[b])), len(sets[a]), len(sets[b]), 85, 100):
                x, y = sorted((root(a), root(b)))
                up[y] = x
    want = len({root(i) for i in range(120)})
    edges = jaccard.divide_skip(sets, list(range(120)), list(range(120)), 85, 100)
    assert len(edges) == 120 - want
    assert all(root(a) == root(b) for a, b in edges)


def top_brute(rows, k=10):
    ok = [(i, [int(np.floor(float(x) * 1024)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    once = {}
    for i, v in ok:
        once[i] = min(once.get(i, v), v)
    out = []
    for q, v in once.items():
        if q % 100 == 0:
            best = sorted(((sum(a * b for a, b in zip(v, w, strict=False)), -i) for i, w in once.items() if i != q), reverse=True)[:k]
            out += [(q, n + 1, -i, s) for n, (s, i) in enumerate(best)]
    return sorted(out)


def test_top_k_with_ties_nulls_and_shards(spark):
    r = np.random.default_rng(4)
    rows = [(int(i), [float(np.float32(x)) for x in r.normal(0, 0.3, 8)]) for i in range(700)]
    rows += [(i, [0.5] * 8) for i in range(800, 900)] + [(800, [0.5] * 8), (None, [0.1] * 8), (901, None), (902, [None] * 8), (903, [float("nan")] * 8), (904, [float("inf")] + [0.0] * 7), (1000, [1.0, -1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    for shard, block in ((4096, 1024), (64, 2)):
        got = sorted(tuple(x) for x in topk.top_k(df, shard_rows=shard, block_rows=block).collect())
        assert got == top_brute(rows)
    extra = df.select("*", *(F.lit("x").alias(c) for c in ("v", "shard", "block", "rank", "score", "query_id", "embedding_")))
    assert sorted(tuple(x) for x in topk.top_k(extra).collect()) == top_brute(rows)
    assert topk.top_k(df.limit(0)).count() == 0
    assert topk.top_k(df.where("vec_id in (100, 5)")).collect()[0].vec_id == 5


def test_budgets_go_to_siblings_first(spark):
    rows = [("d0", "en", "a", 100, 1), ("d0", "en", "b", 1000, 1), ("d0", "de", "c", 1000, 1), ("d1", "en", "d", 50, 1)]
    leaves = spark.createDataFrame(rows, "domain string, lang string, source string, tokens long, n_docs long")
    got = {r.source: r.quota for r in mixing.leaf_budgets(leaves, {}, 1000, 1).collect()}
    # d1 holds 50 of its 500; d0 gets 950, 475 a language; leaf a holds 100, its sibling b takes the other 375
    assert got == {"d": 50, "c": 475, "a": 100, "b": 375}
    got = {r.source: r.quota for r in mixing.leaf_budgets(leaves, {"lang": {"de": 0}}, 1000, 2).collect()}
    assert got == {"d": 100, "c": 0, "a": 200, "b": 700}


def test_mixing_reaches_quotas_and_epochs(spark, docs, odd, empty):
    out = mixing.mix(docs, {"source": {"src0": 5}}, share=(12, 10), max_epochs=2, bucket_docs=10)
    total = docs.select(mixing.word_count(docs["text"]).alias("n")).groupBy().sum("n").first()[0]
    taken = out.groupBy().sum("taken").first()[0]
    assert total * 12 // 10 - 200 <= taken <= total * 12 // 10
    assert out.groupBy("doc_id", "epoch").count().where("count > 1").count() == 0
    assert mixing.mix(odd, {}, share=(1, 1), max_epochs=1).count() == odd.count()
    assert mixing.keep_mixed(odd, {}, (1, 1)).count() == odd.count()
    for share in ((9, 10), (3, 10)):
        weights = {"lang": {"en": 3}, "source": {"src0": 2}}
        once = mixing.mix(docs, weights, share, max_epochs=1, bucket_docs=10).select("doc_id").distinct().collect()
        kept = mixing.keep_mixed(docs, weights, share)
        assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in once)
    assert mixing.mix(empty, {}).count() == 0


def held_out(doc_id, folds, held):
    return zlib.crc32(str(doc_id).encode()) % folds == held


def test_classifiers_hold_out_and_learn(spark, sf):
    sf = sf.replace("sf0.001", "sf0.01")
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    for out, column, folds, held, least in ((quality.quality(docs, labels), "quality", 4, 2, 0.97), (toxicity.toxicity(docs, labels), "toxic", 5, 0, 0.9)):
        rows = out.join(labels, "doc_id").collect()
        assert out.count() == docs.count() and all(r.held_out == held_out(r.doc_id, folds, held) and 0 <= r.score <= 1 for r in rows)
        own = [r for r in rows if r.held_out]
        assert sum(r.predicted == r[column] for r in own) >= least * len(own)


def test_quality_ratios_equal_plain_counts(spark, docs, labels):
    rows = docs.join(labels, "doc_id").select("doc_id", "text", F.col("quality").alias("y"))
    got, scratch = quality.log_count_ratios(rows), np.zeros(1 << quality.BITS, np.int64)
    n = np.ones((2, 1 << quality.BITS))
    for r in rows.collect():
        for b in set(quality.ngrams(r.text, scratch).tolist()):
            n[r.y, b] += 1
    assert np.allclose(got, np.log(n[1] / n[1].sum()) - np.log(n[0] / n[0].sum()))


def test_quality_sample_is_bounded_and_distinct(spark):
    rows = [(i % 40, f"text {i % 80}", i % 2) for i in range(400)]
    keys = quality.sample(spark.createDataFrame(rows, "doc_id long, text string, y int"), 9).collect()
    assert len(keys) == len(set(keys)) == 18 and sum(k.y for k in keys) == 9


def test_dual_coordinate_descent_reaches_the_optimum():
    rng = np.random.default_rng(6)
    rows = [np.unique(rng.integers(0, 40, 8)) for _ in range(60)]
    ratio, y = rng.normal(0, 1, 40), rng.integers(0, 2, 60)
    w, bias = quality.dual_coordinate_descent(rows, ratio, y, cost=1.0, epochs=3000)
    x = np.zeros((60, 41))
    for i, r in enumerate(rows):
        x[i, r] = ratio[r] / np.sqrt((ratio[r] ** 2).sum())
        x[i, 40] = 1
    sign, top = np.where(y == 1, 1.0, -1.0), np.where(y == 1, 1 / (2 * y.mean()), 1 / (2 * (1 - y.mean())))
    loss = lambda v: (v @ v) / 2 + (top * np.maximum(1 - sign * (x @ v), 0)).sum()
    best, v = np.inf, np.zeros(41)
    for step in range(1, 40001):  # plain subgradient descent
        v -= (v - x.T @ (top * sign * (sign * (x @ v) < 1))) / step
        best = min(best, loss(v))
    assert loss(np.append(w, bias)) <= best * 1.002


def test_labels_of_the_held_out_fold_change_nothing(spark, docs, labels):
    from pyspark.sql import functions as F

    flipped = labels.withColumn("quality", F.when(common.fold(4) == 2, 1 - F.col("quality")).otherwise(F.col("quality"))).withColumn("toxic", F.when(common.fold(5) == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    for f in (quality.quality, toxicity.toxicity):
        a, b = ({r.doc_id: round(r.score, 9) for r in f(docs, x).collect()} for x in (labels, flipped))
        assert a == b


def test_classifiers_on_odd_rows(spark, odd, empty, labels):
    for f in (quality.quality, toxicity.toxicity):
        assert f(odd, labels).count() == odd.count()
        assert f(odd, labels.limit(0)).count() == odd.count()
        assert f(empty, labels).count() == 0
    assert toxicity.drop_toxic(odd, labels).columns == odd.columns


def kneser_ney(rows, text, min_docs=3, min_pair=3, favour=0.5, discount=3.0, dead=1.0):
    """The value of a text by plain dictionaries over labelled ``(y, text)`` rows."""
    stem = lambda w: w[:4] + "*" if len(w) > 4 else ""
    words = lambda t: __import__("re").findall(r"[^\W_]+", t.lower())
    docs, tokens, df, pairs = [0, 0], [0, 0], ({}, {}), ({}, {})
    for y, t in rows:
        w = words(t)
        docs[y] += 1
        tokens[y] += len(w)
        for x in set(w) | {stem(x) for x in w if stem(x)}:
            df[y][x] = df[y].get(x, 0) + 1
        for p in {(h, x) for h, x in zip([""] + w, w)} | {(h, stem(x)) for h, x in zip([""] + w, w) if stem(x)}:
            pairs[y][p] = pairs[y].get(p, 0) + 1
    known = [w for w, n in df[1].items() if n >= min_docs and np.log(n / docs[1] / ((df[0].get(w, 0) + 0.5) / docs[0])) > favour]
    ctx = [{w: sum(x == w for _, x in pairs[y]) for w in known} for y in (0, 1)]
    kept = lambda n, y: max(n - discount * tokens[y] / min(tokens), 0) / tokens[y]
    spare = 1 - sum(kept(ctx[y][w], y) for w in known if "*" not in w for y in (0, 1)) / 2
    both = {w: (ctx[0][w] + ctx[1][w]) / sum(tokens) for w in known}
    cls = {w: [kept(ctx[y][w], y) + spare * both[w] for y in (0, 1)] for w in known if "*" in w}
    ratio = {w: np.log(p[1] / p[0]) for w, p in cls.items()}
    for w in known:
        if "*" not in w:
            back = [c * min(1, both[w] / both[stem(w)]) for c in cls[stem(w)]] if stem(w) in cls else [spare * both[w]] * 2
            p = [kept(ctx[y][w], y) + back[y] for y in (0, 1)]
            ratio[w] = np.log(p[1] / p[0])

    def of(h, w):
        if w not in ratio:
            return ratio.get(stem(w), 0.0)
        n = [pairs[y].get((h, w), 0) for y in (0, 1)]
        if n[1] < min_pair:
            return ratio[w]
        p = [kept(n[y], y) + spare * sum(n) / sum(tokens) for y in (0, 1)]
        return np.log(p[1] / p[0]) - ratio.get(h, 0.0)

    w = words(text)
    v = np.array([of(h, x) for h, x in zip([""] + w, w)])
    return float((np.sign(v) * np.maximum(abs(v) - dead, 0)).sum() / (len(w) + 10)) if w else 0.0


def test_toxicity_values_equal_plain_kneser_ney(spark, docs, labels):
    rows = docs.join(labels, "doc_id").select("doc_id", "text", F.col("toxic").alias("y")).collect()
    # few toxic texts here: repeated words of an invented kind make pairs and classes
    rows = [(r.doc_id, r.text or "", r.y) for r in rows] + [(10_000 + i, f"you zqjxa{i % 7} are rotten scum{i % 2} and the rotten scum{i % 2} goes", 1) for i in range(40)]
    train = spark.createDataFrame(rows, "doc_id long, text string, y int")
    table = toxicity.expressions(train, 3, 3, 0.5, 3.0)
    keys, ratios, rest = toxicity.split(table, 10**6)
    assert rest is None and len(keys) == len(set(keys.tolist())) == table.count()
    s = toxicity.Scorer(keys, ratios, 1.0)
    plain = [(y, t) for _, t, y in rows]
    for text in ["", "rotten scum1", "zqjxa99 unheard", *(t for _, t, _ in rows[:25]), *(t for _, t, _ in rows[-3:])]:
        assert s.value(toxicity.words_of(text)) == pytest.approx(kneser_ney(plain, text), abs=1e-9)
    assert s.value(toxicity.words_of("rotten scum1")) > 0.05


def test_long_texts_of_few_toxic_words_are_found(spark):
    # as in the driver's tables: a few texts full of insults, most with one or two among hundreds of words
    r = random.Random(11)
    rows = []
    for i in range(1500):
        words, toxic = [f"w{min(int(r.paretovariate(0.6)), 4000)}x" for _ in range(r.choice((60, 150, 300)))], i % 8 == 0
        for _ in range((25 if i % 48 == 0 else 2) if toxic else 0):
            words[r.randrange(len(words))] = r.choice(("scum", "trash", "moron", "loser"))
        rows.append((i, " ".join(words), int(toxic)))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int").repartition(4)
    out = {x.doc_id: x for x in toxicity.toxicity(df, df).collect()}
    own = [out[i] for i, _, _ in rows if out[i].held_out]
    assert sum(x.predicted for x in own if x.doc_id % 8 == 0) >= 0.9 * sum(x.doc_id % 8 == 0 for x in own)
    assert sum(x.predicted for x in own if x.doc_id % 8) <= 3


def test_both_models_score_all_words(spark):
    # "fine" speaks for ordinary texts, "the" for neither
    rows = [(i, f"the k{i}a scum k{i}b the" if i % 4 == 0 else f"the k{i}a fine k{i}b the", int(i % 4 == 0)) for i in range(400)]
    train = spark.createDataFrame(rows, "doc_id long, text string, y int").repartition(3)
    table = toxicity.expressions(train, 3, 3, None, 3.0)
    keys, ratios, rest = toxicity.split(table, 10**6)
    assert rest is None and len(keys) == len(set(keys.tolist())) == table.count()
    of = lambda w: ratios[keys == toxicity.WordHasher()([w]).view(np.int64)[0]].tolist()
    (fine,), (the,), (scum,) = map(of, ("fine", "the", "scum"))
    # by hand: distinct words before it, less three and nine (100 toxic texts, 300 others, five words each), over the words of the class
    tokens, before = (1500, 500), {"fine": (300, 0), "the": (301, 101), "scum": (0, 100)}
    kept = {w: [max(n - 3 * t / 500, 0) / t for n, t in zip(c, tokens)] for w, c in before.items()}
    spare = 1 - sum(map(sum, kept.values())) / 2
    want = {w: np.log((k[1] + spare * sum(before[w]) / 2000) / (k[0] + spare * sum(before[w]) / 2000)) for w, k in kept.items()}
    assert [fine, the, scum] == pytest.approx([want["fine"], want["the"], want["scum"]])
    assert fine < -1 and scum > 1 and abs(the) < 0.1
    strong, weak = toxicity.Scorer(keys, ratios, 1.0).parts(["fine", "unheard"])
    assert strong + weak == pytest.approx(fine / (2 + toxicity.EASE)) and strong < 0 and weak < 0


def shuffled_bytes(spark, work):
    """What ``work`` writes to shuffles, by Spark's own record of its stages."""
    sc, jvm = spark.sparkContext._jsc.sc(), spark._jvm

    def written():
        sc.listenerBus().waitUntilEmpty()
        of = sc.statusStore().stageList(jvm.java.util.ArrayList(), False, False, spark.sparkContext._gateway.new_array(jvm.double, 0), jvm.java.util.ArrayList())
        return {(s.stageId(), s.attemptId()): s.shuffleWriteBytes() for s in (of.apply(i) for i in range(of.size()))}

    before = written()
    work()
    return sum(n for stage, n in written().items() if stage not in before)


def drawn_texts(spark, rows):
    r = random.Random(5)
    texts = [(i, " ".join(f"{r.randrange(2500)}word" for _ in range(300)), int(i % 5 == 0)) for i in range(rows)]
    return spark.createDataFrame(texts, "doc_id long, text string, y int").repartition(2), texts


def test_word_pairs_are_shuffled_with_each_key_once(spark):
    df, texts = drawn_texts(spark, 1500)
    pairs = {(h, w) for _, t, _ in texts for h, w in zip(["", *t.split()], t.split())}
    # nearly every pair stands in one task only, once for its word and once for its class; two hashes for each are 16 bytes
    assert shuffled_bytes(spark, lambda: toxicity.expressions(df, 3, 3, None, 3.0).count()) < 16 * 2 * len(pairs)


def test_pairs_in_small_lists_and_parts_give_the_same_table(spark):
    df, _ = drawn_texts(spark, 200)
    for favour in (None, 0.1):
        whole, small = (sorted((x.key, round(x.ratio, 9), x.n) for x in toxicity.expressions(df, 3, 3, favour, 3.0, **how).collect()) for how in ({}, {"held": 500, "share": 10**6}))
        assert len(whole) > 100 and whole == small


def test_rare_toxic_words_keep_their_counts_in_a_large_corpus(spark):
    # about 456,000 (document, word) pairs
    r = random.Random(7)
    rows = [(i, i % 3 == 0, " ".join(f"w{r.randrange(4000)}" for _ in range(400))) for i in range(1200)] + [(5000 + i, True, f"zqj w{i} vkx") for i in range(3)]
    df = spark.createDataFrame([(i, int(y), t) for i, y, t in rows], "doc_id long, y int, text string")
    keys = {x.key for x in toxicity.toxic_words(df, 3).collect()}
    assert set(jaccard.WordHasher()(["zqj", "vkx", "w7"]).view(np.int64).tolist()) <= keys


def test_expressions_joined_by_shuffle_give_the_same_scores(spark, docs, odd, labels):
    some = docs.select("doc_id", "text").unionByName(odd.select("doc_id", "text"))
    whole, part, none = (sorted((str(x.doc_id), round(x.score, 9)) for x in toxicity.toxicity(some, labels, min_docs=2, shared=n).collect()) for n in (10**6, 20, 0))
    assert whole == part == none
    clashing = odd.unionByName(docs.select("doc_id", "text"), allowMissingColumns=True)
    kept = [sorted(str(x.doc_id) for x in toxicity.drop_toxic(clashing, labels, min_docs=2, shared=n).collect()) for n in (10**6, 0)]
    assert kept[0] == kept[1]


def test_pipeline_stages(spark, sf, tmp_path):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, docs, sf).write.parquet(f"{tmp_path}/{name}")
        after = spark.read.parquet(f"{tmp_path}/{name}")
        assert after.columns == columns
        if name == "ngram_jaccard":
            rows = [(r.doc_id, r.text) for r in docs.collect()]
            assert {str(r.doc_id) for r in after.collect()} == {c for _, _, c in brute(rows, 5, 80, 100)}
        docs = after
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    assert packed.select("doc_id").distinct().count() == docs.count()
    assert corpus_pipeline.run(spark, sf).count() == packed.count()


def test_pipeline_stages_as_a_chain_on_odd_rows(spark, sf, odd, empty, tmp_path):
    import corpus_pipeline

    long = spark.createDataFrame([(100, " ".join(f"w{i * i % 977}" for i in range(30_000)))], "doc_id long, text string")
    for name, docs in (("odd", odd.unionByName(long, allowMissingColumns=True)), ("empty", empty)):
        columns, n = docs.columns, docs.count()
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
            stage(spark, docs, sf).write.parquet(f"{tmp_path}/{name}{k}")
            docs = spark.read.parquet(f"{tmp_path}/{name}{k}")
            assert docs.columns == columns and docs.count() <= n
            n = docs.count()
            if name == "odd" and k == 1:  # equal texts: 7 stays once, 8 goes; both texts of null ids stay
                ids = sorted(str(r.doc_id) for r in docs.collect())
                assert ids.count("7") == 1 and "8" not in ids and ids.count("None") == 2 and "1" in ids
        packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
        assert packed.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()


def test_keep_one_of_repeated_rows(spark):
    rows = [(1, "a b c d e f", "x"), (1, "a b c d e f", "y"), (1, "other words are these here now", "z"), (2, "a b c d e f", "x"), (None, "null id", "p"), (None, "null id", "q"), (None, None, "r"), (3, "", "s")]
    kept = jaccard.keep_one(spark.createDataFrame(rows, "doc_id long, text string, i string"))
    got = sorted(((str(r.doc_id), r.text) for r in kept.collect()), key=str)
    assert kept.columns == ["doc_id", "text", "i"]
    assert got == sorted([("1", "a b c d e f"), ("1", "other words are these here now"), ("None", "null id"), ("None", None), ("3", "")], key=str)
