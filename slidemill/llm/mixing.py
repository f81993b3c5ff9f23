"""Mixing sources to target weights by hierarchical budgeting, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slidemill.llm.common import checkpoint, few

LEVELS = ("domain", "lang", "source")


def word_count(text: Column) -> Column:
    """Blank-separated words, the token unit of the budgets."""
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), "")).cast("long")


def domain_of(source: Column) -> Column:
    """Three source families told apart by the last character of the source name."""
    return F.concat(F.lit("d"), (F.ascii(F.right(source, F.lit(1))) % 3).cast("string"))


def weight_of(value: Column, weights: dict[str, int], default: int = 1) -> Column:
    out = F.lit(default)
    for name, weight in weights.items():
        out = F.when(value == name, weight).otherwise(out)
    return out.cast("long")


def share_out(nodes: DataFrame, parent: list[str], name: str, weight: Column, cap: str, budget: str, out: str) -> DataFrame:
    """Split each parent's budget over its children by weight, none above its capacity.

    What a child cannot take is spread over its siblings by their weights. Children are taken by rising
    capacity per weight: those full at the common level form a prefix, found with running sums; the others get
    ``weight * rest div rest_of_weights``. Exact in integers; a child of weight 0 gets nothing.
    """
    wide = lambda c: c.cast("decimal(38,0)")
    by = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    n = nodes.withColumn("_w", weight).withColumn("_c", F.when(F.col("_w") > 0, F.col(cap)).otherwise(F.lit(0)))
    n = n.withColumn("_r", F.when(F.col("_w") > 0, F.col("_c") / F.col("_w")).otherwise(F.lit(-1.0)))
    run = by.orderBy("_r", name)
    before = F.coalesce(F.sum("_c").over(run.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    after = F.sum("_w").over(by) - F.coalesce(F.sum("_w").over(run.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    n = n.withColumn("_b", F.col(budget) - before).withColumn("_a", after)
    n = n.withColumn("_full", (F.col("_w") == 0) | (wide(F.col("_c")) * F.col("_a") <= wide(F.col("_w")) * F.col("_b")))
    n = n.withColumn("_rest", F.col(budget) - F.coalesce(F.sum(F.when(F.col("_full"), F.col("_c"))).over(by), F.lit(0)))
    n = n.withColumn("_ws", F.coalesce(F.sum(F.when(~F.col("_full"), F.col("_w"))).over(by), F.lit(1)))
    n = n.withColumn(out, F.when(F.col("_full"), F.col("_c")).otherwise(F.expr("_w * _rest div _ws")).cast("long"))
    return n.drop("_w", "_c", "_r", "_b", "_a", "_full", "_rest", "_ws")


def leaf_budgets(leaves: DataFrame, weights: dict[str, dict[str, int]], budget: int, max_epochs: int) -> DataFrame:
    """``leaves`` (levels, ``tokens``, ``n_docs``) with the ``quota`` of each leaf, budgets going down level by level.

    A node's capacity is that of all its leaves, so a leaf's shortage is made good inside its own parent as far as
    that can hold it, and only what the whole parent lacks goes to the parent's siblings.
    """
    out = leaves.withColumn("_cap3", F.col("tokens") * max_epochs)
    for depth in (2, 1):
        out = out.withColumn(f"_cap{depth}", F.sum(f"_cap{depth + 1}").over(Window.partitionBy(*LEVELS[:depth])) if depth == 2 else F.sum("_cap3").over(Window.partitionBy(LEVELS[0])))
    budget_of = {1: out.groupBy(LEVELS[0]).agg(F.first("_cap1").alias("_cap1")).withColumn("_q0", F.lit(budget).cast("long"))}
    tops = share_out(budget_of[1], [], LEVELS[0], weight_of(F.col(LEVELS[0]), weights.get(LEVELS[0], {})), "_cap1", "_q0", "_q1").select(LEVELS[0], "_q1")
    mids = out.groupBy(*LEVELS[:2]).agg(F.first("_cap2").alias("_cap2")).join(tops, LEVELS[0])
    mids = share_out(mids, [LEVELS[0]], LEVELS[1], weight_of(F.col(LEVELS[1]), weights.get(LEVELS[1], {})), "_cap2", "_q1", "_q2").select(*LEVELS[:2], "_q2")
    low = out.join(mids, list(LEVELS[:2]))
    low = share_out(low, list(LEVELS[:2]), LEVELS[2], weight_of(F.col(LEVELS[2]), weights.get(LEVELS[2], {})), "_cap3", "_q2", "quota")
    return low.drop("_cap1", "_cap2", "_cap3", "_q2")


def levels_of(docs: DataFrame) -> dict[str, Column]:
    """A document's place in the tree."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    return {"domain": domain_of(text("source")), "lang": text("lang"), "source": text("source")}


def order_key(seed: int, epoch: Column, doc_id: Column) -> Column:
    """The seeded digest that orders an epoch."""
    return F.md5(F.concat_ws(":", F.lit(seed), epoch, F.coalesce(doc_id.cast("long").cast("string"), F.lit(""))))


def mix(docs: DataFrame, weights: dict[str, dict[str, int]], share: tuple[int, int] = (6, 10), max_epochs: int = 2, seed: int = 42, bucket_docs: int = 4096) -> DataFrame:
    """Choose documents to meet target weights: ``doc_id, domain, lang, source, epoch, n_tokens, taken``.

    The budget, ``share`` of all tokens (words), goes down the tree domain - language - source by ``weights``
    (level -> value -> integer weight, 1 where unnamed, 0 to leave out). A leaf may be read ``max_epochs`` times.
    Each epoch orders the leaf's documents by a seeded digest; whole epochs take all, the last takes the prefix
    that reaches the quota, ``taken`` telling how many tokens of a document lie inside (the crossing one is cut).

    No window holds a leaf: a leaf is dealt into ``n_docs div bucket_docs`` ranges of the digest, ranges are summed
    before they are run up, and only a range's own documents meet. Only totals reach the driver. Null or empty
    texts have 0 tokens and are taken when the prefix gets to them; null language or source is the value '';
    null ids are kept (digest of ''); repeated rows count as often as they stand; an empty table gives no rows.
    Other columns are not read.
    """
    return chosen(docs, weights, share, max_epochs, seed, bucket_docs).drop("key")


def chosen(docs: DataFrame, weights: dict[str, dict[str, int]], share: tuple[int, int], max_epochs: int, seed: int, bucket_docs: int = 4096) -> DataFrame:
    """The rows of ``mix`` with the ``key`` that orders them."""
    base = checkpoint(docs.select(F.col("doc_id").cast("long").alias("doc_id"), *(c.alias(name) for name, c in levels_of(docs).items()), word_count(F.col("text").cast("string")).alias("n_tokens")))
    total = base.agg(F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("t")).first()["t"]
    leaves = base.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("n_docs"))
    quotas = checkpoint(leaf_budgets(leaves, weights, total * share[0] // share[1], max_epochs))
    turns = quotas.withColumn("whole", F.when(F.col("tokens") > 0, F.expr("quota div tokens")).otherwise(F.when(F.col("quota") >= 0, 1))).withColumn(
        "epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("whole")))
    )
    turns = turns.withColumn("reach", F.when(F.col("epoch") < F.col("whole"), F.col("tokens")).otherwise(F.col("quota") - F.col("whole") * F.col("tokens")))
    turns = turns.where((F.col("epoch") < F.col("whole")) | (F.col("reach") > 0)).select(*LEVELS, "epoch", "reach", "tokens", F.greatest(F.lit(1), F.expr(f"n_docs div {bucket_docs}")).alias("buckets"))
    # one row for each leaf and epoch
    dealt = base.join(few(turns), list(LEVELS)).withColumn("key", order_key(seed, F.col("epoch"), F.col("doc_id")))
    bucket = F.expr("cast(conv(substr(key, 1, 8), 16, 10) as bigint) * buckets div 4294967296")
    out = ["doc_id", *LEVELS, "epoch", "n_tokens", "taken", "key"]
    everything = dealt.where("reach = tokens").withColumn("taken", F.col("n_tokens")).select(out)
    part = dealt.where("reach < tokens").withColumn("bucket", bucket)
    sums = part.groupBy(*LEVELS, "epoch", "bucket").agg(F.sum("n_tokens").alias("s"))
    upto = Window.partitionBy(*LEVELS, "epoch").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(*LEVELS, "epoch", "bucket", F.coalesce(F.sum("s").over(upto), F.lit(0)).alias("start"))
    inside = Window.partitionBy(*LEVELS, "epoch", "bucket").orderBy("key", "n_tokens").rowsBetween(Window.unboundedPreceding, -1)
    prefix = (
        part.withColumn("ahead", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
        .join(starts, [*LEVELS, "epoch", "bucket"])
        .withColumn("left", F.col("reach") - F.col("start") - F.col("ahead"))
        .where((F.col("left") > 0) | ((F.col("n_tokens") == 0) & (F.col("left") == 0)))
        .withColumn("taken", F.least("n_tokens", "left"))
        .select(out)
    )
    return everything.unionByName(prefix)


def keep_mixed(docs: DataFrame, weights: dict[str, dict[str, int]], share: tuple[int, int], seed: int = 42) -> DataFrame:
    """The documents a single epoch chooses, whole (a crossing one too), all columns as they are.

    An epoch takes a prefix of each leaf, so the last key taken decides for every row by itself and no text is shuffled;
    only the leaves' last keys are joined. Rows that repeat an id in a leaf with as many tokens have one key: all of
    them stay if one is chosen. Null texts have no tokens, null ids the digest of ''; an empty table gives none.
    """
    cols, tag = docs.columns, "_" * (1 + max(map(len, docs.columns)))  # no column has a name that long
    at = F.struct(F.col("key"), F.col("n_tokens").alias("n"))
    last = chosen(docs, weights, share, 1, seed).groupBy(*(F.col(c).alias(c + tag) for c in LEVELS)).agg(F.max(at).alias(f"last{tag}"))
    placed = docs.withColumns({name + tag: c for name, c in levels_of(docs).items()}).join(few(last), [c + tag for c in LEVELS])
    own = F.struct(order_key(seed, F.lit(0), F.col("doc_id")).alias("key"), word_count(F.col("text").cast("string")).alias("n"))
    return placed.where(own <= F.col(f"last{tag}")).select(cols)


def oracle_sql(weights: dict[str, dict[str, int]], share: tuple[int, int], max_epochs: int, seed: int) -> str:
    """The same choice as DuckDB SQL, with one window for each leaf."""
    case = lambda c: "CASE " + c + "".join(f" WHEN '{k}' THEN {v}" for k, v in weights.get(c, {}).items()) + " ELSE 1 END" if weights.get(c) else "1"

    def level(source: str, parent: str, name: str, cap: str, budget: str, out: str) -> str:
        over = f"PARTITION BY {parent}" if parent else ""
        return f"""
SELECT * EXCLUDE (w, c, r, b, a, f, rest, ws), CAST(CASE WHEN f THEN c ELSE (w * rest) // ws END AS BIGINT) AS {out} FROM (
  SELECT *, {budget} - coalesce(sum(CASE WHEN f THEN c END) OVER ({over}), 0) AS rest, coalesce(sum(CASE WHEN NOT f THEN w END) OVER ({over}), 1) AS ws FROM (
    SELECT *, w = 0 OR c * a <= w * b AS f FROM (
      SELECT *, {budget} - coalesce(sum(c) OVER ({over} ORDER BY r, {name} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b,
             sum(w) OVER ({over} ORDER BY r, {name} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS a FROM (
        SELECT *, CASE WHEN w > 0 THEN c / w ELSE -1.0 END AS r FROM (
          SELECT *, CASE WHEN w > 0 THEN {cap} ELSE 0 END AS c FROM (SELECT *, CAST({case(name)} AS HUGEINT) AS w FROM ({source})))))))"""

    top = level("SELECT domain, sum(cap) AS cap1, any_value(q0) AS q0 FROM l GROUP BY domain", "", "domain", "cap1", "q0", "q1")
    mid = level("SELECT l.domain, lang, sum(cap) AS cap2, any_value(q1) AS q1 FROM l JOIN t1 ON l.domain = t1.domain GROUP BY l.domain, lang", "domain", "lang", "cap2", "q1", "q2")
    low = level("SELECT l.*, q2 FROM l JOIN t2 ON l.domain = t2.domain AND l.lang = t2.lang", "domain, lang", "source", "cap", "q2", "quota")
    return rf"""
WITH b AS (
  SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, 'd' || (ascii(right(coalesce(source, ''), 1)) % 3) AS domain,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS n_tokens FROM documents),
l AS (SELECT domain, lang, source, CAST(sum(n_tokens) AS HUGEINT) AS tokens, sum(n_tokens) * {max_epochs} AS cap,
        (SELECT (sum(n_tokens) * {share[0]}) // {share[1]} FROM b) AS q0 FROM b GROUP BY ALL),
t1 AS ({top}), t2 AS ({mid}), t3 AS ({low}),
e AS (SELECT *, unnest(range(0, CAST(w AS BIGINT) + 1)) AS epoch FROM (SELECT *, CASE WHEN tokens > 0 THEN quota // tokens ELSE 1 END AS w FROM t3)),
r AS (SELECT domain, lang, source, epoch, tokens, CASE WHEN epoch < w THEN tokens ELSE quota - w * tokens END AS reach FROM e),
o AS (SELECT b.*, epoch, reach, tokens, coalesce(sum(n_tokens) OVER (PARTITION BY domain, lang, source, epoch ORDER BY md5(concat_ws(':', '{seed}', epoch, coalesce(CAST(doc_id AS VARCHAR), ''))), n_tokens ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
      FROM b JOIN r USING (domain, lang, source) WHERE reach > 0 OR tokens = 0 AND epoch = 0)
SELECT doc_id, domain, lang, source, epoch, n_tokens, CAST(least(n_tokens, reach - ahead) AS BIGINT) AS taken
FROM o WHERE reach = tokens OR reach > ahead OR n_tokens = 0 AND reach = ahead
"""
