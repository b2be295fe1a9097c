"""Mix sources to target weights: hierarchical token budgets.

A token budget flows down a tree of domains, languages and sources. Each node
passes its share on to its children by their weights; what a child can't take
(it has too few tokens even when repeated ``max_epochs`` times) goes to its
siblings by theirs. A node's capacity is the sum of its leaves', so only what a
whole subtree can't take reaches the siblings of its parent. Of each leaf the
documents are read in seeded epochs, each a random order of its own, up to the
leaf's quota of tokens.

Everything is DataFrame functions. The water level of a family is the largest
``(budget - capacities before) / (weights from here on)`` in the order of
capacity per weight. The prefix of a leaf is found as a cut key from bucketed
running sums, so neither a hot leaf nor any text is ever shuffled whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casaflow.session import materialize

LEVELS = ("domain", "lang", "source")
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of words of a text (0 for null)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def share_out(children: DataFrame, family: list[str], name: str, budget: str, weight: str, capacity: str, out: str) -> DataFrame:
    """``children`` with ``out``: the family's budget dealt by weight, no child
    above its capacity, shortages dealt on among the others. Children without a
    positive weight get nothing."""
    w = F.greatest(F.coalesce(weight, F.lit(0.0)), F.lit(0.0))
    fill = F.when(w > 0, F.col(capacity) / w)
    order = Window.partitionBy(*family).orderBy(fill.asc_nulls_last(), name)
    before = F.coalesce(F.sum(F.when(w > 0, F.col(capacity))).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum(w).over(order.rowsBetween(0, Window.unboundedFollowing))
    level = F.when(w > 0, (F.col(budget) - before) / rest)
    return (children.withColumn("_level", level)
            .withColumn("_water", F.max("_level").over(Window.partitionBy(*family)))
            .withColumn(out, F.least(F.col(capacity), F.greatest(F.coalesce(F.col("_water") * w, F.lit(0.0)), F.lit(0.0))))
            .drop("_level", "_water"))


def leaf_quotas(leaves: DataFrame, weights: list[tuple[str, float]], budget: Column, max_epochs: int) -> DataFrame:
    """(domain, lang, source, tokens, quota): ``leaves`` has the tokens of every
    leaf; ``weights`` are ("domain", w), ("domain/lang", w) or
    ("domain/lang/source", w), 1 where none is given; ``budget`` is an
    aggregate over the leaves."""
    given = leaves.sparkSession.createDataFrame(weights or [("", 1.0)], "path string, weight double")
    # a domain may have the tokens of many leaves: capacities are sums from below
    tree = leaves.withColumn("cap2", F.col("tokens").cast("double") * max_epochs)
    nodes = [tree.groupBy("domain").agg(F.sum("cap2").alias("cap0")),
             tree.groupBy("domain", "lang").agg(F.sum("cap2").alias("cap1")), tree]
    total = leaves.agg(budget.cast("double").alias("grant"))
    granted = nodes[0].crossJoin(total)        # one row on the right
    for depth, level in enumerate(LEVELS):
        if depth:
            granted = nodes[depth].join(granted.select(*LEVELS[:depth], F.col("got").alias("grant")), list(LEVELS[:depth]))
        path = F.concat_ws("/", *LEVELS[:depth + 1])
        weighed = granted.withColumn("path", path).join(given, "path", "left").withColumn("w", F.coalesce("weight", F.lit(1.0))).drop("path", "weight")
        family = list(LEVELS[:depth]) or ["grant"]
        granted = share_out(weighed, family, level, "grant", "w", f"cap{depth}", "got")
    return granted.select(*LEVELS, "tokens", F.floor(F.col("got") + F.lit(1e-6)).cast("long").alias("quota"))


def epoch_key(seed: int, epoch: Column, doc_id: Column, text: Column) -> Column:
    """A document's place in an epoch: hex, ordered as text. Only rows that
    repeat both id and text share one."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit("")),
                             F.md5(F.coalesce(text, F.lit("")).cast("binary"))).cast("binary"))


def mix_sources(docs: DataFrame, weights: list[tuple[str, float]], budget_share: float, domain: Column, seed: int = 1,
                max_epochs: int = 2, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                source_col: str = "source", epoch_col: str = "mix_epoch", bucket_digits: int = 3) -> DataFrame:
    """The documents of the mixture: all columns of ``docs`` and ``epoch_col``
    (from 0), a row for every epoch that takes the document.

    ``domain`` names each row's domain; the budget is ``budget_share`` of all
    tokens (words). A leaf's quota is met by whole epochs and then by the
    documents that end within the rest, in the epoch's order; rows that repeat
    both id and text are taken together. A null domain, language or source is
    the empty name. Null or empty texts have no tokens and come with any epoch
    that reaches their place. Very long texts are whole documents. An empty
    table gives an empty mixture. Extra columns may have any names but
    that of ``epoch_col``.
    """
    def text(c: Column) -> Column:
        return F.coalesce(c.cast("string"), F.lit(""))

    leaf = [text(domain).alias("domain"), text(F.col(lang_col)).alias("lang"), text(F.col(source_col)).alias("source")]
    narrow = materialize(docs.select(*leaf, F.col(id_col).alias("id"), F.md5(F.coalesce(text_col, F.lit("")).cast("binary")).alias("digest"),
                                     word_count(F.col(text_col)).alias("n")), "mix-sizes")
    leaves = narrow.groupBy(*LEVELS).agg(F.sum("n").alias("tokens"))
    quotas = leaf_quotas(leaves, weights, F.floor(F.sum("tokens") * F.lit(budget_share)), max_epochs)
    has = F.col("tokens") > 0
    quotas = materialize(quotas.select(
        *LEVELS, F.when(has, F.expr("quota div tokens")).otherwise(F.lit(0)).cast("long").alias("full"),
        F.when(has, F.col("quota") % F.col("tokens")).otherwise(F.lit(0)).cast("long").alias("rest")), "mix-quotas")

    key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("full").cast("string"), F.coalesce(F.col("id").cast("string"), F.lit("")), "digest").cast("binary"))
    placed = (narrow.join(quotas, list(LEVELS)).where("rest > 0").select(*LEVELS, "rest", key.alias("key"), "n")
              .groupBy(*LEVELS, "rest", "key").agg(F.sum("n").alias("n"))
              .withColumn("bucket", F.substring("key", 1, bucket_digits)))
    placed = materialize(placed, "mix-order")
    sums = placed.groupBy(*LEVELS, "bucket").agg(F.sum("n").alias("size"))      # at most 16^digits rows a leaf
    ahead = Window.partitionBy(*LEVELS).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("ahead", F.coalesce(F.sum("size").over(ahead), F.lit(0)))
    within = Window.partitionBy(*LEVELS, "bucket").orderBy("key").rowsBetween(Window.unboundedPreceding, 0)
    ends = placed.join(sums, [*LEVELS, "bucket"]).withColumn("end", F.col("ahead") + F.sum("n").over(within))
    cuts = ends.where("end <= rest").groupBy(*LEVELS).agg(F.max("key").alias("cut"))
    plan = quotas.join(cuts, list(LEVELS), "left").select(*[F.col(c).alias(f"_{c}") for c in LEVELS], "full", "cut")
    plan = materialize(plan.select(F.concat_ws("\u0001", *[f"_{c}" for c in LEVELS]).alias("leaf"), "full", "cut"), "mix-plan")

    row = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)])
    rows = docs.select(row.alias("row"), F.concat_ws("\u0001", *leaf).alias("leaf"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    taken = rows.join(plan, "leaf")
    last = F.coalesce(epoch_key(seed, F.col("full"), F.col("id"), F.col("text")) <= F.col("cut"), F.lit(False))
    epochs = F.col("full") + F.when(last, 1).otherwise(0)
    each = taken.withColumn("epochs", epochs).where("epochs > 0").select("row", F.explode(F.sequence(F.lit(0).cast("long"), F.col("epochs") - 1)).alias("epoch"))
    return each.select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(docs.columns)], F.col("epoch").cast("int").alias(epoch_col))
