"""Mixing sources to target weights: hierarchical budgets over a domain - language - source tree.

DataFrame and SQL functions only. A token budget is divided down the tree in proportion to integer weights. A node can take
at most ``max_epochs`` times the tokens it has; what it cannot take goes to its siblings (water filling in integer
arithmetic), and only what a whole subtree cannot take goes to the subtree's siblings, one level up. A leaf's quota
is taken as whole epochs of all its documents, then a prefix of one more epoch: documents in the order of md5(seed,
epoch, id), as long as their tokens fit. The prefix is found by sums per hash bucket, so that only one bucket of each leaf is
ever sorted; then every document is judged by comparing its md5 with the leaf's last one.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.shared import columns, workdir, written

LEAF = ("domain", "lang", "source")
BUCKET_DIGITS = 4  # 65,536 buckets a leaf


def n_tokens(text: Column) -> Column:
    """Words between ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _filled(nodes: DataFrame, parents: list[str], weight: str, amount: Column) -> DataFrame:
    """Adds ``given`` to the nodes (``cap``, ``weight``) of each parent: water filling of the parent's ``amount``.

    In ascending order of cap / weight the first nodes are filled to their caps, the rest share what is left by weight,
    rounded down. Nodes without weight get nothing.
    """
    group = Window.partitionBy(*parents) if parents else Window.partitionBy(F.lit(1))
    before = group.orderBy("ratio", *[c for c in LEAF if c in nodes.columns]).rowsBetween(Window.unboundedPreceding, -1)
    w = F.when(F.col("cap") > 0, F.col(weight)).otherwise(F.lit(0))
    out = (nodes.withColumn("amount", amount).withColumn("w", w)
           .withColumn("ratio", F.when(F.col("w") > 0, F.col("cap") / F.col("w")).otherwise(F.lit(float("inf"))))
           .withColumn("cap_before", F.coalesce(F.sum("cap").over(before), F.lit(0)))
           .withColumn("w_before", F.coalesce(F.sum("w").over(before), F.lit(0)))
           .withColumn("w_all", F.sum("w").over(group)))
    out = out.withColumn("full", (F.col("w") > 0) & (F.col("cap") * (F.col("w_all") - F.col("w_before"))
                                                    <= F.col("w") * (F.col("amount") - F.col("cap_before"))))
    spent = lambda c: F.sum(F.when(F.col("full"), F.col(c)).otherwise(0)).over(group)
    out = out.withColumn("cap_full", spent("cap")).withColumn("w_full", spent("w"))
    share = F.expr("CASE WHEN w = 0 THEN 0 WHEN full THEN cap ELSE w * (amount - cap_full) div (w_all - w_full) END")
    return out.withColumn("given", share.cast("long")).drop("amount", "w", "ratio", "cap_before", "w_before", "w_all", "full", "cap_full", "w_full")


def leaf_quotas(leaves: DataFrame, weights: DataFrame, budget: int, max_epochs: int) -> DataFrame:
    """``(domain, lang, source, avail, quota)`` from ``leaves(domain, lang, source, avail)`` and
    ``weights(domain, lang, source, domain_weight, lang_weight, source_weight)``."""
    same = [leaves[c].eqNullSafe(weights[c]) for c in LEAF]
    tree = leaves.join(weights, same).select(*[leaves[c] for c in LEAF], "avail", "domain_weight", "lang_weight", "source_weight")
    tree = tree.withColumn("cap", F.col("avail") * max_epochs)
    domains = tree.groupBy("domain").agg(F.sum("cap").alias("cap"), F.max("domain_weight").alias("domain_weight"))
    domains = _filled(domains, [], "domain_weight", F.lit(budget).cast("long")).select(F.col("domain").alias("_d"), F.col("given").alias("amount"))
    langs = tree.groupBy("domain", "lang").agg(F.sum("cap").alias("cap"), F.max("lang_weight").alias("lang_weight"))
    langs = _filled(langs.join(domains, F.col("domain").eqNullSafe(F.col("_d"))).drop("_d"), ["domain"], "lang_weight", F.col("amount"))
    langs = langs.select(F.col("domain").alias("_d"), F.col("lang").alias("_l"), F.col("given").alias("amount"))
    under = tree.join(langs, F.col("domain").eqNullSafe(F.col("_d")) & F.col("lang").eqNullSafe(F.col("_l"))).drop("_d", "_l")
    return _filled(under, ["domain", "lang"], "source_weight", F.col("amount")).select(*LEAF, "avail", F.col("given").alias("quota"))


def _order(seed: int) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("epochs").cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))


def plan_mix(docs: DataFrame, weights: DataFrame, budget: int | None = None, budget_pct: int = 100, max_epochs: int = 4, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """``(rows, cuts)`` of ``docs(doc_id, text, domain, lang, source)``: each row's tokens, and of each leaf the number of
    whole ``epochs`` and the ``last`` md5 of the prefix in the next one (null: none).

    ``budget`` is in tokens; without it, ``budget_pct`` per cent of all tokens there are.
    """
    base = workdir(docs.sparkSession, "mix")
    rows = written(docs.select("doc_id", *LEAF, n_tokens(F.col("text")).alias("n_tokens")), base, "rows")
    leaves = written(rows.groupBy(*LEAF).agg(F.sum("n_tokens").alias("avail")), base, "leaves")
    if budget is None:
        budget = (leaves.agg(F.sum("avail")).first()[0] or 0) * budget_pct // 100
    quotas = (leaf_quotas(leaves, weights, budget, max_epochs).filter("avail > 0")
              .withColumn("epochs", F.expr("CAST(quota div avail AS INT)")).withColumn("left", F.col("quota") - F.col("epochs") * F.col("avail")))
    quotas = written(quotas, base, "quotas")
    on = lambda a, b: [a[c].eqNullSafe(b[c]) for c in LEAF]
    placed = rows.join(quotas, on(rows, quotas)).select(rows["*"], "epochs", "left").withColumn("at", _order(seed))
    buckets = placed.withColumn("bucket", F.substring("at", 1, BUCKET_DIGITS)).groupBy(*LEAF, "epochs", "left", "bucket").agg(F.sum("n_tokens").alias("n"))
    upto = Window.partitionBy(*LEAF).orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    buckets = buckets.withColumn("upto", F.sum("n").over(upto))
    # The bucket in which the prefix ends; its documents are the only ones that are sorted.
    ends = written(buckets.filter(F.col("upto") > F.col("left")).groupBy(*LEAF).agg(F.min(F.struct("bucket", "upto", "n")).alias("end"))
                   .select(*LEAF, F.col("end.bucket").alias("bucket"), (F.col("end.upto") - F.col("end.n")).alias("before")), base, "ends")
    inside = placed.join(ends, on(placed, ends)).filter(F.substring("at", 1, BUCKET_DIGITS) == F.col("bucket")).select(placed["*"], "before")
    peers = inside.groupBy(*LEAF, "left", "before", "at").agg(F.sum("n_tokens").alias("n"))
    running = peers.withColumn("upto", F.col("before") + F.sum("n").over(Window.partitionBy(*LEAF).orderBy("at")))
    lasts = running.filter(F.col("upto") <= F.col("left")).groupBy(*LEAF).agg(F.max("at").alias("last_at"))
    # Where none of that bucket fits, the prefix is all buckets before it.
    cuts = quotas.join(ends, on(quotas, ends), "left").select(quotas["*"], "bucket")
    cuts = cuts.join(lasts, on(cuts, lasts), "left").select(*[cuts[c] for c in LEAF], "epochs", "quota", F.coalesce("last_at", "bucket").alias("last"))
    return rows, written(cuts, base, "cuts")


def apply_mix(rows: DataFrame, cuts: DataFrame, seed: int = 0) -> DataFrame:
    """Every selected copy of ``rows(doc_id, domain, lang, source, ...)``, with ``epoch`` 0, 1, ..."""
    named = cuts.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(LEAF)], "epochs", "last")
    joined = rows.join(named, [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(LEAF)])
    more = F.when(_order(seed) <= F.col("last"), 1).otherwise(0)
    # sequence() counts downwards when it has to: no copies is an empty array.
    n = F.col("epochs") + more
    copies = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    return joined.withColumn("epoch", F.explode(copies)).select(*rows.columns, "epoch")


def mix_sources(docs: DataFrame, weights: DataFrame, domain: Column, budget: int | None = None, budget_pct: int = 100, max_epochs: int = 4,
                seed: int = 0, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """One row per selected copy: ``doc_id, domain, lang, source, n_tokens, epoch``.

    Null domains, languages and sources are nodes of their own, matched by null in ``weights``; leaves without a row there, or with
    weight 0, get nothing. Null and empty texts have no tokens: they go along with each whole epoch, and in the prefix as
    their md5 falls. Rows that repeat an id are ordered as one: all or none of them are in a prefix. An empty table gives none.
    """
    named = docs.withColumn("_domain", domain)
    plain = columns(named, doc_id=id_col, text=text_col, domain="_domain", lang=lang_col, source=source_col)
    rows, cuts = plan_mix(plain, weights, budget, budget_pct, max_epochs, seed)
    return apply_mix(rows, cuts, seed)
