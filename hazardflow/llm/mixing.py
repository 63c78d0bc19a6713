"""Mixing sources to target weights: budgets down a domain-language-source tree, then seeded token prefixes.

1. Leaves: documents with equal (domain, language, source). A leaf's capacity is its tokens times
   ``max_epochs``; an inner node's is the sum over its children with a positive weight.
2. Budgets go down from the root (``budget_share`` of the corpus tokens, at most its capacity). A node's
   budget is dealt to its children by weight; a child gets its capacity at most, and what it can't take
   goes to its siblings by their weights (water filling in closed form: siblings in the order of capacity
   over weight, running sums, one fill level). Since a node never gets more than its whole subtree can
   take, a shortage is made up by siblings first and moves to an ancestor's siblings only when they are full.
3. A leaf with ``t`` tokens and budget ``b`` gives ``b div t`` whole epochs and, of one more epoch, the
   prefix of ``b mod t`` tokens in the order of a seeded hash; the document at the cut gives its first tokens.

At scale: documents of one leaf are cut by the leading bits of the hash into buckets of about
``bucket_rows`` (bits from the leaf's row count), bucket sums give the running total, and only the
bucket that holds the cut is sorted, so a leaf with a third of all rows is never one task.

Defined results: null levels form a node of their own, ``(none)``; documents without words are never
selected; a missing weight is 1, a weight of 0 or less takes nothing; repeated rows are separate documents;
an empty table gives no rows. Output columns are the key, the levels and the counts only.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .columns import word_count

NONE = "(none)"
ORDER_BITS = 52


def seeded_order(seed: int, epoch: Column, key: Column) -> Column:
    """52 bits of a hash that any SQL engine can repeat."""
    text = F.concat(F.lit(f"{seed}:"), epoch.cast("string"), F.lit(":"), F.coalesce(key.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, ORDER_BITS // 4), 16, 10).cast("long")


def weight_of(level: str, weights: Mapping[str, Mapping[str, float]]) -> Column:
    out = F.lit(1.0)
    for value, w in weights.get(level, {}).items():
        out = F.when(F.col(level) == value, F.lit(float(w))).otherwise(out)
    return out


def share_out(children: DataFrame, parent: Sequence[str], name: str) -> DataFrame:
    """Water filling of ``parent_budget`` among siblings: adds ``budget`` to (parent.., name, w, cap, parent_budget)."""
    by = [F.col(c) for c in parent] or [F.lit(0)]
    whole = Window.partitionBy(*by)
    before = whole.orderBy("_full_at", name).rowsBetween(Window.unboundedPreceding, -1)
    at = children.withColumn("_full_at", F.when(F.col("w") > 0, F.col("cap") / F.col("w")).otherwise(F.lit(0.0)))
    level = ((F.col("parent_budget") - F.coalesce(F.sum("cap").over(before), F.lit(0)))
             / (F.sum("w").over(whole) - F.coalesce(F.sum("w").over(before), F.lit(0.0))))
    at = at.withColumn("_level", F.when(F.col("w") > 0, level))
    at = at.withColumn("_capped", (F.col("w") <= 0) | (F.col("cap") <= F.col("w") * F.col("_level")))
    fill = F.max(F.when(~F.col("_capped"), F.col("_level"))).over(whole)
    budget = F.when(F.col("_capped"), F.col("cap").cast("double")).otherwise(F.col("w") * fill)
    return at.withColumn("budget", budget).drop("_full_at", "_level", "_capped")


def leaf_budgets(leaves: DataFrame, levels: Sequence[str], weights: Mapping[str, Mapping[str, float]],
                 budget_share: float, max_epochs: int) -> DataFrame:
    """``leaves`` (levels.., tokens, n_docs) with an integer ``budget`` each."""
    live = leaves
    positive = F.lit(True)
    for c in levels:
        live = live.withColumn(f"_w_{c}", F.greatest(weight_of(c, weights), F.lit(0.0)))
        positive = positive & (F.col(f"_w_{c}") > 0)
    live = live.withColumn("cap", F.when(positive, F.col("tokens") * max_epochs).otherwise(F.lit(0)))
    top = Window.partitionBy(F.lit(0))  # the few children of the root
    root = F.least(F.floor(F.sum("tokens").over(top) * F.lit(float(budget_share))), F.sum("cap").over(top)).cast("double")
    for depth, name in enumerate(levels):
        path = list(levels[: depth + 1])
        nodes = live.groupBy(*path).agg(F.sum("cap").alias("cap"), F.sum("tokens").alias("tokens"),
                                        F.max(f"_w_{name}").alias("w"))
        parent = path[:-1]
        nodes = nodes.join(budgets, parent) if parent else nodes.withColumn("parent_budget", root)
        budgets = share_out(nodes, parent, name).select(*path, F.col("budget").alias("parent_budget"))
    whole = F.least(F.floor(F.col("parent_budget") + F.lit(1e-6)), F.col("cap")).cast("long")
    return live.join(budgets, list(levels)).select(*levels, "tokens", "n_docs", whole.alias("budget"))


def select_prefixes(docs: DataFrame, budgets: DataFrame, levels: Sequence[str], seed: int,
                    bucket_rows: int = 4096) -> DataFrame:
    """(key, levels.., n_tokens, epoch, tokens_taken) of ``docs`` (key, levels.., n_tokens > 0)."""
    levels = list(levels)
    bits = F.greatest(F.lit(0), F.ceil(F.log2(F.col("n_docs") / F.lit(float(bucket_rows)))).cast("int"))
    plan = budgets.where(F.col("budget") > 0).select(
        *levels, F.expr("budget div tokens").alias("_epochs"), (F.col("budget") % F.col("tokens")).alias("_rest"),
        bits.alias("_bits"))
    rows = docs.join(plan, levels).withColumn("_o", seeded_order(seed, F.col("_epochs"), F.col("key")))
    rows = rows.withColumn("_bucket", F.expr(f"shiftright(_o, {ORDER_BITS} - _bits)"))
    sums = rows.groupBy(*levels, "_bucket").agg(F.sum("n_tokens").alias("_sum"))
    run = Window.partitionBy(*levels).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.withColumn("_off", F.coalesce(F.sum("_sum").over(run), F.lit(0)))
    placed = rows.join(offsets, [*levels, "_bucket"])
    cut = (F.col("_off") < F.col("_rest")) & (F.col("_off") + F.col("_sum") > F.col("_rest"))
    keep = ["key", *levels, "n_tokens", "_epochs"]
    even = placed.where(~cut).select(*keep, F.when(F.col("_off") < F.col("_rest"), F.col("n_tokens"))
                                     .otherwise(F.lit(0)).cast("long").alias("_last"))
    inside = Window.partitionBy(*levels, "_bucket").orderBy("_o", "key").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("_off") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))
    at_cut = placed.where(cut).select(*keep, F.greatest(F.lit(0), F.least(
        F.col("n_tokens"), F.col("_rest") - start)).cast("long").alias("_last"))
    epochs = F.filter(F.sequence(F.lit(0).cast("long"), F.col("_epochs")),
                      lambda e: (e < F.col("_epochs")) | (F.col("_last") > 0))
    return even.unionByName(at_cut).select("*", F.explode(epochs).alias("epoch")).select(
        "key", *levels, "n_tokens", F.col("epoch").cast("int").alias("epoch"),
        F.when(F.col("epoch") < F.col("_epochs"), F.col("n_tokens")).otherwise(F.col("_last")).alias("tokens_taken"))


def mix_sources(docs: DataFrame, levels: Mapping[str, Column], weights: Mapping[str, Mapping[str, float]], *,
                key: str = "doc_id", text: str = "text", budget_share: float = 1.0, max_epochs: int = 4,
                seed: int = 7, bucket_rows: int = 4096) -> DataFrame:
    """(key, levels.., n_tokens, epoch, tokens_taken): one row a selected document and epoch."""
    names = list(levels)
    rows = docs.select(F.col(key).alias("key"), word_count(F.col(text)).alias("n_tokens"),
                       *[F.coalesce(c.cast("string"), F.lit(NONE)).alias(n) for n, c in levels.items()])
    rows = cut_lineage(rows.where(F.col("n_tokens") > 0))  # narrow rows without texts: words are counted once
    leaves = rows.groupBy(*names).agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("n_docs"))
    budgets = leaf_budgets(leaves, names, weights, budget_share, max_epochs)
    return select_prefixes(rows, budgets, names, seed, bucket_rows).withColumnRenamed("key", key)


def domain_of(source: Column) -> Column:
    """The registered tree's domains: sources dealt to four by the number in their name, others to ``(none)``."""
    number = F.regexp_extract(source, r"(\d{1,9})\z", 1)
    return F.when(number != "", F.concat(F.lit("domain"), (number.cast("long") % 4).cast("string")))


#: The registered query's target weights.
WEIGHTS = {"domain": {"domain0": 4, "domain1": 3, "domain2": 2, "domain3": 1},
           "lang": {"en": 5, "de": 2, "fr": 2, "es": 1}}


def mix_documents(docs: DataFrame) -> DataFrame:
    return mix_sources(docs, {"domain": domain_of(F.col("source")), "lang": F.col("lang"), "source": F.col("source")},
                       WEIGHTS)


def op9_source_mixing(spark, sf_dir: str) -> DataFrame:
    return mix_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def _sql() -> str:
    def case(level: str) -> str:
        arms = " ".join(f"WHEN {level} = '{v}' THEN {float(w)}" for v, w in WEIGHTS.get(level, {}).items())
        return f"(CASE {arms} ELSE 1.0 END)::DOUBLE" if arms else "1.0::DOUBLE"

    levels, steps, prev = ["domain", "lang", "source"], [], "root"
    for i, name in enumerate(levels):
        path, parent = levels[: i + 1], levels[:i]
        part = f"PARTITION BY {', '.join(parent)}" if parent else ""
        join = f"JOIN {prev} USING ({', '.join(parent)})" if parent else f"CROSS JOIN {prev}"
        steps.append(f"""
n{i} AS (SELECT *, cap / w AS full_at FROM (SELECT {', '.join(path)}, sum(cap)::BIGINT AS cap, {case(name)} AS w
         FROM leaf GROUP BY {', '.join(path)}) {join}),
l{i} AS (SELECT *, (b - coalesce(sum(cap) OVER p, 0)::BIGINT)::DOUBLE
                 / (sum(w) OVER ({part}) - coalesce(sum(w) OVER p, 0.0)) AS lv
         FROM n{i} WINDOW p AS ({part} ORDER BY full_at, {name} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
b{i} AS (SELECT {', '.join(path)}, CASE WHEN cap <= w * lv THEN cap::DOUBLE
           ELSE w * max(CASE WHEN cap > w * lv THEN lv END) OVER ({part}) END AS b FROM l{i})""")
        prev = f"b{i}"
    return rf"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '{NONE}') AS lang, coalesce(source, '{NONE}') AS source,
    coalesce('domain' || (nullif(regexp_extract(source, '(\d{{1,9}})\z', 1), '')::BIGINT % 4)::VARCHAR, '{NONE}') AS domain,
    len(regexp_extract_all(coalesce(text, ''), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))::BIGINT AS n_tokens
  FROM documents),
r AS (SELECT * FROM d WHERE n_tokens > 0),
leaf AS (SELECT domain, lang, source, sum(n_tokens)::BIGINT AS tokens, (sum(n_tokens) * 4)::BIGINT AS cap
         FROM r GROUP BY ALL),
root AS (SELECT least(sum(tokens), sum(cap))::DOUBLE AS b FROM leaf),{','.join(steps)},
plan AS (SELECT domain, lang, source, least(floor(b + 1e-6)::BIGINT, cap) // tokens AS e,
                least(floor(b + 1e-6)::BIGINT, cap) % tokens AS rest
         FROM leaf JOIN b2 USING (domain, lang, source) WHERE least(floor(b + 1e-6)::BIGINT, cap) > 0),
o AS (SELECT r.*, e, rest, coalesce(sum(n_tokens) OVER (PARTITION BY domain, lang, source
        ORDER BY md5('7:' || e::VARCHAR || ':' || coalesce(doc_id::VARCHAR, ''))[1:13], doc_id
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
      FROM r JOIN plan USING (domain, lang, source)),
t AS (SELECT *, greatest(0, least(n_tokens, rest - start)) AS last FROM o),
x AS (SELECT *, unnest(range(0, e + CASE WHEN last > 0 THEN 1 ELSE 0 END)) AS epoch FROM t)
SELECT doc_id, domain, lang, source, n_tokens, epoch::INTEGER AS epoch,
       (CASE WHEN epoch < e THEN n_tokens ELSE last END)::BIGINT AS tokens_taken FROM x
"""


SQL = _sql()
