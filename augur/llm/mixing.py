"""Mixing sources to target weights by hierarchical budgeting.

Documents form a tree domain > language > source. A token budget is handed
down the tree: each node's budget is shared among its children in proportion
to their weights, and a child that can't use its share (its tokens times
``epochs``) leaves the rest to its siblings. A node never gets more than its
whole subtree can use, so a shortage is made up among siblings first and
reaches the parent's siblings only when all siblings are full. Shares are
whole tokens, rounded down (less than one token lost for each node).

A leaf takes as many whole epochs of its documents as its budget holds; of the next
epoch it takes the longest prefix, in that epoch's seeded order, whose tokens
fit. The prefix is found without sorting a leaf: token sums for each of 4,096
ranges of the order's hash find the range where the budget ends, and only that
range's documents are ordered. A leaf may thus hold any share of all rows.

All of it is DataFrame code. Tokens are words ``[^\\x20\\x09-\\x0D]+`` unless
another column is given. Null texts and texts without words have no tokens and
are never taken. A null domain, language or source is a branch of its own
(named ``?``, as that name would be). Repeated rows count as documents; where
two have the same id, text hash decides the order. Weights that aren't named
are 1; 0 excludes a branch. An empty table gives an empty table. Columns of
the input are kept; one with the name of an added column is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from augur.llm.scratch import few_files, stored

SEED = "mix-1"
EPOCHS = 2
SHARE = 0.6
RANGE_DIGITS = 3  # hex digits: 4,096 ranges
MAX_BROADCAST = 50_000  # leaves: some 10 MB
TREE = ("domain", "language", "origin")
ADDED = ("domain", "language", "origin", "n_tokens", "copies")
# Target weights by branch; what isn't named weighs 1. Languages and sources are
# weighed within each domain alike.
WEIGHTS = {
    "domain": {"d0": 4, "d1": 3, "d2": 2, "d3": 1},
    "language": {"en": 4, "de": 3, "fr": 2, "es": 1},
    "origin": {"src0": 1},
}


def domain_of(source: Column) -> Column:
    """``documents`` names no domain: four groups of sources stand for them,
    dealt by the first byte of the name's MD5."""
    return F.concat(F.lit("d"), (F.conv(F.substring(F.md5(source), 1, 2), 16, 10).cast("int") % 4).cast("string"))


def tokens_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _weight(level: str, weights: dict[str, dict[str, int]]) -> Column:
    named = weights.get(level) or {}
    if not named:
        return F.lit(1).cast("long")
    pairs = [F.lit(x) for kv in named.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), F.col(level)), F.lit(1)).cast("long")


def share_out(children: DataFrame, parent: list[str], child: str) -> DataFrame:
    """Children (parent keys, child, weight, room, given) with ``budget``:
    their part of ``given``, by weight, none over its room."""
    by = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    order = by.orderBy(F.col("room") / F.col("weight"), child)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    used, left = F.coalesce(F.sum("room").over(before), F.lit(0)), F.sum("weight").over(onward)
    level = (F.col("given") - used) / left  # tokens for each unit of weight, were all from here on unfilled
    filled = F.col("room") / F.col("weight") <= F.col("level")
    return (
        children.filter("weight > 0")
        .withColumn("level", level)
        .withColumn("rate", F.max(F.when(~filled, F.col("level"))).over(by))
        .withColumn("budget", F.when(filled, F.col("room")).otherwise(F.floor(F.col("rate") * F.col("weight"))))
        .drop("level", "rate")
    )


def leaf_budgets(leaves: DataFrame, budget: Column, weights=None, epochs: int = EPOCHS) -> DataFrame:
    """``leaves`` (domain, language, origin, tokens) with ``budget``: each one's
    tokens out of ``budget``, an expression over the sum column ``tokens``."""
    weights = WEIGHTS if weights is None else weights
    leaves = leaves.withColumn("room", F.col("tokens") * epochs)
    for level in TREE:
        leaves = leaves.withColumn(f"{level}_weight", _weight(level, weights))
    leaves = leaves.filter(" and ".join(f"{level}_weight > 0" for level in TREE))
    total = leaves.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens"), F.coalesce(F.sum("room"), F.lit(0)).alias("all"))
    whole = total.select(F.least(F.floor(budget), F.col("all")).cast("long")).scalar()
    parent: list[str] = []
    for depth, level in enumerate(TREE):
        keys = list(TREE[: depth + 1])
        nodes = leaves.groupBy(*keys).agg(
            F.sum("room").alias("room"), F.sum("tokens").alias("tokens"), F.max(f"{level}_weight").alias("weight")
        )
        nodes = nodes.join(given, parent) if parent else nodes.withColumn("given", whole)
        shared = share_out(nodes, parent, level)
        given = shared.select(*keys, F.col("budget").alias("given"))
        parent = keys
    return shared.select(*TREE, "tokens", "budget")


def mix(
    docs: DataFrame,
    budget: Column | None = None,
    weights=None,
    epochs: int = EPOCHS,
    seed: str = SEED,
    domain: Column | None = None,
    tokens: Column | None = None,
    max_broadcast: int = MAX_BROADCAST,
) -> DataFrame:
    """The documents taken, all columns, with domain, language, origin,
    n_tokens and ``copies`` (how many epochs take the document). ``budget`` is
    an expression over ``tokens``, the tokens of all documents (default: 0.6 of them)."""
    budget = F.col("tokens") * SHARE if budget is None else budget
    rest = [c for c in docs.columns if c not in ADDED]
    branch = lambda c: F.coalesce(c, F.lit("?"))
    rows = docs.select(
        *rest,
        branch(domain_of(F.col("source")) if domain is None else domain).alias("domain"),
        branch(F.col("lang")).alias("language"),
        branch(F.col("source")).alias("origin"),
        (tokens_of(F.col("text")) if tokens is None else tokens).alias("n_tokens"),
    ).filter("n_tokens > 0")
    leaves = stored(rows.groupBy(*TREE).agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("n")), "leaves")
    # what is joined to documents has a row a leaf: broadcast while their counted number allows, so texts stay put
    n_leaves, n = leaves.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    small = F.broadcast if n_leaves <= max_broadcast else (lambda df: df)
    plan = leaf_budgets(leaves, budget, weights, epochs).select(
        *TREE, F.expr("budget div tokens").alias("whole"), F.expr("budget % tokens").alias("rest")
    )
    drawn = F.md5(F.concat_ws("-", F.lit(seed), F.col("whole"), F.col("doc_id").cast("string")))
    ranked = rows.join(small(plan), list(TREE)).withColumn("_order", drawn).withColumn("_range", F.substring("_order", 1, RANGE_DIGITS))
    sums = ranked.groupBy(*TREE, "_range").agg(F.sum("n_tokens").alias("n"), F.max("rest").alias("rest"))
    upto = F.sum("n").over(Window.partitionBy(*TREE).orderBy("_range"))
    ends = (  # the range where each leaf's prefix ends, and what is left for it there
        sums.withColumn("upto", upto)
        .filter("upto > rest")
        .groupBy(*TREE)
        .agg(F.min("_range").alias("_end"), F.min_by(F.col("rest") - F.col("upto") + F.col("n"), "_range").alias("_left"))
    )
    placed = ranked.join(small(ends), list(TREE))
    before = placed.filter("_range <> _end").withColumn("copies", F.col("whole") + (F.col("_range") < F.col("_end")).cast("long"))
    last = Window.partitionBy(*TREE).orderBy("_order", "doc_id", F.xxhash64("text")).rowsBetween(Window.unboundedPreceding, 0)
    within = placed.filter("_range = _end").withColumn(
        "copies", F.col("whole") + (F.sum("n_tokens").over(last) <= F.col("_left")).cast("long")
    )
    return before.unionByName(few_files(within, n)).filter("copies > 0").select(*rest, *ADDED)


def op9_mixing_sources(spark, sf_dir: str) -> DataFrame:
    """The documents that a mix of 0.6 of all tokens takes."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source")
    return mix(docs).select("doc_id", *ADDED)
