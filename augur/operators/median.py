"""Exact median for wide value domains without a per-group buffer or a sort of all rows.

``F.median`` (``percentile``) keeps a value -> count map per group: fine for
bounded domains (integer percentages), but a group with a third of the rows
and mostly distinct values would hold them all in one task's memory.
``exact_median`` selects instead. Per group it keeps a bracket [low, high] of
values that surely holds the middle one or two ranks, and the number of rows
below it, and narrows it in passes over the rows:

1. a sketch (``percentile_approx``, merged map-side) of the rows inside the bracket
   proposes a narrower one round the ranks looked for;
2. an exact count of the rows below and inside the proposal accepts each of its two sides
   only where the ranks stay inside, so a sketch's error can't spoil the result.

A pass leaves about 4 / ``accuracy`` of the rows strictly inside a bracket (ties
with its ends aren't among them). When few enough are left, the values inside the brackets are
counted (value -> count, combined map-side) and the middle is read off the
running counts, at most ``enough`` values and two ends a group. Only
sketches, counts and those values are shuffled; no row is, whatever a group's size.

The middle values' mean is the linearly interpolated median, as
``percentile(value, 0.5)`` defines it. NULL values are ignored; a group whose values are all NULL
gets NULL; a NULL key is a group. Brackets (a row a group) are counted and broadcast up to
``max_groups``; more groups take ``ranked_median``, with the same result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from augur.operators.keys import dense_key
from augur.session import stored

ACCURACY = 10_000
ENOUGH = 100_000
MAX_GROUPS = 100_000  # brackets broadcast: some 100 bytes each
GRID = 1000  # shares at which a later pass cuts
# rows strictly inside a bracket that is wider than one value
_OPEN_WIDTH = "case when _low < _high then _open end"


def _null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    lf, rt = left.alias("_l"), right.alias("_r")
    cond = [F.col(f"_l.{k}").eqNullSafe(F.col(f"_r.{k}")) for k in keys]
    rest = [c for c in right.columns if c not in keys]
    return lf.join(rt, cond, how).select(
        *[F.col(f"_l.{c}") for c in left.columns], *[F.col(f"_r.{c}") for c in rest]
    )


def exact_median(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    name: str = "median",
    accuracy: int = ACCURACY,
    enough: int = ENOUGH,
    max_groups: int = MAX_GROUPS,
) -> DataFrame:
    base = df.select(*keys, F.col(value).alias("_v"))
    known = base.where(F.col("_v").isNotNull())
    # the first scan's sketch needs no bracket: the middle is at a half
    first = base.groupBy(*keys).agg(
        F.count("_v").alias("_n"),
        F.min("_v").alias("_low"),
        F.max("_v").alias("_high"),
        F.percentile_approx("_v", [0.5 - 2 / accuracy, 0.5 + 2 / accuracy], accuracy).alias("_cuts"),
    )
    brackets = stored(
        first.select(
            *keys, "_n", "_low", "_high", F.lit(0).cast("long").alias("_below"), F.col("_n").alias("_in"), F.col("_n").alias("_open"),
            F.col("_cuts")[0].alias("_low2"), F.col("_cuts")[1].alias("_high2"),
        ),
        "brackets",
    )
    groups, widest = brackets.agg(F.count(F.lit(1)), F.expr(f"max({_OPEN_WIDTH})")).first()
    if groups > max_groups:
        return ranked_median(df, keys, value, name)
    while widest is not None and widest > enough:
        if "_low2" not in brackets.columns:
            brackets = stored(_proposed(known, brackets, keys, accuracy), "proposed")
        brackets = stored(_accepted(known, brackets, keys), "brackets")
        before, widest = widest, brackets.agg(F.expr(f"max({_OPEN_WIDTH})")).first()[0]
        if widest is not None and widest >= before:
            break
    brackets = brackets.drop("_low2", "_high2")
    inside = _null_safe_join(known, F.broadcast(brackets), keys).where("_v between _low and _high")
    counts = inside.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_c"), F.first("_n").alias("_n"), F.first("_below").alias("_below"))
    until = F.col("_below") + F.sum("_c").over(Window.partitionBy(*keys).orderBy("_v"))
    lower, upper = F.floor((F.col("_n") - 1) / 2), F.floor(F.col("_n") / 2)  # 0-based ranks of the middle
    met = lambda rank: (F.col("_until") > rank) & (F.col("_until") - F.col("_c") <= rank)
    middle = counts.withColumn("_until", until).groupBy(*keys).agg(
        F.max(F.when(met(lower), F.col("_v").cast("double"))).alias("_a"),
        F.max(F.when(met(upper), F.col("_v").cast("double"))).alias("_b"),
    )
    middle = middle.select(*keys, ((F.col("_a") + F.col("_b")) / 2).alias(name))
    return _null_safe_join(brackets.select(*keys), middle, keys, "left")


def _proposed(known: DataFrame, brackets: DataFrame, keys: Sequence[str], accuracy: int) -> DataFrame:
    """Narrower brackets from a sketch of the rows inside, at a grid of shares
    (the ranks looked for lie at another share in each group)."""
    inside = _null_safe_join(known, F.broadcast(brackets), keys).where("_v between _low and _high")
    lower, upper = _middle()
    grid = [i / GRID for i in range(GRID + 1)]
    sketch = inside.groupBy(*keys).agg(F.percentile_approx("_v", grid, accuracy).alias("_cuts"))
    share = lambda rank, off: (rank - F.col("_below")) / F.col("_in") + F.lit(off / accuracy)
    cut = lambda at: F.col("_cuts")[F.greatest(F.lit(0), F.least(F.lit(GRID), at.cast("int")))]
    return _null_safe_join(brackets, sketch, keys, "left").withColumns(
        {"_low2": cut(F.floor(share(lower, -2) * GRID)), "_high2": cut(F.ceil(share(upper, 2) * GRID))}
    ).drop("_cuts")


def _accepted(known: DataFrame, proposed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Brackets with the proposed sides that hold up to an exact count."""
    lower, upper = _middle()
    v, low, high = F.col("_v"), F.col("_low2"), F.col("_high2")
    counted = _null_safe_join(known, F.broadcast(proposed), keys).where("_v between _low and _high")
    counts = counted.groupBy(*keys).agg(
        F.count_if(v < low).alias("_under"), F.count_if(v > high).alias("_over"), F.count_if((v > low) & (v < high)).alias("_between")
    )
    found = _null_safe_join(proposed, counts, keys, "left")
    low_holds = F.coalesce(F.col("_below") + F.col("_under") <= lower, F.lit(False))
    high_holds = F.coalesce(F.col("_below") + F.col("_in") - F.col("_over") > upper, F.lit(False))
    under, over = F.when(low_holds, F.col("_under")).otherwise(F.lit(0)), F.when(high_holds, F.col("_over")).otherwise(F.lit(0))
    return found.select(
        *keys,
        "_n",
        F.when(low_holds, low).otherwise(F.col("_low")).alias("_low"),
        F.when(high_holds, high).otherwise(F.col("_high")).alias("_high"),
        (F.col("_below") + under).alias("_below"),
        (F.col("_in") - under - over).alias("_in"),
        F.when(low_holds & high_holds, F.col("_between")).otherwise(F.col("_in") - under - over).alias("_open"),
    )


def _middle():
    """The 0-based ranks of the one or two middle rows."""
    return F.floor((F.col("_n") - 1) / 2), F.floor(F.col("_n") / 2)


def ranked_median(df: DataFrame, keys: Sequence[str], value: str, name: str = "median") -> DataFrame:
    """The same by global ranks, for any number of groups: rows are written once in
    ranges of (keys, value), which split any group; the ranks of a group's middle rows
    are joined to the ranked rows. Ranks are unique, so no key of that join can be hot."""
    base = df.select(*keys, value).where(F.col(value).isNotNull())
    ranked = dense_key(base, [*keys, value], "_g")
    stats = ranked.groupBy(*keys).agg(F.min("_g").alias("_start"), F.count(F.lit(1)).alias("_n"))
    wanted = stats.select(
        *keys,
        F.explode(
            F.array_distinct(F.array(F.floor((F.col("_n") - 1) / 2), F.ceil((F.col("_n") - 1) / 2)))
        ).alias("_at"),
        "_start",
    ).select(*keys, (F.col("_start") + F.col("_at")).alias("_g"))
    middle = (
        wanted.join(ranked.select("_g", F.col(value).cast("double").alias("_value")), "_g")
        .groupBy(*keys)
        .agg(F.avg("_value").alias(name))
    )
    groups = df.select(*keys).distinct()
    return _null_safe_join(groups, middle, keys, "left")
