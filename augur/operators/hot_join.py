"""Equality joins with keys that hold a large share of the rows.

A hash or sort-merge join deals rows by key: a key with a third of the rows is
one task. Adaptive execution splits such a partition only where it reads a plain shuffle
and above its size threshold; ``hot_join`` does not depend on either:

1. ``hot_keys`` finds the keys with more than ``share`` of the rows by a counter sketch
   (``approx_top_k``): it is combined map-side, so only
   sketches of a bounded size are shuffled. A sketch tracks enough keys for
   its error to stay under half of ``share``, so none is missed;
2. rows of a hot key are dealt by (key, salt) with one salt for each ``share`` of the
   rows, and the other side's rows of that key are repeated for every salt;
3. all other rows have salt 0 and are joined as without salts.

Which keys are salted changes where rows meet, never the result, so keys are
told apart by a 64-bit hash there. At most 2 / ``share`` hot keys exist: that
bounds the broadcast table, and the repetitions to 3 / ``share`` rows for each
row a key has on the other side.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from augur.session import stored

SHARE = 0.001
MERGERS = 64  # tasks that combine the sketches of all scan tasks, before the last one
JOINS = ("inner", "left", "left_semi", "left_anti")


def hot_keys(df: DataFrame, keys: Sequence[str], share: float = SHARE) -> DataFrame:
    """(_hash, _salts) of the keys with more than ``share`` of the rows: the
    hash of the key, and its rows in units of that share. Keys with over half of
    ``share`` may be among them, so there are 2 / ``share`` at most."""
    if not 0 < share < 1:
        raise ValueError(f"share is between 0 and 1, not {share}")
    # an item sketch of n slots errs by 3.5 / n of the rows at most
    tracked, most = math.ceil(7 / share), math.ceil(2 / share)
    sketches = (
        df.select(F.xxhash64(*keys).alias("_hash"), (F.spark_partition_id() % MERGERS).alias("_merger"))
        .groupBy("_merger")
        .agg(F.expr(f"approx_top_k_accumulate(_hash, {tracked})").alias("_sketch"), F.count(F.lit(1)).alias("_rows"))
    )
    # grouped by a constant: an empty table has no sketch to combine
    whole = sketches.groupBy(F.lit("all")).agg(F.expr("approx_top_k_combine(_sketch)").alias("_sketch"), F.sum("_rows").alias("_rows"))
    top = whole.select(
        (F.col("_rows") * share).alias("_unit"), F.explode(F.expr(f"approx_top_k_estimate(_sketch, {most})")).alias("_top")
    )
    return top.where("_top.count > _unit").select(
        F.col("_top.item").alias("_hash"), F.ceil(F.col("_top.count") / F.col("_unit")).cast("int").alias("_salts")
    )


def hot_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    share: float = SHARE,
    spread: Column | None = None,
) -> DataFrame:
    """``left.join(right, on, how)`` where single keys may hold much of ``left``.

    ``how`` is inner, left, left_semi or left_anti. The key columns have the
    same types on both sides. Rows of a hot key are spread by ``spread``
    (default: a hash of the whole row; name a row id where a
    third of the rows may be repeated as a whole). It must be deterministic, as a
    lost task's rows must go where they went before. NULL keys match nothing, and are spread like any key.
    """
    on = list(on)
    if how not in JOINS:
        raise ValueError(f"how is one of {JOINS}, not {how!r}")
    for key in on:
        if left.schema[key].dataType != right.schema[key].dataType:
            raise ValueError(f"{key} has two types: {left.schema[key].dataType}, {right.schema[key].dataType}")
    hot = stored(hot_keys(left, on, share), "hot_keys")
    if hot.isEmpty():
        return left.join(right, on, how)
    if spread is None:
        spread = F.xxhash64(*[f.name for f in left.schema if not isinstance(f.dataType, T.MapType)])
    salts = lambda df: df.withColumn("_hash", F.xxhash64(*on)).join(F.broadcast(hot), "_hash", "left").drop("_hash")
    dealt = left.withColumn("_spread", spread)
    dealt = salts(dealt).withColumn("_salt", F.coalesce(F.pmod("_spread", "_salts").cast("int"), F.lit(0))).drop("_spread", "_salts")
    known = right.dropna(subset=on)
    repeated = salts(known).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))).drop("_salts")
    return dealt.join(repeated, [*on, "_salt"], how).drop("_salt")
