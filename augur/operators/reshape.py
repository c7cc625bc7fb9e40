"""Long <-> wide reshaping."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def conditional_aggs(
    category: str,
    categories: Sequence[tuple[str, str]],
    metrics: Sequence[tuple[str, Callable[[Column], Column]]],
    value: str,
) -> list[Column]:
    """``AGG(CASE WHEN category = c THEN value END)`` for every (prefix, c) and
    (suffix, agg): one pass, one shuffle, columns ``<prefix>_<suffix>``."""
    out = []
    for prefix, cat in categories:
        cond_value = F.when(F.col(category) == F.lit(cat), F.col(value))
        for suffix, agg in metrics:
            out.append(agg(cond_value).alias(f"{prefix}_{suffix}"))
    return out


def wide_to_long(
    df: DataFrame,
    keys: Sequence[str],
    categories: Sequence[tuple[str, str]],
    suffixes: Sequence[str],
    category_name: str,
) -> DataFrame:
    """Inverse of ``conditional_aggs``: one row per (keys, category) with the
    ``<prefix>_<suffix>`` columns renamed to ``<suffix>`` (a row-local
    ``inline`` of an array of structs; no shuffle)."""
    structs = [
        F.struct(
            F.lit(cat).alias(category_name),
            *[F.col(f"{prefix}_{s}").alias(s) for s in suffixes],
        )
        for prefix, cat in categories
    ]
    return df.select(*keys, F.inline(F.array(*structs)))
