"""Checks that the operators on ``embeddings`` share."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def finite(vector: str = "embedding") -> Column:
    """Whether a vector is there and has finite components only."""
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.col(vector).isNotNull() & F.coalesce(whole, F.lit(False))
