"""Latest / first value per group as partial aggregates.

``ROW_NUMBER() OVER (PARTITION BY k ORDER BY t DESC) = 1`` sorts every group
after a full shuffle. ``max_by(v, t)`` is combined map-side, so each task
ships at most one row per group and a hot group costs no more than any other.
Ties on ``t`` inside a group are resolved arbitrarily by both forms; the
forecast fact's natural key (forecaster, question, timestamp) is unique, so
there are none there.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_by(df: DataFrame, keys: Sequence[str], order: str, values: Sequence[str]) -> DataFrame:
    """One row per ``keys`` holding ``values`` of the row with the largest ``order``."""
    return df.groupBy(*keys).agg(*[F.max_by(v, order).alias(v) for v in values])

