"""De-duplication.

Every form here is an aggregate, so duplicates collapse map-side before the
shuffle and a key with a third of all rows is pre-reduced in every task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def duplicate_groups(
    df: DataFrame,
    key: Sequence[str | Column],
    count_name: str = "copies",
    extra: Sequence[Column] = (),
) -> DataFrame:
    """Groups of ``key`` that occur more than once, with their size."""
    return (
        df.groupBy(*key)
        .agg(F.count(F.lit(1)).alias(count_name), *extra)
        .where(F.col(count_name) > 1)
    )


def reduced(df: DataFrame, *cols: str) -> DataFrame:
    """Distinct ``cols`` as a hash aggregate of its own.

    The optimizer drops a ``distinct`` below MAX or MIN, which don't mind
    duplicates; over text these then sort all raw rows. The count that is
    filtered on (always true) keeps this aggregate.
    """
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_copies")).where("_copies > 0").select(*cols)
