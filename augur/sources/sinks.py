"""Sinks: full-refresh table writes (S5/S6), load audit (S7), record export."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def materialize_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    sort_within: Sequence[str] = (),
    fmt: str = "parquet",
) -> None:
    """Full refresh: overwrite the table at ``path``.

    Global order is not a table property; ``sort_within`` sorts rows inside
    each file so that Parquet min/max statistics prune row groups. With
    folder partitioning the partition columns lead the sort: the writer needs
    rows grouped by folder and would otherwise re-sort on those columns alone.
    """
    order = [*partition_by, *[c for c in sort_within if c not in partition_by]]
    out = df.sortWithinPartitions(*order) if order else df
    writer = out.write.mode("overwrite").format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def write_with_audit(df: DataFrame, path: str, name: str, **kwargs) -> int:
    """Write like ``materialize_table`` and return the row count seen by the
    writer itself (an ``Observation``), so no second scan is needed."""
    obs = Observation(f"audit_{name}")
    materialize_table(df.observe(obs, F.count(F.lit(1)).alias("rows")), path, **kwargs)
    return int(obs.get["rows"])


def audit_frame(spark: SparkSession, counts: dict[str, int]) -> DataFrame:
    """Audit rows (table, rows) from observed counts."""
    return spark.createDataFrame(sorted(counts.items()), "table string, rows long")


def export_json(df: DataFrame, path: str) -> None:
    """Result export as JSON records, written by the executors (no collect)."""
    df.write.mode("overwrite").json(path)
