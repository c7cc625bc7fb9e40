"""Dense, ordered surrogate keys 1..N.

``ROW_NUMBER() OVER (ORDER BY k)`` plans an ``Exchange SinglePartition``:
every row goes through one task. ``dense_key`` gives the same numbers
without that bottleneck:

1. range-partition on the ordering (Spark samples the key distribution, so a
   hot value of the first column is still split over several partitions as
   long as the full ordering is a total order), sort inside partitions and
   write the rows once to the shared checkpoint folder: one file per range;
2. count rows per file: a table with one row per file, bounded by the
   partition count and not by the data;
3. running offsets over that small table, broadcast back (size proven by 2);
4. key = offset of the file + the row's index inside the file + 1.

Keys come from immutable files, not from task-local counters, so a lost
executor or a recomputed stage cannot renumber rows. The ordering must be
total (unique); ties get an arbitrary but dense order, as with ROW_NUMBER.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from augur.session import scratch_path

ColumnOrName = Column | str


def _order_cols(order: Sequence[ColumnOrName]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def _ranges(df: DataFrame, cols: list[Column], num_partitions: int | None) -> DataFrame:
    """Range-partition on ``cols``. With an explicit count there are exactly
    that many ranges. Without one, the session's shuffle partitions give the
    range bounds and AQE coalesces neighbouring small ranges up to its
    advisory size: coalescing only merges adjacent ranges, so the order
    across files is kept, and the range count follows the data volume (one
    file for a small dimension, ~advisory-size files for a large fact)."""
    if num_partitions:
        return df.repartitionByRange(num_partitions, *cols)
    return df.repartitionByRange(*cols)


def written_ranges(
    df: DataFrame, cols: Sequence[Column], num_partitions: int | None = None, path: str | None = None
) -> DataFrame:
    """``df`` in sorted range files, read back with ``_part`` (the range) and
    ``_row`` (the row's place in it). One file a range, whatever limit the
    session sets on records per file."""
    spark = df.sparkSession
    path = path or scratch_path(spark, "dense_key")
    (
        _ranges(df, list(cols), num_partitions)
        .sortWithinPartitions(*cols)
        .write.mode("overwrite")
        .option("maxRecordsPerFile", 0)
        .parquet(path)
    )
    ranges = spark.read.parquet(path)
    # range number from the file name part-<n>-...
    part_no = F.regexp_extract(F.col("_metadata.file_name"), r"^part-(\d+)", 1).cast("int")
    return ranges.select(*ranges.columns, part_no.alias("_part"), F.col("_metadata.row_index").alias("_row"))


def dense_key(
    df: DataFrame,
    order: Sequence[ColumnOrName],
    name: str = "sk",
    num_partitions: int | None = None,
    path: str | None = None,
) -> DataFrame:
    """Append ``name`` = 1..N in ``order`` (ascending, NULLs first as in
    Spark's default ascending sort) without a single-partition exchange.

    Runs one job that writes the sorted ranges to ``path`` (default: a new
    folder under ``spark.checkpoint.dir``); the returned DataFrame reads them.
    ``num_partitions`` fixes the number of ranges (default: adaptive, see
    ``_ranges``); either way one range must fit a task.
    """
    rows = written_ranges(df, _order_cols(order), num_partitions, path)
    counts = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    # one row per written file: this window is over at most (shuffle partitions)
    # rows, and the broadcast carries 12 bytes per file
    offsets = counts.select(
        "_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_off")
    )
    return rows.join(F.broadcast(offsets), "_part").select(
        *df.columns, (F.col("_off") + F.col("_row") + 1).cast("bigint").alias(name)
    )
