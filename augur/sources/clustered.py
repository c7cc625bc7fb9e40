"""Clustered tables (O4): rows in range files, with an index of the files' bounds.

  <path>/rows/part-*.parquet   the rows, in sorted ranges of the keys: one file a range
  <path>/files/*.parquet       one row a file: its name, row count, first and last keys

Sorting inside files lets Parquet skip row groups, but a reader still opens every
file. Here files are ranges of the whole table, so a look-up by keys reads
the index (a row a file) and opens only the files whose bounds hold those
keys. A key with more rows than a range fills several files: the ranges are
cut on ``tie`` as well.

The bounds are the first and last row of each file, found by row number: no
aggregate over the rows, so text keys are not sorted a second time. NULL keys
sort first and can be looked up with None.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from augur.operators.keys import written_ranges

# file names of one look-up that the driver takes; with more, the whole folder is read
MOST_FILES = 10_000


def write_clustered(
    df: DataFrame, path: str, keys: Sequence[str], tie: Sequence[str] = (), num_files: int | None = None
) -> None:
    """Write ``df`` to the new folder ``path``, clustered by ``keys`` (equal
    keys in order of ``tie``). ``num_files`` fixes the number of ranges
    (default: by volume, as adaptive execution coalesces them)."""
    spark, rows = df.sparkSession, f"{path}/rows"
    written_ranges(df, [F.col(c) for c in [*keys, *tie]], num_files, rows)
    placed = spark.read.schema(df.schema).parquet(rows).select(
        *keys, F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_at")
    )
    # a row a file: broadcast back, and two rows a file left after the filter
    counts = placed.groupBy("_file").agg(F.count(F.lit(1)).alias("_rows"))
    ends = placed.join(F.broadcast(counts), "_file").where("_at = 0 or _at = _rows - 1")
    end = lambda at: F.max(F.when(F.col("_at") == at, F.struct(*keys)))
    bounds = ends.groupBy("_file", "_rows").agg(end(F.lit(0)).alias("low"), end(F.col("_rows") - 1).alias("high"))
    bounds.select(F.col("_file").alias("file"), F.col("_rows").alias("rows"), "low", "high").coalesce(1).write.parquet(f"{path}/files")


def _prefix(spark: SparkSession, path: str, at: Sequence, upto) -> tuple[DataFrame, list, Column]:
    """The index, the fields of the keys named, and its rows' condition."""
    index = spark.read.parquet(f"{path}/files")
    fields = index.schema["low"].dataType.fields
    if not 0 < len(at) <= len(fields):
        raise ValueError(f"give values of the first of {[f.name for f in fields]}")
    fields = fields[: len(at)]
    last = at[-1] if upto is None else upto
    bound = lambda values: F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(values, fields, strict=True)])
    part = lambda side: F.struct(*[F.col(f"{side}.{f.name}").alias(f.name) for f in fields])
    holds = (part("low") <= bound([*at[:-1], last])) & (part("high") >= bound(at))
    return index, fields, holds


def clustered_files(spark: SparkSession, path: str, *at, upto=None) -> DataFrame:
    """(file, rows) of the files that can hold rows with these values of the
    first keys; with ``upto``, the last value is the low end of a range."""
    index, _, holds = _prefix(spark, path, at, upto)
    return index.where(holds).select("file", "rows")


def read_clustered(spark: SparkSession, path: str, *at, upto=None, most_files: int = MOST_FILES) -> DataFrame:
    """The rows with these values of the first keys, from the files that can
    hold them; with ``upto``, the last value is the low end of a range, ends included."""
    _, fields, _ = _prefix(spark, path, at, upto)
    rows = spark.read.parquet(f"{path}/rows")
    found = [r["file"] for r in clustered_files(spark, path, *at, upto=upto).limit(most_files + 1).collect()]
    if not found:
        return rows.where(F.lit(False))
    if len(found) <= most_files:
        rows = spark.read.schema(rows.schema).parquet(*[f"{path}/rows/{name}" for name in sorted(found)])
    equal = fields if upto is None else fields[:-1]
    for field, value in zip(equal, at):  # a range's low end is left over
        rows = rows.where(F.col(field.name).eqNullSafe(F.lit(value).cast(field.dataType)))
    if upto is not None:
        low, high = (F.lit(v).cast(fields[-1].dataType) for v in (at[-1], upto))
        rows = rows.where(F.col(fields[-1].name).between(low, high))
    return rows
