"""Intermediate tables in the folder the cluster shares.

``spark.checkpoint.dir`` names that folder. Reading a written table instead
of recomputing keeps a job correct when executors are lost.

A file costs more than its rows where tables are small: on a local file system Hadoop
starts a process for every file and checksum it writes (``chmod``), next to the executor's heap. So
tables whose rows are counted beforehand are dealt to files by that count, not by shuffle partitions.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from augur.session import ensure_checkpoint_dir

ROWS_A_FILE = 8192


def few_files(df: DataFrame, rows: int) -> DataFrame:
    """``df``, whose last step reads and makes about ``rows`` rows at most, in no more partitions than one for each
    ``ROWS_A_FILE``. Partitions are joined, never split or shuffled; a large table keeps its own."""
    return df.coalesce(max(1, -(-rows // ROWS_A_FILE)))


def stored(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """``df`` written to a new folder under ``spark.checkpoint.dir`` and read back; with ``rows``, by ``few_files``."""
    spark: SparkSession = df.sparkSession
    base = spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)
    path = f"{base.rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"
    (df if rows is None else few_files(df, rows)).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
