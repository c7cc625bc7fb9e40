"""CSV scans with header, every column a string."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from augur.sources.schemas import RAW_SCHEMAS


LINE, FILE = "_line", "_file"  # what a lenient scan adds


def scan_csv_strings(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    multiline: bool = False,
    lenient: bool = False,
) -> DataFrame:
    """Read a headed CSV with the given all-string schema.

    Quoted fields may hold commas; a doubled quote escapes a quote. Empty
    cells (quoted or not) become NULL. ``multiline`` stays off unless a source
    has embedded newlines, since it makes files unsplittable. A line with too few or
    too many cells stops the scan; ``lenient`` keeps it, with its text in a
    column ``_line`` (NULL for whole records) and its file's name in ``_file``.
    """
    if lenient:
        schema = T.StructType([*schema.fields, T.StructField(LINE, T.StringType())])
    rows = (
        spark.read.schema(schema)
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multiline)
        .option("mode", "PERMISSIVE" if lenient else "FAILFAST")
        .option("columnNameOfCorruptRecord", LINE)
        .option("columnPruning", not lenient)  # a pruned parse doesn't see missing cells
        .csv(path)
    )
    return rows.withColumn(FILE, F.col("_metadata.file_name")) if lenient else rows


def load_raw(
    spark: SparkSession,
    paths: Mapping[str, str],
    schemas: Mapping[str, T.StructType] = RAW_SCHEMAS,
    lenient: bool = False,
) -> dict[str, DataFrame]:
    """Name -> path map to name -> lazily read raw DataFrame."""
    return {name: scan_csv_strings(spark, path, schemas[name], lenient=lenient) for name, path in paths.items()}
