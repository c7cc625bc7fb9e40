"""Rows that can't be loaded, kept with file, line and reason (S1, F7, F8 in lenient mode).

The default mode is strict: a line that doesn't parse or a cell that doesn't
cast stops the load. In lenient mode ``split`` sends such rows to a quarantine table
and the rest to the load. Every row goes to exactly one of the two, so
counts add up. A row with several faults has the first one's reason.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from augur.sources.csv import FILE, LINE

SCHEMA = "extract string, file string, line string, reason string"


def _uncast(column: str, kind: str) -> Column:
    """Text is there, but isn't a value of this type."""
    return F.col(column).isNotNull() & F.col(column).try_cast(kind).isNull()


def checks(extract: str) -> dict[str, Column]:
    """Reason -> fault, for the cells of an extract that are cast strictly."""
    return {
        "raw_forecasts_export": {
            "prediction is not a whole number": _uncast("prediction", "int"),
            "forecast_timestamp is not a time": _uncast("forecast_timestamp", "timestamp_ntz"),
        },
        "raw_forecaster_demographics": {
            "years_forecasting_experience is not a whole number": _uncast("years_forecasting_experience", "int"),
        },
    }.get(extract, {})


def split(rows: DataFrame, extract: str, faults: Mapping[str, Column] | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows that load, quarantined rows) of an extract, read leniently or not.
    The line of a row that parsed is its cells as CSV."""
    faults = checks(extract) if faults is None else faults
    cells = [c for c in rows.columns if c not in (LINE, FILE)]
    line = F.col(LINE) if LINE in rows.columns else F.lit(None).cast("string")
    file = F.col(FILE) if FILE in rows.columns else F.lit(None).cast("string")
    reason = reduce(
        lambda found, item: F.coalesce(found, F.when(item[1], F.lit(item[0]))),
        faults.items(),
        F.when(line.isNotNull(), F.lit(f"not a record of {len(cells)} cells")),
    )
    judged = rows.withColumn("_reason", reason)
    bad = judged.where("_reason is not null").select(
        F.lit(extract).alias("extract"),
        file.alias("file"),
        F.coalesce(line, F.to_csv(F.struct(*cells))).alias("line"),
        F.col("_reason").alias("reason"),
    )
    return judged.where("_reason is null").select(*cells), bad
