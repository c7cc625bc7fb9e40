"""Calendar attributes of a date."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_parts(d: Column) -> list[Column]:
    """year, month, day, day_name, month_name, quarter of a date column.

    Integer parts are BIGINT; names are the full English names
    (``dayname``/``monthname`` would abbreviate).
    """
    return [
        F.year(d).cast("bigint").alias("year"),
        F.month(d).cast("bigint").alias("month"),
        F.dayofmonth(d).cast("bigint").alias("day"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.quarter(d).cast("bigint").alias("quarter"),
    ]
