"""Per-group sequence numbers (W5), e.g. the update number of a forecast.

``ROW_NUMBER() OVER (PARTITION BY g ORDER BY t)`` needs all rows of a group
in one task; a group holding a third of the data then runs in one task.
``sequence_number`` splits hot groups instead:

1. rows are written in sorted ranges of (g, t): range partitions split any
   group, and a group's rows are neighbours;
2. rows are numbered per (range, group): no task holds more than one range's
   share of a group, and no join is needed;
3. only a range's first group can have begun in an earlier one. Its rows in
   those (one small row for each range at most) are added; that table has a row per
   range and is broadcast.

``method="window"`` keeps the single-shuffle window for data known to have
no hot group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from augur.operators.keys import written_ranges


def sequence_number(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    name: str = "seq",
    method: str = "split",
    num_partitions: int | None = None,
) -> DataFrame:
    if method == "window":
        w = Window.partitionBy(*group).orderBy(*order)
        return df.withColumn(name, F.row_number().over(w).cast("bigint"))
    if method != "split":
        raise ValueError(f"unknown method {method!r}")
    rows = written_ranges(df, [F.col(c) for c in [*group, *order]], num_partitions)
    # NULL-safe: a NULL group key is a group of its own, as in the window form
    same = lambda a, b: [F.col(f"{a}.{g}").eqNullSafe(F.col(f"{b}.{g}")) for g in group]
    heads = rows.where("_row = 0").select("_part", *group).alias("_h")  # one row per range
    runs = (  # rows per range of the groups that some range begins with
        rows.alias("_r")
        .join(F.broadcast(heads.select(*group).distinct().alias("_g")), same("_r", "_g"), "left_semi")
        .groupBy("_part", *group)
        .agg(F.count(F.lit(1)).alias("_n"))
        .alias("_r")
    )
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = runs.withColumn("_carried", F.sum("_n").over(earlier)).where("_carried is not null")
    carried = carried.select("_part", *group, "_carried").alias("_c")
    place = F.row_number().over(Window.partitionBy("_part", *group).orderBy("_row"))
    numbered = rows.withColumn("_place", place).alias("_p")
    cond = [F.col("_p._part") == F.col("_c._part"), *same("_p", "_c")]
    return numbered.join(F.broadcast(carried), cond, "left").select(
        *[F.col(f"_p.{c}") for c in df.columns],
        (F.col("_p._place") + F.coalesce(F.col("_c._carried"), F.lit(0))).cast("bigint").alias(name),
    )
