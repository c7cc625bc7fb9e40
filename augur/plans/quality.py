"""Data-quality detectors (Q1-Q10) as Spark aggregates.

The reference describes its findings in prose and repairs them in SQL;
here every finding class has a detector that runs over whole tables in one
pass (or one shuffle) and returns a DataFrame.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from augur.functions.clean import normalize_tag, unparsable_iso_date
from augur.operators.dedup import duplicate_groups


def exact_duplicates(df: DataFrame, cols: Sequence[str], id_col: str | None = None) -> DataFrame:
    """Q1: groups of rows identical in ``cols``; ``copies`` and, when an id
    column is given, the smallest id of each group. The compared columns are
    grouped on whole, but only the reported ones are returned."""
    extra = [F.min(id_col).alias(f"first_{id_col}")] if id_col else []
    return duplicate_groups(df, list(cols), "copies", extra)


def conflicting_duplicates(df: DataFrame, key: Sequence[str], id_col: str | None = None) -> DataFrame:
    """Q1 (conflicts): natural keys carried by more than one *different* row;
    ``copies`` rows, ``versions`` distinct rows (ignoring ``id_col``, whose
    smallest value is reported). De-duplication must pick a survivor for
    these by a total order."""
    rest = [c for c in df.columns if c not in key and c != id_col]
    extra = [F.min(id_col).alias(f"first_{id_col}")] if id_col else []
    return (
        df.groupBy(*key)
        .agg(
            F.count(F.lit(1)).alias("copies"),
            F.count_distinct(F.struct(*rest)).alias("versions"),
            *extra,
        )
        .where(F.col("versions") > 1)
    )


def blank_or_null_counts(df: DataFrame, col: str) -> DataFrame:
    """Q2: NULL count, blank (space-only) count and row count of a column."""
    c = F.col(col)
    return df.agg(
        F.count_if(c.isNull()).alias("nulls"),
        F.count_if(F.trim(c) == F.lit("")).alias("blanks"),
        F.count(F.lit(1)).alias("n"),
    )


def blank_or_null_profile(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Q2/Q5: null and blank counts for many string columns in one scan,
    returned long: (column, nulls, blanks, n)."""
    aggs = []
    for c in cols:
        aggs += [
            F.count_if(F.col(c).isNull()).alias(f"{c}__nulls"),
            F.count_if(F.trim(F.col(c)) == F.lit("")).alias(f"{c}__blanks"),
        ]
    wide = df.agg(F.count(F.lit(1)).alias("n"), *aggs)
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.col(f"{c}__nulls").alias("nulls"),
                F.col(f"{c}__blanks").alias("blanks"),
            )
            for c in cols
        ]
    )
    return wide.select(F.inline(rows), "n")


def date_format_issues(df: DataFrame, col: str) -> DataFrame:
    """Q3: values present but not ISO dates."""
    return df.agg(F.count_if(unparsable_iso_date(col)).alias("bad"))


def vocab_violations(df: DataFrame, col: str, accepted: Sequence[str], count_name: str = "n") -> DataFrame:
    """Q4: values outside the accepted vocabulary, with counts. The list is
    a literal IN predicate, pushed to the scan."""
    c = F.col(col)
    return (
        df.where(c.isNotNull() & ~c.isin(list(accepted)))
        .groupBy(col)
        .agg(F.count(F.lit(1)).alias(count_name))
    )


def orphans(parent: DataFrame, child: DataFrame, parent_key: str, child_key: str) -> DataFrame:
    """Parent rows with no child row (left anti join). Child keys are
    de-duplicated first: a map-side partial aggregate whose hash
    partitioning the join reuses, so each task ships distinct keys only."""
    keys = child.select(F.col(child_key).alias(parent_key)).distinct()
    return parent.join(keys, parent_key, "left_anti")


def case_variants(values: DataFrame, col: str, key_name: str = "k") -> DataFrame:
    """Q7: spellings that differ only in case/outer spaces, per normalised
    value. ``count_distinct`` is planned as a two-level aggregate, so a hot
    value is pre-reduced map-side."""
    return (
        values.groupBy(normalize_tag(col).alias(key_name))
        .agg(F.count_distinct(col).alias("variants"))
        .where(F.col("variants") > 1)
    )


def duplicate_pairs(df: DataFrame, key: str, value: str, count_name: str = "copies") -> DataFrame:
    """Q8: (key, normalised value) pairs occurring more than once."""
    return duplicate_groups(
        df.select(key, normalize_tag(value).alias("k")), [key, "k"], count_name
    )


def reconciliation(raw: DataFrame, clean_count: Column) -> DataFrame:
    """Q9: raw rows against rows after cleaning, and the delta."""
    return raw.agg(F.count(F.lit(1)).alias("raw_rows"), clean_count.alias("clean_rows")).select(
        "raw_rows", "clean_rows", (F.col("clean_rows") - F.col("raw_rows")).alias("delta")
    )


def model_reconciliation(
    raw_forecasts: DataFrame, fact: DataFrame, raw_tags: DataFrame, bridge: DataFrame
) -> DataFrame:
    """Q9 (model): raw vs modelled rows for forecasts and tags, and the two
    deltas, in one row. Each count is a scalar subquery (no cross join)."""
    n = lambda df: df.agg(F.count(F.lit(1))).scalar()
    fact_rows, raw_tag_rows, bridge_rows = n(fact), n(raw_tags), n(bridge)
    return raw_forecasts.agg(F.count(F.lit(1)).alias("raw_forecasts")).select(
        "raw_forecasts",
        fact_rows.alias("fact_rows"),
        (fact_rows - F.col("raw_forecasts")).alias("forecast_delta"),
        raw_tag_rows.alias("raw_tags"),
        bridge_rows.alias("bridge_rows"),
        (bridge_rows - raw_tag_rows).alias("tag_delta"),
    )


def issue(findings: DataFrame, count_expr: Column, severity: str, table: str, column: str,
          text: str, resolution: str) -> DataFrame:
    """One issue-register row: literal description plus a count computed
    from the detector's output."""
    # a detector that finds nothing reports 0, not NULL (sum over no rows)
    return findings.agg(F.coalesce(count_expr.cast("bigint"), F.lit(0).cast("bigint")).alias("affected")).select(
        F.lit(severity).alias("severity"),
        F.lit(table).alias("table_name"),
        F.lit(column).alias("column_name"),
        F.lit(text).alias("issue"),
        F.lit(resolution).alias("resolution"),
        "affected",
    )


def issues(found: DataFrame, rows: Sequence[tuple[str, str, str, str, str, str]]) -> DataFrame:
    """Issue-register rows for several counts of one single-row frame: each
    row names its count column, then severity, table, column, text, resolution."""
    entries = [
        F.struct(
            F.lit(severity).alias("severity"),
            F.lit(table).alias("table_name"),
            F.lit(column).alias("column_name"),
            F.lit(text).alias("issue"),
            F.lit(resolution).alias("resolution"),
            F.coalesce(F.col(count).cast("bigint"), F.lit(0).cast("bigint")).alias("affected"),
        )
        for count, severity, table, column, text, resolution in rows
    ]
    return found.select(F.inline(F.array(*entries)))


def issue_register(issues: Sequence[DataFrame]) -> DataFrame:
    """Q10: union of issue rows."""
    out = issues[0]
    for d in issues[1:]:
        out = out.unionByName(d)
    return out
