"""Dashboard-derived metrics (U15-U22) as jobs over the marts.

These read the (small) marts, never the fact again. Single-row results use
scalar subqueries rather than cross joins of one-row frames.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from augur.functions.labels import first_word, pair_label, question_label as _qlabel, signed_points
from augur.plans.marts import MEMBER, member_words, merge_cells, profile, question_cells


def kpi_header(summary: DataFrame, engagement: DataFrame, revisions: DataFrame) -> DataFrame:
    """#questions, #forecasters, total submissions, mean of the rounded
    per-question medians (rounded to 1 place), #revised pairs."""
    forecasters = engagement.agg(F.count(F.lit(1))).scalar()
    submissions = engagement.agg(F.sum("total_submissions").cast("bigint")).scalar()
    revised = revisions.agg(F.count(F.lit(1))).scalar()
    return summary.agg(
        F.count(F.lit(1)).alias("questions"),
        F.round(F.avg("median_prediction"), 1).alias("mean_of_medians"),
    ).select(
        "questions",
        forecasters.alias("forecasters"),
        submissions.alias("submissions"),
        "mean_of_medians",
        revised.alias("revisions"),
    )


def question_extremes(summary: DataFrame) -> DataFrame:
    """Most and least confident question (ties broken by id) and the
    spread of medians."""
    order = F.struct("median_prediction", "question_id")
    return summary.agg(
        F.max_by("question_id", order).alias("hi"),
        F.min_by("question_id", order).alias("lo"),
        (F.max("median_prediction") - F.min("median_prediction")).alias("spread"),
    )


def question_label(summary: DataFrame, width: int = 62) -> DataFrame:
    """display label and asymmetric error bars per question."""
    return summary.select(
        "question_id",
        _qlabel(F.col("question_id"), F.col("question_text"), width).alias("label"),
        (F.col("max_prediction") - F.col("median_prediction")).alias("err_hi"),
        (F.col("median_prediction") - F.col("min_prediction")).alias("err_lo"),
    )


# The display tables' columns and headings, in order.
SUMMARY_TABLE = {
    "question_id": "ID",
    "question_text": "Question",
    "forecaster_count": "Forecasters",
    "median_prediction": "Median %",
    "mean_prediction": "Mean %",
    "stddev_prediction": "Std Dev",
    "min_prediction": "Min %",
    "max_prediction": "Max %",
}
TYPE_TABLE = {
    "forecaster_type": "Type",
    "forecaster_count": "Forecasters",
    "total_forecasts": "Total Forecasts",
    "avg_prediction": "Avg %",
    "median_prediction": "Median %",
    "prediction_stddev": "Std Dev",
}
REVISION_TABLE = {
    "forecaster_name": "Forecaster",
    "forecaster_type": "Type",
    "question_id": "Question",
    "first_prediction": "First %",
    "last_prediction": "Last %",
    "net_revision": "Net Change",
    "total_submissions": "Submissions",
}
PROFILE_TABLE = {
    "forecaster_name": "Name",
    "forecaster_type": "Type",
    "years": "Exp (yrs)",
    "education_level": "Education",
    "country": "Country",
    "questions_covered": "Questions",
    "total_submissions": "Submissions",
    "avg_prediction": "Avg %",
}
CALIBRATION_AVG, CALIBRATION_SD = "{} Avg", "{} \u03c3"


def display(mart: DataFrame, headings: dict[str, str]) -> DataFrame:
    """A mart's display columns under their headings."""
    return mart.select(*[F.col(c).alias(h) for c, h in headings.items()])


def presentation_projection(summary: DataFrame) -> DataFrame:
    """The question table."""
    return display(summary, SUMMARY_TABLE)


def calibration_table(spread: DataFrame, names: dict[str, str], sd_suffix: str = "sd") -> DataFrame:
    """The calibration table; ``names`` gives each prefix's display name."""
    headings = {"question_id": "Question"}
    for prefix, name in names.items():
        headings[f"{prefix}_avg"] = CALIBRATION_AVG.format(name)
        headings[f"{prefix}_{sd_suffix}"] = CALIBRATION_SD.format(name)
    return display(spread, headings)


def revision_counts(revisions: DataFrame) -> DataFrame:
    """Up / down counts and the largest absolute move."""
    net = F.col("net_revision")
    return revisions.agg(
        F.count_if(net > 0).alias("up"),
        F.count_if(net < 0).alias("down"),
        F.max(F.abs(net)).alias("max_abs"),
    )


def revision_label(revisions: DataFrame, name_sep: str | None = None) -> DataFrame:
    """``<first name> / <question>`` and ``+5 pts`` text."""
    return revisions.select(
        "forecaster_sk",
        "question_id",
        pair_label(F.col("forecaster_name"), F.col("question_id"), name_sep).alias("label"),
        signed_points(F.col("net_revision")).alias("txt"),
    )


def hypothesis_check(
    spread: DataFrame, prefixes: tuple[str, ...], tighter: tuple[str, str], sd_suffix: str = "sd"
) -> DataFrame:
    """Mean of the (rounded) per-question stddevs per type, and whether
    the first named type is tighter than the second."""
    a, b = tighter
    return spread.agg(
        *[F.round(F.avg(f"{p}_{sd_suffix}"), 3).alias(f"{p}_mean") for p in prefixes],
        (F.avg(f"{a}_{sd_suffix}") < F.avg(f"{b}_{sd_suffix}")).alias(f"{a}_tighter"),
    )


def experience_vs_avg(engagement: DataFrame, name_sep: str | None = None) -> DataFrame:
    """Experience against average prediction and volume, with the
    first word of the name as label."""
    return engagement.na.drop(subset=["years"]).select(
        "years",
        "avg_prediction",
        "total_submissions",
        "forecaster_type",
        first_word(F.col("forecaster_name"), name_sep).alias("label"),
    )


def ordered_summary(summary: DataFrame) -> DataFrame:
    """O1: by question id ascending, NULLs last as in the reference."""
    return summary.orderBy(F.col("question_id").asc_nulls_last())


def ordered_engagement(engagement: DataFrame) -> DataFrame:
    """O2: by submissions descending (ties by id for a stable order)."""
    return engagement.orderBy(F.col("total_submissions").desc(), F.col("forecaster_sk").asc_nulls_last())


def ordered_revisions(revisions: DataFrame) -> DataFrame:
    """O3: by absolute net revision descending (ties by pair)."""
    return revisions.orderBy(
        F.abs("net_revision").desc(), F.col("forecaster_sk").asc_nulls_last(), F.col("question_id").asc_nulls_last()
    )


def ascending(mart: DataFrame, column: str, *ties: str) -> DataFrame:
    """A mart from its least to its greatest ``column`` (ties by the named columns)."""
    return mart.orderBy(F.col(column).asc_nulls_last(), *[F.col(c).asc_nulls_last() for c in ties])


def top_forecaster(engagement: DataFrame) -> DataFrame:
    """Highest volume, ties broken by the smaller id (top-1 report)."""
    return (
        engagement.orderBy(F.col("total_submissions").desc(), F.col("forecaster_sk").asc())
        .limit(1)
        .select("forecaster_sk", "forecaster_name", "forecaster_type", "total_submissions", "questions_covered")
    )


def coverage_gaps(fact: DataFrame, forecasters: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Per question, how many forecasters answered it against how many
    are active (have any forecast) and registered (in the dimension);
    ``has_gap`` marks questions answered by fewer than all active ones.

    From the fact or ``marts.question_cells``: a question's forecasters are
    the bits of its words, the active ones those of all questions' words
    together. Counts, not pairs; ``missing_pairs`` lists the pairs.
    """
    cells = question_cells(fact, known)
    words = merge_cells(cells.where(F.col("kind") == MEMBER), [])
    active = words.agg(F.sum(F.bit_count("bits")).cast("long")).scalar()
    registered = forecasters.agg(F.count(F.lit(1))).scalar()
    covered = F.col("covered")
    return (
        profile(cells, ["question_id"])
        .withColumnRenamed("members", "covered")
        .select(
            "question_id",
            "covered",
            active.alias("active"),
            registered.alias("registered"),
            (active - covered).alias("missing_active"),
            (registered - covered).alias("missing_registered"),
            (covered < active).alias("has_gap"),
        )
    )


def missing_pairs(fact: DataFrame, forecasters: DataFrame, registered: bool = False, known: DataFrame | None = None) -> DataFrame:
    """Which forecasters each question lacks: of the active ones (any
    forecast on any question), or with ``registered`` of the whole dimension.

    From the fact or ``marts.question_cells``, as complements of bitmap words:
    a word of 64 forecasters meets the questions once, a question that has them all
    leaves it at once, and only bits that are missing become rows. No join of
    questions with forecasters; a word's row carries one entry a question.
    """
    words = question_cells(fact, known).where((F.col("kind") == MEMBER) & F.col("cell").isNotNull() & F.col("question_id").isNotNull())
    asked = words.agg(F.collect_set("question_id")).scalar()
    have = words.groupBy("cell").agg(
        F.map_from_entries(F.collect_list(F.struct("question_id", "bits"))).alias("have"), F.bit_or("bits").alias("all")
    )
    if registered:
        keys = forecasters.where(F.col("forecaster_sk").isNotNull())
        every = member_words(keys, "forecaster_sk").withColumnRenamed("bits", "_bits")
        have = every.join(have, "cell", "left").withColumn("all", F.col("_bits"))
    gaps = have.select("cell", "all", "have", F.explode(asked).alias("question_id")).select(
        "question_id", "cell", F.col("all").bitwiseAND(F.bitwise_not(F.coalesce(F.col("have")[F.col("question_id")], F.lit(0).cast("long")))).alias("gap")
    )
    bit = F.explode(F.filter(F.sequence(F.lit(0), F.lit(63)), lambda i: F.getbit("gap", i) == 1)).alias("bit")
    rows = gaps.where("gap <> 0").select("question_id", "cell", bit)
    who = rows.select("question_id", (F.col("cell") * 64 + F.col("bit")).alias("forecaster_sk"))
    return who.join(forecasters.select("forecaster_sk", "forecaster_name"), "forecaster_sk").select(
        "question_id", "forecaster_sk", "forecaster_name"
    )


def ordered_types(types: DataFrame) -> DataFrame:
    """O2: the type comparison by average, descending, NULLs last."""
    return types.orderBy(F.col("avg_prediction").desc_nulls_last(), F.col("forecaster_type").asc_nulls_last())
