"""Analytical marts (U6-U14) over a forecast fact and a forecaster dimension.

Fact columns:       forecaster_sk, question_id, question_text, prediction,
                    forecast_timestamp
Forecaster columns: forecaster_sk, forecaster_name, forecaster_type, years,
                    and where there are any forecaster_id, education_level,
                    country

Per-pair marts read the fact once, through ``pair_table``: one row for each
(forecaster, question) with counts, sums, extremes and the first and last
prediction, a map-side hash aggregate. Profiles (median, moments, distinct
forecasters) read it once through ``profile_cells``: a histogram of values and
64-bit words of a bitmap of members, both combined map-side by one hash
aggregate, so neither pairs nor texts are shuffled for them. Both tables are
mergeable (``merge_pairs``, ``merge_cells``): states of parts of the fact add up to
the state of the whole, which is what the incremental gold layer keeps. Each
function takes the fact or such a table, so a caller may write it once.
Forecaster attributes join aggregates, never the fact, and question texts come last.
Joins carry no broadcast hint: AQE broadcasts the dimension only when its
measured size is under the threshold and keeps a sort-merge join otherwise.

Of several predictions of a pair at one time, the greatest counts as the last
and the least as the first, so reruns agree.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from augur.operators.reshape import wide_to_long
from augur.operators.sequence import sequence_number

FACT_KEY = ["forecaster_sk", "question_id"]
TS = "forecast_timestamp"
PAIR_COLUMNS = ["n", "n_predicted", "total", "least", "greatest", "first_at", "first_prediction", "last_at", "last_prediction"]
CELL_COLUMNS = ["kind", "cell", "n", "bits"]
VALUE, MEMBER = 0, 1  # kinds of a profile's cells

# Revision direction labels.
UP, DOWN, SAME = "revised up", "revised down", "no change"


def _r1(c):
    return F.round(c, 1)


def _at(ts: str, prediction: str):
    """A time and the prediction made then as one ordered number (buffers of a
    hash aggregate hold numbers, not structs)."""
    micros = F.unix_micros(F.col(ts).cast("timestamp")).cast("decimal(20,0)")
    return micros * F.lit(1 << 33).cast("decimal(11,0)") + F.coalesce(F.col(prediction), F.lit(-(1 << 31))).cast("decimal(11,0)")


def pair_table(fact: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """One row for each (forecaster, question): submissions (n), predictions
    that aren't NULL with their sum and extremes, first and last prediction and their
    order keys. Given that table, it is returned as it is. ``known``
    (forecaster_sk) drops forecasts of unknown forecasters, after the aggregation."""
    pairs = fact
    if not set(PAIR_COLUMNS) <= set(fact.columns):
        rows = fact.select(*FACT_KEY, "prediction", _at(TS, "prediction").alias("_at"))
        pairs = rows.groupBy(*FACT_KEY).agg(
            F.count(F.lit(1)).alias("n"),
            F.count("prediction").alias("n_predicted"),
            F.sum("prediction").alias("total"),
            F.min("prediction").alias("least"),
            F.max("prediction").alias("greatest"),
            F.min("_at").alias("first_at"),
            F.min_by("prediction", "_at").alias("first_prediction"),
            F.max("_at").alias("last_at"),
            F.max_by("prediction", "_at").alias("last_prediction"),
        )
    return pairs if known is None else pairs.join(known.select("forecaster_sk"), "forecaster_sk", "left_semi")


def merge_pairs(states: DataFrame, also: Sequence[str] = ()) -> DataFrame:
    """Pair tables of disjoint sets of forecasts, unioned, as one. ``also``
    names further columns that a forecaster determines."""
    return states.groupBy(*FACT_KEY, *also).agg(
        *[F.sum(c).alias(c) for c in ("n", "n_predicted", "total")],
        F.min("least").alias("least"),
        F.max("greatest").alias("greatest"),
        F.min("first_at").alias("first_at"),
        F.min_by("first_prediction", "first_at").alias("first_prediction"),
        F.max("last_at").alias("last_at"),
        F.max_by("last_prediction", "last_at").alias("last_prediction"),
    )


def profile_cells(df: DataFrame, keys: Sequence[str], value: str, member: str, weight: str | None = None) -> DataFrame:
    """Mergeable state of the profiles of ``df`` per ``keys``: a histogram of
    whole-number ``value`` (kind 0: cell = value, n rows) and a bitmap of the
    integer ``member`` keys (kind 1: cell = word number, 64 members a word).

    One scan, one shuffle of at most (values + members / 64) rows a key and
    task. Spark's own bitmap aggregate has a binary buffer and is planned as a sort of
    all rows; BIT_OR of 64-bit words stays in the hash aggregate.
    """
    word, bit = _word(member)
    n = F.col(weight).cast("long") if weight else F.lit(1).cast("long")
    zero = F.lit(0).cast("long")
    cells = F.stack(
        F.lit(2),
        F.lit(VALUE), F.col(value).cast("long"), n, zero,
        F.lit(MEMBER), word, zero, F.coalesce(bit, zero),
    ).alias(*CELL_COLUMNS)
    return merge_cells(df.select(*keys, cells), keys)


def _word(member: str) -> tuple[Column, Column]:
    """The number of the bitmap word that holds a member, and the member's bit in it."""
    m = F.col(member).cast("long")
    return F.shiftright(m, 6), F.call_function("shiftleft", F.lit(1).cast("long"), m.bitwiseAND(F.lit(63)).cast("int"))


def member_words(df: DataFrame, member: str) -> DataFrame:
    """The bitmap of all ``member`` keys: (cell, bits)."""
    word, bit = _word(member)
    return df.select(word.alias("cell"), bit.alias("bits")).groupBy("cell").agg(F.bit_or("bits").alias("bits"))


def merge_cells(states: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Cells of disjoint sets of rows, unioned, as one."""
    return states.groupBy(*keys, "kind", "cell").agg(F.sum("n").alias("n"), F.bit_or("bits").alias("bits"))


def profile(cells: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per ``keys``: rows, distinct members and the exact median, mean,
    stddev, min and max of the values, from ``profile_cells``."""
    value = F.when(F.col("kind") == VALUE, F.col("cell"))
    known = F.when(value.isNotNull(), F.col("n"))
    v = F.col("_v").cast("decimal(20,0)")
    rows = cells.select(*keys, "n", value.alias("_v"), known.alias("_k"), F.bit_count("bits").alias("_b"))
    out = rows.groupBy(*keys).agg(
        F.sum("_b").cast("long").alias("members"),
        F.sum("n").alias("rows"),
        F.percentile("_v", F.lit(0.5), F.col("n")).alias("median"),
        F.sum("_k").alias("_n"),
        F.sum(v * F.col("_k")).cast("double").alias("_s"),
        F.sum(v * v * F.col("_k")).cast("double").alias("_q"),
        F.min("_v").cast("int").alias("min"),
        F.max("_v").cast("int").alias("max"),
    )
    return out.select(*keys, "members", "rows", "median", *_mean_and_stddev(), "min", "max")


def _mean_and_stddev() -> list[Column]:
    """From exact sums: the number of values _n, their sum _s and that of their squares _q."""
    spread = (F.col("_q") - F.col("_s") * F.col("_s") / F.col("_n")) / (F.col("_n") - 1)
    return [
        (F.col("_s") / F.col("_n")).alias("mean"),
        F.when(F.col("_n") > 1, F.sqrt(F.greatest(spread, F.lit(0.0)))).alias("stddev"),
    ]


def question_cells(fact: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """``profile_cells`` of the predictions per question. Given that table,
    it is returned as it is. ``known`` (forecaster_sk) drops forecasts of unknown
    forecasters before: cells don't tell whose forecasts they hold."""
    if set(CELL_COLUMNS) <= set(fact.columns):
        return fact
    if known is not None:
        fact = fact.join(known.select("forecaster_sk"), "forecaster_sk", "left_semi")
    return profile_cells(fact, ["question_id"], "prediction", "forecaster_sk")


def with_text(df: DataFrame, questions: DataFrame | Column) -> DataFrame:
    """``question_text`` after ``question_id``: an expression of the id, or from
    a table of both (a NULL id is an id of its own)."""
    if isinstance(questions, Column):
        joined = df.withColumn("question_text", questions)
    else:
        d, q = df.alias("_d"), questions.select("question_id", "question_text").alias("_q")
        same = F.col("_d.question_id").eqNullSafe(F.col("_q.question_id"))
        joined = d.join(q, same, "left").select("_d.*", "_q.question_text")
    return joined.select("question_id", "question_text", *[c for c in df.columns if c != "question_id"])


def question_summary(
    fact: DataFrame,
    with_stddev: bool = True,
    approximate: bool = False,
    known: DataFrame | None = None,
    questions: DataFrame | Column | None = None,
) -> DataFrame:
    """Per question, distinct forecasters and the prediction profile,
    from the fact or ``question_cells``. ``questions`` gives the texts
    (default: the distinct ids and texts of the fact).

    ``approximate=True`` trades exactness for one single-pass aggregate over
    the fact itself: HyperLogLog++ for the distinct count (about 1% relative
    error) and ``percentile_approx`` for the median (a data value within
    1/10000 of the rank, not the interpolated midpoint). The default is exact.
    """
    if questions is None:
        questions = fact.select("question_id", "question_text").distinct()
    if approximate:
        per = fact.groupBy("question_id").agg(
            F.approx_count_distinct("forecaster_sk", 0.01).alias("members"),
            F.percentile_approx("prediction", 0.5, 10000).alias("median"),
            F.avg("prediction").alias("mean"),
            F.stddev_samp("prediction").alias("stddev"),
            F.min("prediction").alias("min"),
            F.max("prediction").alias("max"),
        )
    else:
        per = profile(question_cells(fact, known), ["question_id"])
    return with_text(per, questions).select(
        "question_id",
        "question_text",
        F.col("members").alias("forecaster_count"),
        _r1("median").alias("median_prediction"),
        _r1("mean").alias("mean_prediction"),
        *([_r1("stddev").alias("stddev_prediction")] if with_stddev else []),
        F.col("min").alias("min_prediction"),
        F.col("max").alias("max_prediction"),
    )


def latest_forecasts(fact: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Each forecaster's most recent prediction per question."""
    return pair_table(fact, known).select(*FACT_KEY, F.col("last_prediction").alias("prediction"))


def latest_with_type(
    fact: DataFrame, forecasters: DataFrame, latest: DataFrame | None = None
) -> DataFrame:
    """Latest forecasts (or a precomputed silver copy) with the forecaster type."""
    base = latest if latest is not None else latest_forecasts(fact)
    return base.join(forecasters.select("forecaster_sk", "forecaster_type"), "forecaster_sk")


LATEST_KEY = ["question_id", "forecaster_type"]


def type_comparison(
    fact: DataFrame, forecasters: DataFrame, latest: DataFrame | None = None
) -> DataFrame:
    """U8: forecaster types compared on their latest forecasts, from the
    fact, the pair table or cells (``profile_cells`` per ``LATEST_KEY``)."""
    if set(CELL_COLUMNS) <= set(fact.columns):
        cells = merge_cells(fact, ["forecaster_type"])
    else:
        cells = profile_cells(latest_with_type(fact, forecasters, latest), ["forecaster_type"], "prediction", "forecaster_sk")
    return profile(cells, ["forecaster_type"]).select(
        "forecaster_type",
        F.col("members").alias("forecaster_count"),
        F.col("rows").alias("total_forecasts"),
        _r1("mean").alias("avg_prediction"),
        _r1("median").alias("median_prediction"),
        _r1("stddev").alias("prediction_stddev"),
    )


def type_counts(fact: DataFrame, forecasters: DataFrame, latest: DataFrame | None = None) -> DataFrame:
    """Latest forecasts of every type, counted, with a title-cased label."""
    if set(CELL_COLUMNS) <= set(fact.columns):
        rows = fact.groupBy("forecaster_type").agg(F.sum("n").alias("n"))
    else:
        rows = latest_with_type(fact, forecasters, latest).groupBy("forecaster_type").agg(F.count(F.lit(1)).alias("n"))
    return rows.select("forecaster_type", F.initcap("forecaster_type").alias("label"), "n")


def type_slice(fact: DataFrame, forecasters: DataFrame, forecaster_type: str) -> DataFrame:
    """``type_counts`` of one type. The type filter reaches the
    dimension scan before the join."""
    return type_counts(fact, forecasters.where(F.col("forecaster_type") == forecaster_type))


def _who(forecasters: DataFrame, *attrs: str) -> list[str]:
    """Forecaster key, the natural id when the dimension has one, then those
    of ``attrs`` that it has."""
    extra = ["forecaster_id"] if "forecaster_id" in forecasters.columns else []
    return ["forecaster_sk", *extra, *[a for a in attrs if a in forecasters.columns]]


def _revisions(per_pair: DataFrame, forecasters: DataFrame) -> DataFrame:
    """Revision columns for pairs (first_prediction, last_prediction,
    total_submissions) with more than one submission."""
    who = _who(forecasters, "forecaster_name", "forecaster_type")
    net = F.col("last_prediction") - F.col("first_prediction")
    return (
        per_pair.where(F.col("total_submissions") > 1)
        .join(forecasters.select(*who), "forecaster_sk")
        .select(
            *who,
            "question_id",
            "first_prediction",
            "last_prediction",
            net.alias("net_revision"),
            F.when(net > 0, UP).when(net < 0, DOWN).otherwise(SAME).alias("revision_direction"),
            "total_submissions",
        )
    )


def belief_revision(fact: DataFrame, forecasters: DataFrame) -> DataFrame:
    """U9 (literal): ``first`` is the least prediction, as in the reference,
    and ``last`` the prediction at the latest timestamp. Pairs with one
    submission are dropped before the join."""
    pairs = pair_table(fact).select(
        *FACT_KEY, F.col("least").alias("first_prediction"), "last_prediction", F.col("n").alias("total_submissions")
    )
    return _revisions(pairs, forecasters)


def numbered_revision(fact: DataFrame, forecasters: DataFrame) -> DataFrame:
    """U9 from update numbers (W5): a pair's last prediction is that of the
    update whose number is the pair's count of updates (W6, W8). Numbers come
    from ``sequence_number``, so a pair with a third of all updates is split
    over tasks; ``belief_revision`` needs no order and is the cheaper form."""
    updates = sequence_number(fact.select(*FACT_KEY, TS, "prediction"), FACT_KEY, [TS, "prediction"], "update_no")
    per_pair = updates.groupBy(*FACT_KEY).agg(
        F.min("prediction").alias("first_prediction"),
        F.max(F.struct("update_no", F.col("prediction").alias("p"))).alias("_last"),
    )
    return _revisions(
        per_pair.select(
            *FACT_KEY,
            "first_prediction",
            F.col("_last.p").alias("last_prediction"),
            F.col("_last.update_no").alias("total_submissions"),
        ),
        forecasters,
    )


def belief_revision_chrono(fact: DataFrame, forecasters: DataFrame) -> DataFrame:
    """First and last by time (what the reference means to compute)."""
    pairs = pair_table(fact).select(
        *FACT_KEY, "first_prediction", "last_prediction", F.col("n").alias("total_submissions")
    )
    return _revisions(pairs, forecasters)


def calibration_spread(
    fact: DataFrame,
    forecasters: DataFrame,
    categories: Sequence[tuple[str, str]],
    sd_suffix: str = "sd",
    latest: DataFrame | None = None,
) -> DataFrame:
    """Per question, avg and stddev of latest predictions for each
    listed type as ``<prefix>_avg`` / ``<prefix>_<sd_suffix>`` columns."""
    per = _calibration(fact, forecasters, latest).groupBy("question_id")
    of = lambda t, c: F.max(F.when(F.col("forecaster_type") == t, F.col(c)))  # noqa: E731 - one row each
    return per.agg(
        *[of(t, c).alias(f"{prefix}_{suffix}") for prefix, t in categories for c, suffix in (("avg", "avg"), ("stddev", sd_suffix))]
    )


def _calibration(fact: DataFrame, forecasters: DataFrame, latest: DataFrame | None) -> DataFrame:
    """avg and stddev of the latest predictions per (question, type); from
    cells per ``LATEST_KEY``, or by the same exact sums straight from the latest."""
    if set(CELL_COLUMNS) <= set(fact.columns):
        per = profile(fact, LATEST_KEY)
    else:
        v = F.col("prediction").cast("decimal(20,0)")
        sums = latest_with_type(fact, forecasters, latest).groupBy(*LATEST_KEY).agg(
            F.count("prediction").alias("_n"), F.sum(v).cast("double").alias("_s"), F.sum(v * v).cast("double").alias("_q")
        )
        per = sums.select(*LATEST_KEY, *_mean_and_stddev())
    return per.select(*LATEST_KEY, _r1("mean").alias("avg"), _r1("stddev").alias("stddev"))


def calibration_long(
    fact: DataFrame,
    forecasters: DataFrame,
    types: Sequence[str],
    latest: DataFrame | None = None,
) -> DataFrame:
    """One row per (question, type); grouped directly instead of
    pivoting and un-pivoting."""
    cells = set(CELL_COLUMNS) <= set(fact.columns)
    dim = forecasters if cells else forecasters.where(F.col("forecaster_type").isin(list(types)))
    return _calibration(fact, dim, latest).where(F.col("forecaster_type").isin(list(types)))


def calibration_unpivot(
    spread: DataFrame, categories: Sequence[tuple[str, str]], sd_suffix: str = "sd"
) -> DataFrame:
    """R2 over an existing wide mart: (question_id, forecaster_type, avg, <sd_suffix>)."""
    return wide_to_long(spread, ["question_id"], categories, ["avg", sd_suffix], "forecaster_type")


def engagement(fact: DataFrame, forecasters: DataFrame) -> DataFrame:
    """Per forecaster coverage and activity, aggregated before the
    join (one row per forecaster reaches the join, not one per forecast).
    Of the profile, the columns that the dimension has."""
    per = (
        pair_table(fact)
        .groupBy("forecaster_sk")
        .agg(
            F.count("question_id").alias("questions_covered"),
            F.sum("n").alias("total_submissions"),
            _r1(F.sum("total") / F.sum("n_predicted")).alias("avg_prediction"),
            F.min("least").alias("min_prediction"),
            F.max("greatest").alias("max_prediction"),
        )
    )
    who = _who(forecasters, "forecaster_name", "forecaster_type", "years", "education_level", "country")
    return per.join(forecasters.select(*who), "forecaster_sk").select(
        *who,
        "questions_covered",
        "total_submissions",
        "avg_prediction",
        "min_prediction",
        "max_prediction",
    )
