"""Star-schema build from the raw survey extracts.

raw_forecasts_export ─┬─> dim_questions ──┬─> bridge_question_tags <── raw_question_tags
                      ├─> dim_date        │
                      ├─> dim_forecasters │  <── raw_forecaster_demographics
                      └─> fct_forecasts <─┴── (forecaster_sk, question_sk lookups)

Every surrogate key is dense 1..N in natural-key order and is produced by
``dense_key`` (no single-partition exchange). Aggregation happens before
joins wherever the grain allows.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from augur.functions.clean import (
    blank_to_null,
    is_complete,
    normalize_tag,
    normalize_vocab,
    parse_mixed_dates,
    typed_date,
    typed_int,
    typed_timestamp,
)
from augur.functions.dates import date_parts
from augur.operators.dedup import reduced
from augur.operators.keys import dense_key
from augur.sources.csv import load_raw
from augur.session import concurrently, stored
from augur.sources.quarantine import split
from augur.sources.store import Entry, Store

# Fixed value: the one vocabulary repair the extract needs.
EDUCATION_VOCAB = {"Bachelor": "Bachelors"}

FORECAST_NATURAL_KEY = ["forecaster_id", "question_id", "forecast_timestamp"]


def dim_forecasters(
    forecasts: DataFrame,
    demographics: DataFrame,
    vocab: Mapping[str, str] = EDUCATION_VOCAB,
    profile_cols: Sequence[str] = ("education_level",),
) -> DataFrame:
    """One row per forecaster in the demographics extract.

    Forecasts are pre-aggregated to one row per forecaster before the left
    join (no fan-out); a registered forecaster with no forecast is kept with
    NULL name/type and is_active = FALSE. Name and type are MAX over the
    forecasts as in the reference; years are cast before MAX so '12' > '8'.
    """
    per = forecaster_names(forecasts)
    joined = forecaster_profiles(demographics, vocab, profile_cols).join(per, "forecaster_id", "left")
    return dense_key(joined, ["forecaster_id"], "forecaster_sk").select(
        "forecaster_sk", "forecaster_id", *FORECASTER_ATTRIBUTES[:-2], F.coalesce("is_active", F.lit(False)).alias("is_active"), "has_complete_profile"
    )


FORECASTER_ATTRIBUTES = [
    "forecaster_name", "forecaster_type", "education_level", "years_forecasting_experience", "country", "affiliation", "joined_date",
    "is_active", "has_complete_profile",
]


def forecaster_names(forecasts: DataFrame) -> DataFrame:
    """What forecasts tell about their forecasters: name, type, is_active.
    Reduced first: a hash aggregate that leaves few rows for MAX over text,
    which Spark can only plan as a sort."""
    return (
        reduced(forecasts, "forecaster_id", "forecaster_name", "forecaster_type")
        .groupBy("forecaster_id")
        .agg(
            F.max("forecaster_name").alias("forecaster_name"),
            F.max("forecaster_type").alias("forecaster_type"),
            F.lit(True).alias("is_active"),
        )
    )


def forecaster_profiles(
    demographics: DataFrame, vocab: Mapping[str, str] = EDUCATION_VOCAB, profile_cols: Sequence[str] = ("education_level",)
) -> DataFrame:
    """One cleaned row per registered forecaster; every column is a MAX or an
    OR, so rows of several extracts merge."""
    cleaned = demographics.select(
        "forecaster_id",
        normalize_vocab("education_level", vocab).alias("education_level"),
        typed_int("years_forecasting_experience").alias("years_forecasting_experience"),
        "country",
        "affiliation",
        parse_mixed_dates("joined_date").alias("joined_date"),
        is_complete(*profile_cols).alias("has_complete_profile"),
    )
    return (
        reduced(cleaned, *cleaned.columns)
        .groupBy("forecaster_id")
        .agg(
            *[F.max(c).alias(c) for c in ("education_level", "years_forecasting_experience", "country", "affiliation", "joined_date")],
            F.bool_or("has_complete_profile").alias("has_complete_profile"),
        )
    )


def question_texts(forecasts: DataFrame) -> DataFrame:
    """MAX(text) per question id, as in the reference."""
    texts = reduced(forecasts, "question_id", "question_text")  # few: see forecaster_names
    return texts.groupBy("question_id").agg(F.max("question_text").alias("question_text"))


def dim_questions(forecasts: DataFrame) -> DataFrame:
    """One row per question id; text is MAX(text) as in the reference."""
    return dense_key(question_texts(forecasts), ["question_id"], "question_sk").select(
        "question_sk", "question_id", "question_text"
    )


def question_tags(tags: DataFrame) -> DataFrame:
    return tags.select("question_id", normalize_tag("tag").alias("tag")).distinct()


def bridge_question_tags(tags: DataFrame, questions: DataFrame) -> DataFrame:
    """Normalise (lower, trim) first, then de-duplicate the pairs."""
    return (
        question_tags(tags)
        .join(questions.select("question_id", "question_sk"), "question_id")
        .select("question_sk", "tag")
    )


def dim_date(forecasts: DataFrame, ts_col: str = "forecast_timestamp") -> DataFrame:
    """U4: distinct dates first, calendar attributes derived from few rows."""
    days = forecasts.select(typed_date(typed_timestamp(ts_col)).alias("date_day")).distinct()
    return days.select("date_day", *date_parts(F.col("date_day")))


FORECAST_VALUES = ["prediction", "question_text", "rationale"]


def typed_forecasts(forecasts: DataFrame) -> DataFrame:
    """The natural key and the values of raw forecasts, typed as the fact has them."""
    return forecasts.select(
        "forecaster_id",
        "question_id",
        typed_timestamp("forecast_timestamp").alias("forecast_timestamp"),
        typed_int("prediction").alias("prediction"),
        "question_text",
        blank_to_null("rationale").alias("rationale"),
    )


def dedup_forecasts(forecasts: DataFrame) -> DataFrame:
    """One row per natural key (forecaster, question, time). The survivor
    is the row smallest in (prediction, question text, rationale), NULL first:
    a total order on what the fact stores, so reruns keep the same row, and a
    later batch can be held against a row that the fact already has. Exact
    copies go first, in a hash aggregate, and are written once; only keys that
    different rows share are then resolved by that order."""
    rows = stored(typed_forecasts(forecasts).distinct(), "forecast_rows")
    shared = rows.groupBy(*FORECAST_NATURAL_KEY).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    r, k = rows.alias("r"), stored(shared.drop("_n"), "shared_keys").alias("k")
    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"k.{c}")) for c in FORECAST_NATURAL_KEY]
    resolved = (
        r.join(k, same, "left_semi")
        .groupBy(*FORECAST_NATURAL_KEY)
        .agg(F.min(F.struct(*FORECAST_VALUES)).alias("_r"))
        .select(*FORECAST_NATURAL_KEY, *[F.col(f"_r.{c}").alias(c) for c in FORECAST_VALUES])
    )
    return r.join(k, same, "left_anti").unionByName(resolved)


FACT_ORDER = ["forecast_timestamp", "forecaster_id", "question_id"]


def fact_rows(forecasts: DataFrame, forecasters: DataFrame, questions: DataFrame) -> DataFrame:
    """Dedup -> key lookups. Inner joins drop forecasts of unknown
    forecasters, as the reference does. Natural ids stay for ordering."""
    return dedup_forecasts(forecasts).join(
        forecasters.select("forecaster_id", "forecaster_sk"), "forecaster_id"
    ).join(questions.select("question_id", "question_sk"), "question_id")


def fact_columns(keyed: DataFrame) -> DataFrame:
    """Final fact columns."""
    return keyed.select(
        "forecast_sk",
        "forecaster_sk",
        "question_sk",
        "forecast_timestamp",
        "prediction",
        "rationale",
        F.col("question_text").alias("question_text_snapshot"),
        typed_date("forecast_timestamp").alias("date_day"),
    )


def fct_forecasts(forecasts: DataFrame, forecasters: DataFrame, questions: DataFrame) -> DataFrame:
    """Dedup -> key lookups -> dense forecast_sk ordered by (time,
    forecaster, question)."""
    return fact_columns(dense_key(fact_rows(forecasts, forecasters, questions), FACT_ORDER, "forecast_sk"))


def build_tables(raw: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """All five model tables as lazy DataFrames, in dependency order."""
    f = raw["raw_forecasts_export"]
    forecasters = dim_forecasters(f, raw["raw_forecaster_demographics"])
    questions = dim_questions(f)
    return {
        "dim_forecasters": forecasters,
        "dim_questions": questions,
        "bridge_question_tags": bridge_question_tags(raw["raw_question_tags"], questions),
        "dim_date": dim_date(f),
        "fct_forecasts": fct_forecasts(f, forecasters, questions),
    }


# The partition column of each model table (the fact has a
# folder per forecast date, the dimensions that later loads update one per
# bucket of natural ids, which isn't a column of the table) and the
# sort-within-file columns.
BUCKET = "_bucket"
PARTITION_BY = {"fct_forecasts": "date_day", "dim_forecasters": BUCKET, "dim_questions": BUCKET}
SORT_WITHIN = {
    "dim_forecasters": ["forecaster_sk"],
    "dim_questions": ["question_sk"],
    "bridge_question_tags": ["question_sk", "tag"],
    "dim_date": ["date_day"],
    "fct_forecasts": ["forecaster_sk", "question_sk", "forecast_timestamp"],
    "pending_forecasts": [],
    "pending_tags": [],
}
MODEL_TABLES = ("dim_forecasters", "dim_questions", "bridge_question_tags", "dim_date", "fct_forecasts")
BUCKETS = 8


def bucket_of(key: str, buckets: int):
    """The bucket of a natural id: an update rewrites only the buckets it touches."""
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def write_table(store: Store, name: str, df: DataFrame, buckets: int) -> Entry:
    column = PARTITION_BY.get(name)
    if column == BUCKET and BUCKET not in df.columns:
        key = "forecaster_id" if name == "dim_forecasters" else "question_id"
        df = df.withColumn(BUCKET, bucket_of(key, buckets))
    return store.write(name, df, column, SORT_WITHIN[name], hidden=column == BUCKET)


def write_concurrently(store: Store, jobs: Mapping[str, Callable[[], DataFrame]], buckets: int) -> dict[str, Entry]:
    """Build and write independent tables as concurrent Spark jobs (one
    submitting thread each; building may itself run jobs, e.g. dense keys)."""
    return concurrently({n: lambda n=n, make=make: write_table(store, n, make(), buckets) for n, make in jobs.items()})


def unregistered(forecasts: DataFrame, forecasters: DataFrame) -> DataFrame:
    """Forecasts of people who aren't registered, kept for later loads."""
    return forecasts.join(forecasters.select("forecaster_id"), "forecaster_id", "left_anti").distinct().select(*forecasts.columns)


def untied(tags: DataFrame, questions: DataFrame) -> DataFrame:
    """Tags of questions without a forecast yet, kept for later loads."""
    return question_tags(tags).join(questions.select("question_id"), "question_id", "left_anti").select("question_id", "tag")


def split_all(raw: Mapping[str, DataFrame]) -> tuple[dict[str, DataFrame], DataFrame]:
    """The rows of all extracts that load, and the quarantined ones. The former are
    written once: every table reads them."""
    parts = {name: split(rows, name) for name, rows in raw.items()}
    bad = reduce(DataFrame.unionByName, [b for _, b in parts.values()])
    return {name: stored(good, name) for name, (good, _) in parts.items()}, bad


def build(
    spark: SparkSession,
    raw_paths: Mapping[str, str],
    out_dir: str,
    buckets: int = BUCKETS,
    assertions: Mapping[str, Callable[[Mapping[str, Entry]], bool]] | None = None,
    lenient: bool = False,
) -> dict[str, int]:
    """CSV -> raw -> star schema, full refresh, returns observed row counts.

    The three dimensions do not depend on each other and are written as
    concurrent jobs; bridge and fact then read the *written* dimensions, so
    every key lookup sees stable numbers, and are written concurrently too.
    All tables are published by one commit record (``sources/store.py``): until
    it is there, readers see the old version, and a failed build changes
    nothing. ``assertions`` see the written tables' profiles (rows, NULLs per
    column) and keep a version that fails one from being published. ``lenient``
    moves rows that don't parse or cast to the version's ``quarantine`` table
    (``sources/quarantine.py``) instead of stopping.
    """
    store = Store(spark, out_dir)
    base = store.version()
    raw, bad = load_raw(spark, raw_paths, lenient=lenient), None
    if lenient:
        raw, bad = split_all(raw)
    f, tags = raw["raw_forecasts_export"], raw["raw_question_tags"]
    entries = write_concurrently(
        store,
        {
            "dim_forecasters": lambda: dim_forecasters(f, raw["raw_forecaster_demographics"]),
            "dim_questions": lambda: dim_questions(f),
            "dim_date": lambda: dim_date(f),
        },
        buckets,
    )
    forecasters = store.read("dim_forecasters", entries["dim_forecasters"])
    questions = store.read("dim_questions", entries["dim_questions"])
    entries |= write_concurrently(
        store,
        {
            "bridge_question_tags": lambda: bridge_question_tags(tags, questions),
            "fct_forecasts": lambda: fct_forecasts(f, forecasters, questions),
            "pending_forecasts": lambda: unregistered(f, forecasters),
            "pending_tags": lambda: untied(tags, questions),
        },
        buckets,
    )
    if bad is not None:
        entries["quarantine"] = store.write("quarantine", bad)
    store.commit(base, entries, {"build": uuid.uuid4().hex, "buckets": buckets}, assertions)
    return {t: entries[t].rows for t in MODEL_TABLES}


def tables(spark: SparkSession, model_dir: str, version: int | None = None) -> dict[str, DataFrame]:
    """The model's tables, all of one version (default: the newest)."""
    snapshot = Store(spark, model_dir).snapshot(version)
    return {t: snapshot.read(t) for t in MODEL_TABLES}


def table(spark: SparkSession, model_dir: str, name: str, version: int | None = None) -> DataFrame:
    return Store(spark, model_dir).snapshot(version).read(name)


def mart_inputs(tables: Mapping[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """(fact, forecasters) in the shape the marts read.

    The fact keeps the integer surrogate ``forecaster_sk``: marts group on it
    and take names, types and ids from the dimension after aggregating, so
    the fact is never joined to the (possibly large) forecaster dimension row
    by row. Only the small question dimension is joined for id and text.
    """
    fct, fq, fd = tables["fct_forecasts"], tables["dim_questions"], tables["dim_forecasters"]
    fact = fct.join(fq, "question_sk").select(
        "forecaster_sk", "question_id", "question_text", "prediction", "forecast_timestamp"
    )
    forecasters = fd.select(
        "forecaster_sk",
        "forecaster_id",
        "forecaster_name",
        "forecaster_type",
        F.col("years_forecasting_experience").alias("years"),
        "education_level",
        "country",
    )
    return fact, forecasters
