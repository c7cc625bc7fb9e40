"""Driver test tables and the forecast-shaped views built over them.

Mapping (FIXTURES.md, part B):

  forecast fact     events: forecaster = user_id, question = event_type,
                    time = ts, prediction = floor(value)
  forecaster dim    customer: id = c_custkey, name = c_name,
                    type = c_mktsegment, years = c_nationkey
  tag bridge        supplier x part via lineitem (supplier = question, brand = tag)
  date dim, keys    orders
  duplicates, text  documents
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def forecasts(spark: SparkSession, sf_dir: str, checked: bool = True) -> DataFrame:
    """Forecast fact view: one row per submission.

    ``checked`` keeps referential integrity the way the model build does (an
    inner join on the forecaster); only existence is needed, so it is a semi
    join and no dimension column travels with the fact. Marts that inner-join
    the forecaster dimension after aggregating enforce integrity themselves
    (groups of unknown forecasters find no partner) and take the unchecked
    fact, which saves a join over every forecast row. In the model pipeline
    integrity is established once when ``fct_forecasts`` is built; this view
    re-checks it per query only because the driver's ``events`` are raw.
    Columns: forecaster_sk, question_id, question_text, prediction,
    forecast_timestamp, date_day.
    """
    events = read_table(spark, sf_dir, "events")
    if checked:
        known = read_table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"))
        events = events.join(known, "user_id", "left_semi")
    return events.select(
        F.col("user_id").alias("forecaster_sk"),
        F.col("event_type").alias("question_id"),
        F.upper("event_type").alias("question_text"),
        F.floor("value").cast("int").alias("prediction"),
        F.col("ts").alias("forecast_timestamp"),
        F.col("ts").cast("date").alias("date_day"),
    )


def forecasters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forecaster dimension view: forecaster_sk, forecaster_name,
    forecaster_type, years."""
    return read_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("forecaster_sk"),
        F.col("c_name").alias("forecaster_name"),
        F.col("c_mktsegment").alias("forecaster_type"),
        F.col("c_nationkey").alias("years"),
    )


def forecaster_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dimension view with education_level (the market segment in lower
    case) and country (the nation's name)."""
    nations = read_table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("years"), F.col("n_name").alias("country"))
    dims = forecasters(spark, sf_dir).withColumn("education_level", F.lower("forecaster_type"))
    return dims.join(nations, "years", "left")


# ---------------------------------------------------------------- raw extracts
# The model build reads all-text extracts. These have its columns, filled from
# the driver tables: events are forecasts, customers the registered people
# (their first order's day the joining date, in prose for orders in status F).

PROSE_STATUS = "F"


def raw_forecasts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per event, as text. The extract records a forecast's day only,
    so several events of a person and question on a day are duplicates or
    conflicts of one natural key. The rationale is blank for error events."""
    customers = read_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"),
        F.col("c_name").alias("forecaster_name"),
        F.col("c_mktsegment").alias("forecaster_type"),
    )
    return read_table(spark, sf_dir, "events").join(customers, "user_id", "left").select(
        F.col("user_id").cast("string").alias("forecaster_id"),
        "forecaster_name",
        "forecaster_type",
        F.col("event_type").alias("question_id"),
        F.upper("event_type").alias("question_text"),
        F.floor("value").cast("string").alias("prediction"),
        F.date_format("ts", "yyyy-MM-dd").alias("forecast_timestamp"),
        F.when(F.col("event_type") == "error", F.lit("  ")).otherwise(F.col("props")).alias("rationale"),
    )


def raw_demographics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer, as text."""
    first = F.struct("o_orderdate", "o_orderkey", "o_orderstatus")
    joined = read_table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.min(first).alias("f"))
    nations = read_table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("country"))
    day = F.col("f.o_orderdate")
    prose, iso = F.date_format(day, "MMMM dd, yyyy"), F.date_format(day, "yyyy-MM-dd")
    customers = read_table(spark, sf_dir, "customer").join(nations, "c_nationkey", "left").join(joined, "c_custkey", "left")
    return customers.select(
        F.col("c_custkey").cast("string").alias("forecaster_id"),
        F.when(F.col("c_acctbal") < 0, F.lit("")).otherwise(F.concat(F.lit(" "), "c_mktsegment")).alias("education_level"),
        F.col("c_nationkey").cast("string").alias("years_forecasting_experience"),
        "country",
        F.col("c_name").alias("affiliation"),
        F.when(F.col("f.o_orderstatus") == PROSE_STATUS, prose).otherwise(iso).alias("joined_date"),
    )
