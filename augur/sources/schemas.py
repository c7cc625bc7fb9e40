"""Explicit schemas. Raw extracts are read as all-string tables, never inferred."""

from __future__ import annotations

from pyspark.sql import types as T


def all_strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


RAW_FORECASTS = all_strings(
    "forecaster_id",
    "forecaster_name",
    "forecaster_type",
    "question_id",
    "question_text",
    "forecast_timestamp",
    "prediction",
    "rationale",
)

RAW_DEMOGRAPHICS = all_strings(
    "forecaster_id",
    "years_forecasting_experience",
    "education_level",
    "country",
    "affiliation",
    "joined_date",
)

RAW_QUESTION_TAGS = all_strings("question_id", "tag")

# name -> schema of the three raw sources of the survey extract
RAW_SCHEMAS: dict[str, T.StructType] = {
    "raw_forecasts_export": RAW_FORECASTS,
    "raw_forecaster_demographics": RAW_DEMOGRAPHICS,
    "raw_question_tags": RAW_QUESTION_TAGS,
}
