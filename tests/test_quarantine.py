"""Lenient loads: bad rows are kept aside with file, line and reason; counts add up."""

import os

import pytest

from augur.plans import model as M
from augur.sources.csv import scan_csv_strings
from augur.sources.quarantine import split
from augur.sources.schemas import RAW_FORECASTS
from augur.sources.store import Store
from augur.streaming.incremental import load
from conftest import FIXTURES

BAD = [
    "F01,Ada Lovelace,superforecaster,Q1,Text,2024-09-01 10:00:00,many,why",  # prediction
    "F01,Ada Lovelace,superforecaster,Q1,Text,some day,30,why",  # time
    "F01,Ada Lovelace",  # too few cells
    "F01,Ada,expert,Q1,Text,2024-09-02 10:00:00,30,why,one more",  # too many
    "F01,Ada,expert,Q1,Text,never,lots,why",  # two faults: one row
]


@pytest.fixture()
def paths(tmp_path):
    lines = open(os.path.join(FIXTURES, "survey_forecasts.csv")).read().splitlines()
    forecasts = tmp_path / "forecasts.csv"
    forecasts.write_text("\n".join([*lines[:8], *BAD, *lines[8:]]) + "\n")
    people = open(os.path.join(FIXTURES, "survey_forecasters.csv")).read().rstrip("\n")
    demographics = tmp_path / "people.csv"
    demographics.write_text(people + "\nF55,eight,PhD,UK,Oxford,2020-01-15\n")
    return {
        "raw_forecasts_export": str(forecasts),
        "raw_forecaster_demographics": str(demographics),
        "raw_question_tags": os.path.join(FIXTURES, "survey_tags.csv"),
    }


def test_lenient_build_equals_a_build_without_the_bad_rows(spark, paths, raw_paths, tmp_path):
    out, clean = str(tmp_path / "m"), str(tmp_path / "clean")
    with pytest.raises(Exception, match="MALFORMED|CAST"):
        M.build(spark, paths, out)
    assert Store(spark, out).version() == 0  # strict: nothing is published
    assert M.build(spark, paths, out, lenient=True) == M.build(spark, raw_paths, clean)
    for name, df in M.tables(spark, out).items():
        assert sorted(map(repr, df.collect())) == sorted(map(repr, M.table(spark, clean, name).collect())), name
    kept = M.table(spark, out, "quarantine").collect()
    reasons = sorted((r["extract"], r["file"], r["reason"]) for r in kept)
    assert reasons == [
        ("raw_forecaster_demographics", "people.csv", "years_forecasting_experience is not a whole number"),
        ("raw_forecasts_export", "forecasts.csv", "forecast_timestamp is not a time"),
        ("raw_forecasts_export", "forecasts.csv", "not a record of 8 cells"),
        ("raw_forecasts_export", "forecasts.csv", "not a record of 8 cells"),
        ("raw_forecasts_export", "forecasts.csv", "prediction is not a whole number"),
        ("raw_forecasts_export", "forecasts.csv", "prediction is not a whole number"),
    ]
    assert {r["line"] for r in kept if r["extract"] == "raw_forecasts_export"} == set(BAD)


def test_counts_add_up(spark, paths):
    rows = scan_csv_strings(spark, paths["raw_forecasts_export"], RAW_FORECASTS, lenient=True)
    good, bad = split(rows, "raw_forecasts_export")
    lines = len(open(paths["raw_forecasts_export"]).read().splitlines()) - 1
    assert good.count() + bad.count() == lines and bad.count() == len(BAD)
    assert good.columns == RAW_FORECASTS.names


def test_lenient_load_appends_to_the_quarantine(spark, paths, raw_paths, tmp_path):
    out = str(tmp_path / "m")
    M.build(spark, raw_paths, out)
    rows = scan_csv_strings(spark, paths["raw_forecasts_export"], RAW_FORECASTS, lenient=True)
    assert load(spark, out, rows, lenient=True)["appended"] == 0
    assert M.table(spark, out, "quarantine").count() == len(BAD)
    frame = spark.createDataFrame([("F01", "Ada", "expert", "Q1", "t", "2031-01-01", "x", "w"), ("F01", "Ada", "expert", "Q1", "t", "2031-01-01", "7", "w")], RAW_FORECASTS)
    assert load(spark, out, frame, lenient=True)["appended"] == 1
    assert M.table(spark, out, "quarantine").count() == len(BAD) + 1
