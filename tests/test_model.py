"""Golden and invariant tests of the star-schema build on the hand-made fixture."""

import datetime as dt

from pyspark.sql import functions as F

from augur.plans import model as M


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_row_counts(model):
    counts = {k: v.count() for k, v in model.items()}
    assert counts == {
        "dim_forecasters": 7,
        "dim_questions": 3,
        "bridge_question_tags": 6,
        "dim_date": 17,
        "fct_forecasts": 18,
    }


def test_dim_forecasters_repairs(model):
    d = {r["forecaster_id"]: r for r in model["dim_forecasters"].collect()}
    assert [d[k]["forecaster_sk"] for k in sorted(d)] == list(range(1, 8))
    assert d["F03"]["education_level"] == "Bachelors"
    assert sum(1 for r in d.values() if r["education_level"] == "Bachelors") == 2
    assert d["F06"]["joined_date"] == dt.date(2023, 3, 5)
    assert d["F01"]["joined_date"] == dt.date(2020, 1, 15)
    assert d["F05"]["has_complete_profile"] is False
    assert all(d[k]["has_complete_profile"] for k in d if k != "F05")
    # registered, never active: kept, flagged, no name/type
    assert d["F09"]["is_active"] is False
    assert d["F09"]["forecaster_name"] is None and d["F09"]["forecaster_type"] is None
    assert sum(1 for r in d.values() if r["is_active"]) == 6
    assert d["F02"]["years_forecasting_experience"] == 12
    assert d["F02"]["affiliation"] == "Cambridge, King's College"
    assert "FX" not in d


def test_dim_questions_and_bridge(model):
    q = rows(model["dim_questions"], "question_sk", "question_id")
    assert q == [(1, "Q1"), (2, "Q2"), (3, "Q3")]
    texts = {r["question_id"]: r["question_text"] for r in model["dim_questions"].collect()}
    assert texts["Q2"] == 'Will the "new" treaty pass, by 2026?'
    b = rows(model["bridge_question_tags"], "question_sk", "tag")
    assert b == [
        (1, "climate"), (1, "environment"), (2, "energy"), (2, "politics"), (3, "energy"), (3, "transport")
    ]
    assert model["bridge_question_tags"].select("tag").distinct().count() == 5


def test_dim_date(model):
    d = {r["date_day"]: r for r in model["dim_date"].collect()}
    r = d[dt.date(2024, 2, 1)]
    assert (r["year"], r["month"], r["day"], r["quarter"]) == (2024, 2, 1, 1)
    assert r["day_name"] == "Thursday" and r["month_name"] == "February"
    assert dict(model["dim_date"].dtypes)["year"] == "bigint"


def test_fact(model):
    f = model["fct_forecasts"]
    fd = model["dim_forecasters"].select("forecaster_sk", "forecaster_id")
    fq = model["dim_questions"].select("question_sk", "question_id")
    j = f.join(fd, "forecaster_sk").join(fq, "question_sk")
    assert j.count() == 18  # every FK resolves
    # natural key unique
    assert j.groupBy("forecaster_id", "question_id", "forecast_timestamp").count().where("count > 1").count() == 0
    # conflicting resend: smallest row survives deterministically
    r = j.where("forecaster_id = 'F04' and question_id = 'Q2'").collect()
    assert [x["prediction"] for x in r] == [55]
    # blank / space-only / empty rationale -> NULL
    assert f.where(F.col("rationale").isNull()).count() == 3
    # unknown forecaster dropped
    assert j.where("prediction = 99").count() == 0
    # dense forecast_sk ordered by (timestamp, forecaster, question)
    ordered = [r["forecast_sk"] for r in j.orderBy("forecast_timestamp", "forecaster_id", "question_id").collect()]
    assert ordered == list(range(1, 19))
    types = dict(f.dtypes)
    assert types["prediction"] == "int" and types["forecast_timestamp"] == "timestamp_ntz"
    assert types["forecast_sk"] == "bigint" and types["date_day"] == "date"


def test_input_order_does_not_matter(spark, raw, model):
    shuffled = {k: v.orderBy(F.rand(7)).repartition(3) for k, v in raw.items()}
    again = M.build_tables(shuffled)
    for name in ("dim_forecasters", "fct_forecasts", "bridge_question_tags"):
        cols = model[name].columns
        assert rows(again[name], *cols) == rows(model[name], *cols), name


def test_build_writes_and_audits(spark, raw_paths, tmp_path):
    out = str(tmp_path / "model")
    counts = M.build(spark, raw_paths, out)
    assert counts == {
        "dim_forecasters": 7,
        "dim_questions": 3,
        "dim_date": 17,
        "bridge_question_tags": 6,
        "fct_forecasts": 18,
    }
    first = rows(M.table(spark, out, "fct_forecasts"), "forecast_sk", "prediction")
    M.build(spark, raw_paths, out)  # full refresh is idempotent
    assert rows(M.table(spark, out, "fct_forecasts"), "forecast_sk", "prediction") == first


def test_active_flag_matches_fact(model):
    active = model["dim_forecasters"].where("is_active").count()
    in_fact = model["fct_forecasts"].select("forecaster_sk").distinct().count()
    assert active == in_fact == 6
