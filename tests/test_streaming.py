"""Incremental loads: batch append and the file-source stream give the same
fact as one full build, keys continue after the current maximum, and
re-running a batch appends nothing."""

import os
import shutil

from pyspark.sql import functions as F

from augur.plans import model as M
from augur.sources.csv import load_raw
from augur.sources.schemas import RAW_FORECASTS
from augur.streaming.incremental import append_forecasts, extend_forecasters, retry_pending, stream_forecasts
from conftest import FIXTURES

NK = ["forecaster_sk", "question_sk", "forecast_timestamp", "prediction"]


def split_fixture(tmp_path):
    """First 12 data lines as the initial extract, all lines (overlapping)
    as the later one."""
    lines = open(os.path.join(FIXTURES, "survey_forecasts.csv")).read().splitlines()
    first, later = tmp_path / "first", tmp_path / "later"
    first.mkdir()
    later.mkdir()
    (first / "a.csv").write_text("\n".join(lines[:13]) + "\n")
    (later / "b.csv").write_text("\n".join([lines[0]] + lines[5:]) + "\n")
    return str(first / "a.csv"), str(later)


def paths(forecasts):
    return {
        "raw_forecasts_export": forecasts,
        "raw_forecaster_demographics": os.path.join(FIXTURES, "survey_forecasters.csv"),
        "raw_question_tags": os.path.join(FIXTURES, "survey_tags.csv"),
    }


def natural(spark, out):
    f = M.table(spark, out, "fct_forecasts")
    return sorted(tuple(r) for r in f.select(*NK).collect()), f


def test_batch_append_matches_full_build(spark, tmp_path, model):
    first, later = split_fixture(tmp_path)
    out = str(tmp_path / "model")
    M.build(spark, paths(first), out)
    before = M.table(spark, out, "fct_forecasts").agg(F.max("forecast_sk")).first()[0]
    new_raw = load_raw(spark, paths(later + "/b.csv"))["raw_forecasts_export"]
    n = append_forecasts(spark, new_raw, out)
    got, fact = natural(spark, out)
    full = model["fct_forecasts"]
    assert got == sorted(tuple(r) for r in full.select(*NK).collect())
    keys = sorted(r[0] for r in fact.select("forecast_sk").collect())
    assert keys == list(range(1, len(keys) + 1)) and n == len(keys) - before
    assert append_forecasts(spark, new_raw, out) == 0  # idempotent


def test_stream_matches_full_build(spark, tmp_path, model):
    first, later = split_fixture(tmp_path)
    out = str(tmp_path / "model")
    M.build(spark, paths(first), out)
    q = stream_forecasts(spark, later, out, str(tmp_path / "stream_ckpt"))
    q.awaitTermination(300)
    got, _ = natural(spark, out)
    assert got == sorted(tuple(r) for r in model["fct_forecasts"].select(*NK).collect())
    # a second extract with rows already loaded changes nothing
    shutil.copy(later + "/b.csv", later + "/c.csv")
    q2 = stream_forecasts(spark, later, out, str(tmp_path / "stream_ckpt"))
    q2.awaitTermination(300)
    again, _ = natural(spark, out)
    assert again == got


def test_append_registers_new_forecasters(spark, tmp_path, model):
    demo_lines = open(os.path.join(FIXTURES, "survey_forecasters.csv")).read().splitlines()
    without = tmp_path / "demo_without_f06.csv"
    without.write_text("\n".join(x for x in demo_lines if not x.startswith("F06")) + "\n")
    p = paths(os.path.join(FIXTURES, "survey_forecasts.csv"))
    p["raw_forecaster_demographics"] = str(without)
    out = str(tmp_path / "model")
    M.build(spark, p, out)
    raw = load_raw(spark, paths(os.path.join(FIXTURES, "survey_forecasts.csv")))
    n = append_forecasts(spark, raw["raw_forecasts_export"], out, raw["raw_forecaster_demographics"])
    assert n == 2  # F06's two forecasts
    dims = M.table(spark, out, "dim_forecasters")
    keys = {r["forecaster_id"]: r["forecaster_sk"] for r in dims.collect()}
    assert keys["F06"] == 7 and sorted(keys.values()) == list(range(1, 8))
    by_id = lambda f, d: sorted(
        tuple(r) for r in f.join(d.select("forecaster_sk", "forecaster_id"), "forecaster_sk")
        .select("forecaster_id", "forecast_timestamp", "prediction").collect())
    full = by_id(model["fct_forecasts"], model["dim_forecasters"])
    assert by_id(M.table(spark, out, "fct_forecasts"), dims) == full


HEAD = ["forecaster_id", "forecaster_name", "forecaster_type", "question_id", "question_text", "forecast_timestamp", "prediction", "rationale"]


def extract(spark, *rows):
    """Raw rows (forecaster, question, timestamp, prediction)."""
    columns = RAW_FORECASTS.names
    full = [dict(zip(HEAD, (f, "N", "expert", q, "text", t, p, "r"), strict=True)) for f, q, t, p in rows]
    return spark.createDataFrame([tuple(r[c] for c in columns) for r in full], RAW_FORECASTS)


def as_csv(spark, df, path):
    df.coalesce(1).write.option("header", True).option("escape", "\"").mode("append").csv(path)


def by_id(spark, out):
    fact, dims, questions = (M.table(spark, out, t) for t in ("fct_forecasts", "dim_forecasters", "dim_questions"))
    joined = fact.join(dims.select("forecaster_sk", "forecaster_id"), "forecaster_sk").join(questions, "question_sk")
    rows = joined.select("forecaster_id", "question_id", "forecast_timestamp", "prediction").collect()
    return sorted(map(str, map(tuple, rows)))


def rebuilt(spark, tmp_path, new, demographics=None):
    """A full build over the fixture's forecasts and the new ones."""
    folder = str(tmp_path / "all")
    p = paths(os.path.join(FIXTURES, "survey_forecasts.csv"))
    as_csv(spark, load_raw(spark, p)["raw_forecasts_export"], folder)
    as_csv(spark, new, folder)
    p["raw_forecasts_export"] = folder
    if demographics:
        p["raw_forecaster_demographics"] = demographics
    M.build(spark, p, str(tmp_path / "rebuilt"))
    return by_id(spark, str(tmp_path / "rebuilt"))


def test_late_extracts_reach_the_fact(spark, tmp_path):
    """Extracts arrive out of order, months late: as a full rebuild has them."""
    out, landing = str(tmp_path / "model"), str(tmp_path / "landing")
    M.build(spark, paths(os.path.join(FIXTURES, "survey_forecasts.csv")), out)
    days = ["2030-06-01 08:00:00", "2030-06-02 08:00:00", "2030-01-01 08:00:00", "2030-06-03 08:00:00"]
    batches = [extract(spark, ("F01", "Q1", t, "50")) for t in days]
    for batch in batches:
        as_csv(spark, batch, landing)
        stream_forecasts(spark, landing, out, str(tmp_path / "ckpt")).awaitTermination(300)
    new = batches[0]
    for batch in batches[1:]:
        new = new.unionByName(batch)
    assert by_id(spark, out) == rebuilt(spark, tmp_path, new)


def test_rows_without_a_time_are_kept_once(spark, tmp_path):
    out = str(tmp_path / "model")
    M.build(spark, paths(os.path.join(FIXTURES, "survey_forecasts.csv")), out)
    only = extract(spark, ("F02", "Q2", None, "40"))
    assert append_forecasts(spark, only, out) == 1
    both = extract(spark, ("F02", "Q2", None, "40"), ("F03", "Q1", "2031-02-03 00:00:00", "41"), ("F04", "Q1", None, "42"))
    assert append_forecasts(spark, both, out) == 2
    assert append_forecasts(spark, both, out) == 0
    assert by_id(spark, out) == rebuilt(spark, tmp_path, both)
    keys = sorted(r[0] for r in M.table(spark, out, "fct_forecasts").select("forecast_sk").collect())
    assert keys == list(range(1, len(keys) + 1))


def test_forecasts_of_people_registered_later(spark, tmp_path):
    """Parked until the person is registered, then loaded once."""
    out, landing = str(tmp_path / "model"), str(tmp_path / "landing")
    M.build(spark, paths(os.path.join(FIXTURES, "survey_forecasts.csv")), out)
    before = by_id(spark, out)
    new = extract(spark, ("F77", "Q1", "2030-01-01 00:00:00", "10"), ("F78", "Q9", "2030-01-02 00:00:00", "20"))
    as_csv(spark, new, landing)
    stream_forecasts(spark, landing, out, str(tmp_path / "ckpt")).awaitTermination(300)
    assert by_id(spark, out) == before
    people = open(os.path.join(FIXTURES, "survey_forecasters.csv")).read().splitlines()
    cells = people[1].split(",")
    cells[people[0].split(",").index("forecaster_id")] = "F77"
    joined = tmp_path / "people.csv"
    joined.write_text("\n".join([*people, ",".join(cells)]) + "\n")
    p = paths(os.path.join(FIXTURES, "survey_forecasts.csv")) | {"raw_forecaster_demographics": str(joined)}
    assert extend_forecasters(spark, load_raw(spark, p)["raw_forecaster_demographics"], out) == 1
    stream_forecasts(spark, landing, out, str(tmp_path / "ckpt")).awaitTermination(300)  # no new file
    expected = rebuilt(spark, tmp_path, new, str(joined))
    assert by_id(spark, out) == expected and len(expected) == len(before) + 1
    assert retry_pending(spark, out) == 0 and by_id(spark, out) == expected
    assert [r["forecaster_id"] for r in M.table(spark, out, "pending_forecasts").collect() if r["forecaster_id"] in ("F77", "F78")] == ["F78"]


def test_failed_build_leaves_the_old_model(spark, tmp_path, monkeypatch):
    import pytest

    out = str(tmp_path / "model")
    p = paths(os.path.join(FIXTURES, "survey_forecasts.csv"))
    M.build(spark, p, out)
    before = by_id(spark, out)
    monkeypatch.setattr(M, "fct_forecasts", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        M.build(spark, p, out)
    assert by_id(spark, out) == before
