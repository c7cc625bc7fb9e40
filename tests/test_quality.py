"""Every defect class of the fixture is found by its detector (Q1-Q10)."""

from pyspark.sql import functions as F

from augur.functions.clean import parse_mixed_dates
from augur.plans import quality as Q


def test_exact_duplicates(raw):
    f = raw["raw_forecasts_export"]
    dups = Q.exact_duplicates(f, f.columns).collect()
    assert [(r["forecaster_id"], r["question_id"], r["copies"]) for r in dups] == [("F03", "Q3", 2)]


def test_conflicting_duplicates(raw):
    f = raw["raw_forecasts_export"]
    c = Q.conflicting_duplicates(f, ["forecaster_id", "question_id", "forecast_timestamp"]).collect()
    assert [(r["forecaster_id"], r["question_id"], r["copies"], r["versions"]) for r in c] == [
        ("F04", "Q2", 2, 2)
    ]


def test_blank_or_null(raw):
    f = raw["raw_forecasts_export"]
    r = Q.blank_or_null_counts(f, "rationale").collect()[0]
    # "" and an empty cell load as NULL; "   " is a blank string
    assert (r["nulls"], r["blanks"], r["n"]) == (2, 1, 21)
    prof = {x["column"]: x for x in Q.blank_or_null_profile(
        raw["raw_forecaster_demographics"], ["education_level", "affiliation", "country"]).collect()}
    assert prof["education_level"]["nulls"] == 1 and prof["affiliation"]["nulls"] == 1
    assert prof["country"]["nulls"] == 0 and prof["country"]["n"] == 7


def test_date_formats(raw):
    d = raw["raw_forecaster_demographics"]
    assert Q.date_format_issues(d, "joined_date").collect()[0]["bad"] == 1
    assert d.select(parse_mixed_dates("joined_date").alias("d")).where("d is null").count() == 0


def test_vocab(raw):
    d = raw["raw_forecaster_demographics"]
    v = Q.vocab_violations(d, "education_level", ["PhD", "Masters", "Bachelors"]).collect()
    assert [(r["education_level"], r["n"]) for r in v] == [("Bachelor", 1)]


def test_orphans(raw):
    o = Q.orphans(raw["raw_forecaster_demographics"], raw["raw_forecasts_export"], "forecaster_id", "forecaster_id")
    assert [r["forecaster_id"] for r in o.collect()] == ["F09"]
    # and the reverse direction: forecasts by someone not registered
    u = Q.orphans(raw["raw_forecasts_export"].select("forecaster_id").distinct(),
                  raw["raw_forecaster_demographics"], "forecaster_id", "forecaster_id")
    assert [r["forecaster_id"] for r in u.collect()] == ["FX"]


def test_case_variants_and_pairs(raw):
    t = raw["raw_question_tags"]
    cv = {r["k"]: r["variants"] for r in Q.case_variants(t, "tag").collect()}
    assert cv == {"climate": 2, "energy": 2, "transport": 2}
    dp = sorted((r["question_id"], r["k"], r["copies"]) for r in Q.duplicate_pairs(t, "question_id", "tag").collect())
    assert dp == [("Q1", "climate", 2), ("Q3", "transport", 2)]


def test_reconciliation_and_register(raw, model):
    f = raw["raw_forecasts_export"]
    rec = Q.reconciliation(f, F.count_distinct("forecaster_id", "question_id", "forecast_timestamp")).collect()[0]
    assert (rec["raw_rows"], rec["clean_rows"], rec["delta"]) == (21, 19, -2)
    reg = Q.issue_register([
        Q.issue(Q.exact_duplicates(f, f.columns), F.sum(F.col("copies") - 1), "high", "forecasts", "*",
                "exact duplicate rows", "dedup"),
        Q.issue(Q.orphans(raw["raw_forecaster_demographics"], f, "forecaster_id", "forecaster_id"),
                F.count(F.lit(1)), "low", "demographics", "forecaster_id", "never active", "flag"),
    ]).collect()
    assert [(r["severity"], r["affected"]) for r in reg] == [("high", 1), ("low", 1)]


def test_issue_reports_zero_when_nothing_found(raw):
    t = raw["raw_question_tags"]
    none = Q.exact_duplicates(t.where("question_id = 'nope'"), t.columns)
    r = Q.issue(none, F.sum(F.col("copies") - 1), "high", "tags", "*", "dups", "dedup").collect()[0]
    assert r["affected"] == 0


def test_model_reconciliation(raw, model):
    r = Q.model_reconciliation(raw["raw_forecasts_export"], model["fct_forecasts"],
                               raw["raw_question_tags"], model["bridge_question_tags"]).collect()[0]
    assert tuple(r) == (21, 18, -3, 8, 6, -2)
