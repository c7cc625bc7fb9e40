"""Mart goldens on the fixture, computed independently with pandas."""

import os
from decimal import ROUND_HALF_UP, Decimal

import pandas as pd
import pytest
from pyspark.sql import functions as F

from augur.plans import derived, marts
from augur.plans.model import mart_inputs
from conftest import FIXTURES

TYPES = [("sf", "superforecaster"), ("ex", "expert"), ("pub", "public")]


def r1(x):
    if x is None or pd.isna(x):
        return None
    return float(Decimal(repr(float(x))).quantize(Decimal("0.1"), rounding=ROUND_HALF_UP))


@pytest.fixture(scope="module")
def pdfact():
    f = pd.read_csv(os.path.join(FIXTURES, "survey_forecasts.csv"), dtype=str, keep_default_na=False)
    d = pd.read_csv(os.path.join(FIXTURES, "survey_forecasters.csv"), dtype=str, keep_default_na=False)
    f = f.sort_values("prediction").drop_duplicates(["forecaster_id", "question_id", "forecast_timestamp"])
    f = f[f.forecaster_id.isin(d.forecaster_id)].copy()
    f["prediction"] = f.prediction.astype(int)
    return f


@pytest.fixture(scope="module")
def inputs(model):
    return mart_inputs(model)


@pytest.fixture(scope="module")
def ids(model):
    """surrogate forecaster key -> natural id"""
    return {r["forecaster_sk"]: r["forecaster_id"] for r in model["dim_forecasters"].collect()}


def as_dict(df, key, ids=None):
    out = {}
    for r in df.collect():
        k = r[key]
        out[ids[k] if ids else k] = r.asDict()
    return out


def pair(r, ids):
    return (ids[r["forecaster_sk"]], r["question_id"])


def test_question_summary(inputs, pdfact):
    fact, _ = inputs
    got = as_dict(marts.question_summary(fact), "question_id")
    for q, g in pdfact.groupby("question_id"):
        p = g.prediction
        exp = {
            "forecaster_count": g.forecaster_id.nunique(),
            "median_prediction": r1(p.median()),
            "mean_prediction": r1(p.mean()),
            "stddev_prediction": r1(p.std(ddof=1)),
            "min_prediction": p.min(),
            "max_prediction": p.max(),
        }
        assert {k: got[q][k] for k in exp} == exp, q
    assert len(got) == 3


def latest(pdfact):
    return pdfact.sort_values("forecast_timestamp").groupby(["forecaster_id", "question_id"]).tail(1)


def test_type_comparison(inputs, pdfact):
    fact, dims = inputs
    got = as_dict(marts.type_comparison(fact, dims), "forecaster_type")
    lat = latest(pdfact)
    for t, g in lat.groupby("forecaster_type"):
        p = g.prediction
        assert got[t]["forecaster_count"] == g.forecaster_id.nunique()
        assert got[t]["total_forecasts"] == len(g)
        assert got[t]["avg_prediction"] == r1(p.mean())
        assert got[t]["median_prediction"] == r1(p.median())
        assert got[t]["prediction_stddev"] == r1(p.std(ddof=1))


def test_belief_revision_literal_and_chrono(inputs, pdfact, ids):
    fact, dims = inputs
    lit = {pair(r, ids): r for r in marts.belief_revision(fact, dims).collect()}
    chrono = {pair(r, ids): r for r in marts.belief_revision_chrono(fact, dims).collect()}
    s = pdfact.sort_values("forecast_timestamp")
    exp_pairs = {k for k, g in s.groupby(["forecaster_id", "question_id"]) if len(g) > 1}
    assert set(lit) == exp_pairs == set(chrono) == {("F01", "Q1"), ("F02", "Q1"), ("F05", "Q1")}
    # literal: first is MIN, so the downward revision reads "no change"
    assert (lit[("F05", "Q1")]["net_revision"], lit[("F05", "Q1")]["revision_direction"]) == (0, "no change")
    assert chrono[("F05", "Q1")]["net_revision"] == -5
    assert chrono[("F05", "Q1")]["revision_direction"] == "revised down"
    # 28 -> 26 -> 27
    assert (lit[("F02", "Q1")]["first_prediction"], lit[("F02", "Q1")]["last_prediction"]) == (26, 27)
    assert (chrono[("F02", "Q1")]["first_prediction"], chrono[("F02", "Q1")]["net_revision"]) == (28, -1)
    assert lit[("F02", "Q1")]["total_submissions"] == 3
    assert (chrono[("F02", "Q1")]["forecaster_id"], chrono[("F02", "Q1")]["forecaster_type"]) == ("F02", lit[("F02", "Q1")]["forecaster_type"])
    assert lit[("F01", "Q1")]["revision_direction"] == "revised up"
    counts = derived.revision_counts(marts.belief_revision(fact, dims)).collect()[0]
    assert (counts["up"], counts["down"], counts["max_abs"]) == (2, 0, 5)


def test_calibration_spread_and_long(inputs, pdfact):
    fact, dims = inputs
    got = as_dict(marts.calibration_spread(fact, dims, TYPES), "question_id")
    lat = latest(pdfact)
    for q, g in lat.groupby("question_id"):
        for prefix, t in TYPES:
            p = g[g.forecaster_type == t].prediction
            assert got[q][f"{prefix}_avg"] == (r1(p.mean()) if len(p) else None)
            assert got[q][f"{prefix}_sd"] == (r1(p.std(ddof=1)) if len(p) > 1 else None)
    # one-forecast group: stddev NULL
    assert got["Q3"]["sf_sd"] is None
    long_ = {(r["question_id"], r["forecaster_type"]): r for r in
             marts.calibration_long(fact, dims, [t for _, t in TYPES]).collect()}
    for q in got:
        for prefix, t in TYPES:
            if got[q][f"{prefix}_avg"] is not None:
                assert long_[(q, t)]["avg"] == got[q][f"{prefix}_avg"]
                assert long_[(q, t)]["stddev"] == got[q][f"{prefix}_sd"]
    unp = {(r["question_id"], r["forecaster_type"]): r for r in marts.calibration_unpivot(
        marts.calibration_spread(fact, dims, TYPES), TYPES).collect()}
    assert len(unp) == 9 and unp[("Q1", "expert")]["avg"] == got["Q1"]["ex_avg"]


def test_engagement(inputs, pdfact, ids):
    fact, dims = inputs
    got = as_dict(marts.engagement(fact, dims), "forecaster_sk", ids)
    assert set(got) == {"F01", "F02", "F03", "F04", "F05", "F06"}
    for fid, g in pdfact.groupby("forecaster_id"):
        p = g.prediction
        assert got[fid]["questions_covered"] == g.question_id.nunique()
        assert got[fid]["total_submissions"] == len(g)
        assert got[fid]["avg_prediction"] == r1(p.mean())
        assert (got[fid]["min_prediction"], got[fid]["max_prediction"]) == (p.min(), p.max())
    assert got["F02"]["years"] == 12
    assert {"education_level", "country"} <= set(got["F02"]) and got["F02"]["country"]


def test_derived(inputs, pdfact, ids):
    fact, dims = inputs
    qs = marts.question_summary(fact)
    eng = marts.engagement(fact, dims)
    rev = marts.belief_revision(fact, dims)
    k = derived.kpi_header(qs, eng, rev).collect()[0]
    meds = [r1(g.prediction.median()) for _, g in pdfact.groupby("question_id")]
    assert (k["questions"], k["forecasters"], k["submissions"], k["revisions"]) == (3, 6, 18, 3)
    assert k["mean_of_medians"] == r1(sum(meds) / len(meds))
    top = derived.top_forecaster(eng).collect()
    assert [(ids[r["forecaster_sk"]], r["total_submissions"]) for r in top] == [("F01", 4)]  # tie with F02 broken by id
    ext = derived.question_extremes(qs).collect()[0]
    assert ext["spread"] == max(meds) - min(meds)
    gaps = {r["question_id"]: r for r in derived.coverage_gaps(fact, dims).collect()}
    assert gaps["Q1"]["covered"] == 5 and gaps["Q1"]["active"] == 6 and gaps["Q1"]["registered"] == 7
    assert gaps["Q1"]["missing_active"] == 1 and gaps["Q1"]["missing_registered"] == 2
    assert gaps["Q1"]["has_gap"] is True
    lab = {pair(r, ids): r for r in derived.revision_label(rev).collect()}
    assert lab[("F01", "Q1")]["label"] == "Ada / Q1" and lab[("F01", "Q1")]["txt"] == "+5 pts"
    assert lab[("F05", "Q1")]["txt"] == "no change"
    ql = {r["question_id"]: r["label"] for r in derived.question_label(qs).collect()}
    assert ql["Q1"] == "Q1  Will global temperature rise > 1.5C by 2030?..."
    hc = derived.hypothesis_check(marts.calibration_spread(fact, dims, TYPES), ("sf", "ex", "pub"), ("sf", "pub"))
    assert hc.columns == ["sf_mean", "ex_mean", "pub_mean", "sf_tighter"]
    exp = derived.experience_vs_avg(eng)
    assert exp.count() == 6 and "Ada" in {r["label"] for r in exp.collect()}
    pp = derived.presentation_projection(qs)
    assert pp.columns == ["ID", "Question", "Forecasters", "Median %", "Mean %", "Std Dev", "Min %", "Max %"]
    profiles = derived.display(eng, derived.PROFILE_TABLE)
    assert profiles.columns == ["Name", "Type", "Exp (yrs)", "Education", "Country", "Questions", "Submissions", "Avg %"]
    assert derived.display(rev, derived.REVISION_TABLE).columns[-1] == "Submissions"
    assert derived.display(marts.type_comparison(fact, dims), derived.TYPE_TABLE).count() == 3
    table = derived.calibration_table(marts.calibration_spread(fact, dims, TYPES), {"sf": "SF", "ex": "Expert", "pub": "Public"})
    assert table.columns == ["Question", "SF Avg", "SF \u03c3", "Expert Avg", "Expert \u03c3", "Public Avg", "Public \u03c3"]
    best = top[0]
    assert best["forecaster_name"].startswith("Ada") and best["questions_covered"] >= 1 and best["forecaster_type"]
    sl = marts.type_slice(fact, dims, "expert").collect()[0]
    assert (sl["label"], sl["n"]) == ("Expert", 5)


def test_numbered_form_equals_aggregate_form(inputs):
    fact, dims = inputs
    a = marts.belief_revision(fact, dims)
    b = marts.numbered_revision(fact, dims)
    assert a.columns == b.columns
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_orderings(inputs):
    fact, dims = inputs
    qs = [r["question_id"] for r in derived.ordered_summary(marts.question_summary(fact)).collect()]
    assert qs == ["Q1", "Q2", "Q3"]
    eng = [r["total_submissions"] for r in derived.ordered_engagement(marts.engagement(fact, dims)).collect()]
    assert eng == sorted(eng, reverse=True)
    rev = [abs(r["net_revision"]) for r in derived.ordered_revisions(marts.belief_revision(fact, dims)).collect()]
    assert rev == sorted(rev, reverse=True)
    up = [r["net_revision"] for r in derived.ascending(marts.belief_revision(fact, dims), "net_revision", "question_id").collect()]
    assert up == sorted(up)


def test_marts_from_the_pair_table_equal_those_from_the_fact(inputs):
    fact, dims = inputs
    pairs = marts.pair_table(fact).cache()
    for mart in (marts.type_comparison, marts.type_counts, marts.belief_revision, marts.belief_revision_chrono, marts.engagement):
        assert sorted(map(repr, mart(fact, dims).collect())) == sorted(map(repr, mart(pairs, dims).collect()))
    cells, texts = marts.question_cells(fact).cache(), fact.select("question_id", "question_text").distinct()
    assert sorted(map(repr, marts.question_summary(fact).collect())) == sorted(map(repr, marts.question_summary(cells, questions=texts).collect()))
    assert sorted(map(repr, derived.coverage_gaps(fact, dims).collect())) == sorted(map(repr, derived.coverage_gaps(cells, dims).collect()))
    assert marts.pair_table(pairs) is pairs and marts.question_cells(cells) is cells


def test_states_of_parts_merge_to_the_state_of_the_whole(inputs, spark):
    fact, _ = inputs
    parts = [fact.where(f"abs(hash(forecaster_sk, question_id, forecast_timestamp)) % 3 = {k}") for k in range(3)]
    whole = lambda df: sorted(map(repr, df.collect()))
    a, b, c = (marts.pair_table(p) for p in parts)
    assert whole(marts.merge_pairs(a.union(b).union(c))) == whole(marts.pair_table(fact))
    a, b, c = (marts.question_cells(p) for p in parts)
    assert whole(marts.merge_cells(a.union(b).union(c), ["question_id"])) == whole(marts.question_cells(fact))


def test_bitmap_counts_equal_count_distinct(spark):
    """Keys on both sides of zero, at word limits, NULL and repeated; a third of all rows in one key."""
    keys = [None, 0, 1, 63, 64, 65, -1, -64, -65, 2**40, 2**40 + 1, 7, 7]
    rows = [(f"q{i % 3}", k, i % 5 if i % 4 else None) for i in range(300) for k in keys[: 1 + i % len(keys)]] + [("q9", 5, 1)] * 900
    df = spark.createDataFrame(rows, "q string, m long, v int").repartition(6)
    got = {r["q"]: r for r in marts.profile(marts.profile_cells(df, ["q"], "v", "m"), ["q"]).collect()}
    exp = df.groupBy("q").agg(F.count_distinct("m").alias("m"), F.count("*").alias("n"), F.median("v").alias("med"), F.stddev("v").alias("sd"))
    for r in exp.collect():
        g = got[r["q"]]
        assert (g["members"], g["rows"], g["median"]) == (r["m"], r["n"], r["med"])
        assert g["stddev"] == pytest.approx(r["sd"])


def test_ties_on_time_are_settled_by_the_prediction(spark):
    rows = [(1, "q", 10, 5), (1, "q", 40, 5), (1, "q", 20, 9), (1, "q", 70, 9), (1, "q", 30, 9), (2, "q", None, 3), (2, "q", -4, 3)]
    fact = spark.createDataFrame(rows, "forecaster_sk int, question_id string, prediction int, forecast_timestamp int").repartition(4)
    got = {r["forecaster_sk"]: r for r in marts.pair_table(fact).collect()}
    assert (got[1]["first_prediction"], got[1]["last_prediction"]) == (10, 70)
    assert (got[2]["first_prediction"], got[2]["last_prediction"], got[2]["n"], got[2]["n_predicted"]) == (None, -4, 2, 1)


def test_profile_with_nulls(spark):
    """NULL predictions count as submissions, not in the statistics."""
    rows = [("q", "Q", 1, None), ("q", "Q", 2, 10), ("q", "Q", 2, 20), ("z", "Z", 1, None)]
    fact = spark.createDataFrame([(f, q, t, p, i) for i, (q, t, f, p) in enumerate(rows)], "forecaster_sk int, question_id string, question_text string, prediction int, forecast_timestamp int")
    got = as_dict(marts.question_summary(fact), "question_id")
    assert (got["q"]["forecaster_count"], got["q"]["median_prediction"], got["q"]["stddev_prediction"]) == (2, 15.0, 7.1)
    assert got["z"]["forecaster_count"] == 1 and got["z"]["median_prediction"] is None and got["z"]["stddev_prediction"] is None


def test_question_summary_approximate(inputs, pdfact):
    fact, _ = inputs
    exact = as_dict(marts.question_summary(fact), "question_id")
    approx = as_dict(marts.question_summary(fact, approximate=True), "question_id")
    assert approx.keys() == exact.keys()
    for q, g in pdfact.groupby("question_id"):
        p = sorted(g.prediction)
        lo, hi = p[(len(p) - 1) // 2], p[len(p) // 2]
        assert approx[q]["forecaster_count"] == exact[q]["forecaster_count"]
        assert lo <= approx[q]["median_prediction"] <= hi
        assert approx[q]["mean_prediction"] == exact[q]["mean_prediction"]


def test_missing_pairs_name_who_a_question_lacks(inputs, pdfact, ids, spark):
    fact, dims = inputs
    have = set(zip(pdfact.question_id, pdfact.forecaster_id, strict=True))
    asked, active, registered = set(pdfact.question_id), set(pdfact.forecaster_id), set(ids.values())
    for everyone, flag in ((active, False), (registered, True)):
        got = {(r["question_id"], ids[r["forecaster_sk"]]) for r in derived.missing_pairs(fact, dims, registered=flag).collect()}
        assert got == {(q, f) for q in asked for f in everyone} - have
    # words on both sides of zero and their limits
    keys = [-65, -64, -1, 0, 62, 63, 64, 2**40]
    fact = spark.createDataFrame([(k, q, 1, i) for i, k in enumerate(keys) for q in ("a", "b")[: 1 + i % 2]], "forecaster_sk long, question_id string, prediction int, forecast_timestamp int")
    who = spark.createDataFrame([(k, str(k)) for k in keys], "forecaster_sk long, forecaster_name string")
    got = {(r["question_id"], r["forecaster_sk"]) for r in derived.missing_pairs(fact, who).collect()}
    assert got == {("b", k) for i, k in enumerate(keys) if not i % 2}


def test_types_by_average(inputs):
    fact, dims = inputs
    avg = [r["avg_prediction"] for r in derived.ordered_types(marts.type_comparison(fact, dims)).collect()]
    assert avg == sorted(avg, reverse=True) and len(avg) == 3
