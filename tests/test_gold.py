"""Gold layer on the fixture equals the marts computed directly."""

from augur.plans import derived, marts
from augur.plans.gold import TYPES, build_gold, gold_table, register_views
from augur.plans.model import build, mart_inputs


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_gold_equals_direct(spark, raw_paths, model, tmp_path):
    mdir, gdir = str(tmp_path / "model"), str(tmp_path / "gold")
    build(spark, raw_paths, mdir)
    counts = build_gold(spark, mdir, gdir)
    assert counts["latest_forecasts"] == 14 and counts["question_summary"] == 3
    fact, dims = mart_inputs(model)
    assert rows(gold_table(spark, gdir, "type_comparison")) == rows(marts.type_comparison(fact, dims))
    assert rows(gold_table(spark, gdir, "engagement")) == rows(marts.engagement(fact, dims))
    spread = gold_table(spark, gdir, "calibration_spread")
    assert "sf_stddev" in spread.columns and "public_avg" in spread.columns
    assert rows(spread) == rows(marts.calibration_spread(fact, dims, TYPES, "stddev"))
    k = gold_table(spark, gdir, "kpi_header").collect()[0]
    assert (k["questions"], k["forecasters"], k["submissions"], k["revisions"]) == (3, 6, 18, 3)
    hc = gold_table(spark, gdir, "hypothesis_check")
    assert hc.columns == ["sf_mean", "expert_mean", "public_mean", "sf_tighter"]
    assert rows(gold_table(spark, gdir, "revision_counts")) == rows(
        derived.revision_counts(marts.belief_revision(fact, dims)))

    names = register_views(spark, mdir, gdir)
    assert "fct_forecasts" in names and "question_summary" in names
    assert spark.sql("select count(*) from fct_forecasts").first()[0] == 18
    assert spark.sql("select sum(total_submissions) from engagement").first()[0] == 18
