"""Plan-shape tests: what must (not) appear in the physical plans."""

import re

import pytest

from augur.plans.catalog import QUERIES
from conftest import SF_SMALL

FACT_PATH = [
    "question_summary", "type_comparison", "belief_revision", "belief_revision_chrono",
    "calibration_spread", "engagement", "latest_forecast", "update_sequence", "fct_build",
]


def final_plan(df):
    df.collect()  # runs the adaptive plan to its final form
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", FACT_PATH)
def test_no_single_partition_on_fact_path(spark, name):
    plan = final_plan(QUERIES[name](spark, SF_SMALL))
    # the only allowed single-partition exchange feeds the offset window of
    # dense keys: its input is one count per written range file
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            below = next(x for x in lines[i + 1:] if "HashAggregate" in x)
            assert "output=[_part#" in below and "_n#" in below, (name, below)


def final_lines(plan):
    import os
    import sys

    sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
    from plan_report import final_lines as lines

    return lines(plan)


@pytest.mark.parametrize(
    "name", ["question_summary", "type_comparison", "belief_revision", "belief_revision_chrono", "calibration_spread", "engagement", "calibration_long"]
)
def test_marts_read_the_fact_once(spark, name):
    lines = final_lines(final_plan(QUERIES[name](spark, SF_SMALL)))
    assert sum("FileScan parquet" in x and "user_id" in x for x in lines) == 1


def test_kpi_header_reads_written_pairs(spark):
    plan = final_plan(QUERIES["kpi_header"](spark, SF_SMALL))
    assert "FileScan" in plan and "event_type" not in plan


def test_no_sort_aggregate_on_raw_rows(spark):
    """MAX and MIN over text are planned as sorts: they may only see rows
    that a hash aggregate has reduced."""
    from augur.operators.dedup import reduced
    from augur.plans import model
    from augur.sources.tables import raw_demographics, raw_forecasts

    raw = raw_forecasts(spark, SF_SMALL)
    for df in (model.dedup_forecasts(raw), reduced(raw, "question_id", "question_text").groupBy("question_id").agg({"question_text": "max"})):
        lines = final_lines(final_plan(df))
        for i, line in enumerate(lines):
            if "SortAggregate" in line and "partial_" in line:
                below = "".join(lines[i:])
                # or rows of shared keys, from the distinct rows written before
                assert "HashAggregate" in below or "LeftSemi" in below, below
    assert raw_demographics(spark, SF_SMALL).columns[0] == "forecaster_id"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_udfs(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF"):
        assert node not in plan, (name, node)


@pytest.mark.parametrize(
    ("name", "exchanges"),
    [("question_summary", 2), ("type_comparison", 3), ("belief_revision", 1), ("calibration_spread", 4), ("engagement", 2), ("latest_forecast", 1)],
)
def test_marts_shuffle_no_more_than_their_grains(spark, name, exchanges):
    """One shuffle a grain (pairs, cells, keys); the dimension is broadcast here. No texts in a key."""
    lines = final_lines(final_plan(QUERIES[name](spark, SF_SMALL)))
    shuffled = [x for x in lines if re.search(r"\bExchange hashpartitioning", x)]
    assert len(shuffled) <= exchanges, shuffled
    assert not any("question_text" in x for x in shuffled)


def test_latest_is_partial_aggregate_not_window(spark):
    plan = final_plan(QUERIES["latest_forecast"](spark, SF_SMALL))
    assert "partial_max_by" in plan and "Window" not in plan


def test_type_filter_pushed_to_scan(spark):
    plan = QUERIES["type_slice"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(c_mktsegment,BUILDING\)", plan), plan


def test_column_pruning(spark):
    plan = QUERIES["question_summary"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert "user_id:bigint,event_type:string,value:double" in schemas
    assert all("props" not in s for s in schemas)


def test_engagement_aggregates_before_join(spark):
    plan = final_plan(QUERIES["engagement"](spark, SF_SMALL))
    join_pos = plan.find("HashJoin")
    agg_pos = plan.find("partial_count", join_pos)
    assert join_pos != -1 and agg_pos > join_pos  # partial aggregate sits below the join
