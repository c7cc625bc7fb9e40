"""Random facts: the aggregate forms of the marts equal the literal window
forms (ties in predictions, NULL predictions, one-row groups)."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from augur.plans import marts

ROW = st.tuples(
    st.integers(1, 4),                       # forecaster
    st.sampled_from(["a", "b", "c"]),        # question
    st.one_of(st.none(), st.integers(0, 5)),  # prediction with ties and NULLs
)


def frame(spark, rows):
    base = dt.datetime(2024, 1, 1)
    data = [(f, q, q.upper(), p, base + dt.timedelta(minutes=i)) for i, (f, q, p) in enumerate(rows)]
    fact = spark.createDataFrame(
        data, "forecaster_sk long, question_id string, question_text string, prediction int, "
        "forecast_timestamp timestamp_ntz")
    dims = spark.createDataFrame(
        [(i, f"Name{i} X", "t1" if i % 2 else "t2", i) for i in range(1, 5)],
        "forecaster_sk long, forecaster_name string, forecaster_type string, years int")
    return fact, dims


@settings(max_examples=6, deadline=None)
@given(st.lists(ROW, min_size=1, max_size=30))
def test_revision_forms_agree(spark, rows):
    fact, dims = frame(spark, rows)
    a = sorted(map(tuple, marts.belief_revision(fact, dims).collect()), key=repr)
    b = sorted(map(tuple, marts.numbered_revision(fact, dims).collect()), key=repr)
    assert a == b


@settings(max_examples=6, deadline=None)
@given(st.lists(ROW, min_size=1, max_size=30))
def test_latest_equals_row_number(spark, rows):
    fact, _ = frame(spark, rows)
    w = Window.partitionBy("forecaster_sk", "question_id").orderBy(F.col("forecast_timestamp").desc())
    exp = fact.withColumn("rn", F.row_number().over(w)).where("rn = 1").select(
        "forecaster_sk", "question_id", "prediction")
    got = marts.latest_forecasts(fact).select("forecaster_sk", "question_id", "prediction")
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, exp.collect()), key=repr)
