"""Operator properties on generated inputs, including a hot key holding a
third of all rows (SURVEY §5 invariants and property tests)."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from augur.functions import clean, labels
from augur.operators.keys import dense_key
from augur.operators.latest import latest_by
from augur.operators.reshape import conditional_aggs, wide_to_long
from augur.operators.sequence import sequence_number


@pytest.fixture(scope="module")
def skewed(spark):
    rnd = random.Random(11)
    rows = []
    for i in range(3000):
        g = 0 if i % 3 == 0 else rnd.randint(1, 40)  # group 0 holds a third of the rows
        rows.append((g, rnd.randint(1, 3), i * 7 % 3001, rnd.randint(0, 100)))
    return spark.createDataFrame(rows, "g long, h int, t long, v int")


def test_dense_key_matches_row_number(spark, skewed):
    got = dense_key(skewed, ["g", "h", "t"], "k", num_partitions=5)
    whole = Window.orderBy("g", "h", "t")  # the literal form: one task numbers all rows
    exp = skewed.withColumn("k", F.row_number().over(whole).cast("bigint"))
    cols = ["g", "h", "t", "v", "k"]
    assert sorted(got.select(cols).collect()) == sorted(exp.select(cols).collect())
    ks = [r["k"] for r in got.select("k").collect()]
    assert sorted(ks) == list(range(1, 3001))


def test_sequence_split_equals_window(skewed):
    a = sequence_number(skewed, ["g", "h"], ["t"], "n", method="split")
    b = sequence_number(skewed, ["g", "h"], ["t"], "n", method="window")
    cols = ["g", "h", "t", "n"]
    assert sorted(a.select(cols).collect()) == sorted(b.select(cols).collect())


def test_latest_equals_window_form(skewed):
    w = Window.partitionBy("g", "h").orderBy(F.col("t").desc())
    exp = skewed.withColumn("rn", F.row_number().over(w)).where("rn = 1").select("g", "h", "v")
    assert sorted(latest_by(skewed, ["g", "h"], "t", ["v"]).collect()) == sorted(exp.collect())


def test_reshape_roundtrip(skewed):
    cats = [("a", 1), ("b", 2), ("c", 3)]
    metrics = [("sum", F.sum), ("max", F.max)]
    wide = skewed.groupBy("g").agg(*conditional_aggs("h", cats, metrics, "v"))
    long_ = wide_to_long(wide, ["g"], cats, ["sum", "max"], "h")
    exp = skewed.groupBy("g", "h").agg(F.sum("v").alias("sum"), F.max("v").alias("max"))
    got = long_.where("sum is not null").select("g", "h", "sum", "max")
    assert sorted(got.collect()) == sorted(exp.collect())


@settings(max_examples=15, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet=" aB\t", max_size=4)), min_size=1, max_size=8))
def test_blank_to_null_property(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    got = [r[0] for r in df.select(clean.blank_to_null("s")).collect()]
    exp = []
    for v in values:
        t = None if v is None else v.strip(" ")
        exp.append(None if t is None or t == "" else t)
    assert got == exp


def test_scalar_helpers(spark):
    df = spark.createDataFrame(
        [("Bachelor", "2023-01-05", 5, "Ada Lovelace"), (" PhD ", "March 15, 2023", -3, "Alan"), (None, "2023/01/05", 0, " x y"),
         ("", "2023", 1, "Ada\tL"), ("q", "2023-03", 1, "  "), ("q", "2023-03-05 10:00:00", 1, "\t \nb")],
        "e string, d string, n int, name string",
    )
    out = df.select(
        clean.normalize_vocab("e", {"Bachelor": "Bachelors"}).alias("e"),
        clean.parse_mixed_dates("d").cast("string").alias("d"),
        labels.signed_points(F.col("n")).alias("p"),
        labels.first_word(F.col("name")).alias("w"),
        clean.is_complete("e").alias("c"),
        clean.unparsable_iso_date("d").alias("bad"),
    ).collect()
    assert [tuple(r) for r in out] == [
        ("Bachelors", "2023-01-05", "+5 pts", "Ada", True, False),
        ("PhD", "2023-03-15", "-3 pts", "Alan", True, True),
        (None, "2023-01-05", "no change", "x", False, False),
        ("", None, "+1 pts", "Ada", False, True),
        ("q", None, "+1 pts", "", True, True),
        ("q", "2023-03-05", "+1 pts", "b", True, False),
    ]


def test_keys_are_dense_whatever_the_file_limit(spark, skewed):
    """A limit on records per file splits other writes, not the ranges."""
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "100")
    try:
        keys = [r["k"] for r in dense_key(skewed, ["g", "h", "t"], "k", num_partitions=4).select("k").collect()]
        a = sequence_number(skewed, ["g", "h"], ["t"], "n", num_partitions=4).select("g", "h", "t", "n").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    assert sorted(keys) == list(range(1, 3001))
    assert sorted(a) == sorted(sequence_number(skewed, ["g", "h"], ["t"], "n", method="window").select("g", "h", "t", "n").collect())


def test_sequence_keeps_null_groups(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 1), ("a", 3)], "g string, t int")
    a = sequence_number(df, ["g"], ["t"], "n", method="split")
    b = sequence_number(df, ["g"], ["t"], "n", method="window")
    key = lambda r: (r["g"] or "", r["t"])
    assert sorted(a.collect(), key=key) == sorted(b.collect(), key=key)
    assert a.count() == 4


def test_dense_key_splits_a_hot_leading_key(spark, tmp_path):
    """A third of the rows share the leading ordering column; the range files
    still come out balanced because the full ordering is total."""
    rows = [(0 if i % 3 == 0 else i, i) for i in range(6000)]
    df = spark.createDataFrame(rows, "g long, t long")
    path = str(tmp_path / "ranges")
    dense_key(df, ["g", "t"], "k", num_partitions=6, path=path)
    sizes = [r["n"] for r in spark.read.parquet(path).groupBy(F.col("_metadata.file_name")).agg(
        F.count(F.lit(1)).alias("n")).collect()]
    assert sum(sizes) == 6000 and len(sizes) >= 5
    assert max(sizes) < 2000  # the hot key alone is 2000 rows: it was split


def test_hot_group_is_numbered_over_many_ranges(spark):
    """One group fills several ranges: no window partition holds it whole and
    the numbers run on from range to range."""
    rows = [("hot", i) for i in range(2000)] + [(f"g{i % 7}", i) for i in range(500)] + [(None, 3), (None, 4)]
    df = spark.createDataFrame(rows, "g string, t long")
    split = sequence_number(df, ["g"], ["t"], "n", num_partitions=9)
    key = lambda r: (r["g"] is None, r["g"] or "", r["t"])
    exp = sequence_number(df, ["g"], ["t"], "n", method="window")
    assert sorted(split.collect(), key=key) == sorted(exp.collect(), key=key)
    plan = split._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "_part" in plan


@pytest.fixture(scope="module")
def wide(spark):
    """Wide and narrow domains, ties at the middle, NULLs, a NULL key, a hot group."""
    rnd = random.Random(5)
    rows = []
    for i in range(4000):
        g = "hot" if i % 3 == 0 else f"g{rnd.randint(1, 30)}"
        v = None if i % 97 == 0 else rnd.random() * 1e6 if i % 2 else float(rnd.randint(0, 50))
        rows.append((g, v))
    rows += [("all_null", None), ("one", 7.0), (None, 1.0), (None, 4.0)]
    rows += [("ties", 5.0)] * 500 + [("ties", 1e300)] * 300 + [("ties", -1e300)] * 100
    rows += [("two", 1.0)] * 50 + [("two", 2.0)] * 50 + [("far", 10.0**k) for k in range(-300, 300)]
    return spark.createDataFrame(rows, "g string, v double").repartition(5).cache()


@pytest.mark.parametrize("how", ["select", "few passes", "ranked"])
def test_exact_median_matches_percentile_on_wide_domain(wide, how):
    from augur.operators.median import exact_median

    options = {"select": {"enough": 10, "accuracy": 100}, "few passes": {}, "ranked": {"max_groups": 0}}[how]
    got = {r["g"]: r["median"] for r in exact_median(wide, ["g"], "v", **options).collect()}
    exp = {r["g"]: r["m"] for r in wide.groupBy("g").agg(F.median("v").alias("m")).collect()}
    assert set(got) == set(exp)
    for k in exp:
        assert (got[k] is None and exp[k] is None) or abs(got[k] - exp[k]) < 1e-9 * max(1.0, abs(exp[k])), k


def test_median_selection_moves_counts_not_rows(spark, tmp_path):
    from augur.operators.median import exact_median

    df = spark.range(200_000).select((F.col("id") % 2).alias("g"), F.rand(3).alias("v"))
    path = str(tmp_path / "rows")
    df.write.parquet(path)
    df = spark.read.parquet(path)
    found = exact_median(df, ["g"], "v", enough=500)
    exp = {r["g"]: r["m"] for r in df.groupBy("g").agg(F.median("v").alias("m")).collect()}
    assert {r["g"]: r["median"] for r in found.collect()} == pytest.approx(exp)
    lines = found._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in lines
