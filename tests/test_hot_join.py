"""Joins of hot keys, and clustered tables."""

import pytest
from pyspark.sql import functions as F

from augur.operators.hot_join import hot_join, hot_keys
from augur.sources.clustered import clustered_files, read_clustered, write_clustered
from conftest import SF_SMALL


@pytest.fixture(scope="module")
def skewed(spark):
    """Key 0 holds a third of the rows, NULL a sixth, the others 1 to 4 each."""
    key = F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 6 == 1, None).otherwise(F.col("id") % 5000)
    return spark.range(30_000).select(key.cast("long").alias("k"), F.concat(F.lit("g"), key % 7).alias("g"), F.col("id").alias("v"))


@pytest.fixture(scope="module")
def other(spark, skewed):
    found = skewed.select("k", "g").distinct().where("k is null or k % 11 != 5")
    return found.withColumn("w", F.col("k") * 2).unionByName(found.where("k = 0").withColumn("w", F.lit(-1).cast("long")))


def rows(df):
    return sorted((tuple(r) for r in df.select(sorted(df.columns)).collect()), key=repr)


def test_hot_keys_are_those_over_the_share(spark, skewed):
    found = {r["_hash"]: r["_salts"] for r in hot_keys(skewed, ["k", "g"], 0.01).collect()}
    hashes = {(r["k"], r["g"]): r["h"] for r in skewed.select("k", "g", F.xxhash64("k", "g").alias("h")).distinct().collect()}
    assert set(found) == {hashes[0, "g0"], hashes[None, None]}
    assert found[hashes[0, "g0"]] in (33, 34, 35)
    assert hot_keys(skewed.where("false"), ["k"], 0.01).collect() == []
    with pytest.raises(ValueError):
        hot_keys(skewed, ["k"], 0)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_hot_join_equals_join(skewed, other, how):
    assert rows(hot_join(skewed, other, ["k", "g"], how, share=0.01)) == rows(skewed.join(other, ["k", "g"], how))
    # no hot key, empty sides
    assert rows(hot_join(skewed, other, ["k", "g"], how, share=0.9)) == rows(skewed.join(other, ["k", "g"], how))
    none = other.where("false")
    assert rows(hot_join(skewed, none, ["k", "g"], how, share=0.01)) == rows(skewed.join(none, ["k", "g"], how))
    assert hot_join(skewed.where("false"), other, ["k", "g"], how).collect() == []


def test_hot_join_refuses_what_it_cant_do(skewed, other):
    with pytest.raises(ValueError):
        hot_join(skewed, other, ["k"], "full")
    with pytest.raises(ValueError):
        hot_join(skewed, other.withColumn("k", F.col("k").cast("int")), ["k"])


def test_no_task_gets_the_hot_key(spark, skewed, other):
    """The largest task of the join holds at most three times the median."""
    kept = {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", False)
    spark.conf.set("spark.sql.shuffle.partitions", 32)
    try:
        def largest(joined):
            sizes = sorted(r["count"] for r in joined.groupBy(F.spark_partition_id().alias("p")).count().collect())
            return sizes[-1] / sizes[len(sizes) // 2]

        right = other.where("w is null or w >= 0")
        assert largest(skewed.join(right, ["k", "g"], "left")) > 10
        assert largest(hot_join(skewed, right, ["k", "g"], "left")) <= 3
    finally:
        for c, v in kept.items():
            spark.conf.set(c, v)


def test_clustered_look_up_opens_few_files(spark, skewed, tmp_path):
    path = f"{tmp_path}/clustered"
    write_clustered(skewed, path, ["k", "g"], tie=["v"], num_files=24)
    index = spark.read.parquet(f"{path}/files")
    assert index.agg(F.sum("rows")).first()[0] == 30_000 and index.count() > 16
    for at in [(17,), (17, "g3"), (17, "g4"), (0,), (None,), (4999,), (70_000,)]:
        cond = F.col("k").eqNullSafe(at[0]) & (F.col("g").eqNullSafe(at[1]) if len(at) > 1 else F.lit(True))
        assert rows(read_clustered(spark, path, *at)) == rows(skewed.where(cond)), at
    found = read_clustered(spark, path, 17)
    assert len(found.inputFiles()) == clustered_files(spark, path, 17).count() <= 2
    assert len(read_clustered(spark, path, 0).inputFiles()) >= 6  # the hot key fills several files
    between = read_clustered(spark, path, 100, upto=300)
    assert rows(between) == rows(skewed.where("k between 100 and 300")) and len(between.inputFiles()) <= 4
    assert rows(read_clustered(spark, path, 17, "g0", upto="g3")) == rows(skewed.where("k = 17 and g <= 'g3'"))
    assert rows(read_clustered(spark, path, 0, most_files=2)) == rows(skewed.where("k = 0"))
    with pytest.raises(ValueError):
        read_clustered(spark, path)


def test_clustered_empty_table(spark, skewed, tmp_path):
    write_clustered(skewed.where("false"), f"{tmp_path}/none", ["k"])
    assert read_clustered(spark, f"{tmp_path}/none", 1).collect() == []


def test_one_forecasters_history_opens_few_files(spark, tmp_path):
    from augur.sources.tables import forecasts

    fact, path = forecasts(spark, SF_SMALL, checked=False), f"{tmp_path}/fact"
    write_clustered(fact, path, ["forecaster_sk", "question_id"], tie=["forecast_timestamp"], num_files=8)
    one = fact.groupBy("forecaster_sk").count().orderBy(F.desc("count"), "forecaster_sk").first()[0]
    found = read_clustered(spark, path, one)
    assert len(found.inputFiles()) <= 2 < spark.read.parquet(f"{path}/files").count()
    assert rows(found) == rows(fact.where(F.col("forecaster_sk") == one))
