import types

import pytest

from augur import session
from augur.session import clear_scratch, cluster_conf, ensure_checkpoint_dir, scratch_path


def test_checkpoint_dir_is_read_from_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir")
    got = ensure_checkpoint_dir(spark)
    assert got.replace("file:", "").startswith(configured)
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(got)


def test_scratch_tables_are_removed(spark, monkeypatch):
    monkeypatch.setattr(session, "_run", "removed-by-test")
    path = scratch_path(spark, "t")
    spark.range(3).write.parquet(path)
    assert clear_scratch(spark) and not clear_scratch(spark)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


def test_cluster_without_shared_folder_is_an_error():
    context = types.SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077")
    fake = types.SimpleNamespace(conf=types.SimpleNamespace(get=lambda *a: None), sparkContext=context)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(fake)


def test_cluster_conf_follows_the_shuffled_volume():
    small, big = cluster_conf(4000, 0.1), cluster_conf(4000, 100)
    assert int(small["spark.sql.shuffle.partitions"]) == 8000
    assert int(big["spark.sql.shuffle.partitions"]) == 20_000
    assert big["spark.sql.adaptive.advisoryPartitionSizeInBytes"] == "256m"
