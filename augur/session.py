"""Spark session settings used by the library, tests and the benchmark."""

from __future__ import annotations

import itertools
import tempfile
import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

# Settings every job in this library assumes. AQE re-plans joins from runtime
# sizes (broadcast only below the threshold, skew-join splitting), coalesces
# small shuffle partitions and keeps timestamps zone-free.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


# Fixed values of a large run: shuffle partitions and their limit. Beyond the
# limit more partitions cost more in shuffle blocks and map statuses (both grow
# with map tasks x partitions) than they save; AQE splits what is too large.
SHUFFLE_MB = 256
MOST_PARTITIONS = 20_000


def cluster_conf(total_cores: int, shuffled_tb: float) -> dict[str, str]:
    """Settings for a large cluster run (what a Spark user would pass with
    ``--conf``). ``shuffled_tb`` is the largest volume one exchange moves, not
    the input: jobs here aggregate map-side, so an exchange is usually far
    smaller than the scan. Shuffle partitions are ~256 MB, two a core at
    least and at most 20,000; AQE coalesces them. Input splits are 256 MB (1 GB
    from 10 TB shuffled on, which keeps map tasks and with them shuffle blocks
    down); skew join on for partitions 5x the median and above 512 MB;
    broadcasts only below 64 MB measured size."""
    initial = max(2 * total_cores, int(shuffled_tb * 1024 * 1024 / SHUFFLE_MB))
    initial = min(initial, MOST_PARTITIONS)
    return {
        "spark.sql.shuffle.partitions": str(initial),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(initial),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
        "spark.sql.files.maxPartitionBytes": "256m" if shuffled_tb < 10 else "1g",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
        "spark.sql.autoBroadcastJoinThreshold": "64m",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    }


def build_session(
    app: str = "augur",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster that setting points at shared storage and is used as is.
    Unset, a local folder is made for a ``local[...]`` master only: on a
    cluster every executor would write to a disk of its own.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no driver-side context here
        if not path:
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster") from None
        return path
    current = sc.getCheckpointDir()
    if current:
        return current
    if not path:
        master = sc.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder shared by the cluster ({master})")
        path = tempfile.mkdtemp(prefix="augur-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


# this process's folder below <checkpoint dir>/tables: no other run shares it
_run = uuid.uuid4().hex


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tables/{_run}/{name}-{next(_counter)}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a ``scratch_path`` and read back: computed once, and
    not anew where an executor is lost."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def concurrently(jobs: Mapping[str, Callable]) -> dict:
    """Results of independent functions that run Spark jobs, each submitted by a thread of its own."""
    with ThreadPoolExecutor(max_workers=max(1, len(jobs))) as pool:
        return dict(pool.map(lambda item: (item[0], item[1]()), jobs.items()))


def clear_scratch(spark: SparkSession) -> bool:
    """Remove what this run wrote with ``scratch_path``. Call it when nothing
    that reads those tables is needed any more (the command line does so at
    its end). Returns whether there was something to remove."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    folder = jvm.org.apache.hadoop.fs.Path(f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{_run}")
    return bool(folder.getFileSystem(conf).delete(folder, True))


# itertools.count is safe to advance from concurrent job-submitting threads
_counter = itertools.count(1)
