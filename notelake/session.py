"""Session helpers.

``get_session`` is for tests, scripts and the bench: on a cluster the session is
created by the platform and only the settings below that are still unset are
filled in.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the jobs rely on. Timestamps are kept as TIMESTAMP_NTZ throughout, so
# the session zone only matters for epoch conversions done by the caller.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int = 8,
                app_name: str = "notelake") -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if master and master.startswith("local") and "NOTELAKE_DRIVER_MEMORY" in os.environ:
        builder = builder.config("spark.driver.memory", os.environ["NOTELAKE_DRIVER_MEMORY"])
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster the folder is configured by the platform and is only read here; where it is
    unset there, an error is raised, as a folder of one machine would be lost on the others.
    Only in local mode (tests) a scratch folder is made.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        conf_dir = tempfile.mkdtemp(prefix="notelake-ckpt-")
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    spark.sparkContext.setCheckpointDir(conf_dir)
    return conf_dir


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: evaluated once, lineage
    cut, and kept when executors are lost."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def read_folder(spark: SparkSession, paths: str | list[str], **options) -> DataFrame:
    """Files as ``binaryFile`` rows. Folders are listed by as many tasks as the cluster has room for:
    Spark's default is up to 10,000 tasks for every folder of many folders, each with a result of
    some KB of its own for the driver, whatever it found."""
    given = spark.conf.get(_LISTING)
    spark.conf.set(_LISTING, str(min(int(given), 4 * spark.sparkContext.defaultParallelism)))
    try:
        return spark.read.format("binaryFile").options(**options).load(paths)
    finally:
        spark.conf.set(_LISTING, given)
