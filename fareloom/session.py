"""Session and shared-folder helpers."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark import SparkConf, SparkContext
from pyspark.sql import DataFrame, SparkSession


#: The setting that names the folder of the current run.
RUN = "fareloom.run"


def session(
    app: str = "fareloom", master: str | None = None, cores: int | str = "*", work: str | None = None
) -> SparkSession:
    """The platform's session when a master is configured (spark-submit), a local one otherwise.

    Cluster sizing and shuffle parallelism belong to the submit command; only the local fallback
    sets them here. ``work`` is the shared folder of intermediate tables where the platform names none.
    """
    builder = SparkSession.builder.appName(app)
    if work and not SparkConf().get("spark.checkpoint.dir", None):
        builder = builder.config("spark.checkpoint.dir", work)
    if master is None and SparkConf().get("spark.master", None):
        return builder.getOrCreate()
    return (
        builder.master(master or f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def _root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None) or _own_folder(spark.sparkContext)
    return f"{root.rstrip('/')}/fareloom"


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder name below the cluster's shared checkpoint folder.

    ``spark.checkpoint.dir`` names storage that every executor reaches. It is unset only in tests
    and local trials, where a temporary folder serves.
    """
    run = spark.conf.get(RUN, "")
    return "/".join(filter(None, (_root(spark), run, f"{name}-{uuid.uuid4().hex}")))


@contextmanager
def one_run(spark: SparkSession) -> Iterator[None]:
    """What is written to shared folders meanwhile is removed at the end, on whatever storage it is."""
    before, run = spark.conf.get(RUN, ""), f"run-{uuid.uuid4().hex}"
    spark.conf.set(RUN, run)
    try:
        yield
    finally:
        spark.conf.set(RUN, before)
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{_root(spark)}/{run}")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def written(table: DataFrame, name: str) -> DataFrame:
    """The table as a Parquet table in the shared folder, which outlives lost executors."""
    path = shared_folder(table.sparkSession, name)
    table.write.parquet(path)
    return table.sparkSession.read.parquet(path)


@cache
def _own_folder(context: SparkContext) -> str:
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="fareloom-")
    context.setCheckpointDir(folder)
    return folder
