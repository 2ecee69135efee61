"""Session settings the operators count on, and durable lineage cuts."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # wide plans hold many columns; do not record the call site of each
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "netsleuth", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings above; ``conf`` overrides them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shuffle_width(spark: SparkSession) -> int:
    """How many reduce tasks the session plans for."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ship(spark: SparkSession) -> None:
    """Send this package to the workers, once per application, as a zip that Spark distributes."""
    context = spark.sparkContext
    if getattr(context, "_netsleuth_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(), "netsleuth.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.relpath(full, os.path.dirname(root)))
    context.addPyFile(path)
    context._netsleuth_shipped = True


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local session without ``spark.checkpoint.dir`` gets a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    own = tempfile.mkdtemp(prefix="netsleuth-")
    context.setCheckpointDir(own)
    return own


#: Whether a query that ends gives back its shuffle files.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


ADAPTIVE = "spark.sql.adaptive.enabled"


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """Queries run inside take ``value`` for ``key``."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


@contextmanager
def shuffles_given_back(spark: SparkSession) -> Iterator[None]:
    """Queries run inside drop their shuffle files as they end, not when the driver next collects garbage.

    Only for queries whose rows end up in files of their own, which nothing reads by the shuffle again.
    """
    with setting(spark, CLEANUP, "true"):
        yield


def durable(df: DataFrame, compression: str | None = None) -> DataFrame:
    """Cut the lineage by writing the rows to a table in the shared folder, by the session's codec if none is named.

    Lost executors only reread it. Later plans see its true size and columns, so
    the optimizer prunes and picks join strategies as for any other table.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/layers/{uuid.uuid4().hex}"
    with shuffles_given_back(spark):
        df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def durable_partitions(df: DataFrame, adaptive: bool = False) -> DataFrame:
    """Cut the lineage with a reliable checkpoint, which keeps the partitioning.

    An adaptive plan does not tell how its rows are partitioned, so later joins and groups would shuffle them again. If
    only the number of partitions counts, the plan may be ``adaptive``.
    """
    spark = df.sparkSession
    folder = shared_dir(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    with shuffles_given_back(spark), setting(spark, ADAPTIVE, spark.conf.get(ADAPTIVE) if adaptive else "false"):
        # a frame takes the setting as it is made
        return df.select("*").checkpoint()
