"""Session defaults and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str | int = 8, app: str = "gatelake", **conf: str) -> SparkSession:
    """Single-JVM session for tests and the benchmark; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores if str(cores).isdigit() else 8))
        .config("spark.sql.adaptive.enabled", "true")
        # small test tables: do not merge shuffles down to one or two busy cores
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "128k")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.driver.extraJavaOptions", "-Xss8m")
    )
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; a fresh folder only where it is unset and the master is local."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = f"file://{tempfile.mkdtemp(prefix='gatelake-')}"
        spark.conf.set("spark.checkpoint.dir", path)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


def checkpoint(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: cuts lineage and survives lost executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


_WRITTEN: list[str] = []
_TABLES: list[str] = []


def drop_written(spark: SparkSession) -> int:
    """Deletes the tables ``materialize`` and ``bucketed`` wrote since the last call; DataFrames that read them are then unusable."""
    jvm, n = spark.sparkContext._jvm, 0
    while _TABLES:
        spark.sql(f"DROP TABLE IF EXISTS {_TABLES.pop()}")
    while _WRITTEN:
        path = jvm.org.apache.hadoop.fs.Path(_WRITTEN.pop())
        n += path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    return n


def materialize(df: DataFrame, label: str = "table", *, apart: str | None = None) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    For tables used by several branches of a plan: later scans prune columns
    and push filters, and the text they were derived from is read only once.
    Rows that differ in ``apart``, a column of few values, go to files of their
    own: a filter on it reads no others.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/gatelake/{label}-{uuid.uuid4().hex}"
    _WRITTEN.append(path)
    if apart is None:
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)
    with settings(spark, spark_sql_maxConcurrentOutputFileWriters="16"):  # no sort by a column of few values
        df.write.partitionBy(apart).parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)


def n_buckets(spark: SparkSession) -> int:
    """As many buckets as a shuffle has partitions, so that a shuffled side meets a bucketed one without a second exchange."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def bucketed(df: DataFrame, keys: list[str], label: str = "table", *, dealt: bool = False) -> DataFrame:
    """Write ``df`` once into buckets of ``keys`` in the shared folder and read it back.

    Joins and aggregations on the keys then take the table where it lies: only the
    other side is shuffled, or none where both are dealt alike. ``dealt`` says that
    the rows come dealt by the keys already. The table is named in the session's
    catalogue until ``drop_written``.
    """
    spark = df.sparkSession
    n, name = n_buckets(spark), f"gatelake_{label}_{uuid.uuid4().hex}"
    path = f"{shared_dir(spark)}/gatelake/{name}"
    _WRITTEN.append(path)
    _TABLES.append(name)
    rows = df if dealt else df.repartition(n, *keys)
    rows.write.option("path", path).bucketBy(n, *keys).saveAsTable(name, format="parquet")
    return spark.table(name)


@contextmanager
def settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """Session settings (``_`` for ``.``) for the actions of one block; the ones before are put back."""
    names = {k: k.replace("_", ".") for k in values}
    before = {k: spark.conf.get(n, None) for k, n in names.items()}
    for k, v in values.items():
        spark.conf.set(names[k], v)
    try:
        yield
    finally:
        for k, n in names.items():
            spark.conf.unset(n) if before[k] is None else spark.conf.set(n, before[k])
